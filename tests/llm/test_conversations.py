import hashlib
import math
import random
import re
import zlib

from tests.compare import connect, difference
from tidewell.llm import conversations
from tidewell.llm.queries import ORACLES, QUERIES

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
NAMES = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0d]+", text))


def plain_trie(rows):
    by_conv = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            by_conv.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(turns, key=lambda x: x[:2])] for c, turns in by_conv.items()}
    members, ends = {}, {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 4
        whole = own.get(conv - int(math.fmod(conv, 20)), [])[:h] + turns[h:]
        for d in range(len(whole) + 1):
            members.setdefault(tuple(whole[:d]), []).append(conv)
        ends.setdefault(tuple(whole), []).append(conv)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children.get(node, [])
        leaves[node] = sum(leaves[b] for b in below) or 1
        saved[node] = sum(saved[b] for b in below) + ((len(members[node]) - 1) * words(node[-1][1]) if node else 0)
    return sorted(
        (
            (
                min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(children.get(node, [])), leaves[node],
                saved[node], hashlib.sha256(",".join(map(str, sorted(ends.get(node, [])))).encode()).hexdigest(),
            )
            for node, m in members.items()
        ),
        key=repr,
    )


def found(spark, rows, **settings):
    out = conversations.prefix_trie(spark.createDataFrame(rows, SCHEMA), **settings)
    return sorted((tuple(r[n] for n in NAMES) for r in out.collect()), key=repr)


def made(rng, many, hot):
    """Conversations of few distinct turns; `hot` of them are one and the same, and some are long."""
    rows = []
    for conv in range(many):
        if conv < hot:
            turns = ["same start", "and so on", "to the end"]
        else:
            length = rng.choice([0, 1, 2, 3, 5, 40])
            turns = ["same start"] * rng.randint(0, 1) + [f"text {rng.randint(0, 2)}" for _ in range(length)]
        rows += [(conv, i, rng.choice(["user", "bot"]) if i > 5 else "user", t) for i, t in enumerate(turns)]
    rng.shuffle(rows)
    return rows


def test_against_plain_trie_over_many_partitions(spark):
    for seed, many, hot in ((1, 60, 0), (2, 150, 60), (3, 40, 40)):
        rows = made(random.Random(seed), many, hot)
        for size in (3, 20, 100_000):
            assert found(spark, rows, rows_per_part=size) == plain_trie(rows)


def test_nodes_shared_by_all_partitions_count_once(spark):
    """One long common beginning, and ids that end in the middle of it."""
    rows = [(20 * c, d, "user", f"turn {d}") for c in range(30) for d in range(3 + c % 12)]
    rows += [(20 * c, 20, "user", f"own {c}") for c in range(0, 30, 2)]
    for size in (1, 2, 7):
        assert found(spark, rows, rows_per_part=size) == plain_trie(rows)


def test_awkward_rows(spark):
    rows = [
        (1, None, None, None), (1, 0, "user", ""), (1, 0, "user", ""), (None, 0, "user", "no conversation"), (None, None, None, None),
        (20, 3, "user", "x " * 50_000), (21, 1, "", "a"), (-7, 0, "user", "a b\tc"), (-20, 0, "bot", "first"), (22, None, "user", "null turn"),
        (22, -5, "user", "é 日本"), (25, 0, "user:1", "a"), (26, 0, "user", ":1a"),
    ]
    assert found(spark, rows) == plain_trie(rows)
    assert found(spark, rows, rows_per_part=1) == plain_trie(rows)
    assert conversations.prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    nobody = spark.createDataFrame([(None, 1, "user", "x")], SCHEMA)
    assert conversations.prefix_trie(nobody).count() == 0


def test_clashing_columns_change_nothing(spark):
    rows = made(random.Random(4), 30, 5)
    names = "conv base turns given path words key part slot depth kind owner ends taken members".split()
    table = spark.createDataFrame([(*r, *["clash"] * len(names)) for r in rows], SCHEMA + "".join(f", {n} string" for n in names))
    out = conversations.prefix_trie(table)
    assert sorted((tuple(r[n] for n in NAMES) for r in out.collect()), key=repr) == plain_trie(rows)


def test_ids_of_a_hot_conversation_come_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(conversations, "PIECE_IDS", 3)
    rows = [(20 * c, 0, "user", "same") for c in range(50)]
    assert found(spark, rows, rows_per_part=9) == plain_trie(rows)


def test_query_matches_sql(spark, folder):
    problem, count = difference(QUERIES["op11_prefix_trie"](spark, folder), connect(folder), ORACLES["op11_prefix_trie"])
    assert problem is None and count > 0

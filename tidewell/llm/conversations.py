"""A prefix trie of conversations, from the longest common prefixes of sorted neighbours.

A conversation is a row: its turns' digests, joined to one binary path, and their numbers of words. Rows are sorted
over all partitions by path and id, so a node of the trie (a distinct sequence of first turns) is a run of
neighbours. Within a partition, neighbours are joined by edges of their common depth, and union-find takes the edges
in descending depth: a component that is merged at a depth is a branching node there, and what it was deeper down
becomes its children. Nodes on the path of a partition's first or last row may go on in other partitions. These two
paths are all that is left of a partition's forest when it is contracted: partial counts per open node, which are
merged by the node's own key. Of the partitions that share an open node the first one owns it, so that its words,
its leaf and its place among its parent's children count once.

A turn or conversation that very many share is a partial row per partition. The ids that end at a node are hashed
where they lie, or, for an open node, as a stream of small pieces in order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewell.storage import write_once

DIGEST = 16
GROUP = 20
SHARED_TURNS = 4
ROWS_PER_PART = 100_000
#: Ids of one piece of an open node's list.
PIECE_IDS = 4096
WORD = "[^ \\t-\\r]+"
NOTHING = hashlib.sha256(b"").hexdigest()


def turns_of(table: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """conv and turns (array of digest and words, in order) of every conversation.

    Turns are in the order of their number, null first, and of their digest where numbers repeat. A null role or
    text counts as empty. Rows without a conversation are in none.
    """
    role, text = (F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in (role_col, text_col))
    rows = table.filter(F.col(f"`{conv_col}`").isNotNull()).select(
        F.col(f"`{conv_col}`").cast("bigint").alias("conv"),
        F.struct(
            F.col(f"`{turn_col}`").alias("turn"),
            F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)).alias("digest"),
            F.regexp_count(text, F.lit(WORD)).alias("words"),
        ).alias("turn"),
    )
    # Dealt out by group, so that conversations meet the one they start from without another shuffle.
    rows = rows.withColumn("base", F.col("conv") - F.col("conv") % GROUP).repartition("base")
    return rows.groupBy("base", "conv").agg(F.sort_array(F.collect_list("turn")).alias("turns"))


def rebuilt(convs: DataFrame, shared: int = SHARED_TURNS) -> DataFrame:
    """conv, path (digests, 16 bytes each) and words of conversations that start as the first of their group.

    The first crc32(id) mod `shared` turns are those of the conversation with id - id % GROUP, a remainder that has
    the id's sign.
    """
    head = F.when(F.col("conv") == F.col("base"), F.slice("turns", 1, shared - 1))
    given = F.coalesce(F.max(head).over(W.partitionBy("base")), F.slice("turns", 1, 0))
    given = given if shared > 1 else F.slice("turns", 1, 0)
    taken = F.crc32(F.col("conv").cast("string").cast("binary")) % shared
    own = F.slice("turns", taken.cast("int") + 1, F.size("turns"))
    turns = F.concat(F.slice("given", 1, taken.cast("int")), own)
    return convs.withColumn("given", given).withColumn("turns", turns).select(
        "conv",
        F.unhex(F.array_join(F.transform("turns", lambda t: t["digest"]), "")).alias("path"),
        F.transform("turns", lambda t: t["words"]).alias("words"),
    )


def common_depth(a: bytes, b: bytes) -> int:
    """Number of leading turns two paths share."""
    if b.startswith(a):
        return len(a) // DIGEST
    low, high = 0, min(len(a), len(b)) // DIGEST
    while low < high:
        middle = (low + high + 1) // 2
        if a[:middle * DIGEST] == b[:middle * DIGEST]:
            low = middle
        else:
            high = middle - 1
    return low


class Component:
    """Neighbouring rows that share `depth` turns, with what hangs below the node there."""

    __slots__ = ("low", "high", "depth", "least", "ends", "children", "tops", "leaves", "members", "once")

    def __init__(self, row: int, depth: int, conv: int):
        self.low = self.high = row
        self.depth = depth
        self.least = conv
        #: Rows, from `low` on, whose last turn is at `depth`.
        self.ends = 1
        self.children = 0
        #: Numbers of the nodes whose parent is not made yet.
        self.tops: list[int] = []
        self.leaves = 0
        #: Words of the nodes below, each as often as it has members; of closed nodes, once.
        self.members = self.once = 0


class Forest:
    """The nodes of one partition's sorted rows."""

    def __init__(self, convs: list[int], paths: list[bytes], words: list[list[int]]):
        self.convs, self.paths, self.words = convs, paths, words
        #: low, high, depth, least, children, leaves, members, once, ends
        self.nodes: list[tuple] = []
        self.parents: list[int] = []
        self.depths = [len(p) // DIGEST for p in paths]
        self._join()

    def open(self, low: int, high: int) -> bool:
        """Whether a node may go on in another partition: whether it holds the first or the last row."""
        return low == 0 or high == len(self.convs) - 1

    def _raise(self, part: Component, depth: int) -> None:
        """Make the nodes of a component down to below `depth`; it then hangs at `depth`."""
        n, row = part.high - part.low + 1, self.words[part.low]
        is_open = self.open(part.low, part.high)
        while part.depth > depth:
            words = row[part.depth - 1] if part.depth else 0
            part.members += n * words
            if not is_open:
                part.once += words
            # Whether an open node has children is known only when all partitions are merged.
            if not part.children and not is_open:
                part.leaves += 1
            number = len(self.nodes)
            self.nodes.append(
                (part.low, part.high, part.depth, part.least, part.children, part.leaves, part.members, part.once, part.ends)
            )
            self.parents.append(-1)
            for top in part.tops:
                self.parents[top] = number
            part.tops, part.children, part.ends = [number], 0 if is_open else 1, 0
            part.depth -= 1

    def _join(self) -> None:
        rows = [Component(i, d, c) for i, (d, c) in enumerate(zip(self.depths, self.convs))]
        edges = [common_depth(a, b) for a, b in zip(self.paths, self.paths[1:])]
        root = list(range(len(rows)))

        def find(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        for i in sorted(range(len(edges)), key=lambda i: -edges[i]):
            left, right = find(i), find(i + 1)
            a, b = rows[left], rows[right]
            self._raise(a, edges[i])
            self._raise(b, edges[i])
            a.high = b.high
            a.least = min(a.least, b.least)
            a.ends += b.ends
            a.children += b.children
            a.tops += b.tops
            a.leaves += b.leaves
            a.members += b.members
            a.once += b.once
            root[right] = left
        self._raise(rows[find(0)], -1)

    def key(self, row: int, depth: int) -> bytes:
        return hashlib.blake2b(self.paths[row][:depth * DIGEST], digest_size=DIGEST).digest()


FIELDS = {
    "kind": pa.string(), "part": pa.int32(), "slot": pa.int32(), "conv_id": pa.int64(), "depth": pa.int64(),
    "parent_slot": pa.int32(), "parent_conv_id": pa.int64(), "n_convs": pa.int64(), "n_children": pa.int64(),
    "n_leaves": pa.int64(), "members": pa.int64(), "once": pa.int64(), "words": pa.int64(), "inner": pa.bool_(),
    "key": pa.binary(), "parent_key": pa.binary(), "ends": pa.string(),
}
SCHEMA = (
    "kind string, part int, slot int, conv_id bigint, depth bigint, parent_slot int, parent_conv_id bigint, n_convs bigint, "
    "n_children bigint, n_leaves bigint, members bigint, once bigint, words bigint, inner boolean, key binary, "
    "parent_key binary, ends string"
)
BATCH = 4096


def _records(forest: Forest, part: int) -> Iterator[dict]:
    """A partition's closed nodes, the open ones of its contracted forest, and the pieces of their ids."""
    nodes, parents = forest.nodes, forest.parents
    is_open = [forest.open(n[0], n[1]) for n in nodes]
    inner = [False] * len(nodes)
    for number, parent in enumerate(parents):
        if parent >= 0:
            inner[parent] = True
    for number, (low, high, depth, least, children, leaves, members, once, ends) in enumerate(nodes):
        parent = parents[number]
        out = {
            "kind": "closed", "part": part, "slot": number, "conv_id": least, "depth": depth, "n_convs": high - low + 1,
            "n_children": children, "n_leaves": leaves, "members": members, "once": once,
        }
        ids = forest.convs[low:low + ends]
        if not is_open[number]:
            out["ends"] = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
            if is_open[parent]:
                out["parent_slot"] = parent
            else:
                out["parent_conv_id"] = nodes[parent][3]
            yield out
            continue
        key = forest.key(low, depth)
        out |= {"kind": "open", "key": key, "words": forest.words[low][depth - 1] if depth else 0, "inner": inner[number]}
        if parent >= 0:
            out |= {"parent_slot": parent, "parent_key": forest.key(low, depth - 1)}
        yield out
        for i in range(0, len(ids), PIECE_IDS):
            piece = ",".join(map(str, ids[i:i + PIECE_IDS]))
            yield {"kind": "piece", "part": part, "slot": i // PIECE_IDS, "key": key, "ends": piece}


def _batched(records: Iterator[dict]) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    for record in records:
        held.append(record)
        if len(held) == BATCH:
            yield pa.RecordBatch.from_pylist(held, pa.schema(list(FIELDS.items())))
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, pa.schema(list(FIELDS.items())))


def forests(rows: DataFrame, rows_per_part: int = ROWS_PER_PART) -> DataFrame:
    """The records of every partition of the sorted rows (conv, path, words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        convs: list[int] = []
        paths: list[bytes] = []
        words: list[list[int]] = []
        for batch in batches:
            convs += batch.column("conv").to_pylist()
            paths += batch.column("path").to_pylist()
            words += batch.column("words").to_pylist()
        if convs:
            yield from _batched(_records(Forest(convs, paths, words), TaskContext.get().partitionId()))

    spark = rows.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // rows_per_part))
    dealt = rows.repartitionByRange(parts, "path", "conv").sortWithinPartitions("path", "conv")
    return write_once(dealt.mapInArrow(run, SCHEMA), "trie-forests")


def _count_owned(rows: pd.DataFrame) -> pd.DataFrame:
    """Add to a partition's open nodes what the open nodes below them count for, each for its owner only."""
    rows = rows.sort_values("slot").reset_index(drop=True)  # children come before their parents
    at = {slot: i for i, slot in enumerate(rows["slot"])}
    mine = (rows["part"] == rows["owner"]).tolist()
    children, leaves, once = (rows[c].tolist() for c in ("n_children", "n_leaves", "once"))
    more_leaves = [int(m and not inner) for m, inner in zip(mine, rows["any_inner"])]
    more_words = [int(w) if m else 0 for m, w in zip(mine, rows["words"])]
    for i, parent in enumerate(rows["parent_slot"]):
        if parent >= 0:
            up = at[parent]
            children[up] += mine[i]
            more_leaves[up] += more_leaves[i]
            more_words[up] += more_words[i]
    sums = {
        "n_children": children,
        "n_leaves": [a + b for a, b in zip(leaves, more_leaves)],
        "once": [a + b for a, b in zip(once, more_words)],
    }
    return rows.assign(**sums)[COUNTED]


COUNTED = ["key", "parent_key", "depth", "conv_id", "n_convs", "n_children", "n_leaves", "members", "once"]
COUNTED_SCHEMA = (
    "key binary, parent_key binary, depth bigint, conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, "
    "members bigint, once bigint"
)


def merged(open_nodes: DataFrame) -> DataFrame:
    """The open nodes of all partitions, one row each."""
    owners = open_nodes.groupBy("key").agg(F.min("part").alias("owner"), F.max("inner").alias("any_inner"))
    wanted = [*COUNTED, "part", "slot", F.coalesce("parent_slot", F.lit(-1)).alias("parent_slot"), "words"]
    counted = open_nodes.select(*wanted).join(owners, "key").groupBy("part").applyInPandas(_count_owned, COUNTED_SCHEMA)
    return counted.groupBy("key").agg(
        F.max("parent_key").alias("parent_key"), F.max("depth").alias("depth"), F.min("conv_id").alias("conv_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "members", "once")],
    )


def _hash_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest per key of pieces that come in order."""
    key, digest = None, None
    keys: list[bytes] = []
    found: list[str] = []
    for batch in batches:
        for name, piece in zip(batch.column("key").to_pylist(), batch.column("ends").to_pylist()):
            if name != key:
                if key is not None:
                    keys.append(key)
                    found.append(digest.hexdigest())
                key, digest = name, hashlib.sha256(piece.encode())
            else:
                digest.update(b"," + piece.encode())
    if key is not None:
        keys.append(key)
        found.append(digest.hexdigest())
    yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(found, pa.string())], names=["key", "ends"])


def prefix_trie(
    table: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    rows_per_part: int = ROWS_PER_PART,
    rebuild: bool = True,
) -> DataFrame:
    """One row per node of the trie of all conversations, the textless root included.

    conv_id is the smallest member, n_convs counts members, n_children and n_leaves (nodes without children in the
    subtree, itself included) are about the trie, saved_tokens sums (members - 1) times the words of a node's last
    turn over the subtree, and ends_sha256 is that of the comma-joined ids of members that end at the node. With
    `rebuild`, conversations first get the first turns of their group (see `rebuilt`).

    Rows of null conversations are in no node, null roles and texts are empty, repeated turns stay and are in the
    order of their digest, and an empty table has no nodes. Other columns are not read. A conversation's digests
    (16 bytes a turn) are held in one row. Turns are told apart by 128 bits of hash.
    """
    convs = turns_of(table, conv_col, turn_col, role_col, text_col)
    rows = write_once(rebuilt(convs, shared=SHARED_TURNS if rebuild else 1), "conversations")
    records = forests(rows, rows_per_part)
    open_nodes = records.filter("kind = 'open'")
    whole = write_once(merged(open_nodes), "trie-open")
    pieces = records.filter("kind = 'piece'").select("key", "part", "slot", "ends")
    pieces = pieces.repartition("key").sortWithinPartitions("key", "part", "slot")
    ends = pieces.mapInArrow(_hash_pieces, "key binary, ends string")

    saved = (F.col("members") - F.col("once")).alias("saved_tokens")
    above = whole.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    shared = whole.join(above, "parent_key", "left").join(ends, "key", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", saved,
        F.coalesce("ends", F.lit(NOTHING)).alias("ends_sha256"),
    )
    closed = records.filter("kind = 'closed'")
    columns = ["n_convs", "n_children", "n_leaves", saved, F.col("ends").alias("ends_sha256")]
    inside = closed.filter("parent_slot IS NULL").select("conv_id", "depth", "parent_conv_id", *columns)
    # By partition and place there, so that what hangs on one common turn is still dealt out by partition.
    places = open_nodes.select("part", F.col("slot").alias("parent_slot"), "key").join(
        whole.select("key", F.col("conv_id").alias("above")), "key"
    )
    hanging = closed.filter("parent_slot IS NOT NULL").join(places.drop("key"), ["part", "parent_slot"])
    hanging = hanging.select("conv_id", "depth", F.col("above").alias("parent_conv_id"), *columns)
    return inside.unionByName(hanging).unionByName(shared)

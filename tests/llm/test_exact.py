import hashlib

import pytest

from tests.compare import connect, difference
from tests.llm.fixtures import awkward, check_awkward, with_clashes
from tidewell.llm import exact
from tidewell.llm.queries import ORACLES, QUERIES


def brute(rows, pick):
    groups = {}
    for number, text in rows:
        groups.setdefault(text or "", []).append(number)
    out = []
    for number, text in rows:
        known = [n for n in groups[text or ""] if n is not None]
        keep = pick(known) if known else None
        out.append((number, keep, len(groups[text or ""]), number == keep, hashlib.sha256((text or "").encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("keep,pick", [("largest", max), ("smallest", min)])
def test_against_plain_grouping(spark, keep, pick):
    rows = [(r["doc_id"], r["text"]) for r in awkward(spark).collect()]
    for runs, fan_in in ((4096, 16), (3, 2), (1, 2)):
        found = exact.exact_groups(awkward(spark), keep=keep, runs=runs, fan_in=fan_in)
        assert sorted(map(tuple, found.collect()), key=repr) == brute(rows, pick)


def test_awkward(spark):
    check_awkward(spark, exact.exact_groups)


def test_drop_keeps_columns_and_one_of_each(spark):
    docs = with_clashes(awkward(spark))
    left = exact.drop_exact(docs, keep="smallest")
    assert left.columns == docs.columns
    assert sorted((r["doc_id"] for r in left.collect()), key=repr) == sorted([1, 3, 5, None, 6, 7, 8, -9], key=repr)


def test_query_matches_sql(spark, folder):
    problem, count = difference(QUERIES["op7_exact_dedup"](spark, folder), connect(folder), ORACLES["op7_exact_dedup"])
    assert problem is None and count > 0


def test_no_python_in_the_plan(spark, folder):
    plan = QUERIES["op7_exact_dedup"](spark, folder)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_wrong_choice(spark):
    with pytest.raises(ValueError):
        exact.exact_groups(awkward(spark), keep="any")

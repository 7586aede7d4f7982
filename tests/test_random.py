"""Random tables with repeated and NULL keys against a brute-force reading of each operator."""

import random

import pytest

import driftmend as dm
from fixtures import bag, by_key, statuses

SCHEMA = "k1 int, k2 string, n int, s string"
KEYS = ["k1", "k2"]


def table(seed):
    pick = random.Random(seed)

    def value(choices):
        return pick.choice([None, *choices])

    return [
        (value(range(40)), value("abcdef"), value(range(3)), value(["x", "y|z", "::", ""])) for _ in range(pick.randint(150, 250))
    ]


@pytest.fixture(scope="module", params=[1, 2])
def case(request, spark):
    ours, theirs = table(request.param), table(request.param + 100)
    theirs += ours[: len(ours) // 2]
    return ours, theirs, spark.createDataFrame(ours, SCHEMA), spark.createDataFrame(theirs, SCHEMA)


def rows(df):
    return bag(tuple(r) for r in df.collect())


def without(first, second):
    known = by_key(second)
    return [r for r in first if r[:2] not in known]


def test_row_and_digest_diff(case):
    ours, theirs, target, given = case
    expected = statuses(ours, theirs)
    found = {(r["k1"], r["k2"]): (r["status"], tuple(r["changed_cols"])) for r in dm.row_diff(target, given, KEYS).collect()}
    assert found == expected
    by_digest = {(r["k1"], r["k2"]): r["status"] for r in dm.digest_diff(target, given, KEYS, include_same=True).collect()}
    assert by_digest == {k: status for k, (status, _) in expected.items()}


def test_bag_diff(case):
    ours, theirs, target, given = case
    a, b = bag(ours), bag(theirs)
    expected = {r: (a.get(r, 0), b.get(r, 0)) for r in {*a, *b} if a.get(r, 0) != b.get(r, 0)}
    assert {tuple(r)[:4]: tuple(r)[4:] for r in dm.bag_diff(target, given).collect()} == expected


def test_sync(case):
    ours, theirs, target, given = case
    assert rows(dm.sync(target, given, KEYS)) == bag([*theirs, *without(ours, theirs)])
    assert rows(dm.sync(target, given, KEYS, "upsert")) == bag([*ours, *without(theirs, ours)])
    assert rows(dm.rows_to_delete(target, given, KEYS)) == bag(without(theirs, ours))


def test_merge_latest(case):
    ours, theirs, target, given = case
    a, b = by_key(ours), by_key(theirs)

    def version(group):
        return max((r[2] for r in group if r[2] is not None), default=None)

    expected = []
    for key in {*a, *b}:
        mine, other = version(a.get(key, [])), version(b.get(key, []))
        given_wins = key not in a or (key in b and other is not None and (mine is None or other > mine))
        expected += b[key] if given_wins else a[key]
    assert rows(dm.merge_bidirectional(target, given, KEYS, "latest", version="n")) == bag(expected)


def test_merge_fill_nulls(case):
    ours, theirs, target, given = case
    b = by_key(theirs)

    def least(key, i):
        return min((r[i] for r in b.get(key, []) if r[i] is not None), default=None)

    filled = [(*r[:2], *(v if v is not None else least(r[:2], i) for i, v in enumerate(r[2:], start=2))) for r in ours]
    assert rows(dm.merge_bidirectional(target, given, KEYS, "fill_nulls")) == bag([*filled, *without(theirs, ours)])


def test_orphans(case):
    ours, theirs, target, given = case
    parents = {r[:2] for r in theirs[::3]}
    expected = [r for r in ours if None not in r[:2] and r[:2] not in parents]
    parent = target.sparkSession.createDataFrame(theirs[::3], SCHEMA)
    assert rows(dm.orphan_rows(target, parent, KEYS, KEYS)) == bag(expected)
    counted = {tuple(r)[:2]: r["n_rows"] for r in dm.orphan_keys(target, parent, KEYS, KEYS).collect()}
    assert counted == bag(r[:2] for r in expected)

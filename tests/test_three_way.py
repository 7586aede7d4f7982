"""Three-way merges against a brute-force reading, on random tables with repeated and NULL keys."""

import random
from collections import Counter

import pytest

import driftmend as dm

SCHEMA = "k1 int, k2 string, n int, s string"
KEYS = ["k1", "k2"]


def drawn(seed):
    pick = random.Random(seed)
    value = lambda choices: pick.choice([None, *choices])
    row = lambda: (value(range(30)), value("abc"), value(range(3)), value(["x", ""]))
    base = [row() for _ in range(120)]

    def altered():
        out = []
        for r in base:
            what = pick.random()
            if what < 0.6:
                out.append(r)
            elif what < 0.8:
                out.append((*r[:2], value(range(3)), r[3]))
        return out + [row() for _ in range(20)]

    ours, theirs = altered(), altered()
    theirs += ours[-10:]
    return base, ours, theirs


def by_key(rows):
    found = {}
    for r in rows:
        found.setdefault(r[:2], []).append(r)
    return {k: Counter(v) for k, v in found.items()}


def expected(base, ours, theirs):
    b, t, g = by_key(base), by_key(ours), by_key(theirs)
    out = {}
    for key in {*b, *t, *g}:
        x, y, z = t.get(key, Counter()), g.get(key, Counter()), b.get(key, Counter())
        if x == y:
            out[key] = "same"
        elif y == z or x == z:
            side, now = ("target", x) if y == z else ("given", y)
            out[key] = f"{side}_{'deleted' if not now else 'inserted' if not z else 'changed'}"
        else:
            out[key] = "conflict_target_deleted" if not x else "conflict_given_deleted" if not y else "conflict"
    return out


def settled(base, ours, theirs, status, policy):
    b, t, g = by_key(base), by_key(ours), by_key(theirs)
    total = Counter()
    for key, what in status.items():
        x, y = t.get(key, Counter()), g.get(key, Counter())
        take = y if what.startswith("given_") else x
        if what.startswith("conflict"):
            if policy == "given_wins" or (what == "conflict_target_deleted" and policy in ("latest", "fill_nulls")):
                take = y
            elif policy == "latest" and what == "conflict":
                newest = lambda rows: max((r[2] for r in rows if r[2] is not None), default=None)
                a, c = newest(x), newest(y)
                take = y if c is not None and (a is None or c > a) else x
        if policy == "fill_nulls" and (what == "conflict" or (what == "same" and key not in b and sum(x.values()) > 1)):
            least = lambda i: min((r[i] for r in y if r[i] is not None), default=None)  # noqa: E731,B023
            take = Counter()
            for r, n in x.items():
                take[(*r[:2], *(v if v is not None else least(i) for i, v in enumerate(r[2:], start=2)))] += n
        total += take
    return total


@pytest.fixture(scope="module", params=[1, 2, 3])
def case(request, spark):
    rows = drawn(request.param)
    return rows, [spark.createDataFrame(r, SCHEMA) for r in rows]


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def test_status(case):
    rows, (base, target, given) = case
    found = dm.three_way_status(target, given, dm.keep_base(base, KEYS), KEYS).collect()
    assert {(r.k1, r.k2): r.status for r in found} == expected(*rows)


@pytest.mark.parametrize("policy", ["target_wins", "given_wins", "latest", "fill_nulls"])
def test_merge(case, policy):
    (first, ours, theirs), (base, target, given) = case
    found = dm.merge_three_way(target, given, dm.keep_base(base, KEYS), KEYS, policy, version="n")
    assert bag(found) == settled(first, ours, theirs, expected(first, ours, theirs), policy)


@pytest.mark.parametrize("policy", ["target_wins", "given_wins", "latest", "fill_nulls"])
def test_without_a_base_it_is_the_two_way_merge(case, policy):
    _, (_, target, given) = case
    two_way = dm.merge_bidirectional(target, given, KEYS, policy, version="n")
    assert bag(dm.merge_three_way(target, given, None, KEYS, policy, version="n")) == bag(two_way)
    empty = dm.keep_base(target.limit(0), KEYS)
    assert bag(dm.merge_three_way(target, given, empty, KEYS, policy, version="n")) == bag(two_way)


def test_merging_again_changes_nothing(case):
    _, (base, target, given) = case
    state = dm.merge_three_way(target, given, dm.keep_base(base, KEYS), KEYS)
    again = dm.keep_base(state, KEYS)
    assert {r.status for r in dm.three_way_status(state, state, again, KEYS).collect()} == {"same"}
    assert bag(dm.merge_three_way(state, given, dm.keep_base(given, KEYS), KEYS)) == bag(state)


def test_true_conflicts(spark):
    rows = lambda *r: spark.createDataFrame(list(r), "k int, n int, s string")
    base = rows((1, 1, "a"), (2, 1, "a"), (3, 1, "a"), (4, 1, "a"), (5, 1, "a"))
    target = rows((1, 2, "a"), (2, 2, "b"), (4, 2, "a"), (6, 1, None))
    given = rows((1, 1, "b"), (2, 2, "b"), (3, 9, "a"), (5, 2, "a"), (6, 2, None))
    found = dm.true_conflicts(target, given, dm.keep_base(base, ["k"]), ["k"]).collect()
    assert sorted(tuple(r) for r in found if r.column) == [(1, "n", "2", "1"), (1, "s", "a", "b"), (6, "n", "1", "2")]
    assert sorted(tuple(r) for r in found if not r.column) == [(3, None, "deleted", "changed"), (4, None, "changed", "deleted"), (5, None, "deleted", "changed")]


def test_a_base_of_other_columns_is_refused(spark):
    one = spark.createDataFrame([(1, 2)], "k int, n int")
    base = dm.keep_base(spark.createDataFrame([(1, 2)], "k int, n long"), ["k"])
    with pytest.raises(ValueError, match="the base was kept"):
        dm.merge_three_way(one, one, base, ["k"])


def test_no_rows_are_sorted(case):
    _, (base, target, given) = case
    plan = dm.three_way_status(target, given, dm.keep_base(base, KEYS), KEYS)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan

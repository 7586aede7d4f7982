"""Syncs of whole schemas against a brute-force reading: circles of references, tables of their own, refusals in consequence."""

import random

import pytest

import driftmend as dm
from driftmend.plans.schema_sync import layers
from driftmend.sources.sinks import work_folder

# a points at itself and at b, b at a, c at a: columns after the key are references.
POINTING = {"a": ["a", "b"], "b": ["a"], "c": ["a"], "d": ["c"]}
SCHEMAS = {name: "id int, " + "".join(f"r{i} int, " for i in range(len(to))) + "v string" for name, to in POINTING.items()}


def test_layers():
    assert layers(["x", "y", "z"], {"x": ["y"], "y": ["z"]}) == [["z"], ["y"], ["x"]]
    found = layers(sorted(POINTING), POINTING)
    assert found == [["a", "b"], ["c"], ["d"]]
    long = [f"t{i}" for i in range(3000)]
    assert len(layers(long, {a: [b] for a, b in zip(long, long[1:], strict=False)})) == 3000
    assert layers(["p", "q"], {"p": ["q", "p"], "q": ["p"]}) == [["p", "q"]]


def drawn(seed):
    pick = random.Random(seed)

    def side():
        tables = {}
        for name, to in POINTING.items():
            ids = [i for i in range(25) if pick.random() < 0.5]
            tables[name] = {i: (i, *(pick.choice([None, *range(25)]) if pick.random() < 0.5 else None for _ in to), pick.choice("uv")) for i in ids}
        return tables

    return side(), side()


def brute(target, given, mode):
    op = {}
    for name in POINTING:
        for k, row in target[name].items():
            if k not in given[name]:
                op[name, k] = "insert"
            elif row != given[name][k] and mode != "insert_missing":
                op[name, k] = "update"
        for k in given[name]:
            if k not in target[name] and mode == "mirror":
                op[name, k] = "delete"
    refs = lambda name, row: [(p, v) for p, v in zip(POINTING[name], row[1:-1], strict=True) if v is not None]
    refused = set()
    while True:
        there = lambda p, v: v in given[p] or (op.get((p, v)) == "insert" and (p, v) not in refused)  # noqa: E731,B023
        bad = {(n, k) for (n, k), o in op.items() if o != "delete" and (n, k) not in refused and any(not there(p, v) for p, v in refs(n, target[n][k]))}
        if not bad:
            break
        refused |= bad
    kept = set()
    while True:
        def after():
            for name in POINTING:
                for k in {*given[name], *target[name]}:
                    o = op.get((name, k))
                    done = o and (name, k) not in refused and (name, k) not in kept
                    if done and o in ("insert", "update"):
                        yield name, target[name][k]
                    elif k in given[name] and not (done and o == "delete"):
                        yield name, given[name][k]
        state = list(after())
        held = {(p, v) for n, row in state for p, v in refs(n, row) if op.get((p, v)) == "delete"} - kept
        if not held:
            break
        kept |= held
    states = {name: sorted(row for n, row in state if n == name) for name in POINTING}
    return states, {(n, op[n, k], str(k)) for n, k in refused | kept}


def spaces(spark, target, given):
    contracts = [dm.TableContract(n, "id", [dm.Reference(f"r{i}", p, "id") for i, p in enumerate(to)]) for n, to in POINTING.items()]
    make = lambda side: dm.Namespace("main", {n: spark.createDataFrame(list(rows.values()), SCHEMAS[n]) for n, rows in side.items()}, contracts)
    return make(target), make(given)


def text(row):
    return tuple("" if v is None else str(v) for v in row)


@pytest.mark.parametrize(("seed", "mode"), [(1, "insert_missing"), (2, "upsert"), (3, "mirror"), (4, "mirror")])
def test_agrees_with_brute_force(spark, seed, mode):
    target, given = drawn(seed)
    states, refused = brute(target, given, mode)
    plan = dm.sync_schema(*spaces(spark, target, given), mode)
    for name in POINTING:
        assert sorted((tuple(r) for r in plan.state(name).collect()), key=text) == sorted(states[name], key=text), name
    assert {(r.table, r.op, r.key) for r in plan.refused.collect()} == refused


def test_steps_never_leave_an_orphan(spark):
    """A consistent target is reached, and every step on the way leaves only rows with parents."""
    rows = {"p": "id int", "c": "id int, p int"}
    contracts = [dm.TableContract("p", "id"), dm.TableContract("c", "id", [dm.Reference("p", "p", "id")])]
    make = lambda p, c: dm.Namespace("main", {"p": spark.createDataFrame(p, rows["p"]), "c": spark.createDataFrame(c, rows["c"])}, contracts)
    target, given = make([(1,), (3,)], [(1, 3), (2, 1), (4, None)]), make([(1,), (2,)], [(1, 2), (2, 2), (3, 2)])
    out = work_folder(spark, "schema")
    plan = dm.run_schema_sync(target, given, out, "mirror")
    state = {n: {r.id: r for r in given.tables[n].collect()} for n in rows}
    for table, op in plan.steps:
        for r in spark.read.parquet(f"{out}/{table}/{op}").collect():
            if op == "delete":
                del state[table][r.id]
            else:
                state[table][r.id] = r
            assert all(c.p is None or c.p in state["p"] for c in state["c"].values())
    for n in rows:
        assert sorted(map(tuple, state[n].values()), key=str) == sorted(map(tuple, spark.read.parquet(f"{out}/{n}/state").collect()), key=str)
        assert sorted(map(tuple, state[n].values()), key=str) == sorted(map(tuple, target.tables[n].collect()), key=str)
    assert plan.refused.isEmpty() and spark.read.parquet(f"{out}/refused").isEmpty()


def test_a_chain_of_refusals_of_any_length(spark):
    """Row i points at row i - 1, and the first at nothing there is."""
    contracts = [dm.TableContract("t", "id", [dm.Reference("up", "t", "id")])]
    make = lambda rows: dm.Namespace("main", {"t": spark.createDataFrame(rows, "id int, up int")}, contracts)
    plan = dm.sync_schema(make([(i, i - 1) for i in range(6)] + [(50, None), (51, 50)]), make([]))
    assert plan.refused.count() == 6
    assert sorted(r.id for r in plan.state("t").collect()) == [50, 51]


def test_tables_without_a_key_keep_their_parents(spark):
    contracts = [dm.TableContract("p", "id"), dm.TableContract("log", (), [dm.Reference("p", "P", "ID")])]
    p = lambda *ids: spark.createDataFrame([(i,) for i in ids], "id int")
    log = spark.createDataFrame([(1,), (None,)], "p long")
    plan = dm.sync_schema(dm.Namespace("main", {"p": p(3), "log": log}, contracts), dm.Namespace("main", {"p": p(1, 2), "log": log}), "mirror")
    assert sorted(r.id for r in plan.state("p").collect()) == [1, 3]
    assert [tuple(r) for r in plan.refused.collect()] == [("p", "delete", "1", "log.p -> p")]


def test_references_must_point_at_a_key(spark):
    contracts = [dm.TableContract("p", "id"), dm.TableContract("c", "id", [dm.Reference("x", "p", "other")])]
    tables = {"p": spark.createDataFrame([(1, 2)], "id int, other int"), "c": spark.createDataFrame([(1, 2)], "id int, x int")}
    space = dm.Namespace("main", tables, contracts)
    with pytest.raises(ValueError, match="not its key"):
        dm.sync_schema(space, space)


def test_orphans_in_consequence(spark):
    """A chain of any length, a circle that holds itself up, and one that hangs on a row without a parent."""
    contracts = [dm.TableContract("t", "id", [dm.Reference("up", "t", "id")])]
    rows = [(1, 99), (2, 1), (3, 2), (4, 3), (10, None), (11, 10), (20, 21), (21, 20), (22, 21), (30, 30)]
    space = dm.Namespace("main", {"t": spark.createDataFrame(rows, "id int, up int")}, contracts)
    found = dm.consequent_orphans(space).collect()
    assert sorted((r.table, int(r.key), r.reference) for r in found) == [("t", i, "up -> t") for i in (1, 2, 3, 4)]

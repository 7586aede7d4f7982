"""Syncs of states kept as lists of files."""

import pytest

import driftmend as dm
from driftmend.sources.sinks import work_folder
from fixtures import GIVEN, KEYS, SCHEMA, TARGET, bag, by_key


def rows(df):
    return bag(tuple(r) for r in df.collect())


def state(spark, parts, schema, keys=None):
    """A registered state with one file per part."""
    folder = work_folder(spark, "a state+of files")
    for i, part in enumerate(parts):
        spark.createDataFrame(part, schema).coalesce(1).write.parquet(f"{folder}/data/part {i}")
    dm.register_files(spark, f"{folder}/data/*", f"{folder}/manifest")
    return f"{folder}/manifest"


def synced(ours, theirs, mode):
    a, b = by_key(ours), by_key(theirs)
    if mode == "mirror":
        return bag(ours)
    if mode == "upsert":
        return bag([*ours, *(r for r in theirs if r[:2] not in a)])
    return bag([*theirs, *(r for r in ours if r[:2] not in b)])


@pytest.mark.parametrize("mode", ["insert_missing", "upsert", "mirror"])
def test_reads_as_a_sync(spark, mode):
    """NULL and repeated keys, whose rows lie in several files."""
    target = spark.createDataFrame(TARGET, SCHEMA)
    manifest = state(spark, [GIVEN[:4], GIVEN[4:9], GIVEN[9:]], SCHEMA)
    run = dm.run_file_sync(target, manifest, KEYS, work_folder(spark, "sync"), mode)
    assert rows(dm.read_state(spark, run.manifest)) == synced(TARGET, GIVEN, mode)
    assert rows(dm.read_state(spark, manifest)) == bag(GIVEN)


def test_one_changed_row_rewrites_one_file(spark):
    parts = [[(i, i % 3, "x") for i in range(k, 1000, 10)] for k in range(10)]
    manifest = state(spark, parts, "k int, n int, s string")
    altered = [(i, i % 3, "y" if i == 437 else "x") for i in range(1000)]
    run = dm.run_file_sync(spark.createDataFrame(altered, "k int, n int, s string"), manifest, ["k"], work_folder(spark, "sync"), "upsert")
    assert (run.files_kept, run.files_dropped, run.files_added) == (9, 1, 1)
    changes = {(r.change, r.n_rows) for r in dm.file_changes(spark, manifest, run.manifest).collect()}
    assert changes == {("kept", 100), ("dropped", 100), ("added", 100)}
    assert rows(dm.read_state(spark, run.manifest)) == bag(altered)


def test_nothing_to_do_keeps_every_file(spark):
    parts = [[(i, "x")] for i in range(3)]
    manifest = state(spark, parts, "k int, s string")
    target = spark.createDataFrame([(i, "x") for i in range(3)], "k int, s string")
    run = dm.run_file_sync(target.select("s", "k"), manifest, ["K"], work_folder(spark, "sync"), "mirror")
    assert (run.files_kept, run.files_dropped, run.files_added) == (3, 0, 0)
    assert dm.read_state(spark, run.manifest).columns == ["k", "s"]


def test_syncs_follow_one_another_and_a_repeated_run_does_nothing(spark):
    make = lambda data: spark.createDataFrame(data, "k int, s string")
    manifest = state(spark, [[(1, "a"), (2, "b")], [(3, "c")]], "k int, s string")
    out = work_folder(spark, "sync")
    first = dm.run_file_sync(make([(1, "a"), (3, "d"), (4, "e")]), manifest, ["k"], out, "mirror")
    assert rows(dm.read_state(spark, first.manifest)) == bag([(1, "a"), (3, "d"), (4, "e")])
    assert dm.run_file_sync(make([(9, "z")]), manifest, ["k"], out, "mirror") == first
    second = dm.run_file_sync(make([]), first.manifest, ["k"], work_folder(spark, "sync"), "mirror")
    assert dm.read_state(spark, second.manifest).collect() == [] and second.files_kept == 0
    third = dm.run_file_sync(make([(5, "f")]), second.manifest, ["k"], work_folder(spark, "sync"))
    assert rows(dm.read_state(spark, third.manifest)) == bag([(5, "f")])


def test_a_lost_run_leaves_no_manifest(spark):
    manifest = state(spark, [[(1, "a")]], "k int, s string")
    out = work_folder(spark, "sync")
    target = spark.createDataFrame([(1, "b")], "k int, s string")
    target.write.parquet(f"{out}/data")
    spark.createDataFrame([("nowhere", 1)], "file string, n_rows long").write.parquet(f"{out}/manifest/files")
    run = dm.run_file_sync(target, manifest, ["k"], out, "upsert")
    assert rows(dm.read_state(spark, run.manifest)) == bag([(1, "b")])


def test_wider_values_are_refused(spark):
    manifest = state(spark, [[(1, 1)]], "k int, n int")
    with pytest.raises(ValueError, match="map the schema first"):
        dm.run_file_sync(spark.createDataFrame([(1, 1)], "k int, n long"), manifest, ["k"], work_folder(spark, "sync"))


def test_untouched_files_are_not_read_whole(spark):
    """What is written anew comes from the touched file and from target only."""
    parts = [[(i, "x" * 10) for i in range(k, 100, 2)] for k in range(2)]
    manifest = state(spark, parts, "k int, s string")
    target = spark.createDataFrame([(0, "y")], "k int, s string")
    run = dm.run_file_sync(target, manifest, ["k"], work_folder(spark, "sync"), "upsert")
    added = {r.change: r.n_rows for r in dm.file_changes(spark, manifest, run.manifest).collect()}
    assert added == {"kept": 50, "dropped": 50, "added": 50}


def test_a_copy_run_twice_has_its_rows_once(spark):
    folder = f"{work_folder(spark, 'copy')}/t"
    one, two = spark.createDataFrame([(1, "a"), (2, None)], "k int, s string"), spark.createDataFrame([(1, "a")], "k int, s string")
    assert [dm.copy_once(one, folder, "2024-01-01 10:00"), dm.copy_once(two, folder, "b/c"), dm.copy_once(two, folder, "2024-01-01 10:00")] == [2, 1, 2]
    assert rows(dm.read_copied(spark, folder)) == bag([(1, "a"), (2, None), (1, "a")])
    assert sorted((r.run, r.n_rows) for r in dm.copy_runs(spark, folder).collect()) == [("2024-01-01 10:00", 2), ("b/c", 1)]
    # A run lost before its end left rows, which are not read and are replaced by its repetition.
    one.write.parquet(f"{folder}/run=lost")
    assert dm.read_copied(spark, folder).count() == 3
    assert dm.copy_once(two, folder, "lost") == 1 and dm.read_copied(spark, folder).count() == 4

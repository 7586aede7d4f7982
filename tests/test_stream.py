import datetime
import os

import pytest

import driftmend as dm
from driftmend.sources.sinks import work_folder
from fixtures import bag

EVENTS = "id int, ts timestamp_ntz, v string"


def at(day):
    return datetime.datetime(2024, 1, day)


GIVEN = [(1, at(1), "a"), (2, at(2), "b")]
FIRST = [(2, at(2), "b"), (3, at(3), "c"), (3, at(3), "c"), (4, at(20), "d")]
SECOND = [(3, at(3), "c"), (4, at(20), "d"), (5, at(2), "late"), (6, at(21), "f"), (None, None, "blank")]


def arrive(spark, folder, rows, name):
    spark.createDataFrame(rows, EVENTS).coalesce(1).write.parquet(f"{folder}/{name}")


def run(spark, folder, out, given, **options):
    arrivals = dm.read_arrivals(spark, f"{folder}/*", given.schema, max_files=1)
    dm.stream_sync(arrivals, given, ["id"], f"{out}/rows", f"{out}/checkpoint", **options).awaitTermination()
    return bag(tuple(r) for r in dm.synced_state(given, f"{out}/rows").collect())


@pytest.fixture
def given(spark):
    return spark.createDataFrame(GIVEN, EVENTS)


def test_rows_are_added_once_over_several_runs(spark, tmp_path, given):
    out = work_folder(spark, "stream")
    arrive(spark, tmp_path, FIRST, "one")
    assert run(spark, tmp_path, out, given) == bag([*GIVEN, FIRST[1], FIRST[3]])
    arrive(spark, tmp_path, SECOND, "two")
    everything = bag([*GIVEN, FIRST[1], FIRST[3], *SECOND[2:]])
    assert run(spark, tmp_path, out, given) == everything
    assert run(spark, tmp_path, out, given) == everything


def test_a_batch_that_is_replayed_replaces_itself(spark, tmp_path, given):
    out = work_folder(spark, "stream")
    arrive(spark, tmp_path, FIRST, "one")
    first = run(spark, tmp_path, out, given)
    # A new checkpoint starts over with batch 0, as a replay of it would.
    arrivals = dm.read_arrivals(spark, f"{tmp_path}/*", given.schema)
    dm.stream_sync(arrivals, given, ["id"], f"{out}/rows", f"{out}/second-checkpoint").awaitTermination()
    assert bag(tuple(r) for r in dm.synced_state(given, f"{out}/rows").collect()) == first


def test_late_rows_are_written_and_listed(spark, tmp_path, given):
    arrive(spark, tmp_path, FIRST, "one")
    arrive(spark, tmp_path, SECOND[:4], "two")
    whole = run(spark, tmp_path, work_folder(spark, "stream"), given, progress="ts", fixed_progress=True)
    assert whole == bag([*GIVEN, FIRST[1], FIRST[3], SECOND[2], SECOND[3]])
    out = work_folder(spark, "stream")
    run(spark, tmp_path, out, given, progress="ts", delay="3 days")
    arrive(spark, tmp_path, [(7, at(1), "too late"), (8, at(22), "in time")], "three")
    late = run(spark, tmp_path, out, given, progress="ts", delay="3 days")
    assert (8, at(22), "in time") in late and (7, at(1), "too late") in late
    listed = {tuple(r) for r in dm.late_rows(given, f"{out}/rows").collect()}
    assert (7, at(1), "too late") in listed and (8, at(22), "in time") not in listed


def test_rows_that_are_not_added_are_listed(spark, tmp_path, given):
    out = work_folder(spark, "stream")
    arrive(spark, tmp_path, [(3, at(3), "c"), (3, at(3), "c"), (3, at(4), "other"), (1, at(9), "there")], "one")
    assert run(spark, tmp_path, out, given) == bag([*GIVEN, (3, at(3), "c"), (3, at(4), "other")])
    arrive(spark, tmp_path, [(3, at(5), "again"), (2, at(2), "b"), (9, at(9), "new")], "two")
    state = run(spark, tmp_path, out, given)
    assert state == bag([*GIVEN, (3, at(3), "c"), (3, at(4), "other"), (9, at(9), "new")])
    rejected = bag(tuple(r) for r in dm.rejected_rows(given, f"{out}/rows").collect())
    assert rejected == bag([(3, at(3), "c"), (3, at(5), "again")])


def test_the_name_of_the_folders_is_refused(spark, tmp_path):
    odd = spark.createDataFrame([(1, 2)], "id int, batch int")
    odd.write.parquet(f"{tmp_path}/one")
    arrivals = dm.read_arrivals(spark, f"{tmp_path}/*", odd.schema)
    with pytest.raises(ValueError, match="batch"):
        dm.stream_sync(arrivals, odd, ["id"], f"{tmp_path}/out", f"{tmp_path}/checkpoint")


def test_a_delay_needs_a_progress_column(spark, tmp_path, given):
    arrive(spark, tmp_path, FIRST, "one")
    with pytest.raises(ValueError, match="progress"):
        run(spark, tmp_path, work_folder(spark, "stream"), given, delay="1 day")


def test_the_stream_agrees_with_the_batch_sync(spark, tmp_path, given):
    arrive(spark, tmp_path, FIRST, "one")
    arrive(spark, tmp_path, SECOND, "two")
    streamed = run(spark, tmp_path, work_folder(spark, "stream"), given)
    everything = spark.read.schema(given.schema).parquet(f"{tmp_path}/*").distinct()
    assert streamed == bag(tuple(r) for r in dm.sync(everything, given, ["id"]).collect())


def test_a_delivery_of_any_size_is_written_by_many_tasks(spark, tmp_path):
    from checks.sync_queries import stream_sync_files
    from checks.tables import Tables

    days = [datetime.datetime(2024, 1, 1) + datetime.timedelta(hours=6 * i) for i in range(120)]
    rows = [(i, days[i % 120], i, "view", 1.0, "{}") for i in range(4000)]
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    for i in range(4):
        spark.createDataFrame(rows[i::4], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/events.parquet")
    base, before = f"{spark.conf.get('spark.checkpoint.dir')}/driftmend", set()
    if os.path.isdir(base):
        before = set(os.listdir(base))
    found = stream_sync_files(Tables(spark, str(tmp_path))).groupBy("part").count().collect()
    (own,) = [name for name in os.listdir(base) if name.startswith("deliveries-") and name not in before]
    for i in range(3):
        files = [name for name in os.listdir(f"{base}/{own}/files/{i}") if name.endswith(".parquet")]
        assert len(files) >= 4
    # One batch for each delivery, and every row where it belongs.
    assert {name for name in os.listdir(f"{base}/{own}/rows") if name.startswith("batch=")} == {f"batch={i}" for i in range(-1, 3)}
    late = {i for i, ts, *_ in rows if i % 3 == 1 and ts < at(5)}
    first = {i for i, ts, *_ in rows if ts < at(15)} - late
    second = {i for i, ts, *_ in rows if ts >= at(15)}
    given = {i for i, ts, *_ in rows if ts < at(20) and i % 50}
    again = {i for i in first if i % 10 == 0}, {i for i in second if i % 7 == 0}
    expected = {"state": len(rows), "rejected": sum(len(x - given) for x in again), "late": len(late - given)}
    assert {r["part"]: r["count"] for r in found} == expected

"""Adding rows to given as they arrive in files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from driftmend.functions.names import col, cols, resolve
from driftmend.functions.sides import keep_by_key
from driftmend.functions.types import comparable
from driftmend.sources.sinks import staged


def read_arrivals(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    format: str = "parquet",
    glob: str | None = None,
    max_files: int | None = None,
) -> DataFrame:
    """A stream of the rows of files arriving in a folder, ``max_files`` of them per micro-batch."""
    reader = spark.readStream.schema(schema).format(format)
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.load(path)


def stream_sync(
    arrivals: DataFrame,
    given: DataFrame,
    keys: Sequence[str],
    out: str,
    checkpoint: str,
    progress: str | None = None,
    delay: str | None = None,
    fixed_progress: bool = False,
) -> StreamingQuery:
    """Write the arriving rows whose key is neither in ``given`` nor written before, one folder per micro-batch.

    Works through what has arrived and stops; start it again, with the same ``checkpoint``, for what arrives later.
    A micro-batch that is replayed after a failure overwrites its own folders and compares with earlier
    ones only, so every key is written once. Several unlike rows of a new key in one micro-batch are all written.

    Nothing is dropped without a trace: rows of a key that an earlier micro-batch wrote, and further copies of an equal
    row, are listed by :func:`rejected_rows`. With ``delay`` the rows written although they are further behind the
    highest ``progress`` value before them are listed by :func:`late_rows`.
    ``fixed_progress`` says that a key never changes its progress value: then only rows of given from
    the batch's least value on are read for the comparison.
    """
    names = resolve(arrivals, keys, "key column")
    spark = arrivals.sparkSession
    schema = arrivals.schema
    if (delay is not None or fixed_progress) and progress is None:
        raise ValueError("delay and fixed_progress need a progress column")
    if "batch" in (c.lower() for c in schema.names):
        raise ValueError("the column name 'batch' is used for the folders of micro-batches; rename it first")
    # Reading the output has to work before the first batch is written.
    for kind in ("", "_rejected", "_late"):
        spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{out}{kind}/batch=-1")
    stored = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])

    def add(batch: DataFrame, batch_id: int) -> None:
        forms = [comparable(col(f.name), f.dataType).alias(f"_form_{i}") for i, f in enumerate(schema.fields)]
        row = F.struct(*cols(schema.names))
        counted = batch.groupBy(*forms).agg(F.any_value(row).alias("row"), F.count("*").alias("n"))
        # Written first, so that its size is known: the keys of given and of earlier batches are reduced to those of
        # a small batch without a shuffle, and each is read once.
        counted = staged(counted.select("row", "n"), "arrivals")
        alike = counted.select("row.*")

        earlier = batch.sparkSession.read.schema(stored).parquet(out).where(F.col("batch") < batch_id)
        seen = given
        if fixed_progress:
            since = alike.agg(F.min(col(progress))).scalar()
            seen = given.where((col(progress) >= since) | col(progress).isNull())
        there = seen.select(*cols(names), F.lit(True).alias("_given"))
        before = earlier.select(*cols(names), F.lit(False).alias("_given"))
        known = keep_by_key(there.unionByName(before), alike, names, "left_semi")
        known = staged(known.groupBy(*cols(names)).agg(F.bool_or("_given").alias("_given")), "arrivals")
        new = keep_by_key(alike, known, names, "left_anti")
        new.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

        copies = counted.where("n > 1").select("row.*", F.explode(F.sequence(F.lit(2).cast("bigint"), F.col("n"))).alias("_copy")).drop("_copy")
        copies = keep_by_key(copies, known.where("_given"), names, "left_anti")
        rejected = keep_by_key(alike, known.where("NOT _given"), names, "left_semi").unionByName(copies)
        rejected.write.mode("overwrite").parquet(f"{out}_rejected/batch={batch_id}")
        if delay is not None:
            mark = earlier.agg(F.max(col(progress)) - F.expr(f"INTERVAL {delay}")).scalar()
            new.where(col(progress) < mark).write.mode("overwrite").parquet(f"{out}_late/batch={batch_id}")

    return (
        arrivals.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def _stored(given: DataFrame, path: str) -> DataFrame:
    stored = T.StructType([*given.schema.fields, T.StructField("batch", T.LongType())])
    return given.sparkSession.read.schema(stored).parquet(path).drop("batch")


def synced_state(given: DataFrame, out: str) -> DataFrame:
    """Given with everything the stream has added so far."""
    return given.unionByName(_stored(given, out))


def rejected_rows(given: DataFrame, out: str) -> DataFrame:
    """Rows that arrived for a key the stream had written before, and further copies of equal rows."""
    return _stored(given, f"{out}_rejected")


def late_rows(given: DataFrame, out: str) -> DataFrame:
    """Rows the stream wrote although they came later than its ``delay``."""
    return _stored(given, f"{out}_late")

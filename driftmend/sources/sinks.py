"""Writing findings and copying tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from driftmend.functions.names import col, cols
from driftmend.sources.readers import quoted


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name below the folder all executors share.

    That is the session's ``spark.checkpoint.dir`` or the checkpoint folder set on its context; without either it is
    an error, since a folder of one machine would not be seen by the others.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{base.rstrip('/')}/driftmend/{purpose}-{uuid.uuid4().hex}"


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` and read it back: the lineage ends there, and the planner knows its true size,
    so it broadcasts the table in later joins only where that is below the broadcast threshold."""
    path = work_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unstaged(df: DataFrame) -> None:
    """Remove what :func:`staged` wrote, once nothing reads ``df`` any more."""
    spark = df.sparkSession
    for folder in {name.rpartition("/")[0] for name in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries built and run inside remove their shuffle files when they end; Spark would keep them until the driver's
    next garbage collection. Run each of them once: a second run would write the files again."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def write_findings(findings: DataFrame, path: str, format: str = "parquet") -> None:
    """Append findings with the time of writing, one directory per run."""
    stamped = findings.withColumn("found_at", F.current_timestamp())
    stamped.write.mode("append").format(format).partitionBy("run_id").save(path)


def copy_table(source: DataFrame, destination: str, format: str = "parquet", partition_by: Sequence[str] = ()) -> None:
    """Append every row of ``source`` to ``destination``.

    Rows already there must have the same columns and types, in any order and case; map the schema first if not.
    A copy that is repeated appends its rows again.
    """
    try:
        there = source.sparkSession.read.format(format).load(destination).schema
    except AnalysisException:  # nothing is there yet
        there = None
    if there is not None:
        shape = lambda schema: {f.name.lower(): f.dataType.simpleString() for f in schema.fields}
        if shape(there) != shape(source.schema):
            raise ValueError(f"{destination} has another shape: {there.simpleString()} and not {source.schema.simpleString()}")
        source = source.select(*[col(f.name) for f in there.fields])
    writer = source.write.mode("append").format(format)
    (writer.partitionBy(*partition_by) if partition_by else writer).save(destination)


def copy_once(source: DataFrame, destination: str, run_id: str) -> int:
    """Add every row of ``source`` to ``destination`` under a run's id and return their number; a repeated run adds nothing.

    Each run has a folder of its own, which it overwrites if it was lost before its end; what it wrote and when is told in
    ``destination``_runs, last. The rows are counted while they are written. Read the table with :func:`read_copied`.
    """
    spark = source.sparkSession
    told = f"{destination}_runs/run={quote(run_id, safe='')}"
    try:
        before = spark.read.schema("n_rows long, at timestamp").parquet(told).first()
    except AnalysisException:  # the run is new, or was lost
        before = None
    if before is not None:
        return before.n_rows
    if "run" in (c.lower() for c in source.columns):
        raise ValueError("the column name 'run' is used for the folders of runs; rename it first")
    rows = Observation()
    source.observe(rows, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{destination}/run={quote(run_id, safe='')}")
    done = spark.range(1).select(F.lit(rows.get["n"]).cast("long").alias("n_rows"), F.current_timestamp().alias("at"))
    done.coalesce(1).write.mode("overwrite").parquet(told)
    return rows.get["n"]


def read_copied(spark: SparkSession, destination: str) -> DataFrame:
    """All rows that finished runs of :func:`copy_once` added, whatever a lost run has left."""
    finished = [row.run for row in copy_runs(spark, destination).select("run").collect()]
    rows = spark.read.option("basePath", destination).parquet(*[f"{destination}/run={quote(run, safe='')}" for run in finished])
    return rows.drop("run")


def copy_runs(spark: SparkSession, destination: str) -> DataFrame:
    """``run``, ``n_rows`` and ``at`` of each finished run."""
    return spark.read.schema("n_rows long, at timestamp, run string").parquet(f"{destination}_runs").select("run", "n_rows", "at")


def copy_to_database(
    source: DataFrame, schema: str, table: str, connection: Mapping[str, str], tasks: int = 32
) -> None:
    """Append every row of ``source`` to a database table over JDBC, at most ``tasks`` connections at a time."""
    writer = source.write.mode("append").format("jdbc").options(**connection)
    writer.options(dbtable=f"{quoted(schema)}.{quoted(table)}", numPartitions=str(tasks), batchsize="10000").save()


def save_bucketed(df: DataFrame, table: str, keys: Sequence[str], buckets: int) -> None:
    """Save as a Spark table bucketed and sorted by key. Two tables saved alike are compared without a shuffle
    when their key is proven (``primary_key=True``)."""
    clustered = df.repartition(buckets, *cols(keys))
    clustered.write.bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)

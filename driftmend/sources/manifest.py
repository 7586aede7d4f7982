"""States kept as lists of files, so that a new state can share the files that did not change with the old one."""

from __future__ import annotations

import json
import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_FILES = "file string, n_rows long"


def register_files(spark: SparkSession, path: str, manifest: str) -> None:
    """List the Parquet files below ``path`` in a new manifest. The files stay where they are and must not be changed."""
    table = spark.read.parquet(path)
    write_manifest(listed(table), table.schema, manifest)


def read_state(spark: SparkSession, manifest: str) -> DataFrame:
    """All rows of the files of a manifest, whatever else lies in their folders."""
    schema = state_schema(spark, manifest)
    files = [row.file for row in state_files(spark, manifest).select("file").collect()]
    return read_listed(spark, schema, files)


def state_files(spark: SparkSession, manifest: str) -> DataFrame:
    """``file`` and ``n_rows`` of each file of a manifest."""
    return spark.read.schema(_FILES).parquet(f"{manifest}/files")


def state_schema(spark: SparkSession, manifest: str) -> T.StructType:
    return T.StructType.fromJson(json.loads(spark.read.schema("schema string").parquet(f"{manifest}/schema").first().schema))


def manifest_complete(spark: SparkSession, manifest: str) -> bool:
    """Whether a manifest was written to its end: the schema comes last."""
    try:
        return not spark.read.schema("schema string").parquet(f"{manifest}/schema").isEmpty()
    except AnalysisException:
        return False


def file_changes(spark: SparkSession, before: str, after: str) -> DataFrame:
    """One row per file of two manifests: ``file``, ``n_rows`` and ``change``, one of ``kept``, ``dropped`` and ``added``."""
    old = state_files(spark, before).select("file", "n_rows", F.lit(1).alias("_side"))
    new = state_files(spark, after).select("file", "n_rows", F.lit(2).alias("_side"))
    sides = old.unionByName(new).groupBy("file").agg(F.max("n_rows").alias("n_rows"), F.sum("_side").alias("_sides"))
    return sides.select("file", "n_rows", F.element_at(F.array(F.lit("dropped"), F.lit("added"), F.lit("kept")), F.col("_sides").cast("int")).alias("change"))


def listed(table: DataFrame) -> DataFrame:
    """``file`` and ``n_rows`` of each file of a table with rows."""
    return table.groupBy(file_of().alias("file")).agg(F.count(F.lit(1)).alias("n_rows"))


def file_of() -> Column:
    """The name of the file a row of a table of files comes from, as a reader takes it: Spark tells it URL-encoded."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def read_listed(spark: SparkSession, schema: T.StructType, files: list[str]) -> DataFrame:
    """The rows of these files; a name is never taken for a pattern."""
    if not files:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[re.sub(r"([*?\[\]{}\\])", r"\\\1", name) for name in files])


def write_manifest(files: DataFrame, schema: T.StructType, manifest: str) -> None:
    """The files first and the schema last, so that what a lost run leaves behind is told from a manifest.

    A few files hold the list: it is as long as the state has files, never as its rows.
    """
    spark = files.sparkSession
    files.coalesce(1).write.mode("overwrite").parquet(f"{manifest}/files")
    spark.range(1).select(F.lit(schema.json()).alias("schema")).coalesce(1).write.mode("overwrite").parquet(f"{manifest}/schema")

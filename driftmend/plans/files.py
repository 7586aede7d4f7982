"""A sync that rewrites only the files with rows it changes."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftmend.functions.names import col, cols, reserve, resolve
from driftmend.functions.sides import distinct_keys, keep_by_key
from driftmend.operators.sync import MODES, same_shape
from driftmend.operators.three_way import key_changes
from driftmend.sources.manifest import (
    file_changes,
    file_of,
    listed,
    manifest_complete,
    read_listed,
    read_state,
    state_files,
    state_schema,
    write_manifest,
)
from driftmend.sources.sinks import staged


@dataclass(frozen=True)
class FileSync:
    """The manifest of the new state, and how many files it shares with the old one, does without and adds."""

    manifest: str
    files_kept: int
    files_dropped: int
    files_added: int


def run_file_sync(target: DataFrame, manifest: str, keys: Sequence[str], out: str, mode: str = "insert_missing") -> FileSync:
    """Bring the state of ``manifest`` (given) up to ``target`` and write ``out/manifest`` and the files it needs anew.

    The result reads (``read_state``) as :func:`~driftmend.operators.sync.sync` would give it. First the keys to change are
    found: by key columns alone for ``insert_missing``, else by digests too (128 bits and the number of rows of a key). Then
    the files that hold rows of such keys; only these are read whole and written again without those rows, next to target's
    rows of the keys. All other files are carried over by name. Rows of a key may lie in several files, and a key may have several rows.

    The old manifest and its files stay as they are, for whoever still reads them. The new manifest is written last: a run
    that is lost leaves none and is simply run again, and running it again after that does nothing.
    """
    if mode not in MODES:
        raise ValueError(f"mode is one of {MODES}, not {mode!r}")
    spark = target.sparkSession
    new = f"{out}/manifest"
    if not manifest_complete(spark, new):
        _write(target, manifest, keys, out, mode)
    counts = {r.change: r.n for r in file_changes(spark, manifest, new).groupBy("change").agg(F.count(F.lit(1)).alias("n")).collect()}
    return FileSync(new, *(counts.get(change, 0) for change in ("kept", "dropped", "added")))


def _write(target: DataFrame, manifest: str, keys: Sequence[str], out: str, mode: str) -> None:
    spark = target.sparkSession
    schema = state_schema(spark, manifest)
    given = read_state(spark, manifest)
    sides = same_shape(target, given, keys)
    reserve(given.columns, "_file", "_op")
    spelt = dict(zip(sides.keys + sides.values, resolve(given, sides.keys + sides.values), strict=True))
    for ours, theirs in spelt.items():
        if sides.types[ours] != given.schema[theirs].dataType:
            wide, narrow = sides.types[ours].simpleString(), given.schema[theirs].dataType.simpleString()
            raise ValueError(f"column {theirs} of the state is {narrow} and cannot hold {wide}; map the schema first")

    changes = staged(key_changes(sides.target, sides.given, sides.keys, mode), "changes")
    gone = changes.where("_op <> 'insert'")
    files = [row.file for row in state_files(spark, manifest).select("file").collect()]
    own_keys = [spelt[k] for k in sides.keys]
    # A file is touched if it holds a row of a key to change: key columns and file names are all that is read.
    named = read_listed(spark, schema, files)
    if files:
        named = named.select(*cols(own_keys), file_of().alias("_file"))
        renamed = gone.select(*[col(k).alias(o) for k, o in zip(sides.keys, own_keys, strict=True)])
        touched = keep_by_key(named, renamed, own_keys, "left_semi").select(F.col("_file").alias("file")).distinct()
        touched = staged(touched, "touched-files")
    else:
        touched = state_files(spark, manifest).select("file")

    # As many names as files, which the driver lists for any read.
    rewritten = read_listed(spark, schema, [row.file for row in touched.collect()])
    left, same = distinct_keys(gone.select(*[col(k).alias(spelt[k]) for k in sides.keys]), own_keys)
    rest = rewritten.join(left, on=same, how="left_anti")
    come = keep_by_key(sides.target, changes.where("_op <> 'delete'"), sides.keys, "left_semi")
    back = {theirs: ours for ours, theirs in spelt.items()}
    come = come.select(*[col(back[f.name]).alias(f.name) for f in schema.fields])
    # Few rows of many files are put together to files of a task's size.
    rest.unionByName(come).hint("rebalance").write.mode("overwrite").parquet(f"{out}/data")
    added = listed(spark.read.schema(schema).parquet(f"{out}/data"))
    kept = state_files(spark, manifest).join(touched, on="file", how="left_anti")
    write_manifest(kept.unionByName(added), schema, f"{out}/manifest")


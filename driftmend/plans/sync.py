"""A sync carried out: the new state and its change log written next to each other."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftmend.functions.frames import stacked
from driftmend.functions.names import cols
from driftmend.functions.sides import Sides, keep_by_key
from driftmend.operators.buckets import digest_diff
from driftmend.operators.keys import key_presence
from driftmend.operators.rows import pair_sides, paired_changes, rows_differ, surplus_rows
from driftmend.operators.sync import MODES, same_shape
from driftmend.sources.sinks import staged

# The operations each mode carries out.
OPERATIONS = {"insert_missing": ("insert",), "upsert": ("insert", "update"), "mirror": ("insert", "update", "delete")}


@dataclass(frozen=True)
class SyncRun:
    """Where a sync left its results, and whether the key proved to be a primary key on both sides."""

    state: str
    changes: str
    primary_key: bool


def run_sync(target: DataFrame, given: DataFrame, keys: Sequence[str], out: str, mode: str = "insert_missing") -> SyncRun:
    """Write the new state of given to ``out/state`` and the change log to ``out/changes``.

    ``out`` must be new: nothing is written over a table that is being read. The keys that are not
    simply on both sides once are found first, from key columns alone, and written to the shared work
    folder. They are few where the sides are nearly in sync, and their size is then known, so the
    planner picks the rows to add by a broadcast when they are few and by a shuffle when not; the
    tables themselves are not shuffled for it otherwise. Updates, where the mode has them, are found by
    digests of rows (128 bits), and only rows whose digests differ are compared in full.
    """
    if mode not in MODES:
        raise ValueError(f"mode is one of {MODES}, not {mode!r}")
    sides = same_shape(target, given, keys)
    null_key = reduce(Column.__or__, [c.isNull() for c in cols(sides.keys)])
    paired = (F.col("n_target") == 1) & (F.col("n_given") == 1) & ~null_key
    irregular = staged(key_presence(sides.target, sides.given, sides.keys).where(~paired), "keys")
    proven = irregular.where((F.greatest("n_target", "n_given") > 1) | null_key).isEmpty()

    if mode == "insert_missing":
        state = sides.given.unionByName(_of_keys(sides.target, irregular, "n_given", sides.keys, proven))
    elif mode == "upsert":
        state = sides.target.unionByName(_of_keys(sides.given, irregular, "n_target", sides.keys, proven))
    else:
        state = sides.target
    state.write.mode("errorifexists").parquet(f"{out}/state")
    _changes(sides, irregular, proven, OPERATIONS[mode]).write.mode("errorifexists").parquet(f"{out}/changes")
    return SyncRun(f"{out}/state", f"{out}/changes", proven)


def _changes(sides: Sides, irregular: DataFrame, proven: bool, ops: Sequence[str]) -> DataFrame:
    """The log of :func:`~driftmend.operators.rows.change_log`, from the keys that are not once on both sides."""
    packed = F.struct(*cols(sides.values)) if sides.values else F.struct(F.lit(True).alias("present"))
    kind = sides.target.select(packed.alias("row")).schema["row"].dataType
    parts = []
    for op, rows, absent in (("insert", sides.target, "n_given"), ("delete", sides.given, "n_target")):
        if op in ops:
            row, nothing = packed, F.lit(None).cast(kind)
            before, after = (nothing, row) if op == "insert" else (row, nothing)
            found = _of_keys(rows, irregular, absent, sides.keys, proven)
            parts.append(found.select(*cols(sides.keys), F.lit(op).alias("op"), before.alias("before"), after.alias("after")))
    if "update" in ops:
        digests = digest_diff(sides.target, sides.given, sides.keys).where("status = 'changed'").select(*cols(sides.keys))
        changed = staged(digests, "changed")
        near = replace(sides, **{s: keep_by_key(getattr(sides, s), changed, sides.keys, "left_semi", proven) for s in ("target", "given")})
        pairs = pair_sides(near, proven)
        parts.append(paired_changes(near, pairs.where(rows_differ(near))))
        if not proven:
            repeated = irregular.where((F.greatest("n_target", "n_given") > 1) & (F.least("n_target", "n_given") > 0))
            parts.append(surplus_rows(sides, repeated, ops))
    return stacked(parts)


def _of_keys(rows: DataFrame, irregular: DataFrame, absent_from: str, keys: Sequence[str], proven: bool) -> DataFrame:
    """The rows whose key the other side has not at all."""
    return keep_by_key(rows, irregular.where(F.col(absent_from) == 0), keys, "left_semi", primary_key=proven)

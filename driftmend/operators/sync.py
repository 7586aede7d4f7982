"""The state of given after a sync from target. Only candidates are staged here; see ``driftmend.plans.sync``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftmend.functions.names import col, cols, resolve
from driftmend.functions.sides import Sides, align, keep_by_key
from driftmend.functions.types import family
from driftmend.sources.sinks import staged

# What a sync may do to the rows of given, from the least to the most.
MODES = ("insert_missing", "upsert", "mirror")


def same_shape(target: DataFrame, given: DataFrame, keys: Sequence[str]) -> Sides:
    """Both sides with the same columns, or an error: a sync must not drop or blank a column by itself."""
    ours, theirs = {c.lower() for c in target.columns}, {c.lower() for c in given.columns}
    if ours != theirs:
        raise ValueError(
            f"columns only in target {sorted(ours - theirs)}, only in given {sorted(theirs - ours)}; map the schema first"
        )
    for name in target.columns:
        ours_type = target.schema[name].dataType
        theirs_type = given.schema[resolve(given, [name])[0]].dataType
        if family(ours_type) != family(theirs_type):
            raise ValueError(
                f"column {name} is {ours_type.simpleString()} in target and {theirs_type.simpleString()} in given; "
                "map the schema first"
            )
    return align(target, given, keys)


def rows_to_insert(target: DataFrame, given: DataFrame, keys: Sequence[str], primary_key: bool = False) -> DataFrame:
    """Rows of target whose key given does not have. Only given's key columns are read."""
    sides = same_shape(target, given, keys)
    return keep_by_key(sides.target, sides.given, sides.keys, "left_anti", primary_key)


def rows_to_delete(target: DataFrame, given: DataFrame, keys: Sequence[str], primary_key: bool = False) -> DataFrame:
    """Rows of given whose key target does not have: what a mirror removes."""
    sides = same_shape(target, given, keys)
    return keep_by_key(sides.given, sides.target, sides.keys, "left_anti", primary_key)


def sync(
    target: DataFrame, given: DataFrame, keys: Sequence[str], mode: str = "insert_missing", primary_key: bool = False
) -> DataFrame:
    """The new state of given.

    ``insert_missing`` adds target's rows whose key is missing and leaves every other row alone;
    ``upsert`` also replaces the rows of shared keys by target's; ``mirror`` is target itself.
    Repeated keys are kept as often as the side they come from has them.
    """
    sides = same_shape(target, given, keys)
    if mode == "insert_missing":
        return sides.given.unionByName(keep_by_key(sides.target, sides.given, sides.keys, "left_anti", primary_key))
    if mode == "upsert":
        return keep_by_key(sides.given, sides.target, sides.keys, "left_anti", primary_key).unionByName(sides.target)
    if mode == "mirror":
        return sides.target
    raise ValueError(f"mode is one of {MODES}, not {mode!r}")


def _since(given: DataFrame, name: str, dtype, lookback) -> Column | None:
    """The mark to sync from as a scalar subquery, or None if given has no value of ``name``.

    Whether there is one is looked up at once: without a mark everything counts as new and nothing is filtered.
    """
    if given.where(col(name).isNotNull()).isEmpty():
        return None
    mark = F.max(col(name)).cast(dtype)
    if lookback is not None:
        mark = (mark - F.lit(lookback)).cast(dtype)
    return given.agg(mark).scalar()


def sync_candidates(target: DataFrame, given: DataFrame, progress: str, lookback=None) -> DataFrame:
    """Rows of target at or after given's highest ``progress`` value less ``lookback``; all of them if given has none.

    The mark is a scalar subquery, so the filter reaches target's scan. At or after, as rows may tie
    with the mark; the key comparison drops those already there. Rows of target without a progress
    value count as new only while there is no mark.
    """
    ours, theirs = resolve(target, [progress])[0], resolve(given, [progress])[0]
    since = _since(given, theirs, target.schema[ours].dataType, lookback)
    return target if since is None else target.where(col(ours) >= since)


def incremental_sync(
    target: DataFrame,
    given: DataFrame,
    keys: Sequence[str],
    progress: str,
    lookback=None,
    mode: str = "insert_missing",
    fixed_progress: bool = False,
    primary_key: bool = False,
) -> DataFrame:
    """The new state of given after syncing only :func:`sync_candidates`.

    Rows that reach target later than ``lookback`` after the mark had passed them are not found, by
    design: a full check finds them. The candidates are written to the shared work folder first, so that
    their size is known: few are broadcast and given is not shuffled for them. ``fixed_progress`` says
    that a key never changes its progress value; then only given's rows from the mark on can match, and
    older ones are passed on without any comparison.
    """
    if mode not in ("insert_missing", "upsert"):
        raise ValueError(f"mode is insert_missing or upsert, not {mode!r}")
    sides = same_shape(target, given, keys)
    name = resolve(sides.target, [progress])[0]
    since = _since(sides.given, name, sides.target.schema[name].dataType, lookback)
    if since is None:
        return sync(sides.target, sides.given, sides.keys, mode, primary_key)
    recent = staged(sides.target.where(col(name) >= since), "recent")
    if not fixed_progress:
        if mode == "upsert":
            return sync(recent, sides.given, sides.keys, "upsert", primary_key)
        return sides.given.unionByName(_unseen(recent, sides.given, sides.keys, primary_key))
    newer = sides.given.where(col(name) >= since)
    if mode == "upsert":
        older = sides.given.where((col(name) < since) | col(name).isNull())
        return older.unionByName(sync(recent, newer, sides.keys, "upsert", primary_key))
    return sides.given.unionByName(keep_by_key(recent, newer, sides.keys, "left_anti", primary_key))


def _unseen(recent: DataFrame, given: DataFrame, keys: Sequence[str], primary_key: bool) -> DataFrame:
    """Rows of ``recent`` whose key given does not have. Given's keys are reduced to those of ``recent`` first."""
    seen = keep_by_key(given.select(*cols(keys)), recent, keys, "left_semi", primary_key)
    return keep_by_key(recent, seen, keys, "left_anti", primary_key)

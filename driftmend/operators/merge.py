"""Two-way merge: the union of both sides' keys, with rows on both sides settled by a policy."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftmend.functions.names import col, cols, resolve
from driftmend.functions.sides import Sides, keep_by_key
from driftmend.functions.types import comparable, has_map
from driftmend.operators.rows import pair_sides
from driftmend.operators.sync import same_shape

# How a key on both sides is settled.
POLICIES = ("target_wins", "given_wins", "latest", "fill_nulls")


def merge_bidirectional(
    target: DataFrame,
    given: DataFrame,
    keys: Sequence[str],
    policy: str = "target_wins",
    version: str | None = None,
    primary_key: bool = False,
) -> DataFrame:
    """The state both sides are to have. Never deletes: without a common base a deletion looks like an insertion.

    ``latest`` takes the side with the greater ``version``: on a tie, or with neither known, target's;
    with one known, that one's. ``fill_nulls`` takes target's row with its NULLs filled from given.
    Where a key has several rows, all rows of the winning side stay; ``fill_nulls`` then fills each NULL from
    the least value other than NULL that given has in that column for the key.
    """
    sides = same_shape(target, given, keys)
    if policy not in POLICIES:
        raise ValueError(f"policy is one of {POLICIES}, not {policy!r}")
    if policy == "latest":
        if version is None:
            raise ValueError("the policy latest needs a version column")
        version = resolve(sides.target, [version])[0]
    if primary_key:
        return _merge_pairs(sides, policy, version)
    if policy == "target_wins":
        return sides.target.unionByName(keep_by_key(sides.given, sides.target, sides.keys, "left_anti"))
    if policy == "given_wins":
        return sides.given.unionByName(keep_by_key(sides.target, sides.given, sides.keys, "left_anti"))
    if policy == "latest":
        return _latest(sides, version)
    return _fill_nulls(sides)


def _merge_pairs(sides: Sides, policy: str, version: str | None) -> DataFrame:
    """Every policy on a proven key: one full outer join."""
    here, there = F.col("n_target") > 0, F.col("n_given") > 0
    ours, theirs = F.col("target_row"), F.col("given_row")
    if policy == "fill_nulls":
        settled = [F.coalesce(ours.getField(v), theirs.getField(v)).alias(v) for v in sides.values]
    else:
        if policy == "target_wins":
            target_side = here
        elif policy == "given_wins":
            target_side = ~there
        else:
            mine, other = (
                (col(version), col(version)) if version in sides.keys else (ours.getField(version), theirs.getField(version))
            )
            target_side = here & (~there | other.isNull() | F.coalesce(mine >= other, F.lit(False)))
        settled = [F.when(target_side, ours.getField(v)).otherwise(theirs.getField(v)).alias(v) for v in sides.values]
    return pair_sides(sides, primary_key=True).select(*cols(sides.keys), *settled)


def _latest(sides: Sides, version: str) -> DataFrame:
    """Settle each key on its versions alone, then keep or drop whole rows by the settled keys."""
    narrow = list(dict.fromkeys([*sides.keys, version]))
    both = sides.target.select(*cols(narrow), F.lit(True).alias("_ours")).unionByName(
        sides.given.select(*cols(narrow), F.lit(False).alias("_ours"))
    )
    ours = F.col("_ours")
    settled = both.groupBy(*cols(sides.keys)).agg(
        F.count_if(ours).alias("_n_target"),
        F.count_if(~ours).alias("_n_given"),
        F.max(F.when(ours, col(version))).alias("_target_version"),
        F.max(F.when(~ours, col(version))).alias("_given_version"),
    )
    newer = F.col("_given_version").isNotNull() & (
        F.col("_target_version").isNull() | (F.col("_given_version") > F.col("_target_version"))
    )
    given_wins = settled.where((F.col("_n_given") > 0) & ((F.col("_n_target") == 0) | newer)).select(*cols(sides.keys))
    return keep_by_key(sides.target, given_wins, sides.keys, "left_anti").unionByName(
        keep_by_key(sides.given, given_wins, sides.keys, "left_semi")
    )


def _least(sides: Sides, name: str) -> Column:
    """The least value that is not NULL."""
    dtype = sides.types[name]
    return F.min_by(col(name), F.when(col(name).isNotNull(), comparable(col(name), dtype))) if has_map(dtype) else F.min(col(name))


def _fill_nulls(sides: Sides) -> DataFrame:
    return filled_from(sides).unionByName(keep_by_key(sides.given, sides.target, sides.keys, "left_anti"))


def filled_from(sides: Sides) -> DataFrame:
    """Target's rows, with every NULL filled that given has a value for, each column from the least of its key.

    Target's rows of a key may lack different columns, and no row of given need have them all. Only rows with
    a NULL to fill are joined; complete rows pass through unshuffled.
    """
    fillable = [v for v in sides.values if sides.target.schema[v].nullable]
    if not fillable:
        return sides.target
    gap = F.lit(False)
    for v in fillable:
        gap = gap | col(v).isNull()
    complete, gaps = sides.target.where(~gap), sides.target.where(gap)
    wanted = keep_by_key(sides.given, gaps, sides.keys, "left_semi")
    theirs = wanted.groupBy(*[col(k).alias(f"_key_{i}") for i, k in enumerate(sides.keys)]).agg(
        *[_least(sides, v).alias(f"_fill_{i}") for i, v in enumerate(fillable)]
    )
    same = [col(k).eqNullSafe(F.col(f"_key_{i}")) for i, k in enumerate(sides.keys)]
    at = {v: i for i, v in enumerate(fillable)}
    filled = gaps.join(theirs, on=reduce(Column.__and__, same), how="left").select(
        *cols(sides.keys),
        *[F.coalesce(col(v), F.col(f"_fill_{at[v]}")).alias(v) if v in at else col(v) for v in sides.values],
    )
    return complete.select(*cols(filled.columns)).unionByName(filled)


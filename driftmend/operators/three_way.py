"""Three-way merge: with a common base kept from the last agreement, a deletion is told from an insertion."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftmend.functions.digest import row_digest
from driftmend.functions.names import col, cols, reserve, resolve
from driftmend.functions.sides import Sides, keep_by_key
from driftmend.operators.keys import key_presence
from driftmend.operators.merge import POLICIES, filled_from
from driftmend.operators.rows import conflicts
from driftmend.operators.sync import same_shape
from driftmend.sources.sinks import staged

# What happened to a key since the base.
THREE_WAY_STATUSES = (
    "same",
    "target_inserted",
    "target_changed",
    "target_deleted",
    "given_inserted",
    "given_changed",
    "given_deleted",
    "conflict",
    "conflict_target_deleted",
    "conflict_given_deleted",
)
_FACTS = ("n_rows", "digest_1", "digest_2")


def keep_base(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What a later three-way merge needs of an agreed state: per key its rows' number and two sums of their digests.

    Write it where it can be read when the sides are merged next; the rows themselves need not be kept. ``shape`` names
    the columns and types it was made of, which must be those of the sides then.
    """
    keys = resolve(df, keys, "key column")
    reserve(keys, *_FACTS, "shape")
    taken = {k.lower() for k in keys}
    values = [c for c in df.columns if c.lower() not in taken]
    summed = _digested(df, values).groupBy(*cols(keys)).agg(*[F.sum(c).alias(c) for c in _FACTS])
    return summed.withColumn("shape", F.lit(_shape({c: df.schema[c].dataType.simpleString() for c in [*keys, *values]})))


def three_way_status(target: DataFrame, given: DataFrame, base: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """One row per key of either side or ``base`` (a :func:`keep_base`, or None) with its status, of ``THREE_WAY_STATUSES``.

    A key is as many rows as it has: it changed if their number or any of them did, and both sides are the ``same`` where
    they have the same rows now, whatever the base. All three go through one aggregation of keys and
    digests; equal digests (128 bits and the number of rows) are taken for equal rows.
    """
    sides = same_shape(target, given, keys)
    return _compared(sides, base).select(*cols(sides.keys), _status())


def merge_three_way(
    target: DataFrame,
    given: DataFrame,
    base: DataFrame | None,
    keys: Sequence[str],
    policy: str = "target_wins",
    version: str | None = None,
) -> DataFrame:
    """The state both sides are to have, given what they had in common.

    What only one side inserted, changed or deleted since the base is taken over. A key that both sides left unlike the base
    and unlike each other is a conflict, settled by the ``policy`` of
    :func:`~driftmend.operators.merge.merge_bidirectional`; against a deletion ``target_wins`` and ``given_wins`` take
    their side, be it the deletion, while ``latest`` and ``fill_nulls`` keep the rows, as a deletion has no version and no values.
    ``fill_nulls`` also fills rows that both sides inserted alike from each other, where a key has several.
    Without a base every key counts as inserted, so nothing is deleted and the result is that of the two-way merge.

    The keys that are not simply target's are written to the shared work folder first: few where the sides are nearly
    alike, and then neither table is shuffled for them.
    """
    if policy not in POLICIES:
        raise ValueError(f"policy is one of {POLICIES}, not {policy!r}")
    sides = same_shape(target, given, keys)
    if policy == "latest":
        if version is None:
            raise ValueError("the policy latest needs a version column")
        version = resolve(sides.target, [version])[0]
    status = F.col("status")
    by_policy = {
        "target_wins": F.lit("target"),
        "given_wins": F.lit("given"),
        "latest": F.when(status == "conflict_target_deleted", "given")
        .when((status == "conflict") & _given_is_newer(), "given")
        .otherwise("target"),
        "fill_nulls": F.when(status == "conflict_target_deleted", "given")
        .when((status == "conflict") | ((status == "same") & (F.col("_b_n_rows") == 0) & (F.col("_t_n_rows") > 1)), "filled")
        .otherwise("target"),
    }[policy]
    take = F.when(status.startswith("given_"), "given").when(status.startswith("target_"), "target").otherwise(by_policy)
    take = F.when((status == "same") & (take != "filled"), "target").otherwise(take)
    compared = _compared(sides, base, version if policy == "latest" else None).withColumn("status", _status())
    others = staged(compared.select(*cols(sides.keys), take.alias("_take")).where("_take <> 'target'"), "taken")
    state = keep_by_key(sides.target, others, sides.keys, "left_anti").unionByName(
        keep_by_key(sides.given, others.where("_take = 'given'"), sides.keys, "left_semi")
    )
    if policy != "fill_nulls":
        return state
    both = others.where("_take = 'filled'")
    near = replace(sides, **{s: keep_by_key(getattr(sides, s), both, sides.keys, "left_semi") for s in ("target", "given")})
    return state.unionByName(filled_from(near))


def key_changes(target: DataFrame, given: DataFrame, keys: Sequence[str], mode: str) -> DataFrame:
    """The keys whose rows a sync of this ``mode`` changes in given, with ``_op``: insert, update or delete.

    By key columns alone for ``insert_missing``, else by digests too. A key with several rows is changed as a whole.
    """
    if mode == "insert_missing":
        found = key_presence(target, given, keys).where((F.col("n_target") > 0) & (F.col("n_given") == 0))
        return found.drop("n_target", "n_given").withColumn("_op", F.lit("insert"))
    status = F.col("status")
    # Without a base a key is inserted where it is, and a conflict where both have it with unlike rows.
    op = F.when(status == "target_inserted", "insert").when(status == "conflict", "update")
    if mode == "mirror":
        op = op.when(status == "given_inserted", "delete")
    found = three_way_status(target, given, None, keys)
    return found.withColumn("_op", op).where(F.col("_op").isNotNull()).drop("status")


def true_conflicts(target: DataFrame, given: DataFrame, base: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """The differing cells, as :func:`~driftmend.operators.rows.conflicts` has them, of keys that both sides changed.

    A key that one side changed and the other deleted is one row without a ``column``, its values being ``changed`` and ``deleted``.
    """
    sides = same_shape(target, given, keys)
    found = _compared(sides, base).select(*cols(sides.keys), _status()).where(F.col("status").startswith("conflict"))
    found = staged(found, "conflicts")
    both = found.where("status = 'conflict'")
    near = [keep_by_key(side, both, sides.keys, "left_semi") for side in (sides.target, sides.given)]
    gone = F.when(F.col("status") == "conflict_target_deleted", "deleted").otherwise("changed")
    kept = F.when(F.col("status") == "conflict_target_deleted", "changed").otherwise("deleted")
    deleted = found.where("status <> 'conflict'").select(
        *cols(sides.keys), F.lit(None).cast("string").alias("column"), gone.alias("target_value"), kept.alias("given_value")
    )
    return conflicts(*near, sides.keys).unionByName(deleted) if sides.values else deleted


def _shape(types: dict[str, str]) -> str:
    return ", ".join(f"{name.lower()} {kind}" for name, kind in sorted(types.items(), key=lambda x: x[0].lower()))


def _digested(df: DataFrame, values: Sequence[str]) -> DataFrame:
    """The columns of ``df`` and, for each row, the facts that are added up per key. The order of ``values`` is their names'."""
    ordered = sorted(values, key=str.lower)
    digests = [row_digest(df, ordered, seed).cast("decimal(38,0)").alias(f"digest_{seed}") for seed in (1, 2)]
    return df.select("*", F.lit(1).cast("bigint").alias("n_rows"), *digests)


def _compared(sides: Sides, base: DataFrame | None, version: str | None = None) -> DataFrame:
    """Per key the facts of target (``_t_``), given (``_g_``) and base (``_b_``), and with ``version`` both sides' highest."""
    reserve(sides.keys, *_FACTS, "status")
    kept = [*cols(sides.keys), *map(F.col, _FACTS)]
    parts = []
    for side, df in (("t", sides.target), ("g", sides.given)):
        marks = [F.lit(side).alias("_side")] + ([col(version).alias("_version")] if version else [])
        parts.append(_digested(df, sides.values).select(*kept, *marks))
    if base is not None:
        shape = _shape({name: kind.simpleString() for name, kind in sides.types.items()})
        first = base.select("shape").first()
        if first is not None and first.shape != shape:
            raise ValueError(f"the base was kept of the columns {first.shape}; the sides have {shape}")
        theirs = resolve(base, sides.keys, "key column")
        marks = [F.lit("b").alias("_side")]
        marks += [F.lit(None).cast(sides.types[version]).alias("_version")] if version else []
        parts.append(base.select(*[col(b).alias(k) for b, k in zip(theirs, sides.keys, strict=True)], *map(F.col, _FACTS), *marks))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    facts = [
        F.coalesce(F.sum(F.when(F.col("_side") == side, F.col(c))), F.lit(0)).alias(f"_{side}_{c}")
        for side in ("t", "g", "b")
        for c in _FACTS
    ]
    versions = [F.max(F.when(F.col("_side") == side, F.col("_version"))).alias(f"_{side}_version") for side in ("t", "g")] if version else []
    return rows.groupBy(*cols(sides.keys)).agg(*facts, *versions)


def _alike(one: str, other: str) -> Column:
    equal = [F.col(f"_{one}_{c}") == F.col(f"_{other}_{c}") for c in _FACTS]
    return equal[0] & equal[1] & equal[2]


def _status() -> Column:
    def one_side(side: str, name: str) -> Column:
        n, before = F.col(f"_{side}_n_rows"), F.col("_b_n_rows")
        return F.when(n == 0, f"{name}_deleted").when(before == 0, f"{name}_inserted").otherwise(f"{name}_changed")

    return (
        F.when(_alike("t", "g"), "same")
        .when(_alike("g", "b"), one_side("t", "target"))
        .when(_alike("t", "b"), one_side("g", "given"))
        .when(F.col("_t_n_rows") == 0, "conflict_target_deleted")
        .when(F.col("_g_n_rows") == 0, "conflict_given_deleted")
        .otherwise("conflict")
        .alias("status")
    )


def _given_is_newer() -> Column:
    ours, theirs = F.col("_t_version"), F.col("_g_version")
    return theirs.isNotNull() & (ours.isNull() | (theirs > ours))

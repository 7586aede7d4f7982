"""Column names: quoting and case-insensitive lookup."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quote(name: str) -> str:
    """Backtick-quoted identifier, safe for names holding dots or backticks."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    return F.col(quote(name))


def cols(names: Iterable[str]) -> list[Column]:
    return [col(n) for n in names]


def resolve(df: DataFrame, names: Sequence[str], what: str = "column") -> list[str]:
    """The spelling ``df`` uses for each of ``names``: exact match first, then ignoring case."""
    found, absent = [], []
    for name in names:
        same = [c for c in df.columns if c.lower() == name.lower()]
        if len(same) > 1 and name not in same:
            raise ValueError(f"{what} {name!r} is ambiguous: {same}")
        if not same:
            absent.append(name)
        else:
            found.append(name if name in same else same[0])
    if absent:
        raise ValueError(f"{what}s {absent} not found; the table has {df.columns}")
    return found


def reserve(taken: Iterable[str], *outputs: str) -> None:
    """Refuse key or value columns that would clash with an operator's own output columns."""
    lowered = {o.lower() for o in outputs}
    clash = sorted(t for t in taken if t.lower() in lowered)
    if clash:
        raise ValueError(f"columns {clash} clash with output columns {list(outputs)}; rename them first")

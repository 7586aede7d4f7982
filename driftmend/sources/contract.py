"""Namespaces of tables, and the constraints declared for them.

Parquet keeps no keys, references or NOT NULL flags, so these are declared as contracts
(or read from a database's ``information_schema``) and verified on the data.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Reference:
    """A foreign key: ``columns`` point at ``ref_columns`` of ``table``, pairwise, in ``schema`` (None: the same)."""

    columns: tuple[str, ...]
    table: str
    ref_columns: tuple[str, ...]
    schema: str | None = None

    def __post_init__(self) -> None:
        object.__setattr__(self, "columns", _names(self.columns))
        object.__setattr__(self, "ref_columns", _names(self.ref_columns))
        if len(self.columns) != len(self.ref_columns) or not self.columns:
            raise ValueError(f"reference {self.columns} -> {self.table}{self.ref_columns} does not pair up")


@dataclass(frozen=True)
class TableContract:
    """What is declared about one table. Key columns count as required."""

    name: str
    keys: tuple[str, ...] = ()
    references: tuple[Reference, ...] = ()
    required: tuple[str, ...] = ()
    defaults: Mapping[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        object.__setattr__(self, "keys", _names(self.keys))
        object.__setattr__(self, "required", _names(self.required))
        object.__setattr__(self, "references", tuple(self.references))


@dataclass(frozen=True)
class Namespace:
    """A schema: its tables as DataFrames, their contracts, and tables that could not be loaded."""

    schema: str
    tables: Mapping[str, DataFrame]
    contracts: tuple[TableContract, ...] = ()
    errors: Mapping[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        object.__setattr__(self, "contracts", tuple(self.contracts))

    def names(self) -> list[str]:
        return sorted(self.tables)

    def find(self, name: str) -> str | None:
        """The spelling of a table name here: the same if there is one, else ignoring case the last in order."""
        if name in self.tables:
            return name
        same = [n for n in self.names() if n.lower() == name.lower()]
        return same[-1] if same else None

    def contract(self, name: str) -> TableContract:
        for contract in self.contracts:
            if contract.name.lower() == name.lower():
                return contract
        return TableContract(name)


def _names(value: str | Iterable[str]) -> tuple[str, ...]:
    return (value,) if isinstance(value, str) else tuple(value)

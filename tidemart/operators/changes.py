"""Validity of changes and typed slices of the change log."""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.constants import BOOTSTRAP_INSERT, DATABASE, DELETE, INSERT, UPDATE
from tidemart.functions.numbers import increase, to_int


# The change log, or a function that reads one table's part of it.
Changes = DataFrame | Callable[[str], DataFrame]


def of_table(changes: Changes, table: str, database: str = DATABASE) -> DataFrame:
    """One table's changes."""
    rows = changes if isinstance(changes, DataFrame) else changes(table)
    return rows.where((F.col("database") == database) & (F.col("table") == table))


def _usable(database: str, types: tuple[str, ...]) -> Column:
    return (F.col("database") == database) & F.col("type").isin(*types) & (F.size("data") > 0)


def dimension_changes(changes: DataFrame, database: str = DATABASE) -> DataFrame:
    """Changes a dimension can take; rows of an initial load count as inserts."""
    kinds = (INSERT, UPDATE, DELETE, BOOTSTRAP_INSERT)
    plain = F.when(F.col("type") == BOOTSTRAP_INSERT, INSERT).otherwise(F.col("type"))
    return changes.where(_usable(database, kinds)).withColumn("type", plain)


def fact_changes(changes: DataFrame, database: str = DATABASE) -> DataFrame:
    """Changes a routed fact can take."""
    return changes.where(_usable(database, (INSERT, UPDATE)))


def rejected_changes(changes: DataFrame, database: str = DATABASE) -> DataFrame:
    """Parsed changes that no dimension takes."""
    kinds = (INSERT, UPDATE, DELETE, BOOTSTRAP_INSERT)
    return changes.where(~F.coalesce(_usable(database, kinds), F.lit(False)))


def became(key: str, new: str, old: str | None = None) -> Column:
    """The change moved ``key`` to ``new``, from ``old`` or from anything."""
    before = F.col("old")[key]
    left = before.isNotNull() if old is None else before == old
    return left & (F.col("data")[key] == new)


def added(key: str) -> Column:
    """The change is an insert, or an update that raised the number ``key``."""
    raised = F.col("old")[key].isNotNull() & (to_int(F.col("data")[key]) > to_int(F.col("old")[key]))
    return (F.col("type") == INSERT) | ((F.col("type") == UPDATE) & raised)


def added_amount(key: str) -> Column:
    """How much an :func:`added` change added."""
    return F.when(F.col("type") == INSERT, to_int(F.col("data")[key])).otherwise(
        increase(F.col("data")[key], F.col("old")[key])
    )


@dataclass(frozen=True)
class Slice:
    """One table's changes of some kinds, with the keys a fact reads from them.

    Columns come out as ``<name>_<key>`` plus ``<name>_ts`` and ``<name>_et``,
    so several slices of one log join without ambiguous names. Keys leave the
    maps here: the maps themselves never reach a shuffle.
    """

    name: str
    table: str
    types: tuple[str, ...]
    keys: tuple[str, ...]
    moved: tuple[str, str, str | None] | None = None

    def read(self, changes: Changes, database: str = DATABASE, where: Column | None = None) -> DataFrame:
        kept = of_table(changes, self.table, database).where(F.col("type").isin(*self.types))
        if self.moved:
            key, new, old = self.moved
            kept = kept.where(became(key, new, old))
        if where is not None:
            kept = kept.where(where)
        return kept.select(
            *[F.col("data")[key].alias(f"{self.name}_{key}") for key in self.keys],
            F.col("ts").alias(f"{self.name}_ts"),
            F.col("et").alias(f"{self.name}_et"),
        )

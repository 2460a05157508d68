"""Routes kept as a table.

The config stream merges each micro-batch into the table; a router reads the table, however long the history of changes is. A
row is known by its sink type and source; its newest version by (ts_ms, seq) counts. The snapshot goes in as of the log position noted
*before* it was read: older changes are in it, and those made while it was read come from the log as well and win, with
the same content. So no change is missed and none counts twice.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.operators.merge import newest_rows
from tidemart.schemas import CONFIG_COLUMNS, CONFIG_DDL
from tidemart.sinks.keyed import MergedTable

KEYS = ["sink_type", "source_table", "source_type"]
START = "start"


@dataclass(frozen=True)
class RouteStore:
    """A catalog table of config rows with their newest change."""

    name: str

    @property
    def table(self) -> MergedTable:
        ddl = f"{CONFIG_DDL}, op string, ts_ms bigint, seq bigint"
        return MergedTable(self.name, ddl, _newest)

    def begin(self, snapshot: DataFrame, ts_ms: int | None = None, seq: int | None = None) -> None:
        """Take up a snapshot as of a log position; without one, every change comes after it."""
        self.apply(as_of(snapshot, ts_ms, seq), START)

    def apply(self, changes: DataFrame, run: str) -> None:
        """Merge config changes; a run that is repeated replaces itself."""
        self.table.create(changes.sparkSession)
        self.table.write(_newest(changes), run)

    def routes(self, spark: SparkSession, sink_type: str) -> DataFrame:
        """The config rows in force; none before anything was taken up."""
        if not spark.catalog.tableExists(self.name):
            return spark.createDataFrame([], CONFIG_DDL)
        rows = self.table.read(spark).where(F.col("sink_type") == sink_type)
        return rows.where("op <> 'd'").select(*CONFIG_COLUMNS)


def as_of(snapshot: DataFrame, ts_ms: int | None, seq: int | None) -> DataFrame:
    """Snapshot rows as config changes at a log position."""
    at = [F.lit(value).cast("bigint").alias(name) for name, value in (("ts_ms", ts_ms), ("seq", seq))]
    return snapshot.select(*CONFIG_COLUMNS, F.lit("r").alias("op"), *at)


def _newest(changes: DataFrame) -> DataFrame:
    return newest_rows(changes, KEYS, ["ts_ms", "seq"])

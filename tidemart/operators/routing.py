"""Config-driven routing of changes."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.constants import ANY_TYPE, DATABASE
from tidemart.operators.changes import dimension_changes, fact_changes
from tidemart.operators.joins import measured_join
from tidemart.schemas import CONFIG_COLUMNS


def current_config(changes: DataFrame, sink_type: str, snapshot: DataFrame | None = None) -> DataFrame:
    """The config rows in force: newest per (source_table, source_type), unless deleted.

    The start-up snapshot yields to any change. Only rows of ``sink_type`` take
    part, so a change of a row's sink type or key leaves its former entry in
    force until that is deleted.
    """
    rows = changes.where(F.col("sink_type") == sink_type).withColumn("_rank", F.lit(1))
    if snapshot is not None:
        start = snapshot.where(F.col("sink_type") == sink_type).select(
            *CONFIG_COLUMNS,
            F.lit("r").alias("op"),
            F.lit(None).cast("bigint").alias("ts_ms"),
            F.lit(None).cast("bigint").alias("seq"),
            F.lit(0).alias("_rank"),
        )
        rows = rows.unionByName(start)
    order = F.struct("_rank", "ts_ms", "seq")
    newest = rows.groupBy("source_table", "source_type").agg(
        F.max_by(F.struct("op", *CONFIG_COLUMNS), order).alias("row")
    )
    return newest.where("row.op <> 'd'").select(*[f"row.{c}" for c in CONFIG_COLUMNS])


def _routes(config: DataFrame) -> DataFrame:
    names = F.transform(F.split("sink_columns", ","), lambda name: F.trim(name))
    return config.select(
        F.col("source_table").alias("_table"),
        F.col("source_type").alias("_type"),
        "sink_table",
        "sink_row_key",
        names.alias("_names"),
    )


def _route(changes: DataFrame, routes: DataFrame, match: Column) -> DataFrame:
    """Join changes with their route and prune the data to the route's columns.

    The row key is read before pruning, so it need not be a sink column.
    """
    spread = F.xxhash64("ts", "seq", F.map_values("data"))
    return measured_join(changes, routes, match, spread).select(
        "sink_table",
        F.col("data")[F.col("sink_row_key")].alias("row_key"),
        F.col("type").alias("op_type"),
        F.map_filter("data", lambda name, _: F.array_contains("_names", name)).alias("data"),
        "ts",
        "seq",
    )


def route_dimensions(changes: DataFrame, config: DataFrame, database: str = DATABASE) -> DataFrame:
    """Dimension changes with their target; a config row covers all kinds of change.

    Rows without a row key can be told by a null ``row_key``.
    """
    routes = _routes(config.where(F.col("source_type") == ANY_TYPE))
    return _route(dimension_changes(changes, database), routes, F.col("table") == F.col("_table"))


def route_facts(changes: DataFrame, config: DataFrame, database: str = DATABASE) -> DataFrame:
    """Fact changes with their target; a config row covers one kind of change."""
    match = (F.col("table") == F.col("_table")) & (F.col("type") == F.col("_type"))
    return _route(fact_changes(changes, database), _routes(config), match)


def fact_messages(routed: DataFrame) -> DataFrame:
    """Routed facts as (topic, value); absent values are left out of the JSON."""
    kept = F.map_filter("data", lambda _, value: value.isNotNull())
    return routed.select(F.col("sink_table").alias("topic"), F.to_json(kept).alias("value"))

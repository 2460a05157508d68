"""Router plans: changes to dimensions (J0) and to fact topics."""

from pyspark.sql import DataFrame

from tidemart.constants import DATABASE
from tidemart.operators.merge import live_rows, merge_changes
from tidemart.operators.routing import fact_messages, route_dimensions, route_facts


def dimension_rows(changes: DataFrame, config: DataFrame, database: str = DATABASE) -> DataFrame:
    """Dimension rows after all changes, as (sink_table, row_key, data)."""
    return live_rows(merge_changes(route_dimensions(changes, config, database)))


def routed_facts(changes: DataFrame, config: DataFrame, database: str = DATABASE) -> DataFrame:
    """Messages of the routed facts, as (topic, value)."""
    return fact_messages(route_facts(changes, config, database))

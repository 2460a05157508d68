"""Dictionary of codes and names."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.constants import DIM_DICTIONARY
from tidemart.schemas import DICTIONARY_COLUMNS
from tidemart.sinks.keyed import DimensionStore


def read_dictionary(spark: SparkSession, store: DimensionStore, sink_table: str = DIM_DICTIONARY) -> DataFrame:
    """The dictionary as the dimension store holds it now."""
    return store.dictionary(spark, sink_table)


def file_dictionary(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A dictionary kept as files, read as they stand now."""
    schema = ", ".join(f"{c} string" for c in DICTIONARY_COLUMNS)
    return spark.read.format(fmt).schema(schema).load(path).where(F.col("dic_code").isNotNull())

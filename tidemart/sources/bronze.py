"""Parsed change log kept as parquet by table and day, so jobs scan only their slices."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.constants import WATERMARK
from tidemart.schemas import CHANGE_DDL
from tidemart.sources.topics import with_event_time


PARTITIONS = ("table", "day")
# The partition of rows without a day.
NO_DAY = "__HIVE_DEFAULT_PARTITION__"
LOG_DDL = "mid string, is_new string, ts bigint, seq bigint, doc variant, day date"
STREAM_SALTS = 8


def bronze_rows(changes: DataFrame, span: str = "day") -> DataFrame:
    """Changes with the day they belong to, or the first day of their month or year."""
    day = F.to_date(F.date_trunc(span, F.timestamp_seconds("ts")))
    return changes.select("database", "type", "data", "old", "ts", "seq", "table", day.alias("day"))


def write_bronze(
    changes: DataFrame, path: str, mode: str = "append", by: tuple[str, ...] = PARTITIONS, span: str = "day"
) -> None:
    """Store a batch of changes by (table, day), or by table only; by month or year, with ``span``, where days hold little.

    The rebalance hint gathers each partition into few files and splits the
    partitions of a busy table over many tasks.
    """
    bronze_rows(changes, span).hint("rebalance", *by).write.mode(mode).partitionBy(*by).parquet(path)


def gathered(changes: DataFrame, salts: int = STREAM_SALTS) -> DataFrame:
    """Bronze rows of a stream, gathered by partition into at most ``salts`` tasks each."""
    rows = bronze_rows(changes)
    return rows.repartition(*PARTITIONS, F.pmod(F.xxhash64("ts", "seq", F.map_values("data")), F.lit(salts)))


def read_bronze(
    spark: SparkSession, path: str, streaming: bool = False, delay: str = WATERMARK, day: str | None = None, **options: str
) -> DataFrame:
    """Stored changes; a filter on ``table`` or ``day`` prunes partitions. ``options`` go to the reader.

    With ``day`` the source is that day's files of all tables; ``NO_DAY`` names the changes without time.
    """
    reader = (spark.readStream if streaming else spark.read).options(**options)
    if day:
        reader, path = reader.option("basePath", path), f"{path}/table=*/day={day}"
    return with_event_time(reader.schema(CHANGE_DDL + ", day date").parquet(path), delay)


def bronze_days(spark: SparkSession, path: str) -> list[str]:
    """The days that bronze holds, in order; only partition names are read. Changes without time, if any, come last."""
    rows = spark.read.schema(CHANGE_DDL + ", day date").parquet(path).select("day").distinct()
    return sorted((str(r.day) if r.day else NO_DAY for r in rows.toLocalIterator()), key=lambda day: (day == NO_DAY, day))


def log_rows(records: DataFrame) -> DataFrame:
    """Parsed behaviour records with the day they belong to: key columns of their own, the whole object as a variant."""
    return records.select("mid", "is_new", "ts", "seq", "doc", F.to_date(F.timestamp_millis("ts")).alias("day"))


def write_log(records: DataFrame, path: str, mode: str = "append") -> None:
    """Store parsed behaviour records by day. What is read of them later is parsed no more, and only key columns unless more is asked."""
    log_rows(records).hint("rebalance", "day").write.mode(mode).partitionBy("day").parquet(path)


def read_log(spark: SparkSession, path: str, day: str | None = None) -> DataFrame:
    """Stored behaviour records, of one day if it is given."""
    rows = spark.read.schema(LOG_DDL).parquet(path)
    return (rows if day is None else rows.where(F.col("day") == F.lit(day).cast("date"))).drop("day")

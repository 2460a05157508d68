"""Routing config: start-up snapshot and change envelopes."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.schemas import CONFIG_COLUMNS, CONFIG_DDL, ENVELOPE_DDL


def config_snapshot(
    spark: SparkSession, sink_type: str, fmt: str = "jdbc", path: str | None = None, **options: str
) -> DataFrame:
    """Config rows of one sink type as they stand now.

    The filter is part of the plan, so a JDBC source evaluates it itself.
    """
    reader = spark.read.format(fmt).options(**options)
    if fmt != "jdbc":
        reader = reader.schema(CONFIG_DDL)
    rows = reader.load(path) if path else reader.load()
    return rows.select(*CONFIG_COLUMNS).where(F.col("sink_type") == sink_type)


def _envelopes(lines: DataFrame) -> tuple[DataFrame, Column]:
    """Lines with their envelope ``e``, and whether it is a change: an object with ``op`` and the row that belongs to it."""
    document = F.from_json("value", ENVELOPE_DDL + ", _bad string", {"columnNameOfCorruptRecord": "_bad"})
    env = lines.select("*", F.explode(F.array(document)).alias("e"))
    usable = F.col("e._bad").isNull() & F.col("e.op").isNotNull() & _image().isNotNull()
    return env, F.coalesce(usable, F.lit(False))


def _image() -> Column:
    return F.when(F.col("e.op") == "d", F.col("e.before")).otherwise(F.col("e.after"))


def _order() -> list[Column]:
    return [F.col("e.ts_ms").alias("ts_ms"), F.coalesce("e.seq", "position").alias("seq")]


def config_changes(lines: DataFrame) -> DataFrame:
    """Config rows with ``op`` from change envelopes.

    A delete carries its row in the before image, everything else in the after
    image. ``(ts_ms, seq)`` orders the changes.
    """
    env, usable = _envelopes(lines)
    return env.where(usable).select(_image().alias("row"), F.col("e.op").alias("op"), *_order()).select("row.*", "op", "ts_ms", "seq")


def config_rejects(lines: DataFrame) -> DataFrame:
    """Lines that are no config changes."""
    env, usable = _envelopes(lines)
    return env.where(~usable).select("value")


def table_changes(lines: DataFrame) -> DataFrame:
    """Config changes for the life of sink tables: an update that names another sink table also deletes the former one."""
    env, usable = _envelopes(lines)
    former = F.col("e.before.sink_table")
    renamed = usable & (F.col("e.op") == "u") & former.isNotNull() & ~former.eqNullSafe(F.col("e.after.sink_table"))
    gone = env.where(renamed).select("e.before.*", F.lit("d").alias("op"), *_order())
    return config_changes(lines).unionByName(gone)

"""New-visitor correction over a whole log."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemart.functions.times import day_of_millis

ARRIVAL = "arrival"
SAME_DAY = "same_day"
DAY_MILLIS = 24 * 60 * 60 * 1000


def correct_visitors(records: DataFrame, mode: str = ARRIVAL) -> DataFrame:
    """Set ``is_new`` to '0' on records of devices already seen.

    ``arrival``: a device counts as new on its first record, by (ts, seq), only. Of
    records that are first alike (a repeated line) one counts.
    ``same_day``: it counts as new during the day of its first visit; a first
    record that does not claim to be new puts that visit a day earlier.

    The first record per device comes from an aggregate, which reduces a busy
    device before the shuffle, rather than from a window that would sort all its
    records in one task. Records that stay new are then found by a join on the
    device and that record, or that day, so a busy device's records spread over
    the partitions. Records that do not claim to be new pass by the join.
    """
    return _corrected(records, records.groupBy("mid").agg(F.min(F.struct("ts", "seq", "is_new")).alias("first")), mode)


def _corrected(records: DataFrame, firsts: DataFrame, mode: str) -> DataFrame:
    """Records judged by the ``first`` record of each device."""
    claims = F.col("is_new") == "1"
    # Where the first record claims nothing, the visit lies before all records.
    news = firsts.where(F.col("first.is_new") == "1")
    if mode == ARRIVAL:
        news = news.select(F.col("mid").alias("_mid"), F.col("first.ts").alias("_ts"), F.col("first.seq").alias("_seq"))
        same = F.col("ts").eqNullSafe(F.col("_ts")) & F.col("seq").eqNullSafe(F.col("_seq"))
    elif mode == SAME_DAY:
        news = news.select(F.col("mid").alias("_mid"), day_of_millis(F.col("first.ts")).alias("_day"))
        same = day_of_millis(F.col("ts")) == F.col("_day")
    else:
        raise ValueError(f"unknown mode {mode!r}")
    first = (F.col("mid") == F.col("_mid")) & same
    unclaimed = records.where(~F.coalesce(claims, F.lit(False)))
    claimed = records.where(claims)
    if mode == SAME_DAY:
        flagged = claimed.join(news, first, "left").withColumn("is_new", F.when(F.col("_mid").isNotNull(), "1").otherwise("0"))
        return flagged.select(*records.columns).unionByName(unclaimed)
    # Devices whose first record stands several times: mostly none, and then adaptive execution drops their branch. Only key
    # columns are shuffled to find them, and only their first records are numbered.
    repeated = claimed.select("mid", "ts", "seq").join(news, first, "inner").groupBy("_mid").count().where("count > 1").select("_mid")
    news = news.join(repeated.select(F.col("_mid").alias("_again")), F.col("_mid") == F.col("_again"), "left")
    joined = claimed.join(news, first, "left").where("_again is null")
    corrected = joined.withColumn("is_new", F.when(F.col("_mid").isNotNull(), "1").otherwise("0")).select(*records.columns)
    several = claimed.join(news.where("_again is not null"), first, "inner")
    nth = F.row_number().over(Window.partitionBy("mid").orderBy("ts", "seq"))
    numbered = several.withColumn("_nth", nth).withColumn("is_new", F.when(F.col("_nth") == 1, "1").otherwise("0"))
    return corrected.unionByName(numbered.select(*records.columns)).unionByName(unclaimed)


VISITS_DDL = "mid string, ts bigint, seq bigint, is_new string"


def earliest_visits(rows: DataFrame) -> DataFrame:
    """The first record of each device, as (mid, ts, seq, is_new)."""
    firsts = rows.groupBy("mid").agg(F.min(F.struct("ts", "seq", "is_new")).alias("first"))
    return firsts.select("mid", "first.ts", "first.seq", "first.is_new")


def correct_next(records: DataFrame, known: DataFrame, mode: str = ARRIVAL) -> tuple[DataFrame, DataFrame]:
    """Correct the next part of a log that is worked off in order, such as its next day.

    ``known`` has the first record (mid, ts, seq, is_new) of every device before, and may already have those of this part. Returns
    the corrected records and the first records of this part's devices, to be added to what is known. What is read is this part and
    the key columns of ``known``; only devices of this part are looked up, and Spark may filter by them at run time.
    """
    here = earliest_visits(records)
    before = known.select(F.col("mid").alias("_mid"), F.struct("ts", "seq", "is_new").alias("_known"))
    firsts = here.join(before, F.col("mid") == F.col("_mid"), "left").select(
        "mid", F.least(F.struct("ts", "seq", "is_new"), F.col("_known")).alias("first")
    )
    return _corrected(records, firsts, mode), here

"""Joins of facts: bounded inner and left joins, interval join, lookup.

Fact joins carry no hints: Spark broadcasts a side only when its size is known to
be under ``spark.sql.autoBroadcastJoinThreshold``, and adaptive execution splits
the partitions of hot keys. A stream has no adaptive re-planning, so the inner
joins can spread a key over ``salts`` state partitions. Dictionaries and routes
may come from sources Spark has no size for, so those are measured.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# A side is broadcast when it holds no more than this.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 32 * 1024 * 1024
# Partitions over which a key is spread when its other side is too large for that.
LOOKUP_SALTS = 16


def is_small(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Whether ``df`` is measured to fit the broadcast bounds; reads at most ``rows`` + 1 rows."""
    width = F.octet_length(F.to_json(F.struct("*")))
    seen = df.limit(rows + 1).agg(F.count(F.lit(1)).alias("n"), F.sum(width).alias("size")).first()
    return seen["n"] <= rows and (seen["size"] or 0) <= size


def measured_join(many: DataFrame, few: DataFrame, on: Column, spread: Column, small: bool | None = None) -> DataFrame:
    """Inner join with a side that is usually small, such as a dictionary.

    The side is broadcast if measured to be small. If not, it is repeated once
    per salt and the rows of a busy key are spread by the hash ``spread``.
    """
    if is_small(few) if small is None else small:
        return many.join(F.broadcast(few), on, "inner")
    many, few, same = _salted(many, few, LOOKUP_SALTS, spread)
    return many.join(few, on & same, "inner").drop("_salt_many", "_salt_one")


def near(left: str, right: str, bound: str | None) -> Column:
    """Event times at most ``bound`` apart; always true without a bound."""
    if bound is None:
        return F.lit(True)
    reach = F.expr(f"interval {bound}")
    return (F.col(right) >= F.col(left) - reach) & (F.col(right) <= F.col(left) + reach)


def _salted(
    many: DataFrame, one: DataFrame, salts: int, spread: Column | None = None
) -> tuple[DataFrame, DataFrame, Column]:
    """Spread ``many`` by a hash, by default of the row, and repeat ``one`` once per salt."""
    if salts <= 1:
        return many, one, F.lit(True)
    if spread is None:
        spread = F.xxhash64(*[F.col(c) for c in many.columns])
    return (
        many.withColumn("_salt_many", F.pmod(spread, F.lit(salts)).cast("int")),
        one.withColumn("_salt_one", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))),
        F.col("_salt_many") == F.col("_salt_one"),
    )


def inner_join(
    many: DataFrame,
    one: DataFrame,
    on: list[tuple[str, str]],
    *,
    times: tuple[str, str],
    bound: str | None = None,
    salts: int = 1,
) -> DataFrame:
    """Inner join of a detail side with a side holding few rows per key.

    Only the detail side's event time survives. With ``salts`` > 1 the detail
    rows of one key are spread over that many partitions by a hash of the row
    and the other side is repeated once per salt, which leaves the result as is.
    """
    many, one, cond = _salted(many, one, salts)
    cond = cond & near(*times, bound)
    for left, right in on:
        cond = cond & (F.col(left) == F.col(right))
    return many.join(one, cond, "inner").drop(times[1], "_salt_many", "_salt_one")


def inner_join_by_key(
    many: DataFrame, rows: DataFrame, one: DataFrame, key: str, on: tuple[str, str], salts: int = 1
) -> DataFrame:
    """Inner join of wide rows, partitioned by ``key``, with a side holding few rows per value of another column.

    ``rows`` holds at least the pairs of ``key`` and that column that ``many`` has. Only the pairs go to ``one``, with what
    they find they come back by ``key``; so the wide rows stay where they are. Equal rows of ``one`` are counted on the
    way, since pairs may repeat and are made distinct where they come back.
    The other column is compared, not joined on, so that the partitioning by ``key`` is enough: a key should have few values of it.
    """
    left, right = on
    counted = one.groupBy(*one.columns).agg(F.count(F.lit(1)).alias("_times"))
    pairs, counted, cond = _salted(rows.select(F.col(key).alias("_key"), left), counted, salts)
    found = pairs.join(counted, cond & (F.col(left) == F.col(right)), "inner").select("_key", *counted.columns)
    found = found.drop("_salt_one").repartition("_key").distinct()
    found = found.withColumn("_time", F.explode(F.sequence(F.lit(1), F.col("_times").cast("int"))))
    return many.join(found, (F.col(key) == F.col("_key")) & F.col(left).between(F.col(right), F.col(right)), "inner").drop("_key", "_times", "_time")


def spread_key(key: str, *row: str) -> Column:
    """``key``, or for null keys a text no real key has and that differs by row.

    Null keys match nothing in a left join but would all land in one task.
    """
    return F.coalesce(F.col(key), F.concat(F.lit("\u0000"), F.xxhash64(*[F.col(c) for c in row]).cast("string")))


def left_join(
    left: DataFrame,
    right: DataFrame,
    on: tuple[str, str],
    *,
    times: tuple[str, str],
    bound: str | None = None,
) -> DataFrame:
    """Left join keeping only the left side's event time."""
    cond = (F.col(on[0]) == F.col(on[1])) & near(*times, bound)
    return left.join(right, cond, "left").drop(times[1], on[1])


def interval_join(
    many: DataFrame,
    anchor: DataFrame,
    on: tuple[str, str],
    *,
    times: tuple[str, str],
    before: int,
    after: int,
    salts: int = 1,
) -> DataFrame:
    """Inner join where the detail's time lies in ``[anchor - before, anchor + after]``.

    Seconds are whole. Time is cut into windows as long as the interval; a
    detail has one window and an anchor at most two, and the window is part of
    the join key. So a busy key spreads over its windows, and only rows close
    in time are ever compared.
    """
    width = max(before + after, 1)
    at, anchor_at = times
    seconds = F.unix_seconds(F.col(anchor_at))
    first = F.floor((seconds - before) / F.lit(width)).cast("bigint")
    last = F.floor((seconds + after) / F.lit(width)).cast("bigint")
    anchor = anchor.withColumn("_window_anchor", F.explode(F.sequence(first, last)))
    many = many.withColumn("_window_many", F.floor(F.unix_seconds(F.col(at)) / F.lit(width)).cast("bigint"))
    many, anchor, cond = _salted(many, anchor, salts)
    cond = (
        cond
        & (F.col(on[0]) == F.col(on[1]))
        & (F.col("_window_many") == F.col("_window_anchor"))
        & (F.col(at) >= F.col(anchor_at) - F.expr(f"interval {before} seconds"))
        & (F.col(at) <= F.col(anchor_at) + F.expr(f"interval {after} seconds"))
    )
    return anchor.join(many, cond, "inner").drop(
        "_window_many", "_window_anchor", "_salt_many", "_salt_one"
    )


def lookup(fact: DataFrame, dictionary: DataFrame, code: str, name: str, small: bool | None = None) -> DataFrame:
    """Add the dictionary name of a code; rows whose code is unknown are dropped."""
    names = dictionary.select(F.col("dic_code").alias("_code"), F.col("dic_name").alias(name))
    spread = F.xxhash64(*[F.col(c) for c in fact.columns])
    return measured_join(fact, names, F.col(code) == F.col("_code"), spread, small).drop("_code")

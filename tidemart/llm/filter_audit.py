"""What corpus filters take from each other, for every order of applying them.

Every filter has a table of the rows that fail it, ids only; the tables are stored together as one relation
(row, filter). The survivors of a set of filters are the rows left by anti-joins with those tables, and what the next filter
removes is the semi-join of the survivors with its table. All orders with the same filters in front share the same
survivors, so n filters take 2 ** n sets, not n! orders. A level holds the survivors of all sets of k filters, and
one semi-join and one anti-join take all of them on: each set is made once, from the set without its last filter.

The id tables and levels are stored in buckets of the row number: the joins of a level need no shuffle. Only
counts by (part, set, filter) leave them, and the orders are spelled out over those.

The five filters of the report: under ``LEAST_WORDS`` words; few distinct words; many capitals; a symbol of ``SYMBOLS``;
the text of a smaller id. Rows are audited one by one, so repeated ids count as often as they stand. Null texts count
as empty and null parts as ''. A row without id has no smaller id and is none, and has no labels. Where an id has several
labels, a flag is set if one of them sets it. Null flags count as 0. Empty tables give no parts.
"""

from __future__ import annotations

import uuid
from functools import reduce
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import stored
from tidemart.session import shared_dir

LEAST_WORDS = 100
DISTINCT_PERCENT = 80
CAPITAL_PERCENT = 10
SYMBOLS = "[#$%&*|]"
WHITE = r"[\x20\x09-\x0D]+"
COPY = "E"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

ROWS_A_BUCKET = 100_000
MOST_BUCKETS = 20_000


def bucketed(df: DataFrame, name: str, buckets: int) -> DataFrame:
    """A stored table in buckets of ``row``, so that joins on it need no exchange."""
    spark = df.sparkSession
    name = f"{name}_{uuid.uuid4().hex}"
    writer = df.repartition(buckets, "row").write.bucketBy(buckets, "row").sortBy("row")
    writer.option("path", f"{shared_dir(spark)}/llm/{name}").saveAsTable(name, format="parquet")
    return spark.table(name)


def text_failures(text: Column) -> dict[str, Column]:
    """Failure conditions that look at one text only."""
    found = F.array_remove(F.split(text, WHITE), "")
    size = F.char_length(text)
    capitals = size - F.char_length(F.translate(text, CAPITALS, ""))
    return {
        "A": F.size(found) < LEAST_WORDS,
        "B": 100 * F.size(F.array_distinct(found)) < DISTINCT_PERCENT * F.size(found),
        "C": 100 * capitals > CAPITAL_PERCENT * size,
        "D": text.rlike(SYMBOLS),
    }


def labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows (row, part, doc_id) with their flags ``good`` and ``toxic``."""
    flag = lambda name: F.max(F.when(F.col(name) == 1, 1).otherwise(0))
    by_id = labels.where("doc_id is not null").groupBy("doc_id").agg(flag("quality").alias("good"), flag("toxic").alias("toxic"))
    known = rows.where("doc_id is not null").join(by_id, "doc_id", "left").select("row", "part", "good", "toxic")
    unknown = rows.where("doc_id is null").select("row", "part", F.lit(0).alias("good"), F.lit(0).alias("toxic"))
    return known.union(unknown).fillna(0, ["good", "toxic"])


def relations(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame, list[str], int]:
    """Rows (row, part, good, toxic), the id tables (row, filter) with the filters' numbers, their names, and the number of
    buckets of both.

    The whole texts are read once. A copy is a row that is not the smallest of its text: the smallest ids are taken by
    digest on the map side first, and joined back on digest and id, so a text that is everywhere is no hot key.
    """
    text = F.coalesce("text", F.lit(""))
    checks = text_failures(text)
    measured = docs.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        F.coalesce("lang", F.lit("")).alias("part"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
        F.array_compact(F.array(*[F.when(check, i) for i, check in enumerate(checks.values())])).alias("fails"),
    )
    measured = stored(measured, "audited")
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = min(MOST_BUCKETS, max(least, -(-measured.count() // ROWS_A_BUCKET)))
    smallest = measured.groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
    copies = measured.where("doc_id is not null").join(smallest, ["digest", "doc_id"], "left_anti")
    ids = measured.select("row", F.explode("fails").alias("filter")).union(copies.select("row", F.lit(len(checks))))
    failing = bucketed(ids, "failing", buckets)
    return bucketed(labelled(measured, labels), "rows", buckets), failing, [*checks, COPY], buckets


def removals(rows: DataFrame, failing: DataFrame, filters: int, buckets: int) -> tuple[DataFrame, DataFrame]:
    """What each filter removes after the set ``gone``: (part, gone, filter, removed, good_lost, toxic_lost); and the number
    of survivors (part, gone, n). ``gone`` has a bit for each filter."""
    level = rows.withColumn("gone", F.lit(0))
    hits, sizes = [], []
    for k in range(filters):
        sizes.append(level.groupBy("part", "gone").agg(F.count("*").alias("n")))
        ahead = F.expr(f"filter(sequence(0, {filters - 1}), i -> gone & shiftleft(1, i) = 0)")
        before = level.withColumn("next", F.explode(ahead)).alias("b")
        # Written so, the filter is no join key: the buckets are by row alone.
        fails = F.expr("b.row = f.row and b.next - f.filter = 0")
        hit = before.join(failing.alias("f"), fails, "left_semi").groupBy("part", "gone", F.col("next").alias("filter"))
        hits.append(hit.agg(F.count("*").alias("removed"), F.sum("good").alias("good_lost"), F.sum("toxic").alias("toxic_lost")))
        if k < filters - 1:
            left = before.where("gone < shiftleft(1, next)").join(failing.alias("f"), fails, "left_anti")
            left = left.select("row", "part", "good", "toxic", F.expr("gone | shiftleft(1, next)").alias("gone"))
            level = bucketed(left, f"survivors_{k + 1}", buckets)
    return stored(reduce(DataFrame.unionByName, hits), "removals"), stored(reduce(DataFrame.unionByName, sizes), "sizes")


def audit(rows: DataFrame, failing: DataFrame, names: list[str], buckets: int) -> DataFrame:
    """Every part, order of the filters (single letters, ``names``), and step; rows (row, part, good, toxic), id tables (row, filter)
    with the filters' numbers, both best in ``buckets`` of the row."""
    removed, sizes = removals(rows, failing, len(names), buckets)
    whole = (1 << len(names)) - 1
    orders = F.split(F.lit(" ".join("".join(order) for order in permutations(names))), " ")
    parts = sizes.where("gone = 0").groupBy("part").agg(F.sum("n").alias("rows")).select("part", F.explode(orders).alias("filter_order"))
    number = f"locate(substr(filter_order, {{}}, 1), '{''.join(names)}') - 1"
    spelled = parts.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(names))))).select(
        "part", "filter_order", "step",
        F.expr(number.format("step")).alias("filter"),
        F.expr(f"aggregate(sequence(0, step - 1), 0, (gone, i) -> if(i = 0, 0, gone | shiftleft(1, {number.format('i')})))").alias("gone"),
    )
    alone = removed.groupBy("part", "filter").agg(
        F.sum(F.when(F.col("gone") == 0, F.col("removed"))).alias("fails"),
        F.sum(F.when(F.expr(f"gone = {whole} - shiftleft(1, filter)"), F.col("removed"))).alias("unique_fails"),
    )
    seen = sizes.groupBy("part", "gone").agg(F.sum("n").alias("n"))
    counts = ["n", "removed", "good_lost", "toxic_lost", "fails", "unique_fails"]
    found = spelled.join(seen, ["part", "gone"], "left").join(removed, ["part", "gone", "filter"], "left").join(alone, ["part", "filter"], "left")
    found = found.fillna(0, counts)
    by_filter = found.groupBy("part", "filter").agg(F.sum("removed").alias("shapley"))
    return found.join(by_filter, ["part", "filter"]).select(
        "part", "filter_order", "step",
        (F.col("n") - F.col("removed")).alias("kept"),
        "removed",
        (F.col("fails") - F.col("removed")).alias("redundant"),
        "unique_fails", "good_lost", "toxic_lost", "shapley",
    )


def audit_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """op13: the five filters over all documents, by language."""
    return audit(*relations(docs, labels))

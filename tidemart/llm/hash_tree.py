"""Shards by a weighted hash tree: region, then rack, then shard.

A row draws at every level. Each child of the node reached so far gets a score -ln(u) / weight, where u
is a hash in (0, 1) of the row's key and the child's name, and the smallest score wins. So a child
wins in proportion to its weight, and a draw depends on nothing but key, names and weights:
when a weight changes, only rows whose winner is, or was, the changed child move, at the level of the
change; below an unchanged node nothing moves. Growth opens a new region holding the new
shard, hence one more shard takes rows only into itself.

All of it is column expressions. Rows get their place in a shard (``slot``) from counts of
(shard, bucket), where buckets are hashed pieces of a shard, so that no task holds a whole shard.

Null keys draw like a key of their own. Null texts have no bytes (size 1, checksum 0). Equal rows
get slots of their own. Columns named like a result column are replaced.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


class Node(NamedTuple):
    """A region, rack or shard. Shards have a number and no children."""

    name: str
    weight: float
    children: tuple[Node, ...] = ()
    shard: int | None = None


def shard_node(number: int, weight: float = 1.0) -> Node:
    return Node(f"shard-{number}", weight, shard=number)


def parent(name: str, *children: Node) -> Node:
    return Node(name, sum(c.weight for c in children), children)


def even_tree(shards: int = 8, regions: int = 2, racks: int = 2) -> Node:
    """Shards 0.. of weight 1, dealt to racks in turn, racks to regions."""
    groups: list[list[list[Node]]] = [[[] for _ in range(racks)] for _ in range(regions)]
    for n in range(shards):
        groups[n * regions // shards][(n * regions * racks // shards) % racks].append(shard_node(n))
    made = [
        parent(f"region-{r}", *(parent(f"region-{r}/rack-{k}", *rack) for k, rack in enumerate(region) if rack))
        for r, region in enumerate(groups)
        if any(region)
    ]
    return parent("root", *made)


def grown(tree: Node, number: int, weight: float = 1.0) -> Node:
    """The tree with one more shard, in a region and rack of its own."""
    name = f"region-of-{number}"
    return parent("root", *tree.children, parent(name, parent(f"{name}/rack-0", shard_node(number, weight))))


def draw(key: Column, name: str) -> Column:
    """A number in (0, 1), from the upper 52 bits of a hash."""
    return (F.shiftrightunsigned(F.xxhash64(F.lit(name), key), 12).cast("double") + 0.5) / F.lit(2.0**52)


def descend(node: Node, key: Column) -> Column:
    """The number of the shard that a key reaches below ``node``."""
    if node.shard is not None:
        return F.lit(node.shard)
    live = [c for c in node.children if c.weight > 0]
    if len(live) == 1:
        return descend(live[0], key)
    scores = [(-F.log(draw(key, c.name)) / F.lit(c.weight)) for c in live]
    best = F.least(*scores)
    chosen = F.when(scores[0] == best, descend(live[0], key))
    for score, child in zip(scores[1:], live[1:], strict=True):
        chosen = chosen.when(score == best, descend(child, key))
    return chosen


def assign(rows: DataFrame, tree: Node, key: str = "doc_id", out: str = "shard") -> DataFrame:
    """Add the shard of every row. No shuffle."""
    return rows.withColumn(out, descend(tree, F.col(key).cast("string")))


def with_slots(rows: DataFrame, shard: str = "shard", buckets: int = 256) -> DataFrame:
    """Number the rows of each shard from 0 without gaps.

    A shard's rows are ordered by bucket, then by their columns. Equal rows are counted before the
    shuffle and spread out again after it. What is broadcast has shards x buckets rows at most.
    """
    columns = rows.columns
    counted = rows.groupBy(*columns).agg(F.count("*").alias("__n"))
    counted = counted.withColumn("__bucket", F.pmod(F.xxhash64(*columns), F.lit(buckets)))
    place = [F.col(shard), F.col("__bucket")]
    starts = (
        rows.withColumn("__bucket", F.pmod(F.xxhash64(*columns), F.lit(buckets)))
        .groupBy(*place)
        .agg(F.count("*").alias("__size"))
        .withColumn("__start", F.sum("__size").over(Window.partitionBy(shard).orderBy("__bucket")) - F.col("__size"))
        .drop("__size")
    )
    within = Window.partitionBy(shard, "__bucket").orderBy(*columns)
    before = F.sum("__n").over(within) - F.col("__n")
    numbered = counted.withColumn("__before", before).join(F.broadcast(starts), [shard, "__bucket"])
    first = F.col("__start") + F.col("__before")
    return numbered.withColumn("slot", F.explode(F.sequence(first, first + F.col("__n") - 1))).select(*columns, "slot")


def shard_report(docs: DataFrame, shards: int = 8) -> DataFrame:
    """op6: shard and slot of every document, and its shard with one more shard; law ``key``."""
    tree = even_tree(shards)
    rows = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
    )
    rows = assign(assign(rows, tree), grown(tree, shards), out="grown_shard")
    return with_slots(rows).withColumn("law", F.lit("key")).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    )

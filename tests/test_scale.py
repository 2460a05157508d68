"""Plans at scale: hot keys are split, null keys spread, scans pruned."""

import re

import pytest
from logs import bag
from pyspark.sql import functions as F

from tidemart.adapters import star_schema as star
from tidemart.adapters.star_schema import Tables
from tidemart.operators.joins import interval_join, is_small
from tidemart.operators.visitors import ARRIVAL, correct_visitors
from tidemart.plans import facts
from tidemart.sources.topics import with_event_time

SHUFFLED = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.shuffle.partitions": "16",
}
ROWS = 120_000


@pytest.fixture
def shuffled(spark):
    old = {k: spark.conf.get(k, None) for k in SHUFFLED}
    for k, v in SHUFFLED.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _changes(df, table, data):
    return df.selectExpr(
        "'shop' database", f"'{table}' table", "'insert' type", f"map({data}) data",
        "cast(null as map<string,string>) old", "1000L ts", "id seq",
    )


def _shop(spark):
    """A third of all details belong to one order; a seventh has no id."""
    base = spark.range(ROWS)
    key = "if(id % 3 = 0, 'hot', cast(id % 5000 as string))"
    parts = [
        _changes(base, "order_detail", f"'id', if(id % 7 = 0, null, cast(id as string)), 'order_id', {key}, "
                 "'sku_id', cast(id as string), 'sku_num', '1', 'order_price', '2.00'"),
        _changes(spark.range(5000), "order_info", "'id', if(id = 0, 'hot', cast(id as string)), 'user_id', 'u', 'province_id', 'p'"),
        _changes(base.where("id % 2 = 0"), "order_detail_activity",
                 "'order_detail_id', cast(id as string), 'activity_id', 'a', 'activity_rule_id', 'r'"),
        _changes(base.where("id % 5 = 0"), "order_detail_coupon", "'order_detail_id', cast(id as string), 'coupon_id', 'c'"),
    ]
    return with_event_time(star.union(parts))


def final_plan(df):
    df.foreachPartition(lambda rows: None)
    return df._jdf.queryExecution().executedPlan().toString()


def largest_share(df):
    """Largest share of rows in one partition."""
    counts = df.groupBy(F.spark_partition_id()).count().collect()
    return max(r["count"] for r in counts) / sum(r["count"] for r in counts)


@pytest.mark.parametrize("salts", [1, 8])
def test_hot_order_is_split_and_nothing_is_lost(shuffled, salts):
    df = facts.order_detail(_shop(shuffled), salts=salts)
    whole = df.agg(
        F.count("*"), F.count("activity_id"), F.count("coupon_id"), F.sum("sku_id"), F.count("user_id")
    ).first()
    ids = [i for i in range(ROWS) if i % 3 == 0 or i % 5000]
    named = [i for i in ids if i % 7]
    assert tuple(whole) == (
        len(ids), sum(i % 2 == 0 for i in named), sum(i % 5 == 0 for i in named), float(sum(ids)), len(ids),
    )
    plan = final_plan(df)
    assert salts > 1 or "SortMergeJoin(skew=true)" in plan
    assert plan.split("Initial Plan")[0].count("Exchange hashpartitioning(od_key") == 1


@pytest.mark.parametrize("salts", [1, 4])
def test_whole_details_are_shuffled_once(shuffled, salts):
    df = facts.order_detail(_shop(shuffled), salts=salts)
    plan = df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    exchanges = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: (.*)", plan)
    assert sum("od_sku_name" in e for e in exchanges) == 1
    assert not any("od_id" in e for e in exchanges)


@pytest.mark.parametrize("salts", [1, 4])
def test_repeated_ids_and_orders_meet_as_often_as_they_stand(shuffled, salts):
    """As the join of whole details within a bound of time that all changes keep."""
    base = shuffled.range(60)
    parts = [
        _changes(base, "order_detail", "'id', if(id % 5 = 0, null, concat('d', id % 9)), 'order_id', if(id % 11 = 0, null, cast(id % 7 as string)), "
                 "'sku_id', cast(id % 2 as string), 'sku_num', '1', 'order_price', '2.00'"),
        _changes(base.where("id < 20"), "order_info", "'id', if(id % 13 = 0, null, cast(id % 6 as string)), 'user_id', if(id % 3 = 0, null, cast(id % 2 as string))"),
        _changes(base.where("id < 12"), "order_detail_activity", "'order_detail_id', if(id % 4 = 0, null, concat('d', id % 9)), 'activity_id', 'a'"),
        _changes(base.where("id < 12"), "order_detail_coupon", "'order_detail_id', concat('d', id % 3), 'coupon_id', cast(id % 2 as string)"),
    ]
    changes = with_event_time(star.union(parts))
    found, wanted = bag(facts.order_detail(changes, salts=salts)), bag(facts.order_detail(changes, bound="1 day"))
    assert found == wanted and max(wanted.values()) > 1


def test_null_ids_do_not_pile_up(shuffled):
    detail = facts.ORDER_DETAIL.read(_shop(shuffled))
    nulls = detail.where("od_id is null").withColumn(
        "od_key", facts.spread_key("od_id", "od_order_id", "od_sku_id", "od_create_time", "od_ts")
    )
    assert largest_share(nulls.repartition(16, "od_key")) < 0.12


def test_busy_device_is_spread(shuffled):
    records = shuffled.range(ROWS).selectExpr(
        "if(id % 3 = 0, 'hot', cast(id % 1000 as string)) mid", "'1' is_new", "id div 10 ts", "id seq"
    )
    df = correct_visitors(records, ARRIVAL)
    devices = records.select("mid").distinct().count()
    assert bag(df.groupBy("is_new").count()) == {("0", ROWS - devices): 1, ("1", devices): 1}
    assert re.search(r"Exchange hashpartitioning\(mid#\w+, coalesce\(ts", final_plan(df))


def test_interval_join_compares_only_near_rows(shuffled):
    """All rows share one key; pairs outside a window never meet in the join."""
    side = shuffled.range(20_000).selectExpr("'hot' k", "id", "timestamp_seconds(id * 600) at")
    many = side.selectExpr("k many_k", "id many_id", "at many_at")
    anchor = side.selectExpr("k anchor_k", "id anchor_id", "at anchor_at")
    df = interval_join(many, anchor, ("many_k", "anchor_k"), times=("many_at", "anchor_at"), before=1800, after=5)
    # Each anchor meets itself and the three details before it.
    assert df.count() == 4 * 20_000 - 6
    assert "_window_many" in final_plan(df)


def test_slices_read_the_columns_they_need(spark):
    changes = star.order_changes(Tables(spark, "/root/testdata/sf0.01"))
    plan = facts.ORDER.read(changes)._jdf.queryExecution().executedPlan().toString()
    assert "lineitem" not in plan
    assert "FileScan parquet [o_orderkey#" in plan and "o_totalprice" not in plan


def test_small_sides_are_measured(spark):
    df = spark.range(100)
    assert is_small(df)
    assert not is_small(df, rows=99)
    assert not is_small(df, size=10)
    assert is_small(df.where("id < 0"))

"""Message sinks and keyed tables (K1-K6)."""

import json

from logs import bag, json_bag

from tidemart.sinks.keyed import newest_fact_table
from tidemart.sinks.messages import FileSink, fact_values, keyed_fact_values

CART = "id string, user_id string, sku_id string, sku_num int, ts bigint"


def cart(spark, *rows):
    return spark.createDataFrame([(i, "u", "s", n, ts) for i, n, ts in rows], CART)


def test_values_keep_nulls_and_order(spark):
    value = fact_values(cart(spark, ("1", None, 5))).first().value
    assert value == '{"id":"1","user_id":"u","sku_id":"s","sku_num":null,"ts":5}'


def test_keyed_values(spark):
    row = keyed_fact_values(cart(spark, ("1", 2, 5)), ["id"]).first()
    assert json.loads(row.key) == {"id": "1"} and json.loads(row.value)["sku_num"] == 2


def test_a_repeated_run_replaces_itself(spark, tmp_path):
    sink = FileSink(str(tmp_path))
    for rows, run in (([("1", 1, 1)], "a"), ([("2", 2, 2), ("3", 3, 3)], "b"), ([("2", 2, 2), ("3", 3, 3)], "b"), ([], "c")):
        sink.write(fact_values(cart(spark, *rows)), "topic", run)
    assert len(json_bag(spark.read.text(f"{tmp_path}/topic"))) == 3
    assert spark.read.text(f"{tmp_path}/topic").count() == 3


def test_rows_name_their_topic(spark, tmp_path):
    sink = FileSink(str(tmp_path))
    messages = spark.createDataFrame([("a", "1"), ("b", "2"), ("a", "3")], "topic string, value string")
    sink.write_by_topic(messages, "r1")
    sink.write_by_topic(messages, "r1")
    assert bag(spark.read.schema("value string, topic string").text(str(tmp_path)).select("topic", "value")) == {
        ("a", "1"): 1, ("a", "3"): 1, ("b", "2"): 1,
    }


def test_newest_fact_table(spark):
    table = newest_fact_table("default.carts", "cart_add", ["id"], ["ts"])
    table.create(spark)
    table.create(spark)
    table.write(cart(spark, ("1", 1, 1), ("2", 2, 2)), "r1")
    table.write(cart(spark, ("1", 9, 9)), "r2")
    table.write(cart(spark, ("1", 9, 9)), "r2")
    expected = bag(cart(spark, ("1", 9, 9), ("2", 2, 2)))
    assert bag(table.read(spark)) == expected
    table.compact(spark)
    assert spark.table(table.name).select("run").distinct().count() == 1
    assert len(spark.sql(f"SHOW PARTITIONS {table.name}").collect()) == 1
    assert bag(table.read(spark)) == expected
    assert "Exchange" not in table.read(spark)._jdf.queryExecution().executedPlan().toString()
    table.compact(spark)
    table.write(cart(spark, ("2", 7, 7)), "r3")
    assert "Exchange" in table.read(spark)._jdf.queryExecution().executedPlan().toString()
    table.compact(spark)
    assert bag(table.read(spark)) == bag(cart(spark, ("1", 9, 9), ("2", 7, 7)))
    table.drop(spark)
    assert not spark.catalog.tableExists("default.carts")


def test_a_compaction_cut_short_changes_nothing(spark):
    table = newest_fact_table("default.carts2", "cart_add", ["id"], ["ts"])
    table.create(spark)
    table.write(cart(spark, ("1", 1, 1), ("2", 2, 2)), "r1")
    table.write(cart(spark, ("1", 9, 9)), "r2")
    expected = bag(table.read(spark))
    table._insert(table.read(spark).where("id = '1'"), "cut-short", "INTO")
    assert bag(table.read(spark)) == expected
    table.compact(spark)
    assert bag(table.read(spark)) == expected

"""Parsing of both logs, the config and the dictionary."""

import json

from logs import bag, dumps, lines_df, write_files
from shop import HISTORY

from tidemart.schemas import CONFIG_COLUMNS
from tidemart.sinks.messages import fact_values
from tidemart.sources.config import config_changes, config_snapshot
from tidemart.sources.dictionary import file_dictionary
from tidemart.sources.topics import parse_behaviour, parse_changes, parse_facts, read_changes, read_lines


def test_changes_and_rejects(spark):
    bad = ["{bad", "[1]", "", "null", '{"table":"a","ts":', "12", '"text"']
    changes, rejected = parse_changes(lines_df(spark, dumps(HISTORY) + bad))
    assert changes.count() == len(HISTORY)
    assert sorted(r.value for r in rejected.collect()) == sorted(bad)


def test_null_line_is_rejected(spark):
    lines = spark.createDataFrame([(None, 1)], "value string, position bigint")
    changes, rejected = parse_changes(lines)
    assert changes.count() == 0 and rejected.count() == 1


def test_seq_is_the_line_field_or_else_the_position(spark):
    rows = [{"table": "t", "ts": 1, "seq": 77}, {"table": "t", "ts": 1}]
    changes, _ = parse_changes(lines_df(spark, dumps(rows)))
    assert [r.seq for r in changes.orderBy("seq").collect()] == [1, 77]


def test_missing_keys_and_maps_read_as_null(spark):
    rows = [{"database": "shop", "table": "t", "type": "insert", "data": None, "ts": 1}]
    changes, _ = parse_changes(lines_df(spark, dumps(rows)))
    row = changes.selectExpr("data['a'] a", "old['a'] b").first()
    assert (row.a, row.b) == (None, None)


def test_amount_texts_keep_their_zeros(spark):
    rows = [{"table": "t", "data": {"amount": "1.50"}, "ts": 1}]
    changes, _ = parse_changes(lines_df(spark, dumps(rows)))
    assert changes.selectExpr("data['amount'] a").first().a == "1.50"


def test_event_time_and_text_files(spark, tmp_path):
    folder = write_files(tmp_path / "log", dumps(HISTORY), 3)
    changes = read_changes(read_lines(spark, folder, "text", streaming=False))
    assert changes.count() == len(HISTORY)
    assert changes.where("unix_seconds(et) <> ts").count() == 0


def test_behaviour_records_and_rejects(spark):
    lines = [
        json.dumps({"common": {"mid": "m1", "is_new": "1"}, "ts": 5}),
        json.dumps({"common": {"mid": 7, "is_new": 1}, "ts": 6}),
        "{bad", "[1]", "", "null", '{"ts":1}', '{"common":{"mid":null},"ts":1}', '{"common":{"mid":"m"}}',
    ]
    records, rejected = parse_behaviour(lines_df(spark, lines))
    assert bag(records.select("mid", "is_new", "ts", "seq")) == {("m1", "1", 5, 0): 1, ("7", "1", 6, 1): 1}
    assert dict(bag(rejected)) == {
        ("{bad", "not a JSON object"): 1, ("[1]", "not a JSON object"): 1, ("", "not a JSON object"): 1,
        ("null", "not a JSON object"): 1, ('{"ts":1}', "no device id"): 1,
        ('{"common":{"mid":null},"ts":1}', "no device id"): 1, ('{"common":{"mid":"m"}}', "no time"): 1,
    }


def test_config_images(spark):
    def row(name):
        return {"source_table": name, "source_type": "ALL", "sink_table": "t", "sink_type": "dim"}

    lines = dumps([
        {"op": "r", "before": None, "after": row("a"), "ts_ms": 1}, {"op": "d", "before": row("b"), "after": None, "ts_ms": 2},
        {"op": "u", "before": row("old"), "after": row("c"), "ts_ms": 3, "seq": 9},
    ]) + ["{bad", "null", "[]"]
    rows = config_changes(lines_df(spark, lines))
    assert rows.columns == [*CONFIG_COLUMNS, "op", "ts_ms", "seq"]
    assert bag(rows.select("source_table", "op", "ts_ms", "seq")) == {("a", "r", 1, 0): 1, ("b", "d", 2, 1): 1, ("c", "u", 3, 9): 1}


def test_config_snapshot_reads_one_kind(spark, tmp_path):
    rows = [{"source_table": "a", "sink_type": "dim"}, {"source_table": "b", "sink_type": "dwd"}]
    folder = write_files(tmp_path / "config", dumps(rows))
    assert [r.source_table for r in config_snapshot(spark, "dim", "json", folder).collect()] == ["a"]


def test_file_dictionary(spark, tmp_path):
    folder = write_files(tmp_path / "dic", dumps([{"dic_code": "1", "dic_name": "one"}, {"dic_name": "no code"}]))
    assert bag(file_dictionary(spark, folder, "json")) == {("1", "one"): 1}


def test_facts_round_trip_as_json(spark):
    rows = spark.createDataFrame([("1", "u", None, None, 5), ("2", "u", "s", -3, None)],
                                 "id string, user_id string, sku_id string, sku_num int, ts bigint")
    lines = fact_values(rows)
    assert '"sku_id":null' in lines.where("value like '%\"1\"%'").first().value
    assert bag(parse_facts(lines, "cart_add")) == bag(rows)

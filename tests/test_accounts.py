"""Routes kept as a table, tables that follow renames, outputs that appear together, and rejects."""

import json
import os

import pytest
from logs import bag, dumps, lines_df, write_files

from tidemart import constants as C
from tidemart.schemas import CONFIG_COLUMNS, CONFIG_DDL
from tidemart.sinks.keyed import DimensionStore
from tidemart.sinks.messages import FileSink
from tidemart.sinks.routes import RouteStore
from tidemart.sources.config import config_changes, config_rejects, table_changes
from tidemart.sources.dictionary import read_dictionary
from tidemart.sources.topics import read_lines, split_facts
from tidemart.streaming import jobs
from tidemart.streaming.jobs import Run


def route(source, sink, kind="dim"):
    return {"source_table": source, "source_type": "ALL", "sink_table": sink, "sink_type": kind, "sink_columns": "id"}


def envelope(op, at, row=None, before=None):
    return {"op": op, "ts_ms": at, "before": row if op == "d" else before, "after": None if op == "d" else row}


def snapshot(spark, *rows):
    return spark.createDataFrame([tuple(r.get(c) for c in CONFIG_COLUMNS) for r in rows], CONFIG_DDL)


def sinks(df):
    return {(r.source_table, r.sink_table) for r in df.collect()}


def test_a_snapshot_in_mid_log_misses_nothing_and_counts_nothing_twice(spark):
    store = RouteStore("default.routes_a")
    assert store.routes(spark, "dim").count() == 0
    # Position 10 is noted, then changes come at 11 and 12, and the snapshot read sees the one at 11.
    store.begin(snapshot(spark, route("a", "new"), route("b", "old"), route("c", "kept")), ts_ms=10)
    log = [
        envelope("c", 5, route("a", "old")), envelope("c", 6, route("gone", "x")), envelope("d", 7, route("gone", "x")),
        envelope("u", 11, route("a", "new")), envelope("d", 12, route("b", "old")), envelope("c", 13, route("d", "made")),
    ]
    store.apply(config_changes(lines_df(spark, dumps(log[:4]))), "r1")
    store.apply(config_changes(lines_df(spark, dumps(log[4:]))), "r2")
    wanted = {("a", "new"), ("c", "kept"), ("d", "made")}
    assert sinks(store.routes(spark, "dim")) == wanted
    store.apply(config_changes(lines_df(spark, dumps(log[:4]))), "r1")
    store.table.compact(spark)
    assert sinks(store.routes(spark, "dim")) == wanted and store.routes(spark, "dwd").count() == 0
    store.table.drop(spark)


def test_routes_follow_a_stream_and_rejects_are_put_aside(spark, tmp_path):
    lines = dumps([envelope("c", 1, route("a", "x")), envelope("u", 2, route("a", "y"))])
    folder = write_files(tmp_path / "config", [*lines, "{bad", '{"op":"c"}', dumps([envelope("c", 3, route("b", "z"))])[0]], 5)
    store, rejects = RouteStore("default.routes_b"), FileSink(str(tmp_path / "rejects"))
    envelopes = read_lines(spark, folder, "text", maxFilesPerTrigger="2")
    jobs.start_routes(envelopes, store, Run(str(tmp_path / "c"), None), rejects).awaitTermination()
    assert sinks(store.routes(spark, "dim")) == {("a", "y"), ("b", "z")}
    assert {r.value for r in spark.read.text(f"{rejects.root}/{jobs.REJECTED}").collect()} == {"{bad", '{"op":"c"}'}
    store.table.drop(spark)


def test_config_lines_are_changes_or_rejects(spark):
    lines = [*dumps([envelope("c", 1, route("a", "x")), envelope("d", 2, route("a", "x"))]), "", "null", "[]", "{}", '{"op":"d","after":{}}', '{"op":5']
    df = lines_df(spark, lines).union(lines_df(spark, [None]))
    assert config_changes(df).count() == 2 and config_rejects(df).count() == 7


def test_a_renamed_sink_drops_the_former_table(spark):
    store = DimensionStore("dim_renamed")
    store.create(spark, "before")
    lines = dumps([envelope("u", 5, route("a", "after"), route("a", "before")), envelope("u", 6, route("b", "same"), route("b", "same"))])
    store.follow_config(table_changes(lines_df(spark, lines)))
    assert {t.name for t in spark.catalog.listTables("dim_renamed")} == {"after", "same"}
    store.create(spark, "before")
    store.follow_config(table_changes(lines_df(spark, lines)))
    assert spark.catalog.tableExists("dim_renamed.before"), "a replay drops nothing again"


def test_a_dictionary_that_is_not_there_yet_has_no_names(spark):
    assert read_dictionary(spark, DimensionStore("dim_not_there")).collect() == []


def test_facts_are_read_or_rejected(spark):
    lines = ['{"id":"1","sku_num":2,"ts":3}', '{"id":"2","ts":"x"}', "{}", "null", "", "[1]", "{bad"]
    rows, rejected = split_facts(lines_df(spark, lines), "cart_add")
    assert bag(rows.select("id", "ts")) == {("1", 3): 1, (None, None): 1} and rejected.count() == 5


@pytest.mark.parametrize("together", [False, True])
def test_outputs_and_rejected_elements_of_a_log(spark, tmp_path, together):
    records = [
        {"common": {"mid": "m1", "is_new": "1"}, "ts": 5, "start": {"a": 1}, "displays": [{"item": 1}, "x", None, 7], "action": [{"item": 2}]},
        {"common": {"mid": "m1", "is_new": "1"}, "ts": 6, "page": {"p": 1}, "err": {"e": 1}, "action": "none", "displays": None},
    ]
    folder = write_files(tmp_path / "log", dumps(records))
    sink, rejects = FileSink(str(tmp_path / "out")), FileSink(str(tmp_path / "rejects"))
    lines = read_lines(spark, folder, "text")
    jobs.start_log_split(lines, sink, Run(str(tmp_path / "c"), None), rejects=rejects, together=together).awaitTermination()
    counts = {}
    for name, topic in jobs.TOPICS.items():
        rows = sink.committed(spark, topic) if together else spark.read.text(f"{sink.root}/{topic}")
        counts[name] = rows.count()
    assert counts == {"start": 1, "display": 1, "action": 1, "err": 1, "page": 1}
    assert sorted(r.value for r in spark.read.text(f"{rejects.root}/{jobs.REJECTED}").collect()) == ['"none"', '"x"', "7", "null"]
    if together:
        # A run that was stopped before its mark shows none of its outputs, though some are written.
        run = next(n for n in os.listdir(sink.root) if n.startswith("run="))
        half = f"{sink.root}/run=half/topic={jobs.TOPICS['page']}"
        os.makedirs(half)
        with open(f"{half}/part-0.txt", "w") as file:
            file.write(json.dumps({"x": 1}) + "\n")
        assert sink.committed(spark, jobs.TOPICS["page"]).count() == 1
        assert os.path.exists(f"{sink.root}/{run}/_SUCCESS") and C.TOPIC_TRAFFIC_PAGE in jobs.TOPICS.values()


def test_one_pass_gives_what_five_passes_give(spark):
    from tidemart.operators.split import log_messages
    from tidemart.plans import traffic

    lines = lines_df(spark, dumps([
        {"common": {"mid": f"m{i % 3}", "is_new": str(i % 2), "ts": 9}, "ts": i, "start": {"a": i} if i % 2 else None, "page": {"p": i},
         "displays": [{"item": i, "mid": "own", "ts": 1}] * (i % 3), "action": [{"item": i, "ts": 4}, 5] if i % 4 else {}, "err": {"e": 1} if i % 5 == 0 else None, "x": i}
        for i in range(20)
    ]))
    for options in ({}, {"drop_displays": True, "action_key": "actions"}):
        five = traffic.split_log(lines, **options)
        tagged = log_messages(traffic.tagged_log(lines, **options))
        for name, rows in five.items():
            own = tagged.where(f"output = '{name}'").drop("output")
            assert bag(own) == bag(log_messages(rows)), name


def test_levels_keep_runs_few_and_look_ups_read_their_buckets(spark):
    from tidemart.sinks.keyed import level_of

    store = DimensionStore("dim_levels", buckets=4, fan=3)
    ddl = "sink_table string, row_key string, op_type string, data map<string,string>, ts bigint, seq bigint"

    def apply(n, *rows):
        store.apply(spark.createDataFrame([("t", k, op, {"id": k, "v": v}, n, 0) for k, op, v in rows], ddl), f"r{n:03d}")

    for n in range(11):
        apply(n, (f"k{n}", "insert", str(n)), ("same", "update", str(n)))
    table = store.table("t")
    levels = [level_of(r) for r in table.runs(spark)]
    assert max(levels) == 2 and len(levels) <= 2 + 1 + 2
    apply(11, ("k1", "delete", None), ("same", "update", None))
    apply(12, ("k1", "insert", None))
    rows = {r.row_key: r.data for r in store.rows(spark, "t").collect()}
    assert rows["same"] == {"id": "same", "v": "10"} and rows["k1"] == {"id": "k1"} and len(rows) == 12
    found = store.lookup(spark, "t", ["k3", "none"])
    assert [r.row_key for r in found.collect()] == ["k3"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "bucket" in plan.split("PartitionFilters: ", 1)[1].split("PushedFilters")[0]
    table.compact(spark)
    states = {r.row_key: r for r in table.read(spark).collect()}
    assert set(states["k1"].cells) == {"id"} and states["k1"].deleted_at.ts == 11
    # A run that is written again after the compaction brings nothing back.
    apply(1, ("k1", "insert", "1"), ("same", "update", "1"))
    assert {r.row_key: r.data for r in store.rows(spark, "t").collect()} == rows


def test_visitors_of_the_next_day_need_that_day_and_the_first_visits(spark):
    import random

    from tidemart.operators.visitors import ARRIVAL, SAME_DAY, VISITS_DDL, correct_next, correct_visitors, earliest_visits
    from tidemart.sinks.keyed import MergedTable

    rng = random.Random(4)
    day = 86_400_000
    rows = [(f"m{rng.randrange(12)}", rng.choice(["1", "1", "0", None]), d * day + rng.randrange(5) * 1_000, rng.randrange(3)) for d in range(4) for _ in range(25)]
    rows += rows[:10]
    records = spark.createDataFrame(rows, "mid string, is_new string, ts bigint, seq bigint")
    for mode in (ARRIVAL, SAME_DAY):
        table = MergedTable(f"default.first_visits_{mode}", VISITS_DDL, earliest_visits, "mid", 3)
        table.create(spark)
        found = []
        for d in (0, 1, 1, 2, 3):
            corrected, firsts = correct_next(records.where(f"ts div {day} = {d}"), table.read(spark), mode)
            found = [*found, corrected.collect()] if d != 1 or len(found) < 2 else [*found[:-1], corrected.collect()]
            table.write(firsts, f"d{d}")
        assert sum(map(bag_of, found), start=bag_of([])) == bag(correct_visitors(records, mode))


def bag_of(rows):
    from collections import Counter

    return Counter(map(tuple, rows))


def test_a_stored_log_is_parsed_no_more_and_its_keys_are_read_alone(spark, tmp_path):
    from tidemart.operators.visitors import VISITS_DDL
    from tidemart.plans import traffic
    from tidemart.sources.bronze import read_log, write_log
    from tidemart.sources.topics import parse_behaviour

    day = 86_400_000
    lines = lines_df(spark, dumps([
        {"common": {"mid": f"m{i % 4}", "is_new": "1", "n": 1.50}, "ts": i * day // 5, "page": {"p": i}, "displays": [{"item": i}], "x": None} for i in range(20)
    ]))
    path = str(tmp_path / "bronze")
    write_log(parse_behaviour(lines)[0], path)
    run = Run(str(tmp_path / "c"), None)
    folder = write_files(tmp_path / "lines", [r.value for r in lines.collect()], 2)
    jobs.start_log_bronze(read_lines(spark, folder, "text"), str(tmp_path / "streamed"), run).awaitTermination()
    keys = ["mid", "is_new", "ts"]
    assert bag(spark.read.parquet(str(tmp_path / "streamed")).select(*keys)) == bag(read_log(spark, path).select(*keys))
    known = spark.createDataFrame([], VISITS_DDL)
    tagged, firsts = traffic.tagged_day(read_log(spark, path, "1970-01-02"), known)
    assert {r.mid for r in firsts.collect()} == {"m0", "m1", "m2", "m3"} and tagged.count() == 10
    plan = tagged._jdf.queryExecution().executedPlan().toString()
    assert "parse_json" not in plan and "PartitionFilters: [isnotnull(day" in plan
    slim = firsts._jdf.queryExecution().executedPlan().toString()
    assert "doc" not in slim.split("ReadSchema", 1)[1]
    whole = traffic.tagged_log(lines)
    both, _ = traffic.tagged_day(read_log(spark, path), known)
    from tidemart.operators.split import log_messages

    assert bag(log_messages(both)) == bag(log_messages(whole))

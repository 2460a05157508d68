"""Streams give the rows batch runs give, however the log is cut into files."""

import json
import random
import re
from collections import Counter

import pytest
from logs import bag, changes_df, dumps, json_bag, write_files
from shop import DICTIONARY, FLUSH, HISTORY, T0

from tidemart import constants as C
from tidemart.operators.visitors import ARRIVAL, SAME_DAY, correct_visitors
from tidemart.plans import facts
from tidemart.schemas import FACT_COLUMNS
from tidemart.sinks.keyed import DimensionStore, newest_fact_table
from tidemart.sinks.messages import FileSink, fact_values
from tidemart.sources.bronze import read_bronze, write_bronze
from tidemart.sources.topics import parse_behaviour, parse_facts, read_changes, read_fact_lines, read_facts, read_lines, with_event_time
from tidemart.streaming import jobs
from tidemart.streaming.jobs import Run
from tidemart.streaming.visitors import correct_visitors_stream


@pytest.fixture(scope="module")
def dictionary(spark):
    return spark.createDataFrame(DICTIONARY, "dic_code string, dic_name string")


@pytest.fixture(scope="module")
def batch(spark, dictionary):
    """What batch runs give, flush rows included."""
    changes = changes_df(spark, HISTORY + FLUSH)
    details = with_event_time(facts.order_detail(changes))
    return {
        "order_detail": bag(details.drop("et")),
        "order_cancel": bag(facts.order_cancel(details, changes)),
        "payment_success": bag(facts.payment_success(details, changes, dictionary)),
        "order_refund": bag(facts.order_refund(changes, dictionary)),
        "refund_payment": bag(facts.refund_payment(changes, dictionary)),
        "comment": bag(facts.comment_info(changes, dictionary)),
        "cart_add": bag(facts.cart_add(changes)),
    }


def change_stream(spark, folder, per_trigger="1"):
    return read_changes(read_lines(spark, str(folder), "text", maxFilesPerTrigger=per_trigger))


def written(spark, sink, topic, fact):
    lines = spark.read.text(f"{sink.root}/{topic}")
    return bag(parse_facts(lines, fact).select(*FACT_COLUMNS[fact]))


def log_files(tmp_path, files):
    write_files(tmp_path / "log", dumps(HISTORY), files)
    return write_files(tmp_path / "log", dumps(FLUSH))


@pytest.mark.parametrize("files", [1, 5])
def test_order_detail_then_cancel_and_payment(spark, tmp_path, batch, dictionary, files):
    folder = log_files(tmp_path, files)
    out = str(tmp_path / "details")
    jobs.start_order_detail(
        change_stream(spark, folder), out, Run(str(tmp_path / "c4"), None), bound="60 seconds"
    ).awaitTermination()
    details = read_facts(spark, out, "order_detail", "parquet")
    assert bag(details.drop("et")) == batch["order_detail"]

    sink = FileSink(str(tmp_path / "facts"))
    stream = read_facts(spark, out, "order_detail", "parquet", streaming=True)
    jobs.start_order_cancel(stream, change_stream(spark, folder, "100"), sink, Run(str(tmp_path / "c5"), None)).awaitTermination()
    assert written(spark, sink, C.TOPIC_ORDER_CANCEL, "order_cancel") == batch["order_cancel"]

    stream = read_facts(spark, out, "order_detail", "parquet", streaming=True)
    jobs.start_payment_success(
        stream, change_stream(spark, folder, "100"), lambda _: dictionary, sink, Run(str(tmp_path / "c6"), None)
    ).awaitTermination()
    assert written(spark, sink, C.TOPIC_PAYMENT_SUCCESS, "payment_success") == batch["payment_success"]


def test_a_backlog_of_days_loses_nothing(spark, tmp_path):
    """Default bound, several files a day and table: day by day everything joins, also after a stop midway."""
    from shop import activity, coupon, detail, order

    from tidemart.sources.bronze import bronze_days, read_bronze, write_bronze

    rows = []
    for n in range(60):
        ts = T0 + 86_400 * (n % 6) + 40 * n
        rows += [order(f"o{n}", ts), detail(f"d{n}", f"o{n}", "s", ts + n % 4)]
        rows += [activity(f"d{n}", ts + 1)] * (n % 2) + [coupon(f"d{n}", ts + 2)] * (n % 3 == 0)
    changes = changes_df(spark, rows + FLUSH)
    bronze, out = str(tmp_path / "bronze"), str(tmp_path / "details")
    for part in (0, 1):
        write_bronze(changes.where(f"pmod(hash(data['id'], data['order_detail_id']), 2) = {part}"), bronze)
    assert len(bronze_days(spark, bronze)) >= 7
    run = Run(str(tmp_path / "c"), None)

    def start(day):
        return jobs.start_order_detail(read_bronze(spark, bronze, True, day=day), out, run)

    for day in bronze_days(spark, bronze)[:2]:
        start(day).awaitTermination()
    jobs.catch_up(spark, bronze, start)
    details = read_facts(spark, out, "order_detail", "parquet").drop("et")
    assert bag(details) == bag(facts.order_detail(changes).drop("et")) and details.count() == 60


def test_order_detail_upsert(spark, tmp_path, batch):
    folder = log_files(tmp_path, 3)
    table = newest_fact_table("default.details_by_id", "order_detail", ["id"], ["ts", "activity_id"])
    jobs.start_order_detail_upsert(
        change_stream(spark, folder), table, Run(str(tmp_path / "c"), None), bound="60 seconds"
    ).awaitTermination()
    assert bag(table.read(spark)) == batch["order_detail"]
    table.compact(spark)
    assert bag(table.read(spark)) == batch["order_detail"]


@pytest.mark.parametrize("files", [1, 4])
def test_refunds_comments_carts(spark, tmp_path, batch, dictionary, files):
    folder = log_files(tmp_path, files)
    sink = FileSink(str(tmp_path / "facts"))

    def load(_):
        return dictionary

    runs = [Run(str(tmp_path / f"c{i}"), None) for i in range(4)]
    for query in (
        jobs.start_order_refund(change_stream(spark, folder), load, sink, runs[0]),
        jobs.start_refund_payment(change_stream(spark, folder), load, sink, runs[1]),
        jobs.start_comment(change_stream(spark, folder), load, sink, runs[2]),
        jobs.start_cart_add(change_stream(spark, folder), sink, runs[3]),
    ):
        query.awaitTermination()
    assert written(spark, sink, C.TOPIC_ORDER_REFUND, "order_refund") == batch["order_refund"]
    assert written(spark, sink, C.TOPIC_REFUND_PAYMENT, "refund_payment") == batch["refund_payment"]
    assert written(spark, sink, C.TOPIC_COMMENT, "comment") == batch["comment"]
    assert written(spark, sink, C.TOPIC_CART_ADD, "cart_add") == batch["cart_add"]


def test_changes_beyond_the_bound_do_not_join(spark, tmp_path):
    from shop import detail, order

    rows = [order("near", T0), detail("d1", "near", "s", T0 + 4), order("far", T0), detail("d2", "far", "s", T0 + 9)]
    write_files(tmp_path / "log", dumps(rows))
    folder = write_files(tmp_path / "log", dumps(FLUSH))
    out = str(tmp_path / "details")
    jobs.start_order_detail(change_stream(spark, folder), out, Run(str(tmp_path / "c"), None)).awaitTermination()
    assert [r.id for r in spark.read.parquet(out).collect()] == ["d1"]


def test_a_quiet_table_does_not_hold_up_the_others(spark, tmp_path):
    from shop import detail, order

    rows = [order("o", T0), detail("d", "o", "s", T0)]
    write_files(tmp_path / "log", dumps(rows))
    folder = write_files(tmp_path / "log", dumps([detail("later", "none", "s", T0 + 10**6)]))
    out = str(tmp_path / "details")
    jobs.start_order_detail(change_stream(spark, folder), out, Run(str(tmp_path / "c"), None)).awaitTermination()
    assert [r.id for r in spark.read.parquet(out).collect()] == ["d"]
    assert spark.conf.get(jobs.WATERMARK_POLICY) == "min"


def test_details_from_their_topic(spark, tmp_path, batch):
    changes = changes_df(spark, HISTORY + FLUSH)
    FileSink(str(tmp_path)).write(fact_values(facts.order_detail(changes)), "details", "r")
    stream = read_fact_lines(read_lines(spark, str(tmp_path / "details"), "text"), "order_detail")
    folder = log_files(tmp_path, 1)
    sink = FileSink(str(tmp_path / "facts"))
    jobs.start_order_cancel(stream, change_stream(spark, folder), sink, Run(str(tmp_path / "c"), None)).awaitTermination()
    assert written(spark, sink, C.TOPIC_ORDER_CANCEL, "order_cancel") == batch["order_cancel"]


def test_bronze(spark, tmp_path, batch):
    bad = ["{bad", "[1]", "", "null"]
    folder = write_files(tmp_path / "log", dumps(HISTORY + FLUSH) + bad, 3)
    out, sink = str(tmp_path / "bronze"), FileSink(str(tmp_path / "rejects"))

    def lines():
        return read_lines(spark, folder, "text", maxFilesPerTrigger="1")

    jobs.start_bronze(lines(), out, Run(str(tmp_path / "c1"), None)).awaitTermination()
    jobs.start_change_rejects(lines(), sink, Run(str(tmp_path / "c2"), None)).awaitTermination()
    assert sorted(r.value for r in spark.read.text(f"{sink.root}/{jobs.REJECTED}").collect()) == sorted(bad)

    write_bronze(read_bronze(spark, out), str(tmp_path / "again"))
    for path in (out, str(tmp_path / "again")):
        stored = read_bronze(spark, path)
        assert bag(facts.order_detail(stored)) == batch["order_detail"]
        plan = facts.CANCEL.read(stored)._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"PartitionFilters: \[isnotnull\(table#\d+\), \(table#\d+ = order_info\)\]", plan)


def visit_line(mid, is_new, ts, **more):
    return json.dumps({"common": {"mid": mid, "is_new": is_new}, "ts": ts, "page": {"page_id": "p"}, **more})


DAY = 86_400_000


@pytest.mark.parametrize("mode", [ARRIVAL, SAME_DAY])
@pytest.mark.parametrize("files", [1, 3])
def test_log_split(spark, tmp_path, mode, files):
    from tidemart.plans.traffic import split_log

    lines = [visit_line(f"m{i % 7}", "1" if i % 3 else "0", DAY * (1 + i // 20) + i, n=i) for i in range(60)]
    lines += ["{bad", '{"ts":1}', visit_line("m1", "1", None)]
    folder = write_files(tmp_path / "log", lines, files)
    sink = FileSink(str(tmp_path / "out"))
    stream = read_lines(spark, folder, "text", maxFilesPerTrigger="1")
    jobs.start_log_split(stream, sink, Run(str(tmp_path / "c"), None), mode).awaitTermination()
    expected = split_log(read_lines(spark, folder, "text", streaming=False), mode)["page"]
    from tidemart.operators.split import log_messages

    assert json_bag(spark.read.text(f"{sink.root}/{C.TOPIC_TRAFFIC_PAGE}")) == json_bag(log_messages(expected))


def corrected_stream(spark, tmp_path, visits, mode, files, name):
    lines = [visit_line(mid, flag, ts, n=i) for i, (mid, flag, ts) in enumerate(visits)]
    folder = write_files(tmp_path / name, lines, files)
    records, _ = parse_behaviour(read_lines(spark, folder, "text", maxFilesPerTrigger="1"))
    out = str(tmp_path / f"{name}-out")
    Run(str(tmp_path / f"{name}-c"), None).start_files(correct_visitors_stream(records, mode), out).awaitTermination()
    got = spark.read.parquet(out).selectExpr("cast(get_json_object(value, '$.n') as int) n", "is_new").collect()
    return [flag for _, flag in sorted(tuple(r) for r in got)]


@pytest.mark.parametrize("mode", [ARRIVAL, SAME_DAY])
def test_visitors_in_disorder_within_a_batch(spark, tmp_path, mode):
    """Any order within one micro-batch, over several Arrow batches and devices."""
    rng = random.Random(7)
    visits = [(f"m{rng.randrange(5)}", rng.choice(["1", "1", "0", None]), DAY * rng.randint(1, 3) + i)
              for i in rng.sample(range(400), 400)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        got = corrected_stream(spark, tmp_path, visits, mode, 1, "log")
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    rows = [(m, f, t, i) for i, (m, f, t) in enumerate(visits)]
    batch = correct_visitors(spark.createDataFrame(rows, "mid string, is_new string, ts bigint, seq bigint"), mode)
    assert got == [r.is_new for r in batch.orderBy("seq").collect()]


@pytest.mark.parametrize("records", ["1000", "2"])
def test_repeated_lines_count_once(spark, tmp_path, records):
    """Equal lines in one Arrow batch or in several: one first record per device."""
    lines = [visit_line("a", "1", DAY)] * 7 + [visit_line("b", "1", DAY)] + [visit_line("c", "0", DAY)] * 3
    folder = write_files(tmp_path / "log", lines, 1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", records)
    try:
        parsed, _ = parse_behaviour(read_lines(spark, folder, "text"))
        out = str(tmp_path / "out")
        Run(str(tmp_path / "c"), None).start_files(correct_visitors_stream(parsed, ARRIVAL), out).awaitTermination()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    got = Counter((r.mid, r.is_new) for r in spark.read.parquet(out).select("mid", "is_new").collect())
    assert got == {("a", "1"): 1, ("a", "0"): 6, ("b", "1"): 1, ("c", "0"): 3}


def test_state_survives_a_restart(spark, tmp_path):
    folder = tmp_path / "log"
    run = Run(str(tmp_path / "c"), None)
    sink = FileSink(str(tmp_path / "out"))
    for lines in ([visit_line("a", "1", DAY)], [visit_line("a", "1", DAY + 1), visit_line("b", "1", DAY)]):
        write_files(folder, lines)
        jobs.start_log_split(read_lines(spark, str(folder), "text"), sink, run).awaitTermination()
    pages = [json.loads(r.value) for r in spark.read.text(f"{sink.root}/{C.TOPIC_TRAFFIC_PAGE}").collect()]
    assert sorted((p["common"]["mid"], p["ts"], p["common"]["is_new"]) for p in pages) == [
        ("a", DAY, "1"), ("a", DAY + 1, "0"), ("b", DAY, "1"),
    ]


def test_a_replayed_dimension_batch_changes_nothing(spark):
    store = DimensionStore("dim_replay")
    routed = spark.createDataFrame(
        [("dim_t", "k", "insert", {"a": "1"}, 1, 1), ("dim_t", "k", "delete", {}, 2, 2), ("dim_t", "j", "insert", {"a": "2"}, 1, 3)],
        "sink_table string, row_key string, op_type string, data map<string,string>, ts bigint, seq bigint",
    )
    late = routed.where("seq = 1")
    for changes, name in ((routed, "r1"), (routed, "r1"), (late, "r2"), (routed, "r3")):
        store.apply(changes, name)
    assert bag(store.read(spark, "dim_t", ["a"])) == {("j", "2"): 1}
    assert spark.table("dim_replay.dim_t").where("run = 'r1'").count() == 2


def test_dimensions_and_fact_router(spark, tmp_path):
    from logs import change

    config = spark.createDataFrame(
        [
            ("base_dic", "ALL", "dim_base_dic", "dim", "info", "dic_code, dic_name", "dic_code", None),
            ("user", "ALL", "dim_user", "dim", "info", "name,city", "id", None),
            ("coupon", "insert", "dwd_coupon_get", "dwd", None, "id,day", None, None),
        ],
        "source_table string, source_type string, sink_table string, sink_type string, sink_family string, "
        "sink_columns string, sink_row_key string, sink_extend string",
    )
    rows = [
        change("base_dic", "bootstrap-insert", {"dic_code": "1", "dic_name": "bootstrap-insert one", "x": "y"}, ts=1, seq=1),
        change("user", "insert", {"id": "a", "name": "Ann", "city": "Rome"}, ts=2, seq=2),
        change("user", "update", {"id": "a", "name": "Anna", "city": None}, {"name": "Ann"}, 3, 3),
        change("user", "insert", {"id": "b", "name": "Bob", "city": "Oslo"}, ts=3, seq=4),
        change("user", "delete", {"id": "b", "name": "Bob", "city": "Oslo"}, ts=4, seq=5),
        change("user", "insert", {"id": "c", "name": "Cy", "city": "Bonn"}, ts=4, seq=6),
        change("user", "delete", {"id": "c"}, ts=5, seq=7),
        change("user", "insert", {"id": "c", "name": "Cyd"}, ts=5, seq=8),
        change("user", "insert", {"name": "no key"}, ts=5, seq=9),
        change("coupon", "insert", {"id": "1", "day": None, "z": "1"}, ts=6, seq=10),
        change("coupon", "update", {"id": "1", "day": "2"}, {"day": "1"}, 7, 11),
    ]
    for files in (1, 4):
        base = tmp_path / str(files)
        folder = write_files(base / "log", dumps(rows), files)
        store = DimensionStore(f"dim_{files}")
        rejects = FileSink(str(base / "rejects"))
        jobs.start_dimensions(
            change_stream(spark, folder), lambda _: config, store, Run(str(base / "c0"), None), rejects=rejects
        ).awaitTermination()
        keyless = [json.loads(r.value) for r in spark.read.text(f"{rejects.root}/{jobs.REJECTED}").collect()]
        assert [(r["sink_table"], r["data"]) for r in keyless] == [("dim_user", {"name": "no key"})]
        assert bag(store.read(spark, "dim_user", ["name", "city"])) == {("a", "Anna", "Rome"): 1, ("c", "Cyd", None): 1}
        assert bag(store.dictionary(spark, C.DIM_DICTIONARY)) == {("1", "bootstrap-insert one"): 1}
        store.table("dim_user").compact(spark)
        assert bag(store.read(spark, "dim_user", ["name", "city"])) == {("a", "Anna", "Rome"): 1, ("c", "Cyd", None): 1}

        sink = FileSink(str(base / "facts"))
        jobs.start_fact_router(
            change_stream(spark, folder), lambda _: config, sink, Run(str(base / "c9"), None)
        ).awaitTermination()
        assert bag(spark.read.text(sink.root).select("topic", "value")) == Counter(
            {("dwd_coupon_get", '{"id":"1"}'): 1}
        )


def test_dimension_tables_follow_the_config(spark, tmp_path):
    def envelope(op, name, ts, sink_type="dim"):
        row = {"source_table": name, "source_type": "ALL", "sink_table": f"dim_{name}", "sink_type": sink_type,
               "sink_columns": "id", "sink_row_key": "id"}
        return {"op": op, "before" if op == "d" else "after": row, "ts_ms": ts}

    store = DimensionStore("dim_follow")
    rows = [envelope("r", "a", 1), envelope("c", "b", 2), envelope("c", "c", 3), envelope("d", "c", 4),
            envelope("c", "f", 5, "dwd")]
    folder = write_files(tmp_path / "config", dumps(rows))
    run = Run(str(tmp_path / "c"), None)
    jobs.start_dimension_tables(read_lines(spark, folder, "text"), store, run).awaitTermination()

    def tables():
        return {t.name for t in spark.catalog.listTables("dim_follow")}

    assert tables() == {"dim_a", "dim_b"}
    state = spark.sql("select 'k' row_key, null deleted_at, map('id', struct(1L ts, 1L seq, 'k' value)) cells")
    store.table("dim_a").write(state, "x")
    store.table("dim_b").write(state, "x")
    write_files(tmp_path / "config", dumps([envelope("u", "a", 6), envelope("r", "b", 7)]))
    jobs.start_dimension_tables(read_lines(spark, folder, "text"), store, run).awaitTermination()
    assert tables() == {"dim_a", "dim_b"}
    assert store.rows(spark, "dim_a").count() == 0
    assert store.rows(spark, "dim_b").count() == 1
    # The same changes again, under a new checkpoint: what was written since stays.
    store.table("dim_a").write(state, "y")
    jobs.start_dimension_tables(read_lines(spark, folder, "text"), store, Run(str(tmp_path / "c2"), None)).awaitTermination()
    assert tables() == {"dim_a", "dim_b"}
    assert store.rows(spark, "dim_a").count() == 1
    assert store.rows(spark, "dim_b").count() == 1


def test_log_rejects(spark, tmp_path):
    folder = write_files(tmp_path / "log", ["{bad", visit_line("m", "1", 1), '{"ts":1}'])
    sink = FileSink(str(tmp_path / "out"))
    jobs.start_log_rejects(read_lines(spark, folder, "text"), sink, Run(str(tmp_path / "c"), None)).awaitTermination()
    assert sorted(r.value for r in spark.read.text(f"{sink.root}/rejected").collect()) == ["{bad", '{"ts":1}'][::-1]

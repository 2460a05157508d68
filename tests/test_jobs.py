"""The command line runs a chain of jobs over files."""

import pytest
from logs import bag, dumps, write_files
from shop import DICTIONARY, FLUSH, HISTORY

from tidemart import constants as C
from tidemart import jobs
from tidemart.sources.topics import parse_facts


def test_every_job_has_an_entry():
    assert set(jobs.JOBS) == {
        "bronze", "log_bronze", "change_rejects", "dimensions", "routes", "dimension_tables", "log_split", "log_rejects", "comment", "cart_add", "order_detail",
        "order_detail_updating", "order_cancel", "order_cancel_complete", "payment_success", "order_refund", "refund_payment", "fact_router",
    }


def test_settings_that_do_not_go_together():
    base = ["order_detail", "--source", "s", "--out", "o", "--checkpoint", "c"]
    for more in (["--in-order"], ["--by-day"], ["--in-order", "--format", "bronze", "--read", "maxFilesPerTrigger=1"]):
        with pytest.raises(SystemExit):
            jobs.main([*base, *more])


def test_unknown_job():
    with pytest.raises(SystemExit):
        jobs.parser().parse_args(["nothing", "--source", "x", "--checkpoint", "y"])


def test_join_settings_reach_the_jobs(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(jobs, "read_bronze", lambda *a, **o: seen.update(delay=a[3], options=o))
    monkeypatch.setattr(jobs.jobs, "start_order_detail", lambda *a, **o: seen.update(o))
    args = jobs.parser().parse_args(
        ["order_detail", "--source", "s", "--format", "bronze", "--out", "o", "--checkpoint", "c", "--bound", "2 days",
         "--delay", "1 hour", "--salts", "7", "--read", "maxFilesPerTrigger=3"]
    )
    jobs.JOBS["order_detail"](jobs.Inputs(spark, args))
    assert seen == {"delay": "1 hour", "options": {"maxFilesPerTrigger": "3"}, "bound": "2 days", "salts": 7}


def test_compact_command(spark):
    from tidemart.sinks.keyed import newest_fact_table

    table = newest_fact_table("default.compacted_details", "order_detail", ["id"], ["ts", "activity_id"])
    table.create(spark)
    schema = spark.table(table.name).drop("run").schema
    for run in ("r1", "r2", "r3"):
        table.write(spark.createDataFrame([{"id": run, "ts": 1}, {"id": "x", "ts": int(run[1])}], schema), run)
    jobs.main(["compact", "--upsert-table", table.name])
    assert len(spark.sql(f"SHOW PARTITIONS {table.name}").collect()) == 1
    assert {(r.id, int(r.ts)) for r in table.read(spark).collect()} == {("r1", 1), ("r2", 1), ("r3", 1), ("x", 3)}
    table.drop(spark)
    with pytest.raises(SystemExit):
        jobs.main(["order_detail", "--out", "x"])


def test_chain(spark, tmp_path):
    base = str(tmp_path)
    write_files(tmp_path / "log", dumps(HISTORY))
    log = write_files(tmp_path / "log", dumps(FLUSH))
    config = [
        {"source_table": "base_dic", "source_type": "ALL", "sink_table": C.DIM_DICTIONARY, "sink_type": "dim",
         "sink_columns": "dic_code,dic_name", "sink_row_key": "dic_code"},
        {"source_table": "cart_info", "source_type": "insert", "sink_table": "dwd_cart", "sink_type": "dwd", "sink_columns": "id"},
    ]
    dictionary = [
        {"database": C.DATABASE, "table": "base_dic", "type": "insert", "data": {"dic_code": c, "dic_name": n}, "ts": 1, "seq": i}
        for i, (c, n) in enumerate(DICTIONARY)
    ]
    dic_log = write_files(tmp_path / "dic", dumps(dictionary))
    conf = write_files(tmp_path / "config", dumps(config))
    changed = write_files(tmp_path / "config_changes", dumps([
        {"op": "u", "after": {**config[1], "sink_columns": "id,sku_id"}, "ts_ms": 5},
    ]))

    def run(job, source, *more, fmt="text"):
        name = f"{base}/ck/{job}{'-in-order' if '--in-order' in more else ''}"
        jobs.main([job, "--source", source, "--format", fmt, "--checkpoint", name, "--once", *more])

    routes = ["--config", conf, "--config-format", "json", "--config-changes", changed]
    dims = ["--dim-schema", "dim_cli", "--dim-location", f"{base}/dim"]
    run("bronze", log, "--out", f"{base}/bronze")
    run("dimensions", dic_log, *routes, *dims)
    run("order_detail", f"{base}/bronze", "--out", f"{base}/details", fmt="bronze")
    run("order_detail", f"{base}/bronze", "--out", f"{base}/details_in_order", "--in-order", "--flush", "400", "--span", "day", fmt="bronze")
    assert bag(spark.read.parquet(f"{base}/details_in_order").drop("day")) == bag(spark.read.parquet(f"{base}/details"))
    run("payment_success", log, "--out", f"{base}/facts", "--details", f"{base}/details", *dims)
    run("cart_add", log, "--out", f"{base}/facts")
    run("fact_router", log, "--out", f"{base}/routed", *routes)
    kept = ["--routes-table", "default.cli_routes"]
    run("routes", changed, "--config", conf, "--config-format", "json", "--rejects", f"{base}/rejects", *kept)
    jobs.main(["fact_router", "--source", log, "--format", "text", "--checkpoint", f"{base}/ck/kept", "--once", "--out", f"{base}/routed_kept", *kept])
    assert bag(spark.read.text(f"{base}/routed_kept").select("topic", "value")) == bag(spark.read.text(f"{base}/routed").select("topic", "value"))

    assert spark.read.parquet(f"{base}/details").count() == 5
    paid = parse_facts(spark.read.text(f"{base}/facts/{C.TOPIC_PAYMENT_SUCCESS}"), "payment_success")
    assert {r.payment_type_name for r in paid.collect()} == {"card"} and paid.count() == 2
    assert spark.read.text(f"{base}/facts/{C.TOPIC_CART_ADD}").count() == 3
    assert bag(spark.read.text(f"{base}/routed").select("topic", "value")) == {
        ("dwd_cart", '{"id":"b1","sku_id":"s1"}'): 1, ("dwd_cart", '{"id":"b3","sku_id":"s1"}'): 1,
    }

"""Queries by name; each takes a session and a table folder."""

import uuid
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.adapters import star_schema as star
from tidemart.adapters.star_schema import Tables
from tidemart.functions import times
from tidemart.operators import changes as ops
from tidemart.operators.merge import dimension_table, live_rows, merge_changes, newest_rows
from tidemart.operators.routing import current_config, route_dimensions
from tidemart.operators.split import (
    ACTION, DISPLAY, ERR, PAGE, START, log_messages, rejected_elements,
)
from tidemart.operators.visitors import ARRIVAL, SAME_DAY, VISITS_DDL, correct_next, correct_visitors, earliest_visits
from tidemart.plans import facts, routing, traffic
from tidemart.session import configure, shared_dir
from tidemart.sinks.keyed import DimensionStore, MergedTable
from tidemart.sinks.messages import fact_values
from tidemart.sinks.routes import as_of
from tidemart.sources.bronze import LOG_DDL, write_log
from tidemart.sources.config import config_changes, config_rejects
from tidemart.sources.topics import parse_behaviour, parse_changes, parse_facts, split_facts, with_event_time

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}

_DETAIL_TABLES = ("order_detail", "order_info", "order_detail_activity", "order_detail_coupon")


def query(fn: Callable[[Tables], DataFrame], streaming: bool = False) -> Query:
    """Register a query under its function's name."""

    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(Tables(configure(spark), sf_dir, streaming))

    _QUERIES[fn.__name__] = run
    return run


def queries() -> dict[str, Query]:
    from tidemart.checks import streams  # noqa: F401  (registers the streaming queries)

    return dict(_QUERIES)


@query
def order_detail(tables):
    return facts.order_detail(star.order_changes(tables, *_DETAIL_TABLES))


@query
def order_detail_salted(tables):
    return facts.order_detail(star.order_changes(tables, *_DETAIL_TABLES), salts=4)


@query
def order_detail_newest(tables):
    """The upsert sink's content after writing details and their later corrections."""
    details = facts.order_detail_by_id(star.order_changes(tables, *_DETAIL_TABLES))
    # Written side by side, so that the details are joined once; they stay partitioned by id.
    with_later = F.when(F.col("coupon_id").isNotNull(), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    both = details.withColumn("later", F.explode(with_later)).withColumns({
        "ts": F.col("ts") + 60 * F.col("later"),
        "coupon_id": F.when(F.col("later") == 1, F.concat("coupon_id", F.lit("-corrected"))).otherwise(F.col("coupon_id")),
    }).drop("later")
    return newest_rows(both, ["id"], ["ts", "activity_id"])


@query
def order_cancel(tables):
    changes = star.order_changes(tables, *_DETAIL_TABLES)
    # Details of other orders would be shuffled to the cancels for nothing.
    details = facts.order_detail(changes, among=facts.cancelled_orders(changes))
    return facts.order_cancel(with_event_time(details), changes)


@query
def payment_success(tables):
    return facts.payment_success(
        star.click_details(tables), star.event_changes(tables, "payment_info"), star.dictionary(tables)
    )


@query
def payment_success_6h(tables):
    return facts.payment_success(
        star.click_details(tables), star.event_changes(tables, "payment_info"), star.dictionary(tables),
        before=6 * 3600, after=5, salts=3,
    )


@query
def order_refund(tables):
    return facts.order_refund(star.order_changes(tables, "order_refund_info", "order_info"), star.dictionary(tables))


@query
def refund_payment(tables):
    return facts.refund_payment(star.order_changes(tables, "refund_payment", "order_refund_info", "order_info"), star.dictionary(tables))


@query
def comment_lookup(tables):
    return facts.comment_info(star.comment_changes(tables), star.dictionary(tables))


@query
def cart_add(tables):
    return facts.cart_add(star.event_changes(tables, "cart_info"))


@query
def cart_add_from_json(tables):
    """Cart changes parsed from JSON lines, written as JSON facts and read back."""
    changes, _ = parse_changes(star.change_lines(tables))
    lines = fact_values(facts.cart_add(with_event_time(changes)))
    return parse_facts(lines, "cart_add")


@query
def cart_add_messages(tables):
    """The JSON text of cart facts, nulls included."""
    return fact_values(facts.cart_add(star.event_changes(tables, "cart_info")))


@query
def change_quarantine(tables):
    _, rejected = parse_changes(star.change_lines(tables))
    return rejected


@query
def change_validity(tables):
    """How many changes of each table and kind dimensions and routed facts accept."""
    changes = star.shop_changes(tables).drop("et").unionByName(star.dimension_log(tables))

    def tally(df: DataFrame, what: str) -> DataFrame:
        return df.groupBy("table", "type").agg(F.count(F.lit(1)).alias("n")).withColumn("accepted_by", F.lit(what))

    return tally(ops.dimension_changes(changes), "dim").unionByName(tally(ops.fact_changes(changes), "fact"))


@query
def dim_merge(tables):
    """Every live cell of every dimension."""
    rows = routing.dimension_rows(star.dimension_log(tables), star.routing_config(tables.spark))
    return rows.select("sink_table", "row_key", F.explode("data").alias("name", "value"))


@query
def dim_customer(tables):
    """The customer dimension as a table."""
    config = star.routing_config(tables.spark)
    routed = route_dimensions(star.dimension_log(tables), config)
    rows = live_rows(merge_changes(routed))
    return dimension_table(rows, "dim_customer", ["id", "name", "acctbal", "segment"])


@query
def fact_route(tables):
    return routing.routed_facts(star.dimension_log(tables), star.routing_config(tables.spark))


@query
def config_state(tables):
    changes = config_changes(star.config_envelopes(tables))
    return current_config(changes, "dim", star.config_start(tables))


@query
def new_visitor(tables):
    return correct_visitors(star.visits(tables), ARRIVAL)


@query
def new_visitor_same_day(tables):
    return correct_visitors(star.visits(tables), SAME_DAY)


def _by_week(tables: Tables, mode: str) -> DataFrame:
    """Visits corrected week by week, with the first visits kept in a table."""
    spark, name = tables.spark, uuid.uuid4().hex[:12]
    folder = f"{shared_dir(spark)}/visits-{name}"
    store = MergedTable(f"default.first_visits_{name}", VISITS_DDL, earliest_visits, "mid", 4)
    store.create(spark)
    week = F.date_trunc("week", F.timestamp_millis("ts")).cast("date")
    star.visits(tables).withColumn("week", week).write.partitionBy("week").parquet(f"{folder}/log")
    log = spark.read.parquet(f"{folder}/log")
    for part in sorted(r.week for r in log.select("week").distinct().collect()):
        corrected, firsts = correct_next(log.where(F.col("week") == F.lit(part)).drop("week"), store.read(spark), mode)
        corrected.write.parquet(f"{folder}/out/week={part}")
        store.write(firsts, str(part))
        store.compact(spark, 4)
    return spark.read.parquet(f"{folder}/out").drop("week")


@query
def new_visitor_weekly(tables):
    return _by_week(tables, ARRIVAL)


@query
def new_visitor_same_day_weekly(tables):
    return _by_week(tables, SAME_DAY)


@query
def dim_compacted(tables):
    """The customer dimension after runs by time, compacted by levels on the way and wholly at the end."""
    spark = tables.spark
    store = DimensionStore(f"dim_{uuid.uuid4().hex[:12]}", buckets=4, fan=2)
    routed = route_dimensions(star.dimension_log(tables), star.routing_config(spark))
    for at in (300, 100, 200):
        store.apply(routed.where(F.col("ts") == at), f"run-{at}")
    table = store.table("dim_customer")
    table.compact(spark)
    dead = table.read(spark).where("exists(map_values(cells), c -> struct(c.ts, c.seq) < deleted_at)")
    gone = F.lit(dead.count() == 0 and len(table.runs(spark)) == 1)
    return store.read(spark, "dim_customer", ["id", "name", "acctbal", "segment"]).where(gone)


def log_output(tables: Tables, output: str, paths: dict[str, str], absent: list[str] = ()) -> DataFrame:
    """Fields of one output, read from the JSON text that is written."""
    written = log_messages(traffic.split_log(star.log_lines(tables))[output])
    return log_fields(written, paths, absent)


def log_fields(written: DataFrame, paths: dict[str, str], absent: list[str] = ()) -> DataFrame:
    return written.select(
        *[F.get_json_object("value", path).alias(name) for name, path in paths.items()],
        *[F.get_json_object("value", f"$.{key}").isNotNull().cast("int").alias(f"has_{key}") for key in absent],
    )


COMMON_PATHS = {"mid": "$.common.mid", "is_new": "$.common.is_new", "ch": "$.common.ch", "event": "$.event", "ts": "$.ts"}
FLAT_PATHS = {"mid": "$.mid", "is_new": "$.is_new", "ch": "$.ch", "item": "$.item", "ts": "$.ts"}


@query
def log_start(tables):
    paths = {**COMMON_PATHS, "entry": "$.start.entry", "loading": "$.start.loading"}
    return log_output(tables, START, paths, ["displays", "action", "err"])


@query
def log_display(tables):
    return log_output(tables, DISPLAY, {**FLAT_PATHS, "pos": "$.pos"})


@query
def log_action(tables):
    return log_output(tables, ACTION, {**FLAT_PATHS, "action_id": "$.action_id"})


@query
def log_err(tables):
    paths = {**COMMON_PATHS, "code": "$.err.code"}
    return log_output(tables, ERR, paths, ["displays", "action", "page"])


@query
def log_page(tables):
    paths = {**COMMON_PATHS, "page_id": "$.page.page_id"}
    return log_output(tables, PAGE, paths, ["displays", "action", "err"])


def output_counts(written: DataFrame) -> DataFrame:
    """How many messages each device has in each output, new and not."""
    device = F.coalesce(F.get_json_object("value", "$.common.mid"), F.get_json_object("value", "$.mid"))
    is_new = F.coalesce(F.get_json_object("value", "$.common.is_new"), F.get_json_object("value", "$.is_new"))
    return written.groupBy("output", device.alias("mid"), is_new.alias("is_new")).agg(F.count(F.lit(1)).alias("n"))


@query
def log_outputs(tables):
    """All five outputs from one pass."""
    return output_counts(log_messages(traffic.tagged_log(star.log_lines(tables))))


@query
def log_outputs_daily(tables):
    """The log parsed once into bronze, then worked off week by week: each reads its days and the first visits, in one pass."""
    spark, name = tables.spark, uuid.uuid4().hex[:12]
    folder = f"{shared_dir(spark)}/log-{name}"
    store = MergedTable(f"default.first_visits_{name}", VISITS_DDL, earliest_visits, "mid", 4)
    store.create(spark)
    records, _ = parse_behaviour(star.log_lines(tables))
    write_log(records, f"{folder}/bronze")
    days = [str(r.day) for r in spark.read.schema(LOG_DDL).parquet(f"{folder}/bronze").select("day").distinct().collect()]
    weeks = sorted({day[:4] + day[5:7] + str((int(day[8:]) - 1) // 7) for day in days})
    of_week = F.concat(F.date_format("day", "yyyyMM"), ((F.dayofmonth("day") - 1) / 7).cast("int").cast("string"))
    for week in weeks:
        part = spark.read.schema(LOG_DDL).parquet(f"{folder}/bronze").where(of_week == week).drop("day")
        tagged, firsts = traffic.tagged_day(part, store.read(spark))
        log_messages(tagged).write.partitionBy("output").parquet(f"{folder}/out/week={week}")
        store.write(firsts, week)
    return output_counts(spark.read.parquet(f"{folder}/out").select("output", "value"))


@query
def element_quarantine(tables):
    """List elements that are no objects, and values that are no lists."""
    records, _ = parse_behaviour(star.odd_log_lines(tables))
    return rejected_elements(records)


@query
def config_quarantine(tables):
    """Config lines that are no changes."""
    return config_rejects(star.odd_config_lines(tables))


@query
def fact_quarantine(tables):
    """Lines of a fact topic that are no such facts, beside those that are, counted."""
    facts_of, rejected = split_facts(star.odd_cart_lines(tables), "cart_add")
    kept = facts_of.selectExpr("'kept' as kind", "id as value")
    return kept.unionByName(rejected.selectExpr("'rejected' as kind", "value"))


@query
def config_handover(tables):
    """Routes from a snapshot read in mid-log and the changes from the position noted before it was read."""
    changes = config_changes(star.config_envelopes(tables))
    snapshot = current_config(changes.where("ts_ms <= 2"), "dim")
    log = changes.where("ts_ms > 1")
    return current_config(log.unionByName(as_of(snapshot, 1, 1)), "dim")


@query
def log_quarantine(tables):
    _, rejected = parse_behaviour(star.log_lines(tables))
    return rejected


@query
def date_ids(tables):
    """Event times as day and text, and the text read back at a fixed offset."""
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    text = times.datetime_of_millis(ms)
    return tables("events").select(
        "event_id",
        times.day_of_millis(ms).alias("day"),
        text.alias("text"),
        times.millis_of_text(text).alias("millis"),
        F.date_format(times.event_time(F.floor(ms / 1000)), times.DATETIME_FORMAT).alias("event_time"),
        times.day_of_text(F.when(F.col("event_type") == "error", "junk").otherwise(text)).alias("day_of_text"),
    )

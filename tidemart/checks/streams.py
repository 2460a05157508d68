"""Streaming runs over the same tables; their results equal those of the batch queries.

Each call runs a job on all there is and stops, with checkpoint and outputs in a
folder of its own under the shared folder.
"""

import uuid
from dataclasses import replace
from functools import wraps

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart import constants as C
from tidemart.adapters import star_schema as star
from tidemart.adapters.star_schema import Tables
from tidemart.checks.registry import COMMON_PATHS, FLAT_PATHS, log_fields, output_counts, query
from tidemart.operators.split import ACTION, DISPLAY, PAGE
from tidemart.operators.visitors import ARRIVAL, SAME_DAY
from tidemart.plans import facts
from tidemart.schemas import FACT_COLUMNS, fact_schema
from tidemart.session import shared_dir
from tidemart.sinks.keyed import DimensionStore, newest_fact_table
from tidemart.sinks.messages import FileSink
from tidemart.sinks.routes import RouteStore
from tidemart.sources.bronze import read_bronze, write_bronze
from tidemart.sources.log_order import LogTables, in_order
from tidemart.sources.topics import parse_facts, read_lines, with_event_time
from tidemart.streaming import jobs
from tidemart.streaming.jobs import Run
from tidemart.streaming.visitors import correct_visitors_stream

# Order and ship dates of these tables lie years apart.
WIDE_BOUND = "4000 days"
FAR_FUTURE = "4102444800"
# Longer than any span of time by which bronze is partitioned here.
FLUSH_DAYS = 400


STATE_PARTITIONS_PER_CORE = 4


def stream_query(fn):
    """Register a streaming run, with no more state partitions than the cores can use."""

    @wraps(fn)
    def run(tables: Tables) -> DataFrame:
        conf = tables.spark.conf
        before = conf.get("spark.sql.shuffle.partitions")
        most = STATE_PARTITIONS_PER_CORE * tables.spark.sparkContext.defaultParallelism
        conf.set("spark.sql.shuffle.partitions", str(min(int(before), most)))
        try:
            return fn(tables)
        finally:
            conf.set("spark.sql.shuffle.partitions", before)

    return query(run, streaming=True)


class Workspace:
    """A fresh folder for one run."""

    def __init__(self, tables: Tables) -> None:
        self.spark = tables.spark
        self.name = uuid.uuid4().hex[:12]
        self.folder = f"{shared_dir(tables.spark)}/run-{self.name}"
        self.sink = FileSink(f"{self.folder}/out")
        self.run = Run(f"{self.folder}/checkpoint", None)
        self.batch = Tables(tables.spark, tables.folder)

    def steps(self, name: str) -> Run:
        """A run that takes one step of its source after the other."""
        return Run(f"{self.folder}/checkpoint-{name}", "0 seconds")

    def in_order(self, bronze: str) -> LogTables:
        return LogTables(self.spark, bronze, f"{self.folder}/progress-{uuid.uuid4().hex[:8]}", flush=FLUSH_DAYS)

    def facts_in_order(self, path: str, fact: str) -> DataFrame:
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fact_schema(fact))
        return in_order(self.spark, path, f"{self.folder}/progress-{uuid.uuid4().hex[:8]}", ddl, flush=FLUSH_DAYS)

    def dictionary(self, _) -> DataFrame:
        return star.dictionary(self.batch)

    def config(self, _) -> DataFrame:
        return star.routing_config(self.spark)

    def lines(self, topic: str) -> DataFrame:
        return self.spark.read.schema("value string, run string").text(f"{self.sink.root}/{topic}").select("value")

    def fact(self, topic: str, fact: str) -> DataFrame:
        return parse_facts(self.lines(topic), fact).select(*FACT_COLUMNS[fact])


@stream_query
def stream_payment_success(tables):
    work = Workspace(tables)
    jobs.start_payment_success(
        star.click_details(tables), star.event_changes(tables, "payment_info"), work.dictionary, work.sink, work.run
    ).awaitTermination()
    return work.fact(C.TOPIC_PAYMENT_SUCCESS, "payment_success")


@stream_query
def stream_order_detail(tables):
    """Details from bronze. Changes far in the future, added last, bring out details without optional sides."""
    work = Workspace(tables)
    bronze, details = f"{work.folder}/bronze", f"{work.folder}/details"
    names = ("order_detail", "order_info", "order_detail_activity", "order_detail_coupon")
    write_bronze(star.order_changes(work.batch, *names), bronze, by=("table",))
    last = work.spark.range(1)
    end = star.union(
        star.change(last, name, "insert", {"id": "'end'", "order_detail_id": "'end'"}, ts=FAR_FUTURE) for name in names
    )
    for more in (None, end):
        if more is not None:
            write_bronze(more, bronze, by=("table",))
        jobs.start_order_detail(
            read_bronze(work.spark, bronze, streaming=True), details, work.run, bound=WIDE_BOUND
        ).awaitTermination()
    return work.spark.read.parquet(details)


def _placed(work: Workspace, span: str, windows: int = 1) -> LogTables:
    """Bronze of placed orders, to be read in the order of the log."""
    bronze = f"{work.folder}/bronze"
    write_bronze(star.placed_changes(work.batch), bronze, span=span)
    return replace(work.in_order(bronze), windows=windows)


def _details(work: Workspace, changes: LogTables, span: str) -> str:
    path = f"{work.folder}/details"
    jobs.drain(jobs.start_order_detail(changes, path, work.steps("details"), span=span))
    return path


@stream_query
def stream_order_detail_backlog(tables):
    """Years of orders in one query, a year per micro-batch, joined within the default five seconds."""
    work = Workspace(tables)
    details = _details(work, _placed(work, "year"), "year")
    return work.spark.read.parquet(details).select(*FACT_COLUMNS["order_detail"])


@stream_query
def stream_order_detail_updating(tables):
    """The newest version of every detail; versions appear as soon as the order is there."""
    work = Workspace(tables)
    table = newest_fact_table(f"default.details_{work.name}", "order_detail", ["id"], ["ts", "version"], "version int")
    jobs.drain(jobs.start_order_detail_updating(_placed(work, "year", 3), table, work.steps("updating")))
    return table.read(work.spark).select(*FACT_COLUMNS["order_detail"])


@stream_query
def stream_order_cancel(tables):
    """Cancels within the default bound, over the folder that the order-detail stream writes."""
    work = Workspace(tables)
    changes = _placed(work, "year")
    details = work.facts_in_order(_details(work, changes, "year"), "order_detail")
    jobs.drain(jobs.start_order_cancel(details, work.in_order(changes.path), work.sink, work.steps("cancel")))
    return work.fact(C.TOPIC_ORDER_CANCEL, "order_cancel")


@stream_query
def stream_order_cancel_complete(tables):
    """What became of every detail and of every cancel that came late: those of every tenth order come after all else."""
    work = Workspace(tables)
    bronze, path = f"{work.folder}/bronze", f"{work.folder}/details"
    placed = star.placed_changes(work.batch)
    is_late = (F.col("type") == "update") & (F.col("data")["id"].cast("bigint") % 10 == 0)
    write_bronze(placed.where(~is_late), bronze, span="year")
    details = facts.order_detail(with_event_time(placed))
    details.withColumn("day", F.to_date(F.date_trunc("year", F.timestamp_seconds("ts")))).write.partitionBy("day").parquet(path)
    query = jobs.start_order_cancel_complete(
        work.facts_in_order(path, "order_detail"), work.in_order(bronze), work.sink, work.steps("cancel")
    )
    try:
        query.processAllAvailable()
        write_bronze(placed.where(is_late), bronze, span="year")
    finally:
        jobs.drain(query)
    joined = work.fact(C.TOPIC_ORDER_CANCEL, "order_cancel").selectExpr("'joined' kind", "'main' side", "id")
    left = work.lines(jobs.LEFT_OVER).select(F.from_json("value", "kind string, side string, detail string, cancel string").alias("r")).select("r.*")
    key = F.coalesce(F.get_json_object("detail", "$.id"), F.get_json_object("cancel", "$.oc_id"))
    return joined.union(left.select("kind", "side", key))


@stream_query
def stream_order_refund(tables):
    work = Workspace(tables)
    changes = star.order_changes(tables, "order_refund_info", "order_info")
    jobs.start_order_refund(changes, work.dictionary, work.sink, work.run, bound=WIDE_BOUND).awaitTermination()
    return work.fact(C.TOPIC_ORDER_REFUND, "order_refund")


@stream_query
def stream_refund_payment(tables):
    work = Workspace(tables)
    changes = star.order_changes(tables, "refund_payment", "order_refund_info", "order_info")
    jobs.start_refund_payment(changes, work.dictionary, work.sink, work.run, bound=WIDE_BOUND).awaitTermination()
    return work.fact(C.TOPIC_REFUND_PAYMENT, "refund_payment")


@stream_query
def stream_comment_lookup(tables):
    work = Workspace(tables)
    jobs.start_comment(star.comment_changes(tables), work.dictionary, work.sink, work.run).awaitTermination()
    return work.fact(C.TOPIC_COMMENT, "comment")


@stream_query
def stream_cart_add(tables):
    work = Workspace(tables)
    jobs.start_cart_add(star.event_changes(tables, "cart_info"), work.sink, work.run).awaitTermination()
    return work.fact(C.TOPIC_CART_ADD, "cart_add")


def _split(tables: Tables) -> Workspace:
    work = Workspace(tables)
    jobs.start_log_split(star.log_lines(tables), work.sink, work.run).awaitTermination()
    return work


@stream_query
def stream_log_page(tables):
    paths = {**COMMON_PATHS, "page_id": "$.page.page_id"}
    return log_fields(_split(tables).lines(C.TOPIC_TRAFFIC_PAGE), paths, ["displays", "action", "err"])


@stream_query
def stream_log_display(tables):
    return log_fields(_split(tables).lines(C.TOPIC_TRAFFIC_DISPLAY), {**FLAT_PATHS, "pos": "$.pos"})


@stream_query
def stream_log_action(tables):
    return log_fields(_split(tables).lines(C.TOPIC_TRAFFIC_ACTION), {**FLAT_PATHS, "action_id": "$.action_id"})


@stream_query
def stream_log_outputs(tables):
    """All five outputs of a stream that writes them together, read from its committed runs."""
    work = Workspace(tables)
    jobs.start_log_split(star.log_lines(tables), work.sink, work.run, together=True).awaitTermination()
    parts = [work.sink.committed(work.spark, topic).withColumn("output", F.lit(name)) for name, topic in jobs.TOPICS.items()]
    return output_counts(star.union(parts))


@stream_query
def stream_config_state(tables):
    """Routes kept by a stream over several micro-batches of envelopes, after a snapshot."""
    work = Workspace(tables)
    store = RouteStore(f"default.routes_{work.name}")
    store.begin(star.config_start(work.batch))
    lines = star.config_envelopes(work.batch).withColumn("part", F.get_json_object("value", "$.ts_ms")).coalesce(1)
    lines.select("value", "part").write.partitionBy("part").text(f"{work.folder}/envelopes")
    envelopes = read_lines(work.spark, f"{work.folder}/envelopes", "text", maxFilesPerTrigger="1")
    jobs.start_routes(envelopes, store, work.run, FileSink(f"{work.folder}/rejects")).awaitTermination()
    return store.routes(work.spark, C.SINK_DIM)


def _visits(tables: Tables, mode: str) -> DataFrame:
    work = Workspace(tables)
    visits = star.visits(tables).withColumn("value", F.lit(None).cast("string"))
    path = f"{work.folder}/visits"
    work.run.start_files(correct_visitors_stream(visits, mode), path).awaitTermination()
    return work.spark.read.parquet(path).select("mid", "is_new", "ts", "seq")


@stream_query
def stream_new_visitor(tables):
    return _visits(tables, ARRIVAL)


@stream_query
def stream_new_visitor_same_day(tables):
    return _visits(tables, SAME_DAY)


@stream_query
def stream_dim_customer(tables):
    work = Workspace(tables)
    store = DimensionStore(f"dim_{work.name}", f"{work.folder}/dim")
    jobs.start_dimensions(star.dimension_log(tables), work.config, store, work.run).awaitTermination()
    return store.read(work.spark, "dim_customer", ["id", "name", "acctbal", "segment"])


@stream_query
def stream_fact_route(tables):
    work = Workspace(tables)
    jobs.start_fact_router(star.dimension_log(tables), work.config, work.sink, work.run).awaitTermination()
    return work.spark.read.schema("value string, run string, topic string").text(work.sink.root).select("topic", "value")

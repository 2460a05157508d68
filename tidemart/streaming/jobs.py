"""Streaming jobs (J0-J9): a plan, a sink and a checkpoint each.

``changes`` is a streaming change log with watermark, made once and shared by all
slices of a job. Dictionaries and routes are passed as functions, called in every
micro-batch, so a job always uses them as they stand. Every query has a checkpoint
folder of its own.
"""

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tidemart import constants as C
from tidemart.operators.changes import Changes
from tidemart.operators.merge import newest_rows
from tidemart.operators.routing import fact_messages, route_dimensions, route_facts
from tidemart.operators.split import log_messages, rejected_elements, split_records, tagged_records
from tidemart.operators.visitors import ARRIVAL
from tidemart.plans import facts, updates
from tidemart.sinks.keyed import DimensionStore, MergedTable, keyless
from tidemart.sinks.messages import FileSink, KafkaSink, fact_values, keyed_fact_values
from tidemart.sources.bronze import PARTITIONS, bronze_days, gathered, log_rows
from tidemart.sinks.routes import RouteStore
from tidemart.sources.config import config_changes, config_rejects, table_changes
from tidemart.sources.topics import parse_behaviour, parse_changes, split_facts, with_document
from tidemart.streaming.keyed_join import JOINED, MAIN
from tidemart.streaming.visitors import correct_visitors_stream

Sink = FileSink | KafkaSink
Loader = Callable[[SparkSession], DataFrame]
TOPICS = {
    "start": C.TOPIC_TRAFFIC_START,
    "display": C.TOPIC_TRAFFIC_DISPLAY,
    "action": C.TOPIC_TRAFFIC_ACTION,
    "err": C.TOPIC_TRAFFIC_ERR,
    "page": C.TOPIC_TRAFFIC_PAGE,
}
REJECTED = "rejected"
LEFT_OVER = "left_over"
STREAM_SALTS = 4


WATERMARK_POLICY = "spark.sql.streaming.multipleWatermarkPolicy"


@dataclass(frozen=True)
class Run:
    """How a query runs: where it checkpoints and when it is triggered.

    Without ``every`` it processes what is there and stops.

    With ``one_log`` all inputs are slices of one log, and time has come as far
    as the furthest slice: a table that is quiet for long does not hold up the
    others. Otherwise the slowest input sets the time.
    """

    checkpoint: str
    every: str | None = C.TRIGGER
    one_log: bool = False

    def over_one_log(self, changes: Changes) -> "Run":
        """For slices of one stream; tables that are streams of their own keep to the slowest, which ticks move on."""
        return replace(self, one_log=isinstance(changes, DataFrame))

    def start(self, df: DataFrame, handle: Callable[[DataFrame, str], None]) -> StreamingQuery:
        """Run ``handle(batch, run)`` per micro-batch.

        ``run`` names the micro-batch by query and number; both survive a restart
        from the checkpoint, and a new checkpoint makes new names.
        """

        def each(batch: DataFrame, batch_id: int) -> None:
            query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
            handle(batch, f"{query}-{batch_id:09d}")

        writer = df.writeStream.foreachBatch(each).option("checkpointLocation", self.checkpoint)
        return self._started(df, writer)

    def start_files(
        self, df: DataFrame, path: str, fmt: str = "parquet", partition_by: tuple[str, ...] = ()
    ) -> StreamingQuery:
        """Append rows to a folder, each exactly once."""
        writer = df.writeStream.format(fmt).option("checkpointLocation", self.checkpoint).option("path", path)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        return self._started(df, writer.outputMode("append"))

    def _started(self, df: DataFrame, writer: DataStreamWriter) -> StreamingQuery:
        writer = writer.trigger(availableNow=True) if self.every is None else writer.trigger(processingTime=self.every)
        conf = df.sparkSession.conf
        before = conf.get(WATERMARK_POLICY)
        conf.set(WATERMARK_POLICY, "max" if self.one_log else "min")
        try:
            return writer.start()
        finally:
            conf.set(WATERMARK_POLICY, before)


def start_bronze(lines: DataFrame, path: str, run: Run) -> StreamingQuery:
    """Parse the change log into bronze."""
    changes, _ = parse_changes(lines)
    return run.start_files(gathered(changes), path, partition_by=PARTITIONS)


def start_log_bronze(lines: DataFrame, path: str, run: Run) -> StreamingQuery:
    """Parse the behaviour log into bronze."""
    records, _ = parse_behaviour(lines)
    return run.start_files(log_rows(records), path, partition_by=("day",))


def catch_up(spark: SparkSession, bronze: str, start: Callable[[str], StreamingQuery]) -> None:
    """Run a job over stored changes day by day, in the order of the log.

    ``start(day)`` starts the job, always with the same checkpoint, over that day's files of all tables, and the
    run ends when they are done. Every table has then come as far as the others, so the watermark, which moves
    between runs only, makes no row late, and state holds a day and the bound. The checkpoint remembers the files
    it has seen: after a stop the days that are done pass at once.
    """
    for day in bronze_days(spark, bronze):
        start(day).awaitTermination()


def drain(query: StreamingQuery) -> None:
    """Let a query over a source that goes on step by step do all there is, then stop it.

    ``availableNow`` asks a source for its end once and takes everything in one micro-batch; this takes one step
    after the other. Give the query a short trigger.
    """
    try:
        query.processAllAvailable()
    finally:
        query.stop()


def start_change_rejects(lines: DataFrame, sink: Sink, run: Run) -> StreamingQuery:
    """Put aside change-log lines that do not parse."""
    _, rejected = parse_changes(lines)
    return run.start(rejected, lambda batch, name: sink.write(batch, REJECTED, name))


def start_log_split(
    lines: DataFrame, sink: Sink, run: Run, mode: str = ARRIVAL, rejects: Sink | None = None, together: bool = False, **options
) -> StreamingQuery:
    """Correct new visitors and write the five outputs of each micro-batch (J1); list elements that are no objects go to ``rejects``.

    ``together`` writes them in one pass and one write, each row to its own topic; file readers that follow
    ``FileSink.committed`` then see all outputs of a micro-batch or none.
    """
    records, _ = parse_behaviour(lines)

    def handle(batch: DataFrame, name: str) -> None:
        parsed = with_document(batch).drop("value")
        # One pass keeps nothing.
        if not together or rejects is not None:
            parsed = parsed.persist()
        try:
            if together:
                tagged = log_messages(tagged_records(parsed, **options))
                sink.write_by_topic(tagged.replace(TOPICS, subset=["output"]).withColumnRenamed("output", "topic"), name)
            else:
                for output, rows in split_records(parsed, **options).items():
                    sink.write(log_messages(rows), TOPICS[output], name)
            if rejects is not None:
                keys = {"action_key": options["action_key"]} if "action_key" in options else {}
                rejects.write(rejected_elements(parsed, **keys), REJECTED, name)
        finally:
            parsed.unpersist()

    return run.start(correct_visitors_stream(records, mode), handle)


def start_log_rejects(lines: DataFrame, sink: Sink, run: Run) -> StreamingQuery:
    """Put aside behaviour-log lines that are no usable records."""
    _, rejected = parse_behaviour(lines)
    return run.start(rejected, lambda batch, name: sink.write(batch.select("value"), REJECTED, name))


def _start_fact(df: DataFrame, topic: str, sink: Sink, run: Run, finish=lambda batch: batch) -> StreamingQuery:
    return run.start(df, lambda batch, name: sink.write(fact_values(finish(batch)), topic, name))


def start_comment(
    changes: Changes, dictionary: Loader, sink: Sink, run: Run, database: str = C.DATABASE
) -> StreamingQuery:
    """J2."""
    return _start_fact(
        facts.rated_comments(changes, database), C.TOPIC_COMMENT, sink, run,
        lambda batch: facts.name_comments(batch, dictionary(batch.sparkSession)),
    )


def start_cart_add(changes: Changes, sink: Sink, run: Run, database: str = C.DATABASE) -> StreamingQuery:
    """J3."""
    return _start_fact(facts.cart_add(changes, database), C.TOPIC_CART_ADD, sink, run)


def start_order_detail(
    changes: Changes, path: str, run: Run, database: str = C.DATABASE, bound: str = C.BOUND_ORDER_DETAIL,
    salts: int = STREAM_SALTS, span: str | None = None,
) -> StreamingQuery:
    """J4, appended as final rows to a folder that J5 and J6 read.

    With ``span`` (day, month or year) the folder is partitioned by it, and can be read in the order of time.
    """
    details = facts.order_detail(changes, database, bound, salts)
    run = run.over_one_log(changes)
    if span is None:
        return run.start_files(details, path)
    day = F.to_date(F.date_trunc(span, F.timestamp_seconds("ts")))
    return run.start_files(details.withColumn("day", day), path, partition_by=("day",))


def start_order_detail_updating(
    changes: Changes, target: MergedTable, run: Run, database: str = C.DATABASE, bound: int = C.SECONDS_ORDER_DETAIL,
    salts: int = STREAM_SALTS,
) -> StreamingQuery:
    """J4 with early rows: a detail appears as soon as its order is there, and anew with its activity and its coupon.

    The table keeps the newest version of each detail.
    """

    def handle(batch: DataFrame, name: str) -> None:
        target.create(batch.sparkSession)
        target.write(newest_rows(batch, ["id"], ["ts", "version"]), name)

    return run.over_one_log(changes).start(updates.order_detail_versions(changes, database, bound, salts), handle)


def start_order_cancel_complete(
    details: DataFrame, changes: Changes, sink: Sink, run: Run, database: str = C.DATABASE,
    bound: int = C.SECONDS_ORDER_CANCEL, salts: int = STREAM_SALTS,
) -> StreamingQuery:
    """J5 with everything that did not join: late rows, and details whose order was not cancelled in time, to ``LEFT_OVER``."""

    def handle(batch: DataFrame, name: str) -> None:
        batch = batch.persist()
        try:
            sink.write(fact_values(updates.cancelled(batch)), C.TOPIC_ORDER_CANCEL, name)
            left = batch.where(F.col("kind") != JOINED).select("kind", F.coalesce("side", F.lit(MAIN)).alias("side"), F.to_json(MAIN).alias("detail"), F.to_json("cancel").alias("cancel"))
            sink.write(fact_values(left), LEFT_OVER, name)
        finally:
            batch.unpersist()

    return run.start(updates.cancellations(details, changes, database, bound, salts), handle)


def start_order_detail_upsert(
    changes: Changes, target: MergedTable | KafkaSink, run: Run, database: str = C.DATABASE,
    bound: str = C.BOUND_ORDER_DETAIL, salts: int = STREAM_SALTS,
) -> StreamingQuery:
    """J4, keyed by detail id: the newest row per id counts."""

    def handle(batch: DataFrame, name: str) -> None:
        newest = newest_rows(batch, ["id"], ["ts", "activity_id"])
        if isinstance(target, KafkaSink):
            target.write(keyed_fact_values(newest, ["id"]), C.TOPIC_ORDER_DETAIL, name)
        else:
            target.create(batch.sparkSession)
            target.write(newest, name)

    return run.over_one_log(changes).start(facts.order_detail(changes, database, bound, salts), handle)


def start_order_cancel(
    details: DataFrame, changes: Changes, sink: Sink, run: Run, database: str = C.DATABASE,
    bound: str = C.BOUND_ORDER_CANCEL, salts: int = STREAM_SALTS,
) -> StreamingQuery:
    """J5."""
    joined = facts.order_cancel(details, changes, database, bound, salts)
    return _start_fact(joined, C.TOPIC_ORDER_CANCEL, sink, run)


def start_payment_success(
    details: DataFrame, changes: Changes, dictionary: Loader, sink: Sink, run: Run, database: str = C.DATABASE,
    before: int = C.PAYMENT_WINDOW_BEFORE, after: int = C.PAYMENT_WINDOW_AFTER, salts: int = STREAM_SALTS,
) -> StreamingQuery:
    """J6."""
    return _start_fact(
        facts.paid_details(details, changes, database, before, after, salts), C.TOPIC_PAYMENT_SUCCESS, sink, run,
        lambda batch: facts.name_payments(batch, dictionary(batch.sparkSession)),
    )


def start_order_refund(
    changes: Changes, dictionary: Loader, sink: Sink, run: Run, database: str = C.DATABASE,
    bound: str = C.BOUND_ORDER_REFUND, salts: int = STREAM_SALTS,
) -> StreamingQuery:
    """J7."""
    return _start_fact(
        facts.requested_refunds(changes, database, bound, salts), C.TOPIC_ORDER_REFUND, sink, run.over_one_log(changes),
        lambda batch: facts.name_refunds(batch, dictionary(batch.sparkSession)),
    )


def start_refund_payment(
    changes: Changes, dictionary: Loader, sink: Sink, run: Run, database: str = C.DATABASE,
    bound: str = C.BOUND_REFUND_PAYMENT, salts: int = STREAM_SALTS,
) -> StreamingQuery:
    """J8."""
    return _start_fact(
        facts.paid_refunds(changes, database, bound, salts), C.TOPIC_REFUND_PAYMENT, sink, run.over_one_log(changes),
        lambda batch: facts.name_paid_refunds(batch, dictionary(batch.sparkSession)),
    )


def start_fact_router(
    changes: DataFrame, config: Loader, sink: Sink, run: Run, database: str = C.DATABASE
) -> StreamingQuery:
    """J9."""

    def handle(batch: DataFrame, name: str) -> None:
        routed = route_facts(batch, config(batch.sparkSession), database)
        sink.write_by_topic(fact_messages(routed), name)

    return run.start(changes, handle)


def start_dimensions(
    changes: DataFrame, config: Loader, store: DimensionStore, run: Run, database: str = C.DATABASE,
    rejects: Sink | None = None,
) -> StreamingQuery:
    """Merge routed changes into the dimension store; those that name no row go to ``rejects``."""

    def handle(batch: DataFrame, name: str) -> None:
        batch = route_dimensions(batch, config(batch.sparkSession), database).persist()
        try:
            store.apply(batch, name)
            if rejects is not None:
                rejects.write(fact_values(keyless(batch)), REJECTED, name)
        finally:
            batch.unpersist()

    return run.start(changes, handle)


def start_routes(config_lines: DataFrame, store: RouteStore, run: Run, rejects: Sink | None = None) -> StreamingQuery:
    """Keep the routes in force as the config changes; lines that are no changes go to ``rejects``."""

    def handle(batch: DataFrame, name: str) -> None:
        batch = batch.persist()
        try:
            store.apply(config_changes(batch), name)
            if rejects is not None:
                rejects.write(config_rejects(batch), REJECTED, name)
        finally:
            batch.unpersist()

    return run.start(config_lines, handle)


def start_fact_rejects(lines: DataFrame, fact: str, sink: Sink, run: Run) -> StreamingQuery:
    """Put aside lines of a fact topic that are no such facts."""
    _, rejected = split_facts(lines, fact)
    return run.start(rejected, lambda batch, name: sink.write(batch, REJECTED, name))


def start_dimension_tables(config_lines: DataFrame, store: DimensionStore, run: Run) -> StreamingQuery:
    """Create and drop dimension tables as the config changes."""

    def handle(batch: DataFrame, name: str) -> None:
        rows = table_changes(batch)
        store.follow_config(rows.where(rows.sink_type == C.SINK_DIM))

    return run.start(config_lines, handle)

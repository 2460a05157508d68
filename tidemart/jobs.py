"""Command line for the streaming jobs, for use with spark-submit.

    spark-submit --py-files tidemart.zip tidemart/jobs.py order_detail --source ods_db \\
        --read kafka.bootstrap.servers=broker:9092 --out /dw/order_detail \\
        --checkpoint /dw/checkpoints/order_detail
"""

import argparse
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidemart import constants as C
from tidemart.operators.changes import Changes
from tidemart.operators.routing import current_config
from tidemart.operators.visitors import ARRIVAL, SAME_DAY
from tidemart.schemas import fact_schema
from tidemart.session import build_session
from tidemart.sinks.keyed import DimensionStore, newest_fact_table
from tidemart.sinks.messages import FileSink, KafkaSink
from tidemart.sinks.routes import RouteStore
from tidemart.sources.bronze import read_bronze
from tidemart.sources.config import config_changes, config_snapshot
from tidemart.sources.dictionary import file_dictionary, read_dictionary
from tidemart.sources.log_order import LogTables, in_order
from tidemart.sources.topics import read_changes, read_fact_lines, read_facts, read_lines
from tidemart.streaming import jobs
from tidemart.streaming.jobs import Run

BRONZE = "bronze"
COMPACT = "compact"


def _pairs(items: list[str]) -> dict[str, str]:
    return dict(item.split("=", 1) for item in items)


class Inputs:
    """The sources and sinks a command line names."""

    def __init__(self, spark: SparkSession, args: argparse.Namespace, day: str | None = None) -> None:
        self.spark = spark
        self.args = args
        self.day = day
        self.run = Run(args.checkpoint, None if args.once else args.every)
        self.store = DimensionStore(args.dim_schema, args.dim_location)

    def lines(self) -> DataFrame:
        return read_lines(self.spark, self.args.source, self.args.format, **_pairs(self.args.read))

    def changes(self) -> Changes:
        """The change log, from its topic or from bronze; in the order of the log, table by table, if asked for."""
        if self.args.in_order:
            return LogTables(
                self.spark, self.args.source, f"{self.args.checkpoint}.progress", self.args.delay, self.args.windows, self.args.flush
            )
        if self.args.format == BRONZE:
            return read_bronze(self.spark, self.args.source, True, self.args.delay, self.day, **_pairs(self.args.read))
        return read_changes(self.lines(), self.args.delay)

    def joining(self, *names: str) -> dict:
        """The join settings ``names`` that the command line gives; the others keep their defaults."""
        return {name: getattr(self.args, name) for name in names if getattr(self.args, name) is not None}

    def details(self) -> DataFrame:
        """Order details, from the folder of the order-detail job or from a topic of theirs."""
        if self.args.in_order and self.args.details_format == "parquet":
            ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fact_schema("order_detail"))
            progress = f"{self.args.checkpoint}.progress/details"
            return in_order(self.spark, self.args.details, progress, ddl, self.args.delay, None, self.args.windows, self.args.flush)
        if self.args.details_format == "parquet":
            return read_facts(self.spark, self.args.details, "order_detail", "parquet", True, self.args.delay, **_pairs(self.args.read))
        lines = read_lines(self.spark, self.args.details, self.args.details_format, **_pairs(self.args.read))
        return read_fact_lines(lines, "order_detail", self.args.delay)

    def sink(self):
        return KafkaSink(_pairs(self.args.write)) if self.args.out == "kafka" else FileSink(self.args.out)

    def rejects(self) -> FileSink | None:
        return FileSink(self.args.rejects) if self.args.rejects else None

    def log_options(self) -> dict:
        chosen = {"drop_displays": self.args.drop_displays, "action_key": self.args.action_key}
        return {name: value for name, value in chosen.items() if value}

    def dictionary(self, spark: SparkSession) -> DataFrame:
        if self.args.dictionary:
            return file_dictionary(spark, self.args.dictionary)
        return read_dictionary(spark, self.store)

    def config(self, sink_type: str) -> Callable[[SparkSession], DataFrame]:
        """Routes in force: from the table that the routes job keeps, or from a snapshot and the envelopes that followed it."""
        args = self.args
        if args.routes_table:
            return lambda spark: RouteStore(args.routes_table).routes(spark, sink_type)

        def load(spark: SparkSession) -> DataFrame:
            start = config_snapshot(spark, sink_type, args.config_format, args.config, **_pairs(args.config_read))
            if not args.config_changes:
                return start
            lines = read_lines(spark, args.config_changes, "text", streaming=False)
            return current_config(config_changes(lines), sink_type, start)

        return load


def _order_detail(i: Inputs) -> StreamingQuery:
    if i.args.upsert_table:
        table = newest_fact_table(i.args.upsert_table, "order_detail", ["id"], ["ts", "activity_id"])
        return jobs.start_order_detail_upsert(i.changes(), table, i.run, i.args.database, **i.joining("bound", "salts"))
    if i.args.out == "kafka":
        return jobs.start_order_detail_upsert(i.changes(), i.sink(), i.run, i.args.database, **i.joining("bound", "salts"))
    return jobs.start_order_detail(i.changes(), i.args.out, i.run, i.args.database, **i.joining("bound", "salts", "span"))


def _order_detail_updating(i: Inputs) -> StreamingQuery:
    table = newest_fact_table(i.args.upsert_table, "order_detail", ["id"], ["ts", "version"], "version int")
    return jobs.start_order_detail_updating(i.changes(), table, i.run, i.args.database, **i.joining("salts"))


def _routes(i: Inputs) -> StreamingQuery:
    """Keeps the routes; the first start takes up a snapshot, as of the log position on the command line, if one is given."""
    store = RouteStore(i.args.routes_table)
    if i.args.config and not i.spark.catalog.tableExists(store.name):
        rows = [
            config_snapshot(i.spark, kind, i.args.config_format, i.args.config, **_pairs(i.args.config_read)) for kind in (C.SINK_DIM, C.SINK_FACT)
        ]
        store.begin(rows[0].unionByName(rows[1]), i.args.snapshot_at)
    return jobs.start_routes(i.lines(), store, i.run, i.rejects())


JOBS: dict[str, Callable[[Inputs], StreamingQuery]] = {
    "bronze": lambda i: jobs.start_bronze(i.lines(), i.args.out, i.run),
    "log_bronze": lambda i: jobs.start_log_bronze(i.lines(), i.args.out, i.run),
    "change_rejects": lambda i: jobs.start_change_rejects(i.lines(), i.sink(), i.run),
    "dimensions": lambda i: jobs.start_dimensions(
        i.changes(), i.config(C.SINK_DIM), i.store, i.run, i.args.database, i.rejects()
    ),
    "routes": _routes,
    "dimension_tables": lambda i: jobs.start_dimension_tables(i.lines(), i.store, i.run),
    "log_split": lambda i: jobs.start_log_split(
        i.lines(), i.sink(), i.run, i.args.mode, i.rejects(), i.args.together, **i.log_options()
    ),
    "log_rejects": lambda i: jobs.start_log_rejects(i.lines(), i.sink(), i.run),
    "comment": lambda i: jobs.start_comment(i.changes(), i.dictionary, i.sink(), i.run, i.args.database),
    "cart_add": lambda i: jobs.start_cart_add(i.changes(), i.sink(), i.run, i.args.database),
    "order_detail": _order_detail,
    "order_cancel": lambda i: jobs.start_order_cancel(
        i.details(), i.changes(), i.sink(), i.run, i.args.database, **i.joining("bound", "salts")
    ),
    "order_detail_updating": _order_detail_updating,
    "order_cancel_complete": lambda i: jobs.start_order_cancel_complete(
        i.details(), i.changes(), i.sink(), i.run, i.args.database, **i.joining("salts")
    ),
    "payment_success": lambda i: jobs.start_payment_success(
        i.details(), i.changes(), i.dictionary, i.sink(), i.run, i.args.database, **i.joining("before", "after", "salts")
    ),
    "order_refund": lambda i: jobs.start_order_refund(
        i.changes(), i.dictionary, i.sink(), i.run, i.args.database, **i.joining("bound", "salts")
    ),
    "refund_payment": lambda i: jobs.start_refund_payment(
        i.changes(), i.dictionary, i.sink(), i.run, i.args.database, **i.joining("bound", "salts")
    ),
    "fact_router": lambda i: jobs.start_fact_router(i.changes(), i.config(C.SINK_FACT), i.sink(), i.run, i.args.database),
}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tidemart.jobs")
    p.add_argument("job", choices=sorted([*JOBS, COMPACT]))
    p.add_argument("--source", help="topic, or folder of text files or of bronze")
    p.add_argument("--table", action="append", default=[], help="dimension table to compact; by default --upsert-table")
    p.add_argument("--format", default="kafka", choices=["kafka", "text", BRONZE])
    p.add_argument("--read", action="append", default=[], metavar="KEY=VALUE", help="reader option")
    p.add_argument("--out", default="kafka", help="folder, or kafka")
    p.add_argument("--write", action="append", default=[], metavar="KEY=VALUE", help="Kafka writer option")
    p.add_argument("--rejects", help="folder for dimension changes that name no row, config lines that are no changes, odd list elements")
    p.add_argument("--checkpoint")
    p.add_argument("--every", default=C.TRIGGER, help="trigger interval")
    p.add_argument("--once", action="store_true", help="process what is there and stop")
    p.add_argument("--by-day", action="store_true", help="work bronze off day by day, in the order of the log, and stop")
    p.add_argument("--in-order", action="store_true", help="read bronze in the order of its days, all of it in one query")
    p.add_argument("--windows", type=int, default=1, help="days that a micro-batch of --in-order takes")
    p.add_argument("--flush", type=int, help="days after the start of the last day at which time ends, for --in-order --once")
    p.add_argument("--span", choices=["day", "month", "year"], help="partition order details, so that they can be read in order")
    p.add_argument("--database", default=C.DATABASE, help="shop database in the change log")
    p.add_argument("--bound", help="event time within which two changes join, such as '2 days'; each job has a default")
    p.add_argument("--before", type=int, help="seconds an order may precede its payment")
    p.add_argument("--after", type=int, help="seconds an order may follow its payment")
    p.add_argument("--delay", default=C.WATERMARK, help="how late a change may come, in event time; later ones are not joined")
    p.add_argument("--salts", type=int, help="state partitions over which a join key is spread")
    p.add_argument("--details", help="folder or topic of order details")
    p.add_argument("--details-format", default="parquet", choices=["parquet", "text", "kafka"])
    p.add_argument("--dictionary", help="parquet folder; by default the dictionary dimension")
    p.add_argument("--dim-schema", default="dim")
    p.add_argument("--dim-location")
    p.add_argument("--upsert-table", help="catalog table of the newest order details")
    p.add_argument("--config", help="folder of config rows, for formats other than jdbc")
    p.add_argument("--config-format", default="jdbc")
    p.add_argument("--config-read", action="append", default=[], metavar="KEY=VALUE")
    p.add_argument("--config-changes", help="folder of config change envelopes")
    p.add_argument("--routes-table", help="catalog table that the routes job keeps and the routers read")
    p.add_argument("--snapshot-at", type=int, help="time of the config log, in milliseconds, noted before the snapshot is read")
    p.add_argument("--together", action="store_true", help="write the outputs of the log in one pass, all of a micro-batch or none")
    p.add_argument("--drop-displays", action="store_true", help="leave displays out of start, page and error records")
    p.add_argument("--action-key", help="key of a log record's actions")
    p.add_argument("--mode", default=ARRIVAL, choices=[ARRIVAL, SAME_DAY], help="when a visitor stops being new")
    return p


def compact(spark: SparkSession, args: argparse.Namespace) -> None:
    """Merge the runs of the tables that the command line names."""
    store = DimensionStore(args.dim_schema, args.dim_location)
    tables = [store.table(name) for name in args.table]
    if args.upsert_table:
        tables.append(newest_fact_table(args.upsert_table, "order_detail", ["id"], ["ts", "activity_id"]))
    for table in tables:
        table.compact(spark)


def main(argv: list[str] | None = None) -> None:
    p = parser()
    args = p.parse_args(argv)
    if (args.by_day or args.in_order) and args.format != BRONZE:
        p.error("--by-day and --in-order work on bronze")
    if (args.by_day or args.in_order) and args.read:
        p.error("--by-day and --in-order take whole days: leave --read out")
    if args.job != COMPACT and not (args.source and args.checkpoint):
        p.error("--source and --checkpoint are required")
    spark = build_session(f"tidemart-{args.job}")
    if args.job == COMPACT:
        compact(spark, args)
        return
    if args.by_day:
        args.once = True
        jobs.catch_up(spark, args.source, lambda day: JOBS[args.job](Inputs(spark, args, day)))
        return
    if args.in_order and args.once:
        # The source goes on step by step; a trigger without pause takes one after the other.
        args.once, args.every = False, "0 seconds"
        jobs.drain(JOBS[args.job](Inputs(spark, args)))
        return
    JOBS[args.job](Inputs(spark, args)).awaitTermination()


if __name__ == "__main__":
    main()

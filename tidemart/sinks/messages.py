"""Rows as messages, and append-only sinks for them (K1, K3, K4).

A sink writes the messages of one run: a micro-batch of one query, or a batch job.
"""

from dataclasses import dataclass, field

from pyarrow.fs import FileSelector, FileType
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.sources.log_order import place

# The file that Spark's writer leaves in a folder that is written completely.
MARK = "_SUCCESS"


def fact_values(fact: DataFrame) -> DataFrame:
    """Facts as JSON text ``value``, null columns written as nulls."""
    return fact.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))


def keyed_fact_values(fact: DataFrame, keys: list[str]) -> DataFrame:
    """Facts as JSON ``key`` and ``value``, for a topic that keeps the newest per key."""
    return fact.select(
        F.to_json(F.struct(*keys)).alias("key"),
        F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"),
    )


@dataclass(frozen=True)
class FileSink:
    """Messages as text files in ``<root>/<topic>/run=<run>``.

    A run that is written again replaces its folder, so each of its messages is
    stored once.
    """

    root: str

    def write(self, messages: DataFrame, topic: str, run: str) -> None:
        messages.select("value").write.mode("overwrite").text(f"{self.root}/{topic}/run={run}")

    def write_by_topic(self, messages: DataFrame, run: str) -> None:
        """As ``write``, each row to its own topic, in ``<root>/run=<run>/topic=<topic>``.

        The rebalance hint keeps files few and splits a busy topic over tasks. A run's folder gets its mark
        when all topics are written; :meth:`committed` reads marked runs only.
        """
        (
            messages.select("value", "topic")
            .hint("rebalance", "topic")
            .write.mode("overwrite")
            .partitionBy("topic")
            .text(f"{self.root}/run={run}")
        )

    def committed(self, spark: SparkSession, topic: str) -> DataFrame:
        """Lines ``value`` of a topic, of runs whose topics are all written: no topic runs ahead of another."""
        files, root = place(self.root)
        infos = files.get_file_info(FileSelector(root, allow_not_found=True))
        runs = [i.base_name for i in infos if i.base_name.startswith("run=")]
        wanted = [f"{root}/{run}/{name}" for run in runs for name in (MARK, f"topic={topic}")]
        there = [i.type != FileType.NotFound for i in files.get_file_info(wanted)]
        whole = [run for run, mark, own in zip(runs, there[::2], there[1::2], strict=True) if mark and own]
        if not whole:
            return spark.createDataFrame([], "value string")
        return spark.read.text([f"{self.root}/{run}/topic={topic}" for run in whole])


@dataclass(frozen=True)
class KafkaSink:
    """Messages to Kafka topics, each delivered at least once."""

    options: dict[str, str] = field(default_factory=dict)

    def write(self, messages: DataFrame, topic: str, run: str) -> None:
        self.write_by_topic(messages.withColumn("topic", F.lit(topic)), run)

    def write_by_topic(self, messages: DataFrame, run: str) -> None:
        columns = [c for c in ("key", "value", "topic") if c in messages.columns]
        messages.select(*columns).write.format("kafka").options(**self.options).save()

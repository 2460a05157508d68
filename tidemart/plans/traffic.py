"""Behaviour-log plan (J1): parse, correct new visitors, split."""

from pyspark.sql import DataFrame

from tidemart.operators.split import split_records, tagged_records
from tidemart.operators.visitors import ARRIVAL, correct_next, correct_visitors
from tidemart.sources.topics import parse_behaviour


def split_log(lines: DataFrame, mode: str = ARRIVAL, **options) -> dict[str, DataFrame]:
    """The five typed outputs of a batch of log lines."""
    records, _ = parse_behaviour(lines)
    return split_records(correct_visitors(records.drop("value"), mode), **options)


def tagged_log(lines: DataFrame, mode: str = ARRIVAL, **options) -> DataFrame:
    """The same outputs tagged, in one pass over the corrected records: for one write partitioned by output."""
    records, _ = parse_behaviour(lines)
    return tagged_records(correct_visitors(records.drop("value"), mode), **options)


def tagged_day(records: DataFrame, known: DataFrame, mode: str = ARRIVAL, **options) -> tuple[DataFrame, DataFrame]:
    """The next day of a stored log: its outputs, tagged, and the first visits of its devices to add to those ``known``.

    ``records`` are parsed already (``sources/bronze.py``); nothing but that day and the known first visits is read.
    """
    corrected, firsts = correct_next(records, known, mode)
    return tagged_records(corrected, **options), firsts

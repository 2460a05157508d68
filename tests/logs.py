"""Small logs for tests: builders of change and behaviour lines, and readers of results."""

import json
from collections import Counter

from tidemart.constants import DATABASE
from tidemart.schemas import CHANGE_DDL
from tidemart.sources.topics import with_event_time


def change(table, kind, data, old=None, ts=1000, seq=None, database=DATABASE):
    return {"database": database, "table": table, "type": kind, "data": data, "old": old, "ts": ts, "seq": seq}


def changes_df(spark, rows):
    fields = ("database", "table", "type", "data", "old", "ts", "seq")
    tuples = [tuple(r[f] for f in fields) for r in rows]
    return with_event_time(spark.createDataFrame(tuples, CHANGE_DDL))


def lines_df(spark, lines):
    return spark.createDataFrame([(line, i) for i, line in enumerate(lines)], "value string, position bigint")


def write_files(folder, lines, files=1):
    """Write lines in order over some text files, with rising modification times."""
    import os

    folder.mkdir(parents=True, exist_ok=True)
    start = len(list(folder.iterdir()))
    size = -(-len(lines) // files)
    for i in range(files):
        path = folder / f"{start + i:05d}.txt"
        path.write_text("".join(line + "\n" for line in lines[i * size : (i + 1) * size]))
        os.utime(path, (1_000_000 + start + i, 1_000_000 + start + i))
    return str(folder)


def dumps(rows):
    return [json.dumps(r) for r in rows]


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def json_bag(df):
    return Counter(json.dumps(json.loads(r.value), sort_keys=True) for r in df.collect())

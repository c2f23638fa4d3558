"""Stored rows that are hard to read, changes without a time, and long results."""

import datetime as dt

from lakeretrieve.operators import chat
from lakeretrieve.plans.changelog import apply_upsert
from lakeretrieve.stores import SqlDatabase


def test_last_rows_are_taken_before_bad_ones_are_skipped(spark):
    good = '{"type":"human","data":{"content":"%s"}}'
    rows = [("s", 1, good % "one"), ("s", 2, good % "two"), ("s", 3, good % "th\x07ree"), ("s", 4, "no json")]
    log = spark.createDataFrame([(s, n, dt.datetime(2024, 1, n), m) for s, n, m in rows], "session_id string, seq long, ts timestamp, message string")
    found = chat.decode(chat.last_messages(log, 2)).collect()
    assert [(r.seq, r.content, r.position) for r in found] == [(3, "three", 1)]
    assert chat.decode(log).count() == 3


def test_change_without_a_time_is_a_change(spark):
    current = spark.createDataFrame([(1, "a", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1))], "k int, v string, created_at timestamp, updated_at timestamp")
    changes = spark.createDataFrame([(1, "b", None, 0), (2, "c", None, 0)], "k int, v string, ts timestamp, ord int")
    found = {r.k: (r.v, r.updated_at) for r in apply_upsert(current, changes, ["k"], ["v"]).collect()}
    assert found == {1: ("b", dt.datetime(2024, 1, 1)), 2: ("c", None)}


def test_long_results_are_rendered_whole(spark):
    database = SqlDatabase(spark)
    query = "SELECT id FROM range(1500) ORDER BY id"
    assert len(database.run(query).split("\n")) == 1502
    assert len(database.run(query, 10).split("\n")) == 12

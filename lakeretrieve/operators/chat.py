"""Chat history: a log ``session_id, seq, ts, type, content`` of many sessions.

``seq`` breaks ties of equal timestamps. Every operator takes the whole log,
or a table of sessions, and copes with one very long session.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lakeretrieve.functions.chat import message_json, parse_message, transcript_line
from lakeretrieve.plans.topk import render_lines, top_per_group, with_positions

# Messages per transcript part.
PART_MESSAGES = 1000


def decode(log: DataFrame) -> DataFrame:
    """Stored ``message`` JSON as type and content; unparsable rows are skipped.

    A ``position`` given to the raw rows is kept.
    """
    placed = [c for c in log.columns if c == "position"]
    parsed = log.withColumn("__m", parse_message(F.col("message"))).filter(F.col("__m").isNotNull())
    return parsed.select("session_id", "seq", "ts", F.col("__m.type").alias("type"), F.col("__m.content").alias("content"), *placed)


def encode(messages: DataFrame) -> DataFrame:
    """Messages as stored rows."""
    return messages.select(
        "session_id", "seq", "ts", message_json(F.col("type"), F.col("content")).alias("message")
    )


def for_sessions(log: DataFrame, sessions: DataFrame | None) -> DataFrame:
    """Only the listed sessions; the list may repeat a session."""
    return log if sessions is None else log.join(sessions.select("session_id"), "session_id", "left_semi")


def messages(log: DataFrame, sessions: DataFrame | None = None) -> DataFrame:
    """Messages by session and time. The sort is range-partitioned on all three
    keys, so a long session spreads over tasks."""
    return for_sessions(log, sessions).orderBy("session_id", "ts", "seq")


def append(log: DataFrame, new: DataFrame) -> DataFrame:
    return log.unionByName(new.select(*log.columns))


def last_messages(log: DataFrame, n: int) -> DataFrame:
    """Last n messages of each session, ``position`` 1 being the oldest."""
    recent = top_per_group(log, ["session_id"], [F.desc("ts"), F.desc("seq")], n, rank="__back")
    ahead = Window.partitionBy("session_id").orderBy("ts", "seq")
    return recent.withColumn("position", F.row_number().over(ahead)).drop("__back")


def in_range(log: DataFrame, start: Column | None = None, end: Column | None = None) -> DataFrame:
    """Messages between two times, both inclusive and both optional."""
    if start is not None:
        log = log.filter(F.col("ts") >= start)
    if end is not None:
        log = log.filter(F.col("ts") <= end)
    return log


def count_messages(log: DataFrame, sessions: DataFrame) -> DataFrame:
    """Messages of each listed session, 0 when it has none."""
    counts = for_sessions(log, sessions).groupBy("session_id").agg(F.count(F.lit(1)).alias("n"))
    return sessions.select("session_id").join(counts, "session_id", "left").select(
        "session_id", F.coalesce("n", F.lit(0)).alias("n")
    )


def session_ids(log: DataFrame) -> DataFrame:
    return log.select("session_id").distinct().orderBy("session_id")


def clear_sessions(log: DataFrame, sessions: DataFrame | None = None) -> DataFrame:
    """Log without the listed sessions, or an empty log."""
    if sessions is None:
        return log.limit(0)
    return log.join(sessions.select("session_id"), "session_id", "left_anti")


def transcript(log: DataFrame, sessions: DataFrame | None = None, part_messages: int = PART_MESSAGES) -> DataFrame:
    """``(session_id, part, transcript)``: lines ``Speaker: content``.

    Parts of a session follow each other, joined by a newline they are its
    whole transcript. A session of up to ``part_messages`` messages is one
    part; a longer one is never gathered in one task. A listed session without
    messages has the empty transcript.
    """
    placed = with_positions(for_sessions(log, sessions), ["session_id"], ["ts", "seq"])
    parts = render_lines(
        placed.withColumn("part", F.floor((F.col("position") - 1) / part_messages)),
        ["session_id", "part"],
        "position",
        transcript_line(F.col("type"), F.col("content")),
        "\n",
        "transcript",
    )
    if sessions is None:
        return parts
    return sessions.select("session_id").distinct().join(parts, "session_id", "left").select(
        "session_id", F.coalesce("part", F.lit(0)).alias("part"), F.coalesce("transcript", F.lit("")).alias("transcript")
    )


def memory_variables(log: DataFrame, sessions: DataFrame | None = None, part_messages: int = PART_MESSAGES) -> DataFrame:
    """Transcript under its two names and the messages, by session part."""
    placed = with_positions(for_sessions(log, sessions), ["session_id"], ["ts", "seq"])
    placed = placed.withColumn("part", F.floor((F.col("position") - 1) / part_messages))
    entries = F.array_sort(F.collect_list(F.struct("position", "type", "content")))
    return placed.groupBy("session_id", "part").agg(entries.alias("messages")).select(
        "session_id",
        "part",
        F.array_join(
            F.transform("messages", lambda m: transcript_line(m["type"], m["content"])), "\n"
        ).alias("history"),
        "messages",
    ).withColumn("chat_history", F.col("history"))


def save_turns(turns: DataFrame) -> DataFrame:
    """Messages of turns ``session_id, turn, ts, input, output``.

    Input becomes a human message and output an AI message, each only when
    present, at ``seq`` 2 * turn and 2 * turn + 1.
    """
    both = F.array(
        F.struct(F.lit(0).alias("half"), F.lit("human").alias("type"), F.col("input").alias("content")),
        F.struct(F.lit(1).alias("half"), F.lit("ai").alias("type"), F.col("output").alias("content")),
    )
    present = F.filter(both, lambda m: m["content"].isNotNull())
    return turns.select("session_id", "turn", "ts", F.explode(present).alias("m")).select(
        "session_id",
        (F.col("turn") * 2 + F.col("m.half")).cast("bigint").alias("seq"),
        "ts",
        F.col("m.type").alias("type"),
        F.col("m.content").alias("content"),
    )


def pair_turns(log: DataFrame, n: int = 10, *, strict: bool = True) -> DataFrame:
    """``(session_id, pair, question, answer)`` of the last n messages.

    Positions 2i and 2i+1 form a pair; ``strict`` also demands that they are a
    human and an AI message.
    """
    recent = last_messages(log, n).withColumn("pair", F.floor((F.col("position") - 1) / 2))
    odd = F.col("position") % 2 == 1
    pairs = recent.groupBy("session_id", "pair").agg(
        F.count(F.lit(1)).alias("n"),
        F.max(F.when(odd, F.struct("type", "content"))).alias("q"),
        F.max(F.when(~odd, F.struct("type", "content"))).alias("a"),
    ).filter(F.col("n") == 2)
    if strict:
        pairs = pairs.filter((F.col("q.type") == "human") & (F.col("a.type") == "ai"))
    return pairs.select(
        "session_id", "pair", F.col("q.content").alias("question"), F.col("a.content").alias("answer")
    )

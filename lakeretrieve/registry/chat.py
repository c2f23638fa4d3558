"""Queries on chat history."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeretrieve.functions import chat as X
from lakeretrieve.operators import chat as op
from lakeretrieve.registry.base import CHAT_SQL, Tables, query, stamp

_SESSIONS_SQL = "sessions AS (SELECT doc_id::VARCHAR AS session_id FROM labels)"
_TS = "strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts"
_SPEAKER = "CASE type WHEN 'human' THEN 'Human' WHEN 'ai' THEN 'AI' ELSE upper(type[1]) || type[2:] END"
_OUT = ["session_id", "seq", "type"]


def _shown(rows):
    return rows.select(*_OUT, stamp("ts").alias("ts"), F.md5("content").alias("content_md5"))


@query(
    "c01_messages",
    f"""WITH {CHAT_SQL}, {_SESSIONS_SQL} SELECT session_id, seq, type, {_TS}, md5(content) AS content_md5
        FROM chat WHERE session_id IN (SELECT session_id FROM sessions) ORDER BY session_id, chat.ts, seq""",
)
def messages(t: Tables):
    return _shown(op.messages(t.chat, t.sessions))


@query(
    "c02_append_messages",
    f"""WITH {CHAT_SQL}, grown AS (
          SELECT session_id, seq, type, content FROM chat
          UNION ALL SELECT 'bench', item_id, 'human', text FROM benchmark)
        SELECT session_id, seq, type, md5(content) AS content_md5 FROM grown""",
)
def append(t: Tables):
    """Append encoded messages to an encoded log and read them back."""
    new = t.read("benchmark").select(
        F.lit("bench").alias("session_id"),
        F.col("item_id").alias("seq"),
        F.lit("2024-06-01 00:00:00").cast("timestamp").alias("ts"),
        F.lit("human").alias("type"),
        F.col("text").alias("content"),
    )
    log = op.append(op.encode(t.chat), op.encode(new))
    return op.decode(log).select(*_OUT, F.md5("content").alias("content_md5"))


@query(
    "c04_clean_text",
    r"""SELECT page_id AS id, md5(regexp_replace(replace(replace(replace(html, '<', chr(1)), '>', chr(31)), '=', chr(127)),
          '[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]', '', 'g')) AS cleaned_md5 FROM pages""",
)
def clean(t: Tables):
    dirty = F.translate("html", "<>=", "\x01\x1f\x7f")
    return t.read("pages").select(F.col("page_id").alias("id"), F.md5(X.clean_text(dirty)).alias("cleaned_md5"))


@query(
    "c05_last_messages",
    f"""WITH {CHAT_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY ts DESC, seq DESC) AS back FROM chat)
        SELECT session_id, seq, type, {_TS}, md5(content) AS content_md5,
          row_number() OVER (PARTITION BY session_id ORDER BY r.ts, seq)::INTEGER AS position FROM r WHERE back <= 4""",
)
def last_messages(t: Tables):
    rows = op.last_messages(t.chat, 4)
    return rows.select(*_OUT, stamp("ts").alias("ts"), F.md5("content").alias("content_md5"), "position")


@query(
    "c06_time_range",
    f"""WITH {CHAT_SQL} SELECT session_id, seq, type, {_TS}, md5(content) AS content_md5 FROM chat
        WHERE ts BETWEEN TIMESTAMP '2024-01-02 01:00:00' AND TIMESTAMP '2024-01-04 00:02:00'""",
)
def in_range(t: Tables):
    start, end = (F.lit(x).cast("timestamp") for x in ("2024-01-02 01:00:00", "2024-01-04 00:02:00"))
    return _shown(op.in_range(t.chat, start, end))


@query(
    "c07_message_counts",
    f"""WITH {CHAT_SQL}, {_SESSIONS_SQL}, n AS (SELECT session_id, count(*) AS n FROM chat GROUP BY session_id)
        SELECT s.session_id, coalesce(n, 0) AS n FROM sessions s LEFT JOIN n USING (session_id)""",
)
def counts(t: Tables):
    return op.count_messages(t.chat, t.sessions)


@query("c08_session_ids", f"WITH {CHAT_SQL} SELECT DISTINCT session_id FROM chat ORDER BY session_id")
def session_ids(t: Tables):
    return op.session_ids(t.chat)


@query(
    "c09_clear_sessions",
    f"WITH {CHAT_SQL}, {_SESSIONS_SQL} SELECT session_id, seq FROM chat WHERE session_id NOT IN (SELECT session_id FROM sessions)",
)
def clear(t: Tables):
    return op.clear_sessions(t.chat, t.sessions).select("session_id", "seq")


@query(
    "c11_transcript",
    f"""WITH {CHAT_SQL}, {_SESSIONS_SQL}, r AS (SELECT session_id,
          string_agg({_SPEAKER} || ': ' || content, chr(10) ORDER BY ts, seq) AS transcript FROM chat GROUP BY session_id)
        SELECT s.session_id, 0::BIGINT AS part, md5(coalesce(transcript, '')) AS transcript_md5
        FROM (SELECT DISTINCT session_id FROM sessions) s LEFT JOIN r USING (session_id)""",
)
def transcript(t: Tables):
    return op.transcript(t.chat, t.sessions).select("session_id", "part", F.md5("transcript").alias("transcript_md5"))


@query(
    "c12_save_turns",
    """WITH b AS (
         SELECT e.user_id::VARCHAR AS session_id, e.event_id AS turn,
           CASE WHEN event_type <> 'error' THEN event_type END AS input,
           CASE WHEN event_type <> 'signup' THEN props END AS output FROM events e)
       SELECT session_id, 2 * turn AS seq, 'human' AS type, input AS content FROM b WHERE input IS NOT NULL
       UNION ALL SELECT session_id, 2 * turn + 1, 'ai', output FROM b WHERE output IS NOT NULL""",
)
def save_turns(t: Tables):
    turns = t.read("events").select(
        F.col("user_id").cast("string").alias("session_id"),
        F.col("event_id").alias("turn"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("input"),
        F.when(F.col("event_type") != "signup", F.col("props")).alias("output"),
    )
    return op.save_turns(turns).select("session_id", "seq", "type", "content")


@query(
    "c13_memory_variables",
    f"""WITH {CHAT_SQL} SELECT session_id, 0::BIGINT AS part,
          md5(string_agg({_SPEAKER} || ': ' || content, chr(10) ORDER BY ts, seq)) AS history_md5,
          md5(string_agg({_SPEAKER} || ': ' || content, chr(10) ORDER BY ts, seq)) AS chat_history_md5,
          count(*)::INTEGER AS messages, arg_min(type, (ts, seq)) AS first_type
        FROM chat GROUP BY session_id""",
)
def memory(t: Tables):
    return op.memory_variables(t.chat).select(
        "session_id",
        "part",
        F.md5("history").alias("history_md5"),
        F.md5("chat_history").alias("chat_history_md5"),
        F.size("messages").alias("messages"),
        F.col("messages")[0]["type"].alias("first_type"),
    )


def _pairs_sql(strict: bool) -> str:
    test = "q.type = 'human' AND a.type = 'ai'" if strict else "TRUE"
    return f"""WITH {CHAT_SQL},
      l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY ts DESC, seq DESC) AS back FROM chat) WHERE back <= 10),
      p AS (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY ts, seq) AS pos FROM l)
      SELECT q.session_id, (q.pos - 1) // 2 AS pair, md5(q.content) AS question_md5, md5(a.content) AS answer_md5
      FROM p q JOIN p a ON a.session_id = q.session_id AND a.pos = q.pos + 1 AND q.pos % 2 = 1 WHERE {test}"""


def _pairs(t: Tables, strict: bool):
    return op.pair_turns(t.chat, 10, strict=strict).select(
        "session_id", "pair", F.md5("question").alias("question_md5"), F.md5("answer").alias("answer_md5")
    )


@query("c14_pair_turns_strict", _pairs_sql(True))
def pairs_strict(t: Tables):
    return _pairs(t, True)


@query("c14_pair_turns_loose", _pairs_sql(False))
def pairs_loose(t: Tables):
    return _pairs(t, False)


@query(
    "c15_model_roles",
    f"""WITH {CHAT_SQL} SELECT session_id, seq, CASE type WHEN 'human' THEN 'user' ELSE 'assistant' END AS role,
          md5(content) AS content_md5 FROM chat""",
)
def roles(t: Tables):
    return t.chat.select("session_id", "seq", X.model_role(F.col("type")).alias("role"), F.md5("content").alias("content_md5"))

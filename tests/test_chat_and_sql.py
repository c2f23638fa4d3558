import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F, types as T

from lakeretrieve import stores as S
from lakeretrieve.functions import chat as X, prompts as P
from lakeretrieve.operators import chat, rag, sqlsurface as Q
from lakeretrieve.plans.topk import with_positions
from lakeretrieve.streaming import distinct_messages, stream_upserts
from lakeretrieve.plans.changelog import ChangeLog

T0 = dt.datetime(2024, 1, 1)


def log_of(spark, rows):
    return spark.createDataFrame(
        [(s, i, T0 + dt.timedelta(minutes=m), kind, text) for i, (s, m, kind, text) in enumerate(rows)],
        "session_id string, seq bigint, ts timestamp, type string, content string",
    )


@pytest.fixture()
def history(spark, tmp_path):
    store = S.ChatHistory(spark, str(tmp_path / "chat"))
    store.add_messages(
        log_of(
            spark,
            [("s1", 0, "human", "hi\x00\x1f\tthere"), ("s1", 0, "ai", "hello"), ("s1", 5, "human", "more?"), ("s1", 6, "ai", "yes"), ("s2", 1, "system", "be brief")],
        )
    )
    return store


def sessions(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "session_id string")


def test_history(spark, history):
    # ties of the timestamp follow seq; control characters are escaped by JSON and stay readable
    rows = history.messages(sessions(spark, "s1")).collect()
    assert [r.content for r in rows][1:] == ["hello", "more?", "yes"]
    last = history.last_messages(2).filter("session_id = 's1'").orderBy("position").collect()
    assert [(r.type, r.content) for r in last] == [("human", "more?"), ("ai", "yes")]
    assert {r.session_id: r.n for r in history.count_messages(sessions(spark, "s1", "none")).collect()} == {"s1": 4, "none": 0}
    assert [r.session_id for r in history.session_ids().collect()] == ["s1", "s2"]
    at = F.lit("2024-01-01 00:05:00").cast("timestamp")
    assert history.in_range(at, at).count() == 1
    assert history.in_range(end=at).count() == 4 and history.in_range(start=at).count() == 2
    history.clear(sessions(spark, "s1", "never"))
    assert [r.session_id for r in history.session_ids().collect()] == ["s2"]
    history.clear()
    assert history.log().count() == 0


def test_transcript(spark, history):
    texts = {r.session_id: r.transcript for r in history.transcript(sessions(spark, "s1", "s2", "none")).collect()}
    assert texts["s1"].split("\n")[1:] == ["AI: hello", "Human: more?", "AI: yes"]
    assert texts["s2"] == "System: be brief" and texts["none"] == ""
    memory = history.memory_variables(sessions(spark, "s2")).first()
    assert memory.history == memory.chat_history == "System: be brief" and memory.messages[0].content == "be brief"


def test_long_session_is_split_but_whole(spark):
    rows = [("hot", i // 7, "human", f"m{i}") for i in range(2500)] + [("cold", 0, "ai", "x")]
    log = log_of(spark, rows).repartition(6)
    placed = with_positions(log, ["session_id"], ["ts", "seq"]).collect()
    assert sorted((r.position, r.seq) for r in placed if r.session_id == "hot") == [(i + 1, i) for i in range(2500)]
    parts = chat.transcript(log, part_messages=400).filter("session_id = 'hot'").orderBy("part").collect()
    assert len(parts) == 7
    assert "\n".join(p.transcript for p in parts) == "\n".join(f"Human: m{i}" for i in range(2500))


def test_cleaning_and_bad_rows(spark):
    text = "".join(chr(i) for i in range(0xA1))
    got = spark.createDataFrame([(text,)], "t string").select(X.clean_text(F.col("t"))).first()[0]
    assert got == "".join(chr(i) for i in range(0xA1) if i in (9, 10, 13) or 0x20 <= i < 0x7F or i >= 0xA0)
    stored = spark.createDataFrame(
        [("s", 1, T0, '{"type":"human","data":{"content":"ok"}}'), ("s", 2, T0, "broken"), ("s", 3, T0, "")],
        "session_id string, seq bigint, ts timestamp, message string",
    )
    assert [r.content for r in chat.decode(stored).collect()] == ["ok"]


def test_turns_and_pairs(spark):
    turns = spark.createDataFrame(
        [("s", 0, T0, "q0", "a0"), ("s", 1, T0, None, "a1"), ("s", 2, T0, "q2", None), ("s", 3, T0, "q3", "a3")],
        "session_id string, turn bigint, ts timestamp, input string, output string",
    )
    log = chat.save_turns(turns)
    assert [(r.seq, r.type, r.content) for r in log.orderBy("seq").collect()] == [
        (0, "human", "q0"), (1, "ai", "a0"), (3, "ai", "a1"), (4, "human", "q2"), (6, "human", "q3"), (7, "ai", "a3"),
    ]
    strict = chat.pair_turns(log, 10).orderBy("pair").collect()
    assert [(r.question, r.answer) for r in strict] == [("q0", "a0"), ("q3", "a3")]
    loose = chat.pair_turns(log, 5, strict=False).orderBy("pair").collect()
    assert [(r.question, r.answer) for r in loose] == [("a0", "a1"), ("q2", "q3")]
    roles = [r[0] for r in log.orderBy("seq").select(X.model_role(F.col("type"))).collect()]
    assert roles[:2] == ["user", "assistant"]


def test_streamed_repeats(spark, tmp_path):
    path = str(tmp_path / "in")
    log_of(spark, [("s", 0, "human", "a"), ("s", 1, "ai", "b")]).write.parquet(path)
    log_of(spark, [("s", 0, "human", "a")]).write.mode("append").parquet(path)
    stream = spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)
    query = distinct_messages(stream).writeStream.format("memory").queryName("seen").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("seen").count() == 2


def test_streamed_upserts_restart(spark, tmp_path):
    source, state = str(tmp_path / "in"), str(tmp_path / "state")
    log = ChangeLog(spark, str(tmp_path / "log"), {"key": "string"}, {"value": "string"})

    def feed(rows):
        spark.createDataFrame([(k, v, T0, i) for i, (k, v) in enumerate(rows)], "key string, value string, ts timestamp, ord bigint").write.mode("append").parquet(source)
        stream = spark.readStream.schema("key string, value string, ts timestamp, ord bigint").parquet(source)
        stream_upserts(stream, log, state).awaitTermination()

    feed([("a", "1"), ("a", "2")])
    feed([("a", "3"), ("b", "1")])
    feed([])
    assert {r.key: r.value for r in log.current().collect()} == {"a": "3", "b": "1"}


def extract(spark, text, mode):
    return spark.createDataFrame([(text,)], "t string").select(P.extract_sql(F.col("t"), mode)).first()[0]


@pytest.mark.parametrize(
    "text,mode,want",
    [
        ("SQLQuery: SELECT 1\nSQLResult: 1", "reference", "SELECT 1"),
        ('blah SQLQuery: "SELECT 1"', "reference", "SELECT 1"),
        ("SELECT 1 ", "reference", "SELECT 1"),
        ("SELECT 'x'", "reference", "SELECT 'x"),
        ("SELECT 'x'", "paired", "SELECT 'x'"),
        ("```sql\nSELECT 1\n```", "reference", "sql\nSELECT 1"),
        ("```sql\nSELECT 1\n```", "paired", "SELECT 1"),
        ("'SELECT 1'", "paired", "SELECT 1"),
        ("SELECT 'a', 'b'", "paired", "SELECT 'a', 'b'"),
    ],
)
def test_extract(spark, text, mode, want):
    assert extract(spark, text, mode) == want


def test_prompt_values_are_not_templates(spark):
    row = spark.range(1).select(P.result_prompt(F.lit("what is {result}?"), F.lit("S"), F.lit("R"))).first()[0]
    assert "Question: what is {result}?" in row and "SQL result:\nR\n" in row


def test_routing(spark):
    df = spark.createDataFrame([("How MANY users?",), ("Tell me a story",), (None,)], "q string")
    assert [r[0] for r in df.select(P.needs_sql(F.col("q"))).collect()] == [True, False, None]


def test_execute_and_text(spark):
    spark.createDataFrame([(1, "a"), (2, None)], "id int, name string").createOrReplaceTempView("people")
    db = S.SqlDatabase(spark)
    assert db.execute("SELECT id, name, id + 1 AS id FROM people WHERE id = :x", {"x": 1}).first().asDict() == {"id": 2, "name": "a"}
    assert db.execute("SELECT id FROM people WHERE id > ?", [1]).count() == 1
    records, columns = Q.records(db.execute("SELECT * FROM people WHERE id > 5"), 10)
    assert records == [] and columns == ["id", "name"]
    assert db.run("SELECT * FROM people ORDER BY id") == "id | name\n---------\n1 | a\n2 | None"
    assert db.run("SELECT * FROM people WHERE id > 5") == ""
    assert db.run("SELECT * FROM nowhere").startswith("Error executing query: ")
    assert Q.render_top(db.execute("SELECT * FROM people ORDER BY id DESC"), 1).first()[0] == "id | name\n---------\n2 | None"
    assert Q.render_top(db.execute("SELECT * FROM people WHERE id > 5")).first()[0] == "No results found."


def test_catalog_text(spark):
    spark.sql("CREATE OR REPLACE TEMPORARY VIEW tiny AS SELECT 1 AS id, CAST('x' AS STRING) AS name")
    assert "tiny" in [r.table_name for r in Q.usable_tables(spark).collect()]
    assert "tiny" not in [r.table_name for r in Q.usable_tables(spark, base_only=True).collect()]
    assert Q.usable_tables(spark, "no_such_schema").count() == 0
    text = Q.describe_tables(spark, ["tiny", "gone", "people"]).first()[0]
    assert text.startswith("Table: tiny\n  id int NOT NULL\n  name string NOT NULL\n\nTable: people\n")
    assert Q.describe_tables(spark, ["gone"]).first()[0] == ""


@F.pandas_udf(T.StringType())
def fake_sql(prompts: pd.Series) -> pd.Series:
    def respond(p):
        if "bad" in p:
            return "SQLQuery: SELECT 1 / 0 AS x FROM people"
        return None if "silent" in p else "SQLQuery: SELECT count(*) AS n FROM people"

    return prompts.map(respond)


@F.pandas_udf(T.StringType())
def fake_answer(prompts: pd.Series) -> pd.Series:
    return prompts.map(lambda p: None if "mute" in p else "Answer: " + p.split("SQL result:\n")[1].split("\n")[2])


def test_answer_batch(spark):
    spark.createDataFrame([(1, "a"), (2, None)], "id int, name string").createOrReplaceTempView("people")
    questions = spark.createDataFrame([(1, "count"), (2, "silent"), (3, "mute"), (4, "bad mute")], "qid int, question string")
    rows = {r.qid: r for r in S.SqlDatabase(spark).answer(questions, fake_sql, fake_answer, table_info="people").collect()}
    assert rows[1].result == "Answer: 2" and [s.step for s in rows[1].intermediate_steps] == ["sql_generation", "sql_execution", "result_formatting"]
    assert rows[2].result == "Error generating SQL query: no response" and rows[2].sql_query is None
    assert rows[3].result == "n\n-\n2"
    assert rows[4].result.startswith("Error executing SQL query: ") and "DIVIDE_BY_ZERO" in rows[4].result


def test_context(spark):
    questions = spark.createDataFrame([(1, "q"), (2, "count")], "qid int, question string")
    hits = spark.createDataFrame(
        [(1, 1, 0.98765, "s", "A"), (1, 2, None, None, "B")], "qid int, rank int, score double, source string, content string"
    )
    rows = {r.qid: r for r in rag.context(questions, hits).collect()}
    assert rows[1].context == "Document 1 (Score: 0.988, Source: s):\nA\n\nDocument 2 (Score: 0.000, Source: Unknown):\nB\n"
    assert rows[2].context == "No relevant documents found." and rows[2].n_documents == 0
    sql = spark.createDataFrame([(1, "r"), (2, "r")], "qid int, sql_result string")
    answers = {r.qid: r for r in rag.answer(questions, rag.context(questions, hits), sql, lambda c: F.length(c).cast("string")).collect()}
    assert not answers[1].sql_executed and answers[2].sql_executed and answers[1].n_documents == 2

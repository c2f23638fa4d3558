"""Stores bound to a folder of tables. Methods take and return DataFrames.

They only bind paths and defaults; the work is in ``operators`` and ``plans``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakeretrieve.functions import vectors as V
from lakeretrieve.functions.metadata import promote_keys, promoted_filter
from lakeretrieve.operators import blobs, chat, fulltext, hybrid, keyed, sqlsurface, vector
from lakeretrieve.plans import cells, postings, proven
from lakeretrieve.plans.appendlog import AppendTable, batch_numbers
from lakeretrieve.plans.changelog import ChangeLog
from lakeretrieve.session import materialise
from lakeretrieve.sources.tables import CHAT_TABLE, TEXT_TABLE, VECTOR_TABLE

Embedder = Callable[[Column], Column]


class VectorStore:
    """Texts with vectors. Adding does not deduplicate."""

    def __init__(self, spark: SparkSession, path: str, embedder: Embedder, metric: str = "cosine", element: str = "float"):
        self.spark, self.path, self.metric, self.element = spark, path.rstrip("/"), metric, element
        self.embedder = embedder
        schema = VECTOR_TABLE.replace("array<float>", f"array<{V.ELEMENT_TYPES.get(element, 'float')}>")
        self.table = AppendTable(spark, f"{self.path}/table", schema)

    def add_texts(self, texts: DataFrame, ids: str = "content") -> DataFrame:
        """Embed and append ``content[, metadata, id]``; returns the ids."""
        # Written once: a random id or a model must not be evaluated again.
        rows = materialise(vector.prepare_texts(texts, self.embedder, ids=ids, element=self.element), "texts")
        self.table.append(rows)
        return rows.select("id")

    def corpus(self) -> DataFrame:
        return self.table.current()

    def embed_queries(self, queries: DataFrame) -> DataFrame:
        # Written once: a search reads its queries several times.
        return materialise(queries.withColumn("qvector", self.embedder(F.col("query"))), "queries")

    def similarity_search_with_score(self, queries: DataFrame, k: int = 4, conditions: dict | None = None) -> DataFrame:
        """Hits with content and metadata for ``queries (qid, query)``."""
        asked = self.embed_queries(queries)
        corpus = self.corpus()
        hits = vector.knn_batch(corpus, asked, k, self.metric, conditions=conditions)
        return vector.with_payload(hits, corpus, queries.count() * k)

    def similarity_search(self, queries: DataFrame, k: int = 4, conditions: dict | None = None) -> DataFrame:
        return self.similarity_search_with_score(queries, k, conditions).drop("distance", "score")

    def similarity_search_by_vector(self, embedding: Sequence[float], k: int = 4, conditions: dict | None = None) -> DataFrame:
        hits = vector.knn(self.corpus(), embedding, k, self.metric, conditions=conditions, with_score=False)
        return hits.select("id", "content", "metadata")

    def max_marginal_relevance_search(
        self, queries: DataFrame, k: int = 4, fetch_k: int = 20, trade_off: float = 0.5, conditions: dict | None = None
    ) -> DataFrame:
        asked = self.embed_queries(queries)
        corpus = self.corpus()
        picks = vector.mmr_batch(corpus, asked, k, fetch_k, trade_off, self.metric, conditions=conditions)
        return vector.with_payload(picks, corpus, queries.count() * max(k, 1))

    def delete(self, ids: DataFrame) -> None:
        self.table.delete(ids)

    def build_index(self, n_cells: int | None = None, promote: dict[str, str] | None = None) -> None:
        """Index the present rows; an earlier index stays until it is replaced.

        ``promote`` names metadata keys with their SQL types; searches of the index can filter by them.
        """
        at = self.table.last_batch()
        corpus = self._indexed(self.corpus(), promote or {})
        model = cells.train_centres(corpus, n_cells, self.metric)
        cells.write_index(cells.assign_cells(corpus, model), f"{self.path}/cells/at={at}")
        rows = self.spark.read.parquet(f"{self.path}/cells/at={at}")
        centres = proven.with_radii(rows, cells.centre_table(self.spark, model), self.metric)
        centres.write.mode("overwrite").parquet(f"{self.path}/centres/at={at}")

    @staticmethod
    def _indexed(corpus: DataFrame, promote: dict[str, str]) -> DataFrame:
        return corpus.select("id", "embedding", *promote_keys(F.col("metadata"), promote))

    def _index(self) -> tuple[DataFrame, DataFrame]:
        """The index kept whole, and its centres: rows added since it was built
        join their nearest cell and may widen it, deleted rows are left out."""
        at = batch_numbers(self.spark, f"{self.path}/centres", "at")[-1]
        centres = self.spark.read.parquet(f"{self.path}/centres/at={at}")
        index = self.spark.read.parquet(f"{self.path}/cells/at={at}")
        if self.table.last_batch() > at:
            promoted = {f.name.removeprefix("meta_"): f.dataType.simpleString() for f in index.schema if f.name.startswith("meta_")}
            new = cells.assign_to_centres(self._indexed(self.table.rows_since(at), promoted), centres, self.metric).select(*index.columns)
            wider = proven.with_radii(new, centres, self.metric).select(F.col("id").alias("of"), F.col("radius").alias("r"), F.col("rows").alias("more"))
            centres = centres.join(F.broadcast(wider), F.col("id") == F.col("of")).select(
                "id", "vector", F.greatest("radius", "r").alias("radius"), (F.col("rows") + F.col("more")).alias("rows")
            )
            index = index.join(self.table.gone_since(at), "id", "left_anti").unionByName(new)
        return index, centres

    def search_index(
        self, queries: DataFrame, k: int = 4, nprobe: int | None = 8, *, conditions: dict | None = None, below: float | None = None
    ) -> DataFrame:
        """Hits on the index: among the ``nprobe`` nearest cells, or with ``nprobe=None``
        as many cells as prove that no nearer row is left. Conditions are on promoted keys."""
        index, centres = self._index()
        asked = self.embed_queries(queries)
        if nprobe is None:
            return proven.nearest_proven(index, centres, asked, k, self.metric, conditions=conditions, below=below)
        kept = index.filter(promoted_filter(index, conditions)) if conditions else index
        return cells.search_cells(kept, centres.select("id", "vector"), asked, k, nprobe, self.metric, below=below)


class FullTextStore:
    """Texts with an optional stored inverted index."""

    def __init__(self, spark: SparkSession, path: str, analyzer: str = "unicode"):
        self.spark, self.path, self.analyzer = spark, path.rstrip("/"), analyzer
        self.table = AppendTable(spark, f"{self.path}/table", TEXT_TABLE)

    def add_documents(self, documents: DataFrame, ids: str = "content") -> DataFrame:
        rows = materialise(vector.prepare_texts(documents, ids=ids), "texts")
        self.table.append(rows)
        return rows.select("id")

    def corpus(self) -> DataFrame:
        return self.table.current()

    def search(self, queries: DataFrame, k: int = 4, mode: str = "phrase", *, use_index: bool = False) -> DataFrame:
        corpus = self.corpus()
        index = self.index() if use_index else None
        hits = fulltext.search_batch(
            corpus, queries, k, mode, self.analyzer, postings=index, buckets=postings.BUCKETS if use_index else None
        )
        return vector.with_payload(hits, corpus, queries.count() * k)

    def delete(self, ids: DataFrame) -> None:
        self.table.delete(ids)

    def build_index(self) -> None:
        """Index the present rows; an earlier index stays until it is replaced."""
        at = self.table.last_batch()
        rows = postings.build_postings(self.corpus(), self.analyzer)
        postings.write_postings(rows, f"{self.path}/postings/at={at}")

    def index(self) -> DataFrame:
        """Stored postings kept whole: without the rows deleted since they were
        built, and with those of rows added since."""
        at = batch_numbers(self.spark, f"{self.path}/postings", "at")[-1]
        stored = self.spark.read.parquet(f"{self.path}/postings/at={at}")
        if self.table.last_batch() == at:
            return stored
        new = postings.build_postings(self.table.rows_since(at), self.analyzer)
        new = new.withColumn("bucket", postings.term_bucket())
        return stored.join(self.table.gone_since(at), "id", "left_anti").unionByName(new.select(*stored.columns))


class HybridStore(VectorStore):
    """One table searched by vector, by text or by both."""

    def __init__(self, *args, analyzer: str = "unicode", **options):
        super().__init__(*args, **options)
        self.analyzer = analyzer

    def search(
        self,
        queries: DataFrame,
        search_type: str = "hybrid",
        k: int = 4,
        alpha: float = 0.5,
        mode: str = "phrase",
        conditions: dict | None = None,
    ) -> DataFrame:
        corpus = self.corpus()
        hits = hybrid.retrieve(
            corpus,
            self.embed_queries(queries),
            search_type,
            k,
            alpha=alpha,
            metric=self.metric,
            mode=mode,
            analyzer=self.analyzer,
            conditions=conditions,
        )
        return vector.with_payload(hits, corpus, queries.count() * k)


class KeyValueStore:
    """Text values by key, with upsert. An empty value reads back as null."""

    VALUES = {"value": "string"}

    def __init__(self, spark: SparkSession, path: str):
        self.log = ChangeLog(spark, path, {"key": "string"}, self.VALUES)

    def mset(self, pairs: DataFrame, order: str | None = None) -> None:
        """Upsert ``key, value``; of duplicates the last by ``order`` wins."""
        self.log.put(pairs, order=order)

    def mget(self, requests: DataFrame) -> DataFrame:
        """Values for ``ord, key``, missing ones null."""
        return keyed.mget(requests, self.log.current(), list(self.VALUES))

    def mdelete(self, keys: DataFrame) -> None:
        self.log.delete(keys)

    def yield_keys(self, prefix: str | None = None) -> DataFrame:
        return keyed.yield_keys(self.log.current(), prefix)


class DocumentStore(KeyValueStore):
    """Documents with metadata by key."""

    VALUES = {"content": "string", "metadata": "string"}

    def mget(self, requests: DataFrame) -> DataFrame:
        found = keyed.mget(requests, self.log.current(), ["content"])
        return found.withColumnRenamed("content", "value")

    def mset(self, pairs: DataFrame, order: str | None = None) -> None:
        """Plain pairs ``key, value``: the metadata becomes null."""
        self.log.put(pairs.withColumnRenamed("value", "content"), order=order)

    def store_documents(self, documents: DataFrame, order: str | None = None) -> None:
        self.log.put(documents, order=order)

    def get_documents(self, requests: DataFrame, *, null_metadata_as_empty: bool = False) -> DataFrame:
        return keyed.get_documents(requests, self.log.current(), null_metadata_as_empty=null_metadata_as_empty)


class FileStore:
    """Binary files of one volume address."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        volume_type: str = "user",
        volume_name: str | None = None,
        subdirectory: str | None = None,
    ):
        blobs.check_address(volume_type, volume_name)
        self.address = (volume_type, volume_name, subdirectory)
        folder = "/".join([path.rstrip("/"), volume_type, volume_name or "_", (subdirectory or "").strip("/") or "_"])
        values = {"file_path": "string", "value": "binary", "mime_type": "string", "size": "bigint"}
        self.log = ChangeLog(spark, folder, {"key": "string"}, values)

    def store_files(self, files: DataFrame, order: str | None = None) -> None:
        """Upsert ``key, value[, mime_type]``."""
        keep = [] if order is None else [order]
        self.log.put(blobs.blob_rows(files, *self.address, keep=keep), order=order)

    mset = store_files

    def mget(self, requests: DataFrame) -> DataFrame:
        return blobs.get_bytes(requests, self.log.current())

    def get_files(self, requests: DataFrame) -> DataFrame:
        return blobs.get_files(requests, self.log.current())

    def list_files(self, prefix: str | None = None) -> DataFrame:
        return blobs.list_files(self.log.current(), prefix)

    def mdelete(self, keys: DataFrame) -> None:
        self.log.delete(keys)

    def yield_keys(self, prefix: str | None = None) -> DataFrame:
        return blobs.file_keys(self.log.current(), prefix)


class ChatHistory:
    """Messages of all sessions in one append-only table."""

    def __init__(self, spark: SparkSession, path: str):
        self.table = AppendTable(spark, path, CHAT_TABLE, "session_id")

    def add_messages(self, messages: DataFrame) -> None:
        """Append ``session_id, seq, ts, type, content``."""
        self.table.append(chat.encode(messages))

    def save_turns(self, turns: DataFrame) -> None:
        self.add_messages(chat.save_turns(turns))

    def log(self) -> DataFrame:
        return chat.decode(self.table.current())

    def messages(self, sessions: DataFrame | None = None) -> DataFrame:
        return chat.messages(self.log(), sessions)

    def last_messages(self, n: int) -> DataFrame:
        """The last n stored rows of each session; those that do not parse are then skipped."""
        return chat.decode(chat.last_messages(self.table.current(), n))

    def in_range(self, start: Column | None = None, end: Column | None = None) -> DataFrame:
        return chat.in_range(self.log(), start, end)

    def count_messages(self, sessions: DataFrame) -> DataFrame:
        return chat.count_messages(self.table.current(), sessions)

    def session_ids(self) -> DataFrame:
        return chat.session_ids(self.table.current())

    def transcript(self, sessions: DataFrame | None = None) -> DataFrame:
        return chat.transcript(self.log(), sessions)

    def memory_variables(self, sessions: DataFrame | None = None) -> DataFrame:
        return chat.memory_variables(self.log(), sessions)

    def clear(self, sessions: DataFrame | None = None) -> None:
        """Delete the listed sessions, or all."""
        self.table.delete(self.session_ids() if sessions is None else sessions)


class SqlDatabase:
    """SQL over the session's catalog."""

    def __init__(self, spark: SparkSession, database: str | None = None):
        self.spark, self.database = spark, database

    def execute(self, query: str, params: dict | Sequence | None = None) -> DataFrame:
        return sqlsurface.execute(self.spark, query, params)

    def usable_tables(self) -> DataFrame:
        return sqlsurface.usable_tables(self.spark, self.database)

    def table_info(self, tables: Sequence[str] | None = None) -> DataFrame:
        return sqlsurface.describe_tables(self.spark, tables, self.database)

    def run(self, query: str, limit: int | None = None) -> str:
        """Rows as a text table for a prompt, all of them without a limit; errors come back as text."""
        return sqlsurface.run_text(self.spark, query, limit)

    def answer(self, questions: DataFrame, generate, format_answer, **options) -> DataFrame:
        """Answers to ``qid, question``, prompted with the table description."""
        options.setdefault("table_info", self.table_info().first()[0])
        return sqlsurface.answer_batch(self.spark, questions, generate, format_answer, **options)

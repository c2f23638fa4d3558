"""Block postings: one row per (term, slice of documents), with term statistics.

An index is three tables below one folder. ``documents`` numbers the rows of
the corpus in id order. ``blocks`` holds, for a term and a slice of at most
``SLICE_DOCUMENTS`` documents, the gaps between its documents, its count in
each and the gaps between its positions. ``terms`` has the documents and
occurrences of each term. Blocks and terms are range-partitioned by term into
files of a measured size, so that Parquet's minima and maxima skip most of
them; a frequent term spreads over many files, a slice at a time.

No token is shuffled: a task turns its own documents into blocks, and only
blocks move. Every row of the corpus is a document of its own, also where ids
repeat, so a search never returns more than k rows. A null or empty text has
no terms and matches nothing; an empty corpus gives an empty index.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from lakeretrieve.functions.text import DEFAULT_ANALYZER, match_mode, tokenize
from lakeretrieve.plans.lookup import shipped, unshipped
from lakeretrieve.plans.postings import FEW_TERMS, query_terms
from lakeretrieve.plans.spread import input_bytes
from lakeretrieve.plans.topk import top_per_group
from lakeretrieve.session import drop_folder, materialise, scratch_path, shuffles_dropped, stored

# A slice ends at either number; a longer text is a slice by itself.
SLICE_DOCUMENTS = 4096
SLICE_TOKENS = 1 << 20
# Stored bytes that one task sorts: ten times as many in memory, so that it does not spill.
FILE_BYTES = 32 << 20
# Bits of the place in its partition in the number that Spark gives a row.
NUMBER_BITS = 33
# Positions that one batch of decoded rows may hold beyond its first block.
DECODED_ROWS = 1 << 20
# Bits of a candidate filter: sixteen a key, and at most 16 MB to ship.
FILTER_BITS_PER_KEY = 16
FILTER_BITS_MOST = 1 << 27

BLOCKS = (
    "term string, base bigint, documents int, occurrences bigint, "
    "docs array<int>, counts array<int>, positions array<int>"
)


def _slices(sizes: np.ndarray, most_rows: int, most: int) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of rows, each within both limits or a single row."""
    start, held = 0, 0
    for at, size in enumerate(sizes):
        if at > start and (at - start == most_rows or held + size > most):
            yield start, at
            start, held = at, 0
        held += size
    if start < len(sizes):
        yield start, len(sizes)


def _list(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values, type=kind))


def _encode(docs: np.ndarray, tokens: pa.ListArray) -> pa.RecordBatch | None:
    """The blocks of one slice of documents."""
    sizes = tokens.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    coded = tokens.flatten().dictionary_encode()
    total = len(coded)
    if not total:
        return None
    codes = coded.indices.to_numpy()
    row = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(total) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    order = np.argsort(codes, kind="stable")
    codes, row, place = codes[order], row[order], place[order]
    new_term = np.diff(codes, prepend=-1) != 0
    new_doc = new_term | (np.diff(row, prepend=-1) != 0)

    entries = np.flatnonzero(new_doc)
    counts = np.diff(np.append(entries, total))
    held = docs[row[entries]]
    first = new_term[entries]
    gaps = np.where(first, held - docs[0], np.diff(held, prepend=0))
    steps = np.where(new_doc, place, np.diff(place, prepend=0))
    documents = np.diff(np.append(np.flatnonzero(first), len(entries)))
    occurrences = np.diff(np.append(np.flatnonzero(new_term), total))
    return pa.record_batch(
        {
            "term": coded.dictionary.take(pa.array(codes[new_term])),
            "base": pa.array(np.full(len(documents), docs[0]), type=pa.int64()),
            "documents": pa.array(documents, type=pa.int32()),
            "occurrences": pa.array(occurrences, type=pa.int64()),
            "docs": _list(gaps, documents, pa.int32()),
            "counts": _list(counts, documents, pa.int32()),
            "positions": _list(steps, occurrences, pa.int32()),
        }
    )


def _to_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        docs = batch.column("doc").to_numpy()
        tokens = batch.column("tokens")
        sizes = tokens.value_lengths().to_numpy(zero_copy_only=False)
        # A task that reads several files may step back between two of them; no slice reaches into another file's numbers.
        edges = [0, *(np.flatnonzero((np.diff(docs) < 0) | (np.diff(docs >> NUMBER_BITS) != 0)) + 1), len(docs)]
        for first, last in zip(edges, edges[1:]):
            for start, end in _slices(sizes[first:last], SLICE_DOCUMENTS, SLICE_TOKENS):
                start, end = first + start, first + end
                block = _encode(docs[start:end], tokens.slice(start, end - start))
                if block is not None:
                    yield block


def _sums(gaps: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Running sums that start again at each list."""
    total = np.cumsum(gaps)
    return total - np.repeat((total - gaps)[np.cumsum(lengths) - lengths], lengths)


def _wanted(part: pa.RecordBatch, doc: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Whether each document of each block is among those asked for."""
    wanted = part.column("wanted")
    asked = np.repeat(np.arange(len(wanted)), wanted.value_lengths().to_numpy())
    numbers, place = np.unique(np.concatenate([doc, wanted.flatten().to_numpy()]), return_inverse=True)
    keys = np.concatenate([rows, asked]) * len(numbers) + place
    return np.isin(keys[: len(doc)], keys[len(doc) :])


def _decoder(with_positions: bool):
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("occurrences" if with_positions else "documents").to_numpy()
            for start, end in _slices(sizes, len(sizes), DECODED_ROWS):
                part = batch.slice(start, end - start)
                documents = part.column("documents").to_numpy()
                base = np.repeat(part.column("base").to_numpy(), documents)
                doc = base + _sums(part.column("docs").flatten().to_numpy(), documents)
                rows = np.repeat(np.arange(len(documents)), documents)
                columns = {}
                kept = _wanted(part, doc, rows) if "wanted" in part.schema.names else np.ones(len(doc), dtype=bool)
                if with_positions:
                    counts = part.column("counts").flatten().to_numpy()
                    pos = _sums(part.column("positions").flatten().to_numpy(), counts)
                    columns = {"pos": pa.array(pos[np.repeat(kept, counts)], type=pa.int32())}
                    counts = counts[kept]
                base, doc, rows = base[kept], doc[kept], rows[kept]
                if with_positions:
                    base, doc, rows = np.repeat(base, counts), np.repeat(doc, counts), np.repeat(rows, counts)
                term = part.column("term").take(pa.array(rows))
                yield pa.record_batch({"term": term, "base": pa.array(base), "doc": pa.array(doc), **columns})

    return decode


def decoded(blocks: DataFrame, *, positions: bool = True) -> DataFrame:
    """``(term, base, doc[, pos])`` of blocks; with a column ``wanted``, only of those documents."""
    columns = ["term", "base", "documents", "docs", *(["wanted"] if "wanted" in blocks.columns else [])]
    schema = "term string, base bigint, doc bigint"
    if positions:
        columns, schema = [*columns, "occurrences", "counts", "positions"], f"{schema}, pos int"
    return blocks.select(*columns).mapInArrow(_decoder(positions), schema)


def with_bases(documents: DataFrame, blocks: DataFrame) -> DataFrame:
    """``doc, id`` with the ``base`` of the slice that a document lies in, or of one before if that has no block here."""
    bases = blocks.select("base").distinct()
    before = Window.partitionBy(F.shiftright("doc", NUMBER_BITS)).orderBy("doc")
    marked = documents.join(bases, F.col("doc") == F.col("base"), "left")
    base = F.last("base", ignorenulls=True).over(before)
    return marked.select(*documents.columns, base.alias("base")).filter(F.col("base").isNotNull())


def decoded_ids(blocks: DataFrame, documents: DataFrame, *, positions: bool = True) -> DataFrame:
    """``(term, doc, id[, pos])`` of blocks.

    Whole blocks meet the ids of their slice, so no decoded row is shuffled; a
    group is one slice.
    """
    columns = ["term", "base", "documents", "docs", *(["occurrences", "counts", "positions"] if positions else [])]
    kind = documents.schema["id"].dataType.simpleString()
    schema = f"term string, doc bigint, id {kind}{', pos int' if positions else ''}"
    decode, names = _decoder(positions), ["term", "doc", "id", *(["pos"] if positions else [])]

    def meet(held: pa.Table, named: pa.Table) -> Iterator[pa.RecordBatch]:
        named = named.sort_by("doc")
        docs, ids = named.column("doc").to_numpy(), named.column("id").combine_chunks()
        for part in decode(iter(held.to_batches())):
            place = np.searchsorted(docs, part.column("doc").to_numpy())
            yield part.append_column("id", ids.take(pa.array(place))).select(names)

    def run(held: pa.Table, named: pa.Table) -> pa.Table:
        parts = list(meet(held, named)) if held.num_rows else []
        return pa.Table.from_batches(parts) if parts else arrow_empty

    arrow_empty = to_arrow_schema(T._parse_datatype_string(schema)).empty_table()
    met = blocks.select(*columns).groupBy("base").cogroup(with_bases(documents, blocks).groupBy("base"))
    return met.applyInArrow(run, schema)


def _counted(part: pa.RecordBatch) -> pa.RecordBatch:
    """Decoded rows of whole blocks, one row a term and document: how many places, the first, the last and their sum."""
    doc, pos = part.column("doc").to_numpy(), part.column("pos").to_numpy()
    term = part.column("term").dictionary_encode().indices.to_numpy()
    starts = np.flatnonzero((np.diff(term, prepend=-1) != 0) | (np.diff(doc, prepend=-1) != 0))
    ends = np.append(starts[1:], len(doc))
    sums = np.add.reduceat(pos.astype(np.int64), starts) if len(starts) else np.empty(0, np.int64)
    columns = {"n": ends - starts, "first_pos": pos[starts], "last_pos": pos[ends - 1], "sum_pos": sums}
    kinds = {"n": pa.int64(), "first_pos": pa.int32(), "last_pos": pa.int32(), "sum_pos": pa.int64()}
    held = {"term": part.column("term").take(pa.array(starts)), "doc": pa.array(doc[starts])}
    return pa.record_batch(held | {name: pa.array(values, kinds[name]) for name, values in columns.items()})


def counted_ids(blocks: DataFrame, documents: DataFrame) -> DataFrame:
    """``(term, id, n, first_pos, last_pos, sum_pos)``: the places of each term in the documents of an id.

    A task counts a slice as it decodes it. An id of one document has all its
    places there, so only those of ids with several documents are shuffled.
    """
    kind = documents.schema["id"].dataType.simpleString()
    schema = f"term string, id {kind}, n bigint, first_pos int, last_pos int, sum_pos bigint"
    names, decode = T._parse_datatype_string(schema).names, _decoder(True)
    arrow_empty = to_arrow_schema(T._parse_datatype_string(schema)).empty_table()

    def in_slices(held: DataFrame, named: DataFrame, alone: bool) -> DataFrame:
        def meet(held: pa.Table, named: pa.Table) -> Iterator[pa.RecordBatch]:
            named = named.sort_by("doc")
            docs, ids = named.column("doc").to_numpy(), named.column("id").combine_chunks()
            wanted = named.column("alone").to_numpy() == alone
            for part in decode(iter(held.to_batches())):
                counts = _counted(part)
                place = np.searchsorted(docs, counts.column("doc").to_numpy())
                kept = counts.append_column("id", ids.take(pa.array(place))).select(names)
                yield kept.filter(pa.array(wanted[place]))

        def run(held: pa.Table, named: pa.Table) -> pa.Table:
            parts = list(meet(held, named)) if held.num_rows else []
            return pa.Table.from_batches(parts) if parts else arrow_empty

        columns = ["term", "base", "documents", "docs", "occurrences", "counts", "positions"]
        return held.select(*columns).groupBy("base").cogroup(named.groupBy("base")).applyInArrow(run, schema)

    several = documents.groupBy(F.col("id").alias("of")).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")
    if several.isEmpty():
        return in_slices(blocks, with_bases(documents.withColumn("alone", F.lit(True)), blocks), True)
    marked = documents.join(several, F.col("id").eqNullSafe(F.col("of")), "left")
    named = with_bases(marked.select("doc", "id", F.col("rows").isNull().alias("alone")), blocks)
    shared = blocks.join(named.filter("not alone").select("base").distinct(), "base", "left_semi")
    added = in_slices(shared, named, False).groupBy("term", "id").agg(
        F.sum("n").alias("n"), F.min("first_pos").alias("first_pos"), F.max("last_pos").alias("last_pos"), F.sum("sum_pos").alias("sum_pos")
    )
    return in_slices(blocks, named, True).unionByName(added)


def build_blocks(numbered: DataFrame, analyzer: str = DEFAULT_ANALYZER, text: str = "content") -> DataFrame:
    """Blocks of documents with a number ``doc``, ascending within a partition."""
    tokens = F.coalesce(tokenize(F.col(text), analyzer), F.array().cast("array<string>"))
    return numbered.select("doc", tokens.alias("tokens")).mapInArrow(_to_blocks, BLOCKS)


def _files(df: DataFrame) -> int:
    """Files of the stated size; rows of unknown size have the session's number of partitions."""
    size, conf = input_bytes(df), df.sparkSession._jsparkSession.sessionState().conf()
    if size >= conf.defaultSizeInBytes():
        return conf.numShufflePartitions()
    return size // FILE_BYTES + 1


class BlockIndex:
    """The three tables of an index below a folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}")

    @property
    def documents(self) -> DataFrame:
        """``doc, id``."""
        return self._read("documents")

    @property
    def blocks(self) -> DataFrame:
        return self._read("blocks")

    @property
    def terms(self) -> DataFrame:
        """``term, documents, occurrences``."""
        return self._read("terms")

    def postings(self) -> DataFrame:
        """``(term, id, pos)`` of the whole index."""
        return decoded_ids(self.blocks, self.documents).select("term", "id", "pos")

    def counts(self) -> DataFrame:
        """``(term, id, n, first_pos, last_pos, sum_pos)`` of the whole index: its postings, counted by term and id."""
        return counted_ids(self.blocks, self.documents)


def write_index(corpus: DataFrame, path: str, analyzer: str = DEFAULT_ANALYZER, text: str = "content") -> BlockIndex:
    """Index ``id, content``. Numbers are written before they are used, so
    that a repeated task meets the same ones. Texts and blocks that the index
    is made from are deleted as soon as the next table is there."""
    spark = corpus.sparkSession
    # The last keys part a group of equal ids, or of equal rows, among tasks.
    keys = [F.col("id"), F.xxhash64(text), F.rand(17)]
    rows = corpus.select("id", text)
    tasks = max(_files(rows), spark.sparkContext.defaultParallelism)
    ranges = rows.repartitionByRange(tasks, *keys).sortWithinPartitions("id")
    index, texts, unsorted = BlockIndex(spark, path), scratch_path(spark, "numbered"), scratch_path(spark, "blocks")
    with shuffles_dropped(spark):
        numbered = stored(ranges.withColumn("doc", F.monotonically_increasing_id()), texts, "zstd")
        numbered.select("doc", "id").write.mode("overwrite").parquet(f"{index.path}/documents")
        made = stored(build_blocks(numbered, analyzer, text), unsorted, "zstd")
        drop_folder(spark, texts)
        (
            made.repartitionByRange(_files(made), "term", "base")
            .sortWithinPartitions("term", "base")
            .write.mode("overwrite")
            .option("compression", "zstd")
            .parquet(f"{index.path}/blocks")
        )
        drop_folder(spark, unsorted)
        # A term's blocks lie in one file or a few, so they are one row or a few before the shuffle.
        counted = index.blocks.groupBy("term").agg(
            F.sum("documents").cast("bigint").alias("documents"), F.sum("occurrences").alias("occurrences")
        )
        counted.orderBy("term").write.mode("overwrite").option("compression", "zstd").parquet(f"{index.path}/terms")
    return index


def candidate_filter(keys: DataFrame, columns: list[str], bits: int) -> DataFrame:
    """Bit maps of the hashed keys, ``bits / 32768`` rows of 4 KB at most."""
    at = F.pmod(F.xxhash64(*columns), F.lit(bits))
    return keys.groupBy(F.bitmap_bucket_number(at).alias("__bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("__bits")
    )


def filter_bits(n: int) -> int:
    """A power of two of bits for n keys, within the limit."""
    return min(1 << max(n * FILTER_BITS_PER_KEY, 1 << 15).bit_length(), FILTER_BITS_MOST)


def may_hold(rows: DataFrame, columns: list[str], bitmaps: DataFrame, bits: int) -> DataFrame:
    """Rows whose key is in the filter, and a few others; none is shuffled."""
    at = F.pmod(F.xxhash64(*columns), F.lit(bits))
    place = F.bitmap_bit_position(at)
    byte = F.conv(F.hex(F.substring("__bits", (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = byte.bitwiseAND(F.pow(F.lit(2), F.pmod(place, F.lit(8))).cast("int")) != 0
    joined = rows.join(F.broadcast(bitmaps), F.bitmap_bucket_number(at) == F.col("__bucket"))
    return joined.filter(hit).select(*rows.columns)


def _few_terms(terms: DataFrame) -> list[str] | None:
    """The words of a small set of queries, to become a filter of the scans."""
    words = terms.select("term").distinct().limit(FEW_TERMS + 1).collect()
    return [row.term for row in words] if len(words) <= FEW_TERMS else None


def _of_terms(rows: DataFrame, terms: DataFrame, n: int, few: list[str] | None) -> DataFrame:
    if few is not None:
        rows = rows.filter(F.col("term").isin(few))
    return rows.join(shipped(terms.select("term").distinct(), n), "term", "left_semi")


def _any_match(index: BlockIndex, terms: DataFrame, n: int, few: list[str] | None, k: int | None) -> DataFrame:
    wanted = terms.select("qid", "term").distinct()
    blocks = _of_terms(index.blocks, wanted, n, few)
    if k is None:
        # All terms of a slice are in one task, so that a hit of several terms is one row before the shuffle.
        rows = decoded_ids(blocks, index.documents, positions=False)
        return rows.join(shipped(wanted, n), "term").select("qid", "doc", "id").distinct()
    # The k first documents of a query are among the k first of its terms.
    rows = decoded(blocks, positions=False).select("term", "doc")
    rows = top_per_group(rows, ["term"], [F.col("doc")], k).drop("rank")
    return rows.join(shipped(wanted, n), "term").select("qid", "doc").distinct()


def rarest_terms(index: BlockIndex, terms: DataFrame, n: int, few: list[str] | None) -> DataFrame:
    """The rarest term of each query all of whose terms are known, from the statistics."""
    known = _of_terms(index.terms, terms, n, few)
    return (
        terms.join(shipped(known, n), "term", "left")
        .groupBy("qid")
        .agg(
            F.count(F.lit(1)).alias("n_terms"),
            F.count("documents").alias("n_known"),
            F.min(F.struct("documents", "occurrences", "qpos", "term")).alias("rarest"),
        )
        .filter(F.col("n_terms") == F.col("n_known"))
        .select("qid", "n_terms", F.col("rarest.term").alias("term"), F.col("rarest.qpos").alias("anchor"))
    )


def other_places(
    blocks: DataFrame, lookups: DataFrame, terms: DataFrame, n: int, few: list[str] | None, phrase: bool
) -> DataFrame:
    """Places of the other terms in the candidates.

    Blocks whose slice has no candidate of the term go by a bit map built from
    the candidates, before any shuffle. Of the rest only candidates are decoded;
    a slice bounds how many there are. The candidates grow with the corpus, so
    no task or driver holds them.
    """
    key = ["term", "base"]
    bits = filter_bits(lookups.count())
    near = may_hold(_of_terms(blocks, terms, n, few), key, candidate_filter(lookups, key, bits), bits)
    wanted = lookups.groupBy(*key).agg(F.collect_set("doc").alias("wanted"))
    return decoded(near.join(unshipped(wanted), key), positions=phrase)


def _all_match(index: BlockIndex, terms: DataFrame, n: int, few: list[str] | None, phrase: bool) -> DataFrame:
    """Documents with every term, from the places of each query's rarest one."""
    if not phrase:
        terms = terms.groupBy("qid", "term").agg(F.min("qpos").alias("qpos"))
    rarest = materialise(rarest_terms(index, terms, n, few), "anchors")
    blocks = index.blocks
    at_anchor = decoded(_of_terms(blocks, rarest, n, few), positions=phrase).join(shipped(rarest, n), "term")
    start = (F.col("pos") - F.col("anchor")) if phrase else F.lit(0)
    candidates = at_anchor.select("qid", "n_terms", "anchor", "base", "doc", start.alias("start")).filter("start >= 0")
    lookups = materialise(candidates.join(shipped(terms.select("qid", "qpos", "term"), n), "qid"), "lookups")
    single = lookups.filter("n_terms = 1").select("qid", "doc")
    others = lookups.filter("qpos != anchor").withColumn("pos", F.col("start") + F.col("qpos"))
    place = ["term", "doc", "pos"] if phrase else ["term", "doc"]
    found = unshipped(others).join(unshipped(other_places(blocks, others, terms, n, few, phrase).select(*place)), place)
    whole = (
        found.groupBy("qid", "doc", "start", "n_terms")
        .agg(F.count(F.lit(1)).alias("hits"))
        .filter(F.col("hits") == F.col("n_terms") - 1)
    )
    return whole.select("qid", "doc").unionByName(single).distinct()


def search_index(
    index: BlockIndex, queries: DataFrame, k: int | None = 4, mode: str = "phrase", analyzer: str = DEFAULT_ANALYZER
) -> DataFrame:
    """``(qid, rank, id, score)`` for ``queries (qid, query)``; without rank, all if k is None.

    Every hit scores 1.0 and ids ascend. Rows of one id are hits of their own.
    """
    terms = materialise(query_terms(queries, analyzer), "terms")
    n = terms.count()
    few = _few_terms(terms)
    kind = match_mode(mode)
    hits = _any_match(index, terms, n, few, k) if kind == "any" else _all_match(index, terms, n, few, kind == "phrase")
    score = F.lit(1.0).alias("score")
    if k is None:
        named = hits if "id" in hits.columns else unshipped(index.documents).join(unshipped(hits), "doc")
        return named.select("qid", "id", score)
    # Documents are numbered in id order, so ranking needs no ids.
    ranked = top_per_group(hits, ["qid"], [F.col("doc")], k)
    return index.documents.join(shipped(ranked, queries.count() * k), "doc").select("qid", "rank", "id", score)

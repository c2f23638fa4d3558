"""Token ids in a word-aligned binary form (Simple-8b), written and read back.

A word of 64 bits has a selector of 4 bits and 60 bits of payload; the
selector says how many ids of how many bits the payload holds. An id that no
payload can hold is an escape: its word has the place of the id in a table at
the end. Ids are coded in blocks, and a segment begins with the word offset of
each block, so that a block can be read by itself, and all words of a
selector are unpacked at once.

Segment: ``S8B1``; then as little-endian unsigned 32-bit numbers the ids,
words, blocks and escapes, and blocks + 1 word offsets; then the words and the
escapes as little-endian unsigned 64-bit numbers.

The table of segments is in ascending document order: ``part, seg, before``
(ids before it in its part), ``doc_ids``, ``lengths`` and ``payload``. It is
written by Spark's own writer, so a lost executor leaves no half segment.

Defined cases: a null or empty text has only the end id. Rows with equal ids
keep one order, by text; null ids come first. A document longer than a segment
has a segment of its own. An empty table gives no segments.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from public_tokenizers import path as vocabulary_path
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from lakeretrieve.llm.common import stored, whole
from lakeretrieve.llm.registry import QUERIES, table
from lakeretrieve.llm.tokens import encoder, few_at_once

MAGIC = b"S8B1"
# (ids, bits) of each selector; the last selector is the escape.
PACKINGS = [
    (240, 0), (120, 0), (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6),
    (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60),
]
ESCAPE = 15
# The least id of each number of bits: an id has as many bits as limits it reaches.
LIMITS = np.uint64(1) << np.arange(64, dtype=np.uint64)
# The escape keeps one id; its payload is a place in the table of escapes.
WIDEST = 30
BLOCK_IDS = 8192
SEGMENT_IDS = 1 << 18


def _steps(ids: np.ndarray) -> np.ndarray:
    """The selector that packs most ids at each place, as if a word began there.

    Of windows of growing length the widest id is kept, in bits; windows that
    reach beyond the end count as too wide.
    """
    n = len(ids)
    bits = np.full(n + PACKINGS[0][0], 255, np.uint8)
    bits[:n] = np.searchsorted(LIMITS, ids, side="right")
    best = np.full(n, ESCAPE, np.uint8)
    widest, reach = bits, 1
    for selector in reversed(range(ESCAPE)):
        count, width = PACKINGS[selector]
        while reach < count:
            more = min(count - reach, reach)
            widest, reach = np.maximum(widest[: len(widest) - more], widest[more:]), reach + more
        best[widest[:n] <= width] = selector
    return best


def encode_block(ids: np.ndarray, escapes: list[int]) -> np.ndarray:
    """Words of a block; ids that fit no packing are appended to ``escapes``."""
    steps = _steps(ids).tolist()
    counts = [c for c, _ in PACKINGS]
    at, places = 0, []
    while at < len(steps):
        places.append(at)
        at += counts[steps[at]]
    places = np.array(places, np.int64)
    selectors = np.array(steps, np.uint8)[places]
    out = selectors.astype(np.uint64) << np.uint64(60)
    for selector in np.unique(selectors):
        count, bits = PACKINGS[selector]
        who = np.flatnonzero(selectors == selector)
        if selector == ESCAPE:
            out[who] |= np.arange(len(escapes), len(escapes) + len(who), dtype=np.uint64)
            escapes.extend(ids[places[who]].tolist())
        elif bits:
            packed = ids[places[who][:, None] + np.arange(count)] << (np.arange(count, dtype=np.uint64) * np.uint64(bits))
            out[who] |= np.bitwise_or.reduce(packed, axis=1)
    return out


def encode_segment(ids: np.ndarray) -> bytes:
    escapes: list[int] = []
    ids = ids.astype(np.uint64)
    blocks = [encode_block(ids[at : at + BLOCK_IDS], escapes) for at in range(0, len(ids), BLOCK_IDS)]
    offsets = np.cumsum([0, *map(len, blocks)]).astype("<u4")
    head = MAGIC + struct.pack("<4I", len(ids), int(offsets[-1]), len(blocks), len(escapes))
    return b"".join([head, offsets.tobytes(), *[b.astype("<u8").tobytes() for b in blocks], np.array(escapes, "<u8").tobytes()])


def decode_segment(payload: bytes, first_block: int = 0, last_block: int | None = None) -> np.ndarray:
    """Ids of a segment, or of some of its blocks, as unsigned 64-bit numbers."""
    if payload[:4] != MAGIC:
        raise ValueError("not a segment of token ids")
    _, n_words, n_blocks, n_escapes = struct.unpack_from("<4I", payload, 4)
    offsets = np.frombuffer(payload, "<u4", n_blocks + 1, 20)
    at = 20 + 4 * (n_blocks + 1)
    coded = np.frombuffer(payload, "<u8", n_words, at)
    escapes = np.frombuffer(payload, "<u8", n_escapes, at + 8 * n_words)
    coded = coded[offsets[first_block] : offsets[n_blocks if last_block is None else last_block]]
    selectors = (coded >> np.uint64(60)).astype(np.uint8)
    counts = np.array([c for c, _ in PACKINGS])[selectors]
    starts = np.cumsum(counts) - counts
    out = np.zeros(int(counts.sum()), np.uint64)
    for selector in np.unique(selectors):
        count, bits = PACKINGS[selector]
        who = np.flatnonzero(selectors == selector)
        body = coded[who] & np.uint64((1 << 60) - 1)
        if selector == ESCAPE:
            out[starts[who]] = escapes[body.astype(np.int64)]
        elif bits:
            shifts = np.arange(count, dtype=np.uint64) * np.uint64(bits)
            out[starts[who][:, None] + np.arange(count)] = (body[:, None] >> shifts) & np.uint64((1 << bits) - 1)
    return out


SEGMENTS = "part int, seg int, before long, doc_ids array<long>, lengths array<long>, payload binary"
FIELDS = pa.schema(
    [
        ("part", pa.int32()), ("seg", pa.int32()), ("before", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("payload", pa.binary()),
    ]
)


def write_tokens(docs: DataFrame, vocabulary: str, end_id: int) -> DataFrame:
    """The stored table of segments of ``doc_id, text``."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_all = encoder(vocabulary).encode_all
        part, seg, before = TaskContext.get().partitionId(), 0, 0
        doc_ids, coded, held = [], [], 0

        def segment() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(coded), "<u4")
            lengths = [len(c) // 4 for c in coded]
            columns = zip((part, seg, before, doc_ids, lengths, encode_segment(ids)), FIELDS.types)
            return pa.RecordBatch.from_arrays([pa.array([value], kind) for value, kind in columns], schema=FIELDS)

        for batch in batches:
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encode_all(few_at_once(batch.column("text")))):
                ids += end
                if held and held + len(ids) > 4 * SEGMENT_IDS:
                    yield segment()
                    seg, before = seg + 1, before + held // 4
                    doc_ids, coded, held = [], [], 0
                doc_ids.append(doc_id)
                coded.append(ids)
                held += len(ids)
        if coded:
            yield segment()

    ordered = docs.select("doc_id", whole("text").alias("text")).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return stored(ordered.mapInArrow(run, SEGMENTS), "tokens", "none")


def read_tokens(segments: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the stored segments."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for part, before, doc_ids, lengths, payload in zip(rows["part"], rows["before"], rows["doc_ids"], rows["lengths"], rows["payload"]):
                ids = decode_segment(payload).astype("<u4")
                ends = np.cumsum(lengths)
                starts = ends - lengths
                yield pd.DataFrame(
                    {
                        "part": part,
                        "doc_id": pd.array(list(doc_ids), "Int64"),
                        "start": before + starts,
                        "n_tokens": lengths,
                        "ids_crc32": [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts, ends)],
                    }
                )

    read = segments.mapInPandas(run, "part int, doc_id long, start long, n_tokens long, ids_crc32 long")
    sizes = segments.select("part", (F.col("before") + F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)).alias("upto"))
    totals = sizes.groupBy("part").agg(F.max("upto").alias("ids"))
    # One row per written part, so the running sum is over a short table.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(F.col("part").alias("of"), F.coalesce(F.sum("ids").over(earlier), F.lit(0)).alias("offset"))
    return read.join(offsets, F.col("part") == F.col("of")).select("doc_id", (F.col("start") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32")


def op2_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_tokens(write_tokens(table(spark, sf_dir, "documents"), vocabulary_path("word_bpe_49k.json"), 2))


QUERIES["op2_token_file"] = op2_token_file

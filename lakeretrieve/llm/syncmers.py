"""Document fingerprints from closed syncmers.

A k-mer of characters is an anchor if the smallest hash among its s-mers is that
of its first or its last one. Whether it is one depends on its own characters
alone, so an edit changes no anchor outside its place. Two texts are matched by
position: equal anchors are paired, the first with the first and so on, and
the likeness is the share of all anchors of both texts that are in the longest run of pairs
standing in the same order in both. All anchors count, with their places;
paragraphs in another order are unlike.

The fingerprint as shown is 32 digits for the places and hashes of all anchors,
then the ``KEPT`` smallest hashes, by which alike texts can be looked up. An edit that
touches an anchor or moves one changes the first part.

Texts under ``SHORT`` characters have shorter anchors; a longer text is compared
with one of them by shorter anchors too.

Defined cases: a null text counts as empty, and an empty text has an empty
fingerprint, like only to another empty one. A text without anchors has one hash of
the whole text. Rows with equal ids follow each other by text; null ids come
first. A single document is its own next one. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from lakeretrieve.llm.common import stored, whole
from lakeretrieve.llm.registry import QUERIES, table

K, S = 16, 6
# Below so many characters anchors are shorter, so that short texts have some.
SHORT, SHORT_K, SHORT_S = 160, 6, 3
# Hashes shown of a text.
KEPT = 32

_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _MIX
    return h ^ (h >> np.uint64(31))


def _window_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbouring values, by windows of doubling length."""
    reach = 1
    while reach * 2 <= width:
        values = np.minimum(values[: len(values) - reach], values[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def syncmers(text: str, k: int = K, s: int = S) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the anchors of a text, in order."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    n = len(codes) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    inner = np.zeros(len(codes) - s + 1, np.uint64)
    for i in range(s):
        inner = inner * _FACTOR + codes[i : i + len(inner)]
    inner = _mixed(inner)
    width = k - s + 1
    least = _window_minimum(inner, width)
    places = np.flatnonzero((least == inner[:n]) | (least == inner[width - 1 : width - 1 + n]))
    hashes = np.zeros(len(places), np.uint64)
    for i in range(k):
        hashes = hashes * _FACTOR + codes[places + i]
    return places, _mixed(hashes)


Anchors = tuple[np.ndarray, np.ndarray]


def anchors(text: str, short: bool) -> Anchors:
    """Places and hashes of all anchors; of the whole text if it has none."""
    places, hashes = syncmers(text, *((SHORT_K, SHORT_S) if short else (K, S)))
    if text and not len(places):
        return np.zeros(1, np.int64), np.array([xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"))], np.uint64)
    return places, hashes


def _paired(a: Anchors, b: Anchors) -> np.ndarray:
    """Places in ``b`` of the anchors of ``a`` that have a partner, in the order of ``a``."""
    order_a, order_b = np.argsort(a[1], kind="stable"), np.argsort(b[1], kind="stable")
    sorted_a, sorted_b = a[1][order_a], b[1][order_b]
    turn = np.arange(len(sorted_a)) - np.searchsorted(sorted_a, sorted_a, "left")
    partner = np.searchsorted(sorted_b, sorted_a, "left") + turn
    has = partner < np.searchsorted(sorted_b, sorted_a, "right")
    places = np.full(len(order_a), -1, np.int64)
    places[order_a[has]] = b[0][order_b[partner[has]]]
    return places[places >= 0]


def in_order(places: np.ndarray) -> int:
    """Length of the longest ascending run of different numbers, not necessarily neighbours.

    A number above all before it and below all after it is in every such run;
    only the others are gone through one by one.
    """
    if len(places) < 2:
        return len(places)
    before = np.concatenate([[-1], np.maximum.accumulate(places)[:-1]])
    after = np.concatenate([np.minimum.accumulate(places[::-1])[::-1][1:], [np.iinfo(np.int64).max]])
    sure = (before < places) & (places < after)
    ends: list[int] = []
    for place in places[~sure].tolist():
        at = bisect_left(ends, place)
        ends[at : at + 1] = [place]
    return int(sure.sum()) + len(ends)


def likeness(a: Anchors, b: Anchors) -> float:
    """Share of the anchors of both texts that are paired in the same order."""
    total = len(a[0]) + len(b[0])
    return round(2 * in_order(_paired(a, b)) / total, 6) if total else 1.0


def shown(found: Anchors) -> str:
    places, hashes = found
    if not len(hashes):
        return ""
    every = xxhash.xxh3_128_hexdigest(places.astype("<u8").tobytes() + hashes.astype("<u8").tobytes())
    return every + np.unique((hashes >> np.uint64(32)).astype(np.uint32))[:KEPT].astype(">u4").tobytes().hex()


class Fingerprint:
    """A text with its anchors, found once for each length of anchors."""

    def __init__(self, text: str):
        self.text = text
        self.short = len(text) < SHORT
        self._found: dict[bool, Anchors] = {}

    def anchors(self, short: bool) -> Anchors:
        if short not in self._found:
            self._found[short] = anchors(self.text, short)
        return self._found[short]

    def like(self, other: Fingerprint) -> float:
        if self.text == other.text:
            return 1.0
        short = self.short or other.short
        return likeness(self.anchors(short), other.anchors(short))

    def __str__(self) -> str:
        return shown(self.anchors(self.short))


ROW = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def compared(doc_id: int | None, own: Fingerprint, following: Fingerprint) -> tuple:
    """A document against its edited text and against the next document."""
    cut = len(own.text) // 4
    text = own.text[: len(own.text) - cut] + following.text[:cut]
    edited = Fingerprint(text) if text != own.text else own
    return (
        doc_id,
        len(own.text),
        hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest(),
        str(own),
        str(edited),
        own.like(edited),
        own.like(following),
    )


def fingerprints(docs: DataFrame) -> DataFrame:
    """The columns of :data:`ROW` for ``doc_id, text``, each document beside the next by id.

    The table is sorted in ranges of ids. A task sees all neighbours but the
    one across its end; the first and last texts of the tasks are put together
    in a second, short step.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, previous = TaskContext.get().partitionId(), None
        names = ["part", "role", *ROW, "text"]
        for rows in batches:
            out = []
            for doc_id, text in zip(rows["doc_id"].astype(object), rows["text"]):
                doc_id, own = None if pd.isna(doc_id) else int(doc_id), Fingerprint(text)
                if previous is None:
                    out.append((part, "first", None, *[None] * (len(ROW) - 1), text))
                else:
                    out.append((part, "done", *compared(*previous, own), None))
                previous = (doc_id, own)
            made = pd.DataFrame(out, columns=names)
            yield made.astype({"doc_id": "Int64", "n_chars": "Int64"})
        if previous is not None:
            made = pd.DataFrame([(part, "last", previous[0], *[None] * (len(ROW) - 1), previous[1].text)], columns=names)
            yield made.astype({"doc_id": "Int64", "n_chars": "Int64"})

    def across(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out = [
                compared(None if pd.isna(doc_id) else int(doc_id), Fingerprint(text), Fingerprint(following))
                for doc_id, text, following in zip(rows["doc_id"].astype(object), rows["text"], rows["following"])
            ]
            yield pd.DataFrame(out, columns=ROW).astype({"doc_id": "Int64", "n_chars": "Int64"})

    ordered = docs.select("doc_id", whole("text").alias("text")).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    seen = stored(ordered.mapInPandas(run, f"part int, role string, {SCHEMA}, text string"), "neighbours")
    # One row per task, by its number only; texts are joined afterwards.
    order = Window.orderBy("part")
    parts = seen.where("role = 'last'").select("part")
    every = parts.select("part", F.lead("part").over(order).alias("after"), F.first("part").over(order).alias("start"))
    pairs = every.select(F.col("part").alias("from_part"), F.coalesce("after", "start").alias("to_part"))
    last = seen.where("role = 'last'").select("part", "doc_id", "text")
    first = seen.where("role = 'first'").select(F.col("part").alias("first_part"), F.col("text").alias("following"))
    ends = last.join(pairs, F.col("part") == F.col("from_part")).join(first, F.col("to_part") == F.col("first_part"))
    crossed = ends.select("doc_id", "text", "following").mapInPandas(across, SCHEMA)
    return seen.where("role = 'done'").select(*ROW).unionByName(crossed)


def op5_syncmer_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))


QUERIES["op5_syncmer_fingerprint"] = op5_syncmer_fingerprint

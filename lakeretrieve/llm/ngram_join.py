"""N-gram Jaccard join by token-combination prefixes.

A text's set holds its distinct word shingles as 64-bit hashes, the tokens. Two
sets link at a Jaccard similarity of ``num / den`` or more. All tokens have one
order, rare ones first. A set of ``n`` tokens that links with another lacks at
most ``n - ceil(n * num / den)`` of its tokens there, the slack.

Frequent tokens are divided into classes, and a class of order ``k`` is indexed by the
combinations of ``k`` of its tokens, rare tokens (``k = 1``) one by one. The
prefix of a set is extended until ``sum(max(0, c - k + 1))`` over the classes,
``c`` being the tokens of a class in the prefix, exceeds the slack. Take two
linked sets and the prefix that ends first: all that its set shares of it
lies in the other prefix too. If each class shared fewer than ``k`` tokens, the
set would lack more tokens than its slack; so two linked sets always share a
key. Classes are fine enough for a few tokens each, so that keys stay
proportional to the prefix, and depend on the band (power of two) of a set's
size only; a set whose smallest partner lies in the band below has keys in both.

How frequent a token is comes from counters over all texts, a fixed number of
them, shared by tokens of equal remainder. Any order and classes are exact, so
shared counters change the work and never the result.

Equal sets are one node. In a few turns, one node of each key is compared with the
key's nodes of other components; keys differ in it, so a group of near copies
is linked by several stars. Then the nodes that still meet other components are
all compared, in blocks where a key is crowded, and in one key of those that the same nodes have. Parities of the tokens bound how far two sets
differ, so nodes that share a passage only make no rows. Texts are fetched for the
pairs left, and the whole sets are compared. Texts meet in groups of one node
and at most about ``BLOCK`` others.

Defined cases: a text of fewer words than a shingle is one token. A null text
and a text without words have an empty set and are linked with nothing. Null ids are
never the smallest id unless a component has no other. Rows with equal ids are
separate rows. Other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from xxhash import xxh64_intdigest

from lakeretrieve.llm.common import bits_set, rows_kept, stored, unused, with_bit_tests, with_row_key
from lakeretrieve.llm.components import connected_components
from lakeretrieve.llm.registry import QUERIES, table

WIDTH = 4
SIMILARITY = (85, 100)
# Counters that all tokens share; their number is the size of what each task holds.
COUNTERS = 1 << 18
# Texts above a counter's usual load from which a token is of order 2 and of order 3.
FREQUENT = (32, 1024)
# Smallest size of a band for each class of an order.
TOKENS_PER_CLASS = 10
# Other nodes that a node is compared with in one group, and nodes of a block of a crowded key.
BLOCK = 256
CROWDED = 4096
ROW = "__row"
# Turns of stars before all remaining pairs are compared; more of them leave fewer pairs.
TURNS = 2
# Nodes that lead the keys of one group of near copies.
LEADERS = 8
PARITIES = [f"p{i}" for i in range(4)]

ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Hashes whose bits all depend on all bits of ``x``."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _combined(columns: list[np.ndarray]) -> np.ndarray:
    """One hash of the numbers in a row, in their order."""
    found = np.full(len(columns[0]), len(columns), np.uint64)
    for i, column in enumerate(columns):
        found = _mixed(found + column * ODD[i % len(ODD)])
    return found


def shingle_hashes(text: bytes | None, width: int) -> np.ndarray:
    """Hashes of all shingles in order; bytes.split and bytes.lower act on ASCII only."""
    found = (text or b"").lower().split()
    each = np.fromiter(map(xxh64_intdigest, found), np.uint64, len(found))
    width = min(width, len(each))
    if not width:
        return each
    return _combined([each[i : len(each) - width + 1 + i] for i in range(width)])


def token_set(text: bytes | None, width: int) -> np.ndarray:
    return np.unique(shingle_hashes(text, width))


def texts_of(batch: pa.RecordBatch) -> list[bytes | None]:
    return batch.column("text").to_pylist()


def token_loads(texts: DataFrame, width: int) -> np.ndarray:
    """How often tokens of each remainder occur in all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loads = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            every = [shingle_hashes(t, width) for t in texts_of(batch)]
            if every:
                loads += np.bincount((np.concatenate(every) % np.uint64(COUNTERS)).view(np.int64), minlength=COUNTERS)
        seen = np.flatnonzero(loads)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(loads[seen])], ["counter", "n"])

    each = texts.mapInArrow(run, "counter long, n long").groupBy("counter").agg(F.sum("n").alias("n"))
    # Columns, not rows: the driver holds two numbers a counter.
    counts = each.toArrow()
    loads = np.zeros(COUNTERS, np.int64)
    loads[counts["counter"].to_numpy()] = counts["n"].to_numpy()
    return loads


def order_limits(loads: np.ndarray, frequent: tuple[int, int] = FREQUENT) -> list[float]:
    """Loads above which a token is of order 2 and of order 3: well outside what rare tokens make of a counter."""
    usual = float(np.median(loads))
    return [usual + max(f, 6 * usual**0.5) for f in frequent]


def band_of(n: int) -> int:
    return n.bit_length() - 1


def classes_in(band: int, num: int, den: int) -> int:
    """Classes of each order in a band; none if sets of it could run out of tokens before their slack is covered."""
    least = 1 << band
    wanted = max(1, least // TOKENS_PER_CLASS)
    return wanted if 3 * wanted <= -(-least * num // den) - 1 else 0


@lru_cache(maxsize=4096)
def _choices(n: int, k: int) -> np.ndarray:
    return np.array(list(itertools.combinations(range(n), k)), np.int64)


def prefix_keys(tokens: np.ndarray, loads: np.ndarray, limits: list[float], num: int, den: int) -> np.ndarray:
    """The keys of a set: hashes of rare tokens and of combinations of frequent ones in its prefix."""
    n = len(tokens)
    if n * den < num * (n + 1):  # even one token more or less is too many: only equal sets link
        return np.zeros(0, np.int64)
    load = loads[(tokens % np.uint64(len(loads))).view(np.int64)]
    ordered = np.lexsort((tokens, load))
    tokens, load = tokens[ordered], load[ordered]
    least = -(-n * num // den)
    covered = n - least + 1
    found = []
    for band in {band_of(n), band_of(least)}:
        classes = classes_in(band, num, den)
        order = 1 + (load > limits[0]) + (load > limits[1]) if classes else np.ones(n, np.int64)
        if order[covered - 1] == 1:  # loads ascend
            each = [tokens[:covered]]
        else:
            kind = np.where(order == 1, -1, (order - 2) * classes + (tokens % np.uint64(classes)).view(np.int64))
            by_kind = np.argsort(kind, kind="stable")
            starts = np.flatnonzero(np.concatenate(([True], kind[by_kind][1:] != kind[by_kind][:-1])))
            nth = np.empty(n, np.int64)
            nth[by_kind] = np.arange(n) - np.repeat(starts, np.diff(np.append(starts, n)))
            covers = (order == 1) | (nth + 1 >= order)
            end = int(np.searchsorted(np.cumsum(covers), covered)) + 1
            each = [tokens[:end][order[:end] == 1]]
            within = by_kind[by_kind < end]
            kinds = kind[within]
            edges = [0, *(np.flatnonzero(kinds[1:] != kinds[:-1]) + 1).tolist(), len(within)]
            for a, b in zip(edges, edges[1:]):
                k = int(order[within[a]])
                if kinds[a] >= 0 and b - a >= k:
                    chosen = tokens[within[a:b]][_choices(b - a, k)]
                    each.append(_combined([chosen[:, i] for i in range(k)]))
        found.append(_mixed(np.concatenate(each) + ODD[:1] * np.uint64(band)))
    return np.concatenate(found).view(np.int64)


def parities(tokens: np.ndarray, width: int = 64 * len(PARITIES)) -> np.ndarray:
    """Whether an odd number of tokens falls on each of ``width`` bits. Sets differ in at least as many tokens as bits."""
    odd = np.bincount((tokens % np.uint64(width)).view(np.int64), minlength=width) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def wide_parities(tokens: np.ndarray) -> np.ndarray:
    """A bit a token or more for sets beyond the narrow width, else none. Half as many bits are both halves' exclusive or."""
    n = len(tokens)
    return parities(tokens, 1 << (n - 1).bit_length()) if n > 64 * len(PARITIES) else np.zeros(0, np.int64)


def with_row_numbers(docs: DataFrame, key: str = "row") -> DataFrame:
    """The rows with a number that tells them apart and stays the same when the table is read again.

    Files know the place of each row; other tables are stored with numbers.
    """
    if "_metadata" not in docs.columns:
        try:
            return docs.select("*", F.xxhash64(F.col("_metadata.file_path"), F.col("_metadata.row_index")).alias(key))
        except AnalysisException:
            pass
    return with_row_key(docs, key)


def _texts(docs: DataFrame, key: str) -> DataFrame:
    return docs.select("doc_id", F.col("text").cast("binary").alias("text"), F.col(key).alias("row"))


def with_keys(numbered: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """``doc_id, row, fp, n, p0 .., wide, keys``; of equal sets in a task the first has the keys."""
    loads = token_loads(numbered.select("text"), width)
    limits = order_limits(loads)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            prints, sizes, bits, wide, keys = [], [], [], [], []
            for text in texts_of(batch):
                found = token_set(text, width)
                fp = xxh64_intdigest(found.tobytes()) - 2**63
                keys.append([] if fp in seen else prefix_keys(found, loads, limits, num, den))
                seen.add(fp)
                prints.append(fp)
                sizes.append(len(found))
                bits.append(parities(found))
                wide.append(wide_parities(found))
            bits = np.array(bits, np.int64).reshape(-1, len(PARITIES))
            columns = [pa.array(prints, pa.int64()), pa.array(sizes, pa.int64()), *[pa.array(bits[:, i]) for i in range(len(PARITIES))]]
            lists = [pa.array(x, pa.list_(pa.int64())) for x in (wide, keys)]
            names = ["doc_id", "row", "fp", "n", *PARITIES, "wide", "keys"]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("row"), *columns, *lists], names)

    kind = numbered.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, row long, fp long, n long, {', '.join(f'{p} long' for p in PARITIES)}, wide array<long>, keys array<long>"
    return stored(numbered.select("doc_id", "row", "text").mapInArrow(run, schema), "sets")


def may_link(num: int, den: int) -> Column:
    """Whether sizes and parities of ``a`` and ``b`` allow a link; true for every link.

    Of sizes ``x`` and ``y``, sets that differ in ``d`` tokens have a
    similarity of ``(x + y - d) / (x + y + d)``.
    """
    differ = sum((F.bit_count(F.col(f"a_{p}").bitwiseXOR(F.col(f"b_{p}"))) for p in PARITIES), F.lit(0).cast("long"))
    sizes = F.least("a_n", "b_n") * den >= F.greatest("a_n", "b_n") * num
    return sizes & _near_enough(differ, num, den)


def _near_enough(differ: Column, num: int, den: int) -> Column:
    both = F.col("a_n") + F.col("b_n")
    return den * (both - differ) >= num * (both + differ)


def may_link_long(num: int, den: int) -> Column:
    """The same by the parities of long sets, the wider one folded to the other's width; true without them."""

    def folded(x: Column) -> Column:
        half = (F.size(x) / 2).cast("int")
        return F.zip_with(F.slice(x, F.lit(1), half), F.slice(x, half + 1, half), lambda u, v: u.bitwiseXOR(v))

    a, b = F.col("a_wide"), F.col("b_wide")
    narrow_a = F.when(F.size(a) > F.size(b), folded(a)).otherwise(a)
    narrow_b = F.when(F.size(b) > F.size(a), folded(b)).otherwise(b)
    each = F.zip_with(narrow_a, narrow_b, lambda u, v: F.bit_count(u.bitwiseXOR(v)).cast("long"))
    differ = F.aggregate(each, F.lit(0).cast("long"), lambda total, x: total + x)
    return (F.size(a) == 0) | (F.size(b) == 0) | _near_enough(differ, num, den)


def _side(nodes: DataFrame, side: str, columns: tuple[str, ...]) -> DataFrame:
    return nodes.select(*[F.col(c).alias(f"{side}_{c}") for c in columns])


def bounded(pairs: DataFrame, nodes: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs ``a, b`` of nodes that sizes and parities allow to link."""
    columns = ("fp", "n", *PARITIES, "wide")
    a, b = _side(nodes, "a", columns), _side(nodes, "b", columns)
    met = pairs.join(a, F.col("a") == F.col("a_fp")).join(b, F.col("b") == F.col("b_fp"))
    return met.where(may_link(num, den) & may_link_long(num, den)).select("a", "b")


def texts_at(numbered: DataFrame, places: DataFrame) -> DataFrame:
    """``places``, which has a ``first_row``, with the text of that row.

    Only rows whose hash falls on a bit set by a wanted row are shuffled. The
    bits are a table of ``FILTER_BITS / 64`` rows at most; where more rows are
    wanted than it can tell apart, more texts are shuffled and the result is the same.
    """
    bits = bits_set(places, "first_row", "word", wanted=F.lit(True))
    wanted = with_bit_tests(numbered.select("row", "text"), "row", bits, "word").where("wanted").select("row", "text")
    return wanted.join(places, F.col("row") == F.col("first_row")).drop("row", "first_row")


def linked_pairs(pairs: DataFrame, numbered: DataFrame, nodes: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """Those of the distinct pairs ``a, b`` of nodes whose whole sets link.

    A node's partners are dealt to blocks, so that a node with many partners
    is held by many tasks. In each block the node's own text comes first, and
    one set is in memory besides that of the text at hand.
    """
    blocks = pairs.groupBy(F.col("a").alias("of")).agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    dealt = pairs.join(blocks, F.col("a") == F.col("of")).select("a", "b", F.pmod(F.xxhash64("b"), F.col("blocks")).cast("int").alias("block"))
    asked = dealt.select("a", "block", F.col("b").alias("node")).unionByName(dealt.select("a", "block", F.col("a").alias("node")).distinct())
    places = stored(asked.join(nodes.select("fp", "first_row"), F.col("node") == F.col("fp")).select("a", "block", "node", "first_row"), "asked")
    texts = texts_at(numbered, places).withColumn("other", F.col("node") != F.col("a"))
    groups = texts.repartition("a", "block").sortWithinPartitions("a", "block", "other")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, tokens = None, np.zeros(0, np.uint64)
        for batch in batches:
            left, right = [], []
            columns = [batch.column(c).to_pylist() for c in ("a", "block", "node")]
            for a, block, node, text in zip(*columns, texts_of(batch)):
                found = token_set(text, width)
                if xxh64_intdigest(found.tobytes()) - 2**63 != node:
                    continue  # another row with the hash of this one's place
                if (a, block) != held:
                    held, tokens = (a, block), found
                    continue
                both = len(np.intersect1d(tokens, found, assume_unique=True))
                if den * both >= num * (len(tokens) + len(found) - both) and node != a:
                    left.append(a)
                    right.append(node)
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["a", "b"])

    return stored(groups.mapInArrow(run, "a long, b long"), "linked")


def _mixed_keys(shared: DataFrame, roots: DataFrame) -> DataFrame:
    """``key, fp, root`` of the keys in which different components still meet."""
    named = shared.join(roots, F.col("fp") == F.col("node"), "left").select("key", "fp", F.coalesce("root", "fp").alias("root"))
    ends = named.groupBy(F.col("key").alias("of")).agg(F.min("root").alias("least"), F.max("root").alias("most"))
    return stored(named.join(ends.where("least <> most").select("of"), F.col("key") == F.col("of"), "left_semi"), "mixed")


def _star_pairs(mixed: DataFrame, turn: int) -> DataFrame:
    """Pairs of one node of each key with its nodes of other components.

    Keys with the same nodes have one of ``LEADERS`` leaders in the first turn; later, when
    most nodes have found their component, each key has one of its own.
    """
    of = F.pmod("key", F.lit(LEADERS)) if turn == 0 else F.col("key")
    pick = F.struct(F.xxhash64("fp", of, F.lit(turn)), "fp", "root")
    leaders = mixed.groupBy(F.col("key").alias("of")).agg(F.min(pick).alias("leader"))
    met = mixed.join(leaders, F.col("key") == F.col("of")).where(F.col("root") != F.col("leader.root"))
    return met.select(F.least("fp", "leader.fp").alias("a"), F.greatest("fp", "leader.fp").alias("b")).distinct()


def _node_sets(mixed: DataFrame) -> DataFrame:
    """``key, n, nodes0, nodes1``: what tells the nodes of each key, their number and 128 bits of hashes."""
    nodes = [F.bit_xor(F.xxhash64("fp", F.lit(i))).alias(f"nodes{i}") for i in range(2)]
    return mixed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), *nodes)


def _distinct_keys(mixed: DataFrame) -> DataFrame:
    """``of, n, nodes0, nodes1``: one key of those that the same nodes have, with how many they are.

    A passage that long texts share gives them hundreds of keys.
    """
    return _node_sets(mixed).groupBy("n", "nodes0", "nodes1").agg(F.min("key").alias("of")).select("of", "n", "nodes0", "nodes1")


def _met_in(mixed: DataFrame) -> DataFrame:
    """``key, fp, root`` with fewer keys, in which all nodes still meet that met before.

    A group of texts with much in common meets in hundreds of keys, each without the few nodes that
    differ there. The largest key of a node is its main one, and a key goes into the main key that most of its
    nodes have, if that one goes into itself: its nodes join those of the main key, so none of its
    pairs is lost. Where the nodes that came along make more pairs than the keys had one by one, only
    keys without a foreign node go into the main one.
    """
    classes = stored(_node_sets(mixed).join(_distinct_keys(mixed), ["n", "nodes0", "nodes1"]).select("key", "of", "n"), "classes")
    placed = mixed.join(classes.withColumnRenamed("key", "__key"), F.col("key") == F.col("__key")).select("fp", "of", "n").distinct()
    main = F.max(F.struct("n", "of")).over(Window.partitionBy("fp")).getField("of")
    shares = placed.select("of", "n", main.alias("main")).groupBy("of", "n", "main").agg(F.count(F.lit(1)).alias("own"))
    most = shares.groupBy("of", "n").agg(F.max(F.struct("own", "main")).alias("most")).select("of", "n", "most.*")
    most = stored(most, "most")
    heads = most.where("of = main").select(F.col("of").alias("head"))
    joined = most.join(heads, F.col("main") == F.col("head"), "left").select(
        "of", "n", (F.col("n") > F.col("own")).alias("foreign"), F.coalesce("head", "of").alias("into")
    )
    joined = stored(joined, "into")

    def regrouped(into: DataFrame) -> DataFrame:
        names = classes.select(F.col("key").alias("__key"), "of").join(into.select(F.col("of").alias("__of"), "into"), F.col("of") == F.col("__of"))
        met = mixed.join(names.select("__key", "into"), F.col("key") == F.col("__key"))
        return stored(met.select(F.col("into").alias("key"), "fp", "root").distinct(), "met")

    met = regrouped(joined)
    before = joined.groupBy("into").agg(F.sum(F.col("n") * F.col("n")).alias("pairs"))
    now = met.groupBy(F.col("key").alias("dear")).agg(F.count(F.lit(1)).alias("now"))
    dear = stored(now.join(before, F.col("dear") == F.col("into")).where(F.col("now") * F.col("now") > F.col("pairs")).select("dear"), "dear")
    if dear.isEmpty():
        return met
    alone = F.col("dear").isNotNull() & F.col("foreign")
    return regrouped(joined.join(dear, F.col("into") == F.col("dear"), "left").select("of", F.when(alone, F.col("of")).otherwise(F.col("into")).alias("into")))


def _rest_pairs(mixed: DataFrame, nodes: DataFrame, num: int, den: int) -> DataFrame:
    """All pairs of different components that meet in a key and may link."""
    mixed = _met_in(mixed)
    crowds = mixed.groupBy(F.col("key").alias("of")).agg(F.ceil(F.count(F.lit(1)) / CROWDED).cast("int").alias("blocks"))
    own = mixed.join(crowds, F.col("key") == F.col("of")).withColumn("own", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
    # Every pair of blocks is a group of its own; a pair within one block meets in that block's own group.
    paired = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "key", "fp", "root", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")
    )
    rows = stored(paired.join(nodes.select("fp", "n", *PARITIES, "wide"), "fp"), "apart")
    columns = ("fp", "n", *PARITIES, "wide", "key", "i", "j", "own", "root")
    same_group = (F.col("a_key") == F.col("b_key")) & (F.col("a_i") == F.col("b_i")) & (F.col("a_j") == F.col("b_j"))
    once = (F.col("a_fp") < F.col("b_fp")) & ((F.col("a_i") == F.col("a_j")) | (F.col("a_own") != F.col("b_own")))
    near = once & (F.col("a_root") != F.col("b_root")) & may_link(num, den) & may_link_long(num, den)
    met = _side(rows, "a", columns).join(_side(rows, "b", columns), same_group & near)
    return met.select(F.col("a_fp").alias("a"), F.col("b_fp").alias("b")).distinct()


def node_roots(sets: DataFrame, numbered: DataFrame, nodes: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """``node, root`` of every node that links with another."""
    keyed = sets.where(F.size("keys") > 0).select(F.explode("keys").alias("key"), "fp")
    ends = keyed.groupBy(F.col("key").alias("of")).agg(F.min("fp").alias("least"), F.max("fp").alias("most"))
    several = stored(ends.where("least <> most").select("of"), "several")
    # Most keys have one node; the bits of the others keep them from a second shuffle.
    likely = with_bit_tests(keyed, "key", bits_set(several, "of", "word", likely=F.lit(True)), "word").where("likely")
    met = likely.select("key", "fp").join(several, F.col("key") == F.col("of"), "left_semi")
    shared = stored(met.distinct(), "shared")

    def verified(pairs: DataFrame) -> DataFrame:
        return linked_pairs(stored(bounded(pairs, nodes, num, den), "pairs"), numbered, nodes, width, num, den)

    def joined(roots: DataFrame, links: DataFrame) -> DataFrame:
        both = roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(links)
        return stored(connected_components(both), "roots")

    mixed = shared.withColumn("root", F.col("fp"))
    roots = sets.sparkSession.createDataFrame([], "node long, root long")
    for turn in range(TURNS):
        links = verified(_star_pairs(mixed, turn))
        if links.isEmpty():
            break
        roots = joined(roots, links)
        mixed = _mixed_keys(shared, roots)
    rest = verified(_rest_pairs(mixed, nodes, num, den))
    return roots if rest.isEmpty() else joined(roots, rest)


def rooted(texts: DataFrame, width: int = WIDTH, num: int = SIMILARITY[0], den: int = SIMILARITY[1]) -> tuple[DataFrame, DataFrame]:
    """The sets of rows of ``doc_id, text, row``, and ``fp, least, root`` of each node."""
    sets = with_keys(texts, width, num, den)
    alike = [F.first(c).alias(c) for c in ("n", *PARITIES, "wide")]
    nodes = sets.where("n > 0").groupBy("fp").agg(*alike, F.min("row").alias("first_row"), F.min("doc_id").alias("least"))
    nodes = stored(nodes, "nodes")
    roots = node_roots(sets, texts, nodes, width, num, den)
    named = nodes.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    return sets, named


def components(docs: DataFrame, width: int = WIDTH, num: int = SIMILARITY[0], den: int = SIMILARITY[1]) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every document."""
    own = docs if "_metadata" not in docs.columns else docs.drop("_metadata")
    texts = _texts(with_row_numbers(own.select("doc_id", "text"), ROW), ROW)
    sets, named = rooted(texts, width, num, den)
    smallest = named.groupBy(F.col("root").alias("of")).agg(F.min("least").alias("component_id"))
    member = named.join(smallest, F.col("root") == F.col("of")).select(F.col("fp").alias("node"), "component_id")
    placed = sets.where("n > 0").join(member, F.col("fp") == F.col("node")).select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return placed.unionByName(sets.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def keep_one(docs: DataFrame, width: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """One row of each component, with its own columns: that of the smallest id, null ids last, of equal ids any one.

    Texts without words are copies of each other here.
    """
    key = unused(ROW, docs)
    numbered = with_row_numbers(docs, key)
    sets, named = rooted(_texts(numbered, key), width, num, den)
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first")
    # Equal sets come down to one row before they meet their component.
    by_node = sets.groupBy(F.col("fp").alias("node"), (F.col("n") > 0).alias("full")).agg(first)
    met = by_node.join(named, F.col("node") == F.col("fp"), "left")
    kept = met.groupBy(F.coalesce("root", F.lit(0)), "full").agg(F.min("first").alias("first")).select("first.row")
    return rows_kept(numbered, key, stored(kept, "kept"), docs.columns)


def op11_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return components(table(spark, sf_dir, "documents"))


QUERIES["op11_ngram_join"] = op11_ngram_join

"""Line dedup across a corpus: equal lines, and lines within a few edits.

Lines of at least ``min_chars`` code points take part. A line is kept where it
first occurs, in order of document and position, unless a line that first
occurs earlier is within ``edits`` single-character edits of it.

The edit join cuts a line of length l into ``edits + 1`` segments. Within
``edits`` edits a longer line still contains one of a shorter line's segments,
at a place close to where the segment stood. Each line therefore lists its own
segments, and for each length that a partner may have, the substrings at those
places (positions for which the edits before and after them still suffice).
Lines meet on (length, segment number, text) as 64-bit hashes, and pairs are
verified on the texts by a bit-parallel edit distance in a band of
``2 * edits + 1`` diagonals. All of it is column expressions and joins.

Lines are identified by two 64-bit hashes, so that texts are not shuffled for
the join; only lines of candidate pairs are fetched. Equal lines are combined
before the shuffle, so a line in every document is one row.

Defined cases: a null text has no lines and stays null; an empty one stays
empty. A document all of whose lines go keeps its row with an empty text.
Shorter lines, blank ones among them, always stay. Rows with equal ids count
as one document, and each keeps those of its lines that the document keeps. Null ids come last, by a hash of their text.
Columns named like an output column are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakeretrieve.llm.common import let, stored, whole
from lakeretrieve.llm.registry import ORACLES, QUERIES, table
from lakeretrieve.plans.lookup import shipped

EDITS = 1
MIN_CHARS = 20
# Lines of one document that an order number has room for.
ROOM = 2**31
UNNAMED = 2**62
# Characters whose counts are compared before two texts are; each costs a pass over every line.
COUNTED = "etaoinsrhl"


def _document(text: Column) -> Column:
    """The id, or for a null id a number above usual ids."""
    return F.coalesce("doc_id", F.lit(UNNAMED) + F.pmod(F.xxhash64(text), F.lit(2**61)))


def segment_keys(line: Column, chars: Column, edits: int) -> list[tuple[Column, bool]]:
    """Hash keys of a line, each with whether it is one of the line's own segments."""
    parts = edits + 1
    found = []
    for shorter in range(edits + 1):
        length = chars - shorter
        base = F.floor(length / parts).cast("int")
        longer = length - base * parts  # the last so many segments have one more character
        for i in range(parts):
            start = i * base + F.greatest(F.lit(0), longer - (parts - i))
            size = base + F.when(longer >= parts - i, 1).otherwise(0)
            first = max(-i, shorter - (edits - i))
            last = min(i, shorter + (edits - i))
            for moved in range(first, last + 1):
                piece = F.substring(line, start + moved + 1, size)
                found.append((F.xxhash64(length, F.lit(i), piece), shorter == 0 and moved == 0))
    return found


def count_parities(line: Column) -> Column:
    """A bit for each of :data:`COUNTED`: whether it occurs an odd number of times.

    An edit removes one character, adds one, or both, so it changes two bits
    at the most.
    """
    found = F.lit(0).cast("long")
    for i, c in enumerate(COUNTED):
        odd = (F.length(line) - F.length(F.replace(line, F.lit(c)))) % 2
        found = found.bitwiseOR(F.shiftleft(odd.cast("long"), i))
    return found


def edit_distance(a: Column, b: Column, most: int) -> Column:
    """Edits between texts whose lengths differ by ``most`` at the most.

    Exact up to ``most``; above it some larger number. The band holds for the
    current character of ``b`` the ``2 * most + 1`` characters of ``a`` around
    the diagonal, one bit each: ``vp`` and ``vn`` say where the distance grows
    or falls from one row to the next. The distance is followed along the lowest
    diagonal of the band to the end of ``a``, then along the last row.
    """
    width = 2 * most + 1
    every, top = (1 << width) - 1, 1 << (width - 1)

    def run(pair: Column) -> Column:
        left, right = pair["a"], pair["b"]
        n, m = F.size(left), F.size(right)
        both = lambda x: x.bitwiseAND(F.lit(every))

        def step(state: Column, i: Column) -> Column:
            match = F.lit(0)
            for k in range(width):
                at = i + (k - most)
                same = (at >= 0) & (F.get(left, F.greatest(at, F.lit(0))) == F.get(right, i))
                match = match + F.when(same, 1 << k).otherwise(0)

            def advance(x: Column) -> Column:
                vp, vn = state["vp"], state["vn"]
                diagonal = both((x.bitwiseAND(vp) + vp).bitwiseXOR(vp).bitwiseOR(x).bitwiseOR(vn))
                return let(diagonal, finish)

            def finish(d: Column) -> Column:
                vp, vn = state["vp"], state["vn"]
                grows = vn.bitwiseOR(both(F.bitwise_not(d.bitwiseOR(vp))))
                falls = d.bitwiseAND(vp)
                moved = F.shiftright(d, 1)
                # On the diagonal part the band's lowest cell is followed, then a cell one higher at each step.
                beyond = i - (n - most)
                row = F.when(beyond >= 0, F.element_at(F.array(*[F.lit(top >> (1 + r)) for r in range(width - 1)], F.lit(0)), F.least(beyond, F.lit(width - 1)) + 1)).otherwise(0)
                change = F.when(beyond < 0, F.when(d.bitwiseAND(F.lit(top)) == 0, 1).otherwise(0)).otherwise(
                    F.when(grows.bitwiseAND(row) != 0, 1).otherwise(0) - F.when(falls.bitwiseAND(row) != 0, 1).otherwise(0)
                )
                return F.struct(
                    falls.bitwiseOR(both(F.bitwise_not(moved.bitwiseOR(grows)))).alias("vp"),
                    moved.bitwiseAND(grows).alias("vn"),
                    (state["cost"] + change).alias("cost"),
                )

            return let(match, advance)

        start = F.struct(F.lit(((1 << (most + 1)) - 1) << most).alias("vp"), F.lit(0).alias("vn"), F.lit(most).alias("cost"))
        return F.aggregate(F.sequence(F.lit(0), m - 1), start, step)["cost"]

    return let(F.struct(F.split(a, "").alias("a"), F.split(b, "").alias("b")), run)


def _lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """``doc, at, line`` of every line that takes part."""
    text = whole("text")
    each = docs.select(_document(text).alias("doc"), F.posexplode(F.split(text, "\n")).alias("at", "line"))
    return each.where(F.length("line") >= min_chars)


def distinct_lines(docs: DataFrame, edits: int, min_chars: int) -> DataFrame:
    """``h1, h2, place, doc, chars, parities, k0 ..``: each line once, with its first place and its keys.

    ``place`` is document times ``ROOM`` plus position. Keys ride along as
    numbers, so the lines' texts are not needed again.
    """
    line, chars = F.col("line"), F.length("line")
    keys = segment_keys(line, F.col("chars"), edits)
    rows = _lines(docs, min_chars).withColumn("chars", chars)
    named = rows.select(
        F.xxhash64(line).alias("h1"),
        F.xxhash64(F.lit(1), line).alias("h2"),
        "doc",
        (F.col("doc").cast("decimal(19,0)") * F.lit(ROOM) + F.col("at")).cast("decimal(38,0)").alias("place"),
        "chars",
        count_parities(line).alias("parities"),
        *[k.alias(f"k{i}") for i, (k, _) in enumerate(keys)],
    )
    least = ["place", "doc", "chars", "parities", *[f"k{i}" for i in range(len(keys))]]
    return stored(named.groupBy("h1", "h2").agg(*[F.min(c).alias(c) for c in least]), "lines")


def candidate_pairs(lines: DataFrame, edits: int) -> DataFrame:
    """``a, b``: pairs of line hashes that share a segment, each pair once.

    Lengths and character counts that more than ``edits`` edits part are
    compared within the join, so lines that only share a common beginning or
    end make no rows.
    """
    own = [is_own for _, is_own in segment_keys(F.lit(""), F.lit(0), edits)]
    entries = F.array(*[F.struct(F.col(f"k{i}").alias("key"), F.lit(o).alias("own")) for i, o in enumerate(own)])
    rows = lines.select(F.col("h1").alias("line"), "chars", "parities", F.inline(entries)).select("key", "own", "line", "chars", "parities")
    held = rows.where("own").select("key", F.col("line").alias("a"), F.col("chars").alias("a_chars"), F.col("parities").alias("a_parities"))
    asked = rows.select(F.col("key").alias("probe"), F.col("line").alias("b"), F.col("chars").alias("b_chars"), F.col("parities").alias("b_parities"))
    close = (F.col("b_chars") - F.col("a_chars")).between(0, edits)
    close = close & (F.bit_count(F.col("a_parities").bitwiseXOR(F.col("b_parities"))) <= 2 * edits)
    met = held.join(asked, (F.col("key") == F.col("probe")) & (F.col("a") != F.col("b")) & close)
    return stored(met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "candidates")


def line_links(docs: DataFrame, lines: DataFrame, edits: int, min_chars: int) -> DataFrame:
    """``later_h1, later_h2, earlier_h1, earlier_h2`` of all pairs of different lines within ``edits``."""
    pairs = candidate_pairs(lines, edits)
    wanted = stored(
        pairs.select(F.explode(F.array("a", "b")).alias("h")).distinct().join(lines, F.col("h") == F.col("h1")).select("h", "h2", "place"), "wanted"
    )
    found = _lines(docs, min_chars).select(
        F.xxhash64("line").alias("line_h1"),
        F.xxhash64(F.lit(1), F.col("line")).alias("line_h2"),
        (F.col("doc").cast("decimal(19,0)") * F.lit(ROOM) + F.col("at")).cast("decimal(38,0)").alias("line_place"),
        "line",
    )
    here = (F.col("line_h1") == F.col("h")) & (F.col("line_h2") == F.col("h2")) & (F.col("line_place") == F.col("place"))
    texts = stored(found.join(shipped(wanted, wanted.count()), here).select("h", "h2", "place", "line"), "texts")
    side = lambda s: texts.select(*[F.col(c).alias(f"{s}_{c}") for c in texts.columns])
    joined = pairs.join(side("a"), F.col("a") == F.col("a_h")).join(side("b"), F.col("b") == F.col("b_h"))
    near = F.abs(F.length("a_line") - F.length("b_line")) <= edits
    linked = joined.where(near).where(edit_distance(F.col("a_line"), F.col("b_line"), edits) <= edits)
    ordered = F.when(F.col("a_place") < F.col("b_place"), True).otherwise(False)
    pick = lambda yes, no, name: F.when(ordered, F.col(yes)).otherwise(F.col(no)).alias(name)
    return stored(
        linked.select(
            pick("b_h", "a_h", "later_h1"), pick("b_h2", "a_h2", "later_h2"), pick("a_h", "b_h", "earlier_h1"), pick("a_h2", "b_h2", "earlier_h2")
        ),
        "line_links",
    )


def dedup_lines(docs: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS) -> DataFrame:
    """The documents with their own columns, ``text`` without repeated lines, and ``line_counts``.

    ``line_counts`` has the lines that take part, those first seen here, those
    of them dropped as near an earlier line, and the links that the first seen lines have.
    """
    lines = distinct_lines(docs.select("doc_id", "text"), edits, min_chars)
    links = line_links(docs.select("doc_id", "text"), lines, edits, min_chars)
    ends = F.inline(
        F.array(
            F.struct(F.col("later_h1").alias("l1"), F.col("later_h2").alias("l2"), F.lit(1).alias("later")),
            F.struct(F.col("earlier_h1").alias("l1"), F.col("earlier_h2").alias("l2"), F.lit(0).alias("later")),
        )
    )
    linked = links.select(ends).groupBy("l1", "l2").agg(F.max("later").alias("near"), F.count(F.lit(1)).alias("links"))
    judged = lines.join(linked, (F.col("h1") == F.col("l1")) & (F.col("h2") == F.col("l2")), "left")
    at = (F.col("place") - F.col("doc").cast("decimal(19,0)") * F.lit(ROOM)).cast("int")
    near = F.coalesce("near", F.lit(0))
    firsts = (
        judged.groupBy(F.col("doc").alias("__doc"))
        .agg(
            F.collect_list(F.when(near == 0, F.struct(at.alias("at"), "h1"))).alias("__kept"),
            F.count(F.lit(1)).alias("first"),
            F.sum(near).cast("long").alias("near"),
            F.coalesce(F.sum("links"), F.lit(0)).alias("links"),
        )
        .select("__doc", "__kept", F.struct("first", "near", "links").alias("__counts"))
    )
    all_lines = F.split("text", "\n")

    def rebuilt(split: Column) -> Column:
        short = F.filter(F.sequence(F.lit(0), F.size(split) - 1), lambda i: F.length(F.get(split, i)) < min_chars)
        # The hash tells rows of one id apart, whose lines at a position differ.
        own = F.filter("__kept", lambda k: F.xxhash64(F.get(split, k["at"])) == k["h1"])
        kept = F.when(F.col("__kept").isNotNull(), F.transform(own, lambda k: k["at"])).otherwise(F.array().cast("array<int>"))
        places = F.sort_array(F.concat(short, kept))
        count = lambda name: F.coalesce(F.col("__counts")[name], F.lit(0)).cast("long").alias(name)
        return F.struct(
            F.array_join(F.transform(places, lambda i: F.get(split, i)), "\n").alias("text"),
            F.struct((F.size(split) - F.size(short)).cast("long").alias("lines"), count("first"), count("near"), count("links")).alias("counts"),
        )

    own = [F.col(c) for c in docs.columns if c != "line_counts"]
    numbered = docs.select(*own, _document(whole("text")).alias("__own"))
    met = numbered.join(firsts, F.col("__own") == F.col("__doc"), "left")
    made = met.withColumn("__made", F.when(F.col("text").isNotNull(), let(all_lines, rebuilt)))
    return made.select(
        *[F.col("__made")["text"].alias("text") if c == "text" else F.col(c) for c in docs.columns if c != "line_counts"],
        F.col("__made")["counts"].alias("line_counts"),
    )


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: lines that take part, first seen here, near an earlier one, their links, and the text left."""
    done = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda name: F.coalesce(F.col("line_counts")[name], F.lit(0)).alias(f"n_{name}")
    return done.select(
        "doc_id", *map(count, ("lines", "first", "near", "links")), F.length("text").cast("long").alias("n_chars_left"), F.sha2("text", 256).alias("text_sha256")
    )


QUERIES["op3_line_dedup"] = op3_line_dedup

# Brute force: lines of equal or neighbouring lengths, compared at every place of a single edit.
# Of two lines within one edit, half of the shorter one begins or ends both.
ORACLES["op3_line_dedup"] = f"""
WITH each AS (
  SELECT doc_id, unnest(generate_series(1, len(l))) AS pos, unnest(l) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
firsts AS (
  SELECT line, min(struct_pack(d := doc_id, i := pos)) AS p, length(line) AS n
  FROM each WHERE length(line) >= {MIN_CHARS} GROUP BY line),
met AS (
  SELECT a.line AS a, b.line AS b, a.p AS ap, b.p AS bp
  FROM firsts a JOIN firsts b ON b.n = a.n + 1 AND left(a.line, a.n // 2) = left(b.line, a.n // 2)
  UNION SELECT a.line, b.line, a.p, b.p
  FROM firsts a JOIN firsts b ON b.n = a.n + 1 AND right(a.line, a.n - a.n // 2) = right(b.line, a.n - a.n // 2)
  UNION SELECT a.line, b.line, a.p, b.p
  FROM firsts a JOIN firsts b ON b.n = a.n AND a.line < b.line AND left(a.line, a.n // 2) = left(b.line, a.n // 2)
  UNION SELECT a.line, b.line, a.p, b.p
  FROM firsts a JOIN firsts b ON b.n = a.n AND a.line < b.line AND right(a.line, a.n - a.n // 2) = right(b.line, a.n - a.n // 2)),
links AS (
  SELECT * FROM met WHERE len(list_filter(range(0, length(b)), lambda i:
    (CASE WHEN length(a) = length(b) THEN left(a, i) || substr(a, i + 2) ELSE a END) = left(b, i) || substr(b, i + 2))) > 0),
ends AS (
  SELECT a AS line, (ap > bp)::INT AS later FROM links UNION ALL SELECT b, (bp > ap)::INT FROM links),
linked AS (SELECT line, max(later) AS near, count(*) AS links FROM ends GROUP BY line),
judged AS (
  SELECT e.doc_id, e.pos, e.line, length(e.line) >= {MIN_CHARS} AS counts,
         coalesce(f.p = struct_pack(d := e.doc_id, i := e.pos), false) AS first,
         coalesce(near, 0) AS near, coalesce(links, 0) AS links
  FROM each e LEFT JOIN firsts f ON e.line = f.line LEFT JOIN linked k ON e.line = k.line),
done AS (
  SELECT doc_id, sum(counts::INT)::BIGINT AS n_lines, sum(first::INT)::BIGINT AS n_first,
         sum(CASE WHEN first THEN near ELSE 0 END)::BIGINT AS n_near,
         sum(CASE WHEN first THEN links ELSE 0 END)::BIGINT AS n_links,
         coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT counts OR (first AND near = 0)), '') AS kept
  FROM judged GROUP BY doc_id)
SELECT doc_id, n_lines, n_first, n_near, n_links, length(kept)::BIGINT AS n_chars_left, sha256(kept) AS text_sha256
FROM done"""

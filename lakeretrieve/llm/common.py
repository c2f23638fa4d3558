"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from lakeretrieve.session import scratch_path

# White space between words: space and the control characters 9 to 13.
SPACE_RUN = r"[\x20\x09-\x0D]+"
NON_SPACE = r"[^\x20\x09-\x0D]"
# Bits that tell which rows are shuffled, as a table of an eighth of so many bytes.
FILTER_BITS = 1 << 24


def whole(text: str | Column) -> Column:
    """A text with null read as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, also if used in a lambda."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """Maximal runs without white space, in order."""
    return F.array_remove(F.split(text, SPACE_RUN), "")


def stored(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Rows written to the shared folder and read back.

    The rows of a lost executor are read again, not made again, so positions
    and random choices in them stay fixed.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unused(name: str, *tables: DataFrame) -> str:
    """``name``, lengthened until no column of the tables has it in any case."""
    taken = {c.lower() for t in tables for c in t.columns}
    while name.lower() in taken:
        name += "_"
    return name


def bit_of(number: str | Column) -> Column:
    """The bit of a number among ``FILTER_BITS``."""
    return F.pmod(F.xxhash64(number), F.lit(FILTER_BITS))


def _flag(bit: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(bit, F.lit(64)).cast("int"))


def bits_set(numbers: DataFrame, number: str, word: str, **flags: Column) -> DataFrame:
    """The bits of the numbers for which each flag holds, as a table of ``FILTER_BITS / 64`` rows at most."""
    bit = bit_of(F.col(f"`{number}`"))
    each = [F.bit_or(F.when(holds, _flag(bit)).otherwise(F.lit(0).cast("long"))).alias(name) for name, holds in flags.items()]
    return numbers.groupBy(F.shiftright(bit, 6).alias(word)).agg(*each)


def with_bit_tests(rows: DataFrame, number: str, bits: DataFrame, word: str) -> DataFrame:
    """The rows with whether the bit of their number is set, by flag; the table of bits goes to every task."""
    bit = bit_of(F.col(f"`{number}`"))
    flags = [c for c in bits.columns if c != word]
    met = rows.join(F.broadcast(bits), F.shiftright(bit, 6) == F.col(word), "left")
    return met.withColumns({c: F.coalesce(F.col(c).bitwiseAND(_flag(bit)) != 0, F.lit(False)) for c in flags}).drop(word)


def rows_kept(numbered: DataFrame, key: str, kept: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` of the rows whose ``key`` is in ``kept``, a stored table of one column.

    Keys are shuffled, and whole rows only where their hash falls on a bit that a kept and a dropped row set.
    Where there are more rows than the bits can tell apart, more rows are shuffled and the result is the same.
    """
    other, word, stays, goes = (unused(name, numbered) for name in ("__kept", "__word", "__stays", "__goes"))
    kept = kept.toDF(other)
    alike = F.col(f"`{key}`") == F.col(other)
    fates = numbered.select(f"`{key}`").join(kept, alike, "left")
    there = F.col(other).isNotNull()
    bits = stored(bits_set(fates, key, word, **{stays: there, goes: ~there}), "bits")
    tested = with_bit_tests(numbered, key, bits, word)
    shown = [F.col(f"`{c}`") for c in columns]
    sure = tested.where(~F.col(goes)).select(*shown)
    return sure.unionByName(tested.where(F.col(goes) & F.col(stays)).join(kept, alike, "left_semi").select(*shown))


def with_row_key(docs: DataFrame, key: str) -> DataFrame:
    """The rows stored with a number of their own, for ids that are null or repeat."""
    return stored(docs.withColumn(key, F.monotonically_increasing_id()), "rows")

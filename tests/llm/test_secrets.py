"""Secret scans of texts with many matches, against Python's expressions."""

import hashlib
import random
import re
import time

from pyspark.sql import functions as F

from lakeretrieve.llm import secrets

PATTERNS = ((0, secrets.ASSIGN, 6), (1, "AKIA[A-Z0-9]+", 20), (2, "[0-9a-f]+", 24))
EVERY = secrets.RandomModel(tuple([1.0] * len(secrets.ALPHABET) ** 2), 0.1)


def _base(text):
    found = [(m.start(), k, m.end()) for k, p, n in PATTERNS for m in re.finditer(p, text) if len(m[2] if k == 0 else m[0]) >= n]
    return sorted(found)


def _all(text):
    base = _base(text)
    tokens = [(m.start(), 3, m.end()) for m in re.finditer(secrets.CANDIDATE, text)]
    return sorted([*base, *[t for t in tokens if not any(b[0] < t[2] and t[0] < b[2] for b in base)]])


def _listed(spans):
    return ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in spans)


def _texts():
    r = random.Random(4)
    hexes = lambda n: "".join(r.choice("0123456789abcdef") for _ in range(n))
    letters = lambda n: "".join(r.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") for _ in range(n))
    parts = [
        lambda: f'{r.choice(["password", "Token", "API_KEY", "mysecret", "passwd"])}{r.choice([" = ", ":", "=", ": ", " == "])}{r.choice(["", chr(34), chr(39)])}{hexes(r.randint(3, 40))}',
        lambda: "AKIA" + letters(r.randint(10, 24)),
        lambda: hexes(r.randint(16, 40)),
        lambda: letters(r.randint(8, 30)),
        lambda: r.choice(["é", "prose", "\n", "日本", "x=y", "token:"]),
    ]
    sizes = [0, 1, 2, 3, 5, 40, 255, 256, 257, 513, 1100]
    return [r.choice([" ", ", ", " \n"]).join(r.choice(parts)() for _ in range(n)) for n in sizes for _ in range(3)]


def test_spans_against_expressions(spark):
    texts = _texts()
    docs = spark.createDataFrame([*enumerate(texts), (-1, None)], "doc_id long, text string")
    scanned = secrets.with_secrets(docs, EVERY)
    got = scanned.select("doc_id", F.sha2(secrets._listed("base"), 256).alias("base"), secrets._listed("secrets").alias("spans")).collect()
    texts.append("")
    for row in got:
        text = texts[row["doc_id"]]
        assert row["spans"] == _listed(_all(text))
        assert row["base"] == hashlib.sha256(_listed(_base(text)).encode()).hexdigest()


def test_many_spans_of_one_text(spark):
    """100,000 spans: places are summed in blocks, so time does not grow with the square of their number."""
    text = " ".join(f"{i:024x} {'Zq' * 9}{i}" for i in range(50_000))
    began = time.monotonic()
    row = secrets.with_secrets(spark.createDataFrame([(1, text)], "doc_id long, text string"), EVERY).select(F.size("base"), F.size("secrets")).first()
    assert tuple(row) == (50_000, 100_000)
    assert time.monotonic() - began < 120


def test_copies_do_not_fill_the_sample(spark):
    """The ordinary sample counts different texts, however many copies one of them has."""
    rows = [(0, "copiedcopied " * 3)] * 400 + [(i, f"word{'abcdefghij'[i % 10] * 6}x{i} token = {'9f3k2q8z' * 4}{i}") for i in range(1, 30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    ordinary = secrets.labelled_samples(docs, 30, 1000)[1]
    assert ordinary.where("token like 'word%'").count() == 29

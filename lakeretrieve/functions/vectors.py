"""Vector expressions: coercion, distances, scores and the hash embedder.

They are higher-order functions over arrays, so they stay inside the JVM and
are inlined by Catalyst. Unequal lengths and null elements give a null
distance; a zero-norm vector has no cosine distance (null).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

# The element types a stored vector may have.
ELEMENT_TYPES = {"float": "float", "int": "int", "tinyint": "tinyint"}

# Accepted metric names. Any other name ranks by cosine.
METRIC_ALIASES = {
    "cosine": "cosine",
    "euclidean": "l2",
    "l2": "l2",
    "manhattan": "l1",
    "l1": "l1",
}


def metric_kind(metric: str) -> str:
    """``cosine``, ``l2`` or ``l1``; an unknown name means cosine."""
    return METRIC_ALIASES.get(metric.lower(), "cosine")


def coerce_vector(df: DataFrame, column: str) -> Column:
    """Vector as ``array<double>``: numbers converted, everything else 0.0."""
    element = df.schema[column].dataType.elementType
    if isinstance(element, T.BooleanType):
        return F.transform(F.col(column), lambda x: F.coalesce(x.cast("int").cast("double"), F.lit(0.0)))
    if not isinstance(element, T.NumericType):
        return F.transform(F.col(column), lambda _: F.lit(0.0))
    return F.transform(F.col(column), lambda x: F.coalesce(x.cast("double"), F.lit(0.0)))


def cast_vector(vector: Column, element: str, dim: int) -> Column:
    """Cast to the stored element type; a wrong length fails the job."""
    target = ELEMENT_TYPES.get(element.lower(), "float")
    return F.when(F.size(vector) == dim, vector.cast(f"array<{target}>")).otherwise(
        F.raise_error(F.concat(F.lit(f"vector length is not {dim}: "), F.size(vector).cast("string")))
    )


def _doubles(vector: Column) -> Column:
    return vector.cast("array<double>")


def _fold(array: Column) -> Column:
    return F.aggregate(array, F.lit(0.0), lambda acc, x: acc + x)


def dot(a: Column, b: Column) -> Column:
    return _fold(F.zip_with(_doubles(a), _doubles(b), lambda x, y: x * y))


def norm(a: Column) -> Column:
    return F.sqrt(_fold(F.transform(_doubles(a), lambda x: x * x)))


def cosine_distance(a: Column, b: Column, b_norm: float | None = None) -> Column:
    """Cosine distance; ``b_norm`` saves the second norm when it is known."""
    length = norm(a) * (norm(b) if b_norm is None else F.lit(b_norm))
    # abs() only flips a rounding error below zero, and keeps null as null.
    return F.abs(F.lit(1.0) - F.try_divide(dot(a, b), length))


def l2_distance(a: Column, b: Column) -> Column:
    return F.sqrt(_fold(F.zip_with(_doubles(a), _doubles(b), lambda x, y: (x - y) * (x - y))))


def l1_distance(a: Column, b: Column) -> Column:
    return _fold(F.zip_with(_doubles(a), _doubles(b), lambda x, y: F.abs(x - y)))


def distance(metric: str, a: Column, b: Column) -> Column:
    """Distance of the named metric, null where it is undefined."""
    return {"cosine": cosine_distance, "l2": l2_distance, "l1": l1_distance}[metric_kind(metric)](a, b)


def score(metric: str, d: Column) -> Column:
    """Relevance in the vector store.

    Only the literal name ``cosine`` has the linear score; an unknown name
    ranks by cosine distance but is scored by the reciprocal.
    """
    if metric.lower() == "cosine":
        return F.greatest(F.lit(0.0), F.lit(1.0) - d / 2)
    return F.lit(1.0) / (F.lit(1.0) + d)


def hybrid_score(d: Column) -> Column:
    """Relevance in the hybrid store: one minus the distance, any metric."""
    return F.lit(1.0) - d


def hash_embedding(text: Column, dim: int) -> Column:
    """Deterministic embedding: MD5 bytes / 255, repeated up to ``dim``."""
    digest = F.md5(text.cast("binary"))
    return F.when(
        text.isNotNull(),
        F.transform(
            F.sequence(F.lit(0), F.lit(dim - 1)),
            lambda i: F.conv(F.substring(digest, 2 * (i % 16) + 1, F.lit(2)), 16, 10).cast("double") / 255.0,
        ),
    )

"""Vector functions on array<double> columns, without Python."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lorgnette.functions.text import c


def dot(a: Column | str, b: Column | str) -> Column:
    return F.aggregate(F.zip_with(c(a), c(b), lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column | str) -> Column:
    return F.sqrt(F.aggregate(c(a), F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def is_zero(a: Column | str) -> Column:
    """No element differs from 0; so is an empty vector."""
    return ~F.coalesce(F.exists(c(a), lambda x: x != 0), F.lit(False))


def close(a: Column, b: Column) -> Column:
    return F.forall(F.zip_with(a, b, lambda x, y: F.abs(x - y) <= 1e-6 + 1e-5 * F.abs(y)), lambda t: t)


def raw_cosine(a: Column | str, b: Column | str) -> Column:
    """Cosine similarity; 0 if a vector is null or zero or the lengths differ; if not a number, 1 for close vectors and 0 for others."""
    a, b = c(a), c(b)
    unfit = a.isNull() | b.isNull() | (F.size(a) != F.size(b)) | is_zero(a) | is_zero(b)
    x = dot(a, b) / (norm(a) * norm(b))
    return F.when(unfit, 0.0).otherwise(F.when(F.isnan(x), F.when(close(a, b), 1.0).otherwise(0.0)).otherwise(x))


def cosine(a: Column | str, b: Column | str) -> Column:
    """``raw_cosine`` clamped to [0, 1]."""
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), raw_cosine(a, b)))


def unit(a: Column | str, length: Column | None = None) -> Column:
    """The vector by its norm; a zero vector stays as it is. ``length`` is the norm if a column has it already."""
    a = c(a)
    # The norm goes in as an array's only element, so that it is worked out once and not for each element of ``a``.
    n = F.array(norm(a) if length is None else length)
    return F.when(is_zero(a), a).otherwise(F.flatten(F.transform(n, lambda k: F.transform(a, lambda x: x.cast("double") / k))))


def vector_sum(a: Column | str) -> Column:
    """Aggregate: the element-wise sum of vectors of one length, as an array<double>."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    return vector_to_array(Summarizer.sum(array_to_vector(c(a))))

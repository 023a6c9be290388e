"""Vector arithmetic as column expressions over array<double>."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPS = 1e-12


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def doubles(v: Column | str) -> Column:
    return _col(v).cast("array<double>")


def dot(a: Column | str, b: Column | str) -> Column:
    return F.aggregate(F.zip_with(_col(a), _col(b), lambda x, y: x * y), F.lit(0.0), lambda p, q: p + q)


def norm(a: Column | str) -> Column:
    return F.sqrt(F.aggregate(_col(a), F.lit(0.0), lambda s, x: s + x * x))


def cosine(a: Column | str, b: Column | str) -> Column:
    """Dot product over the product of norms; 0 where either is the zero vector."""
    size = norm(a) * norm(b)
    return F.when(size > 0, dot(a, b) / size).otherwise(F.lit(0.0))


def unit(a: Column | str, add_eps: bool = False) -> Column:
    """a over max(norm, eps), or over norm + eps. A zero vector stays as it is."""
    size = norm(a) + EPS if add_eps else F.greatest(norm(a), F.lit(EPS))
    return F.transform(_col(a), lambda x: x / size)


def rounded(a: Column | str, digits: int) -> Column:
    return F.transform(_col(a), lambda x: F.round(x, digits))


def parse_vector(text: Column | str) -> Column:
    """array<double> from "[1, 2]", "(1 2)" or "1, 2 3"; null where a part is not a number or the text is empty."""
    plain = F.trim(F.regexp_replace(_col(text), r"[\[\]()\s,]+", " "))
    parts = F.transform(F.split(plain, " +"), lambda x: x.try_cast("double"))
    return F.when((plain != "") & ~F.exists(parts, lambda x: x.isNull()), parts)


def fit_dim(v: Column | str, dim: Column | int) -> Column:
    """v cut or padded with zeros to dim; null, NaN and infinite values become 0, a null vector all zeros."""
    d = dim if isinstance(dim, Column) else F.lit(dim)
    finite = F.transform(F.coalesce(_col(v), F.array().cast("array<double>")), lambda x: F.when(x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")), F.lit(0.0)).otherwise(x))
    return F.slice(F.concat(finite, F.array_repeat(F.lit(0.0), d)), 1, d)


def vector_text(v: Column | str) -> Column:
    return F.to_json(_col(v))


def jaccard(a: Column | str, b: Column | str, empty_value: float = 1.0) -> Column:
    """Shared over all distinct members; empty_value where both are empty."""
    every = F.size(F.array_union(_col(a), _col(b)))
    return F.when(every == 0, F.lit(empty_value)).otherwise(F.size(F.array_intersect(_col(a), _col(b))) / every)

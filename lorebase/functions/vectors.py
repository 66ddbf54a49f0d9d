"""Text and vector expressions: hashed term vectors, cosine, sign cells."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable

import regex
from pyspark.sql import Column, DataFrame, functions as F

from lorebase.functions.text import TOKEN_SEPARATOR, tokens

DIM = 64
BITS = 8
#: Printable signs of one byte, and the first of them.
MOST_SIGNS, FIRST_SIGN = 94, 33


def _bucket(token: Column, dim: int) -> Column:
    return F.pmod(F.conv(F.substring(F.md5(token), 1, 8), 16, 10).cast("long"), F.lit(dim)).cast("int")


def buckets(text: Column, dim: int = DIM) -> Column:
    """The bucket of every word of a text."""
    return F.transform(tokens(F.coalesce(text, F.lit(""))), lambda token: _bucket(token, dim))


def signs(found: Column, dim: int = DIM) -> Column:
    """Buckets as a text of one sign of a byte each, in which a bucket is counted faster than in an array; beyond MOST_SIGNS as they are."""
    return F.array_join(F.transform(found, lambda b: F.char(b + FIRST_SIGN)), "") if dim <= MOST_SIGNS else found


def counts(found: Column, dim: int = DIM) -> Column:
    """How many words are in each bucket, given their `signs`; `found` should be a column, as it is read once per bucket.

    A transform rather than an array of `dim` expressions: that many of them make a method too long to be compiled.
    """

    def count(b: Column) -> Column:
        if dim > MOST_SIGNS:
            return F.size(found) - F.size(F.array_remove(found, b))
        return F.octet_length(found) - F.octet_length(F.replace(found, F.char(b + FIRST_SIGN), F.lit("")))

    return F.transform(F.sequence(F.lit(0), F.lit(dim - 1)), count)


def embed(df: DataFrame, ids: list[str], text: str, out: str = "embedding", dim: int = DIM) -> DataFrame:
    """Default embedding: hashed term counts scaled to length 1, one row per row of `df`, as ARRAY<DOUBLE>.

    Worked out within the row, without a shuffle. A text without words, null included, gets the zero vector.
    """
    hashed = df.select(*ids, signs(buckets(F.col(text), dim), dim).alias("_signs"))
    counted = hashed.select(*ids, counts(F.col("_signs"), dim).alias("_counts"))
    return counted.select(*ids, unit(F.col("_counts"), dim).alias(out))


def unit(vector: Column, dim: int = DIM) -> Column:
    """The vector scaled to length 1 in double precision; a zero vector stays as it is."""
    squares = F.aggregate(vector, F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    norm = F.sqrt(squares)
    # The norm is repeated rather than used inside the lambda, where it would be worked out once per component.
    return F.zip_with(vector, F.array_repeat(F.when(norm > 0, norm).otherwise(1.0), dim), lambda x, n: x.cast("double") / n)


def embed_with(df: DataFrame, text: str, model: Callable, out: str = "embedding") -> DataFrame:
    """Embedding by a caller's model: `model` maps a pandas Series of texts to a Series of float lists."""
    from pyspark.sql import types as T

    return df.withColumn(out, F.pandas_udf(model, T.ArrayType(T.DoubleType()))(F.col(text)))


def literal_vector(text: str, dim: int = DIM) -> list[float]:
    """The same embedding for one short constant text, such as a tool description."""
    counts = [0] * dim
    for token in regex.split(TOKEN_SEPARATOR, text.lower()):
        if token:
            counts[int(hashlib.md5(token.encode()).hexdigest()[:8], 16) % dim] += 1
    norm = max(math.sqrt(sum(c * c for c in counts)), 1.0)
    return [c / norm for c in counts]


def as_array(values: list[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def dot(a: Column, b: Column) -> Column:
    """Inner product in double precision, summed in index order; the cosine for vectors of length 1."""
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda total, x: total + x
    )


def sign_plane(bit: int, dim: int = DIM) -> list[int]:
    """A fixed hyperplane of +1 and -1: the rule is the first hex digit of md5('bit:index')."""
    return [1 if hashlib.md5(f"{bit}:{i}".encode()).hexdigest()[0] < "8" else -1 for i in range(dim)]


def sign_cell(vector: Column, bits: int = BITS, dim: int = DIM) -> Column:
    """Cell number of a vector: one bit per hyperplane, set where the vector lies on its positive side."""
    cell = F.lit(0)
    for bit in range(bits):
        side = dot(vector, as_array(sign_plane(bit, dim))) >= 0
        cell = cell + F.when(side, F.lit(1 << bit)).otherwise(F.lit(0))
    return cell.cast("int")


def fingerprint(vector: Column) -> Column:
    """Text form of a vector, rounded to 6 digits: whole millionths joined by commas."""
    return F.array_join(F.transform(vector, lambda x: F.round(x * 1_000_000).cast("long").cast("string")), ",")

"""Column expressions on arrays of numbers: small images or feature vectors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col


def let(value, body) -> Column:
    """body(value) with the value computed once for the row, also where the body uses it for every element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def total(a) -> Column:
    return F.aggregate(col(a), F.lit(0.0), lambda s, x: s + x)


def mean(a) -> Column:
    return F.try_divide(total(a), F.size(col(a)))


def centred(a) -> Column:
    return let(mean(a), lambda m: F.transform(col(a), lambda x: x - m))


def squares(a) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, x: s + x * x)


def dot(a, b) -> Column:
    return total(F.zip_with(a, b, lambda x, y: x * y))


def var_pop(a) -> Column:
    """Population variance by two passes."""
    return F.try_divide(let(centred(a), squares), F.size(col(a)))


def ncc(lr, hr) -> Column:
    """Normalised correlation of equally long vectors; a flat first one gives 1, a flat second one 0."""

    def score(p):
        va, vb = squares(p["a"]), squares(p["b"])
        return F.when(va == 0, 1.0).when(vb == 0, 0.0).otherwise(F.try_divide(dot(p["a"], p["b"]), F.sqrt(va * vb)))

    return let(F.struct(centred(lr).alias("a"), centred(hr).alias("b")), score)


def unit_centred(a) -> Column:
    """Centred vector of length one, empty if flat: prepared once, so that a pair's score is a dot product."""
    empty = F.array().cast("array<double>")
    scaled = lambda c: let(F.sqrt(squares(c)), lambda n: F.when(n > 0, F.transform(c, lambda x: x / n)).otherwise(empty))
    return let(centred(a), scaled)


def ncc_prepared(lr, hr) -> Column:
    a, b = col(lr), col(hr)
    return F.when(F.size(a) == 0, 1.0).when(F.size(b) == 0, 0.0).otherwise(dot(a, b))


def median(a) -> Column:
    n = F.size(col(a))
    at = lambda s, k: F.get(s, F.floor(k).cast("int"))
    return let(F.sort_array(col(a)), lambda s: (at(s, (n - 1) / 2) + at(s, n / 2)) / 2)


def median_hash(a) -> Column:
    """64 bits, bit i set if value i is above the median. Longer vectors are folded: value i, i + 64 and so on are added up."""
    folded = F.when(F.size(col(a)) <= 64, col(a)).otherwise(
        F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.aggregate(F.filter(col(a), lambda x, k: k % 64 == i), F.lit(0.0), lambda s, x: s + x))
    )
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    bit = lambda m: lambda x, i: F.when(x > m, F.call_function("shiftleft", one, i)).otherwise(none)
    return let(folded, lambda v: let(median(v), lambda m: F.aggregate(F.transform(v, bit(m)), none, lambda s, x: s.bitwiseOR(x))))


def hamming(a, b) -> Column:
    return F.bit_count(col(a).bitwiseXOR(col(b)))


def bounding_box(a, width: int, threshold: float) -> Column:
    """(x_min, y_min, x_max, y_max) of values above the threshold in a row-major image, ends exclusive; null if none."""

    def box(at):
        xs, ys = F.transform(at, lambda i: i % width), F.transform(at, lambda i: F.floor(i / width).cast("int"))
        return F.when(
            F.size(at) > 0,
            F.struct(
                F.array_min(xs).alias("x_min"),
                F.array_min(ys).alias("y_min"),
                (F.array_max(xs) + 1).alias("x_max"),
                (F.array_max(ys) + 1).alias("y_max"),
            ),
        )

    return let(F.filter(F.transform(col(a), lambda v, i: F.when(v > threshold, i)), lambda i: i.isNotNull()), box)

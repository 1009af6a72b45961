"""Small linear algebra on array columns: vectors are array<double>, matrices arrays of rows.

For models per series: the sums of products come from aggregates over rows, what is solved here has as many rows as a model has terms.
A system that can't be solved gives NULL, never an error.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A pivot below this share of its diagonal entry means that the terms depend on each other.
DEPENDENT = 1e-10


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with the value computed once per row, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def vector(*values: float | Column) -> Column:
    return F.array(*[v if isinstance(v, Column) else F.lit(float(v)) for v in values])


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def dot(a: Column, b: Column) -> Column:
    return total(F.zip_with(a, b, lambda x, y: x * y))


def added(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x + y)


def scaled(a: Column, by: Column) -> Column:
    return F.transform(a, lambda x: x * by)


def picked(matrix: Column, places: Column) -> Column:
    """Rows and columns of a matrix at these places, in this order."""
    return F.transform(places, lambda i: let(F.get(matrix, i), lambda row: F.transform(places, lambda j: F.get(row, j))))


def combined(rows: Column, coefficients: Column) -> Column:
    """coefficients times the rows, summed: one row."""
    weighted = F.zip_with(rows, coefficients, lambda row, c: scaled(row, c))
    return F.aggregate(weighted, F.transform(F.get(rows, F.lit(0)), lambda _: F.lit(0.0)), added)


def congruent(matrix: Column, t: Column) -> Column:
    """T M T' for a symmetric M: the sums of products of new terms, each a row of T over the old ones."""
    half = F.transform(t, lambda row: combined(matrix, row))
    return let(half, lambda h: F.transform(h, lambda left: F.transform(t, lambda row: dot(left, row))))


def cholesky(matrix: Column, size: Column) -> Column:
    """Rows of the lower factor (as long as their place); entries behind a dependent term are NULL.

    The last row of a bordered matrix of terms and response holds the response's share along every term in turn, so the squares of its first
    entries, taken off the response's sum of squares, leave the residual sum of every nested model.
    """

    def entry(rows: Column, row: Column, given: Column, j: Column, i: Column) -> Column:
        off = let(F.get(rows, i), lambda other: F.try_divide(F.get(given, i) - dot(row, F.slice(other, F.lit(1), i)), F.get(other, i)))
        rest = F.get(given, i) - dot(row, row)
        return F.when(i < j, off).otherwise(F.when(rest > DEPENDENT * F.get(given, i), F.sqrt(rest)))

    def line(rows: Column, j: Column) -> Column:
        return let(
            F.get(matrix, j),
            lambda given: F.aggregate(F.sequence(F.lit(0), j), F.array().cast("array<double>"), lambda row, i: F.concat(row, F.array(entry(rows, row, given, j, i)))),
        )

    return F.aggregate(F.sequence(F.lit(0), size - 1), F.array().cast("array<array<double>>"), lambda rows, j: F.concat(rows, F.array(line(rows, j))))


def solved(factor: Column, terms: Column) -> Column:
    """Least-squares coefficients of the first `terms` terms from the factor of a bordered matrix, by back substitution."""
    response = F.get(factor, terms)

    def coefficient(found: Column, i: Column) -> Column:
        below = F.transform(F.slice(factor, i + 2, terms - 1 - i), lambda row: F.get(row, i))
        return F.try_divide(F.get(response, i) - dot(below, found), F.get(F.get(factor, i), i))

    steps = F.sequence(terms - 1, F.lit(0), F.lit(-1))
    return F.aggregate(steps, F.array().cast("array<double>"), lambda found, i: F.concat(F.array(coefficient(found, i)), found))


def gram_cells(rows: DataFrame, keys: Sequence[str], terms: str = "terms") -> DataFrame:
    """keys, i, j, v: sums of the products of the terms i >= j, summed within tasks before they move.

    Sums of parts add up to the sums of the whole, so folds and samples are made of cells, not of rows.
    """
    left = rows.select(*keys, F.col(terms).alias("_x"), F.posexplode(terms).alias("i", "_l"))
    pairs = left.select(*keys, "i", "_l", F.posexplode(F.slice("_x", F.lit(1), F.col("i") + 1)).alias("j", "_r"))
    return pairs.groupBy(*keys, "i", "j").agg(F.sum(F.col("_l") * F.col("_r")).alias("v"))


def gram(cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, gram, size: the full symmetric matrix of the cells of each key; rows are as many as terms."""
    flat = cells.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "j", "v"))), lambda c: c["v"]).alias("_flat"), (F.max("i") + 1).alias("size"))
    places = F.sequence(F.lit(0), F.col("size") - 1)

    def cell(i: Column, j: Column) -> Column:
        high, low = F.greatest(i, j), F.least(i, j)
        return F.get(F.col("_flat"), F.floor(high * (high + 1) / 2).cast("int") + low)

    return flat.select(*keys, F.transform(places, lambda i: F.transform(places, lambda j: cell(i, j))).alias("gram"), "size")

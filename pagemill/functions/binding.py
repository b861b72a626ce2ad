"""Name a sub-expression inside a Column, so it is evaluated once per row."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once.

    Catalyst does not share sub-expressions inside lambdas, so an expensive array that
    is used twice, or once per element of another array, has to be bound first.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def only(value: Column, keep: Callable[[Column], Column]) -> Column:
    """``value`` where ``keep`` holds, no row otherwise; use in a select.

    A filter on a computed column is pushed below the projection that computes it, which
    then runs twice. A generator is not crossed, so the value is computed once.
    """
    return F.explode(F.filter(F.array(value), keep))


def items(rows: DataFrame, keys: Sequence[str], array: str | Column, name: str, pos: str = "pos") -> DataFrame:
    """One row per array item that is not NULL: keys, position, item.

    For an inner explode Spark adds the filter ``size(array) > 0`` and pushes it below the
    projection that computes the array, which doubles the work and may move it below an
    exchange. The outer form is left alone, and the filter on its output stays above.
    """
    return rows.select(*keys, F.posexplode_outer(array).alias(pos, name)).filter(F.col(name).isNotNull())


def empty_array(element_ddl: str) -> Column:
    return F.array().cast(f"array<{element_ddl}>")


def indices(n: Column) -> Column:
    """[0, 1, .., n-1]; empty for n = 0, where ``sequence`` would count down."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(empty_array("int"))


def runs(values: Column, starts_new: Callable[[Column, Column], Column]) -> Column:
    """Cut an array into runs: ``starts_new(previous, current)`` opens the next one."""

    def cut(arr: Column) -> Column:
        opening = F.filter(
            indices(F.size(arr)),
            lambda i: F.when(i == 0, F.lit(True)).otherwise(starts_new(F.get(arr, i - 1), F.get(arr, i))),
        )
        return let(
            opening,
            lambda at: F.transform(
                at, lambda s, n: F.slice(arr, s + 1, F.coalesce(F.get(at, n + 1), F.size(arr)) - s)
            ),
        )

    return let(values, cut)

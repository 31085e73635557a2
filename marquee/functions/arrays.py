"""Array expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from marquee.functions.text import let


def joined(a: Column, separator: str = ", ") -> Column:
    """Elements as one text; null gives ''."""
    return F.coalesce(F.array_join(a, separator), F.lit(""))


def first_filled(*arrays: Column) -> Column:
    """The first array with elements, else an empty one."""
    chain = F
    for a in arrays:
        chain = chain.when(F.size(a) > 0, a)
    return chain.otherwise(F.array().cast("array<string>"))


def distinct_ignoring_case(a: Column) -> Column:
    """Keep the first spelling of every element, in order."""
    keyed = F.transform(a, lambda x, i: F.struct(F.lower(x).alias("key"), i.alias("at"), x.alias("x")))

    def firsts(s: Column) -> Column:
        kept = F.filter(s, lambda e, i: (i == 0) | (F.get(s, i - 1)["key"] != e["key"]))
        return F.array_sort(F.transform(kept, lambda e: F.struct(e["at"], e["x"])))

    return F.transform(let(F.array_sort(keyed), firsts), lambda e: e["x"])


def first_match(a: Column, test: Callable[[Column], Column]) -> Column:
    """First element that passes, or null."""
    return F.get(F.filter(a, test), F.lit(0))

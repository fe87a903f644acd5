"""Pairwise similarities as expressions; the arguments are distinct arrays or strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def flag(c: Column) -> Column:
    return F.when(c, 1.0).otherwise(0.0)


def same(a: Column, b: Column) -> Column:
    return flag((a != "") & (a == b))


def jaccard(a: Column, b: Column) -> Column:
    """Of sets; 0 if either is empty."""
    return F.when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b)))


def prefix4(a: Column, b: Column) -> Column:
    return flag((F.length(a) >= 4) & (F.length(b) >= 4) & (F.substring(a, 1, 4) == F.substring(b, 1, 4)))


def length_diff(a: Column, b: Column) -> Column:
    return F.abs(F.length(a) - F.length(b)).cast("double")


def char_set(a: Column, b: Column) -> Column:
    """Jaccard of the sets of characters, with a gate on the difference of lengths."""
    letters = lambda c: F.array_distinct(F.filter(F.split(c, ""), lambda x: x != ""))
    return (
        F.when((a == "") & (b == ""), 1.0)
        .when((a == "") | (b == ""), 0.0)
        .when(a == b, 1.0)
        .when(F.abs(F.length(a) - F.length(b)) > 10, 0.0)
        .otherwise(jaccard(letters(a), letters(b)))
    )


def length_ratio(a: Column, b: Column) -> Column:
    return F.least(F.length(a), F.length(b)) / F.greatest(F.length(a), F.length(b), F.lit(1))


def overlap(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b)) / F.greatest(F.size(a), F.lit(1))


def any_shared(a: Column, b: Column) -> Column:
    return flag(F.size(F.array_intersect(a, b)) > 0)


def edit_similarity(a: Column, b: Column) -> Column:
    """1 - edit distance / longer length; an extension beside char_set."""
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest == 0, 1.0).otherwise(1 - F.levenshtein(a, b) / longest)

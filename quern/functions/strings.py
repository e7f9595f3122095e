"""String expressions with the semantics of Python's string methods."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip(c: Column) -> Column:
    """Without white space, of all Unicode, at both ends (trim() knows the space alone)."""
    return F.regexp_replace(c, r"(?U)^[\s\x{1C}-\x{1F}]+|[\s\x{1C}-\x{1F}]+$", "")


def or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def before(c: Column, marker: str) -> Column:
    """What precedes the first marker; all of c without one."""
    return F.substring_index(c, marker, 1)


def after(c: Column, marker: str) -> Column:
    """What follows the first marker, further markers included; empty without one."""
    at = F.instr(c, marker)
    return F.when(at > 0, F.substr(c, at + len(marker))).otherwise(F.lit(""))


def without(c: Column, *literals: str) -> Column:
    for x in literals:
        c = F.replace(c, F.lit(x), F.lit(""))
    return c


def last_token(c: Column) -> Column:
    """The last of the tokens that white space parts; null if there is none."""
    return F.try_element_at(F.filter(F.split(c, r"\s+"), lambda x: x != ""), F.lit(-1))


def words(c: Column) -> Column:
    """Tokens that white space parts, as an array without empty ones."""
    return F.filter(F.split(or_empty(c), r"[\x20\x09-\x0D]+"), lambda x: x != "")


def bound(value: Column, then: Callable[[Column], Column]) -> Column:
    """then(value), with value computed once for each row, however often and in whatever lambda it is used."""
    return F.element_at(F.transform(F.array(value), then), 1)


def word_ngrams(tokens: Column, n: int) -> Column:
    """All runs of n tokens, joined by spaces; empty if there are fewer."""

    def runs(t: Column) -> Column:
        count = F.size(t) - (n - 1)
        every = F.transform(F.sequence(F.lit(1), F.greatest(count, F.lit(1))), lambda i: F.array_join(F.slice(t, i, n), " "))
        return F.when(count > 0, every).otherwise(F.array().cast("array<string>"))

    return bound(tokens, runs)


def first_match_replaced(c: Column, pattern: str, new: Column) -> Column:
    """c with the first match of pattern replaced by new; c itself without a match."""
    found = F.regexp_substr(c, F.lit(pattern))
    return F.when(found.isNull(), c).otherwise(F.concat(F.substr(c, F.lit(1), F.instr(c, found) - 1), new, F.substr(c, F.instr(c, found) + F.length(found))))


def finite_number(c: Column) -> Column:
    """Whether c, parsed as a number, is finite; null if it is no number."""
    x = c.try_cast("double")
    return F.when(x.isNotNull(), ~F.isnan(x) & (F.abs(x) != float("inf")))

"""Column helpers shared by the text operators. All of them are built-in functions of the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The white space that separates words: space and the five controls from tab to carriage return.
SPACES = " \t\n\x0b\x0c\r"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once per row.

    A lambda that names a column expression computes it again for each element; a lambda variable
    holds a value.
    """
    return F.transform(F.array(value), body)[0]


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else. lower() has a fast path for ASCII, where both mean the same."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(
        F.translate(text, _UPPER, _UPPER.lower())
    )


def space_words(text: Column) -> Column:
    """Runs of characters other than SPACES."""
    return F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")


def alnum_words(lowered: Column) -> Column:
    """Runs of digits, a-z and everything outside ASCII, of a text lower-cased before."""
    return F.array_remove(F.split(lowered, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def count_of(text: Column, characters: str) -> Column:
    """How many of these characters a text has."""
    return (F.length(text) - F.length(F.translate(text, characters, ""))).cast("long")


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a + x)


def running_totals(values: Column, step: int = 256) -> Column:
    """Sums of all values before each one. In blocks, as each block's list is built by appending."""

    def grown(block: Column, first: Column) -> Column:
        return F.aggregate(
            block, F.array(first), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x))
        )

    def of(longs: Column) -> Column:
        blocks = F.transform(
            F.sequence(F.lit(0), F.floor((F.size(longs) - 1) / step).cast("int")),
            lambda b: F.slice(longs, b * step + 1, F.lit(step)),
        )
        return let(
            blocks,
            lambda bs: let(
                grown(F.transform(bs, total), F.lit(0).cast("long")),
                lambda firsts: F.flatten(
                    F.transform(
                        bs, lambda b, i: F.slice(grown(b, F.get(firsts, i)), F.lit(1), F.size(b))
                    )
                ),
            ),
        )

    empty = F.array().cast("array<bigint>")
    return let(
        F.transform(values, lambda x: x.cast("long")),
        lambda v: F.when(F.size(v) == 0, empty).otherwise(of(v)),
    )


def join_same(left: DataFrame, right: DataFrame, names: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on columns of one name, NULL equal to NULL; the names come once, from the left."""
    renamed = right.withColumnsRenamed({n: f"_r_{n}" for n in names})
    condition = F.lit(True)
    for n in names:
        condition = condition & F.col(n).eqNullSafe(F.col(f"_r_{n}"))
    return left.join(renamed, condition, how).drop(*[f"_r_{n}" for n in names])


def only(df: DataFrame, *names: str) -> DataFrame:
    """The columns an operator needs, so that no other column can clash with the names it adds."""
    return df.select(*names)

"""Positions of pattern matches as built-in column expressions.

A span is a struct (s, e, m): first code point, end (exclusive) and matched
text. Positions come from the gaps between the matches (the text split by the
pattern), summed block by block so that the work stays linear in the matches.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "array<struct<s:bigint,e:bigint,m:string>>"
_BLOCK = 512


def let(value: Column, use) -> Column:
    """use(value) with the value computed once, also where ``use`` reads it inside a lambda."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def none() -> Column:
    return F.array().cast(SPAN)


def _total(lengths: Column) -> Column:
    return F.aggregate(lengths, F.lit(0).cast("long"), lambda a, x: a + x["g"] + x["n"])


def matches(text: Column, pattern: str) -> Column:
    """Spans of the leftmost non-overlapping matches of a pattern that never matches the empty text."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def place(found: Column) -> Column:
        lengths = let(F.split(text, pattern, -1), lambda gaps: F.transform(found, lambda m, i: F.struct(
            F.char_length(F.get(gaps, i)).cast("long").alias("g"), F.char_length(m).cast("long").alias("n"),
            m.alias("m"))))
        return F.when(F.size(found) == 0, none()).otherwise(let(lengths, _placed))

    return let(found, place)


def _placed(lengths: Column) -> Column:
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / _BLOCK).cast("int")),
                         lambda b: F.slice(lengths, b * _BLOCK + 1, _BLOCK))

    def place(block: Column, before: Column) -> Column:
        start = F.struct(before.alias("at"), none().alias("out"))
        return F.aggregate(block, start, lambda a, x: F.struct(
            (a["at"] + x["g"] + x["n"]).alias("at"),
            F.array_append(a["out"], F.struct((a["at"] + x["g"]).alias("s"), (a["at"] + x["g"] + x["n"]).alias("e"),
                                              x["m"].alias("m"))).cast(SPAN).alias("out")), lambda a: a["out"])

    def all_blocks(blocks: Column) -> Column:
        return let(F.transform(blocks, _total), lambda totals: F.flatten(F.transform(blocks, lambda block, i: place(
            block, F.aggregate(F.slice(totals, 1, i), F.lit(0).cast("long"), lambda a, x: a + x)))))

    return let(blocks, all_blocks)


def labelled(spans: Column, kind: str) -> Column:
    """"kind:start:end" of each span."""
    return F.transform(spans, lambda x: F.concat(F.lit(f"{kind}:"), x["s"].cast("string"), F.lit(":"),
                                                 x["e"].cast("string")))


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")

"""Matches of a pattern in a text as spans, with Spark SQL functions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "array<struct<start:bigint,end:bigint,match:string>>"


BLOCK = 256


def in_order(steps: Column) -> Column:
    """Blocks of spans. Adding to an array copies it, so positions are summed up within blocks, and the
    blocks' lengths over blocks; the work for n hits is about BLOCK * n + (n / BLOCK) ** 2 copies."""
    blocks = F.transform(
        F.filter(F.sequence(F.lit(0), F.floor(F.size(steps) / BLOCK).cast("int")), lambda i: i * BLOCK < F.size(steps)),
        lambda i: F.slice(steps, i * BLOCK + 1, F.lit(BLOCK)))
    zero = F.lit(0).cast("bigint")
    summed = F.transform(blocks, lambda block: F.aggregate(
        block, F.struct(zero.alias("at"), F.array().cast(SPAN).alias("out")), lambda state, x: F.struct(
            (state["at"] + x["gap"] + x["hit"]).alias("at"),
            F.concat(state["out"], F.array(F.struct(
                (state["at"] + x["gap"]).alias("start"), (state["at"] + x["gap"] + x["hit"]).alias("end"),
                x["shown"].alias("match")))).alias("out"))))
    starts = lambda parts: F.aggregate(
        parts, F.array(zero), lambda at, block: F.concat(at, F.array(F.element_at(at, -1) + block["at"])))
    # One pass for each: what stands in a lambda's variable is worked out once.
    return F.transform(F.array(summed), lambda parts: F.zip_with(
        parts, F.slice(starts(parts), F.lit(1), F.size(parts)), lambda block, at: F.transform(
            block["out"], lambda x: F.struct((x["start"] + at).alias("start"), (x["end"] + at).alias("end"),
                                             x["match"].alias("match")))))[0]


def matches(text: Column, pattern: str, maybe: str | None = None, group: int = 0) -> Column:
    """Leftmost non-overlapping matches: start and end in code points (end exclusive) and the text of
    ``group``. ``maybe`` is a cheaper pattern that every text with a match contains."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    shown = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else hits
    sizes = lambda parts: F.transform(parts, lambda x: F.length(x).cast("bigint"))
    steps = F.arrays_zip(sizes(F.split(text, pattern, -1)).alias("gap"), sizes(hits).alias("hit"), shown.alias("shown"))
    empty = F.array().cast(SPAN)
    real = F.filter(steps, lambda x: x["hit"].isNotNull())
    found = F.transform(F.array(real), lambda x: F.flatten(in_order(x)))[0]
    return F.when(text.rlike(maybe or pattern), found).otherwise(empty)

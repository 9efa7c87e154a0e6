"""Mergeable aggregate states: build from rows, merge, and read the final number.

A distinct state is a theta sketch with 2**16 nominal entries: exact up to 65,536 distinct
values, within a fraction of a percent beyond. Sketches skip empty strings, which do count as a
value here, so every value is hashed behind a prefix.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LG_ENTRIES = 16


def count_state() -> Column:
    return F.count(F.lit(1))


def count_merge(state: Column | str) -> Column:
    return F.sum(state)


def sum_state(c: Column | str) -> Column:
    return F.sum(F.col(c).cast("decimal(20,0)") if isinstance(c, str) else c.cast("decimal(20,0)")
                 ).cast("decimal(38,0)")


def sum_merge(state: Column | str) -> Column:
    return F.sum(state).cast("decimal(38,0)")


def uniq_state(c: Column | str) -> Column:
    value = F.col(c) if isinstance(c, str) else c
    return F.theta_sketch_agg(F.concat(F.lit("f:"), value), LG_ENTRIES)


def uniq_merge(state: Column | str) -> Column:
    return F.theta_union_agg(state, LG_ENTRIES)


def final_number(state: Column | str) -> Column:
    """Count and sum states as BIGINT; raises when the total does not fit."""
    return (F.col(state) if isinstance(state, str) else state).cast("bigint")


def final_uniq(state: Column | str) -> Column:
    return F.theta_sketch_estimate(state).cast("bigint")

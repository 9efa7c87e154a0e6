"""Rollups: group raw rows into calendar buckets of mergeable states, and merge them again."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filetide.functions import columns as C
from filetide.functions import states as S
from filetide.operators.dedup import TIEBREAK, dedup_latest
from filetide.schema import EVENT_KEY, ROLLUP_DIMENSIONS, VERSION

# Merging to fewer keys than states are kept by goes in two levels over so many salts.
SALTS = 32


@dataclass(frozen=True)
class RollupSpec:
    """A rollup: its calendar grain, its dimensions and its measures."""

    name: str
    grain: str
    dims: tuple[str, ...] = tuple(ROLLUP_DIMENSIONS)
    sums: dict[str, str] = field(default_factory=lambda: {"bytes_read": "read", "bytes_written": "write"})
    distinct: dict[str, str] = field(default_factory=lambda: {"unique_files": "filename"})
    count: str = "events"

    @property
    def time(self) -> str:
        return self.grain

    @property
    def keys(self) -> list[str]:
        return [self.time, *self.dims]

    @property
    def measures(self) -> list[str]:
        return [self.count, *self.sums, *self.distinct]


HOURLY = RollupSpec("rollup_hourly", "hour")
DAILY = RollupSpec("rollup_daily", "day")


def names_of(spec: RollupSpec, measure: str = "unique_files") -> RollupSpec:
    """The rollup that counts ``measure`` of ``spec`` exactly: one group for each different value, with the number
    of its events. It is kept, revised and merged like any other; a value counts while it has events."""
    source = spec.distinct[measure]
    return RollupSpec(f"{spec.name}_{measure}", spec.grain, (*[d for d in spec.dims if d != source], source), sums={}, distinct={})


def exact_distinct(names: DataFrame, keys, spec: RollupSpec = HOURLY, measure: str = "unique_files") -> DataFrame:
    """How many different values there are per ``keys``, from the states of ``names_of(spec)``. Copies of a value
    meet in each task first, so neither a frequent value nor a key with very many gathers in one place."""
    of = names_of(spec, measure)
    events = names.groupBy(*keys, spec.distinct[measure]).agg(F.sum(state(of.count)).alias("_events"))
    return events.filter("_events > 0").groupBy(*keys).agg(F.count(F.lit(1)).alias(measure))


def exact_totals(states: DataFrame, names: DataFrame, keys, spec: RollupSpec = HOURLY, measure: str = "unique_files",
                 measures=None) -> DataFrame:
    """``totals`` with ``measure`` counted exactly instead of by its sketch."""
    rest = [m for m in measures or spec.measures if m != measure]
    exact = exact_distinct(names, keys, spec, measure)
    renamed = exact.select(*[F.col(k).alias(f"_{k}") for k in keys], measure)
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    found = totals(states, keys, spec, rest)
    joined = found.join(renamed, same, "left") if keys else found.crossJoin(renamed)
    return joined.select(*found.columns, F.coalesce(measure, F.lit(0).cast("bigint")).alias(measure))


def state(measure: str) -> str:
    return f"{measure}_state"


def _build(spec: RollupSpec) -> list[Column]:
    return (
        [S.count_state().alias(state(spec.count))]
        + [S.sum_state(source).alias(state(name)) for name, source in spec.sums.items()]
        + [S.uniq_state(source).alias(state(name)) for name, source in spec.distinct.items()]
    )


def _merge(spec: RollupSpec, measures) -> list[Column]:
    def one(name):
        if name == spec.count:
            return S.count_merge(state(name))
        return S.sum_merge(state(name)) if name in spec.sums else S.uniq_merge(state(name))

    return [one(name).alias(state(name)) for name in measures]


def _group(df: DataFrame, keys, first: list[Column], again: list[Column], salts: int) -> DataFrame:
    """Group once, or first by key and salt and then by key.

    Every task aggregates before it shuffles, so a hot key costs one state per task. A full
    distinct state is half a megabyte, and with very many tasks even that is too much for one
    reducer: the salt spreads a key's states over several tasks first. It is the number of the
    input partition, so a key gains no more than one row per salt.
    """
    if salts <= 1:
        return df.groupBy(*keys).agg(*first)
    salted = df.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
    return salted.groupBy(*keys, "_salt").agg(*first).groupBy(*keys).agg(*again)


def rollup(df: DataFrame, spec: RollupSpec = HOURLY, salts: int = 1) -> DataFrame:
    """States of ``spec`` from raw rows: the bucket, the dimensions, one state per measure."""
    return _rollup(df.withColumn(spec.time, C.bucket("event_time", spec.grain)), spec, salts)


def _rollup(rows: DataFrame, spec: RollupSpec, salts: int = 1) -> DataFrame:
    if "operation" in spec.dims:
        rows = rows.withColumn("operation", C.operation())
    rows = rows.select(*dict.fromkeys([*spec.keys, *_sources(spec)]))
    return _group(rows, spec.keys, _build(spec), _merge(spec, spec.measures), salts)


def _sources(spec: RollupSpec) -> list[str]:
    return [*spec.sums.values(), *spec.distinct.values()]


def rollup_latest(df: DataFrame, spec: RollupSpec, parts: int) -> DataFrame:
    """``rollup`` of the latest copy of each event, over ``parts`` tasks.

    Where groups are nearly as many as rows, grouping in each task first saves nothing, and rows would be
    written to disk once for their copies and again for their groups. The copies of an event and the rows of
    a group are both in one bucket of one server, so rows are dealt by these and move once; what a task sorts
    should fit it, which ``parts`` decides. A rollup without servers is made in two steps.
    """
    common = [k for k in EVENT_KEY if k in spec.dims]
    if not common:
        return rollup(dedup_latest(df), spec)
    rows = df.withColumn(spec.time, C.bucket("event_time", spec.grain))
    names = [*EVENT_KEY, VERSION, *TIEBREAK, spec.time, *[d for d in spec.dims if d != "operation"], "write", *_sources(spec)]
    rows = rows.select(*[n for n in dict.fromkeys(names) if n in rows.columns]).withColumn("event_id", C.short_id("event_id"))
    return _rollup(dedup_latest(rows.repartition(parts, spec.time, *common), within=(spec.time,)), spec)


def coarsen(states: DataFrame, fine: RollupSpec, coarse: RollupSpec, salts: int | None = None) -> DataFrame:
    """States of a coarser rollup from those of a finer one with the same measures."""
    rows = states.withColumn(coarse.time, C.bucket(fine.time, coarse.grain))
    return merge_states(rows, coarse.keys, coarse, salts=salts)


def merge_states(states: DataFrame, keys, spec: RollupSpec = HOURLY, measures=None,
                 salts: int | None = None) -> DataFrame:
    """States merged per ``keys``; only the states of ``measures`` are read. By default in two levels
    if keys are left out, since a result then gathers states from everywhere."""
    wanted = list(measures or spec.measures)
    narrow = states.select(*keys, *[state(m) for m in wanted])
    merged = _merge(spec, wanted)
    if salts is None:
        salts = 1 if set(spec.keys) <= set(keys) else SALTS
    return _group(narrow, keys, merged, merged, salts)


def finalize(states: DataFrame, spec: RollupSpec = HOURLY, measures=None) -> DataFrame:
    """Replaces states by the numbers they stand for."""
    wanted = list(measures or spec.measures)
    kept = [c for c in states.columns if c not in {state(m) for m in spec.measures}]
    return states.select(*kept, *[
        (S.final_uniq if m in spec.distinct else S.final_number)(state(m)).alias(m) for m in wanted])


def totals(states: DataFrame, keys, spec: RollupSpec = HOURLY, measures=None,
           salts: int | None = None) -> DataFrame:
    """Merge per ``keys``, then finalize: what a reader of a rollup table wants."""
    return finalize(merge_states(states, keys, spec, measures, salts), spec, measures)

"""Keeping rollups up to date as batches of raw rows arrive.

``as_inserted`` appends the states of every inserted row, redelivered copies included, so counts
and sums grow with redeliveries. ``exact`` counts every event once, by its latest copy: a batch adds the
states of the events that are new, found by a join with the stored rows of the hours it touches, and where
it revises stored events the groups they were and are counted in are aggregated again and replace what
there was. Copies that say the same change nothing. Both write under the batch's number, so doing a batch
twice changes nothing.
"""

from __future__ import annotations

from dataclasses import replace
from datetime import date
from functools import reduce
from operator import or_

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from filetide.functions import columns as C
from filetide.operators.dedup import TIEBREAK, dedup_latest
from filetide.operators.rollup import DAILY, HOURLY, RollupSpec, coarsen, rollup, state
from filetide.schema import EVENT_KEY, VERSION
from filetide.session import prepare
from filetide.storage import layout, numbers
from filetide.storage.tables import append_rollup, touched_days

AS_INSERTED, EXACT = "as_inserted", "exact"
SPECS = (HOURLY, DAILY)
# So many separate hours are named in a filter; more are covered by their first and last.
HOURS = 64


def _by_day(spec: RollupSpec) -> RollupSpec:
    """The rollup as stored: states of a bucket are kept per day, so that days can be replaced."""
    return replace(spec, dims=(layout.ROLLUP_DAY, *spec.dims))


def _derivable(coarse: RollupSpec, fine: RollupSpec) -> bool:
    """Whether states of ``coarse`` follow from those of ``fine``, sparing a pass over raw rows."""
    return fine.grain == "hour" and coarse != fine and replace(fine, name=coarse.name, grain=coarse.grain) == coarse


def _with_sources(specs) -> list[tuple[RollupSpec, RollupSpec | None]]:
    """Each rollup with the one it is made from, if not from raw rows; sources come first."""
    finer = [(s, next((f for f in specs if _derivable(s, f)), None)) for s in specs]
    return sorted(finer, key=lambda pair: pair[1] is not None)


def _write_all(rows: DataFrame, root: str, specs, batch_id, merged: int, days) -> None:
    """States of every rollup from raw rows; coarse ones from the hourly states just written."""
    spark = rows.sparkSession
    for spec, fine in _with_sources(specs):
        if fine is None:
            states = rollup(rows, _by_day(spec))
        else:
            stored = spark.read.schema(layout.rollup_schema(fine)).option(
                "basePath", layout.table_path(root, fine.name)).parquet(*[
                    layout.day_path(layout.table_path(root, fine.name), layout.ROLLUP_DAY, d)
                    for d in sorted(days)])
            wanted = F.lit(batch_id) if isinstance(batch_id, int) else batch_id
            states = coarsen(stored.filter((F.col("merged") == merged) & (F.col("batch_id") == wanted)),
                             _by_day(fine), _by_day(spec))
        append_rollup(states, root, spec, batch_id, merged)


def maintain_rollups(batch: DataFrame, batch_id: int, root: str, mode: str = EXACT,
                     specs: tuple[RollupSpec, ...] = SPECS, days: list[date] | None = None) -> None:
    """Brings every rollup up to date with one batch of raw rows that is already stored."""
    if mode not in (AS_INSERTED, EXACT):
        raise ValueError(f"mode is {AS_INSERTED!r} or {EXACT!r}, not {mode!r}")
    rows = batch.withColumn(layout.ROLLUP_DAY, F.to_date("event_time"))
    days = touched_days(rows, layout.ROLLUP_DAY) if days is None else days
    if not days:
        return
    if mode == AS_INSERTED:
        _write_all(rows, root, specs, batch_id, 0, days)
    else:
        refresh(batch.sparkSession, root, days, specs, batch_id)


def stale_days(spark: SparkSession, root: str, spec: RollupSpec = HOURLY) -> list[date]:
    """Days with raw batches that the rollup has not taken in."""
    latest = layout.latest_batches(layout.raw_parts(spark, root))
    built = layout.built_through(layout.rollup_parts(spark, root, spec))
    return sorted(day for day, batch in latest.items() if batch > built.get(day, -1))


def _rebuild(spark: SparkSession, root: str, specs, days, final: bool, own: int | None = None) -> list[date]:
    """States of whole days from raw rows, published as merged results; late rows of expired days are
    added to what is there instead."""
    last, horizon = numbers.settled(spark, root, own), layout.expired_through(spark, root)
    found = [p for p in layout.raw_parts(spark, root, days) if last is None or p.batch_id <= last]
    whole = [p for p in found if horizon is None or p.day > horizon]
    added = _add_late(spark, root, specs, [p for p in found if p not in set(whole)], final)
    latest = layout.latest_batches(whole)
    if not latest:
        return added
    through = layout.by_day(latest, layout.RAW_DAY)
    rows = layout.read_raw_parts(spark, root, latest).filter(F.col("batch_id") <= through)
    rows = dedup_latest(rows) if final else rows
    rows = rows.withColumnRenamed(layout.RAW_DAY, layout.ROLLUP_DAY)
    _write_all(rows, root, specs, layout.by_day(latest, layout.ROLLUP_DAY), layout.MERGED, latest)
    return sorted({*added, *latest})


def _add_late(spark: SparkSession, root: str, specs, late, final: bool) -> list[date]:
    """States of single raw batches under their own numbers. The rows they might repeat are gone, so
    only copies within a batch count once. A batch that a rollup has already is left out."""
    done = set()
    for spec in specs:
        have = {(p.day, p.batch_id) for p in layout.rollup_parts(spark, root, spec, {p.day for p in late})}
        merged = layout.merged_through(layout.rollup_parts(spark, root, spec, {p.day for p in late}))
        for number in sorted({p.batch_id for p in late}):
            days = {p.day for p in late if p.batch_id == number and (p.day, number) not in have
                    and number > merged.get(p.day, -1)}
            if not days:
                continue
            rows = layout.read_raw_parts(spark, root, days).filter(F.col("batch_id") == number)
            rows = dedup_latest(rows) if final else rows
            _write_all(rows.withColumnRenamed(layout.RAW_DAY, layout.ROLLUP_DAY), root, (spec,), number, 0, days)
            done |= days
    return sorted(done)


# Exact rollups by what a batch changes

def _narrow(rows: DataFrame, specs) -> DataFrame:
    """The columns that rollups and their upkeep read."""
    if any("operation" in s.dims for s in specs):
        rows = rows.withColumn("operation", C.operation())
    wanted = [layout.RAW_DAY, *EVENT_KEY, VERSION, *TIEBREAK, "batch_id"]
    for spec in specs:
        wanted += [*spec.dims, *spec.sums.values(), *spec.distinct.values()]
        wanted += ["write"] if "operation" in spec.dims else []  # which tells the operation
    return rows.select(*dict.fromkeys(wanted))


def _in_hours_of(rows: DataFrame, of: DataFrame) -> DataFrame | None:
    """``rows`` in the hours that ``of`` touches, by filters that reach the files; None if it has none."""
    hour = F.unix_seconds(F.date_trunc("hour", "event_time"))
    hours = sorted(r[0] for r in of.select(hour).distinct().limit(HOURS + 1).collect())
    if not hours:
        return None
    if len(hours) > HOURS:
        ranges = [list(of.agg(F.min(hour), F.max(hour)).first())]
    else:
        ranges = [[hours[0], hours[0]]]
        for at in hours[1:]:
            if at - ranges[-1][1] == 3600:
                ranges[-1][1] = at
            else:
                ranges.append([at, at])
    at = lambda seconds: F.timestamp_seconds(F.lit(seconds))
    said = [(F.col("event_time") >= at(a)) & (F.col("event_time") < at(b + 3600)) for a, b in ranges]
    return rows.filter(reduce(or_, said))


def _compared(stored: DataFrame, fresh: DataFrame) -> DataFrame:
    """Each of the ``fresh`` events with its stored copy, if there is one (``before``), and whether it ``wins``."""
    key = [layout.RAW_DAY, *EVENT_KEY]
    near = _in_hours_of(stored, fresh)
    if near is None:
        near = stored.limit(0)
    before = dedup_latest(near.join(fresh.select(*key), key, "left_semi"))
    rest = [c for c in stored.columns if c not in key]
    order = lambda side: F.struct(*[side[c] if side is not None else F.col(c) for c in (VERSION, *TIEBREAK)])
    both = fresh.join(before.select(*key, F.struct(*rest).alias("before")), key, "left")
    return both.withColumn("wins", F.col("before").isNull() | (order(None) > order(F.col("before"))))


def _contribution(spec: RollupSpec, side: Column | None = None) -> Column:
    """What an event adds to a rollup and where; the time is part of its key."""
    names = dict.fromkeys([*spec.dims, *spec.sums.values(), *spec.distinct.values()])
    pick = lambda c: F.col(c) if side is None or c in EVENT_KEY else side[c]
    return F.struct(*[pick(c).alias(c) for c in names])


def _as_states(rows: DataFrame, spec: RollupSpec) -> DataFrame:
    return rollup(rows.withColumnRenamed(layout.RAW_DAY, layout.ROLLUP_DAY), _by_day(spec))


def _none(spec: RollupSpec) -> dict[str, Column]:
    """States of no event."""
    empty = {state(spec.count): F.lit(0).cast("bigint")}
    empty |= {state(m): F.lit(0).cast("decimal(38,0)") for m in spec.sums}
    return empty | {state(m): F.lit(None).cast("binary") for m in spec.distinct}


def _seen(spark: SparkSession, spec: RollupSpec, days) -> DataFrame:
    """One row that counts nothing for each day: the batch has been taken in."""
    rows = spark.createDataFrame([(d,) for d in sorted(days)], f"{layout.ROLLUP_DAY} date")
    blank = {d: F.lit(None).cast("string") for d in spec.dims}
    return rows.withColumns({spec.time: C.bucket(layout.ROLLUP_DAY, spec.grain), **blank, **_none(spec)})


def _replacing(states: DataFrame, groups: DataFrame, spec: RollupSpec) -> DataFrame:
    """The states of ``groups``, those of no event where nothing is left of one."""
    keys = _by_day(spec).keys
    renamed = groups.select(*[F.col(k).alias(f"_{k}") for k in keys])
    both = renamed.join(states, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys], "left")
    return both.select(*[F.col(f"_{k}").alias(k) for k in keys], *[
        F.coalesce(name, empty).alias(name) for name, empty in _none(spec).items()])


def _publish(spark: SparkSession, root: str, spec: RollupSpec, latest, added: DataFrame, replacing, fenced) -> None:
    """Replaced groups first; they count once the additions, which every day has, are there."""
    number = layout.by_day(latest, layout.ROLLUP_DAY)
    if replacing is not None:
        append_rollup(replacing, root, spec, number, layout.REPLACED)
    fenced()
    append_rollup(added.unionByName(_seen(spark, spec, latest)), root, spec, number, layout.ADDED)


def _add_changes(spark: SparkSession, root: str, spec: RollupSpec, latest: dict[date, int], built: dict[date, int],
                 fenced) -> None:
    """Takes the raw batches after ``built`` and up to ``latest`` into a rollup made from raw rows."""
    raw = _narrow(layout.read_raw_parts(spark, root, latest), (spec,))
    number = F.col("batch_id")
    raw = raw.filter(number <= layout.by_day(latest, layout.RAW_DAY))
    known = {d: n for d, n in built.items() if d in latest}
    since = F.coalesce(layout.by_day(known, layout.RAW_DAY), F.lit(-1).cast("bigint"))
    fresh = dedup_latest(raw.filter(number > since)).drop("batch_id")
    if not known:
        _publish(spark, root, spec, latest, _as_states(fresh, spec), None, fenced)
        return
    fresh = fresh.persist(StorageLevel.MEMORY_AND_DISK)
    compared = _compared(raw.filter(number <= since).drop("batch_id"), fresh).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        new = compared.filter(F.col("before").isNull()).drop("before", "wins")
        other = ~_contribution(spec).eqNullSafe(_contribution(spec, F.col("before")))
        revised = compared.filter(F.col("before").isNotNull() & F.col("wins") & other)
        keys = _by_day(spec).keys
        place = lambda rows: rows.withColumn(spec.time, C.bucket("event_time", spec.grain)).withColumnRenamed(
            layout.RAW_DAY, layout.ROLLUP_DAY).select("event_time", *keys)
        then = revised.select(*[F.col(c) if c in EVENT_KEY or c == layout.RAW_DAY else F.col("before")[c].alias(c)
                                for c in fresh.columns])
        moved = place(revised.drop("before", "wins")).union(place(then)).persist(StorageLevel.MEMORY_AND_DISK)
        replacing = None
        around = _around(raw, moved, spec)
        if around is not None:
            groups = moved.select(*keys).distinct()
            rows = dedup_latest(around.drop("batch_id"))
            replacing = _replacing(_as_states(rows, spec), groups, spec)
        _publish(spark, root, spec, latest, _as_states(new, spec), replacing, fenced)
        moved.unpersist()
    finally:
        compared.unpersist()
        fresh.unpersist()


def _around(raw: DataFrame, moved: DataFrame, spec: RollupSpec) -> DataFrame | None:
    """The raw rows among which those of revised groups are: of their hours, or days for a longer grain."""
    if spec.grain == "hour":
        return _in_hours_of(raw, moved)
    days = [r[0] for r in moved.select(layout.ROLLUP_DAY).distinct().collect()]
    return raw.filter(F.col(layout.RAW_DAY).isin(days)) if days else None


def _derive(spark: SparkSession, root: str, spec: RollupSpec, fine: RollupSpec, whole: set[date], horizon, days,
            fenced) -> None:
    """Takes into a coarse rollup what has changed in the finer one it follows from; days ``whole`` again."""
    parts = layout.rollup_parts(spark, root, fine, days)
    latest = {d: n for d, n in layout.built_through(parts).items() if horizon is None or d > horizon}
    built = _clean_built(spark, root, spec, days)
    pending = {d: n for d, n in latest.items() if n > built.get(d, -1) or d in whole}
    merged = layout.merged_through(parts)
    again = {d: n for d, n in pending.items() if d in whole or d not in built or merged.get(d, -1) > built[d]}
    some = {d: n for d, n in pending.items() if d not in again}
    if again:
        states = layout.read_rollup_parts(spark, root, fine, again, again)
        append_rollup(coarsen(states, _by_day(fine), _by_day(spec)), root, spec,
                      layout.by_day(again, layout.ROLLUP_DAY), layout.MERGED)
    if some:
        chosen = [p for p in parts if p.day in some and built[p.day] < p.batch_id <= some[p.day]]
        path, schema = layout.table_path(root, fine.name), layout.rollup_schema(fine)
        read = lambda kind: layout.read_shown(spark, path, schema, [p for p in chosen if p.merged == kind])
        added = coarsen(read(layout.ADDED).filter(F.col(state(fine.count)) != 0), _by_day(fine), _by_day(spec))
        replacing = None
        if any(p.merged == layout.REPLACED for p in chosen):
            keys = _by_day(spec).keys
            groups = read(layout.REPLACED).withColumn(spec.time, C.bucket(fine.time, spec.grain)).select(*keys).distinct()
            now = layout.read_rollup_parts(spark, root, fine, some, some).withColumn(spec.time, C.bucket(fine.time, spec.grain))
            mine = now.join(groups.select(*[F.col(k).alias(f"_{k}") for k in keys]),
                            [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys], "left_semi").drop(spec.time)
            replacing = _replacing(coarsen(mine, _by_day(fine), _by_day(spec)), groups, spec)
        _publish(spark, root, spec, some, added, replacing, fenced)


def _clean_built(spark: SparkSession, root: str, spec: RollupSpec, days) -> dict[date, int]:
    """Per day the last batch taken in; what an interrupted round wrote for later ones is removed."""
    parts = layout.rollup_parts(spark, root, spec, days)
    built = layout.built_through(parts)
    for part in parts:
        if part.merged == layout.REPLACED and part.batch_id > built.get(part.day, -1):
            layout.delete(spark, part.path)
    return built


def _advance(spark: SparkSession, root: str, specs, days, own: int | None, fenced) -> list[date]:
    last, horizon = numbers.settled(spark, root, own), layout.expired_through(spark, root)
    found = [p for p in layout.raw_parts(spark, root, days) if last is None or p.batch_id <= last]
    late = [p for p in found if horizon is not None and p.day <= horizon]
    done = set(_add_late(spark, root, specs, late, True))
    living = [p for p in found if horizon is None or p.day > horizon]
    latest, compacted = layout.latest_batches(living), layout.merged_through(living)
    redone: dict[str, set[date]] = {}
    for spec, fine in _with_sources(specs):
        if fine is not None:
            _derive(spark, root, spec, fine, redone[fine.name], horizon, days, fenced)
            continue
        built = _clean_built(spark, root, spec, days)
        # A batch that was taken in before and has been written again, or compacted with what has not been.
        again = {p.day for p in living if p.batch_id == own and p.merged == layout.ADDED and built.get(p.day, -1) >= own}
        again |= {d for d, n in compacted.items() if d in built and n > built[d]}
        pending = {d: n for d, n in latest.items() if n > built.get(d, -1) and d not in again}
        if again:
            _rebuild(spark, root, (spec,), sorted(again), True, own)
        if pending:
            _add_changes(spark, root, spec, pending, built, fenced)
        redone[spec.name] = again
        done |= again | set(pending)
    return sorted(done)


def refresh(spark: SparkSession, root: str, days: list[date] | None = None,
            specs: tuple[RollupSpec, ...] = SPECS, own: int | None = None, owner: str = "upkeep") -> list[date]:
    """Takes the raw batches that are stored and settled into the exact rollups; the days that changed.

    ``own`` is the number of a batch that is stored but not yet released, and ``owner`` whose turn it is; while
    another has the turn nothing is done, and what is pending stays so until the next time. Days named without
    ``own`` are rebuilt from raw rows. Numbers that are still open hold back all later batches:
    ``numbers.open_marks`` names them. What the last rebuild of a day replaced is removed now, so that a reader
    which began before a rebuild still finds its files after it.
    """
    prepare(spark)
    turn = numbers.take_turn(spark, root, owner)
    if turn is None:
        return []

    def fenced() -> None:
        if not numbers.has_turn(spark, root, turn):
            raise RuntimeError("another job has taken over the rollups")

    try:
        for spec in specs:
            layout.vacuum(spark, layout.table_path(root, spec.name), layout.ROLLUP_DAY, days)
        if days is not None and own is None:
            return _rebuild(spark, root, specs, days, final=True)
        return _advance(spark, root, specs, days, own, fenced)
    finally:
        numbers.end_turn(spark, root, turn)


def backfill(spark: SparkSession, root: str, spec: RollupSpec, start: date | None = None,
             end: date | None = None, mode: str = EXACT) -> list[date]:
    """Fills a rollup, for example a new one, from raw rows already stored in ``[start, end)``."""
    prepare(spark)
    stored = {p.day for p in layout.raw_parts(spark, root)}
    days = [d for d in stored if (start is None or d >= start) and (end is None or d < end)]
    return _rebuild(spark, root, (spec,), days, final=mode == EXACT)

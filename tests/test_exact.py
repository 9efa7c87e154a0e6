"""Exact rollups kept by changes, and batches of jobs that are lost."""

import random

import pytest
from helpers import plan, raw, record, rows
from pyspark.sql import functions as F

from filetide.operators import rollup as R
from filetide.operators.dedup import dedup_latest
from filetide.sources.tables import read_raw, read_rollup
from filetide.storage import layout, numbers, tables
from filetide.streaming import maintain
from filetide.streaming.ingest import store_batch
from filetide.streaming.upkeep import upkeep

BY_SITE = R.RollupSpec("rollup_site", "day", ("vo", "site"), sums={"bytes_stored": "filesize"},
                       distinct={"unique_users": "user"})


class Lost(Exception):
    pass


def _random_batch(spark, rng, number, size=12):
    """Few files, so that most events come again, some of them revised or moved to another group."""
    said = []
    for _ in range(size):
        name, hour, day = f"/f{rng.randrange(8)}", rng.randrange(3), rng.randrange(20, 22)
        said.append(record(name, rng.randrange(3), write=rng.randrange(2), vo=rng.choice(["a", "b"]), site=rng.choice("xy"),
                           **{"@timestamp": f"2026-03-{day}T{hour:02d}:00:00Z"}))
    return raw(spark, said, f"2026-03-22 13:00:{number % 60:02d}" if number % 4 else "2026-03-22 13:30:00")


def _from_raw(spark, root, spec):
    return rows(R.totals(R.rollup(dedup_latest(read_raw(spark, root)), spec), spec.keys, spec))


def _kept(spark, root, spec):
    return rows(R.totals(read_rollup(spark, root, spec), spec.keys, spec))


def test_changes_give_what_a_rebuild_gives(spark, root):
    rng = random.Random(1)
    specs = (R.HOURLY, R.DAILY, BY_SITE)
    replaced = 0
    for number in range(7):
        tables.append_raw(_random_batch(spark, rng, number), root, number)
        if number not in (2, 3):  # then several batches at once
            maintain.refresh(spark, root, specs=specs)
            replaced += any(p.merged == layout.REPLACED for p in layout.rollup_parts(spark, root, R.HOURLY))
            for spec in specs:
                assert _kept(spark, root, spec) == _from_raw(spark, root, spec), (number, spec.name)
        if number == 4:
            tables.compact_rollup(spark, root, R.HOURLY)
            tables.compact_raw(spark, root)
    assert replaced > 1 and maintain.stale_days(spark, root) == []
    assert maintain.refresh(spark, root, specs=specs) == []
    tables.ensure_tables(spark, root, "exact_views")
    shown = spark.table("exact_views.rollup_hourly")
    assert rows(R.totals(shown, R.HOURLY.keys)) == _from_raw(spark, root, R.HOURLY)
    for spec in specs:
        tables.compact_rollup(spark, root, spec)
        assert _kept(spark, root, spec) == _from_raw(spark, root, spec)


def test_a_batch_written_again_after_it_was_counted(spark, root):
    rng = random.Random(2)
    batches = [_random_batch(spark, rng, n) for n in range(3)]
    for n in (0, 1, 2):
        tables.append_raw(batches[n], root, n)
        maintain.refresh(spark, root, None, own=n)
    again = batches[1].withColumn("ingest_time", F.lit("2026-04-01 00:00:00").cast("timestamp"))
    tables.append_raw(again, root, 1)
    maintain.maintain_rollups(again, 1, root)
    for spec in maintain.SPECS:
        assert _kept(spark, root, spec) == _from_raw(spark, root, spec)


@pytest.mark.parametrize("when", [1, 2, 3, 4])
def test_interrupted_between_two_writes(spark, root, monkeypatch, when):
    """A reader sees all of a batch or nothing, and the next round makes up for it."""
    rng = random.Random(3)
    for n in (0, 1):
        tables.append_raw(_random_batch(spark, rng, n, 20), root, n)
        maintain.refresh(spark, root)
    before = _kept(spark, root, R.HOURLY)
    tables.append_raw(_random_batch(spark, rng, 2, 20), root, 2)
    after = _from_raw(spark, root, R.HOURLY)
    done, write = [], maintain.append_rollup

    def fail(*args, **more):
        write(*args, **more)
        done.append(args)
        if len(done) == when:
            raise Lost

    monkeypatch.setattr(maintain, "append_rollup", fail)
    with pytest.raises(Lost):
        maintain.refresh(spark, root)
    monkeypatch.undo()
    assert before != after and _kept(spark, root, R.HOURLY) == (before if when == 1 else after)
    tables.append_raw(_random_batch(spark, rng, 3, 20), root, 3)
    maintain.refresh(spark, root)
    for spec in maintain.SPECS:
        assert _kept(spark, root, spec) == _from_raw(spark, root, spec)


def test_only_touched_hours_of_stored_rows_are_read(spark, root):
    for n, hour in enumerate((1, 2, 3, 4)):
        tables.append_raw(raw(spark, [record(f"/{i}", **{"@timestamp": f"2026-03-22T{hour:02d}:10:00Z"}) for i in range(5)]), root, n)
        maintain.refresh(spark, root)
    stored = read_raw(spark, root)
    fresh = stored.filter("batch_id = 2").drop("batch_id")
    near = maintain._in_hours_of(stored, fresh)
    scan = plan(near)
    assert "GreaterThanOrEqual(event_time,2026-03-22" in scan and "LessThan(event_time,2026-03-22" in scan
    assert near.count() == 5
    assert maintain._in_hours_of(stored, stored.limit(0)) is None
    tables.compact_raw(spark, root)
    groups = spark.read.parquet(layout.raw_path(root)).select(F.date_trunc("hour", "event_time").alias("h"))
    assert [r.h.hour for r in groups.collect()] == sorted(r.h.hour for r in groups.collect())


def test_only_one_changes_the_rollups(spark, root):
    turn = numbers.take_turn(spark, root, "one")
    assert turn and numbers.take_turn(spark, root, "two") is None
    tables.append_raw(raw(spark, [record()]), root, 0)
    assert maintain.refresh(spark, root, owner="two") == []
    assert numbers.take_turn(spark, root, "one") != turn  # a job's own turn, left when its driver was lost
    assert numbers.take_turn(spark, root, "two", lease_seconds=-1)
    assert not numbers.has_turn(spark, root, turn)


def _dying(at):
    def step(name):
        if name == at:
            raise Lost(name)

    return step


@pytest.mark.parametrize("at", ["marked", "claimed", "noted", "written", "stored", "counted"])
def test_a_lost_driver_comes_back(spark, root, tmp_path, at):
    batch = raw(spark, [record(f"/{i}") for i in range(4)])
    with pytest.raises(Lost):
        store_batch(batch, 0, root, str(tmp_path / "a"), _dying(at))
    store_batch(raw(spark, [record("/other")]), 0, root, str(tmp_path / "b"))
    store_batch(batch, 0, root, str(tmp_path / "a"))
    maintain.refresh(spark, root)
    assert numbers.open_marks(spark, root) == []
    assert read_raw(spark, root).count() == 5
    assert rows(R.totals(read_rollup(spark, root), [], measures=["events"])) == [(5,)]


@pytest.mark.parametrize("mode", [maintain.EXACT, maintain.AS_INSERTED])
@pytest.mark.parametrize("at", ["claimed", "written", "stored"])
def test_a_job_that_never_comes_back(spark, root, tmp_path, at, mode):
    lost = raw(spark, [record(f"/{i}") for i in range(4)])
    with pytest.raises(Lost):
        store_batch(lost, 0, root, str(tmp_path / "a"), _dying(at), mode=mode)
    for n in (0, 1):
        store_batch(raw(spark, [record(f"/other{n}")]), n, root, str(tmp_path / "b"), mode=mode)
    early = upkeep(spark, root, "2026-03-22 12:00:00", mode)
    assert early["held back"] == [0] and not early["finished"] and not early["given up"]
    done = upkeep(spark, root, "2026-03-22 12:00:00", mode, lease_seconds=-1)
    kept = at == "stored"  # the rows were whole
    assert (done["finished"], done["given up"]) == (([0], []) if kept else ([], [0]))
    assert done["held back"] == [] and numbers.settled(spark, root) is None
    total = 6 if kept else 2
    assert read_raw(spark, root).count() == total
    assert rows(R.totals(read_rollup(spark, root), [], measures=["events"])) == [(total,)]
    # It comes back after all: its messages were never acknowledged, and count once.
    store_batch(lost, 0, root, str(tmp_path / "a"), mode=mode)
    assert rows(R.totals(read_rollup(spark, root), [], measures=["events"])) == [(6,)]


def test_a_slow_job_whose_number_was_given_up(spark, root, tmp_path):
    def meanwhile(name):
        if name == "written" and not taken:
            taken.append(upkeep(spark, root, "2026-03-22 12:00:00", lease_seconds=-1)["given up"])

    taken = []
    number = store_batch(raw(spark, [record("/a"), record("/b")]), 0, root, str(tmp_path / "a"), meanwhile)
    assert taken == [[0]] and number == 1 and layout.voided(spark, root) == {0}
    assert read_raw(spark, root).count() == 2
    assert rows(R.totals(read_rollup(spark, root), [], measures=["events"])) == [(2,)]
    tables.ensure_tables(spark, root, "slow_views")
    assert spark.table("slow_views.raw").count() == 2

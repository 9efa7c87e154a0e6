from datetime import date

import pytest
from helpers import plan, raw, record, rows
from pyspark.sql import functions as F

from filetide.operators import rollup as R
from filetide.sources.tables import raw_view, read_raw, read_rollup
from filetide.storage import layout, numbers, retention, tables
from filetide.streaming import maintain
from filetide.streaming.upkeep import upkeep


def _batch(spark, names, version="2026-03-22 13:00:00", day=22, **changes):
    return raw(spark, [record(n, **{"@timestamp": f"2026-03-{day}T12:00:00Z"}, **changes) for n in names], version)


def _store(spark, root, mode, batches):
    for number, batch in batches:
        tables.append_raw(batch, root, number)
        stored = read_raw(spark, root).filter(F.col("batch_id") == number)
        maintain.maintain_rollups(stored, number, root, mode)


def _usage(spark, root, spec=R.HOURLY):
    return rows(R.totals(read_rollup(spark, root, spec), [spec.time, "vo"], spec))


@pytest.fixture()
def batches(spark):
    return [(0, _batch(spark, ["/a", "/b"])), (1, _batch(spark, ["/c"], day=21)),
            (2, _batch(spark, ["/a", "/c2"], "2026-03-22 14:00:00", vo="new"))]


def test_replay_changes_nothing(spark, root, batches):
    _store(spark, root, maintain.AS_INSERTED, batches)
    before = rows(read_raw(spark, root).select("event_id", "vo")), _usage(spark, root)
    _store(spark, root, maintain.AS_INSERTED, [batches[1], batches[0], batches[2]])
    assert (rows(read_raw(spark, root).select("event_id", "vo")), _usage(spark, root)) == before


def test_compaction_changes_no_answer(spark, root, batches):
    _store(spark, root, maintain.AS_INSERTED, batches)
    final = rows(raw_view(spark, root).select("event_id", "vo", "raw_json"))
    hourly, daily = _usage(spark, root), _usage(spark, root, R.DAILY)
    assert tables.compact_raw(spark, root) == [date(2026, 3, 21), date(2026, 3, 22)]
    tables.compact_rollup(spark, root, R.HOURLY)
    tables.compact_rollup(spark, root, R.DAILY)
    assert rows(read_raw(spark, root).select("event_id", "vo", "raw_json")) == final
    assert (_usage(spark, root), _usage(spark, root, R.DAILY)) == (hourly, daily)
    assert all(p.merged for p in layout.raw_parts(spark, root))
    assert tables.compact_raw(spark, root) == []


def test_a_crash_before_cleaning_up_counts_nothing_twice(spark, root, batches):
    _store(spark, root, maintain.AS_INSERTED, batches)
    hourly = _usage(spark, root)
    tables.compact_rollup(spark, root, R.HOURLY, clean=False)
    tables.compact_raw(spark, root, clean=False)
    assert _usage(spark, root) == hourly
    assert read_raw(spark, root).count() == raw_view(spark, root).count() == 4
    assert layout.vacuum(spark, layout.raw_path(root), layout.RAW_DAY)
    assert read_raw(spark, root).count() == 4


def test_batches_after_and_replays_before_a_compaction(spark, root, batches):
    _store(spark, root, maintain.AS_INSERTED, batches[:2])
    tables.compact_raw(spark, root)
    tables.compact_rollup(spark, root, R.HOURLY)
    tables.compact_rollup(spark, root, R.DAILY)
    _store(spark, root, maintain.AS_INSERTED, [batches[1], batches[2]])
    assert read_raw(spark, root).count() == 5
    assert sum(r[2] for r in _usage(spark, root)) == 5
    assert tables.compact_raw(spark, root) == [date(2026, 3, 22)]


def test_exact_rollups_follow_deduplicated_rows_in_any_order(spark, tmp_path, batches):
    expected = None
    for order in ([0, 1, 2], [0, 2, 1, 0, 2]):
        root = str(tmp_path / "-".join(map(str, order)))
        _store(spark, root, maintain.EXACT, [batches[i] for i in order])
        direct = rows(R.totals(R.rollup(raw_view(spark, root)), ["hour", "vo"]))
        assert _usage(spark, root) == direct
        expected = expected or direct
        assert direct == expected


def test_scheduled_refresh_and_backfill_agree(spark, root, batches):
    for number, batch in batches:
        tables.append_raw(batch, root, number)
    assert maintain.stale_days(spark, root) == [date(2026, 3, 21), date(2026, 3, 22)]
    maintain.refresh(spark, root)
    assert maintain.stale_days(spark, root) == []
    refreshed = _usage(spark, root, R.DAILY)
    other = R.RollupSpec("other_daily", "day")
    maintain.backfill(spark, root, other, date(2026, 3, 21), date(2026, 3, 22))
    maintain.backfill(spark, root, other)
    maintain.backfill(spark, root, other)
    assert rows(R.totals(read_rollup(spark, root, other), ["day", "vo"], other)) == refreshed


def test_days_and_columns_are_pruned(spark, root, batches):
    _store(spark, root, maintain.EXACT, batches)
    text = plan(raw_view(spark, root, start="2026-03-22 00:00:00", end="2026-03-22 18:00:00").select("event_id"))
    partition = next(line for line in text.splitlines() if line.startswith("PartitionFilters"))
    assert "event_date" in partition and "2026-03-22" in partition
    schema = next(line for line in text.splitlines() if line.startswith("ReadSchema"))
    assert "raw_json" not in schema and "filename" not in schema
    tables.compact_rollup(spark, root, R.HOURLY, clean=False)
    opened = layout.read_rollup_parts(spark, root, R.HOURLY).inputFiles()
    assert opened and all("merged=1" in f for f in opened)


def test_a_bounded_read_lists_its_days_only(spark, root, batches, monkeypatch):
    _store(spark, root, maintain.EXACT, batches)
    listed = []
    whole = layout.parts
    monkeypatch.setattr(layout, "parts", lambda s, path, day, days=None: listed.append(days) or whole(s, path, day, days))
    assert read_raw(spark, root, "2026-03-22 00:00:00", "2026-03-22 18:00:00").count() == 4
    assert read_rollup(spark, root, start="2026-03-22 00:00:00").count() > 0
    assert listed == [[date(2026, 3, 22)], [date(2026, 3, 22)]]


def test_late_rows_add_to_days_that_have_expired(spark, root, batches):
    _store(spark, root, maintain.EXACT, batches)
    before = _usage(spark, root)
    retention.expire_raw(spark, root, "2026-10-01 00:00:00")
    assert read_raw(spark, root).count() == 0
    tables.append_raw(_batch(spark, ["/late"]), root, 3)
    for again in (maintain.refresh, lambda s, r: maintain.backfill(s, r, R.HOURLY), maintain.refresh):
        again(spark, root)
        tables.compact_raw(spark, root)
        tables.compact_rollup(spark, root, R.HOURLY)
        after = _usage(spark, root)
        assert sum(r[2] for r in after) == sum(r[2] for r in before) + 1
        assert sum(r[2] for r in _usage(spark, root, R.DAILY)) == sum(r[2] for r in before) + 1


def test_two_jobs_take_different_numbers_and_keep_them(spark, root, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    assert [numbers.claim(spark, root, c, n) for c, n in ((a, 0), (b, 0), (a, 1), (b, 0))] == [0, 1, 2, 1]
    assert numbers.settled(spark, root) == -1 and numbers.settled(spark, root, own=0) == 0
    for n in (0, 2):
        numbers.release(spark, root, n)
    assert numbers.settled(spark, root) == 0 and numbers.settled(spark, root, own=1) is None
    numbers.release(spark, root, 1)
    assert [numbers.claim(spark, root, a, n) for n in range(2, 60)] == list(range(3, 61))
    assert numbers.claim(spark, root, a, 59) == 60


def test_a_merge_stops_below_an_open_batch(spark, root, tmp_path):
    slow, quick = (numbers.claim(spark, root, str(tmp_path / c), 0) for c in ("slow", "quick"))
    tables.append_raw(_batch(spark, ["/b"]), root, quick)
    assert tables.compact_raw(spark, root) == [] == maintain.refresh(spark, root)
    numbers.release(spark, root, quick)
    tables.append_raw(_batch(spark, ["/a"]), root, slow)
    numbers.release(spark, root, slow)
    assert tables.compact_raw(spark, root) == [date(2026, 3, 22)]
    assert read_raw(spark, root).count() == 2


def test_upkeep_cleans_up_after_an_interrupted_run(spark, root, batches):
    _store(spark, root, maintain.EXACT, batches)
    tables.compact_raw(spark, root, clean=False)
    done = upkeep(spark, root, "2026-05-21 00:00:00")
    assert done["expired raw"] == [date(2026, 3, 21)]
    assert len(layout.raw_parts(spark, root)) == 1
    assert upkeep(spark, root, "2026-05-21 00:00:00")["expired raw"] == []
    assert sum(r[2] for r in _usage(spark, root)) == 4


def test_too_many_days_are_refused(spark):
    days = spark.range(101).select(F.expr("date'2026-01-01' + cast(id as int)").alias("event_date"))
    assert len(tables.touched_days(days)) == 101
    assert len(tables.touched_days(days.filter("event_date > '2026-01-01'"), limit=100)) == 100
    with pytest.raises(tables.TooManyDays):
        tables.touched_days(days, limit=100)


def test_quarantine_copies_bad_rows(spark, root):
    batch = raw(spark, [record(), "broken"])
    tables.append_raw(batch, root, 0)
    tables.write_quarantine(batch, root, 0)
    assert rows(tables.read_quarantine(spark, root).select("raw_json")) == [("broken",)]
    assert read_raw(spark, root).count() == 2


def test_raw_expiry_boundaries(spark, root):
    times = ["2026-05-01T11:59:59.999Z", "2026-05-01T12:00:00Z", "2026-05-01T12:00:01Z", "2026-04-30T23:59:59Z"]
    tables.append_raw(raw(spark, [record(f"/{i}", **{"@timestamp": t}) for i, t in enumerate(times)]), root, 0)
    as_of = "2026-06-30 12:00:00"
    assert retention.expire_raw(spark, root, as_of) == [date(2026, 4, 30)]
    kept = retention.unexpired_raw(read_raw(spark, root), as_of)
    assert rows(kept.select("filename")) == [("/2",)]
    assert rows(retention.unexpired_raw(read_raw(spark, root), as_of, 90).select("filename")) == [
        ("/0",), ("/1",), ("/2",)]


def test_rollup_expiry_boundaries(spark, root):
    times = ["2024-02-29T05:00:00Z", "2024-02-29T06:00:00Z", "2024-02-28T23:00:00Z"]
    tables.append_raw(raw(spark, [record(f"/{i}", **{"@timestamp": t}) for i, t in enumerate(times)]), root, 0)
    maintain.refresh(spark, root)
    as_of = "2026-02-28 05:00:00"
    assert retention.expire_rollup(spark, root, R.DAILY, as_of) == [date(2024, 2, 28), date(2024, 2, 29)]
    assert retention.expire_rollup(spark, root, R.HOURLY, as_of) == []
    kept = retention.unexpired_rollup(read_rollup(spark, root), R.HOURLY, as_of)
    assert [str(r.hour) for r in kept.select("hour").orderBy("hour").collect()] == [
        "2024-02-28 23:00:00", "2024-02-29 06:00:00"]


def test_bucketed_tables_dedup_without_exchange(spark, tmp_path):
    tables.write_bucketed(raw(spark, [record(), record(), record("/b")]), str(tmp_path / "b"), "bucketed_raw", 4)
    from filetide.operators.dedup import dedup_latest

    latest = dedup_latest(spark.table("bucketed_raw"))
    assert latest.count() == 2
    assert "Exchange" not in plan(latest).split("\n\n")[0]


def test_a_day_with_most_rows_is_split_over_files(spark, root):
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "65536")
    try:
        rows = spark.range(40000, numPartitions=16).select(
            F.expr("date_add(date'2026-01-01', cast(if(id % 3 = 0, id % 30, 0) as int))").alias("event_date"),
            F.col("id"), F.sha2(F.col("id").cast("string"), 256).alias("vo"))
        layout.write_parts(rows, layout.raw_path(root), layout.RAW_DAY, 0, order=["id"])
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    written = spark.read.parquet(layout.raw_path(root))
    files = dict(written.select("event_date", F.input_file_name().alias("f")).distinct()
                 .groupBy("event_date").count().collect())
    assert written.count() == 40000
    assert files[date(2026, 1, 1)] > 4 and len(files) == 10


def test_bodies_stay_out_of_the_comparison(spark, root, batches):
    """What is compared and moved holds no body; one row for each event comes back whole."""
    for number, batch in batches:
        tables.append_raw(batch, root, number)
    latest = raw_view(spark, root)
    found = plan(latest)
    compared = [part for part in found.split("\n\n") if "Exchange" in part.split("\n")[0] and "Broadcast" not in part.split("\n")[0]]
    assert compared and not any("raw_json" in part for part in compared)
    from filetide.operators.dedup import dedup_latest

    assert rows(latest) == rows(dedup_latest(read_raw(spark, root)))
    assert raw_view(spark, root + "/none").count() == 0


def test_stored_questions_read_their_days(spark):
    from filetide.catalog import queries as Q

    sf = "/root/testdata/sf0.001"
    for name, day in (("q1_usage_by_vo_stored", "bucket_date"), ("q4_split_by_source_operation_stored", "bucket_date"),
                      ("q6_raw_spot_check_stored", "event_date"), ("q8_count_by_source_stored", "event_date")):
        text = plan(Q.queries()[name](spark, sf))
        filters = [line for line in text.splitlines() if line.startswith("PartitionFilters")]
        assert filters and all(day in line for line in filters), name


def test_footers_say_what_a_reader_skips(spark, tmp_path):
    from filetide.storage import footers

    path = str(tmp_path / "sorted")
    spark.range(4000, numPartitions=1).select(F.timestamp_seconds("id").alias("t"), F.lpad(
        F.col("id").cast("string"), 5, "0").alias("s"), F.lit("x" * 50).alias("body")).write.option(
            "parquet.block.size", "4096").parquet(path)
    groups = footers.row_groups(spark, path, ["t", "s"])
    whole = footers.skipping(groups, F.lit(True)).first()
    assert whole.rows == whole.rows_read == 4000 and whole.row_groups == whole.row_groups_read > 8
    by_time = footers.skipping(groups, footers.may_hold_time("t", 2000, 2001)).first()
    by_text = footers.skipping(groups, footers.may_hold_text("s", "02000")).first()
    assert by_time.row_groups_read == by_text.row_groups_read == 1
    assert footers.skipping(groups, footers.may_hold_text("s", "zzz")).first().rows_read == 0
    assert footers.skipping(groups, footers.may_hold_text("body", "no range asked for")).first().rows_read == 4000

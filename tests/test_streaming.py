import json

import pytest
from helpers import messages, record, rows
from pyspark.sql import functions as F

from filetide.operators import rollup as R
from filetide.operators.normalize import normalize_records
from filetide.sources.messages import allowed_names, read_messages, union_sources
from filetide.sources.tables import raw_view, read_raw, read_rollup
from filetide.streaming import maintain, metrics
from filetide.streaming.ingest import write_raw

NOW = {"availableNow": True}


def _land(spark, path, *files):
    for records in files:
        (messages(spark, records).coalesce(1).write.mode("append")
         .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSXXX").json(path))


def _run(spark, landing, root, checkpoint, files=1, **options):
    write_raw(read_messages(spark, landing, max_files=files), root, checkpoint, NOW, **options).awaitTermination()


def test_three_messages_one_duplicate(spark, tmp_path):
    landing, root, check = (str(tmp_path / n) for n in ("in", "tables", "check"))
    _land(spark, landing, [record()], [record(), "broken"], [record("/store/run17/tracks.dat", 200)])
    _run(spark, landing, root, check, mode=maintain.EXACT)
    assert read_raw(spark, root).count() == 4
    assert raw_view(spark, root).filter(~F.col("parse_error")).count() == 2
    assert rows(R.totals(read_rollup(spark, root), ["vo"])) == [("", 1, 0, 0, 1), ("astro", 2, 300, 0, 2)]
    totals = metrics.counters(metrics.read_batches(spark, root), metrics.read_commits(spark, root)).first()
    assert totals.asDict() == {"messages": 4, "parse_errors": 1, "rows_inserted": 4, "quarantined": 1,
                               "batches_committed": 3, "insert_failures": 0}

    # A restart takes only what is new, and late rows land in their own old day.
    _land(spark, landing, [record("/late", 7, **{"@timestamp": "2026-01-01T00:30:00Z"})])
    _run(spark, landing, root, check, mode=maintain.EXACT)
    assert raw_view(spark, root).count() == 4
    late = read_rollup(spark, root).filter(F.col("hour") == "2026-01-01 00:00:00")
    assert rows(R.totals(late, [], measures=["events", "bytes_read"])) == [(1, 7)]

    # A second checkpoint takes numbers of its own, also after a restart.
    for more in (1, 2):
        _land(spark, landing + "2", [record(f"/other/{more}")])
        _run(spark, landing + "2", root, check + "2", mode=maintain.EXACT)
        assert raw_view(spark, root).count() == 4 + more


def test_stream_equals_batch(spark, tmp_path):
    landing, root = str(tmp_path / "in"), str(tmp_path / "tables")
    records = [record(f"/{i % 4}", i, write=i % 2) for i in range(9)]
    _land(spark, landing, records[:3], records[3:6], records[6:])
    _run(spark, landing, root, str(tmp_path / "check"), mode=maintain.AS_INSERTED)
    batch = normalize_records(messages(spark, records))
    keys = ["hour", "operation"]
    assert rows(R.totals(read_rollup(spark, root), keys)) == rows(R.totals(R.rollup(batch), keys))
    assert rows(R.totals(read_rollup(spark, root, R.DAILY), ["operation"], R.DAILY)) == rows(
        R.totals(R.rollup(batch, R.DAILY), ["operation"], R.DAILY))


def test_refresh_every_other_batch(spark, tmp_path):
    landing, root = str(tmp_path / "in"), str(tmp_path / "tables")
    _land(spark, landing, [record("/a")], [record("/a")], [record("/c")])
    _run(spark, landing, root, str(tmp_path / "check"), mode=maintain.EXACT, refresh_every=2)
    assert rows(R.totals(read_rollup(spark, root), [], measures=["events"])) == [(1,)]
    maintain.refresh(spark, root)
    assert rows(R.totals(read_rollup(spark, root), [], measures=["events"])) == [(2,)]


def test_a_refused_batch_fails_the_stream_and_is_counted(spark, tmp_path):
    landing, root, check = (str(tmp_path / n) for n in ("in", "tables", "check"))
    days = [record(f"/{d}", **{"@timestamp": f"2026-03-{d:02d}T00:00:00Z"}) for d in range(1, 5)]
    _land(spark, landing, days)
    with pytest.raises(Exception, match="more than 3 days"):
        _run(spark, landing, root, check, max_days=3)
    assert rows(metrics.read_commits(spark, root).select("committed")) == [(False,)]
    _run(spark, landing, root, check, max_days=4)
    assert read_raw(spark, root).count() == 4


def test_latency_buckets(spark):
    seconds = [0.001, 0.005, 0.0051, 10.24, 10.25]
    df = spark.createDataFrame([(s,) for s in seconds], "latency_seconds double")
    out = metrics.latency_histogram(df).collect()
    assert len(out) == 13
    assert [(r.le, r["count"]) for r in out if r.le in (0.005, 0.01, 10.24, float("inf"))] == [
        (0.005, 2), (0.01, 3), (10.24, 4), (float("inf"), 5)]


def test_source_names(spark):
    assert allowed_names(" a, b ,,") == ["a", "b"]
    with pytest.raises(ValueError):
        allowed_names(" , ")
    a, b = spark.range(2), spark.range(3)
    both = union_sources({"a": a, "b": b, "c": a}, "a,b")
    assert rows(both.groupBy("source_exchange").count()) == [("a", 2), ("b", 3)]
    with pytest.raises(ValueError):
        union_sources({"a": a}, ["z"])


def test_text_lines_are_bodies(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "x.txt").write_text(json.dumps(record()) + "\nbroken\n")
    stream = read_messages(spark, str(tmp_path / "in"), "text", source="lines")
    (stream.writeStream.format("memory").queryName("lines").trigger(**NOW)
     .option("checkpointLocation", str(tmp_path / "c")).start()).awaitTermination()
    assert rows(spark.table("lines").groupBy("source_exchange").count()) == [("lines", 2)]


def test_a_listener_sees_batches_and_failures(spark, tmp_path):
    landing, root, check = (str(tmp_path / n) for n in ("in", "tables", "check"))
    _land(spark, landing, [record(), "broken"], [record(f"/{d}", **{"@timestamp": f"2026-03-0{d}T00:00:00Z"}) for d in (1, 2)])
    watch = metrics.Watch()
    spark.streams.addListener(watch)
    try:
        with pytest.raises(Exception, match="more than 1 days"):
            _run(spark, landing, root, check, files=2, max_days=1, mode=None)
        _run(spark, landing, root, check, files=2, mode=None)
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    finally:
        spark.streams.removeListener(watch)
    assert sum(b["messages"] for b in watch.batches) == 4 and sum(b["parse_errors"] for b in watch.batches) == 1
    assert [e["error"] is None for e in watch.ended] == [False, True] and "more than 1 days" in watch.ended[0]["error"]
    assert metrics.counters(metrics.read_batches(spark, root), metrics.read_commits(spark, root)).first()["insert_failures"] == 1

import gc
import glob

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from helpers import plan
from pyspark.sql import functions as F

from filetide import fixtures as X
from filetide.catalog import queries as Q


@pytest.fixture()
def events(spark, tmp_path):
    """A folder with one events file of one row group, which one task would read."""
    n = F.col("id")
    rows = spark.range(6000, numPartitions=1).select(
        n.alias("event_id"), F.timestamp_seconds(F.lit(1_704_067_200) + n * 420).cast("timestamp_ntz").alias("ts"),
        (n % 50).alias("user_id"), F.element_at(F.array(F.lit("view"), F.lit("click")), (n % 2 + 1).cast("int")).alias("event_type"),
        (n % 100 / 4).alias("value"), F.concat(F.lit("k"), n).alias("props"))
    where = tmp_path / "sf"
    where.mkdir()
    pq.write_table(rows.toArrow(), where / "events.parquet")
    return str(where)


def test_events_of_one_row_group_are_dealt_over_tasks(spark, events):
    records = X.event_records(spark, events)
    sizes = [r["n"] for r in records.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert sum(sizes) == 6600 and len(sizes) > 1


def test_a_task_gets_no_more_rows_when_tables_grow(spark, events, monkeypatch):
    monkeypatch.setattr(X, "ROWS_A_TASK", 100)
    assert X.dealt_events(spark, events).rdd.getNumPartitions() == 60
    spark.range(5000, numPartitions=1).select(F.col("id").alias("l_orderkey")).write.parquet(f"{events}/lineitem.parquet")
    assert X.dealt(spark, events, "lineitem", "l_orderkey").rdd.getNumPartitions() == 50


def test_events_are_dealt_once_for_many_readers(spark, events):
    with X.events_at_hand(spark, events):
        assert "InMemoryTableScan" in plan(X.event_batches(X.event_records(spark, events))[0][1])
    assert "InMemoryTableScan" not in plan(X.event_records(spark, events))


def test_a_delivery_is_landed_by_several_tasks_and_is_one_batch(spark, events, tmp_path):
    X.land_messages(spark, events, str(tmp_path / "landing"), 1)
    landed = [sum(1 for _ in open(f)) for f in glob.glob(f"{tmp_path}/landing/*.json")]
    assert sum(landed) == 6000 and 1 < len(landed) <= X.DEALT
    found = Q.met3_outcomes(spark, events).first().asDict()
    assert (found["messages"], found["batches_committed"], found["insert_failures"], found["timed_commits"]) == (6600, 2, 1, 2)


def test_files_of_small_row_groups_stay_small(spark, events, monkeypatch):
    groups, footers = [], Q.footers.row_groups

    def seen(*args):
        groups.append(footers(*args))
        return groups[-1]

    monkeypatch.setattr(Q, "ROWS_A_SMALL_FILE", 1000)
    monkeypatch.setattr(Q.footers, "row_groups", seen)
    assert {(r["layout"], r["rows"], r["most_skipped"]) for r in Q.snk4_row_groups(spark, events).collect()} == {
        ("stored", 6600, True), ("unordered", 6600, False)}
    for files in groups:
        assert max(r[0] for r in files.groupBy("file").agg(F.sum("rows")).select("sum(rows)").collect()) <= 1000


def test_a_footer_is_gone_once_its_file_is_read(spark, tmp_path):
    """What a task has read of one file does not stay while it reads the next."""
    def footers_left(batches):
        gc.disable()
        try:
            for _ in Q.footers.ranges_of(["a", "b"])(batches):
                pass
            yield pa.record_batch([pa.array([sum(type(x).__name__ == "FileMetaData" for x in gc.get_objects())])], names=["left"])
        finally:
            gc.enable()

    paths = []
    for number in range(3):
        paths.append(str(tmp_path / f"{number}.parquet"))
        pq.write_table(pa.table({"a": range(100), "b": range(100)}), paths[-1], row_group_size=10)
    batch = pa.record_batch([pa.array([f"file:{p}" for p in paths])], names=["path"])
    gc.collect()
    assert [b.column("left")[0].as_py() for b in footers_left([batch])] == [0]
    found = Q.footers.row_groups(spark, str(tmp_path), ["a"])
    assert found.count() == 30 and {(r["lows"]["a"], r["highs"]["a"]) for r in found.filter("row_group = 9").collect()} == {("90", "99")}


def test_a_message_is_written_as_json_once(spark, events):
    """Not once more for each place that takes the whole body or a part of it."""
    written = X.event_messages(spark, events)._jdf.queryExecution().optimizedPlan().toString()
    assert written.count("StructsToJsonEvaluator") == 1

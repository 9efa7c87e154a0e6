from helpers import messages, plan, raw, record, rows
from pyspark.sql import functions as F

from filetide.operators import dedup as D
from filetide.operators.normalize import normalize_records
from filetide.plans import usage as U
from filetide.schema import EVENT_KEY


def test_redelivery_collapses(spark):
    twice = raw(spark, [record(), record(), record("/store/run17/tracks.dat", 200)])
    assert D.dedup_latest(twice).count() == 2
    assert rows(D.duplicate_report(twice).select("copies")) == [(2,)]


def test_latest_copy_wins_before_filters(spark):
    copies = raw(spark, [record()]).unionByName(raw(spark, [record(vo="new")], "2026-03-22 13:00:01"))
    assert rows(D.dedup_latest(copies).select("vo")) == [("new",)]
    assert U.raw_spot_check(copies, "astro", "2026-03-22 12:30:00").count() == 0
    assert U.raw_spot_check(copies, "new", "2026-03-22 12:30:00").count() == 1


def test_equal_versions_pick_the_same_copy_in_any_order(spark):
    a, b = raw(spark, [record(activity="x")]), raw(spark, [record(activity="y")])
    one, two = (D.dedup_latest(df).first().activity for df in (a.unionByName(b), b.unionByName(a)))
    assert one == two


def test_receive_time_keeps_copies_apart(spark):
    bare = {"serverID": "s", "filename": "/a"}
    first, second = (normalize_records(messages(spark, [bare], t)) for t in
                     ("2026-03-22 13:00:00", "2026-03-22 13:00:01"))
    both = first.unionByName(second).withColumn("ingest_time", F.col("event_time"))
    assert D.dedup_latest(both).count() == 2


def test_unparseable_bodies_of_one_instant_share_a_key(spark):
    bad = raw(spark, ["{", "}", "other"])
    assert D.dedup_latest(bad).count() == 1


def test_hot_keys_shrink_before_the_shuffle(spark):
    keys = spark.range(0, 30000, numPartitions=4).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    latest = D.dedup_latest(keys, keys=["k"], version="v", tiebreak=[])
    assert latest.count() == 20001
    assert latest.filter("k = 0").first().v == 29997
    text = plan(latest).split("\n\n")[0]
    assert text.count("WindowGroupLimit") >= 2 and text.rindex("WindowGroupLimit") > text.rindex("Exchange")


def test_excess_by_source(spark):
    df = raw(spark, [record(), record(), record("/b")]).unionByName(
        raw(spark, [record()], "2026-03-22 14:00:00", source="other"))
    assert rows(D.excess_by_source(df)) == [("main", 3, 1, 2), ("other", 1, 1, 0)]


def test_key_columns():
    assert EVENT_KEY == ["server_hostname", "event_time", "event_id"]

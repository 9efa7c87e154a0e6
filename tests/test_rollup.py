import re

import pytest
from helpers import plan, raw, record, rows
from pyspark.sql import functions as F

from filetide.functions import columns as C
from filetide.functions import states as S
from filetide.operators import rollup as R


def _sample(spark):
    return raw(spark, [
        record(f"/d/{i % 7}", read=i, write=i % 2, vo=f"v{i % 3}", dirname1="/d",
               **{"@timestamp": f"2026-03-{20 + i % 3}T{i % 24:02d}:10:00Z"}) for i in range(60)])


def test_merge_of_rollups_is_the_rollup_of_the_union(spark):
    df = _sample(spark)
    left, right = df.filter("read % 2 = 0"), df.filter("read % 2 = 1")
    parts = R.rollup(left).unionByName(R.rollup(right))
    assert rows(R.totals(parts, R.HOURLY.keys)) == rows(R.finalize(R.rollup(df)))


@pytest.mark.parametrize("salts", [1, 3])
def test_salting_changes_no_number(spark, salts):
    df = _sample(spark).repartition(5)
    salted = R.rollup(df, R.DAILY, salts=salts)
    assert rows(R.finalize(salted, R.DAILY)) == rows(R.finalize(R.rollup(df, R.DAILY, salts=1), R.DAILY))
    assert rows(R.totals(salted, ["vo"], R.DAILY, salts=salts)) == rows(R.totals(salted, ["vo"], R.DAILY))


def test_daily_from_hourly_equals_daily_from_raw(spark):
    df = _sample(spark)
    assert rows(R.finalize(R.coarsen(R.rollup(df), R.HOURLY, R.DAILY), R.DAILY)) == rows(
        R.finalize(R.rollup(df, R.DAILY), R.DAILY))


def test_operation_and_empty_filename(spark):
    df = raw(spark, [record("", write=0), record("/x", write=1), record("", write=0, read=5)])
    out = R.totals(R.rollup(df), ["operation"])
    assert rows(out) == [("read", 2, 105, 0, 1), ("write", 1, 100, 1, 1)]


def test_redeliveries_count_twice_only_as_inserted(spark):
    from filetide.operators.dedup import dedup_latest

    df = raw(spark, [record(), record()])
    measures = ["events", "bytes_read", "unique_files"]
    assert rows(R.totals(R.rollup(df), [], measures=measures)) == [(2, 200, 1)]
    assert rows(R.totals(R.rollup(dedup_latest(df)), [], measures=measures)) == [(1, 100, 1)]


def test_distinct_states_are_exact_while_small(spark):
    df = spark.range(40000).selectExpr("cast(id % 20011 as string) AS f", "id % 9 AS g")
    states = df.groupBy("g").agg(S.uniq_state("f").alias("s"))
    assert states.agg(S.final_uniq(S.uniq_merge("s"))).first()[0] == 20011


def test_sums_pass_64_bits_in_states_and_refuse_to_wrap(spark):
    big = raw(spark, [record(f"/{i}", read=2**63 - 1) for i in range(2)])
    states = R.rollup(big)
    assert states.first().bytes_read_state == 2**64 - 2
    with pytest.raises(Exception, match="OVERFLOW|out of range|NUMERIC"):
        R.finalize(states).collect()


def test_own_rollup(spark):
    spec = R.RollupSpec("weekly", "week", ("site",), {"stored": "filesize"}, {"users": "user"})
    df = raw(spark, [record(f"/{i}", site="A", user=f"u{i % 2}") for i in range(4)])
    out = R.finalize(R.rollup(df, spec), spec).first()
    assert (str(out.week), out.site, out.events, out.stored, out.users) == ("2026-03-16", "A", 4, 29360128, 2)


def test_exact_distincts_of_many_names(spark):
    """Beyond what a sketch tells exactly, with one group that has most of them and names that recur."""
    rows = spark.range(700_000, numPartitions=8).select(
        F.timestamp_seconds(F.lit(1_774_180_800) + F.col("id") % 7200).alias("event_time"), F.lit("h").alias("server_hostname"),
        F.when(F.col("id") % 50 == 0, "small").otherwise("large").alias("vo"), F.lit("s").alias("source_exchange"),
        F.lit("d").alias("dirname1"), F.lit("e").alias("dirname2"), (F.col("id") % 300_000).cast("string").alias("filename"),
        F.lit(1).cast("bigint").alias("read"), F.lit(0).cast("bigint").alias("write"))
    states, names = R.rollup(rows), R.rollup(rows, R.names_of(R.HOURLY))
    assert R.exact_distinct(names, []).first()["unique_files"] == 300_000
    found = {r["vo"]: (r["events"], r["unique_files"]) for r in R.exact_totals(states, names, ["vo"]).collect()}
    assert found == {"small": (14_000, 6_000), "large": (686_000, 294_000)}


@pytest.mark.parametrize("name, spec", [("agg1_hourly_rollup", R.HOURLY), ("agg2_daily_rollup", R.DAILY)])
def test_latest_copies_and_their_groups_need_one_shuffle(spark, monkeypatch, name, spec):
    """Copies with another vo, ids that are no 32 digits, rows without a server, an id or a time."""
    from filetide.catalog import queries as Q
    from filetide.operators.dedup import dedup_latest

    first = _sample(spark)
    later = first.filter("read % 4 = 0").withColumn("vo", F.lit("revised")).withColumn(
        "ingest_time", F.col("ingest_time") + F.expr("INTERVAL 1 MINUTE"))
    odd = first.filter("read < 20").withColumns({
        "event_id": F.when(F.col("read") % 3 == 0, F.upper("event_id")).when(F.col("read") % 3 == 1, F.lit("no id")),
        "server_hostname": F.when(F.col("read") % 2 == 0, F.col("server_hostname")),
        "event_time": F.when(F.col("read") % 5 > 0, F.col("event_time"))})
    df = first.union(later).union(odd).localCheckpoint()
    monkeypatch.setattr(Q.X, "access_records", lambda *_: df)
    monkeypatch.setattr(Q.X, "table", lambda *_: df)
    got = getattr(Q, name)(spark, "")
    assert rows(got.withColumn(spec.time, F.col(spec.time).cast("timestamp"))) == rows(R.finalize(
        R.rollup(dedup_latest(df), spec), spec).withColumn(spec.time, F.col(spec.time).cast("timestamp")))
    assert len(set(re.findall(r"\(\d+\) Exchange", plan(got)))) == 1


def test_short_ids_are_equal_for_equal_ids_only(spark):
    ids = ["0123456789abcdef" * 2, "0123456789ABCDEF" * 2, "0123456789abcdef", "", None, "x" * 32, "ä", "\0"]
    short = [r[0] for r in spark.createDataFrame([(i,) for i in ids], "id string").select(C.short_id("id")).collect()]
    assert len(set(short)) == len(ids) and short[0] == bytes.fromhex(ids[0]) and short[4] is None

"""Removal of every byte covered by a string of ``LENGTH`` bytes that also starts anywhere else.

Ranks of prefixes are doubled from ``SEED`` bytes to ``LENGTH``, as in prefix doubling, but only where
a repeat is still possible. The first round needs one position in each window of ``LENGTH`` bytes: the
least of its SEED-byte ranks, leftmost of equals, which equal windows have at the same place. All
windows that share such an anchor form one segment. Spark groups the anchors by rank; a segment whose
anchor is unique has no repeated window and goes no further. The next round ranks whole segments, which
are past ``LENGTH`` already: equal ones are repeated throughout. Only where an anchor has segments that
differ does the last round rank their single windows, from pairs of half-window ranks.

Ranks are 64-bit hashes of the bytes; two windows count as equal when their anchors' ranks and their
own agree. Texts are UTF-8 bytes, null is empty, matches never cross documents, and strings are judged
on the input. Rows that repeat a doc_id, or have none, are documents of their own, told apart by 64 bits
of a hash of their texts; equal rows lose the same bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filetide.llm.near import groups
from filetide.llm.words import Prefixes, mix, ranges, raw_bytes, slices
from filetide.llm.work import keep

LENGTH = 200
SEED = 64
SLICE = 2 << 20
CLASS = 4096  # segments of one anchor that a task takes; the windows of larger ones are ranked one by one
# A place is one number: 31 bits of the first window above 8 of the count of the others.
PLACE = "doc_id long, version long, place long"


def versions(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn(
        "version", F.xxhash64("text"))


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` consecutive numbers."""
    done = 1
    while done * 2 <= width:
        x = np.minimum(x[:-done], x[done:])
        done *= 2
    return np.minimum(x[:len(x) - (width - done)], x[width - done:]) if done < width else x


def segments(raw: np.ndarray, bounds: np.ndarray, length: int, seed: int):
    """Of all texts in ``raw``: each segment's text, first and last window, anchor's and own rank."""
    nothing = [np.zeros(0, np.int64)] * 3 + [np.zeros(0, np.uint64)] * 2
    if len(raw) < length:
        return nothing
    sums = Prefixes(raw)
    n = len(raw) - seed + 1
    ranks = mix((sums.sums[seed:] - sums.sums[:n]) * Prefixes.inverses[:n])
    low = np.uint64((1 << 24) - 1)
    if len(raw) > int(low):
        low = np.uint64((1 << 31) - 1)
    least = sliding_least((ranks & ~low) | np.arange(n, dtype=np.uint64), length - seed + 1)
    anchor = (least & low).astype(np.int64)
    windows = np.maximum(np.diff(bounds) - length + 1, 0)
    owner = np.repeat(np.arange(len(windows)), windows)
    if not len(owner):
        return nothing
    at = ranges(bounds[:-1], windows)
    chosen = anchor[at]
    first = np.flatnonzero((np.diff(chosen, prepend=-1) != 0) | (np.diff(owner, prepend=-1) != 0))
    last = np.append(first[1:], len(at)) - 1
    return owner[first], at[first], at[last], ranks[chosen[first]], sums.hashes(at[first], at[last] + length)


def anchors(docs: DataFrame, length: int, seed: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for part in slices(batch, most=SLICE):
                raw, bounds = raw_bytes(part.column("text"))
                owner, first, last, rank, own = segments(raw, bounds, length, seed)
                ids = part.column("doc_id").take(pa.array(owner))
                version = part.column("version").take(pa.array(owner))
                place = ((first - bounds[owner]) << 8) | (last - first)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rank.view(np.int64)), pa.array(own.view(np.int64)), ids, version, pa.array(place)],
                    ["anchor", "segment", "doc_id", "version", "place"])

    return docs.mapInArrow(run, f"anchor long, segment long, {PLACE}")


def contexts(chosen: DataFrame, docs: DataFrame, length: int) -> DataFrame:
    """The bytes of the chosen segments."""
    by_document = chosen.groupBy("doc_id", "version").agg(
        F.collect_list(F.struct("anchor", "single", "size", "place")).alias("chosen"))
    rows = docs.join(by_document, by_document.doc_id.eqNullSafe(docs.doc_id) & (
        by_document.version == docs.version)).select(docs.doc_id, docs.version, "text", "chosen").dropDuplicates(
            ["doc_id", "version"])

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                text = batch.column("text")[i].as_py().encode("utf-8", "surrogatepass")
                found = batch.column("chosen")[i].values
                place = found.field("place").to_numpy()
                first, more = (place >> 8) & ((1 << 31) - 1), place & 255
                yield pa.RecordBatch.from_arrays(
                    [found.field("anchor"), found.field("single"), found.field("size"),
                     pa.array([batch.column("doc_id")[i].as_py()] * len(place), pa.int64()),
                     pa.array([batch.column("version")[i].as_py()] * len(place), pa.int64()), found.field("place"),
                     pa.array([text[a:a + m + length] for a, m in zip(first.tolist(), more.tolist())], pa.binary())],
                    ["anchor", "single", "size", "doc_id", "version", "place", "bytes"])

    return rows.mapInArrow(run, f"anchor long, single boolean, size long, {PLACE}, bytes binary")


def window_ranks(strings: pa.Array, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranks of all windows of each string, from the pairs of their half-window ranks; the string each
    belongs to and its number there."""
    raw, bounds = raw_bytes(strings)
    counts = np.diff(bounds) - length + 1
    sums, half = Prefixes(raw), length // 2
    at = ranges(bounds[:-1], counts)
    left, right = sums.hashes(at, at + half), sums.hashes(at + half, at + length)
    return mix(left * np.uint64(3) + right), np.repeat(np.arange(len(counts)), counts), ranges(
        np.zeros(len(counts), np.int64), counts)


def runs(place: np.ndarray, number: np.ndarray, row: np.ndarray, repeated: np.ndarray):
    """Consecutive repeated windows of a segment as places."""
    row, number = row[repeated], number[repeated]
    if not len(row):
        return row, row
    first = np.flatnonzero((np.diff(number, prepend=-9) != 1) | (np.diff(row, prepend=-9) != 0))
    last = np.append(first[1:], len(row)) - 1
    start = ((place[row[first]] >> 8) + number[first]) << 8
    return row[first], start | (number[last] - number[first])


def partly_repeated(found: DataFrame, length: int) -> DataFrame:
    """doc_id, version and place of runs of repeated windows in single segments; ``found`` as from ``contexts``."""
    parts = max(int(found.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    small = found.filter(F.col("size") <= CLASS).repartition(parts, "anchor").sortWithinPartitions("anchor")

    def in_groups(batches):
        for group in groups(batches, ["anchor"]):
            group = group.combine_chunks()
            ranks, row, number = window_ranks(group.column("bytes").chunk(0), length)
            _, code, count = np.unique(ranks, return_inverse=True, return_counts=True)
            single = group.column("single").to_numpy()
            place = group.column("place").to_numpy()
            row, place = runs(place, number, row, (count[code] > 1) & single[row])
            if len(row):
                yield pa.RecordBatch.from_arrays(
                    [*(group.column(c).chunk(0).take(pa.array(row)) for c in ("doc_id", "version")), pa.array(place)],
                    ["doc_id", "version", "place"])

    def one_by_one(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000)
                ranks, row, number = window_ranks(part.column("bytes"), length)
                place = ((part.column("place").to_numpy()[row] >> 8) + number) << 8
                yield pa.RecordBatch.from_arrays(
                    [part.column("anchor").take(pa.array(row)), pa.array(ranks.view(np.int64)),
                     *(part.column(c).take(pa.array(row)) for c in ("single", "doc_id", "version")),
                     pa.array(place)], ["anchor", "rank", "single", "doc_id", "version", "place"])

    large = found.filter(F.col("size") > CLASS).mapInArrow(
        one_by_one, f"anchor long, rank long, single boolean, {PLACE}")
    often = large.groupBy("anchor", "rank").count().filter("count > 1").select("anchor", "rank")
    return small.mapInArrow(in_groups, PLACE).union(
        large.filter("single").join(often, ["anchor", "rank"]).select("doc_id", "version", "place"))


def repeated_places(docs: DataFrame, length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """doc_id, version and place of all runs of windows (at most 256 in one) that occur elsewhere too; ``docs`` as
    from ``versions``."""
    every = anchors(docs, length, seed)
    common = every.groupBy("anchor").count().filter("count > 1").select("anchor")
    left = keep(every.join(common, "anchor"), "segments")
    own = keep(left.groupBy("anchor", "segment").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "version", "place")).alias("first")).select(
            "anchor", "segment", "n", "first.*"), "ranks")
    classes = own.groupBy("anchor").agg(F.count(F.lit(1)).alias("size"), F.min("n").alias("least")).filter(
        "size > 1 and least = 1")
    chosen = own.join(classes, "anchor").select("anchor", (F.col("n") == 1).alias("single"), "size", "doc_id", "version", "place")
    partly = partly_repeated(keep(contexts(chosen, docs, length), "contexts"), length)
    wholly = left.join(own.filter("n > 1").select("anchor", "segment"), ["anchor", "segment"]).select("doc_id", "version", "place")
    return wholly.union(partly)


def remove_repeats(docs: DataFrame, length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """doc_id, kept (the bytes that stay), n_bytes and spans (start and end of removed runs) of every row
    of ``docs`` (doc_id, text)."""
    whole = versions(docs)
    found = keep(repeated_places(whole, length, seed), "repeats")
    by_document = found.groupBy("doc_id", "version").agg(F.collect_list("place").alias("places"))
    rows = whole.join(by_document, by_document.doc_id.eqNullSafe(whole.doc_id) & (
        by_document.version == whole.version), "left").select(whole.doc_id, "text", "places")

    def run(batches):
        for batch in batches:
            for part in slices(batch, most=4 * SLICE):
                raw, bounds = raw_bytes(part.column("text"))
                kept, spans, sizes = [], [], np.diff(bounds)
                for i, places in enumerate(part.column("places")):
                    text = raw[bounds[i]:bounds[i + 1]]
                    cut = merged(places.values.to_numpy(), length) if places.is_valid else np.zeros((0, 2), np.int64)
                    stays, at = [], 0
                    for a, b in cut.tolist():
                        stays.append(text[at:a])
                        at = b
                    kept.append(b"".join(x.tobytes() for x in [*stays, text[at:]]))
                    spans.append([{"start": a, "end": b} for a, b in cut.tolist()])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").cast(pa.int64()), pa.array(kept, pa.binary()), pa.array(sizes),
                     pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
                    ["doc_id", "kept", "n_bytes", "spans"])

    return rows.mapInArrow(run, "doc_id long, kept binary, n_bytes long, spans array<struct<start:long,end:long>>")


def merged(places: np.ndarray, length: int) -> np.ndarray:
    """Maximal covered runs of bytes, in order."""
    start = (places >> 8) & ((1 << 31) - 1)
    end = start + (places & 255) + length
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(end[order])
    first = np.flatnonzero(np.concatenate([[True], start[1:] > reach[:-1]]))
    return np.column_stack([start[first], reach[np.append(first[1:], len(start)) - 1]])

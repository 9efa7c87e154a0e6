"""How far the sources of a language differ in their words, by sorted pointers to word starts.

A word is a run of ASCII letters and of code points from 128 on, with A-Z in lower case. In each task,
texts are taken ``SHARD_BYTES`` at a time: their bytes stay where Arrow has them, and an array of
pointers to the starts of all words is sorted as by multikey quicksort, eight bytes of each word at a
time: words that agree in a slice are told apart by their next slice alone. Pointers of a shard are in
the order of (lang, source) and text to begin with and sorting is stable, so that each run of equal
words gives, for each source, the number of occurrences and of texts. Spark adds up the shards.

A language keeps the words that at least ``least`` of its documents have. Shares are whole numbers,
parts in ``SCALE`` with 2 added to each count; two shares p and q differ by (p - q)^2 // (p + q). All
arithmetic is exact. Words of a language are dealt out in buckets, and a bucket meets the list of the
language's sources, ``SOURCES`` of them at a time against all, so that no task has more than that.

Null text, lang and source are ''. Rows are documents, also those that repeat a doc_id or have none.
A language without kept words has a difference of 0 between all its sources. Of other columns none is read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from filetide.llm.words import ranges, raw_bytes, slices
from filetide.llm.work import keep

LEAST = 10
TOP = 10
SCALE = 1_000_000_000
SHARD_BYTES = 8 << 20
SLICE = 8
DEEP = 64  # words that agree so far are compared whole
BUCKET_ROWS = 200_000
SOURCES = 256
CELLS = 1 << 20

LETTERS = np.zeros(256, bool)
LETTERS[ord("A"):ord("Z") + 1] = LETTERS[ord("a"):ord("z") + 1] = LETTERS[128:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32
FOUND = "lang string, source string, term string, n long, docs long"
COMPARED = "lang string, source string, part string, item string, value long"


def word_pointers(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word of the texts between ``bounds``, and the number of its text."""
    inside = LETTERS[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[bounds] = True
    starts = np.flatnonzero(inside & ~(np.concatenate([[False], inside[:-1]]) & ~edge[:-1]))
    ends = np.flatnonzero(inside & ~(np.concatenate([inside[1:], [False]]) & ~edge[1:])) + 1
    return starts, ends, np.searchsorted(bounds, starts, side="right") - 1


def sort_pointers(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A stable order of the words by their bytes, and where in it a word differs from the one before."""
    padded = np.concatenate([raw, np.zeros(SLICE, np.uint8)])
    at_any = np.ndarray((len(raw) + 1,), ">u8", padded.data, strides=(1,))

    def key(pointers: np.ndarray, left: np.ndarray) -> np.ndarray:
        taken = at_any[np.minimum(pointers, len(raw))].astype(np.uint64)
        short = (SLICE - np.clip(left, 1, SLICE)).astype(np.uint64) * np.uint64(8)
        return np.where(left > 0, taken >> short << short, np.uint64(0))

    size = ends - starts
    keys = key(starts, size)
    order = np.argsort(keys, kind="stable")
    fresh = np.ones(len(order), bool)
    fresh[1:] = np.diff(keys[order]) != 0
    open_at, depth = np.arange(len(order)), SLICE
    while len(open_at):
        # Of what was open, the runs of more than one word in which some word goes on.
        first = np.flatnonzero(fresh[open_at])
        run = np.cumsum(fresh[open_at]) - 1
        more = np.maximum.reduceat(size[order[open_at]], first) > depth
        many = np.diff(np.append(first, len(open_at))) > 1
        chosen = (more & many)[run]
        open_at, run = open_at[chosen], run[chosen]
        if not len(open_at):
            break
        mine = order[open_at]
        if depth >= DEEP:
            rest = [raw[s:e].tobytes() for s, e in zip((starts[mine] + depth).tolist(), ends[mine].tolist())]
            by = sorted(range(len(mine)), key=lambda i: (run[i], rest[i]))
            order[open_at] = mine[by]
            fresh[open_at[1:]] |= np.array([rest[a] != rest[b] for a, b in zip(by, by[1:])], bool)
            break
        keys = key(starts[mine] + depth, size[mine] - depth)
        by = np.lexsort((keys, run))
        order[open_at], keys = mine[by], keys[by]
        fresh[open_at[1:]] |= keys[1:] != keys[:-1]
        depth += SLICE
    return order, fresh


def counted(batch: pa.RecordBatch) -> pa.RecordBatch:
    """For each word, lang and source of a shard: occurrences and documents."""
    codes, names = [], []
    for name in ("lang", "source"):
        column = pc.fill_null(batch.column(name), "").dictionary_encode()
        codes.append(column.indices.to_numpy().astype(np.int64))
        names.append(column.dictionary)
    group = codes[0] * len(names[1]) + codes[1]
    by = np.argsort(group, kind="stable")
    raw, bounds = raw_bytes(batch.column("text").take(pa.array(by)))
    raw, group = LOWER[raw], group[by]
    starts, ends, text = word_pointers(raw, bounds)
    order, fresh = sort_pointers(raw, starts, ends)
    text = text[order]
    other_text = fresh.copy()
    other_text[1:] |= text[1:] != text[:-1]
    of = group[text]
    segment = fresh.copy()
    segment[1:] |= of[1:] != of[:-1]
    at = np.flatnonzero(segment)
    n = np.diff(np.append(at, len(order)))
    docs = np.add.reduceat(other_text.astype(np.int64), at) if len(at) else n
    shown = order[at]
    sizes = ends[shown] - starts[shown]
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    terms = pa.StringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(raw[ranges(starts[shown], sizes)]))
    take = lambda values, codes: values.take(pa.array(codes))
    return pa.record_batch(
        [take(names[0], of[at] // len(names[1])), take(names[1], of[at] % len(names[1])), terms,
         pa.array(n, pa.int64()), pa.array(docs, pa.int64())], names=["lang", "source", "term", "n", "docs"])


def count_words(docs: DataFrame) -> DataFrame:
    """lang, source, term, n and docs: occurrences and documents of every word in each group."""
    def shards(batches):
        for batch in batches:
            for part in slices(batch, "text", SHARD_BYTES):
                yield counted(part)

    found = docs.select("lang", "source", "text").mapInArrow(shards, FOUND)
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def shares(counts: np.ndarray, total: int, kept: int) -> np.ndarray:
    """1 + floor(SCALE * (count + 2) / (total + 2 * kept)), in Python's numbers where 64 bits are too few."""
    if counts.size and int(counts.max()) + 2 > (2 ** 63 - 1) // SCALE:
        counts = counts.astype(object)
    return (1 + SCALE * (counts + 2) // (total + 2 * kept)).astype(np.int64)


def apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def compare(words: pa.Table, sources: pa.Table, block: int, top: int) -> tuple[list, list]:
    """Of one bucket of a language's words: the sums for each pair of a source of this block and another,
    and the ``top`` words of each such source."""
    names, totals = sources.column("source").to_pylist(), [int(x) for x in sources.column("total").to_pylist()]
    kept, own = int(sources.column("kept")[0].as_py()), range(block * SOURCES, min(len(names), (block + 1) * SOURCES))
    sums = [np.zeros(len(names), np.int64) for _ in own]
    best: list[list[tuple[int, bytes]]] = [[] for _ in own]
    place = {name: i for i, name in enumerate(names)}
    coded = words.column("term").combine_chunks().dictionary_encode()
    terms = coded.dictionary.cast(pa.binary())
    row, count = coded.indices.to_numpy().astype(np.int64), words.column("n").to_numpy()
    column = np.array([place[s] for s in words.column("source").to_pylist()], np.int64)
    by = np.argsort(row, kind="stable")
    row, column, count = row[by], column[by], count[by]
    step = max(1, CELLS // len(names))
    for start in range(0, len(terms), step):
        a, b = np.searchsorted(row, [start, start + step])
        table = np.zeros((min(step, len(terms) - start), len(names)), np.int64)
        table[row[a:b] - start, column[a:b]] = count[a:b]
        q = shares(table.sum(axis=1), sum(totals), kept)
        p = np.stack([shares(table[:, i], totals[i], kept) for i in range(len(names))], axis=1)
        for k, i in enumerate(own):
            sums[k] += apart(p[:, i:i + 1], p).sum(axis=0)
            high = np.flatnonzero((table[:, i] > 0) & (p[:, i] > q))
            value = apart(p[high, i], q[high])
            if len(high) > top:
                least = np.partition(value, len(high) - top)[len(high) - top]
                high, value = high[value >= least], value[value >= least]
            best[k] = sorted([*best[k], *((-int(v), terms[start + h].as_py()) for h, v in zip(high, value))])[:top]
    pairs = [(names[i], names[j], int(sums[k][j])) for k, i in enumerate(own) for j in range(len(names)) if j != i]
    return pairs, [(names[i], term.decode(), -v) for k, i in enumerate(own) for v, term in best[k]]


def divergence(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value and rank of ``docs`` (text, lang, source).

    Part ``pair``: every other source of the language, by how far it is. Part ``term``: the ``top`` words
    that the source has more often than its language, by how much. Larger values first, then items."""
    blank = lambda name: F.coalesce(name, F.lit("")).alias(name)
    groups = docs.select(blank("lang"), blank("source")).distinct()
    in_language = F.sum("docs").over(Window.partitionBy("lang", "term"))
    kept = keep(count_words(docs).withColumn("docs", in_language).filter(F.col("docs") >= least).select(
        "lang", "source", "term", "n"), "terms")
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    sizes = kept.select("lang", "term").distinct().groupBy("lang").agg(F.count(F.lit(1)).alias("kept"))
    none = F.lit(0).cast("bigint")
    groups = keep(groups.join(totals, ["lang", "source"], "left").join(sizes, "lang", "left").select(
        "lang", "source", F.coalesce("total", none).alias("total"), F.coalesce("kept", none).alias("kept")), "groups")
    buckets = 1 + kept.count() // BUCKET_ROWS
    blocks = groups.groupBy("lang").agg(F.ceil(F.count(F.lit(1)) / SOURCES).cast("int").alias("blocks"))
    each = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    left = kept.join(blocks, "lang").select(
        "lang", F.pmod(F.xxhash64("term"), F.lit(buckets)).cast("int").alias("bucket"), each(F.col("blocks")).alias("block"),
        "source", "term", "n")
    right = groups.join(blocks, "lang").withColumn("bucket", each(F.lit(buckets))).withColumn(
        "block", each(F.col("blocks"))).drop("blocks")

    def met(key, words: pa.Table, sources: pa.Table) -> pa.Table:
        sources = sources.sort_by("source")
        lang, _, block = (k.as_py() for k in key)
        pairs, terms = compare(words, sources, block, top)
        rows = [(lang, s, "pair", item, v) for s, item, v in pairs] + [(lang, s, "term", item, v) for s, item, v in terms]
        columns = list(zip(*rows)) or [[]] * 5
        return pa.table({name: pa.array(column, kind) for name, column, kind in zip(
            ("lang", "source", "part", "item", "value"), columns, [pa.string()] * 4 + [pa.int64()])})

    of = ["lang", "bucket", "block"]
    found = left.groupBy(*of).cogroup(right.groupBy(*of)).applyInArrow(met, COMPARED)
    summed = found.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    return summed.withColumn("rank", F.row_number().over(order)).filter(
        (F.col("part") == "pair") | (F.col("rank") <= top))

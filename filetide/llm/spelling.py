"""Spelling variants: words one edit apart, by dynamic programming over the sorted vocabulary.

Words are runs of ASCII letters and of U+00C0 to U+00FF, with A-Z in lower case; one code point of some
is deleted, as a hash of document and word decides (``damaged``). A word is kept as one byte for each
code point.

Two words of m and of m or m + 1 code points that are one edit apart share their first half (m + 1) // 2
or, reversed, the rest. So every word goes to the lists of its first half and of its reversed second half,
as the shorter and as the longer one of a pair. A list is sorted. Words that share a prefix are a range of
it, whose bounds adjacent common prefixes (LCPs) give; the band of three cells of the edit matrix that one
edit can reach is worked out once for a range and each query, from the row of the range around it, for all
queries of a list at once. A range whose row exceeds one edit is skipped with everything in it.

Lists of more than ``LIST_ROWS`` words (``LIST_BYTES`` bytes) are cut by hash into parts, and every two
parts meet in a task of their own, so that no list is too long for a task and no pair is lost.

Null texts are empty; a null doc_id is hashed as ''. Rows that repeat a doc_id count like any others.
Words of any length take part. Without words the result is empty.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filetide.llm.words import ranges, raw_bytes, slices
from filetide.llm.work import keep

LEAST_LETTERS = 7
LEAST_COUNT = 2
RATIO = 10
DAMAGE = 31  # of so many words and documents one loses a code point
LIST_ROWS = 20_000
LIST_BYTES = 4 << 20
TASK_ROWS = 40_000
PAIRS = 1 << 21
NEAR = "word binary, n_near long, best_n long, best binary"

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32
ASCII = np.zeros(256, bool)
ASCII[ord("A"):ord("Z") + 1] = ASCII[ord("a"):ord("z") + 1] = True
LATIN = 0xC3  # the first byte of U+00C0 to U+00FF in UTF-8


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    return table


CRC = _crc_table()
CRC_STEPS = 64


def checksums(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, before: np.ndarray) -> np.ndarray:
    """crc32 of each stretch, continued from ``before``; a byte of all stretches at a time."""
    out = before ^ np.uint32(0xFFFFFFFF)
    size = ends - starts
    active = np.arange(len(starts))
    for step in range(CRC_STEPS):
        active = active[size[active] > step]
        if not len(active):
            break
        state = out[active]
        out[active] = CRC[(state ^ raw[starts[active] + step]) & np.uint32(255)] ^ (state >> np.uint32(8))
    out ^= np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(size > CRC_STEPS).tolist():
        out[i] = zlib.crc32(raw[starts[i]:ends[i]].tobytes(), int(before[i]))
    return out


def damaged(batch: pa.RecordBatch, letters: int = LEAST_LETTERS) -> pa.BinaryArray:
    """The words of a batch of texts with at least ``letters`` code points, a byte for each, after deletion."""
    raw, bounds = raw_bytes(batch.column("text"))
    edge = np.zeros(len(raw) + 1, bool)
    edge[bounds] = True
    follows = np.concatenate([(raw[1:] >> 6) == 2, [False]]) & ~edge[1:]
    lead = (raw == LATIN) & follows
    second = np.concatenate([[False], lead[:-1]])
    inside = ASCII[raw] | lead | second
    starts = np.flatnonzero(inside & ~(np.concatenate([[False], inside[:-1]]) & ~edge[:-1]))
    ends = np.flatnonzero(inside & ~(np.concatenate([inside[1:], [False]]) & ~edge[1:])) + 1
    counted = inside & ~second
    point = np.concatenate([[0], np.cumsum(counted)])
    long = point[ends] - point[starts] >= letters
    starts, ends = starts[long], ends[long]
    lower = LOWER[raw]
    codes = np.where(lead, np.concatenate([raw[1:], np.zeros(1, np.uint8)]) + np.uint8(0x40), lower)[counted]
    first, size = point[starts], point[ends] - point[starts]
    ids = ["" if x is None else str(x) for x in batch.column("doc_id").to_pylist()]
    before = np.array([zlib.crc32(f"{x}:".encode()) for x in ids], np.uint32)
    h = checksums(lower, starts, ends, before[np.searchsorted(bounds, starts, side="right") - 1]).astype(np.int64)
    cut = h % DAMAGE == 0
    at = np.where(cut, h % np.maximum(size, 1), size)
    left = size - cut
    pieces = np.stack([at, left - at], axis=1)
    places = np.stack([first, first + at + cut], axis=1)
    pieces, places = pieces[left >= letters].ravel(), places[left >= letters].ravel()
    left = left[left >= letters]
    offsets = np.concatenate([[0], np.cumsum(left)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(left), [
        None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(codes[ranges(places, pieces)]))])


def vocabulary(docs: DataFrame) -> DataFrame:
    """word (a byte for each code point) and n, of all words that occur."""
    def counts(batches):
        for batch in batches:
            for part in slices(batch, "text", 8 << 20):
                found = pc.value_counts(damaged(part))
                yield pa.record_batch([found.field("values"), found.field("counts")], names=["word", "n"])

    return docs.select("doc_id", "text").mapInArrow(counts, "word binary, n long").groupBy("word").agg(
        F.sum("n").alias("n"))


class Lists:
    """Words of several lists that share one shape: list number, what follows the shared half, length."""

    def __init__(self, group: np.ndarray, rest: np.ndarray, size: np.ndarray):
        columns = [rest[:, i] for i in range(rest.shape[1])]
        # Eight bytes at a time are one key of the sort.
        keys = [sum(c.astype(np.uint64) << np.uint64(56 - 8 * k) for k, c in enumerate(columns[i:i + 8]))
                for i in range(0, len(columns), 8)]
        self.order = np.lexsort([*keys[::-1], group])
        self.group, self.rest, self.size = group[self.order], rest[self.order], size[self.order]
        differ = self.rest[1:] != self.rest[:-1]
        same = np.where(differ.any(axis=1), differ.argmax(axis=1), rest.shape[1])
        self.lcp = np.concatenate([[-1], np.where(self.group[1:] == self.group[:-1], same, -1)])
        self.first = np.flatnonzero(self.lcp < 0)
        self.rows = np.diff(np.append(self.first, len(group)))

    def near(self) -> tuple[np.ndarray, np.ndarray]:
        """All pairs of rows of one list that are one edit apart, the earlier row first."""
        found = []
        ends = np.cumsum(np.repeat(self.rows, self.rows))
        start = 0
        while start < len(ends):
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + PAIRS, side="right")))
            found.append(self._near(np.arange(start, stop)))
            start = stop
        a, b = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 2
        return self.order[a], self.order[b]

    def _near(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        padded = np.zeros((len(self.rest), self.rest.shape[1] + 2), np.uint8)
        padded[:, :-2] = self.rest
        hits = []
        # A node is the first row of a range that shares ``depth`` letters; low, own and high are the cells
        # of its row for one letter less of the query, as many and one more.
        nodes = self.first
        list_of = np.searchsorted(self.first, queries, side="right") - 1
        node, query = list_of, queries
        low, own = np.full(len(query), 2, np.uint8), np.zeros(len(query), np.uint8)
        high = np.ones(len(query), np.uint8)
        for depth in range(self.rest.shape[1] + 1):
            at = nodes[node]
            ended = self.size[at] == depth
            more = self.size[query].astype(np.int64) - depth
            distance = np.where(more == 0, own, np.where(more == 1, high, np.where(more == -1, low, 2)))
            hit = ended & (distance == 1)
            hits.append((at[hit], query[hit]))
            # The ranges within, one letter longer.
            inner = np.flatnonzero((self.lcp <= depth) & (self.size > depth))
            if not len(inner):
                break
            around = np.searchsorted(nodes, inner, side="right") - 1
            count = np.bincount(around, minlength=len(nodes))
            begin = np.cumsum(count) - count
            times = count[node]
            child = ranges(begin[node], times)
            pair = np.repeat(np.arange(len(node)), times)
            # Every pair is met from its later row: what begins at a query or after it is left to others.
            wanted = inner[child] < query[pair]
            child, pair = child[wanted], pair[wanted]
            q, letter = query[pair], padded[inner[child], depth]
            spelled = padded[q]
            differs = lambda i: (spelled[:, i] != letter).view(np.uint8) if i >= 0 else np.ones(len(q), np.uint8)
            new_low = np.minimum(own[pair] + 1, low[pair] + differs(depth - 1))
            new_own = np.minimum(np.minimum(high[pair], new_low) + 1, own[pair] + differs(depth))
            new_high = np.minimum(new_own + 1, high[pair] + differs(depth + 1))
            alive = np.minimum(np.minimum(new_low, new_own), new_high) <= 1
            nodes, node, query = inner, child[alive], q[alive]
            low, own, high = (np.minimum(x[alive], 2) for x in (new_low, new_own, new_high))
            if not len(node):
                break
        return tuple(np.concatenate(x) for x in zip(*hits))


def halves(m: int) -> tuple[int, int]:
    """How many code points pairs of m, or m and m + 1, share at the start or else at the end."""
    return (m + 1) // 2, m - (m + 1) // 2


def near_in(block: pa.RecordBatch, reverse: bool, m: int, group: np.ndarray) -> pa.RecordBatch | None:
    """n_near and the most frequent near word of the words of some lists of one kind."""
    raw, bounds = raw_bytes(block.column("word").cast(pa.binary()))
    first, size = bounds[:-1], np.diff(bounds)
    before, after = halves(m)
    shared = after if reverse else before
    width = m + 1 - shared
    letters = np.concatenate([raw, np.zeros(m + 2, np.uint8)])
    i = np.arange(width)[None, :]
    at = (first + size - 1 - shared)[:, None] - i if reverse else (first + shared)[:, None] + i
    rest = np.where(i < (size - shared)[:, None], letters[at], 0).astype(np.uint8)
    a, b = Lists(group, rest, (size - shared).astype(np.int64)).near()
    keep_it = np.minimum(size[a], size[b]) == m
    if reverse:  # pairs that share their first half have been met in its list
        same = np.ones(len(a), bool)
        for k in range(before):
            same &= letters[first[a] + k] == letters[first[b] + k]
        keep_it &= ~same
    # In a tile of two parts, pairs within a part are left to the part's own tile.
    part = block.column("part").to_numpy()
    both = block.column("both").to_numpy(zero_copy_only=False)
    keep_it &= (part[a] != part[b]) | both[a]
    a, b = a[keep_it], b[keep_it]
    if not len(a):
        return None
    word, other = np.concatenate([a, b]), np.concatenate([b, a])
    n = block.column("n").to_numpy()
    spelled = block.column("word").cast(pa.binary())
    place = np.empty(len(size), np.int64)
    place[pc.sort_indices(spelled).to_numpy()] = np.arange(len(size))
    by = np.lexsort((place[other], -n[other], word))
    word, other = word[by], other[by]
    top = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
    return pa.record_batch([
        spelled.take(pa.array(word[top])), pa.array(np.diff(np.append(top, len(word))), pa.int64()),
        pa.array(n[other[top]], pa.int64()), spelled.take(pa.array(other[top]))], names=["word", "n_near", "best_n", "best"])


def bounds_of_lists(rows: pa.RecordBatch) -> np.ndarray:
    """The rows where another list begins."""
    other = np.zeros(rows.num_rows, bool)
    other[0] = True
    half = rows.column("half").dictionary_encode().indices.to_numpy()
    for column in (rows.column("kind").to_numpy(), half, rows.column("tile").to_numpy()):
        other[1:] |= column[1:] != column[:-1]
    return np.flatnonzero(other)


def scan(rows: pa.RecordBatch, starts: np.ndarray, end: int):
    """The near words within the lists that begin at ``starts``, the last of which ends at ``end``."""
    kind = rows.column("kind").to_numpy()
    group = np.searchsorted(starts, np.arange(end), side="right") - 1
    several = np.flatnonzero(np.bincount(group)[group] > 1)  # a list of one word has no pairs
    kinds = kind[several]
    edges = np.flatnonzero(np.concatenate([[True], kinds[1:] != kinds[:-1]])) if len(kinds) else []
    for a, b in zip(edges, [*edges[1:], len(kinds)]):
        chosen = several[a:b]
        found = near_in(rows.take(pa.array(chosen)), bool(kinds[a] & 1), int(kinds[a] >> 1), group[chosen])
        if found is not None:
            yield found


def scanned(batches):
    """Takes the rows of a task, which come list by list, some whole lists at a time."""
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        waiting.append(batch)
        if sum(w.num_rows for w in waiting) < LIST_ROWS:
            continue
        rows = pa.concat_batches(waiting)
        starts = bounds_of_lists(rows)
        yield from scan(rows, starts[:-1], int(starts[-1]))  # the last list may go on
        waiting = [rows.slice(int(starts[-1]))]
    rows = pa.concat_batches(waiting) if waiting else None
    if rows is not None and rows.num_rows:
        yield from scan(rows, bounds_of_lists(rows), rows.num_rows)


def lists(words: DataFrame) -> DataFrame:
    """kind, half, word, n: every word in each list where a word one edit apart may be."""
    size, half = F.length("word"), F.col("m") - F.floor((F.col("m") + 1) / 2).cast("int")
    classed = words.withColumn("m", F.explode(F.array(size, size - 1))).filter(F.col("m") >= LEAST_LETTERS)
    return classed.withColumn("reverse", F.explode(F.array(F.lit(0), F.lit(1)))).select(
        (2 * F.col("m") + F.col("reverse")).alias("kind"),
        F.when(F.col("reverse") == 0, F.substring("word", F.lit(1), F.col("m") - half)).otherwise(
            F.substring("word", size - half + 1, half)).alias("half"), "word", "n")


def tiled(rows: DataFrame) -> DataFrame:
    """``rows`` with part, tile and both: lists that are too long for a task are cut into parts by hash, and
    a tile holds two parts, or one (``both``). All others are one tile."""
    most = F.least(F.lit(LIST_ROWS), F.greatest(F.lit(2), F.lit(LIST_BYTES) / F.shiftright("kind", 1)))
    sizes = rows.groupBy("kind", "half").agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > most).select(
        "kind", "half", F.ceil(F.col("rows") / most).cast("int").alias("parts"))
    salts = 32  # a long list is spread while it learns its number of parts
    salted = sizes.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    known = rows.withColumn("salt", F.pmod(F.xxhash64("word"), F.lit(salts)).cast("int")).join(
        salted, ["kind", "half", "salt"], "left").drop("salt").withColumn("parts", F.coalesce("parts", F.lit(1)))
    own = known.withColumn("part", F.pmod(F.xxhash64(F.lit(7), "word"), F.col("parts")).cast("int"))
    low, high = F.least("part", "other"), F.greatest("part", "other")
    return own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        "kind", "half", "word", "n", "part", (low.cast("bigint") * F.col("parts") + high).alias("tile"),
        (F.col("part") == F.col("other")).alias("both"))


def near_words(words: DataFrame, rows: int) -> DataFrame:
    """word, n_near, best_n and best of those of ``words`` (word, n) that have words one edit apart."""
    tiles = tiled(lists(words))
    dealt = tiles.repartition(1 + 4 * rows // TASK_ROWS, "kind", "half", "tile").sortWithinPartitions(
        "kind", "half", "tile")
    found = dealt.mapInArrow(scanned, NEAR)
    best = F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("best")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select(
        "word", "n_near", (-F.col("best.less")).alias("best_n"), F.col("best.best").alias("best"))


def roots(links: DataFrame) -> DataFrame:
    """word and root of every word of ``links`` (word, form): a form's form and so on, to the last. Forms
    are ever more frequent, so there are few steps, and each round doubles those taken."""
    reached = keep(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = keep(reached.join(onward, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        reached = moved.select("word", "root")
        if not moved.filter("moved").limit(1).count():
            return reached


def spelled(word: Column | str) -> Column:
    return F.decode(word, "ISO-8859-1")


def variants(docs: DataFrame, least: int = LEAST_COUNT, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near and form_n of the words of ``docs`` (doc_id, text) that occur ``least``
    times: the form is the most frequent word one edit apart, where ``ratio`` times as frequent."""
    words = keep(vocabulary(docs).filter(F.col("n") >= least), "words")
    near = near_words(words, words.count())
    form = lambda c: F.when(F.col("best_n") >= ratio * F.col("n"), F.col(c))
    judged = keep(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"), form("best").alias("form"),
        form("best_n").alias("form_n")), "forms")
    last = roots(judged.filter(F.col("form").isNotNull()).select("word", "form"))
    return judged.join(last, "word", "left").select(
        spelled("word").alias("word"), spelled("form").alias("form"),
        spelled(F.coalesce("root", "word")).alias("root"), "n", "n_near", "form_n")

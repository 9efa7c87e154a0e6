"""Order-sensitive fingerprints (Order MinHash) of whole texts, and texts edited by their successor.

A text is a sequence of words; a word of more than ``LONGEST`` letters counts as several, so that a
text without white space has parts too. Each k-mer of words is numbered by its occurrence. Each of
``SIZE`` hash functions selects the ``PICKED`` least numbered k-mers, keeps them in the order of the
text and hashes the tuple. The share of equal entries is the likeness of two texts: it falls with
edits and with reordering alike.

A text of fewer than k words has one k-mer, the whole; a null or empty one has the empty k-mer, so it
equals other empty texts only.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from filetide.llm.words import mix, split_words, word_hashes
from filetide.llm.work import keep

SIZE = 32
PICKED = 2
K = 2
LONGEST = 32
SEED = 20240
LARGEST = np.uint64(2**64 - 1)


def sequences(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and each text's bounds."""
    words, bounds = split_words(pa.array(texts, pa.string()))
    long = pc.greater(pc.utf8_length(words), LONGEST).to_numpy(zero_copy_only=False)
    if long.any():
        at = np.flatnonzero(long)
        parts = [[w[i:i + LONGEST] for i in range(0, len(w), LONGEST)] for w in words.take(pa.array(at)).to_pylist()]
        pieces, done = [], 0
        for i, cut in zip(at.tolist(), parts):
            pieces += [words.slice(done, i - done), pa.array(cut, pa.string())]
            done = i + 1
        counts = np.ones(len(words), np.int64)
        counts[at] = [len(cut) for cut in parts]
        words = pa.concat_arrays([*pieces, words.slice(done)])
        bounds = np.concatenate([[0], np.cumsum(counts)])[bounds]
    return word_hashes(words), bounds


def fingerprints(texts: list[str], size: int = SIZE, picked: int = PICKED, k: int = K) -> np.ndarray:
    """A row of ``size`` 32-bit entries for each text."""
    hashes, bounds = sequences(texts)
    seeds = mix(np.arange(1, size + 1, dtype=np.uint64) + np.uint64(SEED)) | np.uint64(1)
    out = np.zeros((len(texts), size), np.uint32)
    for i in range(len(texts)):
        out[i] = _one(hashes[bounds[i]:bounds[i + 1]], seeds, picked, k)
    return out


def _one(words: np.ndarray, seeds: np.ndarray, picked: int, k: int) -> np.ndarray:
    n = max(1, len(words) - k + 1)
    grams = np.full(n, len(words) < k, np.uint64)
    for i in range(min(k, len(words))):
        grams = mix(grams * np.uint64(3) + words[i:i + n])
    order = np.argsort(grams, kind="stable")
    ordered = grams[order]
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    number = np.arange(n) - np.repeat(first, np.diff(first, append=n))
    numbered = np.empty(n, np.uint64)
    numbered[order] = mix(ordered + number.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    result = np.zeros(len(seeds), np.uint64)
    block = max(1, 2_000_000 // n)
    for a in range(0, len(seeds), block):
        ranked = numbered[None, :] * seeds[a:a + block, None]
        row = np.arange(len(ranked))
        least = np.empty((len(ranked), min(picked, n)), np.int64)
        for i in range(least.shape[1]):
            least[:, i] = ranked.argmin(axis=1)
            ranked[row, least[:, i]] = LARGEST
        least.sort(axis=1)
        for column in least.T:
            result[a:a + block] = mix(result[a:a + block] * np.uint64(5) + numbered[column])
    return (result >> np.uint64(32)).astype(np.uint32)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a == b).mean(axis=-1)


def written(prints: np.ndarray) -> list[str]:
    return [row.astype(">u4").tobytes().hex() for row in prints]


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by the first as many of the following text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


RESULT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")
BLOCK_CHARS = 4_000_000


def with_successor(docs: DataFrame) -> DataFrame:
    """Each document (doc_id, text) with its fingerprint, and the same for its text edited by the next
    one's, in ascending doc_id (equal ids: by text); the last one's successor is the first.

    Documents are dealt into ranges of doc_id and read in order, so a text moves once. Only the last
    of each range has its successor elsewhere: these few are matched with the first of the next range
    that has rows.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    dealt = docs.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")

    def run(batches):
        task, held, first = TaskContext.get().partitionId(), None, None
        for block in blocks(batches):
            rows = ([held] if held else []) + block
            held = rows[-1]
            if first is None:
                first = rows[0]
            yield from results(rows, task)
        if held:
            yield edges(task, first, held)

    def blocks(batches):
        block, size = [], 0
        for batch in batches:
            for row in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                block.append(row)
                size += len(row[1]) + 1
                if size > BLOCK_CHARS:
                    yield block
                    block, size = [], 0
        if block:
            yield block

    def edges(task, first, last):
        return pa.RecordBatch.from_arrays(
            [pa.nulls(1, f.type) for f in plain] + [pa.array([task], pa.int64())] + [
                pa.array([x], t) for x, t in ((first[1], pa.string()), (last[0], pa.int64()), (last[1], pa.string()),
                                              (True, pa.bool_()))],
            [f.name for f in plain] + ["task", "first_text", "last_id", "last_text", "edge"])

    def results(rows, task):
        if len(rows) > 1:
            columns = result_columns(rows[:-1], rows[1:])
            n = len(rows) - 1
            yield pa.RecordBatch.from_arrays(
                columns + [pa.array(np.full(n, task)), pa.nulls(n, pa.string()), pa.nulls(n, pa.int64()),
                           pa.nulls(n, pa.string()), pa.array(np.zeros(n, bool))],
                [f.name for f in plain] + ["task", "first_text", "last_id", "last_text", "edge"])

    plain = [pa.field("doc_id", pa.int64()), pa.field("n_chars", pa.int64()), pa.field("edited_sha256", pa.string()),
             pa.field("fingerprint", pa.string()), pa.field("edited_fingerprint", pa.string()),
             pa.field("near_edited", pa.float64()), pa.field("near_next", pa.float64())]
    done = keep(dealt.mapInArrow(run, f"{RESULT}, task long, first_text string, last_id long, last_text string, edge boolean"),
                "successors")
    ends = done.filter("edge")
    in_order = Window.orderBy("task")  # one row for each range
    around = Window.partitionBy()
    ends = ends.withColumn("__next", F.coalesce(
        F.lead("first_text").over(in_order), F.min_by("first_text", "task").over(around)))

    def join_ends(batches):
        for batch in batches:
            rows = list(zip(batch.column("last_id").to_pylist(), batch.column("last_text").to_pylist()))
            following = [(None, t) for t in batch.column("__next").to_pylist()]
            yield pa.RecordBatch.from_arrays(result_columns(rows, following), [f.name for f in plain])

    last = ends.select("last_id", "last_text", "__next").mapInArrow(join_ends, RESULT)
    return done.filter("not edge").select(*last.columns).unionByName(last)


def result_columns(rows, following) -> list[pa.Array]:
    texts, after = [r[1] for r in rows], [r[1] for r in following]
    changed = [edited(a, b) for a, b in zip(texts, after)]
    own, new = fingerprints(texts + after[-1:]), fingerprints(changed)
    following_prints = own[1:] if texts[1:] == after[:-1] else fingerprints(after)
    own = own[:len(texts)]
    return [
        pa.array([r[0] for r in rows], pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
        pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in changed]),
        pa.array(written(own)), pa.array(written(new)),
        pa.array(likeness(own, new)), pa.array(likeness(own, following_prints))]

"""Packing of documents into training sequences by reciprocal classes of the capacity.

A length belongs to class k when k of it, and no more, fit a sequence: k = capacity // length. Long
documents are cut into whole sequences, and the rest into the largest reciprocal parts of the
capacity (1/2, 1/3, 1/4 ...) until less than ``least`` tokens are left, which stay one piece. Every
task then fills bins of its own with exactly k pieces of class k, without knowledge of the others.
What a task cannot fill, fewer than k pieces of each class, goes on to tasks that serve ``FAN`` of
them, and so on; the last remainder, bounded by the classes alone, is packed best-fit.

Documents with null text are empty; each document has its end token, so none is lost.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filetide.llm.tokens import WordTokens
from filetide.llm.words import slices
from filetide.llm.work import keep

CAPACITY = 4096
LEAST = 128
FAN = 64
PIECE = "doc_id long, start long, length long, doc_tokens long"
PLACE = "sequence_id long, offset long, task long"


def cuts(tokens: int, capacity: int = CAPACITY, least: int = LEAST) -> list[int]:
    """The lengths of a document's pieces, in order."""
    whole, rest = divmod(tokens, capacity)
    parts = [capacity] * whole
    while rest >= least:
        part = capacity // -(-capacity // rest)
        parts.append(part)
        rest -= part
    return parts + [rest] * (rest > 0)


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int = 2, capacity: int = CAPACITY,
                 least: int = LEAST, ids: bool = False) -> DataFrame:
    """The pieces of every document with the CRC-32 of their ids (little-endian, 32 bits), and the
    ids themselves if asked for. ``tokenizer`` is the path of a tokenizer file on every machine."""
    def run(batches):
        coder, cut = WordTokens(tokenizer), {}
        for batch in batches:
            for part in slices(batch):
                yield piece_batch(part, coder, cut)

    def piece_batch(part, coder, cut):
        flat, bounds = coder.encode(part.column("text"))
        doc, start, length, whole, crc, blobs = [], [], [], [], [], []
        end = np.array([end_id], "<i4").tobytes()
        raw = memoryview(flat.astype("<i4", copy=False)).cast("B")
        for number, (a, b) in zip(part.column("doc_id").to_pylist(), zip(bounds[:-1].tolist(), bounds[1:].tolist())):
            total, at = b - a + 1, 0
            if total not in cut and len(cut) < 100_000:
                cut[total] = cuts(total, capacity, least)
            for size in cut.get(total) or cuts(total, capacity, least):
                blob = raw[4 * (a + at):4 * min(b, a + at + size)]
                last = at + size == total
                crc.append(zlib.crc32(end, zlib.crc32(blob)) if last else zlib.crc32(blob))
                if ids:
                    blobs.append(bytes(blob) + end if last else bytes(blob))
                doc.append(number)
                start.append(at)
                length.append(size)
                whole.append(total)
                at += size
        columns = [pa.array(x, pa.int64()) for x in (doc, start, length, whole, crc)]
        names = ["doc_id", "start", "length", "doc_tokens", "ids_crc32"]
        if ids:
            columns.append(pa.array(blobs, pa.binary()))
            names.append("ids")
        return pa.RecordBatch.from_arrays(columns, names)

    schema = PIECE + ", ids_crc32 long" + ", ids binary" * ids
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def fill_bins(table: pa.Table, capacity: int, first: int, all_of_them: bool) -> tuple[pa.Table, pa.Table, int]:
    """Bins of exactly k pieces of class k: the placed pieces, the others, and the next bin number.
    ``all_of_them`` also places what is left over."""
    length = table.column("length").to_numpy()
    kind = capacity // length
    order = np.argsort(kind, kind="stable")
    kind, length = kind[order], length[order]
    starts = np.flatnonzero(np.diff(kind, prepend=-1))
    counts = np.diff(starts, append=len(kind))
    k = kind[starts]
    index = np.arange(len(kind)) - np.repeat(starts, counts)
    bins = counts // k
    full = index < np.repeat(bins * k, counts)
    number = (np.repeat(first + np.cumsum(bins) - bins, counts) + index // kind)[full]
    ends = np.cumsum(length[full])
    begins = np.flatnonzero(np.diff(number, prepend=-1))
    before = (ends - length[full])[begins]
    offset = ends - length[full] - np.repeat(before, np.diff(begins, append=len(number)))
    placed = table.take(pa.array(order[full]))
    rest = table.take(pa.array(order[~full]))
    first += int(bins.sum())
    if all_of_them:
        more, offsets, first = best_fit(rest.column("length").to_numpy(), capacity, first)
        placed = pa.concat_tables([placed, rest])
        number, offset, rest = np.concatenate([number, more]), np.concatenate([offset, offsets]), rest.slice(0, 0)
    placed = placed.append_column("sequence_id", pa.array(number, pa.int64())).append_column(
        "offset", pa.array(offset, pa.int64()))
    return placed, rest, first


def best_fit(lengths: np.ndarray, capacity: int, first: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Longest first, each into the fullest bin that still has room."""
    number, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    by_room: dict[int, list[int]] = {}
    room = np.zeros(capacity + 1, np.int64)  # how many bins have exactly so much room
    for i in np.argsort(-lengths, kind="stable"):
        need = int(lengths[i])
        fits = np.flatnonzero(room[need:])
        if len(fits):
            left = need + int(fits[0])
            bin_number = by_room[left].pop()
            room[left] -= 1
        else:
            left, bin_number, first = capacity, first, first + 1
        number[i], offset[i] = bin_number, capacity - left
        by_room.setdefault(left - need, []).append(bin_number)
        room[left - need] += 1
    return number, offset, first


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to pieces (any columns besides ``length``, 1 to ``capacity``).

    Pieces stay in the task that has them. Only leftovers move, a bounded number from each task.
    Each level is written once, since its placed pieces and its leftovers must be of the same run.
    """
    columns = pieces.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    task_of = lambda: TaskContext.get().partitionId()

    def first_level(batches):
        rest, number, task = None, task_of() << 28, task_of()
        for batch in batches:
            table = pa.Table.from_batches([batch])
            placed, rest, number = fill_bins(pa.concat_tables([rest, table]) if rest else table, capacity, number, False)
            yield from labelled(placed, task)
        if rest:
            yield from labelled(rest, task)

    def labelled(table, task):
        for name in ("sequence_id", "offset"):
            if name not in table.column_names:
                table = table.append_column(name, pa.nulls(table.num_rows, pa.int64()))
        return table.append_column("task", pa.array(np.full(table.num_rows, task))).combine_chunks().to_batches()

    def next_level(level, last):
        def run(table: pa.Table) -> pa.Table:
            group = table.column("task")[0].as_py() // FAN
            placed, rest, _ = fill_bins(table.select(columns).combine_chunks(), capacity, (level << 56) + (group << 28), last)
            return pa.Table.from_batches([*labelled(placed, group), *labelled(rest, group)])
        return run

    out = f"{schema}, {PLACE}"
    done = keep(pieces.mapInArrow(first_level, out), "packed")
    open_pieces = done.filter(F.col("sequence_id").isNull())
    parts, level = [done.filter(F.col("sequence_id").isNotNull())], 0
    tasks = done.agg(F.max("task")).first()[0]
    while tasks is not None:
        level, last = level + 1, tasks < FAN
        found = open_pieces.groupBy(F.expr(f"task div {FAN}")).applyInArrow(next_level(level, last), out)
        if last:
            parts.append(found)
            break
        found = keep(found, "packed")
        open_pieces = found.filter(F.col("sequence_id").isNull())
        parts.append(found.filter(F.col("sequence_id").isNotNull()))
        tasks //= FAN
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result.drop("task")


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 2, capacity: int = CAPACITY,
                   least: int = LEAST, ids: bool = False) -> DataFrame:
    """Documents (doc_id, text) as placed pieces: doc_id, start, length, doc_tokens, ids_crc32, the ids
    if asked for, sequence_id and offset. Offsets in a sequence are gapless from 0."""
    return pack(token_pieces(docs, tokenizer, end_id, capacity, least, ids), capacity)

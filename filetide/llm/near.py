"""Near-duplicate documents by HyperMinHash.

A document's set holds the 64-bit hashes of its distinct word shingles. Each hash falls into one of
``REGISTERS`` buckets; a register keeps the number of leading zeros of the bucket's least remainder
and its next ``MANTISSA`` bits, 16 bits in all. An empty bucket borrows from another, in an order that
is fixed for all documents, so that small sets agree in their registers as often as large ones do.
Runs of ``ROWS`` registers are bands; documents that agree in a band are candidates. Their similarity
is estimated from the registers, less the agreements expected by accident, and candidates near or
above the threshold are verified on full sets.

Documents with equal sets are one class, and only classes are compared. A band's classes are first
compared with its earliest one, and then, exactly, all those that are still in different components
with each other; pairs within a component are never made. At the threshold a pair shares no band with
probability 3e-6, and its estimate falls below the margin with 3e-7.

A text of fewer words than a shingle is one shingle. Null texts and texts without words have no
shingles and are linked with nothing. Rows with a null doc_id take no part in links: their component
is null and they are kept. Rows that repeat a doc_id are rows of their own, each by its text.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filetide.llm.components import components
from filetide.llm.words import mix, slices, split_words, word_hashes
from filetide.llm.work import keep

SHINGLE = 5
PERCENT = 80
ROWS = 5
BANDS = 32
REGISTERS = ROWS * BANDS
MANTISSA = 10
SIGMAS = 5.0
COLLISIONS = 0.169919487159739093975  # agreements by accident, of two like sets, for each 2 ** MANTISSA registers


def shingles(texts: pa.Array, size: int) -> list[np.ndarray]:
    """The distinct shingles of every text, as sorted 64-bit hashes."""
    words, bounds = split_words(pc.ascii_lower(texts))
    hashes = word_hashes(words)
    rolled = np.zeros(max(len(hashes) - size + 1, 0), np.uint64)
    for i in range(size):
        rolled = mix(rolled * np.uint64(3) + hashes[i:i + len(rolled)])
    sets = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a >= size:
            sets.append(np.unique(rolled[a:b - size + 1]))
        elif b > a:
            whole = np.uint64([b - a])
            for i in range(a, b):
                whole = mix(whole * np.uint64(5) + hashes[i])
            sets.append(whole)
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


EDGES = np.array([-(-(i << 64) // REGISTERS) for i in range(REGISTERS)], dtype=object).astype(np.uint64)
WIDTH = float(2 ** 64) / REGISTERS
_rng = np.random.default_rng(5)
LENDERS = np.array([_rng.permutation(REGISTERS) for _ in range(REGISTERS)])


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """A row of 16-bit registers for each non-empty set: leading zeros above, mantissa below."""
    out = np.zeros((len(sets), REGISTERS), np.uint16)
    for i, s in enumerate(sets):
        if not len(s):
            continue
        first = np.searchsorted(s, EDGES)
        has = np.diff(first, append=len(s)) > 0
        rest = (s[np.minimum(first, len(s) - 1)] - EDGES).astype(np.float64) / WIDTH
        fraction, exponent = np.frexp(np.maximum(rest, 2.0 ** -62))
        values = (-exponent).clip(0, 62) * (1 << MANTISSA) + ((fraction * 2 - 1) * (1 << MANTISSA)).astype(np.int64)
        if not has.all():
            empty = np.flatnonzero(~has)
            lender = LENDERS[empty]
            values[empty] = values[lender[np.arange(len(empty)), has[lender].argmax(axis=1)]]
        out[i] = values
    return out


def sketches(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, n_shingles, the set's digest (null if empty), its registers, and version if docs have it."""
    extra = [c for c in docs.columns if c == "version"]

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                sets = shingles(part.column("text"), size)
                sketch = registers(sets)
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id").cast(pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([digest(s) for s in sets], pa.binary()),
                    pa.array([row.tobytes() if len(s) else None for row, s in zip(sketch, sets)], pa.binary()),
                    *[part.column(c) for c in extra],
                ], ["doc_id", "n_shingles", "node", "registers", *extra])

    return docs.select("doc_id", "text", *extra).mapInArrow(
        run, "doc_id long, n_shingles long, node binary, registers binary" + ", version long" * len(extra))


def digest(s: np.ndarray) -> bytes | None:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None


def bands(classes: DataFrame) -> DataFrame:
    """key and id: a row for each class and band. Ids are short, since these rows are many; classes that
    share one by accident only become candidates together."""
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                rows = np.frombuffer(b"".join(part.column("registers").to_pylist()), np.uint16).reshape(-1, BANDS, ROWS)
                keys = np.tile(mix(np.arange(1, BANDS + 1, dtype=np.uint64)), (len(rows), 1))
                for i in range(ROWS):
                    keys = mix(keys * np.uint64(3) + rows[:, :, i])
                take = np.repeat(np.arange(len(rows)), BANDS)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.ravel().view(np.int64)), part.column("id").take(pa.array(take))], ["key", "id"])

    return classes.select(F.xxhash64("node").alias("id"), "registers").mapInArrow(run, "key long, id long")


def estimates(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Jaccard similarity from rows of registers, corrected for accidental agreement."""
    ratio = np.maximum(size_a, size_b) / np.minimum(size_a, size_b)
    chance = COLLISIONS / (1 << MANTISSA) * 4 * ratio / (1 + ratio) ** 2
    return np.maximum((a == b).mean(axis=1) - chance, 0) / (1 - chance)


def likely(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose estimate does not rule the threshold out."""
    own = lambda side: classes.select(F.col("node").alias(side), F.col("registers").alias(f"registers_{side}"),
                                      F.col("n_shingles").alias(f"n_{side}"))

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 8192):
                part = batch.slice(at, 8192)
                rows = [np.frombuffer(b"".join(part.column(f"registers_{x}").to_pylist()), np.uint16).reshape(
                    -1, REGISTERS) for x in "ab"]
                sizes = [part.column(f"n_{x}").to_numpy() for x in "ab"]
                least = np.minimum(*sizes)
                possible = 100 * least >= percent * np.maximum(*sizes)
                s = percent / 100
                margin = SIGMAS * np.sqrt(s * (1 - s) / np.minimum(least, REGISTERS))
                near = possible & (estimates(*rows, *sizes) >= s - margin)
                yield pa.RecordBatch.from_arrays(
                    [part.column(x).filter(pa.array(near)) for x in "ab"], ["a", "b"])

    return pairs.join(own("a"), "a").join(own("b"), "b").mapInArrow(run, "a binary, b binary")


def full_sets(nodes: DataFrame, classes: DataFrame, docs: DataFrame, size: int) -> DataFrame:
    """node, its registers and its full set; texts move once, for all later comparisons."""
    wanted = nodes.select("node").distinct().join(classes.withColumnRenamed("first_id", "doc_id"), "node")
    texts = docs.select("doc_id", "text").join(wanted, "doc_id")

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                sets = shingles(part.column("text"), size)
                right = pa.array([digest(s) == n for s, n in zip(sets, part.column("node").to_pylist())], pa.bool_())
                found = pa.array([s.tobytes() for s in sets], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [x.filter(right) for x in (part.column("node"), part.column("registers"), found)],
                    ["node", "registers", "hashes"])

    return keep(texts.mapInArrow(run, "node binary, registers binary, hashes binary").dropDuplicates(["node"]), "sets")


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    own = lambda side: sets.select(F.col("node").alias(side), F.col("hashes").alias(f"set_{side}"))

    def compare(batches):
        for batch in batches:
            near = [similar(*(np.frombuffer(x.as_buffer(), np.uint64) for x in two), percent)
                    for two in zip(batch.column("set_a"), batch.column("set_b"))]
            yield pa.RecordBatch.from_arrays([batch.column(x).filter(pa.array(near, pa.bool_())) for x in "ab"], ["a", "b"])

    return pairs.join(own("a"), "a").join(own("b"), "b").mapInArrow(compare, "a binary, b binary")


OUTSIDERS = 256
MEMBERS = 2048


def across(bands_open: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between different components of one band: ``bands_open`` has key, node, component
    and pivot_component. Those outside the pivot's component meet all members, block by block; a task
    holds one block of each, whatever the size of the band, and only links leave it."""
    counted = bands_open.groupBy("key").agg(
        F.count_if(F.col("component") != F.col("pivot_component")).alias("outside"), F.count(F.lit(1)).alias("all"))
    blocks = counted.select("key", F.ceil(F.col("outside") / OUTSIDERS).alias("i_blocks"),
                            F.ceil(F.col("all") / MEMBERS).alias("j_blocks"))
    rows = bands_open.join(blocks, "key").withColumn("h", F.xxhash64("node"))
    i, j = F.pmod("h", "i_blocks"), F.pmod("h", "j_blocks")
    every = lambda n: F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1)
    role = lambda is_member, here, i, j: here.select(
        "key", i.alias("i"), j.alias("j"), F.lit(is_member).alias("member"), "node", "component")
    dealt = role(True, rows, F.explode(every("i_blocks")), j).unionByName(
        role(False, rows.filter(F.col("component") != F.col("pivot_component")), i, F.explode(every("j_blocks"))))
    parts = max(int(bands_open.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    dealt = dealt.join(sets, "node").repartition(parts, "key", "i", "j").sortWithinPartitions("key", "i", "j")

    def run(batches):
        for group in groups(batches, ["key", "i", "j"]):
            found = block_links(group, percent)
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[n] for x in found], pa.binary()) for n in (0, 1)], ["a", "b"])

    return dealt.mapInArrow(run, "a binary, b binary").distinct()


def groups(batches, names: list[str]):
    """Consecutive rows with equal ``names`` as tables."""
    held = []
    for batch in batches:
        keys = np.column_stack([batch.column(n).to_numpy() for n in names])
        cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
        for a, b in zip(cuts, cuts[1:]):
            piece = batch.slice(a, b - a)
            if held and any(held[-1].column(n)[0] != piece.column(n)[0] for n in names):
                yield pa.Table.from_batches(held)
                held = []
            held.append(piece)
    if held:
        yield pa.Table.from_batches(held)


def block_links(group: pa.Table, percent: int) -> list[tuple[bytes, bytes]]:
    member = group.column("member").to_numpy()
    if member.all() or not member.any():
        return []
    nodes, comps = group.column("node").to_pylist(), group.column("component").to_pylist()
    own = np.frombuffer(b"".join(group.column("registers").to_pylist()), np.uint16).reshape(-1, REGISTERS)
    sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in group.column("hashes")]
    sizes = np.array([len(x) for x in sets])
    code = np.unique(np.array(comps, object), return_inverse=True)[1]
    inside = np.flatnonzero(member)
    s, links, reached = percent / 100, [], {}
    for o in np.flatnonzero(~member):
        least = np.minimum(sizes[o], sizes[inside])
        possible = (code[inside] != code[o]) & (100 * least >= percent * np.maximum(sizes[o], sizes[inside]))
        near = inside[possible]
        if not len(near):
            continue
        margin = SIGMAS * np.sqrt(s * (1 - s) / np.minimum(least[possible], REGISTERS))
        value = estimates(own[near], own[o][None, :], sizes[near], sizes[o])
        likely_first = np.argsort(-value, kind="stable")
        for m in near[likely_first][(value >= s - margin)[likely_first]].tolist():
            if code[m] not in reached.setdefault(code[o], set()) and similar(sets[o], sets[m], percent):
                reached[code[o]].add(code[m])
                links.append((nodes[o], nodes[m]))
    return links


def near_duplicates(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, versions: bool = False) -> DataFrame:
    """doc_id, n_shingles, component_id (the least doc_id that links reach) and kept, for every row of
    ``docs`` (doc_id, text). Two documents are linked when 100 * intersection >= percent * union. With
    ``versions`` also version, a hash of the text, and of the texts under the kept doc_id only that with
    the least version is kept."""
    whole = docs.select("doc_id", "text", *[F.xxhash64("text").alias("version")] * versions)
    sketched = keep(sketches(whole, size), "sketches")
    least = F.min(F.struct("doc_id", *["version"] * versions))
    classes = keep(sketched.filter(F.col("node").isNotNull() & F.col("doc_id").isNotNull()).groupBy("node").agg(
        F.min("doc_id").alias("first_id"), F.first("n_shingles").alias("n_shingles"),
        F.first("registers").alias("registers"), *[least.alias("head")] * versions), "classes")
    heads_of = classes.select("node", "first_id", *["head"] * versions)
    classes = classes.drop("head")
    in_bands = bands(classes)
    common = in_bands.groupBy("key").count().filter("count > 1").select("key")
    together = keep(in_bands.join(common, "key"), "together").join(
        classes.select(F.xxhash64("node").alias("id"), "node", "first_id"), "id").select("key", "node", "first_id")
    pivots = together.groupBy("key").agg(F.min(F.struct("first_id", "node")).alias("pivot"))
    shared = keep(together.join(pivots, "key").select("key", "node", F.col("pivot.node").alias("pivot")), "shared")
    sets = full_sets(shared, classes, docs, size)
    first = likely(shared.filter(F.col("node") != F.col("pivot")).select(
        F.col("pivot").alias("a"), F.col("node").alias("b")).distinct(), classes, percent)
    links = keep(verified(first, sets, percent), "confirmed")
    label = components(links)

    # The rest: classes of one band that are still in different components.
    own = lambda name: label.select(F.col("node").alias(name), F.col("component").alias(f"{name}_component"))
    labelled = keep(shared.join(own("node"), "node", "left").join(own("pivot"), "pivot", "left").select(
        "key", "node", F.coalesce("node_component", "node").alias("component"),
        F.coalesce("pivot_component", "pivot").alias("pivot_component")), "labelled")
    mixed = labelled.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter(
        F.col("low") != F.col("high")).select("key")
    more = keep(across(labelled.join(mixed, "key"), sets, percent), "confirmed")
    if not more.isEmpty():
        label = components(links.union(more))
    members = heads_of.join(label, "node", "left").withColumn("component", F.coalesce("component", "node"))
    heads = members.groupBy("component").agg(
        F.min("first_id").alias("component_id"), *[F.min("head").alias("head")] * versions)
    of_node = members.select("node", "component").join(heads, "component").drop("component")
    empty = F.col("node").isNull() | F.col("doc_id").isNull()
    own = ["doc_id", "n_shingles", *["version"] * versions]
    linked = sketched.filter(~empty).select(*own, "node").join(of_node, "node")
    alone = sketched.filter(empty).select(*own, F.col("doc_id").alias("component_id"))
    if not versions:
        every = linked.select(*own, "component_id").union(alone)
        return every.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    return linked.select(*own, "component_id", (F.struct("doc_id", "version") == F.col("head")).alias("kept")).union(
        alone.withColumn("kept", F.lit(True)))

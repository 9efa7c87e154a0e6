"""Mixing of sources to target weights over a tree of budgets.

The levels of the tree (say domain, language, source) are columns of the documents. A budget of
tokens goes down from the root: each node divides its own among its children by weight. A child that
has less than its share gives the shortage to its siblings, by weight again; only what all of them
together cannot take has been passed to their parent's siblings before, since a node's capacity is the
sum of its leaves'. A leaf's capacity is its tokens times ``epochs``.

A leaf reads its documents in epochs, each in a seeded order of its own, and stops in the document
that reaches the budget. Documents with equal hashes are in or out together.

Null texts have no tokens; documents without tokens take nothing from a budget and go with their
place in the order. A null in a level is a node of its own. Equal rows are selected together.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filetide.llm.work import keep

MOST_LEAVES = 100_000  # the tree is held in the driver and broadcast; a larger one is refused


def word_count(text: Column) -> Column:
    words = F.split(F.trim(F.translate(F.coalesce(text, F.lit("")), "\t\n\u000b\f\r", "     ")), " +")
    return F.when(words[0] == "", F.lit(0)).otherwise(F.size(words)).cast("bigint")


@dataclass
class Node:
    capacity: int = 0
    tokens: int = 0
    children: dict = field(default_factory=dict)


def tree(leaves: dict[tuple, int], epochs: int) -> Node:
    root = Node()
    for path, tokens in leaves.items():
        node = root
        node.capacity += tokens * epochs
        for step in path:
            node = node.children.setdefault(step, Node())
            node.capacity += tokens * epochs
        node.tokens = tokens
    return root


def divide(budget: int, shares: dict, capacity: dict) -> dict:
    """``budget`` by ``shares``, none above its capacity, the sum as near to the budget as they allow."""
    given: dict = {}
    still = {k for k in shares if shares[k] > 0}
    left = min(budget, sum(capacity[k] for k in still))
    while still:
        whole = sum(shares[k] for k in still)
        full = {k for k in still if left * shares[k] >= capacity[k] * whole}
        if not full:
            parts = {k: left * shares[k] / whole for k in still}
            given |= {k: int(x) for k, x in parts.items()}
            spare = left - sum(given[k] for k in still)
            for k in sorted(still, key=lambda k: (int(parts[k]) - parts[k], str(k)))[:spare]:
                given[k] += 1
            break
        for k in full:
            given[k] = capacity[k]
            left -= capacity[k]
        still -= full
    return {k: given.get(k, 0) for k in shares}


def budgets(leaves: dict[tuple, int], weight: Callable[[tuple], float], total: int, epochs: int) -> dict[tuple, int]:
    """Tokens for each leaf. ``weight`` gives the weight of a node, by its path, among its siblings."""
    found = {}

    def down(path, node, budget):
        if not node.children:
            found[path] = budget
            return
        shares = {k: weight((*path, k)) for k in node.children}
        parts = divide(budget, shares, {k: n.capacity for k, n in node.children.items()})
        for k, child in node.children.items():
            down((*path, k), child, parts[k])

    root = tree(leaves, epochs)
    if leaves:
        down((), root, min(total, root.capacity))
    return found


def mix(docs: DataFrame, levels: dict[str, Column], weight: Callable[[tuple], float], total: int | None = None,
        share: float = 1.0, epochs: int = 1, seed: int = 1, tokens: Column | None = None) -> DataFrame:
    """``docs`` (doc_id, text, any others) with ``__tokens``, ``__leaf`` (the path as JSON) and ``__epoch``:
    a row for each time a document is read. ``total`` tokens, or that ``share`` of all there are.

    Documents never move: the order is a hash, so the selection is a threshold for each leaf. It is
    found from sums over about sqrt(n) ranges of hashes, and then inside one range.
    """
    count = word_count(F.col("text")) if tokens is None else tokens
    marked = docs.withColumn("__tokens", count).withColumn(
        "__leaf", F.to_json(F.struct(*[c.alias(f"l{i}") for i, c in enumerate(levels.values())]),
                            {"ignoreNullFields": "false"})).withColumn("__text", F.xxhash64("text"))
    small = keep(marked.select("doc_id", "__text", "__tokens", "__leaf"), "mix")
    found = small.groupBy("__leaf").agg(F.sum("__tokens").alias("tokens"), F.count(F.lit(1)).alias("n")).withColumn(
        "path", F.from_json("__leaf", ", ".join(f"l{i} string" for i in range(len(levels))))).limit(
            MOST_LEAVES + 1).collect()
    if len(found) > MOST_LEAVES:
        raise ValueError(f"more than {MOST_LEAVES} leaves: use coarser levels")
    there = {tuple(r["path"]): r for r in found}
    wanted = total if total is not None else int(share * sum(r["tokens"] for r in found))
    plan = budgets({path: r["tokens"] for path, r in there.items()}, weight, wanted, epochs)
    rows = [(there[path]["__leaf"], *(divmod(b, there[path]["tokens"]) if there[path]["tokens"] else (0, 0)))
            for path, b in plan.items()]
    leaves = docs.sparkSession.createDataFrame(rows, "__leaf string, __whole long, __rest long")

    bits = max(1, math.ceil(math.log2(max([r["n"] for r in found], default=1)) / 2))
    # The text takes part, so that rows without a doc_id, or with the same one, are not taken all at once.
    order = F.xxhash64(F.lit(seed), F.col("__whole") + 1, "doc_id", "__text")
    placed = small.join(F.broadcast(leaves), "__leaf").filter("__rest > 0").select(
        "__leaf", "__tokens", "__rest", order.alias("h"), F.shiftright(order, 64 - bits).alias("range"))
    sums = placed.groupBy("__leaf", "__rest", "range").agg(F.sum("__tokens").alias("tokens"))
    before = F.sum("tokens").over(Window.partitionBy("__leaf").orderBy("range")) - F.col("tokens")
    cut = sums.withColumn("before", before).filter(
        (F.col("before") < F.col("__rest")) & (F.col("before") + F.col("tokens") >= F.col("__rest"))).select(
            "__leaf", "range", "before")
    inside = placed.join(F.broadcast(cut), ["__leaf", "range"]).groupBy("__leaf", "__rest", "before", "h").agg(
        F.sum("__tokens").alias("tokens"))
    start = F.col("before") + F.sum("tokens").over(Window.partitionBy("__leaf").orderBy("h")) - F.col("tokens")
    last = inside.withColumn("start", start).filter("start < __rest").groupBy("__leaf").agg(F.max("h").alias("__last"))
    thresholds = [tuple(r) for r in last.collect()]
    limits = leaves.join(F.broadcast(docs.sparkSession.createDataFrame(thresholds, "__leaf string, __last long")),
                         "__leaf", "left")
    more = F.coalesce((order <= F.col("__last")).cast("long"), F.lit(0).cast("long"))
    return marked.join(F.broadcast(limits), "__leaf").withColumn("__times", F.col("__whole") + more).filter(
        "__times > 0").withColumn("__epoch", F.explode(F.sequence(F.lit(1).cast("long"), "__times"))).select(
            *[F.col(f"`{c}`") for c in docs.columns], "__tokens", "__leaf", "__epoch")

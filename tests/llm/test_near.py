import random
import re

import numpy as np
import pyarrow as pa
from llm.corpus import no_documents, odd_documents

from filetide.llm import near
from filetide.llm.components import components


def plain_set(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    if len(words) < size:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(zip(*[words[i:] for i in range(size)]))


def plain(rows, size, percent=80):
    """(doc_id, text) to (doc_id, shingles, component)."""
    rows = [(i, plain_set(t, size)) for i, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (_, a) in enumerate(rows):
        for j in range(i):
            b = rows[j][1]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return sorted((d, len(s), least[find(i)]) for i, (d, s) in enumerate(rows))


def family(rng, words, copies, edits):
    base = [rng.choice(words) for _ in range(120)]
    yield " ".join(base)
    for _ in range(copies):
        copy = list(base)
        for _ in range(rng.randrange(edits)):
            copy[rng.randrange(len(copy))] = rng.choice(words)
        yield " ".join(copy)


def test_odd_documents_against_all_pairs(spark):
    docs = odd_documents(spark)
    rows = near.near_duplicates(docs, 2).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows) == plain(
        [(r["doc_id"], r["text"]) for r in docs.collect()], 2)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows)


def test_chains_of_near_copies_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(near, "OUTSIDERS", 3)
    monkeypatch.setattr(near, "MEMBERS", 5)
    rng = random.Random(8)
    words = [f"w{i}" for i in range(3000)]
    texts = [t for _ in range(3) for t in family(rng, words, 40, 14)]
    texts += [" ".join(rng.choices(words, k=rng.randrange(1, 12))) for _ in range(60)]
    rng.shuffle(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for size in (2, 5):
        rows = near.near_duplicates(docs, size).collect()
        assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows) == plain(list(enumerate(texts)), size)


def test_null_numbers_are_kept_and_linked_with_nothing(spark):
    docs = spark.createDataFrame([(None, "a b c d e f"), (4, "a b c d e f"), (2, "a b c d e f")], "doc_id long, text string")
    rows = {r["doc_id"]: (r["component_id"], r["kept"]) for r in near.near_duplicates(docs).collect()}
    assert rows == {None: (None, True), 4: (2, False), 2: (2, True)}


def test_no_documents(spark):
    assert near.near_duplicates(no_documents(spark)).collect() == []


def test_registers_agree_as_often_as_sets_overlap():
    rng = np.random.default_rng(1)
    for size in (8, 40, 2000):
        agreed = []
        for _ in range(60):
            pool = rng.integers(0, 2 ** 64, size + size // 4, np.uint64)
            a, b = np.sort(pool[:size]), np.sort(pool[size // 4:])
            rows = near.registers([np.unique(a), np.unique(b)])
            agreed.append(near.estimates(rows[:1], rows[1:], np.array([len(a)]), np.array([len(b)]))[0])
        both = size - size // 4
        assert abs(np.mean(agreed) - both / (2 * size - both)) < 0.06


def test_shingles_of_short_texts():
    sets = near.shingles(pa.array(["a b", "A  B ", "a", "", None, "b a"]), 5)
    assert [len(s) for s in sets] == [1, 1, 1, 0, 0, 1]
    assert sets[0][0] == sets[1][0] != sets[5][0]


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, i) for i in range(101, 160)]
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(chain + star, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)}

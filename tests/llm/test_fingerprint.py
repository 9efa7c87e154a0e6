import hashlib
import random

import numpy as np
from llm.corpus import no_documents, odd_documents

from filetide.llm import fingerprint as P


def plain_one(words, size, picked, k):
    """Straight from the definition, on the same hashes."""
    from filetide.llm.words import mix

    n = max(1, len(words) - k + 1)
    with np.errstate(over="ignore"):
        grams = []
        for i in range(n):
            g = np.uint64(len(words) < k)
            for w in words[i:i + k]:
                g = mix(np.array([g * np.uint64(3) + w]))[0]
            grams.append(g)
        seen, numbered = {}, []
        for g in grams:
            seen[g] = seen.get(g, -1) + 1
            numbered.append(mix(np.array([g + np.uint64(seen[g]) * np.uint64(0x9E3779B97F4A7C15)]))[0])
        out = []
        for s in range(size):
            seed = mix(np.array([s + 1], np.uint64) + np.uint64(P.SEED))[0] | np.uint64(1)
            least = sorted(sorted(range(n), key=lambda i: (numbered[i] * seed, i))[:picked])
            h = np.uint64(0)
            for i in least:
                h = mix(np.array([h * np.uint64(5) + numbered[i]]))[0]
            out.append(int(h >> np.uint64(32)))
    return out


def test_against_the_definition():
    rng = random.Random(3)
    texts = ["", "one", "a b", "a b a b a b a b", " ".join(rng.choice("abcdef") for _ in range(60)), "x" * 100]
    hashes, bounds = P.sequences(texts)
    for i, row in enumerate(P.fingerprints(texts)):
        assert row.tolist() == plain_one(hashes[bounds[i]:bounds[i + 1]], P.SIZE, P.PICKED, P.K)


def test_order_counts():
    words = [f"w{i}" for i in range(200)]
    same, turned = P.fingerprints([" ".join(words), " ".join(words[100:] + words[:100])])
    edited = P.fingerprints([" ".join(words[:150] + ["x"] + words[151:])])[0]
    assert P.likeness(same, edited) > 0.8 > P.likeness(same, turned)


def test_each_document_meets_its_successor(spark):
    docs = odd_documents(spark).repartition(7)
    texts = [(r["doc_id"], r["text"] or "") for r in docs.orderBy("doc_id", "text").collect()]
    rows = P.with_successor(docs).collect()
    want = []
    for i, (doc_id, text) in enumerate(texts):
        after = texts[(i + 1) % len(texts)][1]
        half = len(text) // 2
        changed = text[:len(text) - half] + after[:half]
        a, b, c = P.fingerprints([text, changed, after])
        want.append((doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest(), *P.written(np.array([a, b])),
                     float((a == b).mean()), float((a == c).mean())))
    assert sorted(tuple(r) for r in rows) == sorted(want)


def test_blocks_and_few_documents(spark, monkeypatch):
    monkeypatch.setattr(P, "BLOCK_CHARS", 10)
    docs = spark.createDataFrame([(i, f"text number {i} of many") for i in range(30)], "doc_id long, text string")
    assert P.with_successor(docs).count() == 30
    one = P.with_successor(docs.limit(1)).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0
    assert P.with_successor(no_documents(spark)).collect() == []


def test_ranges_of_null_numbers(spark):
    rows = [(None, f"no number {i} of many") for i in range(40)] + [(i, f"text {i} of some") for i in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    texts = [t for _, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))]
    want = []
    for i, text in enumerate(texts):
        changed = P.edited(text, texts[(i + 1) % len(texts)])
        want.append((len(text), hashlib.sha256(changed.encode()).hexdigest()))
    got = P.with_successor(docs).collect()
    assert sorted((r["n_chars"], r["edited_sha256"]) for r in got) == sorted(want)
    assert sum(r["doc_id"] is None for r in got) == 40
    some = spark.createDataFrame(rows[:5], "doc_id long, text string")
    assert sorted(r["n_chars"] for r in P.with_successor(some).collect()) == sorted(len(t) for _, t in rows[:5])

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm.corpus import DOCUMENTS, no_documents, odd_documents

from filetide.llm import divergence as D
from filetide.llm.words import raw_bytes


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def plain(rows, least, top):
    """Straight from the definition, in Python's whole numbers."""
    rows = [(r["text"] or "", r["lang"] or "", r["source"] or "") for r in rows]
    terms = [re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower(text)) for text, _, _ in rows]
    docs, counts, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for (_, lang, source), words in zip(rows, terms):
        docs[lang].update(set(words))
        counts[lang, source].update(words)
        groups[lang].add(source)
    out = set()
    for lang, sources in groups.items():
        kept = sorted(w for w, n in docs[lang].items() if n >= least)

        def share(count):
            total = sum(count[w] for w in kept)
            return {w: 1 + 10**9 * (count[w] + 2) // (total + 2 * len(kept)) for w in kept}

        p = {s: share(counts[lang, s]) for s in sources}
        q = share(sum((counts[lang, s] for s in sources), Counter()))
        f = lambda x, y: (x - y) ** 2 // (x + y)
        for s in sources:
            pairs = [(-sum(f(p[s][w], p[o][w]) for w in kept), o.encode(), o) for o in sources if o != s]
            words = [(-f(p[s][w], q[w]), w.encode(), w) for w in kept if counts[lang, s][w] and p[s][w] > q[w]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(words)[:top])):
                out |= {(lang, s, part, item, -v, i) for i, (v, _, item) in enumerate(found, 1)}
    return out


def got(df):
    rows = [tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def random_documents(spark, n=300, sources=9):
    rng = random.Random(8)
    words = ["w" + c for c in "abcdefghijklmnop"] + ["Größe", "ÉTÉ", "été", "x" * 20, "x" * 20 + "y", "longerthaneight",
                                                    "longerthanseven", "日本語", "a" * 90, "a" * 90 + "b"]
    rows = []
    for i in range(n):
        text = " ".join(rng.choice(words[:rng.randint(2, len(words))]) for _ in range(rng.randint(0, 40)))
        rows.append((i, text, rng.choice(["en", "de", None]), f"s{min(rng.randrange(2 * sources), sources)}", 0, 0, 0, 0))
    return spark.createDataFrame(rows, DOCUMENTS)


def test_against_the_definition(spark):
    docs = random_documents(spark)
    assert got(D.divergence(docs, 3, 4)) == plain(docs.collect(), 3, 4)


def test_many_buckets_and_blocks_of_sources(spark, monkeypatch):
    docs = random_documents(spark)
    want = plain(docs.collect(), 1, 10)
    # The functions travel by value, with these numbers in them.
    monkeypatch.setattr(D, "BUCKET_ROWS", 20)
    monkeypatch.setattr(D, "SOURCES", 4)
    monkeypatch.setattr(D, "CELLS", 30)
    monkeypatch.setattr(D, "SHARD_BYTES", 200)
    assert got(D.divergence(docs, 1)) == want


def test_odd_documents(spark):
    docs = odd_documents(spark)
    for least in (1, 2, 10):
        assert got(D.divergence(docs, least)) == plain(docs.collect(), least, 10)


def test_sources_without_terms_are_all_alike(spark):
    docs = spark.createDataFrame([(1, None, "en", "a", 0, 0, 0, 0), (2, "1 2", "en", "b", 0, 0, 0, 0)], DOCUMENTS)
    assert got(D.divergence(docs)) == {("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)}


def test_no_documents(spark):
    assert D.divergence(no_documents(spark)).collect() == []


def test_order_of_pointers_is_that_of_words():
    rng = random.Random(2)
    for most in (3, 12, 200):
        texts = [" ".join("".join(rng.choice("abé") for _ in range(rng.randint(1, most))) for _ in range(40)) for _ in range(20)]
        texts.insert(3, "")
        import pyarrow as pa

        raw, bounds = raw_bytes(pa.array(texts))
        starts, ends, text = D.word_pointers(raw, bounds)
        words = [raw[a:b].tobytes() for a, b in zip(starts, ends)]
        assert [w.decode() for w in words] == " ".join(t for t in texts if t).split()
        order, fresh = D.sort_pointers(raw, starts, ends)
        by = sorted(range(len(words)), key=lambda i: (words[i], i))
        assert order.tolist() == by
        assert fresh.tolist() == [k == 0 or words[by[k - 1]] != words[i] for k, i in enumerate(by)]


def test_counts_beyond_64_bits():
    big = np.array([10**13, 0, 7])
    total, kept = int(big.sum()), 3
    assert D.shares(big, total, kept).tolist() == [1 + 10**9 * (int(c) + 2) // (total + 6) for c in big]


@pytest.mark.parametrize("text", ["x" * 3_000_000, "ab " * 1_000_000, "é" * 1_500_000])
def test_long_texts(spark, text):
    docs = spark.createDataFrame([(i, text, "en", s, 0, 0, 0, 0) for i, s in enumerate("aab")], DOCUMENTS)
    assert got(D.divergence(docs, 1)) == plain(docs.collect(), 1, 10)

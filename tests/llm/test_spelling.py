import random
import re
import zlib
from collections import Counter

import numpy as np
from llm.corpus import DOCUMENTS, no_documents, odd_documents

from filetide.llm import spelling as S


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[i + 1:] == b[i + 1:] or a[i:] == b[i + 1:] or a[i + 1:] == b[i:]


def plain(rows):
    """Straight from the definition, every word against every other."""
    n = Counter()
    for row in rows:
        name = "" if row["doc_id"] is None else str(row["doc_id"])
        for word in re.findall("[A-Za-zÀ-ÿ]+", row["text"] or ""):
            word = lower(word)
            h = zlib.crc32(f"{name}:{word}".encode())
            if h % 31 == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1:]
            if len(word) >= 7:
                n[word] += 1
    n = {w: c for w, c in n.items() if c >= 2}
    near = {w: [x for x in n if one_edit(w, x)] for w in n}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 10 * n[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return {(w, form[w], root(w), n[w], len(near[w]), n.get(form[w])) for w in n}


def got(df):
    rows = [tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(rows) == len({r[0] for r in rows})
    return set(rows)


def misspelled(spark, seed=5, documents=200):
    """Frequent words, rarer ones an edit away from them, and still rarer ones an edit further."""
    rng = random.Random(seed)
    letters = "abcdeéß÷"
    texts = []
    words = ["".join(rng.choice(letters) for _ in range(rng.randint(6, 14))) for _ in range(12)]
    words += ["aaaaaaaa", "aaaaaaaaa", "aaaaaaaaaa", "abababab", "babababa", "ababababa"]
    for i in range(documents):
        # A chain: the second is a form of the third, and the first of the second.
        said = ["chainedword"] * 2 + ["chainedwxrd"] * (i % 10 == 0) + ["chaiyedwxrd"] * (i % 100 == 0)
        for _ in range(60):
            word = rng.choice(words)
            for _ in range(min(rng.randrange(40) // 37, 2)):
                at, kind = rng.randrange(len(word) + 1), rng.randrange(3)
                word = word[:at] + ("" if kind == 0 else rng.choice(letters)) + word[at + (kind < 2):]
            said.append(word.upper() if rng.random() < 0.1 else word)
        texts.append(rng.choice([" ", "-", "1"]).join(said))
    return spark.createDataFrame(
        [(i if i % 9 else None, t, "en", "s", 0, 0, 0, 0) for i, t in enumerate(texts)], DOCUMENTS)


def test_against_every_pair(spark):
    for seed in (5, 6):
        docs = misspelled(spark, seed)
        want = plain(docs.collect())
        assert len(want) > 100 and any(f and r != f for _, f, r, *_ in want)
        assert got(S.variants(docs)) == want


def test_long_lists_in_parts_and_many_blocks(spark, monkeypatch):
    docs = misspelled(spark)
    monkeypatch.setattr(S, "LIST_ROWS", 7)
    monkeypatch.setattr(S, "TASK_ROWS", 200)
    monkeypatch.setattr(S, "PAIRS", 10)
    assert got(S.variants(docs)) == plain(docs.collect())


def test_odd_documents(spark):
    docs = odd_documents(spark)
    docs = docs.union(docs).union(docs.limit(9))
    assert got(S.variants(docs)) == plain(docs.collect())


def test_long_words(spark):
    long = "ab" * 100_000
    texts = [long, long, long + "c", long + "c", "x" * 2_000_000, "x" * 2_000_000, "y" + long[1:], "y" + long[1:]]
    docs = spark.createDataFrame([(i // 2, t, "en", "s", 0, 0, 0, 0) for i, t in enumerate(texts)], DOCUMENTS)
    want = plain(docs.collect())
    assert got(S.variants(docs)) == want


def test_no_documents(spark):
    assert S.variants(no_documents(spark)).collect() == []


def test_checksums_go_on_from_what_came_before():
    rng = np.random.default_rng(1)
    raw = rng.integers(0, 256, 3000).astype(np.uint8)
    starts = np.sort(rng.integers(0, 2800, 50))
    ends = starts + rng.integers(0, 180, 50)
    before = np.array([zlib.crc32(bytes([i])) for i in range(50)], np.uint32)
    want = [zlib.crc32(raw[a:b].tobytes(), int(c)) for a, b, c in zip(starts, ends, before)]
    assert S.checksums(raw, starts, ends, before).tolist() == want

import random
from collections import Counter

from llm.corpus import no_documents, odd_documents

from filetide.llm import repeats


def plain(texts, length):
    texts = [(t or "").encode() for t in texts]
    seen = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = [False] * len(t)
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = [True] * length
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((bytes(c for c, g in zip(t, gone) if not g), len(t), spans))
    return out


def compare(docs, **options):
    rows = docs.collect()
    want = sorted(zip([r["doc_id"] for r in rows], plain([r["text"] for r in rows], options.get("length", 200))), key=repr)
    got = sorted(((r["doc_id"], (bytes(r["kept"]), r["n_bytes"], len(r["spans"])))
                  for r in repeats.remove_repeats(docs, **options).collect()), key=repr)
    assert got == want


def test_odd_documents_against_all_strings(spark):
    compare(odd_documents(spark))


def test_shared_passages_against_all_strings(spark, monkeypatch):
    rng = random.Random(3)
    letters = "abcd é"
    passage = "".join(rng.choice(letters) for _ in range(90))
    texts = []
    for _ in range(60):
        own = "".join(rng.choice(letters) for _ in range(rng.randrange(80)))
        a, b = sorted(rng.sample(range(91), 2))
        texts.append(own + passage[a:b] + own[:20] + passage[b // 2:])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    compare(docs, length=30, seed=8)
    monkeypatch.setattr(repeats, "CLASS", 2)  # the way of large classes
    compare(docs, length=30, seed=8)


def test_runs_of_one_letter_and_null_numbers(spark):
    docs = spark.createDataFrame([(None, "z" * 500), (None, None), (1, "z" * 150), (1, "y" * 201), (2, "q" * 200)],
                                 "doc_id long, text string")
    compare(docs)


def test_no_documents(spark):
    assert repeats.remove_repeats(no_documents(spark)).collect() == []


def test_many_null_numbers_against_all_strings(spark, monkeypatch):
    rng = random.Random(7)
    passage = "".join(rng.choice("abcd é") for _ in range(90))
    rows = []
    for i in range(60):
        a, b = sorted(rng.sample(range(91), 2))
        own = "".join(rng.choice("abcd é") for _ in range(rng.randrange(80)))
        rows.append((None if i % 3 else 60 - i, own + passage[a:b] + own[:20] + passage[b // 2:]))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    compare(docs, length=30, seed=8)
    monkeypatch.setattr(repeats, "CLASS", 2)
    compare(docs, length=30, seed=8)


def test_texts_that_share_a_doc_id_and_part_of_their_hash(spark):
    """Of many rows without a doc_id some agree in 24 bits of the hash of their texts; no unique text goes."""
    import random

    from pyspark.sql import functions as F

    rng = random.Random(9)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(300))
    # Of 12,000 texts several pairs agree in 24 bits.
    texts = [f"{i} " + ("" if i % 2 else passage[:250]) for i in range(12_000)]
    hashed = spark.createDataFrame([(t,) for t in texts], "t string").select("t", F.pmod(F.xxhash64("t"), F.lit(1 << 24)).alias("h"))
    pairs = [r["ts"] for r in hashed.groupBy("h").agg(F.collect_list("t").alias("ts")).filter("size(ts) > 1").collect()]
    mixed = [sorted(p, key=len) for p in pairs if len({len(t) > 200 for t in p}) == 2][:3]
    assert mixed
    filler = ["".join(rng.choice("ijklmnopqrst ") for _ in range(400)) for _ in mixed]
    docs = [t for pair in mixed for t in pair] + filler
    out = repeats_of(spark, docs)
    for t in docs:
        assert out[t] == (t if passage[:250] not in t else t[:-251])


def repeats_of(spark, texts):
    from filetide.llm.repeats import remove_repeats

    df = spark.createDataFrame([(None, t) for t in texts], "doc_id long, text string")
    by_size = {}
    for r in remove_repeats(df).collect():
        by_size.setdefault(r["n_bytes"], []).append(bytes(r["kept"]).decode())
    out = {}
    for t in texts:
        found = by_size[len(t.encode())]
        out[t] = next(k for k in found if t.startswith(k[:4]))
    return out

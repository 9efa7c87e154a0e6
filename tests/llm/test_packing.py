import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm.corpus import no_documents, odd_documents

from filetide.llm import packing
from filetide.llm.registered import tokenizer_path
from filetide.llm.tokens import WordTokens

PATH = tokenizer_path()


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 50_000))
def test_cuts_cover_a_document_in_reciprocal_parts(n):
    parts = packing.cuts(n)
    assert sum(parts) == n and all(0 < p <= packing.CAPACITY for p in parts)
    assert all(p == packing.CAPACITY // (packing.CAPACITY // p) for p in parts[:-1])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.sampled_from("aZé .,'|<>İßΣ\n\t ́日1"), max_size=30), max_size=8))
def test_word_by_word_ids_equal_whole_text_ids(texts):
    import pyarrow as pa

    coder = WordTokens(PATH)
    ids, bounds = coder.encode(pa.array(texts, pa.string()))
    for i, text in enumerate(texts):
        assert ids[bounds[i]:bounds[i + 1]].tolist() == coder.tokenizer.encode(text, add_special_tokens=False).ids


def test_special_tokens_and_forgetting(monkeypatch):
    import pyarrow as pa

    from filetide.llm import tokens

    monkeypatch.setattr(tokens, "CACHED_WORDS", 3)
    coder = WordTokens(PATH)
    for text in ["a<|endoftext|>b <|startoftext|>", "one two three four five.", "six seven one", None, ""]:
        ids, _ = coder.encode(pa.array([text], pa.string()))
        assert ids.tolist() == coder.tokenizer.encode(text or "", add_special_tokens=False).ids


def check(rows, docs):
    coder = WordTokens(PATH)
    placed = sorted(rows, key=lambda r: (r["sequence_id"], r["offset"]))
    at = {}
    for r in placed:
        assert r["offset"] == at.get(r["sequence_id"], 0)
        at[r["sequence_id"]] = r["offset"] + r["length"]
    assert all(n <= packing.CAPACITY for n in at.values())
    left = {}
    for doc_id, text in docs:
        ids = [*coder.tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        left.setdefault(doc_id, []).append(ids)
    for doc_id, texts in left.items():
        want = []
        for ids in texts:
            start = 0
            for size in packing.cuts(len(ids)):
                part = np.array(ids[start:start + size], "<u4").tobytes()
                want.append((start, size, zlib.crc32(part), len(ids)))
                start += size
        got = [(r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in rows if r["doc_id"] == doc_id]
        assert sorted(got) == sorted(want)
    return at


def test_every_id_lies_in_one_piece(spark):
    docs = odd_documents(spark).repartition(5)
    rows = packing.pack_documents(docs, PATH, ids=True).collect()
    at = check(rows, [(r["doc_id"], r["text"]) for r in docs.collect()])
    assert all(zlib.crc32(bytes(r["ids"])) == r["ids_crc32"] for r in rows)
    assert len(at) <= sum(at.values()) / packing.CAPACITY + 2


def test_no_documents(spark):
    assert packing.pack_documents(no_documents(spark), PATH).collect() == []


@pytest.mark.parametrize("fan", [2, 64])
def test_leftovers_of_many_tasks_meet(spark, monkeypatch, fan):
    monkeypatch.setattr(packing, "FAN", fan)
    pieces = spark.range(0, 900, 1, 9).selectExpr("id", "1 + id % 300 AS length")
    rows = packing.pack(pieces).collect()
    at = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == at.get(r["sequence_id"], 0)
        at[r["sequence_id"]] = r["offset"] + r["length"]
    assert sorted(r["id"] for r in rows) == list(range(900))
    assert max(at.values()) <= packing.CAPACITY and len(at) <= sum(at.values()) / packing.CAPACITY * 1.05 + 1


def test_added_tokens_in_any_case():
    import random

    import pyarrow as pa

    coder = WordTokens(PATH)
    rng = random.Random(7)
    pieces = [p for t in coder.added for p in (t, t.upper(), t.swapcase(), t.capitalize(), t[:-1], t[1:])]
    pieces += ["a", "Word", ".", ",", " ", "\n", "<|", "|>", "É", "日"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 9))) for _ in range(3000)]
    ids, bounds = coder.encode(pa.array(texts, pa.string()))
    for i, text in enumerate(texts):
        assert ids[bounds[i]:bounds[i + 1]].tolist() == coder.tokenizer.encode(text, add_special_tokens=False).ids, text


def test_packed_documents_with_special_tokens(spark):
    docs = [(i, t) for i, t in enumerate(["<|STARTOFTEXT|> x <|endoftext|>", "a<|EndOfText|>b " * 900, "<|ENDOFTEXT|>"])]
    packed = packing.pack_documents(spark.createDataFrame(docs, "doc_id long, text string"), PATH).collect()
    check(packed, docs)


def test_a_tokenizer_that_joins_words_is_refused(tmp_path):
    from tokenizers import Tokenizer, models

    path = str(tmp_path / "other.json")
    tokenizer = Tokenizer(models.WordLevel({"a": 0, "[UNK]": 1}, unk_token="[UNK]"))
    tokenizer.save(path)
    with pytest.raises(ValueError):
        WordTokens(path)

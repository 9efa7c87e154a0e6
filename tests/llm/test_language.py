import itertools

import numpy as np
import pyarrow as pa
from llm.corpus import no_documents, odd_documents
from pyspark.sql import functions as F

from filetide.llm import language as L

SF = "/root/testdata/sf0.01"


def test_labels_are_the_best_of_all(spark=None):
    rng = np.random.default_rng(4)
    sizes = [0, 1, 6, 4, 7]
    scores = rng.standard_normal((sum(sizes), 3)).astype(np.float32) * 2
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    labels = L.label(scores, bounds, 1.5)
    for a, b in zip(bounds[:-1], bounds[1:]):
        value = lambda path: sum(scores[a + i, x] for i, x in enumerate(path)) - 1.5 * sum(
            x != y for x, y in zip(path, path[1:]))
        best = max(itertools.product(range(3), repeat=int(b - a)), key=value)
        assert abs(value(labels[a:b].tolist()) - value(best)) < 1e-4


def test_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = L.learn(docs.filter(~L.held_out("doc_id")))
    rows = L.predict(docs, model, columns=["doc_id", "lang"]).filter(L.held_out("doc_id")).collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) > 0.95 * len(rows)
    both = docs.filter("lang = 'en'").first()["text"][:600] + " " + docs.filter("lang = 'de'").first()["text"][:900]
    names, score, spans = L.predict_texts(pa.array([both]), model)
    assert names == ["de"] and 0.5 < score[0] < 0.75 and [s["lang"] for s in spans[0]] == ["en", "de"]
    assert spans[0][0]["start"] == 0 and spans[0][-1]["end"] == len(both.split())


def test_scripts_narrow_the_candidates(spark):
    docs = spark.createDataFrame([(1, "мир и война это слова", "ru"), (2, "peace and war are words", "en")] * 3,
                                 "doc_id long, text string, lang string")
    model = L.learn(docs)
    names, _, _ = L.predict_texts(pa.array(["слово", "zzz qqq", "漢字", "12 34", None, ""]), model)
    assert names[:2] == ["ru", "en"] and names[2] in ("en", "ru") and names[3:] == ["und"] * 3


def test_odd_documents(spark):
    docs = odd_documents(spark)
    rows = L.predict(docs, L.learn(docs), columns=docs.columns, names=("__a", "__b", "__c")).collect()
    assert len(rows) == docs.count() and rows[0].__fields__ == [*docs.columns, "__a", "__b", "__c"]
    for r in rows:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["__a"] != "und") == letters and (r["__b"] > 0) == letters and 0 <= r["__b"] <= 1
    nothing = L.learn(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r["lang_pred"] for r in L.predict(docs, nothing).collect()} == {"und"}
    assert L.predict(no_documents(spark), L.learn(no_documents(spark))).collect() == []

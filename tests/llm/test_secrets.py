import hashlib
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm.corpus import no_documents, odd_documents

from filetide.llm import secret_scan as S

ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def plain(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def scanned(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [[tuple(x) for x in r["secrets"]] for r in S.scan(docs).orderBy("doc_id").collect()]


PIECES = ["token", "Secret", "api_key", "APIKEY", "=", ":", " ", '"', "'", "abcdef", "AKIA", "ABCDEFGHIJ0123456", "é", "😀",
          "0123456789abcdef", "passwd", "-", "x", "\n", "AKIAAKIA"]


@pytest.fixture(scope="module")
def many(spark):
    return spark


@settings(max_examples=4, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=14).map("".join), min_size=30, max_size=60))
def test_base_spans_against_python(many, texts):
    found = scanned(many, texts)
    assert [[x for x in f if x[1] < 3] for f in found] == [plain(t) for t in texts]


def test_random_runs_are_found_and_words_are_not(spark):
    rng = random.Random(2)
    base64 = "".join(rng.choice(S.ALPHABETS["random_base64"]) for _ in range(48))
    hexes = ["".join(rng.choice("0123456789abcdef") for _ in range(40)) for _ in range(5)]
    words = ["internationalization", "supercalifragilisticexpialidocious", "SomeVeryLongIdentifierName", "a" * 40,
             "ab" * 30, "0123456789" * 4, "heitlichenkeitungeninverschaftlich"]
    texts = [f"é {base64} end", *[f"key {h}" for h in hexes], *words]
    found = scanned(spark, texts)
    assert (2, 3 + list(S.ALPHABETS).index("random_base64"), 50) in found[0]
    assert sum((4, 3, 44) in f for f in found[1:6]) >= 4
    assert not any(x[1] >= 3 for f in found[6:] for x in f)


def test_written_form(spark):
    text = 'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"'
    docs = spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string")
    from pyspark.sql import functions as F

    rows = S.scan(docs).select("doc_id", S.written(F.filter("secrets", lambda x: x["kind"] < 3)).alias("w")).orderBy("doc_id").collect()
    assert [r["w"] for r in rows] == ["assign:0:49,hex:9:49", ""]
    assert hashlib.sha256(b"").hexdigest()


def test_odd_documents(spark):
    docs = odd_documents(spark)
    rows = S.scan(docs).collect()
    assert S.scan(docs).columns == [*docs.columns, "secrets"] and len(rows) == docs.count()
    assert all([tuple(x) for x in r["secrets"] if x[1] < 3] == plain(r["text"]) for r in rows)
    assert S.scan(no_documents(spark)).collect() == []


def test_no_python_runs(spark):
    from helpers import plan

    assert not re.search("EvalPython|InArrow|InPandas", plan(S.scan(odd_documents(spark))))


def test_recall_and_false_reports_by_encoding(spark):
    rng = random.Random(9)
    names = ["random_hex", "random_upper_hex", "random_lower", "random_upper", "random_base32", "random_lower_base32",
             "random_base36", "random_upper_base36", "random_base62", "random_base64"]
    # Letters by their frequency in English, as in long words and names run together.
    common = "etaoinshrdlu" * 6 + "etaoin" * 6 + "cmfwypvbgk" * 2
    words = ["".join(rng.choice(common) for _ in range(n)) for n in (24, 32, 48, 64) for _ in range(100)]
    words += [w.upper() for w in words] + [f"{w[:10]}_{w[10:]}{i % 10}" for i, w in enumerate(words)]
    keys = [(name, n, "".join(rng.choice(S.ALPHABETS[name]) for _ in range(n)))
            for name in names for n in (32, 48, 64) for _ in range(30)]
    found = [{x[1] for x in f if x[1] >= 3} for f in scanned(spark, [k for _, _, k in keys] + words)]
    hits = {}
    for (name, n, _), f in zip(keys, found):
        hits[name, n] = hits.get((name, n), 0) + bool(f)
    least = {32: 15, 48: 20, 64: 24}
    assert {k: v for k, v in hits.items() if v < least[k[1]]} == {}, hits
    assert sum(map(bool, found[len(keys):])) <= 0.02 * sum(hits.values())
    assert [len(x) for x in S.ALPHABETS.values()] == sorted(len(x) for x in S.ALPHABETS.values())


def test_a_megabyte_of_hits_takes_linear_time(spark):
    import time

    text = "token=abcdef;\n" * 75_000
    started = time.monotonic()
    found = scanned(spark, [text])[0]
    assert found == plain(text) and time.monotonic() - started < 120
    texts = ["token=abcdef " * n for n in (255, 256, 257, 511, 512, 513)]
    assert scanned(spark, texts) == [plain(t) for t in texts]


def test_long_runs(spark):
    n = 1 << 15
    for text, kind in (("AKIA" + "A" * n, 1), ("0" * n, 2), ("secret = " + "/" * n, 0)):
        assert (kind in {k for _, k, _ in scanned(spark, [text])[0]}) and scanned(spark, [text])[0][0] == plain(text)[0]

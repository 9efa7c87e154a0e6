import random

from hypothesis import given, settings
from hypothesis import strategies as st
from llm.corpus import DOCUMENTS, no_documents, odd_documents
from pyspark.sql import functions as F

from filetide.llm import mixing

LEAVES = st.dictionaries(st.tuples(st.sampled_from("ab"), st.sampled_from("xyz"), st.sampled_from("123")),
                         st.integers(0, 1000), min_size=1, max_size=12)


@settings(max_examples=200, deadline=None)
@given(LEAVES, st.integers(0, 9000), st.integers(1, 3))
def test_budgets_take_all_that_capacities_allow(leaves, total, epochs):
    weight = lambda path: {"a": 3.0, "x": 2.0}.get(path[-1], 1.0)
    found = mixing.budgets(leaves, weight, total, epochs)
    assert set(found) == set(leaves)
    assert all(0 <= found[k] <= leaves[k] * epochs for k in leaves)
    assert sum(found.values()) == min(total, sum(leaves.values()) * epochs)


def test_shortage_goes_to_siblings_before_ancestors():
    leaves = {("a", "x"): 10, ("a", "y"): 1000, ("b", "x"): 1000}
    found = mixing.budgets(leaves, lambda path: 1.0, 400, 1)
    assert found == {("a", "x"): 10, ("a", "y"): 190, ("b", "x"): 200}


def selected(docs, **options):
    levels = {"lang": F.col("lang"), "source": F.col("source")}
    return mixing.mix(docs, levels, lambda path: 1.0, **options)


def test_each_leaf_reads_a_prefix_of_its_order(spark):
    rng = random.Random(1)
    rows = [(i, "w " * rng.randrange(30), rng.choice(["en", "de", None]), rng.choice(["s", "t"])) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    tokens = {i: len(t.split()) for i, t, _, _ in rows}
    leaf = {i: (lang, source) for i, _, lang, source in rows}
    total = sum(tokens.values())
    there = {}
    for i, x in leaf.items():
        there[x] = there.get(x, 0) + tokens[i]
    for share, epochs in ((0.3, 1), (1.7, 2), (1.0, 1)):
        out = selected(docs, share=share, epochs=epochs).collect()
        want = mixing.budgets(there, lambda path: 1.0, int(share * total), epochs)
        order = {}
        for e in range(1, epochs + 1):
            order |= {(r["doc_id"], e): r["h"] for r in docs.select(
                "doc_id", F.xxhash64(F.lit(1), F.lit(e).cast("long"), "doc_id", F.xxhash64("text")).alias("h")).collect()}
        expected = []
        for x, budget in want.items():
            mine = [i for i in leaf if leaf[i] == x]
            for e in range(1, epochs + 1):
                at = (e - 1) * there[x]
                for i in sorted(mine, key=lambda i: order[i, e]):
                    if at < budget:
                        expected.append((i, e))
                    at += tokens[i]
        got = [(r["doc_id"], r["__epoch"]) for r in out]
        # a document without words is in where its place in the order lies before the end of the budget
        assert sorted(x for x in got if tokens[x[0]]) == sorted(x for x in expected if tokens[x[0]])


def test_odd_documents(spark):
    docs = odd_documents(spark)
    out = selected(docs, share=1.0)
    assert out.columns == [*docs.columns, "__tokens", "__leaf", "__epoch"]
    with_words = docs.filter("trim(translate(text, '\t\n', '  ')) != ''").count()
    assert with_words <= out.count() <= docs.count()
    assert selected(no_documents(spark)).collect() == []
    assert selected(docs, total=0).collect() == []


def test_rows_without_a_doc_id_are_not_one_lump(spark):
    rows = [(None if i % 3 == 0 else i, f"text {i} " + "word " * (i % 7 + 1), "en", "s", 0, 0, 0, 0) for i in range(900)]
    docs = spark.createDataFrame(rows, DOCUMENTS)
    total = docs.select(mixing.word_count(F.col("text")).alias("n")).agg(F.sum("n")).first()[0]
    for seed in range(4, 9):
        for share in (0.5, 0.7):
            got = mixing.mix(docs, {"lang": F.col("lang")}, lambda path: 1.0, share=share, seed=seed).agg(F.sum("__tokens")).first()[0]
            assert int(share * total) <= got < int(share * total) + 10

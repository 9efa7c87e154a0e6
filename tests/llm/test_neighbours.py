import numpy as np
import pytest

from filetide.llm import neighbours as N

SCHEMA = "vec_id long, vector array<float>"


def plain(rows, asked, k):
    ids, v = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], np.float32).astype(float)
    out = {}
    for i in np.flatnonzero(asked(ids)):
        score = v @ v[i]
        others = np.flatnonzero(ids != ids[i])
        best = others[np.lexsort((ids[others], -score[others]))][:k]
        out[int(ids[i])] = [(int(ids[j]), score[j]) for j in best]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


@pytest.mark.parametrize("block", [64, 8192])
def test_against_all_inner_products(spark, monkeypatch, block):
    monkeypatch.setattr(N, "VECTOR_BLOCK", block)
    monkeypatch.setattr(N, "QUERY_BLOCK", max(8, block // 16))
    rng = np.random.default_rng(2)
    rows = [(i, (rng.standard_normal(24) * rng.uniform(0.2, 3) + 1).astype(np.float32).tolist()) for i in range(500)]
    vectors = spark.createDataFrame(rows, SCHEMA)
    got, want = found(N.nearest(vectors.filter("vec_id % 20 = 0"), vectors, 20)), plain(rows, lambda x: x % 20 == 0, 20)
    assert got.keys() == want.keys()
    hits = sum(len({a for a, _ in got[q]} & {a for a, _ in want[q]}) for q in want)
    assert hits >= 0.99 * 20 * len(want)
    for q in got:
        true = dict(zip([r[0] for r in rows], np.array([r[1] for r in rows]) @ np.array(rows[q][1])))
        assert all(abs(s - true[a]) < 1e-9 for a, s in got[q])


def test_odd_vectors_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, None), (3, [0.0, 0.0]), (4, [None, 1.0]), (5, [nan, 1.0]), (6, [inf, 1.0]),
            (7, [2.0, 0.0]), (8, [1.0]), (None, [1.0, 1.0]), (9, []), (20, [0.0, 1.0]), (20, [0.0, 1.0])]
    vectors = spark.createDataFrame(rows, SCHEMA)
    got = found(N.nearest(vectors.filter("vec_id = 0"), vectors, 20))
    assert got == {0: [(1, 2.0), (7, 2.0), (20, 0.0), (20, 0.0)]}
    assert N.nearest(vectors.filter("vec_id = 3"), vectors, 20).collect() == []
    assert N.nearest(vectors.limit(0), vectors.limit(0), 20).collect() == []


def test_equal_vectors_and_one_vector(spark):
    vectors = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(30)], SCHEMA)
    got = found(N.nearest(vectors.filter("vec_id = 20"), vectors, 20))
    assert [a for a, _ in got[20]] == [i for i in range(21) if i != 20]
    one = vectors.filter("vec_id = 0")
    assert N.nearest(one, one, 20).collect() == []

import numpy as np
from pyspark.sql import functions as F

from fathomline.llm import prefix_forest, vafile


def brute(ids, score, k, every):
    out = set()
    for i, q in enumerate(ids):
        if q % every == 0:
            near = sorted((-score[i, j], ids[j]) for j in range(len(ids)) if j != i)[:k]
            out |= {(q, r + 1, v, -s) for r, (s, v) in enumerate(near)}
    return out


def rows(spark, n=900, copies=200, seed=3):
    r = np.random.default_rng(seed)
    m = r.standard_normal((n, 16)).astype(np.float32)
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    m[: 2 * copies : 2] = m[0]
    ids = [i * 5 for i in range(n)]
    data = [(i, x.tolist()) for i, x in zip(ids, m, strict=True)]
    bad = [(-100, None), (-200, []), (-300, [None] * 16), (-400, [float("nan")] * 16), (-500, [float("inf")] * 16), (None, m[0].tolist()), (0, m[0].tolist()), (-600, [1.0])]
    return ids, m.astype(np.float64), spark.createDataFrame(data + bad, "vec_id long, embedding array<float>").withColumns({"cid": F.lit(1), "v": F.lit(2), "rank": F.lit(3)}).repartition(3)


def test_exact(spark):
    ids, m, df = rows(spark)
    ints = np.floor(256 * m)
    want = brute(ids, ints @ ints.T, 5, 50)
    assert {tuple(r) for r in vafile.search(df).collect()} == want
    assert {tuple(r) for r in vafile.search(df, bits=3).collect()} == want
    few = spark.createDataFrame([(0, [1.0, 0.0]), (50, [0.5, 0.5]), (3, [0.0, 0.0])], "vec_id long, embedding array<double>")
    assert sorted(tuple(r) for r in vafile.search(few).collect()) == [(0, 1, 50, 32768), (0, 2, 3, 0), (50, 1, 0, 32768), (50, 2, 3, 0)]
    assert vafile.search(few.limit(0)).count() == 0


def test_forest_recall(spark):
    for at, least in (("/root/testdata/sf0.01", 0.9), ("/root/testdata/sf0.1", 0.9)):
        df = spark.read.parquet(f"{at}/embeddings.parquet")
        m = np.array([r[0] for r in df.orderBy("vec_id").select("embedding").collect()], np.float64)
        want = brute(list(range(len(m))), m @ m.T, 20, 20)
        got = prefix_forest.search(df).collect()
        assert len(got) == len(want)
        assert len({(r[0], r[2]) for r in got} & {(w[0], w[2]) for w in want}) >= least * len(want)
        assert all(abs(r["score"] - m[r["query_id"]] @ m[r["vec_id"]]) < 1e-12 for r in got)


def test_forest_edges(spark):
    ids, m, df = rows(spark)
    got = prefix_forest.search(df).collect()
    want = brute(ids, np.round(m @ m.T, 12), 20, 20)
    assert len(got) == len(want) and len({(r[0], r[2]) for r in got} & {(w[0], w[2]) for w in want}) >= 0.9 * len(want)
    few = spark.createDataFrame([(0, [1.0, 0.0]), (40, [0.0, 0.0]), (3, [9.0, 1.0])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in prefix_forest.search(few).collect()] == [(0, 1, 3, 9.0)]
    assert prefix_forest.search(few.limit(0)).count() == 0


def test_lengths_are_searched_apart(spark):
    r = np.random.default_rng(5)
    two, three, large = r.standard_normal((40, 2)), r.standard_normal((30, 3)), np.round(r.standard_normal((60, 8)) * 1e6)
    data = [(i * 10, x.tolist()) for i, x in enumerate(two)] + [(1000 + i * 10, x.tolist()) for i, x in enumerate(three)] + [(-7, [1.0] * 5)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>").repartition(3)
    parts = [(list(range(0, 400, 10)), two), (list(range(1000, 1300, 10)), three)]
    want = set().union(*(brute(ids, (f := np.floor(256 * m)) @ f.T, 5, 50) for ids, m in parts))
    assert {tuple(x) for x in vafile.search(df).collect()} == want
    near = set().union(*(brute(ids, m @ m.T, 20, 20) for ids, m in parts))
    got = prefix_forest.search(df).collect()
    assert len(got) == len(near) and len({(x[0], x[2]) for x in got} & {(x[0], x[2]) for x in near}) >= 0.9 * len(near)
    # whole numbers whose products are beyond what a double holds
    big = spark.createDataFrame([(i * 10, x.tolist()) for i, x in enumerate(large)], "vec_id long, embedding array<double>")
    whole = [[int(256 * y) for y in x] for x in large.tolist()]
    score = np.array([[sum(a * b for a, b in zip(x, y, strict=True)) for y in whole] for x in whole], object)
    assert {tuple(x) for x in vafile.search(big).collect()} == brute(list(range(0, 600, 10)), score, 5, 50)


def test_near_vectors_need_few_scores():
    r = np.random.default_rng(1)
    m = r.standard_normal((60, 32))[r.integers(0, 60, 3000)] + 0.3 * r.standard_normal((3000, 32))
    forest = prefix_forest.Forest(prefix_forest.Forest.encode(m, 48, 24, 1), len(m), 32, 48, 24)
    found = forest.nearest(m[:50], prefix_forest.strings(m[:50], np.zeros(50), 48, 24, 1), 21, 0.05)
    best = np.argsort(-(m[:50] @ m.T), axis=1)[:, :21]
    assert np.mean([np.isin(b, f).mean() for b, (f, _) in zip(best, found, strict=True)]) >= 0.95
    assert np.mean([len(f) for f, _ in found]) <= 0.2 * len(m)


def test_large_components(spark):
    """Scores beyond 64 bits are no results, the pairs that fit stay, whatever other rows hold."""
    three = spark.createDataFrame([(0, [1 / 256, 0.0]), (1, [1.0, 0.0]), (61, [1e30, 0.0])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in vafile.search(three).collect()] == [(0, 1, 1, 256)]
    r = np.random.default_rng(8)
    m = r.standard_normal((80, 4))
    m[10], m[20], m[30], m[40] = [1e30, 0, 0, 0], [-1e200, 1e200, 0, 0], [2.0**54, -(2.0**54), 1, 0], [2.0**30, 2.0**30, 0, 0]
    m[50] = [1e307, 0, 0, 0]  # not finite once it is scaled
    m[60] = [1e15, 1e15, 0, 0]
    ids = [i * 10 for i in range(80)]
    df = spark.createDataFrame([(i, x.tolist()) for i, x in zip(ids, m, strict=True)], "vec_id long, embedding array<double>").repartition(3)
    whole = [[int(np.floor(256 * c)) for c in x] for x in m.tolist() if abs(x[0]) < 1e300]
    own = [i for i, x in zip(ids, m.tolist(), strict=True) if abs(x[0]) < 1e300]
    want = set()
    for i, q in enumerate(own):
        if q % 50 == 0:
            near = [(-sum(a * b for a, b in zip(whole[i], whole[j], strict=True)), own[j]) for j in range(len(own)) if j != i]
            near = sorted(x for x in near if -(2**63) <= -x[0] < 2**63)[:5]
            want |= {(q, n + 1, v, -s) for n, (s, v) in enumerate(near)}
    assert {tuple(x) for x in vafile.search(df).collect()} == want


def test_bounds_are_read_until_the_result_is_certain(spark):
    """Coarse cells, so that many bounds lie above the best scores and several portions are read."""
    r = np.random.default_rng(2)
    m = r.uniform(-1, 1, (700, 6))
    ids = [i * 5 for i in range(700)]
    ints = np.floor(256 * m)
    df = spark.createDataFrame([(i, x.tolist()) for i, x in zip(ids, m, strict=True)], "vec_id long, embedding array<double>").repartition(2)
    assert {tuple(x) for x in vafile.search(df, k=2, bits=1).collect()} == brute(ids, ints @ ints.T, 2, 50)


def test_scores_are_sums_in_order(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    v = {r["vec_id"]: [float(x) for x in r["embedding"]] for r in df.collect()}
    for r in prefix_forest.search(df).collect():
        total = 0.0
        for a, b in zip(v[r["query_id"]], v[r["vec_id"]], strict=True):
            total += a * b
        assert r["score"] == total

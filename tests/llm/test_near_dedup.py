import itertools
import random
import re

import numpy as np
import pyarrow as pa

from fathomline.llm import near_dedup

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def brute(rows):
    sets = {}
    for i, t in rows:
        w = WORD.findall(bytes(c + 32 if 65 <= c < 91 else c for c in (t or "").encode()))
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    up = {i: i for i in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    ids = sorted(sets)
    for x, i in enumerate(ids):
        for j in ids[x + 1 :]:
            n = len(sets[i] & sets[j])
            if n and 100 * n >= 75 * (len(sets[i]) + len(sets[j]) - n) and root(i) != root(j):
                up[max(root(i), root(j))] = min(root(i), root(j))
    return {i: (len(sets[i]), root(i), root(i) == i) for i in ids}


def test_against_brute_force(spark):
    r = random.Random(2)
    words = ["".join(r.choice("abcdeé") for _ in range(r.randint(1, 7))) for _ in range(300)]
    say = lambda n: [r.choice(words) for _ in range(n)]
    rows, base = [], [say(n) for n in (4, 5, 6, 12, 40, 90, 300, 900)]
    for i in range(300):
        w = list(r.choice(base))
        for _ in range(r.choice([0, 0, 1, 2, 4, len(w) // 20])):
            w[r.randrange(len(w))] = r.choice(words)
        rows.append((1000 - i, " ".join(w).upper() if r.random() < 0.2 else "\t".join(w)))
    chain = say(200)
    for i in range(60):  # neighbours are similar, ends aren't
        rows.append((2000 + i, " ".join(chain)))
        k = r.randrange(190)
        chain[k : k + 4] = say(4)
    rows += [(3000 + i, " ".join(say(r.randint(0, 60)))) for i in range(80)] + [(4000, None), (4001, ""), (4002, " \n"), (4003, "a"), (4004, "A"), (4005, "w " * 30000)]
    got = {x[0]: tuple(x)[1:] for x in near_dedup.cluster(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    assert got == brute(rows)


def test_sketches_estimate_similarity():
    r = np.random.default_rng(1)
    for n in (1, 3, 30, 3000):
        x = r.integers(0, 2**63, 2 * n).astype(np.uint64)
        a, b = np.unique(x[: n + n // 2]), np.unique(x[n // 2 :])
        s = near_dedup.sketches(np.concatenate((a, b)), np.array([0, len(a), len(a) + len(b)]), 384)
        want = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert abs((s[0] == s[1]).mean() - want) < 0.11


def test_edges(spark):
    assert near_dedup.cluster(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    odd = spark.createDataFrame([(1, "a b", 0), (1, "a b", 1), (None, "a b", 2), (2, None, 3), (3, "A  b", 4)], "doc_id long, text string, cls int").selectExpr("*", "1 AS key", "2 AS label", "3 AS n")
    assert sorted(tuple(x) for x in near_dedup.cluster(odd).collect()) == [(1, 1, 1, True), (2, 0, 2, True), (3, 1, 1, False)]


def test_labels_of_a_cell_are_compared():
    sketch, bitmap = np.arange(24, dtype=np.uint16).tobytes(), bytes(near_dedup.BITMAP // 8)
    for labels in ([1, 1, 2, 2], [1, 2, 3], [1, 1, 2, 2, 3, 3], [1, 2, 2, 3, 3]):
        for order in set(itertools.permutations(labels)):
            m = len(order)
            rows = pa.table({"first": [0] * m, "second": [0] * m, "own": [0] * m, "cls": list(range(m)), "n": [9] * m, "label": list(order), "sketch": [sketch] * m, "bitmap": [bitmap] * m})
            pairs = near_dedup.alike(rows, 24, 75, False).to_pydict()
            want = {(i, j) for i, j in itertools.combinations(range(m), 2) if order[i] != order[j]}
            assert set(zip(pairs["a"], pairs["b"], strict=True)) == want and len(pairs["a"]) == len(want)
            assert near_dedup.alike(rows, 24, 75, True).num_rows == len(set(order)) - 1


def test_members_of_different_labels_meet_once(spark):
    r = random.Random(4)
    rows = [(k, k * 1000 + i, 9, label) for k, labels in enumerate(([1] * 90 + [2] * 30 + list(range(10, 50)), list(range(70)), [5] * 60, [1, 2], [1] * 9 + [2] * 9)) for i, label in enumerate(r.sample(labels, len(labels)))]
    members = spark.createDataFrame(rows, "key long, cls long, n long, label long").repartition(3)
    for block in (1, 7, 20, 1000):
        own, cell = {}, {}
        for x in near_dedup.cells(members, block).collect():
            cell.setdefault((x["key"], x["first"], x["second"]), []).append((x["own"], x["cls"], x["label"]))
            assert own.setdefault((x["key"], x["cls"]), x["own"]) == x["own"]
        met = [(a[1], b[1]) for (_, first, second), m in cell.items() for a, b in itertools.permutations(m, 2) if a[2] != b[2] and (a[0], b[0]) == (first, second) and (first != second or a[1] < b[1])]
        want = {tuple(sorted((a[1], b[1]))) for a, b in itertools.combinations(rows, 2) if a[0] == b[0] and a[3] != b[3]}
        assert len(met) == len(want) and {tuple(sorted(x)) for x in met} == want
        assert max(map(len, cell.values())) <= 2 * max(3 * block, block + 12)


def test_dense_families(spark, monkeypatch):
    for seed, block in ((1, 512), (2, 6)):
        monkeypatch.setattr(near_dedup, "BLOCK", block)
        monkeypatch.setattr(near_dedup.likely, "__defaults__", (block,))
        r = random.Random(seed)
        words = [f"w{i}" for i in range(900)]
        rows = []
        for f in range(25):
            base = [r.choice(words) for _ in range(90)]
            for _ in range(20):
                w = list(base)
                for k in r.sample(range(90), r.choice((1, 2, 3, 4))):
                    w[k] = r.choice(words)
                rows.append((len(rows), " ".join(w)))
        for parts in (2, 5):
            got = {x[0]: tuple(x)[1:] for x in near_dedup.cluster(spark.createDataFrame(r.sample(rows, len(rows)), "doc_id long, text string").repartition(parts)).collect()}
            assert got == brute(rows)

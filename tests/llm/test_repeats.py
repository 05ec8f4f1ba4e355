import hashlib
import random
import re

import numpy as np
from pyspark.sql import functions as F

from fathomline.llm import substring_dedup, suffix_dedup, superwindows

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def brute_bytes(rows, length):
    first, out = {}, {}
    texts = {i: (t or "").encode() for i, t in rows}
    for i in sorted(texts):
        for s in range(len(texts[i]) - length + 1):
            first.setdefault(texts[i][s : s + length], (i, s))
    for i, t in texts.items():
        gone = [False] * len(t)
        for s in range(len(t) - length + 1):
            if first[t[s : s + length]] < (i, s):
                gone[s : s + length] = [True] * length
        runs = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        kept = bytes(c for c, g in zip(t, gone) if not g)
        out[i] = (len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out


def brute_words(rows, length):
    docs = {i: WORD.findall((t or "").encode()) for i, t in rows}
    first = {}
    for i in sorted(docs):
        for s in range(len(docs[i]) - length + 1):
            first.setdefault(tuple(docs[i][s : s + length]), i)
    out = {}
    for i, w in docs.items():
        gone = [False] * len(w)
        for s in range(len(w) - length + 1):
            if first[tuple(w[s : s + length])] < i:
                gone[s : s + length] = [True] * length
        out[i] = (len(w), sum(gone), hashlib.sha256(b" ".join(x for x, g in zip(w, gone) if not g)).hexdigest())
    return out


def corpus():
    r = random.Random(5)
    words = ["".join(r.choice("abcdeé") for _ in range(r.randint(1, 7))) for _ in range(400)]
    say = lambda n: " ".join(r.choice(words) for _ in range(n))
    common, other = say(60), say(45)
    rows = []
    for i in range(140):
        text = say(r.randint(0, 80))
        if r.random() < 0.6:
            k = r.randint(0, 30)
            text += " " + " ".join(common.split()[k : k + r.randint(10, 45)]) + "\t" + say(r.randint(0, 20))
        if r.random() < 0.3:
            text += "\n" + other + "  " + other
        rows.append((i * 3, text))
    rows += [(1000 + i, rows[7][1]) for i in range(30)]
    for i in range(30):  # near copies
        w = rows[9][1].split(" ")
        w[r.randrange(len(w))] = "changed"
        rows.append((2000 - i, " ".join(w)))
    rows += [(3000, None), (3001, ""), (3002, "a" * 900), (3003, "a" * 100), (3004, "ab" * 400), (3005, " \n "), (3006, "x " * 50), (3007, "x " * 40)]
    rows += [(3008, say(3000) + " " + common), (4000, "  " + common + " "), (4001, common)]
    return rows


def test_bytes_against_brute_force(spark):
    rows = corpus()
    got = {r[0]: tuple(r)[1:] for r in suffix_dedup.digest(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    assert got == brute_bytes(rows, 100)


def test_words_against_brute_force(spark):
    rows = corpus()
    got = {r[0]: tuple(r)[1:] for r in substring_dedup.digest(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    assert got == brute_words(rows, 13)


def test_edges(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert suffix_dedup.digest(empty).count() == substring_dedup.digest(empty).count() == 0
    rows = [(1, "a b", 0), (1, "a b", 1), (None, "x", 2), (2, None, 3)]
    odd = spark.createDataFrame(rows, "doc_id long, text string, n_removed int").selectExpr("*", "1 AS start", "2 AS h", "3 AS runs")
    assert sorted(r[0] for r in suffix_dedup.digest(odd).collect()) == sorted(r[0] for r in substring_dedup.digest(odd).collect()) == [1, 2]


def test_hot_anchors_are_dealt_again(spark, monkeypatch):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for module, tokens, length, raw, brute in ((suffix_dedup, superwindows.byte_tokens, 100, True, brute_bytes), (substring_dedup, superwindows.word_tokens, 13, False, brute_words)):
        for hot, local in ((5, 10**6), (10**6, 3), (1, 1)):
            monkeypatch.setattr(superwindows, "HOT", hot)
            monkeypatch.setattr(superwindows, "LOCAL", local)
            asked = superwindows.found(docs, superwindows.texts_of(tokens), length, module.GRAM, raw).where("ask")
            assert not asked.where("hot").isEmpty()
            assert asked.where("not hot").isEmpty() or max(r["count"] for r in asked.where("not hot").groupBy("h").agg(F.countDistinct("doc_id", "start").alias("count")).collect()) <= max(hot, 40)
            assert {r[0]: tuple(r)[1:] for r in module.digest(docs).collect()} == brute(rows, length)


def test_refined_buckets(monkeypatch):
    r = np.random.default_rng(2)
    for slice_ in (1, 64, 1 << 19):
        monkeypatch.setattr(suffix_dedup, "SLICE", slice_)
        for letters, n, length in ((2, 400, 9), (3, 3000, 16), (1, 300, 100), (4, 5000, 100), (2, 50, 8)):
            text = r.integers(97, 97 + letters, n).astype(np.uint8)
            text[n // 2 :] = text[: n - n // 2]
            places = r.permutation(n - length + 1)[: n // 2]
            got = suffix_dedup.refined(text, places, length).tolist()
            whole = [text[p : p + length].tobytes() for p in places]
            assert [g == -1 for g in got] == [whole.count(w) == 1 for w in whole]
            assert len({*zip(got, whole, strict=True)} - {(-1, w) for w in whole}) == len({g for g in got if g >= 0}) == len({w for w in whole if whole.count(w) > 1})
    assert not len(suffix_dedup.refined(text, places[:0], 8))


def test_work_tables_are_cleared(spark):
    """Last in this file: a frame whose tables are gone can't be read, a new one can."""
    from pathlib import Path

    from fathomline.llm import frames

    at = Path(frames.work_folder(spark).removeprefix("file:"))
    kept = frames.written(spark.range(5))
    assert kept.count() == 5 and any(at.iterdir())
    frames.cleared(spark)
    assert not at.exists() and frames.written(spark.range(6)).count() == 6

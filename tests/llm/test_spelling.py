"""Spelling variants against plain Python, whose words are all compared with each other."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from fathomline.llm import spelling
from fathomline.llm.fm_index import Index, near


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_words(docs, damage=97):
    n = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if damage and h % damage == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}


def plain_groups(words):
    close = {w: [v for v in words if is_near(w, v)] for w in words}
    form = {}
    for w, vs in close.items():
        best = min(vs, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None
    out = set()
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, words[w], len(close[w]), words[form[w]] if form[w] is not None else None))
    return out


@pytest.mark.parametrize("seed", range(4))
def test_index_finds_each_pair_once(seed):
    r = random.Random(seed)
    words = sorted({tuple(r.randint(1, 3) for _ in range(r.randint(2, 12))) for _ in range(70)} | {(1,) * 40, (1,) * 39, (1,) * 20 + (2,) + (1,) * 19})
    index = Index([np.array(w) for w in words], 3)
    text, size = np.concatenate([np.array(w) for w in words]), np.array([len(w) for w in words])
    at, found = np.cumsum(size) - size, []
    for left, right in ((size // 2, 0 * size), (0 * size, size - size // 2)):
        half = (size - left - right) // 2
        for a, b in ((left + half, right), (left, size - left - half)):  # halves of halves
            some = np.flatnonzero(size - a - b > 0)
            q, w = near(index, text, at[some], size[some], a[some], b[some])
            found += [(words[some[i]], words[j]) for i, j in zip(q, w, strict=True)]
    assert len(found) == len(set(found))
    assert {frozenset(p) for p in found} == {frozenset((a, b)) for a in words for b in words if is_near(a, b)}


def test_groups_in_small_batches_and_hot_groups(spark):
    r = random.Random(9)
    words = {"".join(r.choice("abé") for _ in range(r.randint(5, 9))): r.randint(3, 400) for _ in range(700)}
    words |= {"prefix" + "".join(r.choice("xy") for _ in range(r.randint(3, 8))): r.randint(3, 9) for _ in range(400)} | {"a" * 200: 3, "a" * 199: 7}
    df = spark.createDataFrame([*words.items(), (None, 5)], "word string, n long")
    want = plain_groups(words)
    for hot, batch in ((1 << 20, 1 << 20), (900, 300)):
        assert {tuple(x) for x in spelling.group(df.repartition(3), hot=hot, batch_chars=batch).select("word", "form", "root", "n", "n_near", "form_n").collect()} == want
    assert spelling.group(df.limit(0)).count() == 0


def test_texts_against_plain_python(spark):
    r = random.Random(4)
    lexicon = ["".join(r.choice("abcdeéÉßÀ×") for _ in range(r.randint(1, 9))) for _ in range(60)]
    lexicon += [w + "s" for w in lexicon] + [w.upper() for w in lexicon]
    docs = [(i, " ".join(r.choice(lexicon) + r.choice(["", "-", "1", "…"]) for _ in range(r.randint(0, 200)))) for i in range(60)]
    docs += [(3, docs[0][1]), (None, docs[1][1]), (7, None), (8, ""), (9, "colour " * 50_000 + "color " * 7)]
    df = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, word string, n long").repartition(3)
    want = plain_groups(plain_words(docs))
    assert {tuple(x) for x in spelling.variants(df).select("word", "form", "root", "n", "n_near", "form_n").collect()} == want
    assert ("color", "colour", "colour", 7, 1) in {x[:5] for x in plain_groups(plain_words(docs, None))}
    assert spelling.variants(df.limit(0)).count() == 0

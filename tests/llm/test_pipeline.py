"""run() on the smallest tables against plain Python; the two models' verdicts come from their own operators."""

import hashlib
import re
from collections import Counter

import corpus_pipeline
from test_arrangement import shares
from test_near_dedup import brute

from fathomline.llm import packing, quality, secrets

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def redacted(spark, rows, schema):
    """Texts by id, each secret that the scan finds replaced."""
    texts = {r["doc_id"]: r["text"] for r in rows}
    for r in sorted(secrets.scan(spark.createDataFrame(rows, schema)).where("is_secret").collect(), key=lambda r: (r["doc_id"], -r["start"])):
        t = texts[r["doc_id"]]
        texts[r["doc_id"]] = t[: r["start"]] + "[secret]" + t[r["start"] + r["length"] :]
    return texts


def mixed(texts, source):
    """(doc_id, text) of each pass over a document and of the part at which its source is cut."""
    words, out = {i: WORD.findall(t) for i, t in texts.items()}, []
    total = Counter()
    for i in texts:
        total[source[i]] += len(words[i])
    for s, target in shares(total).items():
        budget = int(target + 0.5)
        whole, rest = divmod(budget, total[s]) if total[s] else (0, 0)
        for i in sorted((i for i in texts if source[i] == s), key=lambda i: (int(hashlib.md5(str(i).encode()).hexdigest()[:15], 16), i)):
            n, part = len(words[i]), min(len(words[i]), rest)
            rest -= part
            out += [(i, texts[i])] * (whole if n else 1)
            if part:
                out.append((i, texts[i] if part == n else " ".join(words[i][:part])))
    return out


def test_run_against_plain_python(spark):
    from tokenizers import Tokenizer

    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    good = {r["doc_id"] for r in quality.score(docs, labels).where("predicted = 1").collect()}
    rows = [r for r in docs.collect() if r["doc_id"] in good]
    kept = {i for i, (_, _, keep) in brute([(r["doc_id"], r["text"]) for r in rows]).items() if keep}
    rows = [r for r in rows if r["doc_id"] in kept]
    want = mixed(redacted(spark, rows, docs.schema), {r["doc_id"]: r["source"] for r in rows})
    t = Tokenizer.from_file(packing.vocabulary())
    tokens = Counter((i, (*t.encode(x, add_special_tokens=False).ids, packing.END)) for i, x in want)

    pieces = sorted(corpus_pipeline.run(spark, SF).collect(), key=lambda r: (r["sequence_id"], r["offset"]))
    at, got = 0, []
    for r in pieces:
        assert r["sequence_id"] * packing.WINDOW + r["offset"] == at and len(r["ids"]) == r["length"]
        at += r["length"]
        if not r["start"]:
            got.append((r["doc_id"], []))
        assert got[-1][0] == r["doc_id"] and len(got[-1][1]) == r["start"]
        got[-1][1].extend(r["ids"])
    assert Counter((i, tuple(x)) for i, x in got) == tokens
    assert len(want) > len(kept) > 0 and 0 < len(good) < docs.count()


def test_odd_tables(spark, tmp_path):
    """Nulls, empty and very long texts, repeated ids and rows, columns that no stage knows, and no rows at all; without labels all rows pass the first stage."""
    rows = [(1, "some words of a text", "en", "s", 20, "a"), (1, "some words of a text", "en", "s", 20, "b"), (None, "x", "en", "s", 1, "c"), (2, None, None, None, None, None), (3, "", "en", "t", 0, "d"), (4, "w " * 20000, "de", None, 40000, "e"), (5, "another text", "en", "t", 12, "f"), (6, " \n", "en", "t", 2, "g")]
    odd = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, `__turn` string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for at, docs in (("odd", odd), ("none", odd.limit(0))):
        docs.write.parquet(f"{tmp_path}/{at}/documents.parquet")
        labels.write.parquet(f"{tmp_path}/{at}/labels.parquet")
    kept = odd
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, f"{tmp_path}/odd").cache()
        assert kept.columns == odd.columns
        assert {r["doc_id"] for r in kept.collect()} <= {1, 2, 3, 4, 5, 6}
    assert {2, 3, 6} <= {r["doc_id"] for r in kept.collect()}
    pieces = corpus_pipeline.run(spark, f"{tmp_path}/odd").collect()
    assert sorted(r["doc_id"] for r in pieces if r["ids"] == [packing.END] and not r["start"]) == [2, 3, 6]
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0

"""Mixing, sharding, packing."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from fathomline.llm import mixing, packing, sharding

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def odd(spark):
    rows = [(1, "a b c", "s"), (1, "a b c", "s"), (None, "x", "s"), (2, None, None), (3, "", "t"), (4, "w " * 5000, None), (5, "q", None)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns({"size": F.lit("clash"), "target": F.lit(0), "shard": F.lit(1), "part": F.lit(2), "n": F.lit(3), "__key": F.lit(4), "__mine": F.lit("own"), "__range": F.lit(5), "mixed row": F.lit(6)})


def shares(sizes, share=1.5, most=2, weights=(3, 1, 2)):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w, cap, left, open_ = {s: weights[i % 3] for i, s in enumerate(order)}, {s: most * sizes[s] for s in order}, share * sum(sizes.values()), set(order)
    out = {}
    while open_:
        level = left / sum(w[s] for s in open_)
        over = {s for s in open_ if level * w[s] >= cap[s]}
        if not over:
            return out | {s: level * w[s] for s in open_}
        out |= {s: float(cap[s]) for s in over}
        left -= sum(cap[s] for s in over)
        open_ -= over
    return out


def test_mix_meets_its_targets(spark):
    for df in (docs(spark), odd(spark)):
        rows = mixing.mix(df).select("doc_id", "text", "source", "size", "source_size", "target", "taken").collect()
        assert len(rows) == df.count()
        total, taken = Counter(), Counter()
        for r in rows:
            assert r["size"] == len(WORD.findall(r["text"] or "")) and 0 <= r["taken"] <= 2 * r["size"]
            total[r["source"]] += r["size"]
            taken[r["source"]] += r["taken"]
        want = shares(total)
        for r in rows:
            assert r["source_size"] == total[r["source"]] and abs(r["target"] - want[r["source"]]) < 1e-6
        assert all(abs(taken[s] - want[s]) <= 0.5 for s in total)
        text = mixing.mixed_rows(df)
        assert text.columns == df.columns
        got = Counter()
        for r in text.collect():
            got[r["source"]] += len(WORD.findall(r["text"] or ""))
        assert got == taken


def test_mix_agrees_under_other_partitions(spark):
    one = sorted(mixing.mix(docs(spark)).select("doc_id", "taken").collect())
    assert one == sorted(mixing.mix(docs(spark).repartition(7)).select("doc_id", "taken").collect())
    assert mixing.mix(docs(spark).limit(0)).count() == mixing.mixed_rows(docs(spark).limit(0)).count() == 0


def test_shards(spark):
    for df in (docs(spark), odd(spark)):
        rows = sharding.shard(df).collect()
        slots = defaultdict(list)
        for r in rows:
            t = (r["text"] or "").encode()
            assert (r["size"], r["text_crc32"]) == (len(t) + 1, zlib.crc32(t))
            assert r["grown_shard"] in (r["shard"], 16) and 0 <= r["shard"] < 16
            slots[r["shard"]].append(r["slot"])
        assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    ids = spark.range(40_000).withColumn("doc_id", F.col("id")).withColumn("text", F.lit("x"))
    n = dict(sharding.shard(ids, [1.0, 3.0, 4.0]).groupBy("shard").count().collect())
    assert abs(n[1] / n[0] - 3) < 0.2 and abs(n[2] / n[0] - 4) < 0.3
    assert sharding.shard(docs(spark).limit(0)).count() == 0


def test_columns_stay(spark):
    mixed, sharded = mixing.mix(odd(spark)), sharding.shard(odd(spark))
    for out, new in ((mixed, ("source_size", "whole", "taken")), (sharded, ("text_crc32", "slot", "grown_shard"))):
        assert sorted(out.columns) == sorted([*odd(spark).columns, *new])
        assert {tuple(r) for r in out.select("__key", "__mine", "__range", "mixed row").collect()} == {(4, "own", 5, 6)}


def test_packing(spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(packing.vocabulary())
    more = spark.createDataFrame([(None, "x<|endoftext|>y é ́a b \x1cz   q It's ΣΑΣ ﻿."), (10**6, None), (10**6, ""), (10**6 + 1, "word" * 9000), (10**6 + 2, "a b " * 9000)], "doc_id long, text string")
    for df in (docs(spark).select("doc_id", "text").unionByName(more).repartition(3).cache(), more):
        pieces = packing.pack(df).cache()
        rows = pieces.collect()
        want = Counter((r["doc_id"], (*t.encode(r["text"] or "", add_special_tokens=False).ids, 1)) for r in df.collect())
        by_seq, whole = defaultdict(list), defaultdict(list)
        for r in rows:
            assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4")) and r["length"] == len(r["ids"])
            by_seq[r["sequence_id"]].append((r["offset"], r["length"]))
            whole[r["doc_id"], r["sequence_id"] * 2048 + r["offset"] - r["start"]].append((r["start"], r["ids"]))
        assert Counter((k[0], tuple(i for _, x in sorted(v) for i in x)) for k, v in whole.items()) == want
        assert sorted(by_seq) == list(range(len(by_seq)))
        for s, x in by_seq.items():
            x.sort()
            assert x[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(x, x[1:])) and (sum(x[-1]) == 2048 or s == len(by_seq) - 1)
        assert packing.sequences(pieces).where("size(ids) != 2048").count() == 0
    assert packing.pack(docs(spark).limit(0)).count() == 0


def test_tokenizers_of_other_rules(spark, tmp_path):
    import json
    from pathlib import Path

    from tokenizers import Tokenizer

    keeps_case = json.loads(Path(packing.vocabulary()).read_text(encoding="utf-8"))
    keeps_case["normalizer"] = None
    (tmp_path / "case.json").write_text(json.dumps(keeps_case), encoding="utf-8")
    r = np.random.default_rng(8)
    letters = [chr(c) for c in (*range(32, 127), *range(0xA0, 0x250), 0x301, 0x308, 0x3A3, 0x130, 0x2028, 0x3000, 0x4E2D, 0x1F600, 0x200D, 9, 10, 13)]
    rows = [(i, "".join(r.choice(letters, r.integers(0, 60)))) for i in range(300)] + [(900, "Don't THEY'LL 1234 ab12 <|endoftext|> x"), (901, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for path in (packing.vocabulary(), str(Path(packing.vocabulary()).with_name("byte_bpe_50k.json")), str(tmp_path / "case.json")):
        t, whole = Tokenizer.from_file(path), defaultdict(list)
        assert packing.Words.of(path).by_word == (path == packing.vocabulary())
        for x in sorted(packing.pack(df, path=path).collect(), key=lambda x: x["start"]):
            whole[x["doc_id"]] += x["ids"]
        assert dict(whole) == {i: [*t.encode(x or "", add_special_tokens=False).ids, 1] for i, x in rows}
    plan = packing.pack(df)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "hashpartitioning" not in plan

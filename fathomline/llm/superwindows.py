"""Repeated windows of a fixed length without a row for each position.

Every window of L tokens has one anchor: the q-gram with the least hash in it. Neighbouring windows mostly share theirs, so a document falls into runs of windows ("super-windows"), some 2/(L-q+2) of its length in number. Equal windows have equal anchors at equal distances, so runs are dealt out by the anchor's hash: a run whose anchor occurs nowhere else holds no repeated window and is final at once; runs that are equal throughout are settled by the order of their documents; and only runs that share an anchor but differ have to be compared token by token, which is left to the operator. Two runs count as equal if anchor and run have equal 64-bit hashes each.

Runs travel packed, a binary value for each pair of tasks, and copies of a run within a task are settled there: neither many documents nor large groups of copies make many rows. An anchor that many runs share in different surroundings is hot: its runs are dealt again by longer anchors, which tell those surroundings apart.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import Rolling, partitions, pieces, seeds, word_slices, BYTE_CODES, written

RUN = np.dtype([("h", "u8"), ("g", "u8"), ("doc", "i8"), ("base", "u4"), ("start", "u4"), ("n", "u2")])
PACKED = pa.schema([("part", pa.int32()), ("kind", pa.int8()), ("runs", pa.binary())])
#: What is packed: runs to settle by their anchor, runs that are settled, runs of anchors that are hot already.
OPEN, SETTLED, HEATED = range(3)
FOUND = "ask boolean, hot boolean, doc_id long, base long, start long, n long, h long"
#: A task packs what it has gathered from so many tokens.
FLUSH = 12 << 20
#: Differing runs of one anchor that are compared in one task, at most, and that a task sends on by the anchor; those of an anchor with more are dealt again by longer anchors.
HOT, LOCAL = 500, 32


def byte_tokens(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return BYTE_CODES[data], at


def word_tokens(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    begins, ends, words = word_slices(data, at)
    return Rolling(BYTE_CODES[data]).of(begins, ends), words


def runs_of(codes: np.ndarray, at: np.ndarray, ids: np.ndarray, length: int, q: int) -> np.ndarray:
    """The runs of some texts, whose tokens are codes[at[i]:at[i + 1]]; doc is ids[i], start counts from at[i]."""
    w = length - q + 1
    if len(codes) < length:
        return np.empty(0, RUN)
    if len(codes) >= 1 << 30:
        raise ValueError(f"a text of {len(codes)} tokens: places have 30 bits")
    rolling = Rolling(codes)
    grams = np.arange(len(codes) - q + 1)
    h = rolling.of(grams, grams + q)
    least = (h >> np.uint64(30) << np.uint64(30)) | grams.astype(np.uint64)  # 34 bits of hash, then the place: the first of equals
    have = 1
    while have < w:  # minima over 1, 2, 4, ... and last w grams
        step = min(have, w - have)
        least = np.minimum(least[:-step], least[step:])
        have += step
    sizes = np.maximum(np.diff(at) - length + 1, 0)
    if not sizes.sum():
        return np.empty(0, RUN)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    s = np.arange(len(doc)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + at[:-1][doc]
    m = (least[s] & np.uint64((1 << 30) - 1)).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], m[1:] != m[:-1])))
    n = np.diff(np.append(first, len(m)))
    begin, anchor = s[first], m[first]
    out = np.empty(len(first), RUN)
    out["h"], out["doc"], out["start"], out["n"] = h[anchor], ids[doc[first]], begin - at[:-1][doc[first]], n
    with np.errstate(over="ignore"):
        out["g"] = rolling.of(begin, begin + n - 1 + length) + (anchor - begin).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    return out


def marks(*columns: np.ndarray) -> np.ndarray:
    """Where rows in order start a new value of the columns."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return new


def settle(runs: np.ndarray, within: bool) -> tuple[np.ndarray, np.ndarray]:
    """Of equal runs: those that stay, and those of which an earlier one is known. within: a run of the same document counts as earlier too."""
    runs = runs[np.lexsort((runs["start"], runs["doc"], runs["g"], runs["h"]))]
    new = marks(runs["h"], runs["g"])
    if not within:
        lead = runs["doc"][np.flatnonzero(new)][np.cumsum(new) - 1] if len(runs) else runs["doc"]
        new = runs["doc"] == lead
    return runs[new], runs[~new]


def texts_of(tokens: Callable) -> Callable:
    """For batches of doc_id and text: tokens of runs of texts, where each text's start, ids, and the token of the document at which each begins."""

    def read(batch: pa.RecordBatch) -> Iterator[tuple]:
        ids = batch["doc_id"].to_numpy(zero_copy_only=False)
        for lo, data, at in pieces(batch["text"]):
            yield *tokens(data, at), ids[lo : lo + len(at) - 1], np.zeros(len(at) - 1, np.int64)

    return read


def passages_of(raw: bool, plain: bool) -> Callable:
    """The same for batches of doc_id, base and run (bytes if raw, else codes), as contents() returns them. plain: bytes stay bytes."""

    def read(batch: pa.RecordBatch) -> Iterator[tuple]:
        for lo in range(0, batch.num_rows, 5000):
            some = batch.slice(lo, 5000)
            runs = some["run"].to_pylist()
            codes = np.frombuffer(b"".join(runs), np.uint8 if raw else np.uint64)
            at = np.concatenate(([0], np.cumsum([len(x) for x in runs]))) // codes.itemsize
            yield BYTE_CODES[codes] if raw and not plain else codes, at, some["doc_id"].to_numpy(), some["base"].to_numpy()

    return read


def found(texts: DataFrame, read: Callable, length: int, q: int, within: bool) -> DataFrame:
    """A written table of spans (ask false): windows start to start + n - 1 of doc_id are repeats; and of runs to compare (ask true), with their anchor's hash h, their text's base, and whether the anchor is hot.

    An anchor that is common in a task's texts is hot at once: its runs don't travel by the anchor, whose task only hears of it. Another is hot if its task finds more than HOT differing runs.
    """
    parts, local, hot = partitions(texts.sparkSession), LOCAL, HOT

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, size = [], 0

        def flush():
            stay, known = settle(np.concatenate(kept), within)
            anchor, differs = marks(stay["h"]), marks(stay["h"], stay["g"])
            group = np.cumsum(anchor) - 1
            common = np.bincount(group, differs)[group] > local if len(stay) else anchor
            told = stay[common & anchor].copy()
            told["n"] = 0  # news of a hot anchor
            for kind, x in ((OPEN, np.concatenate((stay[~common], told))), (SETTLED, known), (HEATED, stay[common])):
                to = (x["g" if kind else "h"] >> np.uint64(11)) % np.uint64(parts)
                x = x[np.argsort(to, kind="stable")]
                cut = np.searchsorted(np.sort(to), np.arange(parts + 1, dtype=np.uint64))
                if full := [p for p in range(parts) if cut[p] < cut[p + 1]]:
                    yield pa.record_batch([pa.array(full, pa.int32()), pa.array([kind] * len(full), pa.int8()), pa.array([x[cut[p] : cut[p + 1]].tobytes() for p in full], pa.binary())], schema=PACKED)

        for batch in batches:
            for codes, at, ids, base in read(batch):
                x = runs_of(codes, at, np.arange(len(ids)), length, q)
                no = x["doc"].copy()
                x["doc"], x["base"], x["start"] = ids[no], base[no], x["start"] + base[no]
                kept.append(x)
                size += len(codes)
                if size >= FLUSH:
                    yield from flush()
                    kept, size = [], 0
        if kept:
            yield from flush()

    def rows(x: np.ndarray, ask: bool, hot: np.ndarray | bool = False) -> Iterator[pa.RecordBatch]:
        hot = np.broadcast_to(hot, len(x))
        for i in range(0, len(x), 50_000):
            y = x[i : i + 50_000]
            whole = [pa.array(np.ascontiguousarray(y[c]).view(np.int64) if c == "h" else y[c].astype(np.int64)) for c in ("doc", "base", "start", "n", "h")]
            yield pa.record_batch([pa.array(np.full(len(y), ask)), pa.array(hot[i : i + 50_000]), *whole], ["ask", "hot", "doc_id", "base", "start", "n", "h"])

    def resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = []
        for batch in batches:
            for kind, x in zip(batch["kind"].to_pylist(), batch["runs"], strict=True):
                x = np.frombuffer(x.as_buffer(), RUN)
                if kind == OPEN:
                    kept.append(x)
                else:
                    yield from rows(x, kind == HEATED, kind == HEATED)
        if not kept:
            return
        order = np.argsort(h := np.concatenate([x["h"] for x in kept]), kind="stable")
        h, again = h[order], np.zeros(len(h), bool)
        again[1:] = h[1:] == h[:-1]
        again[:-1] |= again[1:]
        twice = np.zeros(len(h), bool)
        twice[order] = again  # an anchor that occurs once is final
        ends = np.cumsum([len(x) for x in kept])
        runs = np.concatenate([x[twice[e - len(x) : e]] for x, e in zip(kept, ends, strict=True)])
        news = np.unique(runs["h"][runs["n"] == 0])
        stay, known = settle(runs[runs["n"] > 0], within)
        yield from rows(known, False)
        if len(stay):
            group = np.cumsum(marks(stay["h"])) - 1
            texts = np.bincount(group, marks(stay["h"], stay["g"]))[group]
            heated = np.isin(stay["h"], news) | (texts > hot)
            ask = heated | (texts > 1)
            yield from rows(stay[ask], True, heated[ask])

    packed = texts.mapInArrow(deal, "part int, kind byte, runs binary")
    return written(packed.repartitionById(parts, "part").mapInArrow(resolve, FOUND))


def contents(texts: DataFrame, asked: DataFrame, read: Callable, length: int, raw: bool, keys: list[str]) -> DataFrame:
    """The tokens of runs to compare: h, hot, doc_id, start, n, run (bytes if raw, else 64-bit codes). keys: columns that name a text."""
    wanted = asked.groupBy(*keys).agg(F.collect_list(F.struct("start", "n", "h", "hot")).alias("runs"))

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            edge, flat, no = batch["runs"].offsets.to_numpy(), batch["runs"].values, 0
            start, n, h, hot = (flat.field(k).to_numpy(zero_copy_only=False) for k in ("start", "n", "h", "hot"))
            for codes, at, ids, base in read(batch):
                out = []
                for i in range(len(ids)):
                    for j in range(edge[no + i], edge[no + i + 1]):
                        a = at[i] + start[j] - base[i]
                        out.append((h[j], hot[j], ids[i], start[j], n[j], codes[a : a + n[j] - 1 + length].tobytes()))
                no += len(ids)
                for k in range(0, len(out), 20_000):
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out[k : k + 20_000], strict=True), (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)], ["h", "hot", "doc_id", "start", "n", "run"])

    return texts.join(wanted, keys).mapInArrow(fetch, "h long, hot boolean, doc_id long, start long, n long, run binary")


def spans_of(docs: DataFrame, tokens: Callable, plain: Callable, length: int, q: int, raw: bool, within: bool, compare: Callable) -> DataFrame:
    """Spans doc_id, start, n of docs (doc_id, text; one row per id): windows start to start + n - 1 are repeats. plain: tokens as contents() keeps them, bytes if raw.

    compare gets all runs of an anchor in one task. Runs of hot anchors are dealt again by anchors twice as near to the window's length, and so on: anchors as long as the window leave nothing to compare.
    """
    texts, read, of, keys, out = docs.select("doc_id", "text"), texts_of(tokens), texts_of(plain), ["doc_id"], []
    while True:
        runs = found(texts, read, length, q, within)
        out.append(runs.where("not ask").select("doc_id", "start", "n"))
        asked = runs.where("ask")
        got = contents(texts, asked, of, length, raw, keys)
        last = asked.where("hot").isEmpty()
        got = got if last else written(got)
        out.append(got.where("not hot").select("h", "doc_id", "start", "n", "run").repartition(partitions(docs.sparkSession), "h").mapInArrow(compare, "doc_id long, start long, n long"))
        if last:
            break
        texts, q = got.where("hot").select("doc_id", F.col("start").alias("base"), "run"), (q + length + 1) // 2
        read, of, keys = passages_of(raw, False), passages_of(raw, True), ["doc_id", "base"]
    spans = out[0]
    for more in out[1:]:
        spans = spans.unionByName(more)
    return spans


def spans_by_document(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """docs with the list of their spans (doc_id, start, n), which may be null."""
    listed = spans.groupBy("doc_id").agg(F.collect_list(F.struct("start", "n")).alias("spans"))
    return docs.join(listed, "doc_id", "left")


def covered(size: int, start: np.ndarray, n: np.ndarray, length: int) -> np.ndarray:
    """A mask of the tokens within the windows that start at start to start + n - 1."""
    edge = np.zeros(size + 1, np.int64)
    np.add.at(edge, start, 1)
    np.add.at(edge, start + n - 1 + length, -1)
    return np.cumsum(edge[:-1]) > 0

"""Suffix-array dedup by bucket-pointer refinement.

The suffixes of a group of passages are bucketed by their first 8 bytes; each has a pointer, the place in order at which its bucket starts. A bucket with one member is final. Those left open are refined by sorting on the pointers of later offsets, 8 bytes on, then 16, 32 and so on up to the threshold; new pointers are written at once, so that buckets refined later in a round already sort by them. The order that results is that of a suffix array, in which suffixes that share their first `length` bytes are neighbours; neighbours are compared byte by byte, and of those that agree all but the earliest mark bytes to remove.

Passages are grouped by sampled suffixes, the anchors of superwindows.py, for a corpus has far too many suffixes to shuffle; the sample is such that no repeat of `length` bytes escapes it.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import one_per_id, pieces
from .superwindows import byte_tokens, covered, marks, spans_by_document, spans_of

LENGTH, GRAM = 100, 24
#: A comparison takes runs of so many bytes at once; all runs of an anchor stay together.
SHARD = 4 << 20
#: Suffixes of open buckets that are sorted at once, whole buckets at least.
SLICE = 1 << 19


def ordered(text: np.ndarray, eights: np.ndarray, length: int) -> np.ndarray:
    """Pointers of all suffixes of text, in the order of their first `length` bytes at least. eights: the 8 bytes from each place as a number."""
    n = len(text)
    order = np.argsort(eights, kind="stable")
    new = marks(eights[order])
    pointer = np.empty(n + 1, np.int64)
    pointer[n] = -1  # beyond the end
    pointer[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    alone = new & np.append(new[1:], True)
    open_, depth = order[~alone], 8  # members of open buckets, in order of bucket
    while depth < length and len(open_):
        edge = np.flatnonzero(marks(pointer[open_]))
        cuts = [*dict.fromkeys(edge[np.searchsorted(edge, range(0, len(open_), SLICE), "right") - 1].tolist()), len(open_)]
        left = []
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):  # whole buckets, the pointers of earlier slices renewed
            some = open_[lo:hi]
            key = pointer[some] * (n + 1) + pointer[np.minimum(some + depth, n)] + 1
            turn = np.argsort(key, kind="stable")
            some, key = some[turn], key[turn]
            first, new = marks(pointer[some]), marks(key)
            place = np.arange(len(some))
            pointer[some] += np.maximum.accumulate(np.where(new, place, 0)) - np.maximum.accumulate(np.where(first, place, 0))
            left.append(some[~(new & np.append(new[1:], True))])
        open_, depth = np.concatenate(left), 2 * depth
    return pointer[:n]


def refined(text: np.ndarray, places: np.ndarray, length: int) -> np.ndarray:
    """Buckets of the suffixes of text at places by their first `length` bytes, of which each has so many; -1 for one that is alone in its bucket."""
    n = len(text)
    padded = np.concatenate((text, np.zeros(8, np.uint8)))
    eights = np.zeros(n, np.uint64)
    for i in range(8):
        eights = (eights << np.uint64(8)) | padded[i : i + n]
    turn = np.argsort(ordered(text, eights, length)[places], kind="stable")
    at = places[turn]
    same = np.ones(max(len(at) - 1, 0), bool)
    for off in (*range(0, length - 8, 8), max(length - 8, 0)):
        same &= eights[at[1:] + off] == eights[at[:-1] + off]
    bucket = np.cumsum(np.concatenate((np.zeros(min(len(at), 1), bool), ~same)))
    out = np.empty(len(places), np.int64)
    out[turn] = np.where(np.bincount(bucket, minlength=1)[bucket] == 1, -1, bucket)
    return out


def _compare(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    if not (batches := [x for x in batches if x.num_rows]):
        return
    rows = pa.Table.from_batches(batches).sort_by("h").combine_chunks()
    doc, start, n, h = (rows[c].to_numpy() for c in ("doc_id", "start", "n", "h"))
    sizes = n - 1 + length
    ends = np.cumsum(sizes)
    group = np.flatnonzero(np.append(marks(h), True))
    lo = 0
    while lo < len(h):
        base = ends[lo] - sizes[lo]
        hi = group[np.searchsorted(group, lo, "right")]
        while hi < len(h) and ends[(nxt := group[np.searchsorted(group, hi, "right")]) - 1] - base <= SHARD:
            hi = nxt
        text = np.frombuffer(b"".join(rows["run"].slice(lo, hi - lo).to_pylist()), np.uint8)
        k = n[lo:hi]
        row = np.repeat(np.arange(hi - lo), k)
        off = np.arange(len(row)) - np.repeat(np.cumsum(k) - k, k)
        bucket = refined(text, (ends[lo:hi] - sizes[lo:hi] - base)[row] + off, length)
        row, off, bucket = row[bucket >= 0], off[bucket >= 0], bucket[bucket >= 0]
        place = start[lo:hi][row] + off
        order = np.lexsort((place, doc[lo:hi][row], bucket))
        late = order[~marks(bucket[order])]
        if len(late):
            late.sort()  # by row and place again, so that neighbours make one span
            d, p = doc[lo:hi][row[late]], place[late]
            new = np.flatnonzero(marks(row[late], p - np.arange(len(p))))
            yield pa.record_batch([pa.array(d[new]), pa.array(p[new]), pa.array(np.diff(np.append(new, len(p))))], ["doc_id", "start", "n"])
        lo = hi


def repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Spans doc_id, start, n of docs (doc_id, text; one row per id): the `length` bytes from each of start to start + n - 1 also start earlier."""
    return spans_of(docs, byte_tokens, lambda data, at: (data, at), length, gram, raw=True, within=True, compare=lambda b: _compare(b, length))


def dedup(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Removes each byte covered by a string of `length` bytes that starts earlier too (a smaller id, or the same document before it).

    Returns doc_id, n_bytes, removed (array of start and length, maximal runs) and kept (binary). A null text is empty; an empty text returns as it is. Rows with a null id take no part; of rows repeating an id the one with the greatest text counts. Other columns are not read.
    """
    docs = one_per_id(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), "doc_id", "text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = batch["spans"]
            edge, flat, none = spans.offsets.to_numpy(), spans.values, spans.is_null().to_numpy(zero_copy_only=False)
            start, n = (flat.field(k).to_numpy(zero_copy_only=False) for k in ("start", "n"))
            for lo, data, at in pieces(batch["text"]):
                out = []
                for i in range(len(at) - 1):
                    text, j = data[at[i] : at[i + 1]], lo + i
                    if none[j]:
                        out.append((len(text), [], text.tobytes()))
                        continue
                    gone = covered(len(text), start[edge[j] : edge[j + 1]], n[edge[j] : edge[j + 1]], length)
                    turn = np.flatnonzero(np.diff(np.concatenate(([0], gone.view(np.int8), [0]))))
                    out.append((len(text), [{"start": int(a), "length": int(b - a)} for a, b in turn.reshape(-1, 2)], text[~gone].tobytes()))
                yield pa.record_batch([batch["doc_id"].slice(lo, len(out)), pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))), pa.array([x[2] for x in out], pa.binary())], ["doc_id", "n_bytes", "removed", "kept"])

    return spans_by_document(docs, repeats(docs, length, gram)).select("doc_id", "text", "spans").mapInArrow(cut, "doc_id long, n_bytes long, removed array<struct<start:long,length:long>>, kept binary")


def digest(docs: DataFrame, **params) -> DataFrame:
    out = dedup(docs, **params)
    return out.select("doc_id", "n_bytes", F.aggregate("removed", F.lit(0).cast("long"), lambda a, x: a + x["length"]).alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))

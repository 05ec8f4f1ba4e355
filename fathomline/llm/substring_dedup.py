"""Substring dedup by suffix automata of reference shards.

Passages that may repeat (runs of windows that share an anchor, see superwindows.py) are dealt into shards. A shard's task builds the suffix automaton of the shard's passages, with the least document of each state, and streams the passages through it: the state that holds the last `length` words gives the least document in which they occur. Where that is a smaller document, the window's words go. A shard is broadcast to the rows dealt to it and not to all documents: automata of a whole corpus have no size bound.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import one_per_id, pieces, word_slices
from .superwindows import covered, marks, spans_by_document, spans_of, word_tokens

LENGTH, GRAM = 13, 5
#: Words of a shard; all passages of an anchor stay together.
SHARD = 100_000


class Automaton:
    """The suffix automaton of several sequences; each state knows the least document in which its strings end."""

    def __init__(self):
        self.next, self.link, self.len, self.doc = [{}], [-1], [0], [None]

    def add(self, words, doc: int) -> None:
        nxt, link, size, docs = self.next, self.link, self.len, self.doc
        last = 0
        for c in words:
            if c in nxt[last]:
                q = nxt[last][c]
                if size[q] == size[last] + 1:
                    last = q
                else:
                    last = self._clone(last, c, q)
            else:
                new = len(nxt)
                nxt.append({}), link.append(0), size.append(size[last] + 1), docs.append(None)
                p = last
                while p >= 0 and c not in nxt[p]:
                    nxt[p][c] = new
                    p = link[p]
                if p >= 0:
                    q = nxt[p][c]
                    link[new] = q if size[q] == size[p] + 1 else self._clone(p, c, q)
                last = new
            if docs[last] is None or doc < docs[last]:
                docs[last] = doc

    def _clone(self, p: int, c, q: int) -> int:
        new = len(self.next)
        self.next.append(dict(self.next[q])), self.link.append(self.link[q]), self.len.append(self.len[p] + 1), self.doc.append(None)
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = new
            p = self.link[p]
        self.link[q] = new
        return new

    def close(self) -> None:
        """What ends in a state ends in those it links to."""
        for s in sorted(range(1, len(self.len)), key=self.len.__getitem__, reverse=True):
            to, d = self.link[s], self.doc[s]
            if to > 0 and d is not None and (self.doc[to] is None or d < self.doc[to]):
                self.doc[to] = d

    def first_documents(self, words, length: int) -> list:
        """For each window of `length` words, the least document with it; None where it occurs in none."""
        nxt, link, size, docs = self.next, self.link, self.len, self.doc
        state, matched, out = 0, 0, []
        for i, c in enumerate(words):
            while state and c not in nxt[state]:
                state = link[state]
                matched = size[state]
            if c in nxt[state]:
                state = nxt[state][c]
                matched += 1
            while size[link[state]] >= length:
                state = link[state]
                matched = size[state]
            if i >= length - 1:
                out.append(docs[state] if matched >= length else None)
        return out


def _stream(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    if not (batches := [x for x in batches if x.num_rows]):
        return
    rows = pa.Table.from_batches(batches).sort_by("h").combine_chunks()
    doc, start, n, h = (rows[c].to_numpy() for c in ("doc_id", "start", "n", "h"))
    ends = np.cumsum(n - 1 + length)
    group = np.flatnonzero(np.append(marks(h), True))
    lo = 0
    while lo < len(h):
        base = ends[lo] - (n[lo] - 1 + length)
        hi = group[np.searchsorted(group, lo, "right")]
        while hi < len(h) and ends[(nxt := group[np.searchsorted(group, hi, "right")]) - 1] - base <= SHARD:
            hi = nxt
        runs = [np.frombuffer(x, np.uint64).tolist() for x in rows["run"].slice(lo, hi - lo).to_pylist()]
        shard = Automaton()
        for words, d in zip(runs, doc[lo:hi].tolist(), strict=True):
            shard.add(words, d)
        shard.close()
        out = []
        for words, d, s in zip(runs, doc[lo:hi].tolist(), start[lo:hi].tolist(), strict=True):
            repeated = [first is not None and first < d for first in shard.first_documents(words, length)]
            turn = np.flatnonzero(np.diff(np.array([0, *repeated, 0], np.int8)))
            out += [(d, s + int(a), int(b - a)) for a, b in turn.reshape(-1, 2)]
        if out:
            yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["doc_id", "start", "n"])
        lo = hi


def repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Spans doc_id, start, n of docs (doc_id, text; one row per id): the `length` words from each of start to start + n - 1 also occur in a document with a smaller id."""
    return spans_of(docs, word_tokens, word_tokens, length, gram, raw=False, within=False, compare=lambda b: _stream(b, length))


def dedup(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Removes each word covered by `length` consecutive words that also start in a document with a smaller id.

    Returns doc_id, n_words, n_removed and kept (binary: the words left, joined by one space). A null or blank text has no words. Rows with a null id take no part; of rows repeating an id the one with the greatest text counts. Other columns are not read.
    """
    docs = one_per_id(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), "doc_id", "text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = batch["spans"]
            edge, flat, none = spans.offsets.to_numpy(), spans.values, spans.is_null().to_numpy(zero_copy_only=False)
            start, n = (flat.field(k).to_numpy(zero_copy_only=False) for k in ("start", "n"))
            for lo, data, at in pieces(batch["text"]):
                begins, ends, words = word_slices(data, at)
                gone = np.zeros(len(begins), bool)
                for i in np.flatnonzero(~none[lo : lo + len(at) - 1]):
                    j = lo + i
                    gone[words[i] : words[i + 1]] = covered(words[i + 1] - words[i], start[edge[j] : edge[j + 1]], n[edge[j] : edge[j + 1]], length)
                stay = np.concatenate(([0], np.cumsum(~gone)))[words]
                sizes = (ends - begins)[~gone] + 1  # each word and a space
                to = np.concatenate(([0], np.cumsum(sizes)))
                flat_from = np.repeat(begins[~gone] - to[:-1], sizes) + np.arange(to[-1])
                body = np.append(data, np.uint8(32))[np.minimum(flat_from, len(data))]
                body[to[1:] - 1] = 32
                body = body.tobytes()
                kept = [body[to[a] : max(to[a], to[b] - 1)] for a, b in zip(stay[:-1], stay[1:], strict=True)]
                total = np.diff(words)
                yield pa.record_batch([batch["doc_id"].slice(lo, len(total)), pa.array(total, pa.int64()), pa.array(total - np.diff(stay), pa.int64()), pa.array(kept, pa.binary())], ["doc_id", "n_words", "n_removed", "kept"])

    return spans_by_document(docs, repeats(docs, length, gram)).select("doc_id", "text", "spans").mapInArrow(cut, "doc_id long, n_words long, n_removed long, kept binary")


def digest(docs: DataFrame, **params) -> DataFrame:
    return dedup(docs, **params).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))

"""Packing: concatenate and cut.

Documents are tokenized once, into a table in the shared folder, where each has its place in its partition's stream of tokens. Prefix sums of the partitions' token totals give global offsets; a second pass cuts each document at multiples of the window. A window that reaches over partitions is made of boundary records, pieces with the same sequence_id: no tokens have to be sent for it.
"""

import json
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .frames import pieces, written

WINDOW, END = 2048, 1
#: Offsets, 12 bytes a partition, that are broadcast at most; more are joined.
SENT = 2_000_000
#: Words that a Python process remembers, and how long those are at most. More make it no faster.
REMEMBERED, LONGEST = 200_000, 40


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


#: The rules under which texts can be cut into words first. A tokenizer file with others gets whole texts.
RULES = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [{"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True}, {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
}
#: Words of these characters alone, all but white space, apostrophes and bars of Latin script, are cut by PIECE as the tokenizer cuts them.
SIMPLE = re.compile("[!-&(-{}~\u00a1\u00ab\u00bb\u00bf-\u012f\u0131-\u017f]+").fullmatch
PIECE = re.compile(r"[^\W\d_]+|\d|(?:[^\w\s]|_)+").findall


def _byte_level() -> dict[int, str]:
    """Latin characters as the byte-level alphabet writes their lower case: bytes that print stand for themselves, the others for the characters from 256 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = (b for b in range(256) if b not in shown)
    letters = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return {c: "".join(letters[b] for b in chr(c).lower().encode()) for c in range(0x180)}


BYTE_LEVEL = _byte_level()


class Words:
    """Token ids of texts. Under RULES tokens never reach over white space, so that a word's ids can be remembered, and those of the pieces that it consists of; a task's Python process keeps them for the tasks after it."""

    kept: dict[str, "Words"] = {}

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            own = json.load(f)
        self.by_word = {k: own.get(k) for k in RULES} == RULES and own["model"]["type"] == "BPE" and not own["model"].get("dropout") and all("|" in t["content"] and not re.search(r"\s", t["content"]) for t in own["added_tokens"])  # words with a bar go to the tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation(), self.tokenizer.no_padding()
        if self.by_word:
            self.tokenizer.model._resize_cache(0)  # pieces are remembered here
        self.type = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.known: dict[str, bytes] = {}
        self.units: dict[str, bytes] = {}

    @classmethod
    def of(cls, path: str) -> "Words":
        if path not in cls.kept:
            cls.kept[path] = cls(path)
        return cls.kept[path]

    def _unit(self, piece: str) -> bytes:
        """The ids of a piece, which is one unit of the tokenizer's model."""
        ids = array(self.type.char, [t.id for t in self.tokenizer.model.tokenize(piece.translate(BYTE_LEVEL))]).tobytes()
        if len(self.units) < REMEMBERED and len(piece) <= LONGEST:
            self.units[piece] = ids
        return ids

    def _word(self, word: str) -> bytes:
        units = self.units
        if word.isascii() and word.isalpha():
            word = word.lower()
            return units[word] if word in units else self._unit(word)
        if not SIMPLE(word):
            return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, self.type).tobytes()
        return b"".join([units[p] if p in units else self._unit(p) for p in PIECE(word.lower())])

    def ids(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, each with `end` after it, and where each text's ids start (and the last end)."""
        if not self.by_word:
            got = [[*x.ids, end] for x in self.tokenizer.encode_batch(texts.to_pylist(), add_special_tokens=False)]
            return np.array([i for x in got for i in x], self.type), np.cumsum([0, *map(len, got)])
        split = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        at = np.asarray(split.offsets) - split.offsets[0].as_py()
        coded = split.flatten().dictionary_encode()
        known, codes = self.known, []
        for w in coded.dictionary.to_pylist():
            if (code := known.get(w)) is None:
                code = self._word(w)
                if len(known) < REMEMBERED and len(w) <= LONGEST:
                    known[w] = code
            codes.append(code)
        codes.append(np.array([end], self.type).tobytes())
        size = np.array([len(c) for c in codes]) // self.type.itemsize
        flat, first = np.frombuffer(b"".join(codes), self.type), np.cumsum(size) - size
        word = np.insert(np.asarray(coded.indices), at[1:], len(codes) - 1)
        to = np.concatenate(([0], np.cumsum(size[word])))
        return flat[np.repeat(first[word] - to[:-1], size[word]) + np.arange(to[-1])], to[at + np.arange(len(at))]


def tokenized(docs: DataFrame, path: str, end: int) -> DataFrame:
    """A written table: doc_id, n (tokens, with the end), ids (binary, little-endian unsigned 16 or 32 bit as the vocabulary needs), part and at, where the document starts in its partition's stream."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at, words = TaskContext.get().partitionId(), 0, None
        for batch in batches:
            words = words or Words.of(path)
            texts = batch["text"].fill_null("")
            for lo, _, edge in pieces(texts, 4 << 20):
                n = len(edge) - 1
                ids, cut = words.ids(texts.slice(lo, n), end)
                binary = pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(cut * words.type.itemsize), pa.py_buffer(ids)]).cast(pa.binary())
                yield pa.record_batch([batch["doc_id"].slice(lo, n), pa.array(np.diff(cut)), binary, pa.array(np.full(n, part, np.int32)), pa.array(at + cut[:-1]), pa.array(np.full(n, words.type.itemsize, np.int32))], ["doc_id", "n", "ids", "part", "at", "width"])
                at += int(cut[-1])

    return written(docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n long, ids binary, part int, at long, width int"))


def pack(docs: DataFrame, path: str | None = None, window: int = WINDOW, end: int = END, with_ids: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of documents in sequences of `window` tokens: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and with with_ids the piece's ids (array of int).

    A document is its tokens and the id `end`; only the last sequence may be shorter. A null or empty text is `end` alone. Rows that repeat an id, or have none, are packed each for itself. Other columns are not read.
    """
    table = tokenized(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), path or vocabulary(), end)
    totals = table.groupBy("part").agg(F.max(F.col("at") + F.col("n")).alias("tokens"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition
    offsets = written(totals.select("part", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("base")))
    if offsets.count() <= SENT:
        offsets = F.broadcast(offsets)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            edge = np.cumsum(batch["n"].to_numpy())
            lo = 0
            while lo < batch.num_rows:  # some documents of a million tokens together, one at least
                hi = max(lo + 1, int(np.searchsorted(edge, (edge[lo - 1] if lo else 0) + (1 << 20), "right")))
                yield pieces_of(batch.slice(lo, hi - lo))
                lo = hi

    def pieces_of(batch: pa.RecordBatch) -> pa.RecordBatch:
        place = batch["base"].to_numpy() + batch["at"].to_numpy()
        n = batch["n"].to_numpy()
        first = np.concatenate(([0], np.cumsum((place + n - 1) // window - place // window + 1)))
        doc = np.repeat(np.arange(len(n)), np.diff(first))
        seq = place[doc] // window + np.arange(len(doc)) - first[doc]
        begin = np.maximum(seq * window, place[doc])
        size = np.minimum((seq + 1) * window, (place + n)[doc]) - begin
        kinds = {w: np.dtype(f"<u{w}") for w in batch["width"].unique().to_pylist()}
        flat = np.concatenate([np.frombuffer(x.as_buffer(), kinds[w]).astype("<u4") for x, w in zip(batch["ids"], batch["width"].to_pylist(), strict=True)])
        at = np.concatenate(([0], np.cumsum(size)))  # a document's pieces follow each other, as its tokens do
        crc = [zlib.crc32(flat[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
        out = [batch["doc_id"].take(pa.array(doc)), pa.array(begin - place[doc]), pa.array(size), pa.array(crc, pa.int64()), pa.array(n[doc]), pa.array(seq), pa.array(begin - seq * window)]
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        if not with_ids:
            return pa.record_batch(out, names)
        return pa.record_batch([*out, pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(flat.view(np.int32)))], [*names, "ids"])

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return table.join(offsets, "part").select("doc_id", "n", "ids", "at", "width", "base").mapInArrow(cut, schema + (", ids array<int>" if with_ids else ""))


def sequences(pieces: DataFrame, window: int = WINDOW, pad: int = 0) -> DataFrame:
    """The sequences themselves: sequence_id and `window` ids, the last one padded. pieces: of pack, with ids; each group is one window."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    ids = F.flatten(F.transform(parts, lambda x: x["ids"]))
    return pieces.groupBy("sequence_id").agg(ids.alias("ids")).withColumn("ids", F.concat("ids", F.array_repeat(F.lit(pad), F.lit(window) - F.size("ids"))))

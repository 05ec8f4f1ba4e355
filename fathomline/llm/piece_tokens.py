"""SentencePiece encoding and decoding with a table of prefixes.

In byte-pair encoding that merges by scores a sequence of pieces is the encoding of its text just if each two neighbours are the encoding of theirs. So each prefix of a text has one last piece: of the pieces that end there, which an automaton finds, the one that is compatible with the last piece of the prefix before it. The table holds these, and the pieces of the whole are read from it backwards. Texts are cut into units, spaces and what follows up to the next, since no piece reaches over the start of a space's run; a process remembers the units that it has met.
"""

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
UNIT = re.compile(" +[^ ]*")
SEAM = re.compile("(?<! ) ")
#: Characters of a text that are taken together; the next seam between units ends them.
CHUNK = 1 << 20
#: Units and pairs that a process remembers, and how long those units are at most.
REMEMBERED, PAIRS, LONGEST = 400_000, 2_000_000, 40
#: Kinds of pieces in a model's file, and what an unknown piece and a byte that is no text decode to.
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
UNKNOWN_TEXT, NO_TEXT = " ⁇ ", "�"
#: In place of a piece: the start of a text.
START = (1 << 20) - 1


def model_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _checked(path: str):
    """The model as its library reads it; ValueError where its rules are others than those this module follows."""
    from sentencepiece import sentencepiece_model_pb2 as model

    with open(path, "rb") as f:
        m = model.ModelProto.FromString(f.read())
    t, n = m.trainer_spec, m.normalizer_spec
    kinds = {p.type for p in m.pieces}
    if t.model_type != t.BPE or not t.byte_fallback or t.treat_whitespace_as_suffix or n.precompiled_charsmap or n.remove_extra_whitespaces or not n.add_dummy_prefix or not n.escape_whitespaces or kinds - {NORMAL, UNKNOWN, CONTROL, BYTE}:
        raise ValueError(f"{path}: only BPE models with bytes for unknown characters, a dummy prefix and no other normalisation or kinds of pieces are followed")
    return m


class Pairs(dict):
    """Whether two pieces, first << 20 | second, may follow each other; what precedes a text goes with all. The oldest answers give way."""

    def __init__(self, pieces: "Pieces"):
        self.pieces = pieces

    def __missing__(self, key: int) -> bool:
        if len(self) >= PAIRS:
            self.clear()
        first = key >> 20
        fits = self[key] = first == START or self.pieces.compatible(first, key & START)
        return fits


class Pieces:
    kept: dict[str, "Pieces"] = {}

    def __init__(self, path: str):
        import ahocorasick

        m = _checked(path)
        self.text = [p.piece.replace(SPACE, " ") for p in m.pieces]
        self.kind = [p.type for p in m.pieces]
        self.score = {self.text[i]: p.score for i, p in enumerate(m.pieces) if p.type == NORMAL}
        self.id = {self.text[i]: i for i, p in enumerate(m.pieces) if p.type == NORMAL}
        self.byte = {int(p.piece[3:5], 16): i for i, p in enumerate(m.pieces) if p.type == BYTE}
        self.value = {i: b for b, i in self.byte.items()}
        self.letters = {x for x in self.id if len(x) == 1}
        if len(self.byte) != 256 or any(SEAM.search(x, 1) for x in self.id) or not self.letters.issuperset("".join(self.id)):
            raise ValueError(f"{path}: a piece reaches over the start of a word or has a character that is no piece")
        self.matches = ahocorasick.Automaton()
        for x, i in self.id.items():
            self.matches.add_word(x, (len(x), i))
        self.matches.make_automaton()
        self.pairs = Pairs(self)
        self.listed = [b"%d," % i for i in range(len(self.text))]
        self.plain = [x.encode() for x in self.text]
        self.units: dict[str, tuple[bytes, bytes]] = {}

    @classmethod
    def of(cls, path: str) -> "Pieces":
        if path not in cls.kept:
            cls.kept[path] = cls(path)
        return cls.kept[path]

    def compatible(self, a: int, b: int) -> bool:
        """Whether the text of two pieces encodes to just these: merging it, best score first and leftmost of equal ones, never joins over their seam."""
        seam, text, score = len(self.text[a]), self.text[a] + self.text[b], self.score
        cut = list(range(len(text) + 1))
        best = [score.get(text[i : i + 2]) for i in range(len(text) - 1)]  # of merging part i with the next
        while True:
            top = max((s for s in best if s is not None), default=None)
            if top is None:
                return True
            i = best.index(top)
            if cut[i + 1] == seam:
                return False
            del cut[i + 1], best[i]
            if i:
                best[i - 1] = score.get(text[cut[i - 1] : cut[i + 1]])
            if i < len(best):
                best[i] = score.get(text[cut[i] : cut[i + 2]])

    def _known_ids(self, text: str) -> list[int]:
        """Ids of a text whose characters are all pieces."""
        last = [-1] * len(text) + [START]  # of the prefix that ends with each character; the empty one at the end, which is index -1
        pairs = self.pairs
        for end, (size, piece) in self.matches.iter(text):
            if last[end] < 0 and pairs[last[end - size] << 20 | piece]:
                last[end] = piece
        ids, end = [], len(text) - 1
        while end >= 0:
            ids.append(last[end])
            end -= len(self.text[last[end]])
        return ids[::-1]

    def unit_ids(self, unit: str) -> list[int]:
        if self.letters.issuperset(unit):
            return self._known_ids(unit)
        ids, start = [], 0  # a character that is no piece joins nothing: it is its bytes
        for i, c in enumerate(unit):
            if c not in self.letters:
                ids += self._known_ids(unit[start:i]) + [self.byte[b] for b in c.encode()]
                start = i + 1
        return ids + self._known_ids(unit[start:])

    def parts(self, text: str) -> Iterator[list[str]]:
        """The units of a text, a bounded number of characters at a time; none of an empty text."""
        if not text:
            return
        text, start = " " + text.replace(SPACE, " "), 0
        while start < len(text):
            seam = SEAM.search(text, start + CHUNK)
            end = seam.start() if seam else len(text)
            yield UNIT.findall(text, start, end)
            start = end

    def ids(self, text: str) -> list[int]:
        return [i for units in self.parts(text) for u in units for i in self.unit_ids(u)]

    def decoded(self, ids: list[int], first: bool = True) -> str:
        """The text of ids: without the space before the first piece, bytes joined to characters. Control pieces have no text."""
        out, run = [], bytearray()
        for i in [*ids, None]:
            if i in self.value:
                run.append(self.value[i])
                continue
            if run:
                out.append(_characters(bytes(run)))
                run.clear()
                first = False
            if i is None or self.kind[i] == CONTROL:
                continue
            piece = UNKNOWN_TEXT if self.kind[i] == UNKNOWN else self.text[i]
            out.append(piece[1:] if first and piece[:1] == " " and self.kind[i] == NORMAL else piece)
            first = False
        return "".join(out)

    def remembered(self, unit: str) -> tuple[bytes, bytes]:
        """A unit's ids as text, each with a comma after it, and its decoded text."""
        ids = self.unit_ids(unit)
        whole = b"".join([self.plain[i] for i in ids]) if self.letters.issuperset(unit) else self.decoded(ids, first=False).encode()
        made = b"".join([self.listed[i] for i in ids]), whole
        if len(self.units) < REMEMBERED and len(unit) <= LONGEST:
            self.units[unit] = made
        return made

    def digest(self, text: str) -> tuple[int, str, str]:
        """Number of ids, and the sha256 of their list and of the decoded text."""
        n, ids, whole, units, first = 0, hashlib.sha256(), hashlib.sha256(), self.units, 1
        comma = b""
        for part in self.parts(text):
            made = [units[u] if u in units else self.remembered(u) for u in part]
            listed = b"".join([x for x, _ in made])
            n += listed.count(b",")
            ids.update(comma + listed[:-1])
            comma = b","
            whole.update(b"".join([x for _, x in made])[first:])
            first = 0
        return n, ids.hexdigest(), whole.hexdigest()


def _characters(run: bytes) -> str:
    """Bytes as text; each byte that begins no character is a replacement character."""
    try:
        return run.decode()
    except UnicodeDecodeError as e:
        return run[: e.start].decode() + NO_TEXT + _characters(run[e.start + 1 :]) if len(run) < 500 else "".join(_slowly(run))


def _slowly(run: bytes) -> Iterator[str]:
    at = 0
    while at < len(run):
        for size in (1, 2, 3, 4):
            try:
                yield run[at : at + size].decode()
                break
            except UnicodeDecodeError:
                continue
        else:
            size = 1
            yield NO_TEXT
        at += size


def encoded(text: Column | str, path: str | None = None) -> Column:
    """The ids of a text, array<int>, as the library gives them without begin and end; a null text has none, as an empty one."""
    path = path or model_file()

    @F.arrow_udf("array<int>")
    def run(texts: pa.Array) -> pa.Array:
        made = Pieces.of(path)
        return pa.array([made.ids(x.as_py() or "") for x in texts], pa.list_(pa.int32()))

    return run(text)


def decoded(ids: Column | str, path: str | None = None) -> Column:
    """The text of ids, as the library's decode gives it; of a null list an empty one. An id outside the vocabulary, or null, is an error."""
    path = path or model_file()

    @F.arrow_udf("string")
    def run(lists: pa.Array) -> pa.Array:
        made = Pieces.of(path)
        return pa.array([made.decoded(x.as_py() or []) for x in lists], pa.string())

    return run(ids)


def digest(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of decimal ids joined by commas), decoded_sha256 (of the text that the ids decode to): a row for each row of docs.

    A null text is an empty one: no ids. Rows that repeat an id, or have none, are each encoded. Texts of any length are taken a bounded number of characters at a time, so that no list of all ids is made. Other columns are not read.
    """
    path = path or model_file()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = Pieces.of(path)
            n, ids, text = zip(*(made.digest(x.as_py() or "") for x in batch["text"]), strict=True)
            yield pa.record_batch([batch["doc_id"], pa.array(n, pa.int64()), pa.array(ids), pa.array(text)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return narrow.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")

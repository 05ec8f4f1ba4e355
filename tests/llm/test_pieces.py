"""The prefix table against the library."""

import hashlib
import random

import pytest
import sentencepiece
from pyspark.sql import functions as F

from fathomline.llm import piece_tokens
from fathomline.llm.piece_tokens import Pieces, model_file


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=model_file())


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def row(library, text):
    ids = library.encode(text or "")
    return len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids))


TEXTS = [None, "", " ", "   ", "a", " a  b ", "x" * 5000, " " * 3000, "ab " * 40_000, "▁▁a▁b", "tab\tnew\nline\r", "日本語のテキスト", "🦜🦜 x", "éﬁ　", "<s></s><unk><0x0A>", "\x00\x7f", "Straße naïve Ünïcödé"]


def test_random_texts(library):
    pieces, r = Pieces.of(model_file()), random.Random(1)
    alphabet = "  ▁▁abcdeéñ日本🦜\t\n'<s></s><0x0A>́ﬁ"
    for text in [t for t in TEXTS if t] + ["".join(r.choice(alphabet) for _ in range(r.randint(0, 60))) for _ in range(3000)]:
        ids = library.encode(text)
        assert pieces.ids(text) == ids
        assert pieces.decoded(ids) == library.decode(ids)
        assert pieces.digest(text) == row(library, text)


def test_random_ids(library):
    pieces, r = Pieces.of(model_file()), random.Random(2)
    for _ in range(3000):
        ids = [r.choice([r.randrange(32000), r.randrange(3, 259), r.randrange(300)]) for _ in range(r.randint(0, 12))]
        assert pieces.decoded(ids) == library.decode(ids)
    bad = [pieces.byte[0xE2]] * 700
    assert pieces.decoded(bad) == library.decode(bad)


def test_chunks_and_forgetting(library, monkeypatch):
    monkeypatch.setattr(piece_tokens, "CHUNK", 7)
    monkeypatch.setattr(piece_tokens, "PAIRS", 5)
    monkeypatch.setattr(piece_tokens, "REMEMBERED", 3)
    pieces = Pieces(model_file())
    for text in [t for t in TEXTS if t and len(t) < 6000] + ["some  words and a longer   one " * 9]:
        assert pieces.digest(text) == row(library, text)


def test_tables(spark, library):
    df = spark.createDataFrame([(i if i != 3 else None, t, 1, "x") for i, t in enumerate(TEXTS)] + [(1, "again", 2, "y")], "doc_id long, text string, n_tokens int, units string").repartition(3)
    want = sorted((-1 if i == 3 else i, *row(library, t)) for i, t in enumerate(TEXTS)) + [(1, *row(library, "again"))]
    got = sorted((-1 if x[0] is None else x[0], *x[1:]) for x in map(tuple, piece_tokens.digest(df).collect()))
    assert got == sorted(want)
    both = df.withColumn("ids", piece_tokens.encoded("text")).withColumn("back", piece_tokens.decoded("ids")).collect()
    assert all(x["ids"] == library.encode(x["text"] or "") and x["back"] == library.decode(x["ids"]) for x in both)
    assert piece_tokens.digest(df.limit(0)).count() == 0
    assert df.limit(0).select(piece_tokens.encoded("text"), piece_tokens.decoded(F.array().cast("array<int>"))).count() == 0


def test_other_models_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2 as model

    with open(model_file(), "rb") as f:
        m = model.ModelProto.FromString(f.read())
    m.trainer_spec.model_type = m.trainer_spec.UNIGRAM
    (tmp_path / "other.model").write_bytes(m.SerializeToString())
    with pytest.raises(ValueError, match="BPE"):
        Pieces.of(str(tmp_path / "other.model"))

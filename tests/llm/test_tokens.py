import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from llm.cases import ODD, documents
from tokenizers import Tokenizer

from boardpulse.llm import piece_bpe, simple8b

BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def read(path):
    with open(path, "rb") as f:
        return f.read()


@pytest.fixture(scope="module")
def model():
    return piece_bpe.PieceModel(read(PIECES))


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


def random_texts(seed, alphabet, count, longest):
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(longest))) for _ in range(count)]


def test_pieces_equal_the_library(model, library):
    texts = random_texts(1, " ▁\n\tabcthe.,😀é①<>0\x00　", 4000, 14) + random_texts(2, "aehinrt ", 500, 200) + ["", "x" * 5000]
    assert [i.tolist() for i in model.encode(texts)] == library.encode(texts)


def test_both_agendas_agree(model):
    for text in random_texts(3, "▁aehinrtéß😀.", 500, 30):
        assert [p for p in model._popped(text) if p] == [p for p in model._scanned(text) if p]


def test_pieces_decode(model, library):
    rng = random.Random(4)
    for _ in range(3000):
        ids = [rng.randrange(32000) if rng.random() < 0.6 else rng.randrange(262) for _ in range(rng.randrange(8))]
        assert model.decode(ids) == library.decode(ids) == model.decode_all(pa.array([ids], pa.list_(pa.int32())))[0], ids
    assert model.decode_all(pa.array([None, [], [264]], pa.list_(pa.int32()))) == ["", "", "a"]


def test_wrong_ids_stop_the_job():
    broken = piece_bpe.PieceModel(read(PIECES))
    del broken.costs["▁the"]
    with pytest.raises(RuntimeError):
        broken.encode(["the house and the garden"])


def test_piece_query(odd, nothing, library):
    proto = read(PIECES)
    found = piece_bpe.with_text(piece_bpe.with_ids(odd.select("doc_id", "text", "h"), proto), proto).collect()
    expected = [(i, library.encode(t or ""), library.decode(library.encode(t or "")), "h") for i, t in ODD]
    assert sorted(map(repr, ((r.doc_id, r.ids, r.decoded, r.h) for r in found))) == sorted(map(repr, expected))
    both = piece_bpe.round_trip(odd.select("doc_id", "text", "h"), proto).collect()
    assert sorted(map(repr, ((r.doc_id, r.ids, r.decoded, r.h) for r in both))) == sorted(map(repr, expected))
    assert piece_bpe.with_text(piece_bpe.with_ids(nothing, proto), proto).collect() == []


@pytest.mark.parametrize("top", [1, 2, 9, 100, 5000, 2**16, 2**20 - 1, 2**20, 2**21, 2**40])
def test_words_round_trip(top):
    rng = np.random.default_rng(top)
    for size in (0, 1, 2, 3, 59, 240, 241, 5000):
        for share in (0.0, 0.05, 1.0):
            ids = rng.integers(0, top, size) * (rng.random(size) < share)
            words, escapes = simple8b.pack(ids)
            assert (simple8b.unpack(words, escapes, size) == ids.astype(np.uint64)).all()
    assert len(simple8b.pack(np.zeros(2400, np.int64))[0]) == 10


def test_segments_equal_the_library():
    encoder, library = simple8b.SegmentEncoder(read(BYTES)), Tokenizer.from_file(BYTES)
    texts = random_texts(5, " \n\tabcthe.,'s😀é①<0\x00　​\x1c\xa0\x85|-", 3000, 16)
    texts += random_texts(6, "ab ,'stmdrevl1\n", 5000, 20)
    texts += [t + "<|endoftext|> " + t for t in texts[::50]] + ["", " ", "'", "'s", "don't we'll", "x" * 50_000]
    found = encoder.encode(texts)
    assert [x.tolist() for x in found] == [[*library.encode(t, add_special_tokens=False).ids, 0] for t in texts]


def test_kept_segments_are_few(monkeypatch):
    """Segments lie in one array, and a worker that has met too many goes on with those at hand."""
    encoder, library = simple8b.SegmentEncoder(read(BYTES)), Tokenizer.from_file(BYTES)
    monkeypatch.setattr(simple8b, "KEPT_SEGMENTS", 40)
    for n in range(30):
        texts = [f"the {n} word{n % 7} {chr(1000 + n)} \0 é", f" x{n}\0", "", "the\nend's  <|endoftext|>", "日本 the"]
        assert [x.tolist() for x in encoder.encode(texts)] == [[*library.encode(t, add_special_tokens=False).ids, 0] for t in texts]
        assert len(encoder.numbers) < 80 and len(encoder.ends) == len(encoder.numbers) and len(encoder.ids) == encoder.ends[-1]


def test_files(spark, odd, nothing, tmp_path):
    library, at = Tokenizer.from_file(BYTES), 0
    rows = sorted(ODD, key=lambda r: (r[0] is not None, r[0] or 0))
    found = simple8b.id_digests(odd, read(BYTES)).orderBy("start").collect()
    assert [r.doc_id for r in found] == [r[0] for r in rows]
    texts = {}
    for i, t in rows:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 0]
        texts.setdefault(i, []).append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    for r in found:
        assert r.start == at
        texts[r.doc_id].remove((r.n_tokens, r.ids_crc32))
        at += r.n_tokens
    assert not any(texts.values())
    simple8b.write_ids(odd, read(BYTES), str(tmp_path / "ids"))
    held = sorted((r.doc_id is not None, r.doc_id or 0, r.ids) for r in simple8b.read_ids(spark, str(tmp_path / "ids")).collect())
    assert held == sorted((i is not None, i or 0, [*library.encode(t or "", add_special_tokens=False).ids, 0]) for i, t in ODD)
    assert simple8b.id_digests(nothing, read(BYTES)).collect() == []


def test_digest_of_known_ids(library):
    ids = library.encode("a  b")
    assert hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest() == hashlib.sha256(b"264,28705,287").hexdigest()

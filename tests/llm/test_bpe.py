"""BPE round trip and token files against the library on whole texts."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import zstandard
from tokenizers import Tokenizer

from tablefolio.llm import bpe, tokenfile
from tablefolio.llm.common import fresh_folder

PATH = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
PARTS = ["a", "b", "the", "ing", "er", " ", "\n", "\t", "'", "'s", "'ll", "!!", "7", "12", "é", "é", "ñ", "Ü", "İ", "中", "각",
         "😀", "<|endoftext|>", "<|startoftext|>", "<|", " ", "\x1c", "\x0b", "ß", "Σ", "ς", "ﬁ", "̧", "THE", "\x00", "²"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def texts():
    rng = random.Random(3)
    long = "".join(rng.choice("abcdefgh'é") for _ in range(5000))
    return [None, "", " \n ", "The cat's 12 cats.", "the  the\nthe", "the  the\nthe", long, long + " end", *(
        "".join(rng.choice(PARTS) for _ in range(rng.randint(1, 400))) for _ in range(60))]


def ids_of(library, text):
    return np.array(library.encode(text or "", add_special_tokens=False).ids, "<u4").tobytes()


@pytest.mark.parametrize("leaf_chars", [40, 32_768])
def test_round_trip_as_the_library(spark, odd, library, leaf_chars):
    source = texts()
    got = bpe.encode_decode(odd(source), PATH, leaf_chars=leaf_chars, keep=True).collect()
    assert len(got) == len(source)
    for r in got:
        ids = ids_of(library, source[r.doc_id])
        decoded = library.decode(np.frombuffer(ids, "<u4").tolist(), skip_special_tokens=False)
        assert bytes(r.ids) == ids and r.decoded == decoded and r.n_tokens == len(ids) // 4
        assert r.ids_sha256 == hashlib.sha256(ids).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


@pytest.mark.parametrize("window", [1, 16])
@pytest.mark.parametrize("unsplit", [False, True])
def test_tree_of_halves(monkeypatch, library, unsplit, window):
    monkeypatch.setattr(bpe, "WINDOW", window)
    codec, rng = bpe.Codec(PATH), random.Random(8)
    for _ in range(600):
        text = "".join(rng.choice("abinger's" if unsplit else PARTS) for _ in range(rng.randint(0, 150)))
        pieces = [codec.leaf(x) for x in codec.halves(text, rng.choice([3, 9, 30]))]
        assert codec.tree(pieces).ids.tolist() == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("window", [1, 4])
def test_tree_with_spans_at_the_ends_only(monkeypatch, library, window):
    """Long runs without a space, and windows that grow beyond what is known, take the spans of whole leaves."""
    monkeypatch.setattr(bpe, "WINDOW", window)
    codec, rng, partly = bpe.Codec(PATH), random.Random(10), 0
    for _ in range(300):
        text = "".join(rng.choice(PARTS + [" "] * 12 + ["aing's"] * 9) for _ in range(rng.randint(50, 250)))
        pieces = [codec.leaf(x, edge=12) for x in codec.halves(text, 60)]
        partly += sum(min(p.ends_known()) < len(p.ids) for p in pieces)
        assert all(p.ids.tolist() == library.encode(p.text, add_special_tokens=False).ids for p in pieces)
        packed = [bpe.Piece.unpack(p.text, p.pack()) for p in pieces]
        assert codec.tree(packed).ids.tolist() == library.encode(text, add_special_tokens=False).ids
    assert partly > 300


def test_words_as_whole_texts(library):
    """Words learned one by one in lower case give the ids of whole texts, whatever stands beside them."""
    codec, rng = bpe.Codec(PATH), random.Random(11)
    assert codec.by_word
    marks = ["'", "'S", "'T", "'rE", "''", "’s", "--", "_", ".", ",", "0", "42", "\x7f", "\x00", "\x1f", "\x85", "\u2028", "İ", "I\u0307",
             "E\u0301", "e\u0301", "ñ", "Ñ", "Word", "WORD", "it", "It's", "<|", "<|endoftext|>", "٣", "²", "K", "ſ", "Å", "ﬀ"]
    for _ in range(800):
        ascii_only = rng.random() < 0.5
        some = [m for m in marks if m.isascii()] if ascii_only else marks
        text = "".join(rng.choice([*some, " ", "\n", " "]) for _ in range(rng.randint(0, 40)))
        assert codec.encode([text.encode()]) == [ids_of(library, text)], text


def test_tree_for_a_tokenizer_that_keeps_white_space():
    codec, rng = bpe.Codec(BYTES), random.Random(9)
    assert not codec.by_unit
    for _ in range(300):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 150)))
        assert codec.tree([codec.leaf(x) for x in codec.halves(text, 30)]).ids.tolist() == codec.tok.encode(
            text, add_special_tokens=False).ids


def test_plain_words_ask_the_model_alone(library):
    """Words of Western letters, digits and signs need no normalizer and no pattern, and have the ids of whole texts."""
    codec, rng = bpe.Codec(PATH), random.Random(12)
    codec.tok = None
    source = [*bpe.PLAIN, "L'ÉTÉ, déjà vu: «¿Dónde?» – 12€ ½ Straße’s Œuvre's", *(
        "".join(rng.choice(bpe.PLAIN + " \n" * 30 + "aeinst'" * 20) for _ in range(rng.randint(1, 80))) for _ in range(500))]
    got = codec.encode([t.encode() for t in source])
    assert [g == ids_of(library, t) for g, t in zip(got, source, strict=True)] == [True] * len(source)


def test_memory_of_units_is_bounded(library):
    codec = bpe.Codec(PATH, memo_units=20)
    for k in range(20):
        text = " ".join("".join(random.Random(100 * k + j).choices("abcdefgh", k=6)) for j in range(7))
        assert codec.encode([text.encode()]) == [ids_of(library, text)]
        assert len(codec.memo) <= 10 and len(codec.old) <= 10


def test_token_files(spark, odd, library):
    source, ids = texts(), [5, 3, None, 3, 9, 9, *range(20, 20 + len(texts()) - 6)]
    folder = fresh_folder(spark, "test-ids")
    manifest = tokenfile.write_ids(odd(source, ids), folder, PATH, 2, parts=3).collect()
    got = sorted(tokenfile.read_ids(spark, folder, keep=True).collect(), key=lambda r: r.start)
    assert len(got) == len(source) == sum(m.docs for m in manifest)
    assert [r.doc_id for r in got] == sorted(ids, key=lambda i: (i is not None, i))
    want = sorted((i if i is not None else -1, ids_of(library, t) + b"\x02\0\0\0") for i, t in zip(ids, source, strict=True))
    assert sorted((r.doc_id if r.doc_id is not None else -1, bytes(r.ids)) for r in got) == want
    at = 0
    for r in got:
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(r.ids) // 4, zlib.crc32(bytes(r.ids)))
        at += r.n_tokens
    # one short document without the rest of its file
    some = next(m for m in manifest if m.docs)
    reader = tokenfile.Reader(folder, some.file)
    keys = [int(k) for k, none in zip(reader.index["id"], reader.index["none"], strict=True) if not none]
    assert reader.index["id"][reader.position(keys[-1])] == keys[-1]
    with pytest.raises(KeyError):
        reader.position(10**9)


def test_token_files_with_a_dictionary(spark, library):
    rows = [(i, " ".join(random.Random(i).choices(["the", "quick", "brown", "fox", "jumps"], k=300))) for i in range(400)]
    folder = fresh_folder(spark, "test-ids")
    tokenfile.write_ids(spark.createDataFrame(rows, "doc_id long, text string"), folder, PATH, 2)
    trained = tokenfile.at(folder)[0].open_input_file(tokenfile.at(folder)[1] + "/dictionary.zdict").read()
    assert zstandard.ZstdCompressionDict(trained).dict_id() > 0
    got = {r.doc_id: bytes(r.ids) for r in tokenfile.read_ids(spark, folder, keep=True).collect()}
    assert got == {i: ids_of(library, t) + b"\x02\0\0\0" for i, t in rows}


def test_empty_tables(spark, odd):
    assert bpe.encode_decode(odd([]), PATH).collect() == []
    folder = fresh_folder(spark, "test-ids")
    assert tokenfile.write_ids(odd([]), folder, PATH, 2).collect() == []
    assert tokenfile.read_ids(spark, folder).collect() == []

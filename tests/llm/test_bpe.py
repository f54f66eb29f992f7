"""Byte BPE against the public library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from fichario.llm import bpe
from fichario.llm.catalog import op5_bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", " ", "  \n\t x", "a", "it's 'S l'été <|endoftext|> x<|endoftext|>y", "\x1c\x85\xa0 a　b",
       "=" * 999, "中文😀é" * 50, "a\x00b", "12 345 6", "\n" * 50 + "a", " a" * 700]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encode():
    return bpe.Encoder(bpe.Vocabulary(PATH))


def ids_of(library, text):
    return library.encode(text, add_special_tokens=False).ids


def test_odd_texts_and_random_mixes(library, encode, monkeypatch):
    random.seed(2)
    bits = ["a", "aa", "the", "in", "=", "-", " ", "  ", "\n", "\t", "é", "中", "😀", "0", "'s", "'", "ING", "\x85"]
    mixes = ["".join(random.choices(random.sample(bits, 5), k=200)) for _ in range(300)]
    for window in (bpe.WINDOW_CHARS, 41):
        monkeypatch.setattr(bpe, "WINDOW_CHARS", window)
        for text in ODD + mixes:
            assert list(encode.ids(text)) == ids_of(library, text), text[:60]


def test_a_piece_of_any_length_leaves_in_stable_tokens(library, encode):
    random.seed(4)
    words = [b for b in encode.v.to_bytes.values() if b.isalpha()]
    for n in range(40):
        text = b"".join(random.choices(words, k=800)).decode() if n % 2 else "".join(
            random.choices("abcdeinrst"[:n % 10 + 1], k=4000))
        machine, most, out = bpe.Transducer(encode.v, 16), 0, []
        data = text.encode()
        for low in range(0, len(data), 7):
            out += machine.push(data[low:low + 7])
            most = max(most, len(machine.buffer))
        assert out + machine.finish() == ids_of(library, text)
        longest = max(map(len, encode.v.to_bytes.values()))  # a token may begin before the stable end
        assert most < 16 + encode.v.lookahead + longest
    for text in ("a" * 150_000, " " * 140_000 + "x", "-" * 70_000 + " é" * 3):
        assert list(encode.ids(text)) == ids_of(library, text)


def test_lookahead_of_small_lists():
    assert bpe.lookahead([], {0: 1, 1: 1}) == 1
    assert bpe.lookahead([(0, 1, 2)], {0: 1, 1: 1, 2: 2}) == 2
    # bc first: whether ab joins is known only when c has been seen
    assert bpe.lookahead([(1, 2, 3), (0, 1, 4)], {0: 1, 1: 1, 2: 1, 3: 2, 4: 2}) == 3


def test_decoder_waits_for_split_characters(library, encode):
    for text in ODD:
        decode = bpe.Decoder(encode.v)
        assert "".join(decode.push([i]) for i in encode.ids(text)) + decode.finish() == text
    ids = ids_of(library, "中文😀")
    for cut in range(len(ids) + 1):
        decode = bpe.Decoder(encode.v)
        assert decode.push(ids[:cut]) + decode.finish() == library.decode(ids[:cut], skip_special_tokens=False)


def test_whole_query(spark, library):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = op5_bpe(spark, folder).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = ids_of(library, texts[r.doc_id] or "")
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_nulls_repeats_clashing_columns_and_round_trip(spark):
    rows = [(1, None, 5), (None, "", 6), (1, "a  b", 7), (1, "a  b", 7), (2, "x" * 100_000, 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    tokens = bpe.tokenize(docs, PATH)
    assert tokens.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"]
    assert [r.n_tokens for r in tokens.collect()][:2] == [0, 0]
    back = [r.text for r in bpe.detokenize(tokens, PATH).collect()]
    assert sorted(back) == sorted(t or "" for _, t, _ in rows)
    assert bpe.tokenize(docs.limit(0), PATH).count() == 0


def test_short_pieces_are_merged_without_a_heap_and_like_long_ones(encode, monkeypatch):
    random.seed(6)
    made = [bytes(random.choices(b"aeinrst ", k=n)) for n in range(1, bpe.SHORT_BYTES + 1) for _ in range(20)]
    made += [random.randbytes(n) for n in range(bpe.SHORT_BYTES + 1)]
    long = [bpe._merge_long(encode.v, data) for data in made]
    monkeypatch.setattr(bpe.heapq, "heapify", None)
    assert [bpe.merge(encode.v, data) for data in made] == long


def test_letters_of_python_are_letters_of_the_pattern(encode):
    """A word of letters alone is taken for one piece without a search."""
    letters = "".join(filter(str.isalpha, map(chr, range(0x110000))))
    assert encode.cut.findall(" " + letters) == [" " + letters]

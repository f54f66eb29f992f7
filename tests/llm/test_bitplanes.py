"""Plane files: exact round trips, and the query against the public library."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from fichario.llm import bitplanes
from fichario.llm.catalog import op6_bitplanes

PATH = public_tokenizers.path("word_bpe_49k.json")


def want(docs):
    """docs: (doc_id, text) in order -> (doc_id, start, n_tokens, crc)."""
    library, start, rows = Tokenizer.from_file(PATH), 0, []
    for doc_id, text in docs:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        rows.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return rows


@pytest.mark.parametrize("planes", [4, 32])
@pytest.mark.parametrize("count", [0, 1, 7, 8, 9, 1000])
def test_planes_round_trip(planes, count):
    ids = np.random.default_rng(count).integers(0, 1 << 32, count, dtype=np.uint32)
    assert (bitplanes.from_planes(bitplanes.to_planes(ids, planes), count) == ids).all()


@pytest.mark.parametrize("planes", [4, 32])
def test_file_round_trip_and_ranges(tmp_path, planes):
    uri = f"file://{tmp_path}/x/a.bpl"
    rng = np.random.default_rng(1)
    docs = [rng.integers(0, 50_000, n, dtype=np.uint32) for n in (0, 3, 100, 99, 1, 555, 0, 64)]
    out = bitplanes.Writer(uri, planes, block=64)
    for n, ids in enumerate(docs):
        out.add(None if n == 2 else n, ids)
    assert out.close() == (8, sum(map(len, docs)))
    file, flat = bitplanes.Reader(uri), np.concatenate(docs)
    numbers, nulls, lengths = file.documents()
    assert lengths.tolist() == list(map(len, docs)) and nulls.tolist() == [0, 0, 1, 0, 0, 0, 0, 0]
    for start, count in ((0, len(flat)), (63, 2), (64, 64), (100, 333), (5, 0)):
        assert np.concatenate([np.empty(0, "<u4"), *file.ids(start, count)]).tolist() == flat[start:start + count].tolist()


def test_whole_query(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    assert sorted(map(tuple, op6_bitplanes(spark, folder).collect())) == want(map(tuple, docs))


def test_nulls_ties_and_odd_texts(spark):
    rows = [(2, "B  a\tz\x85q"), (None, "n"), (1, None), (3, ""), (2, "B  a\tz\x85q"), (1 << 62, "é<|endoftext|>É x" + "y" * 200),
            (5, " ".join(["Long"] * 70_000))]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, start int")
    manifest = bitplanes.write(docs, PATH)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    found = sorted(map(tuple, bitplanes.read(manifest).collect()), key=lambda r: r[1])
    assert found == want(order)
    library = Tokenizer.from_file(PATH)
    for r in bitplanes.ids_of(manifest).collect():
        text = dict(rows)[r.doc_id]
        assert r.ids == [*library.encode(text or "", add_special_tokens=False).ids, 1]
    empty = bitplanes.write(docs.limit(0), PATH)
    assert empty.count() == 0 and bitplanes.read(empty).count() == 0


def test_ids_of_composed_letters_and_marks():
    """Marks that compose with the small letter only, and words before one mark or several."""
    path = public_tokenizers.path("word_bpe_49k.json")
    library, own = Tokenizer.from_file(path), bitplanes.Encoder(path)
    pairs = ["J\u030c", "H\u0331", "T\u0308", "W\u030a", "Y\u030a", "K\u0331", "A\u0301", "E\u0316"]
    texts = [f"{p} x{p}. {p.lower()},{p[0]}" for p in pairs]
    texts += ["Word, word. WORD; word: a,b. É, é. ÉÀ! ñ? ß. 5. it's, 's. x.. x., . , ,. ÷. ×, <|endoftext|>, A<|x.",
              "don't. DON'T, we'll! ́, é. É, a\xa0b.  c, 日本, 日本. ı. İ, ς. Σ,", "a" * 500 + ", " + "B" * 70 + ".",
              "\ue000 a\ue000. \ue000\ue000 b", "Ærø ÀÉÎÕÜ ýþÿ Ðß× ÷ über-groß Ÿ ÿ µ ª º", "\u0301 \u030cJ \ue001 a\ue001,"]
    for text in (*texts, *texts, " ".join(texts)):
        found = np.frombuffer(own.encode([text])[0], "<u4").tolist()
        assert found == library.encode(text, add_special_tokens=False).ids

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from shopspan.llm.packing import Encoder, OpenBins, pack, pieces

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def reference():
    return Tokenizer.from_file(PATH)


def test_pieces():
    assert pieces(1, 4) == [1] and pieces(4, 4) == [4] and pieces(5, 4) == [1, 4] and pieces(8, 4) == [4, 4]


def test_best_fit_and_the_fullest_closes_first():
    bins = OpenBins(10, most=2)
    assert [bins.place(s) for s in (6, 7, 3, 4)] == [(0, 0), (1, 0), (1, 7), (0, 6)]
    assert bins.open == 0
    assert [bins.place(s) for s in (6, 8, 5)] == [(2, 0), (3, 0), (4, 0)]  # bin 3, with two free, closes
    assert [bins.place(s) for s in (2, 4, 3)] == [(2, 6), (4, 5), (5, 0)]


def test_random_pieces_against_a_list_of_bins():
    rng, bins, model, n = random.Random(1), OpenBins(64, most=5), [], 0
    for _ in range(3000):
        size = rng.randint(1, 64)
        fitting = [b for b in model if b[1] >= size]
        number, offset = bins.place(size)
        if fitting:
            free = min(b[1] for b in fitting)
            best = next(b for b in model if b[0] == number)
            assert best[1] == free and offset == 64 - free
            model.remove(best)
        else:
            assert (number, offset) == (n, 0)
            n, free = n + 1, 64
        if free > size:
            if len(model) == 5:
                tight = min(b[1] for b in model)
                gone = [b for b in model if b[1] == tight][-1]
                model.remove(gone)
            model.append((number, free - size))
        assert bins.open == len(model)


@pytest.mark.parametrize("text", [
    "Hello world's  it's\n\n\tfoo ", "　\x85\x1c a  b \x0b c", "🎉é ß²١٢٣", "a" * 5000, " " * 5000, "<|endoftext|> x", "\x00\x7f",
])
def test_ids_equal_the_tokenizer(reference, text):
    encode = Encoder(PATH)
    assert encode.fast is not None
    assert encode.ids(text).tolist() == reference.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", [
    " " * 2_000_000, "\n" * 2_000_000, "a" + " \n\t" * 700_000 + "b c", "x " + "\r\n" * 1_000_000, "\u3000" * 1_000_000 + "é", "ab" * 300_000,
])
def test_very_long_runs_equal_the_tokenizer(reference, text):
    assert np.array_equal(Encoder(PATH).ids(text), reference.encode(text, add_special_tokens=False).ids)


def test_long_white_space_is_packed(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, " " * 2_000_000), (3, None)], "doc_id long, text string").coalesce(1)
    got = pack(docs, PATH, with_ids=False).groupBy("doc_id").sum("length").collect()
    assert {r.doc_id for r in got} == {1, 2, 3}


def test_other_vocabularies_use_the_tokenizer():
    path = public_tokenizers.path("word_bpe_49k.json")
    encode = Encoder(path)
    assert encode.fast is None
    assert encode.ids("Some words").tolist() == Tokenizer.from_file(path).encode("Some words", add_special_tokens=False).ids


def test_round_trip(odd_docs, reference):
    got = pack(odd_docs, PATH).collect()
    fill = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == fill.get(r.sequence_id, 0)
        fill[r.sequence_id] = r.offset + r.length
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 and len(r.ids) == r.length
    assert max(fill.values()) <= 2048
    docs = [r for r in got if r.doc_id is not None and r.doc_id != 10]
    texts = {r.doc_id: r.text for r in odd_docs.collect()}
    for d in {r.doc_id for r in docs}:
        parts = sorted((r for r in docs if r.doc_id == d), key=lambda r: r.piece)
        assert [r.start for r in parts] == [sum(p.length for p in parts[:k]) for k in range(len(parts))]
        assert all(p.length == 2048 for p in parts[1:])
        ids = [i for p in parts for i in p.ids]
        assert ids == reference.encode(texts[d] or "", add_special_tokens=False).ids + [0]
    assert len({(r.doc_id, r.piece, r.sequence_id, r.offset) for r in got}) == len(got)


def test_dense_and_empty(spark, prose, odd_docs):
    docs = spark.createDataFrame([(d, prose(d, 20 + d)) for d in range(400)], "doc_id long, text string").coalesce(1)
    got = pack(docs, PATH, with_ids=False).collect()
    assert sum(r.length for r in got) / 2048 / len({r.sequence_id for r in got}) > 0.97
    assert pack(odd_docs.limit(0), PATH).count() == 0

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from shopspan.llm.tiers import CONTEXTS, ChunkEncoder, pack_tiers, powers_of_two, step_groups, windows_of

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def reference():
    return Tokenizer.from_file(PATH)


@pytest.mark.parametrize("text", [
    "Hello World's  it'LL\n\n\tfoo9912 don't", "　\x85\x1c a  b \x0b c\x1fd", "🎉é ß²١٢٣ ΣΑΣ İ", "é ́x á̧", "a" * 5000, " " * 500_000,
    "<|endoftext|> x", "<|STARTOFTEXT|>y", "x<|endoftext|>y", "\x00\x7f ​ x y﻿", "'s 'S ' s", "ﬁ Å ẛ̣ ǅ", "a_b-c (x).,;", "",
])
def test_ids_equal_the_tokenizer(reference, text):
    encode = ChunkEncoder(PATH)
    assert encode.by_chunk
    for _ in range(2):  # the second time from memory
        assert np.frombuffer(encode.ids(text), "<u4").tolist() == reference.encode(text, add_special_tokens=False).ids


def test_random_unicode_equals_the_tokenizer(reference):
    rng, encode = random.Random(3), ChunkEncoder(PATH)
    pools = [range(0x20, 0x7F), range(0xA0, 0x250), range(0x300, 0x370), range(0x370, 0x500), [0x20, 0x9, 0xA, 0x2003, 0x85, 0x1D],
             range(0x1100, 0x1200), range(0xAC00, 0xAC80), range(0x1F00, 0x2000)]
    for _ in range(400):
        text = "".join(chr(rng.choice(rng.choice(pools))) for _ in range(60))
        assert np.frombuffer(encode.ids(text), "<u4").tolist() == reference.encode(text, add_special_tokens=False).ids, repr(text)


def test_every_latin_character_equals_the_tokenizer(reference):
    encode = ChunkEncoder(PATH)
    for c in map(chr, range(1, 0x250)):
        for text in (c, f"a{c}b", f"{c}\u0301A", f"A{c}{c}1", f"don'{c}", f"{c}'s"):
            assert np.frombuffer(encode.ids(text), "<u4").tolist() == reference.encode(text, add_special_tokens=False).ids, repr(text)


def test_memory_of_chunks_is_bounded(reference):
    encode = ChunkEncoder(PATH)
    encode.chunks.most = encode.words.most = 10
    text = " ".join(f"w{k % 37}x{k % 11}" for k in range(500)) + " " + "y" * 100
    assert np.frombuffer(encode.ids(text), "<u4").tolist() == reference.encode(text, add_special_tokens=False).ids
    for memory in (encode.chunks, encode.words):
        assert len(memory.young) <= 10 and len(memory.old) <= 10


def test_other_vocabularies_are_encoded_whole():
    path = public_tokenizers.path("byte_bpe_50k.json")
    encode = ChunkEncoder(path)
    assert not encode.by_chunk
    assert np.frombuffer(encode.ids("Some words"), "<u4").tolist() == Tokenizer.from_file(path).encode("Some words", add_special_tokens=False).ids


def test_powers_of_two():
    assert [powers_of_two(n) for n in (0, 1, 12, 2047)] == [[], [1], [8, 4], [1024, 512, 256, 128, 64, 32, 16, 8, 4, 2, 1]]


@pytest.mark.parametrize("seed", range(6))
def test_windows_hold_every_token_once(seed):
    rng = random.Random(seed)
    longest = [3, 60, 300, 3000, 9000, 2048][seed]
    tokens = [rng.randint(1, longest) for _ in range(400)]
    windows = windows_of(tokens)
    seen = {}
    for size, window in windows:
        assert sum(p.length for p in window) == size and size & (size - 1) == 0
        for p in window:
            seen.setdefault(p.document, []).append((p.start, p.length))
    for d, n in enumerate(tokens):
        at = 0
        for start, length in sorted(seen[d]):
            assert start == at and length > 0
            at += length
        assert at == n
    odd = [s for s, _ in windows if s not in CONTEXTS]
    assert len(odd) == len(set(odd)) and sum(odd) < CONTEXTS[0]
    assert sum(len(p) - 1 for p in seen.values()) <= len(windows) + len(odd) + sum(n // 2048 for n in tokens)


def test_routing_and_filling():
    # 300 goes to the tier of 512 and takes 200 and 12; 100 and 156 fill the tier of 256; 1500 takes 548, the head of 600.
    windows = windows_of([300, 200, 12, 100, 156])
    assert [(s, sorted(p.length for p in w)) for s, w in windows] == [(512, [12, 200, 300]), (256, [100, 156])]
    windows = windows_of([1500, 600])
    assert [(s, [tuple(p) for p in w]) for s, w in windows] == [
        (2048, [(0, 0, 1500), (1, 0, 548)]), (32, [(1, 548, 32)]), (16, [(1, 580, 16)]), (4, [(1, 596, 4)]),
    ]
    assert windows_of([]) == []


def test_step_groups_are_even_in_number_and_cost():
    rng = random.Random(5)
    for n, size in ((1, 8), (7, 8), (8, 8), (83, 8), (400, 16)):
        costs = [rng.randint(1, 100) ** 2 for _ in range(n)]
        groups = step_groups(costs, size)
        counts, sums = {}, {}
        for g, c in zip(groups, costs):
            counts[g], sums[g] = counts.get(g, 0) + 1, sums.get(g, 0) + c
        assert sorted(counts) == list(range(max(n // size, 1)))
        assert max(counts.values()) - min(counts.values()) <= 1
        if n > 100:
            assert max(sums.values()) / min(sums.values()) < 1.25
    assert step_groups([], 8) == []


def test_round_trip(odd_docs, reference):
    got = pack_tiers(odd_docs, PATH, buffer_tokens=20_000).collect()
    fill, context, group = {}, {}, {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == fill.get(r.sequence_id, 0)
        fill[r.sequence_id] = r.offset + r.length
        assert context.setdefault(r.sequence_id, r.context) == r.context and group.setdefault(r.sequence_id, r.step_group) == r.step_group
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 and len(r.ids) == r.length
    assert fill == context and all(n <= 2048 and n & (n - 1) == 0 for n in fill.values())
    of_group = {}
    for s, g in group.items():
        of_group.setdefault(g, set()).add(context[s])
    assert all(len(c) == 1 for c in of_group.values())
    texts = {r.doc_id: r.text for r in odd_docs.collect()}
    for d in set(texts) - {None, 10}:
        parts = sorted((r for r in got if r.doc_id == d), key=lambda r: r.start)
        ids = [i for p in parts for i in p.ids]
        assert [p.start for p in parts] == [sum(q.length for q in parts[:k]) for k in range(len(parts))]
        assert ids == reference.encode(texts[d] or "", add_special_tokens=False).ids + [1]
        assert {p.doc_tokens for p in parts} == {len(ids)}
    n_rows = sum(r.doc_tokens if r.start == 0 else 0 for r in got)
    assert n_rows == sum(r.length for r in got)
    repeated = [r for r in got if r.doc_id == 10 and r.start == 0]
    assert len(repeated) == 2


def test_few_cuts_and_empty(spark, prose, odd_docs):
    docs = spark.createDataFrame([(d, prose(d, 5 + d)) for d in range(500)], "doc_id long, text string").coalesce(1)
    got = pack_tiers(docs, PATH, with_ids=False).collect()
    cut = {r.doc_id for r in got if r.length < r.doc_tokens <= 2048}
    assert len(cut) <= len({r.sequence_id for r in got})
    assert sum(r.context for r in got if r.offset == 0) == sum(r.length for r in got)
    assert pack_tiers(odd_docs.limit(0), PATH).count() == 0
    with pytest.raises(ValueError):
        pack_tiers(docs, PATH, contexts=(100,))

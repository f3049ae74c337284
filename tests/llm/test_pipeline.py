"""The stages against brute force on a small table."""

import random

import pytest
import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from tests.llm.test_hostquality import brute as quality
from tests.llm.test_neardup import brute as near_groups
from tests.llm.test_substring import brute as left_over


@pytest.fixture(scope="module")
def folder(spark, prose, vocabulary, tmp_path_factory):
    rng, path = random.Random(8), str(tmp_path_factory.mktemp("sf"))
    items = [(k, prose(50_000 + k, 30)) for k in range(5)]
    shared = [prose(60_000 + k, 60) for k in range(3)]
    rows = []
    for d in range(120):
        text = prose(d, rng.randint(30, 300))
        if d % 10 == 1:
            text = rows[-1][1]
        if d % 10 == 2:
            w = rows[-1][1].split()
            w[len(w) // 2] = rng.choice(vocabulary)
            text = " ".join(w)
        if d % 10 == 3:
            text += " " + rng.choice(shared) + " " + prose(d + 1000, 10)
        if d % 10 == 4:
            text += " " + rng.choice(items)[1]
        if d % 10 == 5:
            text = prose(d, 8) + " " + " ".join([prose(d + 7, 9)] * 6)
        if d % 10 == 6:
            text = "short one"
        rows.append((d, text, "en", f"src{d % 7}", len(text)))
    rows += [(500, None, None, None, None), (501, "", "en", "src1", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, rows, items


def test_registered():
    assert entry.queries()["pipeline"] is corpus_pipeline.run
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "near_dedup", "substring_dedup", "decontamination", "packing"]
    numbers = {int(q[2:].split("_")[0]) for q in entry.queries() if q.startswith("op") and q[2].isdigit()}
    assert numbers == set(range(1, 14))


def test_stages_equal_brute_force(spark, folder):
    path, rows, items = folder
    got = corpus_pipeline.run(spark, path).collect()
    hosts = {s: [r for r in rows if r[3] == s] for s in {r[3] for r in rows}}
    assert all(sum(quality(r[1])[5] for r in g) < len(g) / 2 for s, g in hosts.items() if s)
    docs = [(r[0], r[1]) for r in rows if not quality(r[1])[5]]
    groups = near_groups(docs, 5, 80)
    docs = [(d, t) for d, t in docs if groups[d] == d]
    docs = [(d, kept if removed else t) for (d, t), (_, removed, kept) in zip(docs, left_over([t for _, t in docs], 35))]
    docs = [(d, t) for d, t in docs if not any(i in t for _, i in items)]
    tokens = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found = {}
    for r in sorted(got, key=lambda r: r.piece):
        found.setdefault(r.doc_id, []).extend(r.ids)
    assert found == {d: tokens.encode(t, add_special_tokens=False).ids + [0] for d, t in docs}


def test_stages_keep_columns_and_take_odd_rows(spark, odd_docs, folder):
    path, docs = folder[0], odd_docs
    for name, stage in corpus_pipeline.STAGES:
        empty = stage(spark, odd_docs.limit(0), path)
        assert empty.count() == 0
        docs = stage(spark, docs, path)
        if name != "packing":
            assert docs.columns == empty.columns == odd_docs.columns
    assert docs.count() > 0


def test_a_copy_without_id_leaves_the_text(spark, odd_docs, folder):
    docs, copy = odd_docs, odd_docs.where("doc_id = 7").first().text
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder[0])
    assert [(r.doc_id, r.text) for r in docs.where("doc_id = 7 or doc_id is null").collect() if r.text in ("", copy)] == [(7, copy)]
    ids = [i for r in sorted(corpus_pipeline.packing(spark, docs, folder[0]).where("doc_id = 7").collect(), key=lambda r: r.piece) for i in r.ids]
    tokens = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert ids == tokens.encode(copy, add_special_tokens=False).ids + [0]

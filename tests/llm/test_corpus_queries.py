"""The registered corpus queries against their SQL, or against plain versions over whole tables."""

import base64
import hashlib
import zlib

import corpus_pipeline as pipeline
import public_tokenizers
import pytest
import tiktoken

import plain
from oracle import connect, differences
from tallybrook.llm import queries
from tallybrook.llm.bpe import read_ranks
from tallybrook.llm.common import stage


@pytest.fixture(scope="module")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, sf_dir, name):
    assert differences(queries.QUERIES[name](spark, sf_dir), connect(sf_dir), queries.ORACLES[name]) == []


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES if n != "pipeline") == list(range(1, 14))


def test_decontamination(spark, sf_dir, documents):
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()
    found = {(r.doc_id, r.item_id) for r in queries.QUERIES["op1_decontamination"](spark, sf_dir).collect()}
    texts = {d.doc_id: plain.words(d.text) for d in documents}
    seeds = {d: {tuple(w[i : i + 5]) for i in range(len(w) - 4)} for d, w in texts.items()}
    expected = set()
    for item in items:
        own = plain.words(item.text)
        grams = {tuple(own[i : i + 5]) for i in range(len(own) - 4)}
        for doc_id, held in seeds.items():
            if grams & held and sum(t[2] for t in plain.tiles(own, texts[doc_id])) >= 0.5 * len(own):
                expected.add((doc_id, item.item_id))
    assert found == expected and expected


def test_quality(spark, sf_dir):
    kept = {r.doc_id: r.keep for r in queries.QUERIES["op2_quality"](spark, sf_dir).collect()}
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").collect()
    right = [kept[r.doc_id] == bool(r.quality) for r in labels]
    assert sum(right) >= 0.97 * len(right)
    assert len(kept) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()


def test_shards(spark, sf_dir, documents):
    rows = queries.QUERIES["op3_shards"](spark, sf_dir).collect()
    texts = {d.doc_id: (d.text or "").encode() for d in documents}
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    sizes, slots = {}, {}
    for r in rows:
        assert (r.size, r.text_crc32, r.law) == (len(texts[r.doc_id]) + 8, zlib.crc32(texts[r.doc_id]), "bytes")
        assert r.grown_shard is None
        sizes[r.shard] = sizes.get(r.shard, 0) + r.size
        slots.setdefault(r.shard, []).append(r.slot)
    assert set(sizes) == set(range(24))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    target = sum(sizes.values()) / 24
    assert all(abs(s - target) <= max(r.size for r in rows) for s in sizes.values())
    place, at, total = sorted(rows, key=lambda r: (r.text_crc32, r.size, r.doc_id)), 0, sum(sizes.values())
    for r in place:
        assert r.shard == min(23, (2 * at + r.size) * 24 // (2 * total))
        at += r.size


def test_near_duplicates(spark, sf_dir, documents):
    found = {r.doc_id: (r.class_id, r.n_links) for r in queries.QUERIES["op6_ngram_join"](spark, sf_dir).collect()}
    expected = plain.near_duplicates([(d.doc_id, d.text) for d in documents])
    assert found == {d.doc_id: e for d, e in zip(documents, expected)}


def test_bpe(spark, sf_dir, documents):
    ranks = read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    found = {r.doc_id: r for r in queries.QUERIES["op8_byte_bpe"](spark, sf_dir).collect()}
    for d in documents:
        ids = library.encode_ordinary(d.text or "")
        r = found[d.doc_id]
        assert (r.n_tokens, r.ids_sha256) == (len(ids), plain.sha256(" ".join(map(str, ids)).encode()))
        assert r.decoded_sha256 == plain.sha256((d.text or "").encode())


def test_licences(spark, sf_dir, documents):
    lines = {
        "Licensed under the Apache License, Version 2.0.": "apache-2.0", "Released under the MIT License.": "mit",
        "This work is licensed under the GNU General Public License, version 3.": "gpl-3.0", "Licensed under CC BY-NC 4.0.": "cc-by-nc-4.0",
    }
    found = {r.doc_id: r.licences for r in queries.QUERIES["op9_licenses"](spark, sf_dir).collect()}
    for d in documents:
        assert found[d.doc_id] == sorted(name for line, name in lines.items() if line in d.text)


def test_suffixes(spark, sf_dir, documents):
    found = {r.doc_id: r for r in queries.QUERIES["op10_suffix_dedup"](spark, sf_dir).collect()}
    for d, (size, removed, spans, kept) in zip(documents, plain.cut([d.text for d in documents])):
        r = found[d.doc_id]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (size, removed, spans, plain.sha256(kept))
    left = plain.cut_passages([d.text for d in documents])
    assert {i for i, r in found.items() if r.n_passages} == {d.doc_id for d, t in zip(documents, left) if t is not None}
    for d, text in zip(documents, left):
        gone = 0 if text is None else len((d.text or "").encode()) - len(text.encode())
        assert found[d.doc_id].n_passage_bytes == gone


def test_warc_digest_by_hand(spark, sf_dir):
    page = spark.read.parquet(f"{sf_dir}/pages.parquet").orderBy("page_id").first()
    row = queries.QUERIES["op4_warc"](spark, sf_dir).where(f"page_id = {page.page_id}").first()
    assert row.payload_digest == base64.b32encode(hashlib.sha1(page.html.encode()).digest()).decode()


def test_pipeline(spark, sf_dir):
    """Each stage on what the stage before it kept, against the plain versions."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    kept = []
    for name, function in pipeline.STAGES:
        docs = stage(function(spark, docs, sf_dir), name)
        kept.append((name, docs.collect()))
    stages = dict(kept)
    assert all(list(rows[0].asDict()) == columns for _, rows in kept[:-1])

    good = [(r.doc_id, r.text) for r in stages["quality_classifier"]]
    classes = plain.near_duplicates(good)
    once = stages["ngram_jaccard_join"]
    assert sorted(r.doc_id for r in once) == sorted({c for c, _ in classes})
    by_id = dict(good)
    assert all(r.text == by_id[r.doc_id] for r in once)

    cut = {r.doc_id: r for r in stages["suffix_array_dedup"]}
    assert len(cut) == len(once)
    for r, left in zip(once, plain.cut_passages([r.text for r in once])):
        assert cut[r.doc_id].text == (r.text if left is None else left)
        if left is not None:
            assert cut[r.doc_id].n_chars == len(left)
    items = [plain.words(r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    clean = {r.doc_id for r in stages["benchmark_decontamination"]}
    for r in cut.values():
        own = plain.words(r.text)
        grams = {tuple(own[i : i + 5]) for i in range(len(own) - 4)}
        leaks = any(
            {tuple(i[k : k + 5]) for k in range(len(i) - 4)} & grams and sum(t[2] for t in plain.tiles(i, own)) >= 0.5 * len(i)
            for i in items
        )
        assert (r.doc_id in clean) != leaks
    tokens = {r.doc_id: r for r in stages["byte_level_bpe"]}
    assert set(tokens) == clean
    assert all(tokens[i].decoded_sha256 == plain.sha256(cut[i].text.encode()) for i in clean)

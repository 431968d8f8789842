"""Operators that SQL can't express, against brute-force versions, and the pipeline stage by stage."""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tidemark.llm import near_dup, packing, substring_dedup, token_files
from tidemark.llm.queries import QUERIES, tokenizer_path
from tidemark.llm.tokens import Encoder


@given(st.lists(st.integers(0, 2**32 - 1), max_size=900), st.sampled_from([1, 7, 50_000, 2**32]))
@settings(max_examples=60, deadline=None)
def test_token_segments_round_trip(ids, below):
    values = np.array([i % below for i in ids], dtype="<u4")
    assert (token_files.decode(token_files.encode(values)) == values).all()


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_equals_the_tokenizer(name):
    tokenizer, own = Tokenizer.from_file(tokenizer_path(name)), Encoder(tokenizer_path(name), most=40)
    parts = ["a", "The", "é", "é", "ß", "İ", "1", "'s", " ", "  ", "\n", "\t", "\r\n", "\x0b", "\xa0", "　", "\x1c", "!", "...", "<|endoftext|>", "<|", "中", "😀", "&&&"]
    random = np.random.default_rng(5)
    texts = ["".join(random.choice(parts, size=random.integers(0, 30))) for _ in range(3000)] + [None, ""]
    for start in range(0, len(texts), 100):
        some = texts[start : start + 100]
        want = [np.asarray(tokenizer.encode(t or "", add_special_tokens=False).ids, dtype="<u4").tobytes() for t in some]
        assert own.ids(some) == want


def test_token_files_query(spark, sf_dir):
    tokenizer = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect()
    got = {r.doc_id: r for r in QUERIES["op10_token_files"](spark, sf_dir).collect()}
    start = 0
    for d in docs:
        ids = np.asarray([*tokenizer.encode(d.text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        row = got[d.doc_id]
        assert (row.start, row.n_tokens, row.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def check_packing(rows, texts, size=2048):
    tokenizer = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    want = Counter()
    for doc_id, text in texts:
        ids = np.asarray([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        for piece, at in enumerate(range(0, len(ids), size)):
            part = ids[at : at + size]
            want[(doc_id, piece, at, len(part), zlib.crc32(part.tobytes()))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    bins: dict[int, list] = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in bins.values():
        end = 0
        for offset, length in sorted(held):
            assert offset == end
            end += length
        assert end <= size
    return len(bins), -(-sum(r.length for r in rows) // size)


def test_packing_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    used, least = check_packing(QUERIES["op6_packing"](spark, sf_dir).collect(), docs.collect())
    assert used <= 1.01 * least + 1


def test_packing_in_runs_and_odd_rows(spark):
    texts = [(i, "word " * (i * 37 % 3000)) for i in range(200)] + [(None, None), (7, "word"), (7, "word"), (8, "")]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(6)
    rows = packing.pack(docs, tokenizer_path("word_bpe_49k.json"), run_items=20, fan_in=2).collect()
    used, least = check_packing(rows, texts)
    assert used <= 1.1 * least + 1
    assert packing.pack(docs.limit(0), tokenizer_path("word_bpe_49k.json")).count() == 0


@given(st.lists(st.integers(1, 100), max_size=60))
@settings(max_examples=60, deadline=None)
def test_best_fit_fills_bins_without_overlap(lengths):
    bins, offsets, used = packing.best_fit(np.array(lengths, dtype=np.int64), 100)
    for b, total in enumerate(used.tolist()):
        held = sorted((offsets[i], lengths[i]) for i in range(len(lengths)) if bins[i] == b)
        end = 0
        for offset, length in held:
            assert offset == end
            end += length
        assert end == total <= 100


def test_quality_model_on_held_out_labels(spark):
    sf_dir = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    rows = [(labels[r.doc_id], r.kept) for r in QUERIES["op3_quality_model"](spark, sf_dir).collect() if r.doc_id in labels]
    assert np.mean([kept for q, kept in rows if q == 1]) > 0.97
    assert np.mean([kept for q, kept in rows if q == 0]) < 0.2


def test_sketch_estimates_and_merges():
    random = np.random.default_rng(1)
    for n in (1, 5, 400, 3000):
        for share in (0.5, 0.8, 1.0):
            both = random.integers(0, 2**63, int(n * 2 * share / (1 + share)) + 1, dtype=np.uint64)
            a, b = (np.unique(np.concatenate((both, random.integers(0, 2**63, max(n - len(both), 0), dtype=np.uint64)))) for _ in range(2))
            x, y = (near_dup.sketch(s, np.zeros(len(s), dtype=np.int64), 1)[0] for s in (a, b))
            union = np.union1d(a, b)
            merged = near_dup.sketch(union, np.zeros(len(union), dtype=np.int64), 1)[0]
            assert (merged == np.maximum(x, y)).all()
            true = len(np.intersect1d(a, b)) / len(union)
            got = near_dup.likely_similarity(np.array([(x > y).sum()]), np.array([(x < y).sum()]), np.array([float(len(a))]), np.array([float(len(b))]))[0]
            assert abs(got - true) < 0.15


def similar(texts, percent=80, size=2):
    """Components of doc_id -> text by all pairs of sets of shingles."""
    sets = {}
    for doc_id, text in texts.items():
        words = (text or "").encode().lower().split()
        k = min(size, len(words))
        sets[doc_id] = set(zip(*[words[i:] for i in range(k)])) if k else set()
    parent = {d: d for d in texts}

    def find(d):
        while parent[d] != d:
            d = parent[d]
        return d

    ids = sorted(d for d in sets if sets[d])
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            x, y = sets[a], sets[b]
            if min(len(x), len(y)) * 100 >= percent * max(len(x), len(y)):
                both = len(x & y)
                if 100 * both >= percent * (len(x) + len(y) - both):
                    low, high = sorted((find(a), find(b)))
                    parent[high] = low
    return {d: find(d) for d in texts}


def test_families_whose_members_are_linked_by_others(spark):
    """Copies of a base that are near it but not near each other, chains, and many equal texts."""
    random = np.random.default_rng(7)
    words = [f"w{i}" for i in range(5000)]
    texts, doc = {}, 1000
    for family in range(6):
        base = list(random.choice(words, 120))
        texts[doc + 900] = " ".join(base)
        for k in range(70):
            copy = list(base)
            for i in random.choice(120, 6, replace=False):
                copy[i] = f"x{doc}"
            texts[doc] = " ".join(copy)
            doc += 1
        chain = list(random.choice(words, 100))
        for k in range(15):
            chain[k * 6] = f"y{doc}"
            texts[doc] = " ".join(chain).upper()
            doc += 1
        doc += 1000
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    got = {r.doc_id: r.component_id for r in near_dup.link(df).collect()}
    assert got == similar(texts)


def test_packing_does_not_depend_on_how_texts_lie(spark):
    """Long texts first, then short ones that fit beside them, against the two taking turns."""
    long, short = " ".join(["a"] * 1300), " ".join(["a"] * 700)
    used = []
    for texts in ([long] * 300 + [short] * 300, [long, short] * 300):
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartitionByRange(6, "doc_id")
        rows = packing.pack(docs, tokenizer_path("word_bpe_49k.json")).collect()
        used.append(len({r.sequence_id for r in rows}))
    assert abs(used[0] - used[1]) <= 0.03 * used[1] and max(used) <= 1.05 * 300


def test_factors_cover_what_is_removed_and_point_to_the_same_words(spark):
    random = np.random.default_rng(3)
    words = [f"v{i}" for i in range(300)]
    passage = list(random.choice(words, 60))
    texts = {}
    for i in range(25):
        own = list(random.choice(words, 50))
        texts[i] = " ".join(own[:20] + passage[i % 7 : 55 - i % 5] + own[20:] + (own[:30] if i % 4 == 0 else []))
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    seen, split = {}, {d: t.split() for d, t in texts.items()}
    rows = {r.doc_id: r for r in substring_dedup.dedup(df).collect()}
    for d in sorted(texts):
        gone = np.zeros(len(split[d]), dtype=bool)
        for i in range(len(split[d]) - 19):
            key = tuple(split[d][i : i + 20])
            if key in seen:
                gone[i : i + 20] = True
            seen.setdefault(key, (d, i))
        assert rows[d].n_removed == gone.sum()
        assert rows[d].kept.split() == [w for w, g in zip(split[d], gone) if not g]
        covered = np.zeros(len(gone), dtype=bool)
        for f in rows[d].factors:
            assert f.words >= 20
            assert split[d][f.start : f.start + f.words] == split[f.from_doc][f.from_start : f.from_start + f.words]
            covered[f.start : f.start + f.words] = True
        assert (covered == gone).all()


def test_pipeline_stage_by_stage(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "lines", "near_dup", "mix", "pack"]
    before = {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, sf_dir)
        made.write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        rows = after.collect()
        if name != "pack":
            assert after.columns == columns
        if name == "quality":
            kept = {r.doc_id for r in QUERIES["op3_quality_model"](spark, sf_dir).where("kept").collect()}
            assert {r.doc_id: r.text for r in rows} == {d: before[d] for d in kept}
        elif name == "lines":
            first: dict[str, int] = {}
            for d in sorted(before):
                for line in (before[d] or "").split("\n"):
                    first.setdefault(fold(line), d)
            want = {}
            for d, text in before.items():
                keys = [(line, fold(line)) for line in (text or "").split("\n")]
                want[d] = "\n".join(line for line, key in keys if len(key) < 10 or first[key] == d)
            assert {r.doc_id: r.text for r in rows} == want
        elif name == "near_dup":
            groups = similar(before, size=corpus_pipeline.STAGE_SHINGLE)
            assert {r.doc_id: r.text for r in rows} == {d: before[d] for d in before if groups[d] == d}
        elif name == "mix":
            words = Counter()
            for r in rows:
                assert before[r.doc_id].startswith(r.text)
                words[r.doc_id] += len(r.text.encode().split())
            for d, text in before.items():
                assert words[d] <= 3 * len(text.encode().split())
            total = sum(len(t.encode().split()) for t in before.values())
            assert abs(sum(words.values()) - total) <= 0.02 * total
        else:
            used, least = check_packing(rows, texts)
            assert used <= 1.01 * least + 1
        if name != "pack":
            before, texts = {r.doc_id: r.text for r in rows}, [(r.doc_id, r.text) for r in rows]
        docs = after
    run = corpus_pipeline.run(spark, sf_dir)
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, run.select(*key).collect())) == sorted(map(tuple, docs.select(*key).collect()))


def fold(line: str) -> str:
    return line.strip(" \t\n\x0b\x0c\r").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))

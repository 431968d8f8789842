"""The near-duplicate stage against all pairs of five-word shingles."""

from __future__ import annotations

import corpus_pipeline


def kept_by_all_pairs(texts, size, percent=80):
    """The smallest id of each component of doc_id -> text."""
    sets = {}
    for doc_id, text in texts.items():
        words = (text or "").encode().lower().split()
        k = min(size, len(words))
        sets[doc_id] = set(zip(*[words[i:] for i in range(k)])) if k else set()
    lowest = {d: d for d in texts}

    def find(d):
        while lowest[d] != d:
            d = lowest[d]
        return d

    ids = sorted(d for d in sets if sets[d])
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                low, high = sorted((find(a), find(b)))
                lowest[high] = low
    return {d for d in texts if find(d) == d}


def test_stage_takes_shingles_of_five_words(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    want = kept_by_all_pairs(texts, 5)
    assert want != kept_by_all_pairs(texts, 2)
    stage = dict(corpus_pipeline.STAGES)["near_dup"]
    assert {r.doc_id for r in stage(spark, docs, sf_dir).collect()} == want

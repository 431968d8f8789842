"""The quality classifier of words against dictionaries, on other scripts, and per kind of junk."""

from __future__ import annotations

import math
import random
import sys
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import word_model
from tidemark.llm.common import Scratch
from tidemark.llm.queries import QUERIES


def plain_surprise(texts, order):
    """Mean -ln p of a text by interpolated modified Kneser-Ney over tokens, by dictionaries."""
    split = [["<s>"] * (order - 1) + word_model.tokens(t) for t in texts]
    levels = {order: Counter(tuple(w[i : i + order]) for w in split for i in range(len(w) - order + 1))}
    for k in range(order - 1, 0, -1):
        levels[k] = Counter(g[1:] for g in levels[k + 1])
    off, sums = {}, {}
    for k, level in levels.items():
        of = Counter(level.values())
        off[k] = [max(d, word_model.LEAST_DISCOUNT) for d in word_model.discounts(of[1], of[2], of[3], of[4])]
        for g, c in level.items():
            total, freed = sums.get(g[:-1], (0, 0.0))
            sums[g[:-1]] = (total + c, freed + off[k][min(c, 3) - 1])

    def p(g):
        if not g:
            return 1 / (len(levels[1]) + 1)
        lower, c = p(g[1:]), levels[len(g)].get(g, 0)
        if g[:-1] not in sums:
            return lower
        total, freed = sums[g[:-1]]
        return (c - off[len(g)][min(c, 3) - 1] if c else 0.0) / total + freed / total * lower

    def surprise(text):
        w = ["<s>"] * (order - 1) + word_model.tokens(text)
        made = [-math.log(p(tuple(w[i : i + order]))) for i in range(len(w) - order + 1)]
        return sum(made) / len(made) if made else None

    return surprise


@pytest.mark.parametrize("order", [2, 3])
def test_word_model_against_dictionaries(spark, order):
    texts = [(i, f"The cat {i % 7} sat on mat {i % 5}, and a dog {i % 11} ran.\nSo it was é.", "en") for i in range(60)]
    texts += [(100, "BUY NOW!!! the the the", "en"), (101, "", "en"), (102, None, None), (103, "zzz qqq", None), (104, "猫 坐 sat", "zh"), (105, " \n", "en")]
    texts += [texts[3], (3, "another text of one id", "en"), (None, "The cat sat", "en"), (None, "The cat sat", "en")]
    docs = spark.createDataFrame(texts, "doc_id long, text string, lang string").repartition(5)
    surprise = plain_surprise([t[1] for t in texts if t[0] is not None and t[0] < 60 and t[0] % 2], order)
    with Scratch(spark, "test") as scratch:
        table, base = word_model.model(docs.where("doc_id < 60 and doc_id % 2 = 1"), scratch, order)
        rows = word_model.scores(docs.select("doc_id", "lang", "text"), table, base, scratch, order).collect()
    assert len(rows) == len(texts)
    got = sorted(((str(r.doc_id), r.surprise) for r in rows), key=str)
    want = sorted(((str(i), surprise(t or "")) for i, t, _ in texts), key=str)
    for (doc, x), (same, y) in zip(sorted(got, key=lambda v: (v[0], v[1] or 0)), sorted(want, key=lambda v: (v[0], v[1] or 0))):
        assert doc == same and x == (y if y is None else pytest.approx(y, abs=1e-5))


def test_model_grows_with_the_trusted_words(spark):
    def rows(n):
        words = spark.range(n).select(F.concat_ws(" ", *[F.concat(F.lit(f"w{k}x"), "id") for k in range(10)]).alias("text"))
        with Scratch(spark, "test") as scratch:
            return word_model.model(words, scratch)[0].count()

    assert rows(2000) > 3.9 * rows(500)


def test_scripts_beyond_latin_are_told_apart(spark):
    """Greek and Cyrillic words that trusted texts have, against words of the same letters that none has."""
    random = np.random.default_rng(3)
    made = {}
    for lang, letters in (("el", "αβγδεζηθικλμνξοπρστυφχψω"), ("ru", "абвгдежзийклмнопрстуфхцчшщыэюя")):
        words = ["".join(random.choice(list(letters), random.integers(3, 9))) for _ in range(300)]
        made[lang] = [" ".join(random.choice(words, 60)) for _ in range(120)]
        made[lang] += ["".join(random.permutation(list(t.replace(" ", "")))) for t in made[lang][:40]]
        made[lang][120:] = [" ".join(t[i : i + 6] for i in range(0, len(t), 6)) for t in made[lang][120:]]
    rows = [(k + 1000 * n, t, lang) for n, (lang, texts) in enumerate(made.items()) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i, *_ in rows if i % 1000 < 120], "doc_id long, quality int, toxic int")
    kept = {r.doc_id for r in word_model.judge(docs, labels).where("kept").collect()}
    assert not [i for i in kept if i % 1000 >= 120]
    assert len(kept) > 0.97 * 240


def test_query_scores_words(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = {r.doc_id: r.n_grams for r in QUERIES["op3_quality_model"](spark, sf_dir).collect()}
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert rows == {r.doc_id: len(word_model.tokens(r.text)) for r in texts}


def kind_of_junk(text):
    words = text.split()
    if sum(a == b for a, b in zip(words, words[1:])) > 0.3 * len(words):
        return "repeated"
    if text.count("!!") > 5:
        return "shouted"
    return "bars" if text.count("|") > 0.1 * len(words) else "marks"


def test_each_kind_of_junk_goes(spark):
    sf_dir = "/root/testdata/sf0.01"
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    kinds: dict[str, list[bool]] = {}
    for r in QUERIES["op3_quality_model"](spark, sf_dir).collect():
        if quality.get(r.doc_id) is not None:
            kinds.setdefault("good" if quality[r.doc_id] == 1 else kind_of_junk(texts[r.doc_id]), []).append(r.kept)
    shares = {kind: round(float(np.mean(kept)), 3) for kind, kept in kinds.items()}
    print(shares, {kind: len(kept) for kind, kept in kinds.items()})
    assert shares.pop("good") > 0.97
    assert max(shares.values()) <= 0.1, shares


def test_without_labels_and_without_rows(spark):
    docs = spark.createDataFrame([(1, "some text", "en"), (2, None, "en"), (None, "a", None)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.doc_id: (r.kept, r.perplexity) for r in word_model.judge(docs, labels).collect()} == {1: (True, None), 2: (False, None), None: (True, None)}
    assert word_model.judge(docs.limit(0), labels).count() == 0
    assert word_model.keep_good(docs, labels).columns == docs.columns


@pytest.mark.parametrize("least", [1, 1000])
def test_limits_of_languages_with_few_trusted_texts(spark, least):
    """Kept by brute force: quantiles of the trusted second half, by language or of all, and the limit of repetition."""
    texts = [(i, f"The cat {i % 7} sat on mat {i % 5}, and a dog {i % 11} ran.", "en" if i % 3 else "de") for i in range(120)]
    texts += [(200, "the the the the the the the the", "en"), (201, "%% && qq zz ## 11", "de"), (202, "", "en"), (203, "cat mat", None)]
    docs = spark.createDataFrame(texts, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(120)], "doc_id long, quality int, toxic int")
    half = {r[0]: r[1] for r in spark.range(200).select("id", F.pmod(F.xxhash64("id"), F.lit(2))).collect()}
    surprise = plain_surprise([t for i, t, _ in texts if i < 120 and half[i] == 0], word_model.ORDER)
    held = [t for t in texts if t[0] < 120 and half[t[0]] == 1]

    def again(text):
        w = ["<s>", *word_model.tokens(text)]
        pairs = list(zip(w, w[1:]))
        return 1 - len(set(pairs)) / len(pairs)

    def limit(rows, measure):
        steps = sorted(math.ceil(round(measure(t) * 1000, 6)) for _, t, _ in rows)
        return steps[math.ceil(len(steps) * word_model.QUANTILE) - 1] / 1000

    def fair(text):
        return surprise(text) - word_model.SPREAD / math.sqrt(len(word_model.tokens(text)))

    rows = {r.doc_id: r for r in word_model.judge(docs, labels, least_trusted=least).collect()}
    assert len(rows) == len(texts)
    for i, text, lang in texts:
        own = [t for t in held if t[2] == lang]
        of = own if len(own) >= least else held
        if not text:
            assert not rows[i].kept
            continue
        most = limit(of, fair) + word_model.SPREAD / math.sqrt(len(word_model.tokens(text)))
        assert math.log(rows[i].most) == pytest.approx(most, abs=2.1e-3)
        if abs(surprise(text) - most) > 3e-3:
            assert rows[i].kept == (surprise(text) <= most and again(text) <= limit(of, again))


def test_hashes_are_those_of_spark(spark):
    made = word_model.keys("a b c", word_model._Hashes(), 3)
    pairs = [(int(c), int(t)) for c, t in zip(made[1].view(np.int64)[:-1], made[0].view(np.int64)[2:])]
    rows = spark.createDataFrame(pairs, "c3 long, g1 long").select(word_model._gram(3)).collect()
    assert [r[0] for r in rows] == made[2].view(np.int64).tolist()


def test_texts_share_rows_and_the_model_is_shuffled_once(spark):
    """A row per n-gram and occurrences, not per text; no pass shuffles the model, and it leaves no table behind."""
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.lit("en").alias("lang"), F.concat_ws(" ", *[F.lit("the cat sat")] * 9, "id").alias("text")).coalesce(1)
    grams = docs.select("doc_id", "doc_id", "text").toDF("a", "b", "text").mapInArrow(word_model._grams(2), word_model._GRAMS_SQL)
    assert grams.count() < 5 * 400
    with Scratch(spark, "test") as scratch:
        table, base = word_model.model(docs, scratch)
        sharded = scratch.buckets(table, "model", "key")
        plan = grams.join(sharded.hint("shuffle_hash"), "key")._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1
        rows = word_model.scores(docs, table, base, scratch).collect()
    assert len(rows) == 400 and all(r.n_grams == 28 and r.fresh == 5 for r in rows)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("test_")]


@pytest.mark.parametrize("window", [7, 1 << 18])
def test_hashes_are_of_the_tokens(monkeypatch, window):
    """Texts cut together have the tokens of the expression, and each token one hash wherever it stands."""
    monkeypatch.setattr(word_model, "_WINDOW", window)
    made = random.Random(5)
    some = [*"ab_9é!|. \n\t\0猫坐ひー・゠฿กิ가Жا", "e\u0301", "\u3000", "\x1c", "\ud800", "\U00020000", "\U0001f600"]
    texts = ["".join(made.choices(some, k=made.randint(0, 40))) for _ in range(2000)]
    texts += ["".join(map(chr, made.choices(range(0x110000), k=60))) for _ in range(500)] + [None, "", "x" * 50, "x" * 51]
    hashes, counts = word_model._Hashes().of(texts)
    split = [word_model.tokens(t) for t in texts]
    assert counts.tolist() == [len(t) for t in split]
    of = {}
    for token, value in zip([t for s in split for t in s], hashes.tolist()):
        assert of.setdefault(token, value) == value
    assert len(set(of.values())) == len(of)


def test_tokens_are_hashed_without_a_call_each():
    """What a text costs in Python calls does not grow with its tokens."""

    def calls(n):
        text = " ".join(f"w{i}" for i in range(n))
        word_model.keys(text, word_model._Hashes(), 2)
        made = Counter()
        hashes = word_model._Hashes()
        sys.setprofile(lambda frame, event, arg: made.update([event]))
        try:
            word_model.keys(text, hashes, 2)
        finally:
            sys.setprofile(None)
        return made["call"] + made["c_call"]

    assert calls(20_000) < 2 * calls(200)

"""Registered queries against their SQL, and edge cases that every operator has to define."""

from __future__ import annotations

import pytest
from compare import differences, duck

from tidemark.llm import (
    collocations, line_dedup, mixing, near_dup, packing, pii, quality_rules, ranked_search, substring_dedup, token_files, topk, url_filter,
    word_model,
)
from tidemark.llm.oracles import ORACLES
from tidemark.llm.queries import QUERIES, tokenizer_path

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = DOCS + ", rep long, doc long, row long, size long, kept boolean, whole string, n_words long, item long, taken long"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, sf_dir, name):
    assert differences(spark, duck(sf_dir), QUERIES[name], ORACLES[name], sf_dir) == ""


def odd_rows():
    long_text = " ".join(f"word{i % 7000}" for i in range(30_000))
    same = "the quick brown fox jumps over the lazy dog and runs away from the big bad wolf " * 4
    return [
        (1, None, None, None, None), (2, "", "en", "a", 0), (3, " \t\n\r ", "en", "a", 5), (4, long_text, "en", None, 1),
        (5, same, "en", "b", 1), (5, same, "en", "b", 1), (6, same, "xx", "b", 1), (None, same, "en", "b", 1),
        (7, "one", None, "c", 3), (5, "other text of the same id", "en", "b", 1), (8, "a b  c 😀 <|endoftext|> é", "en", "c", 9),
    ]


def per_document(spark, tmp_path):
    docs = spark.createDataFrame([(*r, 1, 2, 3, 4, True, "w", 7, 8, 9) for r in odd_rows()], CLASHING)
    none = spark.createDataFrame([], CLASHING)
    labels = spark.createDataFrame([(5, 1, 0), (5, None, 0), (None, 1, 0), (6, 1, 0), (4, 1, 1)], "doc_id long, quality int, toxic int")
    tokens = tokenizer_path("byte_bpe_50k.json")

    def written(df, number):
        token_files.write(df, str(tmp_path / f"tokens{number}"), tokens)
        return token_files.read(spark, str(tmp_path / f"tokens{number}"))

    makers = [
        near_dup.link, quality_rules.judge, lambda d: word_model.judge(d, labels), substring_dedup.dedup,
        mixing.mix, line_dedup.dedup, lambda d: written(d, id(d)), pii.find,
    ]
    return docs, none, makers


def test_odd_rows_give_one_row_each(spark, tmp_path):
    docs, none, makers = per_document(spark, tmp_path)
    ids = sorted((str(r[0]) for r in odd_rows()))
    for make in makers:
        assert sorted(str(r["doc_id"]) for r in make(docs).collect()) == ids
        assert make(none).count() == 0


def test_stage_forms_keep_columns(spark):
    docs = spark.createDataFrame([(*r, 1, 2, 3, 4, True, "w", 7, 8, 9) for r in odd_rows()], CLASHING)
    labels = spark.createDataFrame([(5, 1, 0)], "doc_id long, quality int, toxic int")
    for make in (near_dup.keep_one, line_dedup.clean, mixing.blend, lambda d: word_model.keep_good(d, labels)):
        assert make(docs).columns == docs.columns
        assert make(docs.limit(0)).count() == 0
        make(docs).collect()


def test_near_dup_of_odd_rows(spark):
    docs = spark.createDataFrame(odd_rows(), DOCS)
    rows = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in near_dup.link(docs).collect()}
    assert rows[(1, 0)] == (1, True) and rows[(2, 0)] == (2, True) and rows[(3, 0)] == (3, True)
    assert [v for k, v in rows.items() if k[0] == 6] == [(5, False)]
    assert [v for k, v in rows.items() if k[0] is None] == [(None, True)]
    assert rows[(7, 1)] == (7, True)


def test_lines_of_odd_rows(spark):
    docs = spark.createDataFrame(
        [(None, "Shared line one\nx"), (1, "shared LINE one \nkeep"), (2, "shared line one"), (2, "  shared line one"), (3, None), (4, "short\nshort"), (5, "short")],
        "doc_id long, text string",
    )
    rows = sorted((str(r.doc_id), r.n_lines, r.n_dropped, r.kept) for r in line_dedup.dedup(docs).collect())
    assert rows == sorted([
        ("None", 2, 0, "Shared line one\nx"), ("1", 2, 1, "keep"), ("2", 1, 1, ""), ("2", 1, 1, ""), ("3", 1, 0, ""),
        ("4", 2, 0, "short\nshort"), ("5", 1, 0, "short"),
    ])


def test_hot_line_over_many_ranges(spark):
    rows = [(i, f"a line that everybody has\nown line number {i}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = line_dedup.dedup(docs).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert {r.doc_id: r.n_dropped for r in got} == {i: int(i > 0) for i in range(3000)}


def test_topk_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [0.5, 0.5]), (50, [0.25, -0.5]), (3, [0.5, 0.5]), (2, [0.5, 0.5]), (2, [0.5, 0.5]), (9, None), (10, [None, 1.0]),
        (11, [nan, 1.0]), (12, [inf, 1.0]), (100, [nan, 0.0]), (None, [1.0, 1.0]), (13, [1.0, 2.0, 3.0]), (14, []), (150, []),
    ]
    vectors = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, score int")
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in topk.search(vectors).collect())
    assert got == [
        (0, 1, 2, 32768), (0, 2, 2, 32768), (0, 3, 3, 32768), (0, 4, 50, -8192),
        (50, 1, 0, -8192), (50, 2, 2, -8192), (50, 3, 2, -8192), (50, 4, 3, -8192), (150, 1, 14, 0),
    ]
    assert topk.search(vectors.limit(0)).count() == 0


def test_url_filter_against_plain_ranks(spark):
    pages = [
        (1, "http://a.com/x", '<a href="http://B.net/x">'), (2, "http://b.net/en/", "<a href=//c.org/>"), (3, "nope", ""), (4, None, None),
        (5, "http://d.org?x", '<a href="https://bad.example.com/en/1"><a href="/own">'), (6, "http://bad.example.com/en/", None),
        (7, "http://c.org#f", '<img src="http://a.com/i">'), (8, "http://www.example.com/en/z", None), (9, "http://X.net/fr/", None),
    ]
    df = spark.createDataFrame([(*p, "h") for p in pages], "page_id long, url string, html string, host string")
    rows = {r.page_id: r for r in url_filter.judge(df).collect()}
    assert {k: (r.host, r.path, r.rule, r.verdict) for k, r in rows.items()} == {
        1: ("a.com", "/x", "com/", "allow"), 2: ("b.net", "/en/", None, "allow"), 3: ("", "", None, "allow"), 4: ("", "", None, "allow"),
        5: ("d.org", "", None, "block"), 6: ("bad.example.com", "/en/", "example.com/en/", "block"), 7: ("c.org", "", None, "allow"),
        8: ("www.example.com", "/en/z", "www.example.com/en/", "allow"), 9: ("x.net", "/fr/", "net/fr/", "block"),
    }
    edges = {("a.com", "b.net"), ("b.net", "c.org"), ("d.org", "bad.example.com"), ("c.org", "a.com")}
    hosts = {r.host for r in rows.values()} - {""}

    def ranks(edges, seeds):
        start = {h: (len(hosts) / len(seeds) if h in seeds else 0.0) for h in hosts}
        rank = dict(start)
        for _ in range(url_filter.ROUNDS):
            new = {h: 0.15 * start[h] for h in hosts}
            for a, b in edges:
                new[b] += 0.85 * rank[a] / sum(1 for x, _ in edges if x == a)
            rank = new
        return rank

    trust = ranks(edges, {"a.com", "www.example.com"})
    distrust = ranks({(b, a) for a, b in edges}, {"bad.example.com", "x.net"})
    for r in rows.values():
        if r.host:
            assert r.trust == pytest.approx(trust[r.host]) and r.distrust == pytest.approx(distrust[r.host])
    assert url_filter.judge(df.limit(0)).count() == 0


def test_verdicts_do_not_hang_on_links_elsewhere(spark):
    """The other pages of a blocked host, and hosts that link to it, with and without a link that has nothing to do with it."""
    pages = [(i, f"http://a.net/es/{i}", None) for i in range(3)] + [(10, "http://a.net/about", ""), (11, "http://far.org/", "x" * 300_000)]
    linking = [(20, "http://one.org/", '<a href="http://a.net/">'), (21, "http://half.org/", "<a href='http://a.net/'><a href='http://far.org/q'>")]
    schema = "page_id long, url string, html string"

    def verdicts(rows):
        return {r.page_id: r.verdict for r in url_filter.judge(spark.createDataFrame(rows, schema)).collect()}

    alone = verdicts(pages)
    assert alone == {0: "block", 1: "block", 2: "block", 10: "block", 11: "allow"}
    more = verdicts([*pages, (30, "http://h1.org/", '<a href="http://h2.org/">')])
    assert more == {**alone, 30: "allow"}
    linked = verdicts([*pages, *linking])
    assert linked == {**alone, 20: "block", 21: "block"}


def test_hosts_and_rules_of_all_pages(spark, sf_dir):
    """Host, path, rule and ruled verdict against SQL; no verdict of the given pages is left to links."""
    want = duck(sf_dir).execute("""
        WITH u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN regexp_extract(url, '(?s)^.*?://(.*)$', 1) ELSE '' END AS rest FROM pages),
        h AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                     coalesce(regexp_extract(rest, '^[^/?#]*(/[^?#]*)', 1), '') AS path FROM u),
        r AS (SELECT * FROM (VALUES ('com/', 'allow'), ('example.com/en/', 'block'), ('www.example.com/en/', 'allow'), ('net/es/', 'block'),
                ('net/fr/', 'block')) AS t(rule, verdict)),
        m AS (SELECT page_id, rule, verdict, row_number() OVER (PARTITION BY page_id ORDER BY length(rule) DESC) AS place FROM h, r
              WHERE (host = split_part(rule, '/', 1) OR ends_with(host, '.' || split_part(rule, '/', 1))) AND starts_with(path, substr(rule, strpos(rule, '/'))))
        SELECT h.page_id, host, path, rule, coalesce(verdict, 'allow') FROM h LEFT JOIN m ON h.page_id = m.page_id AND place = 1""").fetchall()
    rows = QUERIES["op7_url_filter"](spark, sf_dir).collect()
    assert sorted((r.page_id, r.host, r.path, r.rule, r.verdict) for r in rows) == sorted(want)


def test_mixing_comes_near_targets(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = mixing.mix(docs, columns=["doc_id", "source"]).collect()
    taken, target = {}, {}
    for r in rows:
        assert 0 <= r.taken <= 3 * r["size"]
        taken[r.source] = taken.get(r.source, 0) + r.taken
        target[r.source] = r.target
    for source, words in target.items():
        assert abs(taken[source] - words) <= 32 + 0.01 * words
    again = mixing.mix(docs.repartition(5), columns=["doc_id", "source"]).collect()
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, again), key=str)


def test_blend_cuts_texts_to_taken_words(spark):
    rows = [(i, "  " * (i % 2) + " ".join(f"w{k}\n" for k in range(i + 3)), "ab"[i % 2], 1) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, taken int")
    taken = {r.doc_id: r.taken for r in mixing.mix(docs).collect()}
    words = dict.fromkeys(taken, 0)
    texts = {r[0]: r[1] for r in rows}
    for r in mixing.blend(docs).collect():
        assert texts[r.doc_id].startswith(r.text)
        words[r.doc_id] += len(r.text.split())
    assert words == taken


def test_ranked_search_of_odd_rows(spark):
    docs = spark.createDataFrame([(*r, 1, 2, 3, 4, True, "w", 7, 8, 9) for r in odd_rows()], CLASHING)
    items = [(1, "Fox and DOG", "x"), (1, "word7", "x"), (2, None, "x"), (3, "", "x"), (4, "nowhere", "x"), (None, "é one", "x")]
    asked = spark.createDataFrame(items, "item_id long, text string, term string")
    rows = ranked_search.search(docs, asked).collect()
    by_item = {}
    for r in sorted(rows, key=lambda r: (str(r.item_id), r["rank"])):
        by_item.setdefault(r.item_id, []).append((r["rank"], r.doc_id, r.score))
    assert set(by_item) == {1, None}
    assert [d for _, d, _ in by_item[1]] == [5, 5, 6, None, 4]
    assert len({s for _, _, s in by_item[1][:4]}) == 1 and [r for r, _, _ in by_item[1]] == [1, 2, 3, 4, 5]
    assert [d for _, d, _ in by_item[None]] == [7]  # the other is written with two characters
    assert ranked_search.search(docs.limit(0), asked).count() == 0 and ranked_search.search(docs, asked.limit(0)).count() == 0


@pytest.mark.parametrize("probe", [1, 3, 500])
def test_ranked_search_at_any_depth(spark, probe):
    """Against all scores: hot terms, ties, and lists that are read in parts."""
    import math
    import random
    from collections import Counter

    rng = random.Random(5)
    texts = [" ".join(rng.choices(["the", "of", "a", "hot", "rare", "x1", "y2", "z3", "É"], [40, 30, 20, 8, 1, 3, 2, 2, 1], k=rng.randint(0, 60))) for _ in range(300)]
    items = [(1, "the of rare"), (2, "the of a hot x1 y2 É"), (3, "z3 z3 the"), (4, "a")]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    rows = ranked_search.search(docs, spark.createDataFrame(items, "item_id long, text string"), top=20, probe=probe).collect()
    counts = [Counter(ranked_search.terms(t)) for t in texts]
    held = [c for c in counts if c]
    n_docs, n_words = len(held), sum(c.total() for c in held)
    want = []
    for item, text in items:
        scores = []
        for d, c in enumerate(counts):
            m = 100 - 50 + (50 * c.total() * n_docs) // n_words
            score = 0
            for t in set(ranked_search.terms(text)) & set(c):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * sum(t in x for x in held) + 1)))
                score += w * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m))
            if score:
                scores.append((-score, d))
        want += [(item, rank, d, -s) for rank, (s, d) in enumerate(sorted(scores)[:20], 1)]
    assert sorted((r.item_id, r["rank"], r.doc_id, r.score) for r in rows) == want


@pytest.mark.parametrize("shard_words", [40, 10**6])
def test_collocations_against_all_phrases(spark, shard_words):
    import random
    from collections import Counter

    rng = random.Random(2)
    words = ["New", "York", "the", "of", "city", "é", "<b>", "a\u2028b"]
    texts = [(rng.choice(["en", None, "de"]), "".join(rng.choice(words) + rng.choice([" ", "  ", " ", "\t", ", ", ".\n"]) for _ in range(rng.randint(0, 40)))) for _ in range(150)]
    texts += [("en", "New York city the of"), ("en", None), ("xx", ""), ("xx", " .,; "), ("fr", "new york city hall " * 30)]
    docs = spark.createDataFrame([(i % 100, lang, t, "x", 1) for i, (lang, t) in enumerate(texts)], "doc_id long, lang string, text string, words string, shard int")
    rows = collocations.mine(docs.repartition(3), least=8, best=30, shard_words=shard_words).collect()
    f, n = {}, Counter()
    import re

    for lang, text in texts:
        lang = lang or "und"
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(str.maketrans("NYC", "nyc"))):
            w = [x for x in re.split("[ \t]+", piece) if x]
            n[lang] += len(w)
            for k in range(1, 6):
                for i in range(len(w) - k + 1):
                    f.setdefault(lang, Counter())[tuple(w[i : i + k])] += 1
    want = []
    for lang, found in f.items():
        several = {p: a for p, a in found.items() if len(p) > 1 and a >= 8}
        made = []
        for p, a in several.items():
            if any(len(q) > len(p) and b >= a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in several.items()):
                continue
            cuts = [(1000 * a * n[lang] // (found[p[:k]] * found[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            made.append((-score, -a, " ".join(p).encode(), found[p[:k]], found[p[k:]]))
        want += [(lang, rank, p.decode(), -a, le, r, n[lang], -s) for rank, (s, a, p, le, r) in enumerate(sorted(made)[:30], 1)]
    assert sorted(tuple(r) for r in rows) == sorted(want)
    assert collocations.mine(docs.limit(0)).count() == 0

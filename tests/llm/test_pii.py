"""Personal data against a plain search, and texts that strain patterns."""

from __future__ import annotations

import re
import time

import duckdb
from compare import differences

from tidemark.llm import pii
from tidemark.llm.oracles import PII
from tidemark.llm.queries import op11_pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
DOCS = "doc_id long, text string, found string, n_email long, base int"


def passes_luhn(digits: str) -> bool:
    twice = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(x - 9 * (x > 9) for x in twice) % 10 == 0


def plain_base(text: str) -> str:
    spans = []
    for place, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else False,
                "card": 12 <= len(digits) <= 19 and passes_luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                spans.append((m.start(), place, f"{kind}:{m.start()}:{m.end()}"))
    return ",".join(s for _, _, s in sorted(spans))


ODD = [
    "a@b.c_d@e.f x@y.z. @ a@b a@@b.c a@b..c %@-.-", "1.2.3.4.5.6.7.8 300.1.1.1.1.1 001.02.0003.255 1.1.1.256 1.1.1.0000000000000000000000000000255",
    "4111 1111 1111 1111 and 4111-1111-1111-1111 or 4111111111111112, 4111  1111 1111 1111; 41111111111111111111", "0 00 000000000000 5-5-5-5-5-5-5-5-5-5-5-5",
    "+1 (743) 555-3824 +49 30 123456 + +1 +12 +1(2)3(4)5(6)7(8)9 ++123456789 +1234567890123456", "😀😀 é a@b.cc 😀 10.0.0.1\n+1 23\n456 7890", "+12345678910.11.12.13 a1.2.3.4@5.6",
    None, "", " ", "nothing here",
]


def test_base_spans_of_odd_texts(spark):
    docs = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in enumerate(ODD)] + [(0, ODD[0], "x", 1, 2), (None, ODD[1], "x", 1, 2)], DOCS)
    rows = pii.find(docs).collect()
    assert len(rows) == len(ODD) + 2
    for r in rows:
        text = ODD[1 if r.doc_id is None else r.doc_id] or ""
        assert r.base == plain_base(text)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [r.base.count(f"{k}:") for k in pii.BASE]
        kept = [f"{s.kind}:{s.start}:{s.end}" for s in r.found]
        assert ",".join(s for s in kept if s.split(":")[0] in pii.BASE) == r.base and ",".join(kept) == r.spans
    assert pii.find(docs.limit(0)).count() == 0


def test_checksums_and_words_nearby(spark):
    texts = [
        "iban DE89 3704 0044 0532 0130 00, GB82WEST12345698765432", "DE88 3704 0044 0532 0130 00 and xDE89370400440532013000",
        "call 555-123-4567 or 222-333-4444", "Mobile: (555) 123-4567; tel +1 (743) 555-3824", "SSN 078-05-1120 and 078-05-1120", "tel 1-555-123-4567",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = sorted((r.doc_id, r.spans, [s.score for s in r.found]) for r in pii.find(docs).collect())
    assert rows == [
        (0, "iban:5:32,iban:34:56", [120, 80]), (1, "", []), (2, "local:5:17", [70]), (3, "local:8:22,phone:28:45", [70, 100]),
        (4, "number:4:15", [70]), (5, "", []),
    ]


def test_long_texts_take_linear_time(spark):
    texts = ["1" * 200_000, "a" * 200_000, "a@" * 50_000, "1.1." * 50_000, "+1" * 50_000, "1 " * 100_000, "A1" * 50_000, "+1" + " " * 200_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    began = time.time()
    rows = {r.doc_id: (r.n_email, r.n_ip, r.n_card, r.n_phone, len(r.found)) for r in pii.find(docs).collect()}
    assert time.time() - began < 60
    assert rows == {i: (0, 25_000, 0, 0, 25_000) if i == 3 else (0,) * 5 for i in range(len(texts))}


def test_many_spans_in_one_text(spark):
    text = "x 10.0.0.1, 4111111111111111; " * 5_000
    (row,) = pii.find(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert row.base == plain_base(text) and row.n_card == row.n_ip == 5_000


def test_sql_agrees_on_odd_texts(spark, tmp_path):
    texts = [*ODD, "iban DE89 3704 0044 0532 0130 00, GB82WEST12345698765432", "call 555-123-4567 or 222-333-4444 SSN 078-05-1120", "Tel (555) 123-4567(555) 123-4567"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert differences(spark, db, op11_pii, PII, str(tmp_path)) == ""

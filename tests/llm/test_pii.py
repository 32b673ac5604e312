import re
from hashlib import sha256

import pytest
from brute import CLASHES, DOCUMENTS, ODD_TEXTS, documents
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clickloom.llm import pii as op
from clickloom.llm.queries import QUERIES

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(number):
    figures = [int(c) for c in reversed(number)]
    return (sum(figures[::2]) + sum(2 * x - 9 * (x > 4) for x in figures[1::2])) % 10 == 0


def holds(kind, value):
    number = re.sub("[^0-9]", "", value)
    return {
        "email": True,
        "ip": kind != "ip" or all(int(x) <= 255 for x in value.split(".")),
        "card": 12 <= len(number) <= 19 and luhn(number),
        "phone": 9 <= len(number) <= 15,
    }[kind]


def base(text):
    found = [
        (m.start(), k, kind, m.end())
        for k, (kind, pattern) in enumerate(PATTERNS.items())
        for m in re.finditer(pattern, text or "")
        if holds(kind, m[0])
    ]
    return [f"{kind}:{a}:{b}" for a, _, kind, b in sorted(found)]


def expected(texts):
    out = {}
    for i, t in texts.items():
        spans = base(t)
        counts = tuple(sum(s.startswith(kind) for s in spans) for kind in PATTERNS)
        out[i] = (*counts, sha256(",".join(spans).encode()).hexdigest())
    return out


def got(df):
    return {r[0]: tuple(r)[1:6] for r in df.collect()}


TEXTS = [
    *ODD_TEXTS,
    "a@b.c-x@d.e a@b.c_x@d.e @x.y x@y +a.b%c@d-e.f.g. 😀é@x.y 😀 z@y.x",
    "1.2.3.4.5.6.7.8 256.1.1.1 0255.000.1.2 1.2.3 999.1.2.3.4 1..2.3.4",
    "4111 1111 1111 1111, 4111-1111-1111-1111 4111  1111 11111111 5500005555555559x 0 1 2 3 4 5 6 7 8 9 0 1 2",
    "+1 (017) 555-7713 +49.30.123456- +12 +123456789012345678 ++1 234 567 89 00 +1(2)3",
    "9" * 30 + " " + "1-" * 6000 + "1",
    "mail x.y (at) example (dot) com or x@",
]


def test_query_base_spans(spark, sf_dir, table_rows):
    texts = dict(table_rows("documents")[["doc_id", "text"]].values)
    rows = QUERIES["op8_pii"](spark, sf_dir)
    assert got(rows) == expected(texts)
    for r in rows.collect():
        every = r.spans.split(",") if r.spans else []
        assert set(base(texts[r.doc_id])) <= set(every)
        starts = [int(s.split(":")[1]) for s in every]
        assert starts == sorted(starts)


@pytest.mark.parametrize("schema", [DOCUMENTS, CLASHES])
def test_odd_texts(spark, schema):
    docs = documents(spark, TEXTS, schema=schema)
    assert got(op.report(docs)) == expected({i + 1: t for i, t in enumerate(TEXTS)})


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text("a@.+-0123456789 ()é😀", max_size=60), min_size=30, max_size=30))
def test_any_text(spark, texts):
    docs = documents(spark, texts)
    base_only = op.spans_of(docs).select("doc_id", op._joined(F.col("base")).alias("s"))
    assert {r.doc_id: r.s for r in base_only.collect()} == {i + 1: ",".join(base(t)) for i, t in enumerate(texts)}


def test_secrets_are_added_and_plain_words_are_not(spark):
    key = "0b96a8c8d79c4a5085c919698889f59b72ab7b{:02d}"
    texts = [f'the token = "{key.format(i)}" of' for i in range(30)]
    texts += ["a-long-word-of-many-syllables-without-figures here"] * 30 + ["it was 2024-01-02 12:30, or 3.14159265358979"] * 30
    out = {r.doc_id: r.spans for r in op.report(documents(spark, texts)).collect()}
    assert all(out[i] == "secret:13:53" for i in range(1, 31))
    assert not any(out[i] for i in range(31, 91))


def test_candidates_have_no_greatest_length(spark):
    key = "sk_" + "0b96a8c8d79c4a5085c919698889f59b72ab7b01" * 20
    texts = [f"the token = {key} of", f"mail {'a' * 300} (at) example (dot) com", "+".join(["call"]) + " 0" + "-1" * 60]
    found = op.spans_of(documents(spark, texts)).select("doc_id", F.explode("candidates").alias("c")).select("doc_id", "c.*")
    lengths = {(r.doc_id, r.form): r.end - r.start for r in found.collect() if r.form != "key" or r.doc_id == 1}
    assert lengths == {(1, "key"): len(key), (2, "address"): 300 + len(" (at) example (dot) com"), (3, "number"): 121}


def test_estimated_reliabilities_follow_the_votes(spark):
    columns = ["kind", *op.LABELERS]
    agree = [("card", 1, 1, 1, 1, -1)] * 50 + [("card", 0, 0, 0, -1, 0)] * 200
    mixed = [("card", 1, 0, 1, -1, -1)] * 5
    found = op.reliabilities(spark.createDataFrame(agree + mixed, columns)).collect()
    p = {tuple(r)[1:6]: r.p for r in found}
    assert p[1, 1, 1, 1, -1] > 0.95 and p[0, 0, 0, -1, 0] < 0.05


def test_empty_table_and_null_ids(spark):
    docs = documents(spark, ["a@b.de", "a@b.de"]).withColumn("doc_id", F.expr("nullif(doc_id, 1)"))
    rows = op.report(docs).collect()
    assert sorted((r.doc_id or 0, r.n_email, r.spans) for r in rows) == [(0, 1, "email:0:6"), (2, 1, "email:0:6")]
    assert op.report(docs.where("false")).collect() == []


def test_main_path_runs_no_python(spark, sf_dir):
    plan = op.report(spark.read.parquet(f"{sf_dir}/documents.parquet"))._jdf.queryExecution().toString()
    rows = op.spans_of(spark.read.parquet(f"{sf_dir}/documents.parquet"))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan + rows)

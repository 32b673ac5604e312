import re
from collections import Counter

import numpy as np
import pytest
from brute import CLASHES, DOCUMENTS, ODD_TEXTS, documents
from pyspark.sql import functions as F

from clickloom.llm import quality as op
from clickloom.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    runs = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {p for i in range(len(w) - 4) if runs[tuple(w[i : i + 5])] > 1 for p in range(i, i + 5)}
    n = len(w)
    return (
        n,
        sum(map(len, w)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(covered),
        n < 10 or 100 * len(covered) > 20 * n,
    )


def base(df):
    return {r.doc_id: tuple(r)[1:] for r in df.select("doc_id", *op.ROW_COUNTS, "base_failed").collect()}


def test_base_counts_of_the_query(spark, sf_dir, table_rows):
    got = base(QUERIES["op1_quality"](spark, sf_dir))
    assert got == {i: brute(t) for i, t in table_rows("documents")[["doc_id", "text"]].values}


def test_junk_goes_and_clean_texts_stay(spark):
    import pandas as pd

    got = QUERIES["op1_quality"](spark, "/root/testdata/sf0.1").toPandas()
    labels = pd.read_parquet("/root/testdata/sf0.1/labels.parquet")
    both = got.merge(labels, on="doc_id")
    assert len(got) == 10_000
    assert (~both.kept)[both.quality == 0].mean() > 0.95
    assert (~both.kept & ~both.base_failed)[both.quality == 1].mean() < 0.005


@pytest.mark.parametrize("schema", [DOCUMENTS, CLASHES])
def test_odd_texts(spark, schema):
    texts = [*ODD_TEXTS, "a b c d e a b c d e x", "a b c d e f\n" * 5, "p q r s t p q r s t p q r s t " + "w " * 9]
    docs = documents(spark, texts, schema=schema)
    got = op.judge(docs)
    assert base(got) == {i + 1: brute(t) for i, t in enumerate(texts)}
    assert all(r.kept == (not r.base_failed) or r.distance > op.CUTOFF for r in got.collect())
    left = op.keep_good(docs)
    assert left.columns == docs.columns and left.count() == got.where("kept").count()


def test_empty_tables_null_groups_and_repeated_ids(spark):
    docs = documents(spark, [" ".join(f"w{i}{k}" for i in range(20)) for k in range(30)])
    assert op.judge(docs.where("false")).collect() == []
    odd = docs.withColumn("lang", F.expr("nullif('en', 'en')")).withColumn("doc_id", F.expr("nullif(doc_id % 3, 0)"))
    got = op.judge(odd.unionAll(docs))
    assert got.count() == 60 and got.where("kept").count() == 60


def test_only_short_texts(spark):
    got = op.judge(documents(spark, ["a", None, "b c"])).collect()
    assert [r.kept for r in got] == [False] * 3


def test_junk_in_small_groups_is_judged_by_the_larger_ones(spark):
    made = np.random.default_rng(4)
    plain = [" ".join("abcdefghijklmnop"[: made.integers(2, 10)] + str(i * 50 + k) for k in range(40)) for i in range(260)]
    junk = "#$% &&& *** ||| <<> ### $$$ %%% <>< |&| ##$ %%& *#* $|$ >>>"
    cases = [("en", "large", x) for x in plain]
    cases += [("en", "one row", junk), ("xx", "one row", junk), ("en", "good row", plain[7] + " more")]
    # Many rows, but few that pass the base rule.
    cases += [("en", "failing", "too short")] * 250 + [("en", "failing", f"{junk} {k}") for k in range(3)]
    # A language that is large by rows that fail only.
    cases += [("yy", f"s{k % 2}", "short") for k in range(250)] + [("yy", "s0", junk + " yy")]
    docs = spark.createDataFrame([(i, *x) for i, x in enumerate(cases)], "doc_id long, lang string, source string, text string")
    got = {r.doc_id: (r.base_failed, r.kept) for r in op.judge(docs).collect()}
    want = {i: ("short" in x[2], x[2] in plain or x[1] == "good row") for i, x in enumerate(cases)}
    assert got == want


def test_distance_matches_numpy(spark):
    made = np.random.default_rng(1)
    points = made.normal(size=(400, op.P)) @ made.normal(size=(op.P, op.P))
    rows = spark.createDataFrame([("g", 1, *map(float, p)) for p in points], ["key", "start", *op.X])
    found = op._decompose(op._moments(rows))
    got = sorted(r.d for r in rows.join(found.drop("start"), "key").select(op.distance().alias("d")).collect())
    spread = np.cov(points.T, bias=True) + np.diag(np.square(op.FLOOR))
    off = points - points.mean(0)
    want = sorted(np.einsum("ij,jk,ik->i", off, np.linalg.inv(spread), off))
    assert np.allclose(got, want)
    assert abs(found.first().log_det - np.linalg.slogdet(spread)[1]) < 1e-9


def test_estimates_resist_a_fifth_of_outliers(spark):
    made = np.random.default_rng(2)
    good = made.normal(size=(800, op.P))
    bad = made.normal(size=(200, op.P)) + 12
    rows = spark.createDataFrame([("g", *map(float, p)) for p in np.vstack([good, bad])], ["key", *op.X])
    found = op.estimates(rows).first()
    assert np.abs(found.m).max() < 0.3


def test_main_path_runs_no_python(spark, sf_dir):
    plan = op.judge(spark.read.parquet(f"{sf_dir}/documents.parquet"))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)

import numpy as np
import pandas as pd
import pytest
from brute import CLASHES, ODD_TEXTS, documents, fold
from pyspark.sql import functions as F

from clickloom.llm import toxicity as op
from clickloom.llm.queries import QUERIES

WORDS = "the of and to in that was for on with as his be at by had not are but from or have an they which".split()


def corpus(spark, insults=("blockhead", "nitwit")):
    made = np.random.default_rng(4)
    rows = []
    for i in range(240):
        words = list(made.choice(WORDS, 30))
        if i % 4 == 0:
            words[int(made.integers(30))] = insults[i // 4 % len(insults)]
        rows.append((i, " ".join(words), int(i % 4 == 0)))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int")


def slow_kernel(s, t):
    """Plain sums over subsequences, with both norms and the power."""
    from itertools import combinations

    def weights(x):
        out = {}
        for places in combinations(range(len(x)), op.ORDER):
            span = places[-1] - places[0] + 1
            if span <= op.SPAN:
                key = bytes(x[i] for i in places)
                out[key] = out.get(key, 0) + op.DECAY**span
        return out

    a, b = weights(s), weights(t)
    norms = np.sqrt(sum(x * x for x in a.values()) * sum(x * x for x in b.values()))
    value = sum(x * b.get(k, 0) for k, x in a.items()) / norms if norms else 0
    return value**op.POWER if value >= op.LEAST else 0


def test_kernel_matches_plain_sums():
    marks = [b"idiot", b"moron", b"worthless", "réeux".encode(), b"aaaa", b"ab"]
    tried = [*marks, b"idxiot", b"iidiot", b"x", b"", b"moronic", b"worthlesss", b"aaaaaaa", b"diot", b"thing"]
    got = op.Landmarks(marks).kernels(tried)
    for unit, pairs in zip(tried, got):
        found = dict(pairs)
        for k, mark in enumerate(marks):
            assert found.get(k, 0) == pytest.approx(slow_kernel(unit, mark))


def test_units_undo_signs_and_spelling():
    assert b"idiot" in op.units("You I.d.i.o.t!") and b"idiot" in op.units("an i d i o t ok")
    assert b"idiot" in op.units("1d10t") and b"idiot" in op.units("*idiot*")
    assert max(map(len, op.units("x" * 5000))) <= op.LONGEST
    assert op.units(None) == op.units("") == op.units(" ...") == set()


def test_held_out_rows(spark):
    sf_dir = "/root/testdata/sf0.1"
    got = QUERIES["op6_toxicity"](spark, sf_dir).toPandas()
    assert len(got) == 10_000 and got.score.between(0, 1).all()
    assert (got.held_out == [fold(i, 3) == 1 for i in got.doc_id]).all()
    assert (got.predicted == (got.score >= 0.7)).all()
    both = got.merge(pd.read_parquet(f"{sf_dir}/labels.parquet"), on="doc_id")
    held = both[both.held_out]
    toxic = held.toxic == 1
    rank = held.score.rank()
    n = toxic.sum()
    assert (rank[toxic].sum() - n * (n + 1) / 2) / (n * (~toxic).sum()) > 0.93
    assert toxic[held.predicted == 1].mean() > 0.85
    assert held.predicted[~toxic].mean() < 0.01


def test_learned_insults_with_letters_put_in(spark):
    rows = corpus(spark)
    model = op.learn(rows.select("doc_id", "text"), rows.select("doc_id", "toxic"))
    clean, *insults = model.scores(
        ["that was not for them", "that was a blockhead", "you nitwitt", "bloxckhead", "n i t w i t", "b-l-o-c-k-h-e-a-d"]
    )
    assert clean < 0.5 and min(insults) > 0.7


def test_odd_rows(spark):
    rows = corpus(spark)
    labels = rows.select("doc_id", "toxic", F.lit("x").alias("text")).unionAll(
        rows.selectExpr("doc_id + 9999", "if(doc_id < 3, null, 1)", "'y'")
    )
    model = op.learn(rows.select("doc_id", "text"), labels)
    docs = documents(spark, ODD_TEXTS, schema=CLASHES)
    got = docs.select("doc_id", op.score(F.col("text"), model).alias("s")).collect()
    assert len(got) == len(ODD_TEXTS) and all(0 <= r.s <= 1 for r in got)
    assert len({r.s for r in got if r.doc_id <= 4}) == 1
    assert docs.where("false").select(op.score(F.col("text"), model)).collect() == []


def test_one_class_or_no_labels(spark):
    rows = corpus(spark)
    docs = rows.select("doc_id", "text")
    none = op.learn(docs, rows.where("false").select("doc_id", "toxic"))
    assert none.scores(["a", None])[0] < 1e-6
    ones = op.learn(docs, rows.where("toxic = 1").select("doc_id", "toxic"))
    assert ones.scores(["a"])[0] > 0.99


def test_files_with_one_label_each(spark, tmp_path, monkeypatch):
    """A task may have no row of label 1."""
    kept = op.store

    def by_label(df, name):
        if name != "labelled-sample":
            return kept(df, name)
        df.repartition(1).write.partitionBy("toxic").parquet(str(tmp_path / "sample"))
        return spark.read.parquet(str(tmp_path / "sample")).select("text", "toxic")

    monkeypatch.setattr(op, "store", by_label)
    rows = corpus(spark)
    model = op.learn(rows.select("doc_id", "text"), rows.select("doc_id", "toxic"))
    clean, insult = model.scores(["that was not for them", "that was a blockhead"])
    assert clean < 0.5 < 0.7 < insult


def test_a_repeated_id_does_not_widen_the_sample(spark, monkeypatch):
    sizes = {}
    kept = op.store
    monkeypatch.setattr(op, "store", lambda df, name: sizes.setdefault(name, kept(df, name)))
    rows = corpus(spark)
    many = spark.range(100_000).selectExpr("0L as doc_id", "concat('that was a blockhead ', id % 7) as text")
    docs = rows.select("doc_id", "text").unionAll(many)
    labels = rows.select("doc_id", "toxic").unionAll(spark.range(3000).selectExpr("0L", "1"))
    model = op.learn(docs, labels, sample=200)
    assert sizes["labelled-sample"].count() <= 400
    assert model.scores(["that was a blockhead"])[0] > 0.5


def test_the_machine_separates_what_can_be_separated():
    x = np.array([[0.0, 1], [0.1, 1.2], [1, 0], [1.3, 0.1]])
    y = np.array([1, 1, 0, 0])
    w = op.support_vectors(x, y, cost=100)
    assert ((x @ w[:-1] + w[-1] > 0) == (y == 1)).all()

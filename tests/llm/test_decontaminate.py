import re

import pytest
from brute import CLASHES, DOCUMENTS, ODD_TEXTS, documents, rows, sha
from compare import compare, sql_engine
from pyspark.sql import functions as F

from clickloom.llm import decontaminate as op
from clickloom.llm.oracle import ORACLE_SQL
from clickloom.llm.queries import QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return WORD.findall(lower)


def brute(texts, items):
    out = {}
    for i, text in texts.items():
        w, hit, found = words(text), set(), set()
        for item, t in items:
            v = words(t)
            size = min(10, len(v))
            for s in range(len(v) - size + 1) if v else []:
                for p in range(len(w) - size + 1):
                    if w[p : p + size] == v[s : s + size]:
                        hit.update(range(p, p + size))
                        found.add(str(item))
        out[i] = (len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit))
    return out


def benchmark(spark, texts):
    return spark.createDataFrame([(i * 3 + 8, t) for i, t in enumerate(texts)], "item_id long, text string")


ITEMS = [None, "", "!!", "one", "Two words", " ".join(f"w{i}" for i in range(25)), "word " * 12, "Two words", "é日本 word"]
TEXTS = [
    *ODD_TEXTS,
    "here is ONE and two words, not two-words. One",
    " ".join(f"W{i}" for i in range(25)),
    "x " + ", ".join(f"w{i}" for i in range(3, 14)) + " w0 w1 w2",
    "é日本 word é日本 word",
]


@pytest.mark.parametrize("schema", [DOCUMENTS, CLASHES])
@pytest.mark.parametrize("max_terms", [op.MAX_TERMS, 3])
def test_odd_texts_and_items(spark, monkeypatch, schema, max_terms):
    monkeypatch.setattr(op.Index.__init__, "__defaults__", (True, max_terms))
    got = op.leak_report(documents(spark, TEXTS, schema=schema), benchmark(spark, ITEMS))
    want = brute({i + 1: t for i, t in enumerate(TEXTS)}, [(i * 3 + 8, t) for i, t in enumerate(ITEMS)])
    assert {r[0]: tuple(r[1:]) for r in got.collect()} == want


def test_query_matches_sql(spark, sf_dir):
    result = compare(
        spark, sql_engine(sf_dir), QUERIES["op4_decontamination"], ORACLE_SQL["op4_decontamination"], sf_dir
    )
    assert result["types_match"] and result["values_match"], result["first_difference"]
    assert result["rows"] == 200


def test_repeated_and_null_ids_and_empty_tables(spark):
    docs = documents(spark, ["a two words", "b", "c two words"]).withColumn("doc_id", F.expr("nullif(doc_id, 1)"))
    docs = docs.unionAll(docs.where("doc_id = 3").withColumn("text", F.lit("clean")))
    items = benchmark(spark, ["two words"])
    assert rows(op.find_leaks(docs, items), "doc_id", "n_hit") == [(2, 0), (3, 0), (3, 2), (None, 2)]
    left = op.drop_leaks(docs, items)
    assert left.columns == docs.columns
    assert rows(left, "doc_id", "text") == [(2, "b"), (3, "clean")]
    assert op.drop_leaks(docs, items.where("false")).count() == 4
    assert op.find_leaks(docs.where("false"), items).collect() == []


def test_proximity(spark):
    docs = documents(spark, ["the quick and brown fox", "quick fox brown", "a quick b c d e f g brown fox", "brown"])
    phrases, _ = op.windows(benchmark(spark, ["quick brown fox"]))
    index = op.Index(docs, phrases, runs=False)
    named = index.proximity_matches(phrases, slack=2).join(index.documents, "row")
    assert rows(named, "doc_id") == [(1,)]
    assert rows(index.phrase_matches(phrases)) == []


def test_runs():
    import numpy as np

    known = np.array([1, 1, 0, 1, 1, 1, 0, 1], bool)
    assert op.in_run(known, 3).tolist() == [False] * 3 + [True] * 3 + [False] * 2
    assert op.in_run(known, 1).tolist() == known.tolist()
    assert op.in_run(np.array([], bool), 2).tolist() == []


def test_proximity_needs_all_postings(spark):
    docs = documents(spark, ["one two x three four", "one two three four", "four three two one", "one two x y z three four"])
    items = spark.createDataFrame([(7, "one two three four"), (8, "none of it")], "item_id long, text string")
    phrases, _ = op.windows(items)
    with pytest.raises(ValueError, match="runs"):
        op.Index(docs, phrases).proximity_matches(phrases)
    got = {r.doc_id: r.near_item_ids for r in op.near_report(docs, items).collect()}
    assert got == {1: ["7"], 2: ["7"]}
    assert {r.doc_id for r in op.near_report(docs, items, slack=3).collect()} == {1, 2, 4}


def test_of_two_rows_with_one_id_and_equal_rows(spark):
    leak = "one two three four five six seven eight nine ten"
    docs = spark.createDataFrame([(1, leak), (1, "clean"), (1, "clean"), (None, leak), (None, None)], "doc_id long, text string")
    items = spark.createDataFrame([(7, leak)], "item_id long, text string")
    assert sorted(map(tuple, op.drop_leaks(docs, items).collect()), key=str) == [(1, "clean"), (1, "clean"), (None, None)]

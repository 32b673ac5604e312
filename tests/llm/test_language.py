from brute import CLASHES, ODD_TEXTS, documents, fold
from pyspark.sql import functions as F

from clickloom.llm import language as op
from clickloom.llm.queries import QUERIES

EN = "the thing and other that with from this there here their would about"
FR = "le la les des une avec pour dans sur mais qui que nous vous leur"


def labelled(spark):
    rows = [(i, f"{t} {i} " * 4, lang) for i in range(6) for t, lang in ((EN, "en"), (FR, "fr"))]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_query_on_held_out_rows(spark, table_rows):
    docs = table_rows("documents").set_index("doc_id")
    got = QUERIES["op2_language_id"](spark, "/root/testdata/sf0.01").toPandas().set_index("doc_id")
    assert len(got) == 1000
    assert all(got.held_out[i] == (fold(i, 5) == 0) for i in got.index)
    import pandas as pd

    lang = pd.read_parquet("/root/testdata/sf0.01/documents.parquet").set_index("doc_id").lang
    held = got[got.held_out]
    assert (held.lang_pred == lang[held.index]).mean() >= 0.97
    assert held.score.between(0, 1).all()
    sure = held[~held.rejected]
    assert len(sure) >= 0.9 * len(held) and (sure.lang_pred == lang[sure.index]).mean() >= 0.98


def test_odd_texts_and_clashing_columns(spark):
    dictionaries = op.learn(labelled(spark))
    docs = documents(spark, [*ODD_TEXTS, "123 !!", "avec les une des"], schema=CLASHES)
    got = docs.select("doc_id", op.classify(F.col("text"), dictionaries).alias("c")).select("doc_id", "c.*").collect()
    by_id = {r.doc_id: r for r in got}
    assert len(got) == len(ODD_TEXTS) + 2
    for i in (1, 2, 3, 4, len(ODD_TEXTS) + 1):
        assert (by_id[i].lang_pred, by_id[i].score, by_id[i].rejected) == ("und", 0.0, True)
    assert by_id[len(ODD_TEXTS) + 2].lang_pred == "fr"
    assert all(r.lang_pred in ("en", "fr", "und") and 0 <= r.score <= 1 for r in got)


def test_ties_take_the_first_name_and_are_rejected():
    judge = op.Classifier({"b": b"xx", "c": b"xx"}).judge
    assert judge("some text")[0] == "b" and judge("some text")[2] == 0


def test_nothing_to_learn_from(spark):
    dictionaries = op.learn(labelled(spark).where("false"))
    assert dictionaries == {}
    docs = documents(spark, ["hello there", None])
    assert {r.c.lang_pred for r in docs.select(op.classify(F.col("text"), dictionaries).alias("c")).collect()} == {"und"}


def test_short_rows_teach_where_there_are_no_others(spark):
    rows = [(i, t, lang) for i in range(9) for t, lang in (("the with", "en"), ("les une", "fr"))]
    dictionaries = op.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert list(dictionaries) == ["en", "fr"]


def test_the_sample_is_bounded_and_the_same_each_time(spark):
    small = op.learn(labelled(spark), sample_rows=2, size=100)
    assert all(len(x) <= 100 for x in small.values())
    assert small == op.learn(labelled(spark).repartition(3), sample_rows=2, size=100)


def test_signs_that_are_no_letters(spark):
    assert op.letters("½ ²") == op.letters("①② ⅷ") == op.letters("٣ 7_!") == b""
    assert op.letters("a½b ⅷ Ünï 日本") == "a b ünï 日本".encode()
    assert not any(c.isalpha() for c in "½²①②ⅷ٣7_")
    docs = documents(spark, ["½ ²", "①②", "ⅷ", "word"])
    got = docs.select(op.classify(F.col("text"), {"en": b"word " * 50}).alias("c")).select("c.lang_pred").collect()
    assert [r[0] for r in got] == ["und", "und", "und", "en"]

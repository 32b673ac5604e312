import public_tokenizers
import pytest
from brute import CLASHES, ODD_TEXTS, documents
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from clickloom.llm import tokens as op
from clickloom.llm.queries import QUERIES
from clickloom.session import new_shared_dir

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)


def library(text):
    return len(LIBRARY.encode(text or "", add_special_tokens=False).ids)


def test_query_matches_the_library(spark, sf_dir, table_rows):
    want = {
        (i, len(t.encode()), library(t), library(t) > 2048) for i, t in table_rows("documents")[["doc_id", "text"]].values
    }
    got = QUERIES["op9_token_counts"](spark, sf_dir)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert set(map(tuple, got.collect())) == want


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=60), st.text("ab C\n\t 'sé́<|>Σ1 ", max_size=60)))
def test_cut_counts_match_whole_counts(text):
    counter = op._counter(PATH)
    assert counter.cut
    assert counter.counts([text]) == [library(text)]
    import re

    assert library(re.sub("[ \n]+", " ", text).strip(" ")) == library(text)


def test_special_strings_count_as_the_library_does():
    texts = ["a <|endoftext|> b", "x<|startoftext|>y", "<|ENDOFTEXT|>", "<|endoftext|><|endoftext|>"]
    assert op._counter(PATH).counts(texts) == [library(t) for t in texts]


def test_a_second_run_encodes_only_what_is_new(spark):
    cache = new_shared_dir(spark, "cache")
    docs = documents(spark, ODD_TEXTS + ODD_TEXTS, schema=CLASHES)
    want = {(i + 1, len((t or "").encode()), library(t)) for i, t in enumerate(ODD_TEXTS + ODD_TEXTS)}
    assert set(map(tuple, op.count_tokens(docs, PATH, cache).collect())) == want
    stored = spark.read.parquet(cache)
    n = stored.count()
    assert n == stored.select("digest").distinct().count() < len(ODD_TEXTS) + 1
    again = documents(spark, [*ODD_TEXTS, "something new"])
    assert op.count_tokens(again, PATH, cache).count() == len(ODD_TEXTS) + 1
    assert spark.read.parquet(cache).count() == n + 1


def test_stored_counts_are_used_and_versions_kept_apart(spark):
    cache = new_shared_dir(spark, "cache")
    docs = documents(spark, ["one two"])
    op.count_tokens(docs, PATH, cache)
    spark.read.parquet(cache).selectExpr("tokenizer", "digest", "n_tokens + 40 as n_tokens").write.parquet(cache + "x")
    assert op.count_tokens(docs, PATH, cache + "x").first().n_tokens == 42
    spark.read.parquet(cache).selectExpr("'old' as tokenizer", "digest", "7L as n_tokens").write.parquet(cache + "y")
    assert op.count_tokens(docs, PATH, cache + "y").first().n_tokens == 2


def test_repeated_and_null_ids_and_empty_table(spark):
    docs = documents(spark, ["a b", "a b", "c"])
    cache = new_shared_dir(spark, "cache")
    same = docs.selectExpr("nullif(doc_id, 3) as doc_id", "text").unionAll(docs.selectExpr("1L", "text"))
    assert op.count_tokens(same, PATH, cache).count() == 6
    assert op.count_tokens(docs.where("false"), PATH, new_shared_dir(spark, "cache")).collect() == []


def test_each_text_is_encoded_once_whatever_its_ids(spark):
    rows = [(None, "one two")] * 50 + [(5, "three")] * 50 + [(5, "one  two"), (6, "alone")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    cache = new_shared_dir(spark, "cache")
    got = op.count_tokens(docs, PATH, cache)
    assert got.count() == 102 and got.where("n_tokens = 2").count() == 51
    assert spark.read.parquet(cache).count() == 3
    # Of these only the new one is encoded.
    more = spark.createDataFrame([(1, "three"), (2, "new"), (3, "new"), (4, "newer")], "doc_id long, text string")
    assert op.count_tokens(more, PATH, cache).count() == 4
    assert spark.read.parquet(cache).count() == 5


def test_texts_that_stand_alone_are_not_shuffled(spark, tmp_path, monkeypatch):
    spark.range(500).selectExpr("id as doc_id", "concat('text ', id div 2 * if(id < 20, 1, 2) + id % 2 * if(id < 20, 0, 1)) as text").write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    seen = []
    split = op.split_rows
    monkeypatch.setattr(op, "split_rows", lambda *more: seen.append(split(*more)) or seen[-1])
    assert op.count_tokens(docs, PATH, str(tmp_path / "cache")).count() == 500
    may, alone = seen[0]
    assert "Exchange hashpartitioning" not in alone._jdf.queryExecution().executedPlan().toString()
    assert alone.count() > 400 and may.count() + alone.count() == 500


@pytest.mark.parametrize("name", ["piece_bpe_32k.model", "byte_bpe_50k.json"])
def test_other_tokenizers(name):
    path = public_tokenizers.path(name)
    text = "Some text,  with\n\nspaces <|endoftext|> and é"
    if name.endswith(".model"):
        import sentencepiece

        want = len(sentencepiece.SentencePieceProcessor(model_file=path).encode(text))
    else:
        want = len(Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids)
    assert op._counter(path).counts([text]) == [want]


def test_white_space_counts_where_the_tokenizer_encodes_it(spark):
    import sentencepiece

    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = ["a b", "a  b", "a\nb", "a\n\n\n  b", " a b "]
    cache = new_shared_dir(spark, "token-cache")
    encode = Tokenizer.from_file(path).encode
    want = {i + 1: len(encode(t, add_special_tokens=False).ids) for i, t in enumerate(texts)}
    assert len(set(want.values())) > 1
    for _ in range(2):
        got = op.count_tokens(documents(spark, texts), path, cache)
        assert {r.doc_id: r.n_tokens for r in got.collect()} == want
    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    got = op.count_tokens(documents(spark, texts), path, cache)
    assert {r.doc_id: r.n_tokens for r in got.collect()} == {i + 1: len(model.encode(t)) for i, t in enumerate(texts)}

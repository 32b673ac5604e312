import random
from collections import defaultdict

import pytest
from brute import CLASHES, DOCUMENTS, ODD_TEXTS, documents, rows, sha
from pyspark.sql import functions as F

from clickloom.llm import lines as op
from clickloom.llm.common import numbered
from clickloom.llm.queries import QUERIES

PASSAGE = "\n".join(f"line {i} of a passage that stands in many documents {i * 7}" for i in range(12))


def brute(texts: dict):
    """(text left, lines, removed) of each id."""
    first = {}
    for i in sorted(texts):
        for a, n, content in op.chunks_of(texts[i]):
            first.setdefault(content, (i, a))
    out = {}
    for i, text in texts.items():
        if text is None:
            out[i] = (None, 0, 0)
            continue
        gone = set()
        for a, n, content in op.chunks_of(text):
            if first[content] != (i, a):
                gone.update(range(a, a + n))
        every = text.split("\n")
        out[i] = ("\n".join(x for k, x in enumerate(every) if k not in gone), len(every), len(gone))
    return out


def result(df):
    return {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in df.select("doc_id", "text", "_lines.*").collect()}


def test_query_matches_brute_force(spark, sf_dir, table_rows):
    texts = dict(table_rows("documents")[["doc_id", "text"]].values)
    want = {(i, n, k, sha(t)) for i, (t, n, k) in brute(texts).items()}
    assert set(map(tuple, QUERIES["op7_line_dedup"](spark, sf_dir).collect())) == want
    assert any(k for _, _, k, _ in want)


@pytest.mark.parametrize("schema", [DOCUMENTS, CLASHES])
def test_odd_texts(spark, schema):
    texts = [*ODD_TEXTS, f"a\nb\n{PASSAGE}\nc", f"other\n{PASSAGE}", f"{PASSAGE}\nthe end\n\n\n", PASSAGE + "\n" + PASSAGE]
    docs = documents(spark, texts, schema=schema)
    done = op.dedup_lines(docs)
    assert done.columns == [*docs.columns, "_lines"]
    assert result(done) == brute({i + 1: t for i, t in enumerate(texts)})
    for r in done.collect():
        assert r.n_chars == len(r.text or "")


def test_a_shifted_passage_goes_from_all_but_the_first(spark):
    texts = [f"own line {i} a\n" * (i % 4) + PASSAGE + f"\nlast {i}" for i in range(40)]
    got = result(op.dedup_lines(documents(spark, texts)))
    assert got[1][2] == 0
    assert all(got[i][2] == 12 for i in range(2, 41))
    assert all(f"last {i - 1}" in got[i][0] for i in got)


@pytest.mark.parametrize("length", [2, 3, 4, 6, 10])
def test_repeated_passages_of_any_length_go_whole(spark, length):
    """Passages of some lines in two documents each, between lines of their own."""
    made, texts, inside = random.Random(length), [], []
    passages = [[f"p{p} l{k} " + " ".join(f"w{made.randrange(10**6)}" for _ in range(28)) for k in range(length)] for p in range(40)]
    for copy in range(2):
        for p, passage in enumerate(passages):
            own = [[f"own {copy} {p} {end} {k} and some more words" for k in range(made.randrange(4))] for end in "ab"]
            texts.append("\n".join(own[0] + passage + own[1]))
            inside.append((copy * length, len(own[0]) + len(own[1])))
    got = result(op.dedup_lines(documents(spark, texts)))
    assert [(got[i + 1][2], got[i + 1][1] - length) for i in range(len(texts))] == inside


def test_what_goes_repeats_an_earlier_line_and_pairs_of_lines_do_not_stay_twice(spark, sf_dir, table_rows):
    """Told by plain code that knows no chunks: bounds from below and from above."""
    texts = dict(table_rows("documents")[["doc_id", "text"]].values)
    got = result(op.dedup_lines(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    removed, seen_lines, seen_pairs = 0, set(), set()
    for i in sorted(texts):
        every, left = texts[i].split("\n"), got[i][0].split("\n") if got[i][0] else []
        # Lines that went, by walking through both texts from the front.
        rest, gone = iter(left), set()
        after = next(rest, None)
        for k, line in enumerate(every):
            if line == after and len(every) - k > 0:
                after = next(rest, None)
            else:
                gone.add(k)
        removed += len(gone)
        assert all(every[k] in seen_lines or every[k] in every[:k] for k in gone)
        pairs = [tuple(every[k : k + 2]) for k in range(len(every) - 1)]
        whole = [p for p in pairs if all(x.split() for x in p) and sum(len(x.split()) for x in p) >= op.MIN_WORDS]
        if len(gone) == 0:
            assert not [p for p in whole if p in seen_pairs]
        seen_lines.update(every)
        seen_pairs.update(whole)
    assert removed > 0


def test_few_words_and_single_lines_stay(spark):
    texts = ["x\ny\nz", "x\ny\nz", "one long line of some fifteen words " * 3, "one long line of some fifteen words " * 3]
    assert all(removed == 0 for _, _, removed in result(op.dedup_lines(documents(spark, texts))).values())


def test_null_and_repeated_ids_and_empty_table(spark):
    docs = documents(spark, [PASSAGE, PASSAGE, PASSAGE]).withColumn("doc_id", F.expr("nullif(doc_id, 1)"))
    got = {r.doc_id: r._lines.n_removed for r in op.dedup_lines(docs).collect()}
    assert got[2] == 0 and got[3] >= 8 and got[None] >= 8
    same = documents(spark, [PASSAGE, PASSAGE]).withColumn("doc_id", F.lit(5).cast("long"))
    assert rows(op.dedup_lines(same), "_lines.n_removed") == [(0,), (12,)]
    unnamed = same.withColumn("doc_id", F.lit(None).cast("long"))
    assert rows(op.dedup_lines(unnamed), "_lines.n_removed") == [(0,), (12,)]
    assert op.dedup_lines(docs.where("false")).collect() == []


def test_equal_digests_of_other_bytes_are_kept(spark, monkeypatch):
    docs = numbered(documents(spark, [PASSAGE, PASSAGE.replace("line", "LINE")]))
    made = op.chunk_digests(docs)
    forced = made.withColumn("digest", F.lit(b"0"))
    monkeypatch.setattr(op, "chunk_digests", lambda docs: forced)
    spans = op.repeated_spans(docs)
    assert spans.count() == 0


def test_only_what_equals_the_first_of_its_digest_goes(spark):
    found = [("a", 0, b"1", True, "x\ny"), ("b", 3, b"1", False, "x\ny"), ("c", 1, b"1", False, "x\nz")]
    found += [("a", 5, b"2", True, "u\nv"), ("c", 7, b"2", False, "u\nv"), ("d", 0, b"2", False, "u\nv")]
    kind = "row string, start int, digest binary, is_first boolean, content string"
    got = op.equal_to_first(spark.createDataFrame(found, kind).withColumn("n", F.lit(2)))
    assert rows(got, "row", "start") == [("b", 3), ("c", 7), ("d", 0)]


def test_occurrences_of_a_frequent_chunk_are_not_dealt_by_its_digest(spark):
    many = spark.range(0, 20_000, 1, 4).selectExpr(
        "cast(id as string) row", "0 start", "2 n", "binary('1') digest", "id = 0 is_first", "'x\ny' content"
    )
    done = op.equal_to_first(op.store(many, "many"))
    plan = done._jdf.queryExecution().optimizedPlan().toString()
    assert done.count() == 19_999 and "Join LeftAnti" in plan and "rightHint=(strategy=broadcast)" in plan


def test_boundaries_do_not_depend_on_what_stands_before():
    inside = defaultdict(set)
    for before in (0, 1, 5):
        every = [f"z{i}" for i in range(before)] + PASSAGE.split("\n")
        for k, cuts in enumerate(op.boundaries(every)):
            inside[k].add(tuple(c - before for c in cuts if c > before + 1))
    assert all(len(x) == 1 for x in inside.values())

import numpy as np
import pytest
from brute import rows
from compare import compare, sql_engine
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clickloom.llm import codes as op
from clickloom.llm.oracle import ORACLE_SQL
from clickloom.llm.queries import QUERIES


def brute(vectors, parts=8, entries=16, rounds=6):
    """Plain loops over (vec_id, label, integers): code and error of each row, and the books."""
    ordered = sorted(vectors, key=lambda v: (v[0] is None, v[0] or 0, v[2]))
    width = len(vectors[0][2]) // parts

    def cut(v, p):
        return v[2][p * width : (p + 1) * width]

    books = [[cut(v, p) for v in ordered[:entries]] for p in range(parts)]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            found = [[] for _ in books[p]]
            for v in vectors:
                found[near(cut(v, p), books[p])[1]].append(cut(v, p))
            books[p] = [[sum(c) // len(f) for c in zip(*f)] if f else e for f, e in zip(found, books[p])]
    out = []
    for v in vectors:
        best = [near(cut(v, p), books[p]) for p in range(parts)]
        out.append((v[0], "".join(f"{i:02x}" for _, i in best), sum(d for d, _ in best)))
    return out, books


def test_query_matches_sql(spark, sf_dir):
    found = compare(spark, sql_engine(sf_dir), QUERIES["op13_vector_codes"], ORACLE_SQL["op13_vector_codes"], sf_dir)
    assert found["values_match"] and found["types_match"], found


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 20), st.integers(1, 5), st.integers(0, 2**32), st.sampled_from([1, 3, 1000, 2**23]))
def test_the_search_finds_the_nearest_and_the_lower_of_equals(count, width, seed, scale):
    made = np.random.default_rng(seed)
    points = made.integers(-scale, scale + 1, (50, width))
    entries = made.integers(-scale, scale + 1, (count, width))
    index, best = op.nearest(points, entries)
    every = ((points[:, None, :] - entries[None]) ** 2).sum(axis=2)
    assert (index == every.argmin(axis=1)).all() and (best == every.min(axis=1)).all()


def test_the_search_leaves_entries_out(monkeypatch):
    """Far sums are never compared: that is what the sorted sums are for."""
    entries = np.arange(16)[:, None] * np.ones((1, 8), int) * 1000
    seen = []
    plain = np.einsum
    monkeypatch.setattr(np, "einsum", lambda form, a, b: seen.append(len(a)) or plain(form, a, b))
    index, _ = op.nearest(entries + 3, entries)
    assert index.tolist() == list(range(16)) and sum(seen) <= 2 * 16


def frame(spark, data, more=""):
    return spark.createDataFrame(data, f"vec_id long, embedding array<float>, label int{more}")


def test_against_plain_loops(spark):
    made = np.random.default_rng(1)
    data = [(int(i), made.normal(size=16).astype("float32").tolist(), int(i) % 3) for i in made.permutation(90)]
    data += [data[0], (None, data[1][1], None), (5, [0.0] * 16, None), (None, [-0.25] * 16, None)]
    bad = [(200, None, 1), (201, [None] + [0.0] * 15, 1), (202, [float("nan")] * 16, 1), (203, [float("-inf")] * 16, 1)]
    bad += [(204, [], 1), (205, [1.0] * 8, 1)]
    got = op.compress(frame(spark, data + bad).repartition(5)).collect()
    whole = [(i, y, [int(np.floor(4096 * np.float64(np.float32(x)))) for x in v]) for i, v, y in data]
    want, books = brute(whole)
    assert sorted(map(str, [(r.vec_id, r.code, r.error) for r in got])) == sorted(map(str, want))
    by_label = {}
    for (_, y, _), (_, _, error) in zip(whole, want):
        by_label[y] = by_label.get(y, 0) + error
    assert {r.label_error for r in got} == set(by_label.values())
    assert {r.codebooks_sha256 for r in got} == {op.books_digest(np.array(books))}


def test_few_vectors_empty_table_and_other_columns(spark):
    few = frame(spark, [(i, [float(i)] * 8, None, "c", 7) for i in (3, 1, 2)], ", code string, error long")
    got = op.compress(few)
    assert rows(got, "vec_id", "code", "error", "label_error") == [(1, "00" * 8, 0, 0), (2, "01" * 8, 0, 0), (3, "02" * 8, 0, 0)]
    assert op.compress(few.where("false")).collect() == []
    with pytest.raises(ValueError, match="8 parts"):
        op.compress(frame(spark, [(1, [0.0] * 9, 1)]))
    with pytest.raises(Exception, match="cannot be coded"):
        op.compress(frame(spark, [(1, [1e30] * 8, 1), (2, [0.0] * 8, 1)])).collect()


def test_a_hot_label_and_equal_vectors(spark):
    data = spark.range(3000).selectExpr("id as vec_id", "transform(sequence(1, 8), i -> cast(id % 5 as float)) as embedding", "1 as label")
    got = op.compress(data)
    assert got.count() == 3000 and got.select("label_error").distinct().count() == 1
    assert got.agg(F.sum("error")).first()[0] == got.first().label_error

import math
from collections import Counter

import pytest
from brute import CLASHES, DOCUMENTS, ODD_TEXTS, documents, rows
from compare import compare, sql_engine
from pyspark.sql import functions as F

from clickloom.llm import mixing as op
from clickloom.llm.oracle import ORACLE_SQL
from clickloom.llm.queries import QUERIES
from clickloom.llm.ranges import running


def water(sizes, weights, share=1.5, most=2):
    """Targets by sharing and sharing again; names in order."""
    whole, capped = share * sum(sizes.values()), {}
    while True:
        free = {k: w for k, w in weights.items() if k not in capped}
        left = whole - sum(capped.values())
        got = {k: left * w / sum(free.values()) for k, w in free.items()}
        over = {k: float(most * sizes[k]) for k in got if got[k] > most * sizes[k] + 1e-9}
        if not over:
            return capped | got
        capped |= over


def test_query_matches_sql(spark, sf_dir):
    found = compare(spark, sql_engine(sf_dir), QUERIES["op12_mixing"], ORACLE_SQL["op12_mixing"], sf_dir)
    assert found["values_match"] and found["types_match"], found


def corpus(spark, schema=DOCUMENTS):
    texts = [*ODD_TEXTS, *[f"w{i} " * (1 + i * 7 % 40) for i in range(200)]]
    docs = documents(spark, texts, schema=schema)
    source = "case when doc_id % 3 = 0 then 'hot' when doc_id % 17 = 0 then null when doc_id % 19 = 0 then '' else concat('s', doc_id % 4) end"
    return docs.withColumn("source", F.expr(source))


@pytest.mark.parametrize("schema", [DOCUMENTS, CLASHES])
def test_sources_come_to_their_targets(spark, schema):
    docs = corpus(spark, schema)
    got = op.curriculum(docs).collect()
    sizes, taken = Counter(), Counter()
    for r in got:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
    names = sorted(sizes, key=lambda x: (x is None, (x or "").encode()))
    weights = {x: (3, 1, 2)[i % 3] for i, x in enumerate(names)}
    want = water(sizes, weights)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert 0 <= r.taken <= 2 * r.size
        assert r.taken == sum(o.words for o in r.occurrences) and all(0 <= o.position < 1 for o in r.occurrences)
    assert {x: math.floor(want[x] + 1e-9) for x in names} == taken
    assert any(want[x] == 2 * sizes[x] for x in names) and any(want[x] < 2 * sizes[x] for x in names)
    texts = {r.doc_id: r.text for r in docs.collect()}
    separators = {c: " " for c in range(9, 14)}
    assert all(r.size == len([w for w in (texts[r.doc_id] or "").translate(separators).split(" ") if w]) for r in got)


def test_positions_follow_the_integrals_of_the_schedules(spark):
    """At any moment, what a source has given is its target times the share of its integral."""
    docs = spark.range(6000).selectExpr("id as doc_id", "concat('s', id % 3) as source", "repeat('w ', 10) as text")
    order = op.training_order(docs).collect()
    positions = [r.position for r in order]
    assert positions == sorted(positions)
    target = {r.source: r.target for r in op.curriculum(docs).select("source", "target").distinct().collect()}
    for number, source in enumerate(sorted(target)):
        knots = op.SCHEDULES[number]
        for t in (0.1, 0.3, 0.5, 0.9):
            reached = 0.0
            for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
                end = min(t, t1)
                if end > t0:
                    slope = (w1 - w0) / (t1 - t0)
                    reached += w0 * (end - t0) + slope * (end - t0) ** 2 / 2
            given = sum(r.words for r in order if r.source == source and r.position < t)
            assert given == pytest.approx(target[source] * reached / op.integral(knots), abs=10.5)
    assert sum(r.words for r in order) == sum(int(x) for x in target.values())


def test_reruns_agree_however_the_rows_lie(spark):
    docs = corpus(spark)
    docs = docs.unionAll(docs.where("doc_id < 50"))
    first = rows(op.curriculum(docs).drop("occurrences"))
    assert rows(op.curriculum(docs.repartition(7)).drop("occurrences")) == first


def test_a_second_epoch_starts_when_the_first_is_through(spark):
    docs = spark.createDataFrame([(i, "a b", "s") for i in range(10)], "doc_id long, text string, source string")
    got = op.curriculum(docs).collect()
    assert {r.target for r in got} == {30.0} and sum(r.taken for r in got) == 30
    first = [o for r in got for o in r.occurrences if o.epoch == 0]
    again = [o for r in got for o in r.occurrences if o.epoch == 1]
    assert len(first) == 10 and max(o.position for o in first) < min(o.position for o in again)


def test_null_ids_no_words_and_empty_tables(spark):
    docs = documents(spark, [None, "", " "], source=None).withColumn("doc_id", F.lit(None).cast("long"))
    assert rows(op.curriculum(docs), "size", "source_size", "target", "taken") == [(0, 0, 0.0, 0)] * 3
    assert op.curriculum(docs.where("false")).collect() == []
    assert op.training_order(docs).collect() == []


def test_running_totals_over_ranges(spark):
    data = spark.range(1000).selectExpr("id % 7 as k", "id as v", "if(id % 2 = 0, null, 'x') as other").repartition(9)
    got = running(data, [F.asc("k"), F.asc("v")], {"total": F.col("v"), "place": F.lit(1).cast("long")})
    every = sorted((i % 7, i) for i in range(1000))
    total, want = 0, []
    for place, (k, v) in enumerate(every, 1):
        total += v
        want.append((k, v, total, place))
    assert sorted(map(tuple, got.select("k", "v", "total", "place").collect())) == want
    assert running(data.where("false"), [F.asc("k")], {"n": F.col("v")}).collect() == []

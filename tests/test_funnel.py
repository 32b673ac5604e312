import random
from collections import Counter, defaultdict

import pytest
from helpers import actions, rows
from pyspark.sql import functions as F

from clickloom.operators import funnel


def visits(spark, pages, session="s"):
    return [
        {"session_id": session, "page_id": page, "action_time": f"2024-01-01 10:00:{i:02}"}
        for i, page in enumerate(pages)
    ]


def ratio(spark, data, flow, **options):
    return rows(funnel.page_jump_ratio(actions(spark, data), flow, **options))


def test_there_and_back(spark):
    data = visits(spark, [1, 2, 1])
    assert ratio(spark, data, ["1", "2"]) == [("1-2", 0.5)]
    assert ratio(spark, data, ["1", "2"], reverse=True) == [("1-2", 0.5)]


def test_back_only(spark):
    data = visits(spark, [2, 1])
    assert ratio(spark, data, ["1", "2"]) == []
    assert ratio(spark, data, ["1", "2"], reverse=True) == [("1-2", 1.0)]


def test_sessions_are_separate(spark):
    assert ratio(spark, visits(spark, [1], "a") + visits(spark, [2], "b"), ["1", "2"]) == []


def test_flow_with_repeats_is_a_set(spark):
    assert funnel.flow_pairs(["1", "2", "1", "2"]) == [(1, 2), (2, 1)]
    assert funnel.flow_pages(["1", "2", "1", "3"]) == [1, 2]
    assert ratio(spark, visits(spark, [1, 2]), ["1", "2", "1", "2"]) == [("1-2", 1.0)]


def test_other_pages_break_a_pair(spark):
    assert ratio(spark, visits(spark, [1, 9, 2]), ["1", "2"]) == []


def test_equal_times_follow_the_next_order_column(spark):
    frame = spark.createDataFrame(
        [("s", 2, "2024-01-01 10:00:00", 7), ("s", 1, "2024-01-01 10:00:00", 5)],
        "session_id string, page_id long, action_time string, event_id long",
    )
    found = funnel.page_jumps(frame, [(1, 2), (2, 1)], ["action_time", "event_id"])
    assert rows(found) == [(1, 2, 1)]


def test_pairs_across_slices(spark, monkeypatch):
    monkeypatch.setattr(funnel, "SAMPLES", 1)
    times = ["2024-01-01 10:59:59", "2024-01-01 11:00:00", "2024-01-03 00:00:00"]
    data = [{"session_id": "s", "page_id": i + 1, "action_time": t} for i, t in enumerate(times)]
    assert rows(funnel.page_jumps(actions(spark, data), [(1, 2), (2, 3)], whole_below=0)) == [(1, 2, 1), (2, 3, 1)]


def test_page_views(spark):
    data = visits(spark, [1, 1, 2, 3])
    assert rows(funnel.page_views(actions(spark, data), [1, 2, 9])) == [(1, 2), (2, 1)]


def test_no_pairs(spark):
    assert ratio(spark, [], ["1", "2"]) == []


def hot_session(seconds):
    """4,000 visits, some without a session, more than a third in one session."""
    rng = random.Random(2)
    data = []
    for event_id in range(4000):
        second = rng.randrange(seconds)
        time = f"2024-01-01 {second // 3600:02}:{second // 60 % 60:02}:{second % 60:02}"
        session = None if rng.random() < 0.05 else "hot" if rng.random() < 0.4 else f"s{rng.randrange(300)}"
        data.append((session, rng.randrange(1, 5), time, event_id))
    return data


VISIT = "session_id string, page_id long, action_time string, event_id long"
ORDER = ["action_time", "event_id"]


@pytest.mark.parametrize("seconds, samples, block", [(6 * 3600, 32, 64), (60, 32, 64), (1, 4, 3), (60, 1, 64)])
@pytest.mark.parametrize("whole_below", [0, funnel.WHOLE_BELOW])
def test_against_brute_force_with_a_hot_session(spark, monkeypatch, seconds, samples, block, whole_below):
    monkeypatch.setattr(funnel, "SAMPLES", samples)
    monkeypatch.setattr(funnel, "BLOCK", block)
    data = hot_session(seconds)
    by_session = defaultdict(list)
    for session, page, time, event_id in data:
        by_session[session].append((time, event_id, page))
    pairs = [(1, 2), (2, 3), (3, 3), (4, 1)]
    expected = Counter()
    for visited in by_session.values():
        pages = [page for _, _, page in sorted(visited)]
        expected.update(pair for pair in zip(pages, pages[1:]) if pair in pairs)
    frame = spark.createDataFrame(data, VISIT)
    found = funnel.page_jumps(frame, pairs, ORDER, whole_below)
    assert {(a, b): n for a, b, n in rows(found)} == dict(expected)
    views = Counter(page for _, page, _, _ in data)
    ratios = {f"{a}-{b}": expected[a, b] / views[a] for a, b in [(1, 2), (2, 3)]}
    assert dict(rows(funnel.page_jump_ratio(frame, ["1", "2", "3"], order_by=ORDER, whole_below=whole_below))) == ratios


def test_a_hot_minute_of_one_session_is_cut_by_its_rows(spark):
    frame = spark.createDataFrame(hot_session(60), VISIT)
    sliced = funnel.with_slices(frame, funnel.session_cuts(frame, ORDER), ORDER)
    hot = sliced.where("session_id = 'hot'").groupBy("slice").count()
    sizes = [n for _, n in rows(hot)]
    # Four slices for each of the four shuffle partitions, more than a third of them here.
    assert len(sizes) >= 4 and max(sizes) < 4000 / 4
    assert sliced.where("session_id <> 'hot' and slice is not null").isEmpty()


def test_only_slices_of_cut_sessions_are_stitched(spark, monkeypatch):
    stored = {}
    kept = funnel.store
    monkeypatch.setattr(funnel, "store", lambda df, name: stored.setdefault(name, kept(df, name)))
    frame = spark.createDataFrame(hot_session(60), VISIT)
    rows(funnel.page_jumps(frame, [(1, 2)], ORDER, whole_below=0))
    slices = stored["session-slices"]
    cut = slices.where("slice is not null")
    assert 0 < cut.count() <= 2 * 16 and slices.count() <= 2 * 16 + 302

"""Page views and page-to-page jump rates along a configured flow."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.operators.joins import estimated_bytes, join_on, lookup
from clickloom.session import store

# Actions of fewer bytes (as stored) than this are sorted session by session, as they are.
WHOLE_BELOW = 64 << 20
# Sampled rows for each slice that a session is cut into, and slices for each shuffle partition.
SAMPLES = 32
SLICES = 4
# Cuts are looked up in blocks of so many, and a session has at most the square of it.
BLOCK = 64


def flow_pages(flow: Sequence[str]) -> list[int]:
    """The pages of a flow that can be left: all but the last, each once."""
    return list(dict.fromkeys(int(page) for page in flow[:-1]))


def flow_pairs(flow: Sequence[str]) -> list[tuple[int, int]]:
    """Adjacent pages of a flow, each pair once."""
    return list(dict.fromkeys((int(a), int(b)) for a, b in zip(flow, flow[1:])))


def page_views(actions: DataFrame, pages: Sequence[int]) -> DataFrame:
    """Views of each of the given pages."""
    return (
        actions.where(F.col("page_id").isin(*pages))
        .groupBy("page_id")
        .agg(F.count("*").alias("views"))
    )


def page_jumps(
    actions: DataFrame,
    pairs: Sequence[tuple[int, int]],
    order_by: Sequence[str] = ("action_time", "page_id"),
    whole_below: int = WHOLE_BELOW,
) -> DataFrame:
    """How often a session goes from one page directly to another, for ``pairs``.

    A session is read in the order of ``order_by``; add a unique last column where
    the data has one. Pairs that never occur are absent.

    In large data a session with more rows than a part of a shuffle partition is cut into
    slices of about that many rows, wherever in time they lie (``with_slices``), so that no
    task has to sort a huge session. A slice is reduced to its pair counts and its first and
    last page; the moves from one slice to the next are found from those rows, one per slice
    of the sessions that were cut. Smaller data than ``whole_below`` is not cut.
    """
    totals = _totals(actions, pairs, [], order_by, whole_below)
    return totals.select(F.inline(_per_pair(pairs))).where(F.col("jumps") > 0)


def session_cuts(rows: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """(session_id, blocks) for the sessions that need be cut: the order values at which a
    slice begins, in blocks. They come from a sample; they decide where rows are worked on
    and never what comes out."""
    slices = SLICES * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = min(1.0, slices * SAMPLES / max(1, rows.count()))
    place = F.row_number().over(Window.partitionBy("session_id").orderBy("at"))
    number = F.count("*").over(Window.partitionBy("session_id"))
    sample = rows.where(F.rand(7) < share).select("session_id", F.struct(*order_by).alias("at"))
    step = F.greatest(F.lit(SAMPLES), F.ceil(F.col("number") / (BLOCK * BLOCK)))
    chosen = sample.select("*", place.alias("place"), number.alias("number")).where(
        (F.col("number") >= 2 * SAMPLES) & (F.col("place") % step == 0)
    )
    cuts = chosen.groupBy("session_id").agg(F.array_sort(F.array_distinct(F.collect_list("at"))).alias("cuts"))
    starts = F.sequence(F.lit(1), F.size("cuts"), F.lit(BLOCK))
    return cuts.select("session_id", F.transform(starts, lambda i: F.slice("cuts", i, BLOCK)).alias("blocks"))


def with_slices(rows: DataFrame, cuts: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """``rows`` with the number of their slice, null in sessions that were not cut."""
    at = F.struct(*order_by)
    met = join_on(rows, lookup(cuts), ["session_id"], "left").withColumn("_at", at)
    block = F.size(F.filter("blocks", lambda b: b[0] <= F.col("_at")))
    within = F.size(F.filter(F.col("blocks")[F.col("_block") - 1], lambda x: x <= F.col("_at")))
    inside = F.when(F.col("_block") == 0, 0).otherwise((F.col("_block") - 1) * BLOCK + within)
    found = met.withColumn("_block", block).withColumn("slice", F.when(F.col("blocks").isNotNull(), inside))
    return found.drop("blocks", "_at", "_block")


def _per_pair(pairs: Sequence[tuple[int, int]]) -> Column:
    return F.array(
        *[
            F.struct(
                F.lit(a).cast("long").alias("from_page"),
                F.lit(b).cast("long").alias("to_page"),
                F.col(f"jumps_{i}").alias("jumps"),
            )
            for i, (a, b) in enumerate(pairs)
        ]
    )


def _moved(from_page: str, to_page: str, pair: tuple[int, int]) -> Column:
    return F.count_if((F.col(from_page) == pair[0]) & (F.col(to_page) == pair[1]))


def _totals(
    actions: DataFrame,
    pairs: Sequence[tuple[int, int]],
    pages: Sequence[int],
    order_by: Sequence[str],
    whole_below: int,
) -> DataFrame:
    """One row: jumps_0.. of the pairs and views_0.. of the pages."""
    rows = actions.select("session_id", *dict.fromkeys(["page_id", *order_by]))

    def counts(next_page: str) -> list[Column]:
        return [
            *[_moved("page_id", next_page, pair).alias(f"jumps_{i}") for i, pair in enumerate(pairs)],
            *[F.count_if(F.col("page_id") == page).alias(f"views_{i}") for i, page in enumerate(pages)],
        ]

    if estimated_bytes(rows) < whole_below:
        in_session = Window.partitionBy("session_id").orderBy(*order_by)
        return rows.select("page_id", F.lead("page_id").over(in_session).alias("next_page")).agg(*counts("next_page"))

    cuts = store(session_cuts(rows, order_by), "session-cuts")
    in_slice = Window.partitionBy("session_id", "slice").orderBy(*order_by)
    steps = with_slices(rows, cuts, order_by).select(
        "session_id",
        "slice",
        "page_id",
        F.lead("page_id").over(in_slice).alias("next_page"),
        F.lag(F.lit(1)).over(in_slice).isNull().alias("is_first"),
        F.lead(F.lit(1)).over(in_slice).isNull().alias("is_last"),
    )
    ends = [F.max(F.when(F.col(f"is_{x}"), F.col("page_id"))).alias(f"{x}_page") for x in ("first", "last")]
    slices = store(steps.groupBy("session_id", "slice").agg(*counts("next_page"), *ends), "session-slices")
    # Only slices of sessions that were cut are brought together.
    in_order = Window.partitionBy("session_id").orderBy("slice")
    linked = slices.where("slice is not null").withColumn("next_first_page", F.lead("first_page").over(in_order))
    names = [*[f"jumps_{i}" for i in range(len(pairs))], *[f"views_{i}" for i in range(len(pages))]]
    links = linked.agg(
        *[_moved("last_page", "next_first_page", pair).alias(f"jumps_{i}") for i, pair in enumerate(pairs)],
        *[F.lit(0).cast("long").alias(f"views_{i}") for i in range(len(pages))],
    )
    sums = [F.sum(x).alias(x) for x in names]
    return slices.agg(*sums).unionByName(links).agg(*sums)


def page_jump_ratio(
    actions: DataFrame,
    flow: Sequence[str],
    reverse: bool = False,
    order_by: Sequence[str] = ("action_time", "page_id"),
    whole_below: int = WHOLE_BELOW,
) -> DataFrame:
    """Jumps per view of the pair's first page, as (page_jump "a-b", ratio).

    ``reverse`` counts the moves from b back to a instead, still named "a-b" and
    still divided by the views of a.
    """
    pairs, pages = flow_pairs(flow), flow_pages(flow)
    moves = [(b, a) for a, b in pairs] if reverse else pairs
    totals = _totals(actions, moves, pages, order_by, whole_below)
    ratios = F.array(
        *[
            F.struct(
                F.lit(f"{a}-{b}").alias("page_jump"),
                F.col(f"jumps_{i}").alias("jumps"),
                F.greatest(F.col(f"views_{pages.index(a)}"), F.lit(1)).alias("views"),
            )
            for i, (a, b) in enumerate(pairs)
        ]
    )
    found = totals.select(F.inline(ratios)).where(F.col("jumps") > 0)
    return found.select("page_jump", (F.col("jumps").cast("double") / F.col("views").cast("double")).alias("ratio"))

"""Mixing sources to target weights by a curriculum that changes over the training.

Every source has a schedule, a weight for each moment of the training from 0 to 1, linear
between knots. Its integral is the source's weight in the whole mix; weights share the words
wanted, no source gives more than ``most`` times what it has, and what is left over is shared
again by weight: with the sources in order of cap over weight that is one running total.

A source's documents are laid end to end in an order drawn from their ids, as often as the
target asks for. So each of them begins at a known share of the source's demand, and the
moment at which the integral of the schedule reaches that share is its training position.
The last document of a source is cut where the target is reached. Sorted by position, in
ranges, the documents are the training order. Only ids, sources and sizes are shuffled.

Defined results: a null text, and one without words, has size 0 and is taken with 0 words.
A null source is a source of its own and the last; an empty name is one like others. Null
ids are drawn as the empty id. Repeated rows are laid end to end like others; which of two
rows alike in id, source and size comes first does not show. Without any words the targets
are 0. An empty table gives no rows. Columns other than id, text and source are not looked at.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.ranges import running
from clickloom.operators.joins import join_on, lookup
from clickloom.session import store

WORD = r"[^\x20\x09-\x0D]+"
Schedule = Sequence[tuple[float, float]]
#: (moment, weight) knots; the integrals are 3, 1 and 2.
SCHEDULES: tuple[Schedule, ...] = (
    ((0.0, 4.0), (1.0, 2.0)),
    ((0.0, 0.5), (0.5, 0.5), (1.0, 2.5)),
    ((0.0, 2.0), (1.0, 2.0)),
)
SHARE = 1.5
MOST = 2
SEED = 42


def integral(schedule: Schedule) -> float:
    return sum((t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(schedule, schedule[1:]))


def moment(schedule: Schedule, share: Column) -> Column:
    """The moment at which the integral of ``schedule`` reaches ``share`` of the whole."""
    wanted = share * integral(schedule)
    found, before = F.lit(schedule[-1][0]), integral(schedule)
    for (t0, w0), (t1, w1) in reversed(list(zip(schedule, schedule[1:]))):
        area = (t1 - t0) * (w0 + w1) / 2
        before -= area
        part = wanted - before
        slope = (w1 - w0) / (t1 - t0)
        # The root of w0 x + slope x^2 / 2 = part, in the form that also holds for slope 0.
        root = 2 * part / (F.sqrt(F.lit(w0 * w0) + 2 * slope * part) + w0)
        found = F.when(wanted < before + area, F.when(part > 0, t0 + root).otherwise(t0)).otherwise(found)
    return found


def _pick(values: Sequence, place: Column) -> Column:
    """``values`` in turn, by a place that counts from 1."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), ((place - 1) % len(values) + 1).cast("int"))


def targets(rows: DataFrame, weights: Sequence[float], share: float = SHARE, most: int = MOST) -> DataFrame:
    """source, source_size, place (from 1), start (words of earlier sources) and target."""
    sources = store(rows.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    one = F.lit(1).cast("long")
    named = running(sources, [F.asc_nulls_last("source")], {"place": one, "start": F.col("source_size")})
    named = named.withColumn("weight", _pick(weights, F.col("place"))).withColumn("cap", F.col("source_size") * most)
    named = store(named.withColumn("start", F.col("start") - F.col("source_size")), "weighted-sources")
    whole = named.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    if whole["weight"] is None:
        return named.select("source", "source_size", "place", "start", F.lit(0.0).alias("target"))
    # Sources with little to give for their weight are met first; those before the first one
    # that can give its share give all they may.
    ratio = F.col("source_size") / F.col("weight")
    met = named.withColumn("ratio", ratio)
    summed = running(met, [F.asc("ratio"), F.asc("place")], {"caps": F.col("cap"), "weights": F.col("weight")})
    left = F.lit(share * whole["size"]) - (F.col("caps") - F.col("cap"))
    level = left / (F.lit(whole["weight"]) - (F.col("weights") - F.col("weight")))
    enough = summed.withColumn("level", level).where(F.col("level") * F.col("weight") <= F.col("cap"))
    level = enough.agg(F.min_by("level", F.struct("ratio", "place"))).first()[0]
    target = F.least(F.col("cap").cast("double"), F.col("weight") * F.lit(level))
    return named.select("source", "source_size", "place", "start", target.alias("target"))


def curriculum(
    docs: DataFrame,
    schedules: Sequence[Schedule] = SCHEDULES,
    share: float = SHARE,
    most: int = MOST,
    seed: int = SEED,
) -> DataFrame:
    """doc_id, source, size, source_size, target, taken and occurrences of every row of
    ``docs``; an occurrence is (epoch, position, words). In order of the first position; rows
    that are not taken come last."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size")
    rows = store(docs.select("doc_id", "source", size, F.monotonically_increasing_id().alias("row")), "sizes")
    weights = [integral(s) for s in schedules]
    sources = store(targets(rows, weights, share, most), "targets")
    draw = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    drawn = rows.withColumn("draw", draw)
    order = [F.asc_nulls_last("source"), *map(F.asc, ["draw", "doc_id", "size", "row"])]
    laid = join_on(running(drawn, order, {"end": F.col("size")}), lookup(sources), ["source"])
    begin = F.col("end") - F.col("size") - F.col("start")
    asked = F.floor("target").cast("long")
    occurrences = []
    for epoch in range(most):
        at = begin + F.col("source_size") * epoch
        words = F.greatest(F.lit(0), F.least(F.col("size"), asked - at)).cast("long")
        met = [moment(s, F.try_divide(at, F.col("target"))) for s in schedules]
        position = F.element_at(F.array(*met), ((F.col("place") - 1) % len(schedules) + 1).cast("int"))
        occurrences.append(F.struct(F.lit(epoch).alias("epoch"), position.alias("position"), words.alias("words")))
    taken = F.filter(F.array(*occurrences), lambda x: x["words"] > 0).alias("occurrences")
    mixed = laid.select("doc_id", "source", "size", "source_size", "target", taken)
    total = F.aggregate("occurrences", F.lit(0).cast("long"), lambda n, x: n + x["words"]).alias("taken")
    mixed = mixed.select("doc_id", "source", "size", "source_size", "target", total, "occurrences")
    # Documents without words have no occurrence and sort last, dealt by id.
    return mixed.orderBy(F.asc_nulls_last(F.get("occurrences", F.lit(0))["position"]), "doc_id", "source", "size")


def training_order(docs: DataFrame, **options) -> DataFrame:
    """One row (position, epoch, doc_id, source, words) for every time a document is met, in
    the order of the training."""
    mixed = curriculum(docs, **options).select("doc_id", "source", F.explode("occurrences").alias("o"))
    rows = mixed.select("o.position", "o.epoch", "doc_id", "source", "o.words")
    return rows.orderBy("position", "doc_id", "source", "epoch", "words")

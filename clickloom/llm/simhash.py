"""SimHash near-duplicates by covering locality-sensitive hashing.

A fingerprint has a bit set where more than half of the shingles' hashes have it. Two
fingerprints are linked when they differ in at most ``radius`` bits.

Tables: every bit position gets a vector of ``radius + 1`` bits. For each non-zero vector
v, table v keeps the positions whose vector has an odd product with v and clears the
others. The vectors of at most ``radius`` differing positions cannot span the whole
space, so some v is orthogonal to all of them: in that table the two fingerprints are
equal. Every pair within the radius therefore meets in one of the 2^(radius+1) - 1
tables; there is nothing probabilistic about recall.

Within a table, equal keys form a bucket. A bucket gives a spanning forest of its links,
not its pairs. A bucket of more than ``block`` fingerprints is cut into blocks, each two
blocks meet in one task, and again only a forest leaves it; no bucket is ever gathered
whole. Components are found by alternating star steps over the stored links.

Defined results: a null text, and one without words, has fingerprint zero. Rows are
fingerprinted one by one, repeated rows and repeated ids included. A null id never
becomes a component id unless all ids of the component are null. An empty table gives
no rows. Other columns are not looked at.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import drop_rows, numbered
from clickloom.operators.joins import lookup
from clickloom.session import store

BITS = 64
SEED = 42


def fingerprint_of(text: str | None, size: int) -> int:
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) <= size:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    else:
        digest, join = xxhash.xxh64_intdigest, b" ".join
        hashes = [digest(join(run), SEED) for run in zip(*(words[i:] for i in range(size)))]
    bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    majority = bits.sum(axis=0, dtype=np.int64) * 2 > len(hashes)
    return int(np.packbits(majority, bitorder="little").view("<i8")[0])


def fingerprint(text: Column, size: int = 4) -> Column:
    """The 64-bit fingerprint over shingles of ``size`` words, as a signed long."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint_of(x, size) for x in texts], dtype="int64")

    return of(text)


def covering_masks(radius: int, bits: int = BITS) -> list[int]:
    """One mask for each non-zero v. The vectors of the positions run through all non-zero
    ones in turn, so that every mask keeps about half of the positions."""
    n = 2 ** (radius + 1) - 1
    vectors = [i % n + 1 for i in range(bits)]
    masks = [sum(1 << i for i, x in enumerate(vectors) if (x & v).bit_count() % 2) for v in range(1, n + 1)]
    return [m - (1 << bits) if m >> (bits - 1) else m for m in masks]


def forest(points: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links that join exactly what links within the radius join; fewer than there are points."""
    links = []
    rest = points.view(np.uint64)
    while len(rest):
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            x = queue.pop()
            near = np.bitwise_count(rest ^ x) <= radius
            if near.any():
                found = rest[near]
                links += [(x, y) for y in found]
                queue += list(found)
                rest = rest[~near]
    return [(int(x), int(y)) for x, y in np.array(links, np.uint64).view(np.int64).reshape(-1, 2)]


def _bucket_links(radius: int):
    """Links of consecutive rows of one bucket (table, key, block pair), over sorted rows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept = None
        for batch in batches:
            rows = batch if kept is None else pd.concat([kept, batch])
            keys = rows[["v", "key", "a", "b"]].to_numpy()
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            last = int(cuts[-1]) if len(cuts) else 0
            kept = rows.iloc[last:]
            yield _links(rows["fp"].to_numpy()[:last], cuts[:-1], radius)
        if kept is not None and len(kept):
            yield _links(kept["fp"].to_numpy(), [], radius)

    return run


def _links(points: np.ndarray, cuts, radius: int) -> pd.DataFrame:
    links: list[tuple[int, int]] = []
    for part in np.split(points, cuts):
        if len(part) == 2:
            x, y = part.tolist()
            if ((x ^ y) & 0xFFFFFFFFFFFFFFFF).bit_count() <= radius and x != y:
                links.append((x, y))
        elif len(part) > 2:
            links += forest(np.unique(part), radius)
    return pd.DataFrame(links, columns=["x", "y"], dtype="int64")


def links(points: DataFrame, radius: int = 4, block: int = 2048) -> DataFrame:
    """Links (x, y) between distinct fingerprints ``fp``; joined up, they join what all
    links within the radius would join."""
    spark = points.sparkSession
    tables = F.explode(
        F.array(
            *[
                F.struct(F.lit(i).alias("v"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
                for i, m in enumerate(covering_masks(radius))
            ]
        )
    ).alias("t")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = points.select("fp", tables).select("fp", "t.v", "t.key").repartition(n, "v", "key")
    sizes = keyed.groupBy("v", "key").agg(F.count("*").alias("n")).where("n > 1")
    members = keyed.join(sizes, ["v", "key"]).withColumn("blocks", F.ceil(F.col("n") / block).cast("int"))
    # Block i meets every block: it goes to the pairs (i, j) and (j, i), smaller number first.
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    others = F.sequence(F.lit(0), F.col("blocks") - 1)
    paired = (
        members.withColumn("i", own)
        .withColumn("j", F.explode(others))
        .select("fp", "v", "key", F.least("i", "j").alias("a"), F.greatest("i", "j").alias("b"))
    )
    dealt = paired.repartition(n, "v", "key", "a", "b").sortWithinPartitions("v", "key", "a", "b")
    return dealt.mapInPandas(_bucket_links(radius), "x long, y long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of an edge; the root is the smallest node reachable.

    Alternating star steps: first every larger neighbour is tied to the smallest one, then
    every smaller one. Each step's links are written out, so lineage stays short.
    """
    now = store(edges.where("x <> y").select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")), "links")
    mark = None
    while True:
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        tied = large.join(small, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = store(tied.unionAll(small.select("u", F.col("m").alias("v"))).distinct(), "links")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == mark:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(
                now.select("v", "v").distinct().toDF("node", "root")
            )
        mark = state


def near_duplicates(docs: DataFrame, size: int = 4, radius: int = 4, block: int = 2048) -> DataFrame:
    """doc_id, row (its key, own or ``_row``), fp, root (the smallest print reachable) and component_id (the
    smallest doc_id reachable) of every row of ``docs``."""
    prints = fingerprint(F.col("text"), size).alias("fp")
    row = F.col("_row") if "_row" in docs.columns else F.monotonically_increasing_id()
    rows = store(docs.select("doc_id", row.alias("row"), prints), "fingerprints")
    nodes = rows.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = components(links(nodes.select("fp"), radius, block)).withColumnRenamed("node", "fp")
    named = nodes.join(roots, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    named = store(named, "nodes-with-roots")
    # Fewer rows than fingerprints: where they are small, the others meet them where they lie.
    ids = store(named.groupBy("root").agg(F.min("first").alias("component_id")), "component-ids")
    component = store(named.join(lookup(ids), "root").select("fp", "root", "component_id"), "components-of-prints")
    return rows.join(lookup(component), "fp").select("doc_id", "row", "fp", "root", "component_id")


def keep_one(docs: DataFrame, size: int = 4, radius: int = 4) -> DataFrame:
    """The documents less all but one of each component; every column is kept.

    The one that stays has the component's smallest id; of several rows with that id, or
    without any, the one with the smallest row key. So of equal rows one stays as well.
    """
    docs = numbered(docs)
    found = near_duplicates(docs.select("_row", "doc_id", "text"), size, radius)
    # Components go by their root: unlinked ones may have the same smallest id, or none.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "row")).alias("first")
    found = store(found, "components")
    firsts = store(found.groupBy("root").agg(first).select("root", F.col("first.row").alias("stays")), "rows-to-keep")
    gone = found.join(lookup(firsts), "root").where("row <> stays")
    return drop_rows(docs, gone.select(F.col("row").alias("_row")))

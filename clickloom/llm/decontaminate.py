"""Benchmark decontamination with a distributed positional inverted index.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z. The index has one
row for each term and document with the sorted positions. It is built in one pass over the
texts and stored sorted by term; a frequent term is spread over many rows, files and tasks.

A phrase search ranks the terms of each phrase by their count in the index. The list of
the rarest term, shifted by the term's place, gives the candidate starts; they are
intersected with the second rarest term's shifted list, and what is left with all others.
A proximity search needs the phrase's terms in order, each at most ``slack`` words later
than in the phrase (gaps allowed): the rarest term again gives the candidates.

Which postings are stored: those of the test terms. For a search of exact phrases only,
``runs`` leaves out words that can be in no phrase because fewer neighbours than its
length are test terms too; the results are the same. The test terms are given to the tasks
only if there are at most ``max_terms`` of them; beyond that every term is posted and
the search's joins select.

Defined results: a null or empty text has no words, no hits and stays; an item without a
word has no window. Rows are matched one by one under an own row number, so repeated ids
and null ids give one row each; equal items are both reported. An empty benchmark hits
nothing. Other columns are not looked at.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.llm.common import drop_rows, numbered, sha256
from clickloom.session import store

WINDOW = 10
MAX_TERMS = 500_000
_BLANK = bytes(c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))
POSTINGS = "row long, doc_id {}, n_words long, postings array<struct<term:string,at:array<int>>>"


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").lower().translate(_BLANK).split()


def word_array(text: str) -> Column:
    @F.pandas_udf("array<string>")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([[w.decode() for w in words(x)] for x in texts])

    return of(text)


def windows(items: DataFrame, size: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """Distinct phrases (phrase, terms) and which items have them (phrase, item_id)."""
    listed = items.select("item_id", word_array("text").alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - (size - 1), F.lit(1)))
    each = listed.select("item_id", "w", F.explode(starts).alias("s")).select(
        "item_id", F.slice("w", F.col("s"), F.lit(size)).alias("terms")
    )
    each = each.select("item_id", "terms", F.array_join("terms", " ").alias("phrase"))
    return each.select("phrase", "terms").distinct(), each.select("phrase", "item_id").distinct()


def in_run(known: np.ndarray, length: int) -> np.ndarray:
    """Which places are in a run of at least ``length`` true values."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], known.astype(np.int8), [0]))))
    out = np.zeros(len(known), bool)
    for start, end in edges.reshape(-1, 2)[np.diff(edges)[::2] >= length]:
        out[start:end] = True
    return out


def post(docs: DataFrame, vocabulary: dict[str, list[int]] | None, runs: bool) -> DataFrame:
    """A row per document with its word count and the positions of the chosen terms.

    ``vocabulary`` has the lengths of the phrases that a term is in; None posts all terms.
    """
    bits = None
    if vocabulary is not None:
        bits = {t.encode(): sum(1 << n for n in set(sizes)) for t, sizes in vocabulary.items()}
    lengths = sorted({n for sizes in (vocabulary or {}).values() for n in sizes})

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            counts, lists = [], []
            for text in batch["text"]:
                found = words(text)
                counts.append(len(found))
                if bits is None:
                    keep = range(len(found))
                else:
                    flags = np.fromiter(map(bits.get, found, [0] * len(found)), np.int64, len(found))
                    if runs:
                        chosen = np.zeros(len(found), bool)
                        for n in lengths:
                            chosen |= in_run(flags >> n & 1 == 1, n)
                    else:
                        chosen = flags > 0
                    keep = np.flatnonzero(chosen).tolist()
                at: dict[bytes, list[int]] = {}
                for i in keep:
                    at.setdefault(found[i], []).append(i)
                lists.append([{"term": t.decode(), "at": places} for t, places in at.items()])
            ids = batch["doc_id"].astype("Int64") if kind == "bigint" else batch["doc_id"]
            yield pd.DataFrame({"row": batch["row"], "doc_id": ids, "n_words": counts, "postings": lists})

    kind = "binary" if docs.schema["doc_id"].dataType == T.BinaryType() else "bigint"
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast(kind), "text")
    return rows.mapInPandas(place, POSTINGS.format(kind))


class Index:
    """``documents``: row, doc_id, n_words. ``postings``: term, row, at; stored by term."""

    def __init__(self, docs: DataFrame, phrases: DataFrame, runs: bool = True, max_terms: int = MAX_TERMS):
        terms = phrases.select(F.explode("terms").alias("term"), F.size("terms").alias("n"))
        terms = terms.groupBy("term").agg(F.collect_set("n").alias("sizes"))
        listed = terms.limit(max_terms + 1).collect()  # bounded: a check of the size
        vocabulary = {r.term: r.sizes for r in listed} if len(listed) <= max_terms else None
        forward = store(post(docs, vocabulary, runs), "postings-of-documents")
        self.documents = forward.select("row", "doc_id", "n_words")
        lists = forward.select("row", F.explode("postings").alias("p")).select("p.term", "row", "p.at")
        if vocabulary is None:
            lists = lists.join(terms.select("term"), "term", "left_semi")
        parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        self.runs = runs
        by_term = lists.repartitionByRange(parts, "term", "row").sortWithinPartitions("term", "row")
        self.postings = store(by_term, "inverted-index")

    def ranked(self, phrases: DataFrame) -> DataFrame:
        """phrase, size, rank (0: the rarest term's place), term, place; phrases with a term
        that the index does not have are left out."""
        counts = self.postings.groupBy("term").agg(F.sum(F.size("at")).alias("n"))
        places = phrases.select("phrase", F.size("terms").alias("size"), F.posexplode("terms").alias("place", "term"))
        order = "row_number() over (partition by phrase order by n, term, place) - 1 as rank"
        known = places.join(counts, "term").selectExpr(
            "phrase", "size", "term", "place", order, "count(*) over (partition by phrase) as have"
        )
        return known.where("have = size").drop("have")

    def phrase_matches(self, phrases: DataFrame) -> DataFrame:
        """phrase, row, start, size of every exact occurrence."""
        ranked = store(self.ranked(phrases), "ranked-terms")
        first = ranked.where("rank = 0").drop("rank")
        found = (
            first.join(self.postings, "term")
            .select("phrase", "size", "row", "place", F.explode("at").alias("start"))
            .selectExpr("phrase", "size", "row", "start - place as start")
            .where("start >= 0")
        )
        second = ranked.where("rank = 1").select("phrase", "term", "place")
        single, longer = found.where("size = 1"), found.where("size > 1")
        paired = longer.join(second, "phrase").join(self.postings, ["term", "row"])
        kept = paired.where("array_contains(at, start + place)").select("phrase", "size", "row", "start")
        kept = store(kept.unionByName(single), "candidates")
        rest = ranked.where("rank > 1").select("phrase", "term", "place")
        short, long = kept.where("size <= 2"), kept.where("size > 2")
        checked = (
            long.join(rest, "phrase")
            .join(self.postings, ["term", "row"])
            .where("array_contains(at, start + place)")
            .groupBy("phrase", "size", "row", "start")
            .agg(F.count("*").alias("n"))
            .where("n = size - 2")
            .drop("n")
        )
        return checked.unionByName(short).select("phrase", "row", "start", "size")

    def proximity_matches(self, phrases: DataFrame, slack: int = 3) -> DataFrame:
        """phrase, row, at (the rarest term's position) where all terms occur in order and
        each is at most ``slack`` words off its place relative to the rarest term.

        Needs an index built without ``runs``: one with has no postings of lone words.
        """
        if self.runs:
            raise ValueError("an index built with runs lacks postings that a proximity search needs")
        ranked = store(self.ranked(phrases), "ranked-terms")
        first = ranked.where("rank = 0").select("phrase", "size", "term", F.col("place").alias("anchor"))
        found = first.join(self.postings, "term").select(
            "phrase", "size", "anchor", "row", F.explode("at").alias("centre")
        )
        rest = ranked.where("rank > 0").select("phrase", "term", "place")
        near = (
            found.join(rest, "phrase")
            .join(self.postings, ["term", "row"])
            .withColumn("at", F.expr(f"filter(at, x -> abs(x - centre - place + anchor) <= {int(slack)})"))
            .where("size(at) > 0")
        )
        # In order: from the first place on, the earliest position after the one before.
        steps = near.groupBy("phrase", "size", "anchor", "row", "centre").agg(
            F.sort_array(F.collect_list(F.struct("place", "at"))).alias("steps")
        )
        alone = found.where("size = 1")
        walk = (
            "aggregate(array_sort(array_append(steps, struct(anchor as place, array(centre) as at))), -1, "
            "(last, s) -> if(last is null, null, array_min(filter(s.at, x -> x > last)))) is not null"
        )
        ordered = steps.where("size(steps) = size - 1").where(walk)
        return ordered.select("phrase", "row", F.col("centre").alias("at")).unionByName(
            alone.select("phrase", "row", F.col("centre").alias("at"))
        )


def covered(matches: DataFrame) -> DataFrame:
    """row, n_hit: how many words of a document are in an occurrence; overlaps count once."""
    spans = matches.selectExpr("row", "start", "start + size as end").distinct()
    before = "max(end) over (partition by row order by start, end rows between unbounded preceding and 1 preceding)"
    ends = spans.selectExpr("row", "start", "end", f"coalesce({before}, 0) as reached")
    return ends.groupBy("row").agg(F.sum(F.expr("greatest(0, end - greatest(start, reached))")).alias("n_hit"))


def find_leaks(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, item_ids (those found, as sorted strings) of every row."""
    phrases, owners = (store(df, "benchmark-windows") for df in windows(items, size))
    index = Index(docs, phrases)
    matches = store(index.phrase_matches(phrases), "matches")
    ids = (
        matches.select("phrase", "row")
        .distinct()
        .join(owners, "phrase")
        .groupBy("row")
        .agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("item_ids"))
    )
    hits = covered(matches).join(ids, "row")
    nothing = F.array().cast("array<string>")
    return index.documents.join(hits, "row", "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("item_ids", nothing).alias("item_ids"),
    )


def leak_report(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    found = find_leaks(docs, items, size)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        sha256(F.array_join("item_ids", ",")).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def near_report(docs: DataFrame, items: DataFrame, size: int = WINDOW, slack: int = 1) -> DataFrame:
    """doc_id and near_item_ids, the sorted ids of the items of which a window occurs with its
    words in order and at most ``slack`` off their places, for every row that has one."""
    phrases, owners = (store(df, "benchmark-windows") for df in windows(items, size))
    index = Index(docs, phrases, runs=False)
    near = index.proximity_matches(phrases, slack).select("phrase", "row").distinct()
    ids = F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("near_item_ids")
    found = near.join(owners, "phrase").groupBy("row").agg(ids)
    return index.documents.join(found, "row").select("doc_id", "near_item_ids")


def drop_leaks(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """The documents without a window of the benchmark; every column is kept.

    Rows are told apart by a number of their own: of two rows with one id, the clean one stays.
    """
    docs = numbered(docs)
    found = find_leaks(docs.select("text", F.col("_row").alias("doc_id")), items, size)
    return drop_rows(docs, found.where("n_hit > 0").select(F.col("doc_id").alias("_row")))

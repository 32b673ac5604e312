"""Line dedup by content-defined chunks.

A rolling hash over the hashes of two lines decides after which lines a chunk ends,
so a passage is cut in the same places wherever it stands. Several chunkings with other
seeds cut it elsewhere. What stands before and after a passage decides where its outer
chunks begin and end, so its ends are anchored beside: each two lines that follow each other
are a small chunk too, and repeated ones carry the removal line by line up to the passage's
first and last line. A chunk with at least two lines of words, and ``min_words`` words
together, that occurs elsewhere is compared byte by byte with its first occurrence (smallest
id, then row number, then place) and removed if equal; the first occurrence stays.

Only hashes of chunks are shuffled at first. Then the texts that have repeated chunks, found
by a filter of fixed size, meet them by a join on the row; what leaves that join is the text
of repeated chunks only. All other texts stay where they are. A chunk that very
many documents have is one row per occurrence; nothing gathers them, and to be compared they
are first brought down to two texts per task.

Defined results: a null text stays null with no lines; an empty one has one empty line.
Every row has a number of its own, so of rows that are equal in all columns the first keeps
its passages. Null ids come last when the first occurrence is chosen. All columns are kept; ``n_chars``, if there, follows a changed text.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import numbered, split_rows
from clickloom.operators.joins import lookup
from clickloom.session import store

CHUNKINGS = 3
DIVISOR = 2
MIN_WORDS = 10
_STEP = 0x9E3779B97F4A7C15
_MIX = np.uint64(0xD6E8FEB86659FD93)
_SHIFT = np.uint64(33)
CHUNK = "row binary, doc_id long, start int, n int, digest binary"


def boundaries(lines: list[str], chunkings: int = CHUNKINGS, divisor: int = DIVISOR) -> list[np.ndarray]:
    """For each chunking, the places where a chunk starts, and the number of lines."""
    hashes = np.array([xxhash.xxh64_intdigest(x) for x in lines], np.uint64)
    rolled = hashes.copy()
    rolled[1:] += hashes[:-1] * np.uint64(_STEP)
    found = []
    for seed in range(1, chunkings + 1):
        mixed = (rolled ^ np.uint64(_STEP * seed % 2**64)) * _MIX
        ends = np.flatnonzero((mixed >> _SHIFT) % np.uint64(divisor) == 0) + 1
        found.append(np.unique(np.concatenate(([0], ends, [len(lines)]))))
    return found


def chunks_of(text: str | None, chunkings: int = CHUNKINGS, divisor: int = DIVISOR, min_words: int = MIN_WORDS):
    """(start, number of lines, bytes) of the chunks that count, each once."""
    if text is None:
        return
    lines = text.split("\n")
    if len(lines) < 2:
        return
    words = [len(x.split()) for x in lines]
    spans = {
        span for cuts in boundaries(lines, chunkings, divisor) for span in zip(cuts[:-1].tolist(), cuts[1:].tolist())
    }
    spans.update((i, i + 2) for i in range(len(lines) - 1))
    for a, b in sorted(spans):
        if sum(map(bool, words[a:b])) >= 2 and sum(words[a:b]) >= min_words:
            yield a, b - a, "\n".join(lines[a:b]).encode("utf-8", "replace")


def chunk_digests(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [
                (row, doc_id, a, n, xxhash.xxh128_digest(content))
                for row, doc_id, text in zip(batch["row"], batch["doc_id"], batch["text"])
                for a, n, content in chunks_of(text)
            ]
            yield pd.DataFrame(rows, columns=["row", "doc_id", "start", "n", "digest"]).astype({"doc_id": "Int64"})

    return docs.select(F.col("_row").alias("row"), F.col("doc_id").cast("long"), "text").mapInPandas(run, CHUNK)


def _texts(text: Column, spans: Column) -> Column:
    """The text of each span (start, n)."""

    @F.pandas_udf("array<string>")
    def of(texts: pd.Series, lists: pd.Series) -> pd.Series:
        out = []
        for content, places in zip(texts, lists):
            lines = content.split("\n")
            out.append(["\n".join(lines[s["start"] : s["start"] + s["n"]]) for s in places])
        return pd.Series(out)

    return of(text, spans)


def repeated_spans(docs: DataFrame) -> DataFrame:
    """row, start, n of every chunk that equals an earlier occurrence; ``docs`` are numbered."""
    chunks = store(chunk_digests(docs), "chunks")
    order = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "row", "start")
    classes = chunks.groupBy("digest", "n").agg(F.count("*").alias("times"), F.min(order).alias("first"))
    repeated = classes.where("times > 1").select("digest", "n", "first")
    met = chunks.join(repeated, ["digest", "n"]).select(
        "row",
        F.struct(
            "start",
            "n",
            "digest",
            F.expr("row = first.row and start = first.start").alias("is_first"),
        ).alias("span"),
    )
    by_row = store(met.groupBy("row").agg(F.collect_list("span").alias("spans")), "repeated-spans")
    may, _ = split_rows(docs.select(F.col("_row").alias("row"), "text"), by_row, "row")
    texts = may.join(by_row, "row")
    found = texts.select("row", "spans", _texts(F.col("text"), F.col("spans")).alias("contents"))
    found = found.select("row", F.explode(F.arrays_zip("spans", "contents")).alias("x")).select(
        "row", "x.spans.*", F.col("x.contents").alias("content")
    )
    found = store(found, "repeated-chunks")
    return equal_to_first(found).select("row", "start", "n").distinct()


def equal_to_first(found: DataFrame) -> DataFrame:
    """The later occurrences whose content is that of the first one of their digest, n."""
    # Each task hands on two texts for a digest, however many occurrences it has: where the least
    # and the greatest text are one, all are equal. Only of other digests the rows meet.
    ends = found.groupBy("digest", "n").agg(F.min("content").alias("least"), F.max("content").alias("greatest"))
    mixed = lookup(store(ends.where("least <> greatest").select("digest", "n"), "mixed-digests"))
    later = found.where("not is_first")
    alike = later.join(mixed, ["digest", "n"], "left_anti")
    unsure = found.join(mixed, ["digest", "n"], "left_semi")
    firsts = unsure.where("is_first").select("digest", "n", F.col("content").alias("original")).distinct()
    equal = unsure.where("not is_first").join(firsts, ["digest", "n"]).where(F.col("content") == F.col("original"))
    return alike.unionByName(equal.select(*alike.columns))


def _kept(text: Column, spans: Column) -> Column:
    """A struct of the text without the spans' lines, and the number of lines removed."""

    @F.pandas_udf("text string, n_removed long")
    def of(texts: pd.Series, lists: pd.Series) -> pd.DataFrame:
        out = []
        for content, places in zip(texts, lists):
            if content is None or places is None:
                out.append((content, 0))
                continue
            gone = {i for s in places for i in range(s["start"], s["start"] + s["n"])}
            left = [x for i, x in enumerate(content.split("\n")) if i not in gone]
            out.append(("\n".join(left), len(gone)))
        return pd.DataFrame(out, columns=["text", "n_removed"])

    return of(text, spans)


def dedup_lines(docs: DataFrame) -> DataFrame:
    """All rows and columns, the text without repeated chunks, then _lines: a struct of
    n_lines (before) and n_removed."""
    columns = docs.columns
    docs = numbered(docs)
    spans = repeated_spans(docs.select("_row", "doc_id", "text"))
    by_row = spans.groupBy("row").agg(F.collect_list(F.struct("start", "n")).alias("_spans"))
    by_row = store(by_row.withColumnRenamed("row", "_row"), "spans-to-remove")
    may, rest = split_rows(docs, by_row, "_row")
    cut = may.join(by_row, "_row", "left").withColumn("_cut", _kept(F.col("text"), F.col("_spans")))
    changed = {"text": F.col("_cut.text")}
    if "n_chars" in columns:
        kind = docs.schema["n_chars"].dataType
        fewer = F.length("_cut.text").cast(kind)
        changed["n_chars"] = F.when(F.col("_cut.n_removed") > 0, fewer).otherwise(F.col("n_chars"))
    lines = F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n"))).cast("long").alias("n_lines")
    done = cut.select(
        *[changed.get(c, F.col(c)).alias(c) for c in columns],
        F.struct(lines, F.col("_cut.n_removed").alias("n_removed")).alias("_lines"),
    )
    as_is = rest.select(*columns, F.struct(lines, F.lit(0).cast("long").alias("n_removed")).alias("_lines"))
    return done.unionAll(as_is)

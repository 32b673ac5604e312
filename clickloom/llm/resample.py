"""Importance resampling towards a target distribution.

Words come from an untrained pre-tokeniser: a Regex Split over the text with A-Z lowered,
which returns each word with its offsets. Laid out one space apart, the words give offset
pairs (start, end); a window of one to ``RUN`` words runs from the start of its first pair
to the end of its last, and the CRC-32 of its bytes names its bucket. As the bytes between
two ends are a space and a word, a window's CRC goes on from that of the window one word
shorter.

The text is read once, and not shuffled: the buckets of its features, two bytes each, are
written out. Every task adds up the buckets of its rows and hands on one row per bucket, for
the raw texts and for the target texts. From these come ``buckets`` gains, integers, which
are all that goes back to the tasks; there the gains of a text's features are summed. A
score is the weight with Gumbel noise from the id's digest, so that the highest scores are a
sample without replacement; ranks come from sorted ranges, no task sorts them all.

Defined results: a null text, and one without words, has no features and weight 0. A null id
takes part with the digest of ``42:``. Repeated rows are drawn one by one; rows of one score
go by id, null ids last, and rows that are alike in everything take adjoining ranks. Without
rows to draw from, or below 20 of them, nothing is drawn. An empty target has no counts, and
every feature gains by the same formula. Columns other than id and text are not looked at.
"""

from collections.abc import Iterator
from functools import cache
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import sha256
from clickloom.llm.ranges import running
from clickloom.session import store

BUCKETS = 10_000
RUN = 3
SEED = 42
#: What is between words; the words are all the rest.
GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@cache
def _splitter():
    from tokenizers import Regex
    from tokenizers.pre_tokenizers import Split

    return Split(Regex(GAPS), "removed")


def words_with_offsets(text: str | None) -> list[tuple[str, tuple[int, int]]]:
    """The words of a text, A-Z lowered, with their offsets in code points."""
    # Lower case of bytes touches ASCII letters only.
    return _splitter().pre_tokenize_str(text.encode("utf-8", "replace").lower().decode()) if text else []


def features(text: str | None, buckets: int = BUCKETS) -> tuple[int, np.ndarray]:
    """The number of words, and the bucket of every run of words."""
    found = words_with_offsets(text)
    if not found:
        return 0, np.empty(0, np.uint32)
    words = " ".join([word for word, _ in found]).encode().split(b" ")
    # What lies between the end of one pair and that of the next.
    steps = [b" " + word for word in words]
    window = list(map(crc32, words))
    runs = window.copy()
    for longer in range(1, RUN):
        window = list(map(crc32, steps[longer:], window))
        runs += window
    return len(words), np.array(runs, np.uint32) % np.uint32(buckets)


def _width(buckets: int) -> type:
    return np.uint16 if buckets <= 1 << 16 else np.uint32


def featured(docs: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``docs`` with n_words and features, the buckets as bytes, in place of the text."""
    width = _width(buckets)

    @F.pandas_udf("n_words long, features binary")
    def of(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for x in texts:
            n, found = features(x, buckets)
            rows.append((n, found.astype(width).tobytes()))
        return pd.DataFrame(rows, columns=["n_words", "features"])

    others = [c for c in docs.columns if c not in ("text", "n_words", "features")]
    return docs.select(*others, of(F.col("text")).alias("_f")).select(*others, "_f.*")


def histogram(rows: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) of all ``rows.features``; buckets without any are absent."""
    width = _width(buckets)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for found in batch["features"]:
                total += np.bincount(np.frombuffer(found, width), minlength=buckets)
        used = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": used.astype("int32"), "n": total[used]})

    counts = rows.select("features").mapInPandas(run, "bucket int, n long")
    return counts.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(rows: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """The gain of each bucket, in thousandths: how much more of it the target has. Both
    frames are those of ``featured``."""
    spark = rows.sparkSession
    raw = histogram(rows, buckets).withColumnRenamed("n", "s")
    wanted = histogram(target, buckets).withColumnRenamed("n", "t")
    both = spark.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    both = both.join(raw, "bucket", "left").join(wanted, "bucket", "left").na.fill(0)
    both = store(both, "bucket-counts")
    sums = both.agg(F.sum("s").alias("S"), F.sum("t").alias("T")).first()
    s, t = F.col("s").cast("double"), F.col("t").cast("double")
    more = (t + 1) * F.lit(float(sums["S"] + buckets)) / ((s + 1) * F.lit(float(sums["T"] + buckets)))
    gain = F.floor(F.lit(1000.0) * F.log(more)).cast("long")
    # As many rows as there are buckets, whatever the input.
    return [row["gain"] for row in both.select("bucket", gain.alias("gain")).orderBy("bucket").collect()]


def weigh(found: Column, gain: list[int]) -> Column:
    """A struct of n_features and weight, the sum of the features' gains."""
    table, width = np.array(gain, np.int64), _width(len(gain))

    @F.pandas_udf("n_features long, weight long")
    def of(features: pd.Series) -> pd.DataFrame:
        buckets = [np.frombuffer(x, width) for x in features]
        return pd.DataFrame({"n_features": [len(b) for b in buckets], "weight": [table[b].sum() for b in buckets]}, dtype="int64")

    return of(found)


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, from the digest of seed and id."""
    digest = sha256(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))))
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def resample(
    docs: DataFrame, target: DataFrame, percent: int = 5, min_words: int = 20, seed: int = SEED, buckets: int = BUCKETS
) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every row of ``docs``; of those with at
    least ``min_words`` words, ``percent`` in a hundred are drawn and have a rank."""
    found = store(featured(docs.select("doc_id", "text"), buckets), "features")
    gain = gains(found, featured(target.select("text"), buckets), buckets)
    weighed = found.select("doc_id", "n_words", weigh(F.col("features"), gain).alias("w")).select("doc_id", "n_words", "w.*")
    weighed = weighed.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    # The row number only tells equal rows apart; which of them has which does not show.
    rows = store(weighed.withColumn("row", F.monotonically_increasing_id()), "scores")
    may = rows.where(F.col("n_words") >= min_words)
    draws = may.count() * percent // 100
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features"), F.asc("row")]
    ranked = running(may, order, {"place": F.lit(1).cast("long")})
    columns = ["doc_id", "n_features", "weight", "score"]
    drawn = F.when(F.col("place") <= draws, F.col("place")).alias("rank")
    rest = rows.where(F.col("n_words") < min_words)
    return ranked.select(*columns, drawn).unionAll(rest.select(*columns, F.lit(None).cast("long").alias("rank")))

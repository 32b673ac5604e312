"""Token counts with a digest cache.

A text's key is the digest of its content with the digest of the tokenizer's file. Where
the tokenizer takes parts between white space one by one (``Counter.cut``), runs of spaces
and line feeds become one space first, which changes no count; others see the text as it is.
Counts already stored under that key are joined; of the others, each different text is encoded
once, whatever ids it stands under, and its count appended.

Texts whose key occurs once and is not stored are encoded where they lie, and that is most of
them. A bitmap of fixed size picks the others: of these, each task keeps one text per key
before the shuffle that leaves one in all, so a hot text arrives as one row per task.

Within a worker, a text for such a tokenizer is cut at spaces and line feeds, where no token and no
normalisation crosses, and the counts of short parts are remembered.

Defined results: null is the empty text with zero tokens and zero bytes. Repeated rows and
ids give one row each. Two jobs that append the same key at once leave two equal entries,
of which reading takes one. Other columns are not looked at.
"""

import hashlib
import os
from collections.abc import Iterator
from functools import cache
from pathlib import Path

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm.common import Memo, split_rows
from clickloom.session import store

CACHE = "tokenizer string, digest string, n_tokens long"
PART_MEMO = 500_000
LONGEST_REMEMBERED = 64


def version(path: str) -> str:
    """The digest of a tokenizer's file."""
    return hashlib.sha256(Path(path).read_bytes()).hexdigest()


class Counter:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if path.endswith(".json"):
            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_file(path)
            tokenizer.no_truncation()
            tokenizer.no_padding()
            self.encode = lambda texts: map(len, tokenizer.encode_batch_fast(texts, add_special_tokens=False))
            # Only where each part is normalised and split by itself may a text be cut.
            self.cut = "Removed" in tokenizer.pre_tokenizer.__repr__() and '"\\s+"' in repr(tokenizer.normalizer)
        else:
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.encode = lambda texts: map(len, model.encode(texts, num_threads=1))
            self.cut = False
        self.known = Memo(PART_MEMO)

    def counts(self, texts: list[str]) -> list[int]:
        if not self.cut:
            return list(self.encode(texts))
        known = self.known
        cut = [x.replace("\n", " ").split(" ") for x in texts]
        missing = list({part for parts in cut for part in parts if part not in known})
        fresh = dict(zip(missing, self.encode(missing)))
        find = known.get
        out = []
        for parts in cut:
            n = 0
            for part in parts:
                got = find(part)
                n += fresh[part] if got is None else got
            out.append(n)
        for part, n in fresh.items():
            if len(part) <= LONGEST_REMEMBERED:
                known.keep(part, n)
        return out


@cache
def _counter(path: str) -> Counter:
    return Counter(path)


def token_count(text: Column, path: str) -> Column:
    @F.pandas_udf("long")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = _counter(path)
        for texts in batches:
            counts = []
            for i in range(0, len(texts), 256):
                counts += counter.counts([x or "" for x in texts.iloc[i : i + 256]])
            yield pd.Series(counts, dtype="int64")

    return of(text)


def read_cache(spark: SparkSession, cache_path: str) -> DataFrame:
    try:
        return spark.read.schema(CACHE).parquet(cache_path).dropDuplicates(["tokenizer", "digest"])
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], CACHE)


def count_tokens(docs: DataFrame, tokenizer_path: str, cache_path: str) -> DataFrame:
    """doc_id, n_bytes and n_tokens of every row of ``docs``; new counts go to the cache."""
    spark = docs.sparkSession
    used = version(tokenizer_path)
    text = F.coalesce("text", F.lit(""))
    if _counter(tokenizer_path).cut:
        content = F.btrim(F.regexp_replace(text, "[ \n]+", " "))
    else:
        # Counts kept under normalised digests by earlier versions are not taken.
        content, used = text, f"{used}:raw"
    digest = F.sha2(content.cast("binary"), 256).alias("digest")
    # What a text is looked up by in the bitmap: cheaper than the digest, and only a filter.
    look = F.xxhash64("text").alias("look")
    keyed = store(docs.select("doc_id", look, F.octet_length(text).cast("long").alias("n_bytes"), digest), "digests")
    known = read_cache(spark, cache_path).where(F.col("tokenizer") == used).select("digest", "n_tokens")
    groups = store(keyed.groupBy("digest", "look").agg(F.count("*").alias("n")), "digest-counts")
    shared = groups.groupBy("digest").agg(F.sum("n").alias("n")).where("n > 1").select("digest")
    shared = store(shared.unionAll(known.select("digest")).distinct(), "digests-to-meet")
    looks = groups.join(shared, "digest", "left_semi").select("look").distinct()
    may, alone = split_rows(docs.select(look, "text"), looks, "look")
    once = may.select(digest, text.alias("text")).dropDuplicates(["digest"]).join(known, "digest", "left_anti")
    fresh = once.unionAll(alone.select(digest, text.alias("text")))
    counts = fresh.select(
        F.lit(used).alias("tokenizer"), "digest", token_count(F.col("text"), tokenizer_path).alias("n_tokens")
    )
    counts.write.mode("append").parquet(cache_path)
    stored = read_cache(spark, cache_path).where(F.col("tokenizer") == used).select("digest", "n_tokens")
    return keyed.join(stored, "digest").select("doc_id", "n_bytes", "n_tokens")

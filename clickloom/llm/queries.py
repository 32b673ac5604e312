"""The text operators over the test tables, with the parameters of production."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm import (
    codes,
    decontaminate,
    html,
    language,
    lines,
    mixing,
    pieces,
    pii,
    quality,
    resample,
    simhash,
    tokens,
    toxicity,
)
from clickloom.llm.common import fold, sha256, ship, table
from clickloom.session import configure, new_shared_dir

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return fn(configure(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return run


@query
def op1_quality(spark, sf_dir):
    return quality.judge(table(spark, sf_dir, "documents")).drop("row")


@query
def op2_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(False))
    dictionaries = language.learn(docs.where(~held_out))
    judged = docs.select("doc_id", held_out.alias("held_out"), language.classify(F.col("text"), dictionaries).alias("c"))
    return judged.select("doc_id", "held_out", "c.*")


@query
def op3_sentencepiece(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    done = docs.select("doc_id", pieces.encode_digest(F.col("text"), tokenizer("piece_bpe_32k.model")).alias("e"))
    return done.select("doc_id", "e.*")


@query
def op4_decontamination(spark, sf_dir):
    return decontaminate.leak_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op5_html_text(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url", html.extract(F.col("html")).alias("text"))
    return pages.withColumn("n_chars", F.length("text").cast("long"))


@query
def op6_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(fold(F.col("doc_id"), 3) == 1, F.lit(False))
    model = toxicity.learn(docs, table(spark, sf_dir, "labels").where(~held_out))
    scored = docs.select("doc_id", held_out.alias("held_out"), toxicity.score(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


@query
def op7_line_dedup(spark, sf_dir):
    kept = lines.dedup_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "_lines.n_lines", "_lines.n_removed", sha256(F.col("text")).alias("text_sha256"))


@query
def op8_pii(spark, sf_dir):
    return pii.report(table(spark, sf_dir, "documents"))


@query
def op9_token_counts(spark, sf_dir):
    counted = tokens.count_tokens(
        table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"), new_shared_dir(spark, "token-cache")
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > 2048)


@query
def op10_simhash(spark, sf_dir):
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), size=4, radius=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op11_resampling(spark, sf_dir):
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op12_mixing(spark, sf_dir):
    mixed = mixing.curriculum(table(spark, sf_dir, "documents"))
    first = F.get("occurrences", F.lit(0))["position"].alias("position")
    return mixed.select("doc_id", "size", "source_size", "target", "taken", first)


@query
def op13_vector_codes(spark, sf_dir):
    return codes.compress(table(spark, sf_dir, "embeddings"))

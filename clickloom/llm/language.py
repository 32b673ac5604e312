"""Language identification by compression.

Each language has a zstandard dictionary of raw content: text of a bounded sample of its
labelled rows. A text is compressed with every dictionary, and the smallest result names
the language. Letters only, lower-cased, in slices of ``SLICE`` bytes so that a long text
does not become its own dictionary; every slice of the whole text counts. Texts of at most
``SHORT`` bytes are searched more thoroughly: there every byte decides.

The margin is what the second language needs above the first, in parts of the first. A
margin under ``narrow`` rejects the answer: ``rejected`` is true and the language is still
named. The score is the softmax weight of the winner over the sizes per slice.

Defined results: a null text and one without a letter is ``und`` with score 0, rejected.
Equal sizes: the first language by name. With no labelled row every text is ``und``. Rows
are judged one by one, so repeated rows, null ids and other columns do not matter.
"""

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE_ROWS = 96
ORDINARY = (40, 60_000)
DICTIONARY_BYTES = 256 * 1024
SLICE = 4096
SHORT = 600
# Fixed bytes before each slice, so that even a short one is stored compressed.
PAD = b"\n" * 64
NARROW = 0.02
SHARPNESS = 60.0
NOT_LETTERS = re.compile(r"[\W\d_]+")


def letters(text: str | None) -> bytes:
    """The letters of a text, lower-cased, in words one space apart."""
    found = NOT_LETTERS.sub(" ", (text or "").lower())
    # Signs such as fractions and circled numbers belong to words, but are no letters.
    signs = {ord(c): " " for c in set(found) if c != " " and not c.isalpha()}
    if signs:
        found = " ".join(found.translate(signs).split())
    return found.strip().encode("utf-8", "replace")


def learn(labelled: DataFrame, sample_rows: int = SAMPLE_ROWS, size: int = DICTIONARY_BYTES) -> dict[str, bytes]:
    """A dictionary for each ``lang`` of the rows (doc_id, text, lang).

    The sample is bounded: the ``sample_rows`` rows with the smallest hash of their id and
    text, those of ordinary length before others, and at most ``size`` bytes of them. The
    driver gets that and no more.
    """
    ranked = labelled.where("lang is not null and text is not null").select(
        "lang",
        "text",
        (~F.length("text").between(*ORDINARY)).alias("odd"),
        F.xxhash64("doc_id", "text").alias("pick"),
    )
    best = ranked.selectExpr(
        "lang", "text", "row_number() over (partition by lang order by odd, pick, text) as place"
    ).where(F.col("place") <= sample_rows)
    found: dict[str, list[bytes]] = {}
    for row in best.orderBy("lang", "place").toLocalIterator():
        found.setdefault(row.lang, []).append(letters(row.text))
    return {lang: b" ".join(texts)[:size] for lang, texts in sorted(found.items()) if any(texts)}


def _packer(content: bytes, strategy: int, search_log: int) -> zstandard.ZstdCompressor:
    how = zstandard.ZstdCompressionParameters(
        strategy=strategy,
        search_log=search_log,
        min_match=4,
        target_length=32,
        window_log=19,
        chain_log=18,
        hash_log=18,
        write_content_size=False,
        write_dict_id=False,
    )
    made = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    made.precompute_compress(compression_params=how)
    return zstandard.ZstdCompressor(dict_data=made, compression_params=how)


class Classifier:
    def __init__(self, dictionaries: dict[str, bytes]):
        self.names = list(dictionaries)
        self.fast = [_packer(x, zstandard.STRATEGY_GREEDY, 2) for x in dictionaries.values()]
        self.thorough = [_packer(x, zstandard.STRATEGY_BTLAZY2, 4) for x in dictionaries.values()]

    def judge(self, text: str | None) -> tuple[str, float, float]:
        """Language, score and margin."""
        content = letters(text)
        if not content or not self.names:
            return "und", 0.0, 0.0
        packers = self.thorough if len(content) <= SHORT else self.fast
        parts = [PAD + content[i : i + SLICE] for i in range(0, len(content), SLICE)]
        sizes = np.array([sum([len(c.compress(p)) for p in parts]) for c in packers], dtype=float)
        first = int(sizes.argmin())
        weights = np.exp(-SHARPNESS * (sizes / sizes[first] - 1))
        margin = np.sort(sizes)[1] / sizes[first] - 1 if len(sizes) > 1 else 1.0
        return self.names[first], float(1 / weights.sum()), float(margin)


def classify(text: Column, dictionaries: dict[str, bytes], narrow: float = NARROW) -> Column:
    """A struct of lang_pred, score, margin and rejected."""
    made: list[Classifier] = []

    @F.pandas_udf("lang_pred string, score double, margin double, rejected boolean")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        judge = (made or made.append(Classifier(dictionaries)) or made)[0].judge
        for texts in batches:
            out = pd.DataFrame([judge(x) for x in texts], columns=["lang_pred", "score", "margin"])
            yield out.assign(rejected=(out.margin < narrow) | (out.lang_pred == "und"))

    return of(text)

"""What the text operators share: reading tables, word rules, digests."""

import shutil
import tempfile
from pathlib import Path

import clickloom
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.operators.joins import key_bits, split_by_bits
from clickloom.session import store

SPACE = "[\\x20\\x09-\\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def words_of(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text; none for null."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE_CHARS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE))


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_row``, a key of its own (binary) for every row, the same wherever and
    however often the rows are read; rows that are equal in everything are still two.

    A row of a Parquet table is named by the MD5 digest of its file and its place in it. Other
    rows are numbered and written out with their numbers.
    """
    if _is_plain_scan(docs):
        place = F.concat_ws(":", F.col("_metadata.file_path"), F.col("_metadata.row_index").cast("string"))
        return docs.select("*", F.unhex(F.md5(place.cast("binary"))).alias("_row"))
    number = F.unhex(F.lpad(F.hex(F.monotonically_increasing_id()), 16, "0"))
    return store(docs.withColumn("_row", number), "numbered")


def _is_plain_scan(docs: DataFrame) -> bool:
    """Whether the rows are those of a Parquet table, each at most once."""
    node = docs._jdf.queryExecution().analyzed()
    while node.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        node = node.children().head()
    if node.nodeName() != "LogicalRelation" or {"_metadata", "_row"} & set(docs.columns):
        return False
    # A projection may hide the files' columns: then there is no naming a row by its place.
    try:
        return node.toString().rstrip().endswith("parquet") and bool(docs.select("_metadata.row_index").columns)
    except AnalysisException:
        return False


def split_rows(rows: DataFrame, keys: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """The rows that may have one of ``keys``, and those that have none for certain: only few
    other rows need be shuffled to meet the keys."""
    return split_by_bits(rows, key, store(key_bits(keys, key), "row-filter"))


def drop_rows(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows of ``docs``, as ``numbered``, less those of ``gone`` (_row); without the number."""
    gone = store(gone.select("_row").distinct(), "rows-to-drop")
    columns = [c for c in docs.columns if c != "_row"]
    may, rest = split_rows(docs, gone, "_row")
    return may.join(gone, "_row", "left_anti").select(*columns).unionAll(rest.select(*columns))


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the Python workers this package, once per application."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        folder = Path(clickloom.__file__).resolve().parent
        made = shutil.make_archive(f"{tempfile.mkdtemp()}/{folder.name}", "zip", folder.parent, folder.name)
        context.addPyFile(made)
        _shipped.add(context.applicationId)


class Memo(dict):
    """A dictionary that starts anew when full, so that a worker's memory stays bounded."""

    def __init__(self, limit: int):
        super().__init__()
        self.limit = limit

    def keep(self, key, value):
        if len(self) >= self.limit:
            self.clear()
        self[key] = value
        return value


class Recent:
    """A bounded memory of two generations: what is used stays when the older one goes.

    ``budget`` is the number of bytes for both; ``size`` tells those of an entry.
    """

    def __init__(self, budget: int, size):
        self.half, self.used, self.size = budget // 2, 0, size
        self.young: dict = {}
        self.old: dict = {}

    def get(self, key):
        found = self.young.get(key)
        if found is None and (found := self.old.pop(key, None)) is not None:
            self.keep(key, found)
        return found

    def keep(self, key, value):
        size = self.size(key, value)
        if self.used + size > self.half:
            self.young, self.old, self.used = {}, self.young, 0
        self.young[key] = value
        self.used += size
        return value

"""What a stream keeps beside Spark's state store: small marks, and tables by change."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Folder:
    """Names and small texts below a path, on whatever file system it is."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm, self.path = spark._jvm, path.rstrip("/")
        self._files = self._at("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, below: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{below}" if below else self.path)

    def names(self, below: str = "") -> list[str]:
        place = self._at(below)
        return [f.getPath().getName() for f in self._files.listStatus(place)] if self._files.exists(place) else []

    def numbers(self, prefix: str = "") -> list[int]:
        """The numbers that follow ``prefix`` in the names, smallest first."""
        found = [x.removeprefix(prefix) for x in self.names() if x.startswith(prefix)]
        return sorted(int(x) for x in found if x.isdigit())

    def exists(self, below: str = "") -> bool:
        return self._files.exists(self._at(below))

    def make(self) -> None:
        self._files.mkdirs(self._at(""))

    def delete(self, below: str) -> None:
        self._files.delete(self._at(below), True)

    def move_in(self, path: str, below: str) -> None:
        """Rename a folder to a name below this one, which nobody can see half of."""
        self.make()
        if not self._files.rename(self._jvm.org.apache.hadoop.fs.Path(path), self._at(below)):
            raise OSError(f"cannot rename {path} to {self.path}/{below}")

    def note(self, below: str, content: dict) -> None:
        """Write a small JSON file; it is there whole or not at all."""
        out = self._files.create(self._at(f".{below}"), True)
        out.write(json.dumps(content).encode())
        out.close()
        self._files.delete(self._at(below), False)
        if not self._files.rename(self._at(f".{below}"), self._at(below)):
            raise OSError(f"cannot write {self.path}/{below}")

    def noted(self, below: str) -> dict:
        stream = self._files.open(self._at(below))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()


class ChangeLog:
    """A table of which a batch writes the changed rows only.

    Each batch leaves ``batch-<n>`` with a row for every key it changed, and a key's newest
    row counts; without keys the newest batch counts as a whole. ``fold`` writes what
    counts to ``base-<n>``, from which reading goes on. A batch builds on earlier ones only,
    so repeating it writes the same again, and a reader who stops at the last finished batch
    sees no half of one. What was folded stays until the next time, for readers under way.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, keys: Sequence[str]):
        self.spark, self.folder, self.keys = spark, Folder(spark, path), list(keys)
        self.fields = T.StructType.fromDDL(schema)
        self.schema = T.StructType([*self.fields, T.StructField("batch", T.LongType())])

    def _paths(self, last: int) -> list[str]:
        names = self.folder.names()
        bases = [int(x[5:]) for x in names if x.startswith("base-") and int(x[5:]) <= last]
        # A base that is being written, or was left half-way, has no such mark.
        while bases and not self.folder.exists(f"base-{max(bases)}/_SUCCESS"):
            bases.remove(max(bases))
        base = max(bases, default=-1)
        later = sorted(n for n in (int(x[6:]) for x in names if x.startswith("batch-")) if base < n <= last)
        paths = [f"{self.folder.path}/base-{base}"] if bases else []
        return paths + [f"{self.folder.path}/batch-{n}" for n in later]

    def read(self, last: int, where: Column | None = None) -> DataFrame:
        """The rows that count after batch ``last``; ``where`` is a condition on keys."""
        paths = self._paths(last)
        if not paths:
            return self.spark.createDataFrame([], self.fields)
        rows = self.spark.read.schema(self.schema).parquet(*(paths if self.keys else paths[-1:]))
        rows = rows if where is None else rows.where(where)
        if not self.keys or len(paths) == 1:
            return rows.select(*self.fields.names)
        values = [c for c in self.fields.names if c not in self.keys]
        newest = [F.max_by(c, "batch").alias(c) for c in values] or [F.max("batch")]
        return rows.groupBy(*self.keys).agg(*newest).select(*self.fields.names)

    def write(self, rows: DataFrame, batch: int) -> None:
        numbered = rows.select(*self.fields.names, F.lit(batch).cast("long").alias("batch"))
        numbered.hint("rebalance").write.mode("overwrite").parquet(f"{self.folder.path}/batch-{batch}")

    def fold(self, batch: int, where: Column | None = None) -> None:
        """Bring everything up to ``batch`` together; rows that fail ``where`` are given up."""
        bases = self.folder.numbers("base-")
        if not self.folder.exists(f"base-{batch}/_SUCCESS"):
            rows = self.read(batch, where).select("*", F.lit(batch).cast("long").alias("batch"))
            rows.write.mode("overwrite").parquet(f"{self.folder.path}/base-{batch}")
        before = max((n for n in bases if n < batch), default=-1)
        for kind, last in (("base-", before - 1), ("batch-", before)):
            for n in self.folder.numbers(kind):
                if n <= last:
                    self.folder.delete(f"{kind}{n}")

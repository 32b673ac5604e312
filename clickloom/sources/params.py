"""Job parameters."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

KEYS = ["startDate", "endDate", "startAge", "endAge", "targetPageFlow"]


@dataclass(frozen=True)
class JobParams:
    """Optional inclusive ranges and the page flow; ``None`` means no restriction."""

    start_date: str | None = None
    end_date: str | None = None
    start_age: int | None = None
    end_age: int | None = None
    page_flow: tuple[str, ...] = ()

    @classmethod
    def from_mapping(cls, values: Mapping[str, object]) -> JobParams:
        """From the keys ``startDate endDate startAge endAge targetPageFlow``.

        Missing and empty values are absent; other keys are ignored.
        """
        given = {k: str(values[k]).strip() for k in KEYS if values.get(k) is not None}
        given = {k: v for k, v in given.items() if v}
        age = {k: int(given[k]) for k in ("startAge", "endAge") if k in given}
        flow = [page.strip() for page in given.get("targetPageFlow", "").split(",")]
        return cls(
            start_date=given.get("startDate"),
            end_date=given.get("endDate"),
            start_age=age.get("startAge"),
            end_age=age.get("endAge"),
            page_flow=tuple(page for page in flow if page),
        )

    @classmethod
    def from_json(cls, spark: SparkSession, text: str) -> JobParams:
        """From JSON text, whose keys may be unquoted."""
        schema = ", ".join(f"{k} string" for k in KEYS)
        options = {"allowUnquotedFieldNames": "true", "allowSingleQuotes": "true", "mode": "FAILFAST"}
        parsed = spark.range(1).select(F.from_json(F.lit(text), schema, options).alias("p")).first()["p"]
        return cls.from_mapping(parsed.asDict())

"""Group-wise top-k."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.operators.joins import join_on, lookup
from clickloom.session import store


def top_rows(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int, position: str = "position"
) -> DataFrame:
    """The first ``n`` rows of each group, numbered in ``position``.

    The filter on row_number lets Spark cut every group to ``n`` rows before the
    shuffle, so a hot group arrives as at most ``n`` rows per upstream task.
    """
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(position, F.row_number().over(window)).where(F.col(position) <= n)


def top_values_with_ties(
    df: DataFrame, group: Sequence[str], value: str, n: int, values: DataFrame | None = None
) -> DataFrame:
    """Rows with ``rank() over (partition by group order by value desc) <= n``.

    A row has such a rank exactly when its value reaches the n-th largest value of
    the group, repeats counted. That value comes from ``n`` rows per group, and the
    rows are compared with it where they lie: however many rows tie, they need not
    meet in one task, as they would in a rank() window.

    ``values`` gives the same group and value pairs where they are cheaper to get. The
    floors, a row per group, are written out: their size then decides how they are joined.
    """
    pairs = (df if values is None else values).select(*group, value)
    floors = (
        top_rows(pairs, group, [F.desc(value)], n, "_position").groupBy(*group).agg(F.min(value).alias("_floor"))
    )
    return join_on(df, lookup(store(floors, "floors")), group).where(F.col(value) >= F.col("_floor")).drop("_floor")

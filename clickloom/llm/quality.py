"""Quality rules: base counts, and robust multivariate outliers among texts.

Counts come from built-in functions only. A text's statistic vector is, with ``PRIOR``
words of smoothing so that short texts do not scatter: log rates of symbols, capitals,
punctuation, repeated words and repeated lines, and the log mean word length.

Per language and source, the minimum covariance determinant is sought: from two starts
(medians with absolute deviations; plain mean and covariance) repeated concentration steps
keep the ``COVERAGE`` nearest share of the rows and estimate again; the start with the
smaller determinant wins. ``FLOOR`` squared is added to the variances, since most texts
have no symbol at all. Groups with fewer than ``MIN_GROUP`` rows that pass the base rule are
judged by all such rows of their language, and languages with fewer by all such rows. A text is rejected when its squared Mahalanobis distance
is over ``CUTOFF`` (about the 0.999999 quantile of chi-square with six degrees), after
division by the group's median distance over the one expected, if that is above one.

All steps are aggregations over one stored row of numbers per text: group sums and bounded
quantile sketches are combined before each shuffle, and no group is ever gathered.

Windows of words are compared by a 64-bit hash of their five words.

Defined results: null is a text without words, which fails the base rule, as any text of
under ten words. Rows are judged one by one, so repeated rows and ids give one row each.
A null language or source is a group of its own. Rows that fail the base rule are not used
for the estimates; if none is left, the rest is kept. An empty table gives no rows.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import SPACE_CHARS, drop_rows, numbered, words_of
from clickloom.session import store

PRIOR = 30
FLOOR = (0.3, 0.2, 0.2, 0.05, 0.3, 0.3)
COVERAGE = 0.75
STEPS = 3
MIN_GROUP = 200
CUTOFF = 40.0
# The median of chi-square with six degrees of freedom.
MEDIAN = 5.348
P = len(FLOOR)
X = [f"x{i}" for i in range(P)]
ROW_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _left(text: Column, drop: str) -> Column:
    """How many characters stay when what matches is taken out."""
    return F.length(F.regexp_replace(text, drop, "")).cast("long")


def base_counts(docs: DataFrame, window: int = 5) -> DataFrame:
    """doc_id, lang, source, row (its key, own or ``_row``), the base counts, n_lines, n_upper, n_punct."""
    text = F.coalesce(F.col("text"), F.lit(""))
    split = docs.select(
        "doc_id",
        "lang",
        "source",
        (F.col("_row") if "_row" in docs.columns else F.monotonically_increasing_id()).alias("row"),
        text.alias("text"),
        words_of(F.col("text")).alias("w"),
        F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACE_CHARS)) != "").alias("lines"),
    )
    inside = F.sequence(F.lit(0), F.size("w") - window)
    hashes = F.transform(inside, lambda i: F.xxhash64(*[F.get("w", i + k) for k in range(window)]))
    none = F.array().cast("array<bigint>")
    counted = split.select(
        "doc_id",
        "lang",
        "source",
        "row",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        _left(F.col("text"), "[^#*$%&|<>]+").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size("lines").cast("long").alias("n_lines"),
        _left(F.col("text"), "[^\\p{Lu}]+").alias("n_upper"),
        _left(F.col("text"), "[\\p{L}\\p{N}\\s]+").alias("n_punct"),
        F.when(F.size("w") >= window, hashes).otherwise(none).alias("h"),
    )
    # Only texts with an equal window sort theirs; equal hashes then stand together.
    placed = F.array_sort(F.transform("h", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    repeats = F.size("h") > F.size(F.array_distinct("h"))
    empty = F.array().cast("array<struct<h:bigint,i:int>>")
    ordered = counted.withColumn("s", F.when(repeats, placed).otherwise(empty)).drop("h")
    twice = F.expr(
        "array_sort(transform(filter(s, (x, k) -> coalesce(x.h = get(s, k - 1).h, false) "
        "or coalesce(x.h = get(s, k + 1).h, false)), x -> x.i))"
    )
    covered = F.expr(
        f"aggregate(transform(t, (x, k) -> least({window}, coalesce(get(t, k + 1) - x, {window}))), "
        "0L, (a, b) -> a + b)"
    )
    return ordered.withColumn("t", twice).drop("s").withColumn("n_repeat_words", covered).drop("t")


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def vector() -> list[Column]:
    """The transformed statistics, by the name of the counts."""

    def rate(low, count, of, per=1):
        return F.log(low + F.col(count) / (F.col(of) + PRIOR * per))

    return [
        rate(0.02, "n_symbols", "n_words"),
        rate(0.01, "n_upper", "word_chars", 5),
        rate(0.01, "n_punct", "word_chars", 5),
        F.log((F.col("word_chars") + 5 * PRIOR) / (F.col("n_words") + PRIOR)),
        rate(0.05, "n_repeat_words", "n_words"),
        rate(0.05, "n_dup_lines", "n_lines", 1 / 6),
    ]


def _grouped(rows: DataFrame) -> DataFrame:
    """Adds ``key``: the group whose estimates judge the row; and ``parts``: the groups, of
    those that judge any row, whose estimates the row takes part in."""
    passing = F.count_if(~F.col("base_failed"))
    by_both = rows.groupBy("lang", "source").agg(passing.alias("n"))
    sizes = by_both.selectExpr("*", "sum(n) over (partition by lang) as of_lang")
    both = F.to_json(F.struct("lang", "source", F.lit(2).alias("level")))
    lang = F.to_json(F.struct("lang", F.lit(1).alias("level")))
    key = F.when(F.col("n") >= MIN_GROUP, both).when(F.col("of_lang") >= MIN_GROUP, lang).otherwise(F.lit("all"))
    # The pair is compared as one text: null joins null.
    pair = F.to_json(F.struct("lang", "source"))
    keys = store(sizes.select(pair.alias("pair"), key.alias("key"), F.array(both, lang, F.lit("all")).alias("parts")), "groups")
    used = keys.select(F.col("key").alias("part")).distinct()
    parts = keys.select("pair", "key", F.explode("parts").alias("part")).join(used, "part")
    keys = store(parts.groupBy("pair", "key").agg(F.collect_list("part").alias("parts")), "groups")
    return rows.withColumn("pair", pair).join(keys, "pair").drop("pair")


def _decompose(groups: DataFrame) -> DataFrame:
    """From columns m0.. and c_i_j (i >= j): array m, array w (the rows of the inverse of the
    Cholesky factor, one after the other) and the log determinant."""
    for j in range(P):
        inner = F.lit(0.0)
        for k in range(j):
            inner = inner + F.col(f"l_{j}_{k}") * F.col(f"l_{j}_{k}")
        groups = groups.withColumn(f"l_{j}_{j}", F.sqrt(F.col(f"c_{j}_{j}") + FLOOR[j] ** 2 - inner))
        below = {}
        for i in range(j + 1, P):
            inner = F.lit(0.0)
            for k in range(j):
                inner = inner + F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}")
            below[f"l_{i}_{j}"] = (F.col(f"c_{i}_{j}") - inner) / F.col(f"l_{j}_{j}")
        groups = groups.withColumns(below) if below else groups
    for i in range(P):
        row = {f"w_{i}_{i}": 1 / F.col(f"l_{i}_{i}")}
        for j in range(i):
            inner = F.lit(0.0)
            for k in range(j, i):
                inner = inner + F.col(f"l_{i}_{k}") * F.col(f"w_{k}_{j}")
            row[f"w_{i}_{j}"] = -inner / F.col(f"l_{i}_{i}")
        groups = groups.withColumns(row)
    return groups.select(
        "key",
        "start",
        F.array(*[F.col(f"m{i}") for i in range(P)]).alias("m"),
        F.array(*[F.col(f"w_{i}_{j}") for i in range(P) for j in range(i + 1)]).alias("w"),
        sum((2 * F.log(F.col(f"l_{i}_{i}")) for i in range(P)), F.lit(0.0)).alias("log_det"),
    )


def distance() -> Column:
    """The squared Mahalanobis distance of x0.. from the group's m under its w."""
    total = F.lit(0.0)
    for i in range(P):
        first = i * (i + 1) // 2
        part = F.lit(0.0)
        for j in range(i + 1):
            part = part + F.col("w")[first + j] * (F.col(X[j]) - F.col("m")[j])
        total = total + part * part
    return total


def _moments(rows: DataFrame) -> DataFrame:
    means = [F.avg(x).alias(f"m{i}") for i, x in enumerate(X)]
    spreads = [F.covar_pop(X[i], X[j]).alias(f"c_{i}_{j}") for i in range(P) for j in range(i + 1)]
    return rows.groupBy("key", "start").agg(*means, *spreads)


def estimates(rows: DataFrame) -> DataFrame:
    """key, m, w, scale of each group of ``rows`` (key, x0..)."""
    medians = [F.percentile_approx(x, 0.5, 1000).alias(f"m{i}") for i, x in enumerate(X)]
    middle = store(rows.groupBy("key").agg(*medians), "medians")
    off = [F.percentile_approx(F.abs(F.col(x) - F.col(f"m{i}")), 0.5, 1000).alias(f"a{i}") for i, x in enumerate(X)]
    off = rows.join(middle, "key").groupBy("key").agg(*off)
    diagonal = {
        f"c_{i}_{j}": (1.4826 * F.col(f"a{i}")) ** 2 if i == j else F.lit(0.0) for i in range(P) for j in range(i + 1)
    }
    robust = middle.join(off, "key").withColumn("start", F.lit(0)).withColumns(diagonal)
    plain = _moments(rows.withColumn("start", F.lit(1)))
    wanted = ["key", "start", *[f"m{i}" for i in range(P)], *diagonal]
    now = store(_decompose(robust.select(*wanted).unionByName(plain.select(*wanted))), "estimates")
    for _ in range(STEPS):
        far = rows.join(now, "key").withColumn("d", distance()).drop("m", "w", "log_det")
        near = far.groupBy("key", "start").agg(F.percentile_approx("d", COVERAGE, 1000).alias("reach"))
        near = store(near.withColumnRenamed("start", "of").withColumnRenamed("key", "group"), "reaches")
        group = (F.col("key") == F.col("group")) & (F.col("start") == F.col("of"))
        now = store(_decompose(_moments(far.join(near, group).where("d <= reach"))), "estimates")
    best = now.selectExpr("*", "row_number() over (partition by key order by log_det, start) as place")
    best = store(best.where("place = 1").select("key", "m", "w"), "estimates")
    middle = rows.join(best, "key").groupBy("key").agg(F.percentile_approx(distance(), 0.5, 1000).alias("middle"))
    return best.join(middle, "key").select("key", "m", "w", F.greatest(F.lit(1.0), F.col("middle") / MEDIAN).alias("scale"))


def judge(docs: DataFrame) -> DataFrame:
    """One row per text: doc_id, row, the base counts, base_failed, kept, distance."""
    counts = base_counts(docs).withColumn("base_failed", base_failed())
    rows = store(counts.withColumns(dict(zip(X, vector()))), "statistics")
    rows = store(_grouped(rows).select("doc_id", "row", *ROW_COUNTS, "base_failed", "key", "parts", *X), "grouped")
    passing = rows.where("not base_failed").select(F.explode("parts").alias("key"), *X)
    groups = store(estimates(passing), "estimates")
    judged = rows.join(groups, "key", "left").withColumn("distance", distance() / F.col("scale"))
    kept = ~F.col("base_failed") & F.coalesce(F.col("distance") <= CUTOFF, F.lit(True))
    return judged.select("doc_id", "row", *ROW_COUNTS, "base_failed", kept.alias("kept"), "distance")


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that the rules keep; every column stays."""
    docs = numbered(docs)
    judged = judge(docs.select("_row", "doc_id", "text", "lang", "source"))
    return drop_rows(docs, judged.where("not kept").withColumnRenamed("row", "_row"))

"""Personal data by weak supervision.

Base spans come from fixed patterns with their checks. Further candidates (numbers,
addresses written out, long keys) that overlap no base span are judged by labelers, each
saying yes, no or nothing: the shape (regex), a check sum or digit count, a gazetteer of
prefixes and endings, the words before (context) and a list of harmless shapes.
Expectation-maximisation over the table of vote patterns estimates per kind how reliable
each labeler is, starting from the share of yes votes, and so how probable each pattern
is. With these as soft labels a naive Bayes classifier over features of the span (shape,
word before, character after, length) is trained by counting; what it gives at least
``SURE`` becomes a span. Base spans always stay.

Only built-in functions are used. The vote table has a bounded number of rows (3 to the
number of labelers, per kind), and so have the classifier's weights (hashed features), so
each step is an aggregation that is combined before it is shuffled.

Patterns are written so that each text is read in linear time: possessive repeats, and a
match starts at the first character of its run or where the last match ended.

Defined results: a null or empty text has no spans. Rows are numbered and judged one by
one, so repeated rows, repeated or null ids give one row each. Positions are code points,
ends exclusive. Spans stand by start, then kind as listed. Other columns are not looked at.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import sha256
from clickloom.session import store

KINDS = ["email", "ip", "card", "phone", "secret"]
LOCAL = "[A-Za-z0-9._%+-]"
BASE = {
    "email": f"(?:\\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]++(?:\\.[A-Za-z0-9-]++)++",
    "ip": "(?:\\G|(?<![0-9]))[0-9]++\\.[0-9]++\\.[0-9]++\\.[0-9]++",
    "card": "[0-9](?:[\\x20-]?[0-9])++",
    "phone": "\\+[0-9][\\x20().0-9-]+[0-9]",
}
# What a text must contain before its pattern is tried.
NEEDS = {"email": "@", "phone": "+"}
CANDIDATE = {
    "number": "(?:\\G|(?<![0-9A-Za-z.+-]))\\(?[0-9][0-9\\x20().-]{7,}[0-9](?![0-9A-Za-z])",
    "address": f"(?:\\G|(?<!{LOCAL})){LOCAL}++ ?[(\\[]at[)\\]] ?[A-Za-z0-9-]++(?: ?(?:\\.|[(\\[]dot[)\\]]) ?[A-Za-z0-9-]++)++",
    "key": "(?:\\G|(?<![A-Za-z0-9_-]))[A-Za-z0-9_-]{20,}+(?![A-Za-z0-9_-])",
}
LOOSE = "array<struct<form:string,at:struct<start:int,end:int,value:string>>>"
CONTEXT = 40
SURE = 0.9
ROUNDS = 6
LABELERS = ["shape", "check", "gazetteer", "context", "harmless"]
SPAN = "array<struct<start:int,kind_no:int,kind:string,end:int>>"
# Card issuers' prefixes, endings of host names, prefixes of keys, cue words.
ISSUERS = "^(?:4|5[1-5]|2[2-7]|3[0-9]|6)"
ENDINGS = "(?i)(?:com|org|net|edu|gov|info|io|eu|de|fr|es|uk|it|nl)$"
KEY_PREFIXES = "^(?:sk_|pk_|AKIA|ghp_|gho_|xox[abp]-|glpat-)"
CUES = {
    "email": "mail|contact|write to",
    "card": "card|visa|master|credit|payment|konto|carte|tarjeta",
    "phone": "phone|tel|call|mobile|fax|anruf|appel|llam",
    "secret": "token|secret|passw|key|auth|bearer|credential",
}


def occurrences(text: Column, pattern: str) -> Column:
    """(start, end, value) of the leftmost non-overlapping matches, in order.

    The pieces between the matches give the places: the same search finds both.
    """
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    empty = F.array().cast("array<struct<start:int,end:int,value:string>>")
    gaps = F.split(text, pattern, -1)

    pairs = F.zip_with(
        F.slice(gaps, F.lit(1), F.size(values)), values, lambda g, v: F.struct(g.alias("gap"), v.alias("value"))
    )
    return F.when(F.size(values) > 0, F.aggregate(pairs, empty, _append)).otherwise(empty)


def _append(done: Column, pair: Column) -> Column:
    before = F.when(F.size(done) > 0, F.get(done, F.size(done) - 1)["end"]).otherwise(F.lit(0))
    at = before + F.length(pair["gap"])
    end = at + F.length(pair["value"])
    return F.array_append(done, F.struct(at.alias("start"), end.alias("end"), pair["value"].alias("value")))


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]+", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the check sum."""
    places = F.sequence(F.lit(1), F.greatest(F.length(number), F.lit(1)))

    def term(place, i):
        d = F.substring(F.reverse(number), place, F.lit(1)).try_cast("int")
        twice = d * 2
        return F.when(i % 2 == 0, d).otherwise(twice - F.when(twice > 9, 9).otherwise(0))

    return F.aggregate(F.transform(places, term), F.lit(0), lambda a, b: a + b) % 10 == 0


def _holds(kind: str, value: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        part = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
        return value.rlike(f"^{part}(?:\\.{part}){{3}}$")
    n = F.length(digits(value))
    if kind == "card":
        return F.when(n.between(12, 19), luhn(digits(value))).otherwise(F.lit(False))
    return n.between(9, 15)


def _base(text: Column, kind: str) -> Column:
    found = F.filter(occurrences(text, BASE[kind]), lambda x: _holds(kind, x["value"]))
    spans = F.transform(
        found,
        lambda x: F.struct(
            x["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind_no"), F.lit(kind).alias("kind"), x["end"].alias("end")
        ),
    )
    if kind not in NEEDS:
        return spans
    return F.when(F.contains(text, F.lit(NEEDS[kind])), spans).otherwise(F.array().cast(SPAN))


def _named(found: Column, form: str) -> Column:
    # A text that was not searched has null for an array.
    named = F.transform(found, lambda x: F.struct(F.lit(form).alias("form"), x.alias("at")))
    return F.coalesce(named, F.array().cast(LOOSE))


def spans_of(docs: DataFrame) -> DataFrame:
    """id, doc_id, one array of base spans for each kind, and the candidates with what stands
    around them."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("id"), "doc_id", text.alias("text"))
    base = rows.withColumns({kind: _base(F.col("text"), kind) for kind in BASE})
    taken = base.withColumn("base", F.array_sort(F.concat(*BASE)))
    loose = {
        "number": occurrences(F.col("text"), CANDIDATE["number"]),
        "address": F.when(F.col("text").rlike("[(\\[]at[)\\]]"), occurrences(F.col("text"), CANDIDATE["address"])),
        "key": occurrences(F.col("text"), CANDIDATE["key"]),
    }
    named = [_named(found, form) for form, found in loose.items()]
    found = taken.withColumn("loose", F.concat(*named))
    free = F.filter(
        "loose", lambda c: ~F.exists("base", lambda b: (b["start"] < c["at"]["end"]) & (c["at"]["start"] < b["end"]))
    )
    around = F.transform(
        free,
        lambda c: F.struct(
            c["form"].alias("form"),
            c["at"]["start"].alias("start"),
            c["at"]["end"].alias("end"),
            c["at"]["value"].alias("value"),
            F.lower(
                F.substring(
                    F.col("text"), F.greatest(c["at"]["start"] - CONTEXT + 1, F.lit(1)), F.least(c["at"]["start"], F.lit(CONTEXT))
                )
            ).alias("before"),
            F.substring(F.col("text"), c["at"]["end"] + 1, F.lit(1)).alias("after"),
        ),
    )
    return found.select("id", "doc_id", *BASE, "base", around.alias("candidates"))


def _vote(*cases: tuple[Column, int]) -> Column:
    chain = F.when(cases[0][0], cases[0][1])
    for condition, vote in cases[1:]:
        chain = chain.when(condition, vote)
    return chain


def votes(candidates: DataFrame) -> DataFrame:
    """Adds kind and one column for each labeler: 1 yes, 0 no, -1 nothing."""
    value, before = F.col("value"), F.col("before")
    n = F.length(digits(value))
    kind = (
        F.when(F.col("form") == "address", "email")
        .when(F.col("form") == "key", "secret")
        .when(n >= 13, "card")
        .when(n >= 9, "phone")
    )
    known = candidates.withColumn("kind", kind).where("kind is not null")
    is_ = {k: F.col("kind") == k for k in CUES}
    # A group's separator is the same throughout; a phone number has groups.
    card_shape = value.rlike("^[0-9]{4}([\\x20-]?)[0-9]{4}\\1[0-9]{4}\\1[0-9]{1,7}$")
    phone_shape = value.rlike("^\\(?[0-9]{2,4}\\)?[\\x20.-][0-9]{3,4}[\\x20.-]?[0-9]{3,4}$")
    mixed = value.rlike("[0-9]") & value.rlike("[A-Za-z]")
    hexadecimal = value.rlike("^(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64})$")
    harmless = value.rlike("^(?:[0-9]{4}[-.][0-9]{2}[-.][0-9]{2}|[0-9]{1,2}[.][0-9]{1,2}[.][0-9]{4})")
    harmless = harmless | value.rlike("^([0-9A-Za-z-])\\1*$") | value.rlike("^[0-9]+\\.[0-9]+$")
    said = {
        "shape": _vote(
            (is_["email"], 1),
            (is_["card"], card_shape.cast("int")),
            (is_["phone"], phone_shape.cast("int")),
            (is_["secret"] & hexadecimal, 1),
            (is_["secret"] & ~value.rlike("[0-9]"), 0),
        ),
        "check": _vote(
            (is_["card"], (n.between(12, 19) & luhn(digits(value))).cast("int")),
            (is_["phone"], n.between(10, 12).cast("int")),
            (is_["secret"], mixed.cast("int")),
        ),
        "gazetteer": _vote(
            (is_["email"], value.rlike(ENDINGS).cast("int")),
            (is_["card"], digits(value).rlike(ISSUERS).cast("int")),
            (is_["secret"] & value.rlike(KEY_PREFIXES), 1),
        ),
        "context": _vote(*[(is_[k] & before.rlike(cue), 1) for k, cue in CUES.items()], (is_["secret"], 0)),
        "harmless": _vote((harmless, 0)),
    }
    return known.withColumns({k: F.coalesce(v.cast("int"), F.lit(-1)) for k, v in said.items()})


def reliabilities(voted: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """kind, the labelers' votes, and p: how probably such a candidate is personal data."""
    ones = sum((F.col(k) == 1).cast("int") for k in LABELERS)
    noes = sum((F.col(k) == 0).cast("int") for k in LABELERS)
    patterns = voted.groupBy("kind", *LABELERS).agg(F.count("*").alias("n"))
    now = store(patterns.withColumn("p", (ones + 0.5) / (ones + noes + 1)), "vote-patterns")
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("labeler"), F.col(k).alias("vote")) for k in LABELERS]))
    for _ in range(rounds):
        long = now.withColumn("x", each).select("*", "x.labeler", "x.vote")
        rates = long.groupBy("kind", "labeler", "vote").agg(
            F.sum(F.col("n") * F.col("p")).alias("yes"), F.sum(F.col("n") * (1 - F.col("p"))).alias("no")
        )
        totals = now.groupBy("kind").agg(
            F.sum(F.col("n") * F.col("p")).alias("all_yes"), F.sum(F.col("n") * (1 - F.col("p"))).alias("all_no")
        )
        rates = rates.join(totals, "kind").select(
            "kind",
            "labeler",
            "vote",
            (F.log((F.col("yes") + 1) / (F.col("all_yes") + 3)) - F.log((F.col("no") + 1) / (F.col("all_no") + 3))).alias("weight"),
        )
        odds = totals.select("kind", F.log((F.col("all_yes") + 1) / (F.col("all_no") + 1)).alias("prior"))
        told = long.join(rates, ["kind", "labeler", "vote"]).groupBy("kind", *LABELERS, "n").agg(
            F.sum("weight").alias("weight")
        )
        p = 1 / (1 + F.exp(-(F.col("prior") + F.col("weight"))))
        now = store(told.join(odds, "kind").select("kind", *LABELERS, "n", p.alias("p")), "vote-patterns")
    return now.drop("n")


def features(candidates: DataFrame) -> Column:
    shape = F.col("value")
    for pattern, sign in (("[0-9]", "9"), ("[a-z]", "a"), ("[A-Z]", "A"), ("(.)\\1{3,}", "$1+")):
        shape = F.regexp_replace(shape, pattern, sign)
    last_word = F.regexp_extract("before", "(\\S+)[^\\p{L}]*$", 1)
    after = F.regexp_replace(F.regexp_replace("after", "\\s", "_"), "[\\p{L}\\p{N}]", "w")
    length = F.length("value").cast("string")
    named = {"shape": shape, "word": last_word, "after": after, "length": length}
    return F.array(*[F.pmod(F.xxhash64(F.lit(k), v), F.lit(4096)).cast("int") for k, v in named.items()])


def classify(voted: DataFrame, patterns: DataFrame) -> DataFrame:
    """Adds sure: the classifier's probability, trained on the patterns' probabilities.

    Votes enter by the soft labels and again as features, so that what the labelers agree on
    is not outweighed by a rare word.
    """
    labelled = voted.join(patterns, ["kind", *LABELERS]).withColumn("features", features(voted))
    labelled = store(labelled, "labelled-candidates")
    totals = labelled.groupBy("kind").agg(F.sum("p").alias("all_yes"), F.sum(1 - F.col("p")).alias("all_no"))
    each = labelled.select("kind", "p", F.explode("features").alias("feature"))
    weights = each.groupBy("kind", "feature").agg(F.sum("p").alias("yes"), F.sum(1 - F.col("p")).alias("no"))
    weights = weights.join(totals, "kind").select(
        "kind",
        "feature",
        (F.log((F.col("yes") + 1) / (F.col("all_yes") + 50)) - F.log((F.col("no") + 1) / (F.col("all_no") + 50))).alias("weight"),
    )
    odds = totals.select("kind", F.log((F.col("all_yes") + 1) / (F.col("all_no") + 1)).alias("prior"))
    scored = (
        labelled.select("id", "kind", "start", "end", "p", F.explode("features").alias("feature"))
        .join(weights, ["kind", "feature"])
        .groupBy("id", "kind", "start", "end")
        .agg(F.sum("weight").alias("weight"), F.first("p").alias("p"))
        .join(odds, "kind")
    )
    own = F.col("prior") + F.col("weight")
    voted_odds = F.log(F.greatest("p", F.lit(1e-6)) / F.greatest(1 - F.col("p"), F.lit(1e-6)))
    return scored.withColumn("sure", 1 / (1 + F.exp(-(own + voted_odds) / 2)))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def find(docs: DataFrame) -> DataFrame:
    """One row per text: doc_id, an array for each base kind, base, and spans (all of them)."""
    rows = store(spans_of(docs), "spans")
    voted = votes(rows.select("id", F.explode("candidates").alias("c")).select("id", "c.*"))
    voted = store(voted, "votes")
    sure = classify(voted, reliabilities(voted)).where(F.col("sure") >= SURE)
    number = F.array_position(F.lit(KINDS), F.col("kind")).cast("int") - 1
    added = sure.groupBy("id").agg(
        F.collect_list(F.struct("start", number.alias("kind_no"), "kind", "end")).cast(SPAN).alias("added")
    )
    every = F.array_sort(F.concat("base", F.coalesce("added", F.array().cast(SPAN))))
    return rows.join(added, "id", "left").select("doc_id", *BASE, "base", every.alias("spans"))


def report(docs: DataFrame) -> DataFrame:
    return find(docs).select(
        "doc_id",
        *[F.size(kind).cast("long").alias(f"n_{kind}") for kind in BASE],
        sha256(_joined(F.col("base"))).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
    )

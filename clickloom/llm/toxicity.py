"""Toxicity by a subsequence string kernel, Nyström landmarks and a support vector machine.

Units are the words of a text, lower-cased, with look-alike signs turned into letters and
other signs taken out, runs of single letters joined, and the words' first ``STEM`` bytes. The kernel of two units counts
their common subsequences of ``ORDER`` letters, each occurrence weighed by ``DECAY`` to
the power of its span (at most ``SPAN``), divided by both norms and raised to ``POWER``:
letters put in between lower it, but do not break it. Before that power, values under
``LEAST`` count as zero.

Landmarks are the words of the training rows that tell the classes apart best, by the
log-likelihood ratio of their document counts, less those ``NEAR`` a better one. A text's vector has its best kernel value
with each landmark, times the inverse root of the landmarks' own kernel matrix (Nyström),
and a linear support vector machine with squared hinge loss is trained on it, with two
virtual rows for each row of label 1 whose landmarks have a letter put in or doubled. A logistic
curve turns its margins into scores.

Learning uses a bounded sample: per class, at most ``SAMPLE`` labelled texts with the
smallest hashes of their ids, however often an id stands there. The driver gets the landmarks
and the sample's vectors, of which there are at most 4 x ``SAMPLE`` of ``LANDMARKS`` numbers. Scoring reads each whole text
once, on its own; kernel values of words are remembered, within bounds.

Defined results: a null text is an empty one; a text without a landmark's likeness gets the
score of the empty text. Labels are joined by id; null labels and labels of ids without a
text are not used; a repeated label counts once, and of a repeated id every text. If a
class has no row, every score is the share of label 1 (0 without labels). Other columns
are not looked at.
"""

import re
from collections.abc import Iterator
from itertools import combinations
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import Memo
from clickloom.session import store

ORDER = 3
SPAN = 5
STEM = 6
CHUNK = 5000
DECAY = 0.85
LEAST = 0.35
POWER = 3
NEAR = 0.9
LANDMARKS = 128
SAMPLE = 6000
LONGEST = 40
UNIT_MEMO = 500_000
# Look-alike signs; signs that are not listed and are not letters are taken out.
ALIKE = dict(zip(b"013457@$", b"oieastas"))
_KEPT = b" \t\n\x0b\x0c\r" + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100)) + bytes(ALIKE)
_TABLE = bytes(ALIKE.get(c, c) for c in range(256))
_DROPPED = bytes(c for c in range(256) if c not in _KEPT)
_SPELLED = re.compile(rb"(?<!\S)(?:[a-z]\s+){2,39}[a-z](?!\S)")


def units(text: str | None) -> set[bytes]:
    """Words, their stems, and spelled-out words; long ones in overlapping parts."""
    clean = (text or "").encode("utf-8", "replace").lower().translate(_TABLE, _DROPPED)
    found = set(clean.split())
    found.update([b"".join(x.split()) for x in _SPELLED.findall(clean)])
    found.update([x[:STEM] for x in found if len(x) > STEM])
    for unit in [x for x in found if len(x) > LONGEST]:
        found.remove(unit)
        found.update(unit[i : i + LONGEST] for i in range(0, len(unit), LONGEST // 2))
    return found


def altered(found: set[bytes], words: set[bytes], double: bool) -> set[bytes]:
    """The units with a letter put into, or doubled in, each of the words."""
    out = set()
    for unit in found:
        if unit in words:
            at = 1 + crc32(unit) % (len(unit) - 1)
            changed = unit[:at] + (unit[at - 1 : at] if double else b"x") + unit[at:]
            out |= {changed, changed[:STEM]}
        elif unit[:STEM] not in words:
            out.add(unit)
    return out


class Landmarks:
    def __init__(self, words: list[bytes]):
        self.words = words
        self.known = Memo(UNIT_MEMO)
        # Subsequences in order; where each one's entries start; the entries.
        self.keys = self.landmark = np.empty(0, np.int64)
        if words:
            unit, key, weight, norm = self.features(words)
            order = np.argsort(key, kind="stable")
            self.landmark, self.weight = unit[order], (weight / norm[unit])[order]
            self.keys, self.first = np.unique(key[order], return_index=True)
            self.size = np.diff(np.append(self.first, len(order)))

    @staticmethod
    def features(words: list[bytes]):
        """(unit, subsequence, weight) of every subsequence of ORDER letters within SPAN
        letters, once per unit, and each unit's norm."""
        letters = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        unit = np.repeat(np.arange(len(words)), [len(x) for x in words])
        codes, weights = [], []
        for rest in combinations(range(1, SPAN), ORDER - 1):
            n = max(0, len(letters) - rest[-1])
            code = letters[:n]
            for step in rest:
                code = code << 8 | letters[step : step + n]
            code = (code | unit[:n] << 8 * ORDER)[unit[:n] == unit[rest[-1] : rest[-1] + n]]
            codes.append(code)
            weights.append(np.full(len(code), DECAY ** (rest[-1] + 1)))
        code, at = np.unique(np.concatenate(codes), return_inverse=True)
        weight = np.bincount(at, np.concatenate(weights), len(code))
        unit, key = code >> 8 * ORDER, code & (1 << 8 * ORDER) - 1
        norm = np.sqrt(np.bincount(unit, weight * weight, len(words)))
        return unit, key, weight, np.where(norm > 0, norm, 1.0)

    def kernels(self, words: list[bytes]) -> list[tuple[tuple[int, float], ...]]:
        """For each unit, (landmark, kernel value) where that is not zero."""
        out: list[tuple[tuple[int, float], ...]] = [()] * len(words)
        if not words or not len(self.keys):
            return out
        unit, key, weight, norm = self.features(words)
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        hit = np.flatnonzero(self.keys[at] == key)
        unit, at, weight = unit[hit], at[hit], weight[hit] / norm[unit[hit]]
        # One entry for each landmark that has the subsequence too.
        size = self.size[at]
        entry = np.repeat(self.first[at] - np.cumsum(size) + size, size) + np.arange(size.sum())
        cell = np.repeat(unit, size) * len(self.words) + self.landmark[entry]
        values = np.bincount(cell, np.repeat(weight, size) * self.weight[entry])
        found: dict[int, list[tuple[int, float]]] = {}
        for i in np.flatnonzero(values >= LEAST).tolist():
            found.setdefault(i // len(self.words), []).append((i % len(self.words), min(1.0, values[i]) ** POWER))
        for i, pairs in found.items():
            out[i] = tuple(pairs)
        return out

    def vectors(self, texts: list[str | None], alter=None) -> np.ndarray:
        """Each text's best kernel value with each landmark; ``alter`` may change its units."""
        out = np.zeros((len(texts), len(self.words)))
        sets = [alter(units(x)) if alter else units(x) for x in texts]
        known = self.known
        missing = list({u for found in sets for u in found if u not in known})
        fresh: dict[bytes, tuple] = {}
        for i in range(0, len(missing), CHUNK):
            part = missing[i : i + CHUNK]
            fresh.update(zip(part, self.kernels(part)))
        for row, found in zip(out, sets):
            for unit in found:
                values = known.get(unit)
                for k, v in fresh[unit] if values is None else values:
                    row[k] = max(v, row[k])
        for unit, values in fresh.items():
            known.keep(unit, values)
        return out


def inverse_root(landmarks: Landmarks) -> np.ndarray:
    """K^(-1/2) of the landmarks' kernel matrix; directions without extent are left out."""
    n = len(landmarks.words)
    matrix = np.eye(n)
    for i, pairs in enumerate(landmarks.kernels(landmarks.words)):
        for k, v in pairs:
            matrix[i, k] = v
    values, vectors = np.linalg.eigh((matrix + matrix.T) / 2)
    scale = np.where(values > 1e-2, 1 / np.sqrt(np.maximum(values, 1e-2)), 0)
    return vectors * scale @ vectors.T


def support_vectors(x: np.ndarray, y: np.ndarray, cost: float = 1.0, steps: int = 60) -> np.ndarray:
    """Weights, the last for the constant, of a linear machine with squared hinge loss, by
    Newton steps; both classes weigh the same."""
    x = np.column_stack([x, np.ones(len(x))])
    sign = np.where(y > 0, 1.0, -1.0)
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y <= 0).sum())) * len(y)
    w = np.zeros(x.shape[1])
    keep = np.eye(x.shape[1])
    keep[-1, -1] = 1e-6
    for _ in range(steps):
        inside = sign * (x @ w) < 1
        weight = 2 * cost * share * inside
        step = np.linalg.solve(keep + (x.T * weight) @ x, (x.T * weight) @ sign)
        if np.allclose(step, w, atol=1e-9):
            break
        w = step
    return w


def logistic(margins: np.ndarray, y: np.ndarray, prior: float) -> tuple[float, float]:
    """Slope and constant of the score's curve; the classes weigh as in all labelled rows."""
    target = np.where(y > 0, (sum(y > 0) + 1) / (sum(y > 0) + 2), 1 / (sum(y <= 0) + 2))
    weight = np.where(y > 0, prior / max(1, (y > 0).sum()), (1 - prior) / max(1, (y <= 0).sum())) * len(y)
    x = np.column_stack([margins, np.ones(len(margins))])
    v = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ v, -30, 30)))
        slope = x.T @ (weight * (p - target)) + 1e-3 * v
        bend = (x.T * (weight * np.maximum(p * (1 - p), 1e-9))) @ x + 1e-3 * np.eye(2)
        v = v - np.linalg.solve(bend, slope)
    return float(v[0]), float(v[1])


class Model:
    def __init__(self, words: list[bytes], weights: np.ndarray, curve: tuple[float, float]):
        self.landmarks, self.weights, self.curve = Landmarks(words), weights, curve

    def __reduce__(self):
        return Model, (self.landmarks.words, self.weights, self.curve)

    def scores(self, texts: list[str | None]) -> np.ndarray:
        margins = self.landmarks.vectors(texts) @ self.weights[:-1] + self.weights[-1]
        return 1 / (1 + np.exp(-np.clip(self.curve[0] * margins + self.curve[1], -30, 30)))


def _in_parts(of, texts: pd.Series) -> np.ndarray:
    parts = [of(list(texts.iloc[i : i + 128])) for i in range(0, len(texts), 128)]
    return np.concatenate(parts) if parts else np.zeros(0)


def _sample(docs: DataFrame, labels: DataFrame, size: int) -> DataFrame:
    """At most ``size`` texts (text, toxic) of each class, whatever repeats."""
    picks = [
        labels.where(F.col("toxic") == k).distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(size) for k in (0, 1)
    ]
    picked = store(picks[0].unionAll(picks[1]), "labelled-ids")
    met = docs.select("doc_id", "text").where(F.col("text").isNotNull()).join(F.broadcast(picked), "doc_id")
    order = [F.xxhash64("doc_id"), "doc_id", F.xxhash64("text"), "text"]
    texts = [met.where(F.col("toxic") == k).orderBy(*order).limit(size).select("text", "toxic") for k in (0, 1)]
    return store(texts[0].unionAll(texts[1]), "labelled-sample")


def choose_landmarks(rows: DataFrame, count: int) -> list[bytes]:
    """The words with the largest log-likelihood ratio of their counts of texts per class."""

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [(u, int(y)) for t, y in zip(batch["text"], batch["toxic"]) for u in units(t) if 3 <= len(u) <= 24]
            yield pd.DataFrame(found, columns=["unit", "toxic"])

    of = F.col("toxic")
    counts = rows.mapInPandas(spread, "unit binary, toxic int").groupBy("unit").agg(
        F.sum(of).alias("a"), F.sum(1 - of).alias("b")
    )
    sizes = rows.groupBy().agg(F.coalesce(F.sum("toxic"), F.lit(0)), F.coalesce(F.sum(1 - of), F.lit(0))).first()
    n1, n0 = map(int, sizes)

    both = (F.col("a") + F.col("b")) / max(1, n1 + n0)

    def part(have, total):
        return have * F.log((have + 1e-9) / (total * both + 1e-9))

    ratio = part(F.col("a"), n1) + part(F.col("b"), n0)
    best = counts.where("a + b >= 3").withColumn("ratio", ratio).orderBy(F.desc("ratio"), "unit").limit(3 * count)
    words = [bytes(r.unit) for r in best.collect()]
    chosen: dict[int, bytes] = {}
    for i, pairs in enumerate(Landmarks(words).kernels(words)):
        if len(chosen) < count and not any(k in chosen and v >= NEAR**POWER for k, v in pairs):
            chosen[i] = words[i]
    return list(chosen.values())


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, landmarks: int = LANDMARKS) -> Model:
    """A model from the rows of ``labels`` (doc_id, toxic) and the texts of their ids."""
    known = labels.where("toxic in (0, 1)").select("doc_id", F.col("toxic").cast("int"))
    rows = _sample(docs, known, sample)
    share = known.agg(F.avg("toxic")).first()[0] or 0.0
    words = choose_landmarks(rows, landmarks)
    found = Landmarks(words)

    listed = set(words)
    changes = [None, *(lambda u, double=double: altered(u, listed, double) for double in (False, True))]

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for change in changes:
                of = batch[batch["toxic"] == 1] if change else batch
                if len(of):
                    x = _in_parts(lambda texts, change=change: found.vectors(texts, change), of["text"])
                    yield pd.DataFrame({"x": x.tolist(), "toxic": of["toxic"].tolist(), "real": change is None})

    got = rows.mapInPandas(vectors, "x array<double>, toxic int, real boolean").toPandas()
    y = got["toxic"].to_numpy()
    if not words or len(set(y)) < 2:
        constant = float(np.log(max(share, 1e-9) / max(1 - share, 1e-9)))
        return Model([], np.zeros(1), (0.0, max(-20.0, min(20.0, constant))))
    root = inverse_root(found)
    mapped = np.array(got["x"].tolist()) @ root
    weights = support_vectors(mapped, y)
    real = got["real"].to_numpy()
    curve = logistic(mapped[real] @ weights[:-1] + weights[-1], y[real], share)
    return Model(words, np.append(root @ weights[:-1], weights[-1]), curve)


def score(text: Column, model: Model) -> Column:
    """The probability of label 1."""

    @F.pandas_udf("double")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(_in_parts(model.scores, texts), dtype="float64")

    return of(text)

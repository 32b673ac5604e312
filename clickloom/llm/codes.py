"""Vector codes: product quantisation in whole numbers, with equal-average search.

A vector is cut into equal parts, and a part is coded as the nearest of its position's
entries (squared distance, the lower index among equals). Equal-average search finds it:
the entries are sorted by the sum of their components; from the place of the part's own sum
the search goes outward to both sides, the smaller gap first. As the squared gap between two
sums over the dimension is never more than the squared distance, a part is done when that
quotient strictly exceeds the best distance so far. All parts of a batch go through these
steps side by side in numpy; a part that is done leaves.

Training rounds are Spark jobs: every task adds up the parts it assigned, and one row per
entry component leaves it. What goes through the driver are codebooks, ``entries`` times
the vectors' length, whatever the input.

Defined results: vectors that are null, or hold nulls or values that are not finite, are
dropped; so are vectors of another length than that of the first kept one. That length must
be a multiple of the number of parts. Components up to ``LARGEST`` are exact; a larger one
fails the job with a message. The first entries go by id, null ids last, equal ids by their
vectors; with fewer vectors there are fewer entries. Repeated rows count one by one, an
empty table gives no rows, and a null label is a label like others. Other columns are not
looked at.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.operators.joins import join_on, lookup
from clickloom.session import store

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
#: Squared distances of parts of up to 4,096 components then fit into 62 bits.
LARGEST = 2.0**12
ROWS = 4096


def kept(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """The rows whose vector can be coded; the first one's length decides between lengths."""
    x = F.col(vector)
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    whole = vectors.where(x.isNotNull() & ~F.coalesce(bad, F.lit(True)) & (F.size(x) > 0))
    first = whole.orderBy(F.asc_nulls_last("vec_id"), vector).select(F.size(vector)).first()
    return whole.where(F.size(vector) == (first[0] if first else 0))


def whole_numbers(column: pa.Array) -> np.ndarray:
    """The vectors of an Arrow list column as a matrix of integers."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(values) and np.abs(values).max() > LARGEST:
        raise ValueError(f"a component beyond {LARGEST:.0f} cannot be coded")
    return np.floor(values * SCALE).astype(np.int64).reshape(len(column), -1)


def nearest(points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal-average search: for every point the index of its nearest entry, the lower one
    among equals, and the squared distance."""
    count, width = entries.shape
    order = np.argsort(entries.sum(axis=1), kind="stable")
    sums, own = entries.sum(axis=1)[order], points.sum(axis=1)
    up = np.searchsorted(sums, own)
    down = up - 1
    best = np.full(len(points), np.iinfo(np.int64).max)
    index = np.full(len(points), count)
    at = np.arange(len(points))
    far = np.iinfo(np.int64).max
    while len(at):
        above = np.where(up[at] < count, np.abs(sums[np.minimum(up[at], count - 1)] - own[at]), far)
        below = np.where(down[at] >= 0, np.abs(own[at] - sums[np.maximum(down[at], 0)]), far)
        gap = np.minimum(above, below)
        # Wide floats hold both sides or round them alike, so that equality never ends a search.
        open_ = (gap != far) & ~(gap.astype(np.longdouble) ** 2 > best[at].astype(np.longdouble) * width)
        at, upward = at[open_], (above <= below)[open_]
        if not len(at):
            break
        place = np.where(upward, up[at], down[at])
        up[at] += upward
        down[at] -= ~upward
        entry = order[place]
        difference = points[at] - entries[entry]
        distance = np.einsum("ij,ij->i", difference, difference)
        better = (distance < best[at]) | ((distance == best[at]) & (entry < index[at]))
        best[at[better]], index[at[better]] = distance[better], entry[better]
    return index, best


def assign(points: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The index of every part of every point, and the squared distances. ``books`` is
    (parts, entries, width)."""
    parts, _, width = books.shape
    cut = points.reshape(len(points), parts, width)
    found = [nearest(np.ascontiguousarray(cut[:, p]), books[p]) for p in range(parts)]
    return np.stack([i for i, _ in found], axis=1), np.stack([d for _, d in found], axis=1)


def first_books(vectors: DataFrame, parts: int, entries: int, vector: str = "embedding") -> np.ndarray:
    rows = vectors.orderBy(F.asc_nulls_last("vec_id"), vector).limit(entries).select(vector).collect()
    if not rows:
        return np.zeros((parts, 0, 0), np.int64)
    if len(rows[0][0]) % parts:
        raise ValueError(f"vectors of {len(rows[0][0])} components cannot be cut into {parts} parts")
    points = whole_numbers(pa.array([r[0] for r in rows], pa.list_(pa.float64())))
    return np.ascontiguousarray(points.reshape(len(rows), parts, -1).transpose(1, 0, 2))


def refined(vectors: DataFrame, books: np.ndarray, vector: str = "embedding") -> np.ndarray:
    """The codebooks after one round: every entry the mean of its parts, rounded down."""
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((parts, entries, width), np.int64)
        counts = np.zeros((parts, entries), np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                points = whole_numbers(batch.column(0)[start : start + ROWS])
                index, _ = assign(points, books)
                cut = points.reshape(len(points), parts, width)
                for p in range(parts):
                    np.add.at(sums[p], index[:, p], cut[:, p])
                    counts[p] += np.bincount(index[:, p], minlength=entries)
        used = np.flatnonzero(counts)
        slot = (used[:, None] * width + np.arange(width)).ravel()
        yield pa.RecordBatch.from_pydict(
            {"slot": slot.astype(np.int32), "total": sums.reshape(-1)[slot], "n": np.repeat(counts.reshape(-1)[used], width)}
        )

    added = vectors.select(vector).mapInArrow(run, "slot int, total long, n long")
    means = added.groupBy("slot").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect()
    fresh = books.reshape(-1).copy()
    for row in means:
        fresh[row["slot"]] = row["total"] // row["n"]
    return fresh.reshape(books.shape)


def train(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, vector: str = "embedding"):
    books = first_books(vectors, parts, entries, vector)
    for _ in range(rounds if books.size else 0):
        books = refined(vectors, books, vector)
    return books


def coded(vectors: DataFrame, books: np.ndarray, vector: str = "embedding") -> DataFrame:
    """All columns but the vector, then code (two hex digits a part) and error."""
    others = [c for c in vectors.columns if c not in (vector, "code", "error")]
    fields = [f for f in vectors.select(*others).schema]
    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                piece = batch.slice(start, ROWS)
                index, distance = assign(whole_numbers(piece.column(len(others))), books)
                code = ["".join([f"{i:02x}" for i in row]) for row in index.tolist()]
                columns = [*piece.columns[:-1], pa.array(code), pa.array(distance.sum(axis=1))]
                yield pa.RecordBatch.from_arrays(columns, names=[*others, "code", "error"])

    return vectors.select(*others, vector).mapInArrow(run, f"{kind}, code string, error long")


def books_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, code, error, label_error (summed over equal labels, nulls together) and the
    digest of the codebooks, for every vector kept."""
    usable = kept(vectors.select("vec_id", "label", "embedding"))
    books = train(usable, parts, entries, rounds)
    done = store(coded(usable, books), "codes")
    by_label = store(done.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors")
    met = join_on(done, lookup(by_label), ["label"])
    digest: Column = F.lit(books_digest(books)).alias("codebooks_sha256")
    return met.select("vec_id", "code", "error", "label_error", digest)

"""Vector compression by part codebooks, learned by active-entry Lloyd rounds on exact integers.

A vector is scaled to integers and cut into consecutive parts; each part is
replaced by the index of the nearest entry of its position's codebook. A round
assigns every part, then moves each entry to the floor of its parts' mean.

From the second assignment on, a part knows its entry and the exact distance to
it. If that entry stayed where it was, no other entry that stayed can have come
nearer, so the part is compared with the moved entries only; a part whose entry
moved is compared with all. Ties go to the lower index in both cases, so the
result is that of comparing everything in every round.

The vectors, entries and distances are a written table that each assignment
replaces; in the same pass a task adds up its parts by entry, so a round moves
one row for each used entry and task. The driver holds the codebooks only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from handover.llm import scratch
from handover.operators.skew import split_join

_ROWS = 4_096  # vectors whose distances are held at once
_LARGEST = 2**40  # of a scaled component
_FARTHEST = 2**62


def squared_distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances [rows, entries] of integer vectors; ``2 ** 62`` stands for all from there on."""
    if not x.shape[1]:
        return np.zeros((len(x), len(entries)), np.int64)
    most = max((int(np.abs(a).max()) for a in (x, entries) if a.size), default=0)
    bound = 4 * most * most * x.shape[1]
    if bound < 2**53:  # every intermediate value is an exact double
        a, b = x.astype(np.float64), entries.astype(np.float64)
        return ((a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)).astype(np.int64)
    kind = np.int64 if bound < _FARTHEST else object
    a, b = x.astype(kind), entries.astype(kind)
    out = np.stack([((a - e) * (a - e)).sum(axis=1) for e in b], axis=1)
    return np.minimum(out, _FARTHEST).astype(np.int64)


def assign(x: np.ndarray, entries: np.ndarray, moved: np.ndarray | None = None, own: np.ndarray | None = None, far: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry of each row and the squared distance to it.

    With ``moved`` (by entry), ``own`` and ``far`` (entry and distance before the
    move), rows whose entry stayed look at moved entries only.
    """
    if moved is None:
        d = squared_distances(x, entries)
        best = d.argmin(axis=1)
        return best, d[np.arange(len(x)), best]
    best, dist = own.astype(np.int64), far.astype(np.int64)
    again = moved[best]
    rows, went = np.flatnonzero(~again), np.flatnonzero(moved)
    if len(rows) and len(went):
        d = squared_distances(x[rows], entries[went])
        near = d.argmin(axis=1)  # the lowest index of equal ones
        d, index = d[np.arange(len(rows)), near], went[near]
        nearer = (d < dist[rows]) | ((d == dist[rows]) & (index < best[rows]))
        best[rows[nearer]], dist[rows[nearer]] = index[nearer], d[nearer]
    if again.any():
        best[again], dist[again] = assign(x[again], entries)
    return best, dist


class Codebooks:
    """Entries by part position, and which of them moved last."""

    def __init__(self, first: np.ndarray, parts: int):
        width = first.shape[1]
        self.cuts = [width * i // parts for i in range(parts + 1)]
        self.entries = [first[:, a:b].copy() for a, b in zip(self.cuts, self.cuts[1:])]
        self.moved: list[np.ndarray] | None = None

    def update(self, sums: dict[tuple[int, int, int], tuple[int, int]]) -> None:
        """Entries become floor(sum / count), by (part, entry, place); entries without parts stay."""
        old = [e.copy() for e in self.entries]
        for (part, entry, place), (total, n) in sums.items():
            self.entries[part][entry, place] = total // n
        self.moved = [(a != b).any(axis=1) for a, b in zip(old, self.entries)]

    def digest(self) -> str:
        """SHA-256 of all components in decimal, by part, entry and place, joined by commas."""
        return hashlib.sha256(",".join(str(v) for e in self.entries for v in e.ravel().tolist()).encode()).hexdigest()


_SUMS = T.StructType().add("part", T.IntegerType()).add("entry", T.IntegerType()).add("n", T.LongType()).add("sums", T.ArrayType(T.LongType()))


def _pass(state: DataFrame, books: Codebooks, sums: bool) -> DataFrame:
    """One assignment: the rows with new ``codes`` and ``dists``, and a task's sums as further rows (``part`` not null)."""
    shared = state.sparkSession.sparkContext.broadcast(books)  # entries x width integers
    kept = T.StructType([f for f in state.schema.fields if f.name in ("key", "label", "v", "codes", "dists")])
    schema = T.StructType([*kept.fields, *_SUMS.fields])

    def matrix(column: pa.Array, width: int) -> np.ndarray:
        return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width) if width else np.zeros((len(column), 0), np.int64)

    def lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
        off = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
        return pa.ListArray.from_arrays(pa.array(off), pa.array(values.ravel(), kind))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = shared.value
        spans = list(zip(b.cuts, b.cuts[1:]))
        # of each part: sums of the assigned vectors by entry, as integers without a bound
        total = [np.zeros(e.shape, object) for e in b.entries]
        count = [np.zeros(len(e), np.int64) for e in b.entries]
        for whole in batches:
            for at in range(0, whole.num_rows, _ROWS):
                batch = whole.slice(at, _ROWS)
                v = matrix(batch.column("v"), b.cuts[-1])
                known = b.moved is not None
                codes = matrix(batch.column("codes"), len(spans)).copy() if known else np.zeros((len(v), len(spans)), np.int64)
                dists = matrix(batch.column("dists"), len(spans)).copy() if known else np.zeros((len(v), len(spans)), np.int64)
                for p, (a, z) in enumerate(spans):
                    x = v[:, a:z]
                    codes[:, p], dists[:, p] = assign(x, b.entries[p], b.moved[p], codes[:, p], dists[:, p]) if known else assign(x, b.entries[p])
                    if sums:
                        order = np.argsort(codes[:, p], kind="stable")
                        used, begin = np.unique(codes[order, p], return_index=True)
                        if z > a:
                            total[p][used] += np.add.reduceat(x[order], begin, axis=0)
                        count[p] += np.bincount(codes[:, p], minlength=len(count[p]))
                made = {"codes": lists(codes, pa.int32()), "dists": lists(dists, pa.int64())}
                columns = [made[f.name] if f.name in made else batch.column(f.name) for f in kept.fields]
                empty = [pa.nulls(len(v), t) for t in to_arrow_schema(_SUMS).types]
                yield pa.RecordBatch.from_arrays([*columns, *empty], names=schema.names)
        found = [(p, e) for p in range(len(spans)) for e in np.flatnonzero(count[p]).tolist()]
        if sums and found:
            rows = [pa.array([p for p, _ in found], pa.int32()), pa.array([e for _, e in found], pa.int32())]
            rows += [pa.array([int(count[p][e]) for p, e in found], pa.int64()), pa.array([total[p][e].tolist() for p, e in found], pa.list_(pa.int64()))]
            none = [pa.nulls(len(found), f.type) for f in to_arrow_schema(kept)]
            yield pa.RecordBatch.from_arrays([*none, *rows], names=schema.names)

    return state.mapInArrow(run, schema)


def compress(vectors: DataFrame, vector: str = "embedding", key: str = "vec_id", label: str = "label", parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024) -> tuple[DataFrame, Codebooks | None]:
    """(key, label, codes array<int>, dists array<long>) for each kept row, and the codebooks.

    Dropped: rows whose vector is null or holds a null or non-finite component,
    and, as they can't be coded together, rows of another length than the vector
    of the smallest key. Components are floor(scale * x), at most 2 ** 40 in size.
    A length that ``parts`` doesn't divide is cut as evenly as can be. Each
    codebook starts from the ``entries`` smallest keys (all, if fewer); among
    equal keys the lesser vector comes first, null keys come last. Repeated rows
    are coded alike and stay. Nothing kept: no rows, and no codebooks. Other
    columns are not read.
    """
    column = F.col(f"`{vector}`")
    finite = column.isNotNull() & F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = lambda x: F.least(F.greatest(F.floor(x.cast("double") * scale), F.lit(-_LARGEST)), F.lit(_LARGEST)).cast("long")
    rows = vectors.where(finite).select(F.col(f"`{key}`").alias("key"), F.col(f"`{label}`").alias("label"), F.transform(column, whole).alias("v"))
    rows = rows.withColumn("codes", F.lit(None).cast("array<int>")).withColumn("dists", F.lit(None).cast("array<long>"))
    smallest = lambda df: df.orderBy(F.col("key").asc_nulls_last(), "v").select("v").limit(entries).collect()  # noqa: E731  # ``entries`` rows
    first = smallest(rows)
    if not first:
        return rows, None
    width = len(first[0]["v"])
    if any(len(r["v"]) != width for r in first):
        first = smallest(rows.where(F.size("v") == width))
    books = Codebooks(np.array([r["v"] for r in first], np.int64).reshape(len(first), width), parts)
    state, old = rows.where(F.size("v") == width), None
    for _ in range(rounds):
        done = scratch.write(_pass(state, books, True), "vector-codes")
        scratch.drop(old)
        old, state = done, done.where("part is null").select("key", "label", "v", "codes", "dists")
        sums = done.where("part is not null").select("part", "entry", "n", F.posexplode("sums").alias("place", "s"))
        sums = sums.groupBy("part", "entry", "place").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n"))
        books.update({(r["part"], r["entry"], r["place"]): (int(r["s"]), r["n"]) for r in sums.collect()})  # entries x width rows
    coded = scratch.write(_pass(state, books, False).select("key", "label", "codes", "dists"), "vector-codes")
    scratch.drop(old)
    return coded, books


def code_vectors(vectors: DataFrame, vector: str = "embedding", key: str = "vec_id", label: str = "label", **settings) -> DataFrame:
    """(key, code, error, label_error, codebooks_sha256) for each row that ``compress`` keeps.

    ``code`` is the indices in part order, two hex digits each (256 entries at
    most); ``error`` the squared distances summed over parts; ``label_error`` the
    errors summed over all rows of the label, null being a label like others.
    """
    if settings.get("entries", 256) > 256:
        raise ValueError("an index has two hex digits: 256 entries at most")
    coded, books = compress(vectors, vector, key, label, **settings)
    index = F.transform("codes", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0"))
    error = F.aggregate("dists", F.lit(0).cast("long"), lambda a, d: a + d)
    coded = coded.select("key", "label", F.array_join(index, "").alias("code"), error.alias("error"), F.spark_partition_id().alias("place"))
    of_label = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    # a label may hold most rows; the place tells rows of one key apart
    joined = split_join(coded, of_label, "label", "of", "left", ["key", "place"], null_safe=True)
    digest = F.lit(books.digest() if books else hashlib.sha256(b"").hexdigest())
    return joined.select(F.col("key").alias(key), "code", "error", "label_error", digest.alias("codebooks_sha256"))

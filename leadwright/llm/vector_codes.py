"""Product codes of vectors, by Lloyd rounds that look at active entries only.

Vectors become integers and are cut into equal parts; each part position has a codebook, learned by a fixed number of rounds
and then used to write a vector as one index per part. Between two rounds most entries soon stand still. A part keeps the
exact squared distance to its entry; where that entry did not move, only the entries that did are compared with the
kept distance, and where it moved, the part is compared with all entries again. Both give the nearest entry, the lower index
at equal distance, just as a full scan would.

Every round reads and writes a table of vectors, indices and distances in the shared folder, so a lost executor repeats its
tasks of one round; the table of the round before is then deleted. Sums are formed per Arrow batch, exact in 64 bits, and added on
Spark as decimals; the driver sees one number per part, entry and component.

Defined cases: vectors that are null, empty or hold null or non-finite components are dropped; the length is that of the
smallest kept vec_id's vector, and vectors of another length are dropped too; a length that the parts do not divide is
filled up with zeros; components beyond +-2^27 count as that; fewer different vec_ids than entries give fewer entries; of
repeated rows with one vec_id all are coded and the smallest vector (as an array) stands in the start; a null vec_id is
coded, not in the start; equal labels meet, nulls together; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadwright.llm import tools
from leadwright.session import clear_stages

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
LIMIT = 2**27
#: Vectors compared at once, so that the distance table stays small.
STEP = 2048


def integers(vectors: np.ndarray, scale: int = SCALE) -> np.ndarray:
    return np.clip(np.floor(float(scale) * vectors.astype(np.float64)), -LIMIT, LIMIT).astype(np.int64)


def _distances(part: np.ndarray, entries: np.ndarray) -> np.ndarray:
    out = np.zeros((len(part), len(entries)), np.int64)
    for x, c in zip(part.T, entries.T):  # one component at a time: no table of rows x entries x components
        gap = x[:, None] - c[None, :]
        gap *= gap
        out += gap
    return out


def assign(part: np.ndarray, entries: np.ndarray, codes: np.ndarray | None, kept: np.ndarray | None, moved: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry of each part and the squared distance; ``codes`` and ``kept`` are those of the round before."""
    new_codes, new_kept = np.zeros(len(part), np.int64), np.zeros(len(part), np.int64)
    stale = np.ones(len(part), bool) if codes is None else moved[codes]
    again = np.flatnonzero(stale)
    if len(again):
        d = _distances(part[again], entries)
        new_codes[again] = d.argmin(axis=1)
        new_kept[again] = d.min(axis=1)
    still = np.flatnonzero(~stale)
    if len(still):
        old, best, active = codes[still], kept[still], np.flatnonzero(moved)
        if len(active):
            d = _distances(part[still], entries[active])
            near, at = d.min(axis=1), active[d.argmin(axis=1)]
            better = (near < best) | ((near == best) & (at < old))
            old, best = np.where(better, at, old), np.where(better, near, best)
        new_codes[still], new_kept[still] = old, best
    return new_codes, new_kept


def _matrix(batch: pa.RecordBatch, width: int, first: bool) -> np.ndarray:
    column = batch.column("vector")
    if first:
        given = integers(column.flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1))
        return np.pad(given, ((0, 0), (0, width - given.shape[1])))
    return np.frombuffer(b"".join(column.to_pylist()), np.int32).reshape(len(batch), width).astype(np.int64)


def _round(book: np.ndarray, moved: np.ndarray, first: bool, last: bool):
    """One round over a batch: indices, distances and, in the first row, the batch's sums and counts per entry."""
    parts, entries, size = book.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = len(batch)
            if not n:
                continue
            vectors = _matrix(batch, parts * size, first)
            codes, kept = np.zeros((n, parts), np.uint8), np.zeros((n, parts), np.int64)
            old = None if first else np.frombuffer(b"".join(batch.column("codes").to_pylist()), np.uint8).reshape(n, parts).astype(np.int64)
            was = None if first else np.frombuffer(b"".join(batch.column("kept").to_pylist()), np.int64).reshape(n, parts)
            sums = np.zeros((parts, entries, size + 1), np.int64)
            for a in range(0, n, STEP):
                rows = slice(a, min(a + STEP, n))
                for p in range(parts):
                    part = vectors[rows, p * size:(p + 1) * size]
                    c, d = assign(part, book[p], None if first else old[rows, p], None if first else was[rows, p], moved[p])
                    codes[rows, p], kept[rows, p] = c, d
                    if not last:
                        for e in np.unique(c):
                            sums[p, e, :size] += part[c == e].sum(axis=0)
                            sums[p, e, size] += int((c == e).sum())
            ids, labels = batch.column("vec_id"), batch.column("label")
            if last:
                text = pa.array([x.tobytes().hex() for x in codes], pa.string())
                yield pa.RecordBatch.from_arrays([ids, labels, text, pa.array(kept.sum(axis=1), pa.int64())], ["vec_id", "label", "code", "error"])
                continue
            binary = lambda rows: pa.array([x.tobytes() for x in rows], pa.binary())
            partial = pa.array([sums.ravel().tolist()] + [None] * (n - 1), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, labels, binary(vectors.astype(np.int32)), binary(codes), binary(kept), partial],
                                             ["vec_id", "label", "vector", "codes", "kept", "partial"])

    return run


def _start(kept: DataFrame, entries: int) -> list:
    """Vectors of the smallest different vec_ids, ascending; each step reads the ids once and looks at ``entries`` rows."""
    found: dict = {}
    rest = kept.filter("vec_id IS NOT NULL")
    while len(found) < entries:
        rows = rest.orderBy("vec_id", "vector").limit(entries).collect()
        for r in rows:
            if len(found) < entries:
                found.setdefault(r["vec_id"], r["vector"])
        if len(rows) < entries:
            break
        rest = kept.filter(F.col("vec_id") > F.lit(max(found)))
    return list(found.values())


def encode(table: DataFrame, vector: str = "embedding", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """vec_id, label, code (two hex digits per part), error (squared distances); and the codebooks (part, entry, component)."""
    spark = table.sparkSession
    x = F.col(f"`{vector}`")
    whole = x.isNotNull() & (F.size(x) > 0) & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    kept = table.filter(whole).select("vec_id", "label", x.cast("array<double>").alias("vector"))
    first = kept.orderBy(F.asc_nulls_last("vec_id"), "vector").limit(1).collect()
    if not first:
        empty = kept.limit(0).select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
        return empty, np.zeros((parts, 0, 0), np.int64)
    length = len(first[0]["vector"])
    kept = kept.filter(F.size("vector") == length)
    start = _start(kept, entries) or [first[0]["vector"]]  # without any vec_id the smallest vector stands in the start
    size = -(-length // parts)
    book = np.pad(integers(np.array(start)), ((0, 0), (0, parts * size - length))).reshape(len(start), parts, size).transpose(1, 0, 2).copy()
    state, moved = kept, np.ones(book.shape[:2], bool)
    types = {f.name: f.dataType.simpleString() for f in state.schema}
    head, run, before = f"vec_id {types['vec_id']}, label {types['label']}", uuid.uuid4().hex, None
    for i in range(rounds):
        name = f"vector-codes-{run}-{i}"
        state = tools.materialise(state.drop("partial").mapInArrow(
            _round(book, moved, i == 0, False), f"{head}, vector binary, codes binary, kept binary, partial array<bigint>"), name)
        if before:
            clear_stages(spark, before)
        before = name
        added = state.filter("partial IS NOT NULL").select(F.posexplode("partial")).groupBy("pos").agg(
            F.sum(F.col("col").cast("decimal(20,0)")).alias("s")).collect()  # one row per part, entry and component
        sums = np.zeros(book.size + book.shape[0] * book.shape[1], object)
        for r in added:
            sums[r["pos"]] = int(r["s"])
        sums = sums.reshape(*book.shape[:2], size + 1)
        new = book.copy()
        for p, e in np.ndindex(*book.shape[:2]):
            if sums[p, e, size]:
                new[p, e] = [s // sums[p, e, size] for s in sums[p, e, :size]]
        moved, book = (new != book).any(axis=2), new
    return state.drop("partial").mapInArrow(_round(book, moved, rounds == 0, True), f"{head}, code string, error bigint"), book


def codebooks_sha256(book: np.ndarray) -> str:
    """Of all components, by part, entry and place, in decimal, with commas between."""
    return hashlib.sha256(",".join(str(v) for v in book.ravel().tolist()).encode()).hexdigest()


def coded_vectors(table: DataFrame, **options) -> DataFrame:
    """vec_id, code, error, label_error (errors of equal labels; null beyond 63 bits) and codebooks_sha256."""
    coded, book = encode(table, **options)
    coded = tools.materialise(coded, "vector-codes")
    totals = coded.groupBy(F.col("label").alias("of")).agg(F.sum(F.col("error").cast("decimal(20,0)")).alias("label_error"))
    met = coded.join(totals, F.col("label").eqNullSafe(F.col("of")))
    return met.select("vec_id", "code", "error", F.expr("try_cast(label_error AS bigint)").alias("label_error"),
                      F.lit(codebooks_sha256(book)).alias("codebooks_sha256"))

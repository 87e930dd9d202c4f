"""Whitening of vectors by the leading eigenvectors of their covariance, which is never formed.

The vectors are packed once, as integers, in blocks. One Spark pass multiplies the covariance with a block of columns:
every task adds Xᵀ(XQ) of its centred rows, and d x b sums reach the driver, whatever the number of rows. The driver
makes the products orthonormal (QR) and solves the projected problem (Rayleigh-Ritz) over the blocks so far; it goes on
until the residuals ‖Vu - eu‖ of all k leading vectors certify them. Of more than KEPT_BLOCKS blocks, the leading Ritz
vectors are kept (restart), so that the driver's memory is bounded by the dimension alone.

Defined cases: rows are dropped whose vector is null, empty, or has a null, non-finite or too large entry (beyond
LARGEST after scaling), or another length than most vectors (of equally frequent lengths, the longer counts). A null id
is an id like another, repeated ids and vectors are rows of their own. Directions without variance can't be whitened
and aren't returned: equal vectors alone, or an empty table, give no rows. A deviation beyond 64 bits is null. Extra
columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom._ship import ensure_importable
from docloom.llm.memory import lean
from docloom.llm.workspace import Workspace

#: Entries of a block of packed vectors; columns multiplied in a pass; blocks of columns kept before a restart; most passes.
BLOCK_ENTRIES, COLUMNS, KEPT_BLOCKS, MOST_PASSES = 1 << 18, 16, 8, 300
LARGEST = float(1 << 52)
PACKED = "dim int, n bigint, ids array<bigint>, wide boolean, body binary, sums array<bigint>"
WHITENED = "vec_id bigint, component int, n bigint, deviation bigint, whitened double"


def _pack(batches: Iterator[pa.RecordBatch], scale: float, offset: int) -> Iterator[pa.RecordBatch]:
    """Rows of one length are packed together; a task keeps one open block a length."""
    held: dict[int, list[tuple[pa.Array, np.ndarray]]] = {}

    def block(dim: int) -> pa.RecordBatch:
        ids, x = (f(y) for f, y in zip((pa.concat_arrays, np.concatenate), zip(*held.pop(dim), strict=True), strict=True))
        wide = bool(np.abs(x).max() >= 1 << 31)
        row = [dim, len(x), ids, wide, x.astype(np.int64 if wide else np.int32).tobytes(), x.sum(axis=0)]
        return pa.RecordBatch.from_arrays([pa.array([v], type=t) for v, t in zip(row, (pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.bool_(), pa.binary(), pa.list_(pa.int64())), strict=True)], ["dim", "n", "ids", "wide", "body", "sums"])

    for batch in batches:
        ids, vectors = batch.column(0), batch.column(1)
        lengths = pc.list_value_length(vectors).to_numpy(zero_copy_only=False)
        for dim in np.unique(lengths).tolist():
            chosen = pa.array(np.flatnonzero(lengths == dim))
            own, rows = ids.take(chosen), vectors.take(chosen).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
            x = np.floor(scale * rows)
            fits = (np.abs(x) <= LARGEST).all(axis=1)
            own, x = own.filter(pa.array(fits)), x[fits].astype(np.int64) + offset
            step = max(1, BLOCK_ENTRIES // dim)
            for at in range(0, len(x), step):
                held.setdefault(dim, []).append((own.slice(at, step), x[at : at + step]))
                if sum(len(y) for _, y in held[dim]) >= step:
                    yield block(dim)
    for dim in list(held):
        yield block(dim)


@dataclass
class Packed:
    """Blocks of n integer vectors; sums: S, exactly. base: S // n; rest: S - n * base."""

    blocks: DataFrame
    dim: int
    n: int
    sums: list[int]

    @property
    def base(self) -> np.ndarray:
        return np.array([s // self.n for s in self.sums], dtype=np.int64)

    @property
    def rest(self) -> np.ndarray:
        return np.array([s % self.n for s in self.sums], dtype=np.int64)

    def column_sums(self, of: Callable[[np.ndarray], np.ndarray], rows: int, columns: int) -> np.ndarray:
        """The sum over all blocks of of(centred rows), a rows x columns matrix that each task adds up before it sends it."""
        centred = self.reader()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((rows, columns))
            for batch in batches:
                for _, x in centred(batch):
                    total += of(x)
            values = pa.ListArray.from_arrays(pa.array(np.arange(rows + 1) * columns, type=pa.int32()), pa.array(total.ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(rows), type=pa.int32()), values], ["i", "c"])

        parts = self.blocks.mapInArrow(run, "i int, c array<double>")
        out = np.zeros((rows, columns))
        for r in parts.groupBy("i").agg(F.array(*(F.sum(F.col("c")[j]) for j in range(columns))).alias("c")).collect():
            out[r.i] = r.c
        return out

    def reader(self) -> Callable[[pa.RecordBatch], Iterator[tuple[dict, np.ndarray]]]:
        dim, base, shift = self.dim, self.base, self.rest / self.n

        def centred(batch: pa.RecordBatch) -> Iterator[tuple[dict, np.ndarray]]:
            for row in batch.select(["ids", "wide", "body"]).to_pylist():
                row["x"] = np.frombuffer(row["body"], dtype=np.int64 if row["wide"] else np.int32).reshape(-1, dim).astype(np.int64) - base
                yield row, row["x"] - shift

        return centred


def pack(rows: DataFrame, ws: Workspace, *, id_col: str, vector_col: str, scale: float, offset: int) -> Packed | None:
    """The usable vectors as integers floor(scale * c) + offset; None if there are none."""
    ensure_importable(rows.sparkSession)
    chosen = rows.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    good = chosen.filter((F.size("v") > 0) & F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
    blocks = ws.write(good.mapInArrow(lean(lambda b: _pack(b, scale, offset)), PACKED), "blocks")
    dims = blocks.groupBy("dim").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("dim")).limit(1).collect()
    if not dims:
        return None
    dim, n = dims[0].dim, dims[0].n
    blocks = blocks.filter(F.col("dim") == dim)
    sums = {r.pos: r.s for r in blocks.select(F.posexplode("sums")).groupBy("pos").agg(F.sum("col").alias("s")).collect()}
    return Packed(blocks, dim, n, [sums[i] for i in range(dim)])


def _basis(z: np.ndarray, kept: np.ndarray, columns: int, rng: np.random.Generator) -> np.ndarray:
    """Orthonormal columns, orthogonal to those kept; directions that z doesn't have are drawn."""
    out = kept
    for source in (z, rng.standard_normal((len(kept), 2 * columns))):
        for c in (source / np.maximum(np.linalg.norm(source, axis=0), 1e-300)).T:
            if out.shape[1] == kept.shape[1] + columns:
                break
            for _ in range(3):
                c = c - out @ (out.T @ c)
            norm = np.linalg.norm(c)
            if norm > 1e-8:
                c = c / norm
                c = c - out @ (out.T @ c)
                out = np.column_stack([out, c / np.linalg.norm(c)])
    return np.linalg.qr(np.column_stack([kept, out[:, kept.shape[1] :]]))[0][:, kept.shape[1] :]


@dataclass
class Components:
    """Unit eigenvectors as columns, by falling eigenvalue; residuals: ‖Vu - eu‖ of each; trace of V; Spark passes made."""

    values: np.ndarray
    vectors: np.ndarray
    residuals: np.ndarray
    trace: float
    passes: int


def components(packed: Packed, k: int, columns: int = COLUMNS, kept_blocks: int = KEPT_BLOCKS, tolerance: float | None = None) -> Components:
    """The k leading eigenvectors of the covariance, each with a residual of at most tolerance times the largest eigenvalue.

    By default as near as the rounding of double sums allows. Fewer come back where the covariance has a lower rank.
    """
    d, n, rng = packed.dim, packed.n, np.random.default_rng(7)
    columns, k = min(max(columns, k), d), min(k, d)
    tolerance = tolerance or 32 * np.finfo(float).eps * d**0.5
    kept, products = np.zeros((d, 0)), np.zeros((d, 0))
    q, trace = _basis(np.zeros((d, 0)), kept, columns, rng), None
    for made in range(1, MOST_PASSES + 1):
        sums = packed.column_sums(lambda x, q=q: np.column_stack([x.T @ (x @ q), (x * x).sum(axis=0)]), d, q.shape[1] + 1) / n
        trace = float(sums[:, -1].sum())
        kept, products = np.column_stack([kept, q]), np.column_stack([products, sums[:, :-1]])
        projected = kept.T @ products
        values, turn = np.linalg.eigh((projected + projected.T) / 2)
        values, turn = values[::-1][:columns], turn[:, ::-1][:, :columns]
        ritz, images = kept @ turn, products @ turn
        off = images - ritz * values
        residuals = np.linalg.norm(off, axis=0)
        if kept.shape[1] == d or values[0] <= 0 or (residuals[:k] <= tolerance * values[0]).all():
            sound = values[:k] > 1e-12 * d * max(values[0], 0)
            ritz = ritz[:, :k][:, sound]
            ritz = ritz * np.sign(ritz[np.abs(ritz).argmax(axis=0), np.arange(ritz.shape[1])])
            return Components(values[:k][sound], ritz / np.linalg.norm(ritz, axis=0), residuals[:k][sound], trace, made)
        if kept.shape[1] + columns > max(kept_blocks, 2) * columns:
            kept, products = ritz, images
        q = _basis(off, kept, min(columns, d - kept.shape[1]), rng)
    raise RuntimeError(f"residuals {residuals[:k]} after {MOST_PASSES} passes: eigenvalue {k} is too near the next ones for {columns} columns")


def _exact(x: np.ndarray, n: int, rest: np.ndarray) -> pa.Array:
    """Sum over dimensions of (n * x - S)^2, in whole numbers; x is without S // n."""
    most = n * (int(np.abs(x).max(initial=0)) + 1)
    if most * most * x.shape[1] < 1 << 63:
        d = n * x - rest
        return pa.array((d * d).sum(axis=1))
    sums = [sum((n * a - b) ** 2 for a, b in zip(row, rest.tolist(), strict=True)) for row in x.tolist()]
    return pa.array([s if s < 1 << 63 else None for s in sums], type=pa.int64())


def whiten_vectors(rows: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 8, scale: float = 1024, offset: int = 100_000, columns: int = COLUMNS, kept_blocks: int = KEPT_BLOCKS) -> DataFrame:
    """One row for each usable vector and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    identity_error is measured on the whitened values themselves, by a pass of its own.
    """
    spark, ws = rows.sparkSession, Workspace(rows.sparkSession, "whitening")
    packed = pack(rows, ws, id_col=id_col, vector_col=vector_col, scale=scale, offset=offset)
    found = components(packed, k, columns, kept_blocks) if packed else None
    m = len(found.values) if found else 0
    if not m:
        return spark.createDataFrame([], f"{WHITENED}, explained double, identity_error double")
    turn = found.vectors / np.sqrt(found.values)
    moments = packed.column_sums(lambda x: np.vstack([(w := x @ turn).T @ w, w.sum(axis=0)]), m + 1, m) / packed.n
    error = float(np.abs(moments[:m] - np.outer(moments[m], moments[m]) - np.eye(m)).max())
    centred, n, rest = packed.reader(), packed.n, packed.rest

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, x in centred(batch):
                ids, deviation = pa.array(row["ids"], type=pa.int64()), _exact(row["x"], n, rest)
                w = x @ turn
                for j in range(m):
                    yield pa.RecordBatch.from_arrays([ids, pa.array(np.full(len(x), j + 1, dtype=np.int32)), pa.array(np.full(len(x), n)), deviation, pa.array(np.ascontiguousarray(w[:, j]))], ["vec_id", "component", "n", "deviation", "whitened"])

    explained = F.element_at(F.array(*(F.lit(float(v / found.trace)) for v in found.values)), F.col("component"))
    return packed.blocks.mapInArrow(lean(project), WHITENED).withColumns({"explained": explained, "identity_error": F.lit(error)})

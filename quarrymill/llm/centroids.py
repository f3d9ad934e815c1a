"""k-means over whole numbers, with adaptive distance bounds: most vectors are not compared with most centroids.

Each vector keeps its nearest centroids in order, an upper bound of its distance to the first, a lower bound for each of the
next ones, and one lower bound for all the rest. When centroids have moved, the bounds give way by as much. If the upper
bound, or else the distance itself, is below all lower ones, the vector stays where it is; else the distances of the next 1,
2, 3, ... are computed anew, as few as make sure that no other is nearer or as near; and if none does, all are. Bounds are rounded away from
what they bound, and only whole numbers are compared for what is returned, so results are exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrymill.llm.common import stored, used_up

CLUSTERS, ROUNDS, DIMS = 8, 10, 64
#: Components are floor(SCALE * x).
SCALE = 1024
#: Prefix of the ids whose hashes choose the first centroids.
SEED = 3
#: Lower bounds of single centroids that a vector keeps; for the rest it has one.
KEPT = 3
#: Vectors of a stored block.
BLOCK = 4096
#: Components are held within this, so that squared distances of 64 of them fit into 63 bits.
MOST = 1 << 27

_BLOCK = "ids binary, known binary, vectors binary, near binary, bounds binary, sums array<long>"


def _up(squared: np.ndarray) -> np.ndarray:
    return np.sqrt(squared.astype(np.float64)) * (1 + 1e-12) + 1e-9


def _down(squared: np.ndarray) -> np.ndarray:
    return np.sqrt(squared.astype(np.float64)) * (1 - 1e-12) - 1e-9


def squared(v: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of vectors (n, d) to centroids (k, d), or of each to its own (n, k, d)."""
    out = np.empty((len(v), c.shape[-2]), np.int64)
    for j in range(c.shape[-2]):
        apart = v - c[..., j, :]
        out[:, j] = np.einsum("nd,nd->n", apart, apart)
    return out


def _full(v: np.ndarray, c: np.ndarray, kept: int) -> tuple[np.ndarray, np.ndarray]:
    """near (n, kept + 1) and bounds (n, kept + 2) from all distances; of those alike the smaller number is nearer."""
    d = squared(v, c)
    order = np.argsort(d, axis=1, kind="stable")
    ordered = np.take_along_axis(d, order, 1)
    bounds = np.full((len(v), kept + 2), np.inf)
    bounds[:, 0] = _up(ordered[:, 0])
    have = min(kept + 1, c.shape[0] - 1)
    bounds[:, 1 : have + 1] = _down(ordered[:, 1 : have + 1])
    return order[:, : kept + 1], bounds


def assign(v: np.ndarray, c: np.ndarray, moved: np.ndarray, near: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """near and bounds after the centroids have moved by at most `moved`; and how many distances were computed for each
    vector. near: the first columns of an order of centroids; bounds: as in the module's text."""
    near, bounds, computed = near.copy(), bounds.copy(), np.zeros(len(v), np.int64)
    kept = near.shape[1] - 1
    bounds[:, 0] += moved[near[:, 0]]
    bounds[:, 1 : kept + 1] -= moved[near[:, 1:]]
    bounds[:, kept + 1 :] -= moved.max(initial=0)
    open_ = np.flatnonzero(~_less(bounds[:, 0], bounds[:, 1:].min(axis=1)))
    if not len(open_):
        return near, bounds, computed
    # the upper bound made exact is often enough
    d0 = squared(v[open_], c[near[open_, :1]])
    bounds[open_, 0] = _up(d0[:, 0])
    computed[open_] += 1
    # what is not among the first z + 1 is farther than all bounds from z + 1 on
    beyond = np.minimum.accumulate(bounds[open_, 1:][:, ::-1], axis=1)[:, ::-1]
    sure = _less(bounds[open_, :1], beyond)
    fits = np.where(sure.any(axis=1), sure.argmax(axis=1), kept + 1)
    for z in range(1, kept + 1):
        at = np.flatnonzero(fits == z)
        if len(at):
            rows = open_[at]
            own = near[rows, : z + 1]
            d = np.concatenate([d0[at], squared(v[rows], c[own[:, 1:]])], axis=1)
            # ties go to the smaller number
            order = np.lexsort((own, d), axis=1)
            near[rows, : z + 1] = np.take_along_axis(own, order, 1)
            d = np.take_along_axis(d, order, 1)
            bounds[rows, 0] = _up(d[:, 0])
            bounds[rows, 1 : z + 1] = _down(d[:, 1:])
            computed[rows] += z
    rest = open_[fits > kept]
    if len(rest):
        near[rest], bounds[rest] = _full(v[rest], c, kept)
        computed[rest] += len(c)
    return near, bounds, computed


def _less(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Surely less: sums of bounds may be off by their last digits."""
    return a * (1 + 1e-12) + 1e-9 < b


def prepared(rows: DataFrame, dims: int, scale: int, id_col: str, vec_col: str) -> DataFrame:
    """vec_id and v (array<int>) of the vectors that are kept."""
    v = F.col(vec_col)
    fine = (F.size(v) == dims) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform(v, lambda x: F.floor(F.least(F.greatest(x.cast("double") * scale, F.lit(-float(MOST))), F.lit(float(MOST)))).cast("int"))
    return rows.filter(F.coalesce(fine, F.lit(False))).select(F.col(id_col).cast("long").alias("vec_id"), whole.alias("v"))


def _blocks(dims: int):
    """Vectors in blocks of at most BLOCK, without an order of centroids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                held.append(batch.slice(at, BLOCK))
                n += held[-1].num_rows
                if n >= BLOCK:
                    yield block(held)
                    held, n = [], 0
        if n:
            yield block(held)

    def block(held: list) -> pa.RecordBatch:
        t = pa.Table.from_batches(held).combine_chunks()
        ids = t["vec_id"]
        known = np.asarray(ids.is_valid())
        v = np.concatenate([x.flatten().to_numpy() for x in t["v"].chunks]).astype(np.int32)
        return _row(ids.fill_null(0).to_numpy().tobytes(), known.tobytes(), v.tobytes(), b"", b"", [])

    return run


def _row(*values) -> pa.RecordBatch:
    kinds = [pa.binary()] * 5 + [pa.list_(pa.int64())]
    return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(values, kinds, strict=True)], ["ids", "known", "vectors", "near", "bounds", "sums"])


def _moved(block: dict, c: np.ndarray, moved: np.ndarray, kept: int) -> tuple:
    v = np.frombuffer(block["vectors"], np.int32).reshape(-1, c.shape[1]).astype(np.int64)
    if not block["near"]:
        near, bounds = _full(v, c, kept)
        return v, near, bounds, np.full(len(v), len(c))
    near = np.frombuffer(block["near"], np.int16).reshape(len(v), -1).astype(np.int64)
    return v, *assign(v, c, moved, near, np.frombuffer(block["bounds"], np.float64).reshape(len(v), -1))


def _round(c: np.ndarray, moved: np.ndarray, kept: int):
    """A block with its vectors' new bounds and, for each centroid, the sum and number of its vectors; last, how many
    distances were computed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in batch.to_pylist():
                v, near, bounds, computed = _moved(block, c, moved, kept)
                sums = np.zeros((len(c), c.shape[1] + 1), np.int64)
                np.add.at(sums, near[:, 0], np.concatenate([v, np.ones((len(v), 1), np.int64)], axis=1))
                yield _row(block["ids"], block["known"], block["vectors"], near.astype(np.int16).tobytes(), bounds.tobytes(), [*sums.ravel().tolist(), int(computed.sum())])

    return run


def _last(c: np.ndarray, moved: np.ndarray, kept: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in batch.to_pylist():
                v, near, _, _ = _moved(block, c, moved, kept)
                apart = squared(v, c[near[:, :1]])[:, 0]
                ids = pa.array(np.frombuffer(block["ids"], np.int64), mask=~np.frombuffer(block["known"], np.bool_))
                yield pa.RecordBatch.from_arrays([ids, pa.array(near[:, 0].astype(np.int32)), pa.array(apart)], ["vec_id", "cluster", "distance"])

    return run


def first_centroids(vectors: DataFrame, clusters: int, seed: int) -> np.ndarray:
    """The vectors with the least hashes of their ids; of one id, the least vector. A null id hashes as an empty one."""
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    found = vectors.withColumn("mark", mark).orderBy("mark", "v").select("v").limit(clusters).collect()
    return np.array([r.v for r in found], np.int64)


def cluster(
    rows: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE, seed: int = SEED, kept: int = KEPT, id_col: str = "vec_id", vec_col: str = "embedding", told: list | None = None
) -> DataFrame:
    """One row for each kept vector: vec_id, cluster, distance (squared), cluster_inertia, inertia, centroid_sha256.

    Kept are vectors of `dims` components, none null or not finite; components become floor(scale * x), within 2^27.
    Centroids start as the vectors with the least hashes of their ids; with fewer vectors there are fewer centroids. A
    vector belongs to the nearest centroid, of those alike to the one with the smaller number; a centroid without vectors
    stays. Rows without an id, repeated rows and equal vectors are all kept. An empty table gives an empty result. Other
    columns are not looked at. told, if given, gets the number of distances computed in each round but the last.
    """
    vectors = stored(prepared(rows, dims, scale, id_col, vec_col), "vectors")
    c = first_centroids(vectors, clusters, seed)
    result = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if not len(c):
        return rows.sparkSession.createDataFrame([], result)
    kept, k = min(kept, len(c) - 1), len(c)
    state = stored(vectors.mapInArrow(_blocks(dims), _BLOCK), "blocks")
    moved = np.zeros(k)
    for _ in range(rounds):
        after = stored(state.mapInArrow(_round(c, moved, kept), _BLOCK), "blocks")
        used_up(state)
        state = after
        # as many sums as centroids have components, whatever the number of vectors
        total = state.select(F.posexplode("sums").alias("at", "x")).groupBy("at").agg(F.sum("x").alias("x")).collect()
        sums = dict((r.at, r.x) for r in total)
        table = np.array([[sums[j * (dims + 1) + i] for i in range(dims + 1)] for j in range(k)], np.int64)
        new = np.array([[int(x) // int(row[-1]) for x in row[:-1]] if row[-1] else c[j] for j, row in enumerate(table)], np.int64)
        moved, c = _up(((new - c) ** 2).sum(axis=1)), new
        moved[(table[:, -1] == 0)] = 0
        if told is not None:
            told.append(sums[k * (dims + 1)])
    out = stored(state.mapInArrow(_last(c, moved, kept), "vec_id long, cluster int, distance long"), "clusters")
    own = {r["cluster"]: int(r["x"]) for r in out.groupBy("cluster").agg(F.sum("distance").alias("x")).collect()}
    marks = [hashlib.sha256(",".join(map(str, row)).encode()).hexdigest() for row in c.tolist()]
    pick = lambda values, kind: F.get(F.array(*[F.lit(x).cast(kind) for x in values]), F.col("cluster"))
    return out.select(
        "vec_id", "cluster", "distance", pick([own.get(j, 0) for j in range(k)], "long").alias("cluster_inertia"), F.lit(sum(own.values())).cast("long").alias("inertia"), pick(marks, "string").alias("centroid_sha256")
    )

"""Centroid clustering with exact results from float32 products (operator 13).

Vectors are rows of integers. In each round a batch's products with the centroids are one float32 matrix product, and
``s(c) = |c|^2 - 2 x.c`` orders the centroids of a vector by distance. Each s(c) is known within

    2 g |x| |c| + u (|c|^2 + 2 |x| |c|) * 8,    g = k v / (1 - k v), k = 66, v = 2^-24, u = 2^-53

g is the bound of any order of summing 64 float32 products of factors that are rounded to float32 themselves, the rest
that of the sums in float64. Where one centroid's interval lies below all others it is the nearest. Vectors of which
intervals overlap are computed again for those centroids in 64-bit integers, and the smallest number of the least distance
is taken. So every assignment is that of exact arithmetic, whatever the order of sums.

Means are exact too: tasks sum integers, the sums of a cluster are added as decimals, and floors are of integers. Per round
the driver holds one row of sums for each centroid. Vectors are written once, as 32-bit integers, and read in each round where they
lie: nothing is shuffled but the sums.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textcore as tc
from .common import WRITTEN, columns, forget, stored, table

DIM, CLUSTERS, ROUNDS, SCALE = 64, 8, 10, 1024
#: Components of this size or more leave no room for squared distances in 64 bits; such vectors are not kept.
LIMIT = 1 << 27
_V, _U = 2.0**-24, 2.0**-53
_G = (DIM + 2) * _V / (1 - (DIM + 2) * _V)


def _whole(batches):
    """Rows with exactly DIM finite components, as floor(SCALE * x) in 32-bit integers."""
    for b in batches:
        vectors = b.column(1)
        if pa.types.is_null(vectors.type) or not len(vectors):
            continue
        size = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False)
        fit = b.filter(pa.array(size == DIM))
        if not fit.num_rows:
            continue
        flat = fit.column(1).flatten()
        gaps = np.asarray(flat.is_null()).reshape(-1, DIM).any(1)
        x = np.floor(pc.fill_null(flat, 0).to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, DIM) * SCALE)
        with np.errstate(invalid="ignore"):
            keep = np.isfinite(x).all(1) & (np.abs(x) < LIMIT).all(1) & ~gaps
        x = np.ascontiguousarray(x[keep].astype(np.int32))
        yield pa.RecordBatch.from_arrays([fit.column(0).filter(pa.array(keep)), _binary(x)], ["vec_id", "v"])


def _binary(x: np.ndarray) -> pa.Array:
    width = x.shape[1] * 4
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), len(x), [None, pa.py_buffer(x)]).cast(pa.binary())


def _vectors(column) -> np.ndarray:
    return tc.text_buffers(column)[0].view(np.int32).reshape(-1, DIM)


def exact(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of pairs of rows, in 64-bit integers."""
    d = x.astype(np.int64) - c
    return np.einsum("ij,ij->i", d, d)


def nearest(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, int]:
    """For each row of ``x`` the number of the nearest row of ``c`` (ties: the smallest), and how many had to be computed
    exactly."""
    cc = np.einsum("ij,ij->i", c, c).astype(np.float64)
    size_c = np.sqrt(cc)
    dot = x.astype(np.float32) @ c.T.astype(np.float32)
    size_x = np.linalg.norm(x.astype(np.float64), axis=1)
    cross = size_x[:, None] * size_c
    s = cc - 2 * dot.astype(np.float64)
    # the norms are rounded themselves: one part in 2^40 more covers them
    e = (2 * _G * cross + 8 * _U * (cc + 2 * cross)) * (1 + 2.0**-40)
    best = (s + e).min(1, keepdims=True)
    open_ = s - e <= best
    out = np.argmax(open_, 1)
    again = np.flatnonzero(open_.sum(1) > 1)
    if len(again):
        row, number = np.nonzero(open_[again])
        d = np.full((len(again), len(c)), np.iinfo(np.int64).max)
        d[row, number] = exact(x[again[row]], c[number])
        out[again] = d.argmin(1)
    return out, len(again)


def _sums(c: np.ndarray):
    def run(batches):
        n, total = np.zeros(len(c), np.int64), np.zeros((len(c), DIM), np.int64)
        for b in batches:
            x = _vectors(b.column(0))
            at, _ = nearest(x, c)
            n += np.bincount(at, minlength=len(c))
            for k in np.unique(at):
                total[k] += x[at == k].sum(0, dtype=np.int64)
        k = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(k.astype(np.int32)), pa.array(n[k]), pa.array(total[k].tolist(), pa.list_(pa.int64()))], ["cluster", "n", "s"])

    return run


def _assigned(c: np.ndarray):
    def run(batches):
        for b in batches:
            x = _vectors(b.column(1))
            at, _ = nearest(x, c)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(at.astype(np.int32)), pa.array(exact(x, c[at]))], ["vec_id", "cluster", "distance"])

    return run


def kept(vectors: DataFrame) -> DataFrame:
    """(vec_id, v): the usable rows of ``vectors`` (vec_id, embedding), components as packed 32-bit integers."""
    return columns(vectors, vec_id="long", embedding="array<float>").mapInArrow(_whole, "vec_id long, v binary")


def first_centroids(rows: DataFrame, k: int = CLUSTERS) -> np.ndarray:
    """The vectors of the k smallest hashes of their ids; equal ids by components, ids of null last."""
    order = F.sha2(F.concat(F.lit("3:"), F.col("vec_id").cast("string")), 256)
    found = rows.select(order.alias("h"), "v").orderBy(F.col("h").asc_nulls_last(), "v").limit(k).collect()
    return np.array([np.frombuffer(r.v, np.int32) for r in found], np.int64).reshape(-1, DIM)


def moved(rows: DataFrame, c: np.ndarray) -> np.ndarray:
    """The centroids after one round: floors of the exact means; empty clusters stay."""
    parts = rows.select("v").mapInArrow(_sums(c), "cluster int, n long, s array<long>")
    total = parts.groupBy("cluster").agg(F.sum("n").alias("n"), *(F.sum(F.col("s")[j].cast("decimal(38,0)")).alias(f"s{j}") for j in range(DIM))).collect()
    out = c.copy()
    for r in total:  # one row a cluster
        out[r.cluster] = [int(r[f"s{j}"]) // r.n for j in range(DIM)]
    return out


def cluster(vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance) of each usable row of ``vectors`` (vec_id, embedding), and the final centroids.

    Rows with another number of components than 64, with a null or non-finite one, or one of 131,072 or more in size (whose
    squares do not fit), are left out; a null embedding is. A null vec_id is an id, after all others; rows that repeat an
    id, or a whole row, count each. With fewer usable rows than ``k`` each is a centroid; ties go to the smaller number;
    extra columns are ignored; an empty table gives no rows.
    """
    rows = stored(kept(vectors), "vectors")
    path = WRITTEN[-1]
    c = first_centroids(rows, k)
    if not len(c):
        return rows.selectExpr("vec_id", "0 as cluster", "0L as distance"), c
    for _ in range(rounds):
        c = moved(rows, c)
    out = stored(rows.mapInArrow(_assigned(c), "vec_id long, cluster int, distance long"), "assigned")
    forget(rows.sparkSession, [path])
    return out, c


def summary(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``assigned`` with cluster_inertia, inertia and centroid_sha256; sums beyond 64 bits are null."""
    sums = {r.cluster: int(r.s) for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}  # one row a cluster
    fits = lambda n: n if n < 1 << 63 else None
    of = [(k, fits(sums.get(k, 0)), hashlib.sha256(",".join(map(str, map(int, c))).encode()).hexdigest()) for k, c in enumerate(centroids)]
    at = lambda i, kind: F.coalesce(*(F.when(F.col("cluster") == o[0], F.lit(o[i])) for o in of), F.lit(None)).cast(kind) if of else F.lit(None).cast(kind)
    return assigned.select("vec_id", "cluster", "distance", at(1, "long").alias("cluster_inertia"), F.lit(fits(sum(sums.values()))).cast("long").alias("inertia"), at(2, "string").alias("centroid_sha256"))


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary(*cluster(table(spark, sf_dir, "embeddings")))


def _oracle(k: int = CLUSTERS, rounds: int = ROUNDS) -> str:
    """The rounds one after another, in integers."""
    distance = "list_sum(list_transform(generate_series(1, 64), lambda j: (v[j] - c[j]) * (v[j] - c[j])))"
    floor = "((s - ((s % n) + n) % n) // n)::bigint"
    near = lambda i: f"select r, any_value(vec_id) as vec_id, any_value(v) as v, arg_min(k, d * {k} + k) as k, min(d) as d from (select r, vec_id, v, k, {distance} as d from kept, c{i}) group by r"
    out = [
        "with whole as (select vec_id, list_transform(embedding, lambda x: floor(x::double * 1024)) as f from embeddings where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = 64)",
        "kept as materialized (select row_number() over () as r, vec_id, list_transform(f, lambda x: x::bigint) as v from whole where len(list_filter(f, lambda x: abs(x) < 134217728)) = 64)",
        f"c0 as materialized (select row_number() over (order by h, v) - 1 as k, v as c from (select sha256('3:' || vec_id) as h, v from kept order by h, v limit {k}))",
    ]
    for i in range(rounds):
        out.append(f"a{i} as materialized ({near(i)})")
        out.append(f"m{i} as (select k, list({floor} order by j) as c from (select k, j, sum(x)::hugeint as s, count(*) as n from (select k, unnest(v) as x, generate_subscripts(v, 1) as j from a{i}) group by k, j) group by k)")
        out.append(f"c{i + 1} as materialized (select k, coalesce(m.c, o.c) as c from c{i} o left join m{i} m using (k))")
    out.append(f"z as materialized ({near(rounds)})")
    return ",\n".join(out) + f"\nselect vec_id, k::int as cluster, d::bigint as distance, sum(d) over (partition by k)::bigint as cluster_inertia, sum(d) over ()::bigint as inertia, sha256(array_to_string(c, ',')) as centroid_sha256 from z join c{rounds} using (k)"


ORACLE = _oracle()

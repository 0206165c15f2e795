"""Centroid clustering on distinct vectors.

Vectors are quantised to whole numbers, and equal ones become one with a multiplicity. Distinct vectors are packed into
blocks in a written table; a round of Lloyd's algorithm reads the blocks, and each task gives back one sum a centroid and
component. Sums are weighted by multiplicity and whole, so centroids don't depend on how rows are cut. At the end the
assignment of each distinct vector is joined back to all rows that have it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.workspace import deleted, small_batches, written

#: Distinct vectors of a block.
BLOCK = 4096
#: Components below this: distances and products of 64 such components are exact in doubles and longs. Larger ones are
#: counted in Python's whole numbers.
SMALL = 1 << 21
MOST = 2**63 - 1


def quantised(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component x, as longs; beyond long they stop at its ends."""
    return F.transform(vector.cast("array<double>"), lambda x: F.floor(x * scale).cast("long"))


def usable(vector: Column, dim: int) -> Column:
    """Exactly dim components, none of them null or non-finite."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return vector.isNotNull() & (F.size(vector) == dim) & ~F.exists(vector, bad)


def nearest(m: np.ndarray, centroids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of the nearest centroid of each row (of longs); ties go to the smaller number.

    Distances are exact; beyond long they are given as its end.
    """
    c = np.array(centroids, object)
    if m.shape[1] <= 64 and int(np.abs(c).max(initial=0)) < SMALL and (not m.size or -SMALL < int(m.min()) and int(m.max()) < SMALL):
        c = c.astype(np.float64)
        x = m.astype(np.float64)
        d = ((x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1)).astype(np.int64)
        best = d.argmin(1)
        return best, d[np.arange(len(d)), best]
    found = [min((sum((a - b) ** 2 for a, b in zip(v, w, strict=True)), k) for k, w in enumerate(centroids)) for v in m.tolist()]
    return np.array([k for _, k in found], np.int64), np.array([min(d, MOST) for d, _ in found], np.int64)


def _packed(distinct: DataFrame, dim: int) -> DataFrame:
    """Blocks of up to BLOCK distinct vectors of a task: vectors, multiplicities m (both as bytes of longs)."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), BLOCK):
                some = batch.iloc[at : at + BLOCK]
                yield pd.DataFrame([(np.stack(some["v"].to_list()).astype(np.int64).tobytes(), some["m"].to_numpy(np.int64).tobytes())], columns=["v", "m"])

    return distinct.select("v", "m").mapInPandas(pack, "v binary, m binary")


def _sums(blocks: DataFrame, centroids: list[list[int]]) -> dict[int, tuple[list[int], int]]:
    """By centroid, the weighted sums of its vectors' components and their count; a task gives a row a centroid and component."""
    dim = len(centroids[0])

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums, counts = [[0] * dim for _ in centroids], [0] * len(centroids)
        for batch in batches:
            for v, m in zip(batch["v"], batch["m"], strict=True):
                x, w = np.frombuffer(v, np.int64).reshape(-1, dim), np.frombuffer(m, np.int64)
                best, _ = nearest(x, centroids)
                safe = float(np.abs(x.astype(np.float64)).max(initial=0)) * float(w.sum()) < 2**62
                for k in np.unique(best).tolist():
                    here = best == k
                    mine = (x[here] * w[here][:, None]).sum(0).tolist() if safe else (x[here].astype(object) * w[here][:, None].astype(object)).sum(0).tolist()
                    sums[k] = [a + b for a, b in zip(sums[k], mine, strict=True)]
                    counts[k] += int(w[here].sum())
        rows = [(k, i, str(s)) for k, own in enumerate(sums) if counts[k] for i, s in enumerate([*own, counts[k]])]
        yield pd.DataFrame(rows, columns=["cluster", "i", "s"])

    got = blocks.mapInPandas(add, "cluster int, i int, s string").groupBy("cluster", "i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    found: dict[int, dict[int, int]] = {}
    for r in got.collect():  # a row a centroid and component, whatever the input
        found.setdefault(r["cluster"], {})[r["i"]] = int(r["s"])
    return {k: ([own[i] for i in range(dim)], own[dim]) for k, own in found.items()}


def _assigned(distinct: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """h, v, m, cluster, distance of every distinct vector."""

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                best, distance = nearest(np.stack(batch["v"].to_list()).astype(np.int64), centroids)
                yield batch.assign(cluster=best, distance=distance)

    return distinct.select("h", "v", "m").mapInPandas(assign, "h long, v array<long>, m long, cluster int, distance long")


def digest(centroid: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()


def clusters(
    vectors: DataFrame, k: int = 8, rounds: int = 10, dim: int = 64, scale: int = 1024, seed: int = 3, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 for every vector that takes part.

    Vectors with other than dim components, or with null or non-finite ones, take no part. The first centroids are the k
    vectors of smallest sha256 of '<seed>:<vec_id>' (a null id is the text 'null'; rows of one id follow each other by vector); with fewer vectors there are fewer.
    Repeated ids and rows all count and are all returned. An empty table gives an empty result. Distances are exact up to
    long's end, where they stop, as inertias do. Components beyond long stop at its ends. Other columns are ignored.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("x")).where(usable(F.col("x"), dim))
    rows = rows.select("vec_id", quantised(F.col("x"), scale).alias("v")).withColumn("h", F.xxhash64("v"))
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("null"))), 256)
    first = rows.select(order.alias("o"), "v").orderBy("o", "v").limit(k).collect()
    schema = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if not first:
        return spark.createDataFrame([], schema)
    centroids = [list(r["v"]) for r in first]
    distinct = written(rows.groupBy("h", "v").agg(F.count(F.lit(1)).alias("m")), "vector-distinct")
    blocks = written(_packed(distinct, dim), "vector-blocks")
    for _ in range(rounds):
        before, sums = centroids, _sums(blocks, centroids)
        centroids = [[s // sums[c][1] for s in sums[c][0]] if c in sums else old for c, old in enumerate(centroids)]
        if centroids == before:
            break
    deleted(blocks)
    assigned = written(_assigned(distinct, centroids), "vector-assigned")
    deleted(distinct)
    weight = (F.col("m").cast("decimal(38,0)") * F.col("distance")).cast("decimal(38,0)")
    of_cluster = {r["cluster"]: int(r["s"]) for r in assigned.groupBy("cluster").agg(F.sum(weight).alias("s")).collect()}
    total = min(sum(of_cluster.values()), MOST)
    known = [(c, min(s, MOST), total, digest(centroids[c])) for c, s in sorted(of_cluster.items())]
    facts = spark.createDataFrame(known, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    out = rows.join(assigned.select("h", "v", "cluster", "distance"), ["h", "v"])
    return out.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")  # k rows

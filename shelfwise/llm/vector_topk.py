"""Exact top-k by integer inner product with block-at-a-time pruning.

Vectors are put in an order that brings like ones together and cut into document-range blocks. A block has the largest and
smallest value of each component and a forward index (the vectors themselves). The sum of a query's best products with
those bounds every score in the block. A query takes the blocks in order of their bounds and scores them until the next
bound is below its k-th score so far. Groups of blocks are dealt over slots, a task each, and stay there while all batches
of queries pass, twice: a first round over each query's best block of each slot sets that score, the second searches.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfwise.llm.workspace import small_batches, written

#: Vectors of a block, blocks of a group, queries of a batch.
BLOCK, GROUP, BATCH = 128, 64, 512
#: Slots for each core, as long as there are groups for them, and bytes of vectors in a slot: with more, there are more slots.
SLOTS, SLOT_BYTES = 2, 64 << 20
#: Finds that a search holds until it cuts them to the k best of each query.
POOL = 1 << 20
#: Sums of products below this are exact in doubles; larger ones are added as Python integers.
EXACT = 2.0**53
MOST = 2**63 - 1


def valid(vector: Column) -> Column:
    """Neither null nor empty, nor holding null or non-finite components."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return vector.isNotNull() & (F.size(vector) > 0) & ~F.exists(vector, bad)


def _order(vector: Column) -> Column:
    """The largest components' places: vectors alike in them come together."""
    ranked = F.array_sort(F.transform(vector, lambda x, i: F.struct((-F.abs(x)).alias("a"), i.alias("i"), (x > 0).alias("s"))))
    return F.transform(F.slice(ranked, 1, 3), lambda x: x["i"] * 2 + x["s"].cast("int"))


def _packed(m: np.ndarray) -> bytes:
    """Whole numbers in doubles as bytes, in 16 bits each where they fit."""
    small = not m.size or float(np.abs(m).max()) < 1 << 15
    return (b"h" if small else b"d") + m.astype(np.int16 if small else np.float64).tobytes()


def _stored(data: bytes, dim: int) -> np.ndarray:
    return np.frombuffer(data, np.int16 if data[:1] == b"h" else np.float64, offset=1).reshape(-1, dim)


def _unpacked(data: bytes, dim: int) -> np.ndarray:
    return _stored(data, dim).astype(np.float64)


def scores(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Inner products of the rows of q and v (whole numbers in doubles) as longs; beyond long they stop at its ends."""
    if not len(q) or not len(v):
        return np.empty((len(q), len(v)), np.int64)
    if float(np.abs(q).max()) * float(np.abs(v).max()) * q.shape[1] < EXACT:
        return (q @ v.T).astype(np.int64)
    whole = [[sum(int(a) * int(b) for a, b in zip(x, y, strict=True)) for y in v.tolist()] for x in q.tolist()]
    return np.array([[min(max(s, -MOST), MOST) for s in row] for row in whole], np.int64)


def bounds(q: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Upper bounds of the scores of queries (rows) in blocks (columns), with room for rounding."""
    got = np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T
    return got + 1 + np.abs(got) * 1e-9


class Blocks(NamedTuple):
    """Blocks of vectors: ids and components of all, the bounds of each block, and where blocks begin (and the last ends)."""

    vec: np.ndarray
    data: np.ndarray
    low: np.ndarray
    high: np.ndarray
    cuts: np.ndarray

    def scored(self, block: int, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of a block, and their scores with queries."""
        here = slice(self.cuts[block], self.cuts[block + 1])
        return self.vec[here], scores(q, self.data[here].astype(np.float64))


def _runs(x: np.ndarray) -> Iterator[tuple[int, int]]:
    """Where runs of equal values start and end."""
    cuts = np.flatnonzero(np.diff(x, prepend=x[:1] - 1, append=x[-1:] + 1)).tolist()
    return zip(cuts, cuts[1:])


def _best(found: list[tuple[np.ndarray, np.ndarray, np.ndarray]], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of queries, ids and scores the k best of each query, in order; ties go to the smaller id."""
    who, name, score = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((name, -score, who))
    who, name, score = who[order], name[order], score[order]
    best = np.arange(len(who)) - np.searchsorted(who, who) < k
    return who[best], name[best], score[best]


def search(ids: np.ndarray, q: np.ndarray, least: np.ndarray, blocks: Blocks, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """The k best vectors of each query, of those that reach least, as numbers of queries, ids and scores; and how many
    blocks were scored, added up over the queries.

    Each query takes the blocks in the order of its own bounds and stops at the first that is below its k-th score. Turns
    are taken in lots (the first, one more, two, four and so on): within a lot the queries that come to the same block
    are scored together, and after it the k-th scores are set anew.
    """
    bound, least, last, scored = bounds(q, blocks.low, blocks.high), least.copy(), np.full(len(ids), MOST), 0
    order = np.argsort(-bound, axis=1, kind="stable")
    bound = np.take_along_axis(bound, order, 1)
    kept = (np.empty(0, np.int64),) * 3

    def cut(more: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        who, name, score = _best(more, k)
        n = np.bincount(who, minlength=len(ids))
        full = n == k
        end = np.cumsum(n)[full] - 1
        least[full], last[full] = score[end], name[end]
        return who, name, score

    at, lot = 0, 1
    while at < bound.shape[1]:
        need, turn = np.nonzero(bound[:, at : at + lot] >= least[:, None])
        if not len(need):
            break
        which = order[need, at + turn]
        by = np.argsort(which, kind="stable")
        need, which, scored = need[by], which[by], scored + len(need)
        more, size = [kept], 0
        for low, high in _runs(which):
            own = need[low:high]
            vec, got = blocks.scored(which[low], q[own])
            row, at_vec = np.nonzero(got >= least[own][:, None])
            who, name, score = own[row], vec[at_vec], got[row, at_vec]
            good = (name != ids[who]) & ((score > least[who]) | (name <= last[who]))
            more.append((who[good], name[good], score[good]))
            size += len(more[-1][0])
            if size > POOL:
                more, size = [cut(more)], 0
        kept = cut(more)
        at += lot
        lot = at
    return *kept, scored


def search_group(
    ids: np.ndarray, q: np.ndarray, least: np.ndarray, vec: np.ndarray, data: np.ndarray, low: np.ndarray, high: np.ndarray, k: int
) -> tuple[list[tuple[np.ndarray, np.ndarray]], int]:
    """search() in blocks of BLOCK vectors each, with the ids and scores of each query by themselves."""
    cuts = np.append(np.arange(0, len(vec), BLOCK), len(vec))
    who, name, score, scored = search(ids, q, least, Blocks(vec, data, low, high, cuts), k)
    ends = np.searchsorted(who, np.arange(len(ids) + 1)).tolist()
    return [(name[a:b], score[a:b]) for a, b in zip(ends, ends[1:])], scored


def first_scores(ids: np.ndarray, q: np.ndarray, blocks: Blocks, k: int) -> np.ndarray:
    """The k-th best score of each query in its best block, or -MOST: no k-th score among all is lower."""
    best, least = bounds(q, blocks.low, blocks.high).argmax(1), np.full(len(ids), -MOST)
    for block in np.unique(best).tolist():
        need = np.flatnonzero(best == block)
        vec, got = blocks.scored(block, q[need])
        if len(vec) >= k:
            least[need] = np.partition(np.where(vec != ids[need][:, None], got, -MOST), -k, axis=1)[:, -k]
    return least


def _groups(rows: DataFrame) -> DataFrame:
    """part, no, dim, ids, data, low, high, sizes: groups of blocks of the vectors in their order, the no-th of a task."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, no = TaskContext.get().partitionId(), 0
        ids: list[int] = []
        held: list[np.ndarray] = []

        def group() -> pd.DataFrame:
            nonlocal no
            m = np.array(held)
            cuts = range(0, len(m), BLOCK)
            low, high = (np.array([f(m[c : c + BLOCK], axis=0) for c in cuts]) for f in (np.min, np.max))
            sizes = np.array([len(m[c : c + BLOCK]) for c in cuts], np.int64)
            row = (part, no, m.shape[1], np.array(ids, np.int64).tobytes(), _packed(m), _packed(low), _packed(high), sizes.tobytes())
            no += 1
            ids.clear()
            held.clear()
            return pd.DataFrame([row], columns=["part", "no", "dim", "ids", "data", "low", "high", "sizes"])

        for batch in batches:
            for i, v in zip(batch["vec_id"], batch["v"], strict=True):
                if held and (len(v) != len(held[0]) or len(held) == BLOCK * GROUP):
                    yield group()
                ids.append(i)
                held.append(np.asarray(v, np.float64))
        if held:
            yield group()

    return rows.mapInPandas(pack, "part int, no int, dim int, ids binary, data binary, low binary, high binary, sizes binary")


def _batches(rows: DataFrame) -> DataFrame:
    """b, dim, q_ids, q: batches of queries of one dimension."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, no = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            for dim, own in batch.groupby(batch["v"].map(len)):
                for at in range(0, len(own), BATCH):
                    some = own.iloc[at : at + BATCH]
                    m = np.array([np.asarray(v, np.float64) for v in some["v"]])
                    yield pd.DataFrame([(part + no, dim, some["vec_id"].to_numpy(np.int64).tobytes(), _packed(m))], columns=["b", "dim", "q_ids", "q"])
                    no += 1

    return rows.mapInPandas(pack, "b long, dim int, q_ids binary, q binary")


def _dealt(groups: DataFrame) -> tuple[DataFrame, int]:
    """groups with the slot of each, and the number of slots."""
    n, size, row = groups.agg(F.count(F.lit(1)), F.sum(F.octet_length("data")), F.max("no")).first()
    slots = max(1, min(n, SLOTS * groups.sparkSession.sparkContext.defaultParallelism), -(-(size or 0) // SLOT_BYTES))
    return groups.withColumn("slot", F.pmod(F.col("part").cast("long") * ((row or 0) + 1) + F.col("no"), F.lit(slots)).cast("int")), slots


def _passing(groups: DataFrame, slots: int, batches: DataFrame) -> DataFrame:
    """The rows of each slot in a task: its groups, then all batches.

    No join does this: the planner takes batches for as small as they were before they went to all slots, and would send
    them all through the driver.
    """
    everywhere = batches.withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1))))
    every = groups.drop("part", "no").withColumn("b", F.lit(-1).cast("long")).unionByName(everywhere, allowMissingColumns=True)
    return every.repartitionById(slots, "slot").sortWithinPartitions("slot", "b")


def _met(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[NamedTuple, Blocks]]:
    """Each batch of queries that passes, and the blocks of its dimension in its slot, if there are any."""
    slot, held, known = None, {}, {}
    for batch in batches:
        for r in batch.itertuples():
            if r.slot != slot:
                slot, held, known = r.slot, defaultdict(list), {}
            if r.b < 0:
                sizes = np.frombuffer(r.sizes, np.int64)
                held[r.dim].append((np.frombuffer(r.ids, np.int64), _stored(r.data, r.dim), _unpacked(r.low, r.dim), _unpacked(r.high, r.dim), sizes))
                continue
            if r.dim in held:
                vec, data, low, high, sizes = (np.concatenate(x) for x in zip(*held.pop(r.dim), strict=True))
                known[r.dim] = Blocks(vec, data, low, high, np.append(0, np.cumsum(sizes)))
            if r.dim in known:
                yield r, known[r.dim]


def _candidates(vectors: DataFrame, queries: Column, k: int) -> DataFrame:
    """query_id, vec_id, score among which is the top k of every query."""
    keys = ["dim", "o", "vec_id"]
    ordered = vectors.withColumns({"o": _order(F.col("v")), "dim": F.size("v")}).repartitionByRange(*keys).sortWithinPartitions(*keys)
    groups, slots = _dealt(written(_groups(ordered.select("vec_id", "v")), "vector-groups"))
    asked = vectors.where(queries).groupBy("vec_id", F.size("v")).agg(F.min("v").alias("v"))
    asked = written(_batches(asked.select("vec_id", "v")), "vector-queries")

    def first(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for r, blocks in _met(batches):
            ids = np.frombuffer(r.q_ids, np.int64)
            yield pd.DataFrame({"b": r.b, "pos": np.arange(len(ids)), "least": first_scores(ids, _unpacked(r.q, r.dim), blocks, k)})

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for r, blocks in _met(batches):
            ids = np.frombuffer(r.q_ids, np.int64)
            who, name, score, _ = search(ids, _unpacked(r.q, r.dim), np.asarray(r.least, np.int64), blocks, k)
            yield pd.DataFrame({"query_id": ids[who], "vec_id": name, "score": score})

    known = _passing(groups, slots, asked).mapInPandas(first, "b long, pos int, least long").groupBy("b", "pos").agg(F.max("least").alias("least"))
    known = known.groupBy("b").agg(F.array_sort(F.collect_list(F.struct("pos", "least"))).alias("x")).select("b", F.col("x.least").alias("least"))
    asked = written(asked.join(known.hint("merge"), "b"), "vector-asked")
    return _passing(groups, slots, asked).mapInPandas(find, "query_id long, vec_id long, score long")


def top_k(vectors: DataFrame, queries: Column, k: int = 20, scale: int = 64, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k other vectors of highest inner product of each vector that `queries` picks.

    A component x counts as floor(scale * x), x as double; scores are whole numbers. Ties go to the smaller id. Vectors that
    are null, empty or hold null or non-finite components, and null ids, take no part; vectors meet those of their own
    dimension only. A query with fewer than k others gets them all. Rows with a query's own id are never its results; an id
    on several rows is one query (its least vector) but as many candidates. Scores beyond a long stop at its ends. An empty
    table gives an empty result. Other columns are ignored.
    """
    small_batches(vectors.sparkSession)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    rows = rows.where(F.col("vec_id").isNotNull() & valid(F.col("v")))
    rows = rows.withColumn("v", F.transform("v", lambda x: F.floor(x * scale).cast("double")))
    out = _candidates(written(rows, "vectors"), queries, k)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return out.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

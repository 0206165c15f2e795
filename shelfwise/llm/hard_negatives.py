"""Hard negatives by dual-tree search.

Vectors are put in order of label and likeness and cut into groups; a group is a balanced tree of boxes over its vectors,
with its labels' range in each node, and its anchors are a batch with a tree of their own. Two boxes bound the inner
products between their vectors from both sides. Bounds of roots say which batches go to which group; a group then stays in
its task while its batches pass, and a search goes down both trees at once: a pair of nodes whose interval misses what all
anchors of the one still look for is dropped whole. Leaf pairs that are left are scored exactly, best bounds first.

Two searches are made: an anchor's best rows of its own label, with the k-th best of its own group as a first bound; then
for each of these positives the best rows of other labels in the interval of scores that the positive sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfwise.llm.vector_topk import MOST, _order, _packed, _unpacked, scores, valid
from shelfwise.llm.workspace import deleted, small_batches, written

#: Vectors of a group, and bytes of them as doubles; vectors of a leaf; leaves that are scored at once; boxes of a row.
GROUP, GROUP_BYTES, LEAF, TURN, BOXES = 4096, 16 << 20, 32, 8, 256
NONE = -MOST - 1


def tree_order(m: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """An order in which each run of LEAF rows, each pair of runs, and so on, is a node: labels part first, then the widest component."""
    order, todo = np.arange(len(m)), [(0, len(m))]
    while todo:
        low, high = todo.pop()
        if high - low <= LEAF:
            continue
        half = LEAF
        while 2 * half < high - low:
            half *= 2
        own = order[low:high]
        by = labels[own]
        if by.min() == by.max():
            x = m[own]
            by = x[:, (x.max(0) - x.min(0)).argmax()]
        order[low:high] = own[np.argsort(by, kind="stable")]
        todo += [(low, low + half), (low + half, high)]
    return order


class Tree(NamedTuple):
    """Levels of nodes, leaves first: smallest and largest components and labels of each node."""

    low: list[np.ndarray]
    high: list[np.ndarray]
    l0: list[np.ndarray]
    l1: list[np.ndarray]


def _up(x: np.ndarray, f: np.ufunc) -> list[np.ndarray]:
    """Leaves' values from rows' values, then those of each pair of nodes, up to the root."""
    levels = [f.reduceat(x, np.arange(0, len(x), LEAF))]
    while len(levels[-1]) > 1:
        levels.append(f.reduceat(levels[-1], np.arange(0, len(levels[-1]), 2)))
    return levels


def tree(m: np.ndarray, labels: np.ndarray) -> Tree:
    return Tree(_up(m, np.minimum), _up(m, np.maximum), _up(labels, np.minimum), _up(labels, np.maximum))


def interval(al: np.ndarray, ah: np.ndarray, bl: np.ndarray, bh: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the inner products between vectors of two boxes (rows of each side), with room for rounding."""
    x, y, z, w = al * bl, al * bh, ah * bl, ah * bh
    least = np.minimum(np.minimum(x, y), np.minimum(z, w)).sum(-1)
    most = np.maximum(np.maximum(x, y), np.maximum(z, w)).sum(-1)
    return least - 1 - np.abs(least) * 1e-9, most + 1 + np.abs(most) * 1e-9


def fitting(same: bool, a0: np.ndarray, a1: np.ndarray, b0: np.ndarray, b1: np.ndarray) -> np.ndarray:
    """Whether labels from a0 to a1 and from b0 to b1 can be the same (or else, can differ)."""
    return (a0 <= b1) & (b0 <= a1) if same else ~((a0 == a1) & (b0 == b1) & (a0 == b0))


class Rows(NamedTuple):
    """Vectors with what is known of them, in the order of their tree."""

    ids: np.ndarray
    labels: np.ndarray
    places: np.ndarray
    data: np.ndarray

    @classmethod
    def of(cls, r, dim: int) -> Rows:
        return cls(*(np.frombuffer(x, np.int64) for x in (r.ids, r.labels, r.places)), _unpacked(r.data, dim))


def open_ends(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Scores from low to high as doubles, with room for rounding; what stops at long's ends has no end."""
    x, y = low.astype(np.float64), high.astype(np.float64)
    x, y = x - np.abs(x) * 1e-9, y + np.abs(y) * 1e-9
    return np.where(low <= -MOST, -np.inf, x), np.where(high >= MOST, np.inf, y)


class Wishes(NamedTuple):
    """For each wish, the anchor's place in its batch, and the scores from low to high that it looks for."""

    pos: np.ndarray
    low: np.ndarray
    high: np.ndarray


def leaf_pairs(a: Tree, c: Tree, least: np.ndarray, most: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of leaves (of a, of c) that may hold what the anchors look for, and their upper bounds.

    least, most: by anchor, the ends of all that it looks for. Both trees are gone down together, level by level.
    """
    least, most, part = _up(least, np.minimum), _up(most, np.maximum), max(1, (1 << 18) // c.low[0].shape[1])
    la, lc = len(a.low) - 1, len(c.low) - 1
    i, j, bound = np.zeros(1, np.int64), np.zeros(1, np.int64), np.full(1, np.inf)
    first = True
    while first or la or lc:
        if not first:
            if la and la >= lc:
                la -= 1
                i, j = np.concatenate((2 * i, 2 * i + 1)), np.concatenate((j, j))
            else:
                lc -= 1
                i, j = np.concatenate((i, i)), np.concatenate((2 * j, 2 * j + 1))
            real = (i < len(a.low[la])) & (j < len(c.low[lc]))
            i, j = i[real], j[real]
        first = False
        good, bound = np.zeros(len(i), bool), np.empty(len(i))
        for at in range(0, len(i), part):
            s = slice(at, at + part)
            low, bound[s] = interval(a.low[la][i[s]], a.high[la][i[s]], c.low[lc][j[s]], c.high[lc][j[s]])
            good[s] = (bound[s] >= least[la][i[s]]) & (low <= most[la][i[s]])
        good &= fitting(same, a.l0[la][i], a.l1[la][i], c.l0[lc][j], c.l1[lc][j])
        i, j, bound = i[good], j[good], bound[good]
    return i, j, bound


def search(a: Rows, a_tree: Tree, c: Rows, c_tree: Tree, wishes: Wishes, k: int, same: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Numbers of wishes, rows of c and scores: among them the k best that each wish finds in c (ties: smaller ids), and how
    many pairs of leaves were scored."""
    n = len(a.ids)
    least, most = np.full(n, float("inf")), np.full(n, float("-inf"))
    low, high = open_ends(wishes.low, wishes.high)
    np.minimum.at(least, wishes.pos, low)
    np.maximum.at(most, wishes.pos, high)
    i, j, bound = leaf_pairs(a_tree, c_tree, least, most, same)
    order = np.lexsort((-bound, i))
    i, j, bound = i[order], j[order], bound[order]
    found, scored = [], 0
    wish_order = np.argsort(wishes.pos, kind="stable")
    for low, high in _runs(i):
        start = int(i[low]) * LEAF
        here = wish_order[slice(*np.searchsorted(wishes.pos[wish_order], (start, start + LEAF)))]
        if not len(here):
            continue
        pos, limit, top = wishes.pos[here], wishes.low[here].copy(), wishes.high[here]
        kept = np.full((len(here), k), NONE)
        mine = []
        for at in range(low, high, TURN):
            turn = slice(at, min(at + TURN, high))
            if bound[at] < limit.min():
                break
            leaves = j[turn][bound[turn] >= limit.min()]
            scored += len(leaves)
            rows = (leaves[:, None] * LEAF + np.arange(LEAF)).ravel()
            rows = rows[rows < len(c.ids)]
            got = scores(a.data[start : start + LEAF], c.data[rows])[pos - start]
            good = (got >= limit[:, None]) & (got <= top[:, None]) & ((c.labels[rows] == a.labels[pos][:, None]) == same)
            good &= c.places[rows] != a.places[pos][:, None]
            if not good.any():
                continue
            kept = np.sort(np.concatenate((kept, np.where(good, got, NONE)), 1), 1)[:, -k:]
            limit = np.maximum(limit, kept[:, 0])
            w, x = np.nonzero(good & (got >= limit[:, None]))
            mine.append((w, rows[x], got[w, x]))
        if mine:
            w, row, score = (np.concatenate(x) for x in zip(*mine, strict=True))
            good = score >= limit[w]
            w, row, score = w[good], row[good], score[good]
            best = np.lexsort((c.places[row], c.ids[row], -score, w))
            w, row, score = w[best], row[best], score[best]
            rank = np.arange(len(w)) - np.searchsorted(w, w)
            found.append((here[w[rank < k]], row[rank < k], score[rank < k]))
    if not found:
        none = np.empty(0, np.int64)
        return none, none, none, scored
    return *(np.concatenate(x) for x in zip(*found, strict=True)), scored


def _runs(x: np.ndarray) -> Iterator[tuple[int, int]]:
    """Where runs of equal values start and end."""
    cuts = [0, *(np.flatnonzero(x[1:] != x[:-1]) + 1).tolist(), len(x)]
    return ((low, high) for low, high in zip(cuts, cuts[1:]) if low < high)


def _own_bounds(a: Rows, c: Rows, k: int) -> np.ndarray:
    """The k-th best score of each anchor among the rows of its label in its own group, or NONE."""
    out = np.full(len(a.ids), NONE)
    for low in range(0, len(a.ids), 256):
        part = slice(low, low + 256)
        good = (c.labels == a.labels[part][:, None]) & (c.places != a.places[part][:, None])
        got = np.where(good, scores(a.data[part], c.data), NONE)
        if got.shape[1] >= k:
            out[part] = np.partition(got, -k, axis=1)[:, -k]
    return out


_GROUP = "g long, dim int, ids binary, labels binary, places binary, data binary, low binary, high binary, l0 long, l1 long"


def _groups(rows: DataFrame, k: int) -> DataFrame:
    """Groups of rows that come in order, and (a_...) the batch of each group's anchors with first bounds `least`."""

    def described(rows: Rows) -> tuple:
        m = rows.data
        return (
            *(x.astype(np.int64).tobytes() for x in rows[:3]), _packed(m), m.min(0).tobytes(), m.max(0).tobytes(), int(rows.labels.min()), int(rows.labels.max())
        )

    def group(number: int, held: list[tuple]) -> tuple:
        places, ids, labels, anchor, v = zip(*held, strict=True)
        m = np.array([np.asarray(x, np.float64) for x in v])
        all_rows = Rows(np.array(ids, np.int64), np.array(labels, np.int64), np.array(places, np.int64), m)
        order = tree_order(m, all_rows.labels)
        all_rows = Rows(*(x[order] for x in all_rows))
        chosen = np.flatnonzero(np.array(anchor, bool)[order])
        out = (number, m.shape[1], *described(all_rows))
        if not len(chosen):
            return (*out, *[None] * 10)
        a = Rows(*(x[chosen] for x in all_rows))
        order = tree_order(a.data, a.labels)
        a = Rows(*(x[order] for x in a))
        return (*out, *described(a), a.ids.tolist(), _own_bounds(a, all_rows, k).tolist())

    columns = [c.split()[0] for c in _GROUP.split(", ")]
    columns += [f"a_{c}" for c in columns[2:]] + ["anchor_id", "least"]

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number, held = TaskContext.get().partitionId() << 32, []
        for batch in batches:
            for row in zip(batch["place"], batch["vec_id"], batch["label"], batch["anchor"], batch["v"], strict=True):
                if held and (len(row[4]) != len(held[0][4]) or len(held) >= max(LEAF, min(GROUP, GROUP_BYTES // (8 * len(row[4]))))):
                    yield pd.DataFrame([group(number, held)], columns=columns)
                    number, held = number + 1, []
                held.append(row)
        if held:
            yield pd.DataFrame([group(number, held)], columns=columns)

    schema = f"{_GROUP}, {', '.join(f'a_{c}' for c in _GROUP.split(', ')[2:])}, anchor_id array<long>, least array<long>"
    return rows.select("place", "vec_id", "label", "anchor", "v").mapInPandas(pack, schema)


def _boxes(rows: DataFrame, numbers: list[str]) -> DataFrame:
    """Boxes (dim, low, high and numbers) of a dimension, up to BOXES to a row."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, own in batch.groupby("dim"):
                for at in range(0, len(own), BOXES):
                    some = own.iloc[at : at + BOXES]
                    row = (dim, b"".join(some["low"]), b"".join(some["high"]), *(some[c].to_numpy(np.int64).tobytes() for c in numbers))
                    yield pd.DataFrame([row], columns=["dim", "low", "high", *numbers])

    return rows.select("dim", "low", "high", *numbers).mapInPandas(pack, f"dim int, low binary, high binary, {', '.join(f'{c} binary' for c in numbers)}")


def _needed(groups: DataFrame, asked: DataFrame, same: bool) -> DataFrame:
    """b, g: which groups may hold what a batch (b, dim, its box, labels from l0 to l1, scores from least to most) looks for.

    Groups' boxes are dealt over slots, batches' boxes go to all; no vector moves for this.
    """
    slots = int(groups.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    of_groups = _boxes(groups, ["g", "l0", "l1"]).withColumn("slot", F.pmod(F.xxhash64("g"), F.lit(slots)).cast("int"))
    of_batches = _boxes(asked, ["b", "l0", "l1", "least", "most"]).select("dim", *[F.col(c).alias(f"a_{c}") for c in ("low", "high", "b", "l0", "l1", "least", "most")])
    of_batches = of_batches.withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1))))

    def meet(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples():
                boxes = lambda x: np.frombuffer(x, np.float64).reshape(-1, r.dim)  # noqa: B023, E731
                low, high, a_low, a_high = boxes(r.low), boxes(r.high), boxes(r.a_low), boxes(r.a_high)
                g, l0, l1, b, a0, a1, least, most = (np.frombuffer(x, np.int64) for x in (r.g, r.l0, r.l1, r.a_b, r.a_l0, r.a_l1, r.a_least, r.a_most))
                least, most = open_ends(least, most)
                for i in range(len(b)):
                    under, over = interval(a_low[i], a_high[i], low, high)
                    good = (over >= least[i]) & (under <= most[i])
                    yield pd.DataFrame({"b": b[i], "g": g[good & fitting(same, a0[i], a1[i], l0, l1)]})

    return of_batches.join(of_groups, ["slot", "dim"]).mapInPandas(meet, "b long, g long")


def _searched(groups: DataFrame, asked: DataFrame, k: int, same: bool) -> tuple[DataFrame, DataFrame]:
    """b, pos, wish, vec_id, place, score: what the wishes of asked (b, rows of the batch, pos, low_score, high_score) find;
    and the written table of what meets.

    All that goes to a group comes after it, in its task.
    """
    boxes = asked.select("b", "dim", "low", "high", "l0", "l1", F.array_min("low_score").alias("least"), F.array_max("high_score").alias("most"))
    needed = written(_needed(groups, boxes, same), "negative-needed")
    rows = ["dim", "ids", "labels", "places", "data"]
    none = lambda t: F.lit(None).cast(t)
    own = groups.join(needed.select("g").distinct(), "g", "left_semi").select(
        "g", F.lit(-1).cast("long").alias("b"), F.lit(0).alias("kind"), *rows, none("array<int>").alias("pos"), none("array<long>").alias("low_score"), none("array<long>").alias("high_score")
    )
    passing = needed.join(asked, "b").select("g", "b", F.lit(1).alias("kind"), *rows, "pos", "low_score", "high_score")

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = c_tree = None
        held, size = [], 0
        for batch in batches:
            for r in batch.itertuples():
                x = Rows.of(r, r.dim)
                if r.kind == 0:
                    c, c_tree = x, tree(x.data, x.labels)
                    continue
                wishes = Wishes(np.asarray(r.pos, np.int64), np.asarray(r.low_score, np.int64), np.asarray(r.high_score, np.int64))
                wish, row, score, _ = search(x, tree(x.data, x.labels), c, c_tree, wishes, k, same)
                held.append((np.full(len(wish), r.b), wishes.pos[wish], wish, c.ids[row], c.places[row], score))
                size += len(wish)
                if size > 50_000:
                    yield _frame(held)
                    held, size = [], 0
        if held:
            yield _frame(held)

    every = own.unionByName(passing).repartition("g").sortWithinPartitions("g", "kind", "b")
    return every.mapInPandas(look, "b long, pos int, wish int, vec_id long, place long, score long"), needed


def _frame(held: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(dict(zip(["b", "pos", "wish", "vec_id", "place", "score"], (np.concatenate(x) for x in zip(*held, strict=True)), strict=True)))


def _first(found: DataFrame, k: int) -> DataFrame:
    """The k best of each wish, with rank. Spark cuts each task's share before the shuffle."""
    rank = F.row_number().over(Window.partitionBy("b", "pos", "wish").orderBy(F.desc("score"), "vec_id", "place"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame, anchors: Column, label: Column | str = "label", positives: int = 5, negatives: int = 3, least: int = 50, most: int = 95,
    scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for the rows that `anchors` picks.

    A component x counts as floor(scale * x), x as double; a score is the whole inner product with the anchor. Higher scores
    come first, ties by smaller id. Positives are an anchor's first other rows of its label (all, if fewer), negatives of a
    positive its first rows of other labels with least * positive <= 100 * negative <= most * positive (all, if fewer), so a
    positive of a negative score has none. Rows with a null id, label or vector, an empty vector, or null or non-finite
    components take no part; vectors meet those of their own dimension only. Every row is an anchor or candidate of its own:
    rows that repeat an id are other rows. Scores beyond a long stop at its ends. An empty table gives an empty result.
    Other columns are ignored.
    """
    small_batches(vectors.sparkSession)
    label = F.col(label) if isinstance(label, str) else label
    rows = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"), label.cast("long").alias("label"), F.coalesce(anchors, F.lit(False)).alias("anchor"),
        F.col(vector_col).cast("array<double>").alias("v"),
    )
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & valid(F.col("v")))
    rows = rows.withColumns({"v": F.transform("v", lambda x: F.floor(x * scale).cast("double")), "place": F.monotonically_increasing_id()})
    rows = written(rows, "negative-rows")
    keys = ["dim", "label", "o", "vec_id", "place"]
    ordered = rows.withColumns({"o": _order(F.col("v")), "dim": F.size("v")}).repartitionByRange(*keys).sortWithinPartitions(*keys)
    groups = written(_groups(ordered, positives), "negative-groups")
    deleted(rows)
    parts = ["ids", "labels", "places", "data", "low", "high", "l0", "l1"]
    batches = groups.where("a_ids is not null").select(F.col("g").alias("b"), "dim", *[F.col(f"a_{c}").alias(c) for c in parts], "anchor_id", "least")
    # an anchor's first bound is reached by rows of its own group; NONE leaves all open
    asked = batches.withColumns({
        "pos": F.sequence(F.lit(0), F.size("least") - 1), "low_score": F.col("least"), "high_score": F.transform("least", lambda x: F.lit(MOST)),
    })
    found, met = _searched(groups, asked, positives, True)
    found = _first(found, positives).select("b", "pos", "rank", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    found = written(found, "negative-positives")
    score = F.col("positive_score").cast("decimal(38,0)")
    low, high = F.ceil(score * least / 100).cast("long"), F.floor(score * most / 100).cast("long")
    wishes = found.withColumns({"low_score": low, "high_score": high}).where("low_score <= high_score")
    wishes = wishes.groupBy("b").agg(F.array_sort(F.collect_list(F.struct("pos", "rank", "low_score", "high_score", "positive_id", "positive_score"))).alias("w"))
    wishes = written(wishes, "negative-wishes")  # a row a group, with at most `positives` for each of its anchors
    deleted(met, found)
    asked = batches.join(wishes, "b").withColumns({c: F.col(f"w.{c}") for c in ("pos", "low_score", "high_score")})
    names = batches.select("b", F.posexplode("anchor_id").alias("pos", "anchor_id"))
    names = wishes.select("b", F.posexplode("w").alias("wish", "x")).select("b", "wish", "x.pos", "x.positive_id", "x.positive_score").join(names, ["b", "pos"])
    best, met = _searched(groups, asked, negatives, False)
    best = _first(best, negatives).select("b", "wish", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    out = best.join(names, ["b", "wish"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    out = written(out, "negatives")
    deleted(met, wishes, groups)
    return out

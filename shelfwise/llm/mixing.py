"""Mixing sources to target weights by fitting budgets exactly.

The documents of a source are counted by exact size. A source's budget is met by whole passes over it, then by a
proportional share of each size, and what remains by a bounded knapsack over the sizes that are left. The counts that this
gives for each size are then filled with documents in the order of a seeded hash.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfwise.llm.workspace import numbered, written

WHITE = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    """Number of runs of what is neither a space nor one of the five ASCII controls from tab to carriage return; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WHITE)), F.lit(0)).cast("long")


#: Sums that the knapsack's table holds at least: in a first attempt, and where that doesn't meet the budget.
REACHES = 1 << 16, 1 << 22


def fit_budget(sizes: np.ndarray, counts: np.ndarray, budget: int, seed: int, reaches: tuple[int, ...] = REACHES) -> np.ndarray:
    """How many documents of each size to take so that their sizes add up to budget, or to less.

    The first attempt that meets the budget counts, else the one that comes nearest. No choice comes nearer from below
    where the budget is at most the last reach (or twice the largest size); beyond, what is missing is less than the
    smallest size of which a document is left. Work and memory are bounded by the number of distinct sizes and the reach,
    not by the number of documents.
    """
    budget, best = min(int(budget), int((sizes * counts).sum())), np.zeros(len(sizes), np.int64)
    for reach in reaches:
        took = _attempt(sizes, counts, budget, seed, reach) if budget > 0 else best
        if (sizes * took).sum() >= (sizes * best).sum():
            best = took
        if (sizes * best).sum() == budget:
            break
    return best


def _attempt(sizes: np.ndarray, counts: np.ndarray, rest: int, seed: int, reach: int) -> np.ndarray:
    """A choice whose sizes add up to rest or less.

    Of more than reach (or twice the largest size) every size first gives its proportional share and single documents in
    seeded order, until no more than that is left. The bounded knapsack fits what is left as well as the remaining
    documents can: a subset-sum on a bit set, in which doubling parts stand for multiplicities.
    """
    took, total = np.zeros(len(sizes), np.int64), int((sizes * counts).sum())
    reach = max(reach, 2 * int(sizes.max()))
    order = np.random.default_rng(seed).permutation(len(sizes))
    order = order[sizes[order] > 0]
    if rest > reach:
        took = np.minimum((counts * ((rest - reach) / total)).astype(np.int64), counts)
        rest -= int((sizes * took).sum())
        while rest > reach:  # a document's size is at most half of reach, so one always fits
            for i in order[took[order] < counts[order]]:
                if rest <= reach:
                    break
                took[i] += 1
                rest -= int(sizes[i])
    reached, mask = 1, (1 << (rest + 1)) - 1
    by = np.full(rest + 1, -1, np.int32)
    parts: list[tuple[int, int]] = []
    for i in order:
        size, left, part = int(sizes[i]), int(min(counts[i] - took[i], rest // max(int(sizes[i]), 1))), 1
        while left > 0 and not reached >> rest & 1:
            part = min(part, left)
            fresh = (reached << (size * part)) & mask & ~reached
            if fresh:
                bits = np.unpackbits(np.frombuffer(fresh.to_bytes(rest // 8 + 1, "little"), np.uint8), bitorder="little")
                by[np.flatnonzero(bits)] = len(parts)
                reached |= fresh
            parts.append((int(i), part))
            left, part = left - part, part * 2
        if reached >> rest & 1:
            break
    at = reached.bit_length() - 1
    while at > 0:
        i, part = parts[by[at]]
        took[i] += part
        at -= int(sizes[i]) * part
    return took


def source_targets(sizes: DataFrame, weights: tuple[int, ...], cap: int) -> DataFrame:
    """source, source_size and target from source and source_size (one row a source).

    Sources in code point order, null last, get the weights in turn and share the sum of all sizes by them; a target stops
    at cap times its source's size and the excess is shared again by weight. In ascending order of cap * size / weight the
    sources that stop come first, so the share of the first that doesn't is everybody else's.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    sizes = sizes.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), ((rank - 1) % len(weights) + 1).cast("int")).cast("double"))
    sizes = sizes.withColumn("most", (F.lit(cap) * F.col("source_size")).cast("double"))
    whole = Window.partitionBy()
    order = Window.orderBy(F.col("most") / F.col("w"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (F.sum("source_size").over(whole) - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("w").over(onward)
    sizes = sizes.withColumn("level", level)
    level = F.min(F.when(F.col("level") * F.col("w") <= F.col("most"), F.struct(F.col("most") / F.col("w"), F.col("level").alias("v")))).over(whole)
    target = F.least("most", F.coalesce(level["v"] * F.col("w"), F.col("most")))
    return sizes.select("source", "source_size", target.alias("target"))


def _mixed(
    rows: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: int = 3, seed: int = 29, cell_rows: int = 200_000
) -> DataFrame:
    """place, doc_id, source, size, source_size, target, repeats and taken (size * repeats) of every row.

    rows has place, doc_id, text, source; place tells rows apart.

    Each source's taken words miss its target by what fit_budget() leaves, rounding apart; repeats are 0 to cap. Null texts
    and texts without words have size 0, take part in passes but add nothing. Null sources are one source. Null ids are
    ordinary; rows that are alike are chosen one by one. An empty table gives an empty result. The same rows give the same
    choice, however they are partitioned.

    Documents of one source and size may be a large part of all rows: they are numbered within cells of a seeded hash, so
    no task gets the group; 64 cells, and more beyond 64 * cell_rows rows. Counts by source, size and cell go to one task
    only by source, with a row for each distinct size.
    """
    rows = rows.select("place", "doc_id", F.col("source").cast("string").alias("source"), n_words(F.col("text")).alias("size"), F.xxhash64(F.lit(seed), "doc_id", "text").alias("h"))
    rows = written(rows, "mix-rows")
    cells = max(64, min(1 << 16, rows.count() // cell_rows))
    rows = rows.withColumn("cell", F.pmod("h", F.lit(cells)))
    counts = written(rows.groupBy("source", "size", "cell").agg(F.count(F.lit(1)).alias("n")), "mix-counts")
    by_size = counts.groupBy("source", "size").agg(F.sum("n").alias("n"))
    targets = written(source_targets(by_size.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), weights, cap), "mix-targets")

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        size, target = int(group["source_size"].iloc[0]), float(group["target"].iloc[0])
        passes = min(cap, int((target + 1e-6) // size)) if size else 0
        budget = round(target - passes * size) if passes < cap else 0
        group = group.sort_values("size")
        extra = fit_budget(group["size"].to_numpy(np.int64), group["n"].to_numpy(np.int64), budget, seed)
        return pd.DataFrame({
            "source": group["source"], "size": group["size"], "source_size": size, "target": target, "passes": passes, "extra": extra,
        })

    same = lambda a, b, *more: [a["source"].eqNullSafe(b["source"]), *(a[c] == b[c] for c in more)]
    plan = by_size.join(targets, same(by_size, targets)).select(by_size["source"], "size", "n", "source_size", "target")
    plan = plan.groupBy("source").applyInPandas(fit, "source string, size long, source_size long, target double, passes int, extra long")
    before = F.sum("n").over(Window.partitionBy("source", "size").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1))
    quota = counts.withColumn("before", F.coalesce(before, F.lit(0)))
    plan = plan.select(F.col("source").alias("s"), F.col("size").alias("z"), "source_size", "target", "passes", "extra")
    quota = quota.join(plan, F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z")))
    quota = quota.select(
        F.col("source").alias("s"), F.col("size").alias("z"), F.col("cell").alias("c"), "source_size", "target", "passes",
        (F.col("extra") - F.col("before")).alias("quota"),
    )
    number = F.row_number().over(Window.partitionBy("source", "size", "cell").orderBy("h", "doc_id", "place"))
    chosen = rows.withColumn("i", number).join(
        quota, F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z")) & (F.col("cell") == F.col("c"))
    )
    chosen = chosen.withColumn("repeats", F.col("passes") + (F.col("i") <= F.col("quota")).cast("int"))
    return chosen.select("place", "doc_id", "source", "size", "source_size", "target", "repeats", (F.col("size") * F.col("repeats")).alias("taken"))


def mix_sources(docs: DataFrame, **options: object) -> DataFrame:
    """doc_id, source, size, source_size, target, repeats, taken of every row of docs (doc_id, text, source). See _mixed()."""
    return _mixed(docs.select(F.monotonically_increasing_id().alias("place"), "doc_id", "text", "source"), **options).drop("place")


def mixed_documents(docs: DataFrame, **options: object) -> DataFrame:
    """The rows of docs as often as the mix takes them, with the columns of docs. options: those of _mixed()."""
    placed = numbered(docs, "mix-docs")
    chosen = _mixed(placed.select("place", "row.doc_id", "row.text", "row.source"), **options)
    chosen = placed.join(chosen.where("repeats > 0").select("place", "repeats"), "place")
    return chosen.select("row", F.explode(F.sequence(F.lit(1), F.col("repeats"))).alias("i")).select("row.*")

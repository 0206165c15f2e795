"""Near-duplicate documents by HyperMinHash.

A document is its set of distinct 5-word shingles. Documents with equal sets are one class. A class has BUCKETS * ROUNDS
registers: in each round the shingles fall into buckets by a hash, and a register keeps the leading zeros and the next ten
bits of its bucket's least hash. A bucket without a shingle takes the register of another one, found along a fixed random
order of buckets, so that registers of small sets agree as often as those of large ones. A band is the registers of one bucket
number over all rounds; classes that share a band meet. Jaccard estimates from all registers, corrected for registers that
agree by chance, pick what is compared first: a spanning forest of the most similar in each block of a group. Where one of
its edges fails, and between blocks, all that may still link parts is compared, each pair in the first band that it shares. Links are confirmed on the full sets of
the texts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.components import connected_components
from shelfwise.llm.words import Words, kept, pieces
from shelfwise.llm.workspace import deleted, numbered, small_batches, written

WORDS = 5
ROUNDS, BUCKETS, MANTISSA = 4, 40, 10
REGISTERS = ROUNDS * BUCKETS
#: Pairs estimated below this are not compared: 5.8 standard deviations of the estimate under 0.75.
ESTIMATE = 0.55
#: Classes that meet are compared within and between blocks of so many, and of about so many shingles.
BLOCK, BLOCK_SHINGLES = 2048, 1 << 20
#: A text that is compared with many others goes out once for so many of them.
SPOKES = 256
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_SEEDS = np.array([(0xD1B54A32D192ED03 * (i + 1)) & (2**64 - 1) for i in range(2 * ROUNDS + 4)], np.uint64)
#: For each register of a round the order in which its buckets are tried, itself first.
_order = np.random.default_rng(5)
PROBES = np.array([[[b, *_order.permutation([x for x in range(BUCKETS) if x != b])] for b in range(BUCKETS)] for _ in range(ROUNDS)])


def mix(x: np.ndarray, seed: int | slice) -> np.ndarray:
    """Hashes of x under a seed, or a row of hashes for each of several."""
    x = (x ^ (_SEEDS[seed][:, None] if isinstance(seed, slice) else _SEEDS[seed])) * _A
    x ^= x >> np.uint64(32)
    x *= _B
    return x ^ (x >> np.uint64(29))


def shingles(texts: list[str | None]) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text; words are remembered from one task of a Python worker to the next.

    A-Z are lower-cased, the six white ASCII characters part words, and fewer than WORDS words are one shingle.
    """
    words = kept("shingles", lambda: Words(xxhash.xxh64_intdigest, ascii_only=True))
    for piece in pieces(texts):
        numbers, starts = words.numbers([texts[i] for i in piece])
        for low, high in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
            if low == high:
                yield np.empty(0, np.uint64)
                continue
            h, width = numbers[low:high], min(WORDS, high - low)
            n = high - low - width + 1
            out = np.full(n, width, np.uint64)
            for k in range(width):
                out = (out ^ h[k : k + n]) * _A
                out ^= out >> np.uint64(31)
            yield np.unique(out)


def registers(shingles: np.ndarray, part: int = 1 << 16) -> np.ndarray:
    """BUCKETS rows of ROUNDS registers: leading zeros and MANTISSA bits of the least hash of a bucket. Not for empty sets."""
    least, used = np.full(REGISTERS, 2**64 - 1, np.uint64), np.zeros(REGISTERS, bool)
    for low in range(0, len(shingles), part):
        x = mix(shingles[low : low + part], np.s_[:ROUNDS])
        at = (((x >> np.uint64(32)) * np.uint64(BUCKETS)) >> np.uint64(32)).view(np.int64)
        at += np.arange(ROUNDS)[:, None] * BUCKETS
        x = (x ^ _SEEDS[ROUNDS]) * _B
        x ^= x >> np.uint64(31)
        x *= _A
        np.minimum.at(least, at.ravel(), x.ravel())
        used[at.ravel()] = True
    mantissa, power = np.frexp(least.astype(np.float64))
    zeros = np.clip(64 - power, 0, 62).astype(np.uint16)
    out = ((zeros << MANTISSA) | ((2 * mantissa - 1) * (1 << MANTISSA)).astype(np.uint16)).reshape(ROUNDS, BUCKETS)
    if used.all():
        return np.ascontiguousarray(out.T)
    used = used.reshape(ROUNDS, BUCKETS)
    round_ = np.arange(ROUNDS)[:, None]
    first = used[round_[:, :, None], PROBES].argmax(2)
    source = np.take_along_axis(PROBES, first[:, :, None], 2)[:, :, 0]
    return np.ascontiguousarray(out[round_, source].T)


@lru_cache
def _chance(power: int) -> float:
    m, k = max(2.0**power / BUCKETS, 1.0), np.arange(63)
    p = (1 - 2.0 ** -(k + 1)) ** m - (1 - 2.0**-k) ** m
    return float((p * p).sum()) / (1 << MANTISSA)


def chance(n: float) -> float:
    """How often registers of two different hashes agree, for sets of about n shingles: equal zeros and equal mantissa."""
    return _chance(int(np.log2(max(n, 1))))


def estimates(one: np.ndarray, regs: np.ndarray, lost: np.ndarray) -> np.ndarray:
    """Jaccard estimates of one against the rows of regs, corrected for agreement by chance."""
    return ((regs == one).mean(1) - lost) / (1 - lost)


def chances(n: np.ndarray) -> np.ndarray:
    """chance() of each size; a pair's is that of its smaller set, so an estimate doesn't depend on what else is in a group."""
    return np.array([chance(x) for x in n.tolist()])


def forest(regs: np.ndarray, n: np.ndarray, percent: int, least: float = ESTIMATE) -> list[tuple[int, int]]:
    """Edges of a spanning forest of most similar pairs (Prim's algorithm) whose size allows a link. n ascends."""
    lost, edges = chances(n), []
    best, by, left = np.full(len(n), -1.0), np.zeros(len(n), np.int64), np.ones(len(n), bool)
    for _ in range(len(n)):
        i = int(np.where(left, best, -2).argmax())
        if best[i] > -1:
            edges.append((int(by[i]), i))
        left[i] = False
        low, high = int(np.searchsorted(n, -(-percent * n[i] // 100))), int(np.searchsorted(n, 100 * n[i] // percent, "right"))
        got = estimates(regs[i], regs[low:high], lost[np.minimum(np.arange(low, high), i)])
        better = low + np.flatnonzero(left[low:high] & (got >= least) & (got > best[low:high]))
        best[better], by[better] = got[better - low], i
    return edges


def apart(group: Group, percent: int, least: float = ESTIMATE) -> Iterator[tuple[int, np.ndarray]]:
    """Each member of a group with the later ones of other parts that it may link with and meets in no band before the group's.

    Members come in order of n; between two blocks only members of different ones are paired.
    """
    (_, i, j), (_, part, n, block, band), regs, _ = group
    lost, bands = chances(n), regs.reshape(len(n), BUCKETS, ROUNDS)
    for a in range(len(n) - 1):
        b = np.arange(a + 1, int(np.searchsorted(n, 100 * n[a] // percent, "right")))
        b = b[(part[b] != part[a]) & ((i == j) | (block[b] != block[a]))]
        b = b[estimates(regs[a], regs[b], lost[a]) >= least]
        b = b[(bands[b] == bands[a]).all(2).argmax(1) == band[a]]
        if len(b):
            yield a, b


def linked(one: np.ndarray, other: np.ndarray, percent: int) -> bool:
    """Whether two sets that aren't empty link, by their full sets."""
    few, many = sorted((one, other), key=len)
    common = int((many[np.minimum(np.searchsorted(many, few), len(many) - 1)] == few).sum())
    return 100 * common >= percent * (len(one) + len(other) - common)


class Common:
    """Sizes of intersections among the sets of a group, one set with many at a time. No set is empty."""

    def __init__(self, sets: list[np.ndarray]) -> None:
        self.sizes = np.array([len(x) for x in sets])
        self._starts = np.cumsum(self.sizes) - self.sizes
        self._ids = np.unique(np.concatenate(sets), return_inverse=True)[1].astype(np.int32)
        self._mark = np.zeros(int(self._ids.max()) + 1, np.int8)

    def counts(self, one: int, others: np.ndarray) -> np.ndarray:
        """How many elements set `one` has in common with each of the others."""
        own = self._ids[self._starts[one] : self._starts[one] + self.sizes[one]]
        self._mark[own] = 1
        sizes = self.sizes[others]
        if 4 * int(sizes.sum()) > len(self._ids):
            found = np.add.reduceat(self._mark[self._ids], self._starts, dtype=np.int64)[others]
        else:
            starts = np.cumsum(sizes) - sizes
            at = np.arange(int(sizes.sum())) + np.repeat(self._starts[others] - starts, sizes)
            found = np.add.reduceat(self._mark[self._ids[at]], starts, dtype=np.int64)
        self._mark[own] = 0
        return found

    def linked(self, one: int, others: np.ndarray, percent: int) -> np.ndarray:
        """Those of the others that link with set `one`."""
        common = self.counts(one, others)
        return others[100 * common >= percent * (self.sizes[one] + self.sizes[others] - common)]


def signatures(rows: DataFrame) -> DataFrame:
    """place, doc_id, n, f1, f2 (of the set), regs of every row of place, doc_id, text; empty regs for an empty set."""

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for place, doc_id, s in zip(batch["place"], batch["doc_id"], shingles(list(batch["text"])), strict=True):
                x, y = mix(s, 2 * ROUNDS + 3), mix(s, 2 * ROUNDS + 2)
                f1, f2 = x.sum(dtype=np.uint64), np.bitwise_xor.reduce(y, initial=np.uint64(0))
                out.append((place, doc_id, len(s), int(f1.astype(np.int64)), int(f2.astype(np.int64)), registers(s).tobytes() if len(s) else b""))
            yield pd.DataFrame(out, columns=["place", "doc_id", "n", "f1", "f2", "regs"])

    rows = rows.select("place", F.col("doc_id").cast("string").alias("doc_id"), "text")
    got = rows.mapInPandas(sign, "place long, doc_id string, n int, f1 long, f2 long, regs binary")
    return got.withColumn("doc_id", F.col("doc_id").cast("long"))


def _bands(own: DataFrame) -> DataFrame:
    """node, n, band, key: a key for each band of a class."""
    width = 2 * ROUNDS
    keys = F.transform(F.sequence(F.lit(0), F.lit(BUCKETS - 1)), lambda b: F.xxhash64(b, F.substr("regs", b * width + 1, F.lit(width))))
    return own.select("node", "n", F.posexplode(keys).alias("band", "key"))


INFO = ["node", "part", "n", "block", "band"]
#: key, i, j; an array for each of INFO; registers; sets where there are texts.
Group = tuple[tuple[int, int, int], np.ndarray, np.ndarray, list[np.ndarray]]


def _groups(batches: Iterator[pd.DataFrame]) -> Iterator[Group]:
    """The groups of members, which come in order of key, i, j, n."""
    held: list[tuple[np.ndarray, np.ndarray, list[np.ndarray]]] = []
    last = None

    def whole() -> Group:
        info, regs, sets = zip(*held, strict=True)
        return last, np.concatenate(info).T, np.concatenate(regs), [x for part in sets for x in part]

    for batch in batches:
        if not len(batch):
            continue
        ids, info = batch[["key", "i", "j"]].to_numpy(np.int64), batch[INFO].to_numpy(np.int64)
        regs = np.frombuffer(b"".join(batch["regs"]), np.uint16).reshape(len(batch), REGISTERS)
        sets = list(shingles(list(batch["text"]))) if "text" in batch else []
        cuts = [0, *(np.flatnonzero((ids[1:] != ids[:-1]).any(1)) + 1).tolist(), len(batch)]
        for low, high in zip(cuts, cuts[1:]):
            now = tuple(ids[low].tolist())
            if held and now != last:
                yield whole()
                held = []
            held.append((info[low:high], regs[low:high], sets[low:high]))
            last = now
    if held:
        yield whole()


def _by_group(members: DataFrame, found: Callable[[Group], list[tuple]], schema: str) -> DataFrame:
    """Rows that a function finds in each group (key, i, j) of members."""
    names = [c.split()[0] for c in schema.split(", ")]

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows: list[tuple] = []
        for group in _groups(batches):
            rows += found(group)
            if len(rows) > 50_000:
                yield pd.DataFrame(rows, columns=names)
                rows = []
        yield pd.DataFrame(rows, columns=names)

    columns = ["key", "i", "j", *INFO, "regs", *(["text"] if "text" in members.columns else [])]
    grouped = members.select(*columns).repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "n", "node")
    return grouped.mapInPandas(look, schema)


def _tree(group: Group, percent: int, least: float = ESTIMATE) -> list[tuple]:
    """key, a, b of the edges of a forest."""
    node = group[1][0].tolist()
    return [(group[0][0], min(node[x], node[y]), max(node[x], node[y])) for x, y in forest(group[2], group[1][2], percent, least)]


def _needed(group: Group, percent: int, least: float = ESTIMATE) -> list[tuple]:
    """key, i, j, node, part, block, band of the members that may link with another part."""
    found: set[int] = set()
    for a, b in apart(group, percent, least):
        found.update((a, *b.tolist()))
    node, part, _, block, band = group[1][:, sorted(found)].tolist()
    return [(*group[0], *x) for x in zip(node, part, block, band, strict=True)]


def _joined(group: Group, percent: int, least: float = ESTIMATE) -> list[tuple]:
    """a, b of links that join parts, on full sets; what earlier ones joined isn't compared again.

    A member is compared with all that it may link with in one count over the group's elements.
    """
    node, part, common, links = group[1][0], group[1][1].copy(), Common(group[3]), []
    for a, others in apart(group, percent, least):
        others = others[part[others] != part[a]]
        others = common.linked(a, others, percent) if len(others) else others
        while len(others):
            one, other = int(node[a]), int(node[others[0]])
            links.append((min(one, other), max(one, other)))
            low, high = sorted((part[a], part[others[0]]))
            part[part == high] = low
            others = others[part[others] != part[a]]
    return links


def verified(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Of the pairs a, b of nodes with texts (node, text), those whose full sets have 100 * intersection >= percent * union.

    The node of a pair that is in more pairs is its hub. A hub's text goes out once for about SPOKES pairs, followed by the
    other texts, and a task holds the hub's set and one batch of texts at a time.
    """
    degree = pairs.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("d"))
    both = pairs.join(degree.select(F.col("node").alias("a"), F.col("d").alias("da")), "a").join(degree.select(F.col("node").alias("b"), F.col("d").alias("db")), "b")
    hub = F.col("da") >= F.col("db")
    both = both.select(F.when(hub, F.col("a")).otherwise(F.col("b")).alias("hub"), F.when(hub, F.col("b")).otherwise(F.col("a")).alias("node"), F.greatest("da", "db").alias("d"))
    both = written(both.withColumn("salt", F.pmod(F.xxhash64("node"), F.ceil(F.col("d") / SPOKES).cast("long"))).drop("d"), "dedup-hubs")
    # joins with texts merge, whatever the size of the other side, so that what is shuffled grows with the input alone
    spokes = both.hint("merge").join(texts, "node").select("hub", "salt", "node", "text")
    hubs = both.select("hub", "salt").distinct().hint("merge").join(texts.withColumnRenamed("node", "hub"), "hub").select("hub", "salt", F.lit(-1).cast("long").alias("node"), "text")

    def confirm(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = np.empty(0, np.uint64)
        for batch in batches:
            rows = []
            for hub, node, s in zip(batch["hub"], batch["node"], shingles(list(batch["text"])), strict=True):
                if node < 0:
                    own = s
                elif linked(own, s, percent):
                    rows.append((min(hub, node), max(hub, node)))
            yield pd.DataFrame(rows, columns=["a", "b"])

    rows = hubs.unionByName(spokes).repartition("hub", "salt").sortWithinPartitions("hub", "salt", "node")
    links = written(rows.mapInPandas(confirm, "a long, b long"), "dedup-links")
    deleted(both)
    return links


def _components_of(rows: DataFrame, percent: int, least: float) -> tuple[DataFrame, DataFrame]:
    """Signatures of rows (place, doc_id, text), and f1, f2, n, node, doc_id, root of their classes, as written tables."""
    signed = written(signatures(rows), "dedup-signatures")
    classes = signed.where("n > 0").groupBy("f1", "f2", "n").agg(F.min("place").alias("node"), F.min("doc_id").alias("doc_id"))
    classes = written(classes, "dedup-classes")
    own = written(signed.select("place", "regs").join(classes.select("node", "n"), F.col("place") == F.col("node")).select("node", "n", "regs"), "dedup-own")
    met = written(_bands(own), "dedup-met")
    groups = met.groupBy("key").agg(
        F.min("band").alias("band"), F.count(F.lit(1)).alias("c"), F.sum("n").alias("size"),
        F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("s"), F.min("node").alias("x"), F.max("node").alias("y"),
    ).where("c > 1")  # bands in which the same classes meet count once: the first
    groups = groups.groupBy("c", "size", "s", "x", "y").agg(F.min(F.struct("band", "key")).alias("g")).select("g.key", "g.band", "c", "size")
    blocks = F.least("c", F.greatest(F.ceil(F.col("c") / BLOCK), F.ceil(F.col("size") / BLOCK_SHINGLES))).cast("int")
    members = met.select("node", "key").join(groups.withColumn("blocks", blocks).drop("size"), "key")
    members = written(members.withColumn("block", F.pmod(F.xxhash64("node", F.lit(7)), "blocks").cast("int")), "dedup-members")
    deleted(met)
    full = members.join(own, "node").withColumns({"part": F.col("node"), "i": F.col("block"), "j": F.col("block")})
    trees = written(_by_group(full, lambda g: _tree(g, percent, least), "key long, a long, b long"), "dedup-trees")
    texts = written(rows.select(F.col("place").alias("node"), "text").join(members.select("node").distinct().hint("merge"), "node"), "dedup-texts")
    links = verified(trees.select("a", "b").distinct(), texts, percent)
    # where an edge failed and more than its two ends meet, or in several blocks, other pairs may still link the parts
    parts = connected_components(links).select(F.col("node").alias("w"), "root")
    failed = trees.join(links, ["a", "b"], "left_anti").select("key", F.lit(True).alias("failed")).distinct()
    again = members.where("c > 2 or blocks > 1").join(parts, F.col("node") == F.col("w"), "left").withColumn("part", F.coalesce("root", "node"))
    keys = again.groupBy("key").agg(F.max("blocks").alias("most"), F.min("part").alias("low"), F.max("part").alias("high")).where("low <> high")
    keys = keys.join(failed, "key", "left").where("most > 1 or failed").select("key")
    again = again.join(keys, "key", "left_semi").withColumn("y", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    again = again.withColumns({"i": F.least("block", "y"), "j": F.greatest("block", "y")}).join(own, "node")
    schema = "key long, i int, j int, node long, part long, block int, band int"
    needed = written(_by_group(again, lambda g: _needed(g, percent, least), schema), "dedup-needed")
    again = needed.hint("merge").join(own, "node").hint("merge").join(texts, "node")
    more = written(_by_group(again, lambda g: _joined(g, percent, least), "a long, b long"), "dedup-more")
    roots = connected_components(links.unionByName(more.distinct()))
    named = classes.join(roots.withColumnRenamed("node", "w"), F.col("node") == F.col("w"), "left").withColumn("root", F.coalesce("root", "node"))
    named = written(named.drop("w"), "dedup-roots")
    deleted(own, members, trees, texts, classes, needed)
    return signed, named


def _near_duplicates(rows: DataFrame, percent: int, least: float) -> DataFrame:
    small_batches(rows.sparkSession)
    signed, named = _components_of(rows, percent, least)
    least = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = named.join(least, "root").select("f1", "f2", "n", F.lit(True).alias("in_class"), "component_id")
    out = signed.select("place", "doc_id", "n", "f1", "f2").join(named, ["f1", "f2", "n"], "left")
    component = F.when(F.col("in_class"), F.col("component_id")).otherwise(F.col("doc_id"))
    out = out.select("place", "doc_id", F.col("n").cast("long").alias("n_shingles"), component.alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def near_duplicates(docs: DataFrame, percent: int = 75, least: float = ESTIMATE) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of docs (doc_id, text).

    component_id is the smallest doc_id that is reached over links; kept says that it is the row's own. Rows without words
    have no shingles and are linked with nothing. Rows of equal sets, repeated rows among them, are linked; several rows
    of the smallest doc_id are all kept. A null doc_id is never a component's name unless it has no other: then
    component_id is null and the rows are kept. An empty table gives an empty result. Texts may be of any length.

    A pair at a similarity of exactly 0.75 shares no band with a chance of (1 - 0.75^4)^40 = 3 in 10 million; of higher
    similarity, less. Pairs that meet and are estimated under `least` are not compared; with least = -1 all that meet are.
    """
    rows = numbered(docs.select("doc_id", "text"), "dedup-docs")
    return _near_duplicates(rows.select("place", "row.doc_id", "row.text"), percent, least).drop("place")


def without_near_duplicates(docs: DataFrame, percent: int = 75, least: float = ESTIMATE) -> DataFrame:
    """One row of docs for each component: of its smallest doc_id (of rows that repeat it, the first); columns of docs."""
    rows = numbered(docs, "dedup-docs")
    kept = _near_duplicates(rows.select("place", "row.doc_id", "row.text"), percent, least).where("kept")
    alike = kept.where("n_shingles > 0").groupBy("component_id").agg(F.min("place").alias("place")).select("place")
    kept = alike.unionByName(kept.where("n_shingles = 0").select("place"))
    return rows.join(kept, "place", "left_semi").select("row.*")

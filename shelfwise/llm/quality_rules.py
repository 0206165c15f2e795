"""Quality rules with thresholds that each language and source sets for itself.

Texts are counted in Arrow batches. Four ratios of the documents that pass two base rules go into sketches: counts by
bucket of a whole number's leading bits, so that a bucket is at most 1 / 32 of its value wide and two sketches are merged by
adding counts. A group (language and source) has its own sketch, with its language's merged one added at the weight of a
few documents, which steadies small groups. Quartiles of that give the group's thresholds, and a join of the counts with the
thresholds the verdicts. Sketches are tables and may be kept and merged with those of later documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfwise.llm.workspace import numbered, small_batches, written

COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
GROUP = ("lang", "source")
#: Leading bits of a value that name its bucket.
BITS = 6
#: So many documents of the whole language are added to each group's own.
PRIOR = 100
#: A value may lie so many quartile distances from the median.
REACH = 8


@dataclass(frozen=True)
class Rule:
    """A ratio of two counts, in whole units of 1 / unit, that may not be above (nor below) its group's thresholds.

    least: the smallest quartile distance that counts, for groups in which most documents are alike.
    """

    name: str
    above: str
    below: str
    unit: int
    least: int
    two_sided: bool = False

    def value(self) -> Column:
        return F.when(F.col(self.below) > 0, F.expr(f"(`{self.above}` * {self.unit}) div `{self.below}`")).otherwise(F.lit(0)).cast("long")


RULES = (
    Rule("word_length", "word_chars", "n_words", 1_000, 250, two_sided=True),
    Rule("symbols", "n_symbols", "n_words", 1_000_000, 12_500),
    Rule("dup_lines", "n_dup_lines", "n_lines", 1_000_000, 50_000),
    Rule("repeats", "n_repeat_words", "n_words", 1_000_000, 50_000),
)


def _codes(x: np.ndarray) -> np.ndarray:
    return pd.factorize(x)[0].astype(np.int64)


def text_counts(texts: pa.Array) -> list[np.ndarray]:
    """COUNTS of each text; words are parted by the six white ASCII characters, lines by \\n."""
    texts, n = pc.fill_null(texts.cast(pa.large_string()), ""), len(texts)
    total = lambda doc, w=None: np.bincount(doc, w, n).astype(np.int64)  # noqa: E731  counts stay far below 2^53

    def parts(lists: pa.Array, good: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, number of its content, and mask of all parts, for those that are good."""
        kept = good.to_numpy(zero_copy_only=False)
        doc = np.repeat(np.arange(n), np.diff(lists.offsets.to_numpy()))[kept]
        return doc, lists.values.dictionary_encode().indices.to_numpy()[kept].astype(np.int64), kept

    split = pc.ascii_split_whitespace(texts)
    doc, word, kept = parts(split, pc.greater(pc.binary_length(split.values), 0))
    chars = pc.utf8_length(split.values).to_numpy()[kept]
    repeated = np.zeros(len(doc), bool)
    if len(doc) > 2:
        many = len(word)  # numbers of words, pairs and windows are below this, so two of them make one long
        pair = _codes(word[:-2] * many + word[1:-1])
        start = np.flatnonzero(doc[:-2] == doc[2:])
        window = _codes(_codes(pair[start] * many + word[start + 2]) * n + doc[start])
        found = start[np.bincount(window)[window] > 1] if len(start) else start
        for k in range(3):
            repeated[found + k] = True
    lines = pc.split_pattern(texts, "\n")
    at, line, _ = parts(lines, pc.greater(pc.binary_length(pc.ascii_trim_whitespace(lines.values)), 0))
    size = int(line.max(initial=0)) + 1
    n_lines, distinct = total(at), total(np.unique(at * size + line) // size)
    symbols = pc.count_substring_regex(texts, "[#*$%&|<>]").to_numpy().astype(np.int64)
    return [total(doc), total(doc, chars), symbols, n_lines, n_lines - distinct, total(doc[repeated])]


def counted(rows: DataFrame) -> DataFrame:
    """rows with COUNTS of text in its place, and base_failed."""
    names = [c for c in rows.columns if c != "text"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [*(batch[c] for c in names), *map(pa.array, text_counts(batch["text"]))]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, *COUNTS])

    schema = ", ".join([*(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in names), *(f"{c} long" for c in COUNTS)])
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return rows.mapInArrow(count, schema).withColumn("base_failed", base)


def bucket(value: Column) -> Column:
    """The smallest value that has the same BITS leading bits and the same length (of whole numbers from 0 on)."""
    shift = F.greatest(F.length(F.bin(value)) - BITS, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, shift), shift)


def sketch(counts: DataFrame) -> DataFrame:
    """lang, source, rule, bucket, n: the sketches of all groups, over rows that pass the base rules. Adds up before the shuffle."""
    values = F.explode(F.array(*[F.struct(F.lit(r.name).alias("rule"), bucket(r.value()).alias("bucket")) for r in RULES]))
    return counts.where(~F.col("base_failed")).select(*GROUP, values.alias("x")).groupBy(*GROUP, "x.rule", "x.bucket").agg(F.count(F.lit(1)).alias("n"))


def merged(*sketches: DataFrame) -> DataFrame:
    """One sketch of what several have seen."""
    every = reduce(DataFrame.unionByName, sketches)
    return every.groupBy(*GROUP, "rule", "bucket").agg(F.sum("n").alias("n"))


def _same(one: str, other: str, names: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{one}.{c}").eqNullSafe(F.col(f"{other}.{c}")) for c in names])


def thresholds(sketches: DataFrame, prior: int = PRIOR, reach: int = REACH) -> DataFrame:
    """lang, source and a column low_<rule> (of two-sided rules) and high_<rule> for each rule.

    A group's weights are its counts times the language's total, plus `prior` times the language's counts: whole numbers, so
    results depend neither on the order of merging nor on rounding. Only sketches are read, never documents.
    """
    by_lang = sketches.groupBy("lang", "rule", "bucket").agg(F.sum("n").alias("m"))
    lang = by_lang.groupBy("lang", "rule").agg(F.sum("m").alias("n_lang"))
    groups = sketches.groupBy(*GROUP, "rule").agg(F.sum("n").alias("n_group")).alias("g")
    groups = groups.join(lang.alias("l"), _same("g", "l", ("lang", "rule"))).select("g.*", "n_lang")
    whole = lambda c: c.cast("decimal(38,0)")
    own = sketches.alias("s").join(groups.alias("g"), _same("s", "g", (*GROUP, "rule")))
    own = own.select("g.*", "s.bucket", whole(whole(F.col("n")) * F.col("n_lang")).alias("weight"))
    added = groups.alias("g").join(by_lang.alias("b"), _same("g", "b", ("lang", "rule"))).select("g.*", "b.bucket", whole(F.col("m") * prior).alias("weight"))
    keys = [*GROUP, "rule", "n_lang", "n_group"]
    both = own.unionByName(added).groupBy(*keys, "bucket").agg(whole(F.sum("weight")).alias("weight"))
    up_to = Window.partitionBy(*keys).orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = both.withColumn("rank", whole(F.sum("weight").over(up_to)))
    total = whole(whole(F.col("n_group") + prior) * F.col("n_lang"))
    quartile = lambda k: F.min(F.when(4 * F.col("rank") >= k * F.col("total"), F.col("bucket")))
    got = both.withColumn("total", total).groupBy(*GROUP, "rule").agg(*[quartile(k).alias(f"q{k}") for k in (1, 2, 3)])
    found = []
    for r in RULES:
        here = F.col("rule") == r.name
        found.append(F.max(F.when(here, F.col("q2") + reach * F.greatest(F.col("q3") - F.col("q2"), F.lit(r.least)))).alias(f"high_{r.name}"))
        if r.two_sided:
            found.append(F.max(F.when(here, F.col("q2") - reach * F.greatest(F.col("q2") - F.col("q1"), F.lit(r.least)))).alias(f"low_{r.name}"))
    return got.groupBy(*GROUP).agg(*found)


def judged(counts: DataFrame, limits: DataFrame) -> DataFrame:
    """counts with broken (names of the rules that a row breaks) and kept.

    A row whose group has no thresholds breaks none of these rules. Groups may be of any size: the join is by group, and
    Spark splits a group that holds many rows.
    """
    both = counts.alias("c").join(limits.alias("t"), _same("c", "t", GROUP), "left")
    broken = []
    for r in RULES:
        bad = r.value() > F.col(f"high_{r.name}")
        if r.two_sided:
            bad = bad | (r.value() < F.col(f"low_{r.name}"))
        broken.append(F.when(bad, F.lit(r.name)))
    both = both.select("c.*", F.array_compact(F.array(*broken)).alias("broken"))
    return both.withColumn("kept", ~F.col("base_failed") & (F.size("broken") == 0))


def quality(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Verdicts on every row of docs (text, lang, source): the columns `keep`, lang, source, COUNTS, base_failed, broken, kept.

    Null and empty texts have no words and fail the base rules. A null language or source is a value like any other. Rows
    are judged one by one, so repeated ids and rows do no harm; an empty table gives an empty result. Texts are counted
    whole. Other columns of docs are ignored, whatever their names.
    """
    small_batches(docs.sparkSession)
    counts = written(counted(docs.select(*keep, *GROUP, "text")), "quality-counts")
    return judged(counts, thresholds(sketch(counts)))


def good_documents(docs: DataFrame) -> DataFrame:
    """The rows of docs (text, lang, source and any others) that quality() keeps, with all their columns as they were."""
    rows = numbered(docs, "quality-docs")
    kept = quality(rows.select("place", "row.text", "row.lang", "row.source"), ("place",)).where("kept").select("place")
    return rows.join(kept, "place", "left_semi").select("row.*")

"""Language identification by rank-order profiles of character n-grams.

A language's profile is the list of its most frequent 1- to 3-grams. A text is of the language whose profile has the
smallest out-of-place distance to the text's own list: the sum of the differences in rank, and the length of a profile
for each n-gram that the profile lacks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfwise.llm.workspace import small_batches

PROFILE = 300
#: Every task gets PROFILE n-grams of 12 bytes for each language; a column with more values than this holds no languages.
MOST_LANGUAGES = 1 << 14
EDGE = 1
_letters: list[np.ndarray] = []


def letters() -> np.ndarray:
    """Whether a code point is a letter."""
    if not _letters:
        _letters.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _letters[0]


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The distinct 1- to 3-grams of the lower-cased text as codes of 21 bits a character, and their counts.

    Runs of what isn't a letter count as one edge, as do both ends.
    """
    a = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    a = np.where(letters()[a], a, EDGE).astype(np.uint64)
    a = np.concatenate(([EDGE], a, [EDGE])).astype(np.uint64)
    inner = a != EDGE
    if not inner.any():
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    a = a[inner | np.concatenate(([True], inner[:-1]))]
    two = (a[:-1] << np.uint64(21)) | a[1:]
    three = (two[:-1] << np.uint64(21)) | a[2:]
    return np.unique(np.concatenate((a[a != EDGE], two, three)), return_counts=True)


def top(codes: np.ndarray, counts: np.ndarray, k: int = PROFILE) -> np.ndarray:
    """The k most frequent codes in order; of equal counts the smaller code first."""
    return codes[np.lexsort((codes, -counts))[:k]]


def learn(docs: DataFrame, docs_per_language: int = 2000, seed: int = 23) -> list[tuple[str, list[int]]]:
    """(language, its profile) from text and lang of docs; rows with a null lang, or without letters, teach nothing.

    The profiles are fitted on about docs_per_language documents a language, chosen by a hash of doc_id (all, where there
    are fewer). All languages are learnt; more than MOST_LANGUAGES different values are an error. Only profiles reach the
    driver.
    """
    small_batches(docs.sparkSession)
    docs = docs.select("doc_id", "text", "lang").where("lang is not null and text is not null")
    found = docs.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(MOST_LANGUAGES + 1).collect()
    if len(found) > MOST_LANGUAGES:
        raise ValueError(f"lang has more than {MOST_LANGUAGES} different values")
    if not found:
        return []
    share = docs.sparkSession.createDataFrame([(r["lang"], docs_per_language / r["n"]) for r in found], "lang string, share double")
    place = F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, texts in batch.groupby("lang")["text"]:
                parts = [grams(t) for t in texts]
                codes, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
                n = np.bincount(at, np.concatenate([p[1] for p in parts]), len(codes)).astype(np.int64)
                yield pd.DataFrame({"lang": lang, "code": codes.astype(np.int64), "n": n})

    counted = docs.join(F.broadcast(share), "lang").where(place < F.col("share")).select("text", "lang").mapInPandas(count, "lang string, code long, n long")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "code"))
    rows = counted.groupBy("lang", "code").agg(F.sum("n").alias("n")).withColumn("rank", rank).where(F.col("rank") <= PROFILE)
    profiles: dict[str, list[tuple[int, int]]] = {}
    for r in rows.select("lang", "code", "rank").collect():
        profiles.setdefault(r["lang"], []).append((r["rank"], r["code"]))
    return sorted((lang, [code for _, code in sorted(ranked)]) for lang, ranked in profiles.items())


def predictor(model: list[tuple[str, list[int]]]):
    """A pandas UDF of text: struct of lang_pred and score."""
    names = np.array([name for name, _ in model] or [""], dtype=object)
    code = np.array([c for _, p in model for c in p], np.uint64)
    lang = np.array([i for i, (_, p) in enumerate(model) for _ in p], np.int64)
    rank = np.array([r for _, p in model for r in range(len(p))], np.int64)
    order = np.argsort(code, kind="stable")
    code, lang, rank = code[order], lang[order], rank[order]

    def one(text: str | None) -> tuple[str, float]:
        own = top(*grams(text)) if text else ()
        if not len(own) or not len(model):
            return "und", 0.0
        low, high = np.searchsorted(code, own), np.searchsorted(code, own, "right")
        n = high - low
        at = np.repeat(low - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
        near = PROFILE - np.abs(rank[at] - np.repeat(np.arange(len(own)), n))  # what is saved against being absent
        saved = np.bincount(lang[at], near, len(model))
        best = int(saved.argmax())
        return names[best], float(saved[best] / (PROFILE * len(own)))

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([one(t) for t in texts], columns=["lang_pred", "score"])

    return predict


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning: crc32 of its id as text, mod 3, is 1. Null ids: false."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 3 == 1, F.lit(False))


def identify_as(docs: DataFrame, model: list[tuple[str, list[int]]], name: str, text_col: str = "text") -> DataFrame:
    """docs with a column of that name: the struct of lang_pred and score. See identify()."""
    small_batches(docs.sparkSession)
    return docs.withColumn(name, predictor(model)(F.col(text_col)))


def identify(docs: DataFrame, model: list[tuple[str, list[int]]], text_col: str = "text") -> DataFrame:
    """docs with lang_pred and score (which replace columns of those names).

    score is 1 minus the out-of-place distance as a share of the largest one. Null texts and texts without a letter get
    `und` and 0, as do all texts under an empty model. Of equally near languages the first in code point order wins. The
    whole text counts, however long. Rows are independent of each other.
    """
    got = identify_as(docs, model, "__lang", text_col)
    return got.withColumns({"lang_pred": F.col("__lang.lang_pred"), "score": F.col("__lang.score")}).drop("__lang")

"""From documents to token files in five stages.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next one's
docs. All but the last return the columns that they were given. As a stage begins, the tables go that the one before wrote
for itself (copies of its texts among them), unless docs still reads them.
"""

from __future__ import annotations

import logging
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm import decontamination, language_id, mixing, near_dedup, token_files
from shelfwise.llm.queries import tokenizer_path
from shelfwise.llm.workspace import deleted, recorded, written

log = logging.getLogger(__name__)

#: The languages to keep, at least one; None: all that the labelled documents teach.
LANGUAGES: frozenset[str] | None = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str, rejected: Observation | None = None) -> DataFrame:
    """Documents whose predicted language is one of LANGUAGES; those of others and those without a letter go.

    No score decides: a text is of the language that it is nearest to, however far that is. Where nothing is labelled no
    language is known, and all go. `rejected` counts what goes, as no_letter and other_language, while the result is made.
    """
    got = language_id.identify_as(docs, language_id.learn(docs), "__lang")
    lang = F.col("__lang.lang_pred")
    wanted = lang != "und" if LANGUAGES is None else lang.isin(sorted(LANGUAGES))
    if rejected is not None:
        got = got.observe(rejected, F.count_if(lang == "und").alias("no_letter"), F.count_if((lang != "und") & ~wanted).alias("other_language"))
    return got.where(wanted).select(*[F.col(f"`{c}`") for c in docs.columns])


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that of the smallest doc_id."""
    return near_dedup.without_near_duplicates(docs)


def remove_benchmark_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item, verbatim or re-parameterised."""
    items = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return decontamination.without_contaminated(docs, items)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix by source takes it."""
    return mixing.mixed_documents(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document in the token files, from the files."""
    return token_files.token_index(spark, token_files.write_token_files(docs, tokenizer_path()))


#: Tables of written() that stages wrote for themselves.
_left: list[DataFrame] = []


def tidied(stage: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """stage, which first deletes what earlier stages of its session wrote for themselves; what docs still reads stays."""

    @wraps(stage)
    def begun(spark: SparkSession, docs: DataFrame, sf_dir: str, **options: Observation) -> DataFrame:
        mine = [t for t in _left if t.sparkSession is docs.sparkSession]
        files = docs.inputFiles() if mine else []
        _left[:] = [t for t in mine if any(f"/{t.written_to.rpartition('/')[2]}/" in f for f in files)]
        deleted(*[t for t in mine if not any(t is x for x in _left)])
        with recorded() as made:
            try:
                return stage(spark, docs, sf_dir, **options)
            finally:
                _left.extend(made)

    return begun


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", tidied(identify_language)),
    ("near_dedup", tidied(remove_near_duplicates)),
    ("decontamination", tidied(remove_benchmark_items)),
    ("source_mixing", tidied(mix)),
    ("token_output", tidied(write_tokens)),
]

#: Language profiles, tokenization and the knapsack are beyond SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's result over documents in sf_dir. What the first stage rejects is logged by reason.

    What a stage writes for itself goes once its result is written, whether or not it is tidied.
    """
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    rejected = Observation("rejected")
    for i, (name, stage) in enumerate(STAGES[:-1]):
        options = {} if i else {"rejected": rejected}
        with recorded() as made:
            before, docs = docs, written(stage(spark, docs, sf_dir, **options), f"stage-{name}")
        deleted(*made[:-1])  # the last is the result
        if i:
            deleted(before)
        else:
            log.info("%s rejects %s", name, rejected.get)
    return STAGES[-1][1](spark, docs, sf_dir)

"""From raw documents to packed training sequences: five stages, each one of the operators in tablegauge.llm.

A stage takes (spark, docs, sf_dir), where docs has the columns of the table `documents`, and returns a
DataFrame, which is written and read again as the next stage's docs. All but the last return the same columns.

* toxicity: documents that score 0.5 or more as toxic go.
* near_duplicates: of each group of near copies (5-word shingles, similarity 0.8) the least doc_id stays.
* decontamination: documents that share 13-word windows with `benchmark` in 1 of 20 words or more go.
* personal_data: every span of personal data is replaced by its kind, as in [EMAIL]; no document goes.
* packing: one row per piece of a document, with its sequence of at most 1024 tokens and its place there.

Stages take texts of any length. Null and empty texts and texts without words pass all of them (in packing
they are a document of its end id). Rows of equal id and text are one document in near_duplicates, of which one
row stays, and rows of their own elsewhere. A null doc_id is kept as null. Columns that the table has beyond
those of `documents` pass unchanged, whatever their names. An empty table gives no rows.

SQL can express neither the scores of a trained classifier nor best-fit packing, so ORACLE_SQL is None and
tests compare the stages with brute force.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tablegauge.llm import bbit_minhash, disclosure, toxicity, vector_packing, winnowing
from tablegauge.llm.common import load, saved, ship_package
from tablegauge.llm.queries import RANKS


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return toxicity.not_toxic(docs, load(spark, sf_dir, "labels"))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return bbit_minhash.deduplicated(docs, words=5, percent=80)


def without_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return winnowing.clean_documents(docs, load(spark, sf_dir, "benchmark"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return disclosure.sanitised(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return vector_packing.pack(docs, RANKS)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", without_toxic),
    ("near_duplicates", without_near_duplicates),
    ("decontamination", without_contaminated),
    ("personal_data", without_personal_data),
    ("packing", packed),
]

ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`; every stage but the last is written to the shared folder."""
    docs = load(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

"""From raw documents to a mixed, tokenised corpus, stage by stage."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cartwake.llm import decontaminate, mixing, quality, simhash_dedup, token_codes
from cartwake.llm.common import on_workers, table
from cartwake.llm.queries import TOKENIZER
from cartwake.sources.files import stored

#: Documents less likely good than this go.
LEAST_SCORE = 0.5


#: Columns that stages read; all others only come along.
READ = ("doc_id", "text", "source")


def _apart(docs: DataFrame) -> DataFrame:
    """``docs`` with names for the other columns that no operator makes."""
    return docs.toDF(*[c if c in READ else f"other_{i}" for i, c in enumerate(docs.columns)])


def _back(rows: DataFrame, inner: DataFrame, docs: DataFrame) -> DataFrame:
    return rows.select(*inner.columns).toDF(*docs.columns)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier, trained on the labelled documents of this input."""
    inner = _apart(docs)
    model = quality.train(inner, table(spark, sf_dir, "labels"))
    return _back(quality.score(inner, model).where(f"score >= {LEAST_SCORE}"), inner, docs)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-duplicates: the document of the least id of each group stays."""
    return simhash_dedup.keep_first(docs)


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with benchmark passages go."""
    inner = _apart(docs)
    marked = decontaminate.scan(inner, table(spark, sf_dir, "benchmark"))
    return _back(marked.where("not contaminated"), inner, docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix uses them."""
    return mixing.repeat(docs, mixing.mix(docs))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the mix, written as shards and read back."""
    return token_codes.encode_documents(docs, public_tokenizers.path(TOKENIZER), end_id=1)


STAGES = [
    ("quality classifier", keep_good),
    ("simhash near-dedup", keep_one_of_each_group),
    ("benchmark decontamination", keep_uncontaminated),
    ("mixing sources", mix_sources),
    ("token codes", encode),
]

#: SQL cannot train, link, fill budgets or tokenise; the tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    on_workers(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

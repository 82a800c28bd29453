"""Training-data pipeline over ``documents``: each stage reads what the one before it kept.

All stages but the last return the columns of ``documents``; the last one the tokens. SQL
cannot express code lengths, likelihoods or byte pair merges, so there is no check in SQL;
the tests compare each stage with a brute-force version.

All stages: ids are integers or null, and texts with a null or repeated id are judged each by
itself. Other columns, whatever their names, come back unchanged; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapgraph.llm import bpe, decontaminate, language, secrets, setsketch
from lapgraph.llm.common import drop_documents, return_memory, stored, table
from lapgraph.llm.queries import language_model, pretoken_pattern, ranks_path


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the context trees know; null texts and texts without a letter
    go. Equal rows share a fate; nothing is shuffled."""
    model = language_model(docs)
    return_memory()  # what the model was made of
    return language.keep_identified(docs, model)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the text with the smallest id, once; a null or repeated
    id makes no group."""
    found = stored(setsketch.near_duplicate_texts(docs), "near")
    repeated = found.groupBy("k", "h").agg(F.count("*").alias("n")).where("n > 1")
    return drop_documents(docs, found.where("NOT kept"), repeated)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark windows make up less than a twentieth. Empty and null texts have
    no window and stay, also beside an empty benchmark."""
    found = decontaminate.judged_texts(docs, table(spark, sf_dir, "benchmark"))
    return drop_documents(docs, stored(found.where("contaminated").select("k", "h"), "contaminated"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, live-looking credentials replaced; examples that many copy stay. Null and
    empty texts stay as they are; n_chars follows the text."""
    return secrets.redact(docs, stored(secrets.judge(secrets.scan(docs)), "judged"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document that is left, one row for each; a null text has none."""
    return bpe.encode_documents(docs, ranks_path(), pretoken_pattern(), forget=True)


STAGES = [
    ("language_id", identified),
    ("near_dedup", without_near_duplicates),
    ("decontamination", decontaminated),
    ("secrets", without_secrets),
    ("bpe", encoded),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs

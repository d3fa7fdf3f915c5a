"""From raw documents to packed training sequences: five stages, each one of the corpus operators.

Toxic documents go, one of each class of near copies stays, personal data gets pseudonyms, sources are mixed to
target weights in training order, and the texts' ids are packed. Every stage but the last returns the columns of
documents. Each is written as Parquet in the shared folder and read again; what a stage has stored on its way is deleted
then.

A null text holds no words: it is not toxic, is a copy of the empty text, holds no personal data, and is not taken by the
mix. Rows are told apart by id and text, so unique texts stay whatever their doc_id; null is a doc_id like any other, and
a source of its own. Ties go to the least doc_id, then to a hash of the text. Columns beyond those of documents stay, with
any name. An empty table gives no rows at every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.llm import curriculum, packing, pii_feistel, prob_minhash, toxicity_kn
from folioscope.llm.common import WRITTEN, forget, stored, table


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the class models, fitted on the labelled ones among them, do not find toxic."""
    return toxicity_kn.keep_ordinary(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies, that of the least doc_id, null last."""
    return prob_minhash.keep_one(docs)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with pseudonyms for personal data, under the session's key; n_chars follows the text."""
    return _counted(pii_feistel.pseudonymised(docs, pii_feistel.session_key(spark)))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The copies that the target weights take, in training order; n_chars follows the text."""
    return _counted(curriculum.mix(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' ids in sequences of at most 4096."""
    return packing.pack_documents(docs)


STAGES = [("toxicity", toxicity), ("near_duplicates", near_duplicates), ("pii", pii), ("mixing", mixing), ("packing", pack)]

#: SQL can express neither the trained models nor the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        before = len(WRITTEN)
        docs = stored(stage(spark, docs, sf_dir), name)
        forget(spark, WRITTEN[before:-1])
    return docs

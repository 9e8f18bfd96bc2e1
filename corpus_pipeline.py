"""The corpus pipeline: language, near duplicates, mixture, sequences.

Each stage takes the documents that the one before it kept, as a Parquet table, and returns a table; all but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.llm.common import id_residue, read_table, small_batches, stored
from marketloom.llm.language_id import UNKNOWN, fit, identify
from marketloom.llm.mixing import mixed_documents
from marketloom.llm.packing import pack
from marketloom.llm.shingle_join import jaccard_components

#: Below this score a text is like no learned language: its frequent n-grams are hardly in any profile.
LEAST_SCORE = 0.25

#: Texts link from this Jaccard similarity of their shingles of so many words on; op10's query has values of its own.
SIMILARITY, WIDTH = Fraction(4, 5), 5


def in_a_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a letter, and texts like no learned language, go.

    Profiles are learned from the documents whose id has not the residue 1, as in the query; when none has a language,
    nothing can be judged and all documents stay.
    """
    small_batches(spark)
    profiles = fit(docs.where(id_residue("doc_id", 3) != 1))
    if not profiles.languages:
        return docs
    judged = identify(docs, profiles)
    return judged.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose word shingles agree, directly or over others, the one with the smallest id stays.

    Rows with a null id stay; of several rows with one id the one whose other columns come first stays.
    """
    small_batches(spark)
    linked = jaccard_components(docs, SIMILARITY, WIDTH)
    gone = linked.where("doc_id <> component_id").select("doc_id").distinct()
    rest = docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    repeated = linked.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id")
    repeated = stored(repeated)
    if repeated.isEmpty():
        return rest
    once = rest.join(repeated, "doc_id", "left_semi").groupBy("doc_id").agg(F.min(F.struct(*docs.columns)).alias("first"))
    return rest.join(repeated, "doc_id", "left_anti").select(*docs.columns).union(once.select("first.*"))


def in_target_shares(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document with the words that the mixture of sources takes of it, repeats in order; the others go.

    Null is a source like the others, the last one; null texts and texts without words hold nothing to take and go; a null
    id is an id like others, and rows with equal ids and texts get the parts of one of them; an empty table stays empty.
    """
    small_batches(spark)
    return mixed_documents(docs)


def as_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the sequences that the documents' tokens are packed into.

    Every row is a document of its own, also with a null or repeated id; a null or empty text has only the closing id;
    texts of any length are cut, never shortened; an empty table gives no pieces.
    """
    import public_tokenizers

    small_batches(spark)
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"), added=True)


STAGES = [
    ("language identification", in_a_known_language),
    ("n-gram Jaccard join", one_of_each_group),
    ("mixing sources to target weights", in_target_shares),
    ("packing", as_sequences),
]

#: The tokenizer and the language profiles can't be written in SQL; tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

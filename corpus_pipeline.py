"""A training corpus from raw documents: five stages, each on all that the one before it kept.

All stages take null ids and texts, empty tables and columns of any name as they come; all but the last
return the columns of documents, in their order. `doc_id` is meant to be unique: what a stage says of rows
that repeat one is in its docstring.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metaloom.llm import line_dedup, mixing, packing, superminhash, toxicity
from metaloom.llm.common import stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is not predicted to be toxic. The classifier learns from all documents that
    have a label to learn from, null and empty texts included. Every row is judged by its own text, so rows
    that repeat an id may part, and a null or empty text is judged as one without words."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).where("predicted = 0").select(docs.columns)


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later occurrences of lines that spread over sources; those of which nothing is
    left go. Null and blank texts stay as they are; rows that repeat id and text are treated alike."""
    kept = line_dedup.drop_spread_lines(docs)
    blank = F.trim(F.translate("text", "\t\n\x0b\x0c\r", "     ")) == ""
    return kept.where(~F.coalesce((F.col("lines_removed") > 0) & blank, F.lit(False))).select(docs.columns)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near-duplicates. Null and empty texts and rows
    without an id all stay. Rows that repeat an id are one document: they stay or go together."""
    found = superminhash.near_duplicates(docs)
    gone = found.where(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each document as often as it is taken whole, and the words taken besides. Null and blank
    texts have no words to take and go; rows that repeat an id are taken one by one."""
    return mixing.mixed_documents(mixing.mix(docs), docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces of the mix in sequences of 4096 tokens; copies of a document are packed one by one."""
    from public_tokenizers import path

    return packing.pack(docs, path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_boilerplate),
    ("minhash_near_dedup", keep_one_of_near_copies),
    ("mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]

# Classifying, near copies and packing are beyond SQL; the stages are tested one by one instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on `documents`; what each returns is written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return stored(STAGES[-1][1](spark, docs, sf_dir), STAGES[-1][0])

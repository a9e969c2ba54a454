"""A training corpus from raw documents: five stages, each over all that the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written to the shared
folder and read again as the next one's documents.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.llm import bwt, lang, mixing, packing, tgm
from tallybook.llm.common import table, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
# Words of a shingle, and percent of two documents' shingles that make them near copies.
SHINGLE, PERCENT = 5, 80

# Learned models, hashes and random draws are beyond SQL; tests hold the rows against brute force.
ORACLE_SQL = None


def _numbered(docs: DataFrame, name: str) -> DataFrame:
    """Rows with a number of their own, as identifiers may be null or shared.

    Stages read files, whose rows get the same numbers in every scan of one folder listing. Rows of
    any other plan are written first.
    """
    try:
        docs.select("_metadata.row_index")
    except AnalysisException:
        docs = written(docs, name)
    return docs.withColumn("row", F.monotonically_increasing_id())


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language. One goes if it has no letter or if the machines are no surer
    of their answer than a guess; where no label taught them anything, only the former. A missing
    label is filled in. Nulls, repeated rows and equal identifiers are judged row by row."""
    model = lang.fit(docs)
    found = lang.predict(docs, model, carry=tuple(c for c in COLUMNS if c != "doc_id"))
    kept = found.filter(~lang.rejected(F.col("lang_pred"), F.col("score"), F.col("text"), model))
    told = F.when(F.col("lang_pred") != lang.UNKNOWN, F.col("lang_pred"))
    return kept.withColumn("lang", F.coalesce("lang", told)).select(*COLUMNS)


def join_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest identifier, null last,
    and of several such the first row. Rows are told apart by their own numbers, so identifiers may
    be null or shared; repeated rows are copies of each other. A document without words stays."""
    rows = _numbered(docs, "rows")
    groups = tgm.jaccard_components(rows.select("row", "text"), "row", shingle=SHINGLE, percent=PERCENT)
    members = groups.select("row", "component_id").join(rows.select("row", "doc_id"), "row")
    first = F.min_by("row", F.struct(F.col("doc_id").isNull(), "doc_id", "row"))
    families = members.groupBy("component_id").agg(first.alias("stays"), F.count(F.lit(1)).alias("n"))
    copies = members.join(families.filter("n > 1"), "component_id").filter("row != stays")
    # written, so that Spark knows their size: texts are shuffled only if they are too many to broadcast
    return rows.join(written(copies.select("row"), "copies"), "row", "left_anti").select(*COLUMNS)


def drop_shared_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that a smaller document has; a text of nothing else goes.
    Characters that a removal cuts through go as a whole."""
    found = bwt.drop_shared(docs, carry=("lang", "source"), as_text=True)
    left = found.filter((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_bytes")))
    texts = left.withColumnRenamed("kept", "text").withColumn("n_chars", F.length("text").cast("long"))
    return texts.select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them, up to three times. Each row is a
    document of its own, whatever its identifier; the draw follows from identifier and text."""
    rows = _numbered(docs, "rows")
    mixed = mixing.mix(rows, "row", drawn_by=("doc_id", "text"))
    return mixing.repeat_numbered(rows, mixed, "row").select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces with their places in sequences of 2048 tokens."""
    return packing.pack(packing.pieces(docs))


STAGES = [
    ("language", identify_language),
    ("near copies", join_near_copies),
    ("shared passages", drop_shared_passages),
    ("mix", mix_sources),
    ("pack", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

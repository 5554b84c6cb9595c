"""A corpus pipeline of five stages over ``documents``: language ID, line
de-duplication, SimHash near-duplicates, source mixing and packing.

Each stage takes (spark, docs, sf_dir), works on every row its predecessor
kept, and returns the columns of ``documents`` (the last returns packed
pieces). ``run`` writes each stage's result as Parquet in the shared folder
and reads it again for the next.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from provisio.llm import crf_language, line_dedup, mixing, pack, simhash
from provisio.llm.common import land
from provisio.session import checkpoint_dir

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

# A document goes when it has no letter, or when no language holds this share of
# its words; a text that switches between two languages stays.
MIN_LANGUAGE_SHARE = 0.4


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID (6): learns from this input's labelled documents that are
    not held out; keeps documents one of whose languages holds enough words.
    Null and letterless texts go. If nothing can be learned, all go."""
    model = crf_language.fit(crf_language.sample_texts(docs.where(~crf_language.held_out(F.col("doc_id"))).select("lang", "text")))
    scored = crf_language.identify(docs, model, keep=COLUMNS)
    return scored.where((F.col("lang_pred") != crf_language.UNDEFINED) & (F.col("score") >= MIN_LANGUAGE_SHARE)).select(*COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line de-duplication (10): later repeated runs are cut out of the texts;
    n_chars follows. Every row stays, also one whose text becomes empty."""
    return line_dedup.dedup_runs(docs).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-duplicates (1): the document whose id names its component
    stays; of rows sharing that id the first by text hash, and of a component
    without any doc_id the row with the smallest text hash."""
    return simhash.representatives(docs.select(*COLUMNS))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Source mixing (3): every source at the same share of characters. A row
    appears as often as its draw says, also not at all; a null source is a source
    of its own, and a source of empty texts only keeps its rows once."""
    return mixing.mix(docs.select(*COLUMNS)).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packing (9): pieces with sequence_id and offset. A null or empty text is
    one piece, its end token; a long text is cut freely; a document that mixing
    repeated is packed each time."""
    return pack.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", keep_identified),
    ("line dedup", drop_repeated_lines),
    ("SimHash near-dedup", keep_one_of_each_group),
    ("mixing sources to target weights", mix_sources),
    ("packing", pack_sequences),
]

# SQL cannot express the CRF, the winnowing or the packing; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the packed pieces."""
    checkpoint_dir(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = land(docs, name.replace(" ", "-"))
    return docs

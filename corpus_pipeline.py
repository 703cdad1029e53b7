"""From raw documents to a training mix: quality, repeated lines, near duplicates, benchmark leaks, source weights.

Every stage takes and returns rows of `documents`, with all columns whatever their names; the mix adds the last one. Rows
are told apart by (doc_id, text), so null and repeated ids, repeated rows and ties have a defined result, stated with the
operator each stage calls. Null and empty texts have no words and no lines: they pass the lines, near-duplicate and
benchmark stages, and are taken 0 words by the mix. Very long texts are read whole. An empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eavcube.llm import decontaminate, jaccard, lines, mixing, quality
from eavcube.llm.common import prepare, quoted, staged, table, unused


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject; without labels of both classes all stay."""
    prepare(spark)
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of ten documents or more stay in the first of them only; documents that lose all their text go.

    Texts that were empty or null before stay.
    """
    prepare(spark)
    (dropped,) = unused(docs, "_dropped")
    kept = lines.apply_bitmaps(docs, lines.shared_line_bitmaps(docs, min_docs=10, min_chars=1, keep="first"), dropped=dropped)
    kept = kept.where((F.col(dropped) == 0) | (F.length(F.btrim(F.col("text"), F.lit(lines.SPACES))) > 0)).drop(dropped)
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return kept.select(*[quoted(c) for c in docs.columns])


def keep_one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares 80 % of its five-word shingles."""
    prepare(spark)
    return jaccard.keep_one(docs, words=5, percent=80)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"), words=5, percent=80)


def mix_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents repeated, with the number of the repetition in `copy`."""
    prepare(spark)
    return mixing.repeat_documents(docs, share=1.5, max_epochs=2.0)


STAGES = [
    ("quality", keep_quality),
    ("lines", drop_shared_lines),
    ("near duplicates", keep_one_of_similar),
    ("decontamination", drop_leaks),
    ("mix", mix_to_weights),
]

# The classifier's compressed sizes have no counterpart in SQL; the tests compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir))
    return docs


QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}

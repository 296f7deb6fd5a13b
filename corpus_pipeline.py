"""The corpus pipeline: quality rules, line dedup, near-dedup, benchmark decontamination, mixing.

STAGES lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame.  All but the last
return the columns of ``documents``, with n_chars the length of the text as it is then; further columns are dropped.  Null and empty
texts, repeated rows and empty tables are handled as the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from amberline.llm import decontaminate, line_dedup, mixing, near_dedup, quality
from amberline.llm.common import WORD, checkpointed, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: The labelling of lines cannot be said in SQL.
ORACLE_SQL = None
#: Ids and text marks of dropped near copies up to this number are broadcast; more are joined by a shuffle.
BROADCAST_IDS = 1_000_000
#: Near copies are documents with a similarity of 0.8 or more.  38 bands of 5: a pair at 0.8 is in no common bucket with probability
#: (1 - 0.8 ** 5) ** 38 = 3e-7, as op8's bands miss a pair at its 0.85.
NEAR = {"percent": 80, "bands": 38, "rows": 5}


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and whose words are mostly in content lines.  Texts without words go."""
    crf = quality.fit_on_labels(docs, table(spark, sf_dir, "labels"))
    return quality.judge(docs, crf, keep=tuple(COLUMNS)).where("kept").select(COLUMNS)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines in at least 10 documents stay only where they come first; documents that lose all their words go.

    Every line that goes is still in the first document that has it.
    """
    docs = docs.select(COLUMNS)
    out = line_dedup.drop_lines(docs, line_dedup.line_bitmaps(docs, keep_first=True))
    emptied = (F.col("n_dropped") > 0) & ~F.coalesce(F.col("text"), F.lit("")).rlike(WORD)
    return out.where(~emptied).withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.length("text")).otherwise(F.col("n_chars")).cast("long")).select(COLUMNS)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, the one with the smallest id, of each group of near copies (similarity 0.8 or more).

    Null ids sort last; rows that share an id, null included, are judged by their own texts, and of those with one text too a single one stays.
    """
    return near_dedup.drop_near_duplicates(docs.select(COLUMNS), BROADCAST_IDS, **NEAR)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts words of benchmark windows out of the texts; documents that are mostly such words go."""
    out = decontaminate.decontaminate(docs.select(COLUMNS), table(spark, sf_dir, "benchmark"))
    return out.withColumn("n_chars", F.length("text").cast("long"))


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in the mix with the number of copies and of words taken; what is taken no times goes."""
    mix = mixing.mix_sources(docs, keep=("text", "lang", "n_chars")).where("copies > 0")
    return mix.select(*COLUMNS, "size", "source_size", "target", "copies", "taken")


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("benchmark_decontamination", benchmark_decontamination),
    ("mixing_sources", mixing_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what is between two stages is in the shared checkpoint folder."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = checkpointed(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

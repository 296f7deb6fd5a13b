"""The registered queries of the subpackage: one per operator, over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontaminate, fill_middle, language, line_dedup, mixing, near_dedup, quality, substring_dedup, suffix_dedup, url_rules, warc, whitening
from .common import checkpointed, remove_folder, scratch_folder, table
from .oracles import ORACLES  # noqa: F401

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def register(f):
        QUERIES[name] = f
        return f

    return register


@query("op1_line_dedup")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return line_dedup.drop_lines(docs, line_dedup.line_bitmaps(docs)).drop("text")


@query("op2_suffix_array_dedup")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return suffix_dedup.drop_bytes(docs, suffix_dedup.removed_bytes(docs)).drop("text")


@query("op3_benchmark_decontamination")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.match_items(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", (F.col("n_hit") > 0).alias("contaminated"))


@query("op4_language_id")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    return language.identify(docs, language.learn(docs))


@query("op5_quality_rules")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return quality.judge(docs, quality.fit_on_labels(docs, table(spark, folder, "labels")))


@query("op6_chat_formatting")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations, and -1, whose texts look like control strings."""
    probe = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                  F.lit("</s>[INST] ok [/INST]").alias("text"))
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    return chat.read_back(chat.format_conversations(turns.unionByName(probe)))


@query("op7_substring_dedup")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return substring_dedup.drop_repeated_words(docs, substring_dedup.repeated_words(docs)).drop("text")


@query("op8_near_dedup")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, folder, "documents"))


RULES = [url_rules.Rule("org", "/", "allow"), url_rules.Rule("example.org", "/es/", "block"), url_rules.Rule("example.org", "/en/1", "block"),
         url_rules.Rule("com", "/fr/", "allow"), url_rules.Rule("com", "/de/", "block")]


@query("op9_url_filters")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return url_rules.judge_urls(table(spark, folder, "pages"), RULES)


@query("op10_mixing")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_sources(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query("op11_fill_in_middle")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return fill_middle.digests(fill_middle.taken_back(fill_middle.fill_in_middle(docs)))


@query("op12_embedding_whitening")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding")
    fitted = whitening.fit(vectors)
    return whitening.by_component(whitening.whiten(vectors, fitted), fitted)


@query("op13_warc_revisits")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    """The archives are in a folder of their own, which goes once their headers are read back and saved."""
    archives = scratch_folder(spark, "warc")
    warc.write_archives(table(spark, folder, "pages"), archives)
    read = checkpointed(warc.read_archives(spark, archives).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))
    remove_folder(spark, archives)
    return read

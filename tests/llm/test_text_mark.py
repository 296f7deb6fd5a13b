"""Rows with null ids are told apart by a hash of the whole text."""

from pyspark.sql import functions as F

from amberline.llm import line_dedup, substring_dedup, suffix_dedup

PASSAGE = " ".join(f"p{i}" for i in range(40))
OTHER = " ".join(f"q{i}" for i in range(40))


def test_texts_that_agree_in_31_bits_of_their_hash_keep_their_own_spans(spark):
    short = F.shiftrightunsigned(F.xxhash64("text"), 33).alias("short")
    numbers = spark.range(200_000).select(F.col("id").cast("string").alias("i"))
    copies = numbers.select(F.concat(F.lit(PASSAGE + "\na"), "i").alias("text")).select("text", short)
    others = numbers.select(F.concat(F.lit(OTHER + "\nb"), "i").alias("text")).select(F.col("text").alias("other"), short)
    pair = copies.join(others, "short").orderBy("text", "other").first()
    assert pair is not None
    docs = spark.createDataFrame([(None, pair.text), (None, pair.other), (1, PASSAGE), (2, PASSAGE)], "doc_id long, text string")
    words = substring_dedup.drop_repeated_words(docs, substring_dedup.repeated_words(docs)).collect()
    assert [r.n_removed for r in words if r.text.startswith("q0 ")] == [0] and len(words) == 4
    lines = line_dedup.drop_lines(docs, line_dedup.line_bitmaps(docs, min_docs=2)).collect()
    assert {r.text: r.n_dropped for r in lines if r.text.startswith("q0 ")} == {pair.other: 0} and len(lines) == 4
    left = suffix_dedup.drop_bytes(docs, suffix_dedup.removed_bytes(docs)).collect()
    assert [r.n_removed for r in left if bytes(r.text) == pair.other.encode()] == [0] and len(left) == 4

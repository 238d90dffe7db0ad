"""The queries of the training-data operators over the test tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bartide.llm import fusion, incremental, mixing, sentences, tokens
from bartide.llm.sql import SQL
from bartide.session import work_path
from bartide.sources.tables import table


def _feed(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    sources = table(spark, sf, "feed_source")
    return fusion.records(table(spark, sf, "candle_feed"), sources), sources


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    """The record that the policy's order names. Its SQL is that order alone: the estimation of p1_fused has no part in it."""
    recs, _ = _feed(spark, sf)
    return fusion.preferred(recs).select("group_id", "field_name", "rec_id")


def p1_fused(spark: SparkSession, sf: str) -> DataFrame:
    return fusion.fuse(*_feed(spark, sf))


def p1_overruled(spark: SparkSession, sf: str) -> DataFrame:
    return fusion.overruled(*_feed(spark, sf))


def p1_sources(spark: SparkSession, sf: str) -> DataFrame:
    return fusion.source_report(*_feed(spark, sf))


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    index = incremental.build(table(spark, sf, "candle"))
    return incremental.dedup(index, table(spark, sf, "candle_batch"))


def p6_batches(spark: SparkSession, sf: str) -> DataFrame:
    """The rows of p6_found, batch by batch, the index opened again for each."""
    path = work_path(spark, "cells")
    incremental.build(table(spark, sf, "candle"), path=path)
    batches = table(spark, sf, "candle_batch")
    found = []
    for r in batches.select("batch_no").distinct().orderBy("batch_no").collect():
        rows = batches.where(F.col("batch_no").eqNullSafe(F.lit(r.batch_no)))
        found.append(incremental.dedup(incremental.CellIndex(spark, path), rows, batch=f"b{r.batch_no}"))
    return reduce(DataFrame.unionByName, found) if found else incremental.dedup(incremental.CellIndex(spark, path), batches)


def p7_ids(spark: SparkSession, sf: str) -> DataFrame:
    return tokens.encode(table(spark, sf, "documents"), "doc_id", "text")


def p7_words(spark: SparkSession, sf: str) -> DataFrame:
    counts = tokens.word_counts(table(spark, sf, "documents"), "text")
    return counts.select(F.hex("word").alias("word_hex"), "n")


def _mix(spark: SparkSession, sf: str) -> mixing.Mix:
    return mixing.Mix(table(spark, sf, "documents"), table(spark, sf, "mix_target"))


def p8_mix(spark: SparkSession, sf: str) -> DataFrame:
    return _mix(spark, sf).rows


def p8_shares(spark: SparkSession, sf: str) -> DataFrame:
    return _mix(spark, sf).report()


def p8_shortfall(spark: SparkSession, sf: str) -> DataFrame:
    """The report of a mix as large as the listed sources together: what each of them can't give to it."""
    documents, targets = table(spark, sf, "documents"), table(spark, sf, "mix_target")
    listed = documents.join(targets.select("source").distinct(), "source", "left_semi")
    total = tokens.sizes(listed, "doc_id", "text").agg(F.sum("n_tokens")).first()[0] or 0
    return mixing.Mix(documents, targets, total_tokens=total).report()


def p9_found(spark: SparkSession, sf: str) -> DataFrame:
    return sentences.split(table(spark, sf, "documents"), "doc_id", "text")


QUERIES = {
    "p1_found": p1_found,
    "p1_fused": p1_fused,
    "p1_overruled": p1_overruled,
    "p1_sources": p1_sources,
    "p6_found": p6_found,
    "p6_batches": p6_batches,
    "p7_ids": p7_ids,
    "p7_words": p7_words,
    "p8_mix": p8_mix,
    "p8_shares": p8_shares,
    "p8_shortfall": p8_shortfall,
    "p9_found": p9_found,
}

__all__ = ["QUERIES", "SQL"]

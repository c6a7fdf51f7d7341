"""Validation of generated items: findings, batches, reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import dims
from ..functions.text import has_cjk, text_key


def _finding(bad: Column, severity: str, reason: Column) -> Column:
    return F.when(F.coalesce(bad, F.lit(False)), F.struct(F.lit(severity).alias("severity"), reason.alias("reason")))


def _blank(c: str) -> Column:
    return F.coalesce(F.trim(c), F.lit("")) == ""


def item_findings(expected: Column | None = None) -> Column:
    """Array of (severity, reason) against an item's columns; expected: the label it should have (its own if none)."""
    label, tokens, context = F.col("label"), F.col("control_tokens_used"), F.col("context")
    known = F.array(*map(F.lit, dims.SCRIPT_TOKENS))
    expected = label if expected is None else expected
    single = [
        _finding(_blank("text"), "error", F.lit("missing-or-empty-text")),
        _finding(label.isNull() | (label != expected), "error", F.concat(F.lit("invalid-label:"), F.coalesce(label, F.lit("None")))),
        _finding(context.isNull() | (F.size(context) == 0) | F.exists(context, lambda e: F.coalesce(F.trim(e), F.lit("")) == ""), "error", F.lit("invalid-context")),
        _finding(_blank("persona"), "error", F.lit("missing-persona")),
        _finding(_blank("medium"), "error", F.lit("missing-medium")),
        _finding(~F.coalesce("duration_hint", F.lit("")).isin(dims.LENGTH_PROFILES), "error", F.concat(F.lit("invalid-duration-hint:"), F.coalesce("duration_hint", F.lit("None")))),
        _finding(tokens.isNull(), "error", F.lit("invalid-control-tokens")),
        _finding(has_cjk(F.col("text")), "error", F.lit("text-contains-cjk")),
    ]
    none = F.expr("cast(array() as array<struct<severity:string,reason:string>>)")
    by_token = F.transform(tokens, lambda t: F.when(~F.array_contains(known, t), F.struct(F.lit("error").alias("severity"), F.concat(F.lit("unknown-control-token:"), t).alias("reason"))).when(~F.contains(F.col("text"), t), F.struct(F.lit("warning").alias("severity"), F.concat(F.lit("token-not-present-in-text:"), t).alias("reason"))))
    by_context = F.transform(context, lambda e, i: F.when(has_cjk(e), F.struct(F.lit("warning").alias("severity"), F.concat(F.lit("context-"), i.cast("string"), F.lit("-contains-cjk")).alias("reason"))))
    return F.filter(F.concat(F.array(*single), F.coalesce(by_token, none), F.coalesce(by_context, none)), lambda f: f.isNotNull())


def findings(items: DataFrame, expected: Column | None = None) -> DataFrame:
    """index, severity, reason of every finding."""
    return items.select(F.col("idx").alias("index"), F.inline(item_findings(expected)))


def duplicates(items: DataFrame) -> DataFrame:
    """A finding for each item whose text repeats an earlier one, naming the first. Texts meet by the md5 of their key: no text is shuffled."""
    keyed = items.where(~_blank("text")).select("idx", F.unhex(F.md5(text_key(F.col("text")))).alias("key"))
    first = keyed.groupBy("key").agg(F.min("idx").alias("first"), F.count("*").alias("n")).where("n > 1")
    return keyed.join(first, "key").where("idx > first").select(F.col("idx").alias("index"), F.lit("error").alias("severity"), F.concat(F.lit("duplicate-text:matches-item-"), F.col("first").cast("string")).alias("reason"))


def batch_findings(items: DataFrame, label: str, wanted: int) -> DataFrame:
    """Findings of a batch asked for `wanted` items of one label, its shortfall (index -1) and repeats included."""
    short = items.agg(F.count("*").alias("n")).where(F.col("n") < wanted).select(F.lit(-1).cast("long").alias("index"), F.lit("error").alias("severity"), F.concat(F.lit("quota-shortfall:"), F.col("n").cast("string"), F.lit(f"/{wanted}")).alias("reason"))
    return short.union(findings(items, F.lit(label))).union(duplicates(items))


def corpus_report(items: DataFrame, wanted: int) -> DataFrame:
    """Counts by label (OK or LOW), by duration hint and by control token, in one pass over exploded facets."""
    facets = F.array(
        F.struct(F.lit("label").alias("facet"), F.col("label").alias("value")),
        F.struct(F.lit("duration_hint").alias("facet"), F.col("duration_hint").alias("value")),
    )
    tokens = F.transform(F.coalesce("control_tokens_used", F.expr("cast(array() as array<string>)")), lambda t: F.struct(F.lit("control_token").alias("facet"), t.alias("value")))
    counted = items.select(F.inline(F.concat(facets, tokens))).groupBy("facet", "value").agg(F.count("*").alias("n"))
    return counted.withColumn("state", F.when(F.col("facet") == "label", F.when(F.col("n") >= wanted, "OK").otherwise("LOW")).otherwise(""))

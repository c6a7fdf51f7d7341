"""Weak labels: tag scoring, capped acceptance, counts and quotas."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import dims
from ..functions.text import clean_tags, tag_text


def tag_scores(tags: Column) -> dict[str, Column]:
    """Per label: 3 for each tag that is a signal, 1 for each signal that a tag holds as whole words."""
    padded = F.transform(F.filter(F.transform(clean_tags(tags), tag_text), lambda t: t != ""), lambda t: F.concat(F.lit(" "), t, F.lit(" ")))

    def score(signals: list[str]) -> Column:
        known = F.array(*[F.lit(f" {s} ") for s in signals])
        return F.aggregate(padded, F.lit(0), lambda a, t: a + F.when(F.array_contains(known, t), 2).otherwise(0) + F.size(F.filter(known, lambda s: F.contains(t, s))))

    return {label: score(signals) for label, signals in dims.TAG_SIGNALS.items()}


def classify(tags: Column) -> Column:
    """The label of greatest score, ties by priority; neutral without any signal."""
    scores = tag_scores(tags)
    best = F.greatest(*scores.values())
    out = F.when(best <= 0, "neutral")
    for label in dims.LABEL_PRIORITY:
        out = out.when(scores[label] == best, label)
    return out.otherwise("neutral")


def page_label(tags: Column, seed: Column) -> Column:
    """A page without tags keeps the label it was found under."""
    return F.when(F.size(tags) > 0, classify(tags)).otherwise(seed)


def label_counts(rows: DataFrame, label: Column, domain: list[str] = dims.LABELS) -> DataFrame:
    """Rows per label of the domain, zeros included."""
    known = rows.sparkSession.createDataFrame([(k, v) for k, v in enumerate(domain)], "ord int, label string")
    counted = rows.select(label.alias("label")).groupBy("label").count()
    return known.join(counted, "label", "left").select("ord", "label", F.coalesce("count", F.lit(0)).alias("n"))


def remaining(counts: DataFrame, target: int) -> DataFrame:
    return counts.select("ord", "label", "n", F.greatest(F.lit(target) - F.col("n"), F.lit(0)).alias("remaining"))


def first_by(rows: DataFrame, key: str, order: str, last: bool = False) -> DataFrame:
    """One row per key, the first in order (or the last): a partial aggregate, no sort of a hot key's rows."""
    row = F.struct(*[F.col(c) for c in rows.columns])
    pick = (F.max_by if last else F.min_by)(row, F.col(order))
    return rows.groupBy(F.col(key).alias("_key")).agg(pick.alias("_row")).select("_row.*")


def accept_capped(rows: DataFrame, caps: dict[str, int]) -> DataFrame:
    """Greedy acceptance in order: a row goes in unless its url is in already or its label is full.

    rows: url, label, ord (unique). A url passed over because its label was full may come in later under another.
    Exact in at most one round per label: with the labels still open, the first of each url counts; the label that fills up
    first is frozen at that place, and the round is repeated. Each round reads one row per label.
    """
    full: dict[str, int] = {label: -1 for label, cap in caps.items() if cap <= 0}
    rows = rows.where(F.col("label").isin(list(caps)))
    while True:
        alive = reduce(lambda a, b: a & b, [(F.col("label") != label) | (F.col("ord") <= upto) for label, upto in full.items()], F.lit(True))
        firsts = first_by(rows.where(alive), "url", "ord")
        open_caps = {label: cap for label, cap in caps.items() if label not in full}
        if not open_caps:
            return firsts
        numbered = firsts.where(F.col("label").isin(list(open_caps))).withColumn("_n", F.row_number().over(Window.partitionBy("label").orderBy("ord"))).where(F.col("_n") <= max(open_caps.values()))
        at_cap = reduce(lambda a, b: a | b, [(F.col("label") == label) & (F.col("_n") == cap) for label, cap in open_caps.items()])
        filled = numbered.where(at_cap).orderBy("ord").select("label", "ord").head(1)
        if not filled:
            return firsts
        full[filled[0]["label"]] = filled[0]["ord"]


def cap_by(rows: DataFrame, key: str, order: str, k: int) -> DataFrame:
    """The first k rows of each key; Spark prunes groups before it sorts them."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(order))).where(F.col("_n") <= k).drop("_n")

"""Queries of paths, names, order, heads and configuration tables, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import audio, labels, results
from ..streaming import incremental
from .queries import V, sql_draw
from .views import table, view

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str) -> Callable:
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[f.__name__], ORACLES[f.__name__] = f, sql
        return f

    return add


NAMED = "case ord % 5 when 0 then '' when 1 then concat('/abs/', filename) when 2 then concat(' ', filename) else filename end"


@query(f"select ord, case when trim({NAMED}) = '' then null when starts_with(trim({NAMED}), '/') then trim({NAMED}) else '/data/set/' || trim({NAMED}) end as path from {V('v_media')}")
def resolve_paths(spark, d):
    return view(spark, d, "v_media").select("ord", results.resolved_path(F.expr(NAMED), "/data/set/").alias("path"))


@query(f"select ord, 'm' || (ord % 700) || case when n = 1 then '' else '-' || (n - 1) end || '.mp4' as name from (select ord, row_number() over (partition by ord % 700 order by ord) as n from {V('v_media')})")
def download_names(spark, d):
    rows = view(spark, d, "v_media").select("ord", F.expr("concat('m', cast(ord % 700 as string))").alias("id"), F.lit("mp4").alias("ext"))
    return results.download_names(rows, "id", "ext", "ord").select("ord", "name")


SIZE = "((ord * 7919) % 400000000 + 12345)"


@query(f"select ord, case when {SIZE} / 1048576.0 < 5 then format('file too small: {{:.2f}} MB < 5.00 MB', {SIZE} / 1048576.0::double) when {SIZE} / 1048576.0 > 200 then format('file too large: {{:.2f}} MB > 200.00 MB', {SIZE} / 1048576.0::double) end as reason from {V('v_media')}")
def size_reasons(spark, d):
    return view(spark, d, "v_media").select("ord", results.size_reason(F.expr(SIZE), 5.0, 200.0).alias("reason"))


@query(f"with f as (select 'raw/f' || page_id || '.wav' as path, length(html) as n from pages) select ord, filename, f.path is not null as file_exists, f.n as file_size_bytes from {V('v_media')} left join f on filename = path")
def file_listing(spark, d):
    files = table(spark, d, "pages").select(F.format_string("raw/f%d.wav", "page_id").alias("path"), F.length("html").cast("long").alias("length"))
    rows = view(spark, d, "v_media").select("ord", "filename")
    return results.with_files(rows, files, "filename").select("ord", "filename", "file_exists", "file_size_bytes")


@query(f"select i.ord, i.k, r.title from (select ord, k from {V('v_urls')}) i join (select k, 't' || max(ord) as title from {V('v_urls')} where k % 3 = 0 group by k) r using (k)")
def results_in_order(spark, d):
    """Every input row with the result of its key, repeated inputs included, ready to be written in input order."""
    rows = view(spark, d, "v_urls").select("ord", "k")
    found = rows.where("k % 3 = 0").groupBy("k").agg(F.concat(F.lit("t"), F.max("ord").cast("string")).alias("title"))
    return results.in_input_order(rows, found, "k", "ord").select("ord", "k", "title")


@query(f"with e as (select weak_label, ord, 'e' || ord as error, row_number() over (partition by weak_label order by ord) as n from {V('v_media')} where status = 'failed') select weak_label, string_agg(error, ', ' order by ord) as message from e where n <= 5 group by weak_label")
def error_samples(spark, d):
    rows = view(spark, d, "v_media").where("status = 'failed'").select("weak_label", "ord", F.concat(F.lit("e"), F.col("ord").cast("string")).alias("error"))
    return results.error_samples(rows, "weak_label", "ord", "error", 5)


@query("select doc_id, row_number() over (order by doc_id) - 1 as idx from documents where lang <> 'en'")
def ordinals(spark, d):
    return results.numbered(table(spark, d, "documents").where("lang <> 'en'").select("doc_id"), "doc_id").select("doc_id", "idx")


@query("select source, doc_id from (select source, doc_id, row_number() over (partition by source order by doc_id) as n from documents) where n <= 3")
def feed_heads(spark, d):
    """The share of each of twenty feeds in a pool of forty."""
    return labels.cap_by(table(spark, d, "documents").select("source", "doc_id"), "source", "doc_id", results.feed_share(40, 20))


@query(f"select doc_id from documents order by {sql_draw('doc_id || ' + chr(39) + ':3' + chr(39))}, doc_id limit 40")
def pool_shuffle(spark, d):
    """The head of a seeded shuffle."""
    return results.shuffled_first(table(spark, d, "documents").select("doc_id"), "doc_id", 3, 40)


REMAINING = "case label when 'fitnah' then 2 when 'disinformasi' then 9 when 'neutral' then 0 else 4 end"


@query(f"select ord, label from (select ord, label, {REMAINING} as r, row_number() over (partition by label order by ord) as n from {V('v_urls')}) where r > 0 and n <= greatest(3 * r, 10)")
def article_heads(spark, d):
    """Jobs of the labels that still need rows, three times as many, ten at least."""
    jobs = view(spark, d, "v_urls").select("ord", "label")
    open_ = jobs.select("label").distinct().withColumn("remaining", F.expr(REMAINING))
    return results.needed_jobs(jobs, open_, "ord").select("ord", "label")


@query("select kind, parameter, low, high from (values ('noise_brown', 'level', 0.02, 0.08), ('noise_pink', 'level', 0.02, 0.08), ('noise_white', 'level', 0.002, 0.008), ('pitch_down', 'n_steps', -4.0, -2.0), ('pitch_up', 'n_steps', 2.0, 4.0), ('speed_down', 'rate', 0.75, 0.875), ('speed_up', 'rate', 1.125, 1.25), ('volume_down', 'level', 0.5, 0.75), ('volume_up', 'level', 1.25, 1.5)) as t(kind, parameter, low, high)".replace("low, high from", "round(low::double, 6) as low, round(high::double, 6) as high from", 1))
def derived_ranges(spark, d):
    made = audio.derived_ranges((2.0, 4.0), (1.125, 1.25), (1.25, 1.5), (0.002, 0.008))
    return spark.createDataFrame([(k, p, round(low, 6), round(high, 6)) for k, own in made.items() for p, (low, high) in own.items()], "kind string, parameter string, low double, high double")


@query("with s as (select event_type, ts, value, unnest([0, 1]) as k from events), w as (select event_type, value, time_bucket(interval '30 minutes', ts::timestamp) - k * interval '30 minutes' as start from s) select event_type, start, count(*) as n, round(sum(value), 4) as total from w group by event_type, start")
def sliding_windows(spark, d):
    """Hourly windows every half hour."""
    found = incremental.sliding(table(spark, d, "events"))
    return found.select("event_type", "start", "n", F.round("total", 4).alias("total"))


@query("with o as (select event_type, ts::timestamp as ts, case when ts::timestamp - lag(ts::timestamp) over (partition by event_type order by ts) < interval '2 minutes' then 0 else 1 end as new from events), s as (select event_type, ts, sum(new) over (partition by event_type order by ts rows unbounded preceding) as k from o) select event_type, min(ts) as start, count(*) as n from s group by event_type, k")
def session_windows(spark, d):
    """Events of a type that follow within two minutes."""
    return incremental.sessions(table(spark, d, "events"), gap="2 minutes").select("event_type", "start", "n")


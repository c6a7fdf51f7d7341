"""Registered queries over the test tables, each with the SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import dims
from ..functions import extract, sampling, signal, text, urls
from ..operators import audio, gates, labels, validate, windows
from .views import VIEWS, table, view

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def V(name: str) -> str:  # noqa: N802
    return f"({VIEWS[name]}) {name}"


def sql_list(values: list[str]) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def sql_draw(key: str) -> str:
    return f"cast('0x' || substring(md5({key}), 1, 8) as bigint)"


HOST = r"regexp_replace(lower(regexp_extract({0}, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)), '^www\.', '')"


def sql_platform(host: str, column: int, other: str) -> str:
    return "case " + " ".join(f"when contains({host}, '{p[0]}') then '{p[column]}'" for p in dims.PLATFORMS) + f" else '{other}' end"


def sql_absolute(h: str, base: str) -> str:
    root, page = rf"regexp_extract({base}, '^([^:]+://[^/?#]*)', 1)", rf"regexp_extract({base}, '^([^?#]*)', 1)"
    return rf"case when regexp_matches({h}, '^[A-Za-z][A-Za-z0-9+.-]*:') then {h} when starts_with({h}, '//') then regexp_extract({base}, '^([^:]+:)', 1) || {h} when starts_with({h}, '/') then {root} || {h} when starts_with({h}, '?') then {page} || {h} when starts_with({h}, '#') then regexp_extract({base}, '^([^#]*)', 1) || {h} when {page} = {root} then {root} || '/' || {h} else regexp_replace({page}, '[^/]*$', '') || {h} end"


def sql_canonical(u: str) -> str:
    def q(p: str) -> str:
        return p.replace("'", "''")

    def full(p: str, prefix: str) -> str:
        m = f"regexp_extract({u}, '{q(p)}', 1)"
        bare = rf"regexp_replace({m}, '^(?:www\.)?', '')" if prefix.endswith("www.") else m
        return f"when {m} <> '' then split_part(case when starts_with({m}, 'http') then {m} else '{prefix}' || {bare} end, '?', 1)"

    def ident(p: str, before: str, after: str = "") -> str:
        m = f"regexp_extract({u}, '{q(p)}', 1)"
        return f"when {m} <> '' then '{before}' || {m} || '{after}'"

    return " ".join(["case", ident(urls.YOUTUBE, "https://www.youtube.com/watch?v="), full(urls.TIKTOK, "https://www."), full(urls.TIKTOK_SHORT, "https://"), full(urls.FB_WATCH, "https://"), ident(urls.FB_VIDEO, "https://www.facebook.com/watch?v="), ident(urls.INSTAGRAM, "https://www.instagram.com/", "/"), ident(urls.TWEET, "https://x.com/i/web/status/"), f"else split_part({u}, '?', 1) end"])


CANON = f"(select ord, k, label, raw_url, {sql_canonical('trim(raw_url)')} as url from {V('v_urls')})"
HREFS = r"""(select page_id, url, unnest(regexp_extract_all(html, '<a[^>]+href=["'']([^"'']+)["'']', 1)) as href from pages)"""


def canon(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, "v_urls").withColumn("url", urls.canonical(F.col("raw_url")))


# --- pages and addresses ----------------------------------------------------------------------------------------------


def page_links(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "pages")
    return p.select("page_id", F.col("url").alias("base"), F.explode(extract.hrefs(F.col("html"), F.col("url"))).alias("link"))


@query(f"select page_id, href from {HREFS}")
def page_hrefs(spark, d):
    return table(spark, d, "pages").select("page_id", F.explode(F.regexp_extract_all("html", F.lit(extract.ANCHOR), F.lit(1))).alias("href"))


@query(f"select page_id, {sql_absolute('href', 'url')} as link from {HREFS}")
def page_links_absolute(spark, d):
    return page_links(spark, d).select("page_id", "link")


@query(f"with l as (select distinct {sql_absolute('href', 'url')} as link from {HREFS}), h as (select link, {HOST.format('link')} as host from l) select {sql_platform('host', 1, 'unknown')} as platform, host, count(*) as links, min(substring(md5(link), 1, 16)) as first_id from h group by all")
def page_hosts_platform(spark, d):
    links = page_links(spark, d).select("link").distinct()
    return links.select(urls.platform(F.col("link")).alias("platform"), urls.host(F.col("link")).alias("host"), urls.record_id(F.col("link")).alias("id")).groupBy("platform", "host").agg(F.count("*").alias("links"), F.min("id").alias("first_id"))


@query("select page_id, substring(md5(url), 1, 16) as id, substring(sha1(url), 1, 10) as media_id from pages")
def record_ids(spark, d):
    return table(spark, d, "pages").select("page_id", urls.record_id(F.col("url")).alias("id"), urls.media_id(F.col("url")).alias("media_id"))


@query(f"select ord, raw_url, url from {CANON}")
def url_canonical(spark, d):
    return canon(spark, d).select("ord", "raw_url", "url")


IDS_SQL = " ".join(f"when regexp_extract(url, '{p}', 1) <> '' then regexp_extract(url, '{p}', 1)" for p in urls.IDS)


@query(f"select ord, url, case {IDS_SQL} end as video_id from {CANON}")
def url_video_id(spark, d):
    return canon(spark, d).select("ord", "url", urls.video_id(F.col("url")).alias("video_id"))


URL_PATH = r"regexp_extract(url, '^[^:]+://[^/?#]*([^?#]*)', 1)"


@query(rf"select ord, url, regexp_extract(url, '{urls.PARTS}', 1) <> '' and not contains(lower({URL_PATH}), 'login') and (not (contains(lower(regexp_extract(url, '{urls.PARTS}', 1)), 'facebook.com') and rtrim({URL_PATH}, '/') = '/watch') or regexp_matches(regexp_extract(url, '^[^?#]*\?([^#]*)', 1), '(?:^|[?&])v=\d+')) as valid from {CANON}")
def url_valid(spark, d):
    return canon(spark, d).select("ord", "url", urls.is_valid(F.col("url")).alias("valid"))


@query(f"select ord, {sql_platform(HOST.format('url'), 1, 'unknown')} as platform, {sql_platform(HOST.format('url'), 2, 'Unknown')} as display from {CANON}")
def url_platform_display(spark, d):
    return canon(spark, d).select("ord", urls.platform(F.col("url")).alias("platform"), urls.platform(F.col("url"), display=True).alias("display"))


@query("select page_id, n, case when n = 1 then url when page_id % 2 = 0 then url || case when contains(url, '?') then '&' else '?' end || 'page=' || n else rtrim(url, '/') || '/' || n end as page_url from pages, (select unnest([1, 2, 3]) as n)")
def page_url_build(spark, d):
    p = table(spark, d, "pages").withColumn("n", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))))
    return p.select("page_id", "n", F.when(F.col("page_id") % 2 == 0, urls.page_url(F.col("url"), F.col("n"), "query")).otherwise(urls.page_url(F.col("url"), F.col("n"), "path")).alias("page_url"))


QUOTED = "replace(url_encode({0}), '%20', '+')"


@query(f"select distinct label, platform, 'search:' || platform || ':' || topic as keyword, 'https://example.org/search?site=' || platform || '&q=' || {QUOTED.format('topic')} as url from (select unnest({sql_list(dims.LABELS)}) as label), (select unnest(['youtube', 'tiktok', 'instagram']) as platform), (select distinct 'topik ' || source || ' ~1*' as topic from documents)")
def search_jobs(spark, d):
    """Labels x platforms x topics: two fixed lists are exploded beside the topics, nothing is joined."""
    topics = table(spark, d, "documents").select(F.concat(F.lit("topik "), "source", F.lit(" ~1*")).alias("topic")).distinct()
    jobs = topics.withColumn("label", F.explode(F.array(*map(F.lit, dims.LABELS)))).withColumn("platform", F.explode(F.array(*map(F.lit, ["youtube", "tiktok", "instagram"]))))
    return jobs.select("label", "platform", text.search_keyword(F.col("platform"), F.col("topic")).alias("keyword"), F.concat(F.lit("https://example.org/search?site="), "platform", F.lit("&q="), urls.quote_plus(F.col("topic"))).alias("url")).distinct()


VIDEO_PAGE = "concat(html, '<a href=\"', raw_url, '\">x</a> \"videoId\":\"', substring(md5(url), 1, 11), '\" /url?url=', replace(replace(raw_url, ':', '%3A'), '/', '%2F'), '&x ')"


def _pages_with_videos(spark, d):
    joined = table(spark, d, "pages").join(view(spark, d, "v_urls").select(F.col("ord").alias("page_id"), "raw_url"), "page_id")
    return joined.select("page_id", "url", F.expr(VIDEO_PAGE.replace("'\"videoId", "'\"videoId")).alias("html"))


def _sql_videos() -> str:
    def q(p: str) -> str:
        return p.replace("'", "''")

    parts = [f"select page_id, '{before}' || unnest(regexp_extract_all(html, '{q(p)}', 1)) as u from p" for p, before in extract.IDS]
    parts += [f"select page_id, {sql_canonical('u')} as u from (select page_id, unnest(regexp_extract_all(html, '{q(p)}', 1)) as u from p)" for p in extract.ADDRESSES]
    raw = [f"select page_id, url_decode(unnest(regexp_extract_all(html, '{q(extract.REDIRECT)}', 1))) as u from p", f"select page_id, unnest(regexp_extract_all(html, '{q(extract.DIRECT)}', 1)) as u from p", f"select page_id, {sql_absolute('h', 'url')} as u from (select page_id, url, unnest(regexp_extract_all(html, '{q(extract.ANCHOR)}', 1)) as h from p)"]
    parts += [f"select page_id, {sql_canonical('trim(u)')} as u from ({r}) where regexp_matches(u, '{q(urls.VIDEO)}')" for r in raw]
    return f"with p as (select page_id, url, {VIDEO_PAGE} as html from pages join (select ord, raw_url from {V('v_urls')}) v on v.ord = page_id) select distinct page_id, u as video_url from ({' union all '.join(parts)})"


@query(_sql_videos())
def extract_video_urls(spark, d):
    return _pages_with_videos(spark, d).select("page_id", F.explode(extract.video_urls(F.col("html"), F.col("url"))).alias("video_url"))


BLOCK_PAGE = "concat('<p>Narasi: <a href=\"', raw_url, '\">s</a> Penjelasan <a href=\"https://youtu.be/aaaaaaaaaaa\">o</a>')"


@query(f"""with p as (select page_id, {BLOCK_PAGE} as html from pages join (select ord, raw_url from {V('v_urls')}) v on v.ord = page_id),
b as (select page_id, unnest(regexp_extract_all(regexp_extract(html, '(?is)Narasi(.*?)(?:Penjelasan|Kesimpulan|Hasil Periksa fakta)', 1), '<a[^>]+href=["'']([^"'']+)["'']', 1)) as u from p),
f as (select page_id, {sql_canonical('trim(u)')} as video_url from b where regexp_matches(u, '{extract.SOURCE_VIDEO}'))
select distinct page_id, video_url from f union select page_id, 'https://www.youtube.com/watch?v=aaaaaaaaaaa' from p where page_id not in (select page_id from f)
union select page_id, 'https://' || regexp_extract(html, 'fb\\.watch/[^"''>\\s/]+/?') from p where contains(html, 'fb.watch/') and page_id not in (select page_id from f)""")
def extract_preferred(spark, d):
    joined = table(spark, d, "pages").join(view(spark, d, "v_urls").select(F.col("ord").alias("page_id"), "raw_url"), "page_id").select("page_id", F.expr(BLOCK_PAGE).alias("html"))
    return joined.select("page_id", F.explode(extract.page_video_urls(F.col("html"), F.lit("https://turnbackhoax.id/a/"))).alias("video_url"))


@query(rf"with l as (select distinct page_id, {sql_absolute('href', 'url')} as link from {HREFS}) select link, min(page_id) as page_id from l where not (contains(link, '/tag/') or contains(link, '/search/') or contains(link, '/infografis/') or contains(link, '/foto/')) group by link")
def article_jobs(spark, d):
    links = page_links(spark, d).where(~extract.skipped(F.col("link"), "cnnindonesia"))
    return links.groupBy("link").agg(F.min("page_id").alias("page_id"))


@query(r"""select page_id, trim(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'), '\s+', ' ', 'g')) as text from pages""")
def html_to_text(spark, d):
    return table(spark, d, "pages").select("page_id", text.html_text(F.col("html")).alias("text"))


TAG_PAGE = "concat('<a href=\"https://www.detik.com/tag/cek-fakta\"><a href=\"https://x.kompas.com/tag/hate-speech%20a\"><a href=\"https://www.detik.com/tag/t', cast(page_id % 9 as string), '-b\">')"


@query(f"""select page_id, 'detik' as site, replace(unnest(regexp_extract_all({TAG_PAGE}, 'href="https://[^"]*detik\\.com/tag/([^"]+)"', 1)), '-', ' ') as tag from pages union all select page_id, 'kompas', replace(replace(unnest(regexp_extract_all({TAG_PAGE}, 'href="https://[^"]*kompas\\.com/tag/([^"]+)"', 1)), '-', ' '), '%20', ' ') from pages""")
def site_tags(spark, d):
    p = table(spark, d, "pages").select("page_id", F.expr(TAG_PAGE).alias("html"))
    return p.select("page_id", F.lit("detik").alias("site"), F.explode(extract.site_tags(F.col("html"), "detik")).alias("tag")).union(p.select("page_id", F.lit("kompas"), F.explode(extract.site_tags(F.col("html"), "kompas"))))


# --- tags and text ------------------------------------------------------------------------------------------------------

CLEAN = rf"(select doc_id, list_filter(c, lambda x, i: list_position(list_transform(c, lambda y: lower(y)), lower(x)) = i) as c from (select doc_id, list_filter(list_transform(tags, lambda t: trim(regexp_replace(t, '\s+', ' ', 'g'), ' -_,:/')), lambda t: t <> '') as c from {V('v_tags')}))"
NORM = r"trim(regexp_replace(regexp_replace(translate(replace(lower({0}), '%20', ' '), '-_', '  '), '[^a-z0-9\s]', '', 'g'), '\s+', ' ', 'g'))"
KEYWORD = "case when len(c) > 0 then substring('tag:' || array_to_string(c, ','), 1, 120) else '' end"


@query(f"select doc_id, array_to_string(c, '|') as tags from {CLEAN}")
def tags_clean(spark, d):
    return view(spark, d, "v_tags").select("doc_id", F.array_join(text.clean_tags(F.col("tags")), "|").alias("tags"))


@query(f"select doc_id, array_to_string(list_transform(c, lambda t: {NORM.format('t')}), '|') as tags from {CLEAN}")
def tags_norm(spark, d):
    return view(spark, d, "v_tags").select("doc_id", F.array_join(F.transform(text.clean_tags(F.col("tags")), text.tag_text), "|").alias("tags"))


@query(f"select doc_id, coalesce(nullif({KEYWORD}, ''), 'seed:x') as keyword from {CLEAN}")
def keyword_from_tags(spark, d):
    return view(spark, d, "v_tags").select("doc_id", F.coalesce(F.nullif(text.tag_keyword(F.col("tags")), F.lit("")), F.lit("seed:x")).alias("keyword"))


PATHS = "case page_id % 4 when 0 then '/tag/cek-fakta' when 1 then concat('/list?category=c', cast(page_id as string)) when 2 then '/' else concat('/a/some-slug-', cast(page_id as string)) end"


@query("select page_id, case page_id % 4 when 0 then 'tag:cek fakta' when 1 then 'category:c' || page_id when 2 then 'seed:fitnah' else 'seed:some slug ' || page_id end as keyword from pages")
def seed_keyword(spark, d):
    return table(spark, d, "pages").select("page_id", text.seed_keyword(F.expr(PATHS), F.lit("fitnah")).alias("keyword"))


def _sql_score(label: str) -> str:
    known = sql_list([f" {s} " for s in dims.TAG_SIGNALS[label]])
    return f"coalesce(list_sum(list_transform(p, lambda t: case when list_contains({known}, t) then 2 else 0 end + len(list_filter({known}, lambda s: contains(t, s))))), 0)"


SCORED = f"(select doc_id, {', '.join(f'{_sql_score(label)} as s{k}' for k, label in enumerate(dims.LABEL_PRIORITY))} from (select doc_id, list_transform(list_filter(list_transform(c, lambda t: {NORM.format('t')}), lambda t: t <> ''), lambda t: ' ' || t || ' ') as p from {CLEAN}))"
CLASS = "case when greatest(s0, s1, s2) <= 0 then 'neutral' " + " ".join(f"when s{k} = greatest(s0, s1, s2) then '{label}'" for k, label in enumerate(dims.LABEL_PRIORITY)) + " end"


@query(f"select doc_id, {CLASS} as label from {SCORED}")
def classify_tags(spark, d):
    return view(spark, d, "v_tags").select("doc_id", labels.page_label(F.col("tags"), F.lit("neutral")).alias("label"))


@query(r"with r as (select lang, doc_id, text, row_number() over (partition by lang order by doc_id) as n from documents) select doc_id, rtrim(trim('T' || doc_id || '. ' || substring(text, 1, 120)), '.') as snippet from r where n <= 50")
def headline_snippets(spark, d):
    top = labels.cap_by(table(spark, d, "documents"), "lang", "doc_id", 50)
    return top.select("doc_id", text.snippet(F.concat(F.lit("T"), F.col("doc_id").cast("string")), F.col("text")).alias("snippet"))


KEY = r"replace(lower(trim(regexp_replace({0}, '\s+', ' ', 'g'))), 'ß', 'ss')"


@query(f"with k as (select doc_id, {KEY.format('text')} as k from documents), f as (select k, min(doc_id) as first from k group by k) select doc_id as index, 'duplicate-text:matches-item-' || first as reason from k join f using (k) where doc_id > first")
def text_key_dups(spark, d):
    items = table(spark, d, "documents").select(F.col("doc_id").alias("idx"), "text")
    return validate.duplicates(items).select("index", "reason")


CJK_SQL = r"[\x{3400}-\x{4dbf}\x{4e00}-\x{9fff}\x{f900}-\x{faff}]"


@query(f"select idx, regexp_matches(text, '{CJK_SQL}') as cjk from {V('v_items')}")
def cjk_flags(spark, d):
    return view(spark, d, "v_items").select("idx", text.has_cjk(F.col("text")).alias("cjk"))


SPOKEN = r"trim(regexp_replace(replace(regexp_replace(replace(trim(regexp_replace(text, '\s+', ' ', 'g')), '[sigh]', '<sigh>'), '\[[^\]]+\]', ' ', 'g'), '<sigh>', '[sigh]'), '\s+', ' ', 'g'))"


@query(f"select idx, case when not regexp_matches(text, '{CJK_SQL}') and {SPOKEN} <> '' then {SPOKEN} end as spoken from {V('v_items')}")
def tts_sanitize(spark, d):
    return view(spark, d, "v_items").select("idx", text.speech_text(F.col("text")).alias("spoken"))


MESSAGES = "concat(case doc_id % 6 when 0 then 'I cannot do that' when 1 then '[{\"a\": \"violates\"}]' when 2 then 'This Violates rules' when 3 then 'HTTP Error 429: Too Many' when 4 then 'Sign in to confirm you are' else 'ERROR: Unsupported URL' end, ' ', cast(doc_id as string))"


@query(f"select doc_id, not starts_with(l, '[') and len(list_filter({sql_list(dims.REFUSALS)}, lambda s: contains(l, s))) > 0 as refusal from (select doc_id, lower(trim({MESSAGES})) as l from documents)")
def refusal_flags(spark, d):
    return table(spark, d, "documents").select("doc_id", text.is_refusal(F.expr(MESSAGES)).alias("refusal"))


def _has(tokens: list[str]) -> str:
    return f"len(list_filter({sql_list(tokens)}, lambda s: contains(l, s))) > 0"


@query(f"select doc_id, case when {_has(dims.SKIP_ERRORS)} then 'skipped' when {_has(dims.LOGIN_ERRORS)} then 'needs-login' when {_has(dims.THROTTLE_ERRORS)} then 'throttled' else 'retryable' end as status from (select doc_id, lower({MESSAGES}) as l from documents)")
def error_status(spark, d):
    return table(spark, d, "documents").select("doc_id", text.error_status(F.expr(MESSAGES)).alias("status"))


@query("select event_id, case when event_id % 10 = 0 then null when x > 300 then 'duration ' || x || 's exceeds max 300s' when x < 5 then 'duration ' || x || 's below min 5s' end as reason from (select event_id, cast(floor(value) as integer) as x from events)")
def duration_gate(spark, d):
    seconds = F.when(F.col("event_id") % 10 != 0, F.floor("value").cast("int"))
    return table(spark, d, "events").select("event_id", gates.duration_reason(seconds, 5, 300).alias("reason"))


@query("select idx, case label when 'disinformasi' then 'kategori_A' when 'fitnah' then 'kategori_B' when 'ujaran_kebencian' then 'kategori_C' when 'neutral' then 'kategori_D' else label end as alias, label as back from " + V("v_items"))
def label_alias(spark, d):
    alias = text.label_alias(F.col("label"))
    return view(spark, d, "v_items").select("idx", alias.alias("alias"), text.label_alias(alias, inverse=True).alias("back"))


# --- labels and acceptance ----------------------------------------------------------------------------------------------

COUNTS = f"(select l.ord, l.label, count(v.ord) as n from (select unnest(range(0, 4)) as ord, unnest({sql_list(dims.LABELS)}) as label) l left join {CANON} v on v.label = l.label group by all)"


@query(f"select cast(ord as integer) as ord, label, n from {COUNTS}")
def label_counts(spark, d):
    return labels.label_counts(canon(spark, d), F.col("label"))


@query(f"select cast(ord as integer) as ord, label, n, greatest(600 - n, 0) as remaining from {COUNTS}")
def label_remaining(spark, d):
    return labels.remaining(label_counts(spark, d), 600)


@query(f"select coalesce(label, 'TOTAL') as label, cast(sum(n) as bigint) as n, case when label is null then '' when sum(n) >= 600 then 'OK' else 'SHORT by ' || cast(600 - sum(n) as bigint) end as state from {COUNTS} group by rollup (label)")
def label_summary(spark, d):
    n = label_counts(spark, d).rollup("label").agg(F.sum("n").alias("n"))
    return n.select(F.coalesce("label", F.lit("TOTAL")).alias("label"), "n", F.when(F.col("label").isNull(), "").when(F.col("n") >= 600, "OK").otherwise(F.concat(F.lit("SHORT by "), (600 - F.col("n")).cast("string"))).alias("state"))


@query(f"select min(ord) as ord, url from {CANON} group by url")
def accept_first_wins(spark, d):
    return labels.first_by(canon(spark, d).select("ord", "url", "label"), "url", "ord").select("ord", "url")


@query(f"select max(ord) as ord, url from {CANON} group by url")
def accept_last_wins(spark, d):
    return labels.first_by(canon(spark, d).select("ord", "url", "label"), "url", "ord", last=True).select("ord", "url")


CAPS = {"ujaran kebencian": 12, "fitnah": 20, "disinformasi": 15, "neutral": 0}
CAP_LABEL = "case ord % 7 when 0 then 'ujaran kebencian' when 1 then 'fitnah' when 2 then 'disinformasi' when 3 then 'neutral' when 4 then 'fitnah' else 'disinformasi' end"


def _sql_capped() -> str:
    caps = ", ".join(f"('{k}', {v})" for k, v in CAPS.items())
    out = f"with r as (select ord, url, {CAP_LABEL} as label from {CANON}), caps(label, cap) as (values {caps}), cut0 as (select label, -1 as upto from caps where cap <= 0)"
    for k in range(len(CAPS) + 1):
        out += f", f{k} as (select arg_min(label, ord) as label, url, min(ord) as ord from (select r.* from r left join cut{k} c using (label) where c.upto is null or r.ord <= c.upto) group by url)"
        out += f", n{k} as (select *, row_number() over (partition by label order by ord) as n from f{k})"
        out += f", cut{k + 1} as (select * from cut{k} union all (select label, ord from n{k} join caps using (label) where n = cap and label not in (select label from cut{k}) order by ord limit 1))"
    return out + f" select ord, url, label from f{len(CAPS)}"


@query(_sql_capped())
def accept_capped(spark, d):
    rows = canon(spark, d).select("ord", "url", F.expr(CAP_LABEL).alias("label"))
    return labels.accept_capped(rows, CAPS).select("ord", "url", "label")


@query(f"select ord, label from (select ord, label, row_number() over (partition by label order by ord) as n from {V('v_urls')}) where n <= 40")
def label_cap(spark, d):
    return labels.cap_by(view(spark, d, "v_urls").select("ord", "label"), "label", "ord", 40)


@query(f"with m as (select filename, max(status) as s, max(case when status = 'ok' then 1 else 0 end) as done from {V('v_media')} where ord % 3 = 0 group by filename) select v_media.ord, v_media.filename, case when m.s is null then 'new' else 'retry' end as queue from {V('v_media')} left join m using (filename) where coalesce(done, 0) = 0")
def resume_plan(spark, d):
    """What is done is left out, what failed is queued again, behind what is new."""
    media = view(spark, d, "v_media")
    before = media.where("ord % 3 = 0")
    done, failed = before.where("status = 'ok'").select("filename").distinct(), before.where("status <> 'ok'").select("filename").distinct()
    todo = media.select("ord", "filename").join(done, "filename", "left_anti")
    return todo.join(failed, "filename", "left_anti").select("ord", "filename", F.lit("new").alias("queue")).union(todo.join(failed, "filename", "left_semi").select("ord", "filename", F.lit("retry")))


@query(f"select idx, format('audio/{{:06d}}.wav', idx) as audio from {V('v_items')} where idx % 3 <> 0")
def resume_tts(spark, d):
    items = view(spark, d, "v_items").select("idx", F.format_string("audio/%06d.wav", "idx").alias("audio"))
    return items.join(items.where("idx % 3 = 0").select("audio"), "audio", "left_anti").select("idx", "audio")


STEMS = "concat(substring(md5(cast(page_id % 100 as string)), 1, 8), case page_id % 3 when 0 then '' when 1 then '-x' else '_chunk001' end)"


@query(f"select u.id, min(s.stem) as stem from (select distinct substring(md5(cast(page_id % 100 as string)), 1, 8) as id from pages) u join (select {STEMS} as stem from pages) s on s.stem = u.id or starts_with(s.stem, u.id || '-') or starts_with(s.stem, u.id || '_chunk') group by u.id")
def regenerate_match(spark, d):
    """Prefix join as an equi-join: every stem offers each of its prefixes that end before a dash, and before _chunk."""
    p = table(spark, d, "pages")
    ids = p.select(F.expr("substring(md5(cast(page_id % 100 as string)), 1, 8)").alias("id")).distinct()
    stems = p.select(F.expr(STEMS).alias("stem")).distinct()
    dashes = F.expr("transform(sequence(1, size(split(stem, '-'))), k -> substring_index(stem, '-', k))")
    keys = stems.select("stem", F.explode(F.array_distinct(F.concat(dashes, F.array(F.regexp_replace("stem", r"_chunk\d+$", ""))))).alias("id"))
    return keys.join(ids, "id").groupBy("id").agg(F.min("stem").alias("stem"))


@query(f"select l.label from (select unnest({sql_list(dims.LABELS)}) as label) l where l.label not in (select distinct replace(label, '_', ' ') from {V('v_items')} where idx % 4 <> 1)")
def missing_labels(spark, d):
    known = spark.createDataFrame([(x,) for x in dims.LABELS], "label string")
    return known.join(view(spark, d, "v_items").where("idx % 4 <> 1").select(text.canonical_label(F.col("label")).alias("label")).distinct(), "label", "left_anti")


# --- media gates --------------------------------------------------------------------------------------------------------

GATE = gates.Gate(max_duration=400.0, min_size=1000, validate_labels=True, max_clip=0.04, min_vad=0.15)
REASON = f"""case when coalesce(nullif(status, ''), 'ok') <> 'ok' then 'status-not-ok' when coalesce(filename, '') = '' or not file_exists then 'missing-file' when not ends_with(lower(filename), '.wav') then 'unsupported-extension'
 when replace(lower(trim(weak_label)), '_', ' ') not in ({sql_list(dims.VALID_LABELS)[1:-1]}) then 'invalid-label' when file_size_bytes < 1000 then 'too-small' when duration_sec < 3 then 'too-short' when duration_sec > 400 then 'too-long'
 when rms < 200 then 'too-quiet' when clip_ratio > 0.04 then 'too-clipped' when vad_ratio < 0.15 then 'low-vad' when vad_ratio is not null and vad_segments < 1 then 'low-vad-segments' else 'accepted' end"""


def gated(spark, d):
    return view(spark, d, "v_media").withColumn("reason", gates.media_reason(GATE))


@query(f"select ord, {REASON} as reason from {V('v_media')}")
def quality_gate(spark, d):
    return gated(spark, d).select("ord", "reason")


@query(f"select {REASON} = 'accepted' as kept, {REASON} as reason, count(*) as n from {V('v_media')} group by all")
def kept_rejected(spark, d):
    return gated(spark, d).groupBy((F.col("reason") == "accepted").alias("kept"), "reason").agg(F.count("*").alias("n"))


@query(f"with g as (select ord, filename, {REASON} as reason from {V('v_media')}), f as (select filename, min(ord) as first from g where reason = 'accepted' group by filename) select ord, filename, case when first is not null and ord > first then 'duplicate-entry' else reason end as reason from g left join f using (filename)")
def first_kept_dedupe(spark, d):
    return gates.first_kept(gated(spark, d).select("ord", "filename", "reason"), "filename", "ord", "reason").select("ord", "filename", "reason")


@query(f"select ord, case when ord % 2 = 0 then 'path:/d/' || filename when ord % 5 = 1 then 'filename:' || filename when ord % 3 = 0 then 'url:u' || ord || '#chunk:' || (ord % 4) when ord % 7 = 0 then '' else 'url:u' || ord end as key from {V('v_media')}")
def dedupe_key(spark, d):
    m = view(spark, d, "v_media")
    o = F.col("ord")
    path = F.when(o % 2 == 0, F.concat(F.lit("/d/"), "filename"))
    name = F.when(o % 5 == 1, F.col("filename"))
    url = F.when((o % 3 == 0) | (o % 7 != 0), F.concat(F.lit("u"), o.cast("string")))
    return m.select("ord", gates.dedupe_key(path, name, url, F.when(o % 3 == 0, (o % 4).cast("string"))).alias("key"))


NAMES = "concat('d', cast(ord % 3 as string), '/f', cast(ord % 400 as string), '.wav')"


@query(f"""with p as (select ord, {NAMES} as path, 'f' || (ord % 400) || '.wav' as base, 'f' || (ord % 400) as stem from {V('v_media')}), o as (select *, first_value(path) over (partition by base order by ord) as owner, row_number() over (partition by base, path order by ord) as n from p),
k as (select *, n - case when path = owner then 1 else 0 end as k from o) select ord, case when k = 0 then base when k = 1 then stem || '-' || substring(sha1(path), 1, 8) || '.wav' else stem || '-' || substring(sha1(path), 1, 8) || '-' || (k - 1) || '.wav' end as name from k""")
def safe_names(spark, d):
    return gates.safe_names(view(spark, d, "v_media").select("ord", F.expr(NAMES).alias("path"))).select("ord", "name")


# --- windows ------------------------------------------------------------------------------------------------------------


@query(f"""with m as (select ord, cast(floor(duration_sec) as integer) as dur from {V('v_media')}), s as (select ord, dur, unnest(range(0, dur, 30)) as start from m where dur >= 5)
select ord, cast(start // 30 as integer) as chunk_index, cast(start as integer) as start_sec, cast(least(start + 30, dur) as integer) as end_sec, format('f{{}}_chunk{{:03d}}.wav', ord, start // 30) as name from s where least(start + 30, dur) - start >= 5""")
def chunk_windows(spark, d):
    m = view(spark, d, "v_media").select("ord", F.floor("duration_sec").cast("int").alias("dur"))
    parts = m.select("ord", F.inline(windows.chunks(F.col("dur"))))
    return parts.select("ord", "chunk_index", F.col("start").alias("start_sec"), F.col("end").alias("end_sec"), windows.chunk_name(F.concat(F.lit("f"), F.col("ord").cast("string")), F.col("chunk_index"), ".wav").alias("name"))


SEGMENTS = "array(named_struct('start', 0D, 'end', cast(ord % 5 as double)), named_struct('start', 6D, 'end', 6D + cast(ord % 7 as double)))"


@query(f"""with s as (select ord, 0 as i, 0.0::double as a, (ord % 5)::double as b from {V('v_media')} union all select ord, 1, 6.0, 6.0 + ord % 7 from {V('v_media')}), k as (select ord, a, b, row_number() over (partition by ord order by i) - 1 as segment_index from s where b - a >= 3),
t as (select ord, sum(greatest(b - a, 0)) / 20 as ratio from s group by ord) select t.ord, cast(segment_index as integer) as segment_index, a as segment_start, b as segment_end, ratio from t left join k using (ord)""")
def segment_rows(spark, d):
    m = view(spark, d, "v_media").select("ord", F.expr(SEGMENTS).alias("segments"))
    m = m.withColumn("ratio", windows.speech_ratio(F.col("segments"), F.lit(20.0)))
    return windows.segment_rows(m, "segments", 3.0).select("ord", "segment_index", "segment_start", "segment_end", "ratio")


@query("with c as (select label, n from (select toxic as label, count(*) as n from labels group by toxic)) select label, unnest(range(0, n, 100)) as start, least(100, n - unnest(range(0, n, 100))) as count from c")
def quota_batches(spark, d):
    c = table(spark, d, "labels").groupBy(F.col("toxic").alias("label")).agg(F.count("*").alias("n"))
    return c.select("label", F.inline(windows.batches(F.col("n"), 100)))


# --- generated items ----------------------------------------------------------------------------------------------------


def _sql_findings(expected: str) -> str:
    def one(bad: str, severity: str, reason: str) -> str:
        return f"select idx as index, '{severity}' as severity, {reason} as reason from i where {bad}"

    blank = "trim(coalesce({0}, '')) = ''".format
    rows = [one(blank("text"), "error", "'missing-or-empty-text'"), one(f"label <> {expected}", "error", "'invalid-label:' || label"), one("context is null or len(context) = 0 or len(list_filter(context, lambda e: trim(e) = '')) > 0", "error", "'invalid-context'"), one(blank("persona"), "error", "'missing-persona'"), one(blank("medium"), "error", "'missing-medium'"), one("duration_hint not in ('short', 'medium', 'long')", "error", "'invalid-duration-hint:' || duration_hint"), one("control_tokens_used is null", "error", "'invalid-control-tokens'"), one(f"regexp_matches(text, '{CJK_SQL}')", "error", "'text-contains-cjk'")]
    rows.append("select idx, case when t in ('[laughter]', '[sigh]') then 'warning' else 'error' end, case when t in ('[laughter]', '[sigh]') then 'token-not-present-in-text:' else 'unknown-control-token:' end || t from (select idx, text, unnest(control_tokens_used) as t from i) where t not in ('[laughter]', '[sigh]') or not contains(text, t)")
    return " union all ".join(rows)


@query(f"with i as (select * from {V('v_items')}) {_sql_findings('label')}")
def item_findings(spark, d):
    return validate.findings(view(spark, d, "v_items"))


@query(f"with i as (select * from {V('v_items')}), k as (select idx, {KEY.format('text')} as k from i where trim(text) <> ''), f as (select k, min(idx) as first from k group by k) select cast(-1 as bigint) as index, 'error' as severity, 'quota-shortfall:' || count(*) || '/1000000' as reason from i union all ({_sql_findings(chr(39) + 'disinformasi' + chr(39))}) union all select idx, 'error', 'duplicate-text:matches-item-' || first from k join f using (k) where idx > first")
def batch_findings(spark, d):
    return validate.batch_findings(view(spark, d, "v_items"), "disinformasi", 1_000_000)


@query(f"with i as (select * from {V('v_items')}), x as (select 'label' as facet, label as value from i union all select 'duration_hint', duration_hint from i union all select 'control_token', unnest(control_tokens_used) from i) select facet, value, n, case when facet = 'label' then case when n >= 260 then 'OK' else 'LOW' end else '' end as state from (select facet, value, count(*) as n from x group by facet, value)")
def corpus_report(spark, d):
    return validate.corpus_report(view(spark, d, "v_items"), 260)


@query("select conv_id, string_agg((turn + 1) || '. ' || text, chr(10) order by turn) as block from conversations group by conv_id")
def prompt_context(spark, d):
    c = table(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", F.col("text").alias("t")))).alias("c"))
    return c.select("conv_id", F.array_join(F.transform("c", lambda x: F.concat((x["turn"] + 1).cast("string"), F.lit(". "), x["t"])), "\n").alias("block"))


ITEM_JSON = "concat('{\"text\":\"t', cast(doc_id as string), '\",\"label\":\"', lang, '\"}')"
DOCUMENT = f"case doc_id % 3 when 0 then concat('[', {ITEM_JSON}, ']') when 1 then concat('{{\"metadata\":{{}},\"items\":[', {ITEM_JSON}, ',', {ITEM_JSON}, ']}}') else concat('\"', replace(concat('[', {ITEM_JSON}, ']'), '\"', '\\\\\"'), '\"') end"


@query("select doc_id, 't' || doc_id as text, lang as label from (select doc_id, lang, unnest(range(0, case when doc_id % 3 = 1 then 2 else 1 end)) from documents)")
def json_items(spark, d):
    c = F.col
    item = F.expr(ITEM_JSON)
    one = F.concat(F.lit("["), item, F.lit("]"))
    document = F.when(c("doc_id") % 3 == 0, one).when(c("doc_id") % 3 == 1, F.concat(F.lit('{"metadata":{},"items":['), item, F.lit(","), item, F.lit("]}"))).otherwise(F.concat(F.lit('"'), F.replace(one, F.lit('"'), F.lit('\\"')), F.lit('"')))
    docs = table(spark, d, "documents").select("doc_id", document.alias("j"))
    return docs.select("doc_id", F.inline(text.json_items(c("j"), "struct<text:string,label:string>")))


# --- sampling and augmentation ------------------------------------------------------------------------------------------


@query(f"select lang, doc_id from (select lang, doc_id, row_number() over (partition by lang order by {sql_draw('doc_id || ' + chr(39) + ':7' + chr(39))}, doc_id) as n from documents) where n <= 8")
def sample_context(spark, d):
    docs = table(spark, d, "documents").select("lang", "doc_id", sampling.draw(F.concat(F.col("doc_id").cast("string"), F.lit(":7"))).alias("h"))
    return labels.cap_by(docs, "lang", F.struct("h", "doc_id"), 8).select("lang", "doc_id")


KINDS = sorted({a[0] for a in dims.AUGMENTATIONS})


@query(f"""with x as (select page_id, kind, copy, row_number() over (partition by page_id order by {sql_draw("page_id || ':' || kind || ':' || copy")}, kind, copy) as version from pages, (select unnest({sql_list(KINDS)}) as kind), (select unnest([0, 1, 2]) as copy))
select page_id, cast(version as integer) as version, kind, 'p' || page_id || '_aug' || version || '_' || kind || '.wav' as filename, 'p' || page_id || ' (augmented: ' || kind || ')' as title from x where version <= 2""")
def augment_plan(spark, d):
    """Two versions a file out of each kind three times, without replacement: a hash orders the choices inside the row."""
    choices = F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(c).alias("copy")) for k in KINDS for c in range(3)])
    key = F.col("page_id").cast("string")
    drawn = F.array_sort(F.transform(choices, lambda c: F.struct(sampling.draw(F.concat_ws(":", key, c["kind"], c["copy"].cast("string"))).alias("h"), c["kind"].alias("kind"), c["copy"].alias("copy"))))
    picked = table(spark, d, "pages").select("page_id", F.posexplode(F.slice(drawn, 1, 2)).alias("v", "c")).select("page_id", (F.col("v") + 1).alias("version"), "c.kind")
    p = F.concat(F.lit("p"), F.col("page_id").cast("string"))
    return picked.select("page_id", "version", "kind", F.concat(p, F.lit("_aug"), F.col("version").cast("string"), F.lit("_"), "kind", F.lit(".wav")).alias("filename"), F.concat(p, F.lit(" (augmented: "), "kind", F.lit(")")).alias("title"))


def _sql_choice(key: str, values: list[str]) -> str:
    return f"{sql_list(values)}[{sql_draw(key)} % {len(values)} + 1]"


@query(f"""with a as (select idx, duration_hint, {_sql_choice("idx || ':g'", dims.GENDERS)} as gender, {_sql_choice("idx || ':a'", dims.AGES)} as age from {V('v_items')}),
p as (select *, case age when 'child' then {_sql_choice("idx || ':p'", dims.AGE_PITCHES['child'])} when 'elderly' then {_sql_choice("idx || ':p'", dims.AGE_PITCHES['elderly'])} else {_sql_choice("idx || ':p'", dims.PITCHES)} end as pitch from a)
select idx, concat_ws(', ', gender, age, pitch, case duration_hint when 'short' then 'short utterance, concise' when 'medium' then 'natural conversational pacing' when 'long' then 'slightly sustained narration' end) as instruct, gender, age, pitch from p""")
def voice_design(spark, d):
    key = F.col("idx").cast("string")
    a = view(spark, d, "v_items").select("idx", "duration_hint", sampling.choice(F.concat(key, F.lit(":g")), dims.GENDERS).alias("gender"), sampling.choice(F.concat(key, F.lit(":a")), dims.AGES).alias("age"))
    k = F.concat(F.col("idx").cast("string"), F.lit(":p"))
    pitch = F.when(F.col("age") == "child", sampling.choice(k, dims.AGE_PITCHES["child"])).when(F.col("age") == "elderly", sampling.choice(k, dims.AGE_PITCHES["elderly"])).otherwise(sampling.choice(k, dims.PITCHES))
    pacing = F.element_at(F.create_map(*[F.lit(x) for p in dims.PACING.items() for x in p]), F.col("duration_hint"))
    made = a.select("idx", F.concat_ws(", ", "gender", "age", pitch, pacing).alias("instruct"))
    parts = F.transform(F.split("instruct", ","), lambda s: F.trim(s))
    return made.select("idx", "instruct", F.element_at(parts, 1).alias("gender"), F.element_at(parts, 2).alias("age"), F.element_at(parts, 3).alias("pitch"))


@query(f"select idx, cast(floor((0.8 + (1.2 - 0.8) * {sql_draw('idx || ' + chr(39) + ':s' + chr(39))} / 4294967296.0) * 1000) as bigint) as speed_milli, 64 as num_step from {V('v_items')}")
def param_sample(spark, d):
    speed = sampling.uniform(F.concat(F.col("idx").cast("string"), F.lit(":s")), 0.8, 1.2)
    return view(spark, d, "v_items").select("idx", F.floor(speed * 1000).alias("speed_milli"), F.lit(64).alias("num_step"))


# --- signals ------------------------------------------------------------------------------------------------------------

SIG = "(select vec_id, list_transform(embedding, lambda v: v::double) as x from embeddings)"


def _samples(spark, d, make):
    e = table(spark, d, "embeddings").select("vec_id", make(F.col("embedding")).alias("y"))
    return e.select("vec_id", F.posexplode("y").alias("i", "v")).select("vec_id", "i", F.round(F.col("v").cast("double"), 6).alias("v"))


def _sql_samples(y: str) -> str:
    return f"select vec_id, cast(i - 1 as integer) as i, round(y[i]::double, 6) as v from (select vec_id, y, unnest(range(1, len(y) + 1)) as i from (select vec_id, {y} as y from {SIG}))"


@query(_sql_samples("list_transform(x, lambda v: least(greatest(v * 3.0, -1.0), 1.0))"))
def sig_gain_clip(spark, d):
    return _samples(spark, d, lambda x: signal.clip(signal.gain(x, 3.0)))


@query(_sql_samples("list_transform(x, lambda v, i: v + case when i > 8 then x[i - 8] * (0.3 * 0.5) else 0 end)"))
def sig_reverb(spark, d):
    return _samples(spark, d, lambda x: signal.reverb(x, 0.5, 160))


@query(_sql_samples("list_transform(x, lambda v, i: list_sum(list_transform(range(0, (i - 1) // 10 + 1), lambda k: pow(0.5, k) * x[i - k * 10])))"))
def sig_echo(spark, d):
    """A feedback delay is a recursion: an Arrow function, linear in the signal."""
    return _samples(spark, d, lambda x: audio.transform(x, "echo", F.lit(10), F.lit(0.5)))


@query(f"select vec_id, round(list_max(list_transform(x, lambda v: abs(v))), 6) as peak, round(sqrt(list_sum(list_transform(x, lambda v: v * v)) / len(x)), 6) as rms, len(list_filter(x, lambda v: abs(v) >= 0.999)) / len(x) as clip_ratio, len(x) / 16000.0::double as duration from {SIG}")
def sig_stats_float(spark, d):
    s = table(spark, d, "embeddings").select("vec_id", signal.float_stats(F.col("embedding"), 16000).alias("s"))
    return s.select("vec_id", F.round("s.peak", 6).alias("peak"), F.round("s.rms", 6).alias("rms"), F.col("s.clip_ratio").alias("clip_ratio"), F.col("s.duration").alias("duration"))


PCM = "(select vec_id, list_transform(x, lambda v: cast(floor(least(greatest(v * 3, -1), 1) * 32767) as integer)) as p from " + SIG + ")"


@query(f"select vec_id, cast(floor(sqrt(list_sum(list_transform(p, lambda v: v::double * v)) / len(p))) as bigint) as rms, list_max(list_transform(p, lambda v: abs(v))) as peak, round(len(list_filter(p, lambda v: abs(v) >= 0.999 * 32767)) / len(p), 6) as clip_ratio from {PCM}")
def sig_stats_pcm(spark, d):
    pcm = F.transform(signal.clip(signal.gain(F.col("embedding"), 3.0)), lambda v: F.floor(v * 32767).cast("int"))
    return table(spark, d, "embeddings").select("vec_id", signal.pcm_stats(pcm).alias("s")).select("vec_id", "s.rms", "s.peak", "s.clip_ratio")


@query(_sql_samples("case when vec_id % 2 = 0 then x[1:40] else x || list_transform(range(0, 6), lambda k: 0.0::double) end"))
def sig_length(spark, d):
    return _samples(spark, d, lambda x: F.when(F.col("vec_id") % 2 == 0, signal.fit_length(x, 40)).otherwise(signal.fit_length(x, 70)))


@query(_sql_samples("x[11:30]"))
def sig_segment(spark, d):
    return _samples(spark, d, lambda x: signal.segment(x, F.lit(0.1), F.lit(0.3), 100))


@query(_sql_samples("list_transform(x, lambda v, i: (v + x[len(x) + 1 - i]) / 2)"))
def sig_downmix(spark, d):
    return _samples(spark, d, lambda x: signal.downmix([x, F.reverse(x)]))


@query(f"select vec_id, case when dur < 0.8 then 'too-short' when dur > 45 then 'too-long' when rms < 0.003 then 'too-quiet' when clip > 0.03 then 'too-clipped' else 'accepted' end as reason from (select vec_id, len(x) / (case vec_id % 3 when 0 then 100.0 when 1 then 1.0 else 60.0 end) as dur, sqrt(list_sum(list_transform(x, lambda v: v * v)) / len(x)) as rms, len(list_filter(x, lambda v: abs(v) >= 0.999)) / len(x) as clip from {SIG})")
def tts_gate(spark, d):
    e = table(spark, d, "embeddings")
    s = signal.float_stats(F.col("embedding"), 1)
    rate = F.when(F.col("vec_id") % 3 == 0, 100.0).when(F.col("vec_id") % 3 == 1, 1.0).otherwise(60.0)
    stats = F.struct(s["rms"].alias("rms"), s["clip_ratio"].alias("clip_ratio"), (s["duration"] / rate).alias("duration"))
    return e.select("vec_id", gates.speech_reason(stats, F.forall("embedding", lambda v: ~F.isnan(v))).alias("reason"))


@query(f"select v.ord, v.url, coalesce(m.title, '') as title, coalesce(nullif(v.label, ''), 'x') as weak_label from {CANON} v left join (select url, max(ord) as ord, 't' || max(ord) as title from {CANON} where ord % 4 = 0 group by url) m using (url)")
def output_rows(spark, d):
    """Result rows with defaults filled from the last stored row of their address."""
    rows = canon(spark, d).select("ord", "url", "label")
    stored = labels.first_by(rows.where("ord % 4 = 0"), "url", "ord", last=True).select("url", F.concat(F.lit("t"), F.col("ord").cast("string")).alias("title"))
    return rows.join(stored, "url", "left").select("ord", "url", F.coalesce("title", F.lit("")).alias("title"), F.coalesce(F.nullif("label", F.lit("")), F.lit("x")).alias("weak_label"))

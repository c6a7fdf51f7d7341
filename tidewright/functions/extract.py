"""Link and tag extraction from stored pages, Column to Column."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .urls import VIDEO, absolute, canonical, unquote

# Where pages hold video ids (pattern with the id as group 1, address before it) ...
IDS = [
    (r"(?:youtube\.com/embed/|youtube\.com/watch\?v=|m\.youtube\.com/watch\?v=|youtu\.be/)([\w-]{11})", "https://www.youtube.com/watch?v="),
    (r'"videoId":"([\w-]{11})"', "https://www.youtube.com/watch?v="),
    (r'"url":"/watch\?v=([\w-]{11})"', "https://www.youtube.com/watch?v="),
    (r'"videoId":"(\d{19})"', "https://www.tiktok.com/@user/video/"),
    (r'"id":"(\d{19})"', "https://www.tiktok.com/@user/video/"),
    (r'facebook\.com/[^"\'>\s]*(?:/videos/|watch\?v=)(\d+)', "https://www.facebook.com/watch?v="),
    (r"facebook\.com/reel/(\d+)", "https://www.facebook.com/watch?v="),
    (r"(?:twitter|x)\.com/\w+/status/(\d+)", "https://x.com/i/web/status/"),
]
# ... and whole addresses, which are made canonical.
ADDRESSES = [r'(tiktok\.com/[^"\'>\s]+/video/\d+)', r'((?:vm|vt)\.tiktok\.com/[^"\'>\s/]+/?)', r'(fb\.watch/[^"\'>\s/]+/?)', r"(instagram\.com/(?:reel|p)/[A-Za-z0-9_-]+)"]
REDIRECT = r'/url\?url=([^&"]+)'
DIRECT = r'((?:youtube\.com|tiktok\.com|facebook\.com|instagram\.com|twitter\.com|x\.com)[^"\'<>\s]+)'
ANCHOR = r'<a[^>]+href=["\']([^"\']+)["\']'
NARRATIVE = [r"(?is)Narasi(.*?)(?:Penjelasan|Kesimpulan|Hasil Periksa fakta)", r"(?is)Salah Sumber:(.*?)(?:Referensi|Artikel terbaru|$)"]
TAG_LINKS = {"kompas": r'href="https://[^"]*kompas\.com/tag/([^"]+)"', "detik": r'href="https://[^"]*detik\.com/tag/([^"]+)"', "liputan6": r'href="https://www\.liputan6\.com/tag/([^"]+)"', "cnnindonesia": r'href="https://www\.cnnindonesia\.com/tag/([^"]+)"'}
SKIPPED = {"cnnindonesia": ["/tag/", "/search/", "/infografis/", "/foto/"], "turnbackhoax": ["/tag/", "/category/", "/author/", "/page/"]}
# Fixed value: what counts as a video among the links of a source block.
SOURCE_VIDEO = r"(?:instagram\.com/(?:reel|p)/|tiktok\.com/.+/video/|(?:vm|vt)\.tiktok\.com/|(?:facebook\.com|fb\.com|fb\.watch).*(?:/videos/|watch\?v=|/reel/)|(?:twitter|x)\.com/\w+/status/|youtube\.com/(?:watch\?v=|embed/)|youtu\.be/)"
FACT_CHECK_HOST = "turnbackhoax.id"


def found(html: Column, pattern: str) -> Column:
    return F.regexp_extract_all(html, F.lit("(?Ud)" + pattern), F.lit(1))


def hrefs(html: Column, base: Column) -> Column:
    """Absolute addresses of a page's anchors."""
    return F.transform(F.regexp_extract_all(html, F.lit(ANCHOR), F.lit(1)), lambda h: absolute(h, base))


def _is_video(c: Column) -> Column:
    return c.rlike("(?Ud)" + VIDEO)


def _behind(prefix: str) -> Callable[[Column], Column]:
    return lambda c: F.concat(F.lit(prefix), c)


def video_urls(html: Column, base: Column) -> Column:
    """Canonical video addresses anywhere in a page, sorted and distinct."""
    parts = [F.transform(found(html, p), _behind(prefix)) for p, prefix in IDS]
    parts += [F.transform(found(html, p), canonical) for p in ADDRESSES]
    addresses = [F.transform(found(html, REDIRECT), unquote), found(html, DIRECT), hrefs(html, base)]
    parts += [F.transform(F.filter(a, _is_video), canonical) for a in addresses]
    return F.array_sort(F.array_distinct(F.flatten(F.array(*parts))))


def preferred_urls(html: Column, base: Column) -> Column:
    """Video addresses among the anchors of a fact-check's source block."""
    blocks = F.array(*[F.regexp_extract(html, p, 1) for p in NARRATIVE])
    links = F.flatten(F.transform(blocks, lambda b: F.regexp_extract_all(b, F.lit(ANCHOR), F.lit(1))))
    return F.array_sort(F.array_distinct(F.transform(F.filter(F.transform(links, lambda h: absolute(h, base)), lambda c: c.rlike("(?Ud)" + SOURCE_VIDEO)), canonical)))


def page_video_urls(html: Column, base: Column) -> Column:
    """The source block's addresses on fact-check articles that have any, else all."""
    first = preferred_urls(html, base)
    return F.when(F.contains(base, F.lit(FACT_CHECK_HOST)) & (F.size(first) > 0), first).otherwise(video_urls(html, base))


def site_tags(html: Column, site: str) -> Column:
    return F.transform(F.regexp_extract_all(html, F.lit(TAG_LINKS[site]), F.lit(1)), lambda t: F.replace(F.replace(t, F.lit("-"), F.lit(" ")), F.lit("%20"), F.lit(" ")))


def skipped(url: Column, site: str) -> Column:
    return F.exists(F.array(*map(F.lit, SKIPPED[site])), lambda s: F.contains(url, s))

"""URL functions, Column to Column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..dims import PLATFORMS

# The shapes of video addresses, in the order in which they are tried; group 1 is the id.
YOUTUBE = r"(?:youtube\.com/(?:embed/|watch\?v=|shorts/)|m\.youtube\.com/watch\?v=|youtu\.be/)([\w-]{11})"
TIKTOK = r"((?:https?://)?(?:www\.)?tiktok\.com/[^\"'>\s]+/video/\d+)"
TIKTOK_SHORT = r"((?:https?://)?(?:vm|vt)\.tiktok\.com/[^\"'>\s/]+/?)"
FB_WATCH = r"((?:https?://)?(?:www\.)?fb\.watch/[^\"'>\s/]+/?)"
FB_VIDEO = r"(?:facebook\.com/[^\"'>\s]*(?:/videos/|watch\?v=)|facebook\.com/reel/)(\d+)"
INSTAGRAM = r"instagram\.com/((?:reel|p)/[A-Za-z0-9_-]+)"
TWEET = r"(?:twitter|x)\.com/\w+/status/(\d+)"
IDS = [r"(?:youtube\.com/watch\?v=)([\w-]{11})", r"/video/(\d+)", r"facebook\.com/watch\?v=(\d+)", r"instagram\.com/(?:reel|p)/([A-Za-z0-9_-]+)", r"status/(\d+)"]
VIDEO = r"(?:youtube\.com/(?:watch\?v=|embed/|shorts/)|m\.youtube\.com/watch\?v=|youtu\.be/|tiktok\.com/.+/video/|(?:vm|vt)\.tiktok\.com/|(?:facebook\.com|fb\.com|fb\.watch).*(?:/videos/|watch\?v=|/reel/)|instagram\.com/(?:reel|p)/|(?:twitter|x)\.com/\w+/status/)"
PARTS = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)"


def got(c: Column, pattern: str, group: int = 1) -> Column:
    """The group of the first match, null without one. Classes are Unicode, as Python's are."""
    return F.nullif(F.regexp_extract(c, "(?U)" + pattern, group), F.lit(""))


def record_id(url: Column) -> Column:
    return F.substring(F.md5(url), 1, 16)


def media_id(url: Column) -> Column:
    return F.substring(F.sha1(url), 1, 10)


def host(url: Column) -> Column:
    return F.regexp_replace(F.lower(F.regexp_extract(url, PARTS, 1)), r"^www\.", "")


def platform(url: Column, display: bool = False, exact_host: bool = False) -> Column:
    """The first platform whose domain the host contains (or, with exact_host, is or ends in)."""
    h, out = host(url), None
    for domain, slug, name in PLATFORMS:
        hit = (h == domain) | h.endswith("." + domain) if exact_host else h.contains(domain)
        value = F.lit(name if display else slug)
        out = F.when(hit, value) if out is None else out.when(hit, value)
    return out.otherwise("Unknown" if display else "unknown")


def _full(found: Column, prefix: str) -> Column:
    bare = F.regexp_replace(found, r"^(?:www\.)?", "") if prefix.endswith("www.") else found
    return F.substring_index(F.when(found.startswith("http"), found).otherwise(F.concat(F.lit(prefix), bare)), "?", 1)


def canonical(url: Column) -> Column:
    """One address per video whatever its spelling; other addresses lose their query."""
    u = F.trim(url)
    return F.coalesce(
        F.concat(F.lit("https://www.youtube.com/watch?v="), got(u, YOUTUBE)),
        _full(got(u, TIKTOK), "https://www."),
        _full(got(u, TIKTOK_SHORT), "https://"),
        _full(got(u, FB_WATCH), "https://"),
        F.concat(F.lit("https://www.facebook.com/watch?v="), got(u, FB_VIDEO)),
        F.concat(F.lit("https://www.instagram.com/"), got(u, INSTAGRAM), F.lit("/")),
        F.concat(F.lit("https://x.com/i/web/status/"), got(u, TWEET)),
        F.substring_index(u, "?", 1),
    )


def video_id(url: Column, strict_reference: bool = False) -> Column:
    """The id in a canonical address, null without one. strict_reference also cuts numeric Facebook ids at 11 characters."""
    patterns = [r"watch\?v=([\w-]{11})", *IDS[1:]] if strict_reference else IDS
    return F.coalesce(*[got(url, p) for p in patterns])


def is_valid(url: Column, strict_reference: bool = False) -> Column:
    """An absolute address that is no login page; Facebook's bare watch page needs a video."""
    h = F.regexp_extract(url, PARTS, 1)
    path = F.regexp_extract(url, r"^[^:]+://[^/?#]*([^?#]*)", 1)
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    has_video = query.rlike(r"[?&]v=\d+") if strict_reference else query.rlike(r"(?:^|[?&])v=\d+")
    watch = F.lower(h).contains("facebook.com") & F.rtrim(path, F.lit("/")).isin("/watch")
    return (h != "") & ~F.lower(path).contains("login") & (~watch | has_video)


def page_url(base: Column, page: Column, style: str) -> Column:
    """Address of a result page; page 1 is the base itself. style: query or path."""
    if style == "query":
        later = F.concat(base, F.when(F.instr(base, "?") > 0, "&").otherwise("?"), F.lit("page="), page.cast("string"))
    else:
        later = F.concat(F.rtrim(base, F.lit("/")), F.lit("/"), page.cast("string"))
    return F.when(page == 1, base).otherwise(later)


def quote_plus(text: Column) -> Column:
    """Form encoding that leaves ~ alone and encodes the asterisk."""
    return F.replace(F.replace(F.url_encode(text), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def unquote(text: Column) -> Column:
    """Percent-decoding; plus signs stay, malformed escapes leave the text as it is."""
    return F.coalesce(F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B"))), text)


def plain_path(url: Column) -> Column:
    """An address without . and .. segments in its path."""
    root, path, rest = (F.regexp_extract(url, p, 1) for p in (r"^([^:/?#]+://[^/?#]*)", r"^[^:/?#]+://[^/?#]*([^?#]*)", r"^[^?#]*(.*)$"))
    parts = F.split(path, "/")
    none = F.expr("cast(array() as array<string>)")
    # the first part is the blank before the root; a last . or .. leaves a folder
    kept = F.aggregate(F.slice(parts, 2, F.size(parts)), none, lambda a, p: F.when(p == ".", a).when(p == "..", F.slice(a, 1, F.greatest(F.size(a) - 1, F.lit(0)))).otherwise(F.concat(a, F.array(p))))
    tail = F.when(F.element_at(parts, -1).isin(".", "..") & (F.size(kept) > 0), "/").otherwise("")
    return F.when(path.rlike(r"(^|/)\.\.?(/|$)"), F.concat(root, F.lit("/"), F.array_join(kept, "/"), tail, rest)).otherwise(url)


def absolute(href: Column, base: Column) -> Column:
    """An address relative to a page: full ones of any scheme, scheme-relative, root-relative, query and fragment forms, and names with or without dots."""
    scheme, root = F.regexp_extract(base, r"^([^:]+:)", 1), F.regexp_extract(base, r"^([^:]+://[^/?#]*)", 1)
    page = F.regexp_extract(base, r"^([^?#]*)", 1)
    folder = F.when(page == root, F.concat(root, F.lit("/"))).otherwise(F.regexp_replace(page, r"[^/]*$", ""))
    return (
        F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), href).when(href.startswith("//"), F.concat(scheme, href)).when(href.startswith("/"), plain_path(F.concat(root, href)))
        .when(href.startswith("?"), F.concat(page, href)).when(href.startswith("#"), F.concat(F.regexp_extract(base, r"^([^#]*)", 1), href)).otherwise(plain_path(F.concat(folder, href)))
    )

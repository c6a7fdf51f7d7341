"""Text, tag and keyword functions, Column to Column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import dims
from .urls import got

CJK = r"[\x{3400}-\x{4dbf}\x{4e00}-\x{9fff}\x{f900}-\x{faff}]"
SPACES = r"(?U)\s+"


def squeeze(text: Column) -> Column:
    return F.btrim(F.regexp_replace(text, SPACES, " "))


def strip_ansi(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), "\x1b\\[[0-9;]*[A-Za-z]", ""))


def clean_tags(tags: Column) -> Column:
    """White space and edge punctuation off, empties out, first spelling of case-insensitive repeats kept."""
    kept = F.filter(F.transform(tags, lambda t: F.btrim(F.regexp_replace(t, SPACES, " "), F.lit(" -_,:/"))), lambda t: t != "")
    return F.filter(kept, lambda t, i: F.array_position(F.transform(kept, lambda x: F.lower(x)), F.lower(t)) == i + 1)


def tag_text(tag: Column) -> Column:
    spaced = F.translate(F.replace(F.lower(tag), F.lit("%20"), F.lit(" ")), "-_", "  ")
    return F.btrim(F.regexp_replace(F.regexp_replace(spaced, r"[^a-z0-9\s]", ""), r"\s+", " "))


def tag_keyword(tags: Column) -> Column:
    c = clean_tags(tags)
    return F.when(F.size(c) > 0, F.substring(F.concat(F.lit("tag:"), F.array_join(c, ",")), 1, 120)).otherwise("")


def seed_keyword(path: Column, label: Column) -> Column:
    slug = F.replace(F.element_at(F.split(F.btrim(path, F.lit("/")), "/"), -1), F.lit("-"), F.lit(" "))
    return (
        F.when(got(path, "/tag/([^/?#]+)").isNotNull(), F.concat(F.lit("tag:"), F.replace(got(path, "/tag/([^/?#]+)"), F.lit("-"), F.lit(" "))))
        .when(got(path, "category=([^&#]+)").isNotNull(), F.concat(F.lit("category:"), got(path, "category=([^&#]+)")))
        .when(F.btrim(path, F.lit("/")) == "", F.concat(F.lit("seed:"), label)).otherwise(F.concat(F.lit("seed:"), slug))
    )


def search_keyword(platform: Column, topic: Column) -> Column:
    return F.substring(F.concat_ws(":", F.lit("search"), platform, topic), 1, 120)


def html_text(html: Column) -> Column:
    """Tags out, the five predefined entities and the no-break space read, white space collapsed."""
    out = F.regexp_replace(html, "<[^>]+>", " ")
    for entity, c in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        out = F.replace(out, F.lit(entity), F.lit(c))
    return squeeze(out)


def snippet(title: Column, summary: Column) -> Column:
    return F.when(F.trim(title) != "", F.rtrim(F.trim(F.concat(title, F.lit(". "), F.substring(summary, 1, 120))), F.lit(".")))


def _folds() -> tuple[dict[str, str], dict[str, str]]:
    """Where case folding goes beyond lower case, from the Unicode tables: to one character, and to several."""
    found = {c: c.casefold() for c in map(chr, range(0x80, 0x1F000)) if c.casefold() != c.lower() and c.lower() == c}
    return {c: f for c, f in found.items() if len(f) == 1}, {c: f for c, f in found.items() if len(f) > 1}


ONE, SEVERAL = _folds()


def casefold(text: Column) -> Column:
    """Full case folding: lower case, then the characters that lower case leaves apart."""
    out = F.translate(F.lower(text), "".join(ONE), "".join(ONE.values()))
    several = out
    for c, folded in SEVERAL.items():
        several = F.replace(several, F.lit(c), F.lit(folded))
    return F.when(out.rlike("[" + "".join(SEVERAL) + "]"), several).otherwise(out)


def text_key(text: Column) -> Column:
    """Lower case and ß alone: the whole folding, see casefold, is too slow for whole tables of texts."""
    return F.replace(F.lower(squeeze(text)), F.lit("ß"), F.lit("ss"))


def unreadable(document: Column) -> Column:
    """Whether a JSON document is neither a list nor an object with items: json_items gives no row for it."""
    inner = F.coalesce(F.when(F.trim(document).startswith('"'), F.get_json_object(F.concat(F.lit('{"a":'), document, F.lit("}")), "$.a")), document)
    listed = F.from_json(F.when(F.trim(inner).startswith("["), inner), "array<string>").isNotNull()
    return ~(listed | F.coalesce(F.trim(F.get_json_object(inner, "$.items")).startswith("["), F.lit(False)))


def item_kind_findings(items: Column) -> Column:
    """Array of (index, severity, reason) for the elements of a JSON list that are no objects, by the kind that they have."""
    each = F.from_json(items, "array<string>")
    first = lambda e: F.substring(F.trim(e), 1, 1)
    text = F.transform(F.from_json(items, "array<variant>"), lambda v: F.schema_of_variant(v))
    kind = lambda k: F.when(k.isNull() | (k == "VOID"), "NoneType").when(k.startswith("ARRAY"), "list").when(k == "STRING", "str").when(k == "BOOLEAN", "bool").when(k.isin("BIGINT"), "int").otherwise("float")
    made = F.zip_with(each, text, lambda e, k: F.when(~F.coalesce(k, F.lit("")).startswith("OBJECT") | (first(e) != "{"), F.concat(F.lit("item-not-object:"), kind(k))))
    return F.filter(F.transform(made, lambda r, i: F.struct(i.cast("long").alias("index"), F.lit("error").alias("severity"), r.alias("reason"))), lambda f: f["reason"].isNotNull())


def has_cjk(text: Column) -> Column:
    return F.regexp_like(text, F.lit(CJK))


def speech_text(text: Column) -> Column:
    """Text fit for synthesis: known control tokens stay, others go; null if it has CJK or nothing is left."""
    names = "|".join(t[1:-1] for t in dims.SPEECH_TOKENS)
    out = squeeze(F.regexp_replace(squeeze(text), rf"\[(?!(?:{names})\])[^\]]+\]", " "))
    return F.when(~has_cjk(text) & (out != ""), out)


def is_refusal(text: Column) -> Column:
    low = F.lower(F.trim(text))
    return ~low.startswith("[") & F.exists(F.array(*map(F.lit, dims.REFUSALS)), lambda s: F.contains(low, s))


def error_status(error: Column) -> Column:
    """skipped, needs-login, throttled or retryable, by the first list that has a token of the message."""
    low = F.lower(strip_ansi(error))

    def has(tokens: list[str]) -> Column:
        return F.exists(F.array(*map(F.lit, tokens)), lambda s: F.contains(low, s))

    return F.when(has(dims.SKIP_ERRORS), "skipped").when(has(dims.LOGIN_ERRORS), "needs-login").when(has(dims.THROTTLE_ERRORS), "throttled").otherwise("retryable")


def label_alias(label: Column, inverse: bool = False) -> Column:
    pairs = [(b, a) if inverse else (a, b) for a, b in dims.LABEL_ALIASES.items()]
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for p in pairs for x in p]), label), label)


def canonical_label(label: Column) -> Column:
    return F.replace(F.lower(F.trim(label)), F.lit("_"), F.lit(" "))


def json_items(document: Column, schema: str) -> Column:
    """Items of a JSON document: a bare array, an object with items, or either of them as a JSON string."""
    inner = F.coalesce(F.when(F.trim(document).startswith('"'), F.get_json_object(F.concat(F.lit('{"a":'), document, F.lit("}")), "$.a")), document)
    return F.coalesce(F.from_json(F.when(F.trim(inner).startswith("["), inner), f"array<{schema}>"), F.from_json(F.get_json_object(inner, "$.items"), f"array<{schema}>"))

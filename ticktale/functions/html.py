"""HTML column helpers (regex based, RE2-compatible patterns)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BODY_RE = r"(?s)<body[^>]*>(.*)</body>"
P_OPEN_RE = r"<p(?:[ \t\n\r\f][^>]*)?>"
TAG_RE = r"<[^>]*>"
LI_LINK_RE = r"<li[^>]*>[ \t\n\r\f]*<a[^>]*href=\"([^\"]*)\"[^>]*>([^<]*)</a>"
TIME_RE = r"<time[^>]*datetime=\"([^\"]*)\""
BASE_RE = r"^(https?://[^/]+)"

# Entities decoded in page text, '&amp;' last.
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", "\""), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&"))


def unescape(c: Column) -> Column:
    for k, v in ENTITIES:
        c = F.replace(c, F.lit(k), F.lit(v))
    return c


def paragraphs(html: Column) -> Column:
    """Text of every <p> in the body: each piece after an opening <p> up to
    its </p> (or the next <p>), tags stripped, entities decoded."""
    body = F.regexp_extract(html, BODY_RE, 1)
    pieces = F.split(body, P_OPEN_RE)
    after = F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0)))
    return F.transform(after, lambda x: unescape(F.regexp_replace(F.substring_index(x, "</p>", 1), TAG_RE, "")))


def absolute_url(href: Column, page_url: Column) -> Column:
    """X10 (fixed form): prefix the page's scheme+host to relative hrefs only."""
    base = F.regexp_extract(page_url, BASE_RE, 1)
    return F.when(href.startswith("http"), href).otherwise(F.concat(base, href))


def publish_date(raw: Column) -> Column:
    """ISO date; else 'Mon. d, yyyy' (with 'Sept' read as 'Sep'); else an
    ISO stamp with offset, keeping the article's own local date."""
    iso = F.try_to_date(raw, "yyyy-MM-dd")
    mon = F.to_date(F.try_to_timestamp(F.replace(raw, F.lit("Sept"), F.lit("Sep")), F.lit("MMM. d, yyyy")))
    stamped = F.when(F.try_to_timestamp(raw, F.lit("yyyy-MM-dd'T'HH:mm:ssZ")).isNotNull(),
                     F.try_to_date(F.substring(raw, 1, 10), "yyyy-MM-dd"))
    return F.coalesce(iso, mon, stamped)


# DuckDB forms for the oracles.
def paragraphs_sql(html: str) -> str:
    body = f"regexp_extract({html}, '(?s)<body[^>]*>(.*)</body>', 1)"
    pieces = f"regexp_split_to_array({body}, '<p(?:[ \\t\\n\\r\\f][^>]*)?>')"
    inner = "regexp_replace(split_part(x, '</p>', 1), '<[^>]*>', '', 'g')"
    for k, v in ENTITIES:
        inner = f"replace({inner}, '{k}', '{v.replace(chr(39), chr(39) * 2)}')"
    return f"list_transform(({pieces})[2:], lambda x: {inner})"

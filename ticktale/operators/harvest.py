"""Article harvest from landed pages.

Network fetching and browser paging stay outside (see README); these jobs
start from a table of fetched pages ``(page_id, url, html)``. Every step is a
per-row expression or a key-local join/aggregate: pages are never gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import html as H
from ..sources.fixtures import ARTICLE_SYMBOLS

# The news sections the study keeps.
WANTED_SECTIONS = ("technology", "business", "climate", "energy & environment")


def company_of(page_id: str = "page_id"):
    """Test-data stand-in for the company a page was fetched for."""
    return F.element_at(F.array(*[F.lit(s) for s in ARTICLE_SYMBOLS]), (F.col(page_id) % 5 + 1).cast("int"))


def page_text(pages: DataFrame, sep: str = " ") -> DataFrame:
    """Body paragraphs joined by ``sep`` (the study used '', which fuses
    sentences at paragraph borders; Q14), trimmed."""
    p = pages.select("page_id", "url", H.paragraphs(F.col("html")).alias("_p"))
    return p.select("page_id", "url", F.trim(F.array_join("_p", sep)).alias("text"),
                    F.size("_p").cast("long").alias("n_paragraphs"))


def page_links(pages: DataFrame) -> DataFrame:
    """One row per <li> link with its label as section; absolute URL."""
    hrefs = F.regexp_extract_all("html", F.lit(H.LI_LINK_RE), F.lit(1))
    labels = F.regexp_extract_all("html", F.lit(H.LI_LINK_RE), F.lit(2))
    p = pages.select("page_id", "url", F.posexplode(F.arrays_zip(hrefs.alias("href"), labels.alias("section")))
                     .alias("pos", "l"))
    return p.select(company_of().alias("company"), "page_id", F.col("pos").cast("long").alias("pos"),
                    H.absolute_url(F.col("l.href"), F.col("url")).alias("link"),
                    F.trim(F.col("l.section")).alias("section"))


def link_sections(links: DataFrame) -> DataFrame:
    """F11 + A21: links per company and lower-cased section, flagged when the
    section is one the study keeps."""
    sec = F.lower("section")
    return links.groupBy("company", sec.alias("section")).agg(
        F.count("*").alias("n_links"), F.count_distinct("link").alias("n_distinct"),
    ).withColumn("wanted", F.col("section").isin(*WANTED_SECTIONS))


def wanted_links(links: DataFrame) -> DataFrame:
    """keep links of the wanted sections."""
    return links.filter(F.lower("section").isin(*WANTED_SECTIONS))


def unseen_links(links: DataFrame, seen: DataFrame) -> DataFrame:
    """Links not processed yet for their company, each once."""
    return (links.select("company", "link").join(seen.select("company", "link"), ["company", "link"], "left_anti")
                 .dropDuplicates(["company", "link"]))


def dated_pages(pages: DataFrame, require_time: bool = True) -> DataFrame:
    """F12 + X1: pages with a <time datetime> and its parsed date."""
    raw = F.regexp_extract("html", H.TIME_RE, 1)
    d = pages.select("page_id", "url", raw.alias("raw_date"), H.publish_date(raw).alias("pub_date"))
    return d.filter(F.col("raw_date") != "") if require_time else d


# ---------------------------------------------------------------- query views
def q_page_text(pages: DataFrame) -> DataFrame:
    return page_text(pages)


def q_page_links(pages: DataFrame) -> DataFrame:
    return page_links(pages)


def q_link_sections(pages: DataFrame) -> DataFrame:
    return link_sections(page_links(pages))


def q_wanted_links(pages: DataFrame) -> DataFrame:
    return wanted_links(page_links(pages))


def q_unseen_links(pages: DataFrame) -> DataFrame:
    seen = pages.select(company_of().alias("company"), F.col("url").alias("link"))
    return unseen_links(page_links(pages), seen)


def q_publish_date(pages: DataFrame) -> DataFrame:
    return dated_pages(pages)

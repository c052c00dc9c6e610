"""Views over the test tables that stand in for the study's inputs.

The study works on OHLCV bars per symbol and on news articles per symbol and
date. The test tables have neither, so these views derive them:

* ``brand_bars``   daily bars per part brand from lineitem x part
* ``event_bars_h`` hourly bars per event type from events (``_6h``: 6-hour)
* ``event_bars_d`` daily bars per event type, weekdays only (gaps on purpose)
* ``long_bars_6h`` the 6-hour bars with an earlier history of the same length
* ``vendor_bars``  the hourly bars under a vendor's column names, the volume of
  some hours missing
* ``articles``     documents spread over 5 symbols and the days of January 2024
* ``news_pages``   pages with a publication stamp (four forms, some without)
  and one more labelled link

Each view has a Spark builder and the same definition as DuckDB SQL (used by
the oracles in ``plans.oracles``). Ties in first/last are broken by unique ids.
All bucketing is done on the NTZ stamps with zone-free functions, so results do
not depend on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import table

ARTICLE_SYMBOLS = ("click", "error", "purchase", "signup", "view")
LINE_SLOTS = 1000   # > the largest line number of an order


def _bars(grouped, price: Column, order: Column, volume: Column):
    return grouped.agg(
        F.min_by(price, order).alias("open"),
        F.max(price).alias("high"),
        F.min(price).alias("low"),
        F.max_by(price, order).alias("close"),
        volume.alias("volume"),
    )


def brand_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars per brand. The lineitem side is the large one: the join is
    left to AQE (broadcast only if the part side measures under the threshold,
    skew splitting otherwise) and the bar aggregate is partial before its
    shuffle, so each task sends at most one row per (brand, day)."""
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey",
               "l_quantity", "l_extendedprice", "l_shipdate")
    part = table(spark, sf_dir, "part", "p_partkey", "p_brand")
    j = li.join(part, li.l_partkey == part.p_partkey)
    price = F.try_divide(F.col("l_extendedprice"), F.col("l_quantity"))
    g = j.groupBy(F.col("p_brand").alias("symbol"), F.to_date("l_shipdate").alias("bar_date"))
    # (orderkey, linenumber) order as one BIGINT (line numbers are 1..7): a
    # fixed-width ordering key keeps min_by/max_by in the hash aggregate (a
    # struct key forces a sort-based aggregate over every lineitem row).
    order = F.col("l_orderkey") * LINE_SLOTS + F.col("l_linenumber")
    return _bars(g, price, order, F.sum("l_quantity"))


def _hour_ntz(ts: Column, step_hours: int = 1) -> Column:
    hour = F.hour(ts) if step_hours == 1 else (F.floor(F.hour(ts) / step_hours) * step_hours).cast("int")
    return F.make_timestamp_ntz(F.year(ts), F.month(ts), F.dayofmonth(ts), hour, F.lit(0), F.lit(0))


def event_bars(spark: SparkSession, sf_dir: str, step_hours: int = 1) -> DataFrame:
    """Intraday bars per event type, ``step_hours`` wide."""
    ev = table(spark, sf_dir, "events", "event_id", "ts", "event_type", "value")
    g = ev.groupBy(F.col("event_type").alias("symbol"), _hour_ntz(F.col("ts"), step_hours).alias("ts"))
    return _bars(g, F.col("value"), F.struct("ts", "event_id"), F.count("*"))


def event_bars_h(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_bars(spark, sf_dir, 1)


def event_bars_6h(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_bars(spark, sf_dir, 6)


def event_bars_d(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars per event type on weekdays only: a trading calendar with gaps."""
    ev = table(spark, sf_dir, "events", "event_id", "ts", "event_type", "value")
    g = ev.groupBy(F.col("event_type").alias("symbol"), F.to_date("ts").alias("bar_date"))
    bars = _bars(g, F.col("value"), F.struct("ts", "event_id"), F.count("*"))
    return bars.filter(F.weekday("bar_date") < 5)


def long_bars_6h(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A coarse series that begins before the finer one, as stored vendor
    histories do: the 6-hour bars, and the same bars moved back by the days
    their symbol spans."""
    b, day = event_bars_6h(spark, sf_dir), F.to_date("ts")
    span = b.groupBy("symbol").agg((F.datediff(F.max(day), F.min(day)) + 1).alias("_days"))
    earlier = b.join(span, "symbol").withColumn("ts", F.col("ts") - F.make_dt_interval("_days")).drop("_days")
    return b.unionByName(earlier)


def vendor_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly bars as a vendor delivers them."""
    b = event_bars_h(spark, sf_dir)
    names = {"open": "1. open", "high": "2. high", "low": "3. low", "close": "4. close", "volume": "5. volume"}
    return b.withColumn("volume", F.when(F.hour("ts") != 3, F.col("volume"))).withColumnsRenamed(names)


# labels of the added link, by page id
PAGE_SECTIONS = ("Technology", "Sports", "Business", "World", "CLIMATE", "Energy & Environment", "Arts")


def news_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as a news site serves them: a <time> stamp before the article (ISO
    date, 'Mon. d, yyyy', stamp with offset; every fourth page has none) and a
    last navigation link labelled with a section."""
    pages = table(spark, sf_dir, "pages", "page_id", "url", "html")
    pid = F.col("page_id")
    day = F.date_add(F.lit("2024-01-01").cast("date"), (pid % 366).cast("int"))
    iso = F.date_format(day, "yyyy-MM-dd")
    stamp = (F.when(pid % 4 == 0, iso).when(pid % 4 == 1, F.replace(F.date_format(day, "MMM. d, yyyy"), F.lit("Sep."), F.lit("Sept.")))
             .when(pid % 4 == 2, F.concat(iso, F.lit("T09:30:00-0500"))))
    section = F.element_at(F.array(*[F.lit(v) for v in PAGE_SECTIONS]), (pid % len(PAGE_SECTIONS) + 1).cast("int"))
    html = F.replace("html", F.lit("<article>"), F.coalesce(F.concat(F.lit('<time datetime="'), stamp, F.lit('"></time><article>')), F.lit("<article>")))
    link = F.concat(F.lit('<li><a href="/s/'), pid, F.lit('">'), section, F.lit("</a></li></ul></nav>"))
    return pages.select("page_id", "url", F.replace(html, F.lit("</ul></nav>"), link).alias("html"))


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as news articles: symbol by ``doc_id % 5``, day by ``doc_id % 30``."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    sym = F.element_at(F.array(*[F.lit(s) for s in ARTICLE_SYMBOLS]), (F.col("doc_id") % 5 + 1).cast("int"))
    return docs.select(
        sym.alias("symbol"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 30).cast("int")).alias("pub_date"),
        F.col("doc_id").alias("article_no"),
        "text",
    )


# DuckDB definitions of the same views (for the oracles).
VIEW_SQL = {
    "brand_bars": """
        SELECT p_brand AS symbol, CAST(l_shipdate AS DATE) AS bar_date,
               arg_min(l_extendedprice / l_quantity, row(l_orderkey, l_linenumber)) AS open,
               max(l_extendedprice / l_quantity) AS high,
               min(l_extendedprice / l_quantity) AS low,
               arg_max(l_extendedprice / l_quantity, row(l_orderkey, l_linenumber)) AS close,
               sum(l_quantity) AS volume
        FROM lineitem JOIN part ON l_partkey = p_partkey
        GROUP BY p_brand, CAST(l_shipdate AS DATE)""",
    "event_bars_h": """
        SELECT event_type AS symbol, date_trunc('hour', ts) AS ts,
               arg_min(value, row(ts, event_id)) AS open, max(value) AS high, min(value) AS low,
               arg_max(value, row(ts, event_id)) AS close, count(*) AS volume
        FROM events GROUP BY event_type, date_trunc('hour', ts)""",
    "event_bars_6h": """
        SELECT event_type AS symbol,
               date_trunc('day', ts) + to_hours(CAST(floor(hour(ts) / 6) * 6 AS BIGINT)) AS ts,
               arg_min(value, row(ts, event_id)) AS open, max(value) AS high, min(value) AS low,
               arg_max(value, row(ts, event_id)) AS close, count(*) AS volume
        FROM events
        GROUP BY event_type, date_trunc('day', ts) + to_hours(CAST(floor(hour(ts) / 6) * 6 AS BIGINT))""",
    "event_bars_d": """
        SELECT * FROM (
          SELECT event_type AS symbol, CAST(ts AS DATE) AS bar_date,
                 arg_min(value, row(ts, event_id)) AS open, max(value) AS high, min(value) AS low,
                 arg_max(value, row(ts, event_id)) AS close, count(*) AS volume
          FROM events GROUP BY event_type, CAST(ts AS DATE)) b
        WHERE isodow(bar_date) < 6""",
    "long_bars_6h": """
        SELECT * FROM event_bars_6h UNION ALL
        SELECT c.symbol, c.ts - to_days(CAST(m.days AS INTEGER)) AS ts, open, high, low, close, volume
        FROM event_bars_6h c JOIN (
          SELECT symbol, date_diff('day', min(CAST(ts AS DATE)), max(CAST(ts AS DATE))) + 1 AS days
          FROM event_bars_6h GROUP BY symbol) m ON m.symbol = c.symbol""",
    "vendor_bars": """
        SELECT symbol, ts, open AS "1. open", high AS "2. high", low AS "3. low", close AS "4. close",
               CASE WHEN hour(ts) <> 3 THEN volume END AS "5. volume" FROM event_bars_h""",
    "news_pages": """
        SELECT page_id, url, replace(replace(html, '<article>',
                 coalesce('<time datetime="' || CASE page_id % 4
                   WHEN 0 THEN strftime(pday, '%Y-%m-%d')
                   WHEN 1 THEN replace(strftime(pday, '%b. %-d, %Y'), 'Sep.', 'Sept.')
                   WHEN 2 THEN strftime(pday, '%Y-%m-%d') || 'T09:30:00-0500' END || '"></time><article>', '<article>')),
               '</ul></nav>', '<li><a href="/s/' || page_id || '">' || ['Technology', 'Sports', 'Business', 'World', 'CLIMATE',
                 'Energy & Environment', 'Arts'][page_id % 7 + 1] || '</a></li></ul></nav>') AS html
        FROM (SELECT *, CAST(DATE '2024-01-01' + CAST(page_id % 366 AS INTEGER) AS DATE) AS pday FROM pages) p""",
    "articles": """
        SELECT CASE doc_id % 5 WHEN 0 THEN 'click' WHEN 1 THEN 'error' WHEN 2 THEN 'purchase'
                               WHEN 3 THEN 'signup' ELSE 'view' END AS symbol,
               CAST(DATE '2024-01-01' + CAST(doc_id % 30 AS INTEGER) AS DATE) AS pub_date,
               doc_id AS article_no, text
        FROM documents""",
}

VIEWS = {
    "brand_bars": brand_bars,
    "event_bars_h": event_bars_h,
    "event_bars_6h": event_bars_6h,
    "event_bars_d": event_bars_d,
    "long_bars_6h": long_bars_6h,
    "vendor_bars": vendor_bars,
    "articles": articles,
    "news_pages": news_pages,
}


def with_views(sql: str, *names: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``sql`` with CTEs for the named views (and extra named CTEs)."""
    parts = [f"{n} AS ({VIEW_SQL[n]})" for n in names]
    parts += [f"{k} AS ({v})" for k, v in (extra or {}).items()]
    if not parts:
        return sql
    return "WITH " + ",\n".join(parts) + "\n" + sql

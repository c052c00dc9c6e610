"""DuckDB SQL oracles: for each registered query, the same result as ANSI SQL
over the pre-registered test tables. Fixture views are inlined as CTEs.
Doubles are rounded with the shared ``R6`` formula on both sides."""

from __future__ import annotations

from ..functions.numeric import R6
from ..sources.fixtures import with_views

ORACLES: dict[str, str] = {}


def oracle(name: str):
    def deco(fn):
        ORACLES[name] = fn()
        return fn
    return deco


# Labelled bars: label (F4), ret (W2), rn/n, positional split.
LB = """
  SELECT symbol, bar_date, open, high, low, close,
         lead(close) OVER w AS next_close,
         CASE WHEN lead(close) OVER w > close THEN 1 ELSE -1 END AS label,
         ln(lead(close) OVER w / close) * 100 AS ret,
         row_number() OVER w AS rn,
         count(*) OVER (PARTITION BY symbol) AS n,
         row_number() OVER w <= floor(count(*) OVER (PARTITION BY symbol) * 0.8) AS is_train,
         row_number() OVER w > floor(count(*) OVER (PARTITION BY symbol) * 0.8) AS is_test
  FROM {src} WINDOW w AS (PARTITION BY symbol ORDER BY bar_date)"""


def lb(src: str = "brand_bars") -> str:
    return LB.format(src=src)


# ------------------------------------------------------------------ bars
@oracle("daily_bars")
def _():
    return with_views(f"""
SELECT symbol, 'daily' AS interval, bar_date, {R6('open')} AS open, {R6('high')} AS high,
       {R6('low')} AS low, {R6('close')} AS close, {R6('volume')} AS volume
FROM brand_bars
WHERE open IS NOT NULL AND high IS NOT NULL AND low IS NOT NULL AND close IS NOT NULL
  AND volume IS NOT NULL""", "brand_bars")


@oracle("price_features")
def _():
    return with_views(f"""
SELECT symbol, bar_date, {R6('open - close')} AS open_close, {R6('high - low')} AS high_low
FROM brand_bars""", "brand_bars")


@oracle("direction_label")
def _():
    return with_views(f"""
SELECT symbol, bar_date, {R6('close')} AS close, {R6('next_close')} AS next_close, label
FROM lb""", "brand_bars", extra={"lb": lb()})


@oracle("label_recode")
def _():
    return with_views("""
SELECT symbol, bar_date, label, class_idx,
       CAST(2.0 * (class_idx - min(class_idx) OVER (PARTITION BY symbol))
            / nullif(max(class_idx) OVER (PARTITION BY symbol) - min(class_idx) OVER (PARTITION BY symbol), 0)
            - 1 AS INTEGER) AS label_pm
FROM (SELECT symbol, bar_date, label, CASE WHEN label = -1 THEN 1 ELSE 2 END AS class_idx FROM lb) x
""", "brand_bars", extra={"lb": lb()})


@oracle("log_return")
def _():
    return with_views(f"SELECT symbol, bar_date, {R6('ret')} AS ret FROM lb",
                      "brand_bars", extra={"lb": lb()})


@oracle("positional_split")
def _():
    return with_views("""
SELECT symbol, bar_date, rn, n, is_train, is_test,
       rn <= CAST(round(n * 0.8) AS BIGINT) AS ov_train,
       rn >= CAST(round(n * 0.8) AS BIGINT) AS ov_test
FROM lb""", "brand_bars", extra={"lb": lb()})


@oracle("missing_series")
def _missing_series_sql() -> str:
    return with_views("""
SELECT g.symbol, g.interval FROM grid g
WHERE NOT EXISTS (SELECT 1 FROM stored s WHERE s.symbol = g.symbol AND s.interval = g.interval)""",
        "brand_bars", "event_bars_h", "event_bars_6h", extra={
            "stored": """
  SELECT DISTINCT symbol, 'daily' AS interval FROM brand_bars
  UNION ALL SELECT DISTINCT symbol, '60min' FROM event_bars_h
  UNION ALL SELECT DISTINCT symbol, '360min' FROM event_bars_6h""",
            "grid": """
  SELECT symbol, unnest(['daily', '60min', '30min', '15min', '5min', '1min']) AS interval
  FROM (SELECT DISTINCT symbol FROM stored) s"""})


# ------------------------------------------------------------------ backtest
def _curves(signals: dict[str, str], src: str = "brand_bars", sfx: str = "") -> dict[str, str]:
    """CTEs lb, lbs, pred, cur (cumulative curves, all rows); names get ``sfx``."""
    arms = " UNION ALL ".join(
        f"SELECT *, '{k}' AS strategy, CAST({v} AS INTEGER) AS signal FROM lbs{sfx}" for k, v in signals.items())
    return {
        f"lb{sfx}": lb(src),
        f"lbs{sfx}": f"SELECT *, coalesce(lag(label) OVER (PARTITION BY symbol ORDER BY bar_date), 1) AS prev FROM lb{sfx}",
        f"pred{sfx}": arms,
        f"cur{sfx}": f"""
  SELECT *, signal * ret AS strat_ret,
         CASE WHEN is_test AND ret IS NOT NULL
              THEN sum(CASE WHEN is_test THEN ret END) OVER c END AS cum_ret,
         CASE WHEN is_test AND ret IS NOT NULL
              THEN sum(CASE WHEN is_test THEN signal * ret END) OVER c END AS cum_strat_ret
  FROM pred{sfx}
  WINDOW c AS (PARTITION BY symbol, strategy ORDER BY bar_date
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    }


RULES = {"long": "1", "prev_dir": "prev", "contrarian": "-prev"}

BT_SUMMARY = """
  SELECT symbol, strategy,
         count(CASE WHEN is_train THEN 1 END) AS n_train,
         count(CASE WHEN is_test THEN 1 END) AS n_test,
         avg(CASE WHEN is_train THEN CAST(signal = label AS DOUBLE) END) * 100 AS train_acc,
         avg(CASE WHEN is_test THEN CAST(signal = label AS DOUBLE) END) * 100 AS test_acc,
         avg(cum_strat_ret - cum_ret) / nullif(stddev_samp(cum_strat_ret), 0) AS sharpe
  FROM cur GROUP BY symbol, strategy"""


@oracle("backtest_cum_return")
def _():
    return with_views(f"""
SELECT symbol, bar_date, signal, label, {R6('ret')} AS ret, {R6('cum_ret')} AS cum_ret,
       {R6('strat_ret')} AS strat_ret, {R6('cum_strat_ret')} AS cum_strat_ret
FROM cur WHERE is_test""", "brand_bars", extra=_curves({"prev_dir": "prev"}))


@oracle("backtest_sharpe")
def _():
    return with_views(f"""
SELECT symbol, n_train, n_test, {R6('train_acc')} AS train_acc, {R6('test_acc')} AS test_acc,
       {R6('sharpe')} AS sharpe
FROM summ""", "brand_bars", extra={**_curves({"prev_dir": "prev"}), "summ": BT_SUMMARY})


@oracle("backtest_overall")
def _():
    return with_views(f"""
SELECT strategy, count(*) AS n_symbols, {R6('avg(test_acc)')} AS mean_test_acc,
       {R6('stddev_samp(test_acc)')} AS std_test_acc
FROM summ GROUP BY strategy""", "brand_bars", extra={**_curves(RULES), "summ": BT_SUMMARY})


@oracle("strategy_curves_wide")
def _():
    cols = ", ".join(f"{R6(f'max(CASE WHEN strategy = {chr(39)}{k}{chr(39)} THEN cum_strat_ret END)')} AS {k}"
                     for k in RULES)
    return with_views(f"""
SELECT symbol, bar_date, {R6("max(CASE WHEN strategy = 'long' THEN cum_ret END)")} AS market, {cols}
FROM cur WHERE is_test GROUP BY symbol, bar_date""", "brand_bars", extra=_curves(RULES))


# ------------------------------------------------------------------ stitch
@oracle("stitch_intervals")
def _():
    return with_views(f"""
SELECT symbol, ts, source_interval, {R6('open')} AS open, {R6('high')} AS high, {R6('low')} AS low,
       {R6('close')} AS close, CAST(volume AS BIGINT) AS volume
FROM (
  SELECT c.*, '360min' AS source_interval FROM long_bars_6h c
  LEFT JOIN cut USING (symbol)
  WHERE cut.cut IS NULL OR c.ts <= cut.cut
  UNION ALL
  SELECT f.*, '60min' AS source_interval FROM fine f
  JOIN cut USING (symbol)
  JOIN (SELECT symbol, min(ts) AS first_ts FROM fine GROUP BY symbol) m USING (symbol)
  WHERE f.ts > m.first_ts) u""", "event_bars_h", "event_bars_6h", "long_bars_6h", extra={
        "fine": "SELECT * FROM event_bars_h",
        "cut": """SELECT f.symbol, min(f.ts) AS cut FROM fine f
                  WHERE EXISTS (SELECT 1 FROM long_bars_6h c WHERE c.symbol = f.symbol AND c.ts = f.ts)
                  GROUP BY f.symbol"""})


# ------------------------------------------------------------------ text
from ..functions.text import (STOP_SQL, sanitize_sql, sentences_sql,  # noqa: E402
                              substring_count_sql, tokens_sql)

SENTS = f"""
  SELECT doc_id, unnest(range(len(s))) AS sent_no, unnest(s) AS sentence
  FROM (SELECT doc_id, {sentences_sql(sanitize_sql('text'))} AS s FROM docsrc) d"""
TOKS = f"""
  SELECT doc_id, sent_no, word FROM (
    SELECT doc_id, sent_no, unnest({tokens_sql('sentence')}) AS word FROM sents) t
  WHERE NOT list_contains({STOP_SQL}, word)"""
SCORES = """
  SELECT doc_id, sent_no, sum(freq) AS score FROM (
    SELECT doc_id, sent_no, count(*) OVER (PARTITION BY doc_id, word) AS freq FROM toks) f
  GROUP BY doc_id, sent_no"""
SUMMARY = """
  SELECT d.doc_id,
         coalesce(string_agg(s.sentence, ' ' ORDER BY s.sent_no) FILTER (WHERE sc.score > 0), '') AS summary,
         count(*) FILTER (WHERE sc.score > 0) AS n_sentences
  FROM docsrc d
  JOIN sents s ON s.doc_id = d.doc_id
  LEFT JOIN scores sc ON sc.doc_id = s.doc_id AND sc.sent_no = s.sent_no
  GROUP BY d.doc_id"""
TEXT_CTES = {"docsrc": "SELECT doc_id, text FROM documents", "sents": SENTS, "toks": TOKS, "scores": SCORES}


@oracle("sanitized_text")
def _():
    return f"SELECT doc_id, {sanitize_sql('text')} AS clean, CAST(length({sanitize_sql('text')}) AS BIGINT) AS n_clean FROM documents"


@oracle("word_freq")
def _():
    return with_views("SELECT doc_id, word, count(*) AS freq FROM toks GROUP BY doc_id, word", extra=TEXT_CTES)


@oracle("sentence_scores")
def _():
    return with_views("SELECT doc_id, CAST(sent_no AS BIGINT) AS sent_no, CAST(score AS BIGINT) AS score FROM scores",
                      extra=TEXT_CTES)


@oracle("extractive_summary")
def _():
    return with_views("SELECT doc_id, summary, CAST(n_sentences AS BIGINT) AS n_sentences FROM summ",
                      extra={**TEXT_CTES, "summ": SUMMARY})


# ------------------------------------------------------------------ keywords
def _keyword_ctes(steps: int = 10) -> dict[str, str]:
    kept = f"list_filter({tokens_sql('summary')}, lambda x: NOT list_contains({STOP_SQL}, x))"
    c = {**TEXT_CTES, "summ": SUMMARY,
         "ktoks": f"SELECT doc_id, {kept} AS toks FROM summ",
         "pairs": """SELECT doc_id, toks[i] AS src, toks[i + 1] AS dst
                     FROM (SELECT doc_id, toks, unnest(range(1, len(toks))) AS i FROM ktoks) p""",
         "edges": """SELECT DISTINCT doc_id, src, dst FROM (
                       SELECT doc_id, src, dst FROM pairs WHERE src <> dst
                       UNION ALL SELECT doc_id, dst, src FROM pairs WHERE src <> dst) e""",
         "deg": "SELECT doc_id, src AS word, count(*) AS deg FROM edges GROUP BY doc_id, src",
         "nodes": """SELECT n.doc_id, n.word, n.n_nodes, coalesce(d.deg, 0) AS deg FROM (
                       SELECT doc_id, unnest(list_distinct(toks)) AS word,
                              CAST(len(list_distinct(toks)) AS BIGINT) AS n_nodes FROM ktoks) n
                     LEFT JOIN deg d ON d.doc_id = n.doc_id AND d.word = n.word""",
         "r0": "SELECT doc_id, word, n_nodes, deg, 1.0::DOUBLE / n_nodes AS rank FROM nodes"}
    for i in range(1, steps + 1):
        c[f"r{i}"] = f"""
          SELECT b.doc_id, b.word, b.n_nodes, b.deg,
                 0.15::DOUBLE / b.n_nodes + 0.85::DOUBLE * coalesce(s.inflow, 0.0::DOUBLE) AS rank
          FROM nodes b LEFT JOIN (
            SELECT e.doc_id, e.dst AS word, sum(p.rank / p.deg) AS inflow
            FROM edges e JOIN r{i - 1} p ON p.doc_id = e.doc_id AND p.word = e.src
            GROUP BY e.doc_id, e.dst) s ON s.doc_id = b.doc_id AND s.word = b.word"""
    c["kw"] = f"""
      SELECT * FROM (
        SELECT doc_id, word, n_nodes, rank,
               row_number() OVER (PARTITION BY doc_id ORDER BY floor(rank * 1e12 + 0.5) DESC, word) AS kw_rank
        FROM r{steps}) k
      WHERE kw_rank <= floor(n_nodes * 0.2::DOUBLE)"""
    c["alltoks"] = f"""
      SELECT doc_id, unnest(range(len(t))) AS pos, unnest(t) AS word
      FROM (SELECT doc_id, {tokens_sql('summary')} AS t FROM summ) a"""
    c["phr"] = """
      SELECT DISTINCT doc_id, phrase, n_words FROM (
        SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS phrase, count(*) AS n_words
        FROM (SELECT t.doc_id, t.pos, t.word,
                     t.pos - row_number() OVER (PARTITION BY t.doc_id ORDER BY t.pos) AS island
              FROM alltoks t
              WHERE EXISTS (SELECT 1 FROM kw WHERE kw.doc_id = t.doc_id AND kw.word = t.word)) x
        GROUP BY doc_id, island HAVING count(*) >= 2) y"""
    return c


@oracle("textrank_keywords")
def _():
    return with_views(f"SELECT doc_id, word, {R6('rank')} AS rank, CAST(kw_rank AS BIGINT) AS kw_rank FROM kw",
                      extra=_keyword_ctes())


@oracle("keyword_phrases")
def _():
    return with_views("SELECT doc_id, phrase, CAST(n_words AS BIGINT) AS n_words FROM phr", extra=_keyword_ctes())


@oracle("keyword_substring_count")
def _():
    return with_views(f"""
SELECT k.doc_id, k.keyword, {substring_count_sql('s.summary', 'k.keyword')} AS cnt
FROM (SELECT doc_id, word AS keyword FROM kw UNION ALL SELECT doc_id, phrase FROM phr) k
JOIN summ s ON s.doc_id = k.doc_id""", extra=_keyword_ctes())


# ------------------------------------------------------------------ harvest
from ..functions.html import paragraphs_sql  # noqa: E402

COMPANY_SQL = """CASE page_id % 5 WHEN 0 THEN 'click' WHEN 1 THEN 'error' WHEN 2 THEN 'purchase'
                 WHEN 3 THEN 'signup' ELSE 'view' END"""
LI_RE_SQL = """'<li[^>]*>[ \\t\\n\\r\\f]*<a[^>]*href="([^"]*)"[^>]*>([^<]*)</a>'"""
LINKS_OF = f"""
  SELECT {COMPANY_SQL} AS company, page_id, CAST(pos AS BIGINT) AS pos,
         CASE WHEN starts_with(href, 'http') THEN href
              ELSE regexp_extract(url, '^(https?://[^/]+)', 1) || href END AS link,
         trim(section) AS section
  FROM (SELECT page_id, url,
               unnest(range(len(regexp_extract_all(html, {LI_RE_SQL}, 1)))) AS pos,
               unnest(regexp_extract_all(html, {LI_RE_SQL}, 1)) AS href,
               unnest(regexp_extract_all(html, {LI_RE_SQL}, 2)) AS section
        FROM {{pages}}) x"""
LINKS = LINKS_OF.format(pages="pages")


@oracle("page_text")
def _():
    p = paragraphs_sql("html")
    return f"""
SELECT page_id, url, trim(array_to_string({p}, ' ')) AS text, CAST(len({p}) AS BIGINT) AS n_paragraphs
FROM pages"""


@oracle("page_links")
def _():
    return LINKS


@oracle("link_sections")
def _():
    return with_views("""
SELECT company, lower(section) AS section, count(*) AS n_links, count(DISTINCT link) AS n_distinct,
       lower(section) IN ('technology', 'business', 'climate', 'energy & environment') AS wanted
FROM links GROUP BY company, lower(section)""", "news_pages", extra={"links": LINKS_OF.format(pages="news_pages")})


@oracle("unseen_links")
def _():
    return with_views(f"""
SELECT DISTINCT company, link FROM links l
WHERE NOT EXISTS (SELECT 1 FROM pages p WHERE {COMPANY_SQL.replace('page_id', 'p.page_id')} = l.company
                  AND p.url = l.link)""", extra={"links": LINKS})


@oracle("wanted_links")
def _():
    return with_views("""
SELECT company, page_id, pos, link, section FROM links
WHERE lower(section) IN ('technology', 'business', 'climate', 'energy & environment')""", "news_pages",
                      extra={"links": LINKS_OF.format(pages="news_pages")})


PAGE_DATES = """
SELECT page_id, url, raw_date,
       coalesce(CAST(try_strptime(raw_date, '%Y-%m-%d') AS DATE),
                CAST(try_strptime(replace(raw_date, 'Sept', 'Sep'), '%b. %d, %Y') AS DATE),
                CASE WHEN try_strptime(raw_date, '%Y-%m-%dT%H:%M:%S%z') IS NOT NULL
                     THEN CAST(try_strptime(left(raw_date, 10), '%Y-%m-%d') AS DATE) END) AS pub_date
FROM (SELECT page_id, url, regexp_extract(html, '<time[^>]*datetime="([^"]*)"', 1) AS raw_date FROM {pages}) p
WHERE raw_date <> ''"""


@oracle("publish_date")
def _():
    return with_views(PAGE_DATES.format(pages="news_pages"), "news_pages")


# ------------------------------------------------------------------ news
NEWS_CTES = {
    "aw": f"""
      SELECT symbol, pub_date, article_no, word, count(*) AS cnt FROM (
        SELECT symbol, pub_date, article_no, unnest({tokens_sql('text')}) AS word FROM articles) t
      WHERE NOT list_contains({STOP_SQL}, word)
      GROUP BY symbol, pub_date, article_no, word""",
    "dwc": "SELECT symbol, pub_date, word, sum(cnt) AS cnt FROM aw GROUP BY symbol, pub_date, word",
    "present": """
      SELECT d.symbol, d.pub_date, o.off AS \"offset\", b.bar_date, b.open, b.close
      FROM (SELECT DISTINCT symbol, pub_date FROM articles) d
      CROSS JOIN (SELECT unnest([0, 1, 3, 5]) AS off) o
      JOIN event_bars_d b ON b.symbol = d.symbol AND b.bar_date = CAST(d.pub_date + o.off AS DATE)""",
    "ex0": """
      SELECT * , CASE WHEN close - open0 >= 0 THEN 1 ELSE -1 END AS label FROM (
        SELECT *, count(*) OVER w AS n_present, min(\"offset\") OVER w AS first_offset,
               arg_min(open, \"offset\") OVER w AS open0
        FROM present WINDOW w AS (PARTITION BY symbol, pub_date)) p
      WHERE n_present >= 3 AND \"offset\" > first_offset""",
    "ex": """
      SELECT * FROM ex0 WHERE symbol IN (
        SELECT symbol FROM ex0 GROUP BY symbol HAVING min(label) <> max(label))""",
    "totals": "SELECT symbol, word, sum(cnt) AS total FROM aw GROUP BY symbol, word",
    "vocab": """
      SELECT * FROM (
        SELECT symbol, word, total,
               row_number() OVER (PARTITION BY symbol ORDER BY total DESC, word) AS pos,
               count(*) OVER (PARTITION BY symbol) AS n
        FROM totals) v
      WHERE pos <= floor(n / 4)""",
    "vec": """
      SELECT symbol, bar_date, word, sum(cnt) AS cnt FROM (
        SELECT c.symbol, CAST(c.pub_date + o.off AS DATE) AS bar_date, c.word, c.cnt
        FROM dwc c CROSS JOIN (SELECT unnest([0, 3, 5]) AS off) o) h
      WHERE EXISTS (SELECT 1 FROM event_bars_d b WHERE b.symbol = h.symbol AND b.bar_date = h.bar_date)
        AND EXISTS (SELECT 1 FROM vocab v WHERE v.symbol = h.symbol AND v.word = h.word)
      GROUP BY symbol, bar_date, word HAVING sum(cnt) <> 0""",
    "terms": """SELECT e.symbol, e.pub_date, e.\"offset\", e.label, c.word, c.cnt
                FROM ex e JOIN dwc c ON c.symbol = e.symbol AND c.pub_date = e.pub_date""",
    "weights": """
      SELECT symbol, word, ln((up + 1.0::DOUBLE) / (down + 1.0::DOUBLE)) AS w FROM (
        SELECT symbol, word, sum(CASE WHEN label = 1 THEN cnt ELSE 0 END) AS up,
               sum(CASE WHEN label = -1 THEN cnt ELSE 0 END) AS down
        FROM terms GROUP BY symbol, word) x""",
    "scores": """
      SELECT symbol, bar_date, 1.0::DOUBLE - 1.0::DOUBLE / (1.0::DOUBLE + exp(-z)) AS p_down,
             1.0::DOUBLE / (1.0::DOUBLE + exp(-z)) AS p_up FROM (
        SELECT v.symbol, v.bar_date, sum(v.cnt * w.w) AS z
        FROM vec v JOIN weights w ON w.symbol = v.symbol AND w.word = v.word
        GROUP BY v.symbol, v.bar_date) s""",
}


@oracle("news_label_examples")
def _():
    return with_views(f"""
SELECT symbol, pub_date, "offset", bar_date, label, {R6('open0')} AS open0, {R6('close')} AS close FROM ex""",
                      "articles", "event_bars_d", extra=NEWS_CTES)


@oracle("day_word_counts")
def _():
    return with_views("SELECT symbol, pub_date, word, CAST(cnt AS BIGINT) AS cnt FROM dwc", "articles",
                      "event_bars_d", extra=NEWS_CTES)


@oracle("daily_news_vector")
def _():
    return with_views("SELECT symbol, word, bar_date, CAST(cnt AS BIGINT) AS cnt FROM vec", "articles",
                      "event_bars_d", extra=NEWS_CTES)


@oracle("attach_news_scores")
def _():
    return with_views(f"""
SELECT b.symbol, b.bar_date, {R6('b.close')} AS close, {R6('coalesce(s.p_down, 0.0)')} AS p_down,
       {R6('coalesce(s.p_up, 0.0)')} AS p_up
FROM event_bars_d b LEFT JOIN scores s ON s.symbol = b.symbol AND s.bar_date = b.bar_date""",
                      "articles", "event_bars_d", extra=NEWS_CTES)


@oracle("cut_at_first_article")
def _():
    return with_views(f"""
SELECT b.symbol, b.bar_date, {R6('b.open')} AS open, {R6('b.close')} AS close
FROM event_bars_d b LEFT JOIN (
  SELECT f.symbol, f.first_date FROM (SELECT symbol, min(pub_date) AS first_date FROM articles GROUP BY symbol) f
  WHERE EXISTS (SELECT 1 FROM event_bars_d x WHERE x.symbol = f.symbol AND x.bar_date = f.first_date)) t
  ON t.symbol = b.symbol
WHERE t.first_date IS NULL OR b.bar_date >= t.first_date""", "articles", "event_bars_d", extra=NEWS_CTES)


@oracle("top_quarter_vocab")
def _():
    return with_views("SELECT symbol, word, CAST(total AS BIGINT) AS total, CAST(pos AS BIGINT) AS pos FROM vocab",
                      "articles", "event_bars_d", extra=NEWS_CTES)


# ------------------------------------------------------------------ select
from ..functions.stats import chi2_critical_1df_sql  # noqa: E402

SELECT_CTES = {
    "ex": f"""SELECT {COMPANY_SQL.replace('page_id', 'doc_id')} AS symbol, doc_id AS example_id, quality AS label
              FROM labels""",
    "terms": f"""
      SELECT symbol, example_id, word, count(*) AS cnt FROM (
        SELECT {COMPANY_SQL.replace('page_id', 'doc_id')} AS symbol, doc_id AS example_id,
               unnest({tokens_sql('text')}) AS word
        FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)) t
      WHERE NOT list_contains({STOP_SQL}, word)
      GROUP BY symbol, example_id, word""",
    "shares": """
      SELECT c.symbol, c.label, c.n_c / n.n AS share FROM
        (SELECT symbol, label, count(*) AS n_c FROM ex GROUP BY symbol, label) c
        JOIN (SELECT symbol, count(*) AS n FROM ex GROUP BY symbol) n ON n.symbol = c.symbol""",
    "obs": """
      SELECT t.symbol, t.word, e.label, sum(t.cnt) AS o
      FROM terms t JOIN ex e ON e.symbol = t.symbol AND e.example_id = t.example_id
      GROUP BY t.symbol, t.word, e.label""",
    "scores": """
      SELECT symbol, word, CAST(total AS BIGINT) AS total, s / total - total AS chi2 FROM (
        SELECT o.symbol, o.word, sum(o.o * o.o / sh.share) AS s, sum(o.o) AS total
        FROM obs o JOIN shares sh ON sh.symbol = o.symbol AND sh.label = o.label
        GROUP BY o.symbol, o.word) x""",
}


def _sel(where_sql: str, extra: dict | None = None) -> str:
    return with_views(f"SELECT symbol, word, total, {R6('chi2')} AS chi2 FROM {where_sql}",
                      extra={**SELECT_CTES, **(extra or {})})


@oracle("chi2_scores")
def _():
    return _sel("scores")


@oracle("select_k_best")
def _():
    return _sel("(SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY chi2 DESC, word) AS r FROM scores) k "
                "WHERE r <= 200")


@oracle("select_fpr")
def _():
    return _sel(f"scores WHERE chi2 > {chi2_critical_1df_sql('0.005::DOUBLE')}")


@oracle("select_fwe")
def _():
    return _sel(f"(SELECT *, count(*) OVER (PARTITION BY symbol) AS m FROM scores) f "
                f"WHERE chi2 > {chi2_critical_1df_sql('0.005::DOUBLE / m')}")


@oracle("select_fdr")
def _():
    ok = f"chi2 >= {chi2_critical_1df_sql('0.005::DOUBLE * i / m')}"
    return _sel("fdr2 WHERE chi2 >= cut", extra={
        "fdr0": """SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY chi2 DESC, word) AS i,
                          count(*) OVER (PARTITION BY symbol) AS m FROM scores""",
        "fdr1": f"SELECT *, max(CASE WHEN {ok} THEN i END) OVER (PARTITION BY symbol) AS istar FROM fdr0",
        "fdr2": "SELECT *, max(CASE WHEN i = istar THEN chi2 END) OVER (PARTITION BY symbol) AS cut FROM fdr1"})


@oracle("select_percentile")
def _():
    return _sel("p3 WHERE chi2 > thr OR tie <= floor(n * 10 / 100) - above", extra={
        "p0": """SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY chi2, word) AS rn,
                        count(*) OVER (PARTITION BY symbol) AS n,
                        (count(*) OVER (PARTITION BY symbol) - 1) * 0.9::DOUBLE AS h FROM scores""",
        "p1": """SELECT *, h - floor(h) AS frac,
                        max(CASE WHEN rn = floor(h) + 1 THEN chi2 END) OVER (PARTITION BY symbol) AS a,
                        max(CASE WHEN rn = least(floor(h) + 2, n) THEN chi2 END) OVER (PARTITION BY symbol) AS b
                 FROM p0""",
        "p2": """SELECT *, count(CASE WHEN chi2 > thr THEN 1 END) OVER (PARTITION BY symbol) AS above
                 FROM (SELECT *, a + frac * (b - a) AS thr FROM p1) t""",
        "p3": """SELECT *, CASE WHEN chi2 = thr THEN row_number() OVER (PARTITION BY symbol, chi2 = thr ORDER BY word)
                            END AS tie FROM p2"""})


# ------------------------------------------------------------------ literal-weight scorers
def _sig(z: str) -> str:
    return f"(1.0::DOUBLE / (1.0::DOUBLE + exp(-({z}))))"


def _lin(ws, xs) -> str:
    # same association as ticktale.functions.kernels.dot: ((x0*w0 + x1*w1) + x2*w2)
    acc = None
    for x, w in zip(xs, ws):
        t = f"({x} * {format(float(w), '.17e')})"
        acc = t if acc is None else f"({acc} + {t})"
    return acc


@oracle("sigmoid_score")
def _():
    from ..operators.models import SIGMOID_THETA as T
    z = (f"({format(T[0], '.17e')} + {format(T[1], '.17e')} * (open - close)) "
         f"+ {format(T[2], '.17e')} * (high - low)")
    return with_views(f"""
SELECT symbol, bar_date, {R6(_sig(z))} AS p, CASE WHEN {_sig(z)} >= 0.5 THEN 1 ELSE -1 END AS pred
FROM brand_bars""", "brand_bars")


@oracle("mlp_forward")
def _():
    from ..operators.models import THETA1, THETA2
    a1 = ["1.0::DOUBLE", "(open - close)", "(high - low)"]
    hid = [_sig(_lin(row, a1)) for row in THETA1]
    a2 = ["1.0::DOUBLE"] + hid
    outs = [_sig(_lin(row, a2)) for row in THETA2]
    return with_views(f"""
SELECT symbol, bar_date, {R6('o[1]')} AS h1, {R6('o[2]')} AS h2,
       CAST(list_position(o, list_max(o)) AS BIGINT) AS pred_class
FROM (SELECT symbol, bar_date, [{', '.join(outs)}] AS o FROM brand_bars) x""", "brand_bars")


# ------------------------------------------------------------------ knn
SQD_SQL = ("list_reduce(list_transform(list_zip(a.vec, b.vec), lambda p: (p[1] - p[2]) * (p[1] - p[2])), "
           "lambda acc, v: acc + v)")
EMB = {"emb": "SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS vec, label, (vec_id * 7919) % 1000 >= 200 AS is_train FROM embeddings"}


@oracle("knn_classify")
def _():
    return with_views("""
SELECT vec_id, label, CAST(pred AS INTEGER) AS pred, votes FROM (
  SELECT test_id AS vec_id, qlabel AS label, nlabel AS pred, count(*) AS votes,
         row_number() OVER (PARTITION BY test_id ORDER BY count(*) DESC, nlabel) AS r
  FROM (
    SELECT a.id AS test_id, a.label AS qlabel, b.label AS nlabel,
           row_number() OVER (PARTITION BY a.id ORDER BY """ + SQD_SQL + """, b.id) AS rn
    FROM emb a, emb b WHERE NOT a.is_train AND b.is_train) n
  WHERE rn <= 5
  GROUP BY test_id, qlabel, nlabel) v
WHERE r = 1""", extra=EMB)


@oracle("feature_normalize")
def _():
    return with_views(f"""
SELECT e.id AS vec_id,
       list_transform(list_zip(e.vec, s.mu, s.sd), lambda p: {R6('(p[1] - p[2]) / (p[3] + 1e-7)')}) AS norm
FROM emb e, (
  SELECT list(mu ORDER BY dim) AS mu, list(coalesce(sd, 0.0) ORDER BY dim) AS sd FROM (
    SELECT dim, avg(x) AS mu, stddev_samp(x) AS sd FROM (
      SELECT unnest(range(len(vec))) AS dim, unnest(vec) AS x FROM emb WHERE is_train) t
    GROUP BY dim) d) s""", extra=EMB)


# ------------------------------------------------------------------ boosting
def _boost_ctes(rounds: int, rows_sql: str | None = None) -> dict[str, str]:
    c = {"lb": lb(),
         "rows": rows_sql or """SELECT symbol, rn AS rid, label AS y, is_train, is_test,
                           [close, open, high, low, open - close, high - low] AS xs FROM lb""",
         "train": "SELECT symbol, rid, y, xs FROM rows WHERE is_train",
         "w1": """SELECT t.symbol, t.rid, 1.0::DOUBLE / n.n AS w FROM train t
                  JOIN (SELECT symbol, count(*) AS n FROM train GROUP BY symbol) n ON n.symbol = t.symbol"""}
    for r in range(1, rounds + 1):
        c[f"long{r}"] = f"""
          SELECT symbol, rid, y, fno, xs[fno] AS x, w,
                 CASE WHEN y = 1 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS lab FROM (
            SELECT t.symbol, t.rid, t.y, t.xs, w.w, unnest(range(1, len(t.xs) + 1)) AS fno
            FROM train t JOIN w{r} w ON w.symbol = t.symbol AND w.rid = t.rid) u"""
        c[f"d{r}"] = f"""
          SELECT *, CASE WHEN nx IS NULL OR nx > x THEN abs(cc + (t0 - c0) - (t1 + t0) / 2) ELSE 0.0::DOUBLE END AS nc,
                 CAST(sign(cc + (t0 - c0) - (t1 + t0) / 2) AS INTEGER) AS flag,
                 CASE WHEN nx IS NULL THEN x + 1e-4 ELSE 5e-1 * (x + nx) END AS thresh
          FROM (SELECT *, sum(lab * w) OVER run AS cc, sum((1 - lab) * w) OVER run AS c0,
                       sum(lab * w) OVER whole AS t1, sum((1 - lab) * w) OVER whole AS t0,
                       lead(x) OVER o AS nx, row_number() OVER o AS pos
                FROM long{r}
                WINDOW o AS (PARTITION BY symbol, fno ORDER BY x, rid),
                       run AS (PARTITION BY symbol, fno ORDER BY x, rid
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                       whole AS (PARTITION BY symbol, fno)) s"""
        c[f"pf{r}"] = f"""
          SELECT symbol, fno, thresh, flag AS polarity, nc + 5e-1 AS perf FROM (
            SELECT *, row_number() OVER (PARTITION BY symbol, fno
                                         ORDER BY floor(nc * 1e12 + 5e-1) DESC, pos) AS k FROM d{r}) x
          WHERE k = 1"""
        c[f"s{r}"] = f"""
          SELECT symbol, fno, thresh, polarity, perf FROM (
            SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY floor(perf * 1e12 + 5e-1) DESC, fno) AS k
            FROM pf{r}) x WHERE k = 1"""
        c[f"p{r}"] = f"""
          SELECT t.symbol, t.rid, t.y, w.w, s.fno, s.thresh, s.polarity,
                 (2 * CAST(t.xs[s.fno] < s.thresh AS INTEGER) - 1) * s.polarity AS pred
          FROM train t JOIN w{r} w ON w.symbol = t.symbol AND w.rid = t.rid JOIN s{r} s ON s.symbol = t.symbol"""
        c[f"e{r}"] = f"""
          SELECT symbol, error, 5e-1 * ln((1.0::DOUBLE - ec) / ec) AS alpha FROM (
            SELECT symbol, error, least(greatest(error, 1e-10), 1 - 1e-10) AS ec FROM (
              SELECT symbol, sum(CAST(pred <> y AS DOUBLE) * w) / sum(w) AS error FROM p{r} GROUP BY symbol) a) b"""
        c[f"u{r}"] = f"""
          SELECT p.symbol, p.rid, p.w * exp(-e.alpha * p.pred * p.y) AS w2
          FROM p{r} p JOIN e{r} e ON e.symbol = p.symbol"""
        c[f"z{r}"] = f"SELECT symbol, sum(w2) AS z FROM u{r} GROUP BY symbol"
        c[f"w{r + 1}"] = f"SELECT u.symbol, u.rid, u.w2 / z.z AS w FROM u{r} u JOIN z{r} z ON z.symbol = u.symbol"
        c[f"out{r}"] = f"""
          SELECT s.symbol, {r} AS round, s.fno, s.thresh, s.polarity, s.perf, e.error, e.alpha, z.z
          FROM s{r} s JOIN e{r} e ON e.symbol = s.symbol JOIN z{r} z ON z.symbol = s.symbol"""
    return c


@oracle("best_stump")
def _():
    return with_views(f"""
SELECT symbol, CAST(fno AS INTEGER) AS fno, {R6('thresh')} AS thresh, CAST(polarity AS INTEGER) AS polarity,
       {R6('perf')} AS perf FROM s1""", "brand_bars", extra=_boost_ctes(1))


@oracle("model_with_news")
def _():
    rows = """
      SELECT symbol || '|price' AS symbol, rn AS rid, label AS y, is_train, is_test, [open - close, high - low] AS xs FROM lbn
      UNION ALL
      SELECT l.symbol || '|news', rn, label, is_train, is_test, [l.open - l.close, l.high - l.low, p_down, p_up]
      FROM lbn l JOIN nb ON nb.symbol = l.symbol AND nb.bar_date = l.bar_date"""
    nb = f"""SELECT b.*, {R6('coalesce(s.p_down, 0.0)')} AS p_down, {R6('coalesce(s.p_up, 0.0)')} AS p_up
             FROM event_bars_d b LEFT JOIN scores s ON s.symbol = b.symbol AND s.bar_date = b.bar_date"""
    acc = """
      SELECT split_part(r.symbol, '|', 1) AS symbol, split_part(r.symbol, '|', 2) AS half, count(*) AS n, s.fno, s.perf,
             avg(CASE WHEN (CASE WHEN r.xs[s.fno] < s.thresh THEN 1 ELSE -1 END) * s.polarity = r.y
                 THEN 100.0::DOUBLE ELSE 0.0::DOUBLE END) AS acc
      FROM rows r JOIN s1 s ON s.symbol = r.symbol WHERE r.is_test GROUP BY ALL"""
    boost = {k: v for k, v in _boost_ctes(1, rows).items() if k != "lb"}
    return with_views(f"""
SELECT p.symbol, p.n AS n_test, CAST(p.fno AS INTEGER) AS fno_base, CAST(q.fno AS INTEGER) AS fno_news,
  {R6('p.perf')} AS perf_base, {R6('q.perf')} AS perf_news, {R6('p.acc')} AS acc_base, {R6('q.acc')} AS acc_news
FROM acc p JOIN acc q ON q.symbol = p.symbol AND p.half = 'price' AND q.half = 'news'""",
                      "articles", "event_bars_d", extra={**NEWS_CTES, "nb": nb, "lbn": lb("nb"), **boost, "acc": acc})


@oracle("adaboost_round")
def _():
    return with_views(f"""
SELECT symbol, CAST(round AS INTEGER) AS round, CAST(fno AS INTEGER) AS fno, {R6('thresh')} AS thresh,
       CAST(polarity AS INTEGER) AS polarity, {R6('perf')} AS perf, {R6('error')} AS error,
       {R6('alpha')} AS alpha, {R6('z')} AS z
FROM (SELECT * FROM out1 UNION ALL SELECT * FROM out2) o""", "brand_bars", extra=_boost_ctes(2))


# ------------------------------------------------------------------ compare
KNN_NB = {**EMB, "nb": """
  SELECT a.id AS test_id, a.label AS qlabel, b.label AS nlabel,
         row_number() OVER (PARTITION BY a.id ORDER BY """ + SQD_SQL + """, b.id) AS rn
  FROM emb a, emb b WHERE NOT a.is_train AND b.is_train"""}


@oracle("kfold_assignment")
def _():
    return """
SELECT vec_id, label,
       CAST((row_number() OVER (PARTITION BY label ORDER BY (vec_id * 7919) % 1000, vec_id) - 1) % 5 AS INTEGER) AS fold
FROM embeddings"""


@oracle("confusion_matrix")
def _():
    return with_views("SELECT label, pred, count(*) AS n FROM kp GROUP BY label, pred", extra={**KNN_NB, "kp": """
      SELECT test_id, qlabel AS label, nlabel AS pred FROM (
        SELECT test_id, qlabel, nlabel,
               row_number() OVER (PARTITION BY test_id ORDER BY count(*) DESC, nlabel) AS r
        FROM nb WHERE rn <= 5 GROUP BY test_id, qlabel, nlabel) v WHERE r = 1"""})


@oracle("config_sweep")
def _():
    return with_views(f"""
SELECT k, count(*) AS n_test, {R6('avg(CAST(pred = label AS DOUBLE)) * 100')} AS accuracy FROM (
  SELECT k, test_id, qlabel AS label, nlabel AS pred FROM (
    SELECT k.k, test_id, qlabel, nlabel,
           row_number() OVER (PARTITION BY k.k, test_id ORDER BY count(*) DESC, nlabel) AS r
    FROM nb JOIN (SELECT unnest([1, 3, 5, 7]) AS k) k ON nb.rn <= k.k
    GROUP BY k.k, test_id, qlabel, nlabel) v WHERE r = 1) p
GROUP BY k""", extra=KNN_NB)


@oracle("classifier_summary")
def _():
    return with_views(f"""
SELECT strategy, {R6('max(test_acc)')} AS best_acc, arg_min(symbol, row(-test_acc, symbol)) AS best_symbol,
       {R6('avg(test_acc)')} AS avg_acc
FROM summ GROUP BY strategy""", "brand_bars", extra={**_curves(RULES), "summ": BT_SUMMARY})


# ------------------------------------------------------------------ reports
def _fixed(x: str, d: int) -> str:
    sc = format(float(10 ** d), ".1e")
    return f"printf('%.{d}f', floor(({x}) * {sc} + 0.5) / {sc})"


def _report_ctes() -> dict[str, str]:
    c = {**_curves(RULES, "brand_bars", "_b"), **_curves(RULES, "event_bars_d", "_d")}
    c["summ_b"] = BT_SUMMARY.replace("FROM cur GROUP", "FROM cur_b GROUP")
    c["summ_d"] = BT_SUMMARY.replace("FROM cur GROUP", "FROM cur_d GROUP")
    c["metrics"] = """
      SELECT 'Daily' AS section, 0 AS sec, strategy AS config, symbol, replace(symbol, '#', ' ') AS name,
             train_acc, test_acc, coalesce(sharpe, 0.0) AS sharpe FROM summ_b
      UNION ALL
      SELECT 'Daily w/ news', 1, strategy, symbol, replace(symbol, '#', ' '), train_acc, test_acc,
             coalesce(sharpe, 0.0) FROM summ_d"""
    c["cfg"] = """
      SELECT section, sec, config, avg(test_acc) AS avg_acc, stddev_samp(test_acc) AS spread, count(*) AS n_sym,
             dense_rank() OVER (PARTITION BY section ORDER BY config) AS blk
      FROM metrics GROUP BY section, sec, config"""
    c["loglines"] = f"""
      SELECT 'run' AS file, sec, CAST(blk AS INTEGER) AS blk, CAST(pos AS INTEGER) AS pos, line FROM (
        SELECT sec, blk, 0 AS pos, config AS line FROM cfg
        UNION ALL SELECT sec, blk, 1, 'Avg test accuracy: ' || CAST({R6('avg_acc')} AS VARCHAR) FROM cfg
        UNION ALL SELECT sec, blk, 2, CAST({R6('coalesce(spread, 0.0)')} AS VARCHAR) FROM cfg
        UNION ALL SELECT sec, blk, 3, CAST(n_sym / 1000.0::DOUBLE AS VARCHAR) FROM cfg
        UNION ALL SELECT m.sec, c.blk, row_number() OVER (PARTITION BY m.section, m.config ORDER BY m.test_acc, m.symbol) + 3,
               printf('%6s   %s   %s   %s', m.name || ' (' || m.symbol || ')', {_fixed('m.train_acc', 4)},
                      {_fixed('m.test_acc', 4)}, {_fixed('m.sharpe', 3)})
          FROM metrics m JOIN cfg c ON c.section = m.section AND c.config = m.config
        UNION ALL SELECT sec, blk, n_sym + 4, '' FROM cfg
        UNION ALL SELECT DISTINCT sec, 0, 0, section || '###' FROM metrics WHERE sec > 0) l"""
    c["parsed"] = """
      SELECT file, CAST(section AS INTEGER) AS section, prev AS config,
             CAST(string_split(t, ': ')[-1] AS DOUBLE) AS accuracy,
             CASE WHEN contains(n1, 'Time') THEN 0.0 ELSE CAST(n1 AS DOUBLE) END AS spread,
             CAST(CASE WHEN contains(n1, 'Time') THEN string_split(n1, ' ')[-1] ELSE string_split(n2, ' ')[-1] END
                  AS DOUBLE) AS time
      FROM (SELECT *, sum(CAST(contains(t, '###') AS INTEGER)) OVER (PARTITION BY file ORDER BY sec, blk, pos
                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS section,
                   lag(t) OVER o AS prev, lead(t, 1) OVER o AS n1, lead(t, 2) OVER o AS n2
            FROM (SELECT *, trim(line) AS t FROM loglines) x
            WINDOW o AS (PARTITION BY file ORDER BY sec, blk, pos)) y
      WHERE contains(t, 'accuracy') AND NOT contains(t, '###')"""
    return c


@oracle("report_lines")
def _():
    return with_views("SELECT file, CAST(sec AS INTEGER) AS sec, blk, pos, line FROM loglines",
                      "brand_bars", "event_bars_d", extra=_report_ctes())


@oracle("parse_run_log")
def _():
    return with_views(f"""
SELECT section, config, {R6('accuracy')} AS accuracy, {R6('spread')} AS spread, {R6('time')} AS time
FROM parsed""", "brand_bars", "event_bars_d", extra=_report_ctes())


@oracle("read_run_log")
def _():
    return ORACLES["parse_run_log"]


@oracle("news_gain_report")
def _():
    f = _fixed
    return with_views(f"""
SELECT config, {R6('diff')} AS diff, {R6('percent')} AS percent,
       printf('%28s:  %s  %s  %s  %6s  %6s  %6s  %6s  %s', config, {f('diff', 3)}, {f('percent', 2)},
              {f('acc_base', 2)}, {f('acc_news', 2)}, {f('std_base', 2)}, {f('std_news', 2)},
              {f('time_base', 2)}, {f('time_news', 2)}) AS line
FROM (SELECT b.config, b.accuracy AS acc_base, b.spread AS std_base, b.time AS time_base,
             n.accuracy AS acc_news, n.spread AS std_news, n.time AS time_news,
             n.accuracy - b.accuracy AS diff, 100 * (n.accuracy - b.accuracy) / nullif(b.accuracy, 0) AS percent
      FROM parsed b JOIN parsed n ON n.config = b.config AND b.section = 0 AND n.section = 1) g
WHERE diff >= 0 AND acc_base >= 51.0 AND time_base < 50.0""", "brand_bars", "event_bars_d", extra=_report_ctes())


@oracle("parse_result_sections")
def _():
    from ..operators.report import RESULT_RE, SYM_RE
    rx, sx = "'" + RESULT_RE + "'", "'" + SYM_RE + "'"
    return with_views(f"""
SELECT file, CAST(section AS INTEGER) AS section, trim(regexp_replace(label, {sx}, '')) AS name,
       CASE WHEN regexp_extract(label, {sx}, 1) = '' THEN label ELSE regexp_extract(label, {sx}, 1) END AS symbol,
       CAST(regexp_extract(line, {rx}, 2) AS DOUBLE) AS train,
       CAST(regexp_extract(line, {rx}, 3) AS DOUBLE) AS test, CAST(regexp_extract(line, {rx}, 4) AS DOUBLE) AS sharpe
FROM (SELECT *, regexp_extract(line, {rx}, 1) AS label,
             sum(CAST(starts_with(line, '###') AS INTEGER) + CAST(ends_with(line, '###') AS INTEGER))
                  OVER (PARTITION BY file ORDER BY sec, blk, pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS section
      FROM loglines) s
WHERE regexp_full_match(line, {rx})""", "brand_bars", "event_bars_d", extra=_report_ctes())


# ------------------------------------------------------------------ article store (batch and stream)
def _article_store_sql() -> str:
    p = paragraphs_sql("html")
    company = COMPANY_SQL.replace("page_id", "n.page_id")
    c = {"first_pages": f"""SELECT * FROM (SELECT n.*, {company} AS company, row_number() OVER (PARTITION BY {company}, url ORDER BY page_id) AS copy
                              FROM news_pages n) f WHERE copy = 1""",
         "dated": f"SELECT page_id, pub_date FROM ({PAGE_DATES.format(pages='first_pages')}) t", **_keyword_ctes()}
    c["docsrc"] = f"""SELECT page_id AS doc_id, trim(array_to_string({p}, ' ')) AS text FROM first_pages
                      WHERE page_id IN (SELECT page_id FROM dated)"""
    return with_views(f"""
SELECT p.company, p.url AS link, k.doc_id AS page_id, d.pub_date, k.keyword,
       {substring_count_sql('s.summary', 'k.keyword')} AS cnt
FROM (SELECT doc_id, word AS keyword FROM kw UNION ALL SELECT doc_id, phrase FROM phr) k
JOIN summ s ON s.doc_id = k.doc_id
JOIN dated d ON d.page_id = k.doc_id
JOIN first_pages p ON p.page_id = k.doc_id""", "news_pages", extra=c)


ORACLES["article_store"] = _article_store_sql()
ORACLES["incremental_articles"] = ORACLES["article_store"]


@oracle("adaboost")
def _():
    rounds = 10
    c = _boost_ctes(rounds)
    c["stumps"] = " UNION ALL ".join(f"SELECT * FROM out{r}" for r in range(1, rounds + 1))
    c["votes"] = """
      SELECT r.symbol, r.rid, r.y, r.is_train, r.is_test, s.round,
             CASE WHEN sum(s.alpha * ((2 * CAST(r.xs[s.fno] < s.thresh AS INTEGER) - 1) * s.polarity))
                       OVER (PARTITION BY r.symbol, r.rid ORDER BY s.round
                             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) > 0 THEN 1 ELSE -1 END AS vote
      FROM rows r JOIN stumps s ON s.symbol = r.symbol"""
    return with_views(f"""
SELECT e.symbol, CAST(e.round AS INTEGER) AS round, {R6('e.train_err')} AS train_err, {R6('e.test_err')} AS test_err,
       {R6('b.err_bound')} AS err_bound
FROM (SELECT symbol, round,
             avg(CASE WHEN is_train THEN CAST(vote <> y AS DOUBLE) END) AS train_err,
             avg(CASE WHEN is_test THEN CAST(vote <> y AS DOUBLE) END) AS test_err
      FROM votes GROUP BY symbol, round) e
JOIN (SELECT symbol, round, exp(sum(ln(z)) OVER (PARTITION BY symbol ORDER BY round
                                                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS err_bound
      FROM stumps) b ON b.symbol = e.symbol AND b.round = e.round""", "brand_bars", extra=c)


# ------------------------------------------------------------------ overall news model
def _overall_ctes() -> dict[str, str]:
    draws = " UNION ALL ".join(f"""
        SELECT *, {a} AS attempt,
               row_number() OVER (ORDER BY (example_id * 7919 + {(42 + a) * 104729}) % 1000003, example_id) AS rn,
               count(*) OVER () AS n FROM ex""" for a in range(5))
    c = {
        "ex": "SELECT 'overall' AS scope, doc_id AS example_id, quality AS label FROM labels",
        "terms": f"""
          SELECT 'overall' AS scope, example_id, word, count(*) AS cnt FROM (
            SELECT doc_id AS example_id, unnest({tokens_sql('text')}) AS word
            FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)) t
          WHERE NOT list_contains({STOP_SQL}, word)
          GROUP BY example_id, word""",
        "draws": f"SELECT *, rn <= ceil(n * 0.2::DOUBLE) AS is_test FROM ({draws}) d",
        "split": """
          SELECT * FROM draws WHERE attempt = (
            SELECT min(attempt) FROM (SELECT attempt FROM draws WHERE NOT is_test
                                      GROUP BY attempt HAVING count(DISTINCT label) > 1) ok)""",
        "trex": "SELECT * FROM split WHERE NOT is_test",
        "trterms": "SELECT * FROM terms WHERE example_id IN (SELECT example_id FROM trex)",
        "shares": """
          SELECT c.label, c.n_c / n.n AS share FROM
            (SELECT label, count(*) AS n_c FROM trex GROUP BY label) c, (SELECT count(*) AS n FROM trex) n""",
        "obs": """SELECT t.word, e.label, sum(t.cnt) AS o FROM trterms t JOIN trex e ON e.example_id = t.example_id
                  GROUP BY t.word, e.label""",
        "scores": """
          SELECT 'overall' AS symbol, word, total, s / total - total AS chi2 FROM (
            SELECT o.word, sum(o.o * o.o / sh.share) AS s, sum(o.o) AS total
            FROM obs o JOIN shares sh ON sh.label = o.label GROUP BY o.word) x""",
        "totals": "SELECT word, sum(cnt) AS total FROM trterms GROUP BY word",
    }
    ok = f"chi2 >= {chi2_critical_1df_sql('0.005::DOUBLE * i / m')}"
    c.update({
        "v_k_best": """SELECT word FROM (SELECT *, row_number() OVER (ORDER BY chi2 DESC, word) AS r FROM scores) k
                       WHERE r <= 200""",
        "v_fpr": f"SELECT word FROM scores WHERE chi2 > {chi2_critical_1df_sql('0.005::DOUBLE')}",
        "v_fwe": f"""SELECT word FROM (SELECT *, count(*) OVER () AS m FROM scores) f
                     WHERE chi2 > {chi2_critical_1df_sql('0.005::DOUBLE / m')}""",
        "f0": "SELECT *, row_number() OVER (ORDER BY chi2 DESC, word) AS i, count(*) OVER () AS m FROM scores",
        "f1": f"SELECT *, max(CASE WHEN {ok} THEN i END) OVER () AS istar FROM f0",
        "f2": "SELECT *, max(CASE WHEN i = istar THEN chi2 END) OVER () AS cut FROM f1",
        "v_fdr": "SELECT word FROM f2 WHERE chi2 >= cut",
        "p0": """SELECT *, row_number() OVER (ORDER BY chi2, word) AS rn, count(*) OVER () AS n,
                        (count(*) OVER () - 1) * 0.9::DOUBLE AS h FROM scores""",
        "p1": """SELECT *, h - floor(h) AS frac, max(CASE WHEN rn = floor(h) + 1 THEN chi2 END) OVER () AS a,
                        max(CASE WHEN rn = least(floor(h) + 2, n) THEN chi2 END) OVER () AS b FROM p0""",
        "p2": """SELECT *, count(CASE WHEN chi2 > thr THEN 1 END) OVER () AS above
                 FROM (SELECT *, a + frac * (b - a) AS thr FROM p1) t""",
        "p3": """SELECT *, CASE WHEN chi2 = thr THEN row_number() OVER (PARTITION BY chi2 = thr ORDER BY word) END AS tie
                 FROM p2""",
        "v_percentile": "SELECT word FROM p3 WHERE chi2 > thr OR tie <= floor(n * 10 / 100) - above",
        "v_chopped": """SELECT word FROM (SELECT *, row_number() OVER (ORDER BY total DESC, word) AS pos,
                                                count(*) OVER () AS n FROM totals) v WHERE pos <= floor(n / 4)""",
        "v_all": "SELECT word FROM totals",
    })
    arms = []
    for i, name in enumerate(("k_best", "fpr", "fdr", "fwe", "percentile", "chopped", "all")):
        c[f"acc_{name}"] = f"""
          SELECT '{name}' AS candidate, {i} AS cand_no, (SELECT count(*) FROM v_{name}) AS n_words,
                 count(*) AS n_test, avg(CAST((coalesce(z, 0.0) > 0) = (label = 1) AS DOUBLE)) * 100 AS test_acc
          FROM split e LEFT JOIN (
            SELECT t.example_id, sum(t.cnt * w.wt) AS z
            FROM terms t JOIN (
              SELECT word, ln((up + 1.0::DOUBLE) / (down + 1.0::DOUBLE)) AS wt FROM (
                SELECT t.word, sum(CASE WHEN e.label = 1 THEN t.cnt ELSE 0 END) AS up,
                       sum(CASE WHEN e.label <> 1 THEN t.cnt ELSE 0 END) AS down
                FROM terms t JOIN trex e ON e.example_id = t.example_id
                WHERE t.word IN (SELECT word FROM v_{name})
                GROUP BY t.word) x) w ON w.word = t.word
            WHERE t.example_id IN (SELECT example_id FROM split WHERE is_test)
              AND t.word IN (SELECT word FROM v_{name})
            GROUP BY t.example_id) zz ON zz.example_id = e.example_id
          WHERE e.is_test"""
        arms.append(f"SELECT * FROM acc_{name}")
    c["res"] = " UNION ALL ".join(arms)
    return c


@oracle("overall_news_model")
def _():
    return with_views(f"""
SELECT candidate, CAST(cand_no AS INTEGER) AS cand_no, CAST(n_words AS BIGINT) AS n_words, n_test,
       {R6('test_acc')} AS test_acc, row_number() OVER (ORDER BY test_acc DESC, cand_no) AS rank
FROM res WHERE n_words > 0""", extra=_overall_ctes())


# ------------------------------------------------------------------ sources and sinks
def _f6(x: str) -> str:
    return f"printf('%.6f', floor(({x}) * 1e6 + 0.5) / 1e6)"


@oracle("feature_matrix_export")
def _():
    cols = ", ".join(_f6(c) for c in ("close", "open", "high", "low", "open - close", "high - low"))
    return with_views(f"SELECT symbol, bar_date, concat_ws(',', {cols}, CAST(label AS VARCHAR)) AS line FROM lb",
                      "brand_bars", extra={"lb": lb()})


@oracle("news_feature_matrix_export")
def _():
    cols = ", ".join(_f6(c) for c in ("l.close", "l.open", "l.high", "l.low", "l.open - l.close", "l.high - l.low"))
    nb = f"""SELECT b.symbol, b.bar_date, {R6('coalesce(s.p_down, 0.0)')} AS p_down, {R6('coalesce(s.p_up, 0.0)')} AS p_up
             FROM event_bars_d b LEFT JOIN scores s ON s.symbol = b.symbol AND s.bar_date = b.bar_date"""
    return with_views(f"""
SELECT l.symbol, l.bar_date, concat_ws(',', {cols}, CAST(label AS VARCHAR), {_f6('p_down')}, {_f6('p_up')}) AS line
FROM lbn l JOIN nb ON nb.symbol = l.symbol AND nb.bar_date = l.bar_date""",
                      "articles", "event_bars_d", extra={**NEWS_CTES, "nb": nb, "lbn": lb("event_bars_d")})


@oracle("article_store_json")
def _():
    return with_views("""
SELECT symbol AS company, pub_date, CAST(dense_rank() OVER (PARTITION BY symbol, pub_date ORDER BY article_no) - 1
       AS BIGINT) AS article_pos, word, cnt FROM aw""", "articles", "event_bars_d", extra=NEWS_CTES)


@oracle("model_vocab_json")
def _():
    return with_views("SELECT symbol AS key, CAST(pos AS BIGINT) AS pos, word AS value FROM vocab",
                      "articles", "event_bars_d", extra=NEWS_CTES)


def _scoped_model_ctes(scope_sql: str) -> dict[str, str]:
    """The candidate-vocabulary comparison per scope (symbol)."""
    P = "PARTITION BY scope"
    draws = " UNION ALL ".join(f"""
        SELECT *, {a} AS attempt,
               row_number() OVER ({P} ORDER BY (example_id * 7919 + {(42 + a) * 104729}) % 1000003, example_id) AS rn,
               count(*) OVER ({P}) AS n FROM ex""" for a in range(5))
    ok = f"chi2 >= {chi2_critical_1df_sql('0.005::DOUBLE * i / m')}"
    c = {
        "ex": f"SELECT {scope_sql} AS scope, doc_id AS example_id, quality AS label FROM labels",
        "terms": f"""
          SELECT scope, example_id, word, count(*) AS cnt FROM (
            SELECT {scope_sql} AS scope, doc_id AS example_id, unnest({tokens_sql('text')}) AS word
            FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)) t
          WHERE NOT list_contains({STOP_SQL}, word)
          GROUP BY scope, example_id, word""",
        "draws": f"SELECT *, rn <= ceil(n * 0.2::DOUBLE) AS is_test FROM ({draws}) d",
        "okd": """SELECT scope, min(attempt) AS attempt FROM (
                    SELECT scope, attempt FROM draws WHERE NOT is_test
                    GROUP BY scope, attempt HAVING count(DISTINCT label) > 1) o GROUP BY scope""",
        "split": "SELECT d.* FROM draws d JOIN okd o ON o.scope = d.scope AND o.attempt = d.attempt",
        "trex": "SELECT * FROM split WHERE NOT is_test",
        "trterms": "SELECT t.* FROM terms t JOIN trex e ON e.example_id = t.example_id",
        "shares": """
          SELECT c.scope, c.label, c.n_c / n.n AS share FROM
            (SELECT scope, label, count(*) AS n_c FROM trex GROUP BY scope, label) c
            JOIN (SELECT scope, count(*) AS n FROM trex GROUP BY scope) n ON n.scope = c.scope""",
        "obs": """SELECT t.scope, t.word, e.label, sum(t.cnt) AS o
                  FROM trterms t JOIN trex e ON e.example_id = t.example_id GROUP BY t.scope, t.word, e.label""",
        "scores": """
          SELECT scope, word, total, s / total - total AS chi2 FROM (
            SELECT o.scope, o.word, sum(o.o * o.o / sh.share) AS s, sum(o.o) AS total
            FROM obs o JOIN shares sh ON sh.scope = o.scope AND sh.label = o.label GROUP BY o.scope, o.word) x""",
        "totals": "SELECT scope, word, sum(cnt) AS total FROM trterms GROUP BY scope, word",
        "v_k_best": f"""SELECT scope, word FROM (SELECT *, row_number() OVER ({P} ORDER BY chi2 DESC, word) AS r
                        FROM scores) k WHERE r <= 200""",
        "v_fpr": f"SELECT scope, word FROM scores WHERE chi2 > {chi2_critical_1df_sql('0.005::DOUBLE')}",
        "v_fwe": f"""SELECT scope, word FROM (SELECT *, count(*) OVER ({P}) AS m FROM scores) f
                     WHERE chi2 > {chi2_critical_1df_sql('0.005::DOUBLE / m')}""",
        "f0": f"SELECT *, row_number() OVER ({P} ORDER BY chi2 DESC, word) AS i, count(*) OVER ({P}) AS m FROM scores",
        "f1": f"SELECT *, max(CASE WHEN {ok} THEN i END) OVER ({P}) AS istar FROM f0",
        "f2": f"SELECT *, max(CASE WHEN i = istar THEN chi2 END) OVER ({P}) AS cut FROM f1",
        "v_fdr": "SELECT scope, word FROM f2 WHERE chi2 >= cut",
        "p0": f"""SELECT *, row_number() OVER ({P} ORDER BY chi2, word) AS rn, count(*) OVER ({P}) AS n,
                        (count(*) OVER ({P}) - 1) * 0.9::DOUBLE AS h FROM scores""",
        "p1": f"""SELECT *, h - floor(h) AS frac, max(CASE WHEN rn = floor(h) + 1 THEN chi2 END) OVER ({P}) AS a,
                        max(CASE WHEN rn = least(floor(h) + 2, n) THEN chi2 END) OVER ({P}) AS b FROM p0""",
        "p2": f"""SELECT *, count(CASE WHEN chi2 > thr THEN 1 END) OVER ({P}) AS above
                 FROM (SELECT *, a + frac * (b - a) AS thr FROM p1) t""",
        "p3": f"""SELECT *, CASE WHEN chi2 = thr THEN row_number() OVER ({P}, chi2 = thr ORDER BY word) END AS tie
                 FROM p2""",
        "v_percentile": "SELECT scope, word FROM p3 WHERE chi2 > thr OR tie <= floor(n * 10 / 100) - above",
        "v_chopped": f"""SELECT scope, word FROM (SELECT *, row_number() OVER ({P} ORDER BY total DESC, word) AS pos,
                               count(*) OVER ({P}) AS n FROM totals) v WHERE pos <= floor(n / 4)""",
        "v_all": "SELECT scope, word FROM totals",
        "width": "SELECT scope, count(*) AS width FROM totals GROUP BY scope",
    }
    arms = []
    for i, name in enumerate(("k_best", "fpr", "fdr", "fwe", "percentile", "chopped", "all")):
        c[f"acc_{name}"] = f"""
          SELECT e.scope, '{name}' AS candidate, {i} AS cand_no, nw.n_words,
                 count(*) AS n_test, avg(CAST((coalesce(zz.z, 0.0) > 0) = (e.label = 1) AS DOUBLE)) * 100 AS test_acc
          FROM split e
          JOIN (SELECT scope, count(*) AS n_words FROM v_{name} GROUP BY scope) nw ON nw.scope = e.scope
          LEFT JOIN (
            SELECT t.example_id, sum(t.cnt * w.wt) AS z
            FROM terms t JOIN (
              SELECT scope, word, ln((up + 1.0::DOUBLE) / (down + 1.0::DOUBLE)) AS wt FROM (
                SELECT t.scope, t.word, sum(CASE WHEN e.label = 1 THEN t.cnt ELSE 0 END) AS up,
                       sum(CASE WHEN e.label <> 1 THEN t.cnt ELSE 0 END) AS down
                FROM terms t JOIN trex e ON e.example_id = t.example_id
                JOIN v_{name} v ON v.scope = t.scope AND v.word = t.word
                GROUP BY t.scope, t.word) x) w ON w.scope = t.scope AND w.word = t.word
            WHERE t.example_id IN (SELECT example_id FROM split WHERE is_test)
            GROUP BY t.example_id) zz ON zz.example_id = e.example_id
          WHERE e.is_test
          GROUP BY e.scope, nw.n_words"""
        arms.append(f"SELECT * FROM acc_{name}")
    c["res"] = "SELECT r.*, w.width FROM (" + " UNION ALL ".join(arms) + ") r JOIN width w ON w.scope = r.scope"
    return c


@oracle("symbol_news_models")
def _():
    c = _scoped_model_ctes(COMPANY_SQL.replace("page_id", "doc_id"))
    c["bestsel"] = """
      SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY scope ORDER BY test_acc DESC, cand_no) AS r
                     FROM res WHERE candidate IN ('k_best', 'fpr', 'fdr', 'fwe', 'percentile')) b WHERE r = 1"""
    c["pick"] = """
      SELECT a.scope AS symbol, a.width, a.n_test, a.width > 700 AS wide,
             (a.width > 700 AND b.test_acc IS NOT NULL AND b.test_acc >= 30.0) AS use_sel,
             b.candidate AS sel_candidate, b.n_words AS sel_words, b.test_acc AS sel_acc, a.test_acc AS all_acc
      FROM (SELECT * FROM res WHERE candidate = 'all') a LEFT JOIN bestsel b ON b.scope = a.scope"""
    return with_views(f"""
SELECT symbol, width, n_test, CASE WHEN use_sel THEN sel_candidate ELSE 'all' END AS candidate,
       CASE WHEN use_sel THEN sel_words ELSE width END AS n_words,
       {R6('CASE WHEN use_sel THEN sel_acc ELSE all_acc END')} AS test_acc,
       wide AND NOT use_sel AS second_try,
       CASE WHEN use_sel THEN sel_acc ELSE all_acc END >= 30.0 AS accepted
FROM pick""", extra=c)


@oracle("adaboost_cv")
def _():
    rounds, k = 5, 5
    rows = f"""
      SELECT symbol || '|' || CAST(f AS VARCHAR) AS symbol, rid, y, fold <> f AS is_train, fold = f AS is_test, xs
      FROM (SELECT *, CAST((row_number() OVER (PARTITION BY symbol, y ORDER BY (rid * 7919) % 1000003, rid) - 1) % {k}
                           AS INTEGER) AS fold
            FROM (SELECT symbol, rn AS rid, label AS y,
                         [close, open, high, low, open - close, high - low] AS xs FROM lb) b) r,
           (SELECT unnest(range({k})) AS f) ff"""
    c = _boost_ctes(rounds, rows)
    c["stumps"] = " UNION ALL ".join(f"SELECT * FROM out{r}" for r in range(1, rounds + 1))
    c["votes"] = """
      SELECT r.symbol, r.rid, r.y, r.is_train, r.is_test, s.round,
             CASE WHEN sum(s.alpha * ((2 * CAST(r.xs[s.fno] < s.thresh AS INTEGER) - 1) * s.polarity))
                       OVER (PARTITION BY r.symbol, r.rid ORDER BY s.round
                             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) > 0 THEN 1 ELSE -1 END AS vote
      FROM rows r JOIN stumps s ON s.symbol = r.symbol"""
    return with_views(f"""
SELECT split_part(symbol, '|', 1) AS symbol, CAST(round AS INTEGER) AS round, {R6('avg(train_err)')} AS train_err,
       {R6('avg(test_err)')} AS test_err, count(*) AS n_folds
FROM (SELECT symbol, round,
             avg(CASE WHEN is_train THEN CAST(vote <> y AS DOUBLE) END) AS train_err,
             avg(CASE WHEN is_test THEN CAST(vote <> y AS DOUBLE) END) AS test_err
      FROM votes GROUP BY symbol, round) e
GROUP BY split_part(symbol, '|', 1), round""", "brand_bars", extra=c)


# ------------------------------------------------------------------ stores written and read back
@oracle("vendor_bars_store")
def _():
    cols = ", ".join(f"{R6(f'\"{i}. {c}\"')} AS {c}" for i, c in enumerate(("open", "high", "low", "close"), 1))
    return with_views(f"""
SELECT symbol, '60min' AS interval, ts, {cols}, CAST("5. volume" AS BIGINT) AS volume FROM vendor_bars
WHERE "1. open" IS NOT NULL AND "2. high" IS NOT NULL AND "3. low" IS NOT NULL AND "4. close" IS NOT NULL
  AND "5. volume" IS NOT NULL AND ts >= DATE '2024-01-10'""", "event_bars_h", "vendor_bars")


@oracle("intraday_matrix_store")
def _():
    cols = ", ".join(f"{R6(x)} AS {n}" for x, n in (("close", "close"), ("open", "open"), ("high", "high"), ("low", "low"),
                                                    ("open - close", "open_close"), ("high - low", "high_low")))
    return with_views(f"""
SELECT symbol, {cols}, CASE WHEN lead(close) OVER (PARTITION BY symbol ORDER BY ts) > close THEN 2 ELSE 1 END AS y
FROM event_bars_h""", "event_bars_h")


@oracle("company_links_store")
def _():
    return with_views("""
SELECT company AS key, row_number() OVER (PARTITION BY company ORDER BY page_id, link) AS pos, link AS value FROM (
  SELECT company, link, min(page_id) AS page_id FROM links
  WHERE lower(section) IN ('technology', 'business', 'climate', 'energy & environment') GROUP BY company, link) l""",
                      "news_pages", extra={"links": LINKS_OF.format(pages="news_pages")})


@oracle("results_store")
def _():
    return with_views(f"""
SELECT strategy || ' ' || symbol AS name, {R6('train_acc')} AS train, {R6('test_acc')} AS test, {R6('sharpe')} AS sharpe
FROM summ""", "brand_bars", extra={**_curves(RULES), "summ": BT_SUMMARY})


@oracle("saved_news_models")
def _():
    c = {k: v for k, v in NEWS_CTES.items() if k not in ("weights", "scores")}
    late = "pub_date >= DATE '2024-01-16'"
    c["model"] = f"""
      SELECT symbol, word, version, ln((up + 1.0::DOUBLE) / (down + 1.0::DOUBLE)) AS w FROM (
        SELECT t.symbol, t.word, g.version, sum(CASE WHEN label = 1 THEN cnt ELSE 0 END) AS up,
               sum(CASE WHEN label = -1 THEN cnt ELSE 0 END) AS down
        FROM terms t JOIN (SELECT symbol, CASE WHEN count(CASE WHEN {late} THEN 1 END) >= count(CASE WHEN NOT ({late}) THEN 1 END)
                                  THEN 2 ELSE 1 END AS version FROM ex GROUP BY symbol) g ON g.symbol = t.symbol
        WHERE g.version = 2 OR NOT ({late}) GROUP BY t.symbol, t.word, g.version) x"""
    c["z"] = """SELECT v.symbol, v.bar_date, m.version, sum(v.cnt * m.w) AS z
                FROM vec v JOIN model m ON m.symbol = v.symbol AND m.word = v.word GROUP BY v.symbol, v.bar_date, m.version"""
    return with_views(f"""
SELECT b.symbol, b.bar_date, CAST(z.version AS INTEGER) AS version, {R6('1.0::DOUBLE / (1.0::DOUBLE + exp(-z.z))')} AS p_up, TRUE AS has_model
FROM event_bars_d b LEFT JOIN z ON z.symbol = b.symbol AND z.bar_date = b.bar_date
WHERE b.symbol IN (SELECT symbol FROM model)
UNION ALL
SELECT symbol, NULL, NULL, NULL, FALSE FROM (SELECT symbol FROM event_bars_d UNION SELECT symbol FROM brand_bars) w
WHERE symbol NOT IN (SELECT symbol FROM model)""", "articles", "event_bars_d", "brand_bars", extra=c)

import datetime as dt
import json

from pyspark.sql import functions as F

from ticktale.operators import bars
from ticktale.sources import stores as st


def test_bars_save_and_scan_by_interval(spark, tmp_path):
    df = spark.createDataFrame([("A", dt.date(2024, 1, 2), 1.0, 2.0, 0.5, 1.5, 10.0)],
                               "symbol string, bar_date date, open double, high double, low double, close double, "
                               "volume double")
    path = str(tmp_path / "bars")
    bars.save_bars(bars.tag_interval(df, "daily").unionByName(bars.tag_interval(df, "60min")), path)
    got = bars.read_bars(spark, path, "daily")
    assert got.count() == 1 and {r.interval for r in got.collect()} == {"daily"}


def test_feature_matrix_roundtrip(spark, tmp_path):
    df = spark.createDataFrame([("A", 73.25, 71.46, 74.15, 71.32, -1)],
                               "symbol string, close double, open double, high double, low double, label int")
    df = bars.price_features(df)
    lines = st.feature_lines(df, "class")
    assert lines.collect()[0].line == "73.250000,71.460000,74.150000,71.320000,-1.790000,2.830000,1"
    path = str(tmp_path / "fm")
    st.write_feature_matrix(lines, path)
    back = st.read_feature_matrix(spark, path).collect()[0]
    assert back.y == 1 and abs(back.open_close + 1.79) < 1e-9


def test_legacy_article_store_and_seen_links(spark, tmp_path):
    doc = [{"2018-11-15": [{"chip": 3, "": 1}, {"nvidia": 0}], "2018-10-01": [{"gpu": 2}]},
           ["http://a/1", "http://a/2"]]
    p = tmp_path / "ACME.json"
    p.write_text(json.dumps(doc, separators=(",", ":")))
    rows = st.read_article_store(spark, str(p), legacy=True).collect()
    got = {(r.company, r.pub_date.isoformat(), r.article_pos, r.word, r.cnt) for r in rows}
    assert ("ACME", "2018-11-15", 0, "chip", 3) in got and ("ACME", "2018-11-15", 1, "nvidia", 0) in got
    assert len(got) == 4
    assert {r.url for r in st.read_seen_links(spark, str(p)).collect()} == {"http://a/1", "http://a/2"}


def test_article_store_lines_roundtrip(spark, tmp_path):
    aw = spark.createDataFrame([("A", dt.date(2024, 1, 1), 5, "x", 2), ("A", dt.date(2024, 1, 1), 3, "y", 1)],
                               "symbol string, pub_date date, article_no long, word string, cnt long")
    path = str(tmp_path / "store")
    st.write_article_store(st.article_store_lines(aw), path)
    got = {(r.company, r.article_pos, r.word, r.cnt) for r in st.read_article_store(spark, path).collect()}
    assert got == {("A", 0, "y", 1), ("A", 1, "x", 2)}


def test_article_lines_do_not_grow_with_the_articles_of_a_date(spark, tmp_path):
    aw = spark.createDataFrame([("A", dt.date(2024, 1, 1), i, "x", i) for i in range(40)],
                               "symbol string, pub_date date, article_no long, word string, cnt long")
    lines = st.article_store_lines(aw)
    assert {len(r.articles) for r in lines.collect()} == {1}
    path = str(tmp_path / "store")
    st.write_article_store(lines, path)
    (tmp_path / "store" / "company=B").mkdir()
    (tmp_path / "store" / "company=B" / "old.json").write_text('{"date": "2024-01-01", "articles": [{"y": 1}, {"y": 2}]}\n')
    got = {(r.company, r.article_pos, r.cnt) for r in st.read_article_store(spark, path).collect()}
    assert got == {("A", i, i) for i in range(40)} | {("B", 0, 1), ("B", 1, 2)}


def test_keyed_lists_legacy(spark, tmp_path):
    p = tmp_path / "vocab.json"
    p.write_text(json.dumps({"AMD": ["chip", "gpu"], "overall": ["market"]}))
    got = {(r.key, r.pos, r.value) for r in st.read_keyed_lists(spark, str(p), legacy=True).collect()}
    assert got == {("AMD", 1, "chip"), ("AMD", 2, "gpu"), ("overall", 1, "market")}


def test_model_manifest_reports_missing(spark, tmp_path):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    d = spark.createDataFrame([("A", 0.0, 1.0), ("A", 1.0, 0.0), ("B", 0.5, 1.0), ("B", 2.0, 0.0)],
                              "symbol string, x double, label double")
    v = VectorAssembler(inputCols=["x"], outputCol="features").transform(d)
    m = LogisticRegression(maxIter=5).fit(v)
    path = str(tmp_path / "models")
    st.save_model(m, d.filter("symbol = 'A'"), path)
    wanted = spark.createDataFrame([("A",), ("B",)], "symbol string")
    assert [r.symbol for r in st.missing_models(spark, wanted, path).collect()] == ["B"]


def test_results_csv(spark, tmp_path):
    df = spark.createDataFrame([("Visa", 73.5, 55.3, 0.2)], "name string, train double, test double, sharpe double")
    path = str(tmp_path / "res")
    st.write_results_csv(df, path)
    assert spark.read.csv(path).count() == 1


def test_date_floor_class_count_one_hot_and_semi_join(spark):
    from ticktale.operators import models, news
    b = spark.createDataFrame([("A", dt.date(2008, 1, 1), 1.0, 1.0), ("A", dt.date(2010, 1, 1), 2.0, 2.0),
                               ("B", dt.date(2010, 1, 1), 3.0, 3.0)],
                              "symbol string, bar_date date, open double, close double")
    assert bars.after_date(b, "2009-06-01").count() == 2
    cc = models.class_count(spark.createDataFrame([(1,), (-1,), (1,)], "label int")).collect()[0]
    assert cc.classes == [-1, 1] and cc.n_classes == 2
    oh = models.one_hot_targets(spark.createDataFrame([("a",), ("b",)], "label string")).orderBy("label").collect()
    assert [list(r.target.toArray()) for r in oh] == [[1.0, 0.0], [0.0, 1.0]]
    scores = spark.createDataFrame([("A", dt.date(2010, 1, 1), 0.3, 0.7)],
                                   "symbol string, bar_date date, p_down double, p_up double")
    out = news.attach_news(b, scores, only_scored_symbols=True).orderBy("bar_date").collect()
    assert [(r.symbol, r.p_up) for r in out] == [("A", 0.0), ("A", 0.7)]


CHIPS = "<p>Chip makers rallied. Chip demand grew strongly. Markets cheered chip makers.</p></body></html>"
BANKS = "<p>Banks fell sharply. Bank shares slid. Lenders worried banks.</p></body></html>"
PAGES = "page_id long, url string, html string"


def _page(stamp, body):
    return f'<html><body><time datetime="{stamp}"></time>{body}' if stamp else f"<html><body>{body}"


def test_stream_intake_processes_a_link_once(spark):
    from ticktale.streaming import incremental as inc
    pages = spark.createDataFrame([(0, "http://n/a", _page("2024-03-01", CHIPS)), (5, "http://n/a", _page("2024-03-02", BANKS)),
                                   (6, "http://n/b", _page("Sept. 3, 2024", BANKS)), (7, "http://n/c", _page("", CHIPS))], PAGES)
    # page ids 0 and 5 share company (id % 5 == 0) and link: only page 0 counts; page 7 has no date
    out = inc.q_incremental_articles(spark, pages, chunks=3).collect()
    assert {(r.link, r.page_id, str(r.pub_date)) for r in out} == {("http://n/a", 0, "2024-03-01"), ("http://n/b", 6, "2024-09-03")}
    assert sorted(out) == sorted(inc.article_store(pages).collect())


def test_intake_goes_on_after_a_restart_and_starts_again_on_reset(spark, tmp_path):
    from ticktale.streaming import incremental as inc
    landing, root = str(tmp_path / "landing"), str(tmp_path / "intake")

    def land(*rows):
        spark.createDataFrame(list(rows), PAGES).coalesce(1).write.mode("append").parquet(landing)

    def run(mode):
        q = inc.start_intake(spark, landing, root, mode)
        if q is not None:
            q.awaitTermination()
        return {r.page_id for r in inc.read_intake(spark, root).collect()}
    # many copies of one link in a batch, and a link whose first page has no date
    land(*[(5 * i, "http://n/a", _page("2024-03-01", CHIPS)) for i in range(3, 300)], (11, "http://n/u", _page("", BANKS)))
    assert run("extend") == {15}
    land((0, "http://n/a", _page("2024-03-01", CHIPS)), (6, "http://n/b", _page("2024-03-04", BANKS)),
         (16, "http://n/u", _page("2024-03-05", BANKS)))
    assert run("keep") == {15}
    assert run("extend") == {15, 6}             # seen links stay seen, the undated one too
    assert run("extend") == {15, 6}
    assert run("reset") == {0, 6}               # all pages again, in one batch: page 11 has no date
    assert inc.newest_generation(spark, root) == 1


def test_intake_takes_a_batch_a_chunk_whatever_the_splits(spark):
    import re

    from ticktale.streaming.incremental import q_incremental_articles
    html = '<time datetime="2024-01-0%d"></time><article><body><p>Rates rose again and markets fell. Rates fell and markets rose %d.</p></body></article>'
    pages = spark.createDataFrame([(i, f"https://x/{i % 20}", html % (i % 9 + 1, i)) for i in range(40)], "page_id long, url string, html string").repartition(6)
    out = q_incremental_articles(spark, pages, chunks=2)
    rows = out.select("link", "page_id").distinct().collect()
    assert rows and all(r.page_id < 20 for r in rows)
    assert {int(n) for f in out.inputFiles() for n in re.findall(r"batch_id=(\d+)/", f)} <= {0, 1}
    from glob import glob
    root = re.sub(r"^file:/*", "/", out.inputFiles()[0]).split("/generation-0/")[0]
    assert len([f for f in glob(f"{root}/generation-0/checkpoint/commits/*") if f.rsplit("/", 1)[1].isdigit()]) <= 2

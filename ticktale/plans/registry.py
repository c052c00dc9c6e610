"""Query registry: name -> builder(spark, sf_dir) -> DataFrame.

Each builder reads the test tables (through the fixture views) and applies
operators from ``ticktale.operators``. The returned DataFrame is lazy;
builders that cut lineage (reliable checkpoints) or fit models run those
jobs when they are called.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators import backtest as bt
from ..operators import bars
from ..sources import fixtures as fx

Builder = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Builder] = {}


def query(name: str):
    def deco(fn: Builder) -> Builder:
        QUERIES[name] = fn
        return fn
    return deco


def _on_brand_bars(op):
    return lambda spark, d: op(fx.brand_bars(spark, d))


# step 1: bars
for _name, _op in {
    "daily_bars": bars.q_daily_bars,
    "price_features": bars.q_price_features,
    "direction_label": bars.q_direction_label,
    "label_recode": bars.q_label_recode,
    "log_return": bars.q_log_return,
    "positional_split": bars.q_positional_split,
    # step 2: back-test
    "backtest_cum_return": bt.q_backtest_cum_return,
    "backtest_sharpe": bt.q_backtest_sharpe,
    "backtest_overall": bt.q_backtest_overall,
    "strategy_curves_wide": bt.q_strategy_curves_wide,
}.items():
    QUERIES[_name] = _on_brand_bars(_op)


@query("missing_series")
def _missing_series(spark, d):
    return bars.q_missing_series(fx.brand_bars(spark, d), fx.event_bars_h(spark, d), fx.event_bars_6h(spark, d))


# step 3: stitch
@query("stitch_intervals")
def _stitch(spark, d):
    from ..operators.stitch import q_stitch_intervals
    return q_stitch_intervals(fx.long_bars_6h(spark, d), fx.event_bars_h(spark, d))


# step 4: text
def _docs(spark, d):
    from ..sources.tables import table
    return table(spark, d, "documents", "doc_id", "text")


def _register_text():
    from ..operators import text as tx
    for name, op in {"sanitized_text": tx.q_sanitized_text, "word_freq": tx.q_word_freq,
                     "sentence_scores": tx.q_sentence_scores,
                     "extractive_summary": tx.q_extractive_summary}.items():
        QUERIES[name] = (lambda o: lambda spark, d: o(_docs(spark, d)))(op)


_register_text()


# step 5: keywords (over the summaries of step 4, written once)
def _summaries(spark, d):
    from ..operators.text import summaries
    from ..session import written
    return written(summaries(_docs(spark, d)), "summaries")


def _register_keywords():
    from ..operators import keywords as kw
    for name, op in {"textrank_keywords": kw.q_textrank_keywords, "keyword_phrases": kw.q_keyword_phrases,
                     "keyword_substring_count": kw.q_keyword_substring_count}.items():
        QUERIES[name] = (lambda o: lambda spark, d: o(_summaries(spark, d)))(op)


_register_keywords()


# step 6: harvest
def _register_harvest():
    from ..operators import harvest as hv
    from ..sources.tables import table
    for name, op in {"page_text": hv.q_page_text, "page_links": hv.q_page_links,
                     "unseen_links": hv.q_unseen_links}.items():
        QUERIES[name] = (lambda o: lambda spark, d: o(table(spark, d, "pages", "page_id", "url", "html")))(op)
    for name, op in {"link_sections": hv.q_link_sections, "wanted_links": hv.q_wanted_links,
                     "publish_date": hv.q_publish_date}.items():
        QUERIES[name] = (lambda o: lambda spark, d: o(fx.news_pages(spark, d)))(op)


_register_harvest()


# step 7: news features
def _register_news():
    from ..operators import news as nw
    both = {"news_label_examples": nw.q_news_label_examples, "daily_news_vector": nw.q_daily_news_vector,
            "attach_news_scores": nw.q_attach_news_scores, "cut_at_first_article": nw.q_cut_at_first_article}
    for name, op in both.items():
        QUERIES[name] = (lambda o: lambda spark, d: o(fx.articles(spark, d), fx.event_bars_d(spark, d)))(op)
    for name, op in {"day_word_counts": nw.q_day_word_counts, "top_quarter_vocab": nw.q_top_quarter_vocab}.items():
        QUERIES[name] = (lambda o: lambda spark, d: o(fx.articles(spark, d)))(op)


_register_news()


# step 8: chi-square selection
def _register_select():
    from ..operators import select as sl
    from ..sources.tables import table

    def inputs(o):
        return lambda spark, d: o(table(spark, d, "documents", "doc_id", "text"),
                                  table(spark, d, "labels", "doc_id", "quality"))
    QUERIES["chi2_scores"] = inputs(sl.q_chi2_scores)
    for mode in sl.SELECTORS:
        QUERIES[f"select_{mode}"] = inputs(sl.q_select(mode))


_register_select()


# step 9: models (rows-only checks, except the literal-weight scorers)
def _register_models():
    from ..operators import models as md
    from ..sources.tables import table
    for name, op in {"svm_linear": md.q_svm("linear", c=1.0), "svm_poly": md.q_svm("poly", c=1.0, gamma=0.5),
                     "svm_rbf_rff": md.q_svm("rbf", c=20.0, gamma=0.2),
                     "svm_sigmoid_landmark": md.q_svm("sigmoid", c=1.0, gamma=0.1),
                     "tree": md.q_tree, "bagged_trees": md.q_bagged_trees, "ls_boost": md.q_ls_boost,
                     "sigmoid_score": md.q_sigmoid_score,
                     "mlp_forward": md.q_mlp_forward}.items():
        QUERIES[name] = _on_brand_bars(op)
    QUERIES["logreg_ovr"] = lambda spark, d: md.q_logreg_ovr(table(spark, d, "embeddings"))


_register_models()


# step 10: knn and normalisation
def _register_knn():
    from ..operators import knn
    from ..sources.tables import table
    QUERIES["knn_classify"] = lambda spark, d: knn.q_knn_classify(table(spark, d, "embeddings"))
    QUERIES["feature_normalize"] = lambda spark, d: knn.q_feature_normalize(table(spark, d, "embeddings"))


_register_knn()


# step 11: boosting
def _register_boost():
    from ..operators import boost
    for name, op in {"best_stump": boost.q_best_stump, "adaboost_round": boost.q_adaboost_round,
                     "adaboost": boost.q_adaboost, "adaboost_full": boost.q_adaboost_full}.items():
        QUERIES[name] = _on_brand_bars(op)


_register_boost()


# step 12: comparison
def _register_compare():
    from ..operators import compare as cp
    from ..sources.tables import table
    QUERIES["kfold_assignment"] = lambda spark, d: cp.q_kfold_assignment(table(spark, d, "embeddings"))
    QUERIES["confusion_matrix"] = lambda spark, d: cp.q_confusion_matrix(table(spark, d, "embeddings"))
    QUERIES["config_sweep"] = lambda spark, d: cp.q_config_sweep(table(spark, d, "embeddings"))
    QUERIES["classifier_summary"] = _on_brand_bars(cp.q_classifier_summary)
    QUERIES["overall_news_model"] = lambda spark, d: cp.q_overall_news_model(
        table(spark, d, "documents", "doc_id", "text"), table(spark, d, "labels", "doc_id", "quality"))


_register_compare()


# step 13: reports over run logs derived from the tables
def _register_report():
    from ..operators import report as rp
    for name, op in {"report_lines": rp.q_report_lines, "parse_run_log": rp.q_parse_run_log,
                     "read_run_log": rp.q_read_run_log,
                     "news_gain_report": rp.q_news_gain_report,
                     "parse_result_sections": rp.q_parse_result_sections}.items():
        QUERIES[name] = (lambda o: lambda spark, d: o(fx.brand_bars(spark, d), fx.event_bars_d(spark, d)))(op)


_register_report()


# step 14: article store, batch and streaming
def _register_stream():
    from ..streaming import incremental as inc
    QUERIES["article_store"] = lambda spark, d: inc.article_store(fx.news_pages(spark, d))
    QUERIES["incremental_articles"] = lambda spark, d: inc.q_incremental_articles(spark, fx.news_pages(spark, d))


_register_stream()


# sources and sinks (round trips over data derived from the tables)
def _scratch(spark, name):
    import os
    import uuid

    from ..session import ensure_checkpoint_dir
    return os.path.join(ensure_checkpoint_dir(spark), f"ticktale-{name}-{uuid.uuid4().hex}")


def _register_stores():
    from pyspark.sql import functions as F

    from ..operators import bars as br
    from ..operators import news as nw
    from ..operators.backtest import labelled_bars
    from ..sources import stores as st

    def feature_matrix_export(spark, d):
        """K3: daily export lines (label -1/+1) keyed by symbol and day."""
        lb = br.price_features(labelled_bars(fx.brand_bars(spark, d)))
        return st.feature_lines(lb, "pm", keep=["bar_date"])

    def article_store_json(spark, d):
        aw = nw.article_words(fx.articles(spark, d))
        path = _scratch(spark, "article-store")
        st.write_article_store(st.article_store_lines(aw), path)
        return st.read_article_store(spark, path)

    def model_vocab_json(spark, d):
        aw = nw.article_words(fx.articles(spark, d))
        vocab = nw.top_quarter_vocab(nw.symbol_word_totals(aw))
        lists = vocab.select(F.col("symbol").alias("key"), F.col("pos").cast("long").alias("pos"),
                             F.col("word").alias("value"))
        path = _scratch(spark, "model-vocab")
        st.legacy_documents(lists).write.mode("overwrite").text(path)
        return st.read_keyed_lists(spark, path, legacy=True)

    def news_feature_matrix_export(spark, d):
        """K4: daily export lines with the news probabilities."""
        b = nw.rounded_news(fx.articles(spark, d), fx.event_bars_d(spark, d))
        return st.feature_lines(br.price_features(labelled_bars(b)), "pm", with_news=True, keep=["bar_date"])

    def model_with_news(spark, d):
        """The same model on the same symbols without and with news."""
        from ..operators import boost
        return boost.q_model_with_news(nw.rounded_news(fx.articles(spark, d), fx.event_bars_d(spark, d)))

    QUERIES["news_feature_matrix_export"] = news_feature_matrix_export
    QUERIES["model_with_news"] = model_with_news
    QUERIES["feature_matrix_export"] = feature_matrix_export
    QUERIES["article_store_json"] = article_store_json
    QUERIES["model_vocab_json"] = model_vocab_json


_register_stores()


def _register_symbol_models():
    from ..operators import compare as cp
    from ..sources.tables import table
    QUERIES["symbol_news_models"] = lambda spark, d: cp.q_symbol_news_models(
        table(spark, d, "documents", "doc_id", "text"), table(spark, d, "labels", "doc_id", "quality"))


_register_symbol_models()


def _register_boost_cv():
    from ..operators import boost
    QUERIES["adaboost_cv"] = _on_brand_bars(boost.q_adaboost_cv)
    QUERIES["adaboost_cv_full"] = _on_brand_bars(boost.q_adaboost_cv_full)


_register_boost_cv()


def _register_comparison():
    from ..operators import models as md
    QUERIES["classifier_comparison"] = _on_brand_bars(md.q_classifier_comparison)


_register_comparison()


def _register_networks():
    from ..operators import networks as nn
    for name, op in {"mlp": nn.q_mlp, "mlp_loss": nn.q_mlp_loss, "network_comparison": nn.q_network_comparison,
                     "network_losses": nn.q_network_losses}.items():
        QUERIES[name] = _on_brand_bars(op)


_register_networks()


def _register_kernel_svm():
    from ..operators import kernel_svm as ks
    for name, op in {"svm_rbf": ks.q_svm_rbf, "svm_rbf_backtest": ks.q_svm_rbf_backtest, "svm_kernels": ks.q_svm_kernels,
                     "svm_sweep": ks.q_svm_sweep, "svm_sweep_backtest": ks.q_svm_sweep_backtest}.items():
        QUERIES[name] = _on_brand_bars(op)


_register_kernel_svm()


def _register_newton():
    from ..operators import newton as nt
    from ..sources.tables import table
    QUERIES["logreg_lambdas"] = _on_brand_bars(nt.q_logreg_lambdas)
    QUERIES["svm_probability"] = _on_brand_bars(nt.q_svm_probability)
    QUERIES["logreg_classes"] = lambda spark, d: nt.q_logreg_classes(table(spark, d, "embeddings", "vec_id", "embedding", "label"))


_register_newton()


def _register_news_svm():
    from ..operators import news_svm as ns
    for name, op in {"svm_news_proba": ns.q_svm_news_proba, "news_svm_fit": ns.q_news_svm_fit}.items():
        QUERIES[name] = (lambda o: lambda spark, d: o(fx.articles(spark, d), fx.event_bars_d(spark, d)))(op)


_register_news_svm()


# stores written and read back: what a later job finds in them
def _register_store_round_trips():
    from pyspark.sql import functions as F

    from ..functions.numeric import r6
    from ..operators import harvest as hv
    from ..operators import saved_models as sm
    from ..sources import stores as st

    def vendor_bars_store(spark, d):
        """Vendor rows cleaned, saved with another interval,
        one interval read back from a date on."""
        path = _scratch(spark, "bars")
        hourly = bars.tag_interval(bars.ingest_vendor_bars(fx.vendor_bars(spark, d)), "60min")
        coarse = bars.tag_interval(fx.event_bars_6h(spark, d), "360min")
        bars.save_bars(hourly.unionByName(coarse), path)
        b = bars.after_date(bars.read_bars(spark, path, "60min"), "2024-01-10", "ts")
        return b.select("symbol", "interval", "ts", *[r6(c).alias(c) for c in ("open", "high", "low", "close")],
                        F.col("volume").cast("long").alias("volume"))

    def intraday_matrix_store(spark, d):
        """The intraday matrix with classes 1 and 2, written and read."""
        path = _scratch(spark, "matrix")
        labelled = bars.price_features(bars.direction_label(fx.event_bars_h(spark, d), "ts"))
        st.write_feature_matrix(st.feature_lines(labelled, "class"), path)
        m = st.read_feature_matrix(spark, path)
        return m.select("symbol", *[r6(c).alias(c) for c in ("close", "open", "high", "low", "open_close", "high_low")], "y")

    def company_links_store(spark, d):
        """A company's wanted links in page order, written and read."""
        path = _scratch(spark, "links")
        links = hv.wanted_links(hv.page_links(fx.news_pages(spark, d))).groupBy("company", "link").agg(F.min("page_id").alias("page_id"))
        st.write_keyed_lists(st.keyed_lists(links, "company", "link", "page_id"), path)
        return st.read_keyed_lists(spark, path)

    def results_store(spark, d):
        """Back-test results as CSV, read back."""
        path = _scratch(spark, "results")
        s = bt.summary(bt.backtest(bt.with_strategies(bt.with_prev_direction(bt.labelled_bars(fx.brand_bars(spark, d))),
                                                      bt.rule_signals())))
        st.write_results_csv(s.select(F.concat_ws(" ", "strategy", "symbol").alias("name"), F.col("train_acc").alias("train"),
                                      F.col("test_acc").alias("test"), "sharpe"), path)
        r = st.read_results_csv(spark, path)
        return r.select("name", *[r6(c).alias(c) for c in ("train", "test", "sharpe")])

    def saved_news_models(spark, d):
        return sm.q_saved_news_models(fx.articles(spark, d), fx.event_bars_d(spark, d), fx.brand_bars(spark, d), _scratch(spark, "models"))

    for fn in (vendor_bars_store, intraday_matrix_store, company_links_store, results_store, saved_news_models):
        QUERIES[fn.__name__] = fn


_register_store_round_trips()

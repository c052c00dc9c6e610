import pyarrow as pa

from ticktale.operators import keywords, text, word_rows

DOCS = [(1, "The chip. The chip and the board. It was."), (2, ""), (3, None), (4, "Ärger über Chips! Chips über Ärger? 7 chips"),
        (5, "one two three four five one two six one two"), (6, "alpha beta alpha gamma beta delta epsilon zeta alpha beta")]


def _docs(spark, rows=DOCS):
    return spark.createDataFrame(rows, "doc_id long, text string")


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString() + df._jdf.queryExecution().executedPlan().toString()


def _rows(df):
    return sorted(map(tuple, df.collect()))


def test_phrases_need_no_row_per_token(spark):
    summ = text.summaries(_docs(spark))
    plan = _plan(keywords.q_keyword_phrases(summ))
    assert "Generate" not in plan and "Window" not in plan


def test_runs_of_words_are_maximal_distinct_and_stay_in_their_row(spark):
    summ = spark.createDataFrame([(1, "a1 b1 x a1 b1 c1 a1"), (2, "b1 y b1"), (3, "b1 c1")], "doc_id long, summary string")
    kw = spark.createDataFrame([(1, "a1"), (1, "b1"), (2, "b1"), (3, "c1"), (3, "b1")], "doc_id long, word string")
    assert _rows(keywords.keyword_phrases(summ, kw)) == [(1, "a1 b1", 2), (3, "b1 c1", 2)]


def test_pieces_give_the_ranks_of_the_whole(monkeypatch):
    toks = pa.array([["a", "b", "a", "c", "b", "d"], [], None, ["z"], ["é", "z", "a", "é", "z"]], pa.list_(pa.string()))
    batch = pa.RecordBatch.from_arrays([pa.array(range(5)), toks], names=["k", "t"])

    def ranks():
        out, at = [], 0
        for b in word_rows._pieces([batch], "t"):
            owner, words, size, r, place = word_rows._rank_piece(b.column("t"), 10, 0.85, 0.15)
            out += list(zip((owner + at).tolist(), words.to_pylist(), size.tolist(), r.tolist(), place.tolist()))
            at += b.num_rows
        return out
    whole = ranks()
    monkeypatch.setattr(word_rows, "PIECE_TOKENS", 2)
    assert len(list(word_rows._pieces([batch], "t"))) > 2 and ranks() == whole


def test_summary_needs_no_window_and_equals_the_table_form(spark):
    plan = _plan(text.q_extractive_summary(_docs(spark)))
    assert "Window" not in plan and "Aggregate" not in plan and "Sort" not in plan
    for n in (None, 1, 2):
        assert _rows(text.summaries(_docs(spark), n=n)) == _rows(text._grouped_summaries(_docs(spark), "doc_id", "text", n))


def test_word_freq_needs_no_aggregate_and_adds_up_repeated_ids(spark):
    plan = _plan(text.q_word_freq(_docs(spark)))
    assert "Aggregate" not in plan and "Sort" not in plan
    rows = DOCS + [(1, "Board and chip"), (None, "x1 x1"), (None, "x1")]
    table_form = text.word_freq(text.sentence_tokens(text.sentences(_docs(spark, rows))))
    key = lambda r: (str(r[0]), r[1])
    assert sorted(map(tuple, text.q_word_freq(_docs(spark, rows)).collect()), key=key) == sorted(map(tuple, table_form.collect()), key=key)
    got = {(r.doc_id, r.sent_no): r.score for r in text.q_sentence_scores(_docs(spark)).collect()}
    assert got[(1, 0)] == 2 and got[(1, 1)] == 3 and (1, 2) not in got


def test_keyword_counts_search_the_rows(spark):
    from ticktale.operators.keywords import keyword_counts
    text = "Banana banana ananas, ana ana ana; \u00e9t\u00e9 \u00e9t\u00e9s"
    words, runs = ["ana", "banana", "\u00e9t\u00e9", "none"], ["ana ana", "\u00e9t\u00e9 \u00e9t\u00e9s"]
    summ = spark.createDataFrame([(1, text), (2, ""), (3, "none"), (4, "a\u00e9")], "doc_id long, summary string")
    kw = spark.createDataFrame([(1, w) for w in words] + [(2, "ana"), (3, "none")], "doc_id long, word string")
    ph = spark.createDataFrame([(1, w) for w in runs], "doc_id long, phrase string")
    df = keyword_counts(summ, kw, ph, keep_empty_keyword=True)
    want = {(1, w, text.count(w)) for w in words + runs} | {(2, "ana", 0), (3, "none", 1), (4, "", 3)}
    assert {tuple(r) for r in df.collect()} == want
    # one search of the bytes a keyword; no text is rebuilt for it
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "replace(" not in plan


def test_dealing_out_documents_holds_no_texts(spark):
    import re

    from ticktale.operators.word_rows import spread
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "600")
    try:
        df = spread(spark.createDataFrame([(1, "a")], "doc_id long, text string").coalesce(1), "doc_id")
        parts = re.findall(r"hashpartitioning\(doc_id#\d+L?, (\d+)\)", df._jdf.queryExecution().executedPlan().toString())
        assert parts and all(int(n) <= 200 for n in parts)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)

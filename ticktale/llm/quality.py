"""Quality rules: a threshold table compiled into one Spark projection.

Each document's measures (lengths, symbols, repeated lines and word windows,
stop words, line ends, capitals) are one struct column built from SQL
functions only, and every row of the rule table becomes one comparison on
it. No shuffle, no user function.

Defined results: a null or empty text has no words, all measures 0, and fails
the word-count rule; ratios over nothing are null and a null ratio passes its
rule. Repeated rows are judged one by one. Other columns of the input are
never read.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticktale.llm.common import SPACE, let, text_of

#: Common function words of the four corpus languages.
STOP_WORDS = ("the and of to in is that for it with as was on be by this an at or "
              "der die das und ist nicht mit ein eine den von zu auf für im "
              "le la les de des et est que un une pour dans sur du en "
              "el los las y que es por con para una del se no").split()


class Rule(NamedTuple):
    """The document passes when ``low <= measure <= high`` (None: no bound)."""
    name: str
    measure: str
    low: float | None
    high: float | None


RULES = (
    Rule("enough_words", "n_words", 50, None),
    Rule("few_repeated_windows", "repeat_ratio", None, 0.5),
    Rule("few_symbols", "symbol_ratio", None, 0.1),
    Rule("few_repeated_lines", "dup_line_ratio", None, 0.4),
    Rule("word_length", "mean_word_length", 2.5, 10.0),
    Rule("has_stop_words", "stop_word_ratio", 0.02, None),
    Rule("mostly_letters", "letter_ratio", 0.7, None),
    Rule("few_capitals", "upper_ratio", None, 0.5),
)


def measures(text: Column) -> Column:
    """Struct of all measures of one text (null: as empty)."""
    def of_words(words: Column) -> Column:
        n = F.size(words)
        chars = F.length(F.concat_ws("", words))
        windows = F.transform(words, lambda w, i: F.struct(
            F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("p")))
        full = F.slice(windows, 1, F.greatest(n - 2, F.lit(0)))

        def covered(ws: Column) -> Column:
            def neighbours(s: Column) -> Column:
                again = F.filter(s, lambda x, i: F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False))
                                 | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False)))
                return F.size(F.array_distinct(F.flatten(F.transform(
                    again, lambda x: F.array(x["p"], x["p"] + 1, x["p"] + 2)))))
            distinct = F.size(F.array_distinct(F.transform(ws, lambda x: x["h"])))
            return F.when(distinct == F.size(ws), F.lit(0)).otherwise(let(F.sort_array(ws), neighbours))

        repeated = F.when(n < 3, F.lit(0)).otherwise(let(full, covered))
        return F.struct(n.cast("long").alias("n_words"), chars.cast("long").alias("word_chars"),
                        repeated.cast("long").alias("n_repeat_words"))

    def of_lines(lines: Column) -> Column:
        return F.struct(F.size(lines).cast("long").alias("n_lines"),
                        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"))

    def of_letters(letters: Column) -> Column:
        runs = F.split(F.lower(letters), " ")
        return F.struct(
            F.length(F.replace(letters, F.lit(" "), F.lit(""))).cast("long").alias("n_letters"),
            F.regexp_count(letters, F.lit(r"\p{Lu}")).cast("long").alias("n_upper"),
            F.size(F.filter(runs, lambda w: w.isin(*STOP_WORDS))).cast("long").alias("n_stop_words"))

    words = F.filter(F.split(text, SPACE), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    letters = F.regexp_replace(text, r"[^\p{L}]+", " ")
    counts = F.struct(let(words, of_words).alias("w"), let(lines, of_lines).alias("l"),
                      let(letters, of_letters).alias("c"),
                      F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("s"))
    return let(counts, lambda m: F.struct(
        m["w"]["n_words"].alias("n_words"), m["w"]["word_chars"].alias("word_chars"),
        m["s"].alias("n_symbols"), m["l"]["n_lines"].alias("n_lines"),
        m["l"]["n_dup_lines"].alias("n_dup_lines"),
        m["w"]["n_repeat_words"].alias("n_repeat_words"),
        F.try_divide(m["w"]["word_chars"], m["w"]["n_words"]).alias("mean_word_length"),
        F.try_divide(m["s"], m["w"]["n_words"]).alias("symbol_ratio"),
        F.try_divide(m["l"]["n_dup_lines"], m["l"]["n_lines"]).alias("dup_line_ratio"),
        F.try_divide(m["w"]["n_repeat_words"], m["w"]["n_words"]).alias("repeat_ratio"),
        F.try_divide(m["c"]["n_stop_words"], m["w"]["n_words"]).alias("stop_word_ratio"),
        F.try_divide(m["c"]["n_letters"], m["w"]["word_chars"]).alias("letter_ratio"),
        F.try_divide(m["c"]["n_upper"], m["c"]["n_letters"]).alias("upper_ratio")))


def verdict(m: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Struct with one boolean per rule: does the document pass it?"""
    out = []
    for r in rules:
        x = m[r.measure]
        low = F.lit(True) if r.low is None else x >= F.lit(r.low)
        high = F.lit(True) if r.high is None else x <= F.lit(r.high)
        out.append(F.coalesce(low & high, F.lit(True)).alias(r.name))
    return F.struct(*out)


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``id_col``, all measures, ``rules`` (one boolean each) and ``kept``."""
    a = docs.select(F.col(id_col), measures(text_of(text_col)).alias("_m"))
    b = a.select(id_col, "_m", verdict(F.col("_m"), rules).alias("rules"))
    kept = F.lit(True)
    for r in rules:
        kept = kept & F.col(f"rules.{r.name}")
    return b.select(id_col, "_m.*", "rules", kept.alias("kept"))


def keep_good(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``docs`` that pass every rule, all columns as they came."""
    def passes(m: Column) -> Column:
        v, ok = verdict(m, rules), F.lit(True)
        for r in rules:
            ok = ok & v[r.name]
        return ok
    return docs.where(let(measures(text_of(text_col)), passes))

"""Language ID by word-first backoff.

Training counts lower-cased letter words per language over all labelled rows
(folded per Arrow batch, then added up), and character n-grams of orders 1 to
``order`` over the word counts. The model is the whole table of counts; nothing
is cut, and no task holds more of it than its block of documents asks for.

Scoring: a word known to any language adds its log frequency per language
(floored for languages that lack it). An unseen word falls back to n-grams of
the longest order, each unknown n-gram to its two shorter ones, down to single
characters. The answer is the language of the highest sum; the score is its
share in the softmax of the mean log-likelihoods per word, between 0 and 1.

Documents are cut into blocks of about ``BLOCK`` characters. Every word of the
corpus is scored once: known words by a join with the model, unseen words in
blocks of ``WORDS`` that ask the model for their n-grams. A block then asks for
the scores of its distinct words, so a word counts once per block. The
``COMMON`` most frequent words, a table of bounded size, travel to the tasks
and are added up there; it spares the exchange the words that every block
holds and changes no result.

A run of more than ``LONG_WORD`` letters (scripts without blanks) counts as
consecutive words of that many letters, the last one shorter.

Defined results: ``und`` with score 0 for a null text, a text without a letter
and when nothing could be learned; ties go to the first language by code
point; rows with a null id are not learned from and not held out; repeated
rows count one by one.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticktale.llm.common import stored, text_of
from ticktale.llm.tokens import slices

LONG_WORD = 40              # longer letter runs count as words of this length
LETTERS = regex.compile(rf"\p{{L}}{{1,{LONG_WORD}}}")
FOLD = 200_000              # entries a task counts before it passes them on
COMMON = 50_000             # words whose scores travel to the tasks
BLOCK = 32 << 20            # characters of the documents that share a word list
WORDS = 10_000              # unseen words that share a list of n-grams


def words_of(text: str) -> list[str]:
    return LETTERS.findall(text.lower())


def _count_batch(counter: dict) -> pa.RecordBatch:
    keys = list(counter)
    return pa.RecordBatch.from_arrays(
        [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()),
         pa.array([k[2] for k in keys], pa.int32()), pa.array([counter[k] for k in keys], pa.int64())],
        names=["lang", "unit", "n", "cnt"])


def _count_words(batches):
    by_lang: dict[str, Counter] = {}

    def flush():
        yield _count_batch({(x, w, 0): k for x, c in by_lang.items() for w, k in c.items()})
        by_lang.clear()

    for b in batches:
        for langs, texts in slices(b):
            for lang, t in zip(langs.to_pylist(), texts):
                by_lang.setdefault(lang, Counter()).update(words_of(t))
            if sum(map(len, by_lang.values())) > FOLD:
                yield from flush()
    yield from flush()


def grams(word: str, n: int) -> list[str]:
    """The n-grams of a word with its ends marked (single characters without)."""
    w = word if n == 1 else f" {word} "
    return [w[i:i + n] for i in range(len(w) - n + 1)]


def _count_grams(order: int):
    def run(batches):
        c: Counter = Counter()
        for b in batches:
            for lang, w, k in zip(*(b.column(i).to_pylist() for i in range(3))):
                for n in range(1, order + 1):
                    for g in grams(w, n):
                        c[(lang, g, n)] += k
                if len(c) > FOLD:
                    yield _count_batch(c)
                    c = Counter()
        yield _count_batch(c)
    return run


UNITS = "lang string, unit string, n int, cnt long"


def train(docs: DataFrame, learn: Column, text_col: str = "text", lang_col: str = "lang", order: int = 5) -> DataFrame:
    """The model table (lang, unit, n, cnt): words are n = 0. ``learn`` says
    which rows may be learned from."""
    rows = docs.where(learn & F.col(lang_col).isNotNull()).select(
        F.col(lang_col).alias("lang"), text_of(text_col).alias("text"))
    words = stored(rows.mapInArrow(_count_words, UNITS).groupBy("lang", "unit", "n")
                   .agg(F.sum("cnt").alias("cnt")), "lang-words")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    gram = words.select("lang", "unit", "cnt").repartition(parts, "unit").mapInArrow(_count_grams(order), UNITS)
    gram = stored(gram.groupBy("lang", "unit", "n").agg(F.sum("cnt").alias("cnt")), "lang-grams")
    return words.unionByName(gram)


class _Ids(dict):
    """Numbers words in the order in which they first come."""

    def __missing__(self, w: str) -> int:
        i = self[w] = len(self)
        return i


def _block_id() -> int:
    return uuid.uuid4().int >> 65


def _encode(common):
    """Documents as the sum over their common words and the numbers of the
    other words in their block; ``units`` are the words that are new to the
    block, numbered from ``base``. ``common``: words and their scores."""
    def run(batches):
        words, scores = common.value
        place = dict(zip(words, range(len(words)))).get
        ids, block, size = _Ids(), _block_id(), 0
        for b in batches:
            for carried, texts in slices(b):
                cols: list[list] = [[] for _ in range(7)]
                for t in texts:
                    if size >= BLOCK:
                        ids, block, size = _Ids(), _block_id(), 0
                    c = Counter(words_of(t))
                    at = np.fromiter((place(w, -1) for w in c), np.int64, len(c))
                    freqs = np.fromiter(c.values(), np.int64, len(c))
                    known = at >= 0
                    base = len(ids)
                    rest = [w for w, k in zip(c, known.tolist()) if not k]
                    no = [ids[w] for w in rest]
                    row = (block, base, [w for w, i in zip(rest, no) if i >= base], no, freqs[~known],
                           freqs[known] @ scores[at[known]], int(freqs[known].sum()))
                    for col, v in zip(cols, row):
                        col.append(v)
                    size += len(t)
                kinds = [pa.int64(), pa.int32(), pa.list_(pa.string()), pa.list_(pa.int32()), pa.list_(pa.int32()),
                         pa.list_(pa.float64()), pa.int64()]
                yield pa.RecordBatch.from_arrays([carried, *map(pa.array, cols, kinds)],
                                                 names=["carried", *(x.split()[0] for x in CODED.split(", "))])
    return run


CODED = "block long, base int, units array<string>, ids array<int>, freqs array<int>, known array<double>, n_known long"


def _longest(w: str, order: int) -> int:
    return min(order, len(w) + 2) if len(w) > 1 else 1


def _ask_grams(order: int):
    """Unseen words in blocks; ``units`` are the n-grams new to the block."""
    def run(batches):
        seen, block, n_words = set(), _block_id(), 0
        for b in batches:
            words, blocks, units = b.column(0).to_pylist(), [], []
            for w in words:
                if n_words == WORDS:
                    seen, block, n_words = set(), _block_id(), 0
                longest = _longest(w, order)
                full = w if longest == 1 else f" {w} "
                new = {full[i:i + n] for n in range(1, longest + 1) for i in range(len(full) - n + 1)} - seen
                seen |= new
                units.append(list(new))
                blocks.append(block)
                n_words += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(blocks, pa.int64()), b.column(0), pa.array(units, pa.list_(pa.string()))],
                names=["block", "word", "units"])
    return run


class Backoff:
    """Scores of unseen words by the n-grams that are known."""

    def __init__(self, known: dict[str, list[float]], floor: float, n_langs: int, order: int):
        self.known, self.order, self.floor = known, order, [floor] * n_langs

    def gram(self, g: str) -> list[float]:
        row = self.known.get(g)
        if row is None:
            if len(g) == 1:
                return self.floor
            row = self.known[g] = [(x + y) / 2 for x, y in zip(self.gram(g[:-1]), self.gram(g[1:]))]
        return row

    def word(self, w: str) -> list[float]:
        gs = [self.gram(g) for g in grams(w, _longest(w, self.order))]
        return [sum(x) / len(gs) for x in zip(*gs)]


def _back_off(floor: float, n_langs: int, order: int):
    def run(words: pa.Table, found: pa.Table) -> pa.Table:
        known = dict(zip(found.column("unit").to_pylist(), found.column("logs").to_pylist()))
        back = Backoff(known, floor, n_langs, order)
        ws = words.column("word").to_pylist()
        return pa.table({"unit": pa.array(ws, pa.string()),
                         "logs": pa.array([back.word(w) for w in ws], pa.list_(pa.float64()))})
    return run


def _decide(langs: list[str]):
    def run(docs: pa.Table, found: pa.Table) -> pa.Table:
        matrix = np.zeros((found.num_rows, len(langs)))
        matrix[found.column("id").to_numpy()] = (
            found.column("logs").combine_chunks().flatten().to_numpy().reshape(-1, len(langs)))
        lang, score = [], []
        for nos, freqs, known, n_known in zip(*(docs.column(c) for c in ("ids", "freqs", "known", "n_known"))):
            nos, freqs = nos.values.to_numpy(), freqs.values.to_numpy()
            n_words = int(freqs.sum()) + n_known.as_py()
            if not n_words:
                lang.append("und")
                score.append(0.0)
                continue
            sums = known.values.to_numpy() + freqs @ matrix[nos]
            best = int(np.argmax(sums))
            lang.append(langs[best])
            score.append(float(1.0 / np.exp((sums - sums[best]) / n_words).sum()))
        return pa.table({"carried": docs.column("carried"), "lang_pred": pa.array(lang, pa.string()),
                         "score": pa.array(score, pa.float64())})
    return run


def predict(docs: DataFrame, model: DataFrame, carry: list[Column], text_col: str = "text") -> DataFrame:
    """``carry`` columns, ``lang_pred`` and ``score`` for every row."""
    known_totals = model.groupBy("lang", "n").agg(F.sum("cnt").alias("total")).collect()     # languages x orders
    langs = sorted({r["lang"] for r in known_totals})
    rows = docs.select(F.struct(*carry).alias("carried"), text_of(text_col).alias("text"))
    if not langs:
        return rows.select("carried.*", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    order = max(r["n"] for r in known_totals)
    floors = [-math.log(max((r["total"] for r in known_totals if r["n"] == n), default=1) * 2.0 + 1.0)
              for n in range(order + 1)]
    total = {(r["lang"], r["n"]): r["total"] for r in known_totals}

    def by_n(values) -> Column:
        return F.element_at(F.array(*[F.lit(float(v)) for v in values]), F.col("n") + 1)

    def log_of(x: str) -> Column:
        share = F.col("cnt") / by_n(total.get((x, n), 1) for n in range(order + 1))
        return F.coalesce(F.max(F.when(F.col("lang") == x, F.log(share))), by_n(floors))
    table = stored(model.groupBy("n", "unit").agg(F.array(*map(log_of, langs)).alias("logs"),
                                                  F.sum("cnt").alias("total")), "lang-model")
    top = table.where("n = 0").orderBy(F.desc("total"), "unit").limit(COMMON).collect()
    common = docs.sparkSession.sparkContext.broadcast(
        ([r["unit"] for r in top], np.array([r["logs"] for r in top], float).reshape(-1, len(langs))))
    seen = table.where("n = 0").select("unit", "logs")
    kind = rows.schema["carried"].dataType.simpleString()
    coded = stored(rows.mapInArrow(_encode(common), f"carried {kind}, {CODED}"), "lang-docs")
    asked = (coded.select("block", "base", F.posexplode("units").alias("i", "unit"))
             .select("block", (F.col("base") + F.col("i")).alias("id"), "unit"))
    unseen = asked.select("unit").distinct().join(seen, "unit", "left_anti")
    words = stored(unseen.mapInArrow(_ask_grams(order), "block long, word string, units array<string>"), "lang-unseen")
    found = (words.select(F.col("block").alias("asked_by"), F.explode("units").alias("unit"))
             .join(table.where("n > 0").select("unit", "logs"), "unit"))
    scored = (words.select("block", "word").groupBy("block").cogroup(found.groupBy("asked_by"))
              .applyInArrow(_back_off(floors[1], len(langs), order), "unit string, logs array<double>"))
    answers = asked.join(seen.unionByName(stored(scored, "lang-backoff")), "unit").select(
        F.col("block").alias("asked_by"), "id", "logs")
    out = (coded.drop("base", "units").groupBy("block").cogroup(answers.groupBy("asked_by"))
           .applyInArrow(_decide(langs), f"carried {kind}, lang_pred string, score double"))
    return out.select("carried.*", "lang_pred", "score")


def language_id(docs: DataFrame, learn: Column, carry: list[Column], text_col: str = "text",
                lang_col: str = "lang", order: int = 5) -> DataFrame:
    return predict(docs, train(docs, learn, text_col, lang_col, order), carry, text_col)

"""Secret scans: fixed patterns plus two character Markov models.

The fixed patterns give the base spans. They also label the training samples:
the matched values are random strings, the identifiers of the rest of the
text are ordinary ones. Character-pair counts of both classes over the whole
table (at most two times the squared alphabet, whatever the input) become
one table of log-likelihood ratios. Every identifier run of at least
``min_length`` characters outside the base spans whose mean ratio per
character pair is above ``threshold`` and whose total ratio is above
``total`` (so that short runs need a higher mean) is an added span of kind
``markov``.

SQL functions only, no shuffle but that of the pair counts. Defined results:
a null or empty text has no span; with no sample of a class all ratios are 0
and nothing is added; repeated rows are scanned one by one; positions are code
points, end exclusive.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticktale.llm.common import let, text_of

#: The base patterns by kind, in listed order.
ASSIGN = (r"(?i:(password|passwd|secret|token|api_?key))[\x22\x27]?\x20*[:=]\x20*[\x22\x27]?"
          r"([A-Za-z0-9+/_.=-]+)")
ACCESS = r"AKIA[A-Z0-9]+"
LONG_ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"          # whole runs, so the same as a run of 24 and more
KINDS = ("assign", "access", "hex", "markov")

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
RUN = r"[A-Za-z0-9+/_=-]"
START = r"(?<![A-Za-z0-9+/_=-])"    # a run is tried from its first character only
CHUNK = 256
SPAN = "array<struct<start:int,kind_no:int,end:int,kind:string>>"


def _may(text: Column, kind: str) -> Column:
    """False only where the kind's pattern cannot match: plain byte searches
    that spare most texts the regular expression."""
    if kind == "assign":
        return (F.contains(text, F.lit(":")) | F.contains(text, F.lit("="))) & text.rlike(ASSIGN)
    if kind == "access":
        return F.contains(text, F.lit("AKIA"))
    return text.rlike(HEX)


def _found(text: Column, pattern: str, kind: str, group: int = 0) -> Column:
    """All matches of a base pattern in order; an empty array without one."""
    return F.when(_may(text, kind), F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
                  ).otherwise(F.array().cast("array<string>"))


def _chunks(xs: Column) -> Column:
    """An array cut into arrays of ``CHUNK``: growing an array by one entry
    copies it, so only short ones are grown."""
    last = F.floor((F.size(xs) - 1) / F.lit(CHUNK)).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda j: F.slice(xs, j * CHUNK + 1, F.lit(CHUNK)))


def _total(sizes: Column) -> Column:
    return F.aggregate(sizes, F.lit(0), lambda a, x: a + x["gap"] + x["n"])


def _running(totals: Column) -> Column:
    """What lies before each entry."""
    return F.aggregate(
        totals, F.struct(F.lit(0).alias("pos"), F.array().cast("array<int>").alias("out")),
        lambda a, x: F.struct((a["pos"] + x).alias("pos"), F.concat(a["out"], F.array(a["pos"])).alias("out")),
        lambda a: a["out"])


def _spans_of(sizes: Column, start: Column, no: int, kind: str) -> Column:
    return F.aggregate(
        sizes, F.struct(start.alias("pos"), F.array().cast(SPAN).alias("out")),
        lambda a, x: F.struct(
            (a["pos"] + x["gap"] + x["n"]).alias("pos"),
            F.concat(a["out"], F.array(F.struct(
                (a["pos"] + x["gap"]).alias("start"), F.lit(no).alias("kind_no"),
                (a["pos"] + x["gap"] + x["n"]).alias("end"), F.lit(kind).alias("kind")))).alias("out")),
        lambda a: a["out"])


def _places(text: Column, pattern: str, kind: str, keep=None) -> Column:
    """Array of spans of all matches; ``keep(match, i)`` filters them. The text
    between matches gives the start positions."""
    no = KINDS.index(kind)
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)

    def spans(both: Column) -> Column:
        sizes = F.transform(both["m"], lambda m, i: F.struct(
            F.length(F.get(both["g"], i)).alias("gap"), F.length(m).alias("n")))
        return F.when(F.size(both["m"]) > 0, let(sizes, lambda xs: let(_chunks(xs), lambda cs: let(
            _running(F.transform(cs, lambda c: _total(c))),
            lambda before: F.flatten(F.transform(cs, lambda c, j: _spans_of(c, F.get(before, j), no, kind))))))
        ).otherwise(F.array().cast(SPAN))

    found = let(F.struct(matches.alias("m"), gaps.alias("g")), spans)
    if keep is not None:
        found = F.filter(found, keep)
    return found


def base_spans(text: Column) -> Column:
    """Array of (start, kind_no, end, kind) of the fixed patterns, by start,
    then kind."""
    def when(kind: str, spans: Column) -> Column:
        return F.when(_may(text, kind), spans).otherwise(F.array().cast(SPAN))

    values = F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2))
    assign = let(values, lambda vs: F.filter(
        _places(text, ASSIGN, "assign"), lambda s, i: F.length(F.get(vs, i)) >= 6))
    access = _places(text, ACCESS, "access", lambda s: s["end"] - s["start"] >= 20)
    return F.sort_array(F.concat(when("assign", assign), when("access", access),
                                 when("hex", _places(text, HEX, "hex"))))


def _pairs(tokens: Column) -> Column:
    """All adjacent character pairs of an array of strings."""
    return F.flatten(F.transform(tokens, lambda t: F.transform(
        F.sequence(F.lit(1), F.length(t) - 1), lambda i: F.substr(t, i, F.lit(2)))))


def train(docs: DataFrame, text_col: str = "text", min_length: int = 12, alpha: float = 0.5,
          backoff: float = 10.0) -> list[float]:
    """Flat table of log P(b | a, random) - log P(b | a, ordinary) over the
    alphabet, learned from all rows. The driver gets one count per class and
    character pair."""
    text = F.col("_t")
    size = f"{{{min_length},}}"
    rows = docs.select(text_of(text_col).alias("_t"))
    random = F.concat(_found(text, ASSIGN, "assign", 2), _found(text, LONG_ACCESS, "access"), _found(text, HEX, "hex"))
    any_base = _may(text, "assign") | _may(text, "access") | _may(text, "hex")
    rest = F.when(any_base, F.regexp_replace(text, "|".join([ASSIGN, LONG_ACCESS, HEX]), " ")).otherwise(text)
    ordinary = F.regexp_extract_all(rest, F.lit(START + RUN + size), F.lit(0))
    samples = rows.select(F.explode(F.array(
        F.struct(F.lit(True).alias("random"),
                 _pairs(F.filter(random, lambda t: (F.length(t) >= min_length))).alias("pairs")),
        F.struct(F.lit(False).alias("random"), _pairs(ordinary).alias("pairs")))).alias("s"))
    counts = (samples.select("s.random", F.explode("s.pairs").alias("pair"))
              .where(F.col("pair").rlike(f"^{RUN}{RUN}$"))
              .groupBy("random", "pair").count().collect())
    n = len(ALPHABET)
    at = {c: i for i, c in enumerate(ALPHABET)}
    table = {True: [0.0] * (n * n), False: [0.0] * (n * n)}
    for r in counts:
        table[r["random"]][at[r["pair"][0]] * n + at[r["pair"][1]]] += r["count"]
    if not any(table[True]) or not any(table[False]):
        return [0.0] * (n * n)
    logs = {k: _log_probabilities(v, n, alpha, backoff) for k, v in table.items()}
    return [x - y for x, y in zip(logs[True], logs[False])]


def _log_probabilities(counts: list[float], n: int, alpha: float, backoff: float) -> list[float]:
    """log P(b | a): pair counts with ``backoff`` pseudo-counts dealt by how
    frequent b is after any character."""
    after = [sum(counts[b::n]) + alpha for b in range(n)]
    total = sum(after)
    out = []
    for a in range(n):
        row = counts[a * n:(a + 1) * n]
        size = sum(row) + backoff
        out += [math.log((c + backoff * after[b] / total) / size) for b, c in enumerate(row)]
    return out


def markov_spans(text: Column, base: Column, ratios: list[float], min_length: int, threshold: float,
                 total: float) -> Column:
    """Spans of identifier runs that look random and meet no base span."""
    n = len(ALPHABET)
    table = F.split(F.lit(",".join(repr(x) for x in ratios)), ",").cast("array<double>")   # folded to a literal

    def looks_random(token: Column) -> Column:
        at = F.transform(F.split(token, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)
        return let(at, lambda ix: F.aggregate(
            F.transform(ix, lambda a, i: F.coalesce(
                F.get(table, a * n + F.get(ix, i + 1)), F.lit(0.0))),
            F.lit(0.0), lambda s, x: s + x) > F.greatest((F.size(ix) - 1) * F.lit(threshold), F.lit(total)))

    pattern = f"{START}{RUN}{{{min_length},}}"
    tokens = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    flags = F.transform(tokens, looks_random)
    return F.when(text.rlike(pattern), let(flags, lambda fs: F.filter(
        _places(text, pattern, "markov"),
        lambda s, i: F.get(fs, i) & ~F.exists(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    )).otherwise(F.array().cast(SPAN))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 12,
         threshold: float = 0.5, total: float = 9.5, ratios: list[float] | None = None) -> DataFrame:
    """``id_col`` and ``base`` and ``added``, arrays of (start, kind_no, end,
    kind). ``ratios``: a trained table; learned from ``docs`` when None."""
    if ratios is None:
        ratios = train(docs, text_col, min_length)
    both = let(text_of(text_col), lambda t: let(base_spans(t), lambda b: F.struct(
        b.alias("base"), markov_spans(t, b, ratios, min_length, threshold, total).alias("added"))))
    return docs.select(F.col(id_col), both.alias("_s")).select(id_col, "_s.base", "_s.added")


def spans_text(spans: Column) -> Column:
    """kind:start:end joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

"""Text column helpers: sanitise, sentence split, word tokens, stop words,
substring counts. All are built-in Spark expressions (JVM, codegen); the
regular expressions avoid look-around so that RE2 (DuckDB) reads them alike.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Word token: a run of letters (any script) or digits.
WORD_RE = r"[\p{L}0-9]+"
# Sentence boundary: end mark followed by blanks (explicit class: the engines'
# \s differ on vertical tab).
SENT_RE = r"([.!?])[ \t\n\f\r]+"
SENT_MARK = "\u0001"

# The English stop-word list used by the study's summariser
# (the common 179-word NLTK English list), in its usual order. Punctuation,
# the other half of the stop set, never forms a word token.
STOP_WORDS = (
    "i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself "
    "yourselves he him his himself she she's her hers herself it it's its itself they them their "
    "theirs themselves what which who whom this that that'll these those am is are was were be been "
    "being have has had having do does did doing a an the and but if or because as until while of at "
    "by for with about against between into through during before after above below to from up down "
    "in out on off over under again further then once here there when where why how all any both each "
    "few more most other some such no nor not only own same so than too very s t can will just don "
    "don't should should've now d ll m o re ve y ain aren aren't couldn couldn't didn didn't doesn "
    "doesn't hadn hadn't hasn hasn't haven haven't isn isn't ma mightn mightn't mustn mustn't needn "
    "needn't shan shan't shouldn shouldn't wasn wasn't weren weren't won won't wouldn wouldn't"
).split()


def col_(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sanitize(text: Column | str) -> Column:
    """Form feed, tab, newline -> blank; carriage return removed."""
    return F.translate(col_(text), "\f\t\n\r", "   ")


def split_sentences(text: Column | str) -> Column:
    """Array of sentences (split after . ! ? followed by blanks)."""
    return F.split(F.regexp_replace(col_(text), SENT_RE, "$1" + SENT_MARK), SENT_MARK)


def word_tokens(text: Column | str) -> Column:
    """Lower-cased word tokens, in order."""
    return F.regexp_extract_all(F.lower(col_(text)), F.lit(WORD_RE), F.lit(0))


def is_stop(word: Column | str) -> Column:
    """Membership in the stop set (an InSet hash lookup)."""
    return col_(word).isin(STOP_WORDS)


def substring_count(text: Column | str, word: Column | str) -> Column:
    """Non-overlapping, case-sensitive count of ``word`` in ``text``;
    an empty word counts ``length + 1`` (as Python's ``str.count``)."""
    t, w = col_(text), col_(word)
    # byte lengths: what is taken out is whole copies of the word, and no text is read to measure it
    return (F.when(F.octet_length(w) == 0, F.length(t) + 1)
             .otherwise(F.try_divide(F.octet_length(t) - F.octet_length(F.replace(t, w, F.lit(""))), F.octet_length(w)))
             .cast("long"))


# SQL text of the same helpers (DuckDB), for the oracles.
STOP_SQL = "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in STOP_WORDS) + "]"


def sanitize_sql(t: str) -> str:
    return f"replace(replace(replace(replace({t}, chr(12), ' '), chr(9), ' '), chr(10), ' '), chr(13), '')"


def sentences_sql(t: str) -> str:
    return f"string_split(regexp_replace({t}, '([.!?])[ \\t\\n\\f\\r]+', '\\1' || chr(1), 'g'), chr(1))"


def tokens_sql(t: str) -> str:
    return f"regexp_extract_all(lower({t}), '[\\p{{L}}0-9]+')"


def substring_count_sql(t: str, w: str) -> str:
    return (f"CAST(CASE WHEN length({w}) = 0 THEN length({t}) + 1 "
            f"ELSE (length({t}) - length(replace({t}, {w}, ''))) // length({w}) END AS BIGINT)")

"""Word counts, sentence scores, keyword ranks and phrases of documents, each
worked out where its row lies.

Spark builds the token arrays; the helpers below take Arrow batches, cut them
into pieces of bounded size and treat all documents of a piece at once (one
dictionary of words, numpy over (row, word) codes). No token is exchanged or
sorted by Spark, so spills and a task's memory do not grow with the table. A document
alone is the unit that has to fit.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from ..session import written

# What a piece holds: its numpy arrays take some hundred bytes a token, so a
# worker needs little beside the Arrow batches, which Spark bounds by rows and bytes.
PIECE_TOKENS = 1 << 16
PIECE_BYTES = 1 << 20


def spread(docs: DataFrame, key: str) -> DataFrame:
    """Documents of few input splits dealt out, so that every core has some. They
    go to no more parts than a task can write side by side: it then holds and
    spills no texts, whatever the size of its split."""
    sc = docs.sparkSession.sparkContext
    side_by_side = int(sc.getConf().get("spark.shuffle.sort.bypassMergeThreshold", "200"))
    few = docs.rdd.getNumPartitions() < min(2 * sc.defaultParallelism, side_by_side)
    return docs.repartition(min(4 * sc.defaultParallelism, side_by_side), key) if few else docs


def once_per_key(docs: DataFrame, key: str, local: Callable[[DataFrame], DataFrame],
                 grouped: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``local`` on the rows whose key is theirs alone, ``grouped`` (which brings
    a key's rows together) on the others, if there are any."""
    many = written(docs.groupBy(key).agg(F.count("*").alias("_n")).filter("_n > 1").select(F.col(key).alias("_k")), "repeated")
    docs = spread(docs, key)
    if many.isEmpty():
        return local(docs)
    same = F.col(key).eqNullSafe(F.col("_k"))
    return local(docs.join(many, same, "left_anti")).unionByName(grouped(docs.join(many, same, "left_semi")))


def _lengths(lists) -> np.ndarray:
    import pyarrow.compute as pc
    return pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)


def _cut(batch, size: np.ndarray, most: int):
    """Slices of the batch whose rows have ``most`` in all, one row at least."""
    ends, at = np.cumsum(size), 0
    while at < batch.num_rows:
        base = ends[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(ends, base + most, "right")))
        yield batch.slice(at, end - at)
        at = end


def _pieces(batches, *columns: str):
    """Slices of the batches with about PIECE_TOKENS entries in the (nested)
    list columns, one row at least."""
    for b in batches:
        size = np.zeros(b.num_rows, dtype=np.int64)
        for c in columns:
            lists = b.column(c)
            n = _lengths(lists)
            inner = lists.flatten()
            if hasattr(inner, "flatten") and hasattr(inner.type, "value_type"):
                n = n + np.diff(np.append(0, np.cumsum(np.append(0, _lengths(inner)))[np.cumsum(n)]))
            size += n
        yield from _cut(b, size, PIECE_TOKENS)


def _nodes(words, owner: np.ndarray):
    """Distinct (owner, word) pairs in that order: the pair of each entry, the
    owners and the words of the pairs."""
    import pyarrow as pa
    import pyarrow.compute as pc
    d = words.dictionary_encode()
    order = pc.sort_indices(d.dictionary).to_numpy()          # by UTF-8 bytes, which is by code point
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.arange(len(order))
    v = max(1, len(order))
    pairs, inv = np.unique(owner * v + place[d.indices.to_numpy()], return_inverse=True)
    return inv, pairs // v, d.dictionary.take(pa.array(order[pairs % v]))


def _fields(df: DataFrame, keys: list[str], *more: StructField) -> StructType:
    return StructType([df.schema[k] for k in keys] + list(more))


def count_words(rows: DataFrame, keys: list[str], tokens: Column, cnt: str = "cnt") -> DataFrame:
    """(keys.., word, cnt) of each row's token array."""
    def run(batches):
        import pyarrow as pa
        for b in _pieces(batches, "_toks"):
            lists = b.column("_toks")
            inv, owner, words = _nodes(lists.flatten(), np.repeat(np.arange(len(lists)), _lengths(lists)))
            n = np.bincount(inv, minlength=len(owner))
            yield pa.RecordBatch.from_arrays([b.column(k).take(pa.array(owner)) for k in keys] + [words, pa.array(n, pa.int64())],
                                             names=[*keys, "word", cnt])
    return rows.select(*keys, tokens.alias("_toks")).mapInArrow(
        run, _fields(rows, keys, StructField("word", StringType()), StructField(cnt, LongType())))


def score_sentences(rows: DataFrame, key: str) -> DataFrame:
    """(key, sents, scores): a sentence's score is the sum over its tokens of
    the token's count in the row. Input columns: key, sents, toks (an array of
    tokens for each sentence)."""
    def run(batches):
        import pyarrow as pa
        for b in _pieces(batches, "toks"):
            lists = b.column("toks")
            n_sents, inner = _lengths(lists), lists.flatten()
            n_toks = _lengths(inner)
            sent = np.repeat(np.arange(len(inner)), n_toks)
            inv, owner, _ = _nodes(inner.flatten(), np.repeat(np.arange(len(lists)), n_sents)[sent])
            n = np.bincount(inv, minlength=len(owner))
            score = np.bincount(sent, weights=n[inv], minlength=len(inner)).astype(np.int64)   # whole sums below 2**53
            scores = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(n_sents)), pa.int32()), pa.array(score, pa.int64()))
            yield pa.RecordBatch.from_arrays([b.column(key), b.column("sents"), scores], names=[key, "sents", "scores"])
    return rows.select(key, "sents", "toks").mapInArrow(
        run, _fields(rows, [key], rows.schema["sents"], StructField("scores", ArrayType(LongType()))))


def _rank_piece(lists, steps: int, damping: float, teleport: float):
    """Damped ranks of every row's graph of adjacent tokens: owners, words,
    nodes of the row, rank, place in the row."""
    length = _lengths(lists)
    row = np.repeat(np.arange(len(lists)), length)
    inv, owner, words = _nodes(lists.flatten(), row)
    n = len(owner)
    near = (row[:-1] == row[1:]) & (inv[:-1] != inv[1:])
    a, b = inv[:-1][near], inv[1:][near]
    code = np.sort(np.concatenate([a * n + b, b * n + a]))
    code = code[np.diff(code, prepend=-1) > 0]                  # distinct undirected edges; sorted, as hashing them is 30 times slower
    src, dst = code // max(1, n), code % max(1, n)
    size = np.bincount(owner, minlength=len(lists))[owner]
    deg = np.bincount(src, minlength=n).astype(float)
    r = 1.0 / size
    for _ in range(steps):
        share = np.divide(r, deg, out=np.zeros(n), where=deg > 0)
        r = teleport / size + damping * np.bincount(dst, weights=share[src], minlength=n)
    order = np.lexsort((np.arange(n), -np.floor(r * 1e12 + 0.5), owner))
    first = np.append(0, np.cumsum(np.bincount(owner, minlength=len(lists))))[owner]
    place = np.empty(n, dtype=np.int64)
    place[order] = np.arange(n)
    return owner, words, size, r, place - first + 1


def rank_tokens(rows: DataFrame, key: str, tokens: Column, steps: int, damping: float, teleport: float,
                ratio: float | None = None) -> DataFrame:
    """(key, word, n_nodes, rank, kw_rank); with ``ratio`` only the first
    ``floor(ratio * n_nodes)`` words of a row."""
    def run(batches):
        import pyarrow as pa
        for b in _token_lists(batches, key):
            owner, words, size, r, place = _rank_piece(b.column("_toks"), steps, damping, teleport)
            at = np.flatnonzero(place <= np.floor(size * ratio)) if ratio is not None else np.arange(len(owner))
            yield pa.RecordBatch.from_arrays(
                [b.column(key).take(pa.array(owner[at])), words.take(pa.array(at)), pa.array(size[at], pa.int64()),
                 pa.array(r[at], pa.float64()), pa.array(place[at], pa.int64())], names=[key, "word", "n_nodes", "rank", "kw_rank"])
    # a row's tokens as one text, which is cut into words a piece at a time
    return rows.select(key, F.array_join(tokens, "\n").alias("_toks")).mapInArrow(
        run, _fields(rows, [key], StructField("word", StringType()), StructField("n_nodes", LongType()),
                     StructField("rank", DoubleType()), StructField("kw_rank", LongType())))


def _token_lists(batches, key: str):
    """Arrow batches (key, token lists) of the rows that have tokens, about
    PIECE_BYTES of joined tokens each."""
    import pyarrow as pa
    import pyarrow.compute as pc
    for b in batches:
        for p in _cut(b, pc.binary_length(b.column("_toks")).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), PIECE_BYTES):
            p = p.filter(pc.greater(pc.binary_length(p.column("_toks")).fill_null(0), 0))
            if p.num_rows:
                yield pa.RecordBatch.from_arrays([p.column(key), pc.split_pattern(p.column("_toks"), "\n")], names=[key, "_toks"])


def runs_of_words(rows: DataFrame, key: str, tokens: Column, words: str) -> DataFrame:
    """(key, phrase, n_words): the distinct maximal runs of two or more adjacent
    tokens that are in the row's array ``words``."""
    def run(batches):
        import pyarrow as pa
        for b in _pieces(batches, "_toks", words):
            lists, kws = b.column("_toks"), b.column(words)
            row = np.repeat(np.arange(len(lists)), _lengths(lists))
            flat, n = lists.flatten(), len(row)
            inv, owner, _ = _nodes(pa.concat_arrays([flat, kws.flatten()]),
                                   np.append(row, np.repeat(np.arange(len(kws)), _lengths(kws))))
            marked = np.zeros(len(owner), dtype=bool)
            marked[inv[n:]] = True
            at = np.flatnonzero(marked[inv[:n]])
            cut = np.flatnonzero((np.diff(at) != 1) | (row[at[1:]] != row[at[:-1]])) + 1
            starts, ends = np.append(0, cut), np.append(cut, len(at))
            long = ends - starts >= 2
            toks = flat.take(pa.array(at)).to_pylist()
            found = dict.fromkeys((row[at[s]], " ".join(toks[s:e]), e - s)
                                  for s, e in zip(starts[long].tolist(), ends[long].tolist()))
            yield pa.RecordBatch.from_arrays(
                [b.column(key).take(pa.array([f[0] for f in found], pa.int64())), pa.array([f[1] for f in found], pa.string()),
                 pa.array([f[2] for f in found], pa.int64())], names=[key, "phrase", "n_words"])
    return rows.select(key, tokens.alias("_toks"), words).mapInArrow(
        run, _fields(rows, [key], StructField("phrase", StringType()), StructField("n_words", LongType())))


def count_in_rows(rows: DataFrame, key: str, text: str, words: str) -> DataFrame:
    """(key, keyword, cnt): for every entry of the row's array ``words`` its
    non-overlapping, case-sensitive count in the row's text; an empty entry
    counts ``length + 1``. Whole characters are whole UTF-8 sequences, so that
    the bytes are searched."""
    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc
        for b in _pieces(batches, words):
            lists, texts = b.column(words), b.column(text).cast(pa.binary())
            flat, length = lists.flatten(), pc.utf8_length(b.column(text)).to_pylist()
            owner = np.repeat(np.arange(len(lists)), _lengths(lists))
            n, at, t = [], -1, b""
            for i, w in zip(owner.tolist(), flat.cast(pa.binary()).to_pylist()):
                if i != at:
                    at, t = i, texts[i].as_py()
                n.append(t.count(w) if w else length[i] + 1)
            yield pa.RecordBatch.from_arrays([b.column(key).take(pa.array(owner)), flat, pa.array(n, pa.int64())],
                                             names=[key, "keyword", "cnt"])
    return rows.select(key, text, words).mapInArrow(
        run, _fields(rows, [key], StructField("keyword", StringType()), StructField("cnt", LongType())))

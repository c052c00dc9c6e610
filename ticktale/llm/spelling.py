"""Spelling variants by blocked Gram matrices of letter counts.

Words are counted over all documents. A replaced letter changes the letter
counts of a word by a squared distance of two, an inserted or deleted one by
one. So a matrix product of the letter counts of two blocks of words gives all
squared distances (norms minus twice the product), pairs of at most two are
kept, and the letters themselves are compared there.

Blocks (cells) hold words of one length and one count of letters in each of
``groups`` groups of letters (dealt by how frequent the letters are). One edit
moves a word at most one step in length and one letter between groups, so a
cell meets only itself and the 21 cells at such a step upwards; cells of
more than ``chunk_words`` words are cut into chunks by hash that meet one by
one. Neighbour cells come together by equi-joins on the cell; products are
taken in tiles of at most ``TILE`` words a side.

Defined results: null texts have no words; a null id counts as an empty one
in the hash of ``drop_letters``; repeated rows count again; words of any length
are kept whole; a word in no near pair has no form and is its own root;
``form`` ties go to the first word by code point; empty tables give no row.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticktale.llm.common import stored, text_of
from ticktale.llm.tokens import slices

LETTERS = "a-zÀ-ÿ"                # after lower-casing A-Z; every letter is one Latin-1 byte
FOLD = 200_000                              # entries a task counts before it passes them on
TILE = 2048
WORK = 200_000_000                          # letter-count distances of one task, about


# ---------------------------------------------------------------- counting
def drop_letters(prefix: bytes, run: str, every: int) -> str:
    """The run, less one letter where ``every`` divides the hash of id and run."""
    h = zlib.crc32(run.encode(), zlib.crc32(prefix))
    if h % every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def _count(min_length: int, every: int):
    pattern = re.compile(f"[{LETTERS}]{{{min_length},}}")

    def batch(counter: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(counter.keys(), pa.string()), pa.array(counter.values(), pa.int64())],
                                          names=["word", "n"])

    def run(batches):
        total: Counter = Counter()
        for b in batches:
            for ids, texts in slices(b):
                for i, t in zip(ids.to_pylist(), texts):
                    prefix = f"{i}:".encode()
                    for r, k in Counter(pattern.findall(t.encode().lower().decode())).items():
                        total[drop_letters(prefix, r, every)] += k
                if len(total) > FOLD:
                    yield batch(total)
                    total.clear()
        yield batch(total)
    return run


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 6,
               min_count: int = 5, every: int = 199) -> DataFrame:
    """(word, n) of all documents: the words of at least ``min_length`` letters
    that come at least ``min_count`` times."""
    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), text_of(text_col).alias("text"))
    counts = rows.mapInArrow(_count(min_length, every), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where((F.length("word") >= min_length) & (F.col("n") >= min_count))


# ---------------------------------------------------------------- cells
def letter_groups(words: DataFrame, groups: int) -> bytes:
    """Translation table from letters (Latin-1) to group digits: the letters by
    falling frequency, each to the group with the least so far."""
    counts = (words.select(F.explode(F.split("word", "")).alias("letter")).where("letter <> ''")
              .groupBy("letter").count().orderBy(F.desc("count"), "letter").collect())      # at most 90 letters
    load, table = [0] * groups, bytearray(256)
    for r in counts:
        g = min(range(groups), key=load.__getitem__)
        load[g] += r["count"]
        table[ord(r["letter"])] = g
    return bytes(table)


def cell_of(word: str, table: bytes, groups: int) -> list[int]:
    t = word.encode("latin-1").translate(table)
    return [len(word), *(t.count(g) for g in range(groups))]


def steps_up(cell: list[int]) -> list[list[int]]:
    """The cell itself and those one edit away, each pair of cells from one
    side only: a letter more, or a letter moved to an earlier group."""
    out = [cell]
    groups = range(1, len(cell))
    for g in groups:
        more = cell.copy()
        more[0], more[g] = more[0] + 1, more[g] + 1
        out.append(more)
        for other in groups:
            if other > g and cell[other]:
                moved = cell.copy()
                moved[g], moved[other] = moved[g] + 1, moved[other] - 1
                out.append(moved)
    return out


def _name(cell: list[int]) -> str:
    return ",".join(map(str, cell))


def _with_cell(table: bytes, groups: int):
    def run(batches):
        for b in batches:
            names = [_name(cell_of(w, table, groups)) for w in b.column("word").to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(names, pa.string())], names=["word", "n", "cell"])
    return run


def _neighbours(batches):
    for b in batches:
        cells, others = [], []
        for name in b.column("cell").to_pylist():
            near = steps_up(list(map(int, name.split(","))))
            cells += [name] * len(near)
            others += map(_name, near)
        yield pa.RecordBatch.from_arrays([pa.array(cells, pa.string()), pa.array(others, pa.string())],
                                         names=["cell", "other"])


def _pack(batches):
    """A chunk's words as one string of Latin-1 letters."""
    for b in batches:
        texts, counts = [], []
        for words in b.column("words").to_pylist():
            texts.append("".join(w["word"] for w in words).encode("latin-1"))
            counts.append([w["n"] for w in words])
        yield pa.RecordBatch.from_arrays(
            [b.column("cell"), b.column("chunk"), pa.array(texts, pa.binary()), pa.array(counts, pa.list_(pa.int64()))],
            names=["cell", "chunk", "letters", "ns"])


# ---------------------------------------------------------------- pairs
def letter_counts(m: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """Rows of letter codes to counts of the given letters; 32-bit floats hold
    the squared distances exactly up to 2**24."""
    out = np.empty((len(m), len(letters)), np.float32 if m.shape[1] < 2000 else np.float64)
    for j, c in enumerate(letters):
        out[:, j] = (m == c).sum(axis=1)
    return out


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For rows of equal length: exactly one place differs. With one letter more
    in ``b``: what they share in front and at the end covers ``a``."""
    if a.shape[1] == b.shape[1]:
        return (a != b).sum(axis=1) == 1
    n = a.shape[1]
    front = np.where((d := a != b[:, :-1]).any(axis=1), d.argmax(axis=1), n)
    back = np.where((d := (a != b[:, 1:])[:, ::-1]).any(axis=1), d.argmax(axis=1), n)
    return front + back >= n


def near_pairs(a: np.ndarray, b: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the pairs with one edit between two blocks; ``same``: the
    blocks are one, each pair comes once."""
    letters = np.intersect1d(np.unique(a), np.unique(b))
    ca, cb = letter_counts(a, letters), letter_counts(b, letters)

    def norms(m, c):        # letters that the other side lacks count in the norm only
        rest = [x for x in np.unique(m) if x not in letters]
        return (c * c).sum(axis=1) + (letter_counts(m, rest) ** 2).sum(axis=1)
    na, nb = norms(a, ca), norms(b, cb)
    left, right = [], []
    for i in range(0, len(a), TILE):
        for j in range(i if same else 0, len(b), TILE):
            square = na[i:i + TILE, None] + nb[None, j:j + TILE] - 2 * (ca[i:i + TILE] @ cb[j:j + TILE].T)
            x, y = np.nonzero(square <= 2)
            x, y = x + i, y + j
            if same:
                x, y = x[x < y], y[x < y]
            for at in range(0, len(x), 1 << 16):
                p, q = x[at:at + (1 << 16)], y[at:at + (1 << 16)]
                ok = one_edit(a[p], b[q])
                left.append(p[ok]), right.append(q[ok])
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def _compare(batches):
    """Both directions of each near pair of two chunks."""
    for b in batches:
        cols = [b.column(c).to_pylist() for c in ("cell", "chunk", "other", "other_chunk", "letters", "other_letters")]
        for r, (cell, chunk, other, other_chunk, la, lb) in enumerate(zip(*cols)):
            size, other_size = int(cell.partition(",")[0]), int(other.partition(",")[0])
            x = np.frombuffer(la, np.uint8).reshape(-1, size)
            y = np.frombuffer(lb, np.uint8).reshape(-1, other_size)
            p, q = near_pairs(x, y, cell == other and chunk == other_chunk)
            if not len(p):
                continue
            words = [x[i].tobytes().decode("latin-1") for i in p]
            others = [y[i].tobytes().decode("latin-1") for i in q]
            ns = b.column("ns")[r].values.to_numpy()[p], b.column("other_ns")[r].values.to_numpy()[q]
            yield pa.RecordBatch.from_arrays(
                [pa.array(words + others, pa.string()), pa.array(others + words, pa.string()),
                 pa.array(np.concatenate(ns[::-1]), pa.int64())], names=["word", "near", "near_n"])


def near_words(words: DataFrame, groups: int = 6, chunk_words: int = 4096) -> DataFrame:
    """(word, near, near_n): all pairs of words one edit apart, both ways.
    ``words`` (word, n) is a stored table without repeats."""
    spark = words.sparkSession
    table = letter_groups(words, groups)
    placed = words.select("word", "n").mapInArrow(_with_cell(table, groups), "word string, n long, cell string")
    placed = stored(placed, "spelling-words")
    sizes = placed.groupBy("cell").agg(F.count("*").alias("size")).withColumn(
        "chunks", F.ceil(F.col("size") / F.lit(chunk_words)))
    large = sizes.where("chunks > 1").select("cell", "chunks")
    chunk = F.pmod(F.xxhash64("word"), F.coalesce("chunks", F.lit(1)))
    packed = (placed.join(large, "cell", "left").groupBy("cell", chunk.alias("chunk"))
              .agg(F.sort_array(F.collect_list(F.struct("word", "n"))).alias("words")))       # a bounded chunk
    packs = stored(packed.mapInArrow(_pack, "cell string, chunk long, letters binary, ns array<long>"),
                   "spelling-cells").withColumn("size", F.size("ns").cast("long"))

    # which chunks meet: equi-join of each cell's neighbours with the chunks that exist
    here = packs.select("cell", "chunk", "size")
    other = here.select(*(F.col(c).alias(f"other_{c}".replace("_cell", "")) for c in here.columns))
    meet = (packs.select("cell").distinct().mapInArrow(_neighbours, "cell string, other string")
            .join(other, "other").join(here, "cell")
            .where((F.col("cell") != F.col("other")) | (F.col("chunk") <= F.col("other_chunk"))))
    meet = stored(meet, "spelling-meetings")
    work = meet.agg(F.sum(F.col("size") * F.col("other_size"))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(work / WORK))
    other_packs = packs.select(F.col("cell").alias("other"), F.col("chunk").alias("other_chunk"),
                               F.col("letters").alias("other_letters"), F.col("ns").alias("other_ns"))
    rows = (meet.select("cell", "chunk", "other", "other_chunk")
            .join(packs.select("cell", "chunk", "letters", "ns"), ["cell", "chunk"])
            .repartition(parts, "other", "other_chunk")
            .join(other_packs.repartition(parts, "other", "other_chunk"), ["other", "other_chunk"]))
    return rows.mapInArrow(_compare, "word string, near string, near_n long")


# ---------------------------------------------------------------- forms
def _roots(forms: DataFrame, hops: int) -> DataFrame:
    """(word, root) of the words with a form; every round doubles how far a
    word looks ahead."""
    at = forms.select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(max(hops, 1)))):
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        at = stored(at.join(ahead, "root", "left").select("word", F.coalesce("_next", "root").alias("root")),
                    "spelling-roots")
    return at


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 6, min_count: int = 5,
             every: int = 199, ratio: int = 5, groups: int = 6, chunk_words: int = 4096) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every word of the vocabulary.
    ``form`` is the most frequent near word if it is at least ``ratio`` times as
    frequent, ``root`` the end of the chain of forms."""
    words = stored(vocabulary(docs, id_col, text_col, min_length, min_count, every), "spelling-vocabulary")
    near = near_words(words, groups, chunk_words).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near"))).alias("best"))
    best_n: Column = -F.col("best.less")
    has_form = best_n >= ratio * F.col("n")
    table = stored(words.join(near, "word", "left").select(
        "word", F.when(has_form, F.col("best.near")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(has_form, best_n).alias("form_n")),
        "spelling-forms")
    top = table.agg(F.max("n")).first()[0] or 1
    hops = 1 + int(math.log(max(top / min_count, 1.0), max(ratio, 2)))      # each form is ratio times as frequent
    roots = _roots(table.where("form IS NOT NULL"), hops)
    return (table.join(roots, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))

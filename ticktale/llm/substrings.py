"""Substring dedup of word windows with a count-min prefilter.

Pass 1: every block (partition sketch) counts its distinct windows in a sketch
of two hashed rows, per document at most once, cut off at two. The sketch has
``CELLS`` cells per window and row and is spread over shards by cell range, so
it grows with the corpus and never meets in one place; a shard adds up the
partition sketches of its range and answers each block which of its cells hold
two or more. The merged count of a window is its smaller cell, never less than
the true number of documents up to two, so no repeated window is lost.

Pass 2: windows estimated repeated (a few percent more than those that are)
are grouped exactly by a 128-bit value of the word sequence, one entry per
window and block with the block's smallest id; the group's smallest id goes
back. A word is removed if a window over it also starts in a document with
a smaller id.

Defined results: null texts and texts without a word have no window; texts
shorter than a window lose nothing; rows with a null id neither lose words nor
make others lose any; rows that repeat an id do not remove one another's
words, both lose what a smaller id holds; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticktale.llm.blocks import (Block, answer, ask, covered, meet, pack, pack_documents, rows_table, runs_of, squeeze,
                                 squeeze_sorted, unpack, unsqueeze, unsqueeze_sorted)
from ticktale.llm.blocks import ROW
from ticktale.llm.common import mix64, stored
from ticktale.llm.minhash import _HASHES, WORDS_KEPT

CELLS = 4                       # sketch cells per window and row
SHARD_WINDOWS = 1_000_000       # windows a shard answers for
BYTES_PER_WORD = 6              # only sizes the sketch


class Windows:
    """The distinct windows of a block in hash order, with the documents
    (numbers in id order) of their occurrences."""

    def __init__(self, block: Block, width: int):
        if len(_HASHES) > WORDS_KEPT:
            _HASHES.clear()
        self.words = [t.split() for t in block.texts]
        self.sizes = np.array([len(w) for w in self.words], np.int64)
        total = int(self.sizes.sum())
        h = np.fromiter((x for ws in self.words for x in map(_HASHES.__getitem__, ws)), np.uint64, total)
        self.doc = np.repeat(np.arange(len(self.sizes)), self.sizes)
        n = max(0, total - width + 1)
        ok = (self.doc[:n] == self.doc[width - 1:]) & (self.doc[:n] >= block.first)
        self.at = np.flatnonzero(ok)                    # where a window starts
        one, two = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
        for i in range(width):
            one = one * np.uint64(0x9E3779B97F4A7C15) + h[i:i + n]
            two = (two ^ h[i:i + n]) * np.uint64(0xD6E8FEB86659FD93)
        one, two = mix64(one[self.at]), mix64(two[self.at], 1)
        order = np.argsort(one, kind="stable")          # equal windows stay in document order
        self.at, self.one, self.two = self.at[order], one[order], two[order]
        new = np.ones(len(order), bool)
        new[1:] = (self.one[1:] != self.one[:-1])
        self.group = np.cumsum(new) - 1                 # occurrence -> distinct window
        first = np.flatnonzero(new)
        self.first = first
        last = np.append(first[1:], len(order))[:len(first)] - 1
        docs = self.doc[self.at]
        self.lowest = block.doc_ids[docs[first]] if len(first) else np.zeros(0, np.int64)
        highest = block.doc_ids[docs[last]] if len(first) else np.zeros(0, np.int64)
        self.counted = np.where(self.lowest != highest, 2, 1).astype(np.uint8)
        self.hash = self.one[first]
        self.check = self.two[first]

    def cells(self, row: int, width: int):
        """Sorted distinct cells of a sketch row, each window's place among
        them, and their counts (cut off at two)."""
        cell = (mix64(self.hash, 7) if row else self.hash) % np.uint64(width)
        u, back = np.unique(cell, return_inverse=True)
        return u, back, np.minimum(np.bincount(back, self.counted, len(u)), 2).astype(np.uint8)


def _slices(u: np.ndarray, per_shard: int):
    """(shard, from, to) of the shard ranges that hold any of the sorted cells."""
    shard = (u // np.uint64(per_shard)).astype(np.int64)
    cut = np.flatnonzero(np.diff(shard, prepend=-1))
    return zip(shard[cut].tolist(), cut.tolist(), [*cut[1:].tolist(), len(u)])


def _sketch(width: int, sketch_width: int, per_shard: int, shards: int):
    def questions(i: int, data: bytes):
        w = Windows(Block(data), width)
        out = []
        for row in (0, 1):
            u, _, c = w.cells(row, sketch_width)
            out += [(row * shards + s, i, row, pack(squeeze_sorted(u[a:b] - np.uint64(s * per_shard)),
                                                    np.packbits(c[a:b] > 1).tobytes()))
                    for s, a, b in _slices(u, per_shard)]
        return out
    return questions


def _merge(per_shard: int, shards: int):
    """Add up the partition sketches of one range; answer which cells of each
    block hold two or more."""
    def answers(got):
        parts = []
        total = np.zeros(per_shard, np.uint8)
        for b, data in got:
            cells, twice = unpack(data)
            u = unsqueeze_sorted(cells, np.uint64).astype(np.int64)
            c = 1 + np.unpackbits(np.frombuffer(twice, np.uint8), count=len(u))
            total[u] = np.minimum(total[u] + c, 2)
            parts.append((b, u))
        return [(b, 0, np.packbits(total[u] > 1).tobytes()) for b, u in parts]
    return answers


def _estimated(w: Windows, got: dict, sketch_width: int, per_shard: int, shards: int) -> np.ndarray:
    """Numbers of the distinct windows whose smaller cell holds two or more."""
    keep = np.ones(len(w.hash), bool)
    for row in (0, 1):
        u, back, _ = w.cells(row, sketch_width)
        over = np.zeros(len(u), bool)
        for s, a, b in _slices(u, per_shard):
            over[a:b] = np.unpackbits(np.frombuffer(got[(0, row * shards + s)], np.uint8), count=b - a)
        keep &= over[back]
    return np.flatnonzero(keep)


def _shards_of(hashes: np.ndarray, shards: int):
    """(shard, numbers of the items that go there), in hash order."""
    to = (mix64(hashes, 11) % np.uint64(shards)).astype(np.int64)
    order = np.argsort(to, kind="stable")
    cut = np.flatnonzero(np.diff(to[order], prepend=-1))
    return zip(to[order][cut].tolist(), np.split(order, cut[1:]))


def _group(got):
    """Exact groups of one hash range: for each block's entries, is there a
    smaller id than the block's own?"""
    one, two, low, sizes = [], [], [], []
    for _, data in got:
        a, b, c = unpack(data)
        one.append(unsqueeze_sorted(a, np.uint64)), two.append(unsqueeze(b, np.uint64)), low.append(unsqueeze(c, np.int64))
        sizes.append(len(one[-1]))
    one, two, low = np.concatenate(one), np.concatenate(two), np.concatenate(low)
    order = np.lexsort((two, one))
    new = np.ones(len(order), bool)
    new[1:] = (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])
    least = np.minimum.reduceat(low[order], np.flatnonzero(new))[np.cumsum(new) - 1]
    smaller = np.zeros(len(order), bool)
    smaller[order] = least < low[order]
    ends = np.cumsum(sizes)
    return [(b, 1, np.packbits(smaller[e - n:e]).tobytes()) for (b, _), n, e in zip(got, sizes, ends)]


OUT = pa.schema([("id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                 ("spans", pa.list_(pa.list_(pa.int64()))), ("kept", pa.binary())])


def dedup_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 13,
                  block_bytes: int = 4 << 20) -> DataFrame:
    """``id_col, n_words, n_removed, spans`` (removed word ranges, end
    exclusive) and ``kept`` (words left, joined by a space) for every row."""
    blocks = pack_documents(docs, id_col, text_col, block_bytes)
    size = blocks.agg(F.sum("size").alias("s")).collect()[0]["s"] or 0
    windows = max(1, size // BYTES_PER_WORD)
    shards = -(-windows // SHARD_WINDOWS)
    per_shard = -(-windows * CELLS // shards)
    sketch_width = per_shard * shards
    over = stored(answer(ask(blocks, _sketch(width, sketch_width, per_shard, shards)), _merge(per_shard, shards)),
                  "sketch-answers")

    def estimated(w: Windows, got: dict) -> np.ndarray:
        return _estimated(w, got, sketch_width, per_shard, shards)

    def entries(i: int, data: bytes, got: dict) -> pa.Table:
        w = Windows(Block(data), width)
        few = estimated(w, got)
        return rows_table([(s, i, 1, pack(squeeze_sorted(w.hash[few[x]]), squeeze(w.check[few[x]]),
                                          squeeze(w.lowest[few[x]])))
                           for s, x in _shards_of(w.hash[few], shards)])

    smaller = answer(meet(blocks, over, entries, ROW), _group)

    def remove(i: int, data: bytes, got: dict) -> pa.Table:
        block = Block(data)
        w = Windows(block, width)
        few = estimated(w, got)
        flag = np.zeros(len(w.hash), bool)
        for s, x in _shards_of(w.hash[few], shards):
            flag[few[x]] = np.unpackbits(np.frombuffer(got[(1, s)], np.uint8), count=len(x))
        own = block.doc_ids[w.doc[w.at]] > w.lowest[w.group]
        gone = covered(len(w.doc), w.at[flag[w.group] | own], width)
        return _result(block, w, gone)

    out = meet(blocks, over.unionByName(smaller), remove,
               "id long, n_words long, n_removed long, spans array<array<long>>, kept binary")
    return out.select(F.col("id").alias(id_col), "n_words", "n_removed", "spans", "kept")


def _result(block: Block, w: Windows, gone: np.ndarray) -> pa.Table:
    removed, spans, kept = [], [], []
    end = 0
    for ws in w.words:
        g, end = gone[end:end + len(ws)], end + len(ws)
        removed.append(int(g.sum()))
        if removed[-1]:
            a, b = runs_of(g)
            spans.append(np.stack([a, b], axis=1).tolist())
            kept.append(b" ".join([x for x, y in zip(ws, g.tolist()) if not y]))
        else:
            spans.append([])
            kept.append(b" ".join(ws))
    return pa.Table.from_arrays([pa.array(block.ids, pa.int64()), pa.array(w.sizes, pa.int64()),
                                 pa.array(removed, pa.int64()), pa.array(spans, OUT.field("spans").type),
                                 pa.array(kept, pa.binary())], schema=OUT)

"""Suffix-array dedup of byte strings by bucket-pointer refinement.

A corpus-wide suffix array is sorted bucket by bucket. Suffixes are dealt by
an anchor: of the q-grams inside a window of ``width`` bytes, the one of least
hash (leftmost of equals). Equal windows have equal anchors at equal places,
so they meet in the anchor's bucket, and neighbouring windows share one
anchor, so a bucket gets one short segment of text for a run of windows.

Initial buckets: blocks report their anchors' q-gram buckets; those met in one
document only need no sorting and go no further. Refinement: a shard takes
equal segments together; an anchor's bucket with one segment left holds each
of its windows once and needs no sorting either. The shard lays the segments
of the other buckets end to end, a piece of them at a time, gives every
position the identifier of its 8-byte bucket, and refines buckets of more than
one suffix by sorting on the bucket identifiers of later offsets (8, 16, 32).
Identifiers are updated in place, so each round reuses the depth the rounds
before have reached. In the sorted array equal windows are neighbours; they
are told apart by comparing their bytes, and each run of equals takes its
smallest id.

A very common q-gram (more than ``HOT`` segments) is not sorted in one place:
its windows are dealt one by one, by anchor and content.

The exchange has a row for each block and shard that share a segment, so both
are large: a row then holds hundreds of segments also where the corpus has
thousands of blocks and shards.

Defined results: null text is empty; texts shorter than ``width`` lose nothing;
rows with a null id neither lose bytes nor make others lose any; rows that
repeat an id do not remove one another's bytes; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticktale.llm.blocks import (ROW, Block, answer, ask, meet, pack, pack_documents, rows_table, squeeze,
                                 squeeze_sorted, unpack, unsqueeze, unsqueeze_sorted)
from ticktale.llm.common import mix64, stored

GRAM = 20                       # bytes of an anchor; a multiple of 4 and at least 16
HOT = 20_000                    # segments of one anchor bucket that one task sorts
SHARD_ANCHORS = 1_000_000       # anchors a shard answers for
SHARD_SEGMENTS = 256_000        # segments a shard sorts at most
LEAST_SEGMENTS = 16_000         # and at least, up to ...
LEAST_SHARDS = 64               # ... so many shards
BITS = 6                        # cells per anchor: 2 ** BITS
CHUNK = 1 << 15                 # windows whose anchors are found at once: the arrays stay in the processor's cache
PIECE = 1 << 18                 # bytes whose suffixes are sorted at once, in whole buckets
_M = 0x9E3779B1


def _power(k: int) -> np.uint32:
    return np.uint32(pow(_M, k, 1 << 32))


def gram_ranks(b: np.ndarray) -> np.ndarray:
    """Rank, in the upper 16 bits, of the GRAM bytes that start at each position."""
    h, size, four = b.astype(np.uint32) + np.uint32(1), 1, None
    while size < 16:
        h = h[:-size] * _power(size) + h[size:] if len(h) > size else h[:0]
        size *= 2
        four = h if size == 4 else four
    n = len(b) - GRAM + 1
    if n <= 0:
        return np.zeros(0, np.uint32)
    h = h[:n] * _power(GRAM - 16)
    h += four[16:16 + n]
    for shift, by in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
        h ^= h >> np.uint32(shift)
        h *= np.uint32(by)
    return h & np.uint32(0xFFFF0000)


def windows_at(b: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """The ``size`` bytes from each of the places ``at`` on, a row for each."""
    rows = np.ndarray(max(0, len(b) - size + 1), f"V{size}", b, strides=(1,))
    return rows[at].view(np.uint8).reshape(len(at), size)


def gram_hashes(b: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes that start at each of the places ``at``."""
    words = windows_at(b, at, GRAM).view("<u4").astype(np.uint64)
    h = np.zeros(len(at), np.uint64)
    for j in range(0, GRAM // 4, 2):
        h ^= words[:, j]
        if j + 1 < GRAM // 4:
            h ^= words[:, j + 1] << np.uint64(32)
        h = mix64(h, j)
    return h


def by_key(key: np.ndarray, bits: int):
    """The places of ``key`` (numbers of so many bits) in the order of their
    keys, equal keys by place; the sorted keys; where another key begins."""
    k = max(1, len(key) - 1).bit_length()
    if bits + k <= 64:                                           # key and place in one number
        x = np.sort((key << np.uint64(k)) | np.arange(len(key), dtype=np.uint64))
        order, key = (x & np.uint64((1 << k) - 1)).astype(np.int64), x >> np.uint64(k)
    else:
        order = np.argsort(key, kind="stable")
        key = key[order]
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    return order, key, new


def by_row(rows: np.ndarray, to: np.ndarray, parts: int):
    """The places of ``rows`` in an order in which those of a part (``to``, less
    than ``parts``) and in it equal rows follow one another, equal rows by
    place; where another row begins."""
    words = rows.view(np.uint64)
    k, t = max(1, len(rows) - 1).bit_length(), int(parts).bit_length()
    h = mix64((words ^ (words >> np.uint64(29))) @ mix64(np.arange(words.shape[1], dtype=np.uint64), 3))
    h >>= np.uint64(k + t)
    order, _, new = by_key((to.astype(np.uint64) << np.uint64(64 - k - t)) | h, 64 - k)
    again = np.flatnonzero(~new)
    other = (words[order[again]] != words[order[again - 1]]).any(axis=1)
    if other.any():                                              # different rows of one hash: told apart by their bytes
        group = np.cumsum(new) - 1
        mixed = np.flatnonzero(np.isin(group, group[again[other]]))
        order[mixed] = [p for *_, p in sorted((g, rows[p].tobytes(), p) for g, p in
                                              zip(group[mixed].tolist(), order[mixed].tolist()))]
        new[mixed] |= (words[order[mixed]] != words[order[mixed - 1]]).any(axis=1)
    return order, new


class Runs:
    """Runs of windows that share an anchor, over the documents of a block."""

    def __init__(self, block: Block, width: int):
        self.bytes = np.frombuffer(b"".join(block.texts), np.uint8)
        sizes = np.array([len(t) for t in block.texts], np.int64)
        self.ends = np.cumsum(sizes)
        begins = self.ends - sizes
        n = max(0, len(self.bytes) - width + 1)
        need = width - GRAM + 1
        los, anchors = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for c in range(0, n, CHUNK):
            m = min(CHUNK, n - c)
            # least (rank, place) of the q-grams of each window, by doubling
            least = gram_ranks(self.bytes[c:c + m + width - 1])
            least |= np.arange(len(least), dtype=np.uint32)
            span = 1
            while span * 2 <= need:
                least = np.minimum(least[:-span], least[span:])
                span *= 2
            least = np.minimum(least[:m], least[need - span:need - span + m])
            new = np.ones(m, bool)
            new[1:] = least[1:] != least[:-1]
            a, b = np.searchsorted(begins, (c, c + m))
            new[begins[a:b] - c] = True                         # a run stays in its document
            at = np.flatnonzero(new)
            los.append(at + c)
            anchors.append((least[at] & np.uint32(0xFFFF)).astype(np.int64) + c)
        lo, anchor = np.concatenate(los), np.concatenate(anchors)
        doc = np.searchsorted(self.ends, lo, side="right")
        # windows of the run, none across the end of its document
        count = np.minimum(np.append(lo[1:], n)[:len(lo)], self.ends[doc] - width + 1) - lo
        ok = (count > 0) & (doc >= block.first)
        self.lo, self.n, self.anchor, self.doc = lo[ok], count[ok], anchor[ok], doc[ok]
        self.gram = gram_hashes(self.bytes, self.anchor)
        self.ids = block.doc_ids[self.doc]

    def buckets(self, bits: int):
        """Sorted distinct anchor buckets (top bits of the q-gram's hash), each
        run's place among them, how many documents (up to two) and runs."""
        order, key, new = by_key(self.gram >> np.uint64(64 - bits), bits)    # runs are in document order
        starts = np.flatnonzero(new)
        ends = np.append(starts, len(order))[1:]
        back = np.empty(len(order), np.int64)
        back[order] = np.cumsum(new) - 1
        many = self.ids[order[starts]] != self.ids[order[ends - 1]]
        return key[starts], back, many, np.minimum(ends - starts, 65535).astype(np.uint16)


def _cuts(u: np.ndarray, per_shard: int):
    shard = (u // np.uint64(per_shard)).astype(np.int64)
    cut = np.flatnonzero(np.diff(shard, prepend=-1))
    return zip(shard[cut].tolist(), cut.tolist(), [*cut[1:].tolist(), len(u)])


def _report(width: int, bits: int, per_shard: int):
    def questions(i: int, data: bytes):
        u, _, many, runs = Runs(Block(data), width).buckets(bits)
        return [(s, i, 0, pack(squeeze_sorted(u[a:b] - np.uint64(s * per_shard)), np.packbits(many[a:b]).tobytes(),
                               squeeze(runs[a:b]))) for s, a, b in _cuts(u, per_shard)]
    return questions


def _met(hot: int, per_shard: int):
    """Which buckets of each block are met in two documents, which are hot, and
    how many segments will follow."""
    def answers(got):
        cells, docs, runs, sizes = [], [], [], []
        for _, data in got:
            a, b, c = unpack(data)
            cells.append(unsqueeze_sorted(a, np.uint64))
            docs.append(1 + np.unpackbits(np.frombuffer(b, np.uint8), count=len(cells[-1])).astype(np.int64))
            runs.append(unsqueeze(c, np.uint16).astype(np.int64))
            sizes.append(len(cells[-1]))
        order, _, new = by_key(np.concatenate(cells), per_shard.bit_length())
        runs = np.concatenate(runs)
        starts = np.flatnonzero(new)
        n_docs = np.add.reduceat(np.concatenate(docs)[order], starts)
        n_runs = np.add.reduceat(runs[order], starts)
        counts = np.diff(np.append(starts, len(order)))
        often, very = np.empty(len(order), bool), np.empty(len(order), bool)
        often[order] = np.repeat(n_docs >= 2, counts)
        very[order] = np.repeat((n_docs >= 2) & (n_runs > hot), counts)
        segments = np.where(often, runs, 0)
        out, end = [], 0
        for (b, _), n in zip(got, sizes):
            x = slice(end, end + n)
            end += n
            out.append((b, 0, pack(np.packbits(often[x]).tobytes(), np.packbits(very[x]).tobytes(),
                                   int(segments[x].sum()).to_bytes(8, "big"))))
        return out
    return answers


class Layout:
    """A segment as a row of bytes, zeros behind its text: the text, then how
    many windows, whether the bucket is hot, the anchor's place."""

    def __init__(self, width: int):
        self.width = width
        self.most = 2 * width - GRAM                             # longest segment
        self.wide = -(-(self.most + 3) // 8) * 8
        #: for each number of windows, the bytes of the text
        self.text = np.arange(self.wide) < (np.arange(width - GRAM + 2) + width - 1)[:, None]

    def rows(self, b: np.ndarray, lo: np.ndarray, n: np.ndarray, is_hot: np.ndarray, anchor: np.ndarray) -> np.ndarray:
        rows = windows_at(np.append(b, np.zeros(self.wide, np.uint8)), lo, self.wide)
        rows &= (self.text * np.uint8(255))[n]
        rows[:, self.most], rows[:, self.most + 1], rows[:, self.most + 2] = n, is_hot, anchor
        return rows

    def flat(self, rows: np.ndarray) -> np.ndarray:
        """The texts of the rows end to end."""
        return rows[self.text[rows[:, self.most]]]

    def squeeze(self, rows: np.ndarray, low: np.ndarray) -> bytes:
        parts = [np.ascontiguousarray(rows[:, self.most:self.most + 3].T).tobytes(),
                 np.ascontiguousarray(low.view(np.uint8).reshape(-1, 8).T).tobytes(), self.flat(rows).tobytes()]
        return len(low).to_bytes(4, "little") + squeeze(np.frombuffer(b"".join(parts), np.uint8))

    def unsqueeze(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        k, raw = int.from_bytes(data[:4], "little"), unsqueeze(data[4:], np.uint8)
        rows = np.zeros((k, self.wide), np.uint8)
        rows[:, self.most:self.most + 3] = raw[:3 * k].reshape(3, k).T
        rows[self.text[rows[:, self.most]]] = raw[11 * k:]
        return rows, np.ascontiguousarray(raw[3 * k:11 * k].reshape(8, k).T).view(np.int64).reshape(-1)


class Segments:
    """The distinct segments of a block's runs in open buckets, by shard."""

    def __init__(self, r: Runs, got: dict, bits: int, per_shard: int, width: int, shards: int):
        u, back, _, _ = r.buckets(bits)
        often, very = np.zeros(len(u), bool), np.zeros(len(u), bool)
        for s, a, b in _cuts(u, per_shard):
            x, y, _ = unpack(got[(0, s)])
            often[a:b] = np.unpackbits(np.frombuffer(x, np.uint8), count=b - a)
            very[a:b] = np.unpackbits(np.frombuffer(y, np.uint8), count=b - a)
        run = np.flatnonzero(often[back])
        is_hot = very[back[run]]
        self.lo, self.n = r.lo[run], r.n[run]
        if is_hot.any():                                         # hot runs: one segment per window
            k = np.where(is_hot, self.n, 1)
            step = np.arange(int(k.sum())) - np.repeat(np.cumsum(k) - k, k)
            run, is_hot = np.repeat(run, k), np.repeat(is_hot, k)
            self.lo, self.n = r.lo[run] + step, np.where(is_hot, 1, r.n[run])
        self.ids = r.ids[run]
        rows = Layout(width).rows(r.bytes, self.lo, self.n, is_hot, r.anchor[run] - self.lo)
        route = r.gram[run]
        if is_hot.any():
            h = np.zeros(int(is_hot.sum()), np.uint64)
            for word in rows[is_hot].view(np.uint64).T:
                h = mix64(h ^ word)
            route[is_hot] = mix64(route[is_hot] ^ h, 5)
        to = mix64(route, 11) % np.uint64(shards)
        order, new = by_row(rows, to, shards)
        first = order[new]                                       # first occurrence: smallest id
        self.back = np.empty(len(order), np.int64)
        self.back[order] = np.cumsum(new) - 1
        self.rows, self.first, self.low, to = rows, first, self.ids[first], to[first].astype(np.int64)
        cut = np.flatnonzero(np.diff(to, prepend=-1))
        self.shards = [(s, slice(a, b)) for s, a, b in zip(to[cut].tolist(), cut.tolist(), [*cut[1:].tolist(), len(to)])]


def codes(text: np.ndarray) -> np.ndarray:
    """The next 8 bytes from each position on (zeros behind the end)."""
    code = np.zeros(len(text) + 8, np.uint64)
    code[:len(text)] = text
    for k in (1, 2, 4):
        code[:-k] = (code[:-k] << np.uint64(8 * k)) | code[k:]
    return code[:len(text)]


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Positions of ``text`` sorted by their next ``depth`` bytes at least
    (zeros behind the end), by bucket-pointer refinement."""
    n = len(text)
    code = codes(text)
    order = np.argsort(code)
    code = code[order]
    new = np.ones(n, bool)
    new[1:] = code[1:] != code[:-1]
    del code
    pointer = np.zeros(n, np.int64)                              # bucket identifier: its first place in the array
    lead = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    pointer[order] = lead
    known, bits = 8, n.bit_length()
    while known < depth:
        alone = new & np.append(new[1:], True)
        open_ = np.flatnonzero(~alone)                           # places in buckets of two and more
        if not len(open_):
            break
        p = order[open_]
        later = p + known
        inside = later < n
        next_ = np.zeros(len(p), np.int64)
        next_[inside] = pointer[later[inside]] + 1
        key = (lead[open_].astype(np.uint64) << np.uint64(bits)) | next_.astype(np.uint64)
        sort, _, split = by_key(key, 2 * bits)                   # stays inside each bucket's places
        order[open_] = p[sort]
        new[open_] = split
        lead = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        pointer[order] = lead                                    # later rounds use the refined identifiers
        known *= 2
    return order


def _least(layout: Layout, rows: np.ndarray, own: np.ndarray) -> np.ndarray:
    """For every segment (a row) and each of its windows the smallest id (of
    ``own``) of the segments that hold the window."""
    width, n = layout.width, rows[:, layout.most].astype(np.int64)
    text = layout.flat(rows)
    segment = np.repeat(np.arange(len(n)), n + width - 1)
    offset = np.arange(len(text)) - (np.cumsum(n + width - 1) - (n + width - 1))[segment]
    at = suffix_array(text, width)
    at = at[(offset < n[segment])[at]]                           # suffixes that are windows
    code = codes(text)
    same = np.zeros(len(at), bool)
    same[1:] = True
    for j in (*range(0, width - 8, 8), width - 8):
        c = code[at + j]
        same[1:] &= c[1:] == c[:-1]
    segment, offset = segment[at], offset[at]
    table = np.full((len(n), width - GRAM + 1), np.iinfo(np.int64).max)
    table[segment, offset] = np.minimum.reduceat(own[segment], np.flatnonzero(~same))[np.cumsum(~same) - 1]
    return table


def _sort(width: int):
    """Equal windows among the segments of a shard: for every segment a bit mask
    of the windows that a smaller id than the segment's own holds."""
    def answers(got):
        layout = Layout(width)
        rows, low = zip(*(layout.unsqueeze(data) for _, data in got))
        sizes = [len(x) for x in low]
        rows, low = np.concatenate(rows), np.concatenate(low)
        order, new = by_row(rows, np.zeros(len(rows), np.uint64), 1)
        starts = np.flatnonzero(new)
        counts = np.diff(np.append(starts, len(order)))
        own = np.minimum.reduceat(low[order], starts)
        rows = rows[order[starts]]                               # distinct
        n = rows[:, layout.most].astype(np.uint64)
        whole = (np.uint64(1) << n) - np.uint64(1)
        mask = np.empty(len(low), np.uint64)
        mask[order] = np.where(np.repeat(own, counts) < low[order], np.repeat(whole, counts), np.uint64(0))
        for x in _crowded(layout, rows):
            table = _least(layout, rows[x], own[x])
            k = counts[x]                                        # the segments that came, of each distinct one
            came = order[np.repeat(starts[x] - np.cumsum(k) + k, k) + np.arange(int(k.sum()))]
            smaller = np.packbits(np.repeat(table, k, axis=0) < low[came][:, None], axis=1, bitorder="little")
            bits = np.zeros((len(came), 8), np.uint8)
            bits[:, :smaller.shape[1]] = smaller
            mask[came] = bits.view("<u8").reshape(-1)
        ends = np.cumsum(sizes)
        return [(b, 1, squeeze(mask[e - k:e])) for (b, _), k, e in zip(got, sizes, ends)]
    return answers


def _crowded(layout: Layout, rows: np.ndarray):
    """Places of the distinct segments whose anchor other segments have too,
    whole buckets together, in pieces of about PIECE bytes. (Of a hot bucket a
    segment is one window: equal windows are equal segments.)"""
    plain = np.flatnonzero(rows[:, layout.most + 1] == 0)
    if not len(plain):
        return
    gram = gram_hashes(rows.reshape(-1), plain * layout.wide + rows[plain, layout.most + 2])
    k = max(1, len(gram) - 1).bit_length()
    order, _, new = by_key(gram >> np.uint64(k), 64 - k)
    starts = np.flatnonzero(new)
    counts = np.diff(np.append(starts, len(order)))
    x = plain[order[np.repeat(counts > 1, counts)]]
    counts = counts[counts > 1]
    size = np.cumsum(rows[x, layout.most].astype(np.int64) + layout.width - 1)
    ends = np.cumsum(counts)
    cut = ends[np.flatnonzero(np.diff(size[ends - 1] // PIECE, append=-1))]
    yield from (x[a:b] for a, b in zip([0, *cut.tolist()], cut.tolist()))


OUT = pa.schema([("id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
                 ("spans", pa.list_(pa.list_(pa.int64()))), ("kept", pa.binary())])


def dedup_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 50,
                block_bytes: int = 8 << 20, hot: int = HOT) -> DataFrame:
    """``id_col, n_bytes, n_removed, spans`` (removed byte ranges, end exclusive)
    and ``kept`` (the bytes left) for every row."""
    if not GRAM < width < GRAM + 64:
        raise ValueError(f"width must be between {GRAM + 1} and {GRAM + 63}")
    blocks = pack_documents(docs, id_col, text_col, block_bytes)
    size = blocks.agg(F.sum("size").alias("s")).collect()[0]["s"] or 0
    anchors = max(1, 2 * size // (width - GRAM + 2))
    bits = min(62, int(anchors).bit_length() + BITS)
    shards = -(-anchors // SHARD_ANCHORS)
    per_shard = -(-(1 << bits) // shards)
    met = stored(answer(ask(blocks, _report(width, bits, per_shard)), _met(hot, per_shard)), "anchor-answers")
    n_segments = _segments(met)
    sort_shards = max(1, -(-n_segments // SHARD_SEGMENTS), min(LEAST_SHARDS, n_segments // LEAST_SEGMENTS))

    def segments(r: Runs, got: dict) -> Segments:
        return Segments(r, got, bits, per_shard, width, sort_shards)

    def send(i: int, data: bytes, got: dict) -> pa.Table:
        s, layout = segments(Runs(Block(data), width), got), Layout(width)
        return rows_table([(shard, i, 1, layout.squeeze(s.rows[s.first[x]], s.low[x])) for shard, x in s.shards])

    masks = answer(meet(blocks, met, send, ROW), _sort(width))

    def remove(i: int, data: bytes, got: dict) -> pa.Table:
        block = Block(data)
        r = Runs(block, width)
        s = segments(r, got)
        mask = np.zeros(len(s.low), np.uint64)
        for shard, x in s.shards:
            mask[x] = unsqueeze(got[(1, shard)], np.uint64)
        whole = (np.uint64(1) << s.n.astype(np.uint64)) - np.uint64(1)
        mine = np.where(s.ids > s.low[s.back], whole, mask[s.back])
        some = np.flatnonzero(mine)
        lo, n, mine, whole = s.lo[some], s.n[some], mine[some], whole[some]
        part = mine != whole                                     # of most runs all windows go
        begin, end = [lo[~part]], [(lo + n)[~part] + width - 1]
        lo, mine = lo[part], mine[part]
        for j in range(width - GRAM + 1):
            begin.append(lo[((mine >> np.uint64(j)) & np.uint64(1)).astype(bool)] + j)
            end.append(begin[-1] + width)
        begin, end = np.concatenate(begin), np.concatenate(end)
        order, _, _ = by_key(begin.astype(np.uint64), len(r.bytes).bit_length())
        return _result(block, r, begin[order], end[order])

    out = meet(blocks, met.unionByName(masks), remove,
               "id long, n_bytes long, n_removed long, spans array<array<long>>, kept binary")
    return out.select(F.col("id").alias(id_col), "n_bytes", "n_removed", "spans", "kept")


def _segments(met: DataFrame) -> int:
    """How many segments the blocks will send: the number at the end of each
    answer (eight big-endian bytes), added up."""
    digits = F.hex(F.substring("data", -8, 8))
    return met.agg(F.sum(F.conv(digits, 16, 10).cast("long")).alias("n")).collect()[0]["n"] or 0


def _result(block: Block, r: Runs, begin: np.ndarray, end: np.ndarray) -> pa.Table:
    """The documents without the bytes from ``begin`` (ascending) to ``end``;
    ranges that overlap or touch are one."""
    doc = np.searchsorted(r.ends, begin, side="right")
    reach = np.maximum.accumulate(end)
    new = np.ones(len(begin), bool)
    new[1:] = (begin[1:] > reach[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    begins = np.append(0, r.ends)[:len(r.ends)]
    doc = doc[first]
    a = begin[first] - begins[doc]
    b = reach[np.append(first, len(begin))[1:] - 1] - begins[doc]
    of = np.append(0, np.cumsum(np.bincount(doc, minlength=len(block.texts))))
    gone = np.append(0, np.cumsum(b - a))
    kept = []
    for t, x, y in zip(block.texts, of[:-1].tolist(), of[1:].tolist()):
        cuts = [0, *np.stack([a[x:y], b[x:y]], axis=1).reshape(-1).tolist(), len(t)] if y > x else [0, len(t)]
        kept.append(b"".join(t[c:d] for c, d in zip(cuts[::2], cuts[1::2])))
    pairs = pa.ListArray.from_arrays(pa.array(np.arange(0, 2 * len(a) + 1, 2), pa.int32()),
                                     pa.array(np.stack([a, b], axis=1).reshape(-1), pa.int64()))
    return pa.Table.from_arrays([pa.array(block.ids, pa.int64()), pa.array([len(t) for t in block.texts], pa.int64()),
                                 pa.array(gone[of[1:]] - gone[of[:-1]], pa.int64()),
                                 pa.ListArray.from_arrays(pa.array(of, pa.int32()), pairs),
                                 pa.array(kept, pa.binary())], schema=OUT)

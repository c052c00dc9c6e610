"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Texts become words (``words_of``). The patterns are the windows of
``window`` consecutive words of the benchmark items; an item of fewer words
is one pattern. Patterns of one length share a search: a table of word pairs
says how far the next possible match can be (pairs in no pattern let it jump
over a whole pattern but one word), pairs that end a pattern lead to a bucket
by the pattern's first pair, and the words themselves are compared there.

The documents are read once, without a shuffle. The items are the stated
query set: the driver reads them one partition after another and cuts them
into blocks of at most ``block_words`` words, which bounds each broadcast and
each search table; every block is one more pass of the same task over its
documents, and after ``PASSES`` of them the rows are written. Long items are cut with ``window - 1`` words in common, so that
every window lies in one block.

Defined results: null texts have no words and are not hit; items without words
have no pattern; items with a null id mark words but are not listed; repeated
items and ids count once, repeated documents one by one; empty tables give no
rows or no hits; other columns are not read.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticktale.llm.common import stored, text_of

#: Fixed value: words are runs of ASCII letters, digits and all that is not ASCII;
#: on UTF-8 bytes those are the bytes kept here, A-Z in lower case.
_KEPT = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()

PASSES = 4

Block = list[tuple[str | None, list[bytes]]]


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_KEPT).split()


class WuManber:
    """Search for patterns of ``m`` words each, ``patterns``: words -> item ids."""

    def __init__(self, m: int, patterns: dict[tuple[bytes, ...], set]):
        self.m, self.block = m, min(2, m)
        self.far = m - self.block + 1
        self.shift: dict[tuple, int] = {}
        self.buckets: dict[tuple, dict[tuple, list]] = {}
        size = self.block
        for p, items in patterns.items():
            for end in range(size, m + 1):
                pair = p[end - size:end]
                if m - end < self.shift.get(pair, self.far):
                    self.shift[pair] = m - end
            self.buckets.setdefault(p[m - size:], {}).setdefault(p[:size], []).append((p, items))

    def starts(self, words: list[bytes]):
        """(start, items) of every occurrence."""
        m, size, far, shift = self.m, self.block, self.far, self.shift.get
        end, n = m, len(words)
        while end <= n:
            pair = tuple(words[end - size:end])
            jump = shift(pair, far)
            if jump:
                end += jump
                continue
            begin = end - m
            for p, items in self.buckets[pair].get(tuple(words[begin:begin + size]), ()):
                if tuple(words[begin:end]) == p:
                    yield begin, items
            end += 1


def searches(block: Block, window: int) -> list[WuManber]:
    by_length: dict[int, dict[tuple, set]] = {}
    for item, words in block:
        m = min(window, len(words))
        patterns = by_length.setdefault(m, {})
        for i in range(len(words) - m + 1):
            patterns.setdefault(tuple(words[i:i + m]), set()).add(item)
    return [WuManber(m, patterns) for m, patterns in sorted(by_length.items())]


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted spans, those that touch or overlap as one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            if b > out[-1][1]:
                out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def _search(shared, window: int):
    """Adds a block's hits to rows of (carried, text, n_words, spans, items)."""
    def run(batches):
        engines = searches(shared.value, window)
        for b in batches:
            n_words, spans, items = [], b.column("spans").to_pylist(), b.column("items").to_pylist()
            for i, text in enumerate(b.column("text")):
                words = words_of(text.as_py())
                n_words.append(len(words))
                found: list[tuple[int, int]] = []
                met: set = set()
                for engine in engines:
                    for at, ids in engine.starts(words):
                        if found and at <= found[-1][1] and found[-1][0] <= at:
                            found[-1] = (found[-1][0], max(found[-1][1], at + engine.m))
                        else:
                            found.append((at, at + engine.m))
                        met |= ids
                if found:
                    spans[i] = [{"start": a, "end": e} for a, e in
                                merge(found + [(s["start"], s["end"]) for s in spans[i]])]
                    items[i] = sorted({x for x in met if x is not None}.union(items[i]))
            yield pa.RecordBatch.from_arrays(
                [b.column("carried"), b.column("text"), pa.array(n_words, pa.int64()), pa.array(spans, SPANS),
                 pa.array(items, pa.list_(pa.string()))], names=["carried", "text", "n_words", "spans", "items"])
    return run


def blocks_of(items, window: int, block_words: int):
    """Blocks of (item id, words) with at most ``block_words`` words (one
    window at least) from rows (id, text as bytes)."""
    block, size = [], 0
    for item, text in items:
        words = words_of(bytes(text))
        at = 0
        while at == 0 and words or at + window <= len(words):
            part = words[at:at + max(block_words, window)]
            if block and size + len(part) > block_words:
                yield block
                block, size = [], 0
            block.append((item, part))
            size += len(part)
            at += len(part) - window + 1 if len(part) >= window else len(words)
    yield block


def find(docs: DataFrame, items: DataFrame, carry: tuple[str, ...] = ("doc_id",), text_col: str = "text",
         item_col: str = "item_id", item_text_col: str = "text", window: int = 10,
         block_words: int = 200_000) -> DataFrame:
    """``carry`` columns, ``n_words``, ``spans`` (array of (start, end), hit
    words, end exclusive, in order and apart) and ``items`` (sorted ids as
    strings of the items with an occurring window)."""
    spark = docs.sparkSession
    carried = F.struct(*[F.col(c) for c in carry]).alias("carried")
    rows = docs.select(carried, text_of(text_col).cast("binary").alias("text"), F.lit(0).cast("long").alias("n_words"),
                       F.array().cast("array<struct<start:int,end:int>>").alias("spans"),
                       F.array().cast("array<string>").alias("items"))
    schema = (f"carried {rows.schema['carried'].dataType.simpleString()}, text binary, n_words long, "
              "spans array<struct<start:int,end:int>>, items array<string>")
    read = items.select(F.col(item_col).cast("string"), text_of(item_text_col).cast("binary")).toLocalIterator()
    for i, block in enumerate(blocks_of(read, window, block_words)):
        if i and i % PASSES == 0:
            rows = stored(rows, "leaks")
        rows = rows.mapInArrow(_search(spark.sparkContext.broadcast(block), window), schema)
    return rows.select(*[F.col("carried").getField(c).alias(c) for c in carry], "n_words", "spans", "items")

"""Blocks of documents and the exchange between blocks and hash ranges.

The two repeated-passage operators work on blocks: a few megabytes of whole
documents, compressed into one row of a shared table, so that later passes
read and deal whole blocks instead of single texts. Blocks ask questions of
hash ranges ("shards"): a block sends each shard one packed row, the shard's
task answers each block with one packed row, and blocks and answers meet in a
cogroup. Rows of the exchange are at most blocks times shards and never more
than the packed items; a value that every document holds is one item per
block.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticktale.llm.common import stored, text_of, worker_cache

ROW = "shard int, block long, kind int, data binary"
SCHEMA = pa.schema([("shard", pa.int32()), ("block", pa.int64()), ("kind", pa.int32()), ("data", pa.binary())])


def pack_documents(docs: DataFrame, id_col: str, text_col: str, block_bytes: int) -> DataFrame:
    """Shared table (block, size, data), one row per block of whole texts."""
    def run(batches):
        part, seq, ids, texts, size = TaskContext.get().partitionId(), 0, [], [], 0

        def flush():
            t = pa.table({"id": pa.array(ids, pa.int64()), "text": pa.array(texts, pa.binary())})
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, t.schema) as w:
                w.write_table(t)
            data = zstandard.ZstdCompressor(3).compress(sink.getvalue().to_pybytes())
            return pa.RecordBatch.from_pylist([{"block": (part << 32) + seq, "size": size, "data": data}],
                                              pa.schema([("block", pa.int64()), ("size", pa.int64()), ("data", pa.binary())]))
        for b in batches:
            for i, t in zip(b.column(0).to_pylist(), b.column(1)):
                t = t.as_py()
                ids.append(i), texts.append(t)
                size += len(t)
                if size >= block_bytes or len(ids) >= 1 << 20:
                    yield flush()
                    seq, ids, texts, size = seq + 1, [], [], 0
        if ids:
            yield flush()

    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).cast("binary").alias("text"))
    return stored(rows.mapInArrow(run, "block long, size long, data binary"), "blocks")


class Block:
    """Documents of a block in id order; rows without an id come first and
    take no part in the matching."""

    def __init__(self, data: bytes):
        t = pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(data)).read_all().combine_chunks()
        ids = t.column("id").to_pylist()
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is not None, ids[i] or 0))
        texts = t.column("text").to_pylist()
        self.ids = [ids[i] for i in order]
        self.texts = [texts[i] for i in order]
        self.first = sum(i is None for i in ids)        # first document with an id
        self.doc_ids = np.array([0 if i is None else i for i in self.ids], np.int64)


def squeeze(a: np.ndarray) -> bytes:
    """Compressed array: byte planes, so that small numbers cost few bytes."""
    a = np.ascontiguousarray(a)
    planes = a.view(np.uint8).reshape(len(a), a.dtype.itemsize).T if len(a) else np.zeros(0, np.uint8)
    return worker_cache("squeeze", lambda: zstandard.ZstdCompressor(1)).compress(np.ascontiguousarray(planes).tobytes())


def unsqueeze(data: bytes, dtype) -> np.ndarray:
    raw = np.frombuffer(worker_cache("unsqueeze", zstandard.ZstdDecompressor).decompress(data), np.uint8)
    k = np.dtype(dtype).itemsize
    return np.ascontiguousarray(raw.reshape(k, -1).T).view(dtype).reshape(-1)


def squeeze_sorted(a: np.ndarray) -> bytes:
    return squeeze(np.diff(a, prepend=a.dtype.type(0)))


def unsqueeze_sorted(data: bytes, dtype) -> np.ndarray:
    return np.cumsum(unsqueeze(data, dtype), dtype=dtype)


def pack(*parts: bytes) -> bytes:
    """Several byte strings as one."""
    return b"".join([len(parts).to_bytes(4, "little"), *[len(p).to_bytes(8, "little") for p in parts], *parts])


def unpack(data: bytes) -> list[bytes]:
    n = int.from_bytes(data[:4], "little")
    at, out = 4 + 8 * n, []
    for i in range(n):
        size = int.from_bytes(data[4 + 8 * i:12 + 8 * i], "little")
        out.append(data[at:at + size])
        at += size
    return out


def rows_table(rows: list[tuple[int, int, int, bytes]]) -> pa.Table:
    cols = list(zip(*rows)) or [[], [], [], []]
    return pa.Table.from_arrays([pa.array(list(c), f.type) for c, f in zip(cols, SCHEMA)], schema=SCHEMA)


def ask(blocks: DataFrame, questions) -> DataFrame:
    """Rows for shards from ``questions(block id, data)``."""
    def run(batches):
        for b in batches:
            for i, d in zip(b.column("block").to_pylist(), b.column("data")):
                yield from rows_table(questions(i, d.as_py())).to_batches()
    return blocks.select("block", "data").mapInArrow(run, ROW)


def answer(rows: DataFrame, answers) -> DataFrame:
    """One task per shard: ``answers(list of (block, data))`` gives rows (block,
    kind, data)."""
    def run(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        got = sorted(zip(table.column("block").to_pylist(), table.column("data").to_pylist()))
        return rows_table([(shard, b, k, d) for b, k, d in answers(got)])
    return rows.groupBy("shard").applyInArrow(run, ROW)


def meet(blocks: DataFrame, replies: DataFrame, work, schema: str) -> DataFrame:
    """``work(block id, data, {(kind, shard): data})`` for every block, with the
    answers it got."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        got = {(k, s): d for s, k, d in zip(*(right.column(c).to_pylist() for c in ("shard", "kind", "data")))}
        return work(left.column("block")[0].as_py(), left.column("data")[0].as_py(), got)
    return blocks.select("block", "data").groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(run, schema)


def runs_of(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the runs of True."""
    edge = np.diff(flags.astype(np.int8), prepend=0, append=0)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def covered(n: int, starts: np.ndarray, length: int) -> np.ndarray:
    """Boolean array of length n, True where a window [s, s + length) lies."""
    d = np.zeros(n + 1, np.int32)
    np.add.at(d, starts, 1)
    np.add.at(d, starts + length, -1)
    return np.cumsum(d[:n]) > 0

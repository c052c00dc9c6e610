"""Exact dedup with an extendible-hash index on shared files.

Rows are keyed by a 64-bit hash of the text. The directory maps the top bits
of a key to a bucket; it starts at the depth the corpus size asks for and
doubles while a bucket holds more than ``bucket_bytes``, each overfull bucket
splitting by its next bit. Every bucket has one owner task, which walks its
entries in key order, chains entries of equal key and compares their bytes.
The chain entries (key, digest, keeper, count) are the index: a table in the
shared folder, looked up by every document.

Copies are folded per Arrow batch before anything is dealt, so a text that a
third of all rows share reaches its owner once per batch, not once per row.
The directory is a table too; the driver only learns whether a bucket is
overfull. A bucket of one key that cannot split any more simply stays large
in count, not in bytes: an owner holds one key's distinct texts at a time.

Defined results: null text equals empty text; repeated rows are copies of one
another (rows with equal id and text share one decision); a null id is lower
than any other; an empty table gives an empty result; other columns are not
read.
"""

from __future__ import annotations

import hashlib
import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticktale.llm.common import stored, text_of

ENTRY = "key long, body binary, keep_id long, n long"
CHAIN = "key long, digest binary, keep_id long, group_size long"


def _fold(batches):
    """Copies inside an Arrow batch become one entry with the largest id and
    the number of rows."""
    for b in batches:
        seen: dict = {}
        for key, body, i in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
            e = seen.get((key, body))
            if e is None:
                seen[(key, body)] = [i, 1]
            else:
                e[0] = i if e[0] is None or (i is not None and i > e[0]) else e[0]
                e[1] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in seen], pa.int64()), pa.array([t for _, t in seen], pa.binary()),
             pa.array([e[0] for e in seen.values()], pa.int64()),
             pa.array([e[1] for e in seen.values()], pa.int64())], names=["key", "body", "keep_id", "n"])


def _own(batches):
    """Walk a bucket's entries in key order: entries of equal key form a chain
    whose links are compared byte by byte."""
    key, chain = None, []

    def rows(k, links):
        return [(k, hashlib.sha256(t).digest(), i, n) for t, i, n in links]

    for b in batches:
        out = []
        for k, body, i, n in zip(*(b.column(c).to_pylist() for c in ("key", "body", "keep_id", "n"))):
            if k != key:
                out += rows(key, chain)
                key, chain = k, []
            for link in chain:
                if link[0] == body:
                    link[1] = i if link[1] is None or (i is not None and i > link[1]) else link[1]
                    link[2] += n
                    break
            else:
                chain.append([body, i, n])
        yield _chain_batch(out)
    yield _chain_batch(rows(key, chain))


def _chain_batch(rows):
    cols = list(zip(*rows)) or [[], [], [], []]
    kinds = (pa.int64(), pa.binary(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, kinds)],
                                      names=["key", "digest", "keep_id", "group_size"])


def _slot(key: Column | str, depth: int) -> Column:
    key = F.col(key) if isinstance(key, str) else key
    return F.shiftrightunsigned(key, 64 - depth) if depth else F.lit(0).cast("long")


def directory(loads: DataFrame, depth: int, max_depth: int, bucket_bytes: int) -> tuple[DataFrame, int]:
    """The directory of a load table (slot at ``max_depth``, bytes): a table
    (slot, bucket, local_depth) for every loaded slot and the global depth
    reached. Doubles while a bucket is overfull and has bits left."""
    d = depth
    at = loads.withColumn("local_depth", F.lit(d))
    while True:
        at = at.withColumn("bucket", F.call_function(
            "shiftrightunsigned", F.col("slot"), F.lit(max_depth) - F.col("local_depth")))
        full = (at.groupBy("local_depth", "bucket").agg(F.sum("bytes").alias("load"))
                .where((F.col("load") > bucket_bytes) & (F.col("local_depth") < max_depth))
                .select("local_depth", "bucket", F.lit(1).alias("over")))
        full = stored(full, "directory-overfull")
        if full.isEmpty():
            return at.select("slot", "bucket", "local_depth"), d
        d += 1
        at = stored(at.join(full, ["local_depth", "bucket"], "left")
                    .withColumn("local_depth", F.col("local_depth") + F.coalesce(F.col("over"), F.lit(0)))
                    .drop("over", "bucket"), "directory")


def build_index(docs: DataFrame, id_col: str, text_col: str, bucket_bytes: int, key_bits: int = 64) -> DataFrame:
    """The chains of all buckets, written to the shared folder."""
    rows = keyed(docs, id_col, text_col, key_bits)
    total = rows.agg(F.sum(F.octet_length("body")).alias("b")).collect()[0]["b"] or 0
    depth = max(0, math.ceil(math.log2(max(1, total / bucket_bytes))))
    max_depth = depth + 6
    loads = stored(rows.groupBy(_slot("key", max_depth).alias("slot"))
                   .agg(F.sum(F.octet_length("body") + 16).alias("bytes")), "directory-loads")
    slots, _ = directory(loads, depth, max_depth, bucket_bytes)
    entries = rows.select("key", "body", "id").mapInArrow(_fold, ENTRY).withColumn("slot", _slot("key", max_depth))
    placed = entries.join(slots, "slot").select("local_depth", "bucket", "key", "body", "keep_id", "n")
    owned = (placed.repartition("local_depth", "bucket")
             .sortWithinPartitions("local_depth", "bucket", "key")
             .select("key", "body", "keep_id", "n").mapInArrow(_own, CHAIN))
    return stored(owned, "exact-index")


def keyed(docs: DataFrame, id_col: str, text_col: str, key_bits: int = 64) -> DataFrame:
    body = text_of(text_col).cast("binary")
    key = F.xxhash64(body)
    if key_bits < 64:
        key = F.shiftleft(F.shiftrightunsigned(key, 64 - key_bits), 64 - key_bits)
    return docs.select(F.col(id_col).cast("long").alias("id"), body.alias("body"), key.alias("key"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                bucket_bytes: int = 32 << 20, key_bits: int = 64) -> DataFrame:
    """``id_col, keep_id, group_size, kept, text_sha256`` for every row. The row
    with the largest id of each set of equal texts is kept. ``key_bits``
    narrows the key (tests force collisions with it)."""
    index = build_index(docs, id_col, text_col, bucket_bytes, key_bits)
    rows = keyed(docs, id_col, text_col, key_bits).select(
        "id", "key", F.unhex(F.sha2("body", 256)).alias("digest"))
    return (rows.join(index, ["key", "digest"])
            .select(F.col("id").alias(id_col), "keep_id", "group_size",
                    F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
                    F.lower(F.hex("digest")).alias("text_sha256")))

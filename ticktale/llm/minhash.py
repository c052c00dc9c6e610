"""Near-duplicates by circulant MinHash, banding and exact Jaccard checks.

Texts with equal shingle sets are one node from the start (a 128-bit digest of
the set), so copies never pair up. A node's signature comes from two
permutations of the 32-bit universe: ``sigma`` scrambles the shingles once,
``pi`` is shifted circularly by one position per coordinate. Bands of
coordinates are the buckets.

Candidates without all pairs of a bucket: every member is compared with one
pivot, the member that shares most buckets with others (in a group of edited
copies, the text nearest to the original). The exact comparison gives the links
to the pivot and, for each member, the shingles in which it differs from the
pivot: those it lacks (l of them) and those it adds (d). For two members A and B
of a pivot of p shingles, with s differences in common, 100 * intersection >=
q * union is the same as

    (100 + q) * s >= w(A) + w(B) - (100 - q) * p,  where w = 100 * l + q * d,

and a member is linked with the pivot if w <= (100 - q) * p. Of two members not
yet joined one is not linked with the pivot, so s is above 0, and often about
half of the differences. With the differences of a member in order of how few
others share them, a pair must meet in the first |differences| - s + 1 of both
(a prefix filter). Only such meetings are candidates; edits made independently
never meet there, so a large group of texts that resemble each other below the
threshold costs one comparison a member.

The meetings are buckets again. One whose members are all of one component is
settled. In the others, members outside the largest component become pivots,
four times as many each round, and are compared with members of other
components until every one has been a pivot. So every pair that shares a band is
either checked, excluded by the inequality or already joined.

With 30 bands of 5 coordinates a link of exactly 0.85 is missed with a
probability of 2e-8. On corpora with far more texts, more rows per band keep
chance collisions rare (parameters).

Defined results: null texts and texts without a word have an empty set, are
their own component and stay; a text with fewer than ``k`` words is one
shingle; rows with a null id are linked with nothing and stay; rows that repeat
an id share its component. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticktale.llm.common import mix64, stored, text_of
from ticktale.llm.tokens import slices

WORDS_KEPT = 300_000        # word hashes a worker remembers


class _Hashes(dict):
    def __missing__(self, w: bytes) -> int:
        h = self[w] = xxhash.xxh3_64_intdigest(w)
        return h


_HASHES = _Hashes()


def shingles(text: str, k: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes of the lower-cased words."""
    words = text.encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(_HASHES) > WORDS_KEPT:
        _HASHES.clear()
    h = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    n = max(1, len(h) - k + 1)
    out = np.zeros(n, np.uint64)
    for i in range(min(k, len(h))):
        out = out * np.uint64(0x9E3779B97F4A7C15) + h[i:i + n]
    return np.unique(mix64(out))


def _scramble(x: np.ndarray, a: int, b: int) -> np.ndarray:
    """A bijection of 32-bit integers, in place."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(a)
    x ^= x >> np.uint32(13)
    x *= np.uint32(b)
    x ^= x >> np.uint32(16)
    return x


def signature(s: np.ndarray, size: int) -> np.ndarray:
    """Coordinate j is the least pi(sigma(x) + j) over the set."""
    low = np.full(size, 0xFFFFFFFF, np.uint32)
    shifts = np.arange(size, dtype=np.uint32)[:, None]
    for at in range(0, len(s), 512):
        x = _scramble(s[at:at + 512].astype(np.uint32), 0x85EBCA6B, 0xC2B2AE35)
        low = np.minimum(low, _scramble(x[None, :] + shifts, 0xCC9E2D51, 0x1B873593).min(axis=1))
    return low


def band_keys(sigs: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One key per band for each row of a matrix of signatures."""
    parts = sigs.reshape(len(sigs), bands, rows).astype(np.uint64)
    key = np.broadcast_to(np.arange(bands, dtype=np.uint64), parts.shape[:2])
    for j in range(rows):
        key = mix64(key ^ parts[:, :, j], 3)
    return key.view(np.int64)


def _sign(bands: int, rows: int, k: int):
    def run(batches):
        for b in batches:
            for ids, texts in slices(b):
                sets = [shingles(t, k) for t in texts]
                linked = [i is not None and len(s) > 0 for i, s in zip(ids.to_pylist(), sets)]
                sigs = np.array([signature(s, bands * rows) for s, x in zip(sets, linked) if x],
                                np.uint32).reshape(-1, bands * rows)
                keys = iter(band_keys(sigs, bands, rows))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([xxhash.xxh3_128_digest(s.tobytes()) if x else None for s, x in zip(sets, linked)], pa.binary()),
                     pa.array([next(keys) if x else None for x in linked], pa.list_(pa.int64()))],
                    names=["id", "n", "node", "bands"])
    return run


def _sets(k: int):
    """Whole sets of nodes; a row that repeats an id with another text is not
    the node's and is left out."""
    def run(batches):
        for b in batches:
            for nodes, texts in slices(b):
                items = [shingles(t, k).tobytes() for t in texts]
                own = [xxhash.xxh3_128_digest(x) == n for x, n in zip(items, nodes.to_pylist())]
                yield pa.RecordBatch.from_arrays([nodes, pa.array(items, pa.binary())],
                                                 names=["node", "items"]).filter(pa.array(own, pa.bool_()))
    return run


def _differ(percent: int):
    """How each node's set differs from its pivot's: ``w`` and ``c`` of the
    inequality above, and the differences."""
    def run(batches):
        for b in batches:
            ws, cs, diffs = [], [], []
            for x, y in zip(b.column("items"), b.column("pivot_items")):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                lacks = np.setdiff1d(y, x, assume_unique=True)
                adds = np.setdiff1d(x, y, assume_unique=True)
                ws.append(100 * len(lacks) + percent * len(adds))
                cs.append((100 - percent) * len(y))
                diffs.append(np.concatenate([lacks, adds]).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [b.column("node"), b.column("pivot"), pa.array(ws, pa.int64()), pa.array(cs, pa.int64()),
                 pa.array(diffs, pa.list_(pa.int64()))], names=["node", "pivot", "w", "c", "diff"])
    return run


def _confirm(percent: int):
    """Exact check: 100 * intersection >= percent * union."""
    def run(batches):
        for b in batches:
            ok = []
            for x, y in zip(b.column("ia").to_pylist(), b.column("ib").to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(x) + len(y) - len(np.union1d(x, y))
                ok.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))
    return run


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) for every node of an edge table (a, b); ``comp`` is the
    least node reachable. Each round hooks components to their least
    neighbour, follows the pointers to the roots and contracts the edges."""
    labels, e = None, edges
    while True:
        both = e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = stored(both.groupBy("a").agg(F.min("b").alias("m"))
                    .select(F.col("a").alias("node"), F.least("a", "m").alias("comp")), "cc-up")
        while True:
            nxt = up.select(F.col("node").alias("comp"), F.col("comp").alias("top"))
            new = stored(up.join(nxt, "comp").select("node", F.col("top").alias("comp"),
                                                     (F.col("top") != F.col("comp")).alias("moved")), "cc-jump")
            up = new.drop("moved")
            if new.where("moved").isEmpty():
                break
        if labels is None:
            labels = up
        else:
            step = up.select(F.col("node").alias("comp"), F.col("comp").alias("top"))
            labels = stored(labels.join(step, "comp", "left")
                            .select("node", F.coalesce("top", "comp").alias("comp")), "cc-labels")
        a = up.select(F.col("node").alias("a"), F.col("comp").alias("ca"))
        b = up.select(F.col("node").alias("b"), F.col("comp").alias("cb"))
        e = stored(e.join(a, "a").join(b, "b").where("ca != cb")
                   .select(F.col("ca").alias("a"), F.col("cb").alias("b")).distinct(), "cc-edges")
        if e.isEmpty():
            return labels


def _stars(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Every member of a bucket compared with the bucket's pivot."""
    fame = members.groupBy("node").agg(F.sum("m").alias("fame"))
    pivots = (members.join(fame, "node").groupBy("bucket")
              .agg(F.max_by("node", F.struct("fame", "node")).alias("pivot")))
    pairs = members.join(pivots, "bucket").where("node != pivot").select("node", "pivot").distinct()
    of_pivot = sets.select(F.col("node").alias("pivot"), F.col("items").alias("pivot_items"))
    rows = pairs.join(sets, "node").join(of_pivot, "pivot").select("node", "pivot", "items", "pivot_items")
    rows = rows.mapInArrow(_differ(percent), "node binary, pivot binary, w long, c long, diff array<long>")
    return stored(rows.withColumn("star", F.monotonically_increasing_id()), "minhash-stars")


def _meetings(stars: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """(bucket, node, w, c, r, ...): a bucket is a difference in the prefix of
    several members of one pivot; ``r`` counts the member's differences from there on."""
    comp = stars.select("pivot", "node").join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    unsettled = comp.groupBy("pivot").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low != high")
    rows = stored(stars.join(unsettled.select("pivot"), "pivot")
                  .select("star", "w", "c", F.explode("diff").alias("x"), "pivot")
                  .select("star", "w", "c", F.xxhash64("pivot", "x").alias("bucket")), "minhash-differences")
    several = rows.groupBy("bucket").agg(F.count("*").alias("f")).where("f > 1")
    ranked = (rows.join(several, "bucket").groupBy("star")
              .agg(F.first("w").alias("w"), F.first("c").alias("c"),
                   F.sort_array(F.collect_list(F.struct("f", "bucket"))).alias("order"))
              .select("star", "w", "c", F.size("order").alias("size"), F.posexplode("order").alias("i", "at"))
              .select("star", "w", "c", F.col("at.bucket").alias("bucket"), (F.col("size") - F.col("i")).alias("r"),
                      (F.col("w") > F.col("c")).alias("far")))
    # against a far partner, and (for a far member) against one that is linked with the pivot
    strict = (100 + percent) * F.col("r") > F.col("w")
    wide = F.col("far") & (100 * F.col("r") >= F.col("w") - F.col("c"))
    prefix = stored(ranked.withColumn("strict", strict).where(strict | wide), "minhash-prefixes")
    met = prefix.groupBy("bucket").agg(F.count("*").alias("m"), F.max(~F.col("far")).alias("near")).where("m > 1")
    return stored(prefix.join(met, "bucket").where("strict or near").join(stars.select("star", "node"), "star")
                  .select("bucket", "node", "w", "c", "r", "strict", "far"), "minhash-meetings")


def _ordered(x: str, y: str):
    return F.least(x, y).alias("a"), F.greatest(x, y).alias("b")


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 85,
               bands: int = 30, rows: int = 5) -> DataFrame:
    """``id_col, n_shingles, component_id, kept`` for every row."""
    base = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    signed = stored(base.mapInArrow(
        _sign(bands, rows, k), "id long, n long, node binary, bands array<long>"), "minhash-signed")
    nodes = stored(signed.where("node is not null").groupBy("node").agg(
        F.min("id").alias("rep"), F.first("bands").alias("bands")), "minhash-nodes")
    placed = nodes.select("node", F.explode("bands").alias("bucket"))
    shared = placed.groupBy("bucket").agg(F.count("*").alias("m")).where("m > 1")
    members = stored(placed.join(shared, "bucket"), "minhash-buckets")
    need = members.select("node").distinct().join(nodes.select("node", "rep"), "node")
    # a repeated row gives its text again: one set for a node
    sets = stored(base.join(need, base["id"] == need["rep"]).select("node", "text").dropDuplicates()
                  .mapInArrow(_sets(k), "node binary, items binary").dropDuplicates(["node"]), "minhash-sets")

    stars = _stars(members, sets, percent)
    tested = stars.select(*_ordered("node", "pivot"))
    links = stars.where("w <= c").select(*_ordered("node", "pivot"))
    labels = nodes.where("false").select("node", F.col("node").alias("comp"))
    if not links.isEmpty():
        labels = components(links)
    meetings = _meetings(stars, labels, percent)
    n_pivots = 4
    while True:
        now = meetings.join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
        sizes = now.groupBy("bucket", "comp").agg(F.count("*").alias("m"))
        unsettled = (sizes.groupBy("bucket").agg(F.count("*").alias("comps"), F.sum("m").alias("all"),
                                                 F.max("m").alias("largest"),
                                                 F.max_by("comp", F.struct("m", "comp")).alias("main"))
                     .where("comps > 1"))
        unsettled = stored(unsettled, "minhash-unsettled")
        most = unsettled.agg(F.max(F.col("all") - F.col("largest")).alias("m")).collect()[0]["m"]
        if most is None:
            break           # each bucket holds one component
        now = stored(now.join(unsettled.select("bucket", "main"), "bucket"), "minhash-open")
        order = Window.partitionBy("bucket").orderBy("node")
        chosen = (now.where("comp != main").withColumn("at", F.row_number().over(order)).where(F.col("at") <= n_pivots)
                  .select("bucket", *(F.col(x).alias(f"p_{x}") for x in ("node", "comp", "w", "r", "strict", "far"))))
        pairs = (now.join(chosen, "bucket").where("comp != p_comp and ((strict and p_strict) or not (far and p_far))")
                 .where((100 + percent) * F.least("r", "p_r") >= F.col("w") + F.col("p_w") - F.col("c"))
                 .select(*_ordered("node", "p_node")).distinct())
        pairs = stored(pairs.join(tested, ["a", "b"], "left_anti"), "minhash-pairs")
        tested = tested.unionByName(pairs)
        found = _check(pairs, sets, percent)
        if not found.isEmpty():
            links = links.unionByName(found)
            labels = components(links)
        if most <= n_pivots:
            break           # every member outside a main component was a pivot in this round
        n_pivots *= 4
    comp = (nodes.select("node", "rep").join(labels, "node", "left")
            .withColumn("comp", F.coalesce("comp", "node")))
    least = comp.groupBy("comp").agg(F.min("rep").alias("component"))
    of_node = comp.join(least, "comp").select("node", "component")
    out = signed.select("id", "n", "node").join(of_node, "node", "left")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                      F.coalesce("component", "id").alias("component_id"),
                      F.coalesce(F.col("id") == F.coalesce("component", "id"), F.lit(True)).alias("kept"))


def _check(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs that are links, by their whole sets."""
    ia = sets.select(F.col("node").alias("a"), F.col("items").alias("ia"))
    ib = sets.select(F.col("node").alias("b"), F.col("items").alias("ib"))
    found = pairs.join(ib, "b").join(ia, "a").select("a", "b", "ia", "ib")
    return stored(found.mapInArrow(_confirm(percent), "a binary, b binary").distinct(), "minhash-links")

"""op1 over many blocks and shards: what goes to the suffix sort, and the edges of its pieces."""

import random

import numpy as np
import pytest

import __spark_entry__  # noqa: F401  (functions travel by value: what a test sets reaches the tasks)
from ticktale.llm import suffixes
from test_llm import ROWS, bytes_brute, frame, key


def test_copies_are_not_sorted_again(spark, tmp_path, monkeypatch):
    """Of whole copies every anchor bucket keeps one segment: nothing to sort."""
    real, log = suffixes.suffix_array, str(tmp_path / "sorted")

    def counted(text, depth):
        with open(log, "a") as f:
            f.write(f"{len(text)}\n")
        return real(text, depth)

    monkeypatch.setattr(suffixes, "suffix_array", counted)
    r = random.Random(3)
    rows = [(i, "".join(r.choices("abcdefghijklmnop ", k=30_000))) for i in range(20)]
    out = suffixes.dedup_bytes(frame(spark, rows + [(i + 100, t) for i, t in rows] + [(200, rows[3][1][:60] + "!")])).collect()
    n = {r["doc_id"]: (r["n_bytes"], r["n_removed"]) for r in out}
    assert all(n[i] == (len(t), 0) and n[i + 100] == (len(t), len(t)) for i, t in rows) and n[200] == (61, 60)
    assert 0 < sum(map(int, open(log))) < sum(len(t) for _, t in rows) / 20


@pytest.mark.parametrize("small", [{"CHUNK": 7}, {"PIECE": 60}, {"SHARD_SEGMENTS": 5}, {"CHUNK": 64, "SHARD_ANCHORS": 9}])
def test_pieces_do_not_change_the_result(spark, monkeypatch, small):
    for name, value in small.items():
        monkeypatch.setattr(suffixes, name, value)
    df = suffixes.dedup_bytes(frame(spark, ROWS[:-8]), hot=3)
    got = [(r["doc_id"], r["n_bytes"], r["n_removed"], len(r["spans"]), bytes(r["kept"])) for r in df.collect()]
    assert key(got) == key(bytes_brute(ROWS[:-8]))


def test_rows_of_one_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(suffixes, "mix64", lambda x, salt=0: x * np.uint64(0))
    r = np.random.default_rng(4)
    rows, to = r.integers(0, 2, (300, 8)).astype(np.uint8), r.integers(0, 3, 300)
    order, new = suffixes.by_row(rows, to, 3)
    group = np.cumsum(new) - 1
    seen = {}
    for p, g in zip(order.tolist(), group.tolist()):
        seen.setdefault((int(to[p]), rows[p].tobytes()), []).append((g, p))
    assert len(seen) == new.sum() and sorted(order.tolist()) == list(range(300))
    assert all(len({g for g, _ in x}) == 1 and x == sorted(x) for x in seen.values())
    assert (np.diff(to[order]) >= 0).all()

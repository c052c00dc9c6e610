"""Tokens are worked on in pieces that stay small whatever the size of a batch."""

import pyarrow as pa

from ticktale.operators import word_rows


def test_joined_tokens_are_cut_from_arrow_batches():
    texts = ["\n".join(f"w{i % 97}" for i in range(j, j + 2000)) if j % 3 else ("" if j % 2 else None) for j in range(1500)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(1500), pa.int64()), pa.array(texts)], names=["doc_id", "_toks"])
    got = []
    for p in word_rows._token_lists([batch], "doc_id"):
        rows = p.column("_toks").to_pylist()
        assert sum(len("\n".join(r)) for r in rows) <= 1 << 20       # four times as much before, from a pandas copy of the batch
        got += zip(p.column("doc_id").to_pylist(), rows)
    assert got == [(j, t.split("\n")) for j, t in enumerate(texts) if t]


def test_long_row_is_a_piece_of_its_own():
    size = word_rows.PIECE_TOKENS
    batch = pa.RecordBatch.from_arrays([pa.array([["a"], ["b"] * (size + 5), ["c"], []], pa.list_(pa.string()))], names=["t"])
    assert [p.num_rows for p in word_rows._pieces([batch], "t")] == [1, 1, 2]
    assert size <= 1 << 16

"""Spelling variants, decontamination and whitening against brute force, with
nulls, empty and long texts, ties, repeated rows, empty tables and extra
columns whose names the operators use inside."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ticktale.llm import decontaminate, spelling, whitening

SCHEMA = "doc_id long, text string, word string, n long, cell string, chunk long, carried string, items string, spans string"


def documents(spark, rows):
    return spark.createDataFrame([r + ("w", 1, "c", 2, "x", "i", "s") for r in rows], SCHEMA).repartition(3)


# ---------------------------------------------------------------- spelling
def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if abs(len(a) - len(b)) != 1:
        return False
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def spelling_brute(rows, min_length=6, min_count=5, every=199, ratio=5):
    counts = Counter()
    for i, t in rows:
        low = "".join(c.lower() if c.isascii() else c for c in t or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", low):
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    vocab = {w: n for w, n in counts.items() if len(w) >= min_length and n >= min_count}
    near = {w: [v for v in vocab if one_edit(w, v)] for w in vocab}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-vocab[v], v), default=None)
        form[w] = best if best is not None and vocab[best] >= ratio * vocab[w] else None
    out = []
    for w, n in vocab.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), vocab.get(form[w])))
    return sorted(out)


def spelling_rows(seed=3):
    r = np.random.default_rng(seed)
    base = ["".join(r.choice(list("aeinrtslé"), r.integers(5, 9))) for _ in range(60)]
    rows = []
    for i in range(120):
        ws = []
        for _ in range(150):
            w = base[min(int(r.exponential(12)), 59)]
            if r.random() < 0.3:
                at = r.integers(len(w))
                w = [w[:at] + w[at + 1:], w[:at] + "x" + w[at:], w[:at] + "y" + w[at + 1:]][r.integers(3)]
            ws.append(w.upper() if r.random() < 0.1 and w.isascii() else w)
        rows.append((i, " ".join(ws)))
    long_run = "ab" * 3000
    return rows + [(200, None), (201, ""), (None, "Straße straßen " * 9), (202, "ÀÉàé÷×x " * 7), (203, rows[0][1]),
                   (203, rows[0][1]), (204, f"{long_run} {long_run}c " * 6),
                   (205, "1abcdef2abcdeg_abcdeh " * 6 + "abcde日本 " * 9)]


@pytest.mark.parametrize("kw", [{}, {"chunk_words": 3}, {"groups": 2}])
def test_spelling_equals_brute_force(spark, kw):
    rows = spelling_rows()
    got = spelling.variants(documents(spark, rows), every=7, **kw)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = spelling_brute(rows, every=7)
    assert sorted(map(tuple, got.collect()), key=lambda r: r[0]) == want
    assert sum(r[1] is not None for r in want) > 20 and any(r[1] is not None and r[1] != r[2] for r in want)


def test_spelling_chain_of_forms_and_ties(spark):
    text = " ".join(["aaaaaa"] * 3125 + ["aaaaab"] * 625 + ["aaaabb"] * 125 + ["aaabbb"] * 25 + ["aabbbb"] * 5
                    + ["zzzzzz"] * 5 + ["zzzzzy"] * 25 + ["zzzzzx"] * 25)
    got = {r["word"]: r for r in spelling.variants(documents(spark, [(1, text)]), every=1 << 40).collect()}
    assert {w: got[w]["root"] for w in ("aabbbb", "aaabbb", "aaaabb", "aaaaab", "aaaaaa")} == dict.fromkeys(
        ("aabbbb", "aaabbb", "aaaabb", "aaaaab", "aaaaaa"), "aaaaaa")
    assert got["zzzzzz"]["form"] == "zzzzzx" and got["aaaaaa"]["form"] is None and got["zzzzzx"]["n_near"] == 2


@pytest.mark.parametrize("n", [0, 1])
def test_near_pairs_of_all_block_shapes(n):
    r = np.random.default_rng(n)
    words = ["".join(r.choice(list("abc"), 6)) for _ in range(300)]
    a = sorted(set(words))
    b = sorted({w[:i] + c + w[i:] for w in a[:40] for i in range(7) for c in "abd"})
    for x, y in ((a, a), (a, b)):
        m = [np.frombuffer("".join(v).encode("latin-1"), np.uint8).reshape(-1, len(v[0])) for v in (x, y)]
        got = set(zip(*(v.tolist() for v in spelling.near_pairs(*m, same=x is y))))
        assert got == {(i, j) for i, p in enumerate(x) for j, q in enumerate(y) if one_edit(p, q) and (x is not y or i < j)}


# ---------------------------------------------------------------- decontamination
def words_brute(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)


def leaks_brute(docs, items, width=10):
    windows = defaultdict(set)
    for i, t in items:
        ws = words_brute(t)
        m = min(width, len(ws))
        for p in range(len(ws) - m + 1 if ws else 0):
            windows[tuple(ws[p:p + m])].add(i)
    out = []
    for i, t in docs:
        ws, hit, met = words_brute(t), set(), set()
        for m in {len(w) for w in windows}:
            for p in range(len(ws) - m + 1):
                found = windows.get(tuple(ws[p:p + m]))
                if found:
                    hit.update(range(p, p + m))
                    met |= found
        out.append((i, len(ws), sorted(hit), sorted(str(x) for x in met if x is not None)))
    return sorted(out, key=repr)


def leak_rows():
    r = np.random.default_rng(8)
    vocab = [f"w{i}" for i in range(30)] + ["Été", "日本"]

    def prose(n):
        return " ".join(r.choice(vocab, n))
    items = [(i, prose(int(r.integers(1, 60)))) for i in range(30)]
    items += [(5, items[5][1]), (31, items[4][1]), (None, "only null id words one two"), (32, None), (33, "..."), (34, ""),
              (35, "same " * 40), (36, "tie tie"), (37, "tie"), (38, "Zz, zz! ZZ?")]
    docs = [(i, prose(int(r.integers(0, 400)))) for i in range(40)]
    for i in range(40, 60):
        docs.append((i, prose(30) + "\n" + items[i % 30][1].upper().replace(" ", "--") + "; " + prose(20)))
    docs += [(60, None), (61, ""), (62, "...!"), (63, "same " * 5000), (64, "x only null id words one two y"),
             (None, items[3][1]), (65, items[3][1]), (65, items[3][1]), (66, "tie"), (67, "zz zz  zz"), (68, "Ł" * 9 + " été")]
    return docs, items


@pytest.mark.parametrize("block_words", [200_000, 60])
def test_decontamination_equals_brute_force(spark, block_words):
    docs, items = leak_rows()
    found = decontaminate.find(documents(spark, docs), spark.createDataFrame(items, "item_id long, text string"),
                               block_words=block_words)
    got = [(r["doc_id"], r["n_words"], [p for s in r["spans"] for p in range(s["start"], s["end"])], r["items"])
           for r in found.collect()]
    want = leaks_brute(docs, items)
    assert sorted(got, key=repr) == want
    assert 20 < sum(bool(w[2]) for w in want)


def test_no_items_or_no_documents(spark):
    docs, items = leak_rows()
    none = spark.createDataFrame([], "item_id long, text string")
    got = decontaminate.find(documents(spark, docs), none).collect()
    assert len(got) == len(docs) and not any(r["spans"] or r["items"] for r in got)
    empty = documents(spark, docs).where("false")
    assert decontaminate.find(empty, spark.createDataFrame(items, "item_id long, text string")).count() == 0
    assert spelling.variants(empty).count() == 0


# ---------------------------------------------------------------- whitening
VECTORS = "vec_id long, embedding array<float>, key binary, dims int, carried string, copies long, weight long, component int"


def vector_frame(spark, rows):
    return spark.createDataFrame([(*r, b"k", 1, "c", 2, 3, 4) for r in rows], VECTORS).repartition(3)


def whitening_brute(rows, dims, components=32, once=False):
    usable = [(i, [float(np.float32(c)) for c in v]) for i, v in rows
              if v is not None and len(v) == dims and all(c is not None and np.isfinite(c) for c in v)]
    x = [[int(np.floor(64 * c)) + 1_000_000 for c in v] for _, v in usable]
    fit = sorted({tuple(v) for v in x}) if once else x
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    z = np.array([[(n * c - s) / n for c, s in zip(v, sums)] for v in fit])
    cov = z.T @ z / n
    e, vec = np.linalg.eigh(cov)
    e, vec = e[::-1][:components], vec[:, ::-1][:, :components]
    dev = [sum((n * c - s) ** 2 for c, s in zip(v, sums)) for v in x]
    white = np.array([[(n * c - s) / n for c, s in zip(v, sums)] for v in x]) @ vec / np.sqrt(e)
    return usable, n, dev, white, e / np.trace(cov)


def vector_rows(dims=40, n=300, seed=2):
    r = np.random.default_rng(seed)
    mix = r.normal(size=(dims, dims)) * np.linspace(0.3, 2, dims)
    rows = [(i, (r.normal(size=dims) @ mix * 0.2).tolist()) for i in range(n)]
    rows += [(1000 + i, rows[7][1]) for i in range(150)] + [(7, rows[7][1]), (None, rows[8][1])]
    v = rows[0][1]
    return rows + [(2000, None), (2001, []), (2002, v[:-1] + [None]), (2003, v[:-1] + [float("nan")]),
                   (2004, v[:-1] + [float("inf")]), (2005, v[:10]), (2006, [700.0] + v[1:])]


@pytest.mark.parametrize("weights", ["count", "one"])
def test_whitening_equals_brute_force(spark, weights):
    rows = vector_rows()
    usable, n, dev, white, explained = whitening_brute(rows, 40, once=weights == "one")
    got = whitening.whiten(vector_frame(spark, rows), weights=weights)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    rows_of = defaultdict(list)
    for r in got.collect():
        assert r["n"] == n and r["identity_error"] < 1e-9
        assert abs(r["explained"] / explained[r["component"] - 1] - 1) < 1e-9
        rows_of[r["vec_id"]].append(r)
    assert {i: 32 * sum(j == i for j, _ in usable) for i, _ in usable} == {i: len(r) for i, r in rows_of.items()}
    sign = {}
    for (i, _), d, w in zip(usable, dev, white):
        for r in rows_of[i]:
            assert r["deviation"] == d
            k = r["component"] - 1
            sign.setdefault(k, np.sign(r["whitened"] * w[k]))
            assert abs(r["whitened"] * sign[k] - w[k]) < 1e-7 * max(1, abs(w[k]))


def test_whitening_degenerate_inputs(spark):
    assert whitening.whiten(vector_frame(spark, [])).count() == 0
    assert whitening.whiten(vector_frame(spark, [(1, None), (2, [])])).count() == 0
    one = whitening.whiten(vector_frame(spark, [(1, [0.5, 1.0]), (2, [0.5, 1.0])])).collect()
    assert len(one) == 4 and all(r["deviation"] == 0 and r["whitened"] is None and r["explained"] is None
                                 and r["identity_error"] is None for r in one)
    flat = whitening.whiten(vector_frame(spark, [(1, [0.0, 1.0]), (2, [2.0, 1.0]), (3, [1.0, 1.0])])).collect()
    assert {r["component"]: r["explained"] for r in flat} == {1: 1.0, 2: 0.0}
    assert all((r["whitened"] is None) == (r["component"] == 2) for r in flat)
    big = whitening.whiten(vector_frame(spark, [(1, [1e30, 0.0]), (2, [-3e9, 1.0]), (3, [1.0, 2.0])])).collect()
    assert len(big) == 6 and all(r["identity_error"] < 1e-4 for r in big)
    assert {r["vec_id"]: r["deviation"] is None for r in big} == {1: True, 2: True, 3: True}


def test_exact_sums_beyond_64_bits():
    x = np.array([[2 ** 50, 5], [3, -2 ** 50]])
    dev = whitening.exact_deviations(x, 10 ** 6, [7, 9])
    assert dev.tolist() == [[10 ** 6 * 2 ** 50 - 7, 5 * 10 ** 6 - 9], [3 * 10 ** 6 - 7, -10 ** 6 * 2 ** 50 - 9]]
    assert whitening.squared_lengths(dev) == [None, None]
    assert whitening.squared_lengths(np.array([[3, 4]])) == [25]
    y = np.array([[1, -128], [1, 127], [300, 1], [2 ** 40, 0]])
    assert (whitening.decode_rows(whitening.encode_rows(y), 2) == y).all()

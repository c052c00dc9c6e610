"""The training-data operators on small fixtures: brute-force versions, exact
round trips and the defined results for nulls, empty and long texts, ties,
repeated rows, empty tables and extra columns."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ticktale.llm import (exact, language, minhash, mixing, quality, secrets, sentencepieces, substrings, suffixes,
                          tokens)
from ticktale.llm.queries import tokenizer_path

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, key string, node string, "
          "size long, block string, id string, word string")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def frame(spark, rows):
    """rows of (doc_id, text[, lang, source]) with extra columns whose names the operators use inside."""
    full = [(r + (None,) * (4 - len(r))) + (7, "k", "n", 1, "b", "i", "w") for r in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


def prose(seed, n, vocab=400):
    r = random.Random(seed)
    words = ["w" + format(i, "x") for i in range(vocab)]
    return " ".join(r.choice(words) for _ in range(n))


PASSAGE = prose(99, 60)
ROWS = [
    (0, prose(1, 120)), (1, prose(1, 120)), (2, prose(1, 120) + " tail"), (3, None), (4, ""), (5, "  \n\t "),
    (6, prose(2, 80) + " " + PASSAGE + " " + prose(3, 80)), (7, PASSAGE), (8, prose(4, 30) + "\n" + PASSAGE),
    (9, "one two"), (10, "one two"), (10, "one two"), (None, prose(1, 120)), (12, prose(5, 20000)),
    (13, "é" * 60 + " ß" * 40), (14, "x" + "é" * 60), (15, "ONE two"), (16, "same " * 200), (17, "same " * 200),
    (18, "\x00nul\x00 byte " * 10), (19, "日本語 " * 30),
]


def bytes_brute(rows, width=50):
    low = {}
    for i, t in rows:
        if i is not None:
            b = (t or "").encode()
            for p in range(len(b) - width + 1):
                w = b[p:p + width]
                low[w] = min(low.get(w, i), i)
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - width + 1) if i is not None else ():
            if low[b[p:p + width]] < i:
                gone[p:p + width] = True
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out.append((i, len(b), int(gone.sum()), spans, bytes(x for x, g in zip(b, gone) if not g)))
    return out


def key(rows):
    return sorted(rows, key=repr)


@pytest.mark.parametrize("kw", [{}, {"hot": 2}, {"block_bytes": 1000}])
def test_suffix_dedup_equals_brute_force(spark, kw):
    df = suffixes.dedup_bytes(frame(spark, ROWS), **kw)
    got = [(r["doc_id"], r["n_bytes"], r["n_removed"], len(r["spans"]), bytes(r["kept"])) for r in df.collect()]
    assert key(got) == key(bytes_brute(ROWS))


def test_suffix_array_sorts():
    r = np.random.default_rng(5)
    text = r.integers(0, 3, 3000).astype(np.uint8)
    order = suffixes.suffix_array(text, 64)
    padded = bytes(text) + b"\0" * 64
    keys = [padded[p:p + 64] for p in order]
    assert keys == sorted(keys) and sorted(order.tolist()) == list(range(3000))


def windows_brute(rows, width=13):
    low = {}
    for i, t in rows:
        ws = WORD.findall(t or "")
        for p in range(len(ws) - width + 1) if i is not None else ():
            w = tuple(ws[p:p + width])
            low[w] = min(low.get(w, i), i)
    out = []
    for i, t in rows:
        ws = WORD.findall(t or "")
        gone = set()
        for p in range(len(ws) - width + 1) if i is not None else ():
            if low[tuple(ws[p:p + width])] < i:
                gone.update(range(p, p + width))
        out.append((i, len(ws), len(gone), " ".join(w for p, w in enumerate(ws) if p not in gone).encode()))
    return out


@pytest.mark.parametrize("kw", [{}, {"block_bytes": 1000}])
def test_window_dedup_equals_brute_force(spark, kw):
    df = substrings.dedup_windows(frame(spark, ROWS), **kw)
    got = [(r["doc_id"], r["n_words"], r["n_removed"], bytes(r["kept"])) for r in df.collect()]
    assert key(got) == key(windows_brute(ROWS))


@pytest.mark.parametrize("bits", [64, 2])
def test_exact_dedup_chains_collisions(spark, bits):
    got = [tuple(r) for r in exact.exact_dedup(frame(spark, ROWS), key_bits=bits, bucket_bytes=2000).collect()]
    groups = defaultdict(list)
    for i, t in ROWS:
        groups[t or ""].append(i)
    want = []
    for i, t in ROWS:
        g = groups[t or ""]
        keep = max((x for x in g if x is not None), default=None)
        want.append((i, keep, len(g), i == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    assert key(got) == key(want)


def sets_of(t, k=5):
    w = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    w = WORD.findall(w)
    return {tuple(w[p:p + k]) for p in range(max(1, len(w) - k + 1))} if w else set()


def near_brute(rows, percent=85):
    sets = [sets_of(t) if i is not None else set() for i, t in rows]
    comp = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * len(sets[a] | sets[b]) or (
                    rows[a][0] is not None and rows[a][0] == rows[b][0]):
                old, new = comp[a], comp[b]
                comp = [new if c == old else c for c in comp]
    low = {}
    for (i, _), c in zip(rows, comp):
        if i is not None:
            low[c] = min(low.get(c, i), i)
    return [(i, len(sets_of(t)), None if i is None else low[c], i is None or i == low[c])
            for (i, t), c in zip(rows, comp)]


def chain(n, words=200):
    """Texts of which neighbours are near and ends are far: each replaces three more words."""
    ws = prose(7, words).split()
    out = []
    for i in range(n):
        out.append(" ".join(ws))
        at = (i * 29) % (words - 5)
        ws[at:at + 3] = [f"new{i}a", f"new{i}b", f"new{i}c"]
    return out


def test_near_dedup_equals_brute_force(spark):
    rows = ROWS + [(100 + i, t) for i, t in enumerate(chain(12))] + [
        (200 + i, prose(8, 150) + " " + prose(300 + i, 8)) for i in range(15)]
    got = [tuple(r) for r in minhash.near_dedup(frame(spark, rows)).collect()]
    assert key(got) == key(near_brute(rows))


def edited(words, r, times, drop=0.0):
    out = list(words)
    for _ in range(times):
        at = r.randrange(len(out))
        out[at:at + 1] = [] if r.random() < drop else [f"e{r.randrange(10**6)}"]
    return out


def test_near_dedup_of_families_around_an_unlinked_original(spark):
    """Copies of an original with few and many edits, families of copies of a far
    variant, cut ends and dropped words: links that avoid the original count too."""
    r = random.Random(5)
    base = prose(9, 180).split()
    texts = [edited(base, r, r.randint(1, 14)) for _ in range(50)]
    for n in (4, 7, 10):
        variant = edited(base, r, n)
        texts += [edited(variant, r, r.randint(0, 4)) for _ in range(12)]
    texts += [base[:n] for n in range(110, 181, 5)] + [base[n:] for n in range(5, 60, 7)]
    texts += [edited(base, r, r.randint(2, 8), drop=0.8) for _ in range(15)]
    r.shuffle(texts)
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    got = [tuple(x) for x in minhash.near_dedup(frame(spark, rows)).collect()]
    assert key(got) == key(near_brute(rows))


def test_components_of_paths_and_stars(spark):
    edges = [(f"{i:03}", f"{i + 1:03}") for i in range(0, 40)] + [("100", f"{i}") for i in range(101, 130)]
    e = spark.createDataFrame([(a.encode(), b.encode()) for a, b in edges], "a binary, b binary")
    got = {bytes(r["node"]).decode(): bytes(r["comp"]).decode() for r in minhash.components(e).collect()}
    assert {v for k, v in got.items() if k < "050"} == {"000"} and len(got) == 71
    assert {v for k, v in got.items() if k >= "100"} == {"100"}


def test_mixing_targets_and_epochs(spark):
    r = random.Random(3)
    rows = [(i, prose(i, r.randint(0, 40)), None, r.choice(["a", "b", "c", None, "é", ""])) for i in range(400)]
    rows += [(1000, None, None, "only null"), (5, "twice here", None, "a"), (5, "twice here", None, "a")]
    docs = frame(spark, rows)
    got = mixing.mix(docs, rows_per_range=16).collect()
    size = Counter()
    for _, t, _, s in rows:
        size[s] += len(WORD.findall(t or ""))
    order = sorted((s for s in size if s is not None)) + [None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    target, left, free = {}, 1.5 * sum(size.values()), set(order)
    while free:                                  # share, cut at the bound, share the excess again
        level = left / sum(weight[s] for s in free)
        over = [s for s in free if level * weight[s] > 2 * size[s]]
        if not over:
            target.update((s, level * weight[s]) for s in free)
            break
        for s in over:
            target[s] = 2.0 * size[s]
            left -= target[s]
            free.remove(s)
    taken = Counter()
    for x in got:
        assert x["source_size"] == size[x["source"]] and math.isclose(x["target"], target[x["source"]], abs_tol=1e-6)
        assert x["taken"] in (0, x["size"], 2 * x["size"])
        taken[x["source"]] += x["taken"]
    assert len(got) == len(rows) and all(abs(taken[s] - target[s]) <= 20 for s in order)
    again = mixing.mix(docs.repartition(5), rows_per_range=64).collect()
    assert key([tuple(x) for x in got]) == key([tuple(x) for x in again])


def test_mixing_prefers_quality(spark):
    rows = [(i, "plain words here now " * 3, None, "a") for i in range(200)]
    rows += [(1000 + i, "#### $$$$ %%%% &&&& " * 3, None, "a") for i in range(200)]
    rows += [(5000, "word " * 3000, None, "b")]
    got = mixing.mix(frame(spark, rows), share=0.6).where("source = 'a' and taken > 0").collect()
    good = sum(r["doc_id"] < 1000 for r in got)
    assert good > 2 * (len(got) - good) > 0


def test_quality_measures(spark):
    t = "the a b c\nthe a b c\n#x | $y\n\n  \nZ"
    got = {r["doc_id"]: r for r in quality.quality(frame(spark, [(1, t), (2, None), (3, ""), (4, "w " * 30000)])).collect()}
    r = got[1]
    assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (12, 18, 3, 1, 8)
    assert got[2]["n_words"] == got[3]["n_words"] == 0 and not got[2]["kept"] and not got[3]["kept"]
    assert got[4]["n_repeat_words"] == 30000 and not got[4]["kept"]


def letters(r, n):
    """Words of letters with a third of function words, few windows twice."""
    return " ".join(r.choice(("the", "of", "and", *("".join(r.choice("bcdfglmnprst") + r.choice("aeiou")
                                                  for _ in range(r.randint(2, 4))) for _ in range(6)))) for _ in range(n))


def test_keep_good_keeps_columns(spark):
    text = letters(random.Random(2), 150)
    docs = frame(spark, [(1, text), (2, "too short"), (3, None)])
    out = quality.keep_good(docs)
    assert out.columns == docs.columns and [r["doc_id"] for r in out.collect()] == [1]


BASE = [("assign", re.compile(r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"),
         lambda m: len(m[2]) >= 6),
        ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
        ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 24)]


def test_secret_spans(spark):
    r = random.Random(4)
    rnd = ["".join(r.choice("ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz23456789") for _ in range(32)) for _ in range(80)]
    texts = [f"Token='{x}' and some_ordinary_identifier_name plus more_of_the_ordinary_identifiers" for x in rnd[:60]]
    texts += [f"plain words {rnd[70]} after", "password=token:abcdef", 'API_KEY" : "abc"', "secret: x", None, "",
              "AKIA" + "Q7" * 9 + " AKIAQ", "é" * 3 + " " + "0f" * 14 + " 0f0f", "an_ordinary_identifier_name_of_the_list"]
    rows = list(enumerate(texts))
    docs = frame(spark, rows)
    ratios = secrets.train(docs.where("doc_id < 60"))       # on so few rows a text would teach its own pairs
    got = {x["doc_id"]: x for x in secrets.scan(docs, ratios=ratios).collect()}
    for i, t in rows:
        want = sorted((m.start(), no, m.end(), kind) for no, (kind, p, ok) in enumerate(BASE)
                      for m in p.finditer(t or "") if ok(m))
        assert [tuple(s) for s in got[i]["base"]] == want, t
    assert [(s["start"], s["end"]) for s in got[60]["added"]] == [(12, 44)]
    assert not got[68]["added"] and not got[0]["added"]
    long = secrets.scan(frame(spark, [(1, "passwd = " + "aB3x" * 5000 + " token: abcdefg")])).collect()[0]
    assert [(x["start"], x["end"]) for x in long["base"]] == [(0, 20009), (20010, 20024)]
    none = secrets.scan(frame(spark, [(1, "just words"), (2, None)])).collect()
    assert all(not x["added"] and not x["base"] for x in none)


def test_language_held_out(spark):
    r = random.Random(6)
    parts = {"en": ["th", "ing", "er", "and", "ou"], "de": ["sch", "ein", "ung", "ich", "ß"], "fr": ["eau", "eux", "que", "ê", "ll"]}
    rows = [(i, " ".join("".join(r.choice(parts[x]) for _ in range(r.randint(1, 4))) for _ in range(40)), x)
            for i, x in enumerate(r.choice(sorted(parts)) for _ in range(240))]
    rows += [(1000, None, "en"), (1001, "123 !!", "de"), (1002, "", None), (None, "thing", "en")]
    docs = frame(spark, rows)
    got = language.language_id(docs, F.col("doc_id") % 4 != 2, [F.col("doc_id")]).collect()
    by = {x["doc_id"]: x for x in got}
    held = [x for x in rows[:240] if x[0] % 4 == 2]
    assert sum(by[i]["lang_pred"] == lang for i, _, lang in held) >= 0.95 * len(held)
    assert {by[i]["lang_pred"] for i in (1000, 1001, 1002)} == {"und"}
    assert all(0 <= x["score"] <= 1 for x in got) and len(got) == len(rows)
    blind = language.language_id(docs, F.lit(False), [F.col("doc_id")]).collect()
    assert {x["lang_pred"] for x in blind} == {"und"}


ODD = ["", None, "  x \n\n y\t\tz  ", "日本語 テスト 123 ", "a՘b", "don't  we'll ''", "\x1c \x85 \xa0 a　b",
       "😀 😀ok", "a" * 5000, "\n \n", "<|endoftext|>a b<|endoftext|>", "a ", " a", "Straße İstanbul"]


def test_token_counts_equal_the_library(spark):
    from tokenizers import Tokenizer
    path = tokenizer_path("byte_bpe_50k.json")
    rows = [(i, t) for i, t in enumerate(ODD + [t for _, t in ROWS])]
    got = {r["doc_id"]: r for r in tokens.token_counts(frame(spark, rows), path).collect()}
    lib = Tokenizer.from_file(path)
    for i, t in rows:
        n = len(lib.encode(t or "", add_special_tokens=False).ids)
        assert (got[i]["n_tokens"], got[i]["n_bytes"], got[i]["over_limit"]) == (n, len((t or "").encode()), n > 512)


def test_sentencepiece_equals_the_library(spark):
    import sentencepiece as sp
    path = tokenizer_path("piece_bpe_32k.model")
    rows = [(i, t) for i, t in enumerate(ODD + [t for _, t in ROWS] + ["▁▁ a▁b  "])]
    lib = sp.SentencePieceProcessor(model_file=path)
    for r in sentencepieces.encode(frame(spark, rows), path).collect():
        t = rows[r["doc_id"]][1] or ""
        assert r["ids"] == lib.encode(t)
        assert r["decoded"] == lib.decode(r["ids"]) and r["round_trip"] == ("▁" not in t)


def test_unigram_viterbi_equals_brute_force():
    r = random.Random(9)
    pieces = {p: (i, -r.random() * 5) for i, p in enumerate(["▁", "a", "b", "ab", "ba", "aba", "▁a", "▁ab", "bb"])}
    enc = sentencepieces.Encoder(sentencepieces.Model(pieces, (), 99, False, True))

    def best(w):
        if not w:
            return 0.0, ()
        return max(((best(w[n:])[0] + pieces[w[:n]][1], (pieces[w[:n]][0],) + best(w[n:])[1])
                    for n in range(1, len(w) + 1) if w[:n] in pieces), key=lambda x: x[0])
    words = sorted({"▁" + "".join(r.choice("ab") for _ in range(r.randint(0, 9))) for _ in range(80)})
    assert enc.encode_sorted(words) == [best(w)[1] for w in words]


def test_empty_tables(spark):
    docs = frame(spark, [(1, "x")]).where("doc_id < 0")
    path = tokenizer_path("piece_bpe_32k.model")
    outs = [suffixes.dedup_bytes(docs), substrings.dedup_windows(docs), exact.exact_dedup(docs), minhash.near_dedup(docs),
            mixing.mix(docs), quality.quality(docs), secrets.scan(docs), sentencepieces.encode(docs, path),
            language.language_id(docs, F.lit(True), [F.col("doc_id")]),
            tokens.token_counts(docs, tokenizer_path("byte_bpe_50k.json"))]
    assert all(o.count() == 0 for o in outs)


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline as P
    r = random.Random(12)
    text = [letters(r, 150) for _ in range(30)]
    rows = [(i, t) for i, t in enumerate(text)] + [(100, text[3]), (101, text[4] + " end"), (102, None), (103, "short")]
    docs = frame(spark, [(i, t, "en", f"s{(i or 0) % 3}") for i, t in rows])
    for name, stage in P.STAGES[:3]:
        docs = stage(spark, docs, "")
        assert docs.columns == list(P.COLUMNS), name
        docs = docs.checkpoint()
    assert sorted(r["doc_id"] for r in docs.collect()) == sorted(set(range(30)) - {3} | {100})
    mixed = P.STAGES[3][1](spark, docs, "").checkpoint()
    assert mixed.columns == list(P.COLUMNS) and mixed.count() > 0
    out = P.STAGES[4][1](spark, mixed, "").collect()
    assert len(out) == mixed.count() and all(r["round_trip"] and r["n_pieces"] == len(r["ids"]) for r in out)


def test_pipeline_near_copies_from_080(spark):
    import corpus_pipeline as P
    words = letters(random.Random(21), 104).split()
    text = " ".join(words)
    near = " ".join("zz" if i in (30, 60) else w for i, w in enumerate(words))
    far = " ".join("zz" if i in (20, 50, 80) else w for i, w in enumerate(letters(random.Random(22), 104).split()))
    rows = [(1, text), (2, near), (3, letters(random.Random(22), 104)), (4, far)]
    a, b, c, d = (sets_of(t) for _, t in rows)
    assert 0.80 <= len(a & b) / len(a | b) < 0.85 and len(c & d) / len(c | d) < 0.80
    got = P.near_copies(spark, frame(spark, rows), "").collect()
    assert sorted(r["doc_id"] for r in got) == [1, 3, 4]


def test_pipeline_null_and_repeated_ids(spark):
    import corpus_pipeline as P
    r = random.Random(23)
    a, b, c, d, e, f, g = (letters(r, 120) for _ in range(7))
    rows = [(None, a), (5, a), (None, b), (7, c), (9, c), (7, d), (7, d), (None, e), (None, e), (None, b + " end"),
            (3, f), (7, f + " end"), (11, None), (11, ""), (None, g), (7, g + " end")]
    full = [(i, t, "en", "s") for i, t in rows]
    exact_rows = P.exact_copies(spark, frame(spark, full), "").checkpoint()
    want = [(5, a), (None, b), (9, c), (7, d), (None, e), (None, b + " end"), (3, f), (7, f + " end"), (11, ""),
            (None, g), (7, g + " end")]
    got = [(x["doc_id"], x["text"] or "") for x in exact_rows.collect()]
    assert key(got) == key(want)
    near = P.near_copies(spark, exact_rows, "").checkpoint()
    got = [(x["doc_id"], x["text"] or "") for x in near.collect()]
    assert len(got) == 8 and {(5, a), (9, c), (7, d), (None, e), (3, f), (11, ""), (7, g + " end")} <= set(got)
    assert len({(None, b), (None, b + " end")} & set(got)) == 1
    many = [(i, letters(r, 60), "en", "s") for i in (None, None, None, None, None, None, 4, 4, 4, 4)]
    docs = frame(spark, many).checkpoint()
    taken = Counter((x["doc_id"], x["text"]) for x in P.mix_sources(spark, docs, "").collect())
    plan = mixing.mix(docs)
    assert set(taken) <= {(i, t) for i, t, *_ in many} and max(taken.values()) <= 2
    assert sum(taken.values()) == plan.agg(F.sum("copies")).collect()[0][0] == 15


def test_language_keeps_rare_words(spark):
    r = random.Random(24)
    words = ["".join(r.choice("abcdefghijklmnop") for _ in range(7)) for _ in range(2 * 21_000)]
    rare = {"aa": words[:500], "bb": words[500:1000]}
    common = {"aa": words[1000:21_500], "bb": words[21_500:]}
    rows = []
    for x in rare:
        rows += [(None, " ".join(common[x]), x)] * 2 + [(None, " ".join(rare[x]), x)]
        rows += [(len(rows) + i, " ".join(rare[x][3 * i:3 * i + 3]), x) for i in range(60)]
    docs = frame(spark, rows)
    got = {x["doc_id"]: x["lang_pred"] for x in language.language_id(
        docs, F.col("doc_id").isNull(), [F.col("doc_id")]).collect()}
    assert all(got[i] == x for i, _, x in rows if i is not None)


@pytest.mark.parametrize("common", [0, 5, 50_000])
def test_language_blocks_equal_brute_force(spark, monkeypatch, common):
    monkeypatch.setattr(language, "COMMON", common)
    r = random.Random(25)
    rows = [(i, " ".join("".join(r.choice("abcdeé" if i % 2 else "cdefgß") for _ in range(r.randint(1, 5))) for _ in range(30)),
             ("de", "en", None)[i % 3]) for i in range(60)] + [(60, None, "en")]
    learned = [x for x in rows if x[0] % 4 != 2 and x[2]]
    cnt = defaultdict(Counter)
    for _, t, x in learned:
        for w in language.words_of(t or ""):
            cnt[x, 0][w] += 1
            for n in range(1, 6):
                cnt[x, n].update(language.grams(w, n))
    total = {k: sum(c.values()) for k, c in cnt.items()}
    floor = [-math.log(2.0 * max(total["de", n], total["en", n]) + 1) for n in range(6)]

    def row(u, n):
        if any(cnt[x, n][u] for x in ("de", "en")):
            return [math.log(cnt[x, n][u] / total[x, n]) if cnt[x, n][u] else floor[n] for x in ("de", "en")]
        if n == 0:
            m = min(5, len(u) + 2) if len(u) > 1 else 1
            return np.mean([row(g, m) for g in language.grams(u, m)], axis=0)
        return [floor[1]] * 2 if n == 1 else np.mean([row(u[:-1], n - 1), row(u[1:], n - 1)], axis=0)

    monkeypatch.setattr(language, "BLOCK", 200)
    monkeypatch.setattr(language, "WORDS", 7)
    out = language.language_id(frame(spark, rows), F.col("doc_id") % 4 != 2, [F.col("doc_id")]).collect()
    assert len(out) == len(rows)
    for x in out:
        ws = language.words_of(rows[x["doc_id"]][1] or "")
        if not ws:
            assert (x["lang_pred"], x["score"]) == ("und", 0.0)
            continue
        sums = np.sum([row(w, 0) for w in ws], axis=0)
        assert x["lang_pred"] == ("de", "en")[int(np.argmax(sums))]
        assert abs(x["score"] - 1 / np.exp((sums - sums.max()) / len(ws)).sum()) < 1e-9


def test_near_dedup_of_many_repeated_rows(spark):
    """Two linked texts, each repeated with its id a thousand times."""
    near = PASSAGE + " " + prose(50, 60)
    rows = [(1, near)] * 1000 + [(2, near + " tail")] * 1000
    got = minhash.near_dedup(frame(spark, rows)).groupBy("doc_id", "component_id", "kept").count().collect()
    assert sorted(tuple(r) for r in got) == [(1, 1, True, 1000), (2, 1, False, 1000)]


def test_secrets_in_a_text_of_many_matches(spark):
    n = 200_000
    got = secrets.scan(frame(spark, [(1, "token=abc123 é " * n)]), ratios=[0.0] * len(secrets.ALPHABET) ** 2).select(
        F.size("base").alias("n"), F.col("base")[n - 1].alias("last"), F.col("base")[777].alias("one")).collect()[0]
    assert got["n"] == n
    assert (got["last"]["start"], got["last"]["end"]) == (15 * (n - 1), 15 * (n - 1) + 12)
    assert (got["one"]["start"], got["one"]["end"]) == (15 * 777, 15 * 777 + 12)


def test_short_random_keys(spark):
    r = random.Random(8)
    rnd = ["".join(r.choice("ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz23456789") for _ in range(32)) for _ in range(80)]
    texts = [f"Token='{x}' and some_ordinary_identifier_name plus more_of_the_ordinary_identifiers" for x in rnd]
    ratios = secrets.train(frame(spark, list(enumerate(texts))))
    tests = ["x xK7qZ9vT3mW8pR2j y", "x ordinary_name y", "x mention_of_more y", "x zQ9xK7wJ4v y"]
    got = {x["doc_id"]: x["added"] for x in secrets.scan(frame(spark, list(enumerate(tests))), ratios=ratios).collect()}
    assert [(s["start"], s["end"]) for s in got[0]] == [(2, 18)] and not (got[1] or got[2] or got[3])


def test_mixing_ranges_stay_even(spark):
    """Nine tenths of a source are junk of the least weight and many ids are null."""
    rows = [(None if i % 3 == 0 else i, f"# {i} $", None, "a") for i in range(3600)]
    rows += [(10_000 + i, f"plain words {i}", None, "a") for i in range(400)]
    sized = mixing.mix(frame(spark, rows), rows_per_range=16)
    assert sized.count() == 4000
    taken = sized.agg(F.sum("taken"), F.max("target")).collect()[0]
    assert abs(taken[0] - taken[1]) <= 20
    plan = frame(spark, rows).select(F.lit(0).alias("ord"), F.lit(None).cast("string").alias("_s")).limit(1)
    keys = spark.range(4000).select(F.lit(None).cast("string").alias("source"), F.floor(
        F.log2(-F.log(F.pmod(F.xxhash64("id"), F.lit(10 ** 6)) / 1e6 + 1e-9) / 0.1) * mixing.STEPS).alias("step"))
    steps = mixing._steps(keys, plan, 16).collect()
    counts = {r["step"]: r["count"] for r in keys.groupBy("step").count().collect()}
    assert all(counts[r["step"]] <= 16 * r["ranges"] for r in steps) and len(steps) == len(counts)
    assert max(counts.values()) < 200

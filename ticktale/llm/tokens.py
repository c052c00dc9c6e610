"""Token counts of a byte-level BPE tokenizer, without materialising ids.

BPE never merges across pre-tokens, so a document's count is the sum over its
distinct pre-tokens of frequency times pieces. Inside each task the Arrow
batches are cut into slices of bounded size; a slice's distinct pre-tokens are
counted in pieces once (and kept in a bounded table of the worker), joined to
the per-document frequencies and summed. Nothing is shuffled: a global
(document, pre-token) table would be larger than the texts themselves.

Defined results: null or empty text has 0 tokens; special strings inside a
text count as one token each, as the library does by default; a text with
characters outside the checked range is cut by the library's own pre-tokenizer;
repeated rows are counted one by one; other columns are not read.
"""

from __future__ import annotations

import json
import os
import re
from collections import Counter

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticktale.llm.common import text_of

#: Fixed value: the public split pattern of this family of tokenizers.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The same for texts of ASCII characters, where the plainer classes match faster.
ASCII_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+"
CHECKED = 0x3000            # code points below this are compared with the library's classes
SLICE_BYTES = 8 << 20
TABLE_SIZE = 400_000


def tokenizer_json(path: str) -> str:
    """The tokenizer file's text, read once on the driver."""
    with open(path, encoding="utf-8") as f:
        return f.read()


class PieceCounter:
    """Per-worker counter built from a tokenizer's JSON."""

    def __init__(self, text: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_str(text)
        spec = json.loads(text)
        added = [t for t in spec.get("added_tokens", [])]
        pre = spec.get("pre_tokenizer") or {}
        plain = not spec.get("normalizer") and not any(t.get(k) for t in added for k in ("lstrip", "rstrip", "single_word"))
        #: without this shape the library does the cutting and counting of whole texts
        self.split = plain and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")
        names = sorted((t["content"] for t in added), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, names))) if names else None
        self.pattern = regex.compile(PATTERN)
        self.ascii = re.compile(ASCII_PATTERN, re.ASCII)
        self.table: dict[str, int] = {}
        odd = [c for c in range(CHECKED) if self._odd(chr(c))] if self.split else []
        self.odd = regex.compile("[" + "".join(regex.escape(chr(c)) for c in odd) + f"{chr(CHECKED)}-\U0010ffff]")

    def _odd(self, c: str) -> bool:
        """Does the library class this character otherwise than the pattern?"""
        return any(len(self.tok.pre_tokenizer.pre_tokenize_str(x)) != len(self.pattern.findall(x))
                   for x in (f"a{c}", f"1{c}", f"!{c}", f"{c} a"))

    def _cut(self, text: str) -> list[str]:
        if text.isascii():
            return self.ascii.findall(text)
        if not self.odd.search(text):
            return self.pattern.findall(text)
        return [text[a:b] for _, (a, b) in self.tok.pre_tokenizer.pre_tokenize_str(text)]

    def frequencies(self, text: str) -> tuple[int, Counter]:
        """Number of special strings, and the pre-token frequencies of the rest."""
        if self.special is None or not self.special.search(text):
            return 0, Counter(self._cut(text))
        freq, n, at = Counter(), 0, 0
        for m in self.special.finditer(text):
            freq.update(self._cut(text[at:m.start()]))
            n, at = n + 1, m.end()
        freq.update(self._cut(text[at:]))
        return n, freq

    def count(self, texts: list[str]) -> list[int]:
        if not self.split:
            return [len(e.ids) for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]
        per_doc = [self.frequencies(t) for t in texts]
        table = self.table
        if len(table) > TABLE_SIZE:
            table.clear()
        new = list({p for _, f in per_doc for p in f if p not in table})
        for p, e in zip(new, self.tok.encode_batch_fast(new, add_special_tokens=False)):
            table[p] = len(e.ids)
        return [n + sum(k * table[p] for p, k in f.items()) for n, f in per_doc]


_COUNTERS: dict[int, PieceCounter] = {}


def token_counts(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 512) -> DataFrame:
    """``id_col, n_bytes, n_tokens, over_limit`` for every row."""
    spec = docs.sparkSession.sparkContext.broadcast(tokenizer_json(tokenizer_path))   # one file, 2 to 10 MB

    def run(batches):
        key = hash(spec.value)
        counter = _COUNTERS.get(key) or _COUNTERS.setdefault(key, PieceCounter(spec.value))
        for b in batches:
            for ids, texts in slices(b):
                yield pa.RecordBatch.from_arrays([ids, pa.array(counter.count(texts), pa.int64())],
                                                 names=["id", "n_tokens"])

    # the byte length is cheap SQL: carry it beside the text
    rows = docs.select(F.struct(F.col(id_col).cast("long").alias("id"),
                                F.octet_length(text_of(text_col)).cast("long").alias("n_bytes")).alias("id"),
                       text_of(text_col).alias("text"))
    out = rows.mapInArrow(run, "id struct<id:long,n_bytes:long>, n_tokens long")
    return out.select(F.col("id.id").alias(id_col), F.col("id.n_bytes").alias("n_bytes"), "n_tokens",
                      (F.col("n_tokens") > limit).alias("over_limit"))


def slices(b: pa.RecordBatch, limit: int = SLICE_BYTES):
    """(first column, texts of the second) in pieces of about ``limit``
    characters, so that a batch of very long texts needs no more memory than
    one of short ones."""
    col, at = b.column(1), 0
    while at < b.num_rows:
        size, end, texts = 0, at, []
        while end < b.num_rows and (size < limit or end == at):
            t = col[end].as_py()
            texts.append(t)
            size, end = size + len(t), end + 1
        yield b.column(0).slice(at, end - at), texts
        at = end

"""SentencePiece encoding and decoding by a shared-prefix Viterbi.

A text is marked (spaces become the mark U+2581, one is put in front) and cut
before each run of marks; no piece crosses such a cut, so marked words are
encoded on their own. The distinct marked words of a slice of documents are
sorted, which is a depth-first walk of their trie: the forward states of the
common prefix with the word before stay on the stack and only the rest of
the word is scored.

Forward state of a prefix: for a unigram model the best score and its last
piece. For a BPE model the scores are merge ranks, not additive; there the
state is the last piece of the prefix's own encoding, and a piece may follow
only if merging the two pieces' text gives just these two again (each prefix
has exactly one such last piece). Both give the library's pieces.

Runs in the tasks on Arrow batches, no shuffle. Characters without a piece
become byte pieces. Defined results: null and empty text have no piece and
decode to the empty text; texts that hold the mark itself decode to spaces in
its place (``round_trip`` false); repeated rows are encoded one by one; other
columns are carried along or ignored, never read.
"""

from __future__ import annotations

import hashlib
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticktale.llm.common import text_of, worker_cache
from ticktale.llm.tokens import slices

MARK = "▁"
WORDS = regex.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
KNOWN_WORDS = 600_000           # a worker forgets all words beyond so many
KNOWN_PIECES = 16_000_000       # or beyond so many pieces
KNOWN_PAIRS = 1_000_000         # and pairs of neighbouring pieces beyond so many


class Model(NamedTuple):
    """What encoding needs of a model file; about 1 MB, whatever the input."""
    pieces: dict[str, tuple[int, float]]     # ordinary pieces: id, score
    bytes_: tuple[int, ...]                  # id of each byte piece, empty without byte fallback
    unknown: int
    bpe: bool
    dummy_prefix: bool


def load_model(path: str) -> Model:
    """Read a .model file with identity normalisation (driver side)."""
    import sentencepiece as sp
    from sentencepiece import sentencepiece_model_pb2 as pb
    s = sp.SentencePieceProcessor(model_file=path)
    proto = pb.ModelProto()
    with open(path, "rb") as f:
        proto.ParseFromString(f.read())
    norm = proto.normalizer_spec
    if norm.precompiled_charsmap or norm.remove_extra_whitespaces or proto.trainer_spec.treat_whitespace_as_suffix:
        raise ValueError("only models without text normalisation are supported")
    n = s.get_piece_size()
    odd = {i for i in range(n) if s.is_control(i) or s.is_unknown(i) or s.is_byte(i) or s.is_unused(i)}
    pieces = {s.id_to_piece(i): (i, s.get_score(i)) for i in range(n) if i not in odd}
    if any(MARK in p.lstrip(MARK) for p in pieces):
        raise ValueError("a piece crosses a word boundary")
    bytes_ = tuple(s.piece_to_id(f"<0x{b:02X}>") for b in range(256)) if proto.trainer_spec.byte_fallback else ()
    return Model(pieces, bytes_, s.unk_id(), proto.trainer_spec.model_type == 2, bool(norm.add_dummy_prefix))


def lengths_by_ending(pieces) -> dict[str, tuple[int, ...]]:
    """Lengths of the pieces that end like a prefix, longest first, by its last
    three characters (or all of a shorter one); 1 is always among them."""
    found: dict[str, set[int]] = {}
    for p in pieces:
        if len(p) > 1:
            found.setdefault(p[-3:], set()).add(len(p))
    for end, lengths in found.items():
        lengths.add(1)
        if len(end) == 3 and end[1:] in pieces:
            lengths.add(2)
    return {end: tuple(sorted(v, reverse=True)) for end, v in found.items()}


class Encoder:
    def __init__(self, model: Model):
        self.m = model
        self.longest = max(map(len, model.pieces), default=1)
        self.known = Known()
        self.pairs: dict[tuple[str, str], bool] = {}
        # pieces that merging their own characters gives back
        self.standing = {p for p in model.pieces if len(p) == 1 or len(self.merge(p)) == 1} if model.bpe else set()
        self.one: dict[str, tuple[int, ...]] = {}
        self.lengths = lengths_by_ending(self.standing)
        self.low = min((s for _, s in model.pieces.values()), default=0.0) - 10.0    # score of an unknown character

    # -- BPE: what follows what ---------------------------------------------
    def merge(self, text: str) -> list[str]:
        """Plain merging of a short text: the best-scored adjacent pair first,
        the leftmost of equals."""
        parts, pieces = list(text), self.m.pieces
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                p = pieces.get(parts[i] + parts[i + 1])
                if p is not None and (best is None or p[1] > best):
                    best, at = p[1], i
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def follows(self, a: str, b: str) -> bool:
        ok = self.pairs.get((a, b))
        if ok is None:
            if len(self.pairs) > KNOWN_PAIRS:
                self.pairs.clear()
            ok = self.pairs[(a, b)] = self.merge(a + b) == [a, b]
        return ok

    # -- forward states --------------------------------------------------------
    def last_piece(self, word: str, k: int, last: list[int]) -> int:
        """BPE: length of the last piece of word[:k] from those of the shorter
        prefixes. Only lengths of pieces with the same ending are tried."""
        lengths, known, standing = self.lengths, self.pairs, self.standing
        for n in lengths.get(word[k - 3:k] if k > 2 else word[:k]) or lengths.get(word[k - 2:k], (1,)):
            if n > k:
                continue
            p = word[k - n:k]
            if n > 1 and p not in standing:
                continue
            if n == k:
                return n
            q = word[k - n - last[k - n]:k - n]
            ok = known.get((q, p))
            if self.follows(q, p) if ok is None else ok:
                return n
        raise AssertionError("a prefix has no encoding")

    def best_piece(self, word: str, k: int, states: list[tuple[int, float]]) -> tuple[int, float]:
        """Unigram: length of the best last piece of word[:k] and its score."""
        pieces = self.m.pieces
        best = (1, states[k - 1][1] + self.low)
        for n in range(1, min(self.longest, k) + 1):
            p = pieces.get(word[k - n:k])
            if p is not None and states[k - n][1] + p[1] > best[1]:
                best = (n, states[k - n][1] + p[1])
        return best

    def ids(self, piece: str) -> tuple[int, ...]:
        got = self.one.get(piece)
        if got is None:
            p = self.m.pieces.get(piece)
            got = (p[0],) if p is not None else tuple(self.m.bytes_[b] for b in piece.encode()) if self.m.bytes_ else (self.m.unknown,)
            if p is not None or len(self.one) < KNOWN_PAIRS:
                self.one[piece] = got
        return got

    def encode_sorted(self, words: list[str]) -> list[tuple[int, ...]]:
        """Pieces of distinct sorted words: depth-first over their trie."""
        out, last, scores, before, one = [], [0], [(0, 0.0)], "", self.one
        bpe, last_piece = self.m.bpe, self.last_piece
        for w in words:
            shared, most = 0, min(len(w), len(before))
            while shared < most and w[shared] == before[shared]:
                shared += 1
            del last[shared + 1:]
            for k in range(shared + 1, len(w) + 1):
                if bpe:
                    last.append(last_piece(w, k, last))
                else:
                    del scores[k:]
                    scores.append(self.best_piece(w, k, scores))
                    last.append(scores[k][0])
            parts, k = [], len(w)
            while k:
                p = w[k - last[k]:k]
                parts.append(one.get(p) or self.ids(p))
                k -= last[k]
            parts.reverse()
            out.append(tuple(chain.from_iterable(parts)))
            before = w
        return out

    def marked(self, text: str) -> list[str]:
        """Marked words. With a mark in front of the text every word starts with
        one, which is then left out here and put back in ``add``."""
        if not text:
            return []
        if not self.m.dummy_prefix:
            return WORDS.findall(text.replace(" ", MARK))
        if "  " not in text and text[0] != " " and MARK not in text:
            return text.split(" ")
        return [w[1:] for w in WORDS.findall(MARK + text.replace(" ", MARK))]

    def add(self, words: set[str]) -> None:
        """Encode the words not known yet, as one sorted list."""
        front = MARK if self.m.dummy_prefix else ""
        new = sorted(words.difference(self.known.number))
        self.known.append(new, self.encode_sorted([front + w for w in new]))

    def numbers(self, texts: list[str]) -> list[np.ndarray]:
        """Each text as row numbers of ``known``."""
        if self.known.full():
            self.known = Known()
        per_doc = [self.marked(t) for t in texts]
        self.add(set(chain.from_iterable(per_doc)))
        at = self.known.number.__getitem__
        return [np.fromiter(map(at, ws), np.int64, len(ws)) for ws in per_doc]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.known.gather(self.numbers(texts)).to_pylist()


class Known:
    """Words of a worker with their piece ids, in flat arrays."""

    def __init__(self):
        self.number: dict[str, int] = {}
        self.flat = np.zeros(1 << 16, np.int32)
        self.start = np.zeros(1, np.int64)          # one more than words

    def full(self) -> bool:
        return len(self.number) > KNOWN_WORDS or self.start[-1] > KNOWN_PIECES

    def append(self, words: list[str], pieces: list[tuple[int, ...]]) -> None:
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        used, more = int(self.start[-1]), int(sizes.sum())
        if used + more > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(max(more, len(self.flat)), np.int32)])
        self.flat[used:used + more] = np.fromiter(chain.from_iterable(pieces), np.int32, more)
        self.start = np.concatenate([self.start, used + np.cumsum(sizes)])
        n = len(self.number)
        self.number.update(zip(words, range(n, n + len(words))))

    def gather(self, docs: list[np.ndarray]) -> pa.Array:
        """List array of each document's ids from its row numbers."""
        words = np.concatenate([np.zeros(0, np.int64), *docs])
        n = self.start[words + 1] - self.start[words]
        ends = np.cumsum(n)
        take = np.arange(int(n.sum())) + np.repeat(self.start[words] - (ends - n), n)
        doc_ends = np.cumsum([0] + [len(d) for d in docs])
        bounds = np.concatenate([[0], ends])[doc_ends].astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(self.flat[take], pa.int32()))


class Decoder:
    def __init__(self, model: Model):
        self.m = model
        self.text = {model.unknown: " \u2047 ".encode()}
        self.text.update({i: p.replace(MARK, " ").encode() for p, (i, _) in model.pieces.items()})
        self.text.update({i: bytes([b]) for b, i in enumerate(model.bytes_)})

    def decode(self, ids) -> str:
        """The text of piece ids; the unknown id gives the library's sign for it."""
        out = b"".join(map(self.text.__getitem__, ids))
        if self.m.dummy_prefix and out[:1] == b" ":
            out = out[1:]
        return out.decode("utf-8", "replace")


def encode(docs: DataFrame, model_path: str, id_cols: tuple[str, ...] = ("doc_id",),
           text_col: str = "text") -> DataFrame:
    """``id_cols`` (any columns to carry), ``ids`` (array of int), ``decoded``
    (the text the ids give back) and ``round_trip``."""
    shared = docs.sparkSession.sparkContext.broadcast(load_model(model_path))
    with open(model_path, "rb") as f:
        key = f"pieces {hashlib.sha256(f.read()).hexdigest()}"

    def run(batches):
        enc, dec = worker_cache(key, lambda: (Encoder(shared.value), Decoder(shared.value)))
        for b in batches:
            for carried, texts in slices(b, 2 << 20):
                numbers = enc.numbers(texts)
                ids = enc.known.gather(numbers)
                flat, ends = ids.values.to_numpy().tolist(), ids.offsets.to_pylist()
                back = [dec.decode(flat[a:b]) for a, b in zip(ends, ends[1:])]
                yield pa.RecordBatch.from_arrays(
                    [carried, ids, pa.array(back, pa.string()),
                     pa.array([a == t for a, t in zip(back, texts)], pa.bool_())],
                    names=["carried", "ids", "decoded", "round_trip"])

    rows = docs.select(F.struct(*[F.col(c) for c in id_cols]).alias("carried"), text_of(text_col).alias("text"))
    kind = rows.schema["carried"].dataType.simpleString()
    out = rows.mapInArrow(run, f"carried {kind}, ids array<int>, decoded string, round_trip boolean")
    return out.select(*[F.col("carried").getField(c).alias(c) for c in id_cols], "ids", "decoded", "round_trip")


def digest(df: DataFrame) -> DataFrame:
    """Replace ``ids`` and ``decoded`` by the number of pieces and digests."""
    return df.select(*[c for c in df.columns if c not in ("ids", "decoded", "round_trip")],
                     F.size("ids").cast("long").alias("n_pieces"),
                     F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
                     F.sha2("decoded", 256).alias("decoded_sha256"), "round_trip")


def ids_sha256(ids: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()

"""Byte-level BPE encoding and decoding with tree concatenation of unsplit text.

Text that the tokenizer's pattern splits into short pieces is encoded piece by piece.
A piece longer than ``LEAF`` bytes is halved down to leaves, all leaves are
encoded side by side, and neighbours are joined level by level: the tokens in a
window around a join are encoded again, and the window grows until its first token
is the left side's and its last token the right side's. Tokens are an encoding
exactly if every two neighbours are, so such a join is the encoding of both.
"""

from __future__ import annotations

import hashlib
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructType
from tokenizers import Tokenizer

from .common import once_per_worker, small_slices, table, text_buffer
from .tokenfst import byte_alphabet, char_classes, piece_starts

LEAF = 512
WINDOW = 4
SLICE = 2 << 20
# Fixed value: the pattern of byte-level tokenizers.
PATTERN = (r"'(?:s|t|re|ve|m|ll|d)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")

_WHITE = regex.compile(r"\s+")


class Codec:
    """Encodes and decodes as the tokenizers library does with a byte-level BPE file."""

    def __init__(self, spec: str, leaf: int = LEAF):
        shape = json.loads(spec)
        alphabet = byte_alphabet()
        self.leaf = leaf
        self.library = Tokenizer.from_str(spec)
        self.library.no_padding()
        self.library.no_truncation()
        self.special = {t["content"]: t["id"] for t in shape["added_tokens"]}
        plain = {w: i for w, i in shape["model"]["vocab"].items() if w not in self.special}
        self.bytes_of = {i: bytes(alphabet[c] for c in w) for w, i in plain.items()}
        self.bytes_of |= {i: w.encode() for w, i in self.special.items()}
        merges = [p.split(" ") if isinstance(p, str) else p for p in shape["model"]["merges"]]
        made = [plain[a + b] for a, b in merges]
        if made != sorted(set(made)) or len(made) + 256 != len(plain):
            raise ValueError("the ids of this vocabulary do not follow its merges")
        # bytes come before all merges, in any order
        order = [*sorted(set(plain.values()) - set(made)), *made]
        self.id_of = np.array(order, np.uint32)
        self.straight = order == list(range(len(order)))
        self.fast = tiktoken.Encoding("pieces", pat_str=PATTERN, special_tokens={}, mergeable_ranks={
            self.bytes_of[i]: rank for rank, i in enumerate(order)})
        # pieces as they are, written in the byte alphabet
        self.letters = {b: c for c, b in alphabet.items()}
        self.whole = Tokenizer.from_str(spec)
        self.whole.pre_tokenizer = None
        self.whole.encode_special_tokens = True
        self.whole.no_padding()
        self.whole.no_truncation()
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") \
            if self.special else None

    # -- unsplit pieces ------------------------------------------------------------

    def _pure(self, pieces: list[bytes]) -> list[list[int]]:
        """Each piece as one word, side by side."""
        words = ["".join(map(self.letters.__getitem__, p)) for p in pieces]
        return [e.ids for e in self.whole.encode_batch(words, add_special_tokens=False)]

    def _text(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def join(self, pairs: list[tuple[list[int], list[int]]]) -> list[list[int]]:
        """The encoding of both sides of each pair, from the encodings of the sides."""
        done: list[list[int] | None] = [a or b if not (a and b) else None for a, b in pairs]
        width = WINDOW
        while any(d is None for d in done):
            open_ = [i for i, d in enumerate(done) if d is None]
            windows = self._pure([self._text(pairs[i][0][-width:] + pairs[i][1][:width])
                                  for i in open_])
            for i, window in zip(open_, windows):
                a, b = pairs[i]
                left = width >= len(a) or window[0] == a[-width]
                right = width >= len(b) or window[-1] == b[width - 1]
                if left and right:
                    done[i] = a[:-width] + window + b[width:]
            width *= 2
        return done

    def tree(self, pieces: list[bytes]) -> list[list[int]]:
        """Unsplit pieces: leaves, then joins of neighbours until one is left of each."""
        leaves, owner = [], []
        for n, piece in enumerate(pieces):
            parts = 1
            while len(piece) > self.leaf * parts:
                parts *= 2
            ends = [len(piece) * k // parts for k in range(parts + 1)]
            leaves += [piece[a:b] for a, b in zip(ends, ends[1:])]
            owner.append(parts)
        flat = iter(self._pure(leaves))
        trees = [[next(flat) for _ in range(parts)] for parts in owner]
        while any(len(t) > 1 for t in trees):
            joined = iter(self.join([(t[k], t[k + 1]) for t in trees if len(t) > 1
                                     for k in range(0, len(t), 2)]))
            trees = [[next(joined) for _ in range(len(t) // 2)] if len(t) > 1 else t
                     for t in trees]
        return [t[0] for t in trees]

    # -- texts ---------------------------------------------------------------------

    def _split(self, text: str) -> np.ndarray:
        """Ids of a text without long pieces, doubtful characters or special strings."""
        found = np.array(self.fast.encode_ordinary(text), np.uint32)
        return found if self.straight else self.id_of[found]

    def _pieces(self, raw: bytes, starts: np.ndarray) -> list[np.ndarray]:
        """Ids of a text with long pieces, which begin and end at some of ``starts``."""
        ends = np.append(starts[1:], len(raw))
        parts, kinds, done = [], [], 0
        for n in np.flatnonzero(ends - starts > self.leaf):
            # white space is split by what follows it, so pieces of it go one by one
            m = n
            while m and starts[m - 1] >= done and _WHITE.fullmatch(
                    raw[starts[m - 1]:starts[m]].decode()):
                m -= 1
            cuts = [done, *starts[m:n + 1].tolist(), int(ends[n])]
            parts += [raw[x:y] for x, y in zip(cuts, cuts[1:])]
            kinds += [False] * (len(cuts) - 2) + [True]
            done = int(ends[n])
        parts.append(raw[done:])
        kinds.append(False)
        trees = iter(self.tree([p for p, long in zip(parts, kinds) if long]))
        return [np.array(next(trees), np.uint32) if long else self._split(part.decode())
                for part, long in zip(parts, kinds)]

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text; a null text has none."""
        texts = texts.fill_null("")
        raw, offsets = text_buffer(texts)
        filled = offsets[:-1] < offsets[1:]
        starts = np.flatnonzero(piece_starts(raw, offsets[:-1][filled]))
        sizes = np.diff(np.append(starts, len(raw)))
        begins = np.searchsorted(starts, offsets)
        long = np.concatenate([[0], np.cumsum(sizes > self.leaf)])
        rare = np.concatenate([[0], np.cumsum(raw >= 0xD5)])
        doubtful = char_classes()[1]
        out = []
        for i, text in enumerate(texts.to_pylist()):
            a, b = offsets[i], offsets[i + 1]
            if rare[b] > rare[a] and not doubtful.isdisjoint(text):
                ids = self.library.encode(text, add_special_tokens=False).ids
                out.append(np.array(ids, np.uint32))
            elif self.cut and any(word in text for word in self.special):
                parts = self.cut.split(text)
                found = self.encode(pa.array(parts[::2], pa.string()))
                marks = [np.array([self.special[w]], np.uint32) for w in parts[1::2]] + [found[0][:0]]
                out.append(np.concatenate([x for pair in zip(found, marks) for x in pair]))
            elif long[begins[i + 1]] > long[begins[i]]:
                own = starts[begins[i]:begins[i + 1]] - a
                out.append(np.concatenate(self._pieces(text.encode(), own)))
            else:
                out.append(self._split(text))
        return out

    def decode(self, ids: np.ndarray) -> str:
        """The text of the ids, special tokens included."""
        return self._text(ids.tolist()).decode("utf-8", "replace")


def codec(spec: str) -> Codec:
    """One codec in each Python worker."""
    return once_per_worker(f"codec_{zlib.crc32(spec.encode())}", lambda: Codec(spec))


def _read(tokenizer: str) -> str:
    with open(tokenizer, encoding="utf-8") as f:
        return f.read()


def _encode(spec: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in small_slices(batch, "text", SLICE):
                ids = [x.view(np.int32) for x in codec(spec).encode(part.column("text"))]
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), pa.array(ids, pa.list_(pa.int32()))], names=["row", "ids"])
    return run


def encode(docs: DataFrame, tokenizer: str, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``docs`` with ids, the whole text's tokens.

    ``tokenizer`` is the path of a tokenizers file, read on the driver. A null or
    empty text has no ids. Repeated rows are encoded alike; an empty table gives no rows.
    """
    schema = (StructType().add("row", StructType([docs.schema[c] for c in keep]))
              .add("ids", ArrayType(IntegerType())))
    rows = docs.select(F.struct(*keep).alias("row"), "text")
    return rows.mapInArrow(_encode(_read(tokenizer)), schema).select("row.*", "ids")


def decode(encoded: DataFrame, tokenizer: str, keep: list[str]) -> DataFrame:
    """The columns ``keep`` with text, what the ids stand for; null ids give an empty text."""
    spec = _read(tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [codec(spec).decode(np.array(ids or [], np.uint32))
                     for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string())],
                                             names=["row", "text"])

    schema = (StructType().add("row", StructType([encoded.schema[c] for c in keep]))
              .add("text", "string"))
    return encoded.select(F.struct(*keep).alias("row"), "ids").mapInArrow(run, schema).select(
        "row.*", "text")


def _digest(spec: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in small_slices(batch, "text", SLICE):
                c = codec(spec)
                ids = c.encode(part.column("text"))
                texts = [c.decode(x).encode() for x in ids]
                yield pa.RecordBatch.from_arrays([
                    part.column("row"), pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in ids]),
                    pa.array([hashlib.sha256(x).hexdigest() for x in texts])],
                    names=["row", "n_tokens", "ids_sha256", "decoded_sha256"])
    return run


def round_trip(docs: DataFrame, tokenizer: str, keep: list[str]) -> DataFrame:
    """The columns ``keep`` with n_tokens and digests of the ids and of the text they
    decode to: ``encode`` and ``decode`` in one pass over the texts."""
    schema = (StructType().add("row", StructType([docs.schema[c] for c in keep]))
              .add("n_tokens", "long").add("ids_sha256", "string").add("decoded_sha256", "string"))
    rows = docs.select(F.struct(*keep).alias("row"), "text")
    return rows.mapInArrow(_digest(_read(tokenizer)), schema).select(
        "row.*", "n_tokens", "ids_sha256", "decoded_sha256")


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return round_trip(docs, public_tokenizers.path("byte_bpe_50k.json"), ["doc_id"])

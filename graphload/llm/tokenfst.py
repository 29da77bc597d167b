"""Token counts by a compiled tokenizer: two deterministic transducers over text.

The first marks where pieces (the units the tokenizer never merges across) start;
it looks one character back and three ahead, so it runs over whole arrays. The
second reads bytes inside a piece. Its state after a prefix holds, for every
suffix that may still grow into a token, the last token before that suffix and how
many tokens lie between, so each transition (state, byte) fixes the next state and
how many tokens more (or fewer) the prefix has: the counts are annotations of the
transitions. States are made when a text first needs them.

Texts are cut into chunks that run side by side. A chunk that begins a piece maps
every state to the same end; a chunk inside an unsplit piece is a map from the state
before it. No maps are composed: all chunks run at once from an assumed state, and
those whose predecessor ended elsewhere run again from there, until every chunk began
where the one before it ended (at worst one round per chunk of an unsplit piece).
"""

from __future__ import annotations

import json
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from tokenizers.pre_tokenizers import ByteLevel

from .common import once_per_worker, small_slices, table, text_buffer

CHUNK = 1024
SLICE = 2 << 20
MOST_STATES = 1 << 17
FEW = 64
LIMIT = 512

LETTER, NUMBER, OTHER, BLANK, SPACE = range(5)


def byte_alphabet() -> dict[str, int]:
    """The characters by which a byte-level vocabulary writes bytes: printable ones
    stand for themselves, the others for the code points from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def char_classes() -> tuple[np.ndarray, frozenset[str]]:
    return once_per_worker("char_classes", _char_classes)


def _char_classes() -> tuple[np.ndarray, frozenset[str]]:
    """Class of every code point (the blank, 0x20, is a class of its own), and the
    characters whose class depends on the version of Unicode.

    Those on which two versions differ are looked up in the library's own splitter.
    """
    classes = np.full(0x110000, OTHER, np.uint8)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        for m in regex.finditer(pattern, every):
            run = m.group()
            classes[ord(run[0]):ord(run[-1]) + 1] = kind
    kinds = {"L": LETTER, "N": NUMBER}
    spaces = regex.compile(r"\s")
    doubtful = frozenset(c for c in every if classes[ord(c)] != (
        SPACE if spaces.match(c) else kinds.get(unicodedata.category(c)[0], OTHER)))
    splitter = ByteLevel(add_prefix_space=False)
    for c in doubtful:
        begins = {span[0] for _, span in splitter.pre_tokenize_str(f"a{c}1{c}!{c}")}
        classes[ord(c)] = next((kind for kind, at in ((LETTER, 1), (NUMBER, 3), (OTHER, 5))
                                if at not in begins), SPACE)
    classes[0x20] = BLANK
    return classes, doubtful


def piece_starts(raw: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Whether a piece starts at each byte of UTF-8 texts that begin at ``begins``."""
    lead = (raw & 0xC0) != 0x80
    at = np.flatnonzero(lead)
    byte = raw[at].astype(np.int32)
    code = byte.copy()
    for size, first, mask in ((2, 0xC0, 0x1F), (3, 0xE0, 0x0F), (4, 0xF0, 0x07)):
        here = np.flatnonzero((byte >= first) & (byte <= (first | mask)))
        value = byte[here] & mask
        for k in range(1, size):
            value = value << 6 | (raw[at[here] + k] & 0x3F)
        code[here] = value
    kind = char_classes()[0][code]
    n = len(at)
    first = np.zeros(n + 1, bool)
    first[np.searchsorted(at, begins)] = True
    first[n] = True
    white = kind >= BLANK
    before = np.concatenate([[OTHER], kind[:-1]]) if n else kind
    start = first[:n].copy()
    start |= white & (before < BLANK)
    # the last blank of a longer run goes with what follows it
    followed = np.zeros(n, bool)
    followed[:-1] = ~first[1:n] & ~white[1:]
    start |= white & (before >= BLANK) & followed
    start |= ~white & (before == SPACE)
    start |= ~white & (before < BLANK) & (kind != before)
    # contractions: an apostrophe that starts a piece, with s t m d re ve ll
    mark = np.flatnonzero((code == 39) & start & (first[:n] | (before != OTHER)))
    wide = np.concatenate([code, [0, 0, 0]])
    ends = np.concatenate([first, [True, True, True]])
    one, two = wide[mark + 1], wide[mark + 2]
    single = ~ends[mark + 1] & np.isin(one, [ord(c) for c in "stmd"])
    double = ~ends[mark + 1] & ~ends[mark + 2] & np.isin(
        one * 256 + two, [ord(a) * 256 + ord(b) for a, b in ("re", "ve", "ll")])
    start[mark[single | double] + 1] = False
    after = np.concatenate([mark[single] + 2, mark[double] + 3])
    start[after[after < n]] = True
    out = np.zeros(len(raw), bool)
    out[at] = start
    return out


class CountTransducer:
    """Byte transducer of a byte-level BPE vocabulary with emitted-token counts."""

    def __init__(self, vocab: dict[bytes, int], merges: dict[tuple[int, int], tuple[int, int]]):
        """``merges``: (left id, right id) -> (rank, merged id)."""
        self.vocab, self.merges = vocab, merges
        self.bytes_of = {i: b for b, i in vocab.items()}
        self.single = [vocab.get(bytes([b])) for b in range(256)]
        self.children: dict[tuple[int, int], int] = {}
        self.token_at: dict[int, int] = {}
        grows, nodes = set(), 1
        for word, token in vocab.items():
            node = 0
            for byte in word:
                if (node, byte) not in self.children:
                    self.children[node, byte] = nodes
                    grows.add(node)
                    nodes += 1
                node = self.children[node, byte]
            self.token_at[node] = token
        self.grows = grows
        self.below: dict[int, list[int]] = {}
        for (node, _), child in reversed(self.children.items()):
            # children were made after their parents, so they are complete here
            found = self.below.setdefault(node, [])
            found += self.below.get(child, [])
            if child in self.token_at:
                found.append(self.token_at[child])
        self.rank = {merged: rank for rank, merged in merges.values()}
        self.parts = {merged: pair for pair, (_, merged) in reversed(merges.items())}
        self.valid: dict[tuple[int, int], bool] = {}
        self.alike: dict[tuple[int, int], int | None] = {}
        self.first_alike: dict[tuple[int, tuple[int, ...]], int] = {}
        self.clear()

    def clear(self, keep: tuple = ()) -> None:
        """Forget all states but the first and those to ``keep``."""
        root = ((0, -1, 0),)
        self.states = list(dict.fromkeys([root, *keep]))
        self.number = {s: i for i, s in enumerate(self.states)}
        self.moves = np.full((max(1024, 2 * len(self.states)), 256), -1, np.int32)

    def encode(self, ids: list[int]) -> list[int]:
        """Merge a list of ids in order of rank, the leftmost first."""
        while len(ids) > 1:
            best = min((self.merges[pair][0], i) for i, pair in enumerate(zip(ids, ids[1:]))
                       if pair in self.merges) if any(
                pair in self.merges for pair in zip(ids, ids[1:])) else None
            if best is None:
                return ids
            i = best[1]
            ids = [*ids[:i], self.merges[ids[i], ids[i + 1]][1], *ids[i + 2:]]
        return ids

    def follows(self, last: int, token: int) -> bool:
        """Whether the two tokens side by side are what their bytes encode to.

        They are not if, at any time while both grow out of bytes, the parts that
        meet at the border merge before either becomes part of something larger.
        """
        if (last, token) not in self.valid:
            self.valid[last, token] = (
                self.encode([self.single[b] for b in self.bytes_of[token]]) == [token]
                if last < 0 else self._apart(last, token))
        return self.valid[last, token]

    def _apart(self, left: int, right: int) -> bool:
        never = len(self.merges)
        left_taken = right_taken = never
        while True:
            merged = self.merges.get((left, right))
            # of two equal merges the one further left goes first
            if merged and merged[0] < left_taken and merged[0] <= right_taken:
                return False
            made_left, made_right = self.rank.get(left, -1), self.rank.get(right, -1)
            if made_left < 0 and made_right < 0:
                return True
            if made_left > made_right or made_left == made_right and left_taken != made_left:
                left_taken, left = made_left, self.parts[left][1]
            else:
                right_taken, right = made_right, self.parts[right][0]

    def same(self, node: int, last: int) -> int | None:
        """A token that allows the same tokens below ``node`` as ``last`` does; None if none."""
        if (node, last) not in self.alike:
            below = self.below[node]
            if len(below) > FEW:
                self.alike[node, last] = last
            else:
                allowed = tuple(t for t in below if self.follows(last, t))
                self.alike[node, last] = (
                    self.first_alike.setdefault((node, allowed), last) if allowed else None)
        return self.alike[node, last]

    def step(self, state: tuple, byte: int) -> tuple[tuple, int]:
        """(next state, tokens more than before)."""
        grown, ended = [], None
        for node, last, behind in state:
            child = self.children.get((node, byte))
            if child is None:
                continue
            token = self.token_at.get(child)
            if ended is None and token is not None and self.follows(last, token):
                ended = token, behind + 1
            if child in self.grows:
                alike = self.same(child, last)
                if alike is not None:
                    grown.append((child, alike, behind))
        token, more = ended
        return (*((c, last, behind - more) for c, last, behind in grown), (0, token, 0)), more

    def learn(self, state: int, byte: int) -> None:
        after, more = self.step(self.states[state], byte)
        if after not in self.number:
            self.number[after] = len(self.states)
            self.states.append(after)
            if len(self.states) > len(self.moves):
                self.moves = np.concatenate([self.moves, np.full_like(self.moves, -1)])
        self.moves[state, byte] = self.number[after] << 8 | more + 128

    def run(self, raw: np.ndarray, inside: np.ndarray, starts: np.ndarray, sizes: np.ndarray,
            entry: list[tuple]) -> tuple[list[tuple], np.ndarray]:
        """Run chunks side by side: (state after each, tokens emitted by each).

        ``inside`` is 0 where a byte starts a piece and the state begins anew.
        """
        if len(self.states) > MOST_STATES:
            self.clear()
        for s in entry:
            if s not in self.number:
                self.number[s] = len(self.states)
                self.states.append(s)
        while len(self.states) > len(self.moves):
            self.moves = np.concatenate([self.moves, np.full_like(self.moves, -1)])
        order = np.argsort(-sizes, kind="stable")
        starts, sizes = starts[order], sizes[order]
        state = np.array([self.number[s] for s in entry], np.int32)[order]
        counts = np.zeros(len(order), np.int64)
        active = len(sizes) - np.searchsorted(sizes[::-1], np.arange(sizes.max(initial=0)), "right")
        for i, a in enumerate(active):
            at = starts[:a] + i
            byte, now = raw[at], state[:a] * inside[at]
            place = (now << 8) + byte
            move = self.moves.ravel()[place]
            if move.min() < 0:
                for p in np.unique(place[move < 0]):
                    self.learn(int(p) >> 8, int(p) & 255)
                move = self.moves.ravel()[place]
            state[:a] = move >> 8
            counts[:a] += (move & 255) - 128
        back = np.empty_like(order)
        back[order] = np.arange(len(order))
        return [self.states[s] for s in state[back]], counts[back]


def chunks(starts: np.ndarray, begins: np.ndarray, ends: np.ndarray, size: int = CHUNK
           ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first byte, bytes) of chunks: cut at the first piece start after ``size``
    bytes, or after twice as many where there is none."""
    places = np.flatnonzero(starts)
    text, first, length = [], [], []
    for t, (begin, end) in enumerate(zip(begins.tolist(), ends.tolist())):
        while end - begin > size:
            i = int(np.searchsorted(places, begin + size))
            cut = int(places[i]) if i < len(places) else end
            cut = min(cut, begin + 2 * size, end)
            text.append(t), first.append(begin), length.append(cut - begin)
            begin = cut
        if end > begin:
            text.append(t), first.append(begin), length.append(end - begin)
    return np.array(text, np.int64), np.array(first, np.int64), np.array(length, np.int64)


class TokenCounter:
    """Counts tokens as the tokenizers library does for a byte-level BPE file."""

    def __init__(self, spec: str):
        spec = json.loads(spec)
        model, alphabet = spec["model"], byte_alphabet()
        shape = spec["pre_tokenizer"]
        if (model["type"] != "BPE" or shape["type"] != "ByteLevel" or shape["add_prefix_space"]
                or not shape.get("use_regex", True) or spec["normalizer"] is not None):
            raise ValueError("not a byte-level BPE tokenizer with the usual pattern")
        self.special = [t["content"] for t in spec["added_tokens"]]
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError("added tokens that take more than their own text")
        to_bytes = lambda word: bytes(alphabet[c] for c in word)
        vocab = {to_bytes(w): i for w, i in model["vocab"].items() if w not in self.special}
        merges = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            a, b = to_bytes(a), to_bytes(b)
            merges.setdefault((vocab[a], vocab[b]), (rank, vocab[a + b]))
        self.transducer = CountTransducer(vocab, merges)
        self.split = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None

    def counts(self, texts: pa.Array) -> np.ndarray:
        """Tokens of each text; a null text has none."""
        texts = texts.fill_null("").cast(pa.large_string())
        special, owner = np.zeros(len(texts), np.int64), None
        marked = np.zeros(len(texts), bool)
        for word in self.special:
            marked |= pc.match_substring(texts, word).to_numpy(zero_copy_only=False)
        if marked.any():
            parts, owner = [], []
            for i, text in enumerate(texts.to_pylist()):
                found = self.split.split(text) if marked[i] else [text]
                special[i] = len(found) - 1
                parts += found
                owner += [i] * len(found)
            texts = pa.array(parts, pa.large_string())
        raw, offsets = text_buffer(texts)
        counted = self._plain(raw, offsets)
        if owner is not None:
            counted = np.bincount(owner, counted, len(special)).astype(np.int64)
        return counted + special

    def _plain(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        filled = offsets[:-1] < offsets[1:]
        begins, ends = offsets[:-1][filled], offsets[1:][filled]
        counts = np.zeros(len(offsets) - 1, np.int64)
        if not len(begins):
            return counts
        starts = piece_starts(raw, begins)
        inside = (~starts).astype(np.int32)
        text, first, size = chunks(starts, begins, ends)
        fresh = self.transducer.states[0]
        entry = [fresh] * len(text)
        after, emitted = self.transducer.run(raw, inside, first, size, entry)
        # the scan: a chunk inside a piece takes on the state its predecessor ended in
        waiting = np.flatnonzero(~starts[first])
        while True:
            again = [i for i in waiting if entry[i] != after[i - 1]]
            if not again:
                break
            for i in again:
                entry[i] = after[i - 1]
            ended, more = self.transducer.run(raw, inside, first[again], size[again],
                                              [entry[i] for i in again])
            for i, state in zip(again, ended):
                after[i] = state
            emitted[again] = more
        counts[np.flatnonzero(filled)] = np.bincount(text, emitted, len(begins)).astype(np.int64)
        return counts


def counter(spec: str) -> TokenCounter:
    """One compiled counter in each Python worker, with the states it has learned."""
    return once_per_worker(f"counter_{zlib.crc32(spec.encode())}", lambda: TokenCounter(spec))


def _count(spec: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = counter(spec)
        for batch in batches:
            for part in small_slices(batch, "text", SLICE):
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), pa.array(compiled.counts(part.column("text")))],
                    names=["row", "n_tokens"])
    return run


def token_counts(docs: DataFrame, tokenizer: str, keep: list[str], limit: int = LIMIT) -> DataFrame:
    """The columns ``keep`` of ``docs`` with n_bytes, n_tokens and over_limit.

    ``tokenizer`` is the path of a tokenizers file, read on the driver. A null or
    empty text has 0 bytes and 0 tokens. Texts are counted whole, whatever their
    length; repeated rows count alike; an empty table gives no rows.
    """
    with open(tokenizer, encoding="utf-8") as f:
        spec = f.read()
    kept = StructType([docs.schema[c] for c in keep])
    rows = docs.select(F.struct(*keep, F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
                                .alias("n_bytes")).alias("row"), "text")
    schema = StructType().add("row", kept.add("n_bytes", "long")).add("n_tokens", "long")
    return rows.mapInArrow(_count(spec), schema).select(
        "row.*", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts(docs, public_tokenizers.path("byte_bpe_50k.json"), ["doc_id"])

"""Substring dedup by hashing the units of lines.

A unit is a line, or a sentence of a line that has several; its words, lower-cased
and with single blanks, make its digest. Digests are grouped over all documents with
a map-side step; the earliest occurrence (smallest doc_id, then place in the text)
stays. A document loses every unit that occurs earlier elsewhere, or earlier in
itself, however short the run it stands in (``min_words`` above 0 keeps runs of fewer
words); where they lay in the original text is kept. Units below ``unit_words`` words and UNIT_CHARS characters say nothing on
their own: they are not hashed and go only with the repeated units on both sides.
Characters count too because some scripts put no blanks between words; the full
stops of such scripts end a sentence without a blank after them.

A passage may also begin and end inside sentences. So windows of WINDOW words are hashed
too, the least of every GROUP neighbours (a run of WINDOW + GROUP - 1 words has one, the
same in each of its occurrences). Units and windows that occur earlier make runs along the
text of the first occurrence; their ends grow word by word against the CONTEXT words that
stand there beside them. A grown run goes if it has WINDOW words, WINDOW_DISTINCT of them
distinct; a piece of a sentence at its end that is too short for a unit stays.
"""

from __future__ import annotations

import re
from array import array
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import islice
from struct import unpack

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from ..storage import remove, scratch_path, write_once
from .common import settled, table

UNIT_WORDS = 4
UNIT_CHARS = 24
MIN_WORDS = 0
WINDOW = 16
WINDOW_DISTINCT = 10
GROUP = 32
CONTEXT = WINDOW + GROUP
ROWS = 1 << 15

# ASCII marks need white space after them; ideographic, Devanagari, Arabic, Ethiopic,
# Burmese and Khmer full stops do not, and take the closing quotes and brackets after them.
# Each pattern begins with one set of characters, for which it looks quickly.
_STOPS = "。｡！？।॥۔؟።။។"
_END = re.compile(rf"[.!?\n{_STOPS}](?:(?<=\n)|(?<=[.!?])[^\w\s]*(?=\s)"
                  rf"|(?<=[{_STOPS}])[{_STOPS}]*[.!?”’»)\]）」』】〉》]*)")
_ASCII_END = re.compile(r"[.!?\n](?:(?<=\n)|[^\w\s]*(?=\s))")


def unit_ends(text: str) -> Iterator[int]:
    """Where units may end, the end of the text last."""
    for m in (_ASCII_END if text.isascii() else _END).finditer(text):
        yield m.end()
    yield len(text)


_HAN = re.compile("[\u3041-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")

# characters of scripts without blanks count as a word each where passages are compared
_NO_BLANKS = ("\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3041-\u30ff\u3400-\u4dbf\u4e00-\u9fff"
              "\uf900-\ufaff\U00020000-\U0003ffff")
_LONE = re.compile(f"[{_NO_BLANKS}]")
_TOKEN = re.compile(rf"[{_NO_BLANKS}]|[^\s{_NO_BLANKS}]+")


def units(text: str) -> Iterator[tuple[int, int, list[str]]]:
    """(first character, end, lower-cased words) of every unit that has words."""
    begin = 0
    for end in unit_ends(text):
        part = text[begin:end]
        words = part.lower().split()
        if words:
            body = part.strip()
            first = begin + part.index(body)
            yield first, first + len(body), words
        begin = end


def unit_words_of(text: str) -> Iterator[list[str]]:
    """The words of ``units`` alone."""
    begin = 0
    for end in unit_ends(text):
        words = text[begin:end].lower().split()
        if words:
            yield words
        begin = end


def long_enough(words: list[str], unit_words: int) -> bool:
    """Whether a unit is hashed: by its words, or by its characters without the blanks.

    A Han or kana character says about as much as three letters and counts as such.
    """
    return len(words) >= unit_words or sum(
        len(w) + 2 * len(_HAN.findall(w)) for w in words) >= UNIT_CHARS


def unit_digest(words: list[str]) -> tuple[int, int]:
    """128 bits of a unit as two signed longs."""
    return unpack(">qq", xxhash.xxh3_128_digest(" ".join(words).encode()))


def has_lone(text: str) -> bool:
    """Whether a text has a character that is a word of its own."""
    return not text.isascii() and _LONE.search(text) is not None


def tokens_of(text: str) -> list[str]:
    """The tokens of all units of a text."""
    lone = has_lone(text)
    return [t for words in unit_words_of(text) for t in (tokens(words) if lone else words)]


def tokens(words: list[str]) -> list[str]:
    """The words of a unit, those of scripts without blanks cut into characters."""
    if not any(_LONE.search(w) for w in words if not w.isascii()):
        return words
    return [t for w in words for t in _TOKEN.findall(w)]


def long_piece(piece: list[str], unit_words: int) -> bool:
    """``long_enough`` for tokens: lone characters count as characters only."""
    return long_enough(piece, unit_words + sum(1 for t in piece if _LONE.match(t)))


# Windows whose neighbours are compared at once.
PART = 1 << 14


class Hashes(dict):
    """64 bits of a word, kept for the next time it comes; emptied when many are held."""

    MOST = 1 << 16

    def __missing__(self, word: str) -> int:
        if len(self) >= self.MOST:
            self.clear()
        self[word] = found = xxhash.xxh3_64_intdigest(word)
        return found


def windows(each: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first token, two halves of the digest) of the windows that stand for texts.

    ``each`` has the hash of every token of all texts one after the other, ``ends`` the end
    of each text; a window lies in one text.
    """
    n = len(each) - WINDOW + 1
    if n <= 0:
        none = np.zeros(0, np.int64)
        return none, none, none
    order = np.argsort(each, kind="stable")
    same = each[order[1:]] == each[order[:-1]]
    # the place before where a token stood; in another text it is before any window of this one
    before = np.full(len(each), -1)
    before[order[1:][same]] = order[:-1][same]
    starts, distinct = np.arange(n), np.zeros(n, np.int8)
    high, low = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
    for k in range(WINDOW):
        part = each[k:k + n]
        high = high * np.uint64(0x9E3779B97F4A7C15) + part
        low = low * np.uint64(0xC2B2AE3D27D4EB4F) + (part ^ (part >> np.uint64(29)))
        distinct += before[k:k + n] < starts
    high = (high ^ (high >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    high ^= high >> np.uint64(29)
    most = np.uint64(0xFFFFFFFFFFFFFFFF)
    value = np.where(distinct >= WINDOW_DISTINCT, high, most)
    begins = np.concatenate([[0], ends[:-1]])
    counts = ends - begins - WINDOW + 1
    # the least of all windows of a short text, the least of every GROUP neighbours of others
    chosen = [np.array([b + value[b:b + c].argmin() for b, c in zip(
        begins[(0 < counts) & (counts <= GROUP)].tolist(),
        counts[(0 < counts) & (counts <= GROUP)].tolist())], np.int64)]
    long = counts > GROUP
    if long.any():
        groups = np.lib.stride_tricks.sliding_window_view(value, GROUP)
        sizes = counts[long] - GROUP + 1
        firsts = np.repeat(begins[long] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        # part by part, as each takes GROUP numbers for every window
        chosen += [np.unique(groups[part].argmin(axis=1) + part)
                   for part in np.array_split(firsts, -(-len(firsts) // PART))]
    chosen = np.unique(np.concatenate(chosen))
    chosen = chosen[value[chosen] != most]
    return chosen, high[chosen].view(np.int64), low[chosen].view(np.int64)


_SPANS = ArrayType(StructType().add("start", "integer").add("size", "integer")
                   .add("units", "integer").add("blanks", "integer"))
# at: first token; size: tokens of a unit, 0 for a window; -1: at is the number of units
_PLACES = "high long, low long, doc_id long, text_key long, at int, size int"
_ENDS = "doc_id long, text_key long, a_id long, a_key long, right boolean, a_at int, at int"
_CONTEXTS = "a_id long, a_key long, right boolean, a_at int, context string"


# Rows that a task holds as Python objects at once.
PIECE = 512


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, PIECE):
            yield batch.slice(start, PIECE)


# Tokens whose windows are made at once.
TOKENS = 1 << 16


def _emit(unit_words: int):
    """Places of all units and windows, and one row with size -1 and the number of units
    for each text."""
    schema = pa.schema([("high", pa.int64()), ("low", pa.int64()), ("doc_id", pa.int64()),
                        ("text_key", pa.int64()), ("at", pa.int32()), ("size", pa.int32())])
    hashes = Hashes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        each, texts = array("Q"), []

        def flush():
            ends = np.array([t[2] for t in texts], np.int64)
            at, high, low = windows(np.frombuffer(each, np.uint64), ends)
            of = np.searchsorted(ends, at, "right")
            begins = np.concatenate([[0], ends[:-1]])
            ids = pa.array([t[0] for t in texts], pa.int64()).take(pa.array(of))
            keys = pa.array([t[1] for t in texts], pa.int64()).take(pa.array(of))
            more = (pa.array(high), pa.array(low), ids, keys,
                    pa.array((at - begins[of]).astype(np.int32)),
                    pa.array(np.zeros(len(at), np.int32)))
            return pa.RecordBatch.from_arrays(
                [pa.concat_arrays([pa.array(c, f.type), m])
                 for c, m, f in zip(zip(*held), more, schema)], schema=schema)

        for batch in _pieces(batches):
            for doc_id, key, text in zip(*(batch.column(n).to_pylist()
                                           for n in ("doc_id", "text_key", "text"))):
                begin, count, lone = len(each), 0, has_lone(text)
                for words in unit_words_of(text):
                    cut, count = tokens(words) if lone else words, count + 1
                    if len(words) >= unit_words or long_enough(words, unit_words):
                        held.append((*unit_digest(words), doc_id, key, len(each) - begin, len(cut)))
                    each.extend(map(hashes.__getitem__, cut))
                held.append((0, 0, doc_id, key, count, -1))
                texts.append((doc_id, key, len(each)))
                if len(each) >= TOKENS or len(held) >= ROWS:
                    yield flush()
                    held, each, texts = [], array("Q"), []
        if texts:
            yield flush()
    return run


def repeated_runs(found: list[tuple[int, int, list[str]]], again: set[int], unit_words: int,
                  min_words: int) -> list[tuple[int, int]]:
    """(first unit, last unit) of the runs that go. ``again``: units that are not the first."""
    runs, first, last, words = [], None, None, 0
    for n, (_, _, unit) in enumerate(found):
        if n in again:
            first = n if first is None else first
            last, words = n, words + len(unit)
        elif long_enough(unit, unit_words):
            if first is not None and words >= min_words:
                runs.append((first, last))
            first, words = None, 0
    if first is not None and words >= min_words:
        runs.append((first, last))
    return runs


def joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The union of spans, those that touch as one."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = out[-1][0], max(end, out[-1][1])
        else:
            out.append((start, end))
    return out


def chains(again: list[dict]) -> dict[tuple, list[tuple[int, int]]]:
    """Token spans that a text has in common with (a_id, a_key), so many tokens further there."""
    found: dict[tuple, list] = {}
    for m in again:
        found.setdefault((m["a_id"], m["a_key"], m["a_at"] - m["at"]), []).append(
            (m["at"], m["at"] + (m["size"] or WINDOW)))
    return {k: joined(v) for k, v in found.items()}


def open_ends(again: list[dict]) -> Iterator[tuple]:
    """(a_id, a_key, right, a_at, at) of the ends beside which less than CONTEXT is known to go."""
    found = chains(again)
    cover = joined([span for spans in found.values() for span in spans])
    begins = np.array([c[0] for c in cover])
    for (a_id, a_key, off), spans in found.items():
        for start, end in spans:
            begin, stop = cover[int(np.searchsorted(begins, start, "right")) - 1]
            if stop - end < CONTEXT:
                yield a_id, a_key, True, end + off, end
            if start - begin < CONTEXT and start and start + off:
                yield a_id, a_key, False, start + off, start


def _ends():
    schema = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("a_id", pa.int64()),
                        ("a_key", pa.int64()), ("right", pa.bool_()), ("a_at", pa.int32()),
                        ("at", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [(doc_id, key, *end) for doc_id, key, again in zip(
                *(batch.column(n).to_pylist() for n in ("doc_id", "text_key", "again")))
                for end in open_ends(again)]
            columns = list(zip(*held)) or [()] * len(schema)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
    return run


def _contexts():
    schema = pa.schema([("a_id", pa.int64()), ("a_key", pa.int64()), ("right", pa.bool_()),
                        ("a_at", pa.int32()), ("context", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches):
            held = []
            for a_id, a_key, text, wanted in zip(*(batch.column(n).to_pylist() for n in (
                    "doc_id", "text_key", "text", "wanted"))):
                whole = tokens_of(text)
                for w in wanted:
                    at = w["a_at"]
                    beside = (whole[at:at + CONTEXT] if w["right"]
                              else whole[max(0, at - CONTEXT):at])
                    held.append((a_id, a_key, w["right"], at, " ".join(beside)))
            columns = list(zip(*held)) or [()] * len(schema)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
    return run


def grown_runs(whole: list[str], borders: list[int], again: list[dict], around: list[dict],
               unit_words: int) -> list[tuple[int, int]]:
    """Token spans of the runs that go, grown against the words beside the first occurrence.

    ``borders``: first token of every unit, and the number of tokens.
    """
    beside = {(c["a_id"], c["a_key"], c["right"], c["a_at"], c["at"]): c["context"].split()
              for c in around}
    runs = []
    for (a_id, a_key, off), spans in chains(again).items():
        grown = []
        for start, end in spans:
            for word in beside.get((a_id, a_key, True, end + off, end), ()):
                if end == len(whole) or whole[end] != word:
                    break
                end += 1
            for word in reversed(beside.get((a_id, a_key, False, start + off, start), ())):
                if not start or whole[start - 1] != word:
                    break
                start -= 1
            grown.append((start, end))
        for start, end in joined(grown):
            if end - start < WINDOW or len(set(whole[start:end])) < WINDOW_DISTINCT:
                continue
            after = borders[bisect_left(borders, start)]
            if after < end and not long_piece(whole[start:after], unit_words):
                start = after
            before = borders[bisect_right(borders, end) - 1]
            if before > start and not long_piece(whole[before:end], unit_words):
                end = before
            runs.append((start, end))
    return joined(runs)


def cleaned(text: str, again: set[int], unit_words: int, min_words: int,
            passages: list[tuple[int, int]] = [], found: list | None = None
            ) -> tuple[str, int, int, list[dict]]:
    """(text without its repeated runs, units, words removed, removed spans).

    ``again``: units that are not the first; ``passages``: characters that go besides;
    ``found``: the units, where the caller has them.
    """
    found = list(units(text)) if found is None else found
    gone = [(found[first][0], found[last][1])
            for first, last in repeated_runs(found, again, unit_words, min_words)]
    merged: list[tuple[int, int]] = []
    for start, end in joined(gone + passages):
        if merged and not text[merged[-1][1]:start].strip():
            merged[-1] = merged[-1][0], end
        else:
            merged.append((start, end))
    kept, done, spans, words = [], 0, [], 0
    for start, end in merged:
        words += len(text[start:end].split())
        kept.append(text[done:start])
        # a run that ends its line takes the blanks before the line's end with it
        rest = text[end:]
        gap = rest[:len(rest) - len(rest.lstrip())]
        done = end + (gap.index("\n") if "\n" in gap else len(gap))
        spans.append({"start": start, "size": end - start, "units": sum(
            start <= a and b <= end for a, b, _ in found), "blanks": done - end})
    kept.append(text[done:])
    return "".join(kept), len(found), words, spans


def _cut(text: str, again: list[dict], around: list[dict], unit_words: int, min_words: int):
    """``cleaned`` by the places that occur earlier and the words beside those."""
    found, lone = list(units(text)), has_lone(text)
    whole, borders = [], []
    for _, _, words in found:
        borders.append(len(whole))
        whole += tokens(words) if lone else words

    def span(token: int) -> tuple[int, int]:
        """Characters of a token; only the unit it stands in is cut."""
        n = bisect_right(borders, token) - 1
        first, end, _ = found[n]
        m = next(islice(_TOKEN.finditer(text[first:end]), token - borders[n], None))
        return first + m.start(), first + m.end()

    unit = {at: n for n, at in enumerate(borders)}
    runs = grown_runs(whole, [*borders, len(whole)], again, around, unit_words)
    return cleaned(text, {unit[m["at"]] for m in again if m["size"]}, unit_words, min_words,
                   [(span(a)[0], span(b - 1)[1]) for a, b in runs], found)


def _clean(unit_words: int, min_words: int):
    """Texts with places that occur earlier are cut; the others go through as they are."""
    spans_type = pa.list_(pa.struct([("start", pa.int32()), ("size", pa.int32()),
                                     ("units", pa.int32()), ("blanks", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches):
            n = batch.num_rows
            touched = np.flatnonzero(batch.column("again").is_valid().to_numpy(
                zero_copy_only=False))
            rows = batch.take(pa.array(touched))
            cut = [_cut(text, again, around or [], unit_words, min_words)
                   for text, again, around in zip(*(rows.column(c).to_pylist()
                                                    for c in ("text", "again", "around")))]
            place = np.arange(n)
            place[touched] = n + np.arange(len(cut))
            place = pa.array(place)

            def whole(column: pa.Array, values: list) -> pa.Array:
                return pa.concat_arrays([column, pa.array(values, column.type)]).take(place)

            text = batch.column("text")
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), whole(text, [c[0] for c in cut]),
                 batch.column("n_units").fill_null(0),
                 whole(pa.array(np.zeros(n, np.int32)), [c[2] for c in cut]),
                 whole(pa.array([[]] * n, spans_type), [c[3] for c in cut])],
                names=["row", "text", "n_units", "removed_words", "removed"])
    return run


def dedup_passages(docs: DataFrame, unit_words: int = UNIT_WORDS, min_words: int = MIN_WORDS
                   ) -> DataFrame:
    """The rows of ``docs`` with their text cleaned, and n_units, removed_words, removed.

    ``removed`` lists (start, size, units, blanks) of what went, in characters of the
    original text: ``size`` of a run, and the ``blanks`` behind it; the text without both is
    the cleaned one. A null text stays null and an empty one empty. A null doc_id ranks last; among
    texts of one doc_id a hash of the text decides. Rows that repeat doc_id and text have
    one rank and lose the same, so the earliest keeps its units in each of them. An empty table gives
    no rows; other columns stay as they are (those with the names above are replaced).
    """
    keyed = docs.withColumn("__key", F.xxhash64("text"))
    narrow = keyed.select("doc_id", F.col("__key").alias("text_key"), "text").filter(
        "text is not null")
    # written, so that the texts are cut into units once; removed when what is needed of it,
    # the digests that have several places, is written
    folder = scratch_path(docs.sparkSession, "emitted")
    emitted = write_once(narrow.mapInArrow(_emit(unit_words), _PLACES), folder)
    counts = settled(emitted.filter("size < 0").select(
        F.col("doc_id").alias("__id"), F.col("text_key").alias("__text_key"),
        F.col("at").alias("n_units")).distinct())
    places = emitted.filter("size >= 0")
    rank = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "text_key", "at")
    # rows that repeat a document repeat its places, so a count says nothing: compare ends;
    # by a hash of the place first, which few digests have two of and which needs no sort
    place = F.xxhash64("doc_id", "text_key", "at")
    several = (places.groupBy("high", "low").agg(F.min(place).alias("a"), F.max(place).alias("b"))
               .filter("a <> b").select("high", "low"))
    places = settled(places.join(several, ["high", "low"], "left_semi"))
    remove(docs.sparkSession, folder)
    firsts = places.groupBy("high", "low").agg(F.min(rank).alias("first"))
    first = [F.col(f"first.{c}").alias(a) for c, a in (
        ("doc_id", "a_id"), ("text_key", "a_key"), ("at", "a_at"))]
    found = settled(places.join(firsts, ["high", "low"]).filter(rank != F.col("first"))
                    .groupBy("doc_id", "text_key")
                    .agg(F.collect_set(F.struct(*first, "at", "size")).alias("again")))
    ends = found.mapInArrow(_ends(), _ENDS)
    wanted = (ends.select("a_id", "a_key", "right", "a_at").distinct().groupBy("a_id", "a_key")
              .agg(F.collect_list(F.struct("right", "a_at")).alias("wanted")))
    contexts = (narrow.join(wanted, F.col("doc_id").eqNullSafe(F.col("a_id"))
                            & (F.col("text_key") == F.col("a_key")))
                .select("doc_id", "text_key", "text", "wanted").mapInArrow(_contexts(), _CONTEXTS)
                # once, however many rows repeat the document
                .groupBy("a_id", "a_key", "right", "a_at").agg(F.min("context").alias("context")))
    e, c = ends.alias("e"), contexts.alias("c")
    around = (e.join(c, F.col("e.a_id").eqNullSafe(F.col("c.a_id"))
                     & (F.col("e.a_key") == F.col("c.a_key"))
                     & (F.col("e.right") == F.col("c.right")) & (F.col("e.a_at") == F.col("c.a_at")))
              .filter("c.context <> ''").groupBy("e.doc_id", "e.text_key").agg(F.collect_list(
                  F.struct("e.a_id", "e.a_key", "e.right", "e.a_at", "e.at", "c.context"))
                  .alias("around"))
              .select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__text_key"), "around"))
    again = (found.join(around, F.col("doc_id").eqNullSafe(F.col("__id"))
                        & (F.col("text_key") == F.col("__text_key")), "left")
             .select(F.col("doc_id").alias("c_id"), F.col("text_key").alias("c_key"),
                     "again", "around"))
    told = counts.join(again, F.col("__id").eqNullSafe(F.col("c_id"))
                       & (F.col("__text_key") == F.col("c_key")), "left").drop("c_id", "c_key")
    out = [c for c in docs.columns if c not in ("text", "n_units", "removed_words", "removed")]
    rows = keyed.select(F.struct(*out).alias("row"), "text", "__key").join(
        told, F.col("row.doc_id").eqNullSafe(F.col("__id"))
        & (F.col("__key") == F.col("__text_key")), "left").select(
            "row", "text", "n_units", "again", "around")
    schema = (StructType().add("row", StructType([docs.schema[c] for c in out]))
              .add("text", "string").add("n_units", "integer").add("removed_words", "integer")
              .add("removed", _SPANS))
    names = [F.col("row")[c].alias(c) if c != "text" else F.col("text") for c in docs.columns
             if c not in ("n_units", "removed_words", "removed")]
    return rows.mapInArrow(_clean(unit_words, min_words), schema).select(
        *names, "n_units", "removed_words", "removed")


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_passages(docs).select(
        "doc_id", "text", "n_units", "removed_words", "removed",
        (F.size("removed") > 0).alias("changed"))

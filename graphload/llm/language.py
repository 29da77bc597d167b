"""Language identification: averaged hashed subword embeddings under a linear softmax.

Subwords are the 3- and 4-byte windows of lower-cased words, edges included. The
model is trained by stochastic gradient descent in numpy on a bounded sample of
labelled rows (``PER_LANGUAGE`` documents of each language by hash order, at most
``MOST_ROWS``; ``WINDOWS`` random windows of each whole text), of which a fifth
calibrates the temperature and the rejection level. Prediction reads whole texts:
the model is linear, so a text's score is the mean of one table row per window.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import settled, small_slices, table, text_buffer

ORDERS = (3, 4)
BITS = 16
DIMS = 16
PER_LANGUAGE = 1500
MOST_ROWS = 30000
WINDOWS = 400
STEPS = 2500
BATCH = 32
RATE = 1.0
# the windows of a document share its step, so each bucket sees little of it
BUCKET_RATE = 20.0
SEED = 7
# A document is rejected below the level that ``KEEP`` of the calibration documents
# reach, but never at a calibrated probability of ``SURE`` or more.
KEEP = 0.999
SURE = 0.5
SLICE = 1 << 20

_LETTERS = np.full(256, 32, np.uint32)
_LETTERS[97:123] = np.arange(97, 123)
_LETTERS[65:91] = np.arange(97, 123)
_LETTERS[128:] = np.arange(128, 256)


def subwords(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of every window, first window of every text and the end).

    Between the texts, and at both ends, lies a separator.
    """
    raw, offsets = text_buffer(texts)
    n, sizes = len(offsets) - 1, np.diff(offsets)
    x = np.full(len(raw) + n + 1, 32, np.uint32)
    x[np.arange(len(raw)) + np.repeat(np.arange(1, n + 1), sizes)] = _LETTERS[raw]
    starts = offsets + np.arange(n + 1)
    word = x != 32
    buckets, cuts = [], []
    code = x
    for order in range(2, max(ORDERS) + 1):
        code = code[:-1] * np.uint32(65599) + x[order - 1:]
        inner = word[1:len(x) - order + 2] if order == 2 else (
            inner[:-1] & word[order - 2:len(word) - 1])
        if order not in ORDERS:
            continue
        # ``inner`` holds the bytes between both ends of each window
        whole = inner if order > 2 else np.ones(len(code), bool)
        counted = np.concatenate([[0], np.cumsum(whole)])
        mixed = (code[whole] ^ np.uint32(order)) * np.uint32(2654435761)
        buckets.append(mixed >> np.uint32(32 - BITS))
        cuts.append(counted[np.minimum(starts, len(code))])
    return buckets, cuts


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    buckets: np.ndarray      # subword embeddings, or their scores where that is narrower
    weights: np.ndarray | None
    bias: np.ndarray
    temperature: float
    level: float

    def probabilities(self, texts: pa.Array) -> np.ndarray:
        """Calibrated probability of each language for whole texts."""
        buckets, cuts = subwords(texts)
        n, width = len(texts), self.buckets.shape[1]
        sums, counts = np.zeros((n, width)), np.zeros(n)
        for found, cut in zip(buckets, cuts):
            counts += np.diff(cut)
            for c in range(width):
                run = np.concatenate([[0.0], np.cumsum(self.buckets[:, c][found])])
                sums[:, c] += np.diff(run[cut])
        mean = sums / np.maximum(counts, 1)[:, None]
        scores = (mean if self.weights is None else mean @ self.weights) + self.bias
        return _softmax(scores / self.temperature)


def _softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _sample_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text_key, lang, order, windows): WINDOWS random windows of each whole text."""
    for batch in batches:
        for part in small_slices(batch, "text", SLICE):
            buckets, cuts = subwords(part.column("text"))
            keys = part.column("order").to_numpy()
            rows = []
            for i, key in enumerate(keys):
                own = np.concatenate([b[c[i]:c[i + 1]] for b, c in zip(buckets, cuts)])
                rng = np.random.default_rng([SEED, int(key) & ((1 << 63) - 1)])
                rows.append(rng.choice(own, WINDOWS).astype(np.int32) if len(own)
                            else np.zeros(0, np.int32))
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in ("doc_id", "text_key", "lang", "order")),
                 pa.array(rows, pa.list_(pa.int32()))],
                names=["doc_id", "text_key", "lang", "order", "windows"])


def learning_rows(docs: DataFrame, usable: Column, per_language: int = PER_LANGUAGE,
                  most: int = MOST_ROWS) -> DataFrame:
    """(lang, order, windows) of the sample: the first rows of each language by hash.

    Rows that are alike in doc_id, language and text count once; rows of one doc_id with
    other texts are other rows, so the bounds hold however ids repeat.
    """
    order = F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1 << 40))
    labelled = docs.filter(usable & F.col("lang").isNotNull() & F.col("text").isNotNull()
                           & F.col("doc_id").isNotNull())
    # ids beyond twice the share that is wanted are left out before any language is gathered
    share = labelled.groupBy("lang").agg(
        (2 * per_language * float(1 << 40) / F.approx_count_distinct("doc_id")).alias("most"))
    key = ["doc_id", "lang", "text_key"]
    keyed = labelled.withColumns({"order": order, "text_key": F.xxhash64("text")})
    # written, or Spark would deal all rows out by language for the window
    near = settled(keyed.select("order", *key).join(share, "lang").filter(
        F.col("order") < F.col("most")).select("order", *key).distinct())
    place = F.row_number().over(Window.partitionBy("lang").orderBy("order", *key))
    chosen = (near.withColumn("place", place).filter(F.col("place") <= per_language)
              .orderBy("place", "lang", "doc_id", "text_key").limit(most).select(*key))
    kind = docs.schema["doc_id"].dataType.simpleString()
    # ``chosen`` has at most ``most`` rows, whatever the data; copies of a row go when its
    # text, which may be long, has become windows
    return (keyed.select("order", "text", *key).join(F.broadcast(chosen), key, "left_semi")
            .mapInArrow(_sample_windows, f"doc_id {kind}, text_key long, lang string, order long, "
                        "windows array<int>")
            .dropDuplicates(key).select("lang", "order", "windows"))


def fit(rows: list) -> LanguageModel:
    """Train and calibrate on rows of (lang, order, windows).

    Every fifth row calibrates and is not learned from, unless its language has no other.
    """
    rows = sorted((r for r in rows if len(r["windows"])),
                  key=lambda r: (r["order"], r["lang"], r["windows"].tobytes()))
    languages = tuple(sorted({r["lang"] for r in rows}))
    if not languages:
        return LanguageModel((), np.zeros((1 << BITS, 1)), None, np.zeros(1), 1.0, 0.0)
    x = np.array([r["windows"] for r in rows], np.int64)
    y = np.array([languages.index(r["lang"]) for r in rows])
    held = np.arange(len(rows)) % 5 == 0
    alone = np.bincount(y[~held], minlength=len(languages))[y] == 0
    rng = np.random.default_rng(SEED)
    e = rng.normal(0, 0.1, (1 << BITS, DIMS))
    w = rng.normal(0, 0.1, (DIMS, len(languages)))
    learn = np.flatnonzero(~held | alone)
    b = np.log(np.bincount(y[learn], minlength=len(languages)) + 1.0)
    b -= b.mean()
    epochs = -(-STEPS * BATCH // len(learn))
    steps, step = epochs * -(-len(learn) // BATCH), 0
    for _ in range(epochs):
        order = rng.permutation(learn)
        for start in range(0, len(order), BATCH):
            part = order[start:start + BATCH]
            rate = RATE * (1 - step / steps)
            step += 1
            mean = e[x[part]].mean(axis=1)
            wrong = _softmax(mean @ w + b)
            wrong[np.arange(len(part)), y[part]] -= 1
            back = wrong @ w.T / WINDOWS
            w -= rate * mean.T @ wrong / len(part)
            b -= rate * 0.1 * wrong.mean(axis=0)
            # sums per bucket first: a scatter with repeated places is slow
            places, where = np.unique(x[part], return_inverse=True)
            doc = np.repeat(np.arange(len(part)), x.shape[1])
            weight = np.zeros((len(places), len(part)))
            np.add.at(weight, (where.ravel(), doc), 1.0)
            e[places] -= BUCKET_RATE * rate * weight @ back
    scores = e[x[held]].mean(axis=1) @ w + b
    losses = {}
    for t in np.geomspace(0.5, 10, 41):
        p = _softmax(scores / t)
        losses[t] = -np.log(np.maximum(p[np.arange(len(p)), y[held]], 1e-12)).mean()
    # of the temperatures that are as good, the most careful one
    best = min(losses.values())
    temperature = float(max(t for t, loss in losses.items() if loss <= best + 1e-3))
    sure = _softmax(scores / temperature).max(axis=1)
    level = float(min(SURE, np.quantile(sure, 1 - KEEP)))
    narrow = len(languages) <= DIMS
    return LanguageModel(languages, e @ w if narrow else e, None if narrow else w, b,
                         temperature, level)


def train(docs: DataFrame, usable: Column) -> LanguageModel:
    """The model of (doc_id, text, lang), learned from the rows where ``usable`` holds."""
    # as Arrow: lists of Python's numbers would take ten times the memory
    found = learning_rows(docs, usable).toArrow()
    windows = found.column("windows").combine_chunks()
    places, values = windows.offsets.to_numpy(), windows.values.to_numpy(zero_copy_only=False)
    return fit([{"lang": lang, "order": order, "windows": values[start:stop]}
                for lang, order, start, stop in zip(found.column("lang").to_pylist(),
                                                    found.column("order").to_pylist(),
                                                    places[:-1], places[1:])])


def _predictor(model: LanguageModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array(model.languages + ("und",), object)
        for batch in batches:
            for part in small_slices(batch, "text", SLICE):
                letters = part.column("letters").to_numpy(zero_copy_only=False)
                if model.languages:
                    p = model.probabilities(part.column("text"))
                    best, score = p.argmax(axis=1), p.max(axis=1)
                else:
                    best, score, letters = np.zeros(len(letters), int), np.zeros(len(letters)), \
                        np.zeros(len(letters), bool)
                best = np.where(letters, best, len(names) - 1)
                score = np.where(letters, score, 0.0)
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), pa.array(names[best], pa.string()),
                     pa.array(np.clip(score, 0.0, 1.0)),
                     pa.array(~letters | (score < model.level))],
                    names=["row", "lang_pred", "score", "rejected"])
    return run


def predict(docs: DataFrame, model: LanguageModel, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``docs`` with lang_pred, score and rejected.

    Only the text is looked at. A null text, and one without a letter, is ``und``
    with score 0 and rejected; so is every text where nothing could be learned.
    ``rejected`` also marks texts below the calibrated level. Repeated rows get
    the same answer each; an empty table gives no rows.
    """
    from pyspark.sql.types import StructType
    kept = StructType([docs.schema[c] for c in keep])
    rows = docs.select(F.struct(*keep).alias("row"), "text",
                       F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters"))
    schema = (StructType().add("row", kept).add("lang_pred", "string").add("score", "double")
              .add("rejected", "boolean"))
    return rows.mapInArrow(_predictor(model), schema).select(
        "row.*", "lang_pred", "score", "rejected")


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 4."""
    return F.pmod(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")), F.lit(4))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = train(docs, fold(F.col("doc_id")) != 2)
    held_out = F.coalesce(fold(F.col("doc_id")) == 2, F.lit(False))
    return predict(docs, model, ["doc_id"]).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")

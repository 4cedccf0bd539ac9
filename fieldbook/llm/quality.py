"""Quality of texts by supervised subword embeddings: hashed word and character n-grams, averaged, then softmax.

A text's features are its words, pairs of neighbouring words, and byte n-grams that may reach over word ends; each hashes
to a row of an embedding table.  The second word of a pair that repeats the first is written as "the same", so that
repetition is one feature whatever is repeated.  A text's vector is the mean of its features' rows, two outputs and a
softmax follow; rows and outputs are learned together by stochastic gradient descent in numpy.  A mean and a linear layer
can change places, so for scoring each row is first multiplied by the outputs: a text then costs one look-up a feature.

Learned from at most ``per_label`` labelled documents of each label, ``windows`` windows of each; all texts are scored whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fieldbook.llm import textbytes as tb
from fieldbook.llm.langid import held_out

#: lengths of byte n-grams
GRAMS = (1, 2, 3, 4)
#: bytes of text scored at a time
STEP = 1 << 20

_SAME = np.uint64(0x5851F42D4C957F2D)
_TIDY = np.arange(256, dtype=np.uint8)
_TIDY[[*range(0x09, 0x0E)]] = 0x20  # all white space is one letter


@dataclass(frozen=True)
class Settings:
    per_label: int = 1500
    windows: int = 2
    window_bytes: int = 500
    bits: int = 16
    dim: int = 10
    epochs: int = 6
    rate: float = 0.5
    batch: int = 16
    seed: int = 11


@dataclass
class Model:
    """``weight``: of each feature, its row times the difference of both outputs; ``bias`` of that difference."""

    weight: np.ndarray
    bias: float


def features(data: np.ndarray, offs: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row and hashed feature of words, word pairs and byte n-grams of texts, kind by kind."""
    data = _TIDY[data]
    shift = np.uint64(64 - bits)
    row_of = np.repeat(np.arange(len(offs) - 1), np.diff(offs))
    starts, ends, row = tb.words(data, offs)
    word = tb.span_hashes(data, starts, ends)
    yield row, (tb.mix(word + np.uint64(1)) >> shift).astype(np.int32)
    pair = row[1:] == row[:-1]
    second = np.where(word[1:] == word[:-1], _SAME, tb.mix(word[1:] + np.uint64(2)))
    first = np.where(word[1:] == word[:-1], _SAME, word[:-1])
    yield row[1:][pair], (tb.mix(first + second)[pair] >> shift).astype(np.int32)
    code = np.zeros(len(data), dtype=np.uint32)
    for n in range(1, max(GRAMS) + 1):
        at = len(data) - n + 1
        if at <= 0:
            return
        code = (code[:at] << np.uint32(8)) | data[n - 1 :]
        if n in GRAMS:
            inside = row_of[:at] == row_of[n - 1 :]
            mixed = (code[inside] + np.uint32(n)) * np.uint32(0x9E3779B1)
            mixed ^= mixed >> np.uint32(15)
            mixed *= np.uint32(0x85EBCA77)
            yield row_of[:at][inside], (mixed >> np.uint32(32 - bits)).astype(np.int32)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def _bags(texts: list[bytes], bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Of each text its distinct features and how often each occurs."""
    out = []
    for text in texts:
        found = [f for _, f in features(np.frombuffer(text, dtype=np.uint8), np.array([0, len(text)]), bits)]
        feature, times = np.unique(np.concatenate([np.zeros(0, dtype=np.int32), *found]), return_counts=True)
        out.append((feature, times.astype(np.float32)))
    return out


def train(texts: list[bytes], labels: np.ndarray, weights: np.ndarray, s: Settings) -> Model:
    """Stochastic gradient descent with falling rate; the same texts give the same model."""
    rng = np.random.default_rng(s.seed)
    bags = _bags(texts, s.bits)
    table = rng.uniform(-1 / s.dim, 1 / s.dim, (1 << s.bits, s.dim)).astype(np.float32)
    out, bias = np.zeros((s.dim, 2)), np.zeros(2)
    steps, done = s.epochs * -(-len(texts) // s.batch), 0
    for _ in range(s.epochs):
        shuffled = rng.permutation(len(texts))
        for lo in range(0, len(texts), s.batch):
            take = shuffled[lo : lo + s.batch]
            rate = s.rate * (1 - done / steps)
            done += 1
            used, column = np.unique(np.concatenate([bags[i][0] for i in take]), return_inverse=True)
            row = np.repeat(np.arange(len(take)), [len(bags[i][0]) for i in take])
            share = np.zeros((len(take), len(used)), dtype=np.float32)  # of each feature in its text
            share[row, column] = np.concatenate([bags[i][1] / bags[i][1].sum() for i in take])
            mean = share @ table[used]
            z = mean @ out + bias
            q = np.exp(z - z.max(axis=1, keepdims=True))
            q /= q.sum(axis=1, keepdims=True)
            q[np.arange(len(take)), labels[take]] -= 1
            q *= weights[take][:, None]
            back = (q @ out.T).astype(np.float32)
            out -= rate * mean.T @ q
            bias -= rate * q.sum(axis=0)
            table[used] -= np.float32(rate * s.dim) * (share.T @ back)
    return Model((table @ (out[:, 1] - out[:, 0])).astype(np.float32), float(bias[1] - bias[0]))


def logits(model: Model, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Of each text the mean weight of its features; a text without features has the bias alone."""
    bits = len(model.weight).bit_length() - 1
    rows = len(offs) - 1
    total, count = np.zeros(rows), np.zeros(rows)
    for row, feature in features(data, offs, bits):
        total += np.bincount(row, weights=model.weight[feature], minlength=rows)
        count += np.bincount(row, minlength=rows)
    return total / np.maximum(count, 1) + model.bias


def _windows(s: Settings):
    """A short text whole, of a longer one windows at random places, which follow from the row's hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, h in zip(batch.column("text").to_pylist(), batch.column("h").to_pylist(), strict=True):
                raw = (text or "").encode()
                if len(raw) <= s.window_bytes:
                    out.append([raw])
                    continue
                starts = np.random.default_rng(h & 0x7FFFFFFFFFFFFFFF).integers(0, len(raw) - s.window_bytes + 1, s.windows)
                out.append([raw[i : i + s.window_bytes] for i in starts])
            yield pa.RecordBatch.from_arrays([batch.column("quality"), batch.column("h"), pa.array(out, pa.list_(pa.binary()))], ["quality", "h", "windows"])

    return run


def learn(docs: DataFrame, labels: DataFrame, settings: Settings | None = None) -> Model | None:
    """A model from ``docs(doc_id, text)`` and ``labels(doc_id, quality)``; None where nothing is labelled.

    Learned from: labels 0 and 1 of documents that are not held out.  The sample is the labelled ids of least hash, at
    most ``per_label`` of each label; a label repeated for an id counts once, one with both labels counts for both.
    Each label weighs as much as it is frequent, so scores are shares of label 1 among such texts.
    """
    s = settings or Settings()
    usable = labels.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")) & F.col("quality").isin(0, 1))
    usable = usable.select("doc_id", F.col("quality").cast("int").alias("quality")).distinct()
    counts = {r["quality"]: r["n"] for r in usable.groupBy("quality").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return None
    spark = docs.sparkSession
    h = F.xxhash64("doc_id", F.lit(s.seed))
    shares = spark.createDataFrame([(q, min(1.0, 1.5 * s.per_label / n + 20 / n)) for q, n in counts.items()], "quality int, share double")
    near = usable.withColumn("h", h).join(F.broadcast(shares), "quality").where(F.pmod("h", F.lit(1_000_003)) < F.col("share") * 1_000_003)
    place = F.row_number().over(W.partitionBy("quality").orderBy("h", "doc_id"))
    picked = near.withColumn("place", place).where(F.col("place") <= s.per_label)  # at most two labels times per_label
    texts = docs.select("doc_id", "text").join(F.broadcast(picked.select("doc_id", "quality", "h")), "doc_id")
    rows = texts.select("quality", "h", "text").mapInArrow(_windows(s), "quality int, h long, windows array<binary>").collect()
    rows.sort(key=lambda r: (r["h"], r["quality"], r["windows"]))
    flat = [(bytes(w), r["quality"], 1 / len(r["windows"])) for r in rows for w in r["windows"]]
    if not flat:
        return None
    y = np.array([q for _, q, _ in flat])
    weight = np.array([w for _, _, w in flat])
    for q in (0, 1):
        if (y == q).any():
            weight[y == q] *= counts[q] / weight[y == q].sum()
    return train([t for t, _, _ in flat], y, weight * len(weight) / weight.sum(), s)


def _scored(shared: Broadcast, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in tb.chunks(batches, "text", STEP):
            if model is None:
                score = np.full(batch.num_rows, 0.5)
            else:
                score = _sigmoid(logits(model, *tb.text_buffer(batch.column("text"))))
            yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in names), pa.array(score)], [*names, "score"])

    return run


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher: label 1 likelier) and ``predicted`` (1 from 0.5 on); only ``text`` is looked at, all of it.

    Null texts score as empty ones: what the model makes of a text without features.  Without a model all score 0.5.
    Equal texts get equal scores; repeated rows and null ids stay; columns of ``docs`` named ``score`` or ``predicted``
    are replaced; an empty table gives an empty table.  The model (one number a feature) is broadcast.
    """
    names = [c for c in docs.columns if c not in ("score", "predicted")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name in names)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(*names).mapInArrow(_scored(shared, names), schema + ", score double")
    return rows.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))

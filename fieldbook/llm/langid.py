"""Language identification by a small byte convolutional network, trained and applied in numpy.

Text bytes (A-Z lower-cased) are cut into windows of fixed length.  Filters of several widths look at each place, the
strongest answer of each filter in a window is kept, and a softmax layer turns these into language scores; a document's
score is the mean over its windows, weighted by their bytes.  The first layer acts on one-hot bytes, so it is a sum of
table rows: two bytes at a time when the network is applied.

Training needs a bounded sample only: at most ``per_language`` documents of each language, ``windows`` windows of each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fieldbook.llm import textbytes as tb

UNDETERMINED = "und"
WINDOW = 256
WIDTHS = (2, 3, 4)
#: bytes of text padded at a time, and of these scored at a time
STEP = 1 << 19
PART = 1 << 17
_tables: dict[int, list] = {}


@dataclass(frozen=True)
class Settings:
    per_language: int = 400
    windows: int = 4
    most_languages: int = 500
    filters: int = 8
    epochs: int = 10
    batch: int = 64
    rate: float = 0.01
    seed: int = 7


@dataclass
class Network:
    languages: list[str]
    tables: list[np.ndarray]  # for each width: width x 256 x filters
    bias: np.ndarray  # of the filters, all widths
    out: np.ndarray  # filters of all widths x languages
    out_bias: np.ndarray
    key: int = field(default=0)


def held_out(doc_id: Column, parts: int = 3) -> Column:
    """Whether a document is kept from training; false without an id (which is not learned from either)."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % parts == 1, F.lit(False))


def has_letter(text: Column) -> Column:
    return F.coalesce(F.rlike(text, F.lit(r"\p{L}")), F.lit(False))


def padded(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts, each followed by zeros up to whole windows; the row and the number of text bytes of each window."""
    size = np.diff(offs)
    per = (size + WIDTHS[-1] - 1 + WINDOW - 1) // WINDOW
    start = np.concatenate(([0], np.cumsum(per * WINDOW)))
    out = np.zeros(start[-1] + WIDTHS[-1], dtype=np.uint8)
    place = np.arange(len(data)) + np.repeat(start[:-1] - offs[:-1], size)
    out[place] = tb.LOWER[data]
    row = np.repeat(np.arange(len(size)), per)
    number = np.arange(len(row)) - np.repeat(np.cumsum(per) - per, per)
    return out, row, np.clip(size[row] - number * WINDOW, 0, WINDOW)


def _pooled(net: Network, data: np.ndarray) -> np.ndarray:
    """Each filter's strongest answer in each window of padded bytes."""
    pairs = _tables.get(net.key)
    if pairs is None:
        two = lambda a, b: (a[:, None, :] + b[None, :, :]).reshape(65536, -1)
        t2, t3, t4 = net.tables
        pairs = [two(t2[0], t2[1]), two(t3[0], t3[1]), t3[2], two(t4[0], t4[1]), two(t4[2], t4[3])]
        _tables.clear()
        _tables[net.key] = pairs
    n = len(data) - WIDTHS[-1]
    wide = data.astype(np.int32)
    code = (wide[:-1] << 8) | wide[1:]
    at = code[:n]
    answers = []
    for width in range(3):
        if width == 0:
            a = pairs[0].take(at, axis=0)
        elif width == 1:
            a = pairs[1].take(at, axis=0)
            a += pairs[2].take(data[2 : n + 2], axis=0)
        else:
            a = pairs[3].take(at, axis=0)
            a += pairs[4].take(code[2 : n + 2], axis=0)
        a = a.reshape(-1, WINDOW, a.shape[1])
        while a.shape[1] > 1:
            half = a.shape[1] // 2
            a = np.maximum(a[:, :half], a[:, half:])
        answers.append(a[:, 0])
    return np.concatenate(answers, axis=1)


def logits(net: Network, data: np.ndarray) -> np.ndarray:
    return np.maximum(_pooled(net, data) + net.bias, 0) @ net.out + net.out_bias


def train(windows: list[bytes], labels: list[str], settings: Settings) -> Network:
    """Adam on cross entropy; the same windows give the same network."""
    rng = np.random.default_rng(settings.seed)
    languages = sorted(set(labels))
    y = np.searchsorted(languages, labels)
    f, n = settings.filters, len(windows)
    x = np.zeros((n, WINDOW + WIDTHS[-1]), dtype=np.uint8)
    for i, w in enumerate(windows):
        x[i, : len(w)] = np.frombuffer(w, dtype=np.uint8)
    x = tb.LOWER[x]
    shapes = [(w, 256, f) for w in WIDTHS] + [(3 * f,), (3 * f, len(languages)), (len(languages),)]
    p = [rng.normal(0, 0.3 if len(s) == 3 else 0.5 if len(s) == 2 else 0, s).astype(np.float32) for s in shapes]
    first, second = [np.zeros_like(v) for v in p], [np.zeros_like(v) for v in p]
    weight = 1 / np.bincount(y, minlength=len(languages))
    step = 0
    for _ in range(settings.epochs):
        order = rng.permutation(n)
        for lo in range(0, n, settings.batch):
            take = order[lo : lo + settings.batch]
            rows, b = np.arange(len(take))[:, None], x[take]
            best, where = [], []
            for t, width in zip(p[:3], WIDTHS, strict=True):
                a = sum(t[j][b[:, j : j + WINDOW]] for j in range(width))
                at = a.argmax(axis=1)
                where.append(at)
                best.append(np.take_along_axis(a, at[:, None], axis=1)[:, 0])
            pre = np.concatenate(best, axis=1) + p[3]
            hidden = np.maximum(pre, 0)
            z = hidden @ p[4] + p[5]
            q = np.exp(z - z.max(axis=1, keepdims=True))
            q /= q.sum(axis=1, keepdims=True)
            q[np.arange(len(take)), y[take]] -= 1
            w = weight[y[take]]
            q *= (w / w.sum())[:, None]
            back = (q @ p[4].T) * (pre > 0)
            grads = [np.zeros_like(t) for t in p[:3]] + [back.sum(axis=0), hidden.T @ q, q.sum(axis=0)]
            for i, width in enumerate(WIDTHS):
                part = back[:, i * f : (i + 1) * f]
                for j in range(width):
                    np.add.at(grads[i][j], (b[rows, where[i] + j], np.arange(f)[None, :]), part)
            step += 1
            for v, g, m, s in zip(p, grads, first, second, strict=True):
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                v -= settings.rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    return Network(languages, p[:3], p[3], p[4], p[5], int(rng.integers(1 << 60)))


def learn(docs: DataFrame, settings: Settings | None = None) -> Network | None:
    """A network from the training part of ``docs(doc_id, text, lang)``; None if nothing can be learned from.

    Learned from: documents that are not held out, with an id, a language and a letter.  The sample is the documents
    of least hash, at most ``per_language`` of each of the ``most_languages`` most frequent languages.
    """
    s = settings or Settings()
    usable = docs.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & has_letter(F.col("text")))
    counts = usable.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(s.most_languages)
    wanted = {r["lang"]: r["count"] for r in counts.collect()}
    if not wanted:
        return None
    spark = docs.sparkSession
    shares = spark.createDataFrame([(lang, min(1.0, 2 * s.per_language / n + 20 / n)) for lang, n in wanted.items()], "lang string, share double")
    hashed = usable.select("lang", "text", F.xxhash64("doc_id", "text").alias("h")).join(F.broadcast(shares), "lang")
    near = hashed.where(F.pmod("h", F.lit(1_000_003)) < F.col("share") * 1_000_003)
    place = F.row_number().over(W.partitionBy("lang").orderBy(F.pmod("h", F.lit(1_000_003)), "h"))
    picked = near.select("lang", "h", "text").mapInArrow(_sampled_rows(s.windows), "lang string, h long, windows array<binary>")
    rows = picked.withColumn("place", place).where(F.col("place") <= s.per_language).select("lang", "windows", "place").collect()
    rows.sort(key=lambda r: (r["lang"], r["place"]))
    return train([bytes(w) for r in rows for w in r["windows"]], [r["lang"] for r in rows for _ in r["windows"]], s)


def _sampled_rows(windows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, h in zip(batch.column("text").to_pylist(), batch.column("h").to_pylist(), strict=True):
                raw = text.encode()
                starts = np.random.default_rng(h & 0x7FFFFFFFFFFFFFFF).integers(0, max(1, len(raw) - WINDOW // 2), windows)
                out.append([raw[i : i + WINDOW] for i in starts])
            yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("h"), pa.array(out, pa.list_(pa.binary()))], ["lang", "h", "windows"])

    return run


def _tagged(net: Network | None, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tb.chunks(batches, "text", STEP):
            n = batch.num_rows
            lang = np.full(n, UNDETERMINED, dtype=object)
            score = np.zeros(n)
            letter = batch.column("has_letter").to_numpy(zero_copy_only=False)
            if net is not None and letter.any():
                data, row, weight = padded(*tb.text_buffer(batch.column("text")))
                z = np.zeros((n, len(net.languages)))
                total = np.zeros(n)
                step = PART // WINDOW
                for lo in range(0, len(row), step):
                    part = slice(lo, min(lo + step, len(row)))
                    answer = logits(net, data[part.start * WINDOW : part.stop * WINDOW + WIDTHS[-1]])
                    np.add.at(z, row[part], answer * weight[part, None])
                    np.add.at(total, row[part], weight[part])
                z /= np.maximum(total, 1)[:, None]
                z = np.exp(z - z.max(axis=1, keepdims=True))
                z /= z.sum(axis=1, keepdims=True)
                best = z.argmax(axis=1)
                lang[letter] = np.array(net.languages, dtype=object)[best[letter]]
                score[letter] = z[np.arange(n), best][letter]
            yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in names), pa.array(lang, pa.string()), pa.array(score)], [*names, "lang_pred", "score"])

    return run


def tag(docs: DataFrame, net: Network | None) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (0 to 1); only ``text`` is looked at, all of it.

    Null texts, texts without a letter, and all texts without a network get ``und`` and 0.  Equal texts get equal
    answers, ties between languages go to the first in order; empty tables give empty tables.  Columns of ``docs``
    named ``lang_pred``, ``score`` or ``has_letter`` are replaced or dropped.
    """
    names = [c for c in docs.columns if c not in ("lang_pred", "score", "has_letter")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name in names)
    rows = docs.select(*names, has_letter(F.col("text")).alias("has_letter"))
    return rows.mapInArrow(_tagged(net, names), schema + ", lang_pred string, score double")

"""Language identification: averaged hashed subword embeddings under a linear softmax, with calibrated rejection.

A text is lower-cased and reduced to letters and single blanks. Its subwords are the runs of two to four characters
that have no blank inside, hashed into ``BUCKETS``. A text's vector is the mean of its subwords' embeddings; a linear
layer and a softmax give the languages. Embeddings and layer are trained together by mini-batch gradient descent in
numpy on the driver, on at most ``SAMPLE`` labelled rows (the bound, chosen by a hash, equally many of each language;
whole texts and one short passage each). A fifth of the sample is kept out of training to fit the softmax temperature
and the rejection threshold, the latter against languages left out in turn and shuffled letters. Prediction covers every
row and whole texts, in the tasks.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feira.llm.common import col, ship, small_batches

BUCKETS = 4096
DIMENSIONS = 16
SAMPLE = 3200
LANGUAGES = 200
EPOCHS = 30
#: One sampled row in so many also gives a text of shuffled letters.
JUNK = 8
UNKNOWN = "und"
#: Share of rightly classified calibration texts that rejection may cost at most, and share of texts in none of the
#: learned languages that it is meant to reject.
REJECT_SHARE, CATCH_SHARE = 0.002, 0.99

_letters: list[np.ndarray] = []


def _codes(text: str) -> np.ndarray:
    """Code points of the lower-cased letters with one blank between, before and behind words; empty without letters."""
    if not _letters:
        _letters.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    raw = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters[0][raw]
    if not letter.any():
        return np.zeros(0, np.uint32)
    codes = np.where(letter, raw, 32).astype(np.uint32)
    codes = np.concatenate([[32], codes, [32]]).astype(np.uint32)
    blank = codes == 32
    return codes[np.append(True, ~(blank[1:] & blank[:-1]))]


def features(codes: np.ndarray, buckets: int = BUCKETS) -> np.ndarray:
    """Share of each bucket among the subwords of a text."""
    counts = np.zeros(buckets, np.float32)
    inner = codes != 32
    mixed = codes * np.uint32(0x9E3779B1)
    ok = None
    for n in (2, 3, 4):
        if len(codes) < n:
            break
        m = len(codes) - n + 1
        mixed = (mixed[:m] ^ (mixed[:m] >> np.uint32(15))) * np.uint32(0x85EBCA6B) + codes[n - 1 :] * np.uint32(0xC2B2AE35)
        if n > 2:
            ok = inner[1 : m + 1] if ok is None else ok[:m] & inner[n - 2 : n - 2 + m]
        spread = ((mixed ^ (mixed >> np.uint32(16))) * np.uint32(0x7FEB352D)) >> np.uint32(32 - (buckets.bit_length() - 1))
        counts += np.bincount(spread if ok is None else spread[ok], minlength=buckets)
    total = counts.sum()
    return counts / total if total else counts


class Model(NamedTuple):
    languages: list[str]
    weights: np.ndarray  # embeddings times linear layer
    bias: np.ndarray
    temperature: float
    threshold: float

    def judge(self, text: str | None) -> tuple[str, float, bool]:
        """Language, its probability, and whether the text is rejected: its best logit is under the threshold.

        Subwords of no learned language have embeddings that training hardly moved, so the logits of a strange text
        are small, while the softmax, which sees only differences, may still be sure.
        """
        codes = _codes(text or "")
        if not len(codes) or not self.languages:
            return UNKNOWN, 0.0, True
        logits = features(codes) @ self.weights + self.bias
        best = int(logits.argmax())
        p = float(_softmax(logits[None, :] / self.temperature)[0, best])
        return self.languages[best], min(1.0, p), bool(logits[best] < self.threshold)

    def predict(self, text: str | None) -> tuple[str, float]:
        return self.judge(text)[:2]


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _descend(x: np.ndarray, y: np.ndarray, classes: int, epochs: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Weights (embeddings times linear layer) and bias after stochastic gradient descent over rows x, classes y."""
    embed = rng.normal(0, 0.5, (x.shape[1], DIMENSIONS)).astype(np.float32)
    layer = np.zeros((DIMENSIONS, classes), np.float32)
    bias = np.zeros(classes, np.float32)
    used = np.arange(len(x))
    size, step = 32, 0
    steps = epochs * -(-len(used) // size)
    for _ in range(epochs):
        rng.shuffle(used)
        for begin in range(0, len(used), size):
            rows = used[begin : begin + size]
            rate = 1.0 - step / steps
            step += 1
            xb = x[rows].astype(np.float32)
            hidden = xb @ embed
            error = _softmax(hidden @ layer + bias)
            error[np.arange(len(rows)), y[rows]] -= 1
            error /= len(rows)
            back = error @ layer.T
            layer -= rate * 4 * (hidden.T @ error)
            bias -= rate * 0.1 * error.sum(axis=0)
            # Shares are small, so the embeddings need the longer step.
            embed -= rate * 200 * (xb.T @ back)
    return (embed @ layer).astype(np.float32), bias


def _temperature(logits: np.ndarray, y: np.ndarray) -> float:
    grid = np.geomspace(0.1, 20, 60)
    truth = (np.arange(len(y)), y)
    losses = [-np.log(np.maximum(_softmax(logits / t)[truth], 1e-12)).mean() for t in grid]
    return float(grid[int(np.argmin(losses))])


def _strange_logits(x: np.ndarray, y: np.ndarray, held: np.ndarray, used: np.ndarray, classes: int, epochs: int, seed: int) -> np.ndarray:
    """Best logits of calibration texts under models that never saw their language, one language left out in turn."""
    scores = []
    for out in range(classes):
        known = used[y[used] != out]
        if not (y[held] == out).any():
            continue
        names = np.unique(y[known])
        place = np.searchsorted(names, y)
        weights, bias = _descend(x[known], place[known], len(names), epochs, np.random.default_rng(seed + 1 + out))
        scores.append((x[held[y[held] == out]].astype(np.float32) @ weights + bias).max(axis=1))
    return np.concatenate(scores) if scores else np.zeros(0)


def train(
    x: np.ndarray, y: np.ndarray, languages: list[str], epochs: int = EPOCHS, seed: int = 7, junk: np.ndarray | None = None
) -> Model:
    """Fit on rows x (shares of buckets) with language numbers y; every fifth row calibrates.

    A best logit is rejected under a threshold half way between two quantiles: the logit under which ``CATCH_SHARE`` of
    the texts in none of the learned languages lie, that is calibration texts of a language under models that were fitted
    without it, and ``junk``, texts of shuffled letters; and the logit under which ``REJECT_SHARE`` of the rightly
    classified calibration texts lie. Where the two groups overlap, the latter decides, so rejection never costs more
    than that share. With fewer than three languages there is none to leave out and junk decides alone.
    """
    rng = np.random.default_rng(seed)
    classes = len(languages)
    order = rng.permutation(len(x))
    held, used = (order[::5], np.setdiff1d(order, order[::5])) if len(x) >= 10 * classes else (order, order)
    weights, bias = _descend(x[used], y[used], classes, epochs, rng)
    logits = x[held].astype(np.float32) @ weights + bias
    temperature = _temperature(logits, y[held])
    right = np.sort(logits.max(axis=1)[logits.argmax(axis=1) == y[held]])
    strange = [_strange_logits(x, y, held, used, classes, epochs, seed)] if classes > 2 else []
    if junk is not None and len(junk):
        strange.append((junk.astype(np.float32) @ weights + bias).max(axis=1))
    strange = np.sort(np.concatenate(strange)) if strange else np.zeros(0)
    bound = float(right[int(REJECT_SHARE * len(right))]) if len(right) else -np.inf
    caught = float(np.nextafter(strange[int(CATCH_SHARE * (len(strange) - 1))], np.float32(np.inf))) if len(strange) else -np.inf
    threshold = bound if caught >= bound or np.isinf(caught) else (caught + bound) / 2
    return Model(languages, weights, bias, temperature, threshold)


def _packed(shares: np.ndarray) -> bytes:
    """The buckets that occur and their shares, in a few bytes each."""
    at = np.flatnonzero(shares)
    return at.astype("<u2").tobytes() + shares[at].astype("<f2").tobytes()


def _unpacked(rows: list[bytes], buckets: int = BUCKETS) -> np.ndarray:
    """Half-precision matrix of packed rows."""
    x = np.zeros((len(rows), buckets), np.float16)
    for row, data in zip(x, rows, strict=True):
        half = len(data) // 2
        row[np.frombuffer(data, "<u2", half // 2)] = np.frombuffer(data, "<f2", half // 2, half)
    return x


def _sampled(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in small_batches([batch], "text"):
            place, lang, data = [], [], []
            columns = zip(*[part.column(c).to_pylist() for c in ("place", "lang", "text")], strict=True)
            for p, name, text in columns:
                codes = _codes(text)
                if not len(codes):
                    continue
                size = 20 + p % 160
                begin = (p >> 8) % max(1, len(codes) - size)
                pieces = [(name, codes), (name, codes[begin : begin + size])]
                if p % JUNK == 0:
                    # Its own letters in no order, as a text of no language.
                    pieces.append((None, np.random.default_rng(p).permutation(codes)))
                for whose, piece in pieces:
                    place.append(p)
                    lang.append(whose)
                    data.append(_packed(features(piece)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(place, pa.int64()), pa.array(lang, pa.string()), pa.array(data, pa.binary())],
                ["place", "lang", "x"],
            )


def fit(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE) -> Model:
    """Train on a bounded sample of the rows of ``df`` that have a text and a language.

    Of every language the ``sample`` / languages rows with the smallest hashes of id, text and arrival are taken, so rows
    that share an id or a text do not come or stay away together. Only the ``LANGUAGES`` most frequent values of the
    language column are learned. An empty sample gives a model that answers ``und``.
    """
    ship(df.sparkSession)
    arrival = F.monotonically_increasing_id()
    labelled = df.select(
        F.pmod(F.xxhash64(col(id_col), col(text_col), arrival, F.lit("langid")), F.lit(1 << 40)).alias("place"),
        col(lang_col).cast("string").alias("lang"),
        col(text_col).cast("string").alias("text"),
    ).filter("lang is not null and text is not null")
    counted = labelled.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES).collect()
    none = Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0, np.float32), 1.0, 0.0)
    if not counted:
        return none
    counts = {r[0]: r[1] for r in counted}
    each = max(1, sample // len(counts))
    # A little more than is needed reaches the ranking, so that it never sees a whole language.
    bound = F.create_map(*[F.lit(v) for k, n in counts.items() for v in (k, int((1 << 40) * min(1.0, 2 * each / n)))])
    chosen = labelled.filter(F.col("place") < bound[F.col("lang")])
    first = F.row_number().over(W.partitionBy("lang").orderBy("place", F.xxhash64("text")))
    chosen = chosen.withColumn("rank", first).filter(F.col("rank") <= each).drop("rank")
    found = chosen.mapInArrow(_sampled, "place bigint, lang string, x binary").collect()
    rows = sorted((r for r in found if r[1] is not None), key=lambda r: (r[0], r[1], bytes(r[2])))
    if not rows:
        return none
    languages = sorted({r["lang"] for r in rows})
    number = {name: i for i, name in enumerate(languages)}
    y = np.array([number[r["lang"]] for r in rows])
    junk = _unpacked([r["x"] for r in sorted(found, key=lambda r: (r[0], bytes(r[2]))) if r["lang"] is None])
    return train(_unpacked([r["x"] for r in rows]), y, languages, junk=junk)


def _scored(df: DataFrame, model: Model, text_col: str) -> DataFrame:
    """Columns c0, c1, ... of ``df`` in order (any names do), then lang, score and rejected."""
    ship(df.sparkSession)
    names = [f"c{i}" for i in range(len(df.columns))]
    text = names[df.columns.index(text_col)]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.judge(t.as_py()) for t in batch.column(text)]
            new = [
                pa.array([f[0] for f in found], pa.string()),
                pa.array([f[1] for f in found], pa.float64()),
                pa.array([f[2] for f in found], pa.bool_()),
            ]
            arrays = [*[batch.column(n) for n in names], *new]
            yield pa.RecordBatch.from_arrays(arrays, [*names, "lang", "score", "rejected"])

    work = df.select(*[col(c).alias(n) for c, n in zip(df.columns, names, strict=True)])
    new = T.StructType().add("lang", "string").add("score", "double").add("rejected", "boolean")
    return work.mapInArrow(run, T.StructType([*work.schema.fields, *new.fields]))


def predict(df: DataFrame, model: Model, text_col: str = "text", lang: str = "lang_pred", score: str = "score") -> DataFrame:
    """``df`` with the predicted language, its probability, and whether the prediction is rejected.

    ``und`` with score 0, and rejected: null, empty and letterless texts. Rejected as well: texts whose best logit is under
    the model's threshold. Columns of ``df`` with the names of the new ones are left out.
    """
    out = _scored(df, model, text_col)
    shown = [F.col(f"c{i}").alias(c) for i, c in enumerate(df.columns) if c.lower() not in (lang, score, "rejected")]
    return out.select(*shown, F.col("lang").alias(lang), F.col("score").alias(score), "rejected")


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(col(id_col).cast("string")) % 4 == 2, F.lit(False))


def keep_known(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows whose language is recognised, learned from the labelled rows of ``df`` that are not held out."""
    model = fit(df.filter(~held_out(id_col)), id_col, text_col, lang_col)
    kept = _scored(df, model, text_col).filter(~F.col("rejected"))
    return kept.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(df.columns)])

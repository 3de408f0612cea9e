"""Language identification with averaged hashed subword embeddings (operator 6)."""

from __future__ import annotations

import zlib
from collections.abc import Sequence
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forecourt.llm.common import cut_lineage, row_slices

UNDETERMINED = "und"
BUCKET_BITS = 12
DIMENSIONS = 16
GRAM_SIZES = (2, 3, 4)
SAMPLE_ROWS = 4000
RANK_PARTS = 64
EPOCHS = 6
BATCH_ROWS = 64
LEARNING_RATE = 8.0
CALIBRATION_SHARE = 0.2
REJECTED_SHARE = 0.001
SCORED_ROWS = 256
HOLD_OUT = (4, 2)  # of crc32(doc_id as text): modulus and held-out remainder

# ASCII letters lowered, bytes beyond ASCII kept, everything else is a word border.
_LETTERS = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
_CHUNK = 1 << 18


def gram_counts(text: str) -> np.ndarray:
    """How often each hashed subword of the whole text occurs.

    Subwords are 2 to 4 bytes of a lower-cased word with a border mark on either
    side. A text is counted in chunks, so memory does not grow with its length.
    """
    data = b" " + text.lower().encode().translate(_LETTERS) + b" "
    counts = np.zeros(1 << BUCKET_BITS, np.int64)
    for at in range(0, len(data), _CHUNK):
        octets = np.frombuffer(data, np.uint8)[at : at + _CHUNK + max(GRAM_SIZES) - 1]
        wide, border = octets.astype(np.uint32), octets == 32
        for size in GRAM_SIZES:
            n = min(len(octets) - size + 1, _CHUNK)
            if n <= 0:
                continue
            whole = ~(border[:n] & border[1 : n + 1]) if size == 2 else ~border[1 : n + 1]
            for k in range(2, size - 1):
                whole &= ~border[k : n + k]
            hashed = np.full(n, size, np.uint32)
            for k in range(size):
                hashed = hashed * np.uint32(0x01000193) ^ wide[k : n + k]
            hashed = (hashed ^ (hashed >> np.uint32(15))) * np.uint32(0x85EBCA6B)
            places = (hashed >> np.uint32(32 - BUCKET_BITS))[whole]
            counts += np.bincount(places, minlength=len(counts))
    return counts


def _averages(counts: np.ndarray) -> np.ndarray:
    """Rows of counts as weights of an average over a text's subwords."""
    totals = np.maximum(counts.sum(1, keepdims=True), 1)
    shares = np.empty(counts.shape, np.float32)  # filled piece by piece: no copy of twice the width
    return np.divide(counts, totals, out=shares, casting="same_kind")


def _packed(counts: np.ndarray) -> bytes:
    """Counts in two bytes each; larger ones are scaled together, which keeps their shares."""
    most = counts.max(initial=0)
    if most > 65_535:
        counts = np.rint(counts * (65_535 / most))
    return counts.astype("<u2").tobytes()


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


@dataclass
class LanguageModel:
    """Bucket embeddings, a linear layer, a temperature, and each language's score below which it rejects."""

    languages: list[str]
    embeddings: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    thresholds: Sequence[float] = ()

    def logits(self, counts: np.ndarray) -> np.ndarray:
        return _averages(counts) @ self.embeddings @ self.weights + self.bias

    def probabilities(self, counts: np.ndarray) -> np.ndarray:
        return _softmax(self.logits(counts) / self.temperature)

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float], list[bool]]:
        """Language, score and acceptance of each text; ``und`` and 0 where there is no letter."""
        names, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
        accepted = [False] * len(texts)
        asked = [i for i, t in enumerate(texts) if self.languages and has_letter(t)]
        for at in range(0, len(asked), SCORED_ROWS):
            rows = asked[at : at + SCORED_ROWS]
            found = self.probabilities(np.stack([gram_counts(texts[i]) for i in rows]))
            best = found.argmax(1)
            for i, k, p in zip(rows, best.tolist(), found.max(1).tolist(), strict=True):
                names[i], scores[i], accepted[i] = self.languages[k], p, p >= self.thresholds[k]
        return names, scores, accepted


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def train(
    counts: np.ndarray,
    labels: list[str],
    dimensions: int = DIMENSIONS,
    epochs: int = EPOCHS,
    rejected_share: float = REJECTED_SHARE,
    seed: int = 7,
) -> LanguageModel:
    """Fit on labelled counts by stochastic gradient descent, then calibrate on held-back rows.

    Rows come in the order of a hash. Every ``1 / CALIBRATION_SHARE``-th row of each
    language is held back, so rare languages are calibrated too. These rows set the
    temperature (least log loss) and each language's threshold: the score that
    ``rejected_share`` of the texts rightly named so stay below, or that of all
    languages together if it is lower: few scores don't reach far down.

    Averages are made of one batch at a time, so beside ``counts`` little memory is
    taken: the driver trains, and all averages would be several times the counts.
    """
    languages = sorted(set(labels))
    if not languages:
        none = np.zeros((1 << BUCKET_BITS, dimensions), np.float32)
        return LanguageModel([], none, np.zeros((dimensions, 0)), np.zeros(0))
    target = np.array([languages.index(label) for label in labels])
    held = _held_back(target, len(languages))
    fit = np.flatnonzero(~held)
    rng = np.random.default_rng(seed)
    embeddings = rng.normal(0, 0.1, (counts.shape[1], dimensions)).astype(np.float32)
    weights = rng.normal(0, 0.1, (dimensions, len(languages))).astype(np.float32)
    bias = np.zeros(len(languages), np.float32)
    share = np.bincount(target[fit], minlength=len(languages)) / max(len(fit), 1)
    worth = (1 / np.maximum(share * len(languages), 0.05)).astype(np.float32)
    steps, step = epochs * -(-len(fit) // BATCH_ROWS), 0
    for _ in range(epochs):
        order = rng.permutation(fit)
        for at in range(0, len(order), BATCH_ROWS):
            rows = order[at : at + BATCH_ROWS]
            rate = LEARNING_RATE * (1 - step / steps)
            step += 1
            x, y = _averages(counts[rows]), target[rows]
            hidden = x @ embeddings
            error = _softmax(hidden @ weights + bias)
            error[np.arange(len(rows)), y] -= 1
            error *= worth[y][:, None] / len(rows)
            back = error @ weights.T
            weights -= np.float32(0.1 * rate) * (hidden.T @ error)
            bias -= np.float32(0.1 * rate) * error.sum(0)
            embeddings -= np.float32(50 * rate) * (x.T @ back)
    model = LanguageModel(languages, embeddings, weights, bias, 1.0, [0.0] * len(languages))
    if held.any():
        _calibrate(model, counts[held], target[held], rejected_share)
    return model


def _held_back(target: np.ndarray, languages: int) -> np.ndarray:
    """Every fifth row of each language, by its place among them; the first four are learned from."""
    every = round(1 / CALIBRATION_SHARE)
    held = np.zeros(len(target), bool)
    for language in range(languages):
        held[np.flatnonzero(target == language)[every - 1 :: every]] = True
    return held


def _calibrate(model: LanguageModel, counts: np.ndarray, target: np.ndarray, share: float) -> None:
    logits = model.logits(counts)

    def loss(temperature: float) -> float:
        p = _softmax(logits / temperature)[np.arange(len(target)), target]
        return float(-np.log(np.maximum(p, 1e-12)).mean())

    model.temperature = min((float(t) for t in np.geomspace(0.1, 10, 41)), key=loss)
    found = _softmax(logits / model.temperature)
    named, scores = found.argmax(1), found.max(1).astype(float)
    right = named == target
    if not right.any():
        return
    limits = [_lower_limit(scores[right], share)] * len(model.languages)
    for language in range(len(limits)):
        own = scores[right & (named == language)]
        if len(own) > 1:
            limits[language] = min(limits[language], _lower_limit(own, share))
    model.thresholds = limits


def _lower_limit(scores: np.ndarray, share: float) -> float:
    """The score that ``share`` of the texts stay below, as ``scores`` tell.

    Fewer than 1 / share scores don't reach that far down: for them it is the
    prediction limit of Student's t on their logits, if that is lower.
    """
    limit, n = float(np.quantile(scores, share)), len(scores)
    if n * share >= 1:
        return limit
    if n < 2:
        return 0.0
    sure = np.clip(scores, 1e-9, 1 - 1e-9)
    logits = np.log(sure / (1 - sure))
    z, free = NormalDist().inv_cdf(1 - share), n - 1
    t = z + (z**3 + z) / (4 * free) + (5 * z**5 + 16 * z**3 + 3 * z) / (96 * free**2)
    tail = logits.mean() - t * logits.std(ddof=1) * np.sqrt(1 + 1 / n)
    return min(limit, float(1 / (1 + np.exp(-tail))))


def _fold() -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % HOLD_OUT[0]


def held_out() -> Column:
    return F.coalesce(_fold() == HOLD_OUT[1], F.lit(False))


def fit(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> LanguageModel:
    """Train on a bounded sample of the labelled rows outside the held-out fold.

    ``sample_rows`` (4000) is the bound on rows that reach the driver, as 8 KB of
    subword counts each, compressed on the way. Languages take turns, each in the order of a hash of the
    ids, so rare ones are not lost. Only ``text`` and ``lang`` are used. Rows
    without id, language or letter are not learned from; of rows with one id, one.
    """
    labelled = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    labelled = labelled.filter(_fold() != HOLD_OUT[1]).select(
        F.col("doc_id").cast("bigint").alias("__id"),
        F.col("lang").cast("string").alias("__lang"),
        F.xxhash64(F.col("doc_id").cast("bigint")).alias("__hash"),
    )
    # Ranked in parts of a language first: what is left of each part is bounded, so that
    # the rows of a frequent language don't meet in one task.
    part = F.pmod("__hash", F.lit(RANK_PARTS))
    rough = F.row_number().over(Window.partitionBy("__lang", part).orderBy("__hash", "__id"))
    turn = F.row_number().over(Window.partitionBy("__lang").orderBy("__hash", "__id"))
    chosen = (
        labelled.withColumn("__rough", rough)
        .filter(F.col("__rough") <= -(-4 * sample_rows // RANK_PARTS))
        .withColumn("__turn", turn)
        .filter(F.col("__turn") <= sample_rows)
        .orderBy("__turn", "__lang")
        .limit(sample_rows)
        .select("__id", "__lang", "__turn")
        .distinct()
    )
    chosen = cut_lineage(chosen)

    def count(batches):
        for batch in batches:
            for rows in row_slices(batch, "text"):
                texts = rows.column("text").to_pylist()
                keep = [i for i, t in enumerate(texts) if has_letter(t)]
                packed = [zlib.compress(_packed(gram_counts(texts[i])), 1) for i in keep]
                some = rows.take(pa.array(keep, pa.int64()))
                yield pa.record_batch(
                    {
                        "turn": some.column("__turn"),
                        "lang": some.column("__lang"),
                        "counts": pa.array(packed, pa.binary()),
                    }
                )

    texts = docs.select(F.col("doc_id").cast("bigint").alias("__id"), "text")
    sampled = texts.join(F.broadcast(chosen), "__id").dropDuplicates(["__turn", "__lang"])
    sampled = sampled.select("__turn", "__lang", "text")
    rows = sampled.mapInArrow(count, "turn int, lang string, counts binary").collect()
    rows.sort(key=lambda r: (r["turn"], r["lang"]))
    labels = [r["lang"] for r in rows]
    counts = np.empty((len(rows), 1 << BUCKET_BITS), "<u2")
    for place in reversed(range(len(rows))):
        counts[place] = np.frombuffer(zlib.decompress(rows.pop()["counts"]), "<u2")
    return train(counts, labels)


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, accepted`` of every row, from its whole text.

    ``lang_pred`` is a learned language; ``und`` with score 0 where the text is
    null or has no letter, or nothing was learned. ``accepted`` is false for
    those and where the calibrated score is below its language's threshold.
    Repeated rows each get a row; a null id is never held out.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), held_out().alias("held_out"), "text"
    )

    def score(batches):
        for batch in batches:
            for part in row_slices(batch, "text"):
                names, scores, accepted = shared.value.predict(part.column("text").to_pylist())
                yield pa.record_batch(
                    {
                        "doc_id": part.column("doc_id"),
                        "held_out": part.column("held_out"),
                        "lang_pred": pa.array(names, pa.string()),
                        "score": pa.array(scores, pa.float64()),
                        "accepted": pa.array(accepted, pa.bool_()),
                    }
                )

    return rows.mapInArrow(
        score, "doc_id bigint, held_out boolean, lang_pred string, score double, accepted boolean"
    )


def keep_accepted(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """The rows of ``docs`` whose language the model accepts, unchanged."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def choose(batches):
        for batch in batches:
            for part in row_slices(batch, "text"):
                accepted = shared.value.predict(part.column("text").to_pylist())[2]
                yield part.filter(pa.array(accepted, pa.bool_()))

    return docs.mapInArrow(choose, docs.schema)

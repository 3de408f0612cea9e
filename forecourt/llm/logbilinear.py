"""Language-model scores from a log-bilinear model trained by noise contrast (operator 7)."""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from forecourt.llm.common import cut_lineage, row_slices

HOLD_OUT = (5, 1)  # of crc32(doc_id as text): modulus and held-out remainder
CLASSES = 512
SUFFIX_CLASSES = 128
HEAD_WORDS = 100_000
CONTEXT = 2
DIMENSIONS = 16
NOISE = 64
BATCH_TOKENS = 2048
RATE = 0.05
WARM_DOCS = 400
WARM_EPOCHS = 2
FLUSH_WORDS = 200_000
CACHED_WORDS = 150_000
SCORED_CHARS = 500_000
BLOCKS = 64
END = 0


def tokens_of(text: str | None) -> list[bytes]:
    """Words with A-Z lowered, as UTF-8; the end is not among them."""
    return (text or "").encode().lower().split()


def held_out() -> Column:
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % HOLD_OUT[0]
    return F.coalesce(fold == HOLD_OUT[1], F.lit(False))


def suffix_class(word: bytes) -> int:
    """The class of a rarer word, from its last two bytes."""
    first_suffix = CLASSES - SUFFIX_CLASSES
    return first_suffix + (word[-1] * 31 + (word[-2] if len(word) > 1 else 0) * 7) % SUFFIX_CLASSES


class _Codes(dict):
    """Codes of words: a head word's place, or beyond the head the class of a rarer word."""

    def __init__(self, head: list[bytes]):
        super().__init__((word, place) for place, word in enumerate(head))
        self.n_head, self.bound = len(head), len(head) + CACHED_WORDS

    def __missing__(self, word: bytes) -> int:
        code = self.n_head + suffix_class(word) - (CLASSES - SUFFIX_CLASSES)
        if len(self) < self.bound:
            self[word] = code
        return code


@dataclass
class Vocabulary:
    """The counts a score needs: totals, the most frequent words, and sums by suffix class.

    The first ``CLASSES - SUFFIX_CLASSES - 1`` head words are classes of their
    own; all other words belong to the class of their last letters.
    """

    n_tokens: int
    n_distinct: int
    n_ends: int
    head: list[bytes]
    head_counts: np.ndarray
    class_tokens: np.ndarray
    class_words: np.ndarray
    codes: _Codes | None = field(default=None, repr=False)

    @property
    def own_classes(self) -> int:
        return min(len(self.head), CLASSES - SUFFIX_CLASSES - 1)

    def tables(self) -> dict[str, np.ndarray]:
        """By code: class, log10(count + 1/2), and log10 of the class's denominator."""
        own = self.own_classes
        suffix = np.array([suffix_class(word) for word in self.head[own:]], np.int64)
        rare = np.arange(CLASSES - SUFFIX_CLASSES, CLASSES)
        of_class = np.concatenate((np.arange(1, own + 1), suffix, rare))
        below = np.log10(self.class_tokens + 0.5 * (self.class_words + 1))
        counted = np.log10(self.head_counts + 0.5)
        return {
            "class": of_class,
            "count": np.concatenate((counted, np.zeros(SUFFIX_CLASSES))),
            "inside": np.concatenate((np.zeros(own), counted[own:], np.zeros(SUFFIX_CLASSES))),
            "below": np.concatenate((np.zeros(own), below[of_class[own:]])),
        }

    def class_share(self) -> np.ndarray:
        """The unigram distribution of the classes, none of them zero."""
        counts = self.class_tokens.astype(np.float64) + 0.5
        counts[END] += self.n_ends
        counts[1 : self.own_classes + 1] += self.head_counts[: self.own_classes]
        return counts / counts.sum()

    def encode(self, text: str | None) -> tuple[list[bytes], np.ndarray]:
        if self.codes is None:
            self.codes = _Codes(self.head)
        words = tokens_of(text)
        return words, np.fromiter(map(self.codes.__getitem__, words), np.int64, len(words))

    def __getstate__(self):
        return self.__dict__ | {"codes": None}


@dataclass
class LogBilinear:
    """p(class | two classes before): softmax of (sum of scaled context vectors) · target + bias."""

    targets: np.ndarray
    contexts: np.ndarray
    scales: np.ndarray
    bias: np.ndarray
    log_z: np.ndarray | None = None

    @classmethod
    def start(cls, share: np.ndarray, seed: int = 11) -> LogBilinear:
        rng = np.random.default_rng(seed)
        shape = (CLASSES, DIMENSIONS)
        return cls(
            rng.normal(0, 0.1, shape).astype(np.float32),
            rng.normal(0, 0.1, shape).astype(np.float32),
            np.ones((CONTEXT, DIMENSIONS), np.float32),
            np.log(share).astype(np.float32),
        )

    def vector(self) -> np.ndarray:
        parts = (self.targets, self.contexts, self.scales, self.bias)
        return np.concatenate([p.ravel() for p in parts])

    @classmethod
    def of_vector(cls, vector: np.ndarray) -> LogBilinear:
        n = CLASSES * DIMENSIONS
        cuts = np.split(
            vector.astype(np.float32), [n, 2 * n, 2 * n + CONTEXT * DIMENSIONS]
        )
        shape = (CLASSES, DIMENSIONS)
        return cls(
            cuts[0].reshape(shape),
            cuts[1].reshape(shape),
            cuts[2].reshape(CONTEXT, DIMENSIONS),
            cuts[3],
        )

    def normalise(self) -> None:
        """log Z of every context, by batched matrix products over all pairs of classes."""
        first, second = self.contexts * self.scales[0], self.contexts * self.scales[1]
        self.log_z = np.empty((CLASSES, CLASSES), np.float32)
        for before_last in range(CLASSES):
            logits = (first[before_last] + second) @ self.targets.T + self.bias
            top = logits.max(1)
            self.log_z[before_last] = top + np.log(np.exp(logits - top[:, None]).sum(1))

    def log_probabilities(self, before: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Natural log p(target | before); ``before`` has the two classes before each token."""
        hidden = (self.contexts * self.scales[0])[before[:, 0]]
        hidden = hidden + (self.contexts * self.scales[1])[before[:, 1]]
        score = np.einsum("ij,ij->i", hidden, self.targets[target]) + self.bias[target]
        return score - self.log_z[before[:, 0], before[:, 1]]


def _scatter(places: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Row sums of ``values`` by class."""
    flat = (places[:, None] * DIMENSIONS + np.arange(DIMENSIONS)).ravel()
    sums = np.bincount(flat, weights=values.ravel(), minlength=CLASSES * DIMENSIONS)
    return sums.reshape(CLASSES, DIMENSIONS).astype(np.float32)


class Trainer:
    """Noise-contrastive estimation with AdaGrad steps over a stream of class sequences."""

    def __init__(self, model: LogBilinear, share: np.ndarray, seed: int):
        self.model, self.rng = model, np.random.default_rng(seed)
        self.share = share / share.sum()
        self.log_noise = np.log(NOISE * self.share).astype(np.float32)
        parts = (model.targets, model.contexts, model.scales, model.bias)
        self.seen = [np.full_like(p, 1e-2) for p in parts]
        self.tokens = 0
        self.before: list[np.ndarray] = []
        self.target: list[np.ndarray] = []
        self.held = 0

    def add(self, classes: np.ndarray) -> None:
        """One text's classes, with its end."""
        before, target = windows(classes)
        self.before.append(before)
        self.target.append(target)
        self.held += len(target)
        if self.held >= 16 * BATCH_TOKENS:
            self.flush()

    def flush(self) -> None:
        if not self.held:
            return
        before, target = np.concatenate(self.before), np.concatenate(self.target)
        order = self.rng.permutation(len(target))
        for at in range(0, len(order), BATCH_TOKENS):
            rows = order[at : at + BATCH_TOKENS]
            self._step(before[rows], target[rows])
        self.tokens += len(target)
        self.before, self.target, self.held = [], [], 0

    def _step(self, before: np.ndarray, target: np.ndarray) -> None:
        m, n = self.model, len(target)
        noise = self.rng.choice(CLASSES, NOISE, p=self.share)
        first, second = m.contexts[before[:, 0]], m.contexts[before[:, 1]]
        hidden = first * m.scales[0] + second * m.scales[1]
        aimed = m.targets[target]
        true = np.einsum("ij,ij->i", hidden, aimed) + m.bias[target] - self.log_noise[target]
        false = hidden @ m.targets[noise].T + (m.bias[noise] - self.log_noise[noise])
        g_true = (1 / (1 + np.exp(-np.clip(true, -30, 30))) - 1) / n
        g_false = 1 / (1 + np.exp(-np.clip(false, -30, 30))) / n
        back = g_true[:, None] * aimed + g_false @ m.targets[noise]
        g_targets = _scatter(target, g_true[:, None] * hidden)
        g_bias = np.bincount(target, weights=g_true, minlength=CLASSES).astype(np.float32)
        np.add.at(g_targets, noise, g_false.T @ hidden)
        np.add.at(g_bias, noise, g_false.sum(0))
        g_contexts = _scatter(before[:, 0], back * m.scales[0])
        g_contexts += _scatter(before[:, 1], back * m.scales[1])
        g_scales = np.stack([(back * first).sum(0), (back * second).sum(0)])
        gradients = (g_targets, g_contexts, g_scales, g_bias)
        parts = (m.targets, m.contexts, m.scales, m.bias)
        for part, seen, gradient in zip(parts, self.seen, gradients, strict=True):
            seen += gradient * gradient * n
            part -= (RATE * gradient * np.sqrt(n) / np.sqrt(seen)).astype(np.float32)


def windows(classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each token of a text, the two classes before it (the end before the first) and its own."""
    padded = np.concatenate((np.full(CONTEXT, END, classes.dtype), classes))
    n = len(classes)
    return np.stack([padded[k : n + k] for k in range(CONTEXT)], axis=1), classes


def _classes(vocabulary: Vocabulary, of_code: np.ndarray, text: str | None) -> np.ndarray:
    _, codes = vocabulary.encode(text)
    return np.append(of_code[codes], END)


def word_counts(docs: DataFrame) -> DataFrame:
    """``word, n``: how often each word occurs in all the texts; no cap, no sample."""

    def count(batches):
        found: Counter[bytes] = Counter()
        for batch in batches:
            for rows in row_slices(batch, "text"):
                for text in rows.column("text").to_pylist():
                    found.update(tokens_of(text))
                    if len(found) > FLUSH_WORDS:
                        yield _counted(found)
                        found = Counter()
        if found:
            yield _counted(found)

    counted = docs.select("text").mapInArrow(count, "word binary, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def _counted(found: Counter) -> pa.RecordBatch:
    return pa.record_batch(
        {
            "word": pa.array(list(found.keys()), pa.binary()),
            "n": pa.array(list(found.values()), pa.int64()),
        }
    )


def _most_frequent(counts: DataFrame, most: int) -> list[Row]:
    """Up to ``most`` of the most frequent words, in order.

    A sort with a limit would send that many rows from every task. Instead the
    words are counted by steps of one percent of frequency, and those of the
    upper steps, as far as they fit, are taken: no more than ``most`` in all.
    """
    step = F.floor(F.ln("n") * 100)
    sizes = counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("words")).collect()
    least, held = None, 0
    for size in sorted(sizes, reverse=True):
        held += size["words"]
        if held > most:
            break
        least = size["step"]
    rows = counts.filter(step >= least).collect() if least is not None else []
    return sorted(rows, key=lambda row: (-row["n"], bytes(row["word"])))


def learn_vocabulary(counts: DataFrame, n_ends: int, head_words: int = HEAD_WORDS) -> Vocabulary:
    """From the counts of all training words; ``head_words`` bounds what reaches the driver."""
    totals = counts.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).first()
    top = _most_frequent(counts, head_words)
    head = [bytes(row["word"]) for row in top]
    head_counts = np.array([row["n"] for row in top], np.float64)
    own = set(head[: CLASSES - SUFFIX_CLASSES - 1])

    def sums(batches):
        tokens, words = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
        for batch in batches:
            for word, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if word not in own:
                    tokens[suffix_class(word)] += n
                    words[suffix_class(word)] += 1
        yield pa.record_batch({"class": np.arange(CLASSES), "tokens": tokens, "words": words})

    by_class = (
        counts.select("word", "n")
        .mapInArrow(sums, "class bigint, tokens bigint, words bigint")
        .groupBy("class")
        .agg(F.sum("tokens").alias("tokens"), F.sum("words").alias("words"))
        .collect()
    )
    tokens, words = np.zeros(CLASSES), np.zeros(CLASSES)
    for row in by_class:
        tokens[row["class"]], words[row["class"]] = row["tokens"], row["words"]
    return Vocabulary(
        n_tokens=(totals["n"] or 0) + n_ends,
        n_distinct=totals["v"] + (n_ends > 0),
        n_ends=n_ends,
        head=head,
        head_counts=head_counts,
        class_tokens=tokens,
        class_words=words,
    )


def train(docs: DataFrame, vocabulary: Vocabulary, warm_docs: int = WARM_DOCS) -> LogBilinear:
    """Fit to all texts of ``docs``: a warm start, then one pass in parallel whose models are averaged.

    The warm start runs on the driver, over class numbers of at most
    ``warm_docs`` texts, chosen by a hash of their ids. Then every task goes on
    from there over all texts of its partition, and the parameters are averaged,
    weighted by tokens, in two steps of grouped sums; only the averages, 68 KB,
    reach the driver.
    """
    spark = docs.sparkSession
    share, of_code = vocabulary.class_share(), vocabulary.tables()["class"]
    model = LogBilinear.start(share)
    shared = spark.sparkContext.broadcast(vocabulary)
    ids = docs.select(F.col("doc_id").cast("bigint").alias("__id")).filter("__id is not null")
    chosen = cut_lineage(ids.orderBy(F.xxhash64("__id")).limit(warm_docs).distinct())

    def number(batches):
        for batch in batches:
            for rows in row_slices(batch, "text"):
                found = [
                    _classes(shared.value, of_code, t).astype("<u2").tobytes()
                    for t in rows.column("text").to_pylist()
                ]
                yield pa.record_batch({"classes": pa.array(found, pa.binary())})

    texts = docs.select(F.col("doc_id").cast("bigint").alias("__id"), "text")
    sample = texts.join(F.broadcast(chosen), "__id").dropDuplicates(["__id"]).select("text")
    rows = sorted(bytes(r[0]) for r in sample.mapInArrow(number, "classes binary").collect())
    warm = Trainer(model, share, seed=1)
    for _ in range(WARM_EPOCHS):
        for row in rows:
            warm.add(np.frombuffer(row, "<u2").astype(np.int64))
        warm.flush()
    begun = spark.sparkContext.broadcast(model.vector())

    def fit(batches):
        part = TaskContext.get().partitionId()
        trainer = Trainer(LogBilinear.of_vector(begun.value), share, seed=part)
        for batch in batches:
            for rows in row_slices(batch, "text"):
                for text in rows.column("text").to_pylist():
                    trainer.add(_classes(shared.value, of_code, text))
        trainer.flush()
        if trainer.tokens:
            vector = trainer.model.vector().astype(np.float64) * trainer.tokens
            blocks = [b.tobytes() for b in np.array_split(vector, BLOCKS)]
            yield pa.record_batch(
                {
                    "block": pa.array(range(BLOCKS), pa.int32()),
                    "part": pa.array([part] * BLOCKS, pa.int32()),
                    "tokens": pa.array([float(trainer.tokens)] * BLOCKS),
                    "vector": pa.array(blocks, pa.binary()),
                }
            )

    def add_up(table: pa.Table) -> pa.Table:
        vectors = (np.frombuffer(v.as_py(), np.float64) for v in table.column("vector"))
        return pa.table(
            {
                "block": pa.array([table.column("block")[0].as_py()], pa.int32()),
                "tokens": [pa.compute.sum(table.column("tokens")).as_py()],
                "vector": pa.array([sum(vectors).tobytes()], pa.binary()),
            }
        )

    fields = "block int, tokens double, vector binary"
    fitted = docs.select("text").mapInArrow(
        fit, "block int, part int, tokens double, vector binary"
    )
    partly = fitted.groupBy("block", F.pmod("part", F.lit(256)).alias("g")).applyInArrow(
        add_up, fields
    )
    sums = partly.groupBy("block").applyInArrow(add_up, fields).collect()
    if sums:
        sums.sort(key=lambda r: r["block"])
        vector = np.concatenate([np.frombuffer(r["vector"], np.float64) for r in sums])
        model = LogBilinear.of_vector(vector / sums[0]["tokens"])
    model.normalise()
    return model


_TAIL = pa.struct([("word", pa.binary()), ("n", pa.int32())])
_SCORED = (
    "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base double, "
    "score double, tail array<struct<word: binary, n: int>>"
)

_SCORED_NAMES = ["doc_id", "held_out", "n_tokens", "n_known", "base", "score", "tail"]


def _score_texts(docs: DataFrame, vocabulary: Vocabulary, model: LogBilinear) -> DataFrame:
    """Per row, the sums over classes and head words, and the counted words beyond the head."""
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary, model))
    tables, n_head = vocabulary.tables(), len(vocabulary.head)
    end_count = float(np.log10(vocabulary.n_ends + 0.5))

    def score(batches):
        words_of, lm = shared.value[0].encode, shared.value[1]
        for batch in batches:
            for rows in row_slices(batch, "text", SCORED_CHARS):
                n_tokens, known, base, scores = [], [], [], []
                offsets, tail_words, tail_counts = [0], [], []
                coded, sequences = [], []
                for text in rows.column("text").to_pylist():
                    words, codes = words_of(text)
                    coded.append(codes)
                    sequences.append(np.append(tables["class"][codes], END))
                    rare = Counter(words[i] for i in np.flatnonzero(codes >= n_head).tolist())
                    tail_words += rare.keys()
                    tail_counts += rare.values()
                    offsets.append(len(tail_words))
                both = [windows(s) for s in sequences]
                logp = lm.log_probabilities(
                    np.concatenate([b for b, _ in both]), np.concatenate([t for _, t in both])
                )
                starts = np.cumsum([0] + [len(s) for s in sequences[:-1]])
                by_class = np.add.reduceat(logp.astype(np.float64), starts) / np.log(10)
                for codes, total in zip(coded, by_class.tolist(), strict=True):
                    n_tokens.append(len(codes) + 1)
                    in_head = int((codes < n_head).sum())
                    known.append(in_head + (shared.value[0].n_ends > 0))
                    base.append(float(tables["count"][codes].sum()) + end_count)
                    inside = tables["inside"][codes].sum() - tables["below"][codes].sum()
                    scores.append(total + float(inside))
                tail = pa.StructArray.from_arrays(
                    [pa.array(tail_words, pa.binary()), pa.array(tail_counts, pa.int32())],
                    fields=list(_TAIL),
                )
                yield pa.record_batch(
                    [
                        rows.column("doc_id"),
                        rows.column("held_out"),
                        pa.array(n_tokens, pa.int64()),
                        pa.array(known, pa.int64()),
                        pa.array(base, pa.float64()),
                        pa.array(scores, pa.float64()),
                        pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), tail),
                    ],
                    names=_SCORED_NAMES,
                )

    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), held_out().alias("held_out"), "text"
    )
    return rows.mapInArrow(score, _SCORED)


def scores(docs: DataFrame) -> DataFrame:
    """Unigram and log-bilinear log10 probabilities of every row's whole text.

    ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.
    The model gives p(class | two tokens before) · p(word | class); the first is
    normalised over all classes, the second over the words of the class and one
    unknown. Counts cover all words of the training fold. A null or empty text
    is one end. Repeated rows each get a row; a null id belongs to training.

    The most frequent words are looked up in the workers; rarer ones, counted
    per text, meet their counts in one join. Without training texts every known
    count is 0.
    """
    learning = docs.filter(~held_out())
    counts = cut_lineage(word_counts(learning))
    vocabulary = learn_vocabulary(counts, learning.count())
    model = train(learning, vocabulary)
    scored = _score_texts(docs, vocabulary, model)
    scored = cut_lineage(scored.withColumn("row_no", F.monotonically_increasing_id()))
    rare = scored.select("row_no", F.inline("tail")).withColumnRenamed("n", "times")
    counted = counts.withColumnRenamed("word", "known")
    found = rare.join(counted, F.col("word") == F.col("known"), "left")
    log_count = F.log10(F.coalesce(F.col("n"), F.lit(0)) + F.lit(0.5))
    tail = found.groupBy("row_no").agg(
        F.sum(F.col("times") * log_count).alias("tail_score"),
        F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("tail_known"),
    )
    below = float(np.log10(vocabulary.n_tokens + 0.5 * (vocabulary.n_distinct + 1)))
    rest = F.coalesce("tail_score", F.lit(0.0))
    return (
        scored.drop("tail")
        .join(tail, "row_no", "left")
        .select(
            "doc_id",
            "held_out",
            "n_tokens",
            (F.col("n_known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"),
            F.lit(vocabulary.n_tokens).cast("bigint").alias("train_tokens"),
            (F.col("base") + rest - F.col("n_tokens") * F.lit(below)).alias("base_score"),
            (F.col("score") + rest).alias("score"),
        )
    )

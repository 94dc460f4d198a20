"""Quality classifier by positive-unlabelled learning.

Trusted positives and unlabelled web text train a linear model that minimises the
non-negative unbiased risk: with class prior c, the risk of positives as
positives, times c, plus the risk of unlabelled text as negatives less the
share that the positives in it have of that risk, which counts as zero where it
would turn negative.  No text is ever taken as a negative one.

The prior is estimated from the same two samples: a first model tells them apart
on two thirds of each; on the rest the share of unlabelled scores above a threshold,
divided by that of the positives, bounds the prior from above, and is close to it
where hardly a negative scores as high.  The threshold with the smallest upper
confidence bound is taken, and once more with the model that this prior gives.  The
rows held back also turn raw scores into posteriors.

A text's features are shares of its words and of their shapes, in hashed classes,
and steps of statistics of its bytes, words and lines.  The model is fitted on
bounded samples; every row is scored whole, in tasks.
"""

from __future__ import annotations

import re
from collections import defaultdict
from itertools import chain, count, islice
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import set_aside, shared

CLASSES = 1 << 14
#: Shares of the sample at which a statistic takes its next step: close at the ends, where junk lies.
STEP_AT = (.005, .01, .02, .03, .045, .06, .08, .11, .15, .25, .5, .75, .85, .89, .92, .94, .955, .97, .98, .99, .995)
STEPS = len(STEP_AT) + 1
#: Pull to zero of the weights of steps, words and shapes; words are many and rare.
STEP_DECAY, WORD_DECAY, SHAPE_DECAY = 1e-3, 0.1, 1e-3
#: Every third row of the samples is held back to estimate the prior and the posteriors.
HELD_BACK = 3
#: Rows of either sample, about.
SAMPLE = 10_000
REMEMBERED = 200_000
#: Bytes of the texts that are cut and looked up together.
TOGETHER = 1 << 20
#: Kinds of bytes: other, lower case, upper case, digit, blank, sentence mark, beyond ASCII.
KINDS = np.zeros(256, np.int64)
for _kind, _members in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\n\x0b\x0c\r",
                                  b".,;:?'\"()-", bytes(range(128, 256))), 1):
    KINDS[list(_members)] = _kind
_SHAPE = bytes((b if k == 0 else ord("oaAd_.n"[k])) for b, k in enumerate(KINDS.tolist()))
_RUN = re.compile(rb"(.)\1+", re.S)
_MARKS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
STATISTICS = ("words", "letters", "upper", "digits", "marks", "other", "word_length", "same_again", "distinct", "distinct_pairs", "letterless",
              "repeated_lines", "line_words")


def shape(word: bytes) -> bytes:
    """The kinds of a word's bytes, runs as one; bytes of kind other stand for themselves."""
    return _RUN.sub(rb"\1", word.translate(_SHAPE))


class _Shapes(dict):
    """(hashed class of a shape, 1 if it has no letter) by the kinds of a word's bytes."""

    def __missing__(self, kinds: bytes) -> tuple[int, int]:
        if len(self) > REMEMBERED:
            self.clear()
        self[kinds] = out = (CLASSES // 2 + crc32(_RUN.sub(rb"\1", kinds), 1) % (CLASSES // 2), int(not any(x in kinds for x in b"aAn")))
        return out


def word_features(words: list[bytes], shapes: _Shapes) -> np.ndarray:
    """Per word its hashed class, that of its shape, and whether it has no letter."""
    out = np.zeros((len(words), 3), np.int64)
    if words:
        out[:, 0] = np.fromiter((crc32(w.strip(_MARKS).lower()) for w in words), np.int64, len(words)) % (CLASSES // 2)
        out[:, 1:] = [shapes[w.translate(_SHAPE)] for w in words]
    return out


class Words:
    """Numbers of the words met so far, with a value per word that is worked out once."""

    def __init__(self, value):
        self.value = value
        self.reset()

    def reset(self):
        self.number, self.known = defaultdict(count().__next__), self.value([])

    def __call__(self, cut: list[list[bytes]]) -> np.ndarray:
        """The numbers of all words in a row; ``known`` then has the value of each."""
        if len(self.number) > REMEMBERED:
            self.reset()
        before = len(self.number)
        out = np.fromiter(map(self.number.__getitem__, chain.from_iterable(cut)), np.int64, sum(map(len, cut)))
        new = list(islice(self.number, before, None))
        if new:
            self.known = np.concatenate([self.known, self.value(new)])
        return out


def statistics(text: bytes, numbers: np.ndarray, letterless: np.ndarray) -> list[float]:
    n = len(numbers)
    kind = np.bincount(KINDS[np.frombuffer(text, np.uint8)], minlength=7) if text else np.zeros(7, np.int64)
    solid = max(int(kind.sum() - kind[4]), 1)
    letters = int(kind[1] + kind[2] + kind[6])
    lines = [x for x in map(bytes.strip, text.split(b"\n")) if x]
    pairs = numbers[:-1] * (int(numbers.max()) + 1 if n else 1) + numbers[1:]
    return [np.log1p(n), letters / solid, kind[2] / max(letters, 1), kind[3] / solid, kind[5] / solid, kind[0] / solid, solid / max(n, 1),
            float((numbers[1:] == numbers[:-1]).mean()) if n > 1 else 0.0, len(np.unique(numbers)) / max(n, 1), len(np.unique(pairs)) / max(n - 1, 1),
            float(letterless.sum()) / max(n, 1), 1 - len(set(lines)) / max(len(lines), 1), np.log1p(n / max(len(lines), 1))]


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * z))


class Samples:
    """Feature rows: statistics, and shares of hashed classes (row, class, share)."""

    def __init__(self, stats: np.ndarray, row: np.ndarray, cls: np.ndarray, share: np.ndarray):
        self.stats, self.cls, self.share, self.row = stats, cls, share, row
        self.starts = np.searchsorted(row, np.arange(len(stats) + 1))

    def take(self, rows: np.ndarray) -> "Samples":
        size = self.starts[rows + 1] - self.starts[rows]
        at = np.repeat(self.starts[rows] - np.cumsum(size) + size, size) + np.arange(size.sum())
        return Samples(self.stats[rows], np.repeat(np.arange(len(rows)), size), self.cls[at], self.share[at])


class Model:
    """Weights of classes and of the steps of every statistic."""

    def __init__(self, edges: np.ndarray):
        self.edges = edges  # statistics x (STEPS - 1)
        self.prior, self.at, self.posterior = 0.5, np.zeros(0), np.zeros(0)
        self.bias, self.steps, self.classes = 0.0, np.zeros((len(edges), STEPS)), np.zeros(CLASSES)

    def step(self, stats: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, stats[:, k], "right") for k, e in enumerate(self.edges)], axis=1)

    def of_steps(self, stats: np.ndarray) -> np.ndarray:
        return self.bias + self.steps[np.arange(len(self.edges)), self.step(stats)].sum(1)

    def score(self, z: np.ndarray) -> np.ndarray:
        """Posteriors by raw score, level within a pool and on a line between two; a hundredth is the plain sigmoid, so that ranks are kept."""
        plain = sigmoid(z)
        return 0.99 * np.interp(z, self.at, self.posterior) + 0.01 * plain if len(self.at) else plain

    def raw(self, s: Samples) -> np.ndarray:
        return self.of_steps(s.stats) + np.bincount(s.row, self.classes[s.cls] * s.share, len(s.stats))


def risk_weights(z_p: np.ndarray, z_u: np.ndarray, prior: float) -> tuple[np.ndarray, np.ndarray]:
    """d risk / d z of positives and unlabelled rows, under the logistic loss.  Where the
    negatives' part of the risk is below zero, its gradient is followed upwards."""
    n_p, n_u = max(len(z_p), 1), max(len(z_u), 1)
    up_p, up_u = sigmoid(z_p) / n_p, sigmoid(z_u) / n_u  # of log(1 + e^z), the loss as a negative
    negative = np.logaddexp(0, z_u).sum() / n_u - prior * np.logaddexp(0, z_p).sum() / n_p
    if negative < 0:
        return prior * up_p, -up_u
    return prior * (sigmoid(z_p) - 1) / n_p - prior * up_p, up_u


def told_apart(z_p: np.ndarray, z_u: np.ndarray, prior: float) -> tuple[np.ndarray, np.ndarray]:
    """The same for telling the two samples apart, as if all unlabelled rows were negatives."""
    return (sigmoid(z_p) - 1) / max(len(z_p), 1), sigmoid(z_u) / max(len(z_u), 1)


def risk(z_p: np.ndarray, z_u: np.ndarray, prior: float) -> float:
    """The non-negative unbiased risk under the logistic loss."""
    negative = np.logaddexp(0, z_u).mean() - prior * np.logaddexp(0, z_p).mean()
    return float(prior * np.logaddexp(0, -z_p).mean() + max(0.0, negative))


def fit(model: Model, positive: Samples, unlabelled: Samples, prior: float, weights=risk_weights, rounds: int = 30, rows: int = 500,
        rate: float = 0.05, seed: int = 11) -> Model:
    """Minimise by Adam over batches of both samples; the same rows give the same model."""
    rng = np.random.default_rng(seed)
    theta = [np.zeros(1), np.zeros_like(model.steps), np.zeros_like(model.classes)]
    decay = [0.0, STEP_DECAY, np.repeat([WORD_DECAY, SHAPE_DECAY], CLASSES // 2)]
    first, second, t = [np.zeros_like(x) for x in theta], [np.zeros_like(x) for x in theta], 0
    parts = max(1, -(-max(len(positive.stats), len(unlabelled.stats)) // rows))
    for _ in range(rounds):
        p_order, u_order = rng.permutation(len(positive.stats)), rng.permutation(len(unlabelled.stats))
        for p_rows, u_rows in zip(np.array_split(p_order, parts), np.array_split(u_order, parts)):
            if not len(p_rows) or not len(u_rows):
                continue
            p, u = positive.take(np.sort(p_rows)), unlabelled.take(np.sort(u_rows))
            g_p, g_u = weights(model.raw(p), model.raw(u), prior)
            slope = [np.array([g_p.sum() + g_u.sum()]), np.zeros_like(model.steps), np.zeros(CLASSES)]
            for s, g in ((p, g_p), (u, g_u)):
                at = model.step(s.stats)
                for k in range(len(model.edges)):
                    slope[1][k] += np.bincount(at[:, k], g, STEPS)
                slope[2] += np.bincount(s.cls, s.share * g[s.row], CLASSES)
            now, t = rate * (1 - t / (rounds * parts)), t + 1
            for i, x in enumerate(theta):
                d = slope[i] + decay[i] * x
                first[i] = 0.9 * first[i] + 0.1 * d
                second[i] = 0.999 * second[i] + 0.001 * d * d
                x -= now * (first[i] / (1 - 0.9 ** t)) / (np.sqrt(second[i] / (1 - 0.999 ** t)) + 1e-8)
            model.bias, model.steps, model.classes = float(theta[0][0]), theta[1], theta[2]
    return model


def prior_bound(z_p: np.ndarray, z_u: np.ndarray, doubt: float = 0.1) -> float:
    """The share of positives among unlabelled rows that scores of rows not fitted on allow, at the
    threshold whose upper confidence bound is smallest."""
    z_p, z_u = np.sort(z_p), np.sort(z_u)
    at = np.unique(np.r_[z_p, z_u])
    above_p = 1 - np.searchsorted(z_p, at) / len(z_p)
    above_u = 1 - np.searchsorted(z_u, at) / len(z_u)
    slack = np.sqrt(np.log(4 / doubt) / 2) * (1 / np.sqrt(len(z_p)) + 1 / np.sqrt(len(z_u)))
    some = above_p > 0
    best = np.argmin((above_u[some] + slack) / above_p[some])
    return float(np.clip(above_u[some][best] / above_p[some][best], 0.05, 0.95))


def calibrate(model: Model, z_p: np.ndarray, z_u: np.ndarray) -> None:
    """Posteriors by raw score from rows that were not fitted on: the prior times the share of the
    positives over that of the unlabelled rows, pooled to rise with the score."""
    z = np.concatenate([z_p, z_u])
    order = np.argsort(z, kind="stable")
    p = np.r_[np.full(len(z_p), model.prior / len(z_p)), np.zeros(len(z_u))][order]
    u = np.r_[np.zeros(len(z_p)), np.full(len(z_u), 1 / len(z_u))][order]
    blocks: list[list[float]] = []  # of positives, of unlabelled rows, least and largest score
    for a, b, x in zip(p, u, z[order]):
        blocks.append([a, b, x, x])
        # the ratio must not fall: pool; cross products, as a block may hold no unlabelled row
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [blocks[-1][0] + last[0], blocks[-1][1] + last[1], blocks[-1][2], last[3]]
    model.at = np.array([x for block in blocks for x in block[2:]])
    model.posterior = np.repeat([min(1.0, a / b) if b else 1.0 for a, b, _, _ in blocks], 2)


def train(positive: Samples, unlabelled: Samples, prior: float | None = None, seed: int = 11) -> Model:
    """A calibrated model of two samples; the ``prior`` is estimated unless given."""
    rng = np.random.default_rng(seed)
    edges = np.quantile(np.concatenate([positive.stats, unlabelled.stats]), STEP_AT, axis=0).T

    def cut(s: Samples) -> tuple[Samples, Samples]:
        order = rng.permutation(len(s.stats))
        held = len(order) // HELD_BACK
        return s.take(np.sort(order[held:])), s.take(np.sort(order[:held]))

    (p, p_held), (u, u_held) = cut(positive), cut(unlabelled)
    if min(len(p_held.stats), len(u_held.stats)) < 2:  # too few to hold any back
        p_held, u_held = p, u
    found = prior
    if found is None:
        model = fit(Model(edges), p, u, 0.5, told_apart, rounds=10)
        found = prior_bound(model.raw(p_held), model.raw(u_held))
    for _ in range(2):
        model = fit(Model(edges), p, u, found)
        model.prior = found
        # the better model leaves fewer negatives among the best scored: a closer bound
        closer = prior_bound(model.raw(p_held), model.raw(u_held))
        if prior is not None or closer >= found:
            break
        found = closer
    calibrate(model, model.raw(p_held), model.raw(u_held))
    return model


def held_out(doc_id: Column) -> Column:
    """True for the documents whose labels are never learned from; a null id's text is 'null' to none and is not held out."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(5)) == 0, F.lit(False))


def _texts_together(column):
    """Runs of texts as bytes, null as empty, of about ``TOGETHER`` bytes."""
    group, held = [], 0
    for value in column:
        text = value.as_py() or b""
        group.append(text)
        held += len(text)
        if held >= TOGETHER:
            yield group
            group, held = [], 0
    if group:
        yield group


def _sampled(rows: DataFrame, key: Column, n: int, size: int) -> DataFrame:
    """About ``size`` of ``n`` rows, by a hash; all of them if there are fewer."""
    steps = 1_000_000
    return rows if n <= size else rows.filter(F.pmod(F.xxhash64(F.lit("sample"), key), F.lit(steps)) < -(-steps * size // n))


def _features(rows: DataFrame) -> Samples:
    """Feature rows of a bounded sample (id, text as bytes), ordered by id and content."""

    def run(batches):
        shapes = _Shapes()
        words = Words(lambda new: word_features(new, shapes))
        for batch in batches:
            done = 0
            for texts in _texts_together(batch.column(1)):
                cut = [t.split() for t in texts]
                size = np.fromiter(map(len, cut), np.int64, len(cut))
                stats, classes, shares = [], [], []
                for text, at in zip(texts, np.split(words(cut), np.cumsum(size)[:-1])):
                    found = words.known[at]
                    stats.append(statistics(text, at, found[:, 2]))
                    cls, n = np.unique(found[:, :2], return_counts=True)
                    classes.append(cls.astype(np.int32))
                    shares.append((n / max(len(at), 1)).astype(np.float32))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(done, len(texts)), pa.array(stats, pa.list_(pa.float64())),
                                                  pa.array(classes, pa.list_(pa.int32())), pa.array(shares, pa.list_(pa.float32()))],
                                                 ["key", "stats", "classes", "shares"])
                done += len(texts)

    got = rows.mapInArrow(run, "key long, stats array<double>, classes array<int>, shares array<float>").toArrow()
    # the tasks' answers come in any order; rows alike in key are alike in text, or in doubt by their statistics
    got = got.take(pa.array(sorted(range(got.num_rows), key=list(zip(got.column("key").to_pylist(), got.column("stats").to_pylist())).__getitem__), pa.int64())).combine_chunks()
    stats = np.array(got.column("stats").to_pylist(), float).reshape(-1, len(STATISTICS))
    size = np.array([len(x) for x in got.column("classes")], np.int64)
    flat = lambda name, kind: np.concatenate([np.zeros(0, kind), *[np.asarray(x.values, kind) for x in got.column(name)]])
    return Samples(stats, np.repeat(np.arange(len(stats)), size), flat("classes", np.int64), flat("shares", float))


def learn(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", sample_docs: int = SAMPLE, prior: float | None = None) -> Model | None:
    """A model from about ``sample_docs`` documents that ``labels`` (doc_id, quality) names positives
    and as many of all ``docs``, unlabelled.  None if there is no positive."""
    rows = docs.select(F.col(f"`{doc_id}`").alias("id"), F.encode(F.coalesce(F.col(f"`{text}`"), F.lit("")), "utf-8").alias("text"))
    trusted = labels.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("quality")).filter(F.col("quality") == 1).select(
        F.col("doc_id").alias("id"))
    # at most about sample_docs ids
    trusted = _sampled(trusted, F.col("id"), trusted.count(), sample_docs)
    key = F.xxhash64(F.lit("key"), "id").alias("key")
    positive = _features(rows.join(F.broadcast(trusted), "id").select(key, "text"))
    unlabelled = _features(_sampled(rows, F.col("id"), docs.count(), sample_docs).select(key, "text"))
    if not len(positive.stats):
        return None
    return train(positive, unlabelled, prior)


def score(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """Every row without its text, with ``score``, the probability of a positive.

    Defined cases: a null text is an empty one, which is scored like any text; without
    a model every score is 0.5; repeated rows score alike; an empty table gives an
    empty result; a very long text is scored whole, one in memory; an input
    column named like an added one is replaced, other names do not matter.
    """
    slim, back = set_aside(docs, {"text": text}, ("score",))
    slim = slim.withColumn("text", F.encode("text", "utf-8"))
    if model is None:
        return back(slim.withColumn("score", F.lit(0.5)), text)
    given = shared(docs, model)
    schema = StructType([slim.schema["__rest"], StructField("score", DoubleType())])

    def run(batches):
        model = given()

        def weight(new):
            found = word_features(new, shapes)
            return np.column_stack([model.classes[found[:, :2]].sum(1), found[:, 2].astype(float)])

        shapes = _Shapes()
        words = Words(weight)
        for batch in batches:
            done = 0
            for texts in _texts_together(batch.column("text")):
                cut = [t.split() for t in texts]
                size = np.fromiter(map(len, cut), np.int64, len(cut))
                stats, mean = [], []
                for t, at in zip(texts, np.split(words(cut), np.cumsum(size)[:-1])):
                    found = words.known[at]
                    stats.append(statistics(t, at, found[:, 1]))
                    mean.append(found[:, 0].sum() / max(len(at), 1))
                z = model.of_steps(np.array(stats)) + np.array(mean)
                yield pa.RecordBatch.from_arrays([batch.column("__rest").slice(done, len(texts)), pa.array(model.score(z))], ["__rest", "score"])
                done += len(texts)

    return back(slim.select("__rest", "text").mapInArrow(run, schema), text)


THRESHOLD = 0.3


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    known = labels.filter(~held_out(F.col("doc_id")))
    model = learn(docs.filter(~held_out(F.col("doc_id"))), known)
    rows = score(docs.select("doc_id", "text"), model)
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))

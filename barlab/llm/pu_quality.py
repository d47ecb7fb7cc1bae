"""Document quality by positive-unlabelled learning.

Trusted positives (documents labelled good) and unlabelled web text are all that the
classifier sees; no document is ever taken as a negative.  With the class prior pi,
the risk of a scorer g on the unseen negatives is what the unlabelled text costs as
negatives less what positives would cost as negatives, so the unbiased risk is

    pi * E_P[loss(g, +1)] + (E_U[loss(g, -1)] - pi * E_P[loss(g, -1)]),

with the sigmoid loss, which is bounded.  The bracket cannot be negative for a real
population; where a flexible scorer drives it below zero, its gradient is reversed (the
non-negative estimator), which stops it from learning the positives by heart.

1. One scan reduces every whole text to ``N_FEATURES`` numbers (marks, capitals, digits,
   repeats, length of words and lines, ...), which are stored.
2. A bounded sample is drawn from them: ``SAMPLE`` positives and ``SAMPLE`` documents of any
   kind at most, those with the least hash of ``doc_id``.  Its quantiles cut each number
   into ``BINS`` bins, and the scorer is a weight of each bin (an additive model).
3. The class prior comes from all documents: a plain classifier of one half of the
   positives (by hash of ``doc_id``) against unlabelled text ranks everything; where it is
   most sure of a positive, the share of all documents above a rank over the share of the
   other half's positives above it falls to pi, as only positives are left there.
   Both shares are counted over the whole table by a group-by on ``RANKS`` ranks.
4. The scorer is fitted on the sample by the non-negative risk and applied to every row.

Labels count by ``doc_id``: a document is a trusted positive if a label says so.

Defined results: null, empty and wordless texts have the features of no words and are
scored like others; without a positive the score is 0 everywhere, with all of
them in one half the prior is taken as one half; a document labelled twice is a positive if one label says
so; repeated rows are scored each; a null ``doc_id`` is never a positive.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlab.llm.scratch import stored
from barlab.llm.textvec import WORDLIKE, Chunk, chunks, mix, prefix_hash, range_hash, tally, windows, words

SAMPLE = 6000
BINS = 16
RANKS = 100
LEAST_POSITIVES = 0.3  # share of the positives above a rank that a prior is read from
STEPS = 300
RIDGE = 1.0  # over the number of positives
THRESHOLD = 0.3
N_FEATURES = 16


def _class(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[[ord(c) for c in chars]] = True
    return out


_UPPER = _class("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LETTER = _UPPER | _class("abcdefghijklmnopqrstuvwxyz")
_DIGIT = _class("0123456789")
_SYMBOL = _class("#*$%&|<>")
_LOUD = _class("!?")
_MARK = _class("\"/:;=@[\\]^_`{}~+()'-")
_STOP = _class(".,")


def _shares_repeated(values: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    """Share of each row's values that the row has before."""
    order = np.lexsort((values, row))
    again = (values[order][1:] == values[order][:-1]) & (row[order][1:] == row[order][:-1])
    return np.bincount(row[order][1:][again], minlength=n) / np.maximum(np.bincount(row, minlength=n), 1)


def features(chunk: Chunk) -> np.ndarray:
    """``(n, N_FEATURES)`` numbers of the chunk's texts."""
    buf, n, w = chunk.buf, chunk.n, words(chunk)
    sums = prefix_hash(buf)
    count = np.diff(w.first)
    size = np.maximum(count, 1)
    n_bytes = np.maximum(chunk.lengths(), 1)

    def total(mask: np.ndarray) -> np.ndarray:
        t = tally(mask[buf])
        return t[chunk.bounds[1:]] - t[chunk.bounds[:-1]]

    points = tally((buf & 0xC0) != 0x80)
    solid = tally(WORDLIKE[buf])
    bare = np.bincount(w.row[solid[w.end] == solid[w.start]], minlength=n)
    capital = np.bincount(w.row[_UPPER[buf[w.start]]], minlength=n)
    letters = np.maximum(total(_LETTER), 1)
    word_hash = range_hash(sums, w.start, w.end)
    twin = (word_hash[1:] == word_hash[:-1]) & (w.row[1:] == w.row[:-1])
    at, triple = windows(word_hash, w.row, 3)

    breaks = np.flatnonzero(buf == 0x0A)
    starts = np.sort(np.concatenate([chunk.bounds[:-1][chunk.lengths() > 0], breaks + 1]))
    starts = starts[starts < len(buf)]
    line_row = np.searchsorted(chunk.bounds, starts, "right") - 1
    ends = np.minimum(np.append(starts[1:], len(buf)), chunk.bounds[line_row + 1])
    lines = np.bincount(line_row, minlength=n)
    line_hash = range_hash(sums, starts, ends)
    out = [
        np.log1p(count),
        np.bincount(w.row, points[w.end] - points[w.start], n) / size,
        total(_SYMBOL) / size,
        total(_LOUD) / size,
        total(_MARK) / size,
        total(_STOP) / size,
        total(_UPPER) / letters,
        capital / size,
        total(_DIGIT) / n_bytes,
        bare / size,
        np.bincount(w.row[1:][twin], minlength=n) / size,
        _shares_repeated(word_hash, w.row, n),
        _shares_repeated(triple, w.row[at], n),
        _shares_repeated(line_hash, line_row, n),
        np.log1p(count / np.maximum(lines, 1)),
        total(np.arange(256) >= 0x80) / n_bytes,
    ]
    return np.stack(out, axis=1)


def feature_table(docs: DataFrame) -> DataFrame:
    """``docs`` with ``text`` replaced by ``features``; a column of that name is replaced."""
    base = docs.drop("features").withColumn("text", F.col("text").cast("string"))
    at = base.columns.index("text")
    others = [f for f in base.schema.fields if f.name != "text"]
    schema = T.StructType([*others, T.StructField("features", T.ArrayType(T.FloatType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(at)):
                part = batch.slice(chunk.first, chunk.n)
                found = pa.array(list(features(chunk).astype(np.float32)), pa.list_(pa.float32()))
                yield pa.RecordBatch.from_arrays([*[c for i, c in enumerate(part.columns) if i != at], found], names=schema.names)

    return base.mapInArrow(run, schema)


@dataclass
class Scorer:
    """Weights of the bins of each feature, and a bias; ``None`` weights score 0."""

    edges: np.ndarray
    weights: np.ndarray | None
    bias: float = 0.0

    def places(self, x: np.ndarray) -> np.ndarray:
        """The weight index of each row's bin, feature by feature."""
        bins = np.stack([np.searchsorted(self.edges[k], x[:, k], "right") for k in range(x.shape[1])], axis=1)
        return bins + np.arange(x.shape[1]) * BINS

    def margin(self, x: np.ndarray) -> np.ndarray:
        return self.bias + self.weights[self.places(x)].sum(axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.zeros(len(x)) if self.weights is None or not len(x) else _sigmoid(self.margin(x))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def bin_edges(x: np.ndarray) -> np.ndarray:
    """Inner quantiles of each feature; features with few values have fewer bins."""
    return np.quantile(x, np.arange(1, BINS) / BINS, axis=0).T


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, edges: np.ndarray, plain: bool = False) -> Scorer:
    """The scorer of least risk, by gradient descent (Adam) over the whole sample.
    ``plain`` takes the unlabelled rows as negatives (logistic regression) instead,
    with ``prior`` the positives' share of the weight."""
    scorer = Scorer(edges, np.zeros(edges.shape[0] * BINS))
    p, u = scorer.places(positive), scorer.places(unlabelled)
    theta = np.zeros(len(scorer.weights) + 1)
    m, v = np.zeros_like(theta), np.zeros_like(theta)

    def slope(places: np.ndarray, of: np.ndarray) -> np.ndarray:
        by_bin = np.bincount(places.ravel(), np.repeat(of, places.shape[1]), len(theta) - 1)
        return np.append(by_bin, of.sum()) / len(of)

    for step in range(1, STEPS + 1):
        sp, su = (_sigmoid(theta[-1] + theta[places].sum(axis=1)) for places in (p, u))
        if plain:
            grad = prior * slope(p, sp - 1) + (1 - prior) * slope(u, su)
        else:
            # Sigmoid loss: s as a negative, 1 - s as a positive; its slope is s (1 - s).
            of_positives = slope(p, sp * (1 - sp))
            as_negative = slope(u, su * (1 - su)) - prior * of_positives
            excess = su.mean() - prior * sp.mean()
            grad = as_negative - prior * of_positives if excess >= 0 else -as_negative
        grad += RIDGE / len(p) * np.append(theta[:-1], 0)
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        theta -= 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Scorer(edges, theta[:-1], float(theta[-1]))


def score(rows: DataFrame, scorer: Scorer) -> DataFrame:
    """``rows`` of a feature table with ``score`` in place of ``features``."""
    shared = rows.sparkSession.sparkContext.broadcast(scorer)
    base = rows.drop("score")
    at = base.columns.index("features")
    schema = T.StructType([*[f for f in base.schema.fields if f.name != "features"], T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(at).flatten().to_numpy(zero_copy_only=False).reshape(-1, N_FEATURES)
            yield pa.RecordBatch.from_arrays([*[c for i, c in enumerate(batch.columns) if i != at], pa.array(shared.value.score(x))], names=schema.names)

    return base.mapInArrow(run, schema)


def class_prior(rows: DataFrame, positives: DataFrame, ranker: Scorer, edges: np.ndarray) -> float:
    """Share of positives among all ``rows``, from all rows and all labelled positives:
    the least ratio of the two shares above a rank that ``LEAST_POSITIVES`` of the
    positives reach."""
    marked = rows.join(positives.withColumn("_good", F.lit(True)), "doc_id", "left").select("features", F.coalesce("_good", F.lit(False)).alias("good"))
    rank = sum((F.col("score") > float(e)).cast("int") for e in edges)
    by_rank = score(marked, ranker).groupBy(rank.alias("rank")).agg(F.count("*").alias("n"), F.count_if("good").alias("good"))
    found = sorted(tuple(r) for r in by_rank.collect())
    above = np.array([(n, good) for _, n, good in found], float)[::-1].cumsum(axis=0)
    share, reach = above[:, 0] / above[-1, 0], above[:, 1] / max(above[-1, 1], 1)
    return float(np.clip((share / np.maximum(reach, 1e-9))[reach >= LEAST_POSITIVES].min(initial=1.0), 0.01, 0.99))


def _sample(rows: DataFrame, limit: int) -> np.ndarray:
    # A row's whole key: those of one doc_id are told apart by what they hold.
    found = rows.orderBy(F.xxhash64("doc_id"), "features").limit(limit).select("features").toArrow()["features"]
    return found.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, N_FEATURES).astype(float)


def train(rows: DataFrame, positives: DataFrame, sample: int = SAMPLE) -> tuple[Scorer, float]:
    """The scorer and the class prior for a stored feature table ``rows``, with
    ``positives(doc_id)`` the trusted ones."""
    positives, rows = positives.where("doc_id is not null").select("doc_id").distinct(), rows.select("doc_id", "features")
    one, other = (positives.where(F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2)) == k) for k in (0, 1))
    unlabelled = _sample(rows, sample)
    halves = [_sample(rows.join(half, "doc_id", "left_semi"), sample // 2) for half in (one, other)]
    positive = np.concatenate(halves)
    if not len(positive):
        return Scorer(np.zeros((N_FEATURES, BINS - 1)), None), 0.0
    edges, prior = bin_edges(unlabelled), 0.5
    if len(halves[0]) and len(halves[1]):
        ranker = fit(halves[0], unlabelled, 0.5, edges, plain=True)
        ranks = np.unique(np.quantile(ranker.score(halves[1]), np.arange(1, RANKS) / RANKS))
        prior = class_prior(rows, other, ranker, ranks)
    return fit(positive, unlabelled, prior, edges), prior


def classify(docs: DataFrame, positives: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``docs`` without ``text`` and with ``score``, 0 to 1, higher: likelier good."""
    rows = stored(feature_table(docs), "pu-features")
    return score(rows, train(rows, positives, sample)[0])

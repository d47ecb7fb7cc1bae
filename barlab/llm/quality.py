"""Line quality by a linear-chain conditional random field.

Every line of a text is content or boilerplate.  Scores of a line come from its
features (words, symbols, capitals, digits, repeats, punctuation), scores of
neighbouring lines from the label pair; Viterbi decoding finds the best label
sequence of the whole text.  A document is kept if at least ``min_share`` of its
words stand in content lines, unless it fails the base rules.

The field is fitted by maximum conditional likelihood (forward-backward, L2) on
``sample_docs`` labelled documents at most, half of each ``quality``, those
with the least hash of ``doc_id``, of at most ``sample_lines`` lines.  Labels of
lines are hidden; the document's label only says on which side of ``min_share`` its
words in content lines lie.  So the lines are first scored without their neighbours,
with the document's label for each; then a line takes the label of its own score, unless
a document would come out on the wrong side (its lines keep its label), twice; and the
chain is fitted to those labels, which vary inside a document.  Everything else
covers every whole text.

Defined results: a null or empty text is one empty line, has no words and fails
the base rules; a share of no words is 0; with no usable labels nothing is
learned and every line is content; repeated rows are judged each; ties of
label sequences go to content.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlab.llm.textvec import WORDLIKE, Chunk, chunks, long_hash, mix, prefix_hash, range_hash, tally, windows, words

MIN_SHARE = 0.5
SAMPLE_DOCS = 3000
SAMPLE_LINES = 300
N_FEATURES = 13


def _table(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[[ord(c) for c in chars]] = True
    return out


_SYMBOL = _table("#*$%&|<>")
_UPPER = _table("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LETTER = _UPPER | _table("abcdefghijklmnopqrstuvwxyz")
_DIGIT = _table("0123456789")
_MARK = _table("!\"/:;=?@[\\]^_`{}~+")
_STOP = _table(".!?")


class Lines:
    """Statistics of a chunk's rows, and the features of all its lines."""

    def __init__(self, chunk: Chunk):
        buf, w = chunk.buf, words(chunk)
        n = len(w.start)
        sums = prefix_hash(buf)
        breaks = np.flatnonzero(buf == 0x0A)
        self.row = np.concatenate([np.arange(chunk.n), np.searchsorted(chunk.bounds, breaks, "right") - 1])
        start = np.concatenate([chunk.bounds[:-1], breaks + 1])
        order = np.lexsort((start, self.row))
        self.row, start = self.row[order], start[order]
        last = np.append(self.row[1:] != self.row[:-1], True) if len(start) else np.zeros(0, bool)
        end = np.where(last, chunk.bounds[self.row + 1], np.append(start[1:], 0) - 1) if len(start) else start
        self.first = np.searchsorted(self.row, np.arange(chunk.n + 1))

        word_hash = long_hash(buf, w.start, w.end, range_hash(sums, w.start, w.end))
        at, value = windows(word_hash, w.row, 3)
        value = mix(value ^ (w.row[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
        by = np.argsort(value, kind="stable")
        same = value[by][1:] == value[by][:-1]
        often = np.zeros(len(at), bool)
        often[by[1:][same]] = True
        often[by[:-1][same]] = True
        depth = np.zeros(n + 1, np.int64)
        np.add.at(depth, at[often], 1)
        np.add.at(depth, at[often] + 3, -1)
        repeated = np.cumsum(depth[:n]) > 0

        a, b = np.searchsorted(w.start, start), np.searchsorted(w.start, end)
        self.n_words = b - a
        hashes = long_hash(buf, start, end, range_hash(sums, start, end)) if len(start) else np.zeros(0, np.uint64)
        by = np.lexsort((start, hashes, self.row))
        again = np.zeros(len(start), bool)
        again[by[1:]] = (hashes[by][1:] == hashes[by][:-1]) & (self.row[by][1:] == self.row[by][:-1])
        again &= self.n_words > 0

        points = tally((buf & 0xC0) != 0x80)
        per_row = lambda t: t[w.first[1:]] - t[w.first[:-1]]  # noqa: E731  a tally over words
        symbols = tally(_SYMBOL[buf])
        self.stats = {
            "n_words": np.diff(w.first),
            "word_chars": per_row(tally(points[w.end] - points[w.start])),
            "n_symbols": symbols[chunk.bounds[1:]] - symbols[chunk.bounds[:-1]],
            "n_dup_lines": np.bincount(self.row[again], minlength=chunk.n),
            "n_repeat_words": per_row(tally(repeated)),
        }

        def share(mask, of):
            t = tally(mask[buf])
            return (t[end] - t[start]) / np.maximum(of, 1)

        size = np.maximum(self.n_words, 1)
        rep, twin = tally(repeated), tally(np.append(False, (word_hash[1:] == word_hash[:-1]) & (w.row[1:] == w.row[:-1])) if n else np.zeros(0, bool))
        letters = tally(_LETTER[buf])
        solid = tally(WORDLIKE[buf])
        bare = tally(solid[w.end] == solid[w.start])  # words of marks only
        tail = np.zeros(len(start), bool)
        full = np.flatnonzero(self.n_words)
        tail[full] = _STOP[buf[w.end[b[full] - 1] - 1]]
        self.features = np.stack(
            [
                np.ones(len(start)),
                np.log1p(self.n_words) / 3,
                np.minimum(share(_SYMBOL, size), 3),
                share(_UPPER, letters[end] - letters[start]),
                share(_DIGIT, np.maximum(end - start, 1)) * 4,
                np.minimum(share(_MARK, size), 3),
                (rep[b] - rep[a]) / size,
                again,
                tail,
                np.minimum((points[end] - points[start]) / size, 30) / 10,
                (twin[b] - twin[a]) / size,
                self.n_words == 0,
                2 * (bare[b] - bare[a]) / size,
            ],
            axis=1,
        )


def _by_step(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequences in order of falling length, and how many have a step t."""
    size = np.diff(first)
    order = np.argsort(-size, kind="stable")
    steps = int(size.max(initial=0))
    return order, np.searchsorted(-size[order], -np.arange(steps), "left")


class ChainField:
    """Weights of the line features for (boilerplate, content), and of label pairs."""

    def __init__(self, emit: np.ndarray, pair: np.ndarray):
        self.emit, self.pair = emit, pair

    def decode(self, features: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Best labels (1: content) of each sequence, by Viterbi."""
        scores = features @ self.emit
        order, alive = _by_step(first)
        begin = first[:-1][order]
        back = np.zeros((len(scores), 2), np.int8)
        labels = np.zeros(len(scores), np.int8)
        best = np.zeros((len(order), 2))
        for t, n in enumerate(alive):
            at = begin[:n] + t
            if t:
                come = best[:n, :, None] + self.pair
                back[at] = come[:, 1] >= come[:, 0]
                best[:n] = come.max(axis=1)
            best[:n] += scores[at]
        now = (best[:, 1] >= best[:, 0]).astype(np.int8)
        for t in range(len(alive) - 1, -1, -1):
            n = alive[t]
            at = begin[:n] + t
            labels[at] = now[:n]
            if t:
                now[:n] = back[at, now[:n]]
        return labels

    @staticmethod
    def fit(features: np.ndarray, first: np.ndarray, labels: np.ndarray, steps: int = 160, ridge: float = 3e-4) -> ChainField:
        """Maximum conditional likelihood per line, by gradient ascent (Adam)."""
        k = features.shape[1]
        order, alive = _by_step(first)
        begin = first[:-1][order]
        total = max(len(labels), 1)
        gold = np.eye(2)[labels]
        inner = np.ones(len(labels), bool)
        inner[first[:-1][np.diff(first) > 0]] = False
        pairs = np.zeros((2, 2))
        np.add.at(pairs, (labels[np.flatnonzero(inner) - 1], labels[inner]), 1)
        theta, m, v = np.zeros(2 * k + 4), 0.0, 0.0
        for step in range(1, steps + 1):
            pair = theta[2 * k :].reshape(2, 2)
            scores = features @ theta[: 2 * k].reshape(k, 2)
            fwd, bwd = np.zeros((len(labels), 2)), np.zeros((len(labels), 2))
            for t, n in enumerate(alive):
                at = begin[:n] + t
                fwd[at] = scores[at] + (np.logaddexp.reduce(fwd[at - 1][:, :, None] + pair, axis=1) if t else 0)
            for t in range(len(alive) - 2, -1, -1):
                at = begin[: alive[t + 1]] + t
                bwd[at] = np.logaddexp.reduce(pair + (scores[at + 1] + bwd[at + 1])[:, None, :], axis=2)
            both = fwd + bwd
            norm = np.logaddexp(both[:, 0], both[:, 1])
            marginal = np.exp(both - norm[:, None])
            at = np.flatnonzero(inner)
            joint = np.exp(fwd[at - 1][:, :, None] + pair + (scores[at] + bwd[at])[:, None, :] - norm[at][:, None, None]).sum(axis=0)
            grad = np.concatenate([(features.T @ (gold - marginal)).ravel(), (pairs - joint).ravel()]) / total - ridge * theta
            m = 0.9 * m + 0.1 * grad
            v = 0.99 * v + 0.01 * grad**2
            theta = theta + 0.2 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        return ChainField(theta[: 2 * k].reshape(k, 2), theta[2 * k :].reshape(2, 2))


def line_labels(features: np.ndarray, first: np.ndarray, quality: np.ndarray, min_share: float = MIN_SHARE, rounds: int = 2) -> np.ndarray:
    """Labels of the lines of documents of which only the quality is known."""
    sizes = np.diff(first)
    given = np.repeat(quality, sizes)
    row = np.repeat(np.arange(len(sizes)), sizes)
    n_words = np.expm1(3 * features[:, 1])
    labels = given
    for _ in range(rounds):
        alone = ChainField.fit(features, np.arange(len(labels) + 1), labels)
        own = (features @ (alone.emit[:, 1] - alone.emit[:, 0]) >= 0).astype(given.dtype)
        inside = np.bincount(row, n_words * own, len(sizes)) / np.maximum(np.bincount(row, n_words, len(sizes)), 1)
        right = (inside >= min_share) == (quality == 1)
        labels = np.where(right[row], own, given)
    return labels


def _sample_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for chunk in chunks(batch.column(0)):
            lines = Lines(chunk)
            size = np.diff(lines.first)
            some = np.flatnonzero((size <= SAMPLE_LINES) & (lines.stats["n_words"] > 0))
            rows = [lines.features[lines.first[r] : lines.first[r + 1]].ravel() for r in some]
            yield pa.RecordBatch.from_arrays([batch.column(1).slice(chunk.first, chunk.n).take(pa.array(some)), batch.column(2).slice(chunk.first, chunk.n).take(pa.array(some)), pa.array(rows, pa.list_(pa.float64()))], names=["quality", "order", "features"])


def fit_field(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> ChainField:
    """The field learned from ``labels(doc_id, quality)`` on a bounded sample."""
    label = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).where("doc_id is not null and quality in (0, 1)")
    label = label.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    least = lambda q: label.where(F.col("quality") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs // 2)
    chosen = least(0).unionByName(least(1))
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id")
    rows = rows.select("text", "quality", F.xxhash64("doc_id").alias("order")).mapInArrow(_sample_features, "quality int, order long, features array<double>")
    found = rows.orderBy("order", "quality", "features").limit(sample_docs).collect()
    if len({r.quality for r in found}) < 2:
        return ChainField(np.tile([0.0, 1.0], (N_FEATURES, 1)) * (np.arange(N_FEATURES) == 0)[:, None], np.zeros((2, 2)))
    sizes = np.array([len(r.features) // N_FEATURES for r in found])
    features = np.concatenate([np.array(r.features) for r in found]).reshape(-1, N_FEATURES)
    first = np.concatenate([[0], np.cumsum(sizes)])
    return ChainField.fit(features, first, line_labels(features, first, np.array([r.quality for r in found])))


_NEW = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def label_lines(docs: DataFrame, field: ChainField, min_share: float = MIN_SHARE) -> DataFrame:
    """``docs`` with the base statistics, ``line_is_content`` (one boolean for each
    line), ``content_share``, ``base_failed`` and ``kept``; columns of ``docs``
    with these names are replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(field)
    base = docs.drop(*_NEW, "line_is_content", "content_share", "base_failed", "kept")
    at = base.columns.index("text")
    schema = T.StructType([*base.schema.fields, *[T.StructField(c, T.LongType()) for c in _NEW], T.StructField("line_is_content", T.ArrayType(T.BooleanType())), T.StructField("content_share", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(at)):
                lines = Lines(chunk)
                content = shared.value.decode(lines.features, lines.first)
                inside = np.bincount(lines.row, lines.n_words * content, chunk.n)
                share = inside / np.maximum(lines.stats["n_words"], 1)
                marks = pa.ListArray.from_arrays(pa.array(lines.first, pa.int32()), pa.array(content.astype(bool)))
                stats = [pa.array(lines.stats[c], pa.int64()) for c in _NEW]
                yield pa.RecordBatch.from_arrays([*batch.slice(chunk.first, chunk.n).columns, *stats, marks, pa.array(share)], names=schema.names)

    rows = base.mapInArrow(run, schema)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return rows.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("content_share") >= min_share))

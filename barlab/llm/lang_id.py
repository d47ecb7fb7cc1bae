"""Language identification by rank-order profiles.

Each language's profile is the list of its ``top`` most frequent letter
1- to 3-grams, most frequent first; a document's profile is made the same way
from its whole text.  A document is compared to a language by the out-of-place
distance: the sum, over the document's n-grams, of how far each one's rank
differs, with ``top`` for an n-gram the language's profile lacks.  The nearest
language wins (on a tie, the one first in alphabetical order).

Letters are the code points of Python's ``str.isalpha`` after ``str.lower``;
everything else is a word break, one blank wide, and no trigram has a blank in
its middle.  Counting n-grams runs on every training document: each task sums
its own counts per language before the shuffle.  What reaches the driver is
``top`` rows for each language.

Defined results: a null, empty or letterless text is ``und`` with score 0; with
no training rows at all every text is ``und``; ties of n-gram counts go to the
lower code; repeated rows are scored each on its own and counted each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UND = "und"
TOP = 300
_SHIFT = 21
_alpha: list[np.ndarray] = []


def is_training_row(doc_id: str | Column = "doc_id") -> Column:
    """True unless crc32 of the id's text leaves remainder 2 modulo 4; a null id
    is a training row."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(col.cast("string")) % 4 != 2, F.lit(True))


def _letters() -> np.ndarray:
    if not _alpha:
        _alpha.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _alpha[0]


def _symbols(text: str) -> np.ndarray:
    """Code points + 2 of the letters, 1 for each run of other characters, and a
    1 at both ends; empty if there is no letter."""
    cp = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[cp]
    if not letter.any():
        return np.zeros(0, np.int64)
    out = np.ones(len(cp) + 2, np.int64)
    out[1:-1][letter] = cp[letter].astype(np.int64) + 2
    keep = out != 1
    keep[0] = True
    keep[1:] |= out[:-1] != 1
    out = out[keep]
    return out if out[-1] == 1 else np.append(out, 1)


def _grams(symbols: np.ndarray, base: int) -> np.ndarray:
    """Codes of all 1-, 2- and 3-grams, digits in ``base``."""
    s = symbols
    pairs = s[:-1] * base + s[1:]
    triples = (pairs[:-1] * base + s[2:])[s[1:-1] != 1]
    return np.concatenate([s[s != 1], pairs, triples])


def _dense(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Symbols renumbered 1, 2, .. in their order (1 stays the blank); the values
    by number; the base for :func:`_grams`."""
    seen = np.zeros(0x110002, bool)
    seen[symbols] = True
    seen[1] = True
    values = np.concatenate([[0], np.flatnonzero(seen)])
    number = np.zeros(0x110002, np.int64)
    number[values] = np.arange(len(values))
    return number[symbols], values, len(values)


def _packed(codes: np.ndarray, values: np.ndarray, base: int) -> np.ndarray:
    """Dense codes as codes of code points, 21 bits a symbol; keeps their order."""
    codes = codes.astype(np.int64)
    first, rest = np.divmod(codes, base * base)
    second, third = np.divmod(rest, base)
    return (values[first] << (2 * _SHIFT)) | (values[second] << _SHIFT) | values[third]


def _count(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    symbols = [s for s in map(_symbols, texts) if len(s)]
    if not symbols:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    number, values, base = _dense(np.concatenate(symbols))
    at, codes = 0, []
    for s in symbols:
        codes.append(_grams(number[at : at + len(s)], base))
        at += len(s)
    codes = np.concatenate(codes)
    if base**3 <= 1 << 22:
        n = np.bincount(codes)
        found = np.flatnonzero(n)
        n = n[found]
    else:
        found, n = np.unique(codes, return_counts=True)
    return _packed(found, values, base), n


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    codes, back = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return codes, np.bincount(back, np.concatenate([p[1] for p in parts]), len(codes)).astype(np.int64)


def _slices(batch: pa.RecordBatch, limit: int = 1 << 21) -> Iterator[tuple[int, list[str]]]:
    """First row and texts of runs of rows of about ``limit`` characters."""
    texts, size, first = [], 0, 0
    for i, x in enumerate(batch.column("text")):
        texts.append(x.as_py() or "")
        size += len(texts[-1])
        if size >= limit:
            yield first, texts
            texts, size, first = [], 0, i + 1
    if texts:
        yield first, texts


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        for first, texts in _slices(batch):
            by: dict[str, list[str]] = {}
            for lang, text in zip(langs[first : first + len(texts)], texts):
                by.setdefault(lang, []).append(text)
            for lang, own in by.items():
                parts = total.setdefault(lang, [])
                parts.append(_count(own))
                if len(parts) > 16:
                    total[lang] = [_merged(parts)]
    for lang, parts in total.items():
        codes, n = _merged(parts)
        for at in range(0, len(codes), 100_000):
            c = codes[at : at + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(c), pa.string()), pa.array(c), pa.array(n[at : at + 100_000])], names=["lang", "gram", "n"])


def train_profiles(docs: DataFrame, top: int = TOP) -> DataFrame:
    """``(lang, rank, gram)``: rank 0 is the language's most frequent n-gram.
    Rows with a null ``lang`` or ``text`` teach nothing."""
    rows = docs.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    counts = rows.where("lang is not null and text is not null").mapInArrow(_gram_counts, "lang string, gram long, n long")
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    summed = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    # A filter on the plain row number is applied before the shuffle too (WindowGroupLimit),
    # so at most ``top`` n-grams of each language and task meet in its window.
    ranked = summed.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= top)
    return ranked.select("lang", (F.col("nth") - 1).alias("rank"), "gram")


class Profiles:
    """All languages' ranks by n-gram: a table of (language, n-gram) ranks with
    ``top`` where the profile has none."""

    def __init__(self, rows: list[tuple[str, int, int]], top: int):
        self.top = top
        self.langs = sorted({r[0] for r in rows})
        at = {lang: i for i, lang in enumerate(self.langs)}
        self.grams = np.unique(np.array([r[2] for r in rows], np.int64))
        self.ranks = np.full((len(self.langs), len(self.grams) + 1), top, np.int32)
        for lang, rank, gram in rows:
            self.ranks[at[lang], np.searchsorted(self.grams, gram)] = rank

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        found, scores = [UND] * len(texts), [0.0] * len(texts)
        symbols = [_symbols(t) for t in texts]
        if not self.langs or not any(map(len, symbols)):
            return found, scores
        number, values, base = _dense(np.concatenate(symbols))
        kind = np.int32 if base**3 < 1 << 31 else np.int64
        at = 0
        for i, s in enumerate(symbols):
            if not len(s):
                continue
            codes, n = np.unique(_grams(number[at : at + len(s)].astype(kind), base), return_counts=True)
            at += len(s)
            best = _packed(codes[np.argsort(-n, kind="stable")[: self.top]], values, base)
            col = np.searchsorted(self.grams, best)
            col[self.grams[np.minimum(col, len(self.grams) - 1)] != best] = len(self.grams)
            ranks = self.ranks[:, col]
            away = np.where(ranks == self.top, self.top, np.abs(ranks - np.arange(len(best)))).sum(axis=1)
            k = int(away.argmin())
            found[i], scores[i] = self.langs[k], 1 - float(away[k]) / (self.top * len(best))
        return found, scores


def identify(docs: DataFrame, profiles: DataFrame, top: int = TOP) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (1: same order as the profile, 0:
    no n-gram in common).  Only ``text`` is read for the prediction; columns of
    ``docs`` with these two names are replaced."""
    from pyspark.sql import types as T

    spark = docs.sparkSession
    model = Profiles([tuple(r) for r in profiles.select("lang", "rank", "gram").collect()], top)
    shared = spark.sparkContext.broadcast(model)
    base = docs.drop("lang_pred", "score")
    schema = T.StructType([*base.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores = [], []
            for _, texts in _slices(batch):
                a, b = shared.value.predict(texts)
                langs += a
                scores += b
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=[*batch.schema.names, "lang_pred", "score"])

    return base.mapInArrow(run, schema)

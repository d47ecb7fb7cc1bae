"""Resampling towards a target distribution by hashed n-gram importance weights.

Features of a text are its runs of 1 to ``MAX_N`` consecutive words (lower-cased A-Z,
words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``), repeats counted; a feature's bucket is the
CRC-32 of its UTF-8 bytes modulo ``buckets``.  A bucket's gain is 1000 times the
logarithm of its smoothed share among the target's features over that among the
corpus's, floored; a document's weight is the floored mean gain of its features.
Adding Gumbel noise to the weights and taking the greatest draws documents
without replacement in proportion to exp(weight / 1000).

Texts are handled a batch at a time: a batch's texts are joined with a separator
that no word holds, one regular-expression pass over the joined bytes finds all
words, ``searchsorted`` on the texts' offsets says whose each word is, n-grams that
cross texts are masked, and ``bincount`` sums what is left by bucket or by text.  A
batch is at most ``CHUNK_BYTES`` of text (a longer text is one by itself, never cut),
so memory does not follow the table.  What reaches the driver and the tasks is
``buckets`` numbers.

Defined results: null, empty and wordless texts have no features, weight 0, and are
never drawn (nor is any text under ``min_words`` words); an empty corpus or target
leaves its side with the smoothing only; repeated rows are documents each; a null
``doc_id`` has the noise of the name ``"<seed>:"`` and comes last among ties; rows that tie
in everything take the ranks in some order.
"""

from __future__ import annotations

import itertools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlab.llm.ordering import numbered
from barlab.llm.scratch import stored
from barlab.llm.textvec import chunks

BUCKETS = 10_000
MAX_N = 2
MIN_WORDS = 20
SHARE = 25  # percent of the documents with enough words
SEED = 7
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_SEPARATOR = b"\x00"
_LONG = 64  # bytes of a word beyond which zlib takes over
_ONES = np.uint32(0xFFFFFFFF)


def _crc_table() -> np.ndarray:
    register = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        register = np.where(register & 1, (register >> 1) ^ np.uint32(0xEDB88320), register >> 1).astype(np.uint32)
    return register


_CRC = _crc_table()


class _Words:
    """The words of a batch: bounds in the joined bytes, and the text of each."""

    def __init__(self, texts: list[bytes]):
        self.joined = _SEPARATOR.join(texts).lower()  # bytes.lower changes A-Z only
        self.buf = np.frombuffer(self.joined, np.uint8)
        spans = itertools.chain.from_iterable(m.span() for m in _WORD.finditer(self.joined))
        bounds = np.fromiter(spans, np.int64).reshape(-1, 2)
        self.start, self.end = bounds[:, 0], bounds[:, 1]
        offsets = np.cumsum([0, *[len(t) + 1 for t in texts[:-1]]])
        self.row = np.searchsorted(offsets, self.start, "right") - 1
        size = self.end - self.start
        self._order = np.argsort(-size, kind="stable")
        self._alive = np.searchsorted(-size[self._order], -np.arange(min(_LONG, size.max(initial=0))), "left")
        self._long = np.flatnonzero(size > _LONG)

    def extend(self, register: np.ndarray) -> np.ndarray:
        """CRC registers after each word's bytes, from the registers before them;
        one byte of all words at a time."""
        now, start = register[self._order], self.start[self._order]
        for t, n in enumerate(self._alive):
            live = now[:n]
            now[:n] = _CRC[(live ^ self.buf[start[:n] + t]) & np.uint32(0xFF)] ^ (live >> np.uint32(8))
        out = np.empty_like(now)
        out[self._order] = now
        for i in self._long:
            rest = self.joined[self.start[i] + _LONG : self.end[i]]
            out[i] = zlib.crc32(rest, int(out[i] ^ _ONES)) ^ 0xFFFFFFFF
        return out

    def features(self, max_n: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
        """``(row, bucket)`` of every run of 1 to ``max_n`` words of one text."""
        register = self.extend(np.full(len(self.start), _ONES, np.uint32))
        rows, crcs = [self.row], [register ^ _ONES]
        for n in range(2, max_n + 1):
            # The run that ends at a word is the run of n - 1 words before it, a space, the word.
            before = np.roll(register, 1)
            before = _CRC[(before ^ np.uint32(0x20)) & np.uint32(0xFF)] ^ (before >> np.uint32(8))
            register = self.extend(before)
            inside = np.zeros(len(register), bool)
            inside[n - 1 :] = self.row[n - 1 :] == self.row[: len(self.row) - n + 1]
            rows.append(self.row[inside])
            crcs.append(register[inside] ^ _ONES)
        return np.concatenate(rows), (np.concatenate(crcs) % np.uint32(buckets)).astype(np.int64)


def _batches(batch: pa.RecordBatch, column: int) -> Iterator[tuple[pa.RecordBatch, _Words]]:
    for chunk in chunks(batch.column(column)):
        data = chunk.buf.tobytes()
        texts = [data[a:b] for a, b in itertools.pairwise(chunk.bounds.tolist())]
        yield batch.slice(chunk.first, chunk.n), _Words(texts)


def bucket_counts(texts: DataFrame, column: str = "text", max_n: int = MAX_N, buckets: int = BUCKETS) -> np.ndarray:
    """Number of features of all texts by bucket; each task sends one row a bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, words in _batches(batch, 0):
                total += np.bincount(words.features(max_n, buckets)[1], minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], names=["bucket", "n"])

    rows = texts.select(F.col(column).cast("string")).mapInArrow(run, "bucket int, n long")
    found = rows.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(buckets, np.int64)
    out[found["bucket"].to_numpy()] = found["n"].to_numpy()
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Floored 1000 * log of each bucket's share in the target over that in the corpus."""
    more = (target + 1.0) * (float(corpus.sum()) + len(corpus))
    less = (corpus + 1.0) * (float(target.sum()) + len(target))
    return np.floor(1000 * np.log(more / less)).astype(np.int64)


def weigh(docs: DataFrame, table: np.ndarray, max_n: int = MAX_N) -> DataFrame:
    """``docs`` with ``n_words``, ``n_features`` and ``weight``; columns of these names are
    replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(table)
    base = docs.drop("n_words", "n_features", "weight").withColumn("text", F.col("text").cast("string"))
    at = base.columns.index("text")
    schema = T.StructType([*base.schema.fields, *[T.StructField(c, T.LongType()) for c in ("n_words", "n_features", "weight")]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        for batch in batches:
            for part, words in _batches(batch, at):
                row, bucket = words.features(max_n, len(gain))
                count = np.bincount(row, minlength=part.num_rows)
                total = np.bincount(row, gain[bucket], part.num_rows).astype(np.int64)
                new = [np.bincount(words.row, minlength=part.num_rows), count, total // np.maximum(count, 1)]
                yield pa.RecordBatch.from_arrays([*part.columns, *[pa.array(x, pa.int64()) for x in new]], names=schema.names)

    return base.mapInArrow(run, schema)


def noise(doc_id: str = "doc_id", seed: int = SEED) -> Column:
    """1000 times a Gumbel draw that ``doc_id`` decides, floored."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def resample(docs: DataFrame, target: DataFrame, share: int = SHARE, min_words: int = MIN_WORDS, seed: int = SEED, max_n: int = MAX_N, buckets: int = BUCKETS) -> DataFrame:
    """``(doc_id, n_features, weight, score, rank)`` of every document; ``rank`` counts
    the drawn ones from 1, ``share`` percent of those with ``min_words`` words."""
    table = gains(bucket_counts(docs, "text", max_n, buckets), bucket_counts(target, "text", max_n, buckets))
    rows = weigh(docs.select("doc_id", "text"), table, max_n).drop("text")
    rows = rows.withColumn("score", F.col("weight") + noise(seed=seed)).withColumn("able", F.col("n_words") >= min_words)
    placed = numbered(stored(rows, "weights"), ["able"], [F.desc("score"), F.asc_nulls_last("doc_id")], "draws")
    drawn = F.col("able") & (F.col("pos") < F.floor(F.col("total") * share / 100))
    return placed.select("doc_id", "n_features", "weight", "score", F.when(drawn, F.col("pos") + 1).alias("rank"))


ORACLE_SQL = r"""
WITH words AS (
  SELECT 0 AS side, doc_id AS id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
  UNION ALL
  SELECT 1, NULL, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark),
features AS (
  SELECT side, id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM words),
counts AS (SELECT side, id, f, count(*) AS n FROM features GROUP BY ALL),
-- CRC-32 by its rule, a byte and seven empty steps at a time.
crcs AS (
  SELECT f, xor(4294967295, list_reduce(flatten(list_transform(string_split(trim(regexp_replace(hex(encode(f)), '(..)', '\1 ', 'g')), ' '),
      lambda x: [CAST('0x' || x AS BIGINT), 0, 0, 0, 0, 0, 0, 0])),
    lambda r, x: xor(xor(r, x) // 2, CASE WHEN xor(r, x) % 2 = 1 THEN 3988292384 ELSE 0 END), 4294967295)) % 10000 AS bucket
  FROM (SELECT DISTINCT f FROM counts)),
sides AS (
  SELECT bucket, coalesce(sum(n) FILTER (side = 0), 0) AS s, coalesce(sum(n) FILTER (side = 1), 0) AS t FROM counts JOIN crcs USING (f) GROUP BY bucket),
totals AS (SELECT sum(s) AS s_all, sum(t) AS t_all FROM sides),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln(CAST((t + 1) * (s_all + 10000) AS DOUBLE) / CAST((s + 1) * (t_all + 10000) AS DOUBLE))) AS BIGINT) AS gain FROM sides CROSS JOIN totals),
weights AS (
  SELECT id AS doc_id, CAST(sum(n) AS BIGINT) AS n_features, CAST(floor(sum(n * gain) / sum(n)) AS BIGINT) AS weight
  FROM counts JOIN crcs USING (f) JOIN gains USING (bucket) WHERE side = 0 GROUP BY id),
noise AS (
  SELECT doc_id, CAST(floor(-1000 * ln(-ln((CAST('0x' || left(sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')), 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS g FROM documents),
scored AS (
  SELECT d.id AS doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + g AS score, coalesce(len(w), 0) >= 20 AS able
  FROM words d JOIN noise ON noise.doc_id = d.id LEFT JOIN weights ON weights.doc_id = d.id WHERE side = 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY able ORDER BY score DESC, doc_id) AS pos, count(*) OVER (PARTITION BY able) AS n FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN able AND pos <= n * 25 // 100 THEN pos END AS rank FROM placed
"""

"""Line-level deduplication over levelled sorted runs of line keys (DataFrame
functions only).

A line's key is the line without ``[\\x20\\x09-\\x0D]`` at its ends and with A-Z
lower-cased; keys of at least ``min_chars`` code points count, by their 128-bit
MD5.  :class:`LineRuns` keeps them the way a log-structured merge tree does:

* Documents arrive in batches.  A batch's keys are aggregated to one row per key
  (documents holding it, largest ``doc_id``) and sorted.
* One pass merges them with the runs: keys that no run has become a new
  sorted run of level 0; keys that some run has are marked as repeats.  A key is
  thus in one run only, so compacting runs never aggregates.
* When a level holds ``fanout`` runs they are merged into one run of the next.

Runs are bucketed and sorted tables in the shared folder, all with the same
buckets, so the joins read them in place, without a shuffle of the runs.  Names and
levels are kept beside them (:meth:`LineRuns.save`), so a later job reopens the
runs and adds its batches.

A key found in at least ``min_docs`` documents loses its lines everywhere but in
the largest ``doc_id`` that holds it.

Defined results: a null or empty text is one empty line; a document is a
``doc_id``: repeated rows with one id are one document for the counts, whether their
texts are equal or not, and each row is rewritten by the lines it has itself; a null
``doc_id`` is one document, the smallest; an empty table gives an empty result;
columns besides ``doc_id`` and ``text`` are kept, and ``n_lines``, ``n_dropped`` among
them are replaced.
"""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barlab.llm.names import row_name
from barlab.llm.scratch import scratch_dir, stored

MIN_CHARS = 20
MIN_DOCS = 3
BATCHES = 4
FANOUT = 2
BUCKET_ROWS = 1 << 19
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    """The line trimmed of ASCII white space and with A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(" \t\n\x0b\x0c\r")), _UPPER, _LOWER)


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def key_table(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``(doc_id, row, pos, key)`` of every line whose key is long enough; ``row`` names
    the row by its id and text."""
    lines = docs.select("doc_id", row_name().alias("row"), F.posexplode(split_lines(F.col("text"))).alias("pos", "line"))
    keyed = lines.select("doc_id", "row", "pos", line_key(F.col("line")).alias("k")).where(F.char_length("k") >= min_chars)
    return keyed.select("doc_id", "row", "pos", F.unhex(F.md5(F.encode("k", "UTF-8"))).alias("key"))


class LineRuns:
    """Sorted runs of line keys by level.  Each batch's table has the keys that were new
    when it came (the run) and, marked ``seen``, those that an older run has."""

    def __init__(self, spark: SparkSession, buckets: int, fanout: int = FANOUT, folder: str | None = None):
        self.spark, self.buckets, self.fanout = spark, buckets, fanout
        self.folder = folder or scratch_dir(spark, "line-runs")
        self.levels: list[list[str]] = [[]]
        self.batches: list[str] = []
        self._made: list[str] = []

    def _name(self) -> str:
        return f"line_run_{uuid.uuid4().hex}"

    def _write(self, rows: DataFrame) -> str:
        """``rows`` are dealt by key to the buckets and sorted."""
        name = self._name()
        rows.write.bucketBy(self.buckets, "key").sortBy("key").option("path", f"{self.folder}/{name}").saveAsTable(name)
        self._made.append(name)
        return name

    def _dealt(self, rows: DataFrame) -> DataFrame:
        return rows.repartition(self.buckets, "key").sortWithinPartitions("key")

    def run(self, name: str) -> DataFrame:
        """``(key, n_docs, max_doc)`` of the run ``name``."""
        return self.spark.table(name).where(~F.col("seen")).drop("seen")

    def add(self, batch: DataFrame) -> None:
        """Add the keys of new documents, ``(key, n_docs, max_doc)`` once per key.
        A document must be in one batch only."""
        rows, seen = self._dealt(batch), F.lit(False)
        for i, name in enumerate(n for level in self.levels for n in level):
            rows = rows.join(self.run(name).select("key", F.lit(True).alias(f"in_{i}")), "key", "left")
            seen = seen | F.col(f"in_{i}").isNotNull()
        made = self._write(rows.select("key", "n_docs", "max_doc", seen.alias("seen")))
        self.batches.append(made)
        self.levels[0].append(made)
        self._compact()

    def _compact(self) -> None:
        level = 0
        while len(self.levels[level]) >= self.fanout:
            runs = functools.reduce(DataFrame.unionByName, map(self.run, self.levels[level]))
            merged = self._write(self._dealt(runs).withColumn("seen", F.lit(False)))
            self.levels[level] = []
            level += 1
            if level == len(self.levels):
                self.levels.append([])
            self.levels[level].append(merged)

    def common(self, min_docs: int) -> DataFrame:
        """``(key, max_doc)`` of the keys that at least ``min_docs`` documents hold."""
        runs = functools.reduce(DataFrame.unionByName, [self.run(n) for level in self.levels for n in level])
        again = functools.reduce(DataFrame.unionByName, [self.spark.table(n).where("seen") for n in self.batches])
        again = again.groupBy("key").agg(F.sum("n_docs").alias("more"), F.max("max_doc").alias("later"))
        n_docs = F.col("n_docs") + F.coalesce("more", F.lit(0))
        rows = runs.join(again, "key", "left").where(n_docs >= min_docs)
        return rows.select("key", F.greatest("max_doc", "later").alias("max_doc"))

    def save(self) -> None:
        """Keep names and levels beside the runs, for :meth:`open`."""
        where = {n: i for i, level in enumerate(self.levels) for n in level}
        order = list(dict.fromkeys([*self.batches, *where]))
        rows = [(i, n, n in self.batches, where.get(n), self.buckets, self.fanout) for i, n in enumerate(order)]
        state = self.spark.createDataFrame(rows, "nth int, name string, is_batch boolean, level int, buckets int, fanout int")
        state.coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/state")

    @classmethod
    def open(cls, spark: SparkSession, folder: str) -> LineRuns:
        """Runs that were saved under ``folder``, in this session or another."""
        state = spark.read.parquet(f"{folder}/state").orderBy("nth").collect()
        runs = cls(spark, state[0].buckets, state[0].fanout, folder)
        for row in state:
            if not spark.catalog.tableExists(row.name):
                kind = spark.read.parquet(f"{folder}/{row.name}").schema["max_doc"].dataType.simpleString()
                columns = f"key BINARY, n_docs BIGINT, max_doc {kind}, seen BOOLEAN"
                spark.sql(f"CREATE TABLE {row.name} ({columns}) USING parquet CLUSTERED BY (key) SORTED BY (key) INTO {row.buckets} BUCKETS LOCATION '{folder}/{row.name}'")
            runs._made.append(row.name)
            if row.is_batch:
                runs.batches.append(row.name)
            while row.level is not None and len(runs.levels) <= row.level:
                runs.levels.append([])
            if row.level is not None:
                runs.levels[row.level].append(row.name)
        return runs

    def close(self) -> None:
        """Forget the tables' names; their files stay in the shared folder."""
        for name in self._made:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def batch_keys(keys: DataFrame, batches: int) -> DataFrame:
    """``(batch, key, n_docs, max_doc)`` of a key table, stored by batch; a document is in
    one batch."""
    held = keys.groupBy("key", "doc_id").agg(F.lit(1).alias("one"))
    batch = F.pmod(F.xxhash64("doc_id"), F.lit(batches)).cast("int")
    held = held.groupBy(batch.alias("batch"), "key").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("max_doc"))
    return stored(held, "line-batches", small=True, by=["batch"])


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, batches: int = BATCHES, fanout: int = FANOUT, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``docs`` with ``text`` rewritten and ``n_lines`` (before), ``n_dropped``.

    The key table is written once, its keys are aggregated once and dealt to ``batches``
    batches by document; runs have a bucket for each ``bucket_rows`` keys; the texts
    themselves are shuffled once, to meet the positions to drop.
    """
    docs = docs.drop("n_lines", "n_dropped")
    keys = stored(key_table(docs, min_chars), "line-keys")
    held = batch_keys(keys, batches)
    runs = LineRuns(docs.sparkSession, 1 + held.count() // bucket_rows, fanout)
    try:
        for b in range(batches):
            runs.add(held.where(F.col("batch") == b).drop("batch"))
        common = stored(runs.common(min_docs), "line-common", small=True)
    finally:
        runs.close()
    lost = keys.join(common, "key").where(~F.col("doc_id").eqNullSafe(F.col("max_doc")))
    drops = lost.groupBy("row").agg(F.array_sort(F.collect_set("pos")).alias("drop"))
    # The whole row is one column here, so that no name of its own meets another.
    rows = docs.select(row_name().alias("row"), F.struct("*").alias("doc")).join(drops, "row", "left")
    rows = rows.select("doc", split_lines(F.col("doc.text")).alias("lines"), F.coalesce("drop", F.array().cast("array<int>")).alias("drop"))
    # The lines between one dropped position and the next, as slices: linear in the text.
    begin = F.concat(F.array(F.lit(0)), F.transform("drop", lambda p: p + 1))
    rows = rows.withColumn("parts", F.arrays_zip(begin.alias("a"), F.concat("drop", F.array(F.size("lines"))).alias("b")))
    kept = F.flatten(F.transform("parts", lambda s: F.slice(F.col("lines"), s["a"] + 1, s["b"] - s["a"])))
    text = F.when(F.size("drop") > 0, F.array_join(kept, "\n")).otherwise(F.col("doc.text"))
    columns = [text.alias(c) if c == "text" else F.col("doc").getField(c).alias(c) for c in docs.columns]
    return rows.select(*columns, F.size("lines").cast("long").alias("n_lines"), F.size("drop").cast("long").alias("n_dropped"))


ORACLE_SQL = r"""
WITH lines AS (
  SELECT doc_id, pos, line,
         translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents)),
common AS (
  SELECT k, max(doc_id) AS max_doc FROM lines WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
marked AS (
  SELECT l.doc_id, l.pos, l.line, c.k IS NOT NULL AND l.doc_id <> c.max_doc AS dropped
  FROM lines l LEFT JOIN common c ON l.k = c.k)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN dropped THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

"""Merkle manifest of a document table, with checkpoint-and-recompute proofs.

Every row is a leaf, the SHA-256 of its fields.  The leaves of one language, in
order of ``doc_id``, form a tree: while several nodes remain, each run of ``FANOUT``
consecutive ones is hashed to one node of the next level (the last run may be
shorter, even of one node).  The trees' roots (subroots), in order of language,
form one more such tree, the forest, whose root names the whole table.

Only every ``STRIDE``-th level is stored (0, 3, 6, ...): of ``FANOUT ** STRIDE`` = 512
nodes, one row.  A stored node and the stored nodes under it are an *aligned
subtree*.  Proofs are extracted from the top down: a task gets one aligned subtree (at
most 512 rows) and the proof of its top, computes the missing levels between
again, checks that they lead to the stored top, and emits the siblings of each
lower node in front of the top's proof; the interior nodes are then forgotten.

A leaf's place is found by :func:`barlab.llm.ordering.numbered`, so a language may
hold any share of the rows; all further work is by (language, 512 leaves).

Defined results: nulls in any field are a ``-``; a null ``lang`` is a tree of its own,
the first; a null ``doc_id`` comes before others; rows that tie in ``doc_id`` are
ordered by their leaf (equal leaves are interchangeable); a lone leaf is its
tree's root, a lone subroot is the root; an empty table has no root and no proofs;
other columns of the table are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlab.llm.ordering import numbered
from barlab.llm.scratch import scratch_dir, stored

FANOUT = 8
STRIDE = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_LEVELS = 21  # FANOUT ** 21 is beyond any 64-bit count


def leaf_hash(fields: Sequence[str] = FIELDS, **changed: Column) -> Column:
    """SHA-256 (lowercase hex) of the fields, each ``-`` or byte count, ``:``, value;
    ``changed`` gives other values for some of them."""

    def part(name: str) -> Column:
        value = changed.get(name, F.col(name)).cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.sha2(F.concat(*[part(f) for f in fields]).cast("binary"), 256)


def node_hash(parts: Sequence[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _parents(nodes: Column) -> Column:
    runs = F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / FANOUT).cast("int"))
    return F.transform(runs, lambda i: F.sha2(F.array_join(F.slice(nodes, i * FANOUT + 1, FANOUT), "").cast("binary"), 256))


def _height(total: Column) -> Column:
    """Levels above the leaves of a tree with so many of them."""
    return sum(((F.lit(FANOUT**i) < total).cast("int") for i in range(1, _LEVELS)), (total > 1).cast("int"))


@dataclass
class Tree:
    """Trees side by side: ``levels[j]`` holds ``(tree, pos, node, height)`` of level
    ``j * STRIDE`` for the trees that reach it; a tree's top is in one of them."""

    levels: list[DataFrame]
    payload: list[str] = field(default_factory=list)

    def tops(self) -> DataFrame:
        """``(tree, node)`` of every tree's root."""
        out = None
        for j, level in enumerate(self.levels):
            done = level.where(F.col("height") <= j * STRIDE).select("tree", "node")
            out = done if out is None else out.unionByName(done)
        return out

    def proofs(self, tops: DataFrame) -> DataFrame:
        """The rows of level 0 with ``at`` and ``siblings``: for each level up to the
        root, the node's place in its run and the run's other nodes, concatenated.
        ``tops`` has, by ``tree``, ``at`` and ``siblings`` of the trees' own roots, and
        whatever else each row of the tree shall get."""
        shared = [c for c in tops.columns if c != "tree"]
        above = None
        for j in range(len(self.levels) - 1, -1, -1):
            level = self.levels[j]
            # Rows that are a root: one of each tree.
            own = level.where(F.col("height") <= j * STRIDE).join(tops, "tree")
            if above is not None:
                rest = level.where(F.col("height") > j * STRIDE).withColumn("block", F.floor(F.col("pos") / FANOUT**STRIDE))
                schema = T.StructType([*level.schema.fields, *[tops.schema[c] for c in shared]])
                pairs = rest.groupBy("tree", "block").cogroup(above.select("tree", "pos", F.col("node").alias("top"), *shared).groupBy("tree", "pos"))
                own = own.select(*schema.names).unionByName(pairs.applyInArrow(_expand(j * STRIDE, schema.names, shared), schema))
            above = own
        return above


def _expand(level: int, names: list[str], shared: list[str]):
    def run(nodes: pa.Table, above: pa.Table) -> pa.Table:
        nodes = nodes.sort_by("pos")
        steps = min(STRIDE, nodes["height"][0].as_py() - level)
        row = np.arange(nodes.num_rows)
        now, places, others = nodes["node"].to_pylist(), [], []
        for _ in range(steps):
            first = [i - i % FANOUT for i in range(len(now))]
            beside = ["".join(now[f:i] + now[i + 1 : f + FANOUT]) for i, f in enumerate(first)]
            places.append((row % FANOUT).tolist())
            others.append([beside[i] for i in row])
            now = [node_hash(now[f : f + FANOUT]) for f in range(0, len(now), FANOUT)]
            row //= FANOUT
        top = above.slice(0, 1).to_pylist()[0]
        if now != [top["top"]]:
            raise ValueError(f"stored level {level + STRIDE} does not follow from level {level}")
        cols = {c: nodes[c] for c in names if c not in shared}
        for c in shared:
            cols[c] = pa.array([top[c]] * nodes.num_rows, above.schema.field(c).type)
        cols["at"] = pa.array([[*here, *top["at"]] for here in zip(*places)], pa.list_(pa.int32()))
        cols["siblings"] = pa.array([[*here, *top["siblings"]] for here in zip(*others)], pa.list_(pa.string()))
        return pa.table({c: cols[c] for c in names})

    return run


def grow(rows: DataFrame, what: str, folder: str) -> Tree:
    """Trees over ``rows`` (a stored table with ``tree``, ``node`` and the columns of the
    order and payload), their stored levels under ``folder``.  Leaves ascend by
    ``key`` and then by ``node``."""
    payload = [c for c in rows.columns if c not in ("tree", "node")]
    leaves = numbered(rows, ["tree"], ["key", "node"], f"{what}-order").withColumn("height", _height(F.col("total")))
    leaves = _keep(leaves.select("tree", "pos", "node", "height", *payload), folder, 0)
    levels = [leaves]
    top = leaves.agg(F.max("height")).first()[0] or 0
    while (len(levels) - 1) * STRIDE < top:
        low = (len(levels) - 1) * STRIDE
        run = F.array_sort(F.collect_list(F.struct("pos", "node")))
        blocks = levels[-1].where(F.col("height") > low).groupBy("tree", F.floor(F.col("pos") / FANOUT**STRIDE).alias("pos")).agg(run.alias("run"), F.any_value("height").alias("height"))
        nodes = F.col("run.node")
        for step in range(STRIDE):
            nodes = F.when(F.col("height") > low + step, _parents(nodes)).otherwise(nodes) if step else _parents(nodes)
        levels.append(_keep(blocks.select("tree", "pos", nodes[0].alias("node"), "height"), folder, low + STRIDE))
    return Tree(levels, payload)


def _keep(df: DataFrame, folder: str, level: int) -> DataFrame:
    return stored(df, f"level {level}", path=f"{folder}/level-{level}")


@dataclass
class Manifest:
    """The stored levels of the language trees and of the forest over them."""

    languages: Tree
    forest: Tree

    def root(self) -> str | None:
        row = self.forest.tops().first()
        return row.node if row else None

    def proofs(self) -> DataFrame:
        """Every document with ``leaf``, ``subroot``, ``root`` and its proof: ``at`` and
        ``siblings`` level by level from the leaf to the root."""
        none = F.array().cast("array<int>").alias("at"), F.array().cast("array<string>").alias("siblings")
        root = self.forest.tops().select("tree", F.col("node").alias("root"), *none)
        subroots = self.forest.proofs(root).select(F.col("key").alias("tree"), F.col("node").alias("subroot"), "root", "at", "siblings")
        rows = self.languages.proofs(subroots).withColumnRenamed("node", "leaf").withColumnRenamed("key", "doc_id")
        return rows.drop("tree", "pos", "height")


def build(docs: DataFrame, fields: Sequence[str] = FIELDS, keep: dict[str, Column] | None = None, folder: str | None = None) -> Manifest:
    """The manifest of ``docs``, stored under ``folder`` (one in the shared folder by
    default).  ``keep`` names further columns to store beside the leaves."""
    folder = folder or scratch_dir(docs.sparkSession, "manifest")
    tree = F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit(""))
    leaves = docs.select(tree.alias("tree"), F.col("doc_id").alias("key"), leaf_hash(fields).alias("node"), *[c.alias(n) for n, c in (keep or {}).items()])
    languages = grow(stored(leaves, "leaves"), "leaves", f"{folder}/languages")
    subroots = languages.tops().select(F.lit("").alias("tree"), F.col("tree").alias("key"), "node")
    return Manifest(languages, grow(stored(subroots, "subroots", small=True), "subroots", f"{folder}/forest"))


def open_manifest(spark: SparkSession, folder: str) -> Manifest:
    """A manifest that :func:`build` stored under ``folder``."""

    def tree(path: str) -> Tree:
        levels = [spark.read.parquet(f"{path}/level-0")]
        top = levels[0].agg(F.max("height")).first()[0] or 0
        levels += [spark.read.parquet(f"{path}/level-{k}") for k in range(STRIDE, top + STRIDE, STRIDE)]
        return Tree(levels, [c for c in levels[0].columns if c not in ("tree", "pos", "node", "height")])

    return Manifest(tree(f"{folder}/languages"), tree(f"{folder}/forest"))


def proof_hash() -> Column:
    """SHA-256 of a proof's siblings, from the leaf's level to the root's."""
    return F.sha2(F.array_join("siblings", "").cast("binary"), 256)


def fold(leaf: Column) -> Column:
    """The root that ``leaf`` leads to along the row's ``at`` and ``siblings``."""

    def up(node: Column, step: Column) -> Column:
        cut, rest = step["at"] * 64, step["siblings"]
        return F.sha2(F.concat(F.substring(rest, F.lit(1), cut), node, F.substring(rest, cut + 1, F.length(rest))).cast("binary"), 256)

    return F.aggregate(F.arrays_zip("at", "siblings"), leaf, up)


ORACLE_SQL = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, lang, text, coalesce(octet_length(encode(CAST(doc_id AS VARCHAR))) || ':' || CAST(doc_id AS VARCHAR), '-')
      || coalesce(octet_length(encode(source)) || ':' || source, '-') || coalesce(octet_length(encode(lang)) || ':' || lang, '-')
      || coalesce(octet_length(encode(CAST(n_chars AS VARCHAR))) || ':' || CAST(n_chars AS VARCHAR), '-') AS head,
    -- CRC-32 by its rule, a byte and seven empty steps at a time.
    xor(4294967295, list_reduce(flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: [CAST(ascii(x) AS BIGINT), 0, 0, 0, 0, 0, 0, 0])),
      lambda r, x: xor(xor(r, x) // 2, CASE WHEN xor(r, x) % 2 = 1 THEN 3988292384 ELSE 0 END), 4294967295)) AS crc
  FROM documents),
hashed AS (
  SELECT doc_id, lang, sha256(head || coalesce(octet_length(encode(text)) || ':' || text, '-')) AS leaf,
    CASE WHEN crc % 3 = 0 THEN sha256(head || coalesce(octet_length(encode(text)) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')) END AS altered
  FROM docs),
leaves AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM hashed),
tree(lang, level, pos, node) AS (
  SELECT lang, 0, pos, leaf FROM leaves
  UNION ALL
  SELECT lang, any_value(level) + 1, pos // 8, sha256(string_agg(node, '' ORDER BY pos))
  FROM (SELECT *, count(*) OVER (PARTITION BY lang) AS n FROM tree) WHERE n > 1 GROUP BY lang, pos // 8),
tops AS (
  SELECT lang, level AS height, node AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place
  FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY level DESC) AS rn FROM tree) WHERE rn = 1),
forest(level, pos, node) AS (
  SELECT 0, place, subroot FROM tops
  UNION ALL
  SELECT any_value(level) + 1, pos // 8, sha256(string_agg(node, '' ORDER BY pos))
  FROM (SELECT *, count(*) OVER () AS n FROM forest) WHERE n > 1 GROUP BY pos // 8),
total AS (SELECT node AS root, level AS height FROM forest ORDER BY level DESC LIMIT 1),
steps AS (
  SELECT l.doc_id, l.pos AS own, l.lang, t.level, l.pos // CAST(8 ** t.level AS BIGINT) % 8 AS spot,
    coalesce(string_agg(t.node, '' ORDER BY t.pos) FILTER (t.pos <> l.pos // CAST(8 ** t.level AS BIGINT)), '') AS others
  FROM leaves l JOIN tops ON tops.lang IS NOT DISTINCT FROM l.lang
  JOIN tree t ON t.lang IS NOT DISTINCT FROM l.lang AND t.level < tops.height AND t.pos // 8 = l.pos // CAST(8 ** (t.level + 1) AS BIGINT)
  GROUP BY ALL),
above AS (
  SELECT tops.lang, f.level, tops.place // CAST(8 ** f.level AS BIGINT) % 8 AS spot,
    coalesce(string_agg(f.node, '' ORDER BY f.pos) FILTER (f.pos <> tops.place // CAST(8 ** f.level AS BIGINT)), '') AS others
  FROM tops CROSS JOIN total JOIN forest f ON f.level < total.height AND f.pos // 8 = tops.place // CAST(8 ** (f.level + 1) AS BIGINT)
  GROUP BY ALL),
paths AS (
  SELECT l.lang, l.pos, list_concat(
      coalesce((SELECT list({'spot': spot, 'others': others} ORDER BY level) FROM steps s WHERE s.lang IS NOT DISTINCT FROM l.lang AND s.own = l.pos), []),
      coalesce((SELECT list({'spot': spot, 'others': others} ORDER BY level) FROM above a WHERE a.lang IS NOT DISTINCT FROM l.lang), [])) AS path
  FROM leaves l),
folded AS (
  SELECT l.doc_id, l.leaf, tops.subroot, total.root, sha256(array_to_string(list_transform(p.path, lambda s: s.others), '')) AS proof_sha256,
    list_reduce(list_prepend({'spot': 0, 'others': coalesce(l.altered, l.leaf)}, p.path),
      lambda h, s: {'spot': 0, 'others': sha256(left(s.others, s.spot * 64) || h.others || substr(s.others, s.spot * 64 + 1))}).others AS folded_root
  FROM leaves l JOIN tops ON tops.lang IS NOT DISTINCT FROM l.lang CROSS JOIN total JOIN paths p ON p.lang IS NOT DISTINCT FROM l.lang AND p.pos = l.pos)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM folded
"""

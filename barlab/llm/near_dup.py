"""Near-duplicate documents by improved consistent weighted sampling.

A document is the weighted set of its runs of five lower-cased words: weight =
count in the document x (1 + RARITY * ln((1 + N) / (1 + df)) / ln(2 + N)), with N
the number of documents and df the number of documents that hold a run of the same
hash bucket (``2**FEATURE_BITS`` buckets, the hashing trick; every document is
counted).  The second factor lies between 1 and ``1 + RARITY``: an inverse document
frequency, damped so that a run does not lose its say by being copied often.

Consistent weighted sampling draws ``bands * rows`` samples (run, quantised
weight) of each document; two documents share a sample with the probability of
their weighted Jaccard similarity, whatever their weights' scale.  Documents that
share all ``rows`` samples of a band are candidates, and candidates count as
linked if their weighted Jaccard similarity, taken from the whole texts, is at
least ``threshold``.  Classes are the connected components of the links.

No pairs within a group are spelled out as rows.  Equal texts are one node.  In each
band's bucket the member with most company is its hub, and every member is
compared with the hub.  Buckets that then still have members of different
components go by their hub's component to families; a family is cut into
blocks of ``BLOCK_BYTES`` of text (a text counts as ``LEAST_BYTES`` at least, which
bounds the texts of a block too), and each pair of blocks is one task's group, which
takes the similarity of all texts of different components at once, as products
of their weight matrices.  So every candidate pair is compared or in one component
already.

Defined results: a null text counts as empty; all empty texts (and all texts
without words, if equal) are equal texts, and a text without words is like its
equals only; a text of one to four words has one run; repeated rows are equal
texts; a class's id is its least non-null ``doc_id`` (null if it has none).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlab.llm.graph import components
from barlab.llm.scratch import stored
from barlab.llm.textvec import chunks, mix, shingles

WORDS = 5
THRESHOLD = 0.8
BANDS = 9
ROWS = 3
FEATURE_BITS = 18
RARITY = 0.25
HUB_ROWS = 2000  # members of a hub that one task compares
BLOCK_BYTES = 1 << 20
LEAST_BYTES = 1 << 10  # so that a pair of blocks has some 2,000 texts at most, its matrix 32 MB
_ID_BITS = 44


def digest(text: str = "text") -> Column:
    """128-bit name of a text; null and empty texts have the same."""
    return F.unhex(F.md5(F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")))


def _key(doc_id: str) -> Column:
    """The id as a key that is never null; ids and null stay apart."""
    return F.coalesce(F.concat(F.lit("i"), F.col(doc_id).cast("string")), F.lit(""))


def _row_sets(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct ``(row, 44-bit id)`` of the shingles with their counts, by row."""
    key = np.sort((rows.astype(np.uint64) << np.uint64(_ID_BITS)) | (values >> np.uint64(64 - _ID_BITS)))
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    at = np.flatnonzero(new)
    count = np.diff(np.append(at, len(key)))
    key = key[at]
    return (key >> np.uint64(_ID_BITS)).astype(np.int64), key & np.uint64((1 << _ID_BITS) - 1), count


def _bucket_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, n = np.zeros(1 << FEATURE_BITS, np.int64), 0
    for batch in batches:
        n += batch.num_rows
        for chunk in chunks(batch.column(0)):
            _, ids, _ = _row_sets(*shingles(chunk, WORDS))
            total += np.bincount((ids >> np.uint64(_ID_BITS - FEATURE_BITS)).astype(np.int64), minlength=len(total))
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1), pa.int32()), pa.array(np.append(total[at], n), pa.int64())], names=["bucket", "n"])


def inverse_frequencies(docs: DataFrame) -> np.ndarray:
    """The second factor of the weights by hash bucket, from every document."""
    counts = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(_bucket_counts, "bucket int, n long")
    table = counts.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    bucket, n = table["bucket"].to_numpy(), table["n"].to_numpy()
    n_docs = int(n[bucket == -1].sum())
    df = np.zeros(1 << FEATURE_BITS)
    df[bucket[bucket >= 0]] = n[bucket >= 0]
    return (1 + RARITY * np.log((1 + n_docs) / (1 + np.minimum(df, n_docs))) / np.log(2 + n_docs)).astype(np.float32)


class Sampler:
    """``BANDS * ROWS`` consistent weighted samples by Ioffe's scheme: of all
    elements the one with the least a = c / (y e^r), where ln y = r (t - beta),
    t = floor(ln w / r + beta), r and c ~ Gamma(2, 1), beta uniform; the sample
    is (element, t).  The draws come from a table of 65,536 rows picked by a hash
    of the element and the sample's number; equal a's are told apart by hash."""

    def __init__(self, n: int):
        u = ((mix(np.arange(1, 5 * 65536 + 1, dtype=np.uint64)) >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53
        u = u.reshape(5, 65536)
        r, c = -np.log(u[0] * u[1]), -np.log(u[2] * u[3])
        self.table = np.stack([r, 1 / r, u[4], np.log(c)], axis=1).astype(np.float32)
        self.seeds = mix(np.arange(101, 101 + n, dtype=np.uint64)) | np.uint64(1)

    def samples(self, ids: np.ndarray, log_weight: np.ndarray, start: np.ndarray) -> np.ndarray:
        """32-bit names of the samples, one row per sample, one column per set;
        the sets begin at ``start`` and are not empty."""
        out = np.empty((len(self.seeds), len(start)), np.uint64)
        for j, seed in enumerate(self.seeds):
            x = (ids + np.uint64(j + 1)) * seed
            x ^= x >> np.uint64(31)
            x *= np.uint64(0x9FB21C651E98DF25)
            draw = self.table[(x >> np.uint64(48)).astype(np.intp)]
            t = np.floor(log_weight * draw[:, 1] + draw[:, 2])
            a = (draw[:, 3] - draw[:, 0] * (t - draw[:, 2] + np.float32(1))).view(np.uint32)
            order = a ^ np.where(a >> np.uint32(31), np.uint32(0xFFFFFFFF), np.uint32(0x80000000))
            name = ((x ^ (t.astype(np.int64).view(np.uint64) * np.uint64(0xA0761D6478BD642F))) * np.uint64(0xE7037ED1A0B428DB)) >> np.uint64(32)
            out[j] = np.minimum.reduceat((order.astype(np.uint64) << np.uint64(32)) | name, start)
        return out & np.uint64(0xFFFFFFFF)


def _signatures(shared, n_bands: int, n_rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler, idf = Sampler(n_bands * n_rows), shared.value
        for batch in batches:
            for chunk in chunks(batch.column(batch.schema.names.index("text"))):
                rows, ids, count = _row_sets(*shingles(chunk, WORDS))
                bands: list = [None] * chunk.n
                if len(rows):
                    start = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
                    weight = np.log(count * idf[(ids >> np.uint64(_ID_BITS - FEATURE_BITS)).astype(np.int64)]).astype(np.float32)
                    names = sampler.samples(ids, weight, start).reshape(n_bands, n_rows, -1)
                    band = np.zeros((n_bands, len(start)), np.uint64)
                    for k in range(n_rows):
                        band = mix(band ^ names[:, k])
                    for r, values in zip(rows[start].tolist(), band.T.view(np.int64).tolist()):
                        bands[r] = values
                part = batch.slice(chunk.first, chunk.n)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(bands, pa.list_(pa.int64()))], names=["doc_id", "digest", "bands"])

    return run


def _weighted(text: pa.Array, idf: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """For each text: its row, shingle hashes (sorted, distinct), counts and weights."""
    for chunk in chunks(text):
        rows, values = shingles(chunk, WORDS)
        bounds = np.searchsorted(rows, np.arange(chunk.n + 1))
        for r in range(chunk.n):
            h, n = np.unique(values[bounds[r] : bounds[r + 1]], return_counts=True)
            yield chunk.first + r, h, n, idf[(h >> np.uint64(64 - FEATURE_BITS)).astype(np.int64)].astype(np.float64)


def _compare(shared, threshold: float):
    """Rows come sorted by hub and salt, the hub's own first; the hub's set is
    kept while its members pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf = shared.value
        hub, hub_h, hub_n, hub_sum = None, None, None, 0.0
        for batch in batches:
            hubs, members = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            a, b, sims = [], [], []
            for i, h, n, w in _weighted(batch.column(3), idf):
                if members[i] is None:
                    hub, hub_h, hub_n, hub_sum = hubs[i], h, n, float((n * w).sum())
                    continue
                assert hubs[i] == hub
                at = np.searchsorted(hub_h, h)
                at[at == len(hub_h)] = 0
                common = hub_h[at] == h if len(hub_h) else np.zeros(len(h), bool)
                both = float((np.minimum(n[common], hub_n[at[common]]) * w[common]).sum())
                total = float((n * w).sum()) + hub_sum - both
                if total > 0 and both / total >= threshold:
                    a.append(members[i])
                    b.append(hub)
                    sims.append(both / total)
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary()), pa.array(sims)], names=["a", "b", "similarity"])

    return run


def _verified(pairs: DataFrame, texts: DataFrame, shared, threshold: float) -> DataFrame:
    """The ``(a, hub)`` pairs that are similar enough, as ``(a, b, similarity)``.
    A hub with many members is compared in several tasks."""
    sizes = pairs.groupBy("hub").agg(F.ceil(F.count("*") / HUB_ROWS).cast("int").alias("salts"))
    members = pairs.join(sizes, "hub").select("hub", F.pmod(F.xxhash64("a"), F.col("salts")).cast("int").alias("salt"), "a")
    members = members.join(texts.withColumnRenamed("digest", "a"), "a").select("hub", "salt", "a", "text")
    own = sizes.join(texts.withColumnRenamed("digest", "hub"), "hub")
    own = own.select("hub", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(None).cast("binary").alias("a"), "text")
    parts = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = members.unionByName(own).repartition(parts, "hub", "salt").sortWithinPartitions("hub", "salt", F.col("a").asc_nulls_first())
    return dealt.mapInArrow(_compare(shared, threshold), "a binary, b binary, similarity double")


def _similarities(texts: pa.Array, idf: np.ndarray) -> np.ndarray:
    """Weighted Jaccard similarity of all pairs of a few texts."""
    rows, names, weights = [], [], []
    for i, h, n, w in _weighted(texts, idf):
        # The k-th occurrence of a run is an element of its own, so that sets do for counts.
        turn = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        rows.append(np.full(len(turn), i))
        names.append(mix(np.repeat(h, n) + turn.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
        weights.append(np.repeat(w, n))
    row, weight = np.concatenate(rows), np.concatenate(weights)
    total = np.bincount(row, weight, len(texts))
    column, count = np.unique(np.concatenate(names), return_inverse=True, return_counts=True)[1:]
    often = count[column] > 1
    row, weight = row[often], weight[often]
    column = np.unique(column[often], return_inverse=True)[1]
    order = np.argsort(column, kind="stable")
    row, weight, column = row[order], np.sqrt(weight[order]), column[order]
    both = np.zeros((len(texts), len(texts)))
    columns = int(column[-1]) + 1 if len(column) else 0
    step = max(1, min(columns, (1 << 22) // max(1, len(texts))))
    for at in range(0, columns, step):
        a, b = np.searchsorted(column, (at, at + step))
        part = np.zeros((len(texts), step))
        part[row[a:b], column[a:b] - at] = weight[a:b]
        both += part @ part.T
    for i in range(len(texts)):
        either = total[i] + total - both[i]
        np.divide(both[i], either, out=both[i], where=either > 0)
    return both


def _compare_blocks(shared, threshold: float):
    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        label = np.unique(np.array(group["label"].to_pylist(), dtype=object), return_inverse=True)[1]
        sim = _similarities(group["text"], shared.value)
        a, b = np.nonzero(np.triu(sim >= threshold, 1))
        apart = label[a] != label[b]
        a, b = a[apart], b[apart]
        names = group["digest"].to_pylist()
        return pa.table({"a": pa.array([names[i] for i in a], pa.binary()), "b": pa.array([names[i] for i in b], pa.binary()), "similarity": pa.array(sim[a, b], pa.float64())})

    return run


def _across_components(open_: DataFrame, texts: DataFrame, shared, threshold: float) -> DataFrame:
    """Links between texts of different components that share a bucket, as ``(a, b,
    similarity)``; ``open_`` has (family, digest, label)."""
    members = open_.join(texts, "digest").withColumn("bytes", F.greatest(F.octet_length("text"), F.lit(LEAST_BYTES)).cast("long"))
    sizes = members.groupBy("family").agg(F.ceil(F.sum("bytes") / BLOCK_BYTES).cast("int").alias("blocks"))
    placed = members.join(sizes, "family").withColumn("block", F.pmod(F.xxhash64("digest"), F.col("blocks")).cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    placed = placed.select("family", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "digest", "label", "text")
    return placed.groupBy("family", "lo", "hi").applyInArrow(_compare_blocks(shared, threshold), "a binary, b binary, similarity double")


def near_dup_classes(docs: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``(doc_id, digest, class_id, class_digest, similar)`` of every row of
    ``docs``: ``class_id`` and ``class_digest`` name the document that stands for
    its class, and ``similar`` counts the class's different texts."""
    spark = docs.sparkSession
    base = docs.select("doc_id", digest().alias("digest"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    shared = spark.sparkContext.broadcast(inverse_frequencies(docs))
    kind = docs.schema["doc_id"].dataType.simpleString()
    signed = stored(base.mapInArrow(_signatures(shared, bands, rows), f"doc_id {kind}, digest binary, bands array<long>"), "signatures", small=True)
    least = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "digest")).alias("least")
    nodes = stored(signed.groupBy("digest").agg(least, F.any_value("bands").alias("bands")), "nodes", small=True)

    placed = nodes.select("digest", F.posexplode("bands").alias("band", "h"))
    buckets = placed.groupBy("band", "h").agg(F.count("*").alias("size")).where("size > 1")
    placed = stored(placed.join(buckets, ["band", "h"]).select("band", "h", "digest", "size"), "buckets", small=True)
    company = placed.groupBy("digest").agg(F.sum("size").alias("company"))
    # One row of each text, the one of its least doc_id, so that many copies do not meet in
    # one task; where that one is repeated, the copies already lie together.
    rep = nodes.join(company, "digest", "left_semi").select("digest", _key("least.doc_id").alias("_key"))
    found = base.withColumn("_key", _key("doc_id")).join(rep, ["digest", "_key"], "left_semi")
    texts = stored(found.groupBy("digest", "_key").agg(F.any_value("text").alias("text")).select("digest", "text"), "texts")
    hubs = placed.join(company, "digest").groupBy("band", "h").agg(F.max(F.struct("company", "digest")).alias("top"))
    hubs = stored(hubs.select("band", "h", F.col("top.digest").alias("hub")), "hubs", small=True)
    pairs = placed.join(hubs, ["band", "h"]).select(F.col("digest").alias("a"), "hub").where("a <> hub").distinct()
    links = stored(_verified(stored(pairs, "pairs", small=True), texts, shared, threshold), "links", small=True)
    labels = stored(components(links), "labels", small=True)

    # Buckets that still have members of different components.
    marked = placed.join(labels, F.col("digest") == F.col("node"), "left").withColumn("label", F.coalesce("label", "digest")).drop("node")
    mixed = marked.groupBy("band", "h").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("band", "h")
    open_ = marked.join(mixed, ["band", "h"]).join(hubs, ["band", "h"]).select("digest", "label", "hub")
    family = labels.select(F.col("node").alias("hub"), F.col("label").alias("family"))
    open_ = open_.join(family, "hub", "left").select(F.coalesce("family", "hub").alias("family"), "digest", "label").distinct()
    late = stored(_across_components(stored(open_, "open", small=True), texts, shared, threshold), "late-links", small=True)
    final = components(links.unionByName(late).select("a", "b")) if late.take(1) else labels

    joined = final.join(nodes, F.col("node") == F.col("digest")).select("digest", "label", "least")
    classes = joined.groupBy("label").agg(F.min("least").alias("first"), F.count("*").alias("similar"))
    moved = joined.join(classes, "label").select(F.col("digest").alias("_d"), "first", "similar")
    named = nodes.join(moved, F.col("digest") == F.col("_d"), "left").select("digest", F.coalesce("first", "least").alias("first"), F.coalesce("similar", F.lit(1)).alias("similar"))
    return signed.join(named, "digest").select("doc_id", "digest", F.col("first.doc_id").alias("class_id"), F.col("first.digest").alias("class_digest"), "similar")


def drop_near_dups(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One document of each class: the one that stands for it.  Of repeated rows
    with its ``doc_id`` and text, one stays."""
    named = near_dup_classes(docs, threshold).where(F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("digest") == F.col("class_digest")))
    named = named.select(_key("doc_id").alias("key"), "digest").distinct()
    # The whole row is one column here, so that no name of its own meets another.
    rows = docs.select(_key("doc_id").alias("key"), digest().alias("digest"), F.struct("*").alias("doc"))
    kept = rows.join(named, ["key", "digest"], "left_semi").dropDuplicates(["key", "digest"])
    return kept.select(*[F.col("doc").getField(c).alias(c) for c in docs.columns])

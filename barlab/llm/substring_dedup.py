"""Removal of long repeated byte strings by bucket-pointer refinement.

A byte goes if it lies in a string of ``length`` bytes that also starts anywhere
else, in the same text or another one.  Texts count as UTF-8 bytes and matches
never cross texts.

1. *Anchors.*  Every string of ``length`` bytes has one: of its ``GRAM``-byte grams
   the one with the least hash (the first, if several have it).  Strings one after
   the other mostly share it, so about one gram in 85 is an anchor.  Equal strings
   have equal anchors at equal places; the anchor's gram is the initial bucket.
   Buckets of one anchor are done.
2. *Contexts.*  An anchor's context is the bytes of all strings that it is the anchor
   of.  Equal contexts are one kind, and everything in a kind that occurs twice is
   repeated.  Of a bucket with several kinds, one context of each is fetched from the
   texts and written, so that the texts are shuffled once for it whatever reads them.
3. *Refinement.*  In a bucket, contexts lie side by side, aligned at the anchor.
   Every offset starts in the bucket of its first ``length / 4`` bytes; buckets are
   refined by sorting on their own identifier and the identifier that the offset
   ``length / 4``, then ``length / 2``, further on has got, so each round reuses what
   the round before found.  Buckets of one are dropped at once.  What is left
   after the last round is a repeated string.
   A bucket of more than ``HOT_CONTEXTS`` kinds of context is not gathered in a
   task: its strings' hashes are counted by a pre-aggregated group-by instead.
4. The strings' places are joined back to the texts, which are cut there.

Each step's table is written before the next one starts, and deleted after its last
reader, so the shuffles of two steps never lie on disk together: at most one
shuffle of the texts is there at a time.

Rows go by a 128-bit name of ``doc_id`` and text, so rows that share an id, or have none,
are texts of their own.

Defined results: null and empty texts, and texts shorter than ``length``, stay as
they are (a null text comes back as empty bytes); repeated rows are copies of each
other, so all of them go; a null ``doc_id`` is a document like others; columns
besides ``doc_id`` and ``text`` are not returned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlab.llm.names import row_name
from barlab.llm.scratch import removed, scratch_dir, stored
from barlab.llm.textvec import Chunk, chunks, mix, prefix_hash, range_hash

LENGTH = 200
GRAM = 32
HOT_CONTEXTS = 3000
CHUNK_CONTEXTS = 1000
CHUNK_BYTES = 1 << 18  # of text in a step: a dozen arrays of eight times that size
_NEVER = np.uint64(0xFFFFFFFFFFFFFFFF)
_PLACE = np.uint64((1 << 31) - 1)


def _sliding_min(values: np.ndarray, w: int) -> np.ndarray:
    """Least of each run of ``w`` values."""
    n = len(values) - w + 1
    blocks = -(-len(values) // w)
    grid = np.full(blocks * w, _NEVER)
    grid[: len(values)] = values
    grid = grid.reshape(blocks, w)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[w - 1 : w - 1 + n])


def find_anchors(chunk: Chunk, sums: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(row, anchor, first, last)`` of every anchor, as positions in the chunk:
    it is the anchor of the strings that start at ``first`` to ``last``."""
    n, w = len(chunk.buf), length - GRAM + 1
    if n < length:
        none = np.zeros(0, np.int64)
        return none, none, none, none
    at = np.arange(n - GRAM + 1)
    # 33 bits of the hash, then the place: the least is the first of the least hashes.
    rank = (range_hash(sums, at, at + GRAM) & ~_PLACE) | at.astype(np.uint64)
    anchor = (_sliding_min(rank, w) & _PLACE).astype(np.int64)
    row = np.searchsorted(chunk.bounds, at[: len(anchor)], "right") - 1
    inside = at[: len(anchor)] + length <= chunk.bounds[row + 1]
    starts = np.flatnonzero(inside)
    new = np.append(True, (anchor[starts][1:] != anchor[starts][:-1]) | (row[starts][1:] != row[starts][:-1])) if len(starts) else np.zeros(0, bool)
    first = starts[new]
    last = np.append(starts[np.flatnonzero(new)[1:] - 1], starts[-1:])
    return row[first], anchor[first], first, last


def _anchor_rows(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(1), CHUNK_BYTES):
                sums = prefix_hash(chunk.buf)
                row, at, first, last = find_anchors(chunk, sums, length)
                gram = range_hash(sums, at, at + GRAM)
                context = range_hash(sums, first, last + length) & ~np.uint64(0xFFFF)
                # The name of a context says how long it is and where its anchor is.
                context |= ((last - first) << 8 | (at - first)).astype(np.uint64)
                part = batch.slice(chunk.first, chunk.n)
                pick = pa.array(row)
                cols = [part.column(0).take(pick), pa.array((first - chunk.bounds[row]).astype(np.int32)), pa.array(gram.view(np.int64)), pa.array(context.view(np.int64))]
                yield pa.RecordBatch.from_arrays(cols, names=["row", "pos", "gram", "context"])

    return run


def _size(length: int) -> Column:
    """Bytes of a context, by its name."""
    return (F.shiftright("context", 8).bitwiseAND(F.lit(0xFF)) + length).cast("int")


def _fetch(length: int):
    """The bytes of the contexts asked of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            gram, context, hot, data = [], [], [], []
            for row, text, asked in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                # Copies of a row are asked alike and mostly come one after the other.
                if row == last:
                    continue
                last = row
                whole = text.as_py().encode()
                for x in asked.as_py():
                    gram.append(x["gram"])
                    context.append(x["context"])
                    hot.append(x["hot"])
                    data.append(whole[x["pos"] : x["pos"] + (x["context"] >> 8 & 0xFF) + length])
                if len(data) >= 20_000:
                    yield _context_batch(gram, context, hot, data)
                    gram, context, hot, data = [], [], [], []
            yield _context_batch(gram, context, hot, data)

    return run


def _context_batch(gram: list[int], context: list[int], hot: list[bool], data: list[bytes]) -> pa.RecordBatch:
    cols = [pa.array(gram, pa.int64()), pa.array(context, pa.int64()), pa.array(hot, pa.bool_()), pa.array(data, pa.binary())]
    return pa.RecordBatch.from_arrays(cols, names=["gram", "context", "hot", "bytes"])


def _shared_buckets(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket identifiers of equal keys, and which of them hold two or more."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    new = np.append(True, ranked[1:] != ranked[:-1])
    number = np.cumsum(new) - 1
    size = np.bincount(number)
    ids = np.empty(len(keys), np.int64)
    ids[order] = number
    return ids, size[ids] > 1


def refine(group: np.ndarray, before: np.ndarray, data: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """``(context, start)`` of each string that another context of its group has at
    the same distance from the anchor; ``before[i]`` bytes of context ``i`` stand
    before its anchor."""
    quarter = length // 4
    size = np.array([len(d) for d in data], np.int64)
    base = np.concatenate([[0], np.cumsum(size)])
    text = np.frombuffer(b"".join(data), np.uint8)
    owner = np.repeat(np.arange(len(data)), size)
    place = np.arange(len(text)) - base[owner]
    at = np.flatnonzero(place + quarter <= size[owner])
    aligned = (group[owner[at]] << 16 | (place[at] - before[owner[at]] + length)).astype(np.uint64)
    ids, many = _shared_buckets(mix(range_hash(prefix_hash(text), at, at + quarter) + mix(aligned)))
    bucket = np.full(len(text) + length, -1, np.int64)
    bucket[at[many]] = ids[many]
    at = at[many]
    for step in (quarter, 2 * quarter):
        # A bucket names group and alignment too, so the pair of identifiers is all there is to sort on.
        later = bucket[at + step]
        ok = (later >= 0) & (place[at] + 2 * step <= size[owner[at]])
        at, later = at[ok], later[ok]
        ids, many = _shared_buckets((bucket[at] << 32) | later)
        now = np.full(len(bucket), -1, np.int64)
        now[at[many]] = ids[many]
        bucket, at = now, at[many]
    return owner[at], place[at]


def _distinct_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by gram and context without the repeats."""
    last = None
    for batch in batches:
        keys = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
        keep = [k != p for k, p in zip(keys, [last, *keys])]
        last = keys[-1] if keys else last
        yield batch.filter(pa.array(keep, pa.bool_()))


def _refined(length: int):
    """Rows come sorted by gram; whole buckets are refined together."""

    def flush(grams, contexts, data):
        grams, contexts = np.array(grams, np.int64), np.array(contexts, np.int64)
        owner, start = refine(np.unique(grams, return_inverse=True)[1], contexts & 0xFF, data, length)
        # Strings that overlap or touch are one span.
        new = np.append(True, (owner[1:] != owner[:-1]) | (start[1:] > start[:-1] + length)) if len(owner) else np.zeros(0, bool)
        first = np.flatnonzero(new)
        last = np.append(first[1:] - 1, len(owner) - 1)[: len(first)]
        who = owner[first]
        return pa.RecordBatch.from_arrays([pa.array(grams[who]), pa.array(contexts[who]), pa.array(start[first].astype(np.int32)), pa.array((start[last] + length).astype(np.int32))], names=["gram", "context", "lo", "hi"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[list, list, list] = ([], [], [])
        # One Python step: two in a row would be two worker processes a task.
        for batch in _distinct_contexts(batches):
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                if len(held[0]) >= CHUNK_CONTEXTS and row[0] != held[0][-1]:
                    yield flush(*held)
                    held = ([], [], [])
                for part, value in zip(held, row):
                    part.append(value)
        if held[0]:
            yield flush(*held)

    return run


def _hot_strings(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for gram, context, data in zip(*[c.to_pylist() for c in batch.columns]):
                sums = prefix_hash(np.frombuffer(data, np.uint8))
                start = np.arange(len(data) - length + 1)
                h = range_hash(sums, start, start + length)
                cols = [np.full(len(h), gram), np.full(len(h), context), (start - (context & 0xFF)).astype(np.int32), start.astype(np.int32), h.view(np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["gram", "context", "col", "lo", "h"])

    return run


def _cut(length: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for text, spans in zip(batch.column(1), batch.column(2)):
                data = text.as_py().encode()
                n, merged = len(data), []
                for x in sorted((s["lo"], s["hi"]) for s in spans.as_py() or ()):
                    if merged and x[0] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], x[1])
                    else:
                        merged.append(list(x))
                ends = [0, *[e for _, e in merged]]
                out[0].append(n)
                out[1].append([s for s, _ in merged])
                out[2].append([e for _, e in merged])
                out[3].append(b"".join(data[a:b] for a, b in zip(ends, [*[s for s, _ in merged], n])))
            cols = [batch.column(0), pa.array(out[0], pa.int64()), pa.array(out[1], pa.list_(pa.int64())), pa.array(out[2], pa.list_(pa.int64())), pa.array(out[3], pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return run


def remove_repeats(docs: DataFrame, length: int = LENGTH, hot_contexts: int = HOT_CONTEXTS) -> DataFrame:
    """``(doc_id, n_bytes, span_start, span_end, kept)`` of every row: the maximal
    removed runs as two arrays, and the remaining bytes.  ``length`` is a multiple
    of 4 from 100 to 280."""
    spark, kind = docs.sparkSession, docs.schema["doc_id"].dataType.simpleString()
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    base = docs.select(row_name().alias("row"), text.alias("text"), "doc_id")
    at = {x: scratch_dir(spark, x) for x in ("anchors", "repeated-grams", "shared-anchors", "contexts", "context-bytes", "hot-strings", "spans", "text-spans")}
    # The texts are scanned for anchors once; counting and joining read the stored rows.
    # The counts are a table of their own, so that the join's two sides are plain shuffles
    # and a gram that very many texts hold is split (AQE).
    anchors = stored(base.select("row", "text").mapInArrow(_anchor_rows(length), "row binary, pos int, gram long, context long"), "anchors", path=at["anchors"])
    many = stored(anchors.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1").select("gram"), "repeated-grams", small=True, path=at["repeated-grams"])
    shared = stored(anchors.join(many, "gram"), "shared-anchors", path=at["shared-anchors"])
    for x in ("anchors", "repeated-grams"):
        removed(spark, at[x])
    kinds = shared.groupBy("gram", "context").agg(F.count("*").alias("n"), F.min(F.struct("row", "pos")).alias("one"))
    sizes = kinds.groupBy("gram").agg(F.count("*").alias("k"))
    kinds = stored(kinds.join(sizes, "gram").select("gram", "context", "n", "k", "one.row", "one.pos"), "contexts", small=True, path=at["contexts"])

    hot = F.col("k") > hot_contexts
    asked = kinds.where("k > 1").groupBy("row").agg(F.collect_list(F.struct("gram", "context", "pos", hot.alias("hot"))).alias("asked"))
    fetched = base.join(asked, "row").select("row", "text", "asked").mapInArrow(_fetch(length), "gram long, context long, hot boolean, bytes binary")
    fetched = stored(fetched, "context-bytes", path=at["context-bytes"])
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = fetched.where("not hot").select("gram", "context", "bytes").repartition(parts, "gram").sortWithinPartitions("gram", "context")
    spans = dealt.mapInArrow(_refined(length), "gram long, context long, lo int, hi int")
    if kinds.where(hot).take(1):
        answers = fetched.where("hot").groupBy("gram", "context").agg(F.any_value("bytes").alias("bytes"))
        strings = stored(answers.mapInArrow(_hot_strings(length), "gram long, context long, col int, lo int, h long"), "hot-strings", path=at["hot-strings"])
        often = strings.groupBy("gram", "col", "h").agg(F.count("*").alias("n")).where("n > 1").select("gram", "col", "h")
        found = strings.join(often, ["gram", "col", "h"])
        spans = spans.unionByName(found.select("gram", "context", "lo", (F.col("lo") + length).alias("hi")))
    spans = stored(spans, "spans", path=at["spans"])
    for x in ("context-bytes", "hot-strings"):
        removed(spark, at[x])
    spans = spans.unionByName(kinds.where("n > 1").select("gram", "context", F.lit(0).alias("lo"), _size(length).alias("hi")))
    places = shared.join(spans, ["gram", "context"])
    span = F.struct((F.col("pos") + F.col("lo")).alias("lo"), (F.col("pos") + F.col("hi")).alias("hi"))
    # A set: copies of a row have the same spans.
    by_text = stored(places.groupBy("row").agg(F.collect_set(span).alias("spans")), "text-spans", path=at["text-spans"])
    for x in ("shared-anchors", "contexts", "spans"):
        removed(spark, at[x])
    rows = base.join(by_text, "row", "left").select("doc_id", "text", "spans")
    names = ["doc_id", "n_bytes", "span_start", "span_end", "kept"]
    return rows.mapInArrow(_cut(length, names), f"doc_id {kind}, n_bytes long, span_start array<long>, span_end array<long>, kept binary")

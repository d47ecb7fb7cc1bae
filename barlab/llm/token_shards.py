"""Token sequences in training order, as fixed-stride binary shards.

Every text is tokenised, closed with the end token and cut into sequences of
``length`` ids (the last one filled up with the end token); ids are
little-endian uint16, so every record has the same stride.  Sequence ``k`` of a
document has the number (document number) x (most sequences a text can have) +
k; a keyed Feistel network over the least even number of bits that holds all
such numbers, walked until it falls in their range again, permutes them.  A
sequence's global slot is the rank of its permuted number among those that
exist: 0, 1, 2, .. without holes.

The permuted numbers are cut into equal ranges, one for each shard.  A task
gathers one range (about ``shard_bytes``: the permutation spreads every document
evenly, whatever its size or source), puts it in order and writes it as one file,
under a temporary name that is renamed when complete, so a task that runs
again leaves the same file.  A reader goes to a slot by one look into the index and one
seek, and reads on from there.

Defined results: a null or empty text is one sequence of end tokens; rows whose
``doc_id`` is null, and all rows if it is not an integer column, are numbered by a hash
of id and text over four times as many numbers as there are such rows; rows that share
a number (a repeated ``doc_id``, copies of one text without an id) have slots by the
records' SHA-256; an empty table has no shard.  The order depends on the rows, ``key`` and ``length`` alone, not on files or
partitions.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import tiktoken
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlab.llm.scratch import stored
from barlab.llm.textvec import mix

LENGTH = 256
KEY = 0x5EED
SHARD_BYTES = 8 << 20
ROUNDS = 6
_MOST = 1 << 62
_loaded: dict[str, tiktoken.Encoding] = {}


@dataclass(frozen=True)
class Order:
    """A keyed permutation of ``0 .. size - 1``."""

    size: int
    key: int

    def _once(self, x: np.ndarray) -> np.ndarray:
        half = np.uint64(max(1, ((self.size - 1).bit_length() + 1) // 2))
        mask = np.uint64((1 << int(half)) - 1)
        left, right = x >> half, x & mask
        for r in range(ROUNDS):
            seed = np.uint64((self.key * 0x9E3779B97F4A7C15 + (r + 1) * 0xD1342543DE82EF95) % (1 << 64))
            left, right = right, left ^ (mix(right + seed) & mask)
        return (left << half) | right

    def permute(self, x: np.ndarray) -> np.ndarray:
        out = self._once(x.astype(np.uint64))
        while (away := np.flatnonzero(out >= np.uint64(self.size))).size:
            out[away] = self._once(out[away])
        return out


def _encoding(pattern: str, ranks: bytes) -> tiktoken.Encoding:
    name = hashlib.sha256(ranks).hexdigest()
    if name not in _loaded:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        _loaded[name] = tiktoken.Encoding(name, pat_str=pattern, mergeable_ranks=table, special_tokens={})
    return _loaded[name]


def _pieces(shared, pattern: str, order: Order, most: int, length: int, ranges: int):
    """Per run of rows and shard, one row: numbers, ids and the records, packed."""
    step = -(-order.size // ranges)

    def flush(keys, docs, ks, ns, records, doc_type):
        key = order.permute(np.concatenate(keys))
        shard = (key // np.uint64(step)).astype(np.int64)
        by = np.lexsort((key, shard))
        cuts = np.append(np.flatnonzero(np.append(True, shard[by][1:] != shard[by][:-1])), len(by))
        records, docs, ks, ns = np.concatenate(records), [d for part in docs for d in part], np.concatenate(ks), np.concatenate(ns)
        pack = zstandard.ZstdCompressor(level=5)
        rows = [by[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
        cols = [
            pa.array([int(shard[r[0]]) for r in rows], pa.int32()),
            pa.array([key[r].astype(np.int64) for r in rows], pa.list_(pa.int64())),
            pa.array([[docs[i] for i in r] for r in rows], pa.list_(doc_type)),
            pa.array([ks[r] for r in rows], pa.list_(pa.int32())),
            pa.array([ns[r] for r in rows], pa.list_(pa.int32())),
            pa.array([pack.compress(records[r].tobytes()) for r in rows], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(cols, names=["shard", "key", "doc_id", "seq_no", "n_tokens", "records"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoding(pattern, shared.value[0]).encode_to_numpy
        end = np.array([shared.value[1]], "<u2")
        held, size = ([], [], [], [], []), 0
        for batch in batches:
            doc_type = batch.schema.field(0).type
            for doc_id, number, text in zip(batch.column(0), batch.column(1), batch.column(2)):
                ids = np.append(encode(text.as_py() or "", disallowed_special=()).astype("<u2"), end)
                n = -(-len(ids) // length)
                rec = np.full(n * length, end[0], "<u2")
                rec[: len(ids)] = ids
                k = np.arange(n, dtype=np.int32)
                fill = np.minimum(len(ids) - k * length, length).astype(np.int32)
                for part, value in zip(held, (np.uint64(number.as_py() * most) + k.astype(np.uint64), [doc_id.as_py()] * n, k, fill, rec.reshape(n, length))):
                    part.append(value)
                size += rec.nbytes
                if size >= 8 << 20:
                    yield flush(*held, doc_type)
                    held, size = ([], [], [], [], []), 0
        if size:
            yield flush(*held, doc_type)

    return run


def _write(folder: str, length: int, names: list[str]):
    """Puts one range in order and writes it; a row for each record."""

    def run(table: pa.Table) -> pa.Table:
        shard, stride = table["shard"][0].as_py(), 2 * length
        unpack = zstandard.ZstdDecompressor()
        data = b"".join(unpack.decompress(x.as_py()) for x in table["records"])
        key = np.concatenate([np.asarray(x.values) for x in table["key"]])
        docs = [d for x in table["doc_id"] for d in x.as_py()]
        seq, n = (np.concatenate([np.asarray(x.values) for x in table[c]]) for c in ("seq_no", "n_tokens"))
        records = [data[i * stride : (i + 1) * stride] for i in range(len(key))]
        sums = [hashlib.sha256(r).hexdigest() for r in records]
        by = sorted(range(len(key)), key=lambda i: (key[i], sums[i]))
        fs, path = _file_system(folder)
        fs.create_dir(path, recursive=True)
        draft = f"{path}/_draft-{shard:06d}-{uuid.uuid4().hex}"
        with fs.open_output_stream(draft) as out:
            for i in by:
                out.write(records[i])
        fs.move(draft, f"{path}/{file_name(shard)}")
        cols = [
            pa.array(np.full(len(by), shard), pa.int32()),
            pa.array(np.arange(len(by)), pa.int64()),
            pa.array([docs[i] for i in by], table.schema.field("doc_id").type.value_type),
            pa.array(seq[by], pa.int32()),
            pa.array(n[by], pa.int32()),
            pa.array([sums[i] for i in by], pa.string()),
        ]
        return pa.Table.from_arrays(cols, names=names)

    return run


def _file_system(folder: str) -> tuple[pafs.FileSystem, str]:
    """Arrow's file system for a URI that Spark uses."""
    return pafs.FileSystem.from_uri(folder.replace("s3a://", "s3://", 1) if folder.startswith("s3a://") else folder)


def file_name(shard: int) -> str:
    return f"shard-{shard:06d}.u16"


def write_shards(docs: DataFrame, folder: str, vocabulary: str, pattern: str, end_token: int, key: int = KEY, length: int = LENGTH, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Write all sequences of ``docs`` to ``folder`` (a URI that every executor can
    write) and return ``(slot, shard, byte_offset, doc_id, seq_no, n_tokens,
    ids_sha256)``, a row for each record.  ``vocabulary`` is the path of a file of
    token ranks on the driver; ids must be below 65,536."""
    spark = docs.sparkSession
    with open(vocabulary, "rb") as f:
        shared = spark.sparkContext.broadcast((f.read(), end_token))
    base = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    size = F.coalesce(F.octet_length("text"), F.lit(0))
    whole = isinstance(docs.schema["doc_id"].dataType, T.IntegralType)
    known = F.col("doc_id").cast("long") if whole else F.lit(None).cast("long")
    lo, hi, longest, total, rows = base.agg(F.min(known), F.max(known), F.max(size), F.sum(size.cast("long")), F.count_if(known.isNull())).first()
    most = (int(longest or 0) + length) // length  # a token has a byte at least
    span = 0 if lo is None else hi - lo + 1
    hashed = F.xxhash64(F.col("doc_id").cast("string"), "text")
    spread = max(1, min(4 * rows, _MOST // most // 2))  # numbers of the rows without an integer id
    if (span + spread) * most < _MOST:
        number = F.coalesce(known - F.lit(lo or 0), F.lit(span) + F.pmod(hashed, F.lit(spread)))
    else:  # ids too far apart: numbers by hash; equal ones are told apart by SHA-256
        span = _MOST // most - spread - 1
        number = F.pmod(F.coalesce(F.xxhash64("doc_id"), hashed), F.lit(span)) if whole else F.pmod(hashed, F.lit(span))
    number = number.cast("long")
    order = Order((span + spread) * most, key)
    ranges = max(1, -(-int(total or 0) // shard_bytes))
    kind = docs.schema["doc_id"].dataType.simpleString()
    packed = base.select("doc_id", number.alias("number"), "text").mapInArrow(
        _pieces(shared, pattern, order, most, length, ranges),
        f"shard int, key array<long>, doc_id array<{kind}>, seq_no array<int>, n_tokens array<int>, records binary",
    )
    names = ["shard", "place", "doc_id", "seq_no", "n_tokens", "ids_sha256"]
    written = packed.groupBy("shard").applyInArrow(_write(folder, length, names), f"shard int, place long, doc_id {kind}, seq_no int, n_tokens int, ids_sha256 string")
    placed = stored(written, "shard-records", small=True)
    counts = placed.groupBy("shard").agg(F.count("*").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    index = counts.select("shard", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first_slot"))
    index.coalesce(1).write.parquet(f"{folder}/index")
    firsts = spark.read.parquet(f"{folder}/index").select("shard", "first_slot")
    rows = placed.join(firsts, "shard")
    return rows.select((F.col("first_slot") + F.col("place")).alias("slot"), "shard", (F.col("place") * (2 * length)).alias("byte_offset"), "doc_id", "seq_no", "n_tokens", "ids_sha256")


def read_from(spark: SparkSession, folder: str, slot: int, length: int = LENGTH) -> Iterator[np.ndarray]:
    """The records from a global slot on, in order, one at a time."""
    fs, path = _file_system(folder)
    for shard, n, first in sorted(tuple(r) for r in spark.read.parquet(f"{folder}/index").where(F.col("first_slot") + F.col("n") > slot).select("shard", "n", "first_slot").collect()):
        with fs.open_input_file(f"{path}/{file_name(shard)}") as f:
            f.seek(max(0, slot - first) * 2 * length)
            while record := f.read(2 * length):
                yield np.frombuffer(record, "<u2")

"""Byte-level BPE encoding by per-prefix dynamic programming, and decoding.

For every prefix of a pre-token there is exactly one token that its BPE encoding
ends with.  The encoder finds it for each prefix in turn: an automaton over the
vocabulary gives all tokens that are suffixes of the prefix, and the one that is
right either is the whole prefix or is *pair-compatible* with the last token of
the prefix before it, that is, BPE leaves those two tokens as they are when it
sees their bytes side by side.  Following the stored last tokens back from the
end gives the ids, the same ids as merging pairs in order of rank.

A pre-token's ids are kept in a bounded per-worker table, so a repeated word
costs a look-up.  The tokenizer's JSON file is read on the driver and sent to
the workers; its size does not depend on the data.

Defined results: a null text is encoded as the empty text (no ids, decoded to
the empty text); text that equals a special token becomes that token's id;
decoding replaces bytes that are not UTF-8, as the library does.  Columns of the
input named ``ids``, ``n_tokens`` or ``decoded`` are replaced; all others are kept.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Fixed value: the byte-level pre-tokenizer's pattern.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CACHED_PIECES = 800_000
_loaded: dict[str, ByteBPE] = {}


def _byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ByteBPE(dict):
    """A tokenizer; as a dict, the ids (little-endian uint32) of known pre-tokens."""

    def __init__(self, spec: str):
        super().__init__()
        parsed = json.loads(spec)
        model, pre = parsed["model"], parsed["pre_tokenizer"]
        if model["type"] != "BPE" or pre != {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True} or parsed["normalizer"]:
            raise ValueError("only byte-level BPE without a normaliser is supported")
        alphabet = _byte_alphabet()
        vocab = {bytes(alphabet[c] for c in token): i for token, i in model["vocab"].items()}
        special = {t["content"]: t["id"] for t in parsed["added_tokens"]}
        size = max([*vocab.values(), *special.values()], default=-1) + 1
        self.token = [b""] * size
        for text, i in vocab.items():
            self.token[i] = text
        self.left, self.right, self.rank = [0] * size, [0] * size, [-1] * size
        self.merge: dict[tuple[int, int], int] = {}
        for r, pair in enumerate(model["merges"]):
            a, b = (model["vocab"][x] for x in (pair.split(" ") if isinstance(pair, str) else pair))
            made = vocab[self.token[a] + self.token[b]]
            self.merge[a, b] = r
            self.left[made], self.right[made], self.rank[made] = a, b, r
        self.matches = ahocorasick.Automaton()
        for text, i in vocab.items():
            self.matches.add_word(text.decode("latin-1"), (i, len(text)))
        self.matches.make_automaton()
        for text, i in special.items():
            self.token[i] = text.encode()
        self.special = {t: np.array([i], "<u4").tobytes() for t, i in special.items()}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        self.pieces = regex.compile(PATTERN).findall
        self.pair: dict[tuple[int, int], bool] = {}

    def compatible(self, a: int, b: int) -> bool:
        """Whether BPE keeps tokens ``a`` and ``b`` apart.

        Undo the merges that made them, the last one first.  While the pair of
        pieces at their border coexists, a merge of the two would come first if
        it ranks before the merge undone (or equal, when it stands to its left).
        """
        known = self.pair.get((a, b))
        if known is not None:
            return known
        x, y, before, apart = a, b, len(self.merge), True
        while True:
            if self.merge.get((x, y), before) < before:
                apart = False
                break
            if self.rank[x] > self.rank[y]:
                before, x = self.rank[x], self.right[x]
            elif self.rank[y] >= 0:
                before, y = self.rank[y] + 1, self.left[y]
            else:
                break
        if len(self.pair) > CACHED_PIECES:
            self.pair.clear()
        self.pair[a, b] = apart
        return apart

    def __missing__(self, piece: str) -> bytes:
        data = piece.encode("utf-8", "surrogatepass")
        last = [-1] * (len(data) + 1)
        for end, (token, size) in self.matches.iter(data.decode("latin-1")):
            end += 1
            if last[end] < 0 and (size == end or self.compatible(last[end - size], token)):
                last[end] = token
        ids, at = [], len(data)
        while at:
            ids.append(last[at])
            at -= len(self.token[last[at]])
        out = np.array(ids[::-1], "<u4").tobytes()
        if len(data) <= 64:
            if len(self) >= CACHED_PIECES:
                self.clear()
            self[piece] = out
        return out

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        if self.cut is None or not any(s in text for s in self.special):
            return b"".join(map(self.__getitem__, self.pieces(text)))
        return b"".join(self.special[part] if part in self.special else b"".join(map(self.__getitem__, self.pieces(part))) for part in self.cut.split(text))

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.token.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


def loaded(spec: str) -> ByteBPE:
    """The tokenizer of a JSON text, made once in each worker process."""
    name = hashlib.sha256(spec.encode()).hexdigest()
    if name not in _loaded:
        _loaded[name] = ByteBPE(spec)
    return _loaded[name]


def _apply(docs: DataFrame, tokenizer: str, work, new: list[T.StructField], limit: int = 1 << 20) -> DataFrame:
    """``docs`` with the columns ``new``, made by ``work(model, batch column values)``
    over runs of rows of about ``limit`` characters."""
    with open(tokenizer, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())
    base = docs.drop(*[c.name for c in new])
    names = [*base.columns, *[c.name for c in new]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = loaded(spec.value)
        for batch in batches:
            values, first, size = [], 0, 0
            column = batch.column(batch.schema.get_field_index(work.reads))
            for i, x in enumerate(column):
                values.append(x.as_py())
                size += len(values[-1] or "")
                if size >= limit or i == len(column) - 1:
                    made = work(model, values)
                    yield pa.RecordBatch.from_arrays([*batch.slice(first, len(values)).columns, *made], names=names)
                    values, first, size = [], i + 1, 0

    return base.mapInArrow(run, T.StructType([*base.schema.fields, *new]))


def _encode(model: ByteBPE, texts: list[str | None]) -> list[pa.Array]:
    ids = [model.encode(t or "") for t in texts]
    return [pa.array(ids, pa.binary()), pa.array([len(x) // 4 for x in ids], pa.int64())]


def _decode(model: ByteBPE, ids: list[bytes | None]) -> list[pa.Array]:
    return [pa.array([model.decode(x or b"") for x in ids], pa.string())]


def _round(model: ByteBPE, texts: list[str | None]) -> list[pa.Array]:
    encoded = _encode(model, texts)
    return [*encoded, *_decode(model, encoded[0].to_pylist())]


_encode.reads = _round.reads = "text"
_decode.reads = "ids"
_IDS = [T.StructField("ids", T.BinaryType()), T.StructField("n_tokens", T.LongType())]
_DECODED = [T.StructField("decoded", T.StringType())]


def encode(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``docs`` with ``ids`` (little-endian uint32) and ``n_tokens`` of ``text``;
    ``tokenizer`` is the path of a tokenizer's JSON file on the driver."""
    return _apply(docs, tokenizer, _encode, _IDS)


def decode(rows: DataFrame, tokenizer: str) -> DataFrame:
    """``rows`` with ``decoded``, the text of ``ids``, special tokens written out."""
    return _apply(rows, tokenizer, _decode, _DECODED)


def encode_and_decode(docs: DataFrame, tokenizer: str) -> DataFrame:
    """:func:`encode`, then :func:`decode` of its ids, in one pass over the rows."""
    return _apply(docs, tokenizer, _round, [*_IDS, *_DECODED])

"""Benchmark decontamination by canonical templates.

Words lose punctuation at their ends and are lower-cased; words that vary when a
question is re-parameterised become typed placeholders: a number ``<num>``, a
number with a unit behind it or a unit word ``<unit>``, and a capitalised word
that opens no line or sentence ``<name>``.  Windows of ``width`` words of this template (an item
with fewer words is one window) are hashed, and the documents' windows are
hash-joined with the benchmark's.

Windows of one document and one item that lie on one alignment (the same
distance between their positions) are put together, and their slots are checked:
in one alignment each value of an item's slot must always stand for the same
value in the document, and the other way round.  A document is contaminated by
an item if a consistent alignment covers at least ``min_coverage`` of the item's
words.

:func:`find_all_leaks`, which the query and the pipeline use, also hashes windows of
the plain lower-cased words.  Such a window needs no slot check, and a word of the
item is covered if a window of either reading covers it, so that a verbatim copy
counts however its words are capitalised and wherever its lines and sentences begin.
There an alignment with contradicting slots loses only the windows that hold a slot
whose value is not the one that stands most often for the item's value (on a tie the
item's own value, then the one that comes first); one document value for two item
values is no contradiction.  The alignments of one text and one item are put
together: the words that any of them covers count, so that a copy with words put in
or left out is found; ``first_word`` is that of the alignment that covers most.  A run
of ``run_words`` plain words of an item is reported whatever part of the item it is.
Of equal windows of plain words a text needs its first only.  Windows of plain words
are hashed for every item: those with placeholders only by their literal values,
and items of fewer than ``min_words`` words as a whole.

A bitmap of fixed size with the benchmark's window hashes goes to the tasks, so
that only windows that may match leave the scan; the join decides.  It is a
pre-filter and nothing more: with a large benchmark it only lets more through.
No row of the benchmark or the documents reaches the driver.

Defined results: null and empty texts match nothing; an item with fewer than
``min_words`` words, or with placeholders only, is no template and is found
verbatim only; repeated rows of
one ``doc_id`` count as one document (:func:`find_all_leaks` scores different texts of
one ``doc_id`` or ``item_id`` by themselves); a null ``doc_id`` or ``item_id`` is kept
as such; on a tie of alignments the one with the lowest offset is reported.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlab.llm.textvec import LOWER, Chunk, chunks, long_hash, mix, prefix_hash, range_hash, windows, words

WIDTH = 8
MIN_WORDS = 5
MIN_COVERAGE = 0.5
RUN_WORDS = 13
BITMAP_BITS = 24

# Unit words, matched without case.
UNITS = """
mm cm m km in inch inches ft foot feet yd yard yards mi mile miles mg g kg gram grams kilogram kilograms lb lbs
pound pounds oz ounce ounces ton tons ml l liter liters litre litres gallon gallons s sec second seconds min minute
minutes h hr hour hours day days week weeks month months year years meter meters metre metres kilometer kilometers
kilometre kilometres cent cents dollar dollars euro euros usd eur percent degree degrees watt watts kw kwh volt volts
hz khz mhz ghz kb mb gb tb byte bytes mph kmh
""".split()

_PLAIN, _NUM, _UNIT, _NAME = 0, 1, 2, 3
_DIGIT = np.zeros(256, bool)
_DIGIT[ord("0") : ord("9") + 1] = True
_UPPER = np.zeros(256, bool)
_UPPER[ord("A") : ord("Z") + 1] = True
_LETTER = _UPPER.copy()
_LETTER[ord("a") : ord("z") + 1] = True
_LETTER[0x80:] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".!?:"]] = True
_MARKS = np.array([0, 0x6E756D, 0x756E6974, 0x6E616D65], np.uint64)


def _hash_of(word: str) -> int:
    data = np.frombuffer(word.encode(), np.uint8)
    return int(range_hash(prefix_hash(data), np.array([0]), np.array([len(data)]))[0])


_UNIT_HASHES = np.sort(np.array([_hash_of(u) for u in UNITS], np.uint64))


def _is_in(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(table, values), len(table) - 1)
    return table[at] == values


class Template:
    """Canonical words of a chunk: ``kind``, ``value`` (hash of the bare word),
    ``symbol`` (what windows are made of), ``row`` and ``pos`` in the row."""

    def __init__(self, chunk: Chunk):
        buf, w = chunk.buf, words(chunk)
        low = LOWER[buf]
        sums = prefix_hash(low)
        solid = np.flatnonzero(_LETTER[buf] | _DIGIT[buf])
        start = np.searchsorted(solid, w.start)
        end = np.searchsorted(solid, w.end)
        bare = end > start  # others are punctuation only and are no words
        self.row = w.row[bare]
        start, end = solid[start[bare]], solid[end[bare] - 1] + 1
        digits = np.concatenate([[0], np.cumsum(_DIGIT[buf])])
        letters = np.concatenate([[0], np.cumsum(_LETTER[buf])])
        n_digits, n_letters = digits[end] - digits[start], letters[end] - letters[start]
        self.value = long_hash(low, start, end, range_hash(sums, start, end))
        breaks = np.concatenate([[0], np.cumsum(buf == 0x0A)])
        n = len(start)
        opens = np.ones(n, bool)
        if n > 1:
            # A sentence ends in the raw word before; a line or row in between.
            tail = _STOP[buf[w.end[bare][:-1] - 1]]
            opens[1:] = (self.row[1:] != self.row[:-1]) | (breaks[start[1:]] > breaks[end[:-1]]) | tail
        capital = _UPPER[buf[start]] & ~opens if n else opens
        # "30km": digits first, then letters that are a unit.
        after = np.searchsorted(np.flatnonzero(_LETTER[buf]), start)
        first_letter = np.append(np.flatnonzero(_LETTER[buf]), len(buf))[after]
        mixed = (n_digits > 0) & (n_letters > 0) & _DIGIT[buf[start]]
        tail_hash = range_hash(sums, np.where(mixed, first_letter, start), end)
        unit = _is_in(self.value, _UNIT_HASHES) & (n_digits == 0) | mixed & _is_in(tail_hash, _UNIT_HASHES)
        kind = np.where(unit, _UNIT, np.where((n_digits > 0) & (n_letters == 0), _NUM, np.where(capital, _NAME, _PLAIN)))
        self.kind = kind
        self.symbol = np.where(kind == _PLAIN, self.value, mix(_MARKS[kind]))
        first = np.searchsorted(self.row, np.arange(chunk.n + 1))
        self.first = first
        self.pos = np.arange(n) - first[self.row]


def _emit(ids: list, t: Template, at: np.ndarray, values: np.ndarray, width: np.ndarray, exact: bool) -> tuple[list, list, list, list]:
    """Rows of windows: id, position, hash and the slots of the window (a window
    of plain words has none)."""
    slots = []
    for a, k in zip(at.tolist(), width.tolist()):
        s = np.flatnonzero(t.kind[a : a + k]) if not exact else np.zeros(0, np.int64)
        slots.append([int(x) for x in t.value[a + s].view(np.int64)])
    return [ids[r] for r in t.row[at]], t.pos[at].tolist(), values.view(np.int64).tolist(), slots


def _hashes(t: Template, width: int, exact: bool) -> tuple[np.ndarray, np.ndarray]:
    at, values = windows(t.value if exact else t.symbol, t.row, width)
    return at, mix(values ^ np.uint64(width) ^ _READING[exact])


_READING = (np.uint64(0), np.uint64(0x706C61696E << 16))
_ITEM = "item_id {}, item_part long, n_words int, exact boolean, width int, item_pos int, h long, item_slots array<long>, item_at array<int>"
_HIT = "doc_id {}, doc_part long, doc_pos int, h long, doc_slots array<long>"


def _benchmark_windows(width: int, min_words: int, readings: list[bool], run_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, parts = batch.column(0).to_pylist(), batch.column(2).to_numpy()
            for chunk in chunks(batch.column(1)):
                t = Template(chunk)
                n = np.diff(t.first)
                sizes = [(exact, int(k)) for exact in readings for k in np.unique(np.minimum(n[n >= (1 if exact else min_words)], width))]
                if True in readings and run_words > width:
                    sizes.append((True, run_words))
                for exact, k in sizes:
                    at, values = _hashes(t, k, exact)
                    size = n[t.row[at]]
                    plain = np.concatenate([[0], np.cumsum(t.kind == _PLAIN)])
                    use = ((np.minimum(size, width) == k) | (k > width)) & (exact | (plain[at + k] > plain[at]))
                    at, values = at[use], values[use]
                    item, pos, h, slots = _emit(ids[chunk.first : chunk.first + chunk.n], t, at, values, np.full(len(at), k), exact)
                    spots = [(p + np.flatnonzero(t.kind[a : a + k])).tolist() if not exact else [] for a, p in zip(at.tolist(), pos)]
                    cols = [pa.array(item, batch.schema.field(0).type), pa.array(parts[chunk.first + t.row[at]], pa.int64()), pa.array(n[t.row[at]], pa.int32()), pa.array(np.full(len(at), exact)), pa.array(np.full(len(at), k), pa.int32()), pa.array(pos, pa.int32()), pa.array(h, pa.int64()), pa.array(slots, pa.list_(pa.int64())), pa.array(spots, pa.list_(pa.int32()))]
                    yield pa.RecordBatch.from_arrays(cols, names=["item_id", "item_part", "n_words", "exact", "width", "item_pos", "h", "item_slots", "item_at"])

    return run


def _document_windows(shared, widths: list[tuple[bool, int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            ids, parts = batch.column(0).to_pylist(), batch.column(2).to_numpy()
            for chunk in chunks(batch.column(1)):
                t = Template(chunk)
                for exact, k in widths:
                    at, values = _hashes(t, k, exact)
                    slot = values >> np.uint64(64 - BITMAP_BITS)
                    hit = (bits[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1
                    at, values = at[hit], values[hit]
                    if exact and len(at):
                        once = np.sort(np.unique(np.stack([t.row[at].astype(np.uint64), values]), axis=1, return_index=True)[1])
                        at, values = at[once], values[once]
                    if len(at):
                        doc, pos, h, slots = _emit(ids[chunk.first : chunk.first + chunk.n], t, at, values, np.full(len(at), k), exact)
                        cols = [pa.array(doc, batch.schema.field(0).type), pa.array(parts[chunk.first + t.row[at]], pa.int64()), pa.array(pos, pa.int32()), pa.array(h, pa.int64()), pa.array(slots, pa.list_(pa.int64()))]
                        yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "doc_part", "doc_pos", "h", "doc_slots"])

    return run


def _bitmap(items: DataFrame) -> tuple[bytes, list[tuple[bool, int]]]:
    """Bit ``h >> (64 - BITMAP_BITS)`` of every window, as at most
    ``2**BITMAP_BITS / 64`` words, and the windows' widths (at most ``width``, and ``run_words``) by reading."""
    slot = F.shiftrightunsigned("h", 64 - BITMAP_BITS)
    words_ = items.groupBy(F.shiftright(slot, 6).alias("w")).agg(F.bit_or(F.expr(f"shiftleft(1L, int(shiftrightunsigned(h, {64 - BITMAP_BITS}) & 63))")).alias("b"))
    bits = np.zeros(1 << (BITMAP_BITS - 6), np.int64)
    for w, b in words_.collect():
        bits[w] = b
    return bits.tobytes(), sorted((r[0], r[1]) for r in items.select("exact", "width").distinct().collect())


def _meetings(docs: DataFrame, benchmark: DataFrame, width: int, min_words: int, readings: list[bool], run_words: int = RUN_WORDS) -> DataFrame:
    """Every window of a document that is one of an item's."""
    from barlab.llm.scratch import stored

    id_type, item_type = docs.schema["doc_id"].dataType.simpleString(), benchmark.schema["item_id"].dataType.simpleString()
    text = F.col("text").cast("string")
    bench = benchmark.select("item_id", text.alias("text")).distinct().withColumn("part", F.xxhash64("text"))
    items = stored(bench.mapInArrow(_benchmark_windows(width, min_words, readings, run_words), _ITEM.format(item_type)), "benchmark-windows", small=True)
    bits, widths = _bitmap(items)
    shared = docs.sparkSession.sparkContext.broadcast(bits)
    hits = docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("part")).mapInArrow(_document_windows(shared, widths), _HIT.format(id_type))
    return hits.join(items, "h").withColumn("offset", F.col("doc_pos") - F.col("item_pos"))


def find_leaks(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, min_words: int = MIN_WORDS, min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """``(doc_id, item_id, first_word, n_covered, n_words, coverage, n_slots,
    n_changed)``: one row for each document and item it contains; ``n_changed``
    of the ``n_slots`` distinct slot values differ from the item's.  This is the
    template reading alone; :func:`find_all_leaks` has both."""
    met = _meetings(docs, benchmark, width, min_words, [False])
    group = ["doc_id", "item_id", "offset"]
    lined = met.groupBy(*group).agg(
        F.max("n_words").alias("n_words"),
        F.array_distinct(F.flatten(F.collect_set(F.expr("sequence(item_pos, item_pos + width - 1)")))).alias("covered"),
        F.array_distinct(F.flatten(F.collect_set(F.arrays_zip(F.col("item_slots").alias("i"), F.col("doc_slots").alias("d"))))).alias("pairs"),
    )
    distinct = lambda part: F.size(F.array_distinct(F.transform("pairs", lambda p: p[part])))
    scored = lined.select(
        *group,
        (F.col("offset") + F.array_min("covered")).alias("first_word"),
        F.size("covered").alias("n_covered"),
        "n_words",
        F.size("pairs").alias("n_slots"),
        F.size(F.filter("pairs", lambda p: p["i"] != p["d"])).alias("n_changed"),
        ((distinct("i") == F.size("pairs")) & (distinct("d") == F.size("pairs"))).alias("consistent"),
    ).where("consistent")
    scored = scored.withColumn("coverage", F.col("n_covered") / F.col("n_words")).where(F.col("coverage") >= min_coverage)
    best = F.max_by(F.struct("first_word", "n_covered", "n_words", "coverage", "n_slots", "n_changed"), F.struct("coverage", -F.col("offset"))).alias("best")
    return scored.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "best.*")


_FOUND = "doc_id {}, item_id {}, first_word int, n_covered int, n_words int, coverage double, n_slots int, n_changed int"


def _meant(met: list[dict]) -> dict[int, int]:
    """The document's value for each of the item's slot values in one alignment."""
    seen = {x for m in met for x in zip(m["item_at"], m["item_slots"], m["doc_slots"])}
    count, first = Counter((i, d) for _, i, d in seen), {}
    for at, i, d in seen:
        first[i, d] = min(at, first.get((i, d), at))
    order = sorted(count, key=lambda p: (count[p], p[0] == p[1], -first[p]))
    return dict(order)


def _score(n_words: int, met: list[dict], min_coverage: float, run_words: int) -> tuple | None:
    """What the windows that one text and one item share amount to."""
    lines = {}
    for m in met:
        lines.setdefault(m["offset"], []).append(m)
    covered, slots, most, first = set(), set(), 0, 0
    for offset in sorted(lines):
        meant = _meant(lines[offset])
        kept = [m for m in lines[offset] if m["item_slots"] == m["doc_slots"] or all(meant[i] == d for i, d in zip(m["item_slots"], m["doc_slots"]))]
        here = {m["item_pos"] + k for m in kept for k in range(m["width"])}
        slots.update(p for m in kept for p in zip(m["item_slots"], m["doc_slots"]))
        if len(here) > most:
            most, first = len(here), offset + min(here)
        covered |= here
    run = any(m["exact"] and m["width"] >= run_words for m in met)
    if not run and (not covered or len(covered) / n_words < min_coverage):
        return None
    return first, len(covered), n_words, len(covered) / n_words, len(slots), sum(i != d for i, d in slots)


def _scores(schema: pa.Schema, min_coverage: float, run_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, item, n_words, met in zip(*(c.to_pylist() for c in batch.columns)):
                found = _score(n_words, met, min_coverage, run_words)
                if found:
                    rows.append((doc, item, *found))
            cols = list(zip(*rows)) or [()] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

    return run


def find_all_leaks(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, min_words: int = MIN_WORDS, min_coverage: float = MIN_COVERAGE, run_words: int = RUN_WORDS) -> DataFrame:
    """The columns of :func:`find_leaks`, for windows of the template and of the
    plain words together; slots are counted on windows of the template."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    id_type, item_type = docs.schema["doc_id"].dataType.simpleString(), benchmark.schema["item_id"].dataType.simpleString()
    met = _meetings(docs, benchmark, width, min_words, [False, True], run_words)
    window = F.struct("offset", "item_pos", "width", "exact", "item_slots", "item_at", "doc_slots")
    lined = met.groupBy("doc_id", "doc_part", "item_id", "item_part").agg(F.max("n_words").alias("n_words"), F.collect_set(window).alias("met"))
    found = _FOUND.format(id_type, item_type)
    scored = lined.drop("doc_part", "item_part").mapInArrow(_scores(to_arrow_schema(StructType.fromDDL(found)), min_coverage, run_words), found)
    row = F.struct("first_word", "n_covered", "n_words", "coverage", "n_slots", "n_changed")
    best = F.max_by(row, F.struct("coverage", "n_covered", -F.col("first_word"), "n_slots", "n_changed")).alias("best")
    return scored.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "best.*")


def drop_leaks(docs: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """``docs`` without the contaminated documents."""
    bad = find_all_leaks(docs, benchmark, **settings).select(F.col("doc_id").alias("leak")).distinct()
    # The whole row is one column here, so that no name of its own meets another.
    kept = docs.select(F.struct("*").alias("doc")).join(bad, F.col("doc.doc_id").eqNullSafe(F.col("leak")), "left_anti")
    return kept.select(*[F.col("doc").getField(c).alias(c) for c in docs.columns])

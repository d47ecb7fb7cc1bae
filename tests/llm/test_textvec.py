import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from barlab.llm import decontaminate, textvec


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab \n\t\x0b\x0c\r\x1cé中A.,", max_size=30)), max_size=8), st.integers(1, 40))
def test_words_of_chunks(texts, limit):
    got: list[list[bytes]] = []
    for chunk in textvec.chunks(pa.array(texts, pa.string()), limit):
        assert chunk.first == len(got)
        w = textvec.words(chunk)
        got += [[bytes(chunk.buf[a:b]) for a, b in zip(w.start[w.first[r] : w.first[r + 1]], w.end[w.first[r] : w.first[r + 1]])] for r in range(chunk.n)]
        start, end, row = textvec.bare_words(chunk)
        assert all(chunk.bounds[r] <= a < b <= chunk.bounds[r + 1] for a, b, r in zip(start, end, row))
    assert got == [[x.encode() for x in re.findall(r"[^\x20\x09-\x0D]+", t or "")] for t in texts]


def test_slices_and_large_types():
    texts = pa.array(["x", "one two", None, "three"], pa.large_string()).slice(1)
    (chunk,) = textvec.chunks(texts)
    assert bytes(chunk.buf) == b"one twothree" and chunk.bounds.tolist() == [0, 7, 7, 12]


def test_equal_ranges_have_equal_hashes():
    buf = np.frombuffer(b"abcabcab\x00\x00ab", np.uint8)
    sums = textvec.prefix_hash(buf)
    at = np.array([0, 3, 6, 10])
    h = textvec.range_hash(sums, at, at + 2)
    assert len(set(h.tolist())) == 1
    assert textvec.range_hash(sums, np.array([8]), np.array([9])) != textvec.range_hash(sums, np.array([8]), np.array([10]))


def test_shingles_of_short_rows():
    (chunk,) = textvec.chunks(pa.array(["a b", "A  B", "b a", "", "a b c d e", "A b c d e f"]))
    rows, values = textvec.shingles(chunk, 5)
    by = {r: values[rows == r].tolist() for r in range(6)}
    assert by[0] == by[1] and len(by[0]) == 1 and len(by[2]) == 1 and by[3] == [] and by[4] == by[5][:1] and len(by[5]) == 2


def test_long_words_that_sums_of_powers_confuse():
    """A Thue-Morse word of two letters and its complement are different words."""
    a = "a"
    while len(a) < 1024:
        a += a.translate(str.maketrans("ab", "ba"))
    b = a.translate(str.maketrans("ab", "ba"))
    (chunk,) = textvec.chunks(pa.array([a, b, f"x y z v {a}", f"x y z v {b}", f"X y z v {a.upper()}"]))
    rows, values = textvec.shingles(chunk, 5)
    by = {r: values[rows == r].tolist() for r in range(5)}
    assert by[0] != by[1] and by[2] != by[3] and by[2] == by[4]
    value = decontaminate.Template(chunk).value.tolist()
    assert value[0] != value[1] and value[6] != value[11] and value[0] == value[6]

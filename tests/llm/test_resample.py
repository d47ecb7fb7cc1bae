import hashlib
import math
import re
import zlib

import numpy as np
from hypothesis import given
from hypothesis import strategies as st

import llm_rows
from barlab.llm import resample

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(low)
    return len(w), [zlib.crc32(f.encode()) % 10_000 for f in w + [f"{a} {b}" for a, b in zip(w, w[1:])]]


def brute(docs, target):
    s, t = np.zeros(10_000, int), np.zeros(10_000, int)
    for side, texts in ((s, [r[1] for r in docs]), (t, target)):
        for text in texts:
            np.add.at(side, np.array(features(text)[1], int), 1)
    S, T = s.sum(), t.sum()
    gain = [math.floor(1000 * math.log((b + 1) * (S + 10_000) / ((a + 1) * (T + 10_000)))) for a, b in zip(s.tolist(), t.tolist())]
    out = []
    for r in docs:
        n, f = features(r[1])
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if r[0] is None else r[0]}".encode()).hexdigest()[:8], 16)
        out.append((n, r[0], len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((x for x in out if x[0] >= 20), key=lambda x: (-x[4], x[1] is None, x[1] or 0))
    drawn = able[: 25 * len(able) // 100]
    return [x[1:] + (None,) for x in out], [x[1:] for x in drawn]


def test_awkward_rows_against_brute_force(spark):
    rows = llm_rows.awkward()
    target = [None, "", "the ing tion", llm_rows.awkward()[5][1]]
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id int, text string")
    got = [tuple(r) for r in resample.resample(llm_rows.docs(spark), bench).collect()]
    every, drawn = brute(rows, target)
    text = lambda r: str(r)
    assert sorted((x[:4] + (None,) for x in got), key=text) == sorted(every, key=text)
    assert [x[:4] for x in sorted((x for x in got if x[4]), key=lambda x: x[4])] == drawn
    assert sorted(x[4] for x in got if x[4]) == list(range(1, len(drawn) + 1))


def test_empty_tables(spark):
    bench = spark.createDataFrame([], "text string")
    assert resample.resample(llm_rows.empty(spark), bench).collect() == []
    rows = resample.resample(llm_rows.docs(spark), bench).collect()
    assert len(rows) == len(llm_rows.awkward())


def test_target_words_are_drawn_first(spark):
    plain = [(i, " ".join(f"w{(i * 31 + j) % 97}" for j in range(40)), "en", "s", 1) for i in range(300)]
    wanted = [(1000 + i, " ".join(f"t{(i * 7 + j) % 53}" for j in range(40)), "en", "s", 1) for i in range(30)]
    bench = spark.createDataFrame([(" ".join(f"t{j % 53}" for j in range(400)),)], "text string")
    drawn = [r.doc_id for r in resample.resample(llm_rows.docs(spark, plain + wanted), bench).where("rank is not null").collect()]
    assert len(drawn) == 82 and sum(d >= 1000 for d in drawn) == 30


@given(st.lists(st.text(alphabet="aB1é中 \x00\n-z", max_size=120), min_size=1, max_size=6))
def test_batch_concatenation_keeps_texts_apart(texts):
    words = resample._Words([t.encode() for t in texts])
    row, bucket = words.features(2, 10_000)
    for i, t in enumerate(texts):
        n, want = features(t)
        assert int((words.row == i).sum()) == n
        assert sorted(bucket[row == i].tolist()) == sorted(want)


def test_long_words_and_longer_runs():
    texts = ["x" * 1000 + " y", "é" * 70, "b " * 50 + "z" * 64 + " " + "z" * 65]
    words = resample._Words([t.encode() for t in texts])
    row, bucket = words.features(3, 997)
    for i, t in enumerate(texts):
        w = WORD.findall(t)
        want = [zlib.crc32(" ".join(w[k : k + n]).encode()) % 997 for n in (1, 2, 3) for k in range(len(w) - n + 1)]
        assert sorted(bucket[row == i].tolist()) == sorted(want)

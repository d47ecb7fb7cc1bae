import hashlib
import os
import random
import re
from collections import Counter

import numpy as np
import pytest

from barlab.llm import substring_dedup
from barlab.llm.queries import op5_substring_dedup, table
from conftest import SF0001
from llm_rows import awkward, docs, empty, prose


def brute(rows, length):
    data = [(d, (t or "").encode()) for d, t, *_ in rows]
    count = Counter(b[i : i + length] for _, b in data for i in range(len(b) - length + 1))
    out = []
    for d, b in data:
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - length + 1):
            if count[b[i : i + length]] > 1:
                gone[i : i + length] = True
        gone[len(b)] = False
        edge = np.flatnonzero(np.diff(np.concatenate([[False], gone]).astype(int)))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((d, len(b), edge[::2].tolist(), edge[1::2].tolist(), kept))
    return sorted(out, key=repr)


def run(spark, rows, length, **settings):
    got = substring_dedup.remove_repeats(docs(spark, rows), length, **settings).collect()
    return sorted(((r.doc_id, r.n_bytes, list(r.span_start), list(r.span_end), bytes(r.kept)) for r in got), key=repr)


def planted(seed, n=60):
    rnd = random.Random(seed)
    shared = [prose(rnd, rnd.randint(20, 60)) for _ in range(5)]
    rows = []
    for i in range(n):
        parts = [prose(rnd, rnd.randint(1, 80)) for _ in range(rnd.randint(1, 4))]
        for _ in range(rnd.randint(0, 3)):
            p = rnd.choice(shared)
            a = rnd.randrange(len(p) // 2)
            parts.insert(rnd.randrange(len(parts) + 1), p[a : a + rnd.randint(90, 400)])
        rows.append((i, rnd.choice([" ", "", "é"]).join(parts), "en", "s", 1))
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("hot", [substring_dedup.HOT_CONTEXTS, 2])
def test_planted_passages_match_brute_force(spark, seed, hot):
    rows = planted(seed)
    for length in (100, 200):
        assert run(spark, rows, length, hot_contexts=hot) == brute(rows, length)


def test_awkward_rows_match_brute_force(spark):
    rows = [r for r in awkward() if r[0] != 9]
    assert run(spark, rows, 200) == brute(rows, 200)


def test_rows_that_share_an_id_are_cut_by_themselves(spark):
    rnd = random.Random(11)
    p = prose(rnd, 80)
    texts = [(None, prose(rnd, 50) + p), (None, prose(rnd, 120)), (5, p + prose(rnd, 40)), (5, prose(rnd, 90)), (5, p), (6, None)]
    rows = [(d, t, "en", "s", 1) for d, t in texts]
    assert run(spark, rows, 200) == brute(rows, 200)


def test_many_copies_of_one_row(spark):
    rnd = random.Random(12)
    p = prose(rnd, 100)
    rows = [(1, p, "en", "s", 1)] * 300 + [(2, prose(rnd, 60) + p[:250], "en", "s", 1)]
    assert run(spark, rows, 200) == brute(rows, 200)


def test_repeats_inside_one_text(spark):
    rnd = random.Random(9)
    p = prose(rnd, 60)
    rows = [(1, p + " between " + p, "en", "s", 1), (2, "z" * 250, "en", "s", 1), (3, "z" * 199, "en", "s", 1), (4, "xy" * 101, "en", "s", 1), (5, prose(rnd, 100), "en", "s", 1)]
    assert run(spark, rows, 200) == brute(rows, 200)


def test_documents_table(spark):
    rows = [tuple(r) for r in table(spark, SF0001, "documents").select("doc_id", "text").collect()]
    want = {d: (n, sum(e) - sum(s), len(s), hashlib.sha256(k).hexdigest()) for d, n, s, e, k in brute(rows, 200)}
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in op5_substring_dedup(spark, SF0001).collect()}
    assert got == want


def test_empty_table(spark):
    assert substring_dedup.remove_repeats(empty(spark)).count() == 0


def test_every_string_has_one_anchor_and_equal_strings_the_same():
    import pyarrow as pa

    from barlab.llm.textvec import chunks, prefix_hash

    rnd = random.Random(4)
    p = prose(rnd, 80)[:300].encode()
    texts = [prose(rnd, 50).encode() + p, b"short", p + prose(rnd, 50).encode()]
    (chunk,) = chunks(pa.array(texts, pa.binary()))
    row, at, first, last = substring_dedup.find_anchors(chunk, prefix_hash(chunk.buf), 200)
    anchor = {int(i): int(a) for a, f, l in zip(at, first, last) for i in range(f, l + 1)}
    want = [i for r in range(3) for i in range(chunk.bounds[r], chunk.bounds[r + 1] - 199)]
    assert sorted(anchor) == want and all(i <= a <= i + 200 - substring_dedup.GRAM for i, a in anchor.items())
    x, y = int(chunk.bounds[1]) - 300, int(chunk.bounds[2])
    assert all(anchor[x + k] - x == anchor[y + k] - y for k in range(101))


def test_buckets_are_dealt_by_an_exchange_of_their_own(spark, monkeypatch):
    # Over a join by gram, Spark drops repartition(gram); should the join turn into a broadcast
    # while it runs, its shuffle is read by mapper and a bucket's contexts part.
    plans, store = [], substring_dedup.stored

    def noted(df, *args, **settings):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return store(df, *args, **settings)

    monkeypatch.setattr(substring_dedup, "stored", noted)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = substring_dedup.remove_repeats(docs(spark, planted(5)), 100, hot_contexts=2)
        plans.append(out._jdf.queryExecution().executedPlan().toString())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sum(len(re.findall(r"hashpartitioning\(gram#\d+L, \d+\), REPARTITION_BY_NUM", p)) for p in plans) == 1


def test_texts_are_shuffled_once_at_a_time(spark, tmp_path, monkeypatch):
    rows = planted(6)
    docs(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    plans, store = [], substring_dedup.stored

    def noted(df, *args, **settings):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return store(df, *args, **settings)

    monkeypatch.setattr(substring_dedup, "stored", noted)
    monkeypatch.setattr(substring_dedup, "scratch_dir", lambda spark, what: f"file://{tmp_path}/scratch/{what}")
    out = substring_dedup.remove_repeats(spark.read.parquet(f"{tmp_path}/documents.parquet"), 100, hot_contexts=2)
    plans.append(out._jdf.queryExecution().optimizedPlan().toString())
    # Anchors; contexts, of hot buckets and others; the cut.
    assert [n for p in plans if (n := len(re.findall(r"Relation \[.*\btext#", p)))] == [1, 1, 1]
    assert os.listdir(tmp_path / "scratch") == ["text-spans"]
    assert sorted(((r.doc_id, r.n_bytes, list(r.span_start), list(r.span_end), bytes(r.kept)) for r in out.collect()), key=repr) == brute(rows, 100)

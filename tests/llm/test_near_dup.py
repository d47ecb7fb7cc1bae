import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from barlab.llm import near_dup
from barlab.llm.graph import components
from barlab.llm.queries import table
from conftest import SF0001
from llm_rows import awkward, docs, empty, prose


def shingles(text):
    words = [w.lower() if w.isascii() else "".join(c.lower() if c.isascii() else c for c in w) for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    return Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4)) if len(words) >= 5 else Counter([tuple(words)] if words else [])


def classes(pairs):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        parent[find(a)] = find(b)
    return find


def similarity(a, b):
    both = sum(min(n, b[s]) for s, n in a.items() if s in b)
    total = sum(a.values()) + sum(b.values()) - both
    return both / total if total else 0.0


def check(spark, rows, sure=0.82, apart=0.77):
    """Against all pairs, by plain Jaccard with room for the weights between 1 and 1.25."""
    found = near_dup.near_dup_classes(docs(spark, rows)).collect()
    assert len(found) == len(rows)
    cls = {(r.doc_id, bytes(r.digest)): bytes(r.class_digest) for r in found}
    texts = defaultdict(set)
    import hashlib

    for d, t, *_ in rows:
        texts[t or ""].add(d)
    name = {t: hashlib.md5(t.encode()).digest() for t in texts}
    got = {t: {cls[d, name[t]] for d in ids} for t, ids in texts.items()}
    assert all(len(c) == 1 for c in got.values())
    got = {t: c.pop() for t, c in got.items()}
    distinct = list(texts)
    sets = [shingles(t) for t in distinct]
    sims = [(i, j, similarity(sets[i], sets[j])) for i in range(len(distinct)) for j in range(i)]
    for i, j, s in sims:
        if s >= sure:
            assert got[distinct[i]] == got[distinct[j]], (distinct[i][:60], distinct[j][:60], s)
    loose = classes((i, j) for i, j, s in sims if s >= apart)
    for c in set(got.values()):
        members = [i for i, t in enumerate(distinct) if got[t] == c]
        assert len({loose(i) for i in members}) == 1
    return found


def copies(rnd, n, edits):
    base = prose(rnd, 200).split()
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(edits):
            w[rnd.randrange(len(w))] = prose(rnd, 1) + "x"
        out.append(" ".join(w))
    return out


def test_awkward_rows(spark):
    found = check(spark, awkward())
    by = {r.doc_id: r for r in found}
    assert by[6].class_id == by[5].class_id == by[None].class_id == 5
    assert by[1].class_id == by[2].class_id == 1 and by[3].class_id == 3


@pytest.mark.parametrize("edits", [1, 3, 6, 9])
def test_groups_of_edited_copies(spark, edits):
    rnd = random.Random(edits)
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(copies(rnd, 40, edits) + copies(rnd, 30, 1) + [prose(rnd, 150) for _ in range(20)])]
    check(spark, rows)


def test_members_of_other_components_are_compared(spark):
    """A chain in one bucket: each text like the next, none like all, so the hub
    leaves some to the exact rest."""
    rnd = random.Random(11)
    words = prose(rnd, 200).split()
    rows = []
    for i in range(8):
        rows.append((i, " ".join(words), "en", "s", 1))
        at = 25 * i
        words[at : at + 12] = [w + "q" for w in words[at : at + 12]]
    found = near_dup.near_dup_classes(docs(spark, rows), bands=60, rows=1).collect()
    sets = [shingles(r[1]) for r in rows]
    assert all(similarity(sets[i], sets[i + 1]) > 0.84 for i in range(7)) and similarity(sets[0], sets[7]) < 0.5
    assert {r.class_id for r in found} == {0}


def test_similarities_of_a_block():
    rnd = random.Random(4)
    texts = copies(rnd, 12, 6) + ["", "one two", "one  TWO", prose(rnd, 300)]
    idf = np.ones(1 << near_dup.FEATURE_BITS, np.float32)
    got = near_dup._similarities(pa.array(texts), idf)
    sets = [shingles(t) for t in texts]
    want = [[similarity(a, b) for b in sets] for a in sets]
    above = np.triu_indices(len(texts), 1)  # what the operator reads
    assert np.allclose(got[above], np.array(want)[above])


def test_blocks_of_short_texts_are_bounded(spark, monkeypatch):
    """Many short texts of one family make several blocks, and no link is lost."""
    monkeypatch.setattr(near_dup, "LEAST_BYTES", 1 << 18)
    test_members_of_other_components_are_compared(spark)


def test_documents_table(spark):
    rows = [tuple(r) for r in table(spark, SF0001, "documents").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    check(spark, rows)


def test_one_of_each_class_stays(spark):
    kept = near_dup.drop_near_dups(docs(spark))
    assert kept.columns == docs(spark).columns
    ids = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)
    assert 5 in ids and not {2, 6, 7} & set(ids) and len(ids) == len(set(ids))


def test_empty_table(spark):
    assert near_dup.near_dup_classes(empty(spark)).count() == 0 and near_dup.drop_near_dups(empty(spark)).count() == 0


def test_samples_agree_as_often_as_the_weighted_jaccard():
    rnd = np.random.default_rng(2)
    ids = rnd.integers(1, 1 << 44, 300).astype(np.uint64)
    wa, wb = rnd.uniform(1, 6, 300), rnd.uniform(1, 6, 300)
    wb[:120] = wa[:120]
    sampler = near_dup.Sampler(4000)
    a = sampler.samples(ids[:260], np.log(wa[:260]).astype(np.float32), np.array([0]))
    b = sampler.samples(ids[20:], np.log(wb[20:]).astype(np.float32), np.array([0]))
    x, y = np.zeros(300), np.zeros(300)
    x[:260], y[20:] = wa[:260], wb[20:]
    truth = np.minimum(x, y).sum() / np.maximum(x, y).sum()
    assert abs((a == b).mean() - truth) < 0.03


def test_components_of_paths_stars_and_rings(spark):
    rnd = random.Random(1)
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 40)] + [(200 + i, 200 + (i + 1) % 9) for i in range(9)] + [(5, 5)]
    rnd.shuffle(edges)
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    find = classes(edges)
    least = {}
    for n in got:
        least[find(n)] = min(n, least.get(find(n), n))
    assert got == {n: least[find(n)] for n in got} and len(got) == 61 + 40 + 9
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0

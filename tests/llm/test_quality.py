import itertools
import random
import re
from collections import Counter

import numpy as np

from barlab.llm import quality
from barlab.llm.queries import op2_line_quality, table
from conftest import SF001
from llm_rows import awkward, docs, empty

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def stats(text):
    text = text or ""
    w = WORD.findall(text)
    seen, dup, runs, cover = set(), 0, Counter(), set()
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    for k in range(len(w) - 2):
        runs[tuple(w[k : k + 3])] += 1
    for k in range(len(w) - 2):
        if runs[tuple(w[k : k + 3])] > 1:
            cover |= {k, k + 1, k + 2}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(cover)


COLS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def test_statistics_match_brute_force(spark):
    texts = {r.doc_id: r.text for r in table(spark, SF001, "documents").collect()}
    rows = op2_line_quality(spark, SF001).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = stats(texts[r.doc_id])
        assert tuple(r[c] for c in COLS) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0]) and not (r.base_failed and r.kept)


def test_verdicts_follow_the_quality_labels(spark):
    label = {r.doc_id: r.quality for r in table(spark, SF001, "labels").collect()}
    rows = [r for r in op2_line_quality(spark, SF001).collect() if r.doc_id in label and not r.base_failed]
    good = [r.kept for r in rows if label[r.doc_id] == 1]
    bad = [r.kept for r in rows if label[r.doc_id] == 0]
    assert np.mean(good) > 0.98 and np.mean(bad) < 0.1


def test_awkward_rows(spark):
    field = quality.ChainField(np.random.default_rng(1).normal(size=(quality.N_FEATURES, 2)), np.eye(2))
    rows = quality.label_lines(docs(spark), field).collect()
    assert len(rows) == len(awkward())
    for r in rows:
        assert tuple(r[c] for c in COLS) == stats(r.text)
        assert len(r.line_is_content) == len((r.text or "").split("\n"))
    assert quality.label_lines(empty(spark), field).count() == 0


def test_decoding_is_the_best_of_all_sequences():
    rnd = np.random.default_rng(4)
    for _ in range(30):
        sizes = rnd.integers(1, 9, 6)
        first = np.concatenate([[0], np.cumsum(sizes)])
        x = rnd.normal(size=(first[-1], 3))
        field = quality.ChainField(rnd.normal(size=(3, 2)), rnd.normal(size=(2, 2)))
        got = field.decode(x, first)
        for a, b in zip(first[:-1], first[1:]):
            score = lambda y: sum(x[a + i] @ field.emit[:, s] for i, s in enumerate(y)) + sum(field.pair[p, q] for p, q in zip(y, y[1:]))
            best = max(itertools.product((0, 1), repeat=b - a), key=score)
            assert tuple(got[a:b]) == best


def test_fit_learns_labels_and_their_neighbours():
    rnd = np.random.default_rng(8)
    first = np.arange(0, 2001, 20)
    labels = np.repeat(rnd.integers(0, 2, 200), 10)
    x = np.stack([np.ones(2000), labels + rnd.normal(0, 1.0, 2000)], axis=1)
    field = quality.ChainField.fit(x, first, labels)
    alone = quality.ChainField(field.emit, np.zeros((2, 2)))
    assert (alone.decode(x, first) == labels).mean() + 0.1 < (field.decode(x, first) == labels).mean()
    # At the maximum, more steps change nothing.
    longer = quality.ChainField.fit(x, first, labels, steps=1000)
    assert np.abs(longer.pair - field.pair).max() < 0.05 and np.abs(longer.emit - field.emit).max() < 0.05


def test_no_labels_keep_all(spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    rows = quality.label_lines(docs(spark), quality.fit_field(docs(spark), none)).collect()
    assert all(all(r.line_is_content) for r in rows)


def test_long_lines_and_words_of_one_power_hash(spark):
    a = "a"
    while len(a) < 4096:  # each text and its complement: their sums of powers modulo 2^64 coincide
        a += a.translate(str.maketrans("ab", "ba"))
    b = a.translate(str.maketrans("ab", "ba"))
    texts = [f"{a}\n{b}", f"{a}\n{a}", f"{a} x y {b} x y {a} x y"]
    field = quality.ChainField(np.zeros((quality.N_FEATURES, 2)), np.zeros((2, 2)))
    got = quality.label_lines(docs(spark, [(i, t, "en", "s", 1) for i, t in enumerate(texts)]), field).collect()
    for r in got:
        assert tuple(r[c] for c in COLS) == stats(texts[r.doc_id])
    assert sorted(r.n_dup_lines for r in got) == [0, 0, 1]


NAVIGATION = ["HOME | ABOUT | CONTACT | LOGIN", "<< PREV | NEXT >>", "SHARE: # # & |", "MENU > SHOP > CART ($0) > $$$ SALE", "& COPYRIGHT | TERMS | PRIVACY | COOKIES"]


def test_navigation_lines_inside_good_documents(spark):
    """Planted in documents whose labels were not learned; none is in the learned ones."""
    sf = "/root/testdata/sf0.1"
    documents, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    held = "crc32(cast(doc_id as string)) % 4 = 0"
    field = quality.fit_field(documents, labels.where(f"not ({held})"))
    good = documents.join(labels.where("quality = 1"), "doc_id").where(held).where("text like '%\\n%'").orderBy("doc_id").limit(200).collect()
    rnd, gold, rows = random.Random(3), {}, []
    for r in good:
        lines = [(x, True) for x in r.text.split("\n")]
        for _ in range(rnd.randint(1, 4)):
            at = rnd.choice([0, len(lines), rnd.randint(0, len(lines))])
            lines[at:at] = [(x, False) for x in rnd.sample(NAVIGATION, rnd.randint(1, 3))]
        gold[r.doc_id] = [c for _, c in lines]
        rows.append((r.doc_id, "\n".join(x for x, _ in lines), "en", "s", 1))
    got = quality.label_lines(docs(spark, rows), field).collect()
    pairs = Counter(p for r in got for p in zip(r.line_is_content, gold[r.doc_id]))
    caught, wrong, missed = pairs[False, False], pairs[False, True], pairs[True, False]
    assert 2 * caught / (2 * caught + wrong + missed) > 0.95
    given = quality.label_lines(documents, field).where("content_share > 0 and content_share < 1")
    assert given.count() > 20

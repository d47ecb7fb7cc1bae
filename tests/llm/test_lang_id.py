import zlib
from collections import Counter, defaultdict

from barlab.llm import lang_id
from barlab.llm.queries import op7_language_id, table
from conftest import SF001
from llm_rows import awkward, docs, empty


def grams(text):
    s, out = " ", Counter()
    for c in (text or "").lower():
        s += c if c.isalpha() else ("" if s[-1] == " " else " ")
    s = s if s[-1] == " " else s + " "
    if s == " ":
        return out
    out.update(c for c in s if c != " ")
    out.update(s[i : i + 2] for i in range(len(s) - 1))
    out.update(s[i : i + 3] for i in range(len(s) - 2) if s[i + 1] != " ")
    return out


def ranked(counts, top):
    # Blanks sort first, then by code point; shorter ones first.
    code = lambda g: (len(g), [0 if c == " " else ord(c) for c in g])
    return {g: i for i, g in enumerate(sorted(counts, key=lambda g: (-counts[g], code(g)))[:top])}


def brute(rows, top):
    total = defaultdict(Counter)
    for d, text, lang, *_ in rows:
        if text is not None and lang is not None and (d is None or zlib.crc32(str(d).encode()) % 4 != 2):
            total[lang] += grams(text)
    profiles = {lang: ranked(c, top) for lang, c in total.items()}
    out = []
    for d, text, *_ in rows:
        own = ranked(grams(text), top)
        if not own or not profiles:
            out.append((d, "und", 0.0))
            continue
        away = {lang: sum(abs(i - p[g]) if g in p else top for g, i in own.items()) for lang, p in profiles.items()}
        best = min(sorted(away), key=away.get)
        out.append((d, best, round(1 - away[best] / (top * len(own)), 9)))
    return sorted(out, key=repr)


def run(df, top):
    profiles = lang_id.train_profiles(df.where(lang_id.is_training_row()), top)
    rows = lang_id.identify(df, profiles, top).collect()
    return sorted(((r.doc_id, r.lang_pred, round(r.score, 9)) for r in rows), key=repr)


def test_awkward_rows_match_brute_force(spark):
    for top in (25, lang_id.TOP):
        assert run(docs(spark), top) == brute(awkward(), top)


def test_held_out_accuracy(spark):
    langs = {r.doc_id: r.lang for r in table(spark, SF001, "documents").select("doc_id", "lang").collect()}
    rows = [r for r in op7_language_id(spark, SF001).collect() if r.held_out]
    assert len(rows) > 150
    assert sum(r.lang_pred == langs[r.doc_id] for r in rows) / len(rows) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_empty_tables(spark):
    assert run(empty(spark), 50) == []
    profiles = lang_id.train_profiles(empty(spark))
    assert {r.lang_pred for r in lang_id.identify(docs(spark), profiles).collect()} == {"und"}

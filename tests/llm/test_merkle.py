import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

import llm_rows
from barlab.llm import merkle


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text=None):
    cells = [row[0], row[3], row[2], row[4], row[1] if text is None else text]
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in cells])


def climb(nodes):
    """Levels of a tree, from its leaves to its root."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([H(*levels[-1][i : i + 8]) for i in range(0, len(levels[-1]), 8)])
    return levels


def proof(levels, at):
    out = []
    for level in levels[:-1]:
        run = at - at % 8
        out.append((at % 8, level[run:at] + level[at + 1 : run + 8]))
        at //= 8
    return out


def brute(rows):
    """doc_id, leaf -> subroot, root, proof hash, folded root of a tampered copy."""
    trees = {}
    for r in rows:
        trees.setdefault(r[2], []).append(r)
    order = sorted(trees, key=lambda lang: (lang is not None, (lang or "").encode()))
    levels = {}
    for lang in order:
        trees[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        levels[lang] = climb([leaf(r) for r in trees[lang]])
    forest = climb([levels[lang][-1][0] for lang in order])
    out = []
    for place, lang in enumerate(order):
        for at, r in enumerate(trees[lang]):
            path = proof(levels[lang], at) + proof(forest, place)
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
            lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r[1]) if r[1] is not None else None
            now = leaf(r, lower) if tampered else leaf(r)
            for i, others in path:
                now = H(*others[:i], now, *others[i:])
            out.append((r[0], leaf(r), levels[lang][-1][0], forest[-1][0], H(*[x for _, o in path for x in o]), now))
    return out


def digests(manifest):
    rows = manifest.proofs()
    return rows.select("doc_id", "leaf", "subroot", "root", merkle.proof_hash(), merkle.fold(F.coalesce("tampered", "leaf")))


def tampered():
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, merkle.leaf_hash(text=lower))


def key(row):
    return tuple("" if v is None else str(v) for v in row)


def check(spark, rows):
    got = [tuple(r) for r in digests(merkle.build(llm_rows.docs(spark, rows), keep={"tampered": tampered()})).collect()]
    assert sorted(got, key=key) == sorted(brute(rows), key=key)


def test_awkward_rows(spark):
    check(spark, llm_rows.awkward())


@pytest.mark.parametrize("n", [8, 9, 512, 1300])
def test_tree_sizes(spark, n):
    # One large language and a few small ones, ids out of order and beyond one another in text.
    rows = [(i * 7919 % 100_003, f"Text {i}", "en", None if i % 5 == 0 else "s", i) for i in range(n)]
    check(spark, rows + [(1, "A", None, "s", 1), (2, "B", "", "s", 2), (3, "C", "é", "s", 3)])


def test_many_languages_make_a_forest_of_several_levels(spark):
    check(spark, [(i, f"T{i}", f"l{i % 600}", "s", i) for i in range(700)])


def test_one_row_and_no_row(spark):
    rows = [(5, "Only", "en", "s", 4)]
    check(spark, rows)
    got = merkle.build(llm_rows.docs(spark, rows)).proofs().first()
    assert got.leaf == got.subroot == got.root and got.siblings == []
    empty = merkle.build(llm_rows.empty(spark))
    assert empty.root() is None and empty.proofs().collect() == []


def test_manifest_is_reopened_and_finds_damage(spark, tmp_path):
    rows = [(i, f"Text {i}", "en", "s", i) for i in range(600)]
    folder = f"file://{tmp_path}/manifest"
    made = merkle.build(llm_rows.docs(spark, rows), folder=folder)
    again = merkle.open_manifest(spark, folder)
    assert again.root() == made.root()
    assert sorted(map(str, again.proofs().collect())) == sorted(map(str, made.proofs().collect()))
    # A stored leaf that was changed does not lead to the stored level above it.
    bad = again.languages.levels[0].withColumn("node", F.when(F.col("pos") == 3, F.lit("0" * 64)).otherwise(F.col("node")))
    again.languages.levels[0] = bad
    with pytest.raises(Exception, match="does not follow"):
        again.proofs().collect()


def test_only_every_third_level_is_stored(spark):
    made = merkle.build(llm_rows.docs(spark, [(i, str(i), "en", "s", i) for i in range(600)]))
    assert [level.count() for level in made.languages.levels] == [600, 2, 1]

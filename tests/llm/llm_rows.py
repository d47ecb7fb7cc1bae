"""Small document tables with every awkward case, for all operators."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators make or use themselves; whatever a table has there must do no harm.
CLASHES = ["score", "kept", "digest", "lang_pred", "n", "key", "batch", "pos", "h", "ids", "decoded", "n_tokens", "label", "size", "mark", "n_lines", "licenses", "n_words", "row", "tree", "node", "weight", "features", "rank", "total", "_doc", "_drop", "_lines", "_from", "_to", "_key", "_digest", "_leak", "_line", "_flow", "_seq", "_tie", "_part", "_nth", "_good", "_i", "_m"]


def prose(rnd: random.Random, n: int, lang: str = "en") -> str:
    parts = {"en": "the ing tion re and er th ou".split(), "de": "sch ung der ein und lich keit ge".split(), "fr": "eau que oi les ment ai é è".split()}[lang]
    words = ["".join(rnd.choice(parts) for _ in range(rnd.randint(1, 4))) for _ in range(n)]
    return " ".join(words)


def awkward(seed: int = 7) -> list[tuple]:
    rnd = random.Random(seed)
    base = prose(rnd, 120)
    rows = [
        (1, None, None, None, None),
        (2, "", "en", "s", 0),
        (3, "   \n\t \n", "en", "s", 5),
        (4, "one two", "en", "s", 7),
        (5, base, "en", "s", len(base)),
        (6, base, "en", "s", len(base)),
        (6, base, "en", "s", len(base)),
        (6, "another text under an id that is used already\n" + base, "en", "s", 1),
        (7, base.replace("the", "tea", 1), None, "s", len(base)),
        (None, base, "en", "s", len(base)),
        (8, "12345 67890 !!! ???", "en", "s", 20),
        (9, prose(rnd, 30_000, "de"), "de", "s", 1),
        (10, "Ünï cödé 中文 文字 😀    x\x00y\r\nlast line", "fr", "s", 9),
        (11, "a" * 5000, "en", "s", 5000),
        (12, "ab " * 3000, "en", "s", 9000),
    ]
    for i in range(13, 40):
        lang = ("en", "de", "fr")[i % 3]
        text = "\n".join(prose(rnd, rnd.randint(3, 40), lang) for _ in range(rnd.randint(1, 6)))
        rows.append((i, text, lang, f"s{i % 2}", len(text)))
    return rows


def docs(spark, rows=None, clashes: bool = True):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(awkward() if rows is None else rows, SCHEMA)
    return df.withColumns({c: F.lit(1) for c in CLASHES}) if clashes else df


def empty(spark):
    return docs(spark, [])

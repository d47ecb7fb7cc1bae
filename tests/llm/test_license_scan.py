import textwrap

from barlab.llm import license_scan
from barlab.llm.queries import QUERIES
from conftest import SF0001, SF001
from llm_rows import awkward, docs, empty
from oracle_compare import compare, duck
import pytest

MIT = " ".join(license_scan.SENTENCES[k] for k in ("mit-grant", "mit-notice", "mit-warranty", "mit-liability"))
APACHE = " ".join(license_scan.SENTENCES[k] for k in ("apache-header", "apache-comply", "apache-unless", "apache-see"))


@pytest.mark.parametrize("sf", [SF0001, SF001])
def test_matches_sql(spark, sf):
    name = "op10_license_scan"
    assert compare(spark, duck(sf), name, QUERIES[name], license_scan.ORACLE_SQL, sf) == []


def scan(spark, texts):
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(texts)]
    return {r.doc_id: (r.n_known, list(r.licenses)) for r in license_scan.scan_licenses(docs(spark, rows)).collect()}


def test_notices_wrapped_texts_and_order(spark):
    s = license_scan.SENTENCES
    got = scan(
        spark,
        [
            "Some prose without an end\nReleased under the MIT License.\nmore",
            textwrap.fill(MIT, 60),
            "Copyright 2020 Someone\n" + textwrap.fill(APACHE, 72),
            s["mit-liability"] + " " + s["mit-warranty"] + " " + s["mit-notice"],  # wrong order
            s["bsd-redistribution"] + " " + s["bsd-source"] + " and so on. " + s["bsd-binary"] + " " + s["bsd-endorse"],
            "released under the MIT license!  Licensed under CC BY-NC 4.0. Released under the MIT License.",
            "not Released under the MIT License.",
        ],
    )
    assert got[0] == (1, ["MIT"]) and got[1][1] == ["MIT"] and got[2][1] == ["Apache-2.0"]
    assert got[3] == (3, []) and got[4][1] == ["BSD-2-Clause", "BSD-3-Clause"]
    assert got[5] == (3, ["CC-BY-NC-4.0", "MIT"]) and got[6] == (0, [])


def test_every_single_sentence_rule_finds_its_sentence(spark):
    rules = [(name, ids[0]) for name, ids in license_scan.RULES if len(ids) == 1 and ids[0] in license_scan.SENTENCES and ids[0] != "mpl-subject"]
    got = scan(spark, [license_scan.SENTENCES[i] for _, i in rules])
    for k, (name, _) in enumerate(rules):
        assert name in got[k][1], rules[k]


def test_awkward_rows(spark):
    got = license_scan.scan_licenses(docs(spark)).collect()
    assert len(got) == len(awkward()) and all(r.n_known == 0 and r.licenses == [] and r.kept == 1 for r in got)
    assert license_scan.scan_licenses(empty(spark)).count() == 0


def test_no_python_and_no_shuffle(spark):
    from barlab.plans.inspect import physical_plan

    plan = physical_plan(license_scan.scan_licenses(docs(spark)))
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan and "Exchange" not in plan


def test_every_rule_finds_its_sentences(spark):
    said = {i: k for k, i in license_scan.KNOWN.items()} | license_scan.SENTENCES
    got = scan(spark, ["\n".join(said[i] for i in ids) for _, ids in license_scan.RULES])
    for k, (name, ids) in enumerate(license_scan.RULES):
        assert name in got[k][1], (name, ids)


def test_standard_notices_of_the_gpl_family_and_mpl(spark):
    grant = "you can redistribute it and/or modify it under the terms of the GNU {} as published by the Free Software Foundation{} either version {} of the License, or (at your option) any later version."
    free = "Copyright (C) 2020 Someone\n\nThis program is free software"
    hope = " This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."
    mpl = "This Source Code Form is subject to the terms of the Mozilla Public License, v{}2.0."
    texts = [
        free + ": " + grant.format("Affero General Public License", ",", 3),
        free + ": " + grant.format("Lesser General Public License", ",", 3) + hope,
        free + ": " + grant.format("General Public License", ",", 3),
        free + "; " + grant.format("General Public License", ";", 2) + hope,
        mpl.format(". "),
        mpl.format(" ") + " And more.",
    ]
    want = [["AGPL-3.0"], ["LGPL-3.0"], ["GPL-3.0"], ["GPL-2.0"], ["MPL-2.0"], ["MPL-2.0"]]
    got = scan(spark, texts + [textwrap.fill(t, 50) for t in texts])
    assert [got[k][1] for k in range(12)] == want * 2


def test_sentences_alike_are_refused():
    with pytest.raises(ValueError, match="a and b"):
        license_scan._known({"a": "This is free software:", "b": "this is free software;"})


ISC = """ISC License

Copyright (c) 2021, A. Person
Copyright (c) 2022 Others

Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.
"""
HEADER = """/*
 * Copyright 2020 Someone
 *
 * Licensed under the Apache License, Version 2.0 (the "License"); you may
 * not use this file except in compliance with the License. You may obtain a
 * copy of the License at
 *
 *     http://www.apache.org/licenses/LICENSE-2.0
 */
"""


def test_real_notices(spark):
    """Texts and licences written down without the module's tables."""
    cases = [
        (ISC, ["ISC"]),
        (ISC.replace("and/or", "and"), ["ISC"]),
        (HEADER, ["Apache-2.0"]),
        ("// SPDX-License-Identifier: MIT\nint main;", ["MIT"]),
        ("/* SPDX-License-Identifier: GPL-2.0-or-later */", ["GPL-2.0"]),
        ("# SPDX-License-Identifier: MIT OR Apache-2.0", ["Apache-2.0", "MIT"]),
        ("Licensed under the MIT License (see LICENSE).", ["MIT"]),
        ("This software is released under the MIT License.", ["MIT"]),
        ("My tool\n\nThis project is licensed under the MIT License - see the [LICENSE](LICENSE) file for details", []),
        ("This package is distributed under the BSD 3-Clause License; see LICENSE for details.", ["BSD-3-Clause"]),
        ("This package is distributed under the BSD 3-Clause License, see LICENSE for details.", ["BSD-3-Clause"]),
        ("We met at MIT. The licence is not known.", []),
        ("MIT", []),
        ("SPDX-License-Identifier: no such one\nMIT is a school.", []),
        ("The copyright of 2020 is not a notice\nreleased under the MIT License", ["MIT"]),
    ]
    got = scan(spark, [t for t, _ in cases])
    for k, (text, want) in enumerate(cases):
        assert got[k][1] == want, text


def test_columns_of_any_name_stay(spark):
    from pyspark.sql import functions as F

    names = ["line", "FLOW", "lower", "seq"]
    rows = docs(spark, [(1, "Released under the MIT License.", "en", "s", 1)]).select("*", *[F.lit(n).alias(n) for n in names])
    got = license_scan.scan_licenses(rows).first()
    assert [got[n] for n in names] == names and got.licenses == ["MIT"]
    assert got["_line"] == got["_flow"] == got["_seq"] == 1


def test_very_many_blank_and_copyright_lines(spark):
    got = scan(spark, ["\n" * 200_000 + "Released under the MIT License.", "copyright x\n" * 50_000 + textwrap.fill(MIT, 60)])
    assert got[0][1] == ["MIT"] and got[1][1] == ["MIT"]

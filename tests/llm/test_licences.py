import re
import textwrap

from swayline.llm import licences
from tests.llm.common import AWKWARD, documents


def test_canonical_forms_meet(spark):
    mit = licences.KNOWN["MIT"]
    variants = [mit, mit.upper(), mit.replace("\n", "  \r\n"), "Copyright (c) 2020 Somebody\n\n" + mit, mit.replace("sublicense", "sub-licence"),
                "* (C) Me, All rights reserved.\n" + mit.replace(",", "")]
    others = [mit + " and more", mit[:-20], "Copyright 2020 only", "MIT"]
    texts = [(100 + i, t) for i, t in enumerate(variants)] + [(200 + i, t) for i, t in enumerate(others)] + AWKWARD
    got = [(r["doc_id"], r["licence_id"]) for r in licences.scan(documents(spark, texts), licences.known_licences(spark)).collect()]
    assert len(got) == len(texts)
    named = {i: n for i, n in got if i is not None}
    assert all(named[100 + i] == "MIT" for i in range(len(variants)))
    assert all(n is None for i, n in got if i is None or i < 100 or i >= 200)


def test_plan_is_native(spark):
    df = licences.scan(documents(spark, AWKWARD), licences.known_licences(spark))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_own_table_and_empty(spark):
    known = spark.createDataFrame([("b", "Same  text"), ("a", "same TEXT!"), ("c", None), ("d", "")], "licence_id string, text string")
    got = {r["doc_id"]: r["licence_id"] for r in licences.scan(documents(spark, [(1, "same text"), (2, ""), (3, None)]), known).collect()}
    assert got == {1: "a", 2: None, 3: None}
    assert licences.scan(documents(spark, []), known).count() == 0


def test_published_texts_are_known(spark):
    """Whole files of the common licences, as they are published: with a title, a copyright line, other line ends."""
    ids = ["0BSD", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSL-1.0", "CC0-1.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "Unlicense"]
    texts = [(i, licences.KNOWN[n].replace("\n", "\r\n").upper()) for i, n in enumerate(ids)]
    texts += [(100, f"MIT License\n\nCopyright (c) 2020 Somebody\n\n{licences.KNOWN['MIT']}"),
              (101, f"BSD 3-Clause License\n\nCopyright (c) 2020, Somebody\nAll rights reserved.\n\n{licences.KNOWN['BSD-3-Clause']}"),
              (102, licences.KNOWN["Apache-2.0"].split("APPENDIX:")[0]), (103, "See below. " + licences.KNOWN["Unlicense"])]
    got = {r["doc_id"]: r["licence_id"] for r in licences.scan(documents(spark, texts), licences.known_licences(spark)).collect()}
    assert [got[i] for i in range(len(ids))] == ids
    assert got[100].startswith("MIT, titled") and got[101].startswith("BSD-3-Clause, titled")
    assert got[102].startswith("Apache-2.0") and got[103] is None


WHOLE = [n for n in licences.KNOWN if not n.startswith("notice: ") and ", " not in n]
NOTICE = re.compile(licences.NOTICE_LINE.removeprefix("(?md)"), re.M)


def wrapped(text, width):
    """Every paragraph filled to ``width`` anew; those with a notice stay as they are."""
    return "\n\n".join(p if NOTICE.search(p.lower()) else textwrap.fill(" ".join(p.split()), width, break_long_words=False, break_on_hyphens=False)
                       for p in re.split(r"\n[ \t]*\n", text))


def test_other_line_breaks_are_the_same_licence(spark):
    texts = [(w * 1000 + i, wrapped(licences.KNOWN[n], w)) for i, n in enumerate(WHOLE) for w in range(60, 101, 4)]
    got = {r["doc_id"]: r["licence_id"] for r in licences.scan(documents(spark, texts), licences.known_licences(spark)).collect()}
    forms = {r["doc_id"]: r["licence_id"] for r in licences.scan(documents(spark, [(i, licences.KNOWN[n]) for i, n in enumerate(WHOLE)]),
                                                                 licences.known_licences(spark)).collect()}
    assert all(forms.values()) and len(texts) > 200
    assert {k: v for k, v in got.items() if v != forms[k % 1000]} == {}


def test_a_missing_line_is_another_text(spark):
    texts, n = [], 0
    for name in ("MIT", "BSD-3-Clause", "MPL-1.1", "MPL-2.0", "GPL-3.0", "Apache-2.0", "Artistic-1.0", "LGPL-2.0"):
        lines = licences.KNOWN[name].split("\n")
        for i, line in enumerate(lines):
            if re.search("[a-z0-9]", line.lower()) and not NOTICE.match(line.lower()):
                texts.append((n, "\n".join(lines[:i] + lines[i + 1:])))
                n += 1
    known = licences.known_licences(spark).filter("licence_id not like '%terms only%'")
    got = [r["doc_id"] for r in licences.scan(documents(spark, texts, clash=False), known).collect() if r["licence_id"]]
    assert n > 1500 and got == []


def test_equivalent_words_over_line_breaks(spark):
    known = spark.createDataFrame([("x", "fifty percent of the authorization to sublicense a program at https://example.org")], "licence_id string, text string")
    texts = [(1, "Fifty per\ncent of the authorisation to sub-\nlicence a programme at http://example.org"), (2, "fifty per ten of the authorization")]
    got = {r["doc_id"]: r["licence_id"] for r in licences.scan(documents(spark, texts), known).collect()}
    assert got == {1: "x", 2: None}


def test_notices_and_lines_of_terms():
    notices = ["Copyright (c) 2020 Somebody", "  * Copyright 1999, Somebody", "(C) 2020 Me", "(c) Copyright [yyyy] [name of copyright owner]", "© 2021 x",
               "Copyright <year> <holder>", "All rights reserved.", "# (c) Me, All rights reserved", "&copy; 2004"]
    terms = ["(c) You must retain, in the Source form", '"Copyright" also means copyright-like laws', "copyright holder, and you cure", "Copyright Holder",
             "All rights reserved to the holder", "(c) under Patent Claims infringed"]
    assert all(NOTICE.match(x.lower()) for x in notices) and not any(NOTICE.match(x.lower()) for x in terms)

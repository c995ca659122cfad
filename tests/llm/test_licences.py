import re._parser as grammar
from itertools import product

import pytest
from check_oracles import compare, duckdb_on

from tellerlake.llm import licences

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software,
and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

CASES = [
    ("Copyright (c) 2020 Someone.\nAll rights reserved.", "Copyright,AllRights", "all-rights-reserved"),
    (MIT, "MitGrant,MitNotice,MitAsIs,MitLiability", "MIT"),
    ("Foo bar.\nLicensed under the Apache License, Version 2.0.\nBaz.", "NamedApache2", "Apache-2.0"),
    ("Released under the MIT License.", "NamedMit", "MIT"),
    ("no full stop before\nLicensed under CC BY-NC 4.0.", "NamedCcByNc4", "CC-BY-NC-4.0"),
    ("This work is licensed under the GNU General Public License, version 3.", "NamedGpl3", "GPL-3.0"),
    ("Released under CC BY 4.0.", "NamedCcBy4", "CC-BY-4.0"),
    ("This work is released under the BSD 3-Clause.", "NamedBsd3", "BSD-3-Clause"),
    ("Distributed under Creative Commons BY-SA 4.0.", "NamedCcBySa4", "CC-BY-SA-4.0"),
    ("Foo. All rights\n  reserved.", "AllRights", "all-rights-reserved"),
    ("Copyright (c) 2020 Someone\nReleased under the MIT License\n", "Copyright,NamedMit", "MIT"),
    (MIT + "\n" + "Released under the MIT License\nAll rights reserved\n" * 3,
     "MitGrant,MitNotice,MitAsIs,MitLiability" + ",NamedMit,AllRights" * 3, "MIT,all-rights-reserved"),
    ("# SPDX-License-Identifier: MIT\ncode", None, None),
    ("All rights reserved. Released under the MIT License. All rights reserved.", "AllRights,NamedMit,AllRights", "MIT,all-rights-reserved"),
    ("A licence to print money.", "", ""),
    ("clean", "", ""),
    ("", "", ""),
    (None, "", ""),
]


def test_cases(docs):
    rows = [(i, t) for i, (t, _, _) in enumerate(CASES)] + [(None, CASES[3][0]), (3, CASES[3][0]), (99, "word " * 50000 + ".\n" + MIT)]
    found = licences.scan(docs(rows)).collect()
    assert len(found) == len(rows)
    got = {r.doc_id: (r.sentences, r.licences) for r in found}
    for i, (_, sentences, names) in enumerate(CASES):
        if sentences is not None:
            assert got[i] == (sentences, names), i
    assert got[None] == got[3] and got[99][1] == "MIT"
    assert licences.scan(docs([])).collect() == []


def strings(pattern):
    """What a pattern matches: every choice in it, repeats at their fewest and, if that is none, once (``.*`` only once)."""

    def of(items):
        return ["".join(parts) for parts in product(*(one(*item) for item in items))]

    def one(kind, arg):
        match str(kind):
            case "LITERAL":
                return [chr(arg)]
            case "ANY":
                return ["x"]
            case "AT":
                return [""]
            case "IN":
                return [chr(arg[0][1][0])] if str(arg[0][0]) == "RANGE" else [chr(v) for _, v in arg]
            case "SUBPATTERN":
                return of(arg[3])
            case "BRANCH":
                return [s for branch in arg[1] for s in of(branch)]
            case "MAX_REPEAT":
                low, _, inner = arg
                return [*([""] if low == 0 and of(inner) != ["x"] else []), *(s * max(low, 1) for s in of(inner))]

    return of(grammar.parse(pattern))


def test_every_choice_of_every_pattern_is_found(docs):
    known = dict(licences.PATTERNS)
    texts = {text: None for pattern in known for text in strings(pattern)} | dict.fromkeys(licences.SENTENCES)
    assert len(texts) > 5000
    assert [t for t in texts if not any(k in t for k in licences.KEYWORDS)] == []
    assert not any(" " in k for k in licences.KEYWORDS)
    texts = list(texts)
    rows = [(i, "Foo bar.\n" + t.replace(" ", "\n") + ".\n\nBaz.") for i, t in enumerate(texts)]
    assert [texts[r.doc_id] for r in licences.scan(docs(rows)).where("sentences = ''").collect()] == []


def test_sql(spark, sf_dir):
    same, note = compare(spark, duckdb_on(sf_dir), sf_dir, "op1_licences")
    assert same, note


def test_plan_has_no_python(spark, sf_dir):
    plan = licences.op1_licences(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan

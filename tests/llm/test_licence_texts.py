"""Whole licence texts, alone and inside longer documents, however they are wrapped."""

import textwrap

import pytest

from kinrate.llm.licences import find_licences, known_digests, whole_texts


def wrapped(text, width):
    return "\n\n".join(textwrap.fill(" ".join(p.split()), width) for p in text.split("\n\n"))


def test_whole_texts_alone_and_inside_documents(spark, docs_of):
    longest = {}
    for name, text in whole_texts():
        longest[name] = max(longest.get(name, ""), text, key=len)
    assert {"Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "BSD-2-Clause", "BSD-3-Clause",
            "Unlicense"} <= set(longest)
    texts, expected = {}, {}
    for i, (name, text) in enumerate(sorted(longest.items())):
        texts[i] = text
        expected[i, name] = (0, True)
        terms = min((t for n, t in whole_texts() if n == name), key=len)
        texts[100 + i] = "A read-me.\n\n" + wrapped(terms, 55) + "\n\nSee the site."
        expected[100 + i, name] = (1, False)
    apache = longest["Apache-2.0"]
    texts |= {
        200: apache.replace("perpetual", "temporary"),
        201: "prose " + wrapped(apache, 60),  # begins within a line
        202: "This work is licensed under\nthe GNU General Public\nLicense, version 3.\nprose",
        203: "prose\nReleased under the\nMIT License.\n\nReleased under the MIT License.\n",
        204: "Released under the\nMIT License and others.",
    }
    expected |= {(202, "GPL-3.0"): (1, False), (203, "MIT"): (2, False)}
    rows = {(r.doc_id, r.licence): (r.n_lines, r.whole_text) for r in
            find_licences(docs_of(texts), known_digests(spark)).collect()}
    assert {k: v for k, v in rows.items() if k in expected} == expected
    assert set(rows) - set(expected) <= {(200, "Apache-2.0"), (201, "Apache-2.0")}
    assert find_licences(docs_of(texts), known_digests(spark).limit(0)).count() == 0


@pytest.mark.parametrize("holder", ["Someone", "Example, Inc."])
def test_bsd_with_bullets_and_holder(spark, docs_of, holder):
    text = dict(whole_texts())["BSD-3-Clause"]
    assert not text.lstrip().startswith("1.")
    found = find_licences(docs_of({1: f"Copyright (c) 2021 {holder}\nAll rights reserved.\n\n{text}"}), known_digests(spark))
    assert [(r.licence, r.whole_text) for r in found.collect()] == [("BSD-3-Clause", True)]

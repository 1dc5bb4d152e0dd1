from __future__ import annotations

import math
import random
import textwrap
from collections import Counter

import pytest

from adtide.llm import license, license_texts
from adtide.llm.queries import op2_license


def test_statements_and_inheritance(spark):
    filler = "<p>Some prose about nothing.</p>" * 3
    rows = [
        (1, "https://h.org/a/LICENSE", "Released under the MIT License."),
        (2, "https://h.org/a/x/file.py?v=1", filler),
        (3, "https://h.org/a/x/COPYING.txt", f"{filler}\nLicensed under the Apache License, Version 2.0."),
        (4, "https://h.org/a/x/y/z.html#top", None),
        (5, "https://h.org/b/file", filler),
        (6, "https://h.org/b/own", f"<div>{filler}</div><p>Licensed under CC BY-NC 4.0.</p>"),
        (7, "https://other.org/a/file", ""),
        (8, "https://other.org/c/", "<b>This work is licensed under the GNU General Public License, version 3.</b>"),
        (9, "https://other.org/c/d/e", filler),
        (10, None, filler), (11, "", "Licensed under CC BY 4.0."), (None, "https://h.org/a/n", filler), (2, "https://h.org/a/x/file.py?v=1", filler),
    ]
    table = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' AS own", "1 AS row", "2 AS dir")
    got = license.scan(table, "page_id", "url", "html").collect()
    assert len(got) == len(rows)
    found = {(r.id, r.license, r.origin, r.declared_by) for r in got}
    assert found == {
        (1, "MIT", "own", 1), (2, "Apache-2.0", "inherited", 3), (3, "Apache-2.0", "own", 3), (4, "Apache-2.0", "inherited", 3),
        (5, None, None, None), (6, "CC-BY-NC-4.0", "own", 6), (7, None, None, None), (8, "GPL-3.0", "own", 8), (9, "GPL-3.0", "inherited", 8),
        (10, None, None, None), (11, "CC-BY-4.0", "own", 11), (None, "MIT", "inherited", 1),
    }
    assert license.scan(table.limit(0), "page_id", "url", "html").count() == 0


def test_templates_are_their_own_best_match():
    idf = dict.fromkeys(license.VOCABULARY, 1.0)
    for name, text in license.TEMPLATES.items():
        assert license.best_template(f"Before it.\n{text}\nAfter.", idf, 1.0)[0] == name
    assert license.best_template("Nothing of that sort here, only words.", idf, 1.0)[1] < license.THRESHOLD


def found(text: str) -> str | None:
    name, score = license.best_template(text, dict.fromkeys(license.VOCABULARY, 4.0), 9.0)
    return name if score >= license.THRESHOLD else None


def wrapped(text: str, width: int = 60, mark: str = "") -> str:
    return "\n".join(mark + line for line in textwrap.wrap(text, width))


def test_wrapped_texts_headers_and_tags():
    for name, text in license_texts.PASSAGES:
        assert found(f"Copyright (c) 2019 Jane Roe\n\n{wrapped(text)}\n") == name, text
        assert found(f"#!/bin/sh\n{wrapped(text, 48, ' * ')}\n\nint main(void);\nreturn zero;") == name, text
    for tag, name in {"Apache-2.0": "Apache-2.0", "GPL-2.0-or-later": "GPL-2.0", "EPL-2.0": "EPL-2.0", "MIT OR Apache-2.0": "MIT OR Apache-2.0", "mit": "MIT"}.items():
        assert found(f"// SPDX-License-Identifier: {tag}\nint x;") == name
    assert found("This small library of mine, written in spring, is released under the MIT license, so use it as you like and tell others") == "MIT"
    assert found("The whole of this code is licensed under the GPLv3 as are its many tests and other files") == "GPL-3.0"


def test_neighbours_are_kept_apart():
    assert found("Licensed under the GNU Affero General Public License, version 3.") == "AGPL-3.0"
    assert found("Licensed under the GNU Lesser General Public License, version 2.1.") == "LGPL-2.1"
    assert found("Licensed under CC BY-ND 4.0.") == "CC-BY-ND-4.0" and found("Licensed under CC BY-NC-SA 4.0.") == "CC-BY-NC-SA-4.0"
    assert found("Licensed under the BSD 2-Clause License.") == "BSD-2-Clause"
    for other in ("Licensed under the Eclipse Public License, version 2.0.", "Licensed under the GNU General Public License, version 1.", "Licensed under CC BY 3.0.", "Released under the XYZ License."):
        assert found(other) is None, other


def test_licence_file_with_a_whole_text_is_inherited(spark):
    body = wrapped(dict(license_texts.PASSAGES[::-1])["MIT"])
    rows = [(1, "https://h.org/a/LICENSE", f"Copyright 2020 J. Roe\n\n{body}"), (2, "https://h.org/a/b/c", "Some prose.")]
    got = license.scan(spark.createDataFrame(rows, "page_id long, url string, html string"), "page_id", "url", "html").collect()
    assert {(r.id, r.license, r.origin) for r in got} == {(1, "MIT", "own"), (2, "MIT", "inherited")}


def test_query_scans_documents_too(spark, tmp_path):
    spark.createDataFrame([(1, "https://h.org/a", "Nothing.")], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    spark.createDataFrame([(1, "Prose.\nReleased under the MIT License."), (2, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {(r.table, r.page_id, r.doc_id, r.license, r.declared_by) for r in op2_license(spark, str(tmp_path)).collect()}
    assert got == {("pages", 1, None, None, None), ("documents", None, 1, "MIT", 1), ("documents", None, 2, None, None)}


def test_only_known_identifiers_are_stated_by_tags():
    for text, name in {
        "SPDX-License-Identifier: see LICENSE file": None,
        "SPDX-License-Identifier: names a licence. Released under the MIT License.": None,
        "SPDX-License-Identifier: NONE": None,
        "SPDX-License-Identifier: GPL-2.0-or-later WITH Classpath-exception-2.0": "GPL-2.0-or-later WITH Classpath-exception-2.0",
        "SPDX-License-Identifier: GPL-2.0 WITH pleasure": None,
        "SPDX-License-Identifier: (mit OR Apache-2.0) AND isc": "(mit OR Apache-2.0) AND isc",
        "SPDX-License-Identifier: MIT OR whatever": None,
        "SPDX-License-Identifier: LicenseRef-Own.1": "LicenseRef-Own.1",
        "SPDX-License-Identifier: lgpl-2.1+": "LGPL-2.1",
        "SPDX-License-Identifier: see below\n# SPDX-License-Identifier: zlib": "Zlib",
        "no tag": None,
    }.items():
        assert license.spdx(text) == name, text


def test_a_sentence_about_tags_does_not_hide_a_statement():
    idf = dict.fromkeys(license.VOCABULARY, 2.0)
    assert license.best_template("SPDX-License-Identifier: names a licence.\nReleased under the MIT License.", idf, 3.0)[0] == "MIT"


def test_frequencies_and_cosines_equal_brute_force(spark):
    rng = random.Random(6)
    statements = [*license.TEMPLATES.values(), *(t for _, t in license_texts.PASSAGES)]
    texts = [None, "", "No licence is named here. Only words."]
    for _ in range(50):
        words = rng.choice(statements).split(" ")
        for _ in range(rng.randint(0, max(1, len(words) // 6))):
            words[rng.randrange(len(words))] = rng.choice(["that", "copy", "some", words[0]])
        texts.append(f"Some prose in front.\n{' '.join(words)}\n<p>And {rng.choice(statements)[: rng.randint(0, 60)]} after it</p>")
    table = spark.createDataFrame([(i, f"https://h.org/{i}", t) for i, t in enumerate(texts)], "page_id long, url string, html string")
    seen: Counter = Counter()
    for text in texts:
        for line in license.lines(text or ""):
            seen[""] += 1
            seen.update(set(license.tokens(line)) & set(license.VOCABULARY))
    assert license._frequencies(table.selectExpr("html AS text")) == dict(seen)
    idf = {w: math.log((1 + seen[""]) / (1 + seen[w])) + 1 for w in license.VOCABULARY}
    rare = math.log((1 + seen[""]) / 2) + 1

    def cosine(template, words: list[str]) -> float:
        own = Counter(words)
        if not words or not template.allows(own):
            return 0.0
        weights = [{w: n * idf.get(w, rare) for w, n in c.items()} for c in (template.words, own)]
        dot = sum(x * weights[1].get(w, 0) for w, x in weights[0].items())
        return dot / math.prod(math.sqrt(sum(x * x for x in side.values())) for side in weights)

    got = {r.id: r for r in license.scan(table, "page_id", "url", "html").collect()}
    stated = 0
    for at, text in enumerate(texts):
        words = license.tokens(license._TAG.sub("\n", text or ""))
        by_name: dict[str, float] = {}
        for template in license._TEMPLATES:
            size = min(template.length, len(words))
            parts = [words[i : i + size] for i in range(len(words) - size + 1)] if template.runs else []
            parts += [license.tokens(line) for line in license.lines(text or "")] if template.single else []
            by_name[template.name] = max([by_name.get(template.name, 0.0), *(cosine(template, part) for part in parts)])
        best = max(by_name.values())
        if best < license.THRESHOLD:
            assert got[at].license is None and got[at].score is None
        else:
            stated += 1
            assert got[at].score == pytest.approx(best, abs=1e-6) and by_name[got[at].license] == pytest.approx(best, abs=1e-6)
    assert 30 <= stated < len(texts)

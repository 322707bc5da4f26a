"""Versions and variants of licenses are told apart."""

from __future__ import annotations

import pytest

from termloom.llm import licenses

LINES = {
    "This work is licensed under the GNU General Public License, version 2.": "GPL-2.0",
    "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
    "This work is licensed under the GNU Lesser General Public License, version 2.1.": "LGPL-2.1",
    "Licensed under CC BY 4.0.": "CC-BY-4.0",
    "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
    "Licensed under CC BY-NC-SA 4.0.": "CC-BY-NC-SA-4.0",
    "Licensed under CC BY-NC 3.0.": "CC-BY-NC-3.0",
    "Released under the MIT License.": "MIT",
    "Released under the Foo License.": None,
    "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
    "Licensed under the Apache License, Version 7.0.": None,
    "SPDX-License-Identifier: MPL-2.0": "MPL-2.0 identifier",
    "SPDX-License-Identifier: GPL-3.0-or-later": "GPL-3.0-or-later identifier",
    "SPDX-License-Identifier: LicenseRef-2.0": None,
    **{licenses.TEMPLATES[n]: n for n in licenses.TEMPLATES if n.endswith((" notice", " text", " conditions", " permission"))},
}


def test_versions_and_variants(spark):
    texts = list(LINES)
    rows = [(k, f"before it {t} after it") for k, t in enumerate(texts)]
    found = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    wrong = {texts[k][:80]: r.license for k, r in found.items() if r.license != LINES[texts[k]]}
    assert not wrong


def test_repeated_words_without_anchors(spark):
    docs = spark.createDataFrame([(1, "b a b a")], "doc_id bigint, text string")
    assert licenses.scan(docs, {"x": "a b a b"}).first().license is None


@pytest.mark.parametrize("name", sorted(n for n in licenses.TEMPLATES if n.startswith(("CC-", "GPL", "LGPL", "AGPL"))))
def test_template_is_itself(name, spark):
    docs = spark.createDataFrame([(1, licenses.TEMPLATES[name])], "doc_id bigint, text string")
    row = licenses.scan(docs).first()
    assert (row.license, row.coverage) == (name, 1.0)

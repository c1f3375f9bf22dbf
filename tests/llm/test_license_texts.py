"""Full texts and standard headers of licences."""

import pytest

from dealscope.llm import license_scan
from dealscope.llm.license_texts import NOTICES, full_texts

HEADER = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details."""


@pytest.mark.parametrize("place", ["alone", "inside"])
def test_texts_and_headers(spark, place):
    fill = " ".join(f"word{i}" for i in range(3000 if place == "inside" else 0))
    known = {**full_texts(), **NOTICES}
    rows = [(i, f"{fill} {known[name]} {fill}") for i, name in enumerate(sorted(known))]
    rows.append((1000, f"{fill}\n{HEADER}\n{fill}"))
    found = license_scan.license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    got = {(r.doc_id, r.license) for r in found}
    assert {(i, name) for i, name in enumerate(sorted(known))} <= got
    assert {name for i, name in got if i == 1000} == {"GPL-3.0-or-later-notice"}

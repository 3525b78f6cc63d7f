"""Licences whose texts differ by a word or a clause are told apart."""

import pytest

from trueledger.llm import licences

PROGRAM = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU%s General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
BSD = "Copyright 2020 Jo. %s: 1. %s %s " + licences._BSD_DISCLAIMER.replace("COPYRIGHT HOLDERS", "REGENTS")


def names(text):
    return {m[0] for m in licences.Scanner()(f"some words before {text} and some after")}


@pytest.mark.parametrize("word, want", [("", "GPL-3.0"), (" Lesser", "LGPL-3.0"), (" Affero", "AGPL-3.0")])
def test_gnu_notices(word, want):
    assert names(PROGRAM % word) == {want}
    assert names(f"This work is licensed under the GNU{word} General Public License, version 3.") == {want}


def test_bsd_bodies():
    clauses = licences._BSD_CLAUSES.replace(". Redis", ". 2. Redis")
    assert names(BSD % (licences._BSD, clauses, "")) == {"BSD-2-Clause"}
    three = names(BSD % (licences._BSD, clauses, "3. " + licences._BSD_NAMES))
    assert "BSD-3-Clause" in three and "BSD-2-Clause" not in three
    assert names(licences._BSD) == {"BSD-2-Clause OR BSD-3-Clause"}


def test_every_template_is_found_by_its_name():
    for name, texts in licences.TEMPLATES.items():
        for text in texts:
            assert names(text) == {name}

"""Licence texts without titles, in licence files and in headers, edited and in other forms."""

import random
from pathlib import Path

import pytest

from tamis.llm import licences as L

SYSTEM = Path("/usr/share/common-licenses")
WANT = {"Apache-2.0": "Apache-2.0", "BSD": "BSD-3-Clause", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2.1": "LGPL-2.1", "MPL-2.0": "MPL-2.0", "GPL-1": None, "LGPL-2": None, "LGPL-3": None, "GFDL-1.2": None, "GFDL-1.3": None, "CC0-1.0": None, "Artistic": None}


@pytest.mark.parametrize("name", sorted(WANT))
def test_the_system_licences(name):
    if not (SYSTEM / name).exists():
        pytest.skip("not on this system")
    text, want = (SYSTEM / name).read_text(errors="replace"), [WANT[name]] if WANT[name] else []
    assert L.licence_file_names(text) == want
    assert L.file_states("".join(f"// {x}\n" for x in text.split("\n")) + "package x\n") == want
    assert L.file_states("/*\n" + text.replace("*/", "") + "*/\nint x;\n") == want


@pytest.mark.parametrize("lic,text", [x for x in L.TEXTS if len(x[1].split()) > 20])
def test_texts_with_a_few_words_changed(lic, text):
    rng = random.Random(2)
    ws = text.split()
    for _ in range(5):
        out = list(ws)
        for at in rng.sample([i for i, w in enumerate(ws) if not w.isdigit()], int(len(ws) * 0.04)):
            out[at] = "changed"
        got = L.by_text("Copyright (c) 2020 A. Person\n\n" + " ".join(out) + "\n\nsome more words at the end")
        assert got == (True, lic)


def test_every_text_is_its_own_nearest():
    for lic, text in L.TEXTS:
        assert L.by_text(text) == (True, lic)


@pytest.mark.parametrize("text", ["This file reads licence texts; permission is hereby granted to none of them.", "Redistribution and use of the cache is described in the handbook.", "The parser knows the GNU General Public License and tells versions apart.", ""])
def test_talk_about_licences_states_none(text):
    assert L.by_text(text) == (False, None) and L.file_states(f"// {text}\npackage x\n") == []


def test_fields():
    assert L.choice("GPL-2.0 WITH Classpath-exception-2.0") == ["GPL-2.0"] and L.choice("Apache-2.0 WITH LLVM-exception") == ["Apache-2.0"]
    assert L.choice("LGPL-3.0") == L.choice("Zlib") == L.choice("GNU Lesser General Public License version 3") == []
    assert L.file_states("// Copyright 2020 X. All rights reserved.\n// Proprietary and confidential.\npackage x\n") == ["PROPRIETARY"]

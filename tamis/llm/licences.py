"""Problem 7: the licence that holds for each file and repository.

Templates are token sequences: the texts of licences (whole, or the passage that no other has), the
notices that go into files, and the names. They are indexed by length, each length a metric tree under the
token edit distance that a bit-parallel automaton computes; the triangle inequality prunes the search, and
the nearest template is accepted within a bounded difference. A text is compared where it shares
three successive words with a template, which any text within the bound does. Statements are read from the
comments at a file's start and end and from licence files; repositories are joined by name in Spark.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamis.functions.ids import norm_id, norm_url

#: Share of a name's tokens, and of a text's, that may differ from the template.
DIFFERENCE, TEXT_DIFFERENCE = 0.2, 0.1
#: Words of an anchor; a template has this share of its runs in any text within the bound.
ANCHOR = 3
#: Lines at either end of a file in which a comment counts though code stands before or after it.
HEAD_LINES, TAIL_LINES = 20, 12

#: Spellings of each licence.
NAMES = {
    "MIT": ["mit", "mit license", "expat", "mit expat", "mit expat license", "expat license", "x11 mit license"],
    "Apache-2.0": ["apache 2 0", "apache license 2 0", "apache license version 2 0", "apache software license 2 0", "apache software license version 2 0", "apache 2", "apache license 2", "apache 2 0 license", "apache license v 2 0", "apache v 2 0", "asl 2 0", "apache", "apache license"],
    "BSD-2-Clause": ["bsd 2 clause", "bsd 2 clause license", "simplified bsd license", "simplified bsd", "freebsd license", "two clause bsd license", "2 clause bsd license", "bsd two clause license"],
    "BSD-3-Clause": ["bsd 3 clause", "bsd 3 clause license", "new bsd license", "new bsd", "modified bsd license", "revised bsd license", "three clause bsd license", "3 clause bsd license", "bsd three clause license"],
    "ISC": ["isc", "isc license"],
    "MPL-2.0": ["mpl 2 0", "mpl v 2 0", "mozilla public license 2 0", "mozilla public license v 2 0", "mozilla public license version 2 0", "mpl 2", "mpl"],
    "GPL-2.0": ["gpl 2 0", "gpl 2", "gpl v 2", "gpl v 2 0", "gnu gpl v 2", "gnu gpl 2", "gnu gpl version 2", "gnu general public license version 2", "gnu general public license v 2", "gnu general public license v 2 0", "general public license version 2", "gpl version 2"],
    "GPL-3.0": ["gpl 3 0", "gpl 3", "gpl v 3", "gpl v 3 0", "gnu gpl v 3", "gnu gpl 3", "gnu gpl version 3", "gnu general public license version 3", "gnu general public license v 3", "gnu general public license v 3 0", "general public license version 3", "gpl version 3"],
    "LGPL-2.1": ["lgpl 2 1", "lgpl v 2 1", "gnu lgpl v 2 1", "gnu lgpl 2 1", "gnu lesser general public license version 2 1", "gnu lesser general public license v 2 1", "lesser general public license version 2 1", "lgpl version 2 1"],
    "AGPL-3.0": ["agpl 3 0", "agpl 3", "agpl v 3", "agpl v 3 0", "gnu agpl v 3", "gnu agpl 3", "gnu affero general public license version 3", "gnu affero general public license v 3", "affero general public license version 3", "agpl version 3"],
    "Unlicense": ["unlicense", "the unlicense", "unlicense license"],
    "0BSD": ["0 bsd", "zero clause bsd license", "zero clause bsd", "bsd zero clause license", "bsd 0 clause", "0 clause bsd license"],
    "PROPRIETARY": ["proprietary", "all rights reserved proprietary", "confidential", "proprietary license", "commercial license"],
}
_GRANT = "to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions"
_WARRANTY = "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software"
_SOURCE_BINARY = "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"
_ENDORSE = "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"
_DISCLAIMER = "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed"
_ANY_PURPOSE = "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"
_AUTHOR = "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness in no event shall the author be liable for any special direct indirect or consequential damages"
_NOTICE = "{0} is free software you can redistribute it and or modify it under the terms of the gnu {1} public license as published by the free software foundation either version {2} of the license or at your option any later version"
#: The texts and notices of licences, as words; None: a licence outside the list of results.
TEXTS: list[tuple[str | None, str]] = [
    ("MIT", f"permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software {_GRANT} the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software {_WARRANTY}"),
    ("BSD-2-Clause", f"{_SOURCE_BINARY} {_DISCLAIMER}"),
    ("BSD-3-Clause", f"{_SOURCE_BINARY} {_ENDORSE} {_DISCLAIMER}"),
    ("ISC", f"{_ANY_PURPOSE} provided that the above copyright notice and this permission notice appear in all copies {_AUTHOR}"),
    ("0BSD", f"{_ANY_PURPOSE} {_AUTHOR}"),
    ("Unlicense", "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means"),
    ("Apache-2.0", "terms and conditions for use reproduction and distribution definitions license shall mean the terms and conditions for use reproduction and distribution as defined by sections 1 through 9 of this document licensor shall mean the copyright owner or entity authorized by the copyright owner that is granting the license"),
    ("Apache-2.0", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("MPL-2.0", "contributor means each individual or legal entity that creates contributes to the creation of or owns covered software"),
    ("MPL-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at"),
    ("GPL-2.0", "the licenses for most software are designed to take away your freedom to share and change it by contrast the gnu general public license is intended to guarantee your freedom to share and change free software to make sure the software is free for all its users"),
    ("GPL-3.0", "the gnu general public license is a free copyleft license for software and other kinds of works the licenses for most software and other practical works are designed to take away your freedom to share and change the works"),
    ("LGPL-2.1", "this is the first released version of the lesser gpl it also counts as the successor of the gnu library public license version 2 hence the version number 2 1"),
    ("AGPL-3.0", "the gnu affero general public license is a free copyleft license for software and other kinds of works specifically designed to ensure cooperation with the community in the case of network server software"),
    *((lic, _NOTICE.format(what, kind, v)) for what in ("this program", "this file", "this library") for lic, kind, v in (("GPL-2.0", "general", "2"), ("GPL-3.0", "general", "3"), ("LGPL-2.1", "lesser general", "2 1"), (None, "lesser general", "3"), (None, "library general", "2"), ("AGPL-3.0", "affero general", "3"))),
    (None, "this version of the gnu lesser general public license incorporates the terms and conditions of version 3 of the gnu general public license supplemented by the additional permissions listed below"),
    (None, "this is the first released version of the library gpl it is numbered 2 because it goes with version 2 of the ordinary gpl"),
    (None, "the purpose of this license is to make a manual textbook or other functional and useful document free in the sense of freedom"),
    (None, "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely"),
    (None, "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit the software"),
    (None, "the laws of most jurisdictions throughout the world automatically confer exclusive copyright and related rights"),
    (None, "the accompanying program is provided under the terms of this eclipse public license"),
    (None, "the intent of this document is to state the conditions under which a package may be copied such that the copyright holder maintains some semblance of artistic control"),
    (None, "the license agreements of most software companies try to keep users at the mercy of those companies"),
]
#: Names near to those above that mean licences outside the list of results.
OTHER_NAMES = [f"{a}{b} general public license {v}" for a in ("gnu ", "") for b in ("lesser", "library") for v in ("version 3", "v 3", "v 3 0", "version 2", "v 2", "v 2 0", "version 2 0", "version 3 0")] + [f"{a}general public license {v}" for a in ("gnu ", "") for v in ("version 1", "v 1")] + [f"gnu free documentation license {v}" for v in ("version 1 1", "version 1 2", "version 1 3")]
#: Titles of licences that aren't among the results.
OTHER = re.compile(r"gnu (?:lesser general public license|library general public license|free documentation license)|creative commons|eclipse public license|boost software license|artistic license|\bzlib\b|european union public|academic free|php license|python software foundation", re.I)
#: Words that say nobody may use a file.
CLOSED = re.compile(
    r"\bproprietary\b|\bconfidential\b|\binternal use only\b|\bnot licen[cs]ed to (?:third|other)\b|\bno licen[cs]e is granted\b|\bno use without\b|\bunauthori[sz]ed (?:use|copying)\b|\bdo not (?:copy|distribute|redistribute)\b",
    re.I,
)
#: The phrases that introduce a statement of the licence.
_LEAD = r"(?:licen[cs]ed (?:to you )?under|(?:released|distributed|published|made available|available|provided|offered|issued) under|governed by|(?:passed on|used|copied|redistributed|modified|changed)(?:[\w ,]{0,60})? under|subject to|covered by|under the terms of)"
STATED = re.compile(rf"(?P<not>\bnot |\bwas |\bwere |\bformerly |\bpreviously )?\b{_LEAD}\s+(?P<either>either(?: of)? )?(?:(?:the )?(?:terms|conditions)(?: and conditions)? of )?(?:the |an? )?(?P<name>[^;\n]{{2,160}})", re.I)
TAGGED = re.compile(r"(?:SPDX-License-Identifier\s*:|@licen[cs]e\b\s*:?|^\s*Licen[cs]e\s*:)\s*(?P<name>[^\n]{1,120})", re.I | re.M)
#: Where the name in a statement ends.
ENDS = re.compile(r"\.(?=\s|$)|,? which\b|,? see\b|,? that\b|,? as\b|,? and (?:comes|ships)\b|,? with(?:out)?\b|,? at (?:your|the)\b|; ", re.I)
LICENCE_FILE = re.compile(r"^(?:un)?licen[cs]e(?:[._-][\w.-]+)?$|^copying(?:[._-][\w.-]+)?$", re.I)
COMMENT = re.compile(r"^\s*(?://+!?|/\*+!?|\*+/?|#+!?|--+|;+|%+|<!--|\"\"\"|''')?\s?|(?:\*/|-->|\"\"\"|''')\s*$")
#: What begins a comment, what closes those of several lines, the strings in a line of code up to a
#: comment's sign, and the lines of code that may stand before a file's first comment.
MARKED = re.compile(r"\s*(?:(?P<opens>/\*|<!--|\"\"\"|''')|//|\*|#(?!include|define|if|endif|pragma)|--|;|%)")
CLOSES = {"/*": "*/", "<!--": "-->", '"""': '"""', "'''": "'''"}
QUOTED = re.compile(r"(?P<triple>\"\"\"|''')|\"(?:\\.?|[^\"\\])*(?:\"|$)|'(?:\\.?|[^'\\])*(?:'|$)|(?P<sign>(?<!\S)(?:#|//))")
PREAMBLE = re.compile(r"\s*(?:<\?(?:php|xml)\b|<!doctype\b|#\s*(?:ifndef|define|pragma once)\b|package\b|[\"']use strict[\"'])", re.I)


def tokens(name: str) -> list[str]:
    """Lower-case words and numbers of a name in one spelling."""
    s = re.sub(r"\b([al]?gpl|mpl)(?=v\d)", r"\1 ", name.lower().replace("licence", "license").replace("+", " "))
    s = re.sub(r"[,-]?\s*\bor (?:any |\(at your option\) any )?later(?: one| version)?\b|-or-later|-only\b|\bonly\b", " ", s)
    s = re.sub(r"\bversion\b|\bver\b\.?", " version ", s)
    out = re.findall(r"[a-z]+|\d+", s)
    drop = {"the", "a", "an", "terms", "of", "conditions", "s"}
    return [t for t in out if t not in drop]


def edit_distance(a: list[str], b: list[str]) -> int:
    """Token edit distance; the columns of the matrix are bits of one integer."""
    if not a or not b:
        return len(a) + len(b)
    where: dict[str, int] = {}
    for i, t in enumerate(a):
        where[t] = where.get(t, 0) | 1 << i
    mask, top = (1 << len(a)) - 1, 1 << len(a) - 1
    up, down, d = mask, 0, len(a)
    for t in b:
        eq = where.get(t, 0)
        x = (((eq & up) + up) ^ up) | eq | down
        plus, minus = down | ~(x | up) & mask, up & x
        d += bool(plus & top) - bool(minus & top)
        plus = plus << 1 | 1
        up = (minus << 1 | ~((eq | down) | plus)) & mask
        down = plus & (eq | down) & mask
    return d


class MetricTree:
    """Burkhard-Keller tree of token sequences under :func:`edit_distance`."""

    def __init__(self, entries: list[tuple[list[str], str]]):
        self.root: list | None = None
        for seq, label in sorted(entries, key=lambda e: (len(e[0]), e[0])):
            self.add(seq, label)

    def add(self, seq: list[str], label: str) -> None:
        if self.root is None:
            self.root = [seq, label, {}]
            return
        node = self.root
        while True:
            d = edit_distance(seq, node[0])
            if d == 0:
                return
            if d not in node[2]:
                node[2][d] = [seq, label, {}]
                return
            node = node[2][d]

    def nearest(self, seq: list[str], bound: int, digits: bool = False) -> tuple[int, str | None] | None:
        """The least distance within ``bound`` and its label; ties go to the smaller label. With ``digits`` the numbers must
        agree in order, as they tell versions apart."""
        best, todo = None, [self.root] if self.root else []
        numbers = [t for t in seq if t.isdigit()]
        while todo:
            held, label, kids = todo.pop()
            d = edit_distance(seq, held)
            if d <= bound and (best is None or (d, label or "") < (best[0], best[1] or "")) and (not digits or numbers == [t for t in held if t.isdigit()]):
                best, bound = (d, label), d
            todo.extend(kid for step, kid in kids.items() if abs(step - d) <= bound)
        return best


@lru_cache(maxsize=1)
def tree() -> MetricTree:
    others = [(tokens(n), None) for n in OTHER_NAMES]
    return MetricTree([(tokens(n), lic) for lic, ns in NAMES.items() for n in ns] + others)


@lru_cache(maxsize=50_000)
def named(name: str) -> str | None:
    """The licence that a name means, or None. Digits must agree, as they tell versions apart."""
    seq = tokens(name)
    if not seq or len(seq) > 14:
        return None
    got = tree().nearest(seq, int(len(seq) * DIFFERENCE))
    if not got or got[1] is None:
        return None
    if got[0]:
        digits = {t for t in seq if t.isdigit()}
        if not any(digits == {t for t in tokens(n) if t.isdigit()} for n in NAMES[got[1]]):
            return None
    return got[1]


@lru_cache(maxsize=1)
def texts() -> tuple[dict[int, MetricTree], dict[tuple, list[tuple[int, int]]]]:
    """A metric tree for each length of the templates, and where each run of ANCHOR words stands in them."""
    by_length: dict[int, list] = {}
    anchors: dict[tuple, set] = {}
    for lic, t in TEXTS:
        seq = text_tokens(t)
        by_length.setdefault(len(seq), []).append((seq, lic))
        for i in range(len(seq) - ANCHOR + 1):
            anchors.setdefault(tuple(seq[i : i + ANCHOR]), set()).add((i, len(seq)))
    return {n: MetricTree(e) for n, e in by_length.items()}, {k: sorted(v) for k, v in anchors.items()}


def text_tokens(text: str) -> list[str]:
    """Lower-case words and numbers, without the numbers of list items."""
    low = re.sub(r"(?m)^\s*(?:\(?(?:\d{1,2}|[a-z])[.)]|[*•-])\s+", " ", text.lower().replace("licence", "license").replace("-\n", "-"))
    return re.findall(r"[a-z]+|\d+", low)


MAY_BE_TEXT = re.compile(r"licen[cs]|software|copyright|contributor|public domain|redistribution|copied|gnu |gpl", re.I)


def by_text(text: str) -> tuple[bool, str | None]:
    """Whether a template of a licence stands in the text, and which licence it is (None: one outside the list);
    the one with the least share of differing words, the first where several are equal.

    A window of ``n`` words with at most ``TEXT_DIFFERENCE * n`` edits shares many runs of ANCHOR words with its
    template, on nearly one diagonal: windows are tried where the most runs agree.
    """
    flat = re.sub(r"\s+", " ", text)
    if not MAY_BE_TEXT.search(flat):
        return False, None
    seq = text_tokens(text)
    trees, anchors = texts()
    starts: dict[tuple[int, int], int] = {}
    for j in range(len(seq) - ANCHOR + 1):
        for i, n in anchors.get(tuple(seq[j : j + ANCHOR]), ()):
            starts[n, j - i] = starts.get((n, j - i), 0) + 1
    best: dict[int, tuple[int, int]] = {}
    for (n, at), hits in sorted(starts.items()):
        near = sum(starts.get((n, at + k), 0) for k in range(-int(n * TEXT_DIFFERENCE), int(n * TEXT_DIFFERENCE) + 1))
        # Each edit breaks at most ANCHOR of the n - ANCHOR + 1 runs.
        if near >= n - ANCHOR + 1 - ANCHOR * int(n * TEXT_DIFFERENCE) and hits > best.get(n, (0, 0))[0]:
            best[n] = (hits, at)
    found = []
    for n, (_, at) in best.items():
        bound = int(n * TEXT_DIFFERENCE)
        window = seq[max(0, at) : max(0, at) + n]
        if (got := trees[n].nearest(window, bound, digits=True)) is not None:
            found.append((got[0] / n, -n, got[1]))
    if not found:
        return False, None
    return True, min(found, key=lambda x: (x[0], x[1], x[2] or ""))[2]


def choice(text: str) -> list[str]:
    """The licences in ``A or B``, ``A, B`` or one name; empty if any part is no licence."""
    text = text.strip().strip("()[]\"'`*/ ").strip()
    whole = named(text)
    if whole:
        return [whole]
    # An exception adds rights to the licence that it names.
    text = re.sub(r"\s+with\s+[\w.-]*(?:exception|note)[\w.-]*", "", text, flags=re.I)
    if whole := named(text):
        return [whole]
    kept = re.sub(r",?\s+or (?:any |\(at your option\) any )?later(?: one| version)?\b", "", text, flags=re.I)
    parts = [p.strip(" ,()\"'") for p in re.split(r"\s+or\s+(?:the\s+)?|\s*\|\s*|\s*/\s*(?=[A-Za-z])", kept, flags=re.I)]
    found = [named(p) for p in parts if p]
    return sorted(set(found)) if found and all(found) else []


def left_open(line: str, at: int) -> str:
    """The triple quote that a line, code from ``at``, leaves open, if any."""
    while (m := QUOTED.search(line, at)) and not m["sign"]:
        at = m.end()
        if m["triple"]:
            end = line.find(m["triple"], at)
            if end < 0:
                return m["triple"]
            at = end + 3
    return ""


def unwrapped(block: list[str]) -> str:
    """Lines of comment without their signs; of successive blank ones the first."""
    out = [COMMENT.sub("", COMMENT.sub("", x, count=1)).strip() for x in block]
    return "\n".join(x for i, x in enumerate(out) if x or not i or out[i - 1])


def comment_ends(text: str) -> list[str]:
    """The comment blocks at the start and the end of a file, whole and unwrapped.

    At the start are all that stand before any code or begin in the first HEAD_LINES lines, at the end all that stand
    after any code or end in the last TAIL_LINES lines, however long they are. Opening lines (PREAMBLE) are no code.
    A comment there that is never closed reaches to the end of the text.
    """
    text = text.replace("\r\n", "\n").replace("\r", "\n").lstrip("\ufeff")
    lines = text.split("\n")
    shuts = {c: text.count("\n", 0, p) if (p := text.rfind(c)) >= 0 else -1 for c in set(CLOSES.values())}
    blocks: list[tuple[int, int, list[str]]] = []
    now: list[str] = []
    began, first_code, last_code = 0, len(lines), -1
    # What closes the comment, or the string of code, in which a line begins.
    shut, string = "", False
    for at, line in enumerate(lines):
        s, pos, said, code = line.strip(), 0, [], string
        if shut and not string and not s:
            said.append("")
        while pos < len(s):
            skip = pos
            if not shut:
                if not (m := MARKED.match(s, pos)):
                    code = True
                    if (shuts['"""'] > at or shuts["'''"] > at) and (quote := left_open(s, pos)) and shuts[quote] > at:
                        shut, string = quote, True
                    break
                skip, shut = m.end(), CLOSES.get(m["opens"], "")
                if not shut or not (shuts[shut] > at or s.find(shut, skip) >= 0 or at < max(first_code, HEAD_LINES) or at >= len(lines) - TAIL_LINES):
                    shut = ""
                    said.append(s[pos:])
                    break
            end = s.find(shut, skip)
            stop = end + len(shut) if end >= 0 else len(s)
            if not string:
                said.append(s[pos:stop])
            if end >= 0:
                shut, string = "", False
            pos = stop
        if said:
            began = began if now else at
            now += said
        if code:
            last_code = at
            if first_code > at and not PREAMBLE.match(line):
                first_code = at
        if now and (code or not said):
            blocks.append((began, at if said else at - 1, now))
            now = []
    if now:
        blocks.append((began, len(lines) - 1, now))
    first, last = max(first_code, HEAD_LINES - 1), min(last_code, len(lines) - TAIL_LINES)
    return [unwrapped(b) for began, ended, b in blocks if began <= first or ended >= last]


def statements(block: str) -> list[str]:
    """Licences that a block of comment or notice states; none if it states none."""
    for m in TAGGED.finditer(block):
        if got := choice(re.sub(r"\s*(?:\*/|-->)\s*$", "", m["name"])):
            return got
        if CLOSED.search(m["name"]) or re.search(r"LicenseRef-Proprietary|UNLICENSED", m["name"]):
            return ["PROPRIETARY"]
    flat = re.sub(r"\s+", " ", block)
    for m in STATED.finditer(flat):
        if m["not"]:
            continue
        name = m["name"]
        # "version 2.0." holds dots: try the longest name that ends where a name may end.
        ends = [e.start() for e in ENDS.finditer(name)] + [len(name)]
        for e in ends:
            if got := choice(name[:e].rstrip(" .,;:")):
                return got
    found, lic = by_text(block)
    if found:
        return [lic] if lic else []
    if CLOSED.search(flat) and not OTHER.search(flat):
        return ["PROPRIETARY"]
    return []


def file_states(text: str | None) -> list[str]:
    """Licences that a source file states for itself at its start or end."""
    if not text:
        return []
    for block in comment_ends(text):
        if got := statements(block):
            return got
    return []


def licence_file_names(text: str | None) -> list[str]:
    """Licences that a licence file names: by its title, or in a statement."""
    if not text or not text.strip():
        return []
    lines = [x.strip().strip("#=*- ") for x in text.replace("\r", "\n").lstrip("\ufeff").split("\n") if x.strip()]
    for line in lines[:3]:
        if got := choice(re.sub(r"^(?:the |under )?(?:terms of )?(?:the )?|\(.*?copyright.*$", "", line, flags=re.I).rstrip(".")):
            return got
    # A title over two lines, as "GNU GENERAL PUBLIC LICENSE / Version 2, June 1991".
    for a, b in zip(lines[:3], lines[1:4]):
        if m := re.match(r"version (\d+(?:\.\d+)?)\b", b, re.I):
            if got := choice(f"{a} version {m[1]}"):
                return got
    found, lic = by_text("\n".join(text.replace("\r", "\n").split("\n")))
    if found:
        return [lic] if lic else []
    return statements("\n".join(lines))


def known(license_text: str | None) -> str | None:
    """A licence field as one of the names or a choice; None for blank and meaningless ones."""
    got = choice(license_text) if license_text else []
    return " OR ".join(got) if got else None


def _read(docs: DataFrame) -> DataFrame:
    """``ord, key, at, top, stated`` of every file; ``top`` marks licence files on top."""
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            top, stated = [], []
            for path, text in zip(b.column("path").to_pylist(), b.column("content").to_pylist()):
                p = re.sub(r"^(?:\./+)+|^/+", "", (path or "").strip().replace("\\", "/"))
                is_file = bool(LICENCE_FILE.match(p.rsplit("/", 1)[-1]))
                try:
                    got = licence_file_names(text) if is_file else file_states(text)
                except RecursionError:  # pragma: no cover
                    got = []
                top.append(is_file and "/" not in p)
                stated.append(got)
            yield pa.RecordBatch.from_arrays([b.column("ord"), b.column("key"), b.column("at"), pa.array(top, pa.bool_()), pa.array(stated, pa.list_(pa.string()))], ["ord", "key", "at", "top", "stated"])

    src = docs.select("ord", F.replace(norm_id(F.col("repo")), F.lit("/"), F.lit("_")).alias("key"), F.col("read_at").cast("timestamp_ntz").alias("at"), F.col("file_path").alias("path"), "content")
    return src.mapInArrow(run, "ord bigint, key string, at timestamp_ntz, top boolean, stated array<string>")


def licence_of_all(docs: DataFrame, records: DataFrame) -> DataFrame:
    """``tbl, ord, license, status`` of every file and every github record.

    Several licence files or record licences of one repository: the one read or found last
    holds, ties by larger ord, then by name; null, blank and meaningless licences are no
    evidence. Null content, paths and repositories give the repository's licence or UNKNOWN.
    """
    @F.pandas_udf("string")
    def field(c: pd.Series) -> pd.Series:
        return c.map(known)

    files = _read(docs)
    hub = records.where("source = 'github'").select("ord", F.replace(F.coalesce(norm_url(F.col("extra.clone_url")), norm_id(F.col("id"))), F.lit("/"), F.lit("_")).alias("key"), F.col("found_at").cast("timestamp_ntz").alias("at"), "license")
    joined = F.array_join("stated", " OR ")
    own = files.where("top and size(stated) > 0 and key is not null").groupBy("key").agg(F.max(F.struct("at", "ord", joined.alias("l")))["l"].alias("own"))
    # The distinct spellings of a field are few; they are read once each.
    spelled = hub.select("license").where("license is not null").distinct().select("license", field("license").alias("known"))
    said = hub.join(spelled, "license").where("known is not null and key is not null").groupBy("key").agg(F.max(F.struct("at", "ord", "known"))["known"].alias("said"))
    repos = own.join(said, "key", "full").select(
        "key",
        F.coalesce("own", "said").alias("repo_license"),
        F.when(F.col("own").isNotNull() & F.col("said").isNotNull() & (F.col("own") != F.col("said")), "conflict").otherwise("ok").alias("repo_status"),
    )
    lic, st = F.coalesce("repo_license", F.lit("UNKNOWN")), F.when(F.col("repo_license").isNull(), "unknown").otherwise(F.col("repo_status"))
    of_records = hub.join(repos, "key", "left").select(F.lit("source_records").alias("tbl"), "ord", lic.alias("license"), st.alias("status"))
    one = F.col("repo_license").isNull() | F.arrays_overlap(F.split("repo_license", " OR "), "stated")
    of_files = files.join(repos, "key", "left").select(
        F.lit("documents_raw").alias("tbl"),
        "ord",
        F.when(F.size("stated") > 0, joined).otherwise(lic).alias("license"),
        F.when(F.size("stated") > 0, F.when(one, "ok").otherwise("conflict")).otherwise(st).alias("status"),
    )
    return of_files.unionByName(of_records)

"""Statements anywhere in the comments at a file's start and end, however long these are."""

import pytest

from tamis.llm import licences as L

NAMES = [f"Copyright (c) {1990 + i} Person Number{i}" for i in range(40)]
STATED = "Licensed under the MIT License."
CODE = [f"x{i} = {i}" for i in range(80)]
MIT = next(t for lic, t in L.TEXTS if lic == "MIT").split()
TEXT = [" ".join(MIT[i : i + 4]) for i in range(0, len(MIT), 4)]
STYLES = {
    "stars": lambda ls: ["/*", *(f" * {x}" for x in ls), " */"],
    "plain": lambda ls: ["/*", *ls, "*/"],
    "docstring": lambda ls: ['"""', *ls, '"""'],
    "single quotes": lambda ls: ["'''" + ls[0], *ls[1:], "'''"],
    "markup": lambda ls: ["<!--", *ls, "-->"],
    "slashes": lambda ls: [f"// {x}" if x else "" for x in ls],
    "hashes": lambda ls: [f"# {x}" if x else "" for x in ls],
}


def states(lines):
    return L.file_states("\n".join(lines) + "\n")


@pytest.mark.parametrize("style", STYLES)
@pytest.mark.parametrize("said", [[*NAMES, "", STATED], [STATED, "", *NAMES], [*NAMES, "", STATED, "", *NAMES], [*NAMES, "", *TEXT], [*TEXT, "", *NAMES]])
def test_long_comments_are_read_whole(style, said):
    block = STYLES[style](said)
    assert states(block + CODE) == states(CODE + block) == states(["<?php", *block, *CODE]) == ["MIT"]
    assert states(block) == states(["", *block, "", ""]) == ["MIT"]


@pytest.mark.parametrize("style", STYLES)
def test_comments_between_code_state_nothing(style):
    assert states(CODE + STYLES[style]([*NAMES, STATED, *NAMES]) + CODE) == []


def test_several_comments_before_and_after_code():
    about = STYLES["stars"](NAMES)
    assert states([*about, "", "", *STYLES["plain"]([STATED]), *CODE]) == ["MIT"]
    assert states([*CODE, *STYLES["plain"]([STATED]), "", *about]) == ["MIT"]
    assert states(["#ifndef A_H", "#define A_H", *about, "", f"// {STATED}", *CODE]) == ["MIT"]


def test_comments_end_where_they_are_closed():
    said = STATED  # as a line of code
    assert states(['"""About.', '"""', said, *CODE]) == []
    assert states(["/* one */ int x;", said, *CODE]) == []
    assert states(["import x", 't = """', *NAMES, '"""', said, *CODE]) == []
    assert states([*CODE, 't = """', "a", '"""', said, "z = 1"]) == []
    assert states(["import x", "t = '''it's", '"""', "'''", said, *CODE, f"# {STATED}"]) == ["MIT"]


def test_comments_that_are_never_closed():
    assert states(["/*", *NAMES, STATED]) == states(["import x", '"""', *NAMES, STATED]) == states([*CODE, "/*", STATED]) == ["MIT"]
    # A pattern of a shell isn't one: it hides neither code nor the comment at the end.
    assert states([*CODE, "/*) echo", STATED, *CODE]) == []
    assert states([*CODE, "/*) echo", *CODE, f"# {STATED}"]) == ["MIT"]


def test_line_breaks_and_blank_lines():
    block = [*NAMES, *[""] * 2000, STATED]
    for end in ("\n", "\r\n", "\r"):
        assert L.file_states("\ufeff" + end.join([*STYLES["plain"](block), *CODE])) == ["MIT"]

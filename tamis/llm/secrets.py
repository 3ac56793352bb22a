"""Problem 2: credentials in source files and answers, and their redaction.

Characters per subword of a public vocabulary tell unnatural strings from words: natural text takes
few subwords, random strings many. Every long unnatural string is a credential unless its context
says otherwise (a name or address of a hash, id, certificate, picture or version, a row of data).
Context then adds what is too short for the score alone: passwords by their name, header, address,
command or comment. What is found is masked character for character; quotes, escapes of line ends, the
operators between joined literals and every other character keep their place.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamis.llm.tokenize import VOCABULARY, WORD_PATTERN, load_ranks
from tamis.plans.runtime import spread

#: A string with fewer characters per subword than this looks random.
UNNATURAL = 2.6
#: Without a name that tells, a string must look clearly random, and isn't longer than a key.
STRANGE, LONGEST = 2.2, 128
#: Shortest password, and shortest string that its score alone may tell from words.
LEAST_CHARS, LEAST_RANDOM = 7, 16

#: Names of secrets; and endings that make a name something else.
NAME = r"(?:[\w.$-]*?(?:pass(?:wd|word|phrase|code)?|pwd|secret|token|api[_-]?key|access[_-]?key|auth[_-]?key|private[_-]?key|signing[_-]?key|encryption[_-]?key|secret[_-]?key|master[_-]?key|credentials?|auth(?:orization)?|bearer|jwt)(?:[_-]?(?:key|value|string|hash|id)?)[\w-]{0,12})"
NOT_A_SECRET = re.compile(r"(?:field|name|column|col|kind|type|path|file|url|uri|limit|max|min|count|size|len|length|index|prefix|suffix|label|title|hint|policy|rule|regex|pattern|mode|ttl|expiry|expires|age|scope|scopes|header_name|param|env|var|provider|service|class|table|row|page|hash|sha|sha1|sha256|digest|checksum|fingerprint|id|ids)s?$", re.I)
TELLS = re.compile(r"pass|pwd|secret|token|key|credential|auth|bearer|jwt", re.I)
#: Tokens that tell what they are by their form.
PREFIXED = (
    r"(?:sk|rk|pk)-(?:[a-z]{2,6}-)?[A-Za-z0-9_-]{16,}|(?:sk|rk)_(?:live|test)_[A-Za-z0-9]{16,}|gh[pousr]_[A-Za-z0-9]{20,}|github_pat_[A-Za-z0-9_]{22,}|glpat-[A-Za-z0-9_-]{20,}|xox[a-z]-[A-Za-z0-9-]{16,}|xapp-[A-Za-z0-9-]{16,}"
    r"|(?:AKIA|ASIA|AGPA|AIDA|AROA)[A-Z0-9]{16}(?![A-Za-z0-9])|AIza[A-Za-z0-9_-]{35}|ya29\.[A-Za-z0-9_-]{20,}|eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{4,}\.[A-Za-z0-9_-]{16,}|hf_[A-Za-z0-9]{20,}|npm_[A-Za-z0-9]{30,}|pypi-[A-Za-z0-9_-]{30,}|SG\.[A-Za-z0-9_-]{16,}\.[A-Za-z0-9_-]{16,}|dop_v1_[a-f0-9]{40,}"
)
RE_PREFIXED = re.compile(rf"(?<![A-Za-z0-9_/+-])(?:{PREFIXED})")
RE_PEM = re.compile(r"-----BEGIN (?P<kind>(?:[A-Z0-9]+ )*PRIVATE KEY(?: BLOCK)?)-----(?P<body>(?:(?!-----BEGIN).)*?)-----END (?P=kind)-----", re.S)
#: A PEM header in base64, with or without a name.
RE_ENCODED = re.compile(r"(?<![A-Za-z0-9+/])LS0tLS1CRUdJTi[A-Za-z0-9+/]{40,}={0,2}")
RE_URL = re.compile(r"[a-z][a-z0-9+.-]*://(?P<user>[^\s:/@\"'`<>]*):(?P<v>[^\s@\"'`]+?)@(?=[\w\[.-])", re.I)
RE_BASIC = re.compile(r"\bBasic\s+(?P<v>[A-Za-z0-9+/_-]{8,}={0,2})", re.I)
RE_BEARER = re.compile(r"\b(?:Bearer|Token)\s+(?P<v>[A-Za-z0-9._~+/-]{16,}=*)")
RE_CONN = re.compile(r"(?:^|[;\"'`\s&?])(?:password|passwd|pwd|accountkey|sharedaccesskey)\s*=\s*(?P<v>[^;\"'`\s&]{4,})\s*[;&]", re.I)
#: name = "value": in code, JSON, maps and calls; the value may be split over lines.
RE_QUOTED = re.compile(rf"(?<![A-Za-z0-9_.-])(?P<nq>[\"'`])?(?P<n>{NAME})(?(nq)(?P=nq))\]?\s*(?::=|=>|==?|:|,|\s)\s*\(?\s*(?:[a-zA-Z]{{0,2}})?(?P<q>[\"'`])(?P<v>(?:[^\"'`\\\n]|\\[^\n]|(?!(?P=q))[\"'`])+)(?P=q)", re.I)
RE_BARE = re.compile(rf"^[ \t]*(?:-[ \t]+)?(?:export[ \t]+|set[ \t]+|ENV[ \t]+)?(?P<n>{NAME})[ \t]*[:=][ \t]*(?P<v>[^\s\"'`#({{\[<][^\s\"'`]{{3,}})[ \t]*(?:#.*)?\r?$", re.I | re.M)
#: In comments and prose.
RE_SAYS = re.compile(
    r"\b(?:password|passwd|passphrase|pass|pwd|secret|token|key|credentials?)\b(?:[ \t]+(?:is|was|are|for \S+ is|to use is|set to))?[ \t]*[:=]?[ \t]+(?!(?:password|passwd|passphrase|pass|pwd|secret|token|key|is|was|and|or)\b)[\"'`]?(?P<v>[^\s\"'`,;()]{7,})"
    r"|\blog ?in\b[^\n]{0,60}?[:=]\s*\S{1,60}\s*/\s*(?P<v2>[^\s\"'`,;]{7,})|(?:^|\s)-u\s+[\"']?[^\s:\"']{1,60}:(?P<v3>[^\s\"'`]{6,})|(?:^|\s)(?:--password|--pass|--token|--api-key)(?:=|\s+)[\"']?(?P<v4>[^\s\"'`]{7,})|\b(?:mysql\w*|mariadb|sshpass|redis-cli)\b[^\n]{0,120}?\s-[pa]\s?(?P<v5>[^\s\"'`-][^\s\"'`]{5,})",
    re.I,
)
#: A string that goes on in the next literal.
RE_SPLIT = re.compile(r"([\"'`])[ \t]*(?:\+|\.|\\|&|\|\|)?[ \t]*\r?\n[ \t]*(?:\+[ \t]*|\.[ \t]*)?\1")

#: What stands where a secret would be.
PLACEHOLDER = re.compile(
    r"\$\{|\{\{|\}\}|<%|%\(|^\$\w+$|^\$\(|^%\w+%$|^@\w+@$|^<[^>]*>$|^\[[^\]]*\]$|^(.)\1*$|^x+[-_x]*$|^\*+|^\.+$|\.\.\.|…"
    r"|change[ _-]?me|change[ _-]?it|replace[ _-]?(?:me|this|with)|place[ _-]?holder|\bexample\b|example[ _-]?(?:only|key|token)|\bdummy\b|\bfake\b|\bsample\b|not[ _-]?a[ _-]?real|redacted|\binsert\b|^your?[ _-]|[ _-]here$|your[ _-](?:api|token|secret|password|key)|^todo\b|^tbd$|^none$|^null$|^undefined$|^nil$|^true$|^false$|^test(?:ing)?$|^secret$|^password$|^token$|^hunter2$|xxxx|^abc123$|^foo(?:bar)?$|\bmasked\b|\bremoved\b",
    re.I,
)
#: Words of texts about passwords, and of settings.
SPEAKS = re.compile(r"\b(?:enter|your|the|this|that|must|should|is|are|was|be|for|not|no|wrong|invalid|please|type|choose|forgot|forgotten|new|old|current|confirm|repeat|again|required|reset|change|password|passphrase|secret|token|key|user|field|match|empty|missing|incorrect|strong|weak|optional|disabled|enabled|prompt|plain|plaintext|internal|external|postgres|database|encrypted|unset|default)\b", re.I)
LOOKUP = re.compile(r"(?:os\.|process\.env|getenv|environ|env\[|config\.|settings\.|secrets?\.|vault|viper|System\.|\bself\.|\bthis\.|\breq\.|\bctx\.|params?\.|\w+\(|\w+\[|::|->|=>|\bnew )", re.I)
UUID = re.compile(r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$", re.I)
#: Runs of characters that keys are written in; what stands before a run that is no key; address lines.
RE_RUN = re.compile(r"(?<![A-Za-z0-9_+/.%-])[A-Za-z0-9_+/-]{16,}={0,2}(?![A-Za-z0-9_+/=.%-])")
HARMLESS = re.compile(
    r"hash|sha|md5|digest|check_?sum|e_?tag|integrity|finger_?print|commit|revision|\brev\b|uuid|guid|(?:^|[^a-z])(?:x_)?ids?(?:[^a-z]|$)|nonce|salt|cert|public|\bpub|ssh_|data:|base64|icon|logo|pixel|image|\bimg|png|jpe?g|gif|font|\bhex|crc|build|version|seed|cursor|anchor|trace|request|tenant|sess|signature|vector|table|blob|payload|\bdata\b|://",
    re.I,
)
HINTS = ["pass", "pwd", "secret", "token", "key", "credential", "auth", "bearer", "basic ", "://", "-----begin", "ls0tls1crudjti", "sk-", "rk-", "sk_", "rk_", "ghp_", "gho_", "ghu_", "ghs_", "ghr_", "github_pat_", "glpat-", "xox", "xapp-", "akia", "asia", "aiza", "ya29.", "eyj", "hf_", "npm_", "pypi-", "sg.", "dop_v1_", "login", "log in", "-u ", "mysql", "mariadb", "redis-cli", "agpa", "aida", "aroa"]


@lru_cache(maxsize=2)
def _encoding(path: str):
    import tiktoken

    return tiktoken.Encoding("split", pat_str=WORD_PATTERN, mergeable_ranks=load_ranks(path), special_tokens={})


@lru_cache(maxsize=100_000)
def chars_per_subword(value: str, vocabulary: str = VOCABULARY) -> float:
    """Characters per subword: about 4 for words, under 2 for random strings."""
    return len(value) / max(1, len(_encoding(vocabulary).encode_ordinary(value)))


@lru_cache(maxsize=1)
def _hints():
    import ahocorasick

    a = ahocorasick.Automaton()
    for h in HINTS:
        a.add_word(h, h)
    a.make_automaton()
    return a


def _kinds(v: str) -> int:
    return any(c.islower() for c in v) + any(c.isupper() for c in v) + any(c.isdigit() for c in v) + any(not c.isalnum() for c in v)


def is_random(v: str, vocabulary: str = VOCABULARY) -> bool:
    """A long string that reads like no words."""
    return len(v) >= LEAST_RANDOM and any(c.isdigit() for c in v) and any(c.isalpha() for c in v) and chars_per_subword(v, vocabulary) < UNNATURAL and len(set(v)) >= 8


def unnatural(text: str, vocabulary: str = VOCABULARY) -> list[tuple[int, int]]:
    """Where long strings stand that read like no words: letters of both cases and digits, mixed, and few
    characters per subword. Text in hexadecimal reads the same whether key, hash or id, and isn't among them."""
    out = []
    for m in RE_RUN.finditer(text):
        v = m.group()
        if len(v) <= LONGEST and len(re.findall(r"\d+", v)) >= 3 and len(re.findall(r"[a-z](?=[A-Z0-9])|[A-Z0-9](?=[a-z])", v)) >= 3 and len(re.findall("[A-Z]", v)) >= 2 and len(re.findall("[a-z]", v)) >= 2 and len(set(v)) >= 10 and chars_per_subword(v, vocabulary) < STRANGE:
            out.append(m.span())
    return out


def tells_of_data(text: str, s: int, e: int) -> bool:
    """The line around an unnatural string says that it is no key: a name of something else before it,
    or nothing beside it, as in rows of data."""
    a, b = text.rfind("\n", 0, s) + 1, text.find("\n", e)
    before, after = text[a:s], text[e : len(text) if b < 0 else b]
    rest = before + after
    if not re.search(r"[A-Za-z]", rest) or not re.search(r"[\"'`=:(\s]$", before):
        return True
    name = re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", before[-80:])
    return bool(HARMLESS.search(name.replace("-", "_"))) or len(RE_RUN.findall(rest)) > 1 or is_placeholder(text[s:e])


def is_phrase(name: str, v: str) -> bool:
    """A passphrase of plain words under the name of a password: three words or more that don't speak
    about passwords, or in a setting (upper-case name) a word of its own."""
    if not re.search(r"pass(?:wd|word|phrase)?$|pwd$", name, re.I) or is_placeholder(v) or SPEAKS.search(v):
        return False
    if re.fullmatch(r"[A-Za-z]+(?:[ -][A-Za-z]+){2,7}", v):
        return v == v.lower() or "-" in v
    return name.isupper() and bool(re.fullmatch(r"[a-z]{8,}", v))


def is_placeholder(v: str) -> bool:
    return bool(PLACEHOLDER.search(v))


def is_password(v: str, vocabulary: str = VOCABULARY) -> bool:
    """A value that its context calls a secret is one: not a placeholder, a look-up or a name,
    but a mix of letters with digits or marks."""
    v = v.strip()
    if len(v) < LEAST_CHARS or " " in v or is_placeholder(v) or UUID.match(v) or not any(c.isalpha() for c in v):
        return False
    if re.match(r"^(?:https?|data|file):", v) or re.fullmatch(r"[\w-]+(?:\.[\w-]+)*\.(?:example|com|org|net|io|go|py|js|json|ya?ml|env|pem|key|txt|html?)", v):
        return False
    if re.fullmatch(r"[A-Za-z]+(?:[_.-][A-Za-z]+)*", v):
        # letters alone: a name, unless they read like nothing
        return len(v) >= LEAST_RANDOM and chars_per_subword(v, vocabulary) < 2.0 and _kinds(v) >= 2
    if any(c.isdigit() for c in v):
        if re.fullmatch(r"[A-Za-z]+_?\d{1,2}", v) and len(v) < 12 and _kinds(v) < 3:
            return False
        if re.fullmatch(r"v?\d+(?:\.\d+)*[a-z]?", v):
            return False
        return True
    return _kinds(v) >= 3 or chars_per_subword(v, vocabulary) < UNNATURAL


def _basic_ok(v: str) -> bool:
    try:
        plain = base64.b64decode(v + "=" * (-len(v) % 4), altchars=b"-_" if "-" in v or "_" in v else None).decode("utf-8")
    except ValueError:
        return False
    user, colon, password = plain.partition(":")
    return bool(colon and plain.isprintable() and len(password) >= 4 and not is_placeholder(password) and password.lower() not in ("password", "pass", "user", user.lower()))


def _pem_ok(body: str) -> bool:
    """A key given in full: lines of base64, not an ellipsis."""
    lines = [re.sub(r"^[\s\"'`+#/*]+|[\s\"'`+,\\]+$", "", x) for x in re.split(r"\r?\n|\\n", body)]
    lines = [x for x in lines if x and not re.match(r"[\w-]+:\s", x)]
    data = [x for x in lines if re.fullmatch(r"[A-Za-z0-9+/=]+", x)]
    return sum(map(len, data)) >= 64 and len(data) >= 0.8 * len(lines) and len({c for x in data for c in x}) >= 16


def _encoded_ok(v: str) -> bool:
    """A private key given in full, in base64."""
    m = RE_PEM.search(base64.b64decode(v.rstrip("=") + "=" * (-len(v.rstrip("=")) % 4)).decode("latin-1")) if len(v.rstrip("=")) % 4 != 1 else None
    return bool(m and _pem_ok(m["body"]))


def _name_ok(n: str) -> bool:
    flat = n.strip("\"'`").rstrip("_-.$")
    last = re.split(r"[.$]", flat)[-1]
    if not TELLS.search(last):
        return False
    return not NOT_A_SECRET.search(re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", last).lower().rsplit("_", 1)[-1] if re.search(r"[_-]|[a-z][A-Z]", last) else last)


def _joined(text: str) -> tuple[str, list[int] | None]:
    """The text with literals that go on joined, and the place in the text of each of its characters."""
    if not RE_SPLIT.search(text):
        return text, None
    at: list[int] = []
    pieces, last = [], 0
    for m in RE_SPLIT.finditer(text):
        pieces.append(text[last : m.start()])
        at.extend(range(last, m.start()))
        last = m.end()
    pieces.append(text[last:])
    at.extend(range(last, len(text)))
    return "".join(pieces), at


def _found(plain: str, vocabulary: str) -> list[tuple[int, int]]:
    """Credentials in a text whose literals are joined, in order and without overlap."""
    low = plain.lower()
    hinted = next(_hints().iter(low), None) is not None
    strange = unnatural(plain, vocabulary)
    if not hinted and not strange:
        return []
    found: list[tuple[int, int]] = []

    def keep(m: re.Match, group: str | int = "v") -> None:
        found.append(m.span(group))

    armored = [m.span() for m in re.finditer(r"-----BEGIN [A-Z0-9 ]+-----.*?-----END [A-Z0-9 ]+-----", plain, re.S)] if "-----begin" in low else []
    for s, e in strange:
        if not tells_of_data(plain, s, e):
            found.append((s, e))
    if hinted:
        if "private key" in low:
            for m in RE_PEM.finditer(plain):
                if _pem_ok(m["body"]):
                    keep(m, 0)
        if "ls0tls1crudjti" in low:
            for m in RE_ENCODED.finditer(plain):
                if _encoded_ok(m.group()):
                    keep(m, 0)
        _by_form(plain, low, vocabulary, keep)
        _by_name(plain, vocabulary, keep)
        if any(w in low for w in ("pass", "pwd", "secret", "token", "key", "login", "log in", "-u ", " -p", " -a", "mysql", "mariadb", "redis-cli", "credential")):
            found += _said(plain, vocabulary)
    found = [(s, e) for s, e in found if not any(a < s and e < b for a, b in armored if (a, b) not in found)]
    found.sort(key=lambda x: (x[0], -x[1]))
    out: list[tuple[int, int]] = []
    for s, e in found:
        if out and s < out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def _by_form(plain: str, low: str, vocabulary: str, keep) -> None:
    """Known prefixes, addresses, headers and connection strings."""
    for m in RE_PREFIXED.finditer(plain):
        v = m.group()
        if len(set(v)) >= 10 and not is_placeholder(v[3:]) and (any(c.isdigit() for c in v[3:]) or chars_per_subword(v, vocabulary) < UNNATURAL):
            keep(m, 0)
    if "://" in plain:
        for m in RE_URL.finditer(plain):
            v = m["v"]
            if len(v) >= 4 and not is_placeholder(v) and not re.match(r"^\$|^%\w+%$|^\d{1,5}$", v) and v.lower() not in ("password", "pass", "pwd", "secret", "token"):
                keep(m)
    if "basic " in low:
        for m in RE_BASIC.finditer(plain):
            if _basic_ok(m["v"]):
                keep(m)
    if "bearer " in low or "token " in low:
        for m in RE_BEARER.finditer(plain):
            if not is_placeholder(m["v"]) and (is_random(m["v"], vocabulary) or len(m["v"]) >= 24 and _kinds(m["v"]) >= 3):
                keep(m)
    if "pass" in low or "pwd" in low or "accesskey" in low or "accountkey" in low:
        for m in RE_CONN.finditer(plain):
            if not is_placeholder(m["v"]) and not LOOKUP.search(m["v"]) and m["v"].lower() not in ("password", "secret"):
                keep(m)


def _by_name(plain: str, vocabulary: str, keep) -> None:
    """Values under names of secrets."""
    for rx in (RE_QUOTED, RE_BARE):
        for m in rx.finditer(plain):
            v = m["v"]
            if not _name_ok(m["n"]) or not is_password(v, vocabulary) and not is_phrase(m["n"], v):
                continue
            if rx is RE_BARE and (LOOKUP.search(v) or v.endswith((";", ",", "{", ")")) and not re.search(r"\d", v) or re.search(r"[(){}\[\]]|:=", v)):
                continue
            if "://" in v or v.startswith(("Basic", "Bearer", "Server=", "data:")) or "-----BEGIN" in v:
                continue
            keep(m)


def _said(plain: str, vocabulary: str) -> list[tuple[int, int]]:
    """Passwords in comments, prose and commands."""
    out = []
    for m in RE_SAYS.finditer(plain):
        g = next(k for k in ("v", "v2", "v3", "v4", "v5") if m[k] is not None)
        v = m[g]
        end = m.end(g)
        while v and v[-1] in ",;:)":
            v, end = v[:-1], end - 1
        said = v
        if said.endswith(".") and end == m.end(g) and not re.search(r"[!?#$%^&*@_+=-]|\d\.$", said):
            said, end = said[:-1], end - 1
        if not is_password(said, vocabulary) or LOOKUP.search(said) or re.search(r"[(){}\[\]<>]|://|:=|==", said) or re.search(r"\.(?:go|py|js|ts|md|txt|json|ya?ml)\b", said):
            continue
        if g == "v" and not (any(c.isdigit() for c in said) and (_kinds(said) >= 3 or "-" in said or len(said) >= 10) or is_random(said, vocabulary) or _kinds(said) >= 3):
            continue
        if g == "v" and re.fullmatch(r"[A-Za-z]*[a-z_]+\d+|[a-z]+[A-Z]\w*|\w+[.]\w+(?:[.]\w+)*", said) and not is_random(said, vocabulary) and not re.search(r"\d{3,}", said):
            continue
        out.append((m.start(g), end))
    return out


def spans(text: str | None, vocabulary: str = VOCABULARY) -> list[tuple[int, int]]:
    """Where credentials stand in a text, as (start, end) of their characters, in order and
    without overlap. A credential that is split over lines is one span from its first character."""
    if not text:
        return []
    plain, at = _joined(text)
    found = _found(plain, vocabulary)
    return found if at is None else [(at[s], at[e - 1] + 1) for s, e in found]


def line_numbers(text: str, found: list[tuple[int, int]]) -> list[int]:
    """Lines (from 1, ending at a line feed) on which a span starts, each once."""
    return sorted({text.count("\n", 0, s) + 1 for s, _ in found})


#: A line of an armored key: what stands before its data, and its data.
RE_KEPT = re.compile(r"-----(?:BEGIN|END) [A-Z0-9 ]+-----|\\[nrt]|\\?\r?\n[ \t]*(?:(?://+|#+|\*+|--+|;+|\|+)[ \t]*)?|[\"'`+,\s]+(?=$|[\"'`\s])|\s+")


def _mask(secret: str, mask: str) -> str:
    """As many mask characters as the secret has, but for white space and quotes, and in a key for its armor, line ends
    (escaped ones too) and comment signs."""
    if "-----BEGIN" not in secret:
        # An escape is masked whole, a blank never.
        return re.sub(r"\\[^\s]|[^\s]", lambda m: mask * len(m.group()), secret)
    out, last = [], 0
    for m in RE_KEPT.finditer(secret):
        out += [re.sub(r"[^\"'`]", mask, secret[last : m.start()]), m.group()]
        last = m.end()
    return "".join(out) + re.sub(r"[^\"'`]", mask, secret[last:])


def redact(text: str | None, vocabulary: str = VOCABULARY, mask: str = "x") -> str | None:
    """The text with every credential masked, character for character; null stays null.

    What joins two literals, quotes, line ends, armor lines and escapes of line ends stay, so that code
    and configuration parse as before; the mask is a letter because ``*`` means something in YAML. A
    second pass finds nothing, as a run of the mask is a placeholder.
    """
    if not text:
        return text
    plain, at = _joined(text)
    found = _found(plain, vocabulary)
    if not found:
        return text
    out = list(text)
    for s, e in found:
        hidden = _mask(plain[s:e], mask)
        for k, c in enumerate(hidden):
            out[at[s + k] if at is not None else s + k] = c
    return "".join(out)


def _texts(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    a = spread(docs.select(F.lit("documents_raw").alias("tbl"), "ord", F.col("content").alias("text")))
    b = spread(pairs.select(F.lit("pairs").alias("tbl"), "ord", F.col("response").alias("text")))
    return a.unionByName(b)


def found_lines(docs: DataFrame, pairs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``tbl, ord, line_no`` of each line on which a credential starts. Null and empty texts have
    none; repeated rows come out each; other columns are ignored."""
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            tbl, ords, lines = [], [], []
            for t, o, text in zip(*(b.column(i).to_pylist() for i in range(3))):
                if got := spans(text, vocabulary):
                    for n in line_numbers(text, got):
                        tbl.append(t)
                        ords.append(o)
                        lines.append(n)
            yield pa.RecordBatch.from_arrays([pa.array(tbl, pa.string()), pa.array(ords, pa.int64()), pa.array(lines, pa.int64())], ["tbl", "ord", "line_no"])

    return _texts(docs, pairs).mapInArrow(run, "tbl string, ord bigint, line_no bigint")


def redacted(docs: DataFrame, pairs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``tbl, ord, text``: the rows that hold credentials, with these masked."""
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(2).to_pylist()
            new = [redact(t, vocabulary) for t in texts]
            keep = pa.array([x != y for x, y in zip(texts, new)], pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(new, pa.string())], ["tbl", "ord", "text"]).filter(keep)

    return _texts(docs, pairs).mapInArrow(run, "tbl string, ord bigint, text string")

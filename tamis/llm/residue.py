"""Problem 10: template residue, filler, error pages and notices in place of content.

One automaton with all phrases, over several languages, runs once over a document. A block
(paragraph or line) of which matched phrases cover most is residue; a phrase that a longer text
merely quotes covers too little. Sentences with placeholders outside code and paragraphs of filler are
residue too, filler being told by what it lacks: it has no function words and repeats itself. A document
is excluded when its residue is a notable share of its length.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

from pyspark.sql import DataFrame

from tamis.llm.answers import FUNCTION
from tamis.plans.runtime import spread

#: Share of a block's characters (names, numbers and addresses aside) that phrases must cover.
COVERED = 0.55
#: Share of a document's characters that must be residue.
EXCLUDED = 0.02
#: Share of a block's words that must be filler Latin, and the least such words.
LATIN_SHARE, LATIN_WORDS = 0.6, 4
#: Filler without known words: least words, most function words, least words with Latin endings, most distinct words.
FILLER_WORDS, FILLER_FUNCTION, FILLER_ENDINGS, FILLER_DISTINCT = 12, 0.04, 0.75, 0.85

#: What servers, sites and templates show.
ERRORS = [
    "not found", "page not found", "file not found", "bad request", "unauthorized", "payment required", "forbidden", "method not allowed", "request timeout", "request time-out", "gone", "too many requests",
    "internal server error", "server error", "bad gateway", "service unavailable", "service temporarily unavailable", "gateway timeout", "gateway time-out", "access denied", "permission denied",
    "you do not have permission to open", "you don't have permission to access", "on this server", "the page you asked for could not be shown", "the page you requested could not be found", "the page you are looking for", "does not exist", "could not be found", "has been moved or deleted",
    "go back to the start page or try the search", "go back to the start page", "oops", "something went wrong on our side", "something went wrong", "please reload the page in", "please reload the page", "please try again later", "please try again", "try again later", "minutes", "seconds",
    "the team has been told about it", "failed to render template", "traceback", "an error occurred while processing your request", "an unexpected error occurred", "an error has occurred", "application error", "a client-side exception has occurred", "fatal error",
    "this repository is not available", "it may have been moved, renamed or made private", "this page isn't available", "this content is not available", "we are down for maintenance", "down for maintenance", "under maintenance", "will be back in", "we'll be back soon",
    "you have gone over the request limit for your address", "rate limit exceeded", "request limit exceeded", "and try again", "wait", "upstream connect error or disconnect before headers", "upstream connect error", "reset reason", "connection refused", "connection timed out", "database connection failed", "error establishing a database connection", "error establishing a connection to the", "database", "error code", "error", "status", "ray id", "request id", "incident id", "reference id", "no healthy upstream", "timeout", "if this goes on", "if the problem persists", "if this persists", "write to the administrators of", "write to the administrator", "contact the administrator", "contact your administrator", "contact support",
    "seite nicht gefunden", "die adresse", "gibt es auf", "nicht mehr", "fehler", "interner serverfehler", "zugriff verweigert", "die seite wurde nicht gefunden", "dienst nicht verfügbar",
    "page introuvable", "la page", "n'existe plus", "n'existe pas", "erreur", "erreur interne du serveur", "accès refusé", "service indisponible",
    "página no encontrada", "la página", "ya no existe", "no existe", "acceso denegado", "error interno del servidor", "servicio no disponible",
    "página não encontrada", "a página", "já não existe", "não existe", "não existe mais", "acesso negado", "erro interno do servidor", "erro", "serviço indisponível",
    "страница не найдена", "страница", "больше не существует", "не существует", "доступ запрещён", "доступ запрещен", "внутренняя ошибка сервера", "ошибка", "сервис недоступен",
]
NOTICES = [
    "please enable javascript to view this page", "please enable javascript", "enable javascript", "to view this page", "to continue", "you need to enable javascript to run this app", "you need to switch on javascript to run this app", "javascript is required", "javascript is disabled", "javascript is not enabled", "this site requires javascript", "this site needs scripts to run", "turn them on in your browser settings and reload", "your browser does not support",
    "your browser is out of date and cannot show this page", "please update your browser", "please upgrade your browser", "loading...", "loading", "please wait", "if nothing happens, scripts may be blocked", "checking your browser before you go on", "checking your browser before accessing", "this can take up to", "just a moment",
    "we use cookies to make this site better", "this site uses cookies", "we use cookies", "accept all", "reject all", "settings", "cookie settings", "by continuing to use this site you agree", "sign in to continue", "log in to continue", "please log in", "please sign in", "you must be logged in to read this thread", "you must be logged in", "subscribe to continue reading", "create a free account to continue",
    "are you a robot?", "are you human?", "tick the box to show that you are human", "verify you are human", "verify that you are human", "please complete the captcha", "complete the security check",
    "bitte aktivieren sie javascript", "um diese seite zu sehen", "um fortzufahren", "bitte melden sie sich an", "diese seite verwendet cookies", "veuillez activer javascript", "pour continuer", "pour afficher cette page", "veuillez vous connecter", "ce site utilise des cookies",
    "active javascript", "activa javascript", "habilite javascript", "habilita javascript", "por favor", "para ver esta página", "para continuar", "ative o javascript", "ative javascript", "inicia sesión", "inicie sessão", "este sitio utiliza cookies", "este site usa cookies",
    "включите javascript", "пожалуйста, включите javascript", "чтобы продолжить", "для просмотра этой страницы", "чтобы увидеть эту страницу", "войдите, чтобы продолжить", "сайт использует cookie",
]
FILLERS = [
    "coming soon", "text goes here", "your text here", "your text goes here", "content goes here", "description goes here", "title goes here", "add your content here", "add your text here", "add content here", "insert text here", "sample text", "placeholder text", "placeholder copy", "final text to follow", "text to follow", "replace this text with your own", "replace this text", "dummy text", "this is a placeholder", "under construction", "this section is a stub", "click to edit", "enter your text", "lorem ipsum",
]
#: Parts of notices and errors; their combinations are phrases too.
_SWITCH = ["enable", "turn on", "switch on", "activate", "allow", "re-enable"]
_SCRIPTS = ["javascript", "java script", "scripts", "cookies", "javascript and cookies", "cookies and javascript"]
_WHERE = ["in your browser", "in your web browser", "in your browser settings", "and reload", "and try again", "and reload the page", "and refresh the page"]
_AIM = ["to proceed", "to continue", "to view this page", "to see this page", "to use this site", "to use this website", "to view this content", "to run this app", "before you continue", "before continuing", "before proceeding"]
NOTICES += [f"{p}{a} {b}" for p in ("please ", "") for a in _SWITCH for b in _SCRIPTS]
NOTICES += [f"{a} {b}" for a in _SCRIPTS[:3] for b in ("must be enabled", "is required", "are required", "is needed", "has to be enabled", "needs to be enabled", "is turned off", "is switched off", "seems to be disabled", "appears to be disabled", "is disabled in your browser")]
_THING = ["page", "file", "document", "resource", "site", "content", "item", "article", "post", "url", "link", "requested url", "requested page", "requested resource", "requested document", "page you requested", "page you were looking for", "page you are trying to reach"]
_GONE = ["could not be located", "cannot be found", "can't be found", "was not found", "is not found", "no longer exists", "has been removed", "has been deleted", "is no longer available", "is unavailable", "is temporarily unavailable", "is currently unavailable", "does not seem to exist", "doesn't exist", "was not found on this server", "has moved", "has expired"]
ERRORS += [f"{p}{a} {b}" for p in ("this ", "the ", "sorry, this ", "sorry, the ", "") for a in _THING for b in _GONE]
ERRORS += [f"{a} {b}" for a in ("we couldn't find", "we could not find", "we can't find", "unable to find", "cannot find") for b in ("that page", "this page", "the page", "the page you requested", "the page you were looking for", "what you were looking for")]
ERRORS += ["the requested url", "was not found on this server", "the requested resource", "the server encountered an internal error or misconfiguration and was unable to complete your request", "your browser sent a request that this server could not understand", "the server is temporarily unable to service your request due to maintenance downtime or capacity problems"]
NOTICES += ["verifying you are human", "verifying that you are human", "this may take a few seconds", "needs to review the security of your connection before proceeding", "review the security of your connection", "checking if the site connection is secure", "performance and security by", "you have been blocked", "your request has been blocked", "unusual traffic from your computer network", "your session has expired", "session expired", "subscribe to read", "this content is for subscribers only", "already a subscriber?", "view in browser", "you are using an outdated browser"]
ERRORS += [
    "pagina non trovata", "la pagina richiesta non esiste", "la pagina non esiste", "impossibile trovare la pagina", "errore interno del server", "accesso negato", "servizio non disponibile", "pagina niet gevonden", "deze pagina bestaat niet", "toegang geweigerd", "nie znaleziono strony", "strona nie została znaleziona", "strona nie istnieje", "odmowa dostępu", "sidan kunde inte hittas", "siden blev ikke fundet", "sivua ei löytynyt", "sayfa bulunamadı", "halaman tidak ditemukan", "stránka nenalezena", "pagina nu a fost găsită",
    "ページが見つかりません", "お探しのページは見つかりませんでした", "ページが存在しません", "アクセスが拒否されました", "サーバーエラー", "页面不存在", "找不到页面", "页面未找到", "无法访问此网站", "您访问的页面不存在", "服务器错误", "페이지를 찾을 수 없습니다", "접근이 거부되었습니다", "الصفحة غير موجودة", "הדף לא נמצא", "η σελίδα δεν βρέθηκε", "पृष्ठ नहीं मिला", "ไม่พบหน้า",
]
NOTICES += ["abilita javascript", "attiva javascript", "per continuare", "schakel javascript in", "om door te gaan", "włącz javascript", "aby kontynuować", "aktivera javascript", "för att fortsätta", "javascriptを有効にしてください", "続行するには", "请启用javascript", "请开启javascript", "자바스크립트를 활성화", "javascript'i etkinleştirin", "aktifkan javascript"]
#: Phrases that say nothing alone: they only help to cover a block with others.
WEAK = {"the requested url", "the requested resource", *(f"{a} {b}" for a in _SWITCH for b in _SCRIPTS if (a, b) != ("enable", "javascript")), *(f"{a} {b}" for a in _THING for b in _GONE), *(f"the {a} {b}" for a in _THING for b in _GONE), "per continuare", "om door te gaan", "aby kontynuować", "för att fortsätta", "続行するには", "view in browser", "database", "minutes", "seconds", "wait", "and try again", "status", "error", "error code", "settings", "to continue", "to view this page", "die adresse", "la page", "a página", "la página", "gibt es auf", "nicht mehr", "no existe", "não existe", "n'existe pas", "não existe mais", "does not exist", "gone", "por favor", "on this server", "could not be found", "timeout", "loading", "fehler", "erreur", "erro", "ошибка", "страница", "не существует", "traceback", "oops", "request id", "reference id", "ray id", "reset reason", "please wait", "pour continuer", "para continuar", "um fortzufahren", "чтобы продолжить", "server error", "unauthorized", "forbidden", "not found", "fatal error", "permission denied"}
#: Words of filler Latin.
LATIN = frozenset(
    "lorem ipsum dolor sit amet consectetur consectetuer adipiscing adipisicing elit sed eiusmod tempor incididunt labore dolore magna aliqua enim minim veniam quis nostrud exercitation ullamco laboris nisi aliquip commodo consequat duis aute irure reprehenderit voluptate velit esse cillum fugiat nulla pariatur excepteur sint occaecat cupidatat proident culpa officia deserunt mollit anim laborum".split()
)
#: Placeholders of common template languages.
PLACEHOLDER = re.compile(
    r"\{\{\{?\s*[\w][\w .|-]*\}?\}\}|<%[=-]?\s*[\w.@ ]+\s*-?%>|\$\{[A-Z][A-Z0-9_]*\}|\[(?:insert|your|enter|add) [^\]\n]{1,50}\]|\bTODO: (?:write|add|insert|describe|fill in) (?:the |your |an? )?\w+"
    r"|(?<!\w)__[A-Z][A-Z0-9_]*__(?!\w)|(?<![\w%])%[A-Z][A-Z0-9_]{2,}%(?![\w%])|<(?:your|insert|enter)[ _-][\w -]{2,40}>|@@[A-Z][A-Z0-9_]+@@|\b(?:YOUR|INSERT|ENTER|ADD)(?: [A-Z0-9]+){1,4} HERE\b|#[A-Z][A-Z0-9_]{3,}#|%\([a-z_]+\)s|\[\[[A-Za-z][\w ]*\]\]"
)
#: Placeholders that other text uses too; two of them in one text are needed.
LOOSE = re.compile(r"(?<![\w$\"'{}^_\\])\{\d\}(?![\"'{}])|\[(?!(?:INFO|WARN|WARNING|ERROR|DEBUG|FATAL|TRACE|NOTE|TODO|PATCH|RFC|WIP|DONE|OK|FAIL|PASS|YES|NO)\])[A-Z]{3,}(?: [A-Z0-9]+)*\](?![(\[:])|(?<![\w\\$}\"'])\{[a-z][a-z0-9_ ]*\}(?![\"'}\w])|(?<!\w)\$[A-Z][A-Z0-9]*_[A-Z0-9_]+\b|<[a-z]+(?:[_ -][a-z0-9]+)+>|<[A-Z]{4,}(?: [A-Z0-9]+)*>|<[A-Z]{3,}(?: [A-Z0-9]+)+>")
SALUTATION = re.compile(r"\s*(?:dear|hi|hello|hey|hallo|liebe[r]?|sehr geehrte[r]?|bonjour|cher|chère|hola|estimad[oa]|olá|prezad[oa]|ciao|gentile)\b", re.I)
#: What people type to fill a field.
KEYS = frozenset("foo bar baz qux quux asdf asdfg asdfgh qwer qwert qwerty blah bla test testing xxx yyy zzz hjkl zxcv jkl abc xyz".split())
OPENERS = ["{{", "<%", "${", "[insert", "[your", "[enter", "[add", "todo: ", "__", "%", "<your", "<insert", "<enter", "@@", "[[", " here", "#"]
FENCED = re.compile(r"^[ \t]*(```|~~~).*?(?:^[ \t]*\1[ \t]*$|\Z)", re.S | re.M)
INLINE = re.compile(r"`[^`\n]*`")
CODE_LINE = re.compile(r"^\s*(?://|/\*|\*\s|#include|#define|--\s|const |let |var |func |def |return\b|if |for |import |package |export |public |private |static |type |class |\$ )|[;{}]\s*$|:=|[\w\])] = \S|\w\([^)]*\)\s*$|=>")
VARIABLE = re.compile(r"https?://\S+|\b[\w-]+(?:\.[\w-]+)*\.(?:example|com|org|net|io)\b\S*|(?<!\w)/[\w./-]+|'[\w.-]+\.html?'|\b[0-9a-f]{8,}\b|\b[\w-]+/\d+(?:\.\d+)+|\d+(?:\.\d+)*|[()|:.,;!?\"'{}\[\]…-]+")
STATUS = re.compile(r"(?<!\d)[45]\d\d(?!\d)")
TAG = re.compile(r"<(?:/?[a-zA-Z][\w-]*(?:\s[^<>]*)?|!--.*?--|!DOCTYPE[^<>]*)/?>", re.S)


@lru_cache(maxsize=1)
def automaton():
    """All phrases in one automaton; its values are (length, weak, kind)."""
    import ahocorasick

    a = ahocorasick.Automaton()
    for p in [*ERRORS, *NOTICES, *FILLERS, *_WHERE, *_AIM]:
        a.add_word(p, (len(p), p in WEAK or p in _WHERE or p in _AIM))
    a.make_automaton()
    return a


def may_be_filler(low: str) -> bool:
    """Some paragraph of plain words begins without any function word."""
    return any(len(w := re.findall(r"[a-z]+", b[:200])) >= FILLER_WORDS and not _FUNCTION.intersection(w[:-1]) for b in low.split("\n\n") if len(b) >= 5 * FILLER_WORDS)


@lru_cache(maxsize=1)
def sieve():
    """What any residue must hold: a phrase, an opener of a placeholder, or a filler word."""
    import ahocorasick

    a = ahocorasick.Automaton()
    for p in {*ERRORS, *NOTICES, *FILLERS, *OPENERS, *LATIN, *KEYS} - WEAK:
        a.add_word(p, p)
    a.make_automaton()
    return a


def _word_at(s: str, i: int, j: int) -> bool:
    """s[i:j] isn't cut out of a longer word."""
    return not ((i and s[i].isalnum() and s[i - 1].isalnum()) or (j < len(s) and s[j - 1].isalnum() and s[j].isalnum()))


def coverage(block: str) -> tuple[float, bool]:
    """Share of a block that phrases cover, variable parts aside, and whether a strong one is there."""
    s = " ".join(block.lower().replace("’", "'").split())
    spans, strong = [], False
    for end, (n, weak) in automaton().iter(s):
        i, j = end - n + 1, end + 1
        if _word_at(s, i, j):
            spans.append((i, j))
            strong |= not weak
    if not spans:
        return 0.0, False
    hit = bytearray(len(s))
    for i, j in spans:
        hit[i:j] = b"\1" * (j - i)
    free = bytearray(len(s))
    for m in VARIABLE.finditer(s):
        free[m.start() : m.end()] = b"\1" * (m.end() - m.start())
    letters = [k for k in range(len(s)) if hit[k] or not free[k] and s[k] != " "]
    inked = [k for k in letters if s[k] != " "]
    return (sum(hit[k] for k in inked) / len(inked) if inked else 0.0), strong


def is_latin(block: str) -> bool:
    words = re.findall(r"[^\W\d_]+", block.lower())
    n = sum(w in LATIN for w in words)
    if n >= LATIN_WORDS and n >= LATIN_SHARE * len(words):
        return True
    return len(words) >= 8 and sum(w in KEYS for w in words) >= 0.9 * len(words)


_FUNCTION = frozenset().union(*FUNCTION.values())
_ENDINGS = re.compile(r"(?:[aeiou]|[aeiou][smtrx]|[au]nt|ent|il|io)$")
_PLAIN = re.compile(r"[^a-zA-Z\s.,;:!?'-]")


def is_filler(block: str) -> bool:
    """Made-up Latin, whatever its words: plain letters, no function word of any language known here,
    mostly Latin endings, and fewer distinct words than real prose has."""
    if _PLAIN.search(block):
        return False
    words = re.findall(r"[a-z]+", block.lower())
    if len(words) < FILLER_WORDS or sum(w in _FUNCTION for w in words) > FILLER_FUNCTION * len(words):
        return False
    return sum(bool(_ENDINGS.search(w)) for w in words) >= FILLER_ENDINGS * len(words) and (len(words) < 20 or len(set(words)) <= FILLER_DISTINCT * len(words))


SENTENCE = re.compile(r"[^.!?\n]*(?:[.!?]+(?=\s|$)|\n|$)|[.!?]+")


def _sentence(line: str, at: int) -> int:
    """Characters of the sentence that holds a place of a line."""
    return next((len(m.group().strip()) for m in SENTENCE.finditer(line) if m.start() <= at < m.end()), len(line))


def placeholder_chars(prose: str, text: str) -> int:
    """Characters of the sentences that hold an unfilled placeholder, outside lines of code. One of a form that
    other text uses too counts only with a second one, or in a salutation."""
    total, loose = 0, []
    sure, maybe = PLACEHOLDER.search(prose), LOOSE.search(prose)
    for x in prose.split("\n") if sure or maybe else ():
        if sure and (m := PLACEHOLDER.search(x)) and not CODE_LINE.search(PLACEHOLDER.sub("x", x)):
            total += _sentence(x, m.start())
        if maybe and LOOSE.search(x) and not CODE_LINE.search(LOOSE.sub("x", x)):
            found = [m for m in LOOSE.finditer(x) if f"</{m.group()[1:-1]}>" not in text]
            loose += [(_sentence(x, m.start()), bool(SALUTATION.match(x))) for m in found]
    if len(loose) > 1 or any(greets for _, greets in loose):
        total += sum(n for n, _ in loose)
    return total


def block_chars(b: str, short: bool) -> int:
    """Characters of a paragraph that are an error, a notice or filler: all of it, or some of its lines."""
    if b.startswith("{"):
        try:
            v = json.loads(b)
            if isinstance(v, dict) and any(isinstance(x, (int, str)) and re.fullmatch(r"[45]\d\d", str(x)) for x in v.values()) and any(isinstance(x, str) and coverage(x)[0] > COVERED for x in v.values()):
                return len(b)
        except ValueError:
            pass
    if is_latin(b) or is_filler(b):
        return len(b)
    plain = TAG.sub(" ", b) if "<" in b else b
    got, strong = coverage(plain)
    if not got:
        return 0
    lines = plain.split("\n")
    if got >= COVERED and (strong or short and STATUS.search(b)) and not any(CODE_LINE.search(x) for x in lines):
        return len(b)
    total = 0
    for x in lines:
        if len(x) >= 8 and not CODE_LINE.search(x) and not re.match(r"\s*(?:#|//|\*)\s", x):
            got, strong = coverage(x)
            if got >= max(COVERED, 0.8) and strong:
                total += len(x)
    return total


def residue_chars(text: str) -> int:
    """Characters of a text that are what a template, server or site showed instead of content."""
    text = text.replace("\r\n", "\n").replace("\r", "\n")
    prose = INLINE.sub(" ", FENCED.sub("\n\n", text))
    total = placeholder_chars(prose, text)
    for block in re.split(r"\n\s*\n", prose):
        if b := block.strip():
            total += block_chars(b, len(text) < 200)
    return total


def is_residue(text: str | None) -> bool:
    """Residue is at least EXCLUDED of the text: content that merely holds a notice among much else stays."""
    if not text or not text.strip():
        return False
    low = text.lower()
    if next(sieve().iter(low), None) is None and not STATUS.search(low) and not LOOSE.search(text) and not may_be_filler(low):
        return False
    return residue_chars(text) >= EXCLUDED * len(text.strip())


def residue(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` of the documents to exclude. Null, empty and blank texts are none; repeated
    rows are kept; other columns are ignored."""
    import pyarrow as pa

    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array([is_residue(t) for t in b.column(1).to_pylist()], pa.bool_())).select([0])

    return spread(docs.select(docs[id_col].alias("k"), docs[text_col].alias("t"))).mapInArrow(run, f"k {kind}").withColumnRenamed("k", id_col)

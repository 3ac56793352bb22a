"""Problem 1: pairs whose response is empty, a refusal, an echo, cut off or in another language.

Copies are told by shingle containment and the longest common subsequence of the tokens of
prompt and response, refusals by aligning the sentences with refusal templates, the rest by
rules on the end of the text and on the languages of both sides: the script where it tells the
language, else the frequent short words of sixteen languages.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

from pyspark.sql import DataFrame

from tamis.plans.runtime import spread

#: Share of the response's tokens that the instruction must cover, longest stretch it may not
#: cover, and share of the instruction that must come back, for an echo.
ECHO_COVERED, ECHO_GAP, ECHO_BACK = 0.7, 6, 0.5
#: Share of a refusal template's tokens that must align with a sentence, in order.
ALIGNED = 0.8
#: Most words that a refusing response has beside refusing sentences.
REFUSAL_REST = 5

#: What stands for no answer.
NOTHING = frozenset("n/a na none null nil empty no_response no_answer no_output undefined nan tbd todo tba unknown_answer -".split()) | {"no response", "no answer", "no output", "empty", "not available", "left blank", "blank", "response", "no content", "no text", "answer", "n a"}
#: Sentences that refuse, as token patterns ("*" stands for any word).
REFUSALS = [
    "i can't help with", "i cannot help with", "i can't help you with", "i am unable to help", "i'm unable to help", "i can't assist with", "i cannot assist with", "i can't provide", "i cannot provide", "i can't do that", "i cannot do that", "i can't answer", "i cannot answer", "i can't comply", "i cannot comply", "i can't fulfill", "i cannot fulfill",
    "i won't be able to assist", "i won't be able to help", "i won't help", "i will not help", "i will not provide", "i will not answer", "i won't answer", "i won't provide", "i'm unable to review", "i'm unable to", "i am unable to", "i am not able to write that", "i am not able to", "i'm not able to", "i cannot provide code for", "i can't write", "i cannot write", "i don't feel comfortable", "i do not feel comfortable", "i'm not comfortable", "i am not comfortable", "i would rather not", "i'd rather not", "i prefer not to",
    "my guidelines keep me from", "my guidelines do not allow", "my guidelines prevent me", "against my guidelines", "that goes beyond what i may do", "this goes beyond what i", "beyond what i can do", "it is not possible for me to", "it's not possible for me to", "not something i can help with", "this is something i have to refuse", "something i must refuse", "i have to refuse", "i must refuse", "i refuse to", "i must decline", "i have to decline", "i decline to", "i am not allowed to", "i'm not allowed to", "i am not permitted to",
    "das kann ich leider nicht", "dabei kann ich nicht helfen", "dabei kann ich leider nicht", "kann ich leider nicht helfen", "ich kann ihnen nicht helfen", "ich kann nicht helfen", "ich kann diese anfrage nicht", "ich muss ablehnen", "muss ich ablehnen", "ich darf nicht", "darf ich nicht", "tut mir leid ich kann", "es tut mir leid aber", "möchte ich nicht beantworten",
    "je dois refuser", "il m'est impossible", "je ne peux pas aider", "je ne peux pas vous aider", "je ne peux pas répondre", "je ne peux pas", "je ne suis pas en mesure", "désolé mais je ne", "je ne suis pas autorisé", "je préfère ne pas",
    "no puedo ayudar", "no puedo responder", "no me es posible", "no puedo proporcionar", "tengo que rechazar", "debo rechazar", "debo negarme", "no estoy autorizado", "prefiero no responder", "lo siento no puedo", "lo siento pero no",
    "não posso ajudar", "não posso responder", "não me é possível", "não posso fornecer", "tenho de recusar", "devo recusar", "tenho que recusar", "não estou autorizado", "prefiro não responder", "não consigo ajudar",
    "я не могу помочь", "я не могу ответить", "не могу помочь с", "не могу ответить", "отвечать на * * * мне нельзя", "мне нельзя", "я вынужден отказать", "вынужден отказаться", "я должен отказать", "не имею права", "не могу выполнить", "я не вправе",
]
#: What a refusing sentence begins with, and what it refuses; templates are their products.
_UNWILLING = ["i can't", "i cannot", "i can not", "i could not possibly", "i am unable to", "i'm unable to", "i'm not able to", "i won't", "i will not", "i'm not going to", "i am not going to", "i shouldn't", "i should not", "i don't think i should", "i'm not willing to", "i have been told not to", "i choose not to", "we can't", "we cannot", "we are unable to"]
_REFUSED = ["help", "assist", "support", "answer", "respond", "provide", "give you", "write", "generate", "produce", "create", "do that", "do this", "review", "discuss", "explain", "share", "comply", "fulfil", "process", "take part", "go into", "talk about", "advise", "engage"]
REFUSALS += [f"{a} {b}" for a in _UNWILLING for b in _REFUSED]
REFUSALS += [
    "outside what i can", "outside the scope of what i", "this request is outside", "i have to pass on this", "i will pass on this", "i'm going to pass on", "i have to say no", "the answer is no", "as an ai language model i", "against our policy", "violates our policy", "goes against policy", "would not be appropriate for me", "wouldn't be appropriate for me", "not something i can do", "not something i'm willing", "i am prevented from", "i'm prevented from", "please ask someone else", "this is not a task i can",
    "non posso aiutare", "non posso rispondere", "non sono in grado di", "devo rifiutare", "preferisco non", "ik kan niet helpen", "ik kan je niet helpen", "ik kan u niet helpen", "ik moet weigeren", "nie mogę pomóc", "nie mogę odpowiedzieć", "muszę odmówić", "jag kan inte hjälpa", "jeg kan ikke hjælpe", "yardımcı olamam",
]
#: Words one of which every refusing sentence holds.
REFUSING = ["can not", "could not possibly", "not going to", "shouldn't", "should not", "not willing", "told not to", "choose not", "outside what", "outside the scope", "is outside", "pass on", "say no", "answer is no", "language model", "policy", "appropriate", "prevented", "someone else", "not a task", "non posso", "non sono", "rifiutare", "preferisco", "kan niet", "kan je niet", "kan u niet", "weigeren", "nie mogę", "odmówić", "kan inte", "kan ikke", "olamam", "can't", "cannot", "won't", "will not", "unable", "not able", "comfortable", "rather not", "prefer not", "guidelines", "beyond what", "not possible", "not something", "refuse", "declin", "not allowed", "not permitted", "kann ich", "ich kann", "ablehnen", "darf", "möchte ich nicht", "refuser", "impossible", "ne peux", "ne suis", "préfère", "no puedo", "no me es", "rechazar", "negarme", "autorizad", "prefiero", "lo siento", "não posso", "não me", "recusar", "não estou", "prefiro", "não consigo", "не могу", "нельзя", "вынужден", "должен отказ", "не имею", "не вправе"]
#: Sentences that go with a refusal and answer nothing.
COURTESY = re.compile(
    r"^(?:you ask(?:ed)? about|i hope you understand|is there anything else|please (?:ask|consult|contact)|let me know if|such an? .{1,60}(?:might|could|may) be|questions about|thanks for|thank you|i'?m sorry|sorry|i apologi[sz]e|unfortunately|feel free|if you have (?:a|any) (?:different|other)|you may want to|consider (?:asking|consulting)|bitte|es tut mir|désolé|je suis désolé|lo siento|lamento|desculpe|извините|простите|к сожалению)",
    re.I,
)
#: A greeting or a closing word around a text.
GREETING = re.compile(r"^\s*(?:(?:hi|hello|hey|ok|okay|sure|well|hmm|please note|note|dear all|good day|so|hallo|bonjour|hola|olá|привет)\b(?: there| all| team)?\s*[,.:!;-]+\s*)+", re.I)
CLOSING = re.compile(r"[\s,.]*\b(?:thanks(?: a lot| in advance)?|thank you|cheers|best regards|regards|bye|danke|merci|gracias|obrigad[oa]|спасибо)\s*[.!]*\s*$", re.I)

#: Frequent short words of each language.
FUNCTION = {
    "en": "the of and to is in that with for by only from has have on when it into its are was were be will would can could should this these which while must not or if but there because so before after both each than then they we you how what why do does an a at as use using my our your",
    "de": "der die das und ist nicht den dem des mit wird werden ein eine einen einer wenn nach zu zum auf sie wir haben hat bitte dass weil sonst muss selbst am im von für wie danach oft noch einmal ohne können zuerst hier darf sich auch aber oder durch bei aus es ich",
    "fr": "le la les et est une un des du pas que qui dans pour sur il faut nous avons quand après doit sont ce cette parce avec par sans plus ou mais à au aux ne se son sa ses lui puis comme être alors elle fois",
    "es": "el la los las y es una un no que para por se del con hay tras cuando hemos al sin porque después debe solo pero como su sus lo vuelve antes aquí más cómo qué ser está quien cuenta",
    "pt": "o os a as e é uma um não que para por se do da dos das com depois quando no na num sem ao porque só deve ser mas como seu sua também já antes aqui mais fica isso está pelo novamente",
}
#: Further languages; words that one above has too don't speak for them.
FUNCTION |= {
    "it": "il lo gli di che è sono per nel nella della delle degli con non si ma anche quando dopo prima ogni senza questo questa viene perché più deve può essere già poi ancora solo sempre dal alla allo",
    "nl": "het een van en niet dat zijn wordt worden met voor op aan ook als maar deze dit naar bij nog uit moet kan heeft hebben omdat wanneer zonder geen altijd eerst daarna dan wel door om er",
    "pl": "nie się jest że na do to jak ale przez przed po gdy kiedy są być może tylko także oraz jego ich który która które już tak dla od bez musi zawsze potem czy",
    "cs": "není je že se na to jak ale před po když jsou být může pouze také jeho jejich který která které už tak pro od bez musí vždy potom nebo při aby jen",
    "sv": "och att det som är inte på med för av den till har kan om eller när från ska måste bara också efter innan alltid utan vid denna detta blir då så",
    "da": "og at det som er ikke på med af den til har kan eller når fra skal kun også efter før altid uden ved denne dette bliver hvis være deres",
    "fi": "ja on ei se että kun mutta myös tai jos niin ovat joka sen ne voi vain ennen jälkeen aina ilman kuin mukaan pitää tämä nämä sitten vielä",
    "tr": "ve bir bu için ile değil olarak gibi daha sonra önce ise ancak her çok kadar olan var yok ya da ne zaman eğer sadece tarafından",
    "id": "dan yang di ke dari untuk dengan tidak ini itu adalah akan pada juga atau dapat harus jika ketika setelah sebelum hanya sudah oleh tanpa setiap",
    "ro": "și este nu să cu pe care pentru din sunt dar când după înainte fiecare fără acest această poate trebuie doar mai fi prin dacă sau lui",
}
_OWNED: dict[str, str] = {}
for _k, _v in FUNCTION.items():
    for _w in _v.split():
        _OWNED.setdefault(_w, _k)
FIRST = ("en", "de", "fr", "es", "pt")
FUNCTION = {k: frozenset(w for w in v.split() if k in FIRST or _OWNED[w] not in FIRST) for k, v in FUNCTION.items()}
#: Scripts that tell the language, as first and last code points.
SCRIPTS = {"ru": [(0x400, 0x4FF)], "el": [(0x370, 0x3FF)], "he": [(0x590, 0x5FF)], "ar": [(0x600, 0x6FF)], "hi": [(0x900, 0x97F)], "th": [(0xE00, 0xE7F)], "ko": [(0xAC00, 0xD7A3), (0x1100, 0x11FF)], "ja": [(0x3040, 0x30FF)], "zh": [(0x4E00, 0x9FFF), (0x3400, 0x4DBF)]}
SPEAKS: dict[str, list[int]] = {}
for _k, _words in enumerate(FUNCTION.values()):
    for _w in _words:
        SPEAKS.setdefault(_w, []).append(_k)
#: Names of the languages, as they are called in each of them.
LANGUAGE_NAMES = {
    "en": r"english|englisch\w*|anglais\w*|ingl[eé]s\w*|inglesa|английск\w*|по-английски",
    "de": r"german|deutsch\w*|allemand\w*|alem[aá]n\w*|alemão|немецк\w*|по-немецки",
    "fr": r"french|französisch\w*|français\w*|franc[eé]s\w*|francês|французск\w*|по-французски",
    "es": r"spanish|spanisch\w*|espagnol\w*|español\w*|castellano|espanhol\w*|испанск\w*|по-испански",
    "pt": r"portuguese|portugiesisch\w*|portugais\w*|portugu[eé]s\w*|português|португальск\w*|по-португальски",
    "ru": r"russian|russisch\w*|russe|ruso|rusa|russo|russa|русск\w*|по-русски",
    "it": r"italian\w*|italien\w*|итальянск\w*",
    "nl": r"dutch|nederlands\w*|niederländisch\w*|néerlandais\w*|neerland[eé]s\w*|holandés|holandês|нидерландск\w*",
    "pl": r"polish|polnisch\w*|polsk\w*|polonais\w*|polac[oa]|polon[eê]s\w*|польск\w*",
    "cs": r"czech|tschechisch\w*|tchèque|checo|tcheco|česk\w*|чешск\w*",
    "sv": r"swedish|schwedisch\w*|suédois\w*|sueco|svenska|шведск\w*",
    "da": r"danish|dänisch\w*|danois\w*|danés|dinamarquês|dansk|датск\w*",
    "fi": r"finnish|finnisch\w*|finnois\w*|fin(?:land)?[eé]s|finlandês|suomeksi|финск\w*",
    "tr": r"turkish|türkisch\w*|turc|turco|türkçe|турецк\w*",
    "id": r"indonesian?|indonesisch\w*|indonésien\w*|indonesio|bahasa|индонезийск\w*",
    "ro": r"romanian|rumänisch\w*|roumain\w*|rumano|romeno|română|румынск\w*",
    "el": r"greek|griechisch\w*|grec|griego|grego|ελληνικ\w*|греческ\w*",
    "he": r"hebrew|hebräisch\w*|hébreu|hebreo|hebraico|עברית|иврит\w*",
    "ar": r"arabic|arabisch\w*|arabe|árabe|العربية|арабск\w*",
    "hi": r"hindi|हिन्दी|हिंदी|хинди",
    "th": r"thai|thailändisch\w*|thaï|tailandés|tailandês|ไทย|тайск\w*",
    "ko": r"korean|koreanisch\w*|coréen|coreano|한국어|корейск\w*",
    "ja": r"japanese|japanisch\w*|japonais\w*|japonés|japonês|日本語|японск\w*",
    "zh": r"chinese|mandarin|chinesisch\w*|chinois\w*|chino|chinês|中文|汉语|китайск\w*",
}
LANGUAGE_NAMES = {k: re.compile(rf"\b(?:{v})\b", re.I) for k, v in LANGUAGE_NAMES.items()}

TOKEN = re.compile(r"[^\W_]+(?:['’][^\W_]+)*")
LETTERS = re.compile(r"[^\W\d_]+")
FENCE_LINE = re.compile(r"^[ \t>]*(```|~~~)", re.M)
FENCED = re.compile(r"^[ \t>]*(```|~~~).*?(?:^[ \t>]*\1[ \t]*\r?$|\Z)", re.S | re.M)
INLINE = re.compile(r"`[^`\n]*`")
ADDRESS = re.compile(r"(?:[a-z]+://|www\.)\S+|\S+@\S+")
INVISIBLE = re.compile(r"[\s​‌‍⁠﻿­\x00-\x1f]+")
CODE_START = re.compile(r"^\s*(?://|/\*|#include\b|#!|package \w|import [\w{\"(']|from \w[\w.]* import\b|func\b.*[({]|type \w+ (?:struct|interface)|class \w+|def \w+\(|async def|export (?:default |const |function |class |async )|const \w+ =|let \w+ =|var \w+\b|public |private |static |fn \w+|@\w+|<\?php|SELECT\b|\{|\[)")
LIST_ITEM = re.compile(r"^\s*(?:[-*+•]|\d+[.)])(?:\s|$)")
ENDED = re.compile(r"[.!?…。！？][\"'”’»)\]*_`]*$|[\"”»)\]}>`;|]$")
#: Words that no finished text ends with.
DANGLING = frozenset("the a an and or of to in on with for by from that which such as so because if when while than into is are was were be has have not but its their this these those where who whose can could may might must will would should at der die das und oder mit von zu für auf dass weil wenn ein eine le la les et ou de des du pour avec que qui un une el los las y o con para por no del que si os e ou com do da um uma и в на с что если для не о по к".split())


def close_at(text: str) -> int:
    """Where a closing word begins, or the length of the text."""
    at = max(0, len(text) - 60)
    m = CLOSING.search(text, at)
    return m.start() if m else len(text)


def tokens(text: str) -> list[str]:
    text = text.lower()
    return TOKEN.findall(text.replace("’", "'") if "’" in text else text)


def common_subsequence(a: list[str], b: list[str]) -> int:
    """Length of the longest common subsequence, with bits of one integer as the matrix row."""
    where: dict[str, int] = {}
    for i, t in enumerate(a):
        where[t] = where.get(t, 0) | 1 << i
    row = mask = (1 << len(a)) - 1
    for t in b:
        m = where.get(t, 0) & row
        row = (row + m | row - m) & mask
    return len(a) - row.bit_count()


_TEMPLATES: dict[str, list[list[str]]] = {}


def _templates() -> dict[str, list[list[str]]]:
    """Refusal templates by each of their words, so that only those with two words in a sentence are aligned."""
    if not _TEMPLATES:
        for t in REFUSALS:
            seq = [x.replace("’", "'") for x in t.split()]
            for w in {x for x in seq if x != "*"}:
                _TEMPLATES.setdefault(w, []).append(seq)
    return _TEMPLATES


@lru_cache(maxsize=1)
def _refusing():
    import ahocorasick

    a = ahocorasick.Automaton()
    for w in REFUSING:
        a.add_word(w, w)
    a.make_automaton()
    return a


def may_refuse(text: str) -> bool:
    """A word that every refusing sentence holds stands in the text."""
    return next(_refusing().iter(text.lower().replace("’", "'")), None) is not None


def refuses(sentence: str) -> bool:
    """A refusal template aligns with the sentence, its words standing close together."""
    if not may_refuse(sentence):
        return False
    seq = tokens(sentence)
    seen: dict[int, tuple[int, list[str]]] = {}
    by_word = _templates()
    for w in set(seq):
        for t in by_word.get(w, ()):
            n, _ = seen.get(id(t), (0, t))
            seen[id(t)] = (n + 1, t)
    for n, t in seen.values():
        real = [x for x in t if x != "*"]
        if n < ALIGNED * len(set(real)):
            continue
        width = len(t) + 2
        for i in range(max(1, len(seq) - len(t) + 1)):
            if common_subsequence(real, seq[i : i + width]) >= ALIGNED * len(real) and (len(real) > 4 or all(x in seq[i : i + width] for x in real)):
                return True
    return False


SENTENCE = re.compile(r"(?<=[.!?…])\s+|\n+|;\s+")
#: Sentences that look like refusals but answer.
ANSWERS = re.compile(r"\b(?:can['’]?t|cannot|couldn['’]?t|could not) (?:reproduce|see|find|confirm|tell)\b.{0,200}\bbut\b", re.I)


def is_refusal(text: str) -> bool:
    if "```" in text or not may_refuse(text):
        return False
    rest, found = 0, False
    for s in SENTENCE.split(GREETING.sub("", text.strip())):
        s = s.strip()
        if not s:
            continue
        if ANSWERS.search(s):
            rest += len(tokens(s))
        elif refuses(s):
            found = True
            after = re.split(r"\b(?:but|instead|however)\b", s, maxsplit=1, flags=re.I)
            if len(after) > 1 and not refuses(after[1]) and refuses(after[0]) and len(tokens(after[1])) > 10:
                rest += len(tokens(after[1]))
        elif not COURTESY.match(s) and not (found and len(tokens(s)) < 4):
            rest += len(tokens(s))
    return found and rest <= REFUSAL_REST


def is_echo(instruction: str, response: str) -> bool:
    """The response is covered by the instruction's shingles or by an alignment with it."""
    if len(response) > 3 * len(instruction) + 80:
        return False
    b = tokens(response)
    a = tokens(instruction)
    known = set(a)
    if len([w for w in b if w in known]) < 0.6 * len(b):
        return False
    b = tokens(GREETING.sub("", response[: close_at(response)]))
    if len(b) < 3 or len(a) < 3:
        return bool(b) and len(b) > 1 and a == b
    shingles = set(zip(a, a[1:], a[2:]))
    covered = bytearray(len(b))
    own = list(zip(b, b[1:], b[2:]))
    back = set()
    for i, s in enumerate(own):
        if s in shingles:
            covered[i : i + 3] = b"\1\1\1"
            back.add(s)
    share = sum(covered) / len(b)
    if share < 0.3:
        return False
    gap = max((len(x) for x in bytes(covered).split(b"\1")), default=0)
    if share >= ECHO_COVERED and gap <= ECHO_GAP and len(back) >= ECHO_BACK * len(shingles):
        return True
    n = common_subsequence(a, b)
    return n >= 0.85 * len(b) and n >= 0.6 * len(a) and gap <= ECHO_GAP + 2


def script(text: str) -> tuple[str | None, int]:
    """The language that most letters' script tells, and how many letters are in it; kana makes Han Japanese."""
    if text.isascii():
        return None, 0
    letters, n = 0, dict.fromkeys(SCRIPTS, 0)
    for c in text:
        if c.isalpha():
            letters += 1
            if c > "\u036f":
                x = ord(c)
                for k, ranges in SCRIPTS.items():
                    if any(lo <= x <= hi for lo, hi in ranges):
                        n[k] += 1
                        break
    if n["ja"] > 0.1 * n["zh"]:
        n["ja"], n["zh"] = n["ja"] + n["zh"], 0
    best = max(n, key=n.get)
    return (best, n[best]) if n[best] > 0.4 * letters else (None, 0)


def language(text: str) -> tuple[str | None, int]:
    """The language of prose and how many words speak for it over the next one; of scripts that tell it,
    a word for every three letters."""
    told, letters = script(text)
    if told:
        return told, -(-letters // 3)
    words = LETTERS.findall(text.lower())
    if not words:
        return None, 0
    votes = [0] * len(FUNCTION)
    for w in words:
        for k in SPEAKS.get(w, ()):
            votes[k] += 1
    first, second = sorted(zip(votes, FUNCTION), reverse=True)[:2]
    return first[1], first[0] - second[0]


def prose(text: str) -> str:
    """The text without fenced and inline code, and without a text that is bare code."""
    text = GREETING.sub("", text) if "```" in text else text
    out = INLINE.sub(" ", FENCED.sub("\n", text)) if "`" in text or "~~~" in text else text
    if out.strip() and CODE_START.match(out.lstrip()) and re.search(r"[{};=]|\bdef\b|:\n", out):
        return ""
    return ADDRESS.sub(" ", out) if "@" in out or "://" in out or "www." in out else out


def is_other_language(instruction: str, response: str) -> bool:
    text = prose(response)
    lang, sure = language(text)
    if lang is None or sure < 3:
        return False
    asked, sure_asked = language(prose(instruction))
    if asked is None or sure_asked < 2 or asked == lang:
        return False
    return not LANGUAGE_NAMES[lang].search(instruction)


def is_truncated(response: str) -> bool:
    text = response.rstrip().rstrip("​‌‍﻿").rstrip()
    if text.count("```") % 2:
        return True
    if close_at(text) < len(text):
        return False
    text = GREETING.sub("", text)
    tail = FENCED.sub("\0", text).rsplit("\0", 1)[-1].strip() if "```" in text or "~~~" in text else text.strip()
    if not tail:
        return False
    body = tail
    if "```" not in text and CODE_START.match(body) and re.search(r"[{};=]|\bdef\b|:\n", body):
        bare = re.sub(r"\"(?:\\.|[^\"\\\n])*\"|'(?:\\.|[^'\\\n])*'|`[^`]*`|//[^\n]*|/\*.*?\*/", "", body, flags=re.S)
        if bare.count("{") > bare.count("}") or bare.count("(") > bare.count(")"):
            return True
        return bool(re.search(r"(?:[=,(+\-*&|]|\b(?:return|func|var|const|if|for|else))$", bare.rstrip()))
    last = tail.split("\n")[-1].strip()
    words = LETTERS.findall(last.lower())
    if LIST_ITEM.match(last):
        if re.fullmatch(r"(?:[-*+•]|\d+[.)])", last):
            return True
        return bool(re.search(r"[,:(–-]$", last)) or bool(words and last[-1].isalpha() and words[-1] in DANGLING)
    if ENDED.search(last):
        # "(see" and the like leave a bracket open
        return last.endswith((")", "]")) is False and last.count("(") > last.count(")") and last[-1] not in ".!?"
    if len(words) <= 3 and "\n" not in tail and (not words or words[-1] not in DANGLING) and not last.endswith((":", ",", "(")):
        return False
    return True


def is_empty(response: str | None) -> bool:
    if response is None:
        return True
    if len(response) > 60:
        return not any(c.isalnum() for c in response)
    bare = FENCE_LINE.sub(" ", response)
    bare = re.sub(r"(?<=\s)(?:go|golang|py|python|js|text|json|yaml)(?=\s)", " ", " " + bare + " ") if "```" in response or "~~~" in response else bare
    flat = INVISIBLE.sub(" ", bare).strip().lower().strip("\"'`()[]{}<>.…-–—*_:;,!?#/\\ ")
    if not any(c.isalnum() for c in flat):
        return True
    return flat in NOTHING


def defect(instruction: str | None, response: str | None) -> str | None:
    """The defect of a pair's response, or None."""
    if is_empty(response):
        return "empty"
    if is_refusal(response):
        return "refusal"
    if instruction and instruction.strip() and is_echo(instruction, response):
        return "echo"
    if is_truncated(response):
        return "truncated"
    if instruction and is_other_language(instruction, response):
        return "other_language"
    return None


def defective(pairs: DataFrame) -> DataFrame:
    """``ord, defect`` of the pairs with a defective response, one defect each.

    A null response is empty; without an instruction there is neither echo nor other_language;
    repeated rows come out each; other columns are ignored.
    """
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [defect(i, r) for i, r in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
            col = pa.array(got, pa.string())
            yield pa.RecordBatch.from_arrays([b.column(0), col], ["ord", "defect"]).filter(col.is_valid())

    return spread(pairs.select("ord", "instruction", "response")).mapInArrow(run, "ord bigint, defect string")

"""Shapes that the test tables don't have: residue, refusals and languages in other words."""

import random

import pytest

from tamis.llm import answers, residue

PROSE = "The cache is cleared before the lock is taken, so that no reader sees a stale entry while the writer runs. "


@pytest.mark.parametrize(
    "text",
    [
        "Not Found\n\nThe requested URL /index.php was not found on this server.\n\nApache/2.4.41 (Ubuntu) Server at host.example Port 80",
        "Please turn on JavaScript in your browser to proceed",
        "Verifying you are human. This may take a few seconds.",
        "Sorry, this page could not be located.",
        "Pagina non trovata",
        "お探しのページは見つかりませんでした。",
        "找不到页面",
        "Dear {first_name}, thank you for your order of the last week. It will be sent to you on Monday.",
        "We could not find the page you were looking for.",
        "JavaScript must be enabled to use this site.",
        "Strona nie została znaleziona",
        "Lorem ipsum dolor sit amet, consectetur adipiscing elit.",
    ],
)
def test_residue_in_other_words(text):
    assert residue.is_residue(text)
    assert not residue.is_residue(PROSE * 800 + "\n\n" + text)


def test_made_up_latin():
    rng = random.Random(4)
    words = ["".join(rng.choice(["ba", "do", "mi", "tu", "ver", "lan", "sor", "pel"]) for _ in range(rng.randint(1, 3))) + rng.choice(["us", "a", "um", "is", "it", "at", "or", "et"]) for _ in range(30)]
    text = " ".join((" ".join(rng.choices(words, k=9)).capitalize() + ".") for _ in range(6))
    assert residue.is_residue(text) and residue.is_residue(PROSE + "\n\n" + text)


@pytest.mark.parametrize(
    "text",
    [
        PROSE,
        "When a page could not be located, the handler returns 404 and logs the address, so that the client can try again.",
        "Gallia est omnis divisa in partes tres, quarum unam incolunt Belgae, aliam Aquitani, tertiam qui ipsorum lingua Celtae, nostra Galli appellantur.",
        "Muisti tyhjennetään ennen kuin lukko otetaan, jotta mikään lukija ei näe vanhaa arvoa kun kirjoittaja on käynnissä.",
        "Use `{{ name }}` in the template; the renderer fills it in when the message is sent, and fails when it is missing.",
        "Enable JavaScript only where you need it: scripts slow the page down and may be blocked by the reader's settings anyway.",
    ],
)
def test_texts_about_it_stay(text):
    assert not residue.is_residue(text)


INSTRUCTION = "Explain why the shared snapshot has to sample before the allocator is closed, and when it should be."


@pytest.mark.parametrize(
    "response",
    ["首先清空缓存，然后检查状态。每个请求只处理一次，因此顺序不会丢失。", "まずキャッシュを空にし、その後で状態を確認します。", "Prima viene svuotata la cache, poi il modulo controlla lo stato di ogni voce senza perdere l'ordine.", "Eerst wordt de cache geleegd, daarna controleert de module de toestand van elke invoer zonder het slot.", "Najpierw pamięć jest czyszczona, potem moduł sprawdza stan wpisów, ponieważ nie może się zmienić.", "먼저 캐시를 비우고 그다음 상태를 확인합니다."],
)
def test_many_languages(response):
    assert answers.defect(INSTRUCTION, response) == "other_language"
    assert answers.defect(INSTRUCTION + " Answer in Chinese, Japanese, Italian, Dutch, Polish or Korean.", response) is None


@pytest.mark.parametrize("response", ["I should not help with requests like this one.", "This request is outside what I can support here.", "I'm going to pass on this one, sorry.", "Sorry, we are unable to process that.", "I choose not to answer this.", "Non posso rispondere a questa domanda."])
def test_refusals_in_other_words(response):
    assert answers.defect(INSTRUCTION, response) == "refusal"


@pytest.mark.parametrize("response", ["I cannot reproduce the failure, but the lock is taken twice in the loop, and that is the cause.", "The policy is to take the lock first and to write the entry afterwards.", "Readers should not help themselves to the lock; they wait for the writer and then read the entry."])
def test_answers_that_look_like_refusals(response):
    assert answers.defect(INSTRUCTION, response) is None

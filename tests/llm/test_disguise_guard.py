"""Every disguise that can be rewritten is looked for, also alone in a text."""

from __future__ import annotations

import random

import pytest

from merchant_ledger.llm import pii


@pytest.mark.parametrize("text, kind, found", [
    ("mail john.doe @ example.com now", 0, "john.doe @ example.com"),
    ("10.0.0.five", 1, "10.0.0.five"),
    ("plus 1 507 555 2257", 3, "plus 1 507 555 2257"),
    ("é 𝐣𝐨𝐡𝐧@𝖾𝗑𝖺𝗆𝗉𝗅𝖾.com", 0, "𝐣𝐨𝐡𝐧@𝖾𝗑𝖺𝗆𝗉𝗅𝖾.com"),
    ("ﬁ mail ⓙohn@ﬁne.ex㏂ple.org é", 0, "ⓙohn@ﬁne.ex㏂ple.org"),
    ("10.0.0.ﬁve", 1, "10.0.0.ﬁve"),
    ("𝟙𝟘.0.0.5", 1, "𝟙𝟘.0.0.5"),
    ("10.0.0.fıve", 1, "10.0.0.fıve"),
])
def test_alone(text, kind, found):
    assert [(k, text[a:b]) for a, k, b in pii.disguised(text, pii.detect(text))] == [(kind, found)]


@pytest.mark.parametrize("text", ["10.0.0.1² and a@b.com™", "five of us met @ noon", "plus one", "ſix ﬁve"])
def test_nothing_new(text):
    assert pii.disguised(text, pii.detect(text)) == []


def test_guard_misses_nothing():
    rng = random.Random(1)
    parts = ["at", "AT", "dot", "Dot", "@", "one", "Five", "plus", "x", "7", "(", ")", "[", "]", " ", " ", "\n", "-", "com"]
    every = pii.rewriting(tuple(pii.ALTERNATIVES))
    for _ in range(20_000):
        text = "".join(rng.choices(parts, k=9))
        some = pii.possible(text)
        expected = [(m.lastgroup, m.span()) for m in every.finditer(text)]
        assert [(m.lastgroup, m.span()) for m in pii.rewriting(some).finditer(text) if some] == expected

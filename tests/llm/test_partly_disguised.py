"""Personal data that is disguised in part, beside what the base patterns find of it."""

from __future__ import annotations

import pytest

from merchant_ledger.llm import pii


def added(text):
    base = pii.detect(text)
    return [(k, text[a:b]) for a, k, b in base], [(k, text[a:b]) for a, k, b in pii.disguised(text, base)]


@pytest.mark.parametrize("text, kind, base, found", [
    ("to j\u043ehn.doe@example.com now", 0, ["hn.doe@example.com"], "j\u043ehn.doe@example.com"),
    ("john (dot) doe@example.com", 0, ["doe@example.com"], "john (dot) doe@example.com"),
    ("mary@mail.example (dot) com", 0, ["mary@mail.example"], "mary@mail.example (dot) com"),
    ("+1 507 555 225 seven", 3, ["+1 507 555 225"], "+1 507 555 225 seven"),
])
def test_full_span_beside_base(text, kind, base, found):
    assert added(text) == ([(kind, b) for b in base], [(kind, found)])


def test_within_base_is_left_out():
    assert pii.disguised("a@b.example.com \u043e", [(0, 0, 15)]) == []
    assert pii.disguised("(dot) 10.0.0.1 a@b.com", pii.detect("(dot) 10.0.0.1 a@b.com")) == []

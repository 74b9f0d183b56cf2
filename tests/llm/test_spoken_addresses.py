"""Spoken addresses against prose, on labelled sentences; and time in runs of white space."""

from __future__ import annotations

import time

import pytest

from merchant_ledger.llm import pii

ADDRESSES = [
    ("john.doe at example.com now", "john.doe at example.com"),
    ("john underscore doe at example dot com", "john underscore doe at example dot com"),
    ("mail john dash doe at example dot com", "john dash doe at example dot com"),
    ("ask jane dot roe at mail dot example dot org", "jane dot roe at mail dot example dot org"),
    ("write to jane at example.org please", "jane at example.org"),
    ("contact: sales at example dot com", "sales at example dot com"),
    ("roe7 at example (dot) net", "roe7 at example (dot) net"),
    ("jane at example dot com", "jane at example dot com"),
    ("jane (at) example (dot) com", "jane (at) example (dot) com"),
    ("jane   [at]   example   [dot]   com", "jane   [at]   example   [dot]   com"),
    ("jane @ example.com", "jane @ example.com"),
    ("e-mail me at jane_roe at example.com", "jane_roe at example.com"),
]
PROSE = [
    "look at google dot com today", "we are at booking dot com", "he met at ten (dot) com", "look at example.com",
    "the prices at shop.example.com are low", "we met at noon.Then we left", "found at example dot org",
    "dash to the store at noon", "an underscore and a hyphen at work", "she works at example.com",
    "meet us at 10 dot five", "5 at example.com",
]


def found(text):
    return [text[a:b] for a, k, b in pii.disguised(text, pii.detect(text)) if k == 0]


@pytest.mark.parametrize("text, address", ADDRESSES)
def test_found(text, address):
    assert found(text) == [address]


def test_precision_and_recall():
    true = sum(found(text) == [address] for text, address in ADDRESSES)
    false = sum(bool(found(text)) for text in PROSE)
    assert true / len(ADDRESSES) >= 0.95 and true / (true + false) >= 0.95, [t for t in PROSE if found(t)]


@pytest.mark.parametrize("text", [
    "(dot) x" + " " * 1_000_000 + "y @ z", "a" + " " * 1_000_000 + "at" + " " * 1_000_000 + "b (dot) c",
    "(" + " " * 1_000_000 + "dot) (at)", "a dot " * 170_000, "one, " * 200_000, "x at y dot z " * 70_000, "plus " * 200_000,
    "a hyphen " * 110_000, "a @ " * 250_000, "x at y.z " * 110_000,
])
def test_time_grows_with_the_text_only(text):
    started = time.process_time()
    pii.disguised(text, pii.detect(text))
    assert time.process_time() - started < 5

"""Personal data in texts, also in disguise, with offsets in the text as it stands."""

from __future__ import annotations

import functools
import re
import sys
import unicodedata
from bisect import bisect_right
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")

DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
NO_DIGIT = re.compile(r"[^0-9]+")

# Letters of other alphabets that look like Latin ones, and spelled digits.
LOOKALIKES = str.maketrans(
    "АВЕКМНОРСТУХаеорсухіѕјԁ" "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧορν",
    "ABEKMHOPCTYXaeopcyxisjd" "ABEZHIKMNOPTYXopv",
)
DIGITS = ("zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine")
MARKS = str.maketrans("．＠＋－（）　。", ".@+-() .")



def _compatible() -> dict[int, str]:
    """Other forms of ASCII letters, digits and signs: mathematical, circled, full width and so on.

    A few are written as several characters. Raised and lowered digits are mostly footnotes
    and powers, and stay, as do raised signs such as the trade mark.
    """
    found = {}
    for c in map(chr, range(128, sys.maxunicode + 1)):
        kind = unicodedata.decomposition(c).partition(" ")[0]
        if kind[:1] != "<" or kind in ("<fraction>", "<noBreak>"):
            continue
        new = unicodedata.normalize("NFKC", c)
        if kind in ("<super>", "<sub>") and not (len(new) == 1 and new.isascii() and new.isalpha() and c not in "ªº"):
            continue
        if re.fullmatch(r"[!-~]", new) or re.fullmatch(r"[A-Za-z0-9.@+()-]+", new) and re.search("[A-Za-z0-9]", new):
            found[ord(c)] = new
    return found


#: What each single character is replaced by; İ and ı match an i where case is ignored.
FOLD = {**_compatible(), ord("İ"): "I", ord("ı"): "i", **{k: chr(v) for k, v in (LOOKALIKES | MARKS).items()}}
_DIGIT = rf"\b(?:{'|'.join(DIGITS)})\b"
#: One pass of the transducer: each alternative is rewritten as a whole, all else is kept. With
#: each goes what must be found, in lower case, where it can match, which is faster to look for.
#: None starts anew at every blank of a run: those that may begin with blanks start at their
#: sign (``SIGNS``), and the blanks before it are taken in afterwards.
_WORD = r"(?<=[A-Za-z0-9])"
ALTERNATIVES = {
    "at": (r"[\[({<]\s*at\s*[\])}>]\s*|(?<=\s)@\s+", r"[\[({<]\s*at\s*[\])}>]|@(?<=\s@)(?=\s)", ()),
    "dot": (r"[\[({<]\s*dot\s*[\])}>]\s*", r"[\[({<]\s*dot\s*[\])}>]", ("dot",)),
    "said": (
        rf"{_WORD}\s+at\s+(?=[A-Za-z0-9-]+(?:(?:\s+dot\s+|\s*[\[({{<]\s*dot\s*[\])}}>]\s*)[A-Za-z0-9-]+)+)",
        r"dot(?<=[\s\[({<]dot)(?=[\s\])}>])", ("dot",),
    ),
    "before": (rf"{_WORD}\s+at\s+(?=[A-Za-z0-9-]+\.[A-Za-z])", r"at(?<=\sat)\s+[a-z0-9-]+\.[a-z]", ()),
    "point": (rf"{_WORD}\s+dot\s+(?=[A-Za-z])", r"dot(?<=\sdot)(?=\s)", ("dot",)),
    "low": (rf"{_WORD}\s+underscore\s+(?=[A-Za-z0-9])", "underscore", ("underscore",)),
    "dash": (
        rf"{_WORD}\s+(?:dash|hyphen)\s+(?=[A-Za-z0-9._]+(?:\s+at\s|\s*[\[({{<]\s*at\b|\s*@))",
        r"(?:dash|hyphen)(?=\s)", ("dash", "hyphen"),
    ),
    "digit": (rf"{_DIGIT}(?:[ ,]+(?={_DIGIT}))?", _DIGIT, DIGITS),
    "plus": (rf"\bplus\s+(?=[0-9]|{_DIGIT})", r"plus(?<=\bplus)(?=\s)", ("plus",)),
}
SIGNS = {"at": "@", "said": "@", "before": "@", "dot": ".", "point": ".", "low": "_", "dash": "-", "plus": "+"}
# Words of which "at" says where, not whose address, unless something else tells.
PLACED = frozenset(
    "a about all am and are arrive arrived arrives available be been book booked bought buy buying call click come"
    " day dinner down find found get go good group hard he here him home hosted i in is it join joined just later"
    " live located look looked looking looks lunch me meet meeting met more morning night not now of office on online"
    " only open order ordered out page people point products prices registered released sale see seen sell she shop"
    " shopping sign site sold start started stay stop store team that the them there they things this time today"
    " tomorrow up us visit was we website week were work worked working works you".split()
)
#: What a spoken address may be told by: so many characters before its "at" are looked at.
LEAD = 120
_SAID_BEFORE = re.compile(r"(?:.*[^A-Za-z0-9._%+-])?([A-Za-z0-9._%+-]+)", re.DOTALL)
_SPELLED = re.compile(r"\b(?:dot|underscore|dash|hyphen)\s+$", re.IGNORECASE)
_ASKED = re.compile(
    r"\b(?:e-?mails?|mail|contact|write|reach|address|send|message|ping)(?:\s+(?:me|us|him|her|them|to|is|it))*\s*:?\s*$",
    re.IGNORECASE,
)


def addressed(before: str, plain_domain: bool) -> bool:
    """Whether a spoken "at" after ``before`` can be that of an address.

    It is if the word before it has a sign or digit inside, ends what is spelled with dot or
    underscore, or follows mail, contact, write and so on. Without that, a domain that is
    itself spelled does for other words than those of ``PLACED``, a plain one doesn't.
    """
    m = _SAID_BEFORE.fullmatch(before[-LEAD:])
    if not m:
        return False
    local, ahead = m[1].strip("."), before[-LEAD:][: m.start(1)]
    if re.search(r"[0-9]|[A-Za-z0-9][._+-][A-Za-z0-9]", local) and re.search("[A-Za-z]", local):
        return True
    if _ASKED.search(ahead) or _SPELLED.search(ahead):
        return True
    return not plain_domain and local.lower() not in PLACED


_NEEDED = {kind: (literals, re.compile(needed)) for kind, (_, needed, literals) in ALTERNATIVES.items()}


@functools.cache
def rewriting(kinds: tuple[str, ...]) -> re.Pattern:
    """The alternatives of these kinds in one pattern."""
    return re.compile("|".join(f"(?P<{k}>{ALTERNATIVES[k][0]})" for k in kinds), re.IGNORECASE)


def possible(plain: str) -> tuple[str, ...]:
    """The kinds of alternatives that can match in a text; the others can't."""
    low = plain.lower()
    return tuple(
        k for k, (literals, needed) in _NEEDED.items()
        if (not literals or any(x in low for x in literals)) and needed.search(low)
    )


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def detect(text: str) -> list[tuple[int, int, int]]:
    """Sorted (start, kind, end), leftmost and not overlapping within a kind.

    E-mail addresses are sought from their @: all that may stand before it back to the last
    match. Other patterns never start again inside what they have read, so the time grows
    with the text's length only.
    """
    found, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            found.append((start, 0, domain.end()))
            done = domain.end()
        else:
            done = at + 1
        at = text.find("@", at + 1)
    for m in IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part) <= 255 for part in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        digits = NO_DIGIT.sub("", m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(NO_DIGIT.sub("", m[0])) <= 15:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


def folded(text: str) -> tuple[str, list[int] | range]:
    """The text with FOLD applied, and the place in ``text`` of each of its characters."""
    plain = text if text.isascii() else text.translate(FOLD)
    if len(plain) == len(text):
        return plain, range(len(text))
    return plain, [i for i, c in enumerate(text) for _ in FOLD.get(ord(c), c)]


def normalised(text: str) -> tuple[str, Callable[[int, int], tuple[int, int]]] | None:
    """The text without its disguises, and what maps a span in it to its place in ``text``.

    First characters are replaced one by one: look-alikes, full width, marks. Then words are
    rewritten: (at), dot, underscore and dash, spelled digits, plus. A word of digits has the place of all of
    its letters. None if there is nothing to replace.
    """
    plain, places = folded(text)
    kinds = possible(plain)
    if not kinds and plain == text:
        return None
    out, size, done = [], 0, 0
    at, froms, lasts, nexts = [], [], [], []  # of each rewritten character: its place, and what it stands for
    for m in rewriting(kinds).finditer(plain) if kinds else ():
        kind, start = m.lastgroup, m.start()
        if kind in ("said", "before") and not addressed(plain[max(0, start - LEAD) : start], kind == "before"):
            continue
        if kind in ("at", "dot"):
            while start > done and plain[start - 1].isspace():
                start -= 1
        if kind == "digit":
            word = re.match("[a-z]+", m[0].lower())[0]
            new, last = str(DIGITS.index(word)), m.start() + len(word)
        else:
            new, last = SIGNS[kind], m.end()
        out += plain[done:start], new
        size += start - done + 1
        done = m.end()
        at.append(size - 1)
        froms.append(start)
        lasts.append(last)
        nexts.append(done)
    if not at and plain == text:
        return None
    out.append(plain[done:])

    def place(i: int) -> tuple[int, int]:
        k = bisect_right(at, i) - 1
        if k >= 0 and at[k] == i:
            return froms[k], lasts[k]
        start = i - at[k] - 1 + nexts[k] if k >= 0 else i
        return start, start + 1

    return "".join(out), lambda start, end: (places[place(start)[0]], places[place(end - 1)[1] - 1] + 1)


def disguised(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans, in ``text``, of what is only found in the normalised text.

    A span that is or lies within one of ``base`` of its kind is left out; one that reaches
    beyond it stands beside it, as where only a part of an address is disguised. An address
    whose last label is not letters is left out too, and a number that was there before
    without passing.
    """
    without = normalised(text)
    if without is None:
        return []
    plain, place = without
    more = []
    for start, kind, end in detect(plain):
        first, last = place(start, end)
        span = first, kind, last
        if text[span[0] : span[2]] == plain[start:end]:
            continue
        if kind == 0 and not plain[start:end].rpartition(".")[2].isalpha():
            continue
        if not any(k == kind and s <= span[0] and span[2] <= e for s, k, e in base):
            more.append(span)
    return more


def scan(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, ``base`` and ``more``, arrays of (start, kind, end) in code points.

    ``base`` is what the fixed patterns find in the text as it stands, ``more`` what they
    find only after look-alike letters, spelled digits and disguised signs are undone, at
    its place in the text as it stands. Texts are read whole, row by row, and nothing is
    shuffled. Null is an empty text; repeated rows are scanned each; other columns are not
    read; no rows give no rows.
    """
    span = "array<struct<start:int,kind:int,end:int>>"

    def scanned(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = frame.pop("text")
            frame["base"] = [detect(t) for t in texts]
            frame["more"] = [disguised(t, b) for t, b in zip(texts, frame["base"])]
            yield frame

    rows = docs.select(F.col("doc_id").cast("string"), F.coalesce("text", F.lit("")).alias("text"))
    made = rows.mapInPandas(scanned, f"doc_id string, base {span}, more {span}")
    return made.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))


def op2(docs: DataFrame) -> DataFrame:
    names = F.array(*map(F.lit, KINDS))
    told = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ","
    )
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return scan(docs).select(
        "doc_id",
        *[count(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS)],
        F.sha2(told("base").cast("binary"), 256).alias("base_sha256"),
        told(F.sort_array(F.concat("base", "more"))).alias("spans"),
    )

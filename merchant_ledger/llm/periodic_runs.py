"""Periodic runs of words, found in a grammar of each text instead of in the text itself."""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchant_ledger.llm.common import batches_of

#: A run has this many words at least, and this many times its period.
LEAST, TIMES = 6, 4

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def re_pair(sequence: list[int], terminals: int) -> tuple[list[tuple[int, int]], list[int]]:
    """A grammar of ``sequence``: rules (left, right) of the symbols from ``terminals`` on, and the rest.

    Again and again the most frequent pair becomes a symbol, of equally frequent ones the
    one that came to be first, until no pair occurs twice (of one symbol with itself, where
    three stand in a row, an occurrence may stay uncounted; the grammar is right with any
    choice of pairs). Places are a doubly linked list,
    pairs know their places, and pairs of one frequency are kept in order of arrival: the
    time is in proportion to the length.
    """
    symbol, n = list(sequence), len(sequence)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    places: dict[tuple[int, int], dict[int, None]] = {}
    queues: dict[int, dict[tuple[int, int], None]] = defaultdict(dict)

    def add(at: int) -> None:
        """Count the pair at ``at`` unless it overlaps the same pair just before."""
        pair = symbol[at], symbol[after[at]]
        found = places.setdefault(pair, {})
        if pair[0] == pair[1] and (before[at] in found or after[at] in found):
            return
        if found:
            queues[len(found)].pop(pair, None)
        found[at] = None
        queues[len(found)][pair] = None

    def remove(at: int) -> None:
        pair = symbol[at], symbol[after[at]]
        found = places.get(pair)
        if found is None or at not in found:
            return
        queues[len(found)].pop(pair, None)
        del found[at]
        if found:
            queues[len(found)][pair] = None
        else:
            del places[pair]

    for at in range(n - 1):
        add(at)
    rules: list[tuple[int, int]] = []
    most = max(queues, default=0)
    while most > 1:
        queue = queues[most]
        if not queue:
            most -= 1
            continue
        pair = next(iter(queue))
        del queue[pair]
        new = terminals + len(rules)
        rules.append(pair)
        for at in places.pop(pair):
            right = after[at]
            if right >= n or (symbol[at], symbol[right]) != pair:
                continue
            left, beyond = before[at], after[right]
            if left >= 0:
                remove(left)
            if beyond < n:
                remove(right)
            symbol[at], symbol[right] = new, -1
            after[at] = beyond
            if beyond < n:
                before[beyond] = at
            if left >= 0:
                add(left)
            if beyond < n:
                add(at)
    rest, at = [], 0
    while at < n:
        rest.append(symbol[at])
        at = after[at]
    return rules, rest


def common_prefix(s: Sequence, i: int, j: int) -> int:
    """How long ``s`` agrees from i < j on."""
    most, length, step = len(s) - j, 0, 16
    while length < most:
        step = min(step, most - length)
        if s[i + length : i + length + step] == s[j + length : j + length + step]:
            length += step
            step *= 4
        elif step == 1:
            break
        else:
            most, step = length + step - 1, (step + 1) // 2
    return length


def common_suffix(s: Sequence, i: int, j: int) -> int:
    """How long ``s`` agrees back from before i < j."""
    most, length, step = i, 0, 16
    while length < most:
        step = min(step, most - length)
        if s[i - length - step : i - length] == s[j - length - step : j - length]:
            length += step
            step *= 4
        elif step == 1:
            break
        else:
            most, step = length + step - 1, (step + 1) // 2
    return length


def prefix_squares(s: Sequence) -> list[tuple[int, int]]:
    """(q, length): primitive periods with which ``s`` begins twice, and how far they last.

    There are few, each of which is more than half of what the one before lasts: a shorter
    one would be a multiple.
    """
    found, q, half = [], 0, len(s) // 2
    while True:
        try:
            q = s.index(s[0], q + 1, half + 1)
        except ValueError:
            return found
        if s[:q] == s[q : 2 * q]:
            length = q + common_prefix(s, 0, q)
            found.append((q, length))
            q = max(q, length // 2)


def crossing(y: Sequence, z: Sequence, heads: list[tuple[int, int]], tails: list[tuple[int, int]]) -> set:
    """(start, length, q) of the runs of y + z that have words of both, as far as they go there.

    A run of four periods has two of them in one part: at the head of ``z`` or the tail of ``y``.
    """
    x, c, found = y + z, len(y), set()
    for q, right in heads:
        left = common_suffix(x, c, c + q)
        if left and left + right >= max(LEAST, TIMES * q):
            found.add((c - left, left + right, q))
    for q, left in tails:
        right = common_prefix(x, c - q, c)
        if right and left + right >= max(LEAST, TIMES * q):
            found.add((c - left, left + right, q))
    return found


def runs(ids: list[int]) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of ``ids``, by start, then period.

    Ids must be 0 and up. The grammar's rest is halved again and again into symbols of its
    own. For every symbol, the runs that cross the boundary of its two parts are computed
    once, and hold wherever the symbol stands. A whole run lies in the smallest symbol that
    has all of it, crossing its boundary there; what other symbols see is a part of it with
    the same period, and is merged with it.
    """
    kinds = max(ids, default=-1) + 1
    if len(ids) < LEAST:
        return []
    rules, rest = re_pair(ids, kinds)
    parts: list[tuple[int, int]] = list(rules)

    def halved(symbols: list[int]) -> int:
        while len(symbols) > 1:
            joined = []
            for i in range(0, len(symbols) - 1, 2):
                parts.append((symbols[i], symbols[i + 1]))
                joined.append(kinds + len(parts) - 1)
            symbols = joined + symbols[len(joined) * 2 :]
        return symbols[0]

    root = halved(rest)
    # A word is a character; beyond the number of characters, an element of a tuple.
    text = [chr(i) if kinds <= 0x110000 else (i,) for i in range(kinds)]
    heads: dict[int, list] = {}
    tails: dict[int, list] = {}

    def squares(symbol: int, memo: dict[int, list], backwards: bool) -> list:
        if symbol not in memo:
            s = text[symbol]
            memo[symbol] = prefix_squares(s[::-1] if backwards else s) if len(s) > 1 else []
        return memo[symbol]

    crossed: dict[int, set] = {}
    busy: set[int] = set()
    for k, (left, right) in enumerate(parts):
        symbol, y, z = kinds + k, text[left], text[right]
        text.append(y + z)
        if len(y) + len(z) >= LEAST:
            crossed[symbol] = crossing(y, z, squares(right, heads, False), squares(left, tails, True))
        if crossed.get(symbol) or left in busy or right in busy:
            busy.add(symbol)
    starts: dict[int, list] = defaultdict(list)
    if root in busy:
        starts[root].append(np.zeros(1, np.int64))
    placed = []
    for symbol in range(kinds + len(parts) - 1, kinds - 1, -1):
        if symbol not in busy or symbol not in starts:
            continue
        at = np.concatenate(starts.pop(symbol))
        for start, length, q in crossed.get(symbol, ()):
            placed.append(np.stack([np.full(len(at), q), at + start, at + start + length]))
        left, right = parts[symbol - kinds]
        if left in busy:
            starts[left].append(at)
        if right in busy:
            starts[right].append(at + len(text[left]))
    return merged(np.concatenate(placed, axis=1)) if placed else []


def merged(intervals: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, q) of the maximal ones among rows q, start, end that overlap by q or more."""
    q, start, end = intervals[:, np.lexsort((-intervals[2], intervals[1], intervals[0]))].tolist()
    found: list[list[int]] = []
    for period, first, last in zip(q, start, end):
        if found and found[-1][0] == period and first <= found[-1][2] - period:
            found[-1][2] = max(found[-1][2], last)
        else:
            found.append([period, first, last])
    return sorted((first, last - first, period) for period, first, last in found)


def stretches(text: np.ndarray, ids: np.ndarray) -> list[tuple[int, int]]:
    """(start, end) of the parts of several texts that may hold runs; ``text`` numbers them.

    In a run, any three words in a row stand three times or more. Where they don't, no run
    passes; three words in a row that stand too rarely within a part cut it again. What is
    counted are hashes: equal ones of different words only leave a part longer.
    """
    if not len(text):
        return []
    cuts = np.flatnonzero(np.diff(text)) + 1
    spans = np.stack([np.insert(cuts, 0, 0), np.append(cuts, len(text))], 1)
    while True:
        spans = spans[spans[:, 1] - spans[:, 0] >= LEAST]
        if not len(spans):
            return []
        sizes = spans[:, 1] - spans[:, 0] - 2
        part = np.repeat(np.arange(len(spans)), sizes)
        at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(spans[:, 0], sizes)
        with np.errstate(over="ignore"):
            key = part.astype(np.uint64) * _A
            for i in range(3):
                key = (key + ids[at + i].astype(np.uint64)) * _B
                key ^= key >> np.uint64(32)
        _, inverse, counts = np.unique(key, return_inverse=True, return_counts=True)
        alive = counts[inverse] >= 3
        if alive.all():
            return [tuple(s) for s in spans.tolist()]
        at, part = at[alive], part[alive]
        new = np.ones(len(at), bool)
        new[1:] = (np.diff(at) != 1) | (np.diff(part) != 0)
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(at)) - 1
        spans = np.stack([at[first], at[last] + 3], 1) if len(at) else np.zeros((0, 2), np.int64)


def runs_of_texts(words: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """The runs of each list of words."""
    sizes = [len(w) for w in words]
    flat = np.array([w for ws in words for w in ws], dtype=object)
    ids = pd.factorize(flat)[0] if len(flat) else np.zeros(0, np.int64)
    text = np.repeat(np.arange(len(words)), sizes)
    first = np.cumsum([0] + sizes)
    found: list[list] = [[] for _ in words]
    for start, end in stretches(text, ids):
        of = int(text[start])
        own = pd.factorize(ids[start:end])[0].tolist()
        found[of] += [(start - int(first[of]) + s, length, q) for s, length, q in runs(own)]
    return [sorted(f, key=lambda r: (r[0], r[2])) for f in found]


def repeated(words: list[bytes], doc_id: str | None) -> list[bytes]:
    """The words with the ending that the id plants: a tenth of all ids repeat a part of the text."""
    h, n = zlib.crc32(doc_id.encode()) if doc_id is not None else 1, len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    unit = words[a : a + p]
    return words[:a] + (unit * ((n - a) // p + 1))[: n - a]


def collapsed(words: list[bytes], found: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run has after its first period."""
    kept = np.ones(len(words), bool)
    for start, length, q in found:
        kept[start + q : start + length] = False
    return words if kept.all() else [w for w, k in zip(words, kept.tolist()) if k]


OUTPUT = (
    "doc_id string, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, "
    "runs_sha256 string, collapsed_sha256 string, runs array<struct<start:bigint,length:bigint,period:bigint>>"
)


def periodic_runs(docs: DataFrame, plant: bool = False) -> DataFrame:
    """Per row of ``docs``: its runs, the longest of them, and digests of both the runs and what is left.

    A run is a stretch of words with a smallest period q, of max(6, 4 * q) words or more,
    that can't be longer. What three words in a row rule out is cut away first; of each
    stretch that is left a grammar is made, by Re-Pair, and runs are found at the boundaries
    of its symbols. Texts are handled where they are, without a shuffle, and a task holds the
    texts of 4 million characters or one text. ``plant`` writes a repeated ending into the
    words of a tenth of the ids, from which known runs result.

    Null and empty texts have no words and no runs: nulls for the longest, digests of
    nothing. A null doc_id passes as null, and nothing is planted. Repeated rows are handled
    each; no rows give no rows. Other columns of ``docs`` are not read.
    """

    def made(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sha = lambda data: hashlib.sha256(data).hexdigest()
        for frame in batches_of(frames):
            ids = [None if i is None else str(i) for i in frame["doc_id"]]
            words = [t.encode("utf-8", "surrogatepass").split() for t in frame["text"]]
            if plant:
                words = [repeated(w, i) for w, i in zip(words, ids)]
            rows = []
            for doc_id, text, found in zip(ids, words, runs_of_texts(words)):
                start, length, q = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
                listed = "".join(f"{s},{n},{p}\n" for s, n, p in found)
                rows.append((
                    doc_id, len(found), start, length, q, 1000 * length // q if found else None,
                    sha(listed.encode()), sha(b" ".join(collapsed(text, found))), found,
                ))
            columns = [c.split()[0] for c in OUTPUT.split(", ")]
            result = pd.DataFrame(rows, columns=columns)
            numbers = ["start", "length", "period", "exponent_milli"]
            yield result.astype({c: "Int64" for c in numbers})

    texts = docs.select(F.col("doc_id").cast("string"), F.coalesce("text", F.lit("")).alias("text"))
    result = texts.mapInPandas(made, OUTPUT)
    return result.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))


def op12(docs: DataFrame) -> DataFrame:
    return periodic_runs(docs, plant=True).drop("runs")

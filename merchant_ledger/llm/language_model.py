"""LM scoring: a hashed maximum-entropy model whose softmax is factored by word classes, twice."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchant_ledger.llm.common import materialize, remainder

HELD_OUT, FOLDS = 2, 7
#: Softmax over so many classes, the last of which is the end of a text; and, within a class,
#: over as many slots: the most frequent words have one each, the others share ``SHARED``.
#: Those in a shared slot have so many ``DIGITS`` of their hash, each by such a softmax again.
WIDTH, SHARED, DIGITS = 16, 4, 1
#: Weights have 2**bits rows for each level of choices, into which features are hashed.
#: Bits grow with the distinct words, up to what tells a broadcast of 16 MB.
LEAST_BITS, MOST_BITS = 12, 16
#: Words that every task knows: the most frequent ones, of at most so many bytes.
HEAD, LONGEST = 100_000, 40
#: The end of a text; no word has a blank.
END = b" "
TOKENS = 4_096
RATE = 0.1
#: A training task has at least about so many tokens: what it sends on does not grow with them.
LEAST_SHARE = 2_000_000
#: Scores are kept within this, where exponentials of single precision are safe.
STEEPEST = 60

_MIX = np.uint64(0x9E3779B97F4A7C15)


def tokens(text: str) -> list[bytes]:
    """Words with A-Z in lower case, and the end."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    words.append(END)
    return words


def tokens_of(texts) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The distinct tokens of a batch, the place there of each token, and the starts by text.

    They are those of ``tokens``. A batch is split as a whole, and each distinct word of it
    becomes an object once.
    """
    lower = pa.array([t.encode("utf-8", "surrogatepass").lower() for t in texts], pa.large_binary())
    # Bytes are bytes here: only ASCII is looked for.
    lower = pa.Array.from_buffers(pa.large_string(), len(lower), lower.buffers())
    split = pc.ascii_split_whitespace(lower)
    words, offsets = split.values, split.offsets.to_numpy()
    filled = pc.greater(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    until = np.concatenate([[0], np.cumsum(filled)])
    if not filled.all():
        words = words.filter(pa.array(filled))
    coded = words.dictionary_encode()
    distinct = coded.dictionary
    distinct = pa.Array.from_buffers(pa.large_binary(), len(distinct), distinct.buffers()).to_pylist()
    ends = np.cumsum(until[offsets[1:]] - until[offsets[:-1]] + 1)
    starts = np.concatenate([[0], ends])
    places = np.full(starts[-1], len(distinct), dtype=np.int64)
    is_word = np.ones(len(places), dtype=bool)
    is_word[ends - 1] = False
    places[is_word] = coded.indices.to_numpy(zero_copy_only=False)
    return [*distinct, END], places, starts


def _hashed(parts: list[bytes]) -> np.ndarray:
    return pd.util.hash_array(np.array(parts, dtype=object), categorize=False)


def digit(hashes: np.ndarray, i: int) -> np.ndarray:
    return ((hashes >> np.uint64(8 * i)) % np.uint64(WIDTH)).astype(np.int64)


class _Hashed(dict):
    """Hashes of short parts of words, each computed once, modulo ``size``."""

    def __init__(self, size: int, known: dict[bytes, int] | None = None):
        super().__init__(known or {})
        self.size = size

    def of(self, parts: list[bytes]) -> np.ndarray:
        new = list(set(parts) - self.keys())
        if new:
            self.update(zip(new, (_hashed(new) % np.uint64(self.size)).tolist()))
        return np.fromiter(map(self.__getitem__, parts), np.int64, len(parts))

    def of_slices(self, words: pa.Array, start: int, stop: int | None) -> np.ndarray:
        """Those of a slice of each word; a slice that many have is looked up once."""
        coded = pc.binary_slice(words, start, stop).dictionary_encode()
        return self.of(coded.dictionary.to_pylist()).take(coded.indices.to_numpy(zero_copy_only=False))


class Words:
    """Hash, class, slot, leaf and known count of words.

    A word's class is told by its last two bytes. Its slot there is its own if ``own`` has
    one, else one of those that are shared, told by its first two bytes. The leaf stands for
    class, shared slot and digits, also where the slot is its own. The count is -1 if ``head``
    has none.
    """

    def __init__(self, head: dict[bytes, int] | None = None, own: dict[bytes, int] | None = None):
        self.head, self.own = head or {}, own or {}
        self.kinds, self.shared = _Hashed(WIDTH - 1, {END: WIDTH - 1}), _Hashed(SHARED)

    def __call__(self, words: list[bytes]) -> np.ndarray:
        hashes = _hashed(words)
        bytewise = pa.array(words, pa.large_binary())
        kinds = self.kinds.of_slices(bytewise, -2, None)
        shared = self.shared.of_slices(bytewise, 0, 2)
        slots, counts = shared.copy(), np.full(len(words), -1, dtype=np.int64)
        if self.own:
            own = np.fromiter(map(self.own.get, words, repeat(-1)), np.int64, len(words))
            np.copyto(slots, own, where=own >= 0)
        if self.head:
            counts = np.fromiter(map(self.head.get, words, repeat(-1)), np.int64, len(words))
        leaves = kinds * WIDTH + shared
        for i in range(DIGITS):
            leaves = leaves * WIDTH + digit(hashes, i)
        return np.stack([hashes.view(np.int64), kinds, slots, leaves, counts])


def features(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Features of each token: one for all, the word before, the one before it, and both
    together. Before a text's first words stands nothing."""
    n = len(hashes)
    before = np.zeros((2, n), dtype=np.uint64)
    before[0, 1:], before[1, 2:] = hashes[:-1], hashes[:-2]
    before[:, starts] = 0
    second = starts + 1
    before[1, second[second < n]] = 0
    with np.errstate(over="ignore"):
        one, skip = before[0] * _MIX, (before[1] + np.uint64(1)) * _MIX
        both = (one ^ skip >> np.uint64(7)) * _MIX
    return np.stack([np.zeros(n, np.uint64), one, skip, both])


def hashed_rows(found: np.ndarray, bits: int, within: np.ndarray | None = None) -> np.ndarray:
    """Rows of the weights for features, apart for what the choice is ``within``."""
    with np.errstate(over="ignore"):
        if within is not None:
            found = ((found >> np.uint64(3)) + (within + 1).astype(np.uint64) * _MIX) * _MIX
    return (found >> np.uint64(64 - bits)).astype(np.uint16)


def scores_of(weights: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each token's scores of all choices, their exponentials, and the sums of those."""
    scores = weights.take(rows[0], axis=0)
    for row in rows[1:]:
        scores += weights.take(row, axis=0)
    np.clip(scores, -STEEPEST, STEEPEST, out=scores)
    powers = np.exp(scores)
    return scores, powers, powers @ np.ones(powers.shape[1], dtype=powers.dtype)


def log_shares(weights: np.ndarray, rows: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Natural logarithms of the probabilities of what was chosen, for each token."""
    logs = np.zeros(len(chosen))
    for at in range(0, len(chosen), TOKENS):
        part = slice(at, at + TOKENS)
        scores, _, sums = scores_of(weights, rows[:, part])
        logs[part] = scores[np.arange(len(sums)), chosen[part]] - np.log(sums)
    return logs


def descend(weights: np.ndarray, squares: np.ndarray, rows: np.ndarray, chosen: np.ndarray, rate: float) -> None:
    """One step along the gradient of the tokens' log probability, in place.

    A row's step is divided by the root of its ``squares``, the sum of its gradients' so far.
    """
    _, powers, sums = scores_of(weights, rows)
    powers *= (-1 / sums)[:, None]
    powers[np.arange(len(chosen)), chosen] += 1
    for row in rows:
        order = np.argsort(row, kind="stable")
        ordered = row.take(order)
        edges = np.concatenate([[0], np.flatnonzero(ordered[1:] != ordered[:-1]) + 1, [len(row)]])
        first, times = edges[:-1], edges[1:] - edges[:-1]
        which = ordered.take(first).astype(np.intp)
        total = powers.take(order.take(first), axis=0)
        # Most rows have one token, which is their sum.
        several = times > 1
        if several.any():
            many = times[several]
            members = powers.take(order[np.repeat(several, times)], axis=0)
            total[several] = np.add.reduceat(members, np.cumsum(many) - many, axis=0)
        grown = squares.take(which) + np.einsum("ij,ij->i", total, total) / total.shape[1]
        squares[which] = grown
        total *= (rate / np.sqrt(grown + 1e-6))[:, None]
        total += weights.take(which, axis=0)
        weights[which] = total


def levels(h: np.ndarray, kinds: np.ndarray, slots: np.ndarray, starts: np.ndarray, bits: int):
    """For classes, slots and each digit: the tokens that choose, their rows, and what they choose."""
    found = features(h, starts)
    yield slice(None), hashed_rows(found, bits), kinds
    at = np.flatnonzero(kinds != WIDTH - 1)
    found, within = found[:, at], kinds[at]
    yield at, hashed_rows(found, bits, within), slots[at]
    some = np.flatnonzero(slots[at] < SHARED)
    at, found = at[some], found[:, some]
    within = within[some] * WIDTH + slots[at]
    for i in range(DIGITS):
        chosen = digit(h[at], i)
        yield at, hashed_rows(found, bits, within), chosen
        within = within * WIDTH + chosen


def _batches(frames: Iterator[pd.DataFrame], most: int = 2_000_000) -> Iterator[pd.DataFrame]:
    for frame in frames:
        at = frame["text"].str.len().cumsum() // most
        for _, part in frame.groupby(at, sort=False):
            yield part


def _flat(texts, words: Words):
    """The distinct tokens of a batch, the place there of all, their starts by text, and their
    hashes, classes, slots, leaves and counts."""
    distinct, places, starts = tokens_of(texts)
    hashes, kinds, slots, leaves, counts = words(distinct).take(places, axis=1)
    return distinct, places, starts, hashes.view(np.uint64), kinds, slots, leaves, counts


def count_words(texts: DataFrame) -> DataFrame:
    """(word, kind, leaf, count) over all texts: summed up in each task, then by word."""

    def counted(frames):
        seen, told = Counter(), Words()

        def rows():
            words = list(seen)
            _, kinds, _, leaves, _ = told(words) if words else [()] * 5
            return pd.DataFrame({"word": words, "kind": kinds, "leaf": leaves, "count": [seen[w] for w in words]})

        for frame in _batches(frames):
            for text in frame["text"]:
                seen.update(tokens(text))
            if len(seen) > 500_000:
                yield rows()
                seen.clear()
        yield rows()

    parts = texts.select("text").mapInPandas(counted, "word binary, kind int, leaf bigint, count bigint")
    return parts.groupBy("word", "kind", "leaf").agg(F.sum("count").alias("count"))


def most_frequent(words: DataFrame, most: int = HEAD) -> dict[bytes, tuple[int, int, int]]:
    """count, kind and leaf of the most frequent words, at most ``most``.

    A histogram of the counts (at most some thousand rows) tells from which count on they
    fit; what comes to the driver is the words from there on.
    """
    short = words.where(F.length("word") <= LONGEST)
    bucket = F.floor(F.log2("count") * 64)
    counts = short.groupBy(bucket.alias("b")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("b")).collect()
    least, total = None, 0
    for r in counts:
        total += r["n"]
        if total > most:
            break
        least = r["b"]
    if least is None:
        return {}
    rows = short.where(bucket >= least).select("word", "count", "kind", "leaf").collect()
    return {bytes(r[0]): tuple(r)[1:] for r in rows}


def own_slots(head: dict[bytes, tuple[int, int, int]]) -> dict[bytes, int]:
    """Slots of their own for the most frequent words of each class."""
    own, taken = {}, Counter()
    for word, (_, kind, _) in sorted(head.items(), key=lambda x: (-x[1][0], x[0])):
        if word != END and taken[kind] < WIDTH - SHARED:
            own[word] = SHARED + taken[kind]
            taken[kind] += 1
    return own


def train(texts: DataFrame, own: dict[bytes, int], bits: int, epochs: int = 1, rate: float = RATE) -> np.ndarray:
    """The weights, of classes, slots and digits: each task descends along its own texts, and what
    they change is averaged.

    A row of the weights counts the tasks that touched it. The tasks' changes are added up
    row by row before and after the shuffle; 2**bits rows of each level come to the driver.
    """
    weights = np.zeros((2 + DIGITS, 1 << bits, WIDTH), dtype=np.float32)
    names = [f"w{k}" for k in range(WIDTH)]
    for _ in range(epochs):
        shared = texts.sparkSession.sparkContext.broadcast((weights, own))

        def moved(frames, shared=shared):
            start, own = shared.value
            new, words, touched = start.copy(), Words(own=own), np.zeros(start.shape[:2], dtype=bool)
            squares = np.zeros(start.shape[:2], dtype=np.float32)
            for frame in _batches(frames):
                _, _, starts, h, kinds, slots, _, _ = _flat(frame["text"], words)
                for level, (_, rows, chosen) in enumerate(levels(h, kinds, slots, starts[:-1], bits)):
                    touched[level][rows] = True
                    for at in range(0, len(chosen), TOKENS):
                        part = slice(at, at + TOKENS)
                        descend(new[level], squares[level], rows[:, part], chosen[part], rate)
            which = np.flatnonzero(touched)
            for at in range(0, len(which), 20_000):
                some = which[at : at + 20_000]
                change = (new.reshape(-1, WIDTH)[some] - start.reshape(-1, WIDTH)[some])
                change = pd.DataFrame(change, columns=names)
                change.insert(0, "row", some)
                yield change

        schema = "row bigint, " + ", ".join(f"{n} float" for n in names)
        changes = texts.select("text").mapInPandas(moved, schema)
        tasks = F.count(F.lit(1))
        mean = changes.groupBy("row").agg(*[(F.sum(n) / tasks).cast("float").alias(n) for n in names]).toPandas()
        weights = weights.copy()
        if len(mean):
            weights.reshape(-1, WIDTH)[mean["row"].to_numpy()] += mean[names].to_numpy()
        shared.unpersist()
    return weights


def scored(docs: DataFrame, epochs: int = 1) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) per row of ``docs``.

    The probability of a word is that of its class, by the maximum-entropy model from the
    two words before it, times that of its slot in the class and, if it has not a slot of
    its own, of each digit, by such models too, times its share of what is told apart so,
    from the counts with one added.
    Counts and training take every text that is not held out. The most frequent words are
    known to every task, a table of fixed size; rarer ones, which can't be hot, are joined
    with the counts of all words. Null is an empty text, which is its end only; rows with a
    null doc_id are learned from; repeated rows count and are scored each; without training
    texts every word is unknown. Only doc_id and text are read; no rows give no rows.
    """
    kind = docs.schema["doc_id"].dataType
    rows = docs.select(
        F.col("doc_id").cast("string"),
        F.coalesce(remainder(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    learned = rows.where(~F.col("held_out"))
    words = materialize(count_words(learned), "lm-words")
    by_leaf = words.groupBy("leaf").agg(F.sum("count").alias("n"), F.count(F.lit(1)).alias("v")).collect()
    sizes = np.zeros(WIDTH ** (2 + DIGITS), dtype=np.int64)
    for r in by_leaf:
        sizes[r["leaf"]] = r["n"] + r["v"]
    n, v = sum(r["n"] for r in by_leaf), sum(r["v"] for r in by_leaf)
    known = most_frequent(words)
    own = own_slots(known)
    for word in own:
        count, _, leaf = known[word]
        sizes[leaf] -= count + 1
    bits = min(max(v.bit_length() - 3, LEAST_BITS), MOST_BITS)
    spark = docs.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, -(-n // LEAST_SHARE))
    weights = train(learned.coalesce(tasks), own, bits, epochs)
    head = {word: each[0] for word, each in known.items()}
    shared = spark.sparkContext.broadcast((head, own, weights))
    base, ten = np.log10(n + v + 1), np.log(10)
    share = np.log10(sizes + 1)

    def evaluated(frames):
        head, own, weights = shared.value
        words = Words(head, own)
        for frame in _batches(frames):
            distinct, places, starts, h, kinds, slots, leaves, counts = _flat(frame.pop("text"), words)
            logs = np.zeros(len(places))
            for level, (which, rows, chosen) in enumerate(levels(h, kinds, slots, starts[:-1], bits)):
                logs[which] += log_shares(weights[level], rows, chosen)
            seen = counts >= 0
            inside = np.where(seen, np.log10(counts.clip(0) + 1), 0)
            alone = (slots >= SHARED) & (kinds != WIDTH - 1)
            model = logs / ten - np.where(alone, np.log10(counts.clip(0) + 2), share[leaves])
            add = lambda x: np.add.reduceat(x, starts[:-1])
            rare = np.flatnonzero(~seen)
            owner = np.searchsorted(starts, rare, side="right") - 1
            each, times = np.unique(owner * len(distinct) + places[rare], return_counts=True)
            owner, which = np.divmod(each, len(distinct))
            cuts = np.searchsorted(owner, np.arange(1, len(frame)))
            names = np.array(distinct, dtype=object)[which]
            yield frame.assign(
                n_tokens=np.diff(starts), known=add(seen.astype(np.int64)), inside=add(inside), model=add(model),
                word=np.split(names, cuts), times=np.split(times, cuts),
            )

    schema = (
        "doc_id string, held_out boolean, n_tokens bigint, known bigint, inside double, model double,"
        " word array<binary>, times array<bigint>"
    )
    parts = rows.mapInPandas(evaluated, schema).withColumn("uid", F.monotonically_increasing_id())
    parts = materialize(parts, "lm-parts")
    log10 = F.log10(F.col("count") + 1)
    found = (
        parts.select("uid", F.inline(F.arrays_zip("word", "times"))).join(words.select("word", "count"), "word")
        .groupBy("uid").agg(F.sum("times").alias("more"), F.sum(F.col("times") * log10).alias("log"))
    )
    inside = F.col("inside") + F.coalesce("log", F.lit(0.0))
    return parts.drop("word", "times").join(found, "uid", "left").select(
        F.col("doc_id").cast(kind).alias("doc_id"),
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (inside - F.col("n_tokens") * F.lit(float(base))).alias("base_score"),
        (inside + F.col("model")).alias("score"),
    )


def op9(docs: DataFrame) -> DataFrame:
    return scored(docs)

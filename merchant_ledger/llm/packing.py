"""Packing token pieces into sequences by minimum bin slack."""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchant_ledger.llm.common import materialize, rank_within

CAPACITY = 1024
END = b"\x00\x00\x00\x00"
#: Longer runs without white space go to an encoder whose time does not grow with their square.
LONGEST_RUN = re.compile(r"\S{2000}")


@dataclass(frozen=True)
class Vocabulary:
    """Files of one byte-level vocabulary: for tokenizers, and as ranks with their pattern."""

    tokenizer: str
    ranks: str
    pattern: str


class Encoder:
    """Ids of texts as little-endian 32-bit integers; strings of special tokens are text.

    The ids are those of the vocabulary's tokenizer. The encoder over the ranks gives the
    same ids in a quarter of the time, unless a text has very long words.
    """

    def __init__(self, vocabulary: Vocabulary):
        import tiktoken
        from tokenizers import Tokenizer

        with open(vocabulary.ranks, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding(
            "ranks", pat_str=vocabulary.pattern, mergeable_ranks=ranks, special_tokens={}
        )
        self.whole = Tokenizer.from_file(vocabulary.tokenizer)
        self.whole.encode_special_tokens = True

    def __call__(self, text: str) -> bytes:
        if LONGEST_RUN.search(text):
            ids = self.whole.encode(text, add_special_tokens=False).ids
        else:
            ids = self.fast.encode_ordinary(text)
        return np.array(ids, dtype="<u4").tobytes()


def token_pieces(docs: DataFrame, vocabulary: Vocabulary, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, doc_tokens, pieces, parts): each document's ids, cut at multiples of ``capacity``.

    ``pieces`` has (start, length, ids_crc32). ``parts`` has the last piece, if it is short,
    cut into powers of two, largest first, in case that its length can't be placed whole.
    A null text is empty: its only id is the end.
    """

    def tokenized(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = Encoder(vocabulary)

        def cut(ids: bytes, start: int, length: int) -> tuple[int, int, int]:
            return start, length, zlib.crc32(ids[4 * start : 4 * (start + length)])

        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                ids = encode(text or "") + END
                n = len(ids) // 4
                short = n % capacity
                pieces = [cut(ids, s, min(capacity, n - s)) for s in range(0, n, capacity)]
                parts, at = [], n - short
                for bit in reversed(range(short.bit_length())):
                    if short >> bit & 1:
                        parts.append(cut(ids, at, 1 << bit))
                        at += 1 << bit
                rows.append((doc_id, n, pieces, parts))
            yield pd.DataFrame(rows, columns=["doc_id", "doc_tokens", "pieces", "parts"])

    piece = "array<struct<start:bigint,length:bigint,ids_crc32:bigint>>"
    texts = docs.select(F.col("doc_id").cast("string"), F.coalesce("text", F.lit("")).alias("text"))
    made = texts.mapInPandas(
        tokenized, f"doc_id string, doc_tokens bigint, pieces {piece}, parts {piece}"
    )
    return made.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))


def closest(counts: dict[int, int], seed: int, capacity: int) -> dict[int, int]:
    """The multiset with ``seed`` whose lengths sum closest to ``capacity``, from above never.

    Subset sums are the bits of an integer. ``reached[i]`` has the sums with the lengths up
    to the i-th; going back through them gives how often each length is used.
    """
    lengths = sorted((n for n in counts if counts[n] > (n == seed)), key=lambda n: (-counts[n], -n))
    within = (1 << capacity + 1) - 1
    reached, sums = [], 1 << seed
    for length in lengths:
        reached.append(sums)
        for _ in range(min(counts[length] - (length == seed), (capacity - seed) // length)):
            more = (sums | sums << length) & within
            if more == sums:
                break
            sums = more
        if sums >> capacity & 1:
            break
    best, used = sums.bit_length() - 1, {seed: 1}
    for length, before in zip(reversed(lengths[: len(reached)]), reversed(reached)):
        while not before >> best & 1:
            best -= length
            used[length] = used.get(length, 0) + 1
    return used


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[tuple], list[tuple]]:
    """Which rank of which length goes where, from how many pieces there are of each length.

    Returns ``places``: (length, first rank, last rank, each, first sequence, offset), where
    ``each`` is how many of that length a sequence has, and ``splits``: (length, first rank,
    part, first rank of the part). The most frequent length is always the one to be filled
    up, and a filling is used as often as it can be. Where none is exact, the pieces of that
    length are split into powers of two, which are placed like others; in the end these fill
    sequences as long as a smaller power of two, the largest that can be reached, which need
    no padding. Each filling uses up a length or at least halves its count: at most about
    ``capacity`` * log2(documents) fillings, whatever the input.
    """
    counts = {n: c for n, c in counts.items() if c}
    after = {n: 1 for n in range(1, capacity + 1)}
    total = dict(counts)
    places, splits, sequence = [], [], 0
    while counts:
        seed = max(counts, key=lambda n: (counts[n], n))
        used = closest(counts, seed, capacity)
        filled = sum(n * k for n, k in used.items())
        if filled < capacity and seed & seed - 1:
            ranks = counts.pop(seed)
            for bit in reversed(range(seed.bit_length())):
                if seed >> bit & 1:
                    part = 1 << bit
                    splits.append((seed, after[seed], part, total.get(part, 0) + 1))
                    total[part] = total.get(part, 0) + ranks
                    counts[part] = counts.get(part, 0) + ranks
            continue
        room = capacity
        while filled < room:
            room = 1 << filled.bit_length() - 1
            used = closest(counts, seed, room)
            filled = sum(n * k for n, k in used.items())
        times, offset = min(counts[n] // k for n, k in used.items()), 0
        for n, k in sorted(used.items(), reverse=True):
            places.append((n, after[n], after[n] + times * k - 1, k, sequence, offset))
            after[n] += times * k
            offset += n * k
            counts[n] -= times * k
            if not counts[n]:
                del counts[n]
        sequence += times
    return places, splits


def pack(docs: DataFrame, vocabulary: Vocabulary, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Documents are tokenized once, with a row per document written to the shared folder. How
    many pieces have which length (at most ``capacity`` numbers, however large the input) is
    all that the plan needs; the pieces are then ranked within their length, a frequent
    length in buckets, and take the places that the plan has for their ranks. The plan's
    tables have at most ``capacity`` * log2(documents) fillings and are broadcast.

    A null doc_id passes as null; rows that repeat, also as a whole, are packed each. Every
    document has at least its end, so an empty text is a piece of one id. No rows give no
    rows. Other columns of ``docs`` are not read.
    """
    spark = docs.sparkSession
    written = materialize(token_pieces(docs, vocabulary, capacity), "pack-pieces")
    pieces = written.select(
        "doc_id",
        "doc_tokens",
        F.inline("pieces"),
        F.when(F.col("doc_tokens") % capacity > 0, F.col("parts")).alias("parts"),
    )
    pieces = pieces.withColumn("parts", F.when(F.col("length") < capacity, F.col("parts")))
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    places, splits = plan(counts, capacity)
    placed = spark.createDataFrame(
        places or [], "length long, first long, last long, each long, sequence long, place long"
    )
    split = spark.createDataFrame(splits or [], "length long, split_from long, part long, base long")
    split = split.groupBy("length", "split_from").agg(F.map_from_entries(F.collect_list(F.struct("part", "base"))).alias("bases"))
    ranked = rank_within(pieces, ["length"], "doc_id", [F.col("doc_id"), F.col("start"), F.col("ids_crc32")])
    whole = F.array(F.struct("start", "length", "ids_crc32", "rank"))
    part = lambda p: F.struct(
        p["start"].alias("start"),
        p["length"].alias("length"),
        p["ids_crc32"].alias("ids_crc32"),
        (F.element_at("bases", p["length"]) + F.col("rank") - F.col("split_from")).alias("rank"),
    )
    final = (
        ranked.join(F.broadcast(split), "length", "left")
        .withColumn("item", F.when(F.col("rank") >= F.col("split_from"), F.transform("parts", part)).otherwise(whole))
        .select("doc_id", "doc_tokens", F.inline("item"))
    )
    at = F.col("rank") - F.col("first")
    return (
        final.join(F.broadcast(placed), "length")
        .where((F.col("rank") >= F.col("first")) & (F.col("rank") <= F.col("last")))
        .select(
            "doc_id",
            "start",
            "length",
            "ids_crc32",
            "doc_tokens",
            (F.col("sequence") + F.floor(at / F.col("each"))).cast("long").alias("sequence_id"),
            (F.col("place") + (at % F.col("each")) * F.col("length")).cast("long").alias("offset"),
        )
    )

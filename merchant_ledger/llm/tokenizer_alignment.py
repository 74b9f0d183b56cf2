"""Cross-tokenizer alignment: inverted bitmaps of the id pairs that two tokenizers link in documents."""

from __future__ import annotations

import base64
import hashlib
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchant_ledger.llm.common import batches_of
from merchant_ledger.llm.packing import Encoder, Vocabulary
from merchant_ledger.session import shared_folder

#: A chunk of documents ends at so many of them, or at about so many links.
MOST_DOCS, MOST_LINKS = 1 << 15, 2_000_000
#: Texts of so many characters, or one text, are cut and aligned together.
MOST_CHARACTERS = 5_000_000
#: So many parts are encoded in one call; longer parts than LONGEST alone.
TOGETHER, LONGEST = 200, 200
#: Where a text may be cut: a blank or a line feed that follows neither.
PART = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
#: Texts with other white space are not cut.
OTHER_SPACE = re.compile(r"[^\S \n]|[\x1c-\x1f\x85]")


@dataclass(frozen=True)
class Tokenizers:
    """The byte-level vocabulary (A) and the file of a piece model (B)."""

    vocabulary: Vocabulary
    pieces: str


@dataclass
class Parts:
    """Parts of texts, numbered: tokens, groups as text, and links of each.

    The links of part i are ``pairs`` (a * size of B + b, each once) and ``times`` from
    ``first[i]`` to ``first[i + 1]``. ``good`` is false where the bytes of either's tokens are
    not the part's.
    """

    good: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    groups: list[str]
    first: np.ndarray
    pairs: np.ndarray
    times: np.ndarray


class Aligner:
    """The tokens of both tokenizers over texts, cut where both have a boundary.

    Texts are cut at blanks and line feeds as long as no token of either goes over them; each
    different part is encoded and aligned once for many texts. A part whose bytes the tokens
    don't give back can't be made up for by another: B writes nothing else than a blank for
    another character.
    """

    def __init__(self, files: Tokenizers):
        import sentencepiece

        self.encode_a = Encoder(files.vocabulary)
        with open(files.vocabulary.ranks, "rb") as lines:
            ranks = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, lines)}
        self.bytes_a = [ranks.get(i, b"") for i in range(max(ranks) + 1)]
        self.model = sentencepiece.SentencePieceProcessor(model_file=files.pieces)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(pieces)
        ]
        self.sizes_a = np.array([len(x) for x in self.bytes_a])
        self.sizes_b = np.array([len(x) for x in self.bytes_b])
        self.blank = self.model.piece_to_id("▁")
        self.cuts = not any("\n" in p or re.search("[^▁]▁", p) for p in pieces)
        n_a, n_b = len(self.bytes_a), len(self.bytes_b)
        self.written = [f"{i}{mark}" for mark in ",|" for i in range(n_a)] + [f"{i}{mark}" for mark in ",;" for i in range(n_b)]

    def cut(self, text: str) -> list[str]:
        """The parts of a blank and ``text``."""
        spaced = " " + text
        return PART.findall(spaced) if self.cuts and not OTHER_SPACE.search(text) else [spaced]

    def ids(self, text: str) -> tuple[list[int], list[int]]:
        """Ids of a part or of several in a row. B adds a blank before it, which is its own or goes."""
        a = np.frombuffer(self.encode_a(text), dtype="<u4").tolist()
        if text[0] != " ":
            b = self.model.encode(text)
            return a, b[1:] if b[0] == self.blank else []
        return a, self.model.encode(text[1:]) if len(text) > 1 else [self.blank]

    def encoded(self, parts: list[str]) -> tuple[list[int], np.ndarray, list[int], np.ndarray, np.ndarray]:
        """Ids of all good parts in a row, how many each has (of A, of B), and which are good.

        Parts are encoded many at a time, as any row of parts is one that the cuts would
        give. Only where the bytes differ are the parts encoded one by one.
        """
        all_a, all_b, good = [], [], np.ones(len(parts), bool)
        n_a, n_b = np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64)

        def add(first: int, last: int) -> None:
            raw = [part.encode("utf-8", "surrogatepass") for part in parts[first:last]]
            ids = self.ids("".join(parts[first:last]))
            given = [[table[i] for i in x] for x, table in zip(ids, (self.bytes_a, self.bytes_b))]
            whole = b"".join(raw)
            if any(b"".join(g) != whole for g in given):
                if last - first == 1:
                    good[first] = False
                for k in range(first, last) if last - first > 1 else ():
                    add(k, k + 1)
                return
            ends = np.cumsum([len(r) for r in raw])
            for x, g, found, n in zip(ids, given, (all_a, all_b), (n_a, n_b)):
                found += x
                until = np.searchsorted(np.cumsum([len(t) for t in g]), ends, side="right")
                n[first:last] = np.diff(until, prepend=0)

        alone = [k for k, part in enumerate(parts) if len(part) > LONGEST or part[-1].isspace()]
        start = 0
        for stop in [*alone, len(parts)]:
            for first in range(start, stop, TOGETHER):
                add(first, min(first + TOGETHER, stop))
            if stop < len(parts):
                add(stop, stop + 1)
            start = stop + 1
        return all_a, n_a, all_b, n_b, good

    def align(self, parts: list[str]) -> Parts:
        """A group ends where a token of each ends; its links are all its pairs."""
        all_a, n_a, all_b, n_b, good = self.encoded(parts)
        a, b = np.array(all_a, np.int64), np.array(all_b, np.int64)
        part_a, part_b = np.repeat(np.arange(len(parts)), n_a), np.repeat(np.arange(len(parts)), n_b)
        end_a, end_b = np.cumsum(self.sizes_a[a]), np.cumsum(self.sizes_b[b])
        last_a = end_b[np.minimum(np.searchsorted(end_b, end_a), len(end_b) - 1)] == end_a if len(b) else end_a > 0
        last_b = end_a[np.minimum(np.searchsorted(end_a, end_b), len(end_a) - 1)] == end_b if len(a) else end_b > 0
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        part = part_a[last_a]
        in_a, in_b = np.bincount(group_a, minlength=len(part)), np.bincount(group_b, minlength=len(part))
        until_a, until_b = np.cumsum(in_a), np.cumsum(in_b)
        code = np.zeros(len(a) + len(b), np.int64)
        code[np.arange(len(a)) + (until_b - in_b)[group_a]] = a + last_a * len(self.bytes_a)
        code[np.arange(len(b)) + until_a[group_b]] = b + last_b * len(self.bytes_b) + 2 * len(self.bytes_a)
        written = [self.written[c] for c in code.tolist()]
        ends = np.cumsum(n_a + n_b)
        groups = ["".join(written[end - k : end]) for end, k in zip(ends.tolist(), (n_a + n_b).tolist())]
        keys, times = self.links(a, b, group_a, group_b, part)
        each = len(self.bytes_a) * len(self.bytes_b)
        first = np.searchsorted(keys, np.arange(len(parts) + 1) * each)
        return Parts(good, n_a, n_b, np.bincount(part, minlength=len(parts)), groups, first, keys % each, times)

    def links(self, a, b, group_a, group_b, part) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (part, pair) in order and how many links have them.

        In a group, equal ids are counted first, and their links are products.
        """
        size_a, size_b = len(self.bytes_a), len(self.bytes_b)
        kinds_a, count_a = np.unique(group_a * size_a + a, return_counts=True)
        kinds_b, count_b = np.unique(group_b * size_b + b, return_counts=True)
        of_a, of_b = kinds_a // size_a, kinds_b // size_b
        in_b = np.bincount(of_b, minlength=len(part))
        repeats = in_b[of_a]
        left = np.repeat(np.arange(len(kinds_a)), repeats)
        right = np.arange(len(left)) + np.repeat((np.cumsum(in_b) - in_b)[of_a] - np.cumsum(repeats) + repeats, repeats)
        pairs = (part[of_a[left]] * size_a + kinds_a[left] % size_a) * size_b + kinds_b[right] % size_b
        return summed(pairs, count_a[left] * count_b[right])


def summed(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sums of their times."""
    if not len(keys):
        return keys, times
    if int(keys.max()) < 1 << 52 and int(times.max()) < 1 << 11:
        packed = np.sort(keys << 11 | times)
        keys, times = packed >> 11, packed & 0x7FF
    else:
        order = np.argsort(keys, kind="stable")
        keys, times = keys[order], times[order]
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[first], np.add.reduceat(times, first)


# A bitmap of a chunk's documents is its sorted 16-bit positions or, where that is shorter, its bits.


def bitmap(positions: np.ndarray) -> bytes:
    """The positions, sorted and distinct, as a compressed bitmap with a mark of its form."""
    if not len(positions):
        return b""
    if 2 * len(positions) <= int(positions[-1]) // 8:
        return b"p" + positions.astype("<u2").tobytes()
    bits = np.zeros(int(positions[-1]) + 1, np.uint8)
    bits[positions] = 1
    return b"b" + np.packbits(bits).tobytes()


def positions(data: bytes) -> np.ndarray:
    if data[:1] == b"b":
        return np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8, offset=1)))
    return np.frombuffer(data, "<u2", offset=1).astype(np.int64) if data else np.zeros(0, np.int64)


def union(planes: list[bytes]) -> np.ndarray:
    """The documents that any of the planes has."""
    return np.unique(np.concatenate([positions(p) for p in planes])) if len(planes) > 1 else positions(planes[0])


def planes(docs: np.ndarray, times: np.ndarray) -> list[bytes]:
    """Plane k is the bitmap of the documents whose times have the bit k."""
    return [bitmap(docs[(times >> k & 1) == 1]) for k in range(int(times.max()).bit_length())]


def expanded(rows: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, document, times) of all that the planes of all rows have; a document once per plane."""
    flat = [(i, k, p) for i, each in enumerate(rows) for k, p in enumerate(each) if p]
    listed = [x for x in flat if x[2][:1] == b"p"]
    bits = [x for x in flat if x[2][:1] == b"b"]
    short = np.frombuffer(b"".join([p[1:] for _, _, p in listed]), "<u2").astype(np.int64)
    found = [positions(p) for _, _, p in bits]
    sizes = [(len(p) - 1) // 2 for _, _, p in listed] + [len(f) for f in found]
    row = np.repeat(np.array([x[0] for x in listed + bits], np.int64), sizes)
    times = np.repeat(np.array([1 << x[1] for x in listed + bits], np.int64), sizes)
    return row, np.concatenate([short, *found]), times


POSTINGS = "a int, b int, docs bigint, planes array<binary>"
DOCS = "pos int, doc_id string, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string"


class Chunk:
    """Documents in order of arrival, and the (pair, document, times) that they link."""

    def __init__(self, aligner: Aligner):
        self.aligner, self.docs, self.keys, self.times, self.links = aligner, [], [], [], 0

    def add(self, doc_ids: list, texts: list[str]) -> None:
        number = defaultdict(count().__next__)
        cut = [np.array([number[part] for part in self.aligner.cut(text)] if text else [], np.int32) for text in texts]
        parts = self.aligner.align(list(number)) if number else None
        for at, doc_id in enumerate(doc_ids):
            used = cut[at]
            pos = len(self.docs)
            if not len(used) or not parts.good[used].all():
                self.docs.append((pos, doc_id, 0, 0, 0, 0, ""))
                continue
            groups = "".join([parts.groups[i] for i in used.tolist()])[:-1]
            kinds, often = np.unique(used, return_counts=True)
            repeats = parts.first[kinds + 1] - parts.first[kinds]
            total = int(repeats.sum())
            where = np.arange(total) + np.repeat(parts.first[kinds] - np.cumsum(repeats) + repeats, repeats)
            times = parts.times[where] * np.repeat(often, repeats)
            self.keys.append(parts.pairs[where] << 15 | pos)
            self.times.append(times)
            self.links += total
            self.docs.append((
                pos, doc_id, int(parts.n_a[used].sum()), int(parts.n_b[used].sum()), int(parts.n_groups[used].sum()),
                int(times.sum()), hashlib.sha256(groups.encode()).hexdigest(),
            ))

    def frames(self) -> Iterator[pd.DataFrame]:
        """The documents' rows, then a row per pair."""
        names = [c.split()[0] for c in DOCS.split(", ")]
        yield pd.DataFrame(self.docs, columns=names).assign(kind="docs")
        if not self.keys:
            return
        size_b = len(self.aligner.bytes_b)
        keys, times = summed(np.concatenate(self.keys), np.concatenate(self.times))
        pairs, docs = keys >> 15, keys & 0x7FFF
        first = np.flatnonzero(np.diff(pairs, prepend=-1))
        for some in np.array_split(first, len(first) // 50_000 + 1):
            ends = np.append(some[1:], first[np.searchsorted(first, some[-1]) + 1 :][:1] if some[-1] != first[-1] else len(pairs))
            made = [planes(docs[i:j], times[i:j]) for i, j in zip(some.tolist(), ends.tolist())]
            yield pd.DataFrame({
                "kind": "postings",
                "a": (pairs[some] // size_b).astype(np.int32),
                "b": (pairs[some] % size_b).astype(np.int32),
                "docs": [len(union(p)) for p in made],
                "planes": made,
            })


def inverted(docs: DataFrame, files: Tokenizers) -> tuple[DataFrame, DataFrame]:
    """(documents, postings) of chunks, written in one pass over the texts.

    A chunk has up to 32,768 documents of one task with about ``MOST_LINKS`` pairs, so it is
    bounded however long the texts are (one very long text is a chunk by itself). Postings
    have a row per pair and chunk.
    """
    columns = f"{DOCS}, {POSTINGS}"

    def made(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        aligner = Aligner(files)
        names = ["kind", "chunk", *[c.split()[0] for c in columns.split(", ")]]
        number, chunk = TaskContext.get().partitionId() << 32, Chunk(aligner)

        def closed() -> Iterator[pd.DataFrame]:
            for frame in chunk.frames():
                frame["chunk"] = number
                frame = frame.reindex(columns=names)
                whole = ["pos", "n_a", "n_b", "n_groups", "n_links", "a", "b", "docs"]
                yield frame.astype({c: "Int64" for c in whole}).astype(
                    {c: object for c in ("doc_id", "groups_sha256", "planes")}
                ).where(lambda f: f.notna(), None)

        for frame in batches_of(frames, MOST_CHARACTERS):
            for first in range(0, len(frame), MOST_DOCS):
                some = frame.iloc[first : first + MOST_DOCS]
                if len(chunk.docs) + len(some) > MOST_DOCS or chunk.links >= MOST_LINKS:
                    yield from closed()
                    number, chunk = number + 1, Chunk(aligner)
                chunk.add(some["doc_id"].tolist(), some["text"].tolist())
        if chunk.docs:
            yield from closed()

    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("string"), F.coalesce("text", F.lit("")).alias("text"))
    rows = texts.mapInPandas(made, f"kind string, chunk bigint, {columns}")
    folder = shared_folder(spark, "align-chunks")
    rows.write.partitionBy("kind").parquet(folder)

    def read(kind: str, schema: str) -> DataFrame:
        written = spark.read.schema(f"chunk bigint, {schema}, kind string").parquet(folder)
        return written.where(F.col("kind") == kind).drop("kind")

    return read("docs", DOCS), read("postings", POSTINGS)


def pair_counts(postings: DataFrame) -> DataFrame:
    """(a, b, count): in how many documents a pair is linked.

    Chunks have no document in common, so the union of a pair's bitmaps has as many
    documents as all of them together; each was counted when it was made.
    """
    return postings.groupBy("a", "b").agg(F.sum("docs").alias("count"))


def aligned(docs: DataFrame, files: Tokenizers) -> DataFrame:
    """Per row of ``docs``: tokens, groups, links, and how the corpus counts the links.

    Postings meet their pairs' counts in a join, and go back to their chunks, where planes
    become each document's times again. The best count per id of A has a row for each id of
    the vocabulary at most, and is broadcast. No group is larger than a chunk.

    A null or empty text, or one that the tokens of either side don't give back byte by
    byte, has no tokens: zeros and an empty digest. Strings of special tokens are text. A
    null doc_id passes as null; repeated rows are a document each; no rows give no rows.
    Other columns of ``docs`` are not read.
    """
    rows, postings = inverted(docs, files)
    counts = pair_counts(postings)
    best = counts.groupBy("a").agg(F.max("count").alias("best"))
    judged = counts.join(F.broadcast(best), "a").select("a", "b", "count", (F.col("count") == F.col("best")).alias("is_best"))
    scored = postings.select("chunk", "a", "b", "planes").join(judged, ["a", "b"]).select("chunk", "planes", "count", "is_best")

    def returned(docs: pd.DataFrame, pairs: pd.DataFrame) -> pd.DataFrame:
        size = int(docs["pos"].max()) + 1 if len(docs) else 0
        total, most = np.zeros(size, np.int64), np.zeros(size, np.int64)
        if len(pairs):
            row, doc, times = expanded(pairs["planes"].tolist())
            np.add.at(total, doc, times * pairs["count"].to_numpy()[row])
            np.add.at(most, doc, times * pairs["is_best"].to_numpy().astype(np.int64)[row])
        at = docs["pos"].to_numpy()
        return docs.drop(columns=["chunk", "pos"]).assign(n_best=most[at], count_sum=total[at])

    result = rows.groupBy("chunk").cogroup(scored.groupBy("chunk")).applyInPandas(
        returned,
        "doc_id string, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
        "n_best bigint, count_sum bigint",
    )
    return result.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))


def op13(docs: DataFrame, files: Tokenizers) -> DataFrame:
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return aligned(docs, files).select(columns)

"""N-gram Jaccard join: prefixes of shingles, rare ones indexed singly, frequent ones in pairs."""

from __future__ import annotations

import hashlib
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from merchant_ledger.llm.common import batches_of, materialize, remove
from merchant_ledger.llm.components import components

SHINGLE = 3
PERCENT = 90
#: A shingle in more sets than this is frequent.
FREQUENT = 100
#: Frequent shingles are paired within so many classes; prefixes are longer by one more.
CLASSES = 32
#: Of sets up to LONGEST_SHORT shingles all pairs of a short prefix are indexed, from SHORTEST_LONG on pairs of a class.
SHORTEST_LONG, LONGEST_SHORT = 46, 56
#: Members of a list that are compared with all others in the first round, and how many times more in the next.
PIVOTS, MORE = 16, 16
#: So many of a member's lists before one are known there, for pairs that those lists have too.
EARLIER = 8
#: Sizes of a list's members are told apart in so many steps for each doubling.
STEPS = 64
#: Ids of documents are broadcast up to this many.
MOST_BROADCAST = 500_000

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def shingle_sets(texts: list[str], size: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct 64-bit hashes of each text's shingles.

    Bytes lower-case and split at exactly the ASCII letters and white space that are asked
    for. All words of a batch are hashed at once.
    """
    split = [text.encode("utf-8", "surrogatepass").lower().split() for text in texts]
    counts = [len(words) for words in split]
    flat = np.array([word for words in split for word in words], dtype=object)
    hashes = pd.util.hash_array(flat, categorize=False) if len(flat) else np.zeros(0, np.uint64)
    ends = np.cumsum(counts)

    def mixed(parts: list[np.ndarray]) -> np.ndarray:
        total = np.full(len(parts[0]), len(parts), dtype=np.uint64)
        for part in parts:
            total = (total * _A + part) * _B
        total ^= total >> np.uint64(29)
        total *= _A
        return total ^ total >> np.uint64(32)

    with np.errstate(over="ignore"):
        n = max(0, len(hashes) - size + 1)
        shingles = mixed([hashes[i : i + n] for i in range(size)]) if n else hashes[:0]
        found = []
        for count, end in zip(counts, ends):
            if count >= size:
                found.append(np.unique(shingles[end - count : end - size + 1]))
            else:
                found.append(mixed([hashes[i : i + 1] for i in range(end - count, end)]) if count else hashes[:0])
    return [each.view(np.int64) for each in found]


def parities(tokens: np.ndarray) -> list[int]:
    """512 bits in eight numbers: of each class of shingles, whether their number is odd.

    Two sets differ in at least as many shingles as their parities differ in bits.
    """
    odd = np.bincount(tokens.view(np.uint64) >> np.uint64(55), minlength=512).astype(np.uint8) & 1
    return np.packbits(odd).view(np.int64).tolist()


def digest(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


def _heads(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """(doc_id, text_hash, n, digest, entries): a set's size, name and extended hash prefix.

    Sets that link share at least 1 + n//10 of the first 1 + 2 * (n//10) in the order of the
    hashes (at 90 percent). Sets that are too small to have other partners than copies have
    no entries.
    """

    def made(frames):
        for frame in batches_of(frames):
            sets = shingle_sets(frame["text"].tolist(), size)
            entries = [s[: 1 + 2 * (len(s) * (100 - percent) // 100)] if _may_differ(len(s), percent) else s[:0] for s in sets]
            yield pd.DataFrame({
                "doc_id": frame["doc_id"].values,
                "text_hash": frame["text_hash"].values,
                "n": [len(s) for s in sets],
                "digest": [digest(s) for s in sets],
                "entries": entries,
            })

    kind = docs.schema["doc_id"].dataType
    texts = docs.select(
        F.col("doc_id").cast("string"), F.xxhash64("text").alias("text_hash"), F.coalesce("text", F.lit("")).alias("text")
    )
    heads = texts.mapInPandas(
        made, "doc_id string, text_hash bigint, n bigint, digest binary, entries array<bigint>"
    )
    return heads.withColumn("doc_id", F.col("doc_id").cast(kind))


def _may_differ(n: int, percent: int) -> bool:
    """Whether a set of n can link with another set, which is one shingle larger at least."""
    return 100 * n >= percent * (n + 1)


def _spare(n: Column, percent: int) -> Column:
    """How many of a set's shingles a partner may lack."""
    return F.floor(n * (100 - percent) / 100)


def _survivors(classes: DataFrame, percent: int) -> DataFrame:
    """Classes with enough entries that another class has too, for any partner they may have.

    Entries that no other class has are counted, by the one class that has them; the others are not moved.
    """
    entries = classes.select("cid", F.explode("entries").alias("h"))
    single = entries.groupBy("h").agg(F.count(F.lit(1)).alias("count"), F.min("cid").alias("cid")).where("count = 1")
    alone = single.groupBy("cid").agg(F.count(F.lit(1)).alias("alone"))
    need = 1 + _spare(F.ceil(F.col("n") * percent / 100), percent)
    sized = classes.withColumn("entries", F.size("entries")).join(alone, "cid", "left")
    return sized.where(F.col("entries") - F.coalesce("alone", F.lit(0)) >= need).drop("entries", "alone")


def _tokens(docs: DataFrame, survivors: DataFrame, size: int) -> DataFrame:
    """(cid, n, h): all shingles of the surviving classes, from one text of each."""
    few = survivors.count() <= MOST_BROADCAST
    wanted = survivors.select("doc_id", "text_hash", "cid", "n", "digest")
    texts = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.coalesce("text", F.lit("")).alias("text"))
    wanted = F.broadcast(wanted) if few else wanted
    same = texts["doc_id"].eqNullSafe(wanted["doc_id"]) & (texts["text_hash"] == wanted["text_hash"])
    texts = texts.join(wanted, same).select("cid", "n", "digest", "text")

    def made(frames):
        for frame in batches_of(frames):
            sets = shingle_sets(frame["text"].tolist(), size)
            same = [digest(s) == bytes(d) for s, d in zip(sets, frame["digest"])]
            yield pd.DataFrame({
                "cid": frame["cid"].values[same],
                "n": frame["n"].values[same],
                "tokens": [s for s, ok in zip(sets, same) if ok],
                "odd": [parities(s) for s, ok in zip(sets, same) if ok],
            })

    rehashed = texts.mapInPandas(made, "cid bigint, n bigint, tokens array<bigint>, odd array<bigint>")
    # Repeated rows of one document give the same class twice; one is enough.
    once = rehashed.groupBy("cid", "n").agg(F.first("tokens").alias("tokens"), F.first("odd").alias("odd"))
    return once.withColumn("odd", F.struct(*[F.col("odd")[i].alias(f"b{i}") for i in range(8)]))


def _signatures(tokens: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """(cid, n, own, odd, tokens) of classes that can link, and their lists (sig, cid, n, own, most).

    ``own`` counts the shingles that no other surviving class has. A class with more of them
    than a partner may lack is out. The rest of a set is ordered from rare to frequent; two
    sets that link share k of the prefix of spare + k. Of short sets k is 2: one of both is
    rare, and found singly, or both are frequent, and found as one of all pairs. Of long sets
    k is CLASSES + 1: one is rare, or two frequent ones are of one class, and found as a
    pair of it. A frequent shingle is never indexed singly. Sets of a length between are indexed both ways.
    If the first shingle that both share is frequent, all are; so rare ones are indexed only as far
    as a first one may stand, which is spare + 1.

    How far into its prefix a set has an entry also bounds the partners that need it: of k shingles
    that both share, the last has rank r in the one set, so the other lacks r - k of those before.
    ``most`` is the largest size of a partner for which that is not too many. Two sets that link have
    a list where the size of each is within the other's ``most``.
    """
    flat = tokens.select("cid", F.explode("tokens").alias("h"))
    shared = flat.groupBy("h").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    known = materialize(flat.join(shared, "h"), "join-shared")
    spare = _spare(F.col("n"), percent)
    alive = (
        known.groupBy("cid").agg(F.count(F.lit(1)).alias("shared"))
        .join(tokens.select("cid", "n", "odd"), "cid")
        .select("cid", "n", (F.col("n") - F.col("shared")).alias("own"), "odd")
        .where(F.col("own") <= spare)
    )
    alive = materialize(alive, "join-alive")
    rank = F.row_number().over(Window.partitionBy("cid").orderBy("df", "h"))
    short = F.col("rank") <= spare + 2 - F.col("own")
    prefix = (
        known.join(alive.drop("odd"), "cid")
        .withColumn("rank", rank)
        .where(F.when(F.col("n") < SHORTEST_LONG, short).otherwise(F.col("rank") <= spare + CLASSES + 1 - F.col("own")))
        .withColumn("short", short & (F.col("n") <= LONGEST_SHORT))
        .withColumn("first", F.col("rank") <= spare + 1 - F.col("own"))
        .where((F.col("df") > FREQUENT) | F.col("first"))
    )
    prefix = materialize(prefix.select("cid", "n", "own", "h", "df", "rank", "short"), "join-prefix")
    remove(known)
    single = prefix.where(F.col("df") <= FREQUENT).select(
        F.struct(F.col("h").alias("a"), F.lit(None).cast("bigint").alias("b")).alias("sig"),
        "cid", "n", "own", (F.col("rank") - 1).alias("lacking"),
    )
    frequent = prefix.where(F.col("df") > FREQUENT)
    long_pairs = _pairs(frequent.where(F.col("n") >= SHORTEST_LONG), [F.pmod("h", F.lit(CLASSES)).alias("class")], CLASSES + 1, lesser_first=True)
    short_pairs = _pairs(frequent.where("short"), [], 2, lesser_first=False)
    lists = single.unionByName(long_pairs).unionByName(short_pairs)
    common = F.col("n") - F.col("own") - F.col("lacking")
    lists = lists.withColumn("most", F.floor(common * (100 + percent) / percent) - F.col("n")).drop("lacking")
    sets = materialize(alive.select("cid", "n", "own", "odd").join(tokens.select("cid", "tokens"), "cid"), "join-sets")
    written = materialize(lists, "join-lists")
    remove(prefix, alive)
    return sets, written


def _pairs(prefix: DataFrame, classes: list[Column], shared: int, lesser_first: bool) -> DataFrame:
    """(sig, cid, n, own, lacking) for all pairs of a set's shingles, or all of one class.

    Pairs of long sets begin with the lesser, those of short sets don't, so they are never taken for each other.
    ``lacking``: shingles before the pair that a partner lacks if the pair is among the first ``shared`` of both.
    """
    grouped = prefix.groupBy("cid", "n", "own", *classes).agg(F.sort_array(F.collect_list(F.struct("h", "rank"))).alias("hs"))

    def pair(x: Column, y: Column) -> Column:
        a, b = (x, y) if lesser_first else (y, x)
        lacking = F.greatest(x["rank"], y["rank"], F.lit(shared)) - shared
        return F.struct(F.struct(a["h"].alias("a"), b["h"].alias("b")).alias("sig"), lacking.alias("lacking"))

    later = F.transform("hs", lambda x, i: F.transform(F.slice("hs", i + 2, F.size("hs")), lambda y: pair(x, y)))
    pairs = grouped.select(F.explode(F.flatten(later)).alias("pair"), "cid", "n", "own")
    return pairs.select("pair.sig", "cid", "n", "own", "pair.lacking")


def _feasible(percent: int) -> Column:
    """Whether two sets can link by their sizes, what only they have, and their parities."""
    differ = sum(F.bit_count(F.col(f"odd.b{i}").bitwiseXOR(F.col(f"p.odd.b{i}"))) for i in range(8))
    both = F.floor((F.col("n") + F.col("p.n") - differ) / 2)
    most = F.least(F.col("n") - F.col("own"), F.col("p.n") - F.col("p.own"), both)
    return 100 * most >= percent * (F.col("n") + F.col("p.n") - most)


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    left = sets.select(F.col("cid").alias("u"), F.col("n").alias("nu"), F.col("tokens").alias("tu"))
    right = sets.select(F.col("cid").alias("v"), F.col("n").alias("nv"), F.col("tokens").alias("tv"))
    both = pairs.join(left, "u").join(right, "v")
    common = F.size(F.array_intersect("tu", "tv"))
    return both.where(100 * common >= percent * (F.col("nu") + F.col("nv") - common)).select("u", "v")


def _with_partners(lists: DataFrame) -> DataFrame:
    """The rows (sig, cid, own) of members that another of their list, or one as they are, may link with by its size.

    Texts that all miss each other by more than a few shingles stand in many lists without a partner in
    any; their rows would be compared with all others. A list's sizes are told in steps, with the
    least size and the largest ``most`` of each, so they are few however long the list is.
    """
    step = F.floor(F.log2("n") * STEPS).alias("step")
    sizes = lists.groupBy("sig", step).agg(F.count(F.lit(1)).alias("members"), F.min("n").alias("least"), F.max("most").alias("most"))
    sizes = sizes.groupBy("sig").agg(
        F.sum("members").alias("members"), F.collect_list(F.struct("least", "most")).alias("sizes")
    ).where("members > 1").drop("members")
    partner = F.exists("sizes", lambda s: (s["least"] <= F.col("most")) & (s["most"] >= F.col("n")))
    return lists.join(sizes, "sig").where(partner).select("sig", "cid", "own")


def _lists_once(lists: DataFrame, sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(list, cid, n, own, odd) and (list, p) of lists with two members or more, and their first pivots.

    Of lists with the same members one is left: a passage that some sets have in common makes
    one for each of its shingles. Members are told by their number and 128 bits. What is known
    of a member is joined to those lists only.
    """
    hubs = lists.groupBy("sig").agg(
        F.count(F.lit(1)).alias("members"),
        F.bit_xor(F.xxhash64("cid")).alias("x"),
        F.bit_xor(F.xxhash64(F.lit(1), "cid")).alias("y"),
        F.min(F.struct("own", "cid")).alias("p"),
    ).where("members > 1")
    hubs = hubs.groupBy("members", "x", "y").agg(F.min(F.struct("sig", "p")).alias("one"))
    hubs = hubs.select("one.sig", F.col("one.p.cid").alias("cid"), F.monotonically_increasing_id().alias("list"))
    hubs = materialize(hubs, "join-hubs")
    known = sets.select("cid", "n", "own", "odd")
    joined = lists.join(hubs.select("sig", "list"), "sig").select("list", "cid").join(known, "cid")
    joined = materialize(joined.select("list", "cid", "n", "own", "odd"), "join-lists")
    pivots = hubs.select("list", "cid").join(known, "cid")
    return joined, pivots.select("list", F.struct("cid", "n", "own", "odd").alias("p"))


def _compared(members: DataFrame, chosen: DataFrame, percent: int) -> DataFrame:
    """(u, v): the pairs of a list's members with its pivots ``chosen`` that can link, most of them once.

    A pair that some list before has too, with one of both as a pivot, is left to that list.
    Each row knows the last ``EARLIER`` of its member's lists, all and those where it is a
    pivot. The first list of a pair is never left out; one too far back makes it come again.
    """
    known = members.join(chosen.select("list", "cid", F.lit(True).alias("led")), ["list", "cid"], "left")
    before = Window.partitionBy("cid").orderBy("list").rowsBetween(-EARLIER, -1)
    known = materialize(
        known.withColumn("seen", F.collect_list("list").over(before)).withColumn(
            "leading", F.collect_list(F.when(F.col("led"), F.col("list"))).over(before)
        ),
        "join-known",
    )
    pivots = known.where("led").select("list", F.struct("cid", "n", "own", "odd", "root", "seen", "leading").alias("p"))
    once = F.col("led").isNull() | (F.col("cid") < F.col("p.cid"))
    had = F.arrays_overlap("seen", "p.leading") | F.arrays_overlap("leading", "p.seen")
    return (
        known.join(pivots, "list")
        .where((F.col("root") != F.col("p.root")) & once & _feasible(percent) & ~had)
        .select(F.least("cid", "p.cid").alias("u"), F.greatest("cid", "p.cid").alias("v"))
    )


def _open(lists: DataFrame, roots: DataFrame) -> DataFrame:
    """The rows of the lists that are not connected, with root, the list's main root and how many are outside of that."""
    named = lists.join(roots.withColumnRenamed("node", "cid"), "cid", "left").withColumn(
        "root", F.coalesce("root", "cid")
    )
    parts = named.groupBy("list", "root").agg(F.count(F.lit(1)).alias("part"))
    open_lists = parts.groupBy("list").agg(
        F.count(F.lit(1)).alias("roots"), F.sum("part").alias("members"), F.max(F.struct("part", "root")).alias("main")
    ).where("roots > 1").select("list", F.col("main.root").alias("main"), (F.col("members") - F.col("main.part")).alias("outside"))
    return materialize(named.join(open_lists, "list"), "join-open")


def _joined(roots: DataFrame, found: DataFrame) -> DataFrame:
    """``roots`` (node, root) when the links ``found`` (u, v) are added. What is not in ``roots`` is its own root."""
    ends = found.join(roots.select(F.col("node").alias("u"), F.col("root").alias("ru")), "u", "left").join(
        roots.select(F.col("node").alias("v"), F.col("root").alias("rv")), "v", "left"
    )
    between = ends.select(F.coalesce("ru", "u").alias("u"), F.coalesce("rv", "v").alias("v"))
    moved = materialize(components(between), "join-moved")
    kept = roots.join(moved.select(F.col("node").alias("root"), F.col("root").alias("to")), "root", "left")
    new = moved.join(roots.select("node"), "node", "left_anti").select("node", "root")
    return kept.select("node", F.coalesce("to", "root").alias("root")).union(new)


def connected(docs: DataFrame, classes: DataFrame, size: int, percent: int) -> DataFrame:
    """(node, root) of the class ids that link, by links that connect what all links connect.

    In each list of an index entry, a few pivots are compared with all that are not yet
    connected with them: first the one with the fewest shingles of its own, then, only outside
    the list's largest component, one of each component before another of any, and more
    of them in each round. A member without a partner of fitting size leaves a list before. A list is done
    when all in it is connected or all outside the largest component were pivots; so no
    link between components is missed, and a list of near copies of one text costs little
    more than its length. Lists with the same members are one, and a pair that several
    lists have is seldom compared in more than one. New links join the components so far, and
    only lists that were open are looked at again; a round without new links changes neither.
    Tables are removed when what follows from them is written.
    """
    survivors = materialize(_survivors(classes, percent), "join-survivors")
    tokens = materialize(_tokens(docs, survivors, size), "join-tokens")
    remove(classes, survivors)
    sets, lists = _signatures(tokens, percent)
    written, lists = lists, materialize(_with_partners(lists), "join-partners")
    remove(written, tokens)
    written = lists
    lists, hubs = _lists_once(written, sets)
    remove(written)
    pairs = (
        lists.join(hubs, "list")
        .where((F.col("cid") != F.col("p.cid")) & _feasible(percent))
        .select(F.least("cid", "p.cid").alias("u"), F.greatest("cid", "p.cid").alias("v"))
        .distinct()
    )
    found = materialize(_verified(pairs, sets, percent), "join-links")
    roots = materialize(components(found), "join-roots")
    open_members = _open(lists, roots)
    remove(lists, found)
    pivots = PIVOTS
    while outside := open_members.agg(F.max("outside")).first()[0]:
        within = F.row_number().over(Window.partitionBy("list", "root").orderBy("own", "cid"))
        ranked = open_members.where("root <> main").withColumn("within", within).where(F.col("within") <= pivots)
        turn = F.row_number().over(Window.partitionBy("list").orderBy("within", "own", "cid"))
        chosen = ranked.withColumn("turn", turn).where(F.col("turn") <= pivots).select("list", "cid")
        pairs = _compared(open_members.drop("main", "outside"), chosen, percent).distinct()
        found = materialize(_verified(pairs, sets, percent), "join-links")
        remove(pairs)
        if found.count():
            before, roots = roots, materialize(_joined(roots, found), "join-roots")
            remove(before)
            before, open_members = open_members, _open(open_members.drop("root", "main", "outside"), roots)
            remove(before)
        remove(found)
        if outside <= pivots:
            break
        pivots *= MORE
    remove(open_members)
    return roots


def near_duplicates(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Per row of ``docs``: doc_id, text_hash, n_shingles, component_id, first_id, first_hash.

    ``component_id`` is the smallest doc_id that links lead to; (``first_id``,
    ``first_hash``) names the one document of each component that a filter is to keep, by
    its doc_id and the hash of its text. Equal sets are one class, so copies are never
    compared with each other. Null and empty texts and texts without words have an empty
    set and link with nothing; shorter texts than a shingle are one shingle as a whole. A
    null doc_id takes part, but names a component only if all its ids are null. Repeated
    rows are repeated in the result. Other columns of ``docs`` are not read.
    """
    heads = materialize(
        _heads(docs, size, percent).withColumn("uid", F.monotonically_increasing_id()), "join-heads"
    )
    name = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    grouped = heads.where("n > 0").groupBy("n", "digest").agg(
        F.min(name).alias("first"), F.min("uid").alias("cid")
    )
    grouped = materialize(grouped, "join-classes")
    classes = grouped.select("cid", "n", "digest").join(
        heads.select(F.col("uid").alias("cid"), "doc_id", "text_hash", "entries").where(F.size("entries") > 0), "cid"
    )
    classes = materialize(classes, "join-entries")
    # The entries stand in that table; without them the heads are small.
    wide, heads = heads, materialize(heads.drop("entries", "uid"), "join-rows")
    remove(wide)
    roots = connected(docs, classes, size, percent)
    named = grouped.join(roots.withColumnRenamed("node", "cid"), "cid", "left").withColumn(
        "root", F.coalesce("root", "cid")
    )
    firsts = named.groupBy("root").agg(F.min("first").alias("component"))
    named = named.select("n", "digest", "root").join(firsts, "root").select("n", "digest", "component")
    alone = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    return (
        heads.join(named, ["n", "digest"], "left")
        .withColumn("component", F.coalesce("component", alone))
        .select(
            "doc_id",
            "text_hash",
            F.col("n").alias("n_shingles"),
            F.col("component.doc_id").alias("component_id"),
            F.col("component.doc_id").alias("first_id"),
            F.col("component.text_hash").alias("first_hash"),
        )
    )


def op7(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs).select("doc_id", "n_shingles", "component_id")


def without_near_duplicates(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One document of each component, with the columns of ``docs``; all without shingles stay.

    Shingles have ``size`` words; ``percent`` (80 at least, by the lengths of the index) is what two sets share.
    A document that is kept but stands there twice, with equal id and text, is kept once.
    """
    found = materialize(near_duplicates(docs, size, percent), "join-kept")
    kept = found.where(
        (F.col("n_shingles") == 0)
        | (F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("text_hash") == F.col("first_hash")))
    )
    keys = materialize(
        kept.groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("_n"), F.max("n_shingles").alias("_s")), "join-keys"
    )
    hashed = docs.select("doc_id", F.xxhash64("text").alias("_hash"), F.struct("*").alias("_row"))
    chosen = hashed.join(
        keys.withColumnRenamed("doc_id", "_id").withColumnRenamed("text_hash", "_key"),
        F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_key")),
    )
    repeated = keys.where("_n > 1 and _s > 0").limit(1).count() > 0
    if not repeated:
        return chosen.select("_row.*")
    once = chosen.where("_n = 1 or _s = 0").select("_row.*")
    return once.union(chosen.where("_n > 1 and _s > 0").dropDuplicates(["doc_id", "_hash"]).select("_row.*"))

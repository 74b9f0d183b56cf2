"""Secret scans: fixed rules, and character Markov models of random strings and of words."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchant_ledger.functions.once import with_once
from merchant_ledger.llm.common import materialize

# The kinds of secrets and how each is found.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex")
#: The kind of what only the models find.
RANDOM = "random"

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
CANDIDATE = r"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_.=-]{20,}"
IDENTIFIER = r"[A-Za-z0-9+/_.=-]{3,}"
#: Ordinary identifiers are learned from at most so many documents, those with the least hashes of their ids.
SAMPLE = 2_000
#: Random strings of which there are as many examples as this besides those in the documents.
GENERATED = 500
#: Log-likelihood ratio in all, and per transition, from which on a string is a secret.
LEAST_RATIO, LEAST_MEAN = 15.0, 0.8

#: Spans have the place of their value, of an assignment the part after its sign.
SPAN = "struct<start:int,kind_no:int,end:int,kind:string,value:int>"
NONE = f"array<{SPAN}>"
#: Long arrays and texts are handled in blocks of so many elements and characters.
BLOCK, CHARACTERS = 128, 4_096


def matches(text: Column, pattern: str) -> Column:
    """Array of (start, end, found), in code points, leftmost and not overlapping.

    What lies between the matches is as long as the parts that they split the text into.
    Matches are gathered in blocks, so that none is copied once for each match after it.
    """
    found, between = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    both = F.arrays_zip(found.alias("found"), between.alias("between"))
    match = "struct<start:int,end:int,found:string>"
    first = F.struct(
        F.lit(0).alias("at"), F.array().cast(f"array<{match}>").alias("block"), F.array().cast(f"array<array<{match}>>").alias("out")
    )

    def add(state: Column, each: Column) -> Column:
        start = state["at"] + F.length(each["between"])
        end = start + F.length(each["found"])
        new = F.array(F.struct(start.alias("start"), end.alias("end"), each["found"].alias("found")))
        any_found, full = each["found"].isNotNull(), F.size(state["block"]) >= BLOCK
        block = F.when(~any_found, state["block"]).when(full, new).otherwise(F.concat(state["block"], new))
        out = F.when(any_found & full, F.concat(state["out"], F.array(state["block"]))).otherwise(state["out"])
        return F.struct(F.coalesce(end, start).alias("at"), block.alias("block"), out.alias("out"))

    return F.aggregate(both, first, add, lambda state: F.flatten(F.concat(state["out"], F.array(state["block"]))))


def _spans(found: Column, kind: str, value: str | None = None) -> Column:
    number = KINDS.index(kind) if kind in KINDS else len(KINDS)
    return F.transform(
        found,
        lambda m: F.struct(
            m["start"].alias("start"), F.lit(number).alias("kind_no"), m["end"].alias("end"), F.lit(kind).alias("kind"),
            (m["end"] - F.length(F.regexp_extract(m["found"], value, 2)) if value else m["start"]).alias("value"),
        ),
    )


def _where_any(text: Column, pattern: str, spans: Column, kind: str = NONE) -> Column:
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast(kind))


def base_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``_base``: the spans that the fixed rules find, sorted."""
    column = F.coalesce(F.col(text), F.lit(""))
    values = F.filter(
        matches(column, ASSIGN), lambda m: F.length(F.regexp_extract(m["found"], f"^{ASSIGN}", 2)) >= 8
    )
    found = with_once(docs, {
        "_assign": _where_any(column, ASSIGN, _spans(values, "assign", f"^{ASSIGN}")),
        "_access": _where_any(column, ACCESS, _spans(matches(column, ACCESS), "access")),
        "_hex": _where_any(column, HEX, _spans(matches(column, HEX), "hex")),
    })
    return with_once(found, {"_base": F.sort_array(F.concat("_assign", "_access", "_hex"))}).drop(
        "_assign", "_access", "_hex"
    )


def blocks_of(text: Column) -> Column:
    """The text in blocks of ``CHARACTERS``, for ``piece``: to find a place in the text itself
    takes a walk from its start."""
    starts = F.sequence(F.lit(0), F.length(text), F.lit(CHARACTERS))
    return F.transform(starts, lambda at: F.substring(text, at + 1, F.lit(CHARACTERS)))


def piece(blocks: Column, start: Column, end: Column) -> Column:
    """What stands from ``start`` to ``end`` in a text of ``blocks``."""
    first = F.floor(start / CHARACTERS).cast("int")
    count = F.floor((end - 1) / CHARACTERS).cast("int") - first + 1
    near = F.array_join(F.slice(blocks, first + 1, F.greatest(count, F.lit(0))), "")
    return F.when(end > start, F.substring(near, start - first * CHARACTERS + 1, end - start)).otherwise("")


def in_blocks(spans: Column) -> Column:
    """Array of (spans, low, high): sorted spans in blocks, and where those of a block lie."""
    starts = F.when(F.size(spans) > 0, F.sequence(F.lit(1), F.size(spans), F.lit(BLOCK))).otherwise(F.array().cast("array<int>"))
    return F.transform(
        F.transform(starts, lambda i: F.slice(spans, i, F.lit(BLOCK))),
        lambda b: F.struct(
            b.alias("spans"), F.get(b, F.lit(0))["start"].alias("low"), F.array_max(F.transform(b, lambda s: s["end"])).alias("high")
        ),
    )


def overlapped(m: Column, blocks: Column) -> Column:
    """Whether a match shares a character with any of the spans in ``blocks``."""
    meets = lambda s: (s["start"] < m["end"]) & (s["end"] > m["start"])
    return F.exists(blocks, lambda b: (b["low"] < m["end"]) & (b["high"] > m["start"]) & F.exists(b["spans"], meets))


def labelled_samples(docs: DataFrame, found: DataFrame) -> DataFrame:
    """(string, random): what the rules found in ``found`` and generated digests; ordinary words."""
    spark = docs.sparkSession
    secrets = found.where(F.size("_base") > 0).select(F.explode(F.col("values")).alias("string"))
    digest = F.sha2(F.col("id").cast("string"), 256)
    generated = spark.range(GENERATED).select(
        F.explode(F.array(F.regexp_replace(F.base64(F.unhex(digest)), "=", ""), F.substring(digest, 1, 40))).alias("string")
    )
    ids = docs.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    texts = docs.join(F.broadcast(ids), "doc_id", "left_semi").select("text")
    for pattern in (ASSIGN, ACCESS, HEX):
        texts = texts.withColumn("text", F.regexp_replace("text", pattern, " "))
    ordinary = texts.select(F.explode(F.regexp_extract_all("text", F.lit(IDENTIFIER), F.lit(0))).alias("string"))
    # What is to be judged is not learned from, but for paths and names without digits that recur.
    judged = F.col("string").rlike(f"^{CANDIDATE}$")
    names = ordinary.where(judged & ~F.col("string").rlike("[0-9]")).groupBy("string").agg(F.count(F.lit(1)).alias("n"))
    names = names.where("n > 1").select(F.explode(F.array_repeat("string", F.col("n").cast("int"))).alias("string"))
    ordinary = ordinary.where(~judged).union(names)
    return (
        secrets.union(generated).select("string", F.lit(True).alias("random"))
        .union(ordinary.select("string", F.lit(False).alias("random")))
    )


def train(samples: DataFrame, smooth: float = 10.0) -> list[float]:
    """Log ratios of all transitions between two characters, random over ordinary.

    A transition's probability is mixed with that of its second character alone, which
    counts as ``smooth`` transitions. One row per transition comes to the driver, 68 * 68
    at most for each model.
    """
    characters, pairs = F.split("string", ""), F.length("string") - 1
    pair = F.zip_with(F.slice(characters, F.lit(1), pairs), F.slice(characters, F.lit(2), pairs), lambda a, b: F.concat(a, b))
    counts = (
        samples.where(F.length("string") > 1).select("random", F.explode(pair).alias("pair"))
        .where(F.col("pair").rlike(r"^[A-Za-z0-9+/_.=-]{2}$"))
        .groupBy("random", "pair").count().collect()
    )
    seen = {(r["random"], r["pair"]): r["count"] for r in counts}
    logs = {}
    for random in (True, False):
        rows = {a: [seen.get((random, a + b), 0) for b in ALPHABET] for a in ALPHABET}
        single = [sum(column) + 0.1 for column in zip(*rows.values())]
        for a, row in rows.items():
            shares = [(n + smooth * k / sum(single)) / (sum(row) + smooth) for n, k in zip(row, single)]
            logs[random, a] = [math.log(p) for p in shares]
    return [r - o for a in ALPHABET for r, o in zip(logs[True, a], logs[False, a])]


def table_of(model: list[float]) -> Column:
    """The model's log ratios; a column of its own, not to be made anew for each character."""
    return F.split(F.lit(",".join(f"{x:.4f}" for x in model)), ",").cast("array<double>")


def log_ratio(string: Column, table: Column) -> Column:
    """Sum of the log ratios in ``table`` over a string's transitions."""
    place = lambda c: F.call_function("locate", c, F.lit(ALPHABET))

    def add(state: Column, c: Column) -> Column:
        now = place(c)
        step = F.when(state["before"] > 0, F.element_at(table, (state["before"] - 1) * len(ALPHABET) + now)).otherwise(0.0)
        return F.struct(now.alias("before"), (state["total"] + step).alias("total"))

    first = F.struct(F.lit(0).alias("before"), F.lit(0.0).alias("total"))
    return F.aggregate(F.split(string, ""), first, add, lambda state: state["total"])


def scan(docs: DataFrame, model: list[float] | None = None) -> DataFrame:
    """``docs`` with ``_base`` and ``_all``: sorted arrays of (start, kind_no, end, kind).

    Rules first; then every further string of 20 or more characters of the alphabet that
    overlaps no span, and is likelier as a random string than as an ordinary
    identifier by the two Markov models (``train``; learned from ``docs`` if not given).
    Texts are read whole and rows are never shuffled. Null and empty texts have no spans;
    without any document the models know the generated strings only. Repeated rows are
    scanned each; other columns pass through, but for ``_base`` and ``_all``.
    """
    docs = docs.drop("_base", "_all", "_near", "_candidates", "_table")
    if model is None:
        text = F.coalesce(F.col("text"), F.lit(""))
        found = base_spans(docs.select("text")).where(F.size("_base") > 0)
        found = with_once(found, {"_blocks": blocks_of(text)})
        values = F.transform("_base", lambda s: piece(F.col("_blocks"), s["value"], s["end"]))
        found = materialize(found.select("_base", values.alias("values")), "secret-values")
        model = train(labelled_samples(docs, found))
    text = F.coalesce(F.col("text"), F.lit(""))
    based = with_once(base_spans(docs), {"_near": in_blocks(F.col("_base"))})
    candidates = F.filter(matches(text, CANDIDATE), lambda m: ~overlapped(m, F.col("_near")))
    listed = with_once(based, {
        "_candidates": _where_any(text, CANDIDATE, candidates, "array<struct<start:int,end:int,found:string>>")
    })
    listed = with_once(listed, {"_table": F.when(F.size("_candidates") > 0, table_of(model))})

    def random(m: Column) -> Column:
        least = F.greatest(F.lit(LEAST_RATIO), LEAST_MEAN * (F.length(m["found"]) - 1))
        return log_ratio(m["found"], F.col("_table")) >= least

    more = _spans(F.filter("_candidates", random), RANDOM)
    return with_once(listed, {"_all": F.sort_array(F.concat("_base", more))}).drop("_candidates", "_near", "_table")


def written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op3(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, counts by kind, the digest of the rules' spans, and all spans."""
    count = lambda kind: F.size(F.filter("_base", lambda s: s["kind"] == kind)).cast("long")
    return scan(docs.select("doc_id", "text")).select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in KINDS],
        F.sha2(written(F.col("_base")).cast("binary"), 256).alias("base_sha256"),
        written(F.col("_all")).alias("spans"),
    )


def redacted(docs: DataFrame, mark: str = "[secret]") -> DataFrame:
    """``docs`` with each stretch of secrets in the text replaced by ``mark``.

    Of an assignment only the value goes. Null texts stay null.
    """
    text = F.col("text")
    rows = scan(docs.select("doc_id", "text", F.struct("*").alias("_row")))
    rows = with_once(rows, {"_blocks": blocks_of(F.when(F.size("_all") > 0, text).otherwise(""))})
    strings = "array<string>"

    def step(state: Column, span: Column) -> Column:
        before = piece(F.col("_blocks"), state["at"], F.greatest(span["value"], state["at"]))
        new = F.when(span["value"] >= state["at"], F.concat(before, F.lit(mark))).otherwise("")
        full = F.size(state["block"]) >= BLOCK
        return F.struct(
            F.greatest(state["at"], span["end"]).alias("at"),
            F.when(full, F.array(new)).otherwise(F.concat(state["block"], F.array(new))).alias("block"),
            F.when(full, F.concat(state["out"], F.array(F.array_join(state["block"], "")))).otherwise(state["out"]).alias("out"),
        )

    first = F.struct(F.lit(0).alias("at"), F.array().cast(strings).alias("block"), F.array().cast(strings).alias("out"))
    rebuilt = F.aggregate("_all", first, step, lambda s: F.concat(
        F.array_join(s["out"], ""), F.array_join(s["block"], ""), piece(F.col("_blocks"), s["at"], F.length(text))
    ))
    new = F.when(F.size("_all") > 0, rebuilt).otherwise(text).alias("text")
    return rows.select(*[new if c == "text" else F.col("_row")[c].alias(c) for c in docs.columns])

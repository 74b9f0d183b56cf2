"""Quality rules as weak supervision: rules vote, and their accuracies are estimated."""

from __future__ import annotations

import math
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchant_ledger.functions.once import with_once
from merchant_ledger.llm.common import materialize, words

WINDOW = 8
SYMBOLS = r"[#*$%&|<>]"
VISIBLE = r"[^\x20\x09-\x0D]"


def _joined(step: int) -> Column:
    """Hashes of twice as many words: each with the one ``step`` places on."""
    return F.transform("_hash", lambda x, i: F.xxhash64(x, F.get("_hash", i + step)))


def measures(docs: DataFrame) -> DataFrame:
    """doc_id with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and shares.

    Windows of eight words are hashed by doubling: hashes of one, two, four, eight words.
    Only where two of a text's windows are equal are the windows sorted to find which words
    lie in them. A null text has no words.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    df = with_once(docs.select("doc_id", "text"), {"_words": words(F.col("text"))})
    df = with_once(df, {"_hash": F.transform("_words", lambda w: F.xxhash64(w))})
    for step in (1, 2, 4):
        df = with_once(df, {"_hash": _joined(step)})
    df = with_once(df, {"_hash": F.slice("_hash", F.lit(1), F.greatest(F.size("_words") - (WINDOW - 1), F.lit(0)))})
    df = with_once(df, {
        "_sorted": F.when(
            F.size(F.array_distinct("_hash")) < F.size("_hash"),
            F.sort_array(F.transform("_hash", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ).otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))
    }).drop("_hash")
    same = lambda e, i: F.coalesce(F.get("_sorted", i)["h"] == e["h"], F.lit(False))
    repeated = F.filter(
        F.transform("_sorted", lambda e, j: F.when(same(e, j - 1) | same(e, j + 1), e["i"])), lambda i: i.isNotNull()
    )
    df = with_once(df, {"_starts": F.sort_array(repeated)}).drop("_sorted")
    covered = F.aggregate(
        "_starts",
        F.struct(F.lit(0).alias("until"), F.lit(0).alias("n")),
        lambda s, i: F.struct(
            (i + WINDOW).alias("until"), (s["n"] + i + WINDOW - F.greatest(i, s["until"])).alias("n")
        ),
        lambda s: s["n"],
    )
    df = with_once(df, {"_lines": F.filter(F.split(text, "\n"), lambda line: line.rlike(VISIBLE))})
    letters = F.length(F.regexp_replace(text, "[^A-Za-z]+", ""))
    return df.select(
        "doc_id",
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        covered.cast("long").alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        F.size(F.array_distinct("_words")).cast("long").alias("n_distinct"),
        F.regexp_count(text, F.lit("[!?]{2,}")).cast("long").alias("n_shouts"),
        letters.cast("long").alias("n_letters"),
        F.length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long").alias("n_capitals"),
    )


def _vote(value: Column, bad: Column, good: Column | None = None) -> Column:
    """0 bad, 1 good, null abstains; a value that can't be told (no words) abstains."""
    told = F.when(value.isNull(), None).when(bad, 0)
    return told.cast("int") if good is None else told.when(good, 1)


def votes() -> dict[str, Column]:
    """The rules. Those for one kind of fault say nothing of texts without it.

    If they called these good, texts with another fault would have many good votes, which
    are no evidence of their own; only general measures vote both ways.
    """
    per = lambda n, all_: F.col(n) / F.nullif(F.col(all_), F.lit(0))
    length, mean, symbols = F.col("n_words"), per("word_chars", "n_words"), per("n_symbols", "n_words")
    lines, repeats, shouts = per("n_dup_lines", "n_lines"), per("n_repeat_words", "n_words"), per("n_shouts", "n_words")
    capitals, kinds = per("n_capitals", "n_letters"), F.log("n_distinct") / F.nullif(F.log("n_words"), F.lit(0.0))
    return {
        "length": _vote(length, length < 20, length >= 40),
        "mean_word": _vote(mean, (mean < 2) | (mean > 20), (mean >= 3) & (mean <= 12)),
        "kinds": _vote(kinds, kinds <= 0.6, kinds >= 0.75),
        "symbols": _vote(symbols, symbols >= 0.15),
        "lines": _vote(lines, lines >= 0.3),
        "repeats": _vote(repeats, repeats > 0.3),
        "shouts": _vote(shouts, shouts >= 0.15),
        "capitals": _vote(capitals, capitals >= 0.5),
    }


def accuracies(patterns: list[tuple[tuple, int]], n_rules: int, rounds: int = 100) -> tuple[float, list[dict]]:
    """Expectation-maximisation over how often each pattern of votes occurs.

    Returns the share of good texts and for each rule the probability of each vote, given
    good and bad. There are at most 3 ** n_rules patterns, however
    many documents. Without patterns the prior is even and rules say nothing.
    """
    good = [_doubt(p) for p, _ in patterns]
    share, tables = 0.5, [dict.fromkeys(product((1, 0), (1, 0, None)), 1 / 3) for _ in range(n_rules)]
    everything = sum(n for _, n in patterns)
    for _ in range(rounds if everything else 0):
        weight = {1: sum(g * n for g, (_, n) in zip(good, patterns))}
        weight[0] = everything - weight[1]
        share = (weight[1] + 1) / (everything + 2)
        for k, table in enumerate(tables):
            for kind, vote in table:
                told = sum((g if kind else 1 - g) * n for g, (p, n) in zip(good, patterns) if p[k] == vote)
                table[kind, vote] = (told + 1) / (weight[kind] + 3)
        good = [_posterior(p, share, tables) for p, _ in patterns]
    return share, tables


def _doubt(pattern: tuple) -> float:
    """Where it starts from: a text that any rule calls bad is likely bad.

    Each kind of bad text breaks one rule, so majorities would call all of them good.
    """
    return 0.1 if 0 in pattern else 0.9


def _odds(table: dict, vote: int | None) -> float:
    """What a rule's vote adds to the log odds. No vote counts as the contrary of itself.

    That a rule abstains is evidence too: it does so more often for one kind of text.
    """
    odds = math.log(table[1, vote] / table[0, vote])
    return odds if vote is None else max(0.0, odds) if vote else min(0.0, odds)


def _posterior(pattern: tuple, share: float, tables: list[dict]) -> float:
    odds = math.log(share / (1 - share)) + sum(_odds(t, v) for t, v in zip(tables, pattern))
    return 1 / (1 + math.exp(-max(-500.0, min(500.0, odds))))


def judge(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """The measures of each document with base_failed, ``quality`` (a probability) and kept.

    The measures are written once, a row of numbers per document; the votes' patterns are
    counted over all documents. Null and empty texts fail the base rule; ties and repeated
    rows are judged alike; no documents give no rows. Only doc_id and text are read.
    """
    measured = materialize(measures(docs), "rules-measures")
    rules = votes()
    voted = measured.select("*", *[v.alias(f"_{k}") for k, v in rules.items()])
    names = [f"_{k}" for k in rules]
    patterns = [(tuple(r[n] for n in names), r["count"]) for r in voted.groupBy(*names).count().collect()]
    share, tables = accuracies(patterns, len(rules))
    odds = F.lit(math.log(share / (1 - share)))
    for name, table in zip(names, tables):
        odds += F.when(F.col(name) == 1, _odds(table, 1)).when(F.col(name) == 0, _odds(table, 0)).otherwise(
            _odds(table, None)
        )
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    scored = voted.select(*measured.columns, (1 / (1 + F.exp(-odds))).alias("quality"), failed.alias("base_failed"))
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= least))


def op8(docs: DataFrame) -> DataFrame:
    return judge(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality"
    )

"""Quality rules by weak supervision.

Each rule votes good (1) or junk (0) or abstains, from counts made of the whole text. Expectation-maximisation over the
table of vote patterns estimates how good each rule is (its chance of each vote for good and for junk texts, apart from
abstentions) and the share of good texts; a text's posterior probability of being good replaces the demand that every
rule passes. The table has at most 3**(number of rules) rows whatever the input; it alone goes to the driver.

Words are maximal runs of code points other than 0x20 and 0x09-0x0D; lines are what lies between line feeds.

Cases: a null text counts as empty; it has no words, fails the base rules, and its rules abstain (posterior: the
estimated share). Texts of any length are counted whole, inside their row. Equal texts get equal results. Extra columns
pass through; output columns that clash get a numbered name. An empty table gives an empty table.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import apart, cut, fresh

MIN_WORDS = 50
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Rule -> (measure, good at most, junk from); between the two it abstains. Per word, per character of words or per line.
#: Several rules look at each kind of junk, so that their agreement shows in the vote patterns.
RULES = {
    "symbols": ("symbols_per_word", 0.05, 0.3),
    "symbol_chars": ("symbols_per_char", 0.01, 0.05),
    "other_chars": ("other_per_char", 0.06, 0.12),
    "repeats": ("repeats_per_word", 0.1, 0.4),
    "same_words": ("same_per_word", 0.7, 0.85),
    "dup_lines": ("dup_lines_per_line", 0.1, 0.4),
    "capitals": ("capitals_per_char", 0.12, 0.3),
    "marks": ("marks_per_word", 0.05, 0.3),
    "long_words": ("chars_per_word", 9.0, 14.0),
}
RULE_NAMES = tuple(RULES)
KEEP_FROM = 0.5


def _count(text: Column, pattern: str) -> Column:
    """Number of code points of ``text`` in matches of ``pattern``."""
    return (F.length(text) - F.length(F.regexp_replace(text, pattern, ""))).cast("long")


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is computed once; a column used inside a lambda would be put in place of each use."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _repeat_words(w: Column) -> Column:
    """Words of ``w`` in three-word windows found twice or more. Texts without such a window need no sorting."""

    def covered(hashes: Column) -> Column:
        rows = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        again = _let(rows, lambda s: F.transform(F.filter(s, lambda x, k: (x["h"] == F.get(s, k - 1)["h"]) | (x["h"] == F.get(s, k + 1)["h"])), lambda x: x["i"]))
        # each window in ascending order covers what reaches beyond the one before
        steps = _let(F.sort_array(again), lambda a: F.transform(a, lambda i, k: F.when(k == 0, F.lit(3)).otherwise(F.least(F.lit(3), i - F.get(a, k - 1)))))
        return F.aggregate(steps, F.lit(0), lambda acc, x: acc + x)

    hashes = F.transform(F.slice(w, 1, F.greatest(F.size(w) - 2, F.lit(0))), lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))
    return _let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h)))


def _measures(df: DataFrame, text_col: str, name: str) -> DataFrame:
    """``df`` with the counts and the rules' further measures in one struct column ``name``."""
    text = F.coalesce(F.col(text_col), F.lit(""))

    def counts(w: Column, lines: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            _count(text, "[#*$%&|<>]+").alias("n_symbols"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
            _repeat_words(w).cast("long").alias("n_repeat_words"),
            F.size(lines).cast("long").alias("lines"),
            _count(text, "\\p{Lu}+").alias("capitals"),
            _count(text, "[!?]+").alias("marks"),
            (F.size(w) - F.size(F.array_distinct(w))).cast("long").alias("same"),
            _count(text, "[^\\p{L}\\p{N}\\x20\\x09-\\x0D]+").alias("others"),
        )

    words = F.array_remove(F.split(text, "[\\x20\\x09-\\x0D]+"), "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    return df.withColumn(name, _let(F.struct(words.alias("w"), lines.alias("l")), lambda x: counts(x["w"], x["l"])))


def votes(m: Column) -> Column:
    """A pattern of the rules' votes as text, a character for each rule: 1 good, 0 junk, - abstains."""
    per = {
        "symbols_per_word": m["n_symbols"] / F.nullif(m["n_words"], F.lit(0)),
        "repeats_per_word": m["n_repeat_words"] / F.nullif(m["n_words"], F.lit(0)),
        "dup_lines_per_line": m["n_dup_lines"] / F.nullif(m["lines"], F.lit(0)),
        "capitals_per_char": m["capitals"] / F.nullif(m["word_chars"], F.lit(0)),
        "symbols_per_char": m["n_symbols"] / F.nullif(m["word_chars"], F.lit(0)),
        "other_per_char": m["others"] / F.nullif(m["word_chars"], F.lit(0)),
        "same_per_word": m["same"] / F.nullif(m["n_words"], F.lit(0)),
        "marks_per_word": m["marks"] / F.nullif(m["n_words"], F.lit(0)),
        "chars_per_word": m["word_chars"] / F.nullif(m["n_words"], F.lit(0)),
    }
    return F.concat(*[F.when(per[x] <= good, "1").when(per[x] >= junk, "0").otherwise("-") for x, good, junk in RULES.values()])


def expectation_maximisation(patterns: dict[str, int], rounds: int = 200) -> dict[str, float]:
    """Pattern -> probability that a text with these votes is good.

    Two hidden classes; given the class, votes are independent. Starts from texts without a junk vote as probably good.
    Chances are smoothed by one vote, so that no single vote is certain. A rule is never taken for worse than chance.
    """
    rules = max((len(p) for p in patterns), default=0)
    good = {p: 0.1 if "0" in p else 0.9 for p in patterns}
    total = sum(patterns.values())
    for _ in range(rounds):
        share = (sum(n * good[p] for p, n in patterns.items()) + 1) / (total + 2)
        ones = []
        for j in range(rules):
            chance = []
            for side in (0, 1):
                weight = {p: n * (good[p] if side else 1 - good[p]) for p, n in patterns.items() if p[j] != "-"}
                chance.append((sum(x for p, x in weight.items() if p[j] == "1") + 0.5) / (sum(weight.values()) + 1))
            if chance[0] > chance[1]:
                chance = [sum(chance) / 2] * 2
            ones.append(chance)
        moved = 0.0
        for p in patterns:
            odds = math.log(share) - math.log1p(-share)
            for j, v in enumerate(p):
                if v != "-":
                    a, b = ones[j]
                    odds += math.log(b / a) if v == "1" else math.log((1 - b) / (1 - a))
            x = 1 / (1 + math.exp(-max(-500.0, min(500.0, odds))))
            moved = max(moved, abs(x - good[p]))
            good[p] = x
        if moved < 1e-9:
            break
    return good


def judge(df: DataFrame, text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """Adds the counts, ``votes``, ``posterior``, ``base_failed`` and ``kept``.

    Without the text in the result, the counts are made once and kept in the shared folder; with it they are made twice,
    for the table of votes and for the result. Kept with the texts they would be made once, but then the pipeline on
    0.51 GB was stopped by an executor's memory. A filter on the result is not put before the counts, where it would make
    them for itself once more.
    """
    names = {c: fresh(df, c) for c in (*COUNTS, "votes", "posterior", "base_failed", "kept")}
    own = fresh(df, "rules_measures")
    m = F.col(own)
    measured = _measures(df, text_col, own).withColumns({**{names[c]: m[c] for c in COUNTS}, names["votes"]: votes(m)}).drop(own)
    if not keep_text:
        measured = cut(measured.drop(text_col))
    counted = measured.groupBy(F.col(names["votes"]).alias("v")).count().collect()  # at most 3**rules rows
    posterior = expectation_maximisation({r["v"]: r["count"] for r in counted})
    rows = sorted(posterior.items()) or [("", 0.0)]
    n, repeats = F.col(names["n_words"]), F.col(names["n_repeat_words"])
    failed = (n < MIN_WORDS) | (100 * repeats > 50 * n)
    table = df.sparkSession.createDataFrame(rows, f"{names['votes']} string, {names['posterior']} double")
    return apart(measured).join(F.broadcast(table), names["votes"], "left").withColumn(names["base_failed"], failed).withColumn(names["kept"], ~failed & (F.coalesce(F.col(names["posterior"]), F.lit(0.0)) >= KEEP_FROM))

"""Quality rules under weak supervision: rules vote or abstain, expectation-maximisation weighs them.

Each rule looks at one statistic of a text and votes 2 (good), 1 (doubtful) or 0 (bad); it abstains (null) on texts too short
to tell. What is behind the votes is hidden: a document is good, or junk of the kind that one of the rules is made for; kinds
of junk pass most rules against the others, so each has its own accuracies. Votes are counted per pattern (4 ** rules patterns
at most, whatever the number of documents); expectation-maximisation over the pattern counts estimates, without any label,
how often each rule gives each vote on good documents and on each kind of junk, and the shares of these. Before that, each of
them is believed as ``GOOD`` and ``JUNK`` say, with the weight of ``BELIEF`` document, so data decide. The posterior
probability of being good decides on a document: a bad vote that a rule gives good documents too does not drop one, and
several doubtful votes can.

All of it is DataFrame operations: texts are read once and their statistics are stored; the driver estimates from the counts of
the patterns, which are at most 16,384 rows.

Defined cases: a null or empty text has no words and fails the base rules; repeated rows get the same verdict, as do equal
texts; all of a very long text counts; an empty table gives an empty result; further columns of the input are ignored, and
``filter_quality`` returns them unchanged; there rows with a null or repeated doc_id are each judged by their own text.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import TEXT_KEYS, stored, with_text_keys, without

SPACES = r"[\x20\x09-\x0D]+"
WINDOW = 8
#: Rule: (statistic, value up to or from which it votes good, value from or up to which it votes bad, least words).
RULES = {
    "word_size": ("mean_word", 9.0, 12.0, 1),
    "symbols": ("symbols_per_word", 0.1, 0.4, 1),
    "capitals": ("capital_share", 0.15, 0.4, 8),
    "exclamations": ("exclamations_per_word", 0.05, 0.25, 8),
    "line_copies": ("dup_line_share", 0.2, 0.5, 1),
    "repeats": ("repeat_share", 0.05, 0.2, 16),
    "variety": ("distinct_share", 0.5, 0.25, 50),
}
#: What is believed of a vote (bad, doubtful, good) beforehand: by a rule on other documents than its kind of junk, and on that.
GOOD, JUNK = (0.002, 0.048, 0.95), (0.8, 0.15, 0.05)
PRIOR_GOOD = 0.86
#: Documents that these beliefs count as: so few that data decide, and none of a kind's chances becomes 0.
BELIEF = 1.0
ROUNDS = 60
#: Documents whose posterior probability of being good is at least this are kept.
THRESHOLD = 0.5


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, n_words and the statistics that rules and base rules use, a row for each row of ``docs``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    found = docs.select("doc_id", text.alias("text")).withColumn("words", F.array_remove(F.split("text", SPACES), ""))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    found = found.withColumns({"n_words": F.size("words").cast("long"), "lines": lines})
    # A hash of each window of eight words, from those of its halves; the windows of a text are told apart by 64 bits.
    found = found.withColumn("h1", F.transform("words", lambda w: F.xxhash64(w)))
    for half in (1, 2, 4):
        later = F.slice(f"h{half}", half + 1, F.greatest(F.lit(0), F.size(f"h{half}") - half))
        pairs = F.zip_with(F.slice(f"h{half}", 1, F.greatest(F.lit(0), F.size(f"h{half}") - half)), later, lambda x, y: F.xxhash64(x, y))
        found = found.withColumn(f"h{2 * half}", pairs)
    found = found.withColumnRenamed(f"h{WINDOW}", "windows")
    found = found.withColumn("repeats", F.size("windows") > F.size(F.array_distinct("windows")))
    # Where there are repeats: windows in order of their hash, equal ones next to each other.
    placed = F.sort_array(F.arrays_zip(F.col("windows").alias("h"), F.sequence(F.lit(1), F.size("windows")).alias("at")))
    found = found.withColumn("placed", F.when(F.col("repeats"), placed))
    again = F.sequence(F.lit(1), F.size("placed"))
    is_again = lambda i: ((i > 1) & (F.col("placed")[i - 1]["h"] == F.col("placed")[i - 2]["h"])) | ((i < F.size("placed")) & (F.col("placed")[i - 1]["h"] == F.col("placed")[i]["h"]))
    at = F.sort_array(F.transform(F.filter(again, is_again), lambda i: F.col("placed")[i - 1]["at"]))
    found = found.withColumn("at", F.when(F.col("repeats"), at))
    # Words that the windows cover: each adds up to eight, as far as the next one begins.
    gaps = F.transform(F.sequence(F.lit(2), F.size("at")), lambda i: F.least(F.lit(WINDOW), F.col("at")[i - 1] - F.col("at")[i - 2]))
    covered = F.aggregate(gaps, F.lit(WINDOW), lambda a, x: a + x)
    count = lambda chars: F.length(F.regexp_replace("text", f"[^{chars}]+", "")).cast("long")
    found = found.select(
        "doc_id",
        "n_words",
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        count("#*$%&|<>").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(F.when(F.col("repeats"), covered), F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        F.size(F.array_distinct("words")).cast("long").alias("n_distinct"),
        count(r"\p{Lu}").alias("n_capitals"),
        count("!").alias("n_exclamations"),
    )
    per = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)
    return found.select(
        *["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"],
        per("word_chars", "n_words").alias("mean_word"),
        per("n_symbols", "n_words").alias("symbols_per_word"),
        per("n_capitals", "word_chars").alias("capital_share"),
        per("n_exclamations", "n_words").alias("exclamations_per_word"),
        per("n_dup_lines", "n_lines").alias("dup_line_share"),
        per("n_repeat_words", "n_words").alias("repeat_share"),
        # Long texts use fewer different words; by the root the share hardly depends on length.
        F.when(F.col("n_words") >= 50, F.least(F.lit(1.0), F.col("n_distinct") / F.pow(F.col("n_words").cast("double"), 0.75))).otherwise(F.lit(1.0)).alias("distinct_share"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def votes() -> dict[str, Column]:
    """The vote of each rule: 2, 1, 0 or null."""
    out = {}
    for name, (stat, good, bad, least) in RULES.items():
        x = F.col(stat)
        yes, no = (x <= good, x >= bad) if good < bad else (x >= good, x <= bad)
        out[name] = F.when(F.col("n_words") >= least, F.when(yes, 2).when(no, 0).otherwise(1))
    return out


def beliefs(rules: int) -> tuple[np.ndarray, np.ndarray]:
    """Before any vote: P(vote | kind) by (kind, rule, vote), the good documents first, and the shares of the kinds."""
    chances = np.tile(np.array(GOOD), (rules + 1, rules, 1))
    chances[np.arange(rules) + 1, np.arange(rules)] = JUNK
    return chances, np.array([PRIOR_GOOD, *[(1 - PRIOR_GOOD) / rules] * rules])


def expected(patterns: np.ndarray, chances: np.ndarray, shares: np.ndarray) -> np.ndarray:
    """P(kind | votes) by (pattern, kind); a vote of -1 is an abstention, which tells nothing."""
    logs = np.tile(np.log(shares), (len(patterns), 1))
    for k in range(patterns.shape[1]):
        voted = patterns[:, k] >= 0
        logs[voted] += np.log(chances[:, k, :])[:, patterns[voted, k]].T
    raised = np.exp(logs - logs.max(axis=1, keepdims=True))
    return raised / raised.sum(axis=1, keepdims=True)


def maximised(patterns: np.ndarray, n: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Chances and shares after so many rounds of expectation and maximisation."""
    believed, shares_before = beliefs(patterns.shape[1])
    chances, shares = believed.copy(), shares_before.copy()
    for _ in range(rounds):
        mass = expected(patterns, chances, shares) * n[:, None]
        shares = (mass.sum(axis=0) + BELIEF * shares_before) / (mass.sum() + BELIEF)
        for k in range(patterns.shape[1]):
            for vote in range(3):
                chances[:, k, vote] = mass[patterns[:, k] == vote].sum(axis=0) + BELIEF * believed[:, k, vote]
            chances[:, k] /= chances[:, k].sum(axis=1, keepdims=True)
    return chances, shares


def estimate(stats: DataFrame, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Chances and shares; the driver sees the pattern counts alone."""
    counted = stats.select(*[v.alias(k) for k, v in votes().items()]).groupBy(*RULES).agg(F.count("*").alias("n")).collect()
    patterns = np.array([[-1 if r[k] is None else r[k] for k in RULES] for r in counted], int).reshape(-1, len(RULES))
    return maximised(patterns, np.array([r["n"] for r in counted], float), rounds)


def posterior(chances: np.ndarray, shares: np.ndarray) -> Column:
    """P(good | the votes in the columns named like the rules)."""
    logs = []
    for chance, share in zip(chances, shares, strict=True):
        log = F.lit(math.log(share))
        for k, by_vote in zip(RULES, np.log(chance), strict=True):
            log = log + F.coalesce(F.element_at(F.array(*[F.lit(float(x)) for x in by_vote]), F.col(k) + 1), F.lit(0.0))
        logs.append(log)
    others = [F.exp(F.least(F.lit(700.0), x - logs[0])) for x in logs[1:]]
    return 1 / (1 + sum(others[1:], others[0]))


def quality(docs: DataFrame) -> DataFrame:
    """doc_id, the statistics, base_failed, p_good and kept, a row for each row of ``docs``."""
    stats = stored(statistics(docs))
    scored = stats.withColumns(votes()).withColumn("p_good", posterior(*estimate(stats))).drop(*RULES)
    scored = scored.withColumn("base_failed", base_failed())
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= THRESHOLD))


def filter_quality(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept. Each row is judged by its own text, also where doc_ids are null or repeat."""
    rows = with_text_keys(docs).select(F.struct("doc_id", *TEXT_KEYS).alias("doc_id"), "text")
    return without(docs, quality(rows).where("not kept").select("doc_id.*"))

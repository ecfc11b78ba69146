"""Quality rules as weak supervision: rules vote or abstain, expectation-maximisation weighs them.

Each rule looks at one figure of a text and votes for good, for bad, or abstains. Votes are counted by pattern (three
values to the power of the rules, so a small table whatever the input), and the accuracies of the rules and the share of
good texts are estimated on these counts alone. The posterior probability of good decides, not a list of musts.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.base import SPACES, written

SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """Votes bad where ``bad`` holds, else good where ``good`` holds, else abstains; SQL over the figures."""

    name: str
    bad: str
    good: str


RULES = (
    Rule("length", "n_words < 50", "n_words >= 80"),
    Rule("symbols", "n_symbols > 0.1 * n_words", "n_symbols < 0.02 * n_words"),
    Rule("repeated_words", "n_repeat_words > 0.25 * n_words", "n_repeat_words < 0.1 * n_words"),
    Rule("repeated_lines", "n_dup_lines > 0.3 * n_lines", "n_dup_lines = 0"),
    Rule("capitals", "n_capitals > 0.4 * n_letters", "n_capitals < 0.15 * n_letters"),
    Rule("letters", "n_letters < 0.7 * word_chars", "n_letters > 0.85 * word_chars"),
    Rule("word_length", "word_chars < 2.5 * n_words or word_chars > 12 * n_words", "word_chars between 3 * n_words and 10 * n_words"),
    Rule("marks", "n_marks > 0.5 * n_words", "n_marks < 0.3 * n_words"),
)


def figures(documents: DataFrame) -> DataFrame:
    """The counts that rules look at, added to ``documents`` (text); see :func:`quality_rules` for the first seven."""
    text = F.coalesce(F.col("text"), F.lit(""))
    trimmed = F.btrim(text, F.lit(SPACES))
    listed = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, "[ \t-\r]+"))
    out = documents.withColumn("_words", listed)
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    out = out.withColumn("_lines", lines)
    n = F.size("_words")
    # Windows as (hash, place) in the order of hashes: equal neighbours are repeats. The words they cover are counted
    # by the distance from each repeated window to the next one. Hashes have 64 bits and stand for their windows.
    out = out.withColumn("_windows", F.when(n >= 3, F.sort_array(F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.struct(
        F.xxhash64(F.get("_words", i), F.get("_words", i + 1), F.get("_words", i + 2)).alias("h"), i.alias("i"))))))
    out = out.withColumn("_places", F.sort_array(F.transform(
        F.filter("_windows", lambda x, k: (x["h"] == F.get("_windows", k - 1)["h"]) | (x["h"] == F.get("_windows", k + 1)["h"])), lambda x: x["i"])))
    covered = F.aggregate("_places", F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")), lambda a, x: F.struct(
        (a["n"] + F.least(F.lit(3), x - a["last"])).alias("n"), x.alias("last")), lambda a: a["n"])
    letters = F.regexp_replace(text, r"[\x00-\x40\x5B-\x60\x7B-\x7F]+", "")
    return out.select(
        *documents.columns,
        n.cast("long").alias("n_words"),
        F.length(F.regexp_replace(text, "[ \t-\r]+", "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.regexp_replace(text, "[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        F.length(letters).cast("long").alias("n_letters"),
        F.length(F.regexp_replace(letters, r"[^A-Z]+", "")).cast("long").alias("n_capitals"),
        (F.length(text) - F.length(F.regexp_replace(text, r"[!?;:=_~^]+", ""))).cast("long").alias("n_marks"),
    ).withColumn("base_failed", F.expr("n_words < 50 or 100 * n_repeat_words > 50 * n_words"))


@dataclass(frozen=True)
class RuleModel:
    """Share of good texts, and for each rule how often its vote is right on good and on bad texts."""

    good: float
    right_on_good: tuple[float, ...]
    right_on_bad: tuple[float, ...]

    def log_odds(self) -> list[tuple[float, float]]:
        """What each rule's vote for good and for bad adds to the log odds of good."""
        return [(math.log(a / (1 - b)), math.log((1 - a) / b)) for a, b in zip(self.right_on_good, self.right_on_bad, strict=True)]

    def posterior(self) -> Column:
        """Probability of good given the votes v0, v1, ... (1 good, -1 bad, 0 none)."""
        odds = F.lit(math.log(self.good / (1 - self.good)))
        for k, (up, down) in enumerate(self.log_odds()):
            odds += F.when(F.col(f"v{k}") == 1, up).when(F.col(f"v{k}") == -1, down).otherwise(0.0)
        return 1 / (1 + F.exp(-odds))

    def posterior_of(self, pattern: tuple[int, ...]) -> float:
        odds = math.log(self.good / (1 - self.good)) + sum((up if v > 0 else down) for v, (up, down) in zip(pattern, self.log_odds(), strict=True) if v)
        return 1 / (1 + math.exp(-odds))


def votes(measured: DataFrame) -> DataFrame:
    return measured.withColumns({f"v{k}": F.expr(f"case when {r.bad} then -1 when {r.good} then 1 else 0 end") for k, r in enumerate(RULES)})


def fit_rules(measured: DataFrame, rounds: int = 40, tolerance: float = 1e-7) -> RuleModel:
    """Expectation-maximisation over the counts of vote patterns.

    Spark counts the patterns; there are at most 3 ** len(RULES) of them, whatever the input, and the rounds over this
    table are plain arithmetic. It starts from rules that are mostly right, which also names the two classes. Each estimate
    has a weak prior of 20 texts at its start value, so rules that never vote and empty tables keep those values.
    """
    names = [f"v{k}" for k in range(len(RULES))]
    counted = votes(measured).groupBy(names).count().collect()
    patterns = sorted((tuple(r[v] for v in names), r["count"]) for r in counted)
    start = model = RuleModel(0.85, (0.97,) * len(RULES), (0.4,) * len(RULES))

    def share(part: float, whole: float, before: float) -> float:
        return min(max((part + 20 * before) / (whole + 20), 1e-4), 1 - 1e-4)

    for _ in range(rounds):
        weighed = [(pattern, n * p, n * (1 - p)) for pattern, n in patterns for p in (model.posterior_of(pattern),)]

        def voted(k: int, vote: int, of: int, weighed=weighed) -> float:
            return sum(w[of] for w in weighed if w[0][k] == vote)

        new = RuleModel(
            share(sum(w[1] for w in weighed), sum(n for _, n in patterns), start.good),
            tuple(share(voted(k, 1, 1), voted(k, 1, 1) + voted(k, -1, 1), s) for k, s in enumerate(start.right_on_good)),
            tuple(share(voted(k, -1, 2), voted(k, 1, 2) + voted(k, -1, 2), s) for k, s in enumerate(start.right_on_bad)))
        moved = max(abs(a - b) for a, b in zip((model.good, *model.right_on_good, *model.right_on_bad), (new.good, *new.right_on_good, *new.right_on_bad), strict=True))
        model = new
        if moved < tolerance:
            break
    return model


def judged(measured: DataFrame, model: RuleModel, threshold: float = 0.5) -> DataFrame:
    """``measured`` with quality (posterior probability of good) and kept."""
    names = [f"v{k}" for k in range(len(RULES))]
    out = votes(measured).withColumn("quality", model.posterior())
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= threshold)).drop(*names)


def quality_rules(documents: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Per row of ``documents`` (doc_id, text): the figures, base_failed, quality and kept.

    n_words: words, runs of other than white space. word_chars: their code points. n_symbols: characters of SYMBOLS.
    n_dup_lines: lines with a word that equal an earlier line. n_repeat_words: words inside a 3-word window that occurs
    twice or more in the text. base_failed: fewer than 50 words, or more than half of them repeated. kept: not
    base_failed, and the posterior probability of good is ``threshold`` or more.

    Null text counts as empty and fails. Every row is judged, also repeated ones and those whose doc_id is null; equal
    texts get equal figures. An empty table gives an empty result; other columns are ignored.
    """
    measured = written(figures(documents.select("doc_id", F.col("text").cast("string").alias("text"))).drop("text"), "quality-figures")
    return judged(measured, fit_rules(measured), threshold)


def keep_good(documents: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of ``documents`` that :func:`quality_rules` keeps, with all their columns."""
    held = documents.select(F.struct("*").alias("_row"), F.col("text").cast("string").alias("text"))
    measured = figures(held).drop("text")
    # A generator between the figures and the filter keeps Spark from working them out in every place that filters by them.
    names = [c for c in measured.columns if c != "_row"]
    measured = measured.select("_row", F.inline(F.array(F.struct(*names))))
    return judged(measured, fit_rules(measured.drop("_row")), threshold).where("kept").select("_row.*")

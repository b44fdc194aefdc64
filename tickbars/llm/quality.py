"""Quality rules as weak supervision: rules vote or abstain, EM weighs them, the posterior decides.

Only DataFrame functions run here.  Every document is measured in its own row
(higher-order functions over its words), so nothing is shuffled but the counts
of vote patterns, of which there are at most ``3 ** len(RULES)``.

Model: a document is good or bad; a rule that votes is right with one accuracy on
good and another on bad ones, and abstains as often on either.  A rule votes for a
good document at least as often as for a bad one.  Accuracies and the share of good
documents are those of the greatest likelihood under these bounds, fitted on the
pattern counts of the whole table.

The base rule (too few words, too many repeated ones) stands apart: it is no voter.

Defined results: a null text counts as empty (no words); such a text fails the
base rule.  A text of any length is measured whole.  Rows with a null id and repeated rows are measured like any other;
each row gets its own result.  An empty table gives an empty result.  Columns of
the input named like a result are replaced.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickbars.session import stored

WHITE = " \t\n\x0b\x0c\r"
WHITE_CLASS = r"[\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50

# Frequent function words of the languages served.
STOP_WORDS = (
    "the of and to in that is was for with on as by it be this have from or are at an not "
    "der die und den das von zu mit sich des auf für ist im dem nicht ein eine als auch "
    "de la le et les des en un du une que est pour qui dans par sur au avec ne se pas "
    "el los y del las por con para una su al lo como más o pero sus"
).split()

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
EXTRA = ["n_lines", "n_stop_words", "n_lettered"]
RULES = ["symbols", "lines", "repeats", "word_length", "stop_words", "letters"]


def _words(text: Column) -> Column:
    return F.filter(F.split(text, WHITE_CLASS + "+"), lambda w: w != "")


def _windows(words: Column) -> Column:
    """A 64-bit key for each window of three words."""
    keys = F.transform(words, lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)))
    return F.slice(keys, 1, F.greatest(F.size(words) - 2, F.lit(0)))


def _ordered(windows: Column) -> Column:
    """Keys with their places, sorted; null where no key occurs twice."""
    placed = F.transform(windows, lambda key, at: F.struct(key.alias("key"), at.alias("at")))
    return F.when(F.size(F.array_distinct(windows)) < F.size(windows), F.sort_array(placed))


def _repeated(ordered: Column) -> Column:
    """Number of words that lie in a window found at least twice."""
    twice = F.filter(
        ordered,
        lambda x, i: F.coalesce(F.get(ordered, i - 1)["key"] == x["key"], F.lit(False))
        | F.coalesce(F.get(ordered, i + 1)["key"] == x["key"], F.lit(False)),
    )
    covered = F.flatten(F.transform(twice, lambda x: F.array(x["at"], x["at"] + 1, x["at"] + 2)))
    return F.when(ordered.isNull(), F.lit(0)).otherwise(F.size(F.array_distinct(covered)))


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """*docs* with MEASURES and EXTRA as long columns."""
    own = [c for c in docs.columns if c not in MEASURES + EXTRA]
    body = F.coalesce(F.col(text), F.lit(""))
    with_words = docs.select(
        *own,
        body.alias("_body"),
        _words(body).alias("_words"),
        F.filter(F.split(body, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("_lines"),
    )
    # one projection for each step: a lambda evaluates all that it holds for each element
    with_windows = with_words.select("*", _windows(F.col("_words")).alias("_windows"))
    with_order = with_windows.select("*", _ordered(F.col("_windows")).alias("_ordered"))
    lines, words = F.col("_lines"), F.col("_words")
    return with_order.select(
        *own,
        F.size(words).cast("long").alias("n_words"),
        F.char_length(F.translate("_body", WHITE, "")).cast("long").alias("word_chars"),
        (F.char_length("_body") - F.char_length(F.translate("_body", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        _repeated(F.col("_ordered")).cast("long").alias("n_repeat_words"),
        F.size(lines).cast("long").alias("n_lines"),
        F.size(F.filter(words, lambda w: F.lower(w).isin(STOP_WORDS))).cast("long").alias("n_stop_words"),
        F.size(F.filter(words, lambda w: w.rlike(r"^\p{P}?\p{L}+[\p{P}]?$"))).cast("long").alias("n_lettered"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _vote(good: Column, bad: Column) -> Column:
    return F.when(bad, F.lit(-1)).when(good, F.lit(1)).otherwise(F.lit(0))


def votes() -> dict[str, Column]:
    """Each rule's vote from the measures: 1 good, -1 bad, 0 abstains."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    lines = F.greatest(F.col("n_lines"), F.lit(1))
    share = lambda name, of: F.col(name) / of
    mean = F.col("word_chars") / words
    return {
        "symbols": _vote(share("n_symbols", words) <= 0.02, share("n_symbols", words) >= 0.2),
        "lines": _vote((F.col("n_dup_lines") == 0) & (F.col("n_lines") >= 2), share("n_dup_lines", lines) >= 0.3),
        "repeats": _vote(share("n_repeat_words", words) <= 0.1, share("n_repeat_words", words) >= 0.3),
        "word_length": _vote(mean.between(3, 9), (mean < 2) | (mean > 14)),
        "stop_words": _vote(share("n_stop_words", words) >= 0.05, share("n_stop_words", words) < 0.01),
        "letters": _vote(share("n_lettered", words) >= 0.8, share("n_lettered", words) < 0.5),
    }


@dataclass(frozen=True)
class Model:
    """Share of good documents; for each rule how often its vote is right on good and on bad ones."""

    prior: float
    on_good: dict[str, float]
    on_bad: dict[str, float]

    def posterior(self) -> Column:
        """Probability that a row with the vote columns is good."""
        odds = F.lit(math.log(self.prior / (1 - self.prior)))
        for rule in RULES:
            good, bad = self.on_good[rule], self.on_bad[rule]
            gain, loss = math.log(good / (1 - bad)), math.log(bad / (1 - good))
            odds = odds + F.when(F.col(rule) == 1, F.lit(gain)).when(F.col(rule) == -1, F.lit(-loss)).otherwise(0.0)
        return 1 / (1 + F.exp(-odds))


FIRST = Model(0.8, {rule: 0.9 for rule in RULES}, {rule: 0.4 for rule in RULES})


def _clip(x: float, low: float, high: float) -> float:
    return min(max(x, low), high)


def accuracies(good_for: float, good: float, bad_for: float, bad: float) -> tuple[float, float]:
    """How often a rule is right on good and on bad documents, from the weights of its votes on them.

    The likeliest shares of votes for, where that among the good is not below that
    among the bad: where it would be, both are the share among all.
    """
    among_good, among_bad = good_for / good, bad_for / bad
    if among_good < among_bad:
        among_good = among_bad = (good_for + bad_for) / (good + bad)
    return _clip(among_good, 0.02, 0.98), 1 - _clip(among_bad, 0.02, 0.98)


def fit(votes_table: DataFrame, rounds: int = 40, settled: float = 1e-4) -> Model:
    """Fit by expectation-maximisation on the counts of vote patterns.

    Shares stay within 0.02 to 0.98 and the prior within 0.05 to 0.95, so that no
    rule decides alone.  A rule that never votes keeps its first accuracies.
    """
    patterns = stored(votes_table.groupBy(*RULES).agg(F.count("*").alias("_n")).coalesce(1), "patterns")
    model = FIRST
    n, p = F.col("_n"), F.col("_p")
    sums = [
        F.sum(F.when(chosen, weight)).alias(f"{rule}{at}")
        for rule in RULES
        for at, (chosen, weight) in enumerate(
            (chosen, weight) for weight in (n * p, n * (1 - p)) for chosen in (F.col(rule) == 1, F.col(rule) != 0)
        )
    ]
    for _ in range(rounds):
        rows = patterns.select("*", model.posterior().alias("_p"))
        found = rows.agg((F.sum(n * p) / F.sum(n)).alias("_prior"), *sums).first()
        if found["_prior"] is None:
            return model
        right = {}
        for rule in RULES:
            weights = [found[f"{rule}{at}"] or 0.0 for at in range(4)]
            voted = weights[1] > 0 and weights[3] > 0
            right[rule] = accuracies(*weights) if voted else (model.on_good[rule], model.on_bad[rule])
        new = Model(
            _clip(found["_prior"], 0.05, 0.95), {r: x[0] for r, x in right.items()}, {r: x[1] for r, x in right.items()}
        )
        moved = max(
            abs(new.prior - model.prior),
            *(abs(new.on_good[r] - model.on_good[r]) + abs(new.on_bad[r] - model.on_bad[r]) for r in RULES),
        )
        model = new
        if moved < settled:
            break
    return model


def judge(measured: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """Measured rows with votes, ``base_failed``, ``posterior`` and ``kept``."""
    own = [c for c in measured.columns if c not in [*RULES, "base_failed", "posterior", "kept"]]
    voted = measured.select(*own, *(vote.alias(rule) for rule, vote in votes().items()))
    return voted.select(
        "*", base_failed().alias("base_failed"), model.posterior().alias("posterior"),
    ).withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= threshold))


def vote_table(measured: DataFrame) -> DataFrame:
    return measured.select(*(vote.alias(rule) for rule, vote in votes().items()))


def score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document with its measures, votes, posterior and verdict."""
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    measured = stored(measure(slim).drop("text"), "measures")
    return judge(measured, fit(vote_table(measured)))


def keep(docs: DataFrame, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of *docs* that pass, with the columns of *docs*.

    Each text is measured once: the rows are written with their votes, those that
    fail the base rule as votes alone, and are filtered when the model stands.  No
    text is shuffled, and repeated rows or null ids need no key.
    """
    whole = docs.select(F.struct(*docs.columns).alias("_row"), F.col(text).alias("text"))
    voted = measure(whole).select("_row", base_failed().alias("_failed"), *(v.alias(r) for r, v in votes().items()))
    held = stored(voted.withColumn("_row", F.when(~F.col("_failed"), F.col("_row"))), "voted", compression="zstd")
    good = fit(held.select(*RULES)).posterior() >= threshold
    return held.where(~F.col("_failed") & good).select("_row.*")

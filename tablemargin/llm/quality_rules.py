"""Quality rules by weak supervision, in columns only.

Every rule looks at counts of a text and votes good (1) or bad (-1), or abstains (0). How far each rule can be trusted is
not set by hand: expectation-maximisation over the votes of all documents estimates, for a hidden good or bad class,
how often each rule votes what, and each document gets the posterior probability of the good class. A document need
not pass every rule; it is kept if the posterior says so.

Only the number of documents of each vote pattern leaves the executors (at most 3 to the power of the number of rules
rows, whatever the data), and the posterior goes back as a sum of literal log-odds.

Defined results: a NULL text has no words, no symbols and no lines and fails the base rule like any text of under ten
words; so does an empty one. Rows are judged one by one, so repeated rows agree; output columns replace columns of
that name. With no rows there is nothing to estimate and nothing to judge.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tablemargin.sources.tables import stage

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
#: The method's verdict: keep from this posterior on.
KEEP_FROM = 0.5

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def with_repeat_words(df: DataFrame, words: str) -> DataFrame:
    """`df` with the number of words inside windows of five words that occur at least twice, the first one included.

    Windows are compared by a 64-bit hash. Equal hashes are brought together by sorting (hash, position), and the
    lengths of the union of the repeated windows are added up; a text without a repeated window skips both.
    """
    w = F.col(words)
    hashes = F.transform(w, lambda x, i: F.xxhash64(x, *[F.get(w, i + k) for k in range(1, WINDOW)]))
    df = df.withColumn("_hashes", F.slice(hashes, F.lit(1), F.greatest(F.size(w) - (WINDOW - 1), F.lit(0))))
    repeats = F.size(F.array_distinct("_hashes")) < F.size("_hashes")
    placed = F.array_sort(F.transform("_hashes", lambda h, i: F.struct(h.alias("h"), i.alias("at"))))
    df = df.withColumn("_placed", F.when(repeats, placed))
    p = F.col("_placed")
    df = df.withColumn("_at", F.sort_array(F.transform(
        F.filter(p, lambda x, i: F.coalesce(x["h"] == F.get(p, i - 1)["h"], F.lit(False))
                 | F.coalesce(x["h"] == F.get(p, i + 1)["h"], F.lit(False))), lambda x: x["at"])))
    covered = F.aggregate(
        "_at", F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda acc, x: F.struct((acc["n"] + x + WINDOW - F.greatest(acc["end"], x)).alias("n"), (x + WINDOW).alias("end")),
        lambda acc: acc["n"])
    return df.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("_hashes", "_placed", "_at")


def counts(df: DataFrame, text: str = "text") -> DataFrame:
    """`df` with the counts that rules look at."""
    t = F.coalesce(F.col(text), F.lit(""))
    df = df.withColumn("_words", F.filter(F.split(t, SPACE), lambda w: w != ""))
    df = with_repeat_words(df, "_words")
    lines = F.filter(F.split(t, "\n"), lambda x: F.length(F.translate(x, "\t\n\x0b\x0c\r ", "")) > 0)
    df = df.withColumn("_lines", lines)
    df = df.withColumns({
        "n_words": F.size("_words").cast("long"),
        "word_chars": F.length(F.translate(t, "\t\n\x0b\x0c\r ", "")).cast("long"),
        "n_symbols": (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "_n_lines": F.size("_lines").cast("long"),
        "_symbol_runs": F.regexp_count(t, F.lit("[#*$%&|<>]+")).cast("long"),
        "_distinct": F.size(F.array_distinct("_words")).cast("long"),
        "_upper": (F.length(t) - F.length(F.translate(t, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))).cast("long"),
        "_digits": (F.length(t) - F.length(F.translate(t, "0123456789", ""))).cast("long"),
        "_shouts": (F.length(t) - F.length(F.translate(t, "!", ""))).cast("long"),
        "_stops": (F.length(t) - F.length(F.translate(t, ".!?", ""))).cast("long")})
    return df.drop("_words", "_lines")


def _objects(bad: Column) -> Column:
    return F.when(bad, -1).otherwise(0)


def votes() -> dict[str, Column]:
    """The rules: most object or abstain, the last two approve or abstain.

    A share is compared by multiplying out, so nothing is divided by zero. Every kind of bad text is covered by more
    than one rule, as only rules that agree or disagree with others say how far they can be trusted.
    """
    n, chars = F.col("n_words"), F.col("word_chars")
    return {
        "short": _objects(n < 10),
        "word_length": _objects((chars < 3 * n) | (chars > 12 * n)),
        "symbols": _objects(100 * F.col("n_symbols") > 5 * chars),
        "symbol_words": _objects(10 * F.col("_symbol_runs") > n),
        "duplicate_lines": _objects((F.col("n_dup_lines") >= 3) & (100 * F.col("n_dup_lines") > 30 * F.col("_n_lines"))),
        "repeated_words": _objects(100 * F.col("n_repeat_words") > 20 * n),
        "vocabulary": _objects((n >= 50) & (F.col("_distinct") < F.pow(n.cast("double"), 0.6))),
        "upper_case": _objects(100 * F.col("_upper") > 30 * chars),
        "digits": _objects(100 * F.col("_digits") > 40 * chars),
        "exclamation": _objects(100 * F.col("_shouts") > 10 * n),
        "sentences": F.when((F.col("_stops") > 0) & (F.col("_stops") * 60 >= n), 1).otherwise(0),
        "varied": F.when(F.col("_distinct") >= F.pow(n.cast("double"), 0.75), 1).otherwise(0),
    }


def estimate(patterns: list[tuple[tuple[int, ...], int]], rounds: int = 60) -> tuple[float, list[dict[int, float]]]:
    """Prior log-odds of the good class and, for each rule, the log-odds that each of its votes adds.

    Expectation-maximisation for a two-class model in which rules err independently, started from the balance of
    votes. Counts are smoothed by one document of each vote in each class.
    """
    total = sum(n for _, n in patterns)
    if not total:
        return 0.0, []
    rules = len(patterns[0][0])
    # An objection says more than approval: most rules find nothing to object to in most bad texts.
    good = [(0.97, 0.3, 0.02)[min(2, v.count(-1))] for v, _ in patterns]
    for _ in range(rounds):
        weight = sum(p * n for p, (_, n) in zip(good, patterns))
        prior = math.log((weight + 1) / (total - weight + 1))
        odds: list[dict[int, float]] = []
        for j in range(rules):
            seen = {(v, c): 1.0 for v in (-1, 0, 1) for c in (0, 1)}
            for p, (vote, n) in zip(good, patterns):
                seen[vote[j], 1] += p * n
                seen[vote[j], 0] += (1 - p) * n
            odds.append({v: math.log(seen[v, 1] / (weight + 3)) - math.log(seen[v, 0] / (total - weight + 3))
                         for v in (-1, 0, 1)})
        good = [1 / (1 + math.exp(-max(-50.0, min(50.0, prior + sum(o[x] for o, x in zip(odds, v)))))) for v, _ in patterns]
    return prior, odds


def judge_counts(counted: DataFrame) -> DataFrame:
    """Frame of `counts` with the posterior of the good class, base_failed and kept; read twice, so stage it first."""
    rules = votes()
    found = counted.select(*[v.alias(k) for k, v in rules.items()]).groupBy(*rules).count().collect()
    prior, odds = estimate([(tuple(r[k] for k in rules), r["count"]) for r in found])
    terms = [F.when(vote == -1, o[-1]).when(vote == 1, o[1]).otherwise(o[0]) for vote, o in zip(rules.values(), odds)]
    log_odds = reduce(lambda a, b: a + b, terms, F.lit(prior))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    judged = counted.withColumns({"posterior": 1 / (1 + F.exp(-log_odds)), "base_failed": failed})
    judged = judged.withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= KEEP_FROM))
    return judged.drop("_n_lines", "_symbol_runs", "_distinct", "_upper", "_digits", "_shouts", "_stops")


def judge(df: DataFrame, text: str = "text") -> DataFrame:
    """`df` with the counts, the posterior of the good class, base_failed and kept."""
    return judge_counts(stage(counts(df, text), "quality-counts"))

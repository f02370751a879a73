"""Quality rules by weak supervision.

Rules vote for or against a document or abstain.  Expectation-maximisation over the
counts of vote patterns (at most 3 ** rules of them, whatever the corpus) estimates how
often every rule is right on good and on bad documents; a document is kept if its
posterior probability of being good is at least one half and no base rule fails.

Null texts are texts without words.  Rows are independent of each other: repeated rows
and ties get the same verdict.  An empty table gives an empty result.  Input columns with
the name of an output column are replaced.
"""

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACES, Scratch, words

# The characters counted as symbols.
SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _without(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def _repeat_words(df: DataFrame) -> DataFrame:
    """Add ``__repeat``: words inside windows of eight words that occur twice or more in the text.

    Windows are compared by hash.  Only texts with an equal pair of windows sort them.
    """
    at = lambda i, k: F.get("__hashes", i + k)
    df = df.withColumn("__hashes", F.transform("__words", lambda w: F.xxhash64(w)))
    windows = F.transform(
        F.sequence(F.lit(0), F.size("__words") - WINDOW),
        lambda i: F.xxhash64(*[at(i, k) for k in range(WINDOW)]),
    )
    df = df.withColumn("__windows", F.when(F.size("__words") >= WINDOW, windows)).drop("__hashes")
    repeated = F.size(F.array_distinct("__windows")) < F.size("__windows")
    pairs = F.array_sort(F.transform("__windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    df = df.withColumn("__sorted", F.when(repeated, pairs)).drop("__windows")
    same = lambda x, j: F.coalesce(x["h"] == F.get("__sorted", j)["h"], F.lit(False))
    found = F.filter("__sorted", lambda x, j: same(x, j - 1) | same(x, j + 1))
    df = df.withColumn("__at", F.array_sort(F.transform(found, lambda x: x["i"]))).drop("__sorted")
    step = F.transform("__at", lambda p, j: F.least(F.coalesce(F.get("__at", j + 1) - p, F.lit(WINDOW)), F.lit(WINDOW)))
    covered = F.aggregate(step, F.lit(0).cast("bigint"), lambda total, x: total + x)
    return df.withColumn("__repeat", F.coalesce(covered, F.lit(0).cast("bigint"))).drop("__at")


def text_statistics(df: DataFrame, text: str = "text") -> DataFrame:
    """Add the base statistics and, under ``__`` names, what only the rules look at."""
    whole = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda line: F.btrim(line, F.lit(SPACES)) != "")
    df = df.withColumns({"__text": whole, "__words": words(F.col(text)), "__lines": lines})
    df = df.withColumns(
        {
            "__chars": _letters("__text"),
            "__n": F.size("__words").cast("bigint"),
            "__distinct": F.size(F.array_distinct("__words")),
            "__short": F.size(F.filter("__words", lambda w: (F.length(w) <= 3) & w.rlike(r"\p{L}"))),
            "__n_lines": F.size("__lines"),
            "__n_dup": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("bigint"),
            "__symbols": _without(F.col("__text"), SYMBOLS).cast("bigint"),
            "__upper": _without(F.col("__text"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
            "__marks": _without(F.col("__text"), "!"),
        }
    ).drop("__lines", "__text")
    df = _repeat_words(df).drop("__words")
    return df.withColumns(
        {
            "n_words": F.col("__n"),
            "word_chars": F.col("__chars"),
            "n_symbols": F.col("__symbols"),
            "n_dup_lines": F.col("__n_dup"),
            "n_repeat_words": F.col("__repeat"),
        }
    )


def _letters(text: str) -> Column:
    return F.length(F.translate(F.col(text), SPACES, "")).cast("bigint")


def rule_votes() -> dict[str, Column]:
    """A vote per rule: 1 for, -1 against, 0 abstains.  They read the columns of :func:`text_statistics`.

    Signs of junk vote against a document or abstain, as their absence says little; only
    a varied vocabulary and a usual share of short words speak for one.
    """
    n = F.nullif(F.col("__n"), F.lit(0))
    chars = F.nullif(F.col("__chars"), F.lit(0))
    distinct, short = F.col("__distinct") / n, F.col("__short") / n
    length = F.col("__chars") / n
    against = lambda sign: F.when(sign, -1).otherwise(0)
    both = lambda good, bad: F.when(good, 1).when(bad, -1).otherwise(0)
    return {
        "symbols": against(F.col("__symbols") / n > 0.1),
        "repeats": against(F.col("__repeat") / n > 0.3),
        "capitals": against(F.col("__upper") / chars > 0.3),
        "exclamations": against(F.col("__marks") / n > 0.3),
        "lines": against((F.col("__n_lines") >= 3) & (F.col("__n_dup") / F.col("__n_lines") > 0.5)),
        "word_length": against((length < 2) | (length > 14)),
        "variety": both(distinct >= 0.45, (n >= 40) & (distinct < 0.25)),
        "short_words": both(short >= 0.12, (n >= 40) & (short < 0.06)),
    }


def fit_accuracies(
    patterns: list[tuple[tuple[int, ...], int]], rounds: int = 50, most: float = 4.0
) -> tuple[float, list[dict[int, float]]]:
    """Expectation-maximisation over ``(votes, number of documents)``.

    For both classes it estimates how often every rule votes for, against and not at all; a
    rule's accuracy enters as the log odds that its vote, or silence, adds to a document's being
    good.  Returns the prior log odds and these per rule.  A vote never counts for its opposite, and
    none adds more than ``most``.  Documents start as good if their votes for outweigh twice their
    votes against.
    """
    n_rules = len(patterns[0][0]) if patterns else 0
    odds = {votes: 2.0 * sum(v if v > 0 else 2 * v for v in votes) + 1.0 for votes, _ in patterns}
    prior, weights = 0.0, [{1: 0.0, 0: 0.0, -1: 0.0} for _ in range(n_rules)]
    for _ in range(rounds):
        good = bad = 1.0
        hits = [{v: [1 / 3, 1 / 3] for v in (1, 0, -1)} for _ in range(n_rules)]
        for votes, count in patterns:
            p = 1 / (1 + math.exp(-max(min(odds[votes], 50), -50)))
            good, bad = good + p * count, bad + (1 - p) * count
            for r, vote in enumerate(votes):
                hits[r][vote][0] += p * count
                hits[r][vote][1] += (1 - p) * count
        prior = math.log(good / bad)
        for r in range(n_rules):
            for vote, (g, b) in hits[r].items():
                weight = max(min(math.log(g / good) - math.log(b / bad), most), -most)
                weights[r][vote] = vote * max(vote * weight, 0.0) if vote else weight
        odds = {votes: posterior_odds(votes, prior, weights) for votes, _ in patterns}
    return prior, weights


def posterior_odds(votes: tuple[int, ...], prior: float, weights: list[dict[int, float]]) -> float:
    return prior + sum(w[v] for v, w in zip(votes, weights, strict=True))


def quality_verdicts(
    spark: SparkSession, df: DataFrame, text: str = "text", carry: list[str] | None = None
) -> DataFrame:
    """Columns ``carry`` of ``df`` (default all) with the base statistics, ``base_failed``, ``posterior`` and ``kept``.

    Texts are read once: statistics and votes are stored, as both the counts of vote
    patterns and the verdicts need them.  The patterns are all that reaches the driver.
    """
    votes = rule_votes()
    names = [f"__vote_{name}" for name in votes]
    failed = (F.col("__n") < MIN_WORDS) | (100 * F.col("__repeat") > 30 * F.col("__n"))
    outputs = (*STATISTICS, "base_failed", "posterior", "kept")
    carried = [c for c in (df.columns if carry is None else carry) if c.lower() not in outputs]
    judged = text_statistics(df, text).withColumns(dict(zip(names, votes.values(), strict=True)) | {"base_failed": failed})
    columns = [F.col(f"`{c}`") for c in (*carried, *STATISTICS, "base_failed", *names)]
    voted = Scratch(spark, "quality").store(judged.select(*columns))
    counted = voted.groupBy(*names).count()
    patterns = [(tuple(row[n] for n in names), row["count"]) for row in counted.collect()]
    prior, weights = fit_accuracies(sorted(patterns))
    odds = F.lit(prior)
    for name, weight in zip(names, weights or [{1: 0.0, 0: 0.0, -1: 0.0}] * len(names), strict=True):
        odds = odds + F.when(F.col(name) > 0, weight[1]).when(F.col(name) < 0, weight[-1]).otherwise(weight[0])
    scored = voted.withColumn("posterior", 1 / (1 + F.exp(-odds))).drop(*names)
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= 0.5))


def keep_quality(spark: SparkSession, docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` with a positive verdict, their columns unchanged."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row_"), F.col(f"`{text}`").alias("text_"))
    return quality_verdicts(spark, rows, "text_", ["row_"]).filter("kept").select("row_.*")

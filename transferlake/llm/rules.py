"""Quality rules (11): weak supervision instead of all-must-pass, in Spark functions only.

Every rule looks at one statistic of the text and votes good, votes bad or abstains (``RULES``).
No labels are used: expectation-maximisation over the votes of all documents estimates how common
good documents are and, of each rule, how often it votes bad among good and among bad documents
when it votes at all. Bad documents are of several kinds (``KINDS``), each with accuracies of its
own: with a single bad class the commonest kind would claim it, and rules that find another kind
would count as unsound. A document is kept if the probability that it is good, given its votes
and those accuracies, is at least one half; one unsound rule cannot reject it alone.

Documents enter the estimate as counts of vote patterns, of which there are at most 3 ^ rules
whatever the size of the table. Each step is an aggregate over that small stored table; the
driver holds one number a class and rule. Accuracies start from, and are weakly held to (``PRIOR``
documents' worth), rules that are mostly right about the kinds they are for.

Base statistics: words are maximal runs of other than blanks and control whitespace; a line counts
as a repeat if it has a word and equals an earlier line; a word counts as repeated if it lies
in a window of three words that the text has twice or more. Windows are compared by 64-bit hash.
A text of under 50 words, or with more than half its words repeated, has failed at the base and
is not kept, but its votes count like any other. Whole texts are read, in time n log n of
their words. Null text is no words. Null and repeated doc_ids are rows like any other. An empty table
gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from transferlake.llm.common import documents, read, stored

WORD = r"[^\x20\x09-\x0D]+"
BLANKS = r"[\x20\x09-\x0D]+"
SYMBOLS = "[#*$%&|<>]"
LEAST_WORDS = 50
MOST_REPEATED = 50          # percent of the words

# name: (votes good while, else votes bad while), over the statistics of ``measured``.
RULES = {
    "length": ("n_words >= 100", "n_words < 20"),
    "word_length": ("word_chars BETWEEN 3 * n_words AND 10 * n_words", "word_chars < 2 * n_words OR word_chars > 15 * n_words"),
    "endings": ("n_lines >= 3 AND 100 * n_endings >= 60 * n_lines", "n_lines >= 3 AND 100 * n_endings < 10 * n_lines"),
    "digits": ("100 * n_digits <= 5 * word_chars", "100 * n_digits > 20 * word_chars"),
    "symbols": ("100 * n_symbols <= 2 * n_words", "100 * n_symbols > 10 * n_words"),
    "letters": ("100 * n_letters >= 80 * word_chars", "100 * n_letters < 70 * word_chars"),
    "letterless_words": ("100 * n_letterless <= 5 * n_words", "100 * n_letterless > 20 * n_words"),
    "capitals": ("n_letters >= 20 AND 100 * n_capitals <= 10 * n_letters", "n_letters >= 20 AND 100 * n_capitals > 30 * n_letters"),
    "exclamations": ("100 * n_marks <= 5 * n_words", "100 * n_marks > 20 * n_words"),
    "repeated_words": ("100 * n_repeat_words <= 10 * n_words", "100 * n_repeat_words > 30 * n_words"),
    "repeated_lines": ("n_lines >= 3 AND 100 * n_dup_lines <= 10 * n_lines", "n_dup_lines >= 3 AND 100 * n_dup_lines > 30 * n_lines"),
    "distinct_words": ("100 * n_distinct >= 40 * n_words", "n_words BETWEEN 50 AND 2000 AND 100 * n_distinct < 25 * n_words"),
}
# Kinds of bad document, and the rules that are for them.
KINDS = {
    "fragments": ["length", "word_length", "endings", "digits"],
    "symbols": ["symbols", "letters", "letterless_words"],
    "shouting": ["capitals", "exclamations"],
    "repetition": ["repeated_words", "repeated_lines", "distinct_words"],
}
PRIOR = 20.0                # documents
GOOD, BAD_ELSE, BAD_IF_KIND = 0.7, 0.05, 0.6     # at the start: share of good documents; bad votes of other rules, of a kind's own
STEPS, SETTLED = 50, 1e-4

_AT = "array<struct<h:bigint,at:int>>"


def _windows() -> Column:
    """Hashes of the windows of three words, in text order."""
    places = F.when(F.size("_words") >= 4, F.sequence(F.lit(0), F.size("_words") - 3)).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.xxhash64(F.get("_words", i), F.get("_words", i + 1), F.get("_words", i + 2)))


def _by_hash() -> Column:
    """(hash, place) of the windows, by hash; none where no window comes twice."""
    found = F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("at")))
    return F.when(F.size(F.array_distinct("_windows")) < F.size("_windows"), F.sort_array(found)).otherwise(F.array().cast(_AT))


def _twice() -> Column:
    """Places of the windows that the text has twice or more, rising."""
    same = lambda w, i: F.coalesce(F.get("_sorted", i)["h"] == w["h"], F.lit(False))
    marked = F.transform("_sorted", lambda w, i: F.when(same(w, i - 1) | same(w, i + 1), w["at"]))
    return F.sort_array(F.filter(marked, lambda at: at.isNotNull()))


def _covered() -> Column:
    """Words in those windows: each adds what lies beyond the end of the one before."""
    start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("bigint").alias("n"))
    return F.aggregate("_twice", start, lambda s, at: F.struct(
        (at + 3).alias("end"), (s["n"] + F.least(F.lit(3), at + 3 - s["end"])).cast("bigint").alias("n")), lambda s: s["n"])


def measured(docs: DataFrame) -> DataFrame:
    """doc_id and the statistics, all bigint."""
    rows = documents(docs).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("_found", F.regexp_extract_all(F.col("text"), F.lit(WORD), F.lit(0)))
    rows = rows.withColumn("_words", F.transform("_found", lambda w: F.xxhash64(w)))
    rows = rows.withColumn("_lines", F.filter(F.split("text", "\n", -1), lambda x: x.rlike(WORD)))
    rows = rows.withColumn("_windows", _windows())
    rows = rows.withColumn("_sorted", _by_hash())
    rows = rows.withColumn("_twice", _twice())
    long = lambda c, name: c.cast("bigint").alias(name)
    count = lambda pattern, name: long(F.regexp_count("text", F.lit(pattern)), name)
    left = lambda pattern, name: long(F.length(F.regexp_replace("text", pattern, "")), name)
    ending = r"""[.!?:;。！？…]["'”’)»]*\s*$"""
    return rows.select(
        "doc_id", long(F.size("_words"), "n_words"), left(BLANKS, "word_chars"), count(SYMBOLS, "n_symbols"),
        long(F.size("_lines") - F.size(F.array_distinct("_lines")), "n_dup_lines"),
        long(_covered(), "n_repeat_words"), long(F.size("_lines"), "n_lines"), long(F.size(F.array_distinct("_words")), "n_distinct"),
        left(r"\P{L}+", "n_letters"), left(r"\P{Lu}+", "n_capitals"), count("[0-9]", "n_digits"), count("[!?]", "n_marks"),
        long(F.size(F.filter("_found", lambda w: ~w.rlike(r"\p{L}"))), "n_letterless"),
        long(F.size(F.filter("_lines", lambda x: F.substring(x, -6, 6).rlike(ending))), "n_endings"))


def votes(rules: dict = RULES) -> Column:
    """1 good, -1 bad, 0 abstain, by rule."""
    return F.array(*[F.when(F.expr(good), 1).when(F.expr(bad), -1).otherwise(0) for good, bad in rules.values()])


class Accuracies:
    """``shares[c]``: share of the documents in class c, 0 the good ones, then the kinds of bad;
    ``bad_votes[c][rule]``: how often a rule that votes says bad of documents of class c."""

    def __init__(self, shares: list, bad_votes: list):
        self.shares, self.bad_votes = shares, bad_votes

    @classmethod
    def start(cls, rules: dict, kinds: dict) -> "Accuracies":
        own = [[], *kinds.values()]
        return cls([GOOD, *[(1 - GOOD) / len(kinds)] * len(kinds)],
                   [[BAD_IF_KIND if name in names else BAD_ELSE for name in rules] for names in own])

    def told(self, rows: DataFrame, pattern: str = "votes") -> DataFrame:
        """``rows`` + _p, the probability of each class; one step of the work a projection, so that
        nothing is worked out twice."""
        def log(share: float, bad: list) -> str:
            listed = lambda xs: "array(" + ", ".join(f"{x!r}D" for x in xs) + ")"
            good, bad = listed([math.log(1 - b) for b in bad]), listed([math.log(b) for b in bad])
            return f"""aggregate(transform({pattern}, (v, i) -> CASE v WHEN 1 THEN get({good}, i) WHEN -1 THEN get({bad}, i) ELSE 0D END),
                                 {math.log(share)!r}D, (a, x) -> a + x)"""
        logs = ", ".join(log(s, b) for s, b in zip(self.shares, self.bad_votes))
        return (rows.selectExpr("*", f"array({logs}) AS _logs").selectExpr("*", "array_max(_logs) AS _most")
                .selectExpr("*", "transform(_logs, x -> exp(x - _most)) AS _each").selectExpr("*", "aggregate(_each, 0D, (a, x) -> a + x) AS _all")
                .selectExpr("*", "transform(_each, x -> x / _all) AS _p").drop("_logs", "_most", "_each", "_all"))


def estimate(patterns: DataFrame, rules: dict = RULES, kinds: dict = KINDS, steps: int = STEPS) -> Accuracies:
    """Expectation-maximisation over rows of (votes, n)."""
    start = now = Accuracies.start(rules, kinds)
    sums = [F.expr(f"sum(CASE WHEN {on} THEN n * _p[{c}] END) AS {name}{c}") for c in range(len(start.shares))
            for name, on in (("all", "true"), ("voted", "vote <> 0"), ("bad", "vote = -1"))]
    for _ in range(steps):
        told = now.told(patterns).selectExpr("n", "_p", "posexplode(votes) AS (rule, vote)")
        found = {r["rule"]: r for r in told.groupBy("rule").agg(*sums).collect()}
        if not found:
            return start
        part = lambda i, name, c: found[i][f"{name}{c}"] or 0.0
        total = sum(part(0, "all", c) for c in range(len(start.shares)))
        new = Accuracies([(part(0, "all", c) + PRIOR * share) / (total + PRIOR) for c, share in enumerate(start.shares)],
                         [[(part(i, "bad", c) + PRIOR * b) / (part(i, "voted", c) + PRIOR) for i, b in enumerate(bad)] for c, bad in enumerate(start.bad_votes)])
        moved = max(abs(x - y) for a, b in zip([now.shares, *now.bad_votes], [new.shares, *new.bad_votes]) for x, y in zip(a, b))
        now = new
        if moved < SETTLED:
            break
    return now


def judged(docs: DataFrame, rules: dict = RULES, kinds: dict = KINDS) -> DataFrame:
    """doc_id, the base statistics, base_failed, kept, posterior, votes."""
    rows = stored(measured(docs).withColumn("votes", votes(rules)), "rules")
    patterns = stored(rows.groupBy("votes").agg(F.count(F.lit(1)).alias("n")), "rules-patterns")
    found = estimate(patterns, rules, kinds)
    failed = F.expr(f"n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words")
    good = F.get("_p", F.lit(0))
    return found.told(rows).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
                       (~failed & (good >= 0.5)).alias("kept"), good.alias("posterior"), "votes")


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(read(spark, sf_dir, "documents"))

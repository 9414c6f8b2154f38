"""Secret scans (9): randomness tests of token-like runs, in Spark functions only.

Base spans are the matches of three patterns (assigned values, access keys, long hex runs).
The method adds spans of kind ``random``: runs of 20 or more base64 characters that a test
battery can't tell from random keys. For each run an encoding is inferred (decimal, hex,
base32, base64) and, over its alphabet, three tests are made: chi-squared uniformity of the
symbols, runs above and below the alphabet's middle, and serial correlation at lag 1. Fisher's
method joins them into one p-value of "drawn at random". Within each length class, since short
runs carry less evidence, the Benjamini-Hochberg rule over all runs of the table rejects
randomness at a false-discovery rate of ``RATE``; a run that is not rejected is reported. Two
cases are settled before the tests: a run of fewer than 20 symbols, padding aside, is not one,
and base64 without two of digits, lower-case and upper-case letters is no key (a random one of 20
symbols looks so once in a million). Runs that touch a base span are left to it.

The rule needs only counts by (length class, p-value in tenths of a decade): that bounded table
is all the driver reads. Positions are in code points, end exclusive. Null and empty texts have
no spans; a null or repeated doc_id is a row like any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from transferlake.llm.common import documents, read, stored

# The base patterns.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
ASSIGN_LEAST = 8

RUN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+"
DECIMAL, HEXADECIMAL = "0123456789", "0123456789abcdef"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
BASE64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
CLASSES = [20, 24, 32, 48, 64]
RATE = 0.05
STEPS = 300                 # p-values are counted in tenths of a decade, down to 1e-30

_SPANS = "array<struct<start:bigint,end:bigint,i:int>>"


def matches(text: str, pattern: str) -> Column:
    """Leftmost non-overlapping matches as (start, end, i), from the pieces between them."""
    found = F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0))
    both = F.arrays_zip(F.split(F.col(text), pattern, -1).alias("gap"), found.alias("hit"))
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit(0).alias("i"), F.array().cast(_SPANS).alias("out"))

    def add(s: Column, x: Column) -> Column:
        begin = (s["at"] + F.length(x["gap"])).cast("bigint")
        end = (begin + F.coalesce(F.length(x["hit"]), F.lit(0))).cast("bigint")
        span = F.struct(begin.alias("start"), end.alias("end"), s["i"].alias("i"))
        return F.struct(end.alias("at"), (s["i"] + 1).alias("i"),
                        F.when(x["hit"].isNull(), s["out"]).otherwise(F.concat(s["out"], F.array(span))).alias("out"))
    spans = F.aggregate(both, start, add, lambda s: s["out"])
    return F.when(F.col(text).rlike(pattern), spans).otherwise(F.array().cast(_SPANS))


def _kind(spans: Column, name: str, rank: int) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), F.lit(name).alias("kind")))


def _tail(z: Column) -> Column:
    """Upper tail of the normal distribution (logistic approximation)."""
    z = F.greatest(F.lit(-8.0), F.least(F.lit(8.0), z))
    return 1 / (1 + F.exp(0.07056 * z * z * z + 1.5976 * z))


def battery(tokens: Column) -> Column:
    """Per token: length class (0: too short, or base64 of one kind of character), p-value bin. One
    step of the work per transform, so that nothing is worked out twice."""
    body = F.transform(tokens, lambda t: F.translate(F.regexp_replace(t, "=+$", ""), "-_", "+/"))
    coded = F.transform(body, lambda t: F.struct(
        t.alias("t"),
        F.when(t.rlike("^[0-9]+$"), DECIMAL).when(t.rlike("^([0-9a-f]+|[0-9A-F]+)$"), HEXADECIMAL)
         .when(t.rlike("^[A-Z2-7]+$") & t.rlike("[2-7]"), BASE32).otherwise(BASE64).alias("alphabet")))
    drawn = F.transform(coded, lambda c: F.struct(
        c["t"].alias("t"), F.length(c["alphabet"]).cast("double").alias("k"), c["alphabet"].alias("alphabet"),
        F.filter(F.transform(F.split(F.when(c["alphabet"] == HEXADECIMAL, F.lower(c["t"])).otherwise(c["t"]), ""),
                             lambda ch: F.instr(c["alphabet"], ch) - 1), lambda s: s >= 0).alias("s")))
    counted = F.transform(drawn, lambda d: F.struct(
        d["t"].alias("t"), d["k"].alias("k"), F.greatest(F.size(d["s"]), F.lit(2)).cast("double").alias("n"),
        F.aggregate(F.transform(F.sequence(F.lit(0), F.length(d["alphabet"]) - 1), lambda v: F.size(F.filter(d["s"], lambda x: x == v))),
                    F.lit(0.0), lambda a, c: a + c * c).alias("squares"),
        F.zip_with(F.slice(d["s"], F.lit(1), F.greatest(F.size(d["s"]) - 1, F.lit(0))), F.slice(d["s"], F.lit(2), F.greatest(F.size(d["s"]) - 1, F.lit(0))),
                   lambda x, y: F.struct((x - (d["k"] - 1) / 2).alias("x"), (y - (d["k"] - 1) / 2).alias("y"))).alias("pairs")))
    tested = F.transform(counted, lambda c: F.struct(
        c["t"].alias("t"), c["k"].alias("k"), c["n"].alias("n"),
        _tail((c["squares"] * c["k"] / c["n"] - c["n"] - (c["k"] - 1)) / F.sqrt(2 * (c["k"] - 1) * (c["n"] - 1) / c["n"])).alias("even"),
        F.least(F.lit(1.0), 2 * _tail(F.abs((F.aggregate(c["pairs"], F.lit(1.0), lambda a, p: a + F.when(p["x"] * p["y"] < 0, 1.0).otherwise(0.0)) - (c["n"] + 1) / 2) / F.sqrt((c["n"] - 1) / 4)))).alias("runs"),
        F.least(F.lit(1.0), 2 * _tail(F.abs(F.aggregate(c["pairs"], F.lit(0.0), lambda a, p: a + p["x"] * p["y"]) * 12 / (c["k"] * c["k"] - 1) / F.sqrt(c["n"] - 1)))).alias("serial")))
    joined = F.transform(tested, lambda d: F.struct(d["t"].alias("t"), d["k"].alias("k"), d["n"].alias("n"), (-(F.ln(d["even"]) + F.ln(d["runs"]) + F.ln(d["serial"]))).alias("x")))
    n_class = lambda n: F.size(F.filter(F.array(*map(F.lit, CLASSES)), lambda c: c <= n))
    sorts = lambda t: sum((F.when(t.rlike(p), 1).otherwise(0) for p in ("[0-9]", "[a-z]", "[A-Z]")), F.lit(0))
    return F.transform(joined, lambda d: F.struct(
        F.when((d["k"] < len(BASE64)) | (sorts(d["t"]) >= 2), n_class(d["n"])).otherwise(0).alias("cls"),
        F.least(F.lit(STEPS), F.greatest(F.lit(0), F.floor(-10 * (F.ln(1 + d["x"] + d["x"] * d["x"] / 2) - d["x"]) / F.lit(2.302585092994046)))).cast("int").alias("bin")))


def found(docs: DataFrame) -> DataFrame:
    """doc_id, base (sorted spans), runs (token-like runs with their test results)."""
    rows = documents(docs).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("_assign", matches("text", ASSIGN)).withColumn("_runs", matches("text", RUN))
    value = F.regexp_extract_all(F.col("text"), F.lit(ASSIGN), F.lit(2))
    rows = rows.withColumn("_values", F.when(F.size("_assign") > 0, value).otherwise(F.array().cast("array<string>")))
    assign = F.filter("_assign", lambda s: F.length(F.get("_values", s["i"])) >= ASSIGN_LEAST)
    base = F.array_sort(F.concat(_kind(assign, "assign", 0), _kind(matches("text", ACCESS), "access", 1), _kind(matches("text", HEX), "hex", 2)))
    tokens = F.transform("_runs", lambda s: F.substring(F.col("text"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))
    rows = rows.select("doc_id", base.alias("base"), "_runs", battery(tokens).alias("_tests"))
    runs = F.zip_with("_runs", "_tests", lambda s, t: F.struct(s["start"].alias("start"), s["end"].alias("end"), t["cls"].alias("cls"), t["bin"].alias("bin")))
    return rows.select("doc_id", "base", runs.alias("runs"))


def rejections(runs: DataFrame, rate: float = RATE) -> dict[int, int]:
    """Per length class, the least bin whose p-values the Benjamini-Hochberg rule rejects."""
    table = runs.select(F.explode("runs").alias("r")).where("r.cls > 0").groupBy("r.cls", "r.bin").agg(F.count(F.lit(1)).alias("n")).collect()
    least: dict[int, int] = {}
    for cls in {r["cls"] for r in table}:
        own = sorted(((r["bin"], r["n"]) for r in table if r["cls"] == cls), reverse=True)
        total, rank = sum(n for _, n in own), 0
        least[cls] = STEPS + 1
        for b, n in own:
            rank += n
            if 10 ** (-b / 10) <= rate * rank / total:
                least[cls] = b
    return least


def scan(docs: DataFrame, rate: float = RATE) -> DataFrame:
    """doc_id, base and spans: arrays of (start, rank, end, kind) in order."""
    rows = stored(found(docs), "secrets")
    least = rejections(rows, rate)
    bar = F.array(*[F.lit(least.get(c, STEPS + 1)) for c in range(len(CLASSES) + 1)])
    clear = lambda r: ~F.exists("base", lambda b: (b["start"] < r["end"]) & (r["start"] < b["end"]))
    passed = F.filter("runs", lambda r: (r["cls"] > 0) & (r["bin"] < F.get(bar, r["cls"])) & clear(r))
    return rows.select("doc_id", "base", F.array_sort(F.concat("base", _kind(passed, "random", 3))).alias("spans"))


def written(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scan(read(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint")
    return rows.select("doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
                       F.sha2(written("base").cast("binary"), 256).alias("base_sha256"), written("spans").alias("spans"))

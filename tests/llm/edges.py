"""Awkward rows every llm operator must take."""

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LONG = " ".join(f"word{i % 997} item{i}" for i in range(6000))

ROWS = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank today.", "en", "a", 70),
    (2, "The quick brown fox jumps over the lazy dog near the river bank today.", "en", "a", 70),      # copy
    (2, "The quick brown fox jumps over the lazy dog near the river bank today.", "en", "a", 70),      # repeated row
    (3, None, None, None, None),
    (4, "", "de", "b", 0),
    (5, " \n\t ", "fr", "b", 4),
    (6, "one", "en", None, 3),
    (7, LONG, "en", "c", len(LONG)),
    (8, "!!! ??? ...", None, "c", 11),
    (None, "a row without an id but with six words", "en", "a", 38),
    (None, None, None, None, None),
    (9, "naïve café déjà vu — 東京 ßtraße \U0001F600 end", "fr", "é", 40),
    (10, "one two three four", "en", "a", 18),
]


def docs(spark, rows=None):
    """With extra columns whose names clash with those the operators work with."""
    df = spark.createDataFrame(ROWS if rows is None else rows, SCHEMA)
    for name in ("score", "size", "node", "_range", "_in", "key", "shard", "y", "stats", "root", "_s", "_words", "base", "copies", "package"):
        df = df.selectExpr("*", f"'x' AS {name}")
    return df


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def rows_of(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)

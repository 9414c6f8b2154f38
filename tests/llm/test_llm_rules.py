import itertools
import math
import re
from collections import Counter

import pytest

import edges
from transferlake.llm import rules
from transferlake.llm.common import read

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    covered = {j for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    seen, repeats = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            repeats += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), repeats, len(covered), failed


def same_base(rows, texts):
    for r in rows:
        assert tuple(r)[1:7] == base(texts[r["doc_id"]])
        assert not (r["base_failed"] and r["kept"]) and 0 <= r["posterior"] <= 1
        assert r["kept"] == (not r["base_failed"] and r["posterior"] >= 0.5)


def test_every_document_against_plain_python(spark):
    rows = rules.op11_quality_rules(spark, SF).collect()
    texts = {r["doc_id"]: r["text"] for r in read(spark, SF, "documents").collect()}
    assert len(rows) == len(texts)
    same_base(rows, texts)
    labels = {r["doc_id"]: r["quality"] for r in read(spark, SF, "labels").collect()}
    judged = [(labels[r["doc_id"]], r["kept"]) for r in rows if not r["base_failed"] and labels.get(r["doc_id"]) is not None]
    for label in (0, 1):      # no label is learned from
        own = [k for y, k in judged if y == label]
        assert own and sum(k == (label == 1) for k in own) >= 0.98 * len(own)


@pytest.mark.parametrize("text, covered", [
    ("a b c", 0), ("a b c a b c", 6), ("a a a", 0), ("a a a a", 4), ("a b c d a b c e", 6), ("x a b c d y a b c d z", 8),
    ("a b a b a b", 6), ("", 0), (" \t\n ", 0), ("a b c\x0bd a b c", 6), ("é x b c é x b c", 6)])
def test_repeated_words(spark, text, covered):
    row = rules.measured(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).first()
    assert row["n_repeat_words"] == covered == base(text)[4]


def brute(counts, steps=rules.STEPS):
    """The same estimate over a dictionary of patterns."""
    start = now = rules.Accuracies.start(rules.RULES, rules.KINDS)

    def post(model, pattern):
        logs = [math.log(s) + sum(math.log(1 - b) if v == 1 else math.log(b) if v == -1 else 0 for v, b in zip(pattern, bad))
                for s, bad in zip(model.shares, model.bad_votes)]
        each = [math.exp(x - max(logs)) for x in logs]
        return [x / sum(each) for x in each]

    for _ in range(steps):
        told = {p: post(now, p) for p in counts}
        total = sum(counts.values())
        shares = [(sum(n * told[p][c] for p, n in counts.items()) + rules.PRIOR * s) / (total + rules.PRIOR) for c, s in enumerate(start.shares)]
        bad = [[(sum(n * told[p][c] for p, n in counts.items() if p[i] == -1) + rules.PRIOR * b)
                / (sum(n * told[p][c] for p, n in counts.items() if p[i]) + rules.PRIOR) for i, b in enumerate(own)] for c, own in enumerate(start.bad_votes)]
        moved = max(abs(x - y) for a, b in zip([now.shares, *now.bad_votes], [shares, *bad]) for x, y in zip(a, b))
        now = rules.Accuracies(shares, bad)
        if moved < rules.SETTLED:
            break
    return now, lambda p: post(now, p)[0]


def test_estimate_against_plain_python(spark):
    rows = rules.op11_quality_rules(spark, "/root/testdata/sf0.001").collect()
    _, good = brute(Counter(tuple(r["votes"]) for r in rows))
    assert all(abs(r["posterior"] - good(tuple(r["votes"]))) < 1e-9 for r in rows)


def test_one_unsound_rule_rejects_nothing(spark):
    """A rule that votes bad at random, and a kind of bad that two rules find."""
    plain = dict.fromkeys(rules.RULES, 1)
    cases = {tuple(plain.values()): 900, tuple({**plain, "endings": -1}.values()): 300, tuple({**plain, "symbols": -1, "letters": -1}.values()): 80,
             tuple({**plain, "capitals": -1, "exclamations": -1}.values()): 20}
    df = spark.createDataFrame([(list(p), n) for p, n in cases.items()], "votes array<int>, n bigint")
    found = rules.estimate(df)
    kept = {tuple(r["votes"]): r["p"] >= 0.5 for r in found.told(df).selectExpr("votes", "_p[0] AS p").collect()}
    assert list(kept[p] for p in cases) == [True, True, False, False]


def test_awkward_rows(spark):
    rows = rules.judged(edges.docs(spark)).collect()
    assert len(rows) == len(edges.ROWS)
    expected = Counter((r[0], *base(r[1])) for r in edges.ROWS)
    assert Counter(tuple(r)[:7] for r in rows) == expected
    assert rules.judged(edges.empty(spark)).count() == 0
    long = "\n".join(itertools.chain(["the same line again"] * 3000, (f"line {i} of a long text" for i in range(3000))))
    row = rules.judged(spark.createDataFrame([(1, long)], "doc_id bigint, text string")).first()
    assert tuple(row)[1:7] == base(long)

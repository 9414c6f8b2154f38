import itertools
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

import edges
from transferlake.llm import language, quality, toxicity
from transferlake.llm.common import in_fold

SF = "/root/testdata/sf0.01"


def accuracy(df, labels, column):
    """Rows held out and their share predicted right."""
    rows = df.join(labels, "doc_id").where("held_out").select("predicted", column, "score").collect()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    return len(rows), sum(r["predicted"] == r[column] for r in rows) / len(rows)


def test_fold_is_crc32_of_the_id(spark):
    ids = list(range(40)) + [10 ** 12]
    got = spark.createDataFrame([(i,) for i in ids], "doc_id bigint").select("doc_id", in_fold(F.col("doc_id"), 5, 0).alias("f")).collect()
    assert {r["doc_id"]: r["f"] for r in got} == {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in ids}


def test_toxicity_holds_out_and_ranks(spark):
    df = toxicity.op1_toxicity(spark, "/root/testdata/sf0.1").cache()
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    n, right = accuracy(df, labels, "toxic")
    assert df.count() == 10_000 and n > 500 and right > 0.95
    rows = df.join(labels, "doc_id").where("held_out").select("score", "toxic").collect()
    on, off = ([r["score"] for r in rows if r["toxic"] == y] for y in (1, 0))
    assert np.mean([(a > b) + 0.5 * (a == b) for a in on for b in off]) > 0.95


def test_quality_holds_out(spark):
    n, right = accuracy(quality.op8_quality(spark, SF), spark.read.parquet(f"{SF}/labels.parquet"), "quality")
    assert n > 80 and right > 0.95


def test_language_holds_out(spark):
    df = language.op6_language(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id")
    rows = df.where("held_out").collect()
    assert len(rows) > 150 and np.mean([r["lang_pred"] == r["lang"] for r in rows]) > 0.97


def test_awkward_rows_and_empty_tables(spark):
    labels = spark.createDataFrame([(1, 1, 0, "z"), (2, 0, 1, "z"), (2, 0, 1, "z"), (3, 0, 1, "z"), (7, 1, 0, "z"), (None, 1, 1, "z"), (9, None, None, "z")],
                                   "doc_id bigint, quality int, toxic int, score string")
    docs, none = edges.docs(spark), labels.limit(0)
    for told in (labels, none, labels.where("doc_id = 1")):
        a = toxicity.score(docs, *toxicity.train(docs, told)).collect()
        stats = quality.with_stats(docs, ["doc_id"])
        b = quality.scored(stats, quality.train(stats, told)).collect()
        for rows in (a, b):
            assert len(rows) == len(edges.ROWS) and all(0 <= r["score"] <= 1 for r in rows)
            by = {}
            for r in rows:
                by.setdefault(r["doc_id"], set()).add(round(r["score"], 9))
            assert by[1] == by[2] and len(by[2]) == 1 and by[3] == by[4]       # equal texts; null and empty
    assert all(r["predicted"] == 1 for r in quality.scored(stats, quality.train(stats, none)).collect())
    assert quality.keep_good(docs, none).count() == len(edges.ROWS)
    void = edges.empty(spark)
    assert toxicity.score(void, *toxicity.train(void, labels)).count() == 0
    assert quality.keep_good(void, labels).count() == 0
    assert language.predict(void, *language.train(void)).count() == 0


def test_language_of_awkward_rows(spark):
    docs = edges.docs(spark)
    rows = language.predict(docs, *language.train(docs)).collect()
    assert len(rows) == len(edges.ROWS)
    und = [r for r in rows if r["doc_id"] in (3, 4, 5, 8)]
    assert all(r["lang_pred"] == "und" and r["score"] == 0 for r in und)
    assert all(r["lang_pred"] in ("en", "fr", "de") for r in rows if r["doc_id"] in (1, 6, 7, 9))
    unknown = language.predict(docs, *language.train(docs.where("false")))
    assert {r["lang_pred"] for r in unknown.collect()} == {"und"}


def test_forward_backward_against_all_paths():
    rng = np.random.default_rng(1)
    scores, moves = rng.normal(size=(1, 4, 3)), rng.normal(size=(3, 3))
    for cut_at in (None, 2):
        cut = np.zeros((1, 4), bool)
        if cut_at is not None:
            cut[0, cut_at] = True
        weight = {p: np.exp(sum(scores[0, t, p[t]] for t in range(4)) + sum(moves[p[t], p[t + 1]] for t in range(3) if not cut[0, t + 1]))
                  for p in itertools.product(range(3), repeat=4)}
        z = sum(weight.values())
        want = np.array([[sum(w for p, w in weight.items() if p[t] == k) / z for k in range(3)] for t in range(4)])
        post, pairs, total = language.forward_backward(scores, np.ones((1, 4), bool), moves, cut)
        assert np.allclose(post[0], want) and np.isclose(total, np.log(z))
        both = np.zeros((3, 3))
        for p, w in weight.items():
            for t in range(3):
                if not cut[0, t + 1]:
                    both[p[t], p[t + 1]] += w / z
        assert np.allclose(pairs, both)


def test_code_switched_text_is_labelled_by_the_longer_part(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names, weights, moves = language.train(docs)
    one = {r["lang"]: r["text"] for r in docs.where("n_chars BETWEEN 800 AND 3000").orderBy("doc_id").limit(300).collect()}
    text = one["fr"][:600] + " " + one["en"][:200]
    (lang,), (score,) = language.label([text], names, weights, moves)
    assert lang == "fr" and 0.55 < score < 0.95


def many_languages(n, rows, words, seed=6):
    """(lang, text) of made-up languages, each with its own 30 words; the last ones have a third of the rows."""
    rng = np.random.default_rng(seed)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz"))
    out = []
    for j in range(n):
        own = ["".join(letters[rng.integers(0, 26, rng.integers(3, 8))]) for _ in range(30)]
        out += [(f"l{j:03d}", " ".join(own[i] for i in rng.integers(0, 30, words))) for _ in range(rows if j < n - 6 else rows // 3)]
    return out


def test_languages_beyond_the_most_frequent_are_learned(spark):
    rows = many_languages(70, 6, 12)
    docs = edges.docs(spark, [(i, t, lang, "a", 0) for i, (lang, t) in enumerate(rows)])
    names, weights, moves = language.train(docs)
    assert names == sorted({lang for lang, _ in rows})
    got = {r["doc_id"]: r["lang_pred"] for r in language.predict(docs, names, weights, moves).collect()}
    assert [got[i] for i in range(len(rows))] == [lang for lang, _ in rows]


def test_languages_of_rows_without_ids_and_of_repeated_rows_are_learned(spark):
    same = "always the very same few words"
    rows = [(None, f"un deux trois mot{i}", "fr", "a", 0) for i in range(60)] + [(None, same, "en", "a", 0)] * 60
    names, weights, moves = language.train(edges.docs(spark, rows), max_per_language=2)
    assert names == ["en", "fr"]
    assert language.label([same, "un deux trois"], names, weights, moves)[0] == ["en", "fr"]
    assert language.train(edges.docs(spark, [(1, "!!!", "en", "a", 3)]))[0] == []


def test_a_fit_in_slices_is_the_same_fit(monkeypatch):
    rows = many_languages(8, 9, 40)
    part = lambda: iter([pd.DataFrame(rows, columns=["lang", "text"])])
    texts = [" ".join(t for _, t in rows[:20])] + [t for _, t in rows]
    seen = []
    for cells in (language.CELLS, 1):
        monkeypatch.setattr(language, "CELLS", cells)
        made = next(language._fit(part())).iloc[0]
        weights, moves = np.frombuffer(made["weights"], np.float32).reshape(8, -1), np.frombuffer(made["moves"]).reshape(8, 8)
        seen.append((weights, moves, language.label(texts, made["names"], weights, moves)))
    (w1, m1, (l1, s1)), (w2, m2, (l2, s2)) = seen
    assert np.allclose(w1, w2, atol=1e-3) and np.allclose(m1, m2, atol=1e-3) and l1 == l2 and np.allclose(s1, s2, atol=1e-3)


def test_isotonic_and_ngrams():
    x, y = quality.isotonic(np.arange(5.0), np.array([0.0, 1.0, 0.0, 1.0, 1.0]), np.ones(5))
    assert list(y) == [0, 0.5, 1, 1] or list(y) == [0, 0.5, 1]
    assert list(np.diff(x) > 0) == [True] * (len(x) - 1)
    grams = [b.tolist() for b, _ in toxicity.ngram_buckets(["abcdefg", "xabcde"], orders=(4,))][0]
    own = [o.tolist() for _, o in toxicity.ngram_buckets(["abcdefg", "xabcde"], orders=(4,))][0]
    assert own == [0] * 5 + [1] * 4 and grams[0] == grams[6] and grams[1] == grams[7]     # text and its closing newline


def test_ridge_sums_equal_one_fit(spark):
    stats = quality.with_stats(spark.read.parquet(f"{SF}/documents.parquet"), ["doc_id"]).cache()
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    a, b = (quality.train(stats.repartition(n), labels) for n in (1, 7))
    x = np.array([r["stats"] for r in stats.limit(50).collect()])
    assert np.allclose(a.raw(x), b.raw(x), atol=1e-6)


def chain(scores, moves):
    """Posteriors of one chain, in logarithms."""
    add = lambda x: np.logaddexp.reduce(x, axis=0)
    ahead, back = [scores[0]], [np.zeros(len(moves))]
    for s in scores[1:]:
        ahead.append(s + add(ahead[-1][:, None] + moves))
    for s in scores[:0:-1]:
        back.append(add((moves + s + back[-1]).T))
    total = np.array(ahead) + np.array(back[::-1])
    return np.exp(total - add(total.T)[:, None])


def test_language_of_whole_texts_against_plain_chains(monkeypatch):
    rng = np.random.default_rng(3)
    names, weights, moves = ["a", "b", "c"], rng.normal(0, 0.3, (3, 1 << language.BITS)).astype(np.float32), rng.normal(0, 1, (3, 3))
    word = lambda: "".join(chr(97 + c) for c in rng.integers(0, 26, rng.integers(1, 9)))
    texts = [" ".join(word() for _ in range(n)) for n in (1, 2, 63, 64, 65, 400, 1500, 7, 64)] + [None, "", "12 !"]
    for cells, points in ((language.CELLS, language.PIECE_POINTS), (3 * 1000, 100)):
        monkeypatch.setattr(language, "CELLS", cells)
        monkeypatch.setattr(language, "PIECE_POINTS", points)
        got, scores = language.label(texts, names, weights, moves)
        words = language.label_words(texts, names, weights, moves)
        for text, lang, score, each in zip(texts, got, scores, words):
            if text is None or not any(c.isalpha() for c in text):
                assert (lang, score, each) == ("und", 0, [])
                continue
            buckets, at, owner = language.featurise([text])
            post = chain(language._emissions(buckets, at, len(owner), weights), moves)
            assert lang == names[post.sum(axis=0).argmax()] and abs(score - post.sum(axis=0).max() / len(post)) < 1e-9
            assert [w for w, _ in each] == [names[j] for j in post.argmax(axis=1)]
            assert np.allclose([p for _, p in each], post.max(axis=1), atol=1e-9)


def test_language_score_depends_on_the_text_alone(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    model = language.train(docs.where("doc_id % 7 <> 0"))

    def scores(df):
        return {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.predict(df, *model).collect()}
    one, other = scores(docs), scores(docs.repartition(13))
    assert len(one) == 10_000 and all(one[i][0] == other[i][0] and abs(one[i][1] - other[i][1]) < 1e-9 for i in one)
    by_text = {}
    for r in docs.select("doc_id", "text").collect():
        by_text.setdefault(r["text"], []).append(one[r["doc_id"]])
    assert sum(len(v) > 1 for v in by_text.values()) > 100
    assert all(max(s for _, s in v) - min(s for _, s in v) < 1e-9 for v in by_text.values())


def test_language_sample_takes_different_rows(spark, monkeypatch):
    """20,000 copies of a row do not take the places of 200 other documents of their language."""
    rows = [(1, "la même ligne", "fr", "a", 12)] * 20_000 + [(10 + i, f"un texte {chr(97 + i % 26)}{chr(97 + i // 26)} de plus", "fr", "a", 20) for i in range(200)]
    docs = spark.createDataFrame(rows + [(5, "another line", "en", "a", 12)], edges.SCHEMA)
    taken = []
    real = type(docs).repartition

    def spied(self, *a, **b):
        if a == (1,):
            taken.extend(self.collect())
        return real(self, *a, **b)
    monkeypatch.setattr(type(docs), "repartition", spied)
    language.train(docs)
    french = [r["text"] for r in taken if r["lang"] == "fr"]
    assert len(french) == language.MAX_PER_LANGUAGE == len(set(french))


def test_toxicity_sample_is_bounded_in_rows(spark, monkeypatch):
    """One labelled id with 3,000 rows, 2,500 of them equal, does not crowd the fitting task."""
    rows = [(1, "the same vile words", "en", "a", 19)] * 2500 + [(1, f"vile words {i}", "en", "a", 12) for i in range(500)]
    rows += [(10 + i, f"kind words {i}", "en", "a", 12) for i in range(120)]
    labels = spark.createDataFrame([(1, 1)] + [(10 + i, 0) for i in range(120)], "doc_id bigint, toxic int")
    taken, real = [], type(labels).repartition

    def spied(self, *a, **b):
        if a == (1,):
            taken.extend(r["y"] for r in self.collect())
        return real(self, *a, **b)
    monkeypatch.setattr(type(labels), "repartition", spied)
    docs = edges.docs(spark, rows)
    found = toxicity.score(docs, *toxicity.train(docs, labels, max_per_class=100)).collect()
    assert taken.count(1) == 100 and taken.count(0) == 100
    assert all(r["predicted"] == (r["doc_id"] == 1) for r in found)

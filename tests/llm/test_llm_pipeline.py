import importlib

import edges
from test_llm_pairs import brute_join, brute_leaks
from test_llm_native import words
from transferlake.llm import mixing, quality
from transferlake.llm.common import read, stored

SF = "/root/testdata/sf0.01"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_against_brute_force(spark):
    pipeline = importlib.import_module("corpus_pipeline")
    docs, seen = read(spark, SF, "documents"), {}
    for name, stage in pipeline.STAGES:
        before = docs
        docs = stored(stage(spark, before, SF), name)
        seen[name] = (before, docs)
    rows = lambda df: [(r["doc_id"], r["text"]) for r in df.collect()]
    for name in list(seen)[:-1]:
        assert seen[name][1].columns == COLUMNS

    before, after = seen["quality"]
    good = {r["doc_id"]: r["quality"] for r in read(spark, SF, "labels").collect()}
    kept = dict(rows(after))
    right = [(d in kept) == bool(q) for d, q in good.items()]
    assert sum(right) / len(right) > 0.95 and set(kept.items()) <= set(rows(before))

    before, after = seen["near_copies"]
    assert sorted(d for d, _ in rows(after)) == sorted({c for _, c, _, _ in brute_join(rows(before))})

    before, after = seen["decontamination"]
    bad = {d for d, *_ in brute_leaks(rows(before), [(r["item_id"], r["text"]) for r in read(spark, SF, "benchmark").collect()])}
    assert bad and sorted(rows(after)) == sorted(r for r in rows(before) if r[0] not in bad)

    before, after = seen["mixing"]
    taken = {r["doc_id"]: r["taken"] for r in mixing.mix(before).collect()}
    got = dict.fromkeys(taken, 0)
    for d, t in rows(after):
        got[d] += words(t)
    assert got == taken

    before, after = seen["sharding"]
    assert sorted(rows(before)) == sorted(rows(after))
    final = sorted(map(repr, after.drop("slot").collect()))
    assert final == sorted(map(repr, pipeline.run(spark, SF).drop("slot").collect()))


def test_pipeline_of_awkward_rows(spark, monkeypatch):
    pipeline = importlib.import_module("corpus_pipeline")
    for docs in (edges.docs(spark), edges.empty(spark)):
        for name, stage in pipeline.STAGES:
            docs = stored(stage(spark, docs, SF), name)
        docs.collect()


def test_nothing_is_rejected_without_labels(spark):
    docs = read(spark, SF, "documents").limit(50)
    assert quality.keep_good(docs, read(spark, SF, "labels").limit(0)).count() == 50

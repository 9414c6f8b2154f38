import re
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest

import edges
from transferlake.llm import decontamination, jaccard
from transferlake.llm.common import read
from transferlake.llm.words import shingle_sets

SF = "/root/testdata/sf0.01"


def shingles(text, width=5):
    w = re.findall(r"[0-9a-z_\x80-\U0010FFFF]+", (text or "").lower())
    return {tuple(w[i:i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()


def brute_join(rows):
    """[(doc_id, class_id, n_links, n_copies)] by comparing every pair of rows."""
    sets, texts = [shingles(t) for _, t in rows], [t or "" for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    by = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            by[x].append(i)
    near = defaultdict(set)
    for i, s in enumerate(sets):
        shared = Counter(j for x in s for j in by[x] if j != i)
        near[i] = {j for j, k in shared.items() if 10 * k >= 8 * (len(s) + len(sets[j]) - k)} | {j for j in range(len(rows)) if j != i and texts[j] == texts[i]}
    for i in near:
        for j in near[i]:
            a, b = find(i), find(j)
            parent[max(a, b)] = min(a, b)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        least[r] = min(x for x in (least.get(r), d) if x is not None) if not (least.get(r) is None and d is None) else None
    return Counter((d, least[find(i)], len(near[i]), texts.count(texts[i])) for i, (d, _) in enumerate(rows))


def got(df):
    return Counter((r["doc_id"], r["class_id"], r["n_links"], r["n_copies"]) for r in df.collect())


def near_copies(n, words=60, seed=3):
    """A chain of texts drifting apart a word at a time, and copies of some."""
    rng = np.random.default_rng(seed)
    now, out = [f"w{i}" for i in range(words)], []
    for _ in range(n):
        now = list(now)
        now[rng.integers(words)] = f"x{rng.integers(10 ** 6)}"
        out.append(" ".join(now))
    return out + out[:n // 4]


def test_join_against_brute_force_on_a_drifting_group(spark):
    rows = [(1000 - i, t) for i, t in enumerate(near_copies(120))]
    df = edges.docs(spark, [(i, t, "en", "a", 0) for i, t in rows])
    assert got(jaccard.join(df)) == brute_join(rows)


def test_groups_cut_into_blocks_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    rows = [(i, t) for i, t in enumerate(near_copies(150, seed=9))]
    df = edges.docs(spark, [(i, t, "en", "a", 0) for i, t in rows])
    assert got(jaccard.join(df)) == brute_join(rows)


def test_join_awkward_rows(spark):
    assert got(jaccard.join(edges.docs(spark))) == brute_join([(r[0], r[1]) for r in edges.ROWS])
    assert jaccard.join(edges.empty(spark)).count() == 0


def test_one_of_each_group_stays(spark):
    docs = read(spark, SF, "documents")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want = sorted({c for _, c, _, _ in brute_join(rows)})
    kept = jaccard.one_of_each(docs)
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sorted(r["doc_id"] for r in kept.collect()) == want
    odd = jaccard.one_of_each(edges.docs(spark)).collect()
    assert Counter(r["doc_id"] for r in odd) == Counter([1, 3, 5, 6, 7, 8, None, 9, 10])
    assert jaccard.one_of_each(edges.empty(spark)).count() == 0


def test_components_against_union_find(spark):
    rng = np.random.default_rng(4)
    pairs = [(f"n{a:03d}", f"n{b:03d}") for a, b in rng.integers(0, 300, (260, 2))] + [(f"p{i:03d}", f"p{i + 1:03d}") for i in range(60)]
    parent = {x: x for p in pairs for x in p}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    rows = jaccard.components(spark.createDataFrame(pairs, "u string, v string")).collect()
    assert {r["node"]: r["root"] for r in rows} == {x: find(x) for x in parent if find(x) != x}


def test_pruning_bars_and_signatures():
    bar = jaccard.bars()
    steps = np.arange(jaccard.STEP, jaccard.HASHES + 1, jaccard.STEP)
    assert (np.diff(bar) > 0).all() and (bar < jaccard.THRESHOLD * steps).all()
    a, b = near_copies(2)[:2]
    sig, keys, counts = jaccard.signatures([a, b, None, a])
    assert (sig[0] == sig[3]).all() and (keys[0] == keys[3]).all() and counts[2] == 0
    j = len(shingles(a) & shingles(b)) / len(shingles(a) | shingles(b))
    assert abs((sig[0] == sig[1]).mean() - j) < 0.15


def test_units_are_whole_whatever_the_batches():
    df = pd.DataFrame({"k": [1, 1, 1, 2, 3, 3, 3, 3, 4], "x": range(9)})
    for size in (1, 2, 4, 9):
        parts = list(jaccard.units((df.iloc[i:i + size] for i in range(0, 9, size)), ["k"]))
        assert pd.concat(parts)["x"].tolist() == list(range(9))
        ends = [set(p["k"]) for p in parts]
        assert all(not (a & b) for i, a in enumerate(ends) for b in ends[i + 1:])


def test_exact_verification_slices():
    rng = np.random.default_rng(0)
    texts = near_copies(30) + [" ".join(f"z{i}" for i in rng.integers(0, 9, 40)) for _ in range(10)]
    sets = shingle_sets(texts)
    a, b = jaccard._linked(sets, np.zeros(len(sets), int), True)
    want = {(i, j) for i in range(len(sets)) for j in range(i + 1, len(sets))
            if 10 * len(np.intersect1d(sets[i], sets[j])) >= 8 * len(np.union1d(sets[i], sets[j]))}
    assert set(zip(a.tolist(), b.tolist())) == want


# --- decontamination ---

def brute_leaks(docs, items):
    out = Counter()
    for q, item in items:
        want = shingles(item) if len(re.findall(r"[0-9a-z_\x80-\U0010FFFF]+", (item or "").lower())) >= 5 else set()
        for d, text in docs:
            k = len(want & shingles(text))
            if want and k >= 0.8 * len(want):
                out[(d, q, k, len(want))] += 1
    return out


def leaked(df):
    return Counter((r["doc_id"], r["item_id"], r["shared"], r["item_shingles"]) for r in df.collect())


def planted():
    rng = np.random.default_rng(8)
    word = lambda: "v%d" % rng.integers(5000)
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate([5, 9, 20, 33, 64, 150, 700])]
    items += [(50, "so " * 60), (51, "too few words"), (52, None), (53, items[2][1])]
    noise = lambda n: " ".join(word() for _ in range(n))
    docs = []
    for i, (_, t) in enumerate(items):
        if t:
            docs.append((100 + i, f"{noise(4000)}. {t.upper()}! {noise(7)}"))
            half = t.split()
            docs.append((200 + i, " ".join(half[:int(len(half) * 0.93)]) + " " + noise(900)))
            docs.append((300 + i, " ".join(half[:len(half) // 2])))
    return docs + [(r[0], r[1]) for r in edges.ROWS], items


@pytest.mark.parametrize("block", [decontamination.BLOCK, 400])
def test_leaks_against_brute_force(spark, block):
    docs, items = planted()
    bench = spark.createDataFrame([(*r, "x") for r in items], "item_id bigint, text string, doc_id string")
    df = edges.docs(spark, [(d, t, "en", "a", 0) for d, t in docs])
    want = brute_leaks(docs, items)
    assert leaked(decontamination.leaks(df, bench, block)) == want and len(want) > 10
    clean = decontamination.decontaminated(df, bench, block)
    bad = {d for d, *_ in want}
    assert clean.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert Counter(r["doc_id"] for r in clean.collect()) == Counter(d for d, _ in docs if d not in bad)


def test_leaks_of_empty_tables(spark):
    bench = spark.createDataFrame([(1, "one two three four five six")], "item_id bigint, text string")
    assert decontamination.leaks(edges.empty(spark), bench).count() == 0
    assert decontamination.leaks(edges.docs(spark), bench.limit(0)).count() == 0
    assert decontamination.decontaminated(edges.docs(spark), bench.limit(0)).count() == len(edges.ROWS)


def test_short_items_are_found_whatever_their_signatures():
    docs, items = [], []
    for seed in (2608, 6840, 7949, 9607, 21649):              # no MinHash value of any window agrees
        w = [f"w{x}" for x in np.random.default_rng(seed).integers(0, 10 ** 9, 60)]
        docs.append(" ".join(w))
        items.append(" ".join(w[12:20] + ["other"]))
    found = decontamination.Items(decontamination.signed(list(range(5)), items)).found(docs)
    assert found == [(i, i, 4) for i in range(5)]

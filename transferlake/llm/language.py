"""Language ID (6): linear-chain conditional random field over the words of a text.

A word's features are hashed: prefixes and suffixes of one to three code points, its character
bigrams and trigrams, and the word itself (the lexicon). Each feature has a weight per language;
learned transitions link a word's language to the next one's. Forward-backward gives every
word's language probabilities, so a text may switch languages; the text's language is the one
with the largest sum, and the score is that sum's share.

A text is one chain from its first word to its last, so its score depends on nothing else: not
on the texts beside it, nor on how rows are dealt to tasks. Texts run side by side, longest
first, one step a word.

The model is fitted on a bounded sample: at most ``max_per_language`` different documents of each
language, those with the smallest hash of id and text. Every language that has a document is
learned, however rare. For training, the sample's words are cut into pieces of ``PIECE_WORDS``
and dealt in a pseudorandom order into chains of ``CHAIN`` words, as code-switched text would be,
so that the transitions learn both staying and switching. It is fitted in one task; the driver
gets the weights (2^16 numbers a language). Prediction is one scan of whole texts, ``CELLS`` code
points times languages at a time (or one text, if it is longer), features made of
``PIECE_POINTS`` code points at once; a word longer than that is cut.

Words are maximal runs of letters and marks beyond ASCII, lower-cased. A text that is null or
has no letter is ``und`` with score 0; so is every text if no language was learned. Null or
blank lang is not learned from. A null or repeated doc_id is a row like any other.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from transferlake.llm.common import documents, in_fold, read
from transferlake.llm.fit import lbfgs
from transferlake.llm.words import U, batches, mix

BITS = 16
CHAIN = 64
PIECE_WORDS = 16
MAX_PER_LANGUAGE = 150
CELLS = 1 << 22             # words (in prediction: twice the code points) times languages worked on at once
PIECE_POINTS = 1 << 18
HISTORY = 512               # of the optimiser: languages times earlier steps kept, 2 to 8 steps
PENALTY = 0.5
STEPS = 30
_KINDS = 9                  # of features: 3 prefixes, 3 suffixes, the word, bigrams, trigrams


def _points(texts: list) -> tuple[np.ndarray, np.ndarray]:
    parts = [np.frombuffer(((t or "").lower() + "\n").encode("utf-32-le", "surrogatepass"), dtype=np.uint32) for t in texts]
    return np.concatenate(parts), np.repeat(np.arange(len(parts)), [len(p) for p in parts])


def _is_letter(points: np.ndarray) -> np.ndarray:
    """ASCII letters, and letters beyond ASCII by Python's own table."""
    out = (points >= 97) & (points <= 122)
    beyond = points >= 128
    if beyond.any():
        kinds = np.unique(points[beyond])
        good = kinds[[chr(k).isalpha() for k in kinds]]
        out |= beyond & np.isin(points, good)
    return out


def featurise(texts: list):
    """(feature buckets, word of each, text of each word), of one batch of texts."""
    points, owner = _points(texts)
    inside = _is_letter(points)
    edge = np.diff(np.concatenate(([0], inside.view(np.int8), [0])))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    n = len(starts)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    code = np.append(np.where(inside, points, 1), [1, 1, 1]).astype(U)       # 1 stands around words
    step = U(0x100000001B3)
    word = np.cumsum(edge[:-1] == 1) - 1
    one, two = code[:-2], code[:-2] * step + code[1:-1]
    three = two * step + code[2:]
    lengths = ends - starts
    made, at = [], []

    def put(kind: int, hashes: np.ndarray, words: np.ndarray):
        made.append(mix(hashes * U(_KINDS) + U(kind)) >> U(64 - BITS))
        at.append(words)

    every = np.arange(n)
    put(0, one[starts], every)
    put(1, two[starts], every)
    put(2, np.where(lengths >= 2, three[starts], two[starts] * step + U(1)), every)     # nothing of the next word
    put(3, one[ends - 1], every)
    has2, has3 = lengths >= 2, lengths >= 3
    put(4, two[ends[has2] - 2], every[has2])
    put(5, three[ends[has3] - 3], every[has3])
    hashed = mix(points.astype(U)) * inside
    total = np.concatenate((np.zeros(1, U), np.cumsum(hashed * np.arange(len(points), dtype=U))))
    plain = np.concatenate((np.zeros(1, U), np.cumsum(hashed)))
    # Sum of code point hashes weighted by place in the word: equal for equal words.
    whole = (total[ends] - total[starts]) - (plain[ends] - plain[starts]) * starts.astype(U) + (plain[ends] - plain[starts]) * U(0x9E37)
    put(6, whole, every)
    in2 = np.flatnonzero(inside[:-1] & inside[1:])
    put(7, two[in2], word[in2])
    in3 = np.flatnonzero(inside[:-2] & inside[1:-1] & inside[2:])
    put(8, three[in3], word[in3])
    return np.concatenate(made).astype(np.int64), np.concatenate(at), owner[starts]


def _slices(n: int, k: int, buckets: np.ndarray, at: np.ndarray):
    """Words 0 .. n-1 as whole chains, CELLS words times k at a time: (first, last + 1, buckets
    and words of the features, words counted from the first)."""
    step = max(1, CELLS // (CHAIN * k)) * CHAIN
    if n <= step:
        return [(0, n, buckets, at)]
    order = np.argsort(at, kind="stable")
    buckets, at = buckets[order], at[order]
    cuts = np.searchsorted(at, np.arange(0, n + step, step))
    return [(a, min(n, a + step), buckets[i:j], at[i:j] - a) for a, i, j in zip(range(0, n, step), cuts, cuts[1:])]


def _emissions(buckets: np.ndarray, at: np.ndarray, n: int, weights: np.ndarray) -> np.ndarray:
    return np.stack([np.bincount(at, w[buckets], n) for w in weights], axis=1)


def _chains(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Words 0 .. n-1 as rows of CHAIN; (index, filled)."""
    rows = -(-n // CHAIN)
    index = np.arange(rows * CHAIN).reshape(rows, CHAIN)
    return np.minimum(index, max(0, n - 1)), index < n


def forward_backward(scores: np.ndarray, filled: np.ndarray, moves: np.ndarray, cut: np.ndarray | None = None):
    """Posteriors [chain, step, language], pair sums [language, language], log-likelihood.
    scores: [chain, step, language]; filled: False past a chain's end; cut: True where a word
    starts a text, so that nothing is carried over from the word before it."""
    chains, steps, k = scores.shape
    top = scores.max(axis=2, keepdims=True)
    local = np.exp(scores - top)
    step = np.exp(moves)
    free = np.ones((k, k))
    ahead, scale = np.zeros((chains, steps, k)), np.ones((chains, steps))
    linked = filled[:, 1:] if cut is None else filled[:, 1:] & ~cut[:, 1:]
    now = local[:, 0].copy()
    for t in range(steps):
        if t:
            go = np.where(linked[:, t - 1, None], ahead[:, t - 1] @ step, ahead[:, t - 1] @ free)
            now = np.where(filled[:, t, None], go * local[:, t], ahead[:, t - 1])
        s = np.where(filled[:, t], now.sum(axis=1), 1.0)
        scale[:, t] = s
        ahead[:, t] = now / s[:, None]
    back = np.ones((chains, steps, k))
    pairs = np.zeros((k, k))
    for t in range(steps - 2, -1, -1):
        nxt = back[:, t + 1] * local[:, t + 1] / scale[:, t + 1, None]
        go = np.where(linked[:, t, None], nxt @ step.T, nxt @ free)
        back[:, t] = np.where(filled[:, t + 1, None], go, back[:, t + 1])
        on = linked[:, t]
        pairs += step * (ahead[on, t].T @ nxt[on])
    post = ahead * back
    post /= post.sum(axis=2, keepdims=True)
    return post, pairs, float((np.log(scale) * filled).sum() + (top[:, :, 0] * filled).sum())


def _fit(parts):
    rows = sorted((lang, text) for pdf in parts for lang, text in zip(pdf["lang"], pdf["text"]))
    names = sorted({lang for lang, _ in rows})
    k, size = len(names), 1 << BITS
    buckets, at, owner, base = [], [], [], 0
    for a, b in batches([t for _, t in rows], 1 << 20):
        f, w, o = featurise([t for _, t in rows[a:b]])
        buckets.append(f)
        at.append(w + base)
        owner.append(o + a)
        base += len(o)
    if not base or k == 0:
        yield pd.DataFrame({"names": [[]], "weights": [b""], "moves": [b""]})
        return
    buckets, at, owner = (np.concatenate(x) for x in (buckets, at, owner))
    label = np.array([names.index(lang) for lang, _ in rows])[owner]
    # Pieces of each text in a pseudorandom order make the chains.
    first = np.searchsorted(owner, np.arange(len(rows)))
    piece = owner * (1 << 32) + (np.arange(base) - first[owner]) // PIECE_WORDS
    order = np.lexsort((np.arange(base), mix(piece.astype(U))))
    place = np.empty(base, np.int64)
    place[order] = np.arange(base)
    at, label = place[at], label[order]
    index, filled = _chains(base)
    inner = filled[:, 1:]
    gold_pairs = np.zeros((k, k))
    np.add.at(gold_pairs, (label[index[:, :-1]][inner], label[index[:, 1:]][inner]), 1)

    slices = _slices(base, k, buckets, at)
    del buckets, at

    def loss(v):
        weights, moves = v[:k * size].reshape(k, size), v[k * size:].reshape(k, k)
        value, grad = PENALTY * (v @ v) / 2 - (gold_pairs * moves).sum(), PENALTY * v
        by_bucket, by_move = grad[:k * size].reshape(k, size), grad[k * size:].reshape(k, k)
        by_move -= gold_pairs
        for a, b, inside, words in slices:
            scores = _emissions(inside, words, b - a, weights)
            index, filled = _chains(b - a)
            post, pairs, log_all = forward_backward(scores[index], filled, moves)
            miss, told = post.reshape(-1, k)[:b - a], (np.arange(b - a), label[a:b])
            value += log_all - scores[told].sum()
            miss[told] -= 1
            by_move += pairs
            for j in range(k):
                by_bucket[j] += np.bincount(inside, miss[words, j], size)
        return value, grad

    v = lbfgs(loss, np.zeros(k * size + k * k), STEPS, memory=max(2, min(8, HISTORY // k)))
    yield pd.DataFrame({"names": [names], "weights": [v[:k * size].astype(np.float32).tobytes()], "moves": [v[k * size:].tobytes()]})


def train(docs: DataFrame, max_per_language: int = MAX_PER_LANGUAGE):
    """(languages, weights [language, bucket], transitions) from documents' text and lang."""
    known = documents(docs).where("trim(lang) <> '' AND text IS NOT NULL")
    known = known.withColumn("_h", F.xxhash64("doc_id", "text"))
    # Of different rows: copies of one row share its hash.
    counts = known.groupBy("lang").agg(F.approx_count_distinct("_h", 0.05).alias("n"), F.min("_h").alias("least")).collect()
    nothing = [], np.zeros((0, 1 << BITS), np.float32), np.zeros((0, 0))
    if not counts:
        return nothing
    # One scan: of each language the share of hashes that holds some times the bound, then the least of those.
    # The least hash is always in: repeated rows share theirs, which may lie above the cut.
    cuts = [(r["lang"], max(r["least"], min((1 << 63) - 1, int(-(1 << 63) + min(1.0, 8 * max_per_language / r["n"]) * (1 << 64))))) for r in counts]
    cuts = docs.sparkSession.createDataFrame(cuts, "lang string, _cut bigint")
    near = known.join(F.broadcast(cuts), "lang").where("_h <= _cut").dropDuplicates(["lang", "_h"])
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("_h", "doc_id", "text"))
    texts = near.withColumn("_rank", rank).where(F.col("_rank") <= max_per_language).select("lang", "text")
    made = texts.repartition(1).mapInPandas(_fit, "names array<string>, weights binary, moves binary").first()
    if made is None or not made["names"]:
        return nothing
    k = len(made["names"])
    return (list(made["names"]), np.frombuffer(made["weights"], np.float32).reshape(k, 1 << BITS).copy(),
            np.frombuffer(made["moves"]).reshape(k, k).copy())


def _pieces(text: str):
    """A lower-cased text cut behind code points that are no letters, so that no word of a
    piece's length or less is split."""
    at = 0
    while len(text) - at > PIECE_POINTS:
        stop = at + PIECE_POINTS
        cut = next((i + 1 for i in range(stop - 1, at, -1) if not text[i].isalpha()), stop)
        yield text[at:cut]
        at = cut
    yield text[at:]


def _scores(texts: list, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(score of each word [word, language], text of each word), in text order."""
    cut = [(i, piece) for i, t in enumerate(texts) for piece in _pieces((t or "").lower())]
    found, owner = [np.zeros((0, len(weights)))], [np.zeros(0, np.int64)]
    for a, b in batches([p for _, p in cut], PIECE_POINTS):
        buckets, at, of = featurise([p for _, p in cut[a:b]])
        if len(of):
            found.append(_emissions(buckets, at, len(of), weights))
            owner.append(np.array([i for i, _ in cut[a:b]])[of])
    return np.concatenate(found), np.concatenate(owner)


def posteriors(scores: np.ndarray, lengths: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(language probabilities of each word, their sums by text). ``scores``: [word, language]
    of whole texts one after another, of ``lengths`` words; each text is a chain of its own."""
    k, order = scores.shape[1], np.argsort(-lengths, kind="stable")
    sorted_lengths = lengths[order]
    steps = int(sorted_lengths[0]) if len(lengths) else 0
    # Step t holds word t of the texts that have one: the first ``active[t]`` of the sorted ones.
    active = np.searchsorted(-sorted_lengths, -np.arange(steps), side="left")
    start = np.concatenate(([0], np.cumsum(active)))
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    first = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    place = start[np.arange(len(scores)) - np.repeat(first, lengths)] + np.repeat(rank, lengths)
    local = np.empty_like(scores)
    local[place] = np.exp(scores - scores.max(axis=1, keepdims=True)) if len(scores) else scores
    step, ahead, scale = np.exp(moves), np.empty_like(local), np.empty((len(local), 1))
    for t in range(steps):
        now = slice(start[t], start[t + 1])
        ahead[now] = local[now] if t == 0 else (ahead[start[t - 1]:start[t - 1] + active[t]] @ step) * local[now]
        scale[now] = ahead[now].sum(axis=1, keepdims=True)
        ahead[now] /= scale[now]
    sums = np.zeros((len(lengths), k))
    back = np.ones((0, k))
    for t in range(steps - 1, -1, -1):
        now, later = slice(start[t], start[t + 1]), slice(start[t + 1], start[t + 1] + len(back))
        new = np.ones((active[t], k))
        new[:len(back)] = (back * local[later] / scale[later]) @ step.T
        back = new
        post = ahead[now] * back
        post /= post.sum(axis=1, keepdims=True)
        ahead[now] = post
        sums[:active[t]] += post
    return ahead[place], sums[rank]


def _groups(texts: list, languages: int):
    """Numbers of the texts, shortest first, CELLS code points times languages at a time."""
    order = sorted(range(len(texts)), key=lambda i: len(texts[i] or ""))
    most = 2 * CELLS // max(1, languages)
    for a, b in batches([texts[i] for i in order], most):
        yield order[a:b]


def _told(texts: list, names: list, weights: np.ndarray, moves: np.ndarray):
    """(numbers of some texts, first word and words of each, probabilities by word, sums by text)."""
    for numbers in _groups(texts, len(names)):
        scores, owner = _scores([texts[i] for i in numbers], weights)
        lengths = np.bincount(owner, minlength=len(numbers))
        some = np.flatnonzero(lengths)
        each, sums = np.zeros((0, len(names))), np.zeros((len(numbers), len(names)))
        if len(some):
            each, sums[some] = posteriors(scores, lengths[some], moves)
        yield numbers, lengths, each, sums


def label(texts: list, names: list, weights: np.ndarray, moves: np.ndarray) -> tuple[list, np.ndarray]:
    """(language, score) of each text."""
    sums = np.zeros((len(texts), max(1, len(names))))
    for numbers, _, _, own in _told(texts, names, weights, moves) if names else ():
        sums[numbers] = own
    total = sums.sum(axis=1)
    best = sums.argmax(axis=1)
    return ([names[j] if t > 0 else "und" for j, t in zip(best, total)], np.where(total > 0, sums.max(axis=1) / np.maximum(total, 1e-9), 0.0))


def label_words(texts: list, names: list, weights: np.ndarray, moves: np.ndarray) -> list[list[tuple]]:
    """(language, probability) of every word of each text, in text order."""
    out: list[list[tuple]] = [[] for _ in texts]
    for numbers, lengths, each, _ in _told(texts, names, weights, moves) if names else ():
        best, at = each.argmax(axis=1), 0
        for i, n in zip(numbers, lengths):
            out[i] = [(names[j], float(p)) for j, p in zip(best[at:at + n], each[np.arange(at, at + n), best[at:at + n]])]
            at += n
    return out


def predict_words(docs: DataFrame, names: list, weights: np.ndarray, moves: np.ndarray) -> DataFrame:
    """doc_id, words: the language of every word of the text, in order, with its probability."""
    def run(parts):
        for pdf in parts:
            told = label_words(pdf["text"].tolist(), names, weights, moves)
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "words": [[{"lang": w, "score": min(1.0, p)} for w, p in t] for t in told]})
    return documents(docs).select("doc_id", "text").mapInPandas(run, "doc_id bigint, words array<struct<lang string, score double>>")


def predict(docs: DataFrame, names: list, weights: np.ndarray, moves: np.ndarray) -> DataFrame:
    """doc_id, lang_pred, score."""
    def run(parts):
        for pdf in parts:
            lang, score = label(pdf["text"].tolist(), names, weights, moves)
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "lang_pred": lang, "score": np.clip(score, 0, 1)})
    return documents(docs).select("doc_id", "text").mapInPandas(run, "doc_id bigint, lang_pred string, score double")


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    held = in_fold(F.col("doc_id"), 4, 2)
    return predict(docs, *train(docs.where(~held))).select("doc_id", held.alias("held_out"), "lang_pred", "score")

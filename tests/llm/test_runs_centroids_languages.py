"""Periodic runs, centroid clustering and language mixtures against brute force and held-out rows."""

import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm import centroids, languages, periods
from llm.registry import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
# Extra columns clash with names that the operators use inside and return.
CLASH = "doc_id long, text string, runs string, n_words string, start int, score string, lang_pred int, slice string, counts long"


def frame(spark, rows):
    made = [(i, t, "r", "w", 1, "s", 2, "x", 3) for i, t in rows]
    return spark.createDataFrame(made, CLASH).repartition(5)


# ---------------------------------------------------------------- periodic runs

def brute_runs(words, min_length=6, min_exponent=4):
    """Every maximal repetition by trying every period at every place; the smallest period of equal stretches stays."""
    found = {}
    n = len(words)
    for q in range(1, n // min_exponent + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if length >= max(min_length, min_exponent * q):
                found.setdefault((i, length), q)
            i = j + 1
    return sorted((s, n, q) for (s, n), q in found.items())


def brute_collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def periodic_texts(seed=3):
    rng = random.Random(seed)
    texts = [None, "", " \t\n", "a", "a a a", "a a a a a", "a a a a a a", "a b " * 4, "a b " * 2 + "a b a b c", "word " * 3000, "x" * 20000, "a\nA a\x0ba a"]
    for size in (1, 2, 3):
        for _ in range(60):
            words = [rng.choice("abc"[:size]) for _ in range(rng.randint(0, 60))]
            texts.append(" ".join(words))
    for _ in range(60):  # repeats of any period, overlapping and nested ones
        words = []
        while len(words) < 120:
            part = [rng.choice("abcd") for _ in range(rng.randint(1, 9))]
            part = part * rng.randint(1, 3) + part[:1]
            words += part * rng.randint(1, 6) + part[: rng.randint(0, len(part))]
        texts.append("  ".join(words))
    return list(enumerate(texts))


@pytest.mark.parametrize("least", [(6, 4), (1, 3), (10, 5)])
def test_runs_are_those_of_brute_force(spark, least):
    rows = periodic_texts()
    got = {r["doc_id"]: r for r in periods.periodic_runs(frame(spark, rows), *least).collect()}
    assert len(got) == len(rows) and list(next(iter(got.values())).asDict()) == ["doc_id", "n_words", "runs", "collapsed"]
    n_runs = 0
    for i, text in rows:
        words = WORD.findall(text or "")
        want = brute_runs(words, *least)
        assert [tuple(r) for r in got[i]["runs"]] == want, text
        assert got[i]["n_words"] == len(words) and got[i]["collapsed"] == brute_collapsed(words, want)
        n_runs += len(want)
    assert n_runs > 80


def test_runs_of_awkward_tables(spark):
    assert periods.periodic_runs(frame(spark, []).limit(0)).count() == 0
    twice = [(1, "a b " * 5), (1, "a b " * 5), (None, "a " * 9), (None, None)]
    got = sorted(periods.run_digests(periods.periodic_runs(frame(spark, twice))).collect(), key=repr)
    assert len(got) == 4 and sorted(r["n_runs"] for r in got) == [0, 1, 1, 1]
    with pytest.raises(ValueError):
        periods.word_runs(np.zeros(4, np.int64), np.array([0, 4]), min_exponent=2)


def test_runs_of_a_very_long_text(spark):
    rng = random.Random(5)
    part = [f"w{rng.randrange(10**6)}" for _ in range(50_000)]
    text = " ".join(part * 4 + ["end"] + [str(i) for i in range(50_000)])
    row = periods.periodic_runs(frame(spark, [(7, text)])).first()
    assert [tuple(r) for r in row["runs"]] == [(0, 200_000, 50_000)] and len(row["collapsed"].split(" ")) == 100_001


def test_run_digests_and_repeated_ends(spark):
    rows = periodic_texts(9)[9:80]
    rows = [(i * 37, t) for i, t in rows] + [(None, "a b c"), (1, "x " + "a b " * 5 + "y " + "c d " * 5 + "z " + "e " * 10)]
    ended = {r["doc_id"]: r["text"] for r in periods.with_repeated_ends(frame(spark, rows)).collect()}
    changed = 0
    for i, text in rows:
        words = WORD.findall(text)
        h = zlib.crc32(str(i).encode())
        if i is not None and h % 10 == 0 and words:
            n, g = len(words), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if k < a else words[a + (k - a) % p] for k, w in enumerate(words)]
            changed += 1
        assert WORD.findall(ended[i]) == words
    assert changed
    digests = {r["doc_id"]: r for r in periods.run_digests(periods.periodic_runs(frame(spark, rows))).collect()}
    ties = 0
    for i, text in rows:
        words = WORD.findall(text)
        runs = brute_runs(words)
        row = digests[i]
        assert row["runs_sha256"] == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        assert row["collapsed_sha256"] == hashlib.sha256(brute_collapsed(words, runs).encode()).hexdigest()
        best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None, None, None))
        ties += len({r[1] / r[2] for r in runs}) < len(runs)
        assert (row["start"], row["length"], row["period"]) == best and row["n_runs"] == len(runs)
        assert row["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
    assert ties


# ---------------------------------------------------------------- clustering

def brute_clusters(rows, k, rounds, parts, scale=256, seed="2"):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows
            if v is not None and len(v) == parts and all(x is not None and math.isfinite(scale * x) for x in v)]
    named = sorted((hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), ",".join(map(str, v)), v) for i, v in kept if i is not None)
    centers = [v for _, _, v in named[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(centers))
    for _ in range(rounds):
        own = [[] for _ in centers]
        for _, v in kept:
            own[near(v)[1]].append(v)
        centers = [[sum(x) // len(vs) for x in zip(*vs, strict=True)] if vs else c for vs, c in zip(own, centers, strict=True)]
    out = [(i, *reversed(near(v))) for i, v in kept]
    total = sum(d for _, _, d in out)
    sums = [sum(d for _, c, d in out if c == j) for j in range(len(centers))]
    return sorted(((i, c, d, sums[c], total, [str(x) for x in centers[c]]) for i, c, d in out), key=repr)


def vectors(spark, rows, kind="double"):
    made = [(i, v, 1, "c", 2) for i, v in rows]
    return spark.createDataFrame(made, f"vec_id long, embedding array<{kind}>, cluster int, distance string, inertia int").repartition(3)


def clustered(df, **options):
    return sorted([tuple(r) for r in centroids.cluster_vectors(df, **options).collect()], key=repr)


def test_clusters_are_those_of_brute_force(spark):
    rng = random.Random(11)
    middles = [[rng.uniform(-3, 3) for _ in range(5)] for _ in range(4)]
    rows = [(i, [round(rng.gauss(m, 0.4), 2) for m in rng.choice(middles)]) for i in range(300)]
    rows += [(300 + i, [0.5] * 5) for i in range(200)]  # a common vector: equal distances, equal centroids, empty clusters
    rows += [(3, rows[3][1]), (3, [9.0] * 5), (None, [1.0] * 5), (900, None), (901, []), (902, [1.0] * 4), (903, [1.0] * 6),
             (904, [1.0, None, 1.0, 1.0, 1.0]), (905, [float("nan")] * 5), (906, [float("inf"), 0.0, 0.0, 0.0, 0.0])]
    got = clustered(vectors(spark, rows), k=30, parts=5)
    assert got == brute_clusters(rows, 30, 5, 5)
    assert len({r[1] for r in got}) < 30  # some stay empty, their centroids as they were


def test_search_rejects_and_stays_exact():
    rng = np.random.default_rng(2)
    centers = rng.integers(-50, 50, (60, 8))
    centers[7] = centers[20]
    x = rng.integers(-60, 60, (3000, 8))
    which, distance = centroids.Centroids(centers.astype(object)).nearest(x)
    every = ((x[:, None, :] - centers[None]) ** 2).sum(axis=2)
    assert (distance == every.min(axis=1)).all() and (which == every.argmin(axis=1)).all()


def test_clusters_of_awkward_tables(spark):
    assert clustered(vectors(spark, []), parts=3) == []
    few = [(1, [0.1, 0.2, 0.3]), (2, [0.1, 0.2, 0.3]), (3, [-1.5, 0.0, 1e5])]
    assert clustered(vectors(spark, few), parts=3) == brute_clusters(few, 40, 5, 3)
    assert clustered(vectors(spark, [(None, [1.0, 1.0, 1.0])]), parts=3) == []  # no row can be a first centroid
    huge = [(1, [1e30, 0.0, 0.0]), (2, [1.0, 2.0, 3.0]), (3, [1e306, 0.0, 0.0]), (4, [1e30, 1e5, 0.0])]
    got = clustered(vectors(spark, huge), parts=3, k=1)
    want = [(i, c, None if d >= 2**63 else d, None, None, v) for i, c, d, _, _, v in brute_clusters(huge, 1, 5, 3)]
    assert got == want and len(got) == 3
    floats = [(i, [float(np.float32(math.sin(i * j + 1))) for j in range(4)]) for i in range(50)]
    assert clustered(vectors(spark, floats, "float"), parts=4, k=6) == brute_clusters(floats, 6, 5, 4)


# ---------------------------------------------------------------- languages

def plain_trigrams(text):
    lowered = "".join(c if c.isalpha() else " " for c in (text or "").lower())
    padded = " " + re.sub(" +", " ", lowered) + " "
    return [padded[i:i + 3] for i in range(len(padded) - 2) if padded[i + 1] != " "]


def best_mixture(counts, chances, subset):
    """Shares of a set by many rounds of expectation-maximisation, and their log likelihood."""
    p = chances[list(subset)]
    shares = np.full(len(subset), 1 / len(subset))
    for _ in range(1000):
        shares = shares * (p / (shares @ p) * counts).sum(axis=1) / counts.sum()
    return shares, float((counts * np.log(shares @ p)).sum())


@pytest.fixture(scope="module")
def learnt(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return docs, languages.learn_languages(docs.where("doc_id % 5 > 0"))


def test_counts_are_those_of_plain_python(spark):
    rows = [("Äb é c", "x"), ("ab ab", "x"), ("ab!ab", "y"), (None, "y"), ("zz", None), ("1 2", "z"), ("", "z")]
    model = languages.learn_languages(spark.createDataFrame(rows, "text string, lang string"))
    assert model.languages == ["x", "y"]
    assert plain_trigrams("Äb é c") == [" äb", "äb ", " é ", " c "] and plain_trigrams("12") == []
    slots, first = languages.trigrams([t for t, _ in rows])
    assert np.diff(first).tolist() == [len(plain_trigrams(t)) for t, _ in rows]
    assert slots[first[1]:first[1] + 4].tolist() == [*slots[first[1]:first[1] + 2]] * 2
    x, y = (np.bincount(np.concatenate([slots[first[i]:first[i + 1]] for i in own]), minlength=1 << languages.BITS) for own in ((0, 1), (2, 3)))
    together = (x + y + 0.5) / (x + y + 0.5).sum()
    for got, own in zip(model.chances, (x, y), strict=True):
        assert np.allclose(got, (1 - languages.COMMON) * own / own.sum() + languages.COMMON * together)
    assert languages.learn_languages(spark.createDataFrame([], "text string, lang string")).languages == []


def test_sets_are_the_best_of_all_sets(spark, learnt):
    docs, model = learnt
    held = [r for r in docs.where("doc_id % 5 = 0 and length(text) > 40").orderBy("doc_id").limit(24).collect()]
    texts = [r["text"][:600] for r in held]
    texts += [f"{a[:300]} {b[:n]}" for (a, b), n in zip(itertools.combinations(texts[:6], 2), itertools.cycle((40, 120, 300)), strict=False)]
    several = 0
    for text in texts:
        slots, _ = languages.trigrams([text])
        at, counts = np.unique(slots, return_counts=True)
        chances, n = model.chances[:, at], np.array([counts.sum()], float)
        price = float(languages.cost(n)[0])
        value = {}
        for size in range(1, len(model.languages) + 1):
            for subset in itertools.combinations(range(len(model.languages)), size):
                value[subset] = (*best_mixture(counts, chances, subset), size)
        penalised = {s: v[1] - (v[2] - 1) * price for s, v in value.items()}
        best = max(penalised, key=penalised.get)
        lang, score, n_trigrams, found = next(languages._answers([text], model))
        chosen = tuple(sorted(model.languages.index(x["lang"]) for x in found))
        assert penalised[chosen] >= penalised[best] - 0.05 and n_trigrams == counts.sum()
        for x in found:
            share = value[chosen][0][chosen.index(model.languages.index(x["lang"]))]
            assert abs(x["share"] - share) < 0.02
        assert lang == found[0]["lang"] and 0 <= score <= 1
        several += len(found) > 1
    assert several


def test_held_out_languages(spark, learnt):
    docs, model = learnt
    held = docs.where("doc_id % 5 = 0 and text rlike '\\\\p{L}{3}'")
    found = languages.identify_languages(held, model).join(held.select("doc_id", "lang"), "doc_id")
    right, n = found.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n >= 30 and right >= 0.97 * n


def test_languages_of_awkward_tables(spark, learnt):
    docs, model = learnt
    long = " ".join(r["text"] for r in docs.where("lang = 'de'").limit(20).collect()) * 5
    rows = [(1, None), (2, ""), (3, " 12 !\n"), (4, "a"), (None, "und der die"), (5, long), (5, long), (6, "日本語"), (7, "İİ ß")]
    got = sorted(languages.identify_languages(frame(spark, rows), model).collect(), key=lambda r: (r["doc_id"] or 0, r["n_trigrams"]))
    assert len(got) == len(rows)
    for row in got:
        if row["doc_id"] in (1, 2, 3):
            assert (row["lang_pred"], row["score"], row["languages"]) == ("und", 0.0, [])
        else:
            assert row["lang_pred"] in model.languages and 0 < row["score"] <= 1
            assert abs(sum(x["share"] for x in row["languages"]) - 1) < 1e-6
    assert [r["lang_pred"] for r in got if r["doc_id"] in (None, 5)] == ["de"] * 3
    assert languages.identify_languages(frame(spark, []).limit(0), model).count() == 0
    unlearnt = languages.identify_languages(frame(spark, rows), languages.LanguageModel([], np.zeros((0, 1 << languages.BITS))))
    assert {r["lang_pred"] for r in unlearnt.collect()} == {"und"}


def test_registered(spark, sf_dir):
    found = QUERIES["op13_language_mixtures"](spark, sf_dir).collect()
    assert len(found) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in found)

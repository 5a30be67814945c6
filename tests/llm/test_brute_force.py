"""Classifiers and the pipeline's stages against plain Python, on rows with nulls, copies, a hot id and long texts."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from tokenizers import Tokenizer

import corpus_pipeline
from aqspark.llm import quality, queries, toxicity

RNG = np.random.default_rng(11)
SOUND, JUNK, RUDE = "river stone morning garden letter window".split(), ["$$$", "A1b2", "xx", "#"], "zounds blast drat".split()


def prose(words, n):
    return " ".join(RNG.choice(words, n)) + "."


BASE = " ".join(f"word{i}" for i in range(300))
TEXTS = [(i, prose(SOUND, 40 + i) if i % 3 else prose(JUNK, 30 + i)) for i in range(1, 31)]
TEXTS += [(i, prose(SOUND + RUDE * 3, 60)) for i in range(31, 45)]
TEXTS += [(50, BASE), (51, BASE + "  "), (52, BASE + " tail"), (53, None), (54, ""), (55, " \n"), (None, "an unnamed row"), (56, prose(SOUND, 30) + " " + " ".join(f"b{i}" for i in range(20))), (57, "Straße 日本語 naïve")]
TEXTS += [(7, f"hot row {i % 5} " + prose(SOUND, 25)) for i in range(25)] + [(7, "hot row again")] * 5
LABELS = [(i, int(i % 3 > 0), 0) for i in range(1, 31)] + [(i, 1, 1) for i in range(31, 45)] + [(50, 1, 0), (53, 0, 0), (7, 1, 0), (None, 1, 1), (999, 1, 1)]
BENCHMARK = [(1, " ".join(f"b{i}" for i in range(18))), (2, None), (3, "")]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
ascii_lower = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
words_of = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", ascii_lower(t))


@pytest.fixture(scope="module")
def docs(spark):
    queries.importable(spark)
    return spark.createDataFrame([(i, t, "en", "s", 0) for i, t in TEXTS], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame(BENCHMARK, "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return d


# ---- quality --------------------------------------------------------------------------------------


def plain_features(text):
    """Place and value of each feature of one text, from dictionaries."""
    w = [x for x in re.split("[ \t-\r]+", text or "") if x]
    n, share = len(w), 1 / max(1, len(w))
    place = lambda kind, value: 8 + xxhash.xxh64_intdigest(kind + value, 7) % ((1 << 15) - 8)

    def shape(x):
        signs = re.sub(rb"[0-9]+", b"0", re.sub(rb"[A-Z]+", b"A", re.sub(rb"[a-z\x80-\xff]+", b"a", x.encode())))
        return re.sub(rb"(?s)(.)\1+", rb"\1", signs)

    total = defaultdict(float)
    for x in w:
        total[place(b"w", ascii_lower(x).encode())] += share
        total[place(b"s", shape(x))] += share
    for x, y in zip(w, w[1:]):
        total[place(b"p", shape(x) + b" " + shape(y))] += share
    kinds, repeats = len(set(w)), sum(x == y for x, y in zip(w, w[1:]))
    figures = [1, math.log1p(n) / 5, math.log1p(n) ** 2 / 25, kinds * share, math.sqrt(kinds * share), repeats * share * 3, sum(len(x.encode()) for x in w) * share / 10, float(n == 0)]
    return {k: math.sqrt(v) for k, v in total.items()} | dict(enumerate(figures))


def plain_tail(theta, text, least=1):
    latent = sum(theta[k] * v for k, v in plain_features(text).items())
    edges = np.cumsum([theta[quality.DIMENSIONS], *np.exp(theta[quality.DIMENSIONS + 1 :])])
    return [1 / (1 + math.exp(e - latent)) for e in edges]


def test_quality_equals_plain_features_and_likelihood(spark, docs):
    rated = quality.grades(spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int"))
    theta = quality.train(docs, rated)
    got = sorted((r["doc_id"] or 0, r["tail"], r["expected_grade"]) for r in quality.predict(docs, theta).collect())
    chances = [(i, plain_tail(theta, t)) for i, t in TEXTS]
    assert np.allclose(got, sorted((i or 0, p[0], sum(p)) for i, p in chances), atol=1e-8)
    kept = quality.select(docs, rated)
    assert Counter(r["text"] for r in kept.collect()) == Counter(t for (_, t), (_, p) in zip(TEXTS, chances) if p[0] >= 0.5)
    # the fit is a minimum of the plain likelihood: small steps along the thresholds and some weights don't lower it
    grade = {i: (0 if not q else 1 if x else 2) for i, q, x in LABELS if i is not None}
    own = {}
    for i, t in TEXTS:
        if i in grade:
            own.setdefault(i, t)
    rows = [(plain_features(own[i]), grade[i]) for i in own if i != 7]

    def loss(p):
        edges, out = [-math.inf, *np.cumsum([p[quality.DIMENSIONS], *np.exp(p[quality.DIMENSIONS + 1 :])]), math.inf], 0.0
        for f, g in rows:
            x = sum(p[k] * v for k, v in f.items())
            above = lambda e: 1 / (1 + math.exp(min(700, e - x))) if e < math.inf else 0.0
            out -= math.log(max(1e-12, above(edges[g]) - above(edges[g + 1]))) / len(rows)
        return out

    assert loss(theta) < 0.5 * loss(np.concatenate([np.zeros(quality.DIMENSIONS), theta[quality.DIMENSIONS :]]))


# ---- toxicity -------------------------------------------------------------------------------------


def plain_toxicity(texts, labels, order=6, discount=0.75):
    """Scores from dictionaries of gram counts."""
    crc = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 5
    label = {}
    for i, _, t in labels:
        if i is not None and t is not None and crc(i):
            label[i] = max(t, label.get(i, 0))
    split = lambda t: [w.encode() for w in words_of(t)]
    grams = lambda w: [(b" " * order + w + b" ")[k : k + order] for k in range(1, len(w) + 2)]
    counts, everything = defaultdict(Counter), set()
    for i, t in texts:
        for w in set(split(t)):
            for g in grams(w):
                everything.add(g)
                if i in label:
                    for v in ("", str(crc(i) % 2)):
                        counts["ab"[label[i]] + v][g] += 1
    levels, lower = {}, everything
    for k in range(order - 1, 0, -1):
        levels[k] = Counter(g[-k:] for g in lower)
        lower = set(levels[k])
    p = {}
    for k in range(1, order):
        total, kinds = Counter(), Counter()
        for g, n in levels[k].items():
            total[g[:-1]] += n
            kinds[g[:-1]] += 1
        for g, n in levels[k].items():
            back = discount * kinds[g[:-1]]
            p[g] = (max(n - discount, 0) + back * (p[g[1:]] if k > 1 else 1 / 256)) / total[g[:-1]]
    heads = {c: Counter() for c in counts}
    cut = {c: Counter() for c in counts}
    for c, own in counts.items():
        for g, n in own.items():
            heads[c][g[:-1]] += n
            cut[c][g[:-1]] += min(n, discount)

    def ratio(g, v):
        if not counts["a"][g] + counts["b"][g] and not heads["a"][g[:-1]] + heads["b"][g[:-1]]:
            return 0.0
        seen = counts["a"][g] + counts["b"][g] > 0

        def log(c):
            back = cut[c + v][g[:-1]] + 1.0
            return math.log((max(counts[c + v][g] - discount, 0) + back * p[g[1:]] if seen else back) / (heads[c + v][g[:-1]] + 1.0))

        return round((log("b") - log("a")) * 2**24) / 2**24

    for c in ("a", "b"):
        for v in ("", "0", "1"):
            counts[c + v], heads.setdefault(c + v, Counter()), cut.setdefault(c + v, Counter())
    known = {}

    def word(w, v):
        if (w, v) not in known:
            known[w, v] = sum(ratio(g, v) for g in grams(w)) / (len(w) + 1)
        return known[w, v]

    def peaks(ws, v):
        r = sorted((word(w, v) for w in ws), reverse=True)
        if not r:
            return [0.0] * 5
        n = len(r)
        return [sum(r) / n, r[0], sum(r[:3]) / min(n, 3), sum(max(x - 0.3, 0) for x in r) / n * 10, r[min(n - 1, n // 50)]]

    whole = [peaks(split(t), "") for _, t in texts]
    other = {}
    for i, t in texts:
        if i in label:
            x = peaks(split(t), "1" if crc(i) % 2 == 0 else "0")
            other[i] = min(other.get(i, x), x)
    ids = sorted(other)
    weights, offset = toxicity.fit_curve(np.array([other[i] for i in ids]), np.array([float(label[i]) for i in ids]))
    return sorted((i or 0, 1 / (1 + math.exp(-(offset + float(np.dot(weights, x)))))) for (i, _), x in zip(texts, whole))


def test_toxicity_equals_plain_counts(spark, docs):
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    got = sorted((r["doc_id"] or 0, r["score"]) for r in toxicity.score(docs, labels).collect())
    expected = plain_toxicity(TEXTS, LABELS)
    assert [i for i, _ in got] == [i for i, _ in expected]
    assert np.allclose([s for _, s in got], [s for _, s in expected], atol=1e-6)


# ---- stages ---------------------------------------------------------------------------------------


def fingerprint(text):
    w = [x for x in re.split("[ \t-\r]+", ascii_lower(text)) if x]
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + 3]), 42) for i in range(max(1, len(w) - 2))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_exact(rows):
    groups = defaultdict(list)
    for k, (i, t) in enumerate(rows):
        groups[re.sub("[ \t-\r]", "", t or "")].append((-len(t or ""), i is None, i or 0, k))
    return [rows[min(v)[3]] for v in groups.values()]


def plain_near(rows):
    """One row of each component: the smallest id, told apart by its text."""
    prints = [fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 3:
                root[find(a)] = find(b)
    groups = defaultdict(list)
    for k in range(len(rows)):
        groups[find(k)].append(rows[k])
    return [[(i, t) for i, t in g if (i is None, i or 0) == min((j is None, j or 0) for j, _ in g)] for g in groups.values()]


def plain_clean(rows):
    items = [words_of(t) for _, t in BENCHMARK]
    windows = {tuple(q[k : k + min(13, len(q))]) for q in items if q for k in range(max(1, len(q) - 12))}
    kept = []
    for i, t in rows:
        w, hit = words_of(t), set()
        for win in windows:
            for k in range(len(w) - len(win) + 1):
                if tuple(w[k : k + len(win)]) == win:
                    hit.update(range(k, k + len(win)))
        if not (hit and 20 * len(hit) >= len(w)):
            kept.append((i, t))
    return kept


def bag(rows):
    return Counter((i, t) for i, t in rows)


def held(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def test_each_stage_equals_plain_python(spark, docs, tables):
    steps = dict(corpus_pipeline.STAGES)
    for name, plain in (("exact_dedup", plain_exact), ("decontamination", plain_clean)):
        out = steps[name](spark, docs, tables)
        assert out.columns == docs.columns and bag(held(out)) == bag(plain(TEXTS)), name
    near = bag(held(steps["near_dedup"](spark, docs, tables)))
    groups = plain_near(TEXTS)
    assert sum(near.values()) == len(groups) and all(sum((bag(g) & near).values()) >= 1 for g in groups)
    theta = quality.train(docs, quality.grades(spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")))
    assert bag(held(steps["quality"](spark, docs, tables))) == bag([(i, t) for i, t in TEXTS if plain_tail(theta, t)[0] >= 0.5])
    tokenizer = Tokenizer.from_file(queries.TOKENIZER)
    pieces = defaultdict(dict)
    used = Counter()
    for r in steps["packing"](spark, docs, tables).collect():
        used[r["sequence_id"]] += r["length"]
        assert r["ids_crc32"] == zlib.crc32(bytes(r["ids"])) and len(r["ids"]) == 4 * r["length"]
        pieces[r["doc_id"], r["doc_tokens"]].setdefault(r["start"], []).append(bytes(r["ids"]))
    whole = Counter(hashlib.sha256(np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], dtype="<u4").tobytes()).hexdigest() for _, t in TEXTS)
    single = Counter(hashlib.sha256(v[0]).hexdigest() for (_, n), starts in pieces.items() for s, v in starts.items() for v in [[x] for x in v] if s == 0 and len(v[0]) == 4 * n)
    assert not single - whole and sum(used.values()) == sum(len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in TEXTS)
    assert all(n == 2048 for s, n in used.items() if s < max(used))


@pytest.mark.parametrize("rows", [[], [(i, None) for i in range(4)] + [(1, None)] * 3, [(7, f"x{i % 2} y z") for i in range(9)]])
def test_all_stages_of_small_and_odd_tables(spark, tables, rows):
    left = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], SCHEMA)
    for name, step in corpus_pipeline.STAGES[:-1]:
        out = step(spark, left, tables)
        assert out.columns == left.columns and out.count() <= left.count(), name
        left = corpus_pipeline.stage_compact(out, name)
    packed = corpus_pipeline.STAGES[-1][1](spark, left, tables)
    assert packed.where("start = 0").count() == left.count()

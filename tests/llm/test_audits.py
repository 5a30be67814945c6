"""Licence scan, resampling and filter audit against brute force on rows with nulls, empty and long texts, copies, repeated rows and clashing names."""

import hashlib
import math
import re
import zlib
from collections import Counter
from itertools import permutations

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from aqspark.llm import filter_audit, licenses, queries, resampling

SCHEMA = "doc_id long, text string, lang string, key string, mask string, part string, score string, at string, n string, buckets string"
LONG = " ".join(f"w{i % 977}" for i in range(30_000))
TEXTS = [
    (1, "Released under the MIT License. Under-the-MIT license!", "en"), (2, "Apache License, Version 2.0", "en"), (3, "cc by-nc-nd 4.0 CC BY NC cc by", "de"), (4, None, "de"), (5, "", None),
    (6, " \t\n", ""), (7, "One # two", "fr"), (8, LONG + " the GNU GPL under the MIT license " + LONG, "en"), (9, "a a a a", "en"), (9, "a a a a", "en"), (10, "a a a a", "de"), (None, "a a a a", "en"),
    (11, "Straße naïve 日本語\xa0x SPDX-License-Identifier: GPL-2.0-only", "en"), (12, "ABC DEF", "en"), (None, "no id", None), (13, "undertheMIT license mit under the MIT licenses", "en"),
]
BENCHMARK = [(1, "One two two naïve"), (2, None), (3, ""), (3, "under the MIT licence w5 w5")]


@pytest.fixture(scope="module")
def docs(spark):
    queries.importable(spark)
    return spark.createDataFrame([(i, t, x, "k", "m", "p", "s", "a", "n", "b") for i, t, x in TEXTS], SCHEMA).repartition(3)


def words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


# ---- licences -------------------------------------------------------------------------------------


def places(text):
    w = words(text)
    return len(w), sorted((i, label) for phrase, label in licenses.BASE.items() for i in range(len(w)) if w[i : i + len(p := phrase.split())] == p)


def test_base_phrases(spark, docs):
    got = sorted((r["doc_id"] or 0, r["n_words"], sorted((x["first"], x["label"]) for x in r["detections"] if x["kind"] == "base"), r["score"]) for r in licenses.scan(docs).collect())
    assert [g[:3] for g in got] == sorted((i or 0, *places(t)) for i, t, _ in TEXTS)
    assert all(0 <= s <= 1 and (s > 0.9 or not base) for _, _, base, s in got)
    assert licenses.scan(docs.limit(0)).count() == 0
    for r in licenses.scan(docs).collect():
        text = {t for i, t, _ in TEXTS if i == r["doc_id"]}.pop() or ""
        for x in r["detections"]:
            assert words(text[x["start"] : x["end"]]) == words(text)[x["first"] : x["after"]]


def spell(tree, rng):
    """A random text that a parsed pattern matches."""
    out = ""
    for op, x in tree:
        op = str(op)
        if op == "LITERAL":
            out += chr(x)
        elif op == "IN":
            kind, y = x[rng.integers(len(x))]
            out += chr(y if str(kind) == "LITERAL" else rng.integers(y[0], y[1] + 1))
        elif op == "MAX_REPEAT":
            out += "".join(spell(x[2], rng) for _ in range(rng.integers(x[0], min(x[1], 3) + 1)))
        elif op == "BRANCH":
            out += spell(x[1][rng.integers(len(x[1]))], rng)
        elif op == "SUBPATTERN":
            out += spell(x[3], rng)
        elif op == "ANY":
            out += "x"
        else:
            assert op.startswith("ASSERT"), op
    return out


def test_one_match_of_every_rule_is_found_through_its_keyword():
    rng, lost = np.random.default_rng(0), {}
    for i, rule in enumerate(licenses.RULES):
        tree = re._parser.parse(rule.pattern.pattern.decode())
        for _ in range(25):
            joined = " ".join(spell(tree, rng).split()).encode()
            if not (rule.pattern.search(joined) and any(k == i for *_, k in licenses.candidates(joined.split(), joined))):
                lost[rule.kind, rule.label] = joined
    assert not lost


def test_resolution_keeps_what_nothing_better_contains():
    rng = np.random.default_rng(3)
    kind = lambda i: licenses.PRIORITY.index(licenses.RULES[i].kind)
    for _ in range(300):
        found = sorted({(int(a), int(a + n), int(i)) for a, n, i in zip(rng.integers(0, 30, 25), rng.integers(1, 12, 25), rng.integers(0, len(licenses.RULES), 25))})
        rank = lambda x: (kind(x[2]), x[0] - x[1], licenses.RULES[x[2]].label)
        expected = {x for x in found if kind(x[2]) == 0 or not any(y != x and y[0] <= x[0] and y[1] >= x[1] and kind(y[2]) <= kind(x[2]) and rank(y) < rank(x) for y in found)}
        # two rules of one label, priority and place are one detection
        same = lambda xs: sorted({(a, b, licenses.RULES[i].kind, licenses.RULES[i].label) for a, b, i in xs})
        assert same(licenses.resolve(found)) == same(expected)


def test_labels_of_own_rules(spark, docs):
    label = {r["doc_id"]: {x["label"] for x in r["detections"]} for r in licenses.scan(docs).collect()}
    assert label[3] == {"cc-by-nc-nd", "cc-by-nc", "cc-by"} and label[11] == {"gpl-2"} and label[8] == {"mit", "gpl"} and label[7] == set()
    n, found = licenses.scan_text(b"gpl " * 200_000)
    assert n == len(found) == 200_000


# ---- resampling -----------------------------------------------------------------------------------


def brute_weights(runs, buckets):
    def features(t):
        w = words(t)
        return [zlib.crc32(" ".join(w[i : i + r]).encode()) % buckets for r in range(1, runs + 1) for i in range(len(w) - r + 1)]

    s, t = (Counter(b for row in rows for b in features(row[1])) for rows in (TEXTS, BENCHMARK))
    total_s, total_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (total_s + buckets) / ((s[b] + 1) * (total_t + buckets))))
    out = []
    for i, x, _ in TEXTS:
        f = features(x)
        weight = sum(map(gain, f)) // len(f) if f else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, len(words(x)), len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    return out


@pytest.mark.parametrize("runs, buckets, least, percent", [(1, 10_000, 20, 10), (1, 10_000, 3, 50), (3, 1 << 17, 0, 100)])
def test_resampling(spark, docs, runs, buckets, least, percent):
    target = spark.createDataFrame(BENCHMARK, "item_id long, text string")
    got = resampling.resample(docs, target, runs=runs, buckets=buckets, least_words=least, percent=percent).collect()
    expected = brute_weights(runs, buckets)
    key = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted((tuple(r)[:5] for r in got), key=key) == sorted(expected, key=key)
    able = sorted((r for r in expected if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    drawn = sorted((r for r in got if r["rank"] is not None), key=lambda r: r["rank"])
    assert [tuple(r)[:5] for r in drawn] == able[: percent * len(able) // 100] and [r["rank"] for r in drawn] == list(range(1, len(drawn) + 1))


def test_resampling_of_empty_tables(spark, docs):
    target = spark.createDataFrame(BENCHMARK, "item_id long, text string")
    assert resampling.resample(docs.limit(0), target).count() == 0
    assert resampling.resample(docs, target.limit(0)).count() == len(TEXTS)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(["a", "bb", "naïve", "日本", "x" * 70, "Aa", "a", "bb"]), max_size=40), st.integers(1, 4), st.integers(0, 5))
def test_composed_crcs_equal_those_of_the_bytes(w, runs, limit):
    texts = [" ".join(w), "", "a-bb", " ".join(reversed(w))] * 2
    own = resampling.Dictionary(limit)
    for _ in range(3):  # an empty dictionary first, then one that knows some words
        bucket, at, n = resampling.features([t.encode() for t in texts], runs, 1 << 30, own)
        for k, t in enumerate(texts):
            x = words(t)
            runs_of = [zlib.crc32(" ".join(x[i : i + r]).encode()) % (1 << 30) for r in range(1, runs + 1) for i in range(len(x) - r + 1)]
            assert bucket[at[k] : at[k + 1]].tolist() == runs_of and n[k] == len(x)


def test_slices_and_the_dictionary_change_nothing(monkeypatch):
    texts = [t.encode() for _, t, _ in TEXTS if t]
    whole = resampling.features(texts, 2, 10_000, resampling.Dictionary())
    for size, limit in ((1, 10), (50, 100_000)):
        monkeypatch.setattr(resampling, "SLICE", size)
        short = [t[:3000] for t in texts]
        again = resampling.features(short, 2, 10_000, resampling.Dictionary(limit))
        monkeypatch.setattr(resampling, "SLICE", 1 << 20)
        assert all(np.array_equal(a, b) for a, b in zip(again, resampling.features(short, 2, 10_000, resampling.Dictionary(0))))
    assert len(whole[2]) == len(texts)


# ---- filter audit ---------------------------------------------------------------------------------

LABELS = [(1, 1, 0), (1, 0, 1), (2, 1, None), (9, 1, 1), (10, None, 1), (None, 1, 1), (99, 1, 1), (8, 1, 0)]


def brute_audit():
    good, bad = {i for i, q, _ in LABELS if q == 1 and i is not None}, {i for i, _, t in LABELS if t == 1 and i is not None}
    fails = []
    for i, t, part in TEXTS:
        t = t or ""
        w = [x for x in re.split("[ \t-\r]+", t) if x]
        twin = any((u or "") == t and j is not None and (i is None or j < i) for j, u, _ in TEXTS)
        tests = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * sum("A" <= c <= "Z" for c in t) > 3 * len(t), "D": any(c in "#$%&*|" for c in t), "E": twin}
        fails.append((part or "", {k for k, v in tests.items() if v}, i in good, i in bad))
    rows, removed_in_all = [], Counter()
    for part in {f[0] for f in fails}:
        own = [f[1:] for f in fails if f[0] == part]
        for order in permutations("ABCDE"):
            for k, x in enumerate(order):
                out = [f for f in own if x in f[0] and not f[0] & set(order[:k])]
                removed_in_all[part, x] += len(out)
                failing = sum(x in f[0] for f in own)
                rows.append((part, "".join(order), k + 1, sum(not f[0] & set(order[: k + 1]) for f in own), len(out), failing - len(out), sum(f[0] == {x} for f in own), sum(f[1] for f in out), sum(f[2] for f in out)))
    return sorted((*r, removed_in_all[r[0], r[1][r[2] - 1]]) for r in rows)


@pytest.mark.parametrize("bound", [2_000_000, 0])
def test_filter_audit(spark, docs, monkeypatch, bound):
    monkeypatch.setattr(filter_audit, "BROADCAST_ROWS", bound)
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    got = filter_audit.audit(filter_audit.failures(docs, labels), "ABCDE")
    assert sorted(map(tuple, got.collect())) == brute_audit()
    assert filter_audit.audit(filter_audit.failures(docs.limit(0), labels), "ABCDE").count() == 0
    assert filter_audit.failures(docs, labels.limit(0)).agg({"good": "sum", "toxic": "sum", "n": "sum"}).first().asDict() == {"sum(good)": 0, "sum(toxic)": 0, "sum(n)": len(TEXTS)}


@pytest.mark.parametrize("k", [1, 2, 3, 5])
def test_paths_through_an_edge(k):
    through = Counter()
    for order in permutations(range(k)):
        state = 0
        for i in order:
            through[state, 1 << i] += 1
            state |= 1 << i
    assert {(s, b): w for s, b, w in filter_audit.edges(k)} == through


def test_audit_of_other_filters_and_limits(spark):
    cells = spark.createDataFrame([("p", 0, 5, 1, 0), ("p", 3, 2, 1, 1), ("p", 3, 1, 0, 0), ("p", 1, 4, 0, 1)], "part string, mask int, n long, good long, toxic long")
    got = {(r["filter_order"], r["step"]): (r["kept"], r["removed"], r["redundant"], r["shapley"]) for r in filter_audit.audit(cells, ["x", "y"]).collect()}
    assert got == {("xy", 1): (5, 7, 0, 11), ("xy", 2): (5, 0, 3, 3), ("yx", 1): (9, 3, 0, 3), ("yx", 2): (5, 4, 3, 11)}
    with pytest.raises(ValueError):
        filter_audit.audit(cells, "abcdefghi")

"""Spelling variants, the prefix trie and the quality classifier against brute force."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from test_operators import edge_docs, edge_labels

from tillroll.llm import prefix_trie, quality_model, spelling
from tillroll.llm.common import table

# --- spelling variants


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_variants(rows, min_count, every):
    n = collections.Counter()
    for doc_id, text in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(c.lower() if "A" <= c <= "Z" else c for c in w)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{w}".encode())
            if h % every == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            n[w] += 1
    n = {w: k for w, k in n.items() if len(w) >= 6 and k >= min_count}
    near = {w: [v for v in n if one_edit(v, w)] for w in n}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 5 * n[w] else None

    def root(w):
        return root(form[w]) if form[w] else w
    return sorted((w, form[w] or "", root(w), n[w], len(near[w]), n[form[w]] if form[w] else -1) for w in n)


def found_variants(df, **kw):
    return sorted((r.word, r.form or "", r.root, r.n, r.n_near, -1 if r.form_n is None else r.form_n)
                  for r in spelling.variants(df, **kw).collect())


@pytest.mark.parametrize("blocks", [{}, {"block_words": 2, "block_chars": 512}])
def test_variants_against_brute_force(spark, blocks):
    rnd = random.Random(7)
    stems = ["".join(rnd.choice("abçÉé") for _ in range(rnd.randint(5, 9))) for _ in range(40)]
    rows = []
    for i in range(300):
        words = []
        for w in rnd.choices(stems, weights=[1 / (k + 1) ** 2 for k in range(40)], k=30):
            at = rnd.randrange(len(w))
            words.append(rnd.choice([w, w, w.upper(), w[:at] + w[at + 1:], w[:at] + "z" + w[at:]]))
        rows.append((i if i else None, rnd.choice([" ", "-", "1 "]).join(words)))
    rows += [(5, None), (6, ""), (7, "ÿ" * 5000 + " " + "ÿ" * 5001), rows[3], rows[3]]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, n int, word string")
    for every in (199, 3):
        want = brute_variants(rows, 2, every)
        assert want and any(r[1] for r in want)
        assert found_variants(df, min_count=2, every=every, **blocks) == want


def test_near_pairs_of_long_and_equal_words():
    a = spelling.letters_of("ab" * 2000 + "ba" * 2000, 4000)
    b = spelling.letters_of("ab" * 2000 + "a" + "ab" * 2000 + "b", 4001)
    i, j = spelling.near_pairs(a, b, False)
    assert sorted(zip(i.tolist(), j.tolist())) == [(0, 0), (0, 1), (1, 0)]
    i, j = spelling.near_pairs(a, a, True)  # equal letter counts, thousands of edits apart
    assert len(i) == 0


def test_block_pairs_cover_every_edit():
    rnd = random.Random(3)
    for n_groups in (1, 2, 5):
        groups = spelling.letter_groups(n_groups)
        assert sorted("".join(groups)) == sorted(spelling.BY_FREQUENCY + spelling.BEYOND)
        for _ in range(200):
            w = "".join(rnd.choices(spelling.BY_FREQUENCY + spelling.BEYOND, k=8))
            v = w[:3] + rnd.choice(spelling.BY_FREQUENCY) + w[rnd.choice([3, 4]):]
            d = [sum(c in g for c in v) - sum(c in g for c in w) for g in groups]
            assert sum(map(abs, d)) <= 2 and max(map(abs, d)) <= 1


def test_variants_of_edge_rows(spark):
    assert spelling.variants(edge_docs(spark, [])).collect() == []
    got = {r.word: r for r in spelling.variants(edge_docs(spark)).collect()}
    assert set(got) == {"dolor"} & set(got) or all(r.n >= 5 for r in got.values())


# --- prefix trie

def brute_trie(rows):
    own = collections.defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, r or "", x or ""))
    own = {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in own.items()}
    full = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        full[c] = tuple(own.get(c - c % 5, [])[:h] + own[c][h:])
    members = collections.defaultdict(list)
    for c in sorted(full):
        for d in range(len(full[c]) + 1):
            members[full[c][:d]].append(c)
    kids = collections.Counter(k[:-1] for k in members if k)
    leaves, saved = collections.Counter(), collections.Counter()
    for k, m in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += kids[k] == 0
            saved[k[:d]] += (len(m) - 1) * len(k[-1][1].encode()) if k else 0
    return sorted(
        (m[0], len(k), members[k[:-1]][0] if k else -1, len(m), kids[k], leaves[k], saved[k],
         hashlib.sha256(",".join(str(c) for c in m if full[c] == k).encode()).hexdigest())
        for k, m in members.items())


def found_trie(df, **kw):
    return sorted(tuple(-1 if v is None else v for v in r) for r in prefix_trie.prefix_trie(df, **kw).collect())


CONVERSATIONS = "conv_id long, turn long, role string, text string, hi long, depth int, conv long"


def shared_conversations():
    rnd = random.Random(1)
    rows = [(c, t, "u" if t % 2 else "a", rnd.choice("aab") if t > 3 else "é" * t)
            for c in range(150) for t in range(rnd.randint(0, 14))]
    rows += rnd.sample(rows, 30)
    return rows + [(None, 1, "a", "b"), (7, None, None, None), (8, None, "z", "zz"), (8, None, "z", "zz"),
                   (1004, 0, "a", "b"), (2001, 5, "a", "long " * 20000)]


@pytest.mark.parametrize("limit,band,ids", [(8192, 1024, 4096), (60, 4, 16), (1, 2, 4096)])
def test_trie_against_brute_force(spark, monkeypatch, limit, band, ids):
    monkeypatch.setattr(prefix_trie, "BAND", band)
    monkeypatch.setattr(prefix_trie, "ID_RANGE", ids)
    rows = shared_conversations()
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], CONVERSATIONS)
    assert found_trie(df, limit=limit) == brute_trie(rows)


def test_trie_of_few_rows(spark):
    for rows in ([], [(None, 1, "a", "b")], [(7, 1, "a", "b")], [(0, None, None, None)] * 3):
        df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], CONVERSATIONS)
        assert found_trie(df) == (brute_trie(rows) if rows and rows[0][0] is not None else [])


def test_node_table():
    rng = np.random.default_rng(0)
    hi, lo = (rng.integers(-2 ** 63, 2 ** 63 - 1, 5000) for _ in range(2))
    node_table = prefix_trie.NodeTable(hi[:4000], lo[:4000])
    assert sorted(node_table.slots) == list(range(4000))
    assert (node_table.find(hi[:4000], lo[:4000]) == node_table.slots).all()
    assert (node_table.find(hi[4000:], lo[4000:]) == -1).all()
    with pytest.raises(ValueError):
        prefix_trie.NodeTable(hi[[1, 2, 1]], lo[[1, 2, 1]])


# --- quality classifier

def test_features_by_hand():
    f = quality_model.Features()
    assert len(f("")) == 0 and len(f(" \n ")) == 0
    # a, a a | shapes: a, =, a =
    assert len(f("word word")) == 5
    assert set(f("word word word")) >= set(f("word word"))
    assert (f("Say NO!! 12") == f("Say NO!! 12")).all() and not np.array_equal(f("Say NO!!"), f("Say no!!"))


def test_ratios_against_counting(spark):
    texts = [(1, "good word"), (1, "good good"), (0, "bad!! word"), (0, "bad!!"), (0, "")]
    rows = spark.createDataFrame([(i, y, t, i) for i, (y, t) in enumerate(texts)],
                                 "doc_id long, label int, text string, h long")
    got = quality_model.log_count_ratios(quality_model.bags(rows))
    f = quality_model.Features()
    p, q = (collections.Counter(b for y, t in texts if y == label for b in f(t).tolist()) for label in (1, 0))
    seen = set(p) | set(q)
    sizes = [sum(c[b] + 1 for b in seen) for c in (p, q)]
    want = {b: np.log((p[b] + 1) / sizes[0]) - np.log((q[b] + 1) / sizes[1]) for b in seen}
    assert set(np.flatnonzero(got)) <= seen
    assert all(abs(got[b] - v) < 1e-9 for b, v in want.items())


def test_descent_reaches_the_optimum():
    rng = np.random.default_rng(1)
    ratios = rng.normal(size=64)
    rows = [np.unique(rng.integers(0, 64, 12)) for _ in range(120)]
    y = np.where([ratios[r].sum() + rng.normal() > 0.5 for r in rows], 1, -1)
    weight, bias = quality_model.dual_descent(rows, y, ratios, epochs=2000)
    x = np.zeros((120, 65))
    for i, r in enumerate(rows):
        x[i, r] = quality_model.scaled(r, ratios)
    x[:, 64] = 1
    cost = np.array([120 / (2 * (y == s).sum()) for s in y])

    def primal(w):
        return w @ w / 2 + cost @ np.maximum(0, 1 - y * (x @ w))
    best = np.append(weight, bias)
    # plain subgradient descent from there and from nothing finds no better point
    for start in (best, np.zeros(65)):
        w, least = start.copy(), primal(start)
        for t in range(1, 4000):
            w = w - (w - (cost * y * (y * (x @ w) < 1)) @ x) / (t + 10)
            least = min(least, primal(w))
        assert primal(best) <= least + 1e-2 * abs(least)


def test_held_out_accuracy(spark):
    docs, labels = (table(spark, "/root/testdata/sf0.01", n) for n in ("documents", "labels"))
    got = quality_model.quality(docs, labels).join(labels, "doc_id").where("held_out and quality is not null")
    rows = got.collect()
    assert len(rows) > 50
    assert np.mean([r.predicted == r.quality for r in rows]) >= 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)


def test_classifier_of_edge_rows(spark):
    labels = spark.createDataFrame([(1, 1, None), (2, 0, 1), (2, 0, 0), (None, 1, 1), (99, 1, 1), (4, 1, 0), (6, 0, 0)],
                                   "doc_id long, quality int, toxic int")
    docs = edge_docs(spark)
    for marked in (labels, labels.where("quality = 1"), labels.limit(0), edge_labels(spark)):
        got = quality_model.quality(docs, marked).collect()
        assert sorted(str(r.doc_id) for r in got) == sorted(str(r.doc_id) for r in docs.collect())
        assert all(0 <= r.score <= 1 for r in got)
        assert quality_model.quality(edge_docs(spark, []), marked).collect() == []


def test_training_rows_do_not_depend_on_partitioning(spark):
    rows = [(i, f"text {j}", None, "a") for i in range(60) for j in range(3)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)], "doc_id long, quality int, toxic int")
    docs = edge_docs(spark, rows)
    want = None
    for n in (1, 7):
        got = {r.doc_id: (r.label, r.text) for r in quality_model.training_rows(
            docs.repartition(n), labels, max_train=20).collect()}
        assert len(got) == 20
        want = want or got
        assert got == want
    few = quality_model.training_rows(docs, labels, max_train=20, max_chars=30).collect()
    assert 0 < len(few) <= 5 and sum(len(r.text) for r in few) <= 30

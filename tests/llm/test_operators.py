"""The training-data operators against brute force, the tokenizers' libraries and held-out rows."""

import collections
import hashlib
import heapq
import math
import random
import time
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tillroll.llm import (bpe, embedding_dedup, html_text, language, lm_scoring, mixing, quality,
                          simhash, token_counts, toxicity)
from tillroll.llm.common import table
from tillroll.llm.components import connected_components

DOCS = ("doc_id long, text string, lang string, source string, n_chars long, row string, host string, "
        "score double, fp long, mix_slot long, `__key` string, n int")


def edge_docs(spark, rows=None):
    long_text = "Lorem ipsum dolor. " * 8000 + "\n" + "x" * 50000
    texts = [(None, None, None, None), (1, "", "en", "a"), (1, "", "en", "a"), (2, "One two", None, "b"),
             (2, "One two", None, "b"), (3, long_text, "en", None), (4, "\x00\x85  é<|endoftext|>", "de", "a"),
             (None, "one two", "fr", "c"), (5, "ONE TWO", "en", "a")]
    return spark.createDataFrame(
        [(*t, None, "r", "h", 0.5, 7, 3, "k", 1) for t in (texts if rows is None else rows)], DOCS)


def edge_labels(spark):
    return spark.createDataFrame([(1, 1, None), (2, 0, 1), (2, 0, 0), (None, 1, 1), (99, 1, 1)],
                                 "doc_id long, quality int, toxic int")


OPERATORS = {
    "token_counts": lambda s, d: token_counts.token_counts(d),
    "lm": lambda s, d: lm_scoring.lm_scores(d),
    "bpe": lambda s, d: bpe.digests(bpe.encode(d)),
    "toxicity": lambda s, d: toxicity.toxicity(d, edge_labels(s)),
    "language": lambda s, d: language.languages(d),
    "quality": lambda s, d: quality.quality_rules(d),
    "mixing": lambda s, d: mixing.mix(d),
    "simhash": lambda s, d: simhash.near_duplicates(d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_edge_rows_and_empty_table(spark, name):
    rows = OPERATORS[name](spark, edge_docs(spark)).collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(
        str(r.doc_id) for r in edge_docs(spark).collect())
    assert OPERATORS[name](spark, edge_docs(spark, [])).collect() == []


def test_stages_keep_all_columns(spark):
    docs = edge_docs(spark)
    for stage in (quality.keep_good, lambda d: toxicity.keep_clean(d, edge_labels(spark)),
                  simhash.keep_one, mixing.mixture):
        kept = stage(docs)
        assert kept.columns == docs.columns
        assert kept.exceptAll(docs).count() == 0
        assert stage(edge_docs(spark, [])).collect() == []
    assert mixing.mixture(docs).count() == docs.count()
    # 'One two' twice, its null id and the capitals are one group; both empty ids and the null text another
    assert sorted(r.doc_id for r in simhash.keep_one(docs).collect()) == [1, 2, 3, 4]


def shared_line_docs(spark):
    """30 documents of host h that are mostly one shared line with a small hash, 100 plain ones, and
    40 copies of a text."""
    shared = min((f"shared line {c} of this site " + "word " * 40 for c in "abcdefghijklmnopqrstuvwxyz"),
                 key=lambda x: hashlib.md5(" ".join(x.split()).encode()).hexdigest())
    own = lambda i, n: " ".join(f"{a}{b}{i % 7 * 'x'}{i // 7 * 'y'}" for a in "abcd" for b in "efghijklmnopqrs")[:n]
    texts = [f"{shared}\n\n{own(i, 40)}" for i in range(30)] + [own(i, 2000) for i in range(30, 130)]
    texts += ["copied " + own(200, 2000)] * 40
    return shared, spark.createDataFrame(
        [(i, t, "h", len(t)) for i, t in enumerate(texts)], "doc_id long, text string, source string, n_chars long")


def test_quality_counts_documents_not_smallest_lines(spark):
    shared, docs = shared_line_docs(spark)
    line = int(hashlib.md5(" ".join(shared.split()).encode()).hexdigest()[:15], 16)
    assert [tuple(r) for r in quality.boilerplate_lines(quality.host_lines(docs)).collect()] == [("h", line, 30)]
    kept = {r.doc_id: r.kept for r in quality.quality_rules(docs, min_words=5, max_repeat_pct=100).collect()}
    assert kept == {i: i >= 30 for i in range(170)}


def test_quality_removes_common_lines(spark):
    shared, docs = shared_line_docs(spark)
    before = {r.doc_id: r.text for r in docs.collect()}
    want = {i: "\n".join(x for x in t.split("\n") if x != shared) for i, t in before.items()}
    assert {r.doc_id: r.clean_text for r in quality.cleaned(docs).collect()} == want
    rows = quality.keep_good(docs, min_words=5, max_repeat_pct=100, min_left=0.0).collect()
    assert {r.doc_id: (r.text, r.n_chars) for r in rows} == {i: (t, len(t)) for i, t in want.items()}
    left = quality.keep_good(docs, min_words=5, max_repeat_pct=100).collect()
    assert sorted(r.doc_id for r in left) == list(range(30, 170))


def random_texts():
    rnd = random.Random(3)
    ranges = ((0x20, 0x7F), (0, 0x20), (0x80, 0x250), (0x370, 0x400), (0x400, 0x460), (0x600, 0x650),
              (0x2000, 0x2070), (0x4E00, 0x4E40), (0x1F600, 0x1F620), (0xAC00, 0xAC40), (0x300, 0x330))
    pool = [chr(c) for r in ranges for c in range(*r)]
    return ["".join(rnd.choices(pool, k=rnd.randint(0, 60))) for _ in range(600)] + [
        "".join(rnd.choices("aAbe' \n'st#.09", k=150)) for _ in range(300)] + [
        "<|endoftext|>a<|endoftext|>", "x<|startoftext|> y", "a" * 3000, " " * 300, "İ ΑΣ J̌", ""]


def test_tokenizers_agree_with_their_library():
    from tokenizers import Tokenizer
    path, word_path = bpe.vocabulary_path(), bpe.vocabulary_path(token_counts.VOCABULARY)
    library, words = Tokenizer.from_file(path), Tokenizer.from_file(word_path)
    coder, counts = bpe.tokenizer(path), token_counts.Counts(word_path)
    for text in random_texts():
        ids = library.encode(text, add_special_tokens=False).ids
        assert coder.encode(text).tolist() == ids
        assert coder.decode(np.array(ids, np.int32)) == library.decode(ids, skip_special_tokens=False)
        assert counts.count(text) == len(words.encode(text, add_special_tokens=False).ids)


def test_token_tables_over_documents(spark, sf_small):
    from tokenizers import Tokenizer
    docs = table(spark, sf_small, "documents")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    library = Tokenizer.from_file(bpe.vocabulary_path())
    for r in bpe.digests(bpe.encode(docs)).collect():
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
    words = Tokenizer.from_file(bpe.vocabulary_path(token_counts.VOCABULARY))
    for r in token_counts.token_counts(docs).collect():
        n = len(words.encode(texts[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 2048)


def test_lm_base_and_lattice(spark, sf_small):
    docs = table(spark, sf_small, "documents")
    words = {r.doc_id: (r.text or "").encode().lower().split() + [b""] for r in docs.collect()}
    c = collections.Counter(w for d, ws in words.items() if zlib.crc32(str(d).encode()) % 7 != 2 for w in ws)
    n, v = sum(c.values()), len(c)
    # a small frequent tier, so that most words take the joined way
    for r in lm_scoring.lm_scores(docs, frequent=50).collect():
        ws = words[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(ws), sum(c[w] > 0 for w in ws), n)
        assert r.base_score == pytest.approx(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), abs=1e-6)
        assert r.score < 0


def cuts_of(text, pieces, spelled):
    """All segmentations of a text into pieces (by number) or bytes."""
    if not text:
        yield []
        return
    for size in range(1, len(text) + 1):
        if text[:size] in pieces:
            for rest in cuts_of(text[size:], pieces, spelled):
                yield [pieces[text[:size]], *rest]
    for rest in cuts_of(text[1:], pieces, spelled):
        yield [*(spelled[b] for b in text[0].encode()), *rest]


def test_lattice_against_all_segmentations():
    rnd = random.Random(5)
    names = ["<unk>", "<s>", "▁", "a", "b", "ab", "▁a", "ba", "bab", "<0x61>", "<0x62>", "<0xC3>", "<0xA9>"]
    spelled = {int(n[3:5], 16): i for i, n in enumerate(names) if n.startswith("<0x")}
    spelled |= {b: 9 for b in "▁".encode()}
    pieces = {n: i for i, n in enumerate(names) if not n.startswith("<")}
    counts = np.array([rnd.random() * 9 for _ in names])
    lattice = lm_scoring.Lattice(names, spelled, counts, 4.0)
    shared = [i for i in range(len(names)) if i > 1]
    total = counts[shared].sum() + len(shared) + 5
    assert sum(math.exp(lattice.logp[i]) for i in shared) + math.exp(lattice.end) == pytest.approx(1)
    words = ["", "a", "b", "ab", "bab", "abab", "é", "aéb", "bababa", "bbbb", "éa", "aaaaa"]
    times = np.arange(1.0, len(words) + 1)
    want, expected = [], np.zeros(len(names))
    for w, t in zip(words, times):
        cuts = list(cuts_of("▁" + w, pieces, spelled))
        each = [math.prod((counts[i] + 1) / total for i in c) for c in cuts]
        want.append(math.log(sum(each)))
        for c, p in zip(cuts, each):
            for i in c:
                expected[i] += t * p / sum(each)
    assert lattice.marginals(words) == pytest.approx(want)
    assert [lattice.marginal(w) for w in words] == pytest.approx(want)
    got = np.zeros(len(names))
    for same in lm_scoring.by_length(words):
        got += lattice.expected([words[i] for i in same], times[same])
    assert got == pytest.approx(expected, abs=1e-6)
    long = "ab" * 400 + "é"
    assert lattice.marginals([long]) == pytest.approx([lattice.marginal(long)])
    assert lattice.forward([long], lattice.arcs([long]))[2][-1] == pytest.approx(lattice.marginal(long))


def test_lm_scores_against_brute_force(spark):
    """Every step again on a few documents: cuts, expectation maximisation, scores."""
    rnd = random.Random(9)
    rows = [(i, " ".join(rnd.choices(["The", "cat", "été", "sat", "x1", "日", "on"], k=rnd.randint(0, 6))),
             None, "a") for i in range(30)]
    docs = edge_docs(spark, rows)
    path = lm_scoring.vocabulary_path(lm_scoring.VOCABULARY)
    sp, names, spelled = lm_scoring.pieces_of(path)
    pieces = {n: i for i, n in enumerate(names) if not (n.startswith("<") and n.endswith(">") and len(n) > 2)}
    usable = set(pieces.values()) | set(spelled.values())
    train = [t for i, t, *_ in rows if zlib.crc32(str(i).encode()) % 7 != 2]
    times = collections.Counter(w.lower() for t in train for w in t.split())
    ends, counts = len(train), collections.Counter()
    for w, c in times.items():
        for i in sp.encode(w):
            counts[i] += c
    probability = None
    for _ in range(lm_scoring.ROUNDS + 1):
        if probability is not None:
            new = collections.Counter()
            for w, c in times.items():
                cuts = list(cuts_of("▁" + w, pieces, spelled))
                each = [math.prod(map(probability, cut)) for cut in cuts]
                for cut, p in zip(cuts, each):
                    for i in cut:
                        new[i] += c * p / sum(each)
            counts = new
        total = sum(counts.values()) + len(usable) + ends + 1
        probability = lambda i, counts=counts, total=total: (counts[i] + 1) / total
    marginal = {w: math.log10(sum(math.prod(map(probability, cut)) for cut in cuts_of("▁" + w, pieces, spelled)))
                for w in {w.lower() for _, t, *_ in rows for w in t.split()}}
    got = {r.doc_id: r.score for r in lm_scoring.lm_scores(docs).collect()}
    for i, t, *_ in rows:
        assert got[i] == pytest.approx(sum(marginal[w.lower()] for w in t.split()) + math.log10((ends + 1) / total),
                                       abs=1e-6)


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    found = toxicity.toxicity(table(spark, sf, "documents"), table(spark, sf, "labels"))
    labels = table(spark, sf, "labels").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    rows = found.where("held_out").join(labels, "doc_id").collect()
    assert np.mean([r.predicted == r.toxic for r in rows]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert sum(len(r.offending) > 0 for r in rows if r.predicted) > 0


def test_language_held_out_and_spans(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = language.languages(docs).where("held_out").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert np.mean([r.lang_pred == r.lang for r in rows]) > 0.97
    model = language.train(docs)
    en, de = (next(r.text for r in docs.where(f"lang = '{x}' AND length(text) > 2000").limit(1).collect())[:1500]
              for x in ("en", "de"))
    path = model.label([en + "\n" + de, "1 2"])
    names = [model.languages[i] for i in path[0]]
    assert set(names[:20]) == {"en"} and set(names[-20:]) == {"de"} and not len(path[1])
    # Viterbi against dynamic programming word by word
    rng = np.random.default_rng(0)
    size = np.array([5, 0, 9, 1])
    scores = rng.normal(size=(15, 3)).astype(np.float32) * 8
    paths = language.viterbi(scores, size)
    for k, (path, at) in enumerate(zip(paths, np.cumsum(size) - size)):
        def total(p):
            return sum(scores[at + i, s] for i, s in enumerate(p)) - language.SWITCH * np.count_nonzero(np.diff(p))
        best = [(0.0, ())]
        for i in range(size[k]):
            best = [max(((total((*p, s)), (*p, s)) for _, p in best), key=lambda x: x[0]) for s in range(3)] \
                if i == 0 else [max(((total((*p, s)), (*p, s)) for _, p in best), key=lambda x: x[0])
                                for s in range(3)]
        assert total(path) == pytest.approx(max(b for b, _ in best), abs=1e-3)


def test_mixing_deviates_by_less_than_a_block(spark):
    docs = spark.range(6000).selectExpr(
        "id AS doc_id", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('s', id % 7) END AS source")
    asked = {"hot": 0.5, "s1": 0.2, "s2": 0.2}
    weights = spark.createDataFrame(list(asked.items()), "source string, weight double")
    rows = mixing.mix(docs, weights, block_docs=4).collect()
    asked |= {s: 0.2 for s in {r.source for r in rows} - set(asked)}  # the smallest that is asked for
    assert len({(r.mix_slot, r.mix_place) for r in rows}) == 6000
    check_deviation([(r.source, r.mix_block, r.mix_slot) for r in rows], asked)


def check_deviation(blocks, asked):
    """Every block lies between its release and its deadline, so no prefix of slots deviates by a block."""
    total = sum(asked.values())
    places = set(blocks)
    assert len({slot for *_, slot in places}) == len(places)
    for source, block, slot in places:
        pace = total / asked[source]
        assert block * pace < slot + 1 + 1e-6 and slot < (block + 1) * pace + 1e-6


def sequential(jobs):
    waiting, slot, at, out = [], 0, 0, {}
    jobs = sorted(jobs, key=lambda j: j[2])
    while at < len(jobs) or waiting:
        slot = slot if waiting else max(slot, jobs[at][2])
        while at < len(jobs) and jobs[at][2] <= slot:
            name, block, _, d = jobs[at]
            heapq.heappush(waiting, (d, name, block))
            at += 1
        d, name, block = heapq.heappop(waiting)
        assert slot < d
        out[name, block] = slot
        slot += 1
    return out


@pytest.mark.parametrize("case", ["few", "many", "equal", "wide"])
def test_schedule_is_the_sequential_one(spark, case):
    rnd = random.Random(2)
    sizes, whole = {
        "few": ({"a": 4000, "b": 1500, "c": 33, "d": 1}, lambda n: int(1e6 * n ** 0.5)),
        "many": ({f"s{i:04}": rnd.randint(1, 60) for i in range(3001)} | {"hot": 30000}, lambda n: n),
        "equal": ({f"s{i:04}": 100 for i in range(300)}, lambda n: 7),
        "wide": ({"a": 1000, "b": 2000, "c": 160}, lambda n: {1000: 1 << 40, 2000: 3000, 160: 1 << 39}[n]),
    }[case]
    total = sum(map(whole, sizes.values()))
    table_ = spark.createDataFrame([(s, n, whole(n), total) for s, n in sizes.items()],
                                   "name string, n long, a long, total long")
    jobs = mixing.jobs_of(table_)
    plain = [tuple(r) for r in jobs.select("name", "block", "r", "d").collect()]
    assert sorted(plain) == sorted((s, i, i * total // whole(n), -(-(i + 1) * total // whole(n)))
                                   for s, n in sizes.items() for i in range(-(-n // 16)))
    got = {(r["name"], r.block): r.slot for r in mixing.schedule(jobs).collect()}
    assert got == sequential(plain)


def test_mixing_keeps_small_asked_weights(spark):
    docs = spark.range(3001 * 32).selectExpr("id AS doc_id", "concat('s', id % 3001) AS source")
    asked = {f"s{i}": 0.95 / 3000 for i in range(3001)} | {"s7": 0.05}
    weights = spark.createDataFrame(list(asked.items()), "source string, weight double")
    rows = mixing.mix(docs, weights).select("source", "mix_block", "mix_slot").distinct().collect()
    check_deviation([tuple(r) for r in rows], asked)
    first = [r.source for r in sorted(rows, key=lambda r: r.mix_slot)][:40]
    assert first.count("s7") == 2  # one slot in twenty, as long as it has blocks


def test_mixing_of_null_ids_and_weights(spark):
    rows = [(None, f"t{i}", "en", "hot", 1) for i in range(400)] + [(i, None, "en", None, 1) for i in range(40)]
    docs = edge_docs(spark, [r[:4] for r in rows])
    for weights in (None, [("hot", 0.0), (None, -1.0)], [("hot", None), ("x", 2.0)], []):
        given = weights if weights is None else spark.createDataFrame(weights, "source string, weight double")
        got = mixing.mix(docs, given).collect()
        assert len({(r.mix_slot, r.mix_place) for r in got}) == len(got) == 440
    starts = mixing.hash60(F.concat_ws(":", F.lit(""), F.col("text")))
    assert docs.select(F.shiftright(starts, 48)).distinct().count() > 100  # null ids of a source are spread


def test_simhash_against_all_pairs(spark, sf_small):
    def brute(text, width=4):
        words = (text or "").encode().lower().split()
        grams = [b" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))] if words else []
        hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    docs = table(spark, sf_small, "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    fps = np.array([brute(t) for _, t in rows], np.uint64)
    near = np.bitwise_count(fps[:, None] ^ fps) <= 4
    name = np.array([d for d, _ in rows])
    while not ((new := np.where(near, name, name.max()).min(axis=1)) == name).all():
        name = new
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    assert got == {d: (f"{int(f):016x}", c) for (d, _), f, c in zip(rows, fps, name)}


def test_simhash_keys_and_long_runs(spark, monkeypatch):
    rng = np.random.default_rng(1)
    x = rng.integers(0, 1 << 63, 2000, dtype=np.uint64)
    y = x.copy()
    for _ in range(4):
        y ^= np.uint64(1) << rng.integers(0, 64, len(y)).astype(np.uint64)
    sets = [[set() for _ in x] for _ in range(2)]
    for side, fps in zip(sets, (x, y)):
        for keys, rows in simhash.fuzzy_keys(fps):
            for k, r in zip(keys.tolist(), rows.tolist()):
                side[r].add(k)
    assert all(a & b for a, b in zip(*sets))
    # a crowd around one fingerprint: runs longer than RUN take the blocks
    crowd = np.unique(np.concatenate([x[:1] ^ (np.uint64(1) << np.arange(64, dtype=np.uint64)), x[:300]])).view(np.int64)
    fps = spark.createDataFrame([(int(f),) for f in crowd], "fp long")
    whole = {tuple(r) for r in connected_components(simhash.links(fps)).collect()}
    monkeypatch.setattr(simhash, "RUN", 8)
    monkeypatch.setattr(simhash, "BLOCK", 5)
    assert {tuple(r) for r in connected_components(simhash.links(fps)).collect()} == whole
    assert len({c for _, c in whole}) == 1 and len(whole) >= 64


def test_components(spark):
    edges = [(1, 2), (2, 3), (5, 4), (7, 7), (None, 1), (3, 9), (9, 1)] + [(i, i + 1) for i in range(20, 60)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.component for r in connected_components(df).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 9: 1, 4: 4, 5: 4, 7: 7} | {i: 20 for i in range(20, 61)}


def test_embeddings_against_all_pairs(spark):
    rng = np.random.default_rng(0)
    unit = lambda v: v / np.linalg.norm(v)
    base = [unit(v) for v in rng.normal(size=(150, 16))]
    rows = [(v * 2, i % 2) for i, v in enumerate(base)] + [(base[0], 0)] * 30
    rows += [(unit(base[i % 9] + rng.normal(size=16) * 0.06), (i % 9) % 2) for i in range(150)]
    rows = [([float(x) for x in v], label) for v, label in rows]
    bad = [(None, 1), ([0.0] * 16, 1), ([float("nan")] * 16, 1), (rows[3][0], None), ([None] * 16, 1), ([], 0)]
    ids = rng.permutation(len(rows) + len(bad)).tolist()
    vectors = spark.createDataFrame([(i, v, label, "x") for i, (v, label) in zip(ids, rows + bad)],
                                    "vec_id long, embedding array<float>, label int, cid string")
    got = {r.vec_id: r for r in embedding_dedup.near_duplicates(vectors).collect()}
    x = np.array([np.array(v, np.float32) for v, _ in rows], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([y for _, y in rows])
    near = (x @ x.T >= 0.93) & (label[:, None] == label)
    np.fill_diagonal(near, False)
    found = np.array([got[i].n_links for i in ids[:len(rows)]])
    assert (found <= near.sum(axis=1)).all() and found.sum() >= 0.9 * near.sum()
    for i in ids[len(rows):]:
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())
    assert embedding_dedup.near_duplicates(vectors.limit(0)).collect() == []


def test_embeddings_audit_of_every_index(spark, monkeypatch):
    dense, sparse = np.eye(64)[0], np.eye(64)[1:41]
    rows = [(i, 0, 64, dense.tolist()) for i in range(60)] + [
        (60 + 2 * i + j, 0, 64, v.tolist()) for i, v in enumerate(sparse) for j in range(2)]
    missed = spark.createDataFrame(rows, "cid long, label int, dim int, unit array<double>")
    totals = spark.createDataFrame([(i, 59 if i < 60 else 0) for i in range(140)], "cid long, partners long")
    assert embedding_dedup.audit(missed, totals) < 0.5  # 0.98 of the links, but no sparse pair

    rng = np.random.default_rng(2)
    base = rng.normal(size=(40, 16))
    x = np.concatenate([base, base + rng.normal(size=base.shape) * 0.1]).astype(np.float32)
    vectors = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)],
                                    "vec_id long, embedding array<float>, label int")
    audited = []
    monkeypatch.setattr(embedding_dedup, "audit", lambda *_: audited.append(1) or 0.0)
    monkeypatch.setattr(embedding_dedup, "BLOCK", 16)  # several pairs of blocks
    got = {r.vec_id: r.n_links for r in embedding_dedup.near_duplicates(vectors).collect()}
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    assert audited and [got[i] for i in range(80)] == ((u @ u.T >= 0.93).sum(axis=1) - 1).tolist()


def _cosine_links(x, label):
    u = np.asarray(x, np.float32).astype(float)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    near = (u @ u.T >= 0.93) & (label[:, None] == label)
    np.fill_diagonal(near, False)
    return near


def test_embeddings_search_goes_to_other_clusters(spark, monkeypatch):
    # an arc where a vector links with 11 on each side, cut by 12 centroids: many linked pairs
    # share no cluster and are found only by visits
    turn = np.linspace(0, np.pi, 96)
    x = np.stack([np.cos(turn), np.sin(turn), np.zeros(96)], axis=1)
    vectors = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)],
                                    "vec_id long, embedding array<float>, label int")
    monkeypatch.setattr(embedding_dedup, "SHARD", 8)
    recalls = []
    audit = embedding_dedup.audit
    monkeypatch.setattr(embedding_dedup, "audit", lambda *a: recalls.append(audit(*a)) or recalls[-1])
    got = {r.vec_id: r for r in embedding_dedup.near_duplicates(vectors).collect()}
    near = _cosine_links(x, np.zeros(96, int))
    assert recalls == [1.0]  # the first index, with two clusters a vector
    assert [got[i].n_links for i in range(96)] == near.sum(axis=1).tolist()
    assert {r.component_id for r in got.values()} == {0}
    # nobody visits: links are missing
    monkeypatch.setattr(embedding_dedup, "search_visitors",
                        lambda *_: spark.createDataFrame([], embedding_dedup.RESULT))
    classes = embedding_dedup.stored(embedding_dedup.classes_of(vectors), "arc")
    totals, _ = embedding_dedup.index_and_search(embedding_dedup.clustered(classes, 96, 12, 2))
    assert totals.agg({"links": "sum"}).first()[0] < 0.95 * near.sum()


def test_embeddings_levels_of_centroids(spark, monkeypatch):
    rng = np.random.default_rng(7)
    base = rng.normal(size=(200, 16))
    dense = base[0] + rng.normal(size=(150, 16)) * 0.15
    x = np.concatenate([base, base + rng.normal(size=base.shape) * 0.1, dense]).astype(np.float32)
    label = np.arange(len(x)) % 200 % 2
    label[400:] = 0
    vectors = spark.createDataFrame([(i, v.tolist(), int(y)) for i, (v, y) in enumerate(zip(x, label))],
                                    "vec_id long, embedding array<float>, label int")
    monkeypatch.setattr(embedding_dedup, "SHARD", 16)
    monkeypatch.setattr(embedding_dedup, "MAX_CENTROIDS", 5)  # 22 wanted: two levels
    monkeypatch.setattr(embedding_dedup, "BLOCK", 24)  # and clusters cut into blocks
    monkeypatch.setattr(embedding_dedup, "DEAL", 32)
    monkeypatch.setattr(embedding_dedup, "audit", lambda *_: 1.0)  # this index, whatever it found
    got = {r.vec_id: r for r in embedding_dedup.near_duplicates(vectors).collect()}
    near = _cosine_links(x, label)
    found = np.array([got[i].n_links for i in range(len(x))])
    assert (found <= near.sum(axis=1)).all() and found.sum() >= 0.95 * near.sum()
    classes = embedding_dedup.classes_of(vectors).cache()  # one id a row
    rows = embedding_dedup.clustered(classes, len(x), 22, 2).collect()
    assert len(rows) == len(x) and all(1 <= len(r.clusters) <= 2 for r in rows)
    assert len({c for r in rows for c in r.clusters}) > 5


def test_frequent_tier_is_bounded(spark):
    words = spark.createDataFrame([(f"w{i}", i % 40) for i in range(1000)] + [("x" * 99, 999)], "word string, c long")
    for most in (1, 10, 100, 5000):
        found = lm_scoring.frequent_words(words, most).collect()
        assert len(found) <= most and (most < 1000 or len(found) == 1000)
        assert not found or min(r.c for r in found) >= 39 - most // 10


# --- toxicity, language, encoding: parts against brute force

def toxic_docs(spark, n=120):
    rnd = random.Random(2)
    words = ["sun", "moon", "tree", "river", "stone"]
    rows = []
    for i in range(n):
        text = [" ".join(rnd.choices(words, k=5)) for _ in range(4)]
        if i % 3 == 0:
            text[i % 4] += " vile scum"
        rows.append((i, ". ".join(text) + ".", "en", "a"))
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(n)], "doc_id long, quality int, toxic int")
    return rows, labels


def test_noisy_or_against_brute_force(spark):
    rows, labels = toxic_docs(spark)
    model = toxicity.train(edge_docs(spark, rows), labels)
    for _, text, *_ in rows[:40]:
        clean = 1.0
        for sentence in text.split(". "):
            z = model.bias + sum(model.weights.get(f, 0.0) for w in set(sentence.strip(".").split())
                                 for f in toxicity.features_of(w))
            clean *= 1 - 1 / (1 + math.exp(-z))
        assert model.score(text) == pytest.approx(1 - clean)
    found = toxicity.toxicity(edge_docs(spark, rows), labels).collect()
    assert all(r.predicted == (r.doc_id % 3 == 0) for r in found)
    spans = {r.doc_id: r.offending for r in found}
    assert all(("vile" in t[spans[i][0]["start"]:spans[i][0]["end"]]) for i, t, *_ in rows if i % 3 == 0)


def test_noisy_or_gradient_by_differences(spark):
    rows, labels = toxic_docs(spark, 40)
    kept = toxicity.training_rows(edge_docs(spark, rows), labels)
    numbers = {w: i for i, w in enumerate(["sun", "vile", "scum", "rive*", "tree", "ston*"])}
    bags = toxicity.Bags(toxicity.bags(kept, numbers).orderBy("h").toArrow())
    theta = np.random.default_rng(0).normal(size=len(numbers) + 1)
    _, grad = toxicity.loss_and_gradient(bags, theta)
    for i in range(len(theta)):
        step = np.zeros_like(theta)
        step[i] = 1e-5
        slope = (toxicity.loss_and_gradient(bags, theta + step)[0]
                 - toxicity.loss_and_gradient(bags, theta - step)[0]) / 2e-5
        assert grad[i] == pytest.approx(slope, rel=1e-4, abs=1e-8)


@pytest.mark.parametrize("rows_of", [toxicity.training_rows, None])
def test_repeated_ids_train_alike_in_any_partitioning(spark, rows_of):
    rows, labels = toxic_docs(spark, 60)
    twice = rows + [(i, f"other text {i}", "de", "b") for i, *_ in rows]
    seen = set()
    for n in (1, 5, 13):
        docs = edge_docs(spark, twice).repartition(n)
        kept = rows_of(docs, labels) if rows_of else language.training_rows(docs)
        found = sorted((r.text, str(r.lang if rows_of is None else r.label)) for r in kept.collect())
        assert len(found) == len({t for t, _ in found}) > 30
        seen.add(str(found))
    assert len(seen) == 1


def test_words_are_letters_with_their_marks(spark):
    find = language.word_pattern().findall
    assert find("हिन्दी भाषा") == ["हिन्दी", "भाषा"] and find("வணக்கம் е́ль") == ["வணக்கம்", "е́ль"]
    assert find("² ½ Ⅻ 12 _ ́") == [] and find("a1b²c") == ["a", "b", "c"]
    docs = edge_docs(spark, [(i, "the cat sat on the mat", "en", "a") for i in range(40)] + [
        (100, "² ½", None, "a"), (101, "Ⅻ ٣", None, "a"), (102, "the", None, "a")])
    found = {r.doc_id: (r.lang_pred, r.score) for r in language.languages(docs).collect()}
    assert found[100] == found[101] == ("und", 0.0) and found[102] == ("en", 1.0)


def test_long_words_take_one_step_a_byte():
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(bpe.vocabulary_path())
    coder = bpe.Tokenizer(bpe.vocabulary_path())
    rnd = random.Random(1)
    for text in (" " * 400_000, "".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=400_000)), "\n" * 5000,
                 "=-" * 50_000, "é" * 20_000):
        began = time.process_time()
        ids = coder.encode(text)
        assert time.process_time() - began < 5
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
        assert coder.decode(ids) == text


def test_automaton_table_against_walking_the_labels():
    a = bpe.tokenizer(bpe.vocabulary_path()).automaton
    begins = {label[:n] for label in a.token for n in range(1, len(label) + 1)}
    rnd = random.Random(8)
    for _ in range(300):
        word = bytes(rnd.choices(b" etaoinshr.,\n\xc3\xa9", k=12))
        state = 0
        for at in range(1, len(word) + 1):
            state = a.step[state << 8 | word[at - 1]]
            read = word[:at]
            longest = next(read[k:] for k in range(at) if read[k:] in begins)
            want = [(a.token[longest[k:]], len(longest) - k) for k in range(len(longest)) if longest[k:] in a.token]
            assert list(a.ends[state]) == want

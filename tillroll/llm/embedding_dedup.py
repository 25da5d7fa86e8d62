"""Near-duplicate embeddings by a robust-pruned graph.

Vectors are compared with those of the same label (and length) only, by cosine in double
precision; they link at ``MIN_COSINE`` or more.

* Equal vectors of a label are one class with a multiplicity, so copies cost nothing.
* Cluster shards: a tree of centroids whose number grows with the largest label (one for
  ``SHARD`` classes). The top level is fitted on a bounded sample (``SAMPLE`` classes; k-means);
  where more than ``MAX_CENTROIDS`` are needed each cluster is cut further by centroids fitted
  on a sample of its own, and a class goes down into the ``overlap`` nearest at each level.
  A shard of more than ``BLOCK`` classes is cut by a hash into blocks, and each pair of
  blocks is a shard, so any two of its members still meet and no task holds more than two blocks.
* Build: each shard's graph joins a vector with its nearest neighbours, pruned by the
  robust rule (a neighbour goes if a kept one is ``ALPHA`` times nearer to it than the
  vector is), with edges back. The adjacency lists of all shards are united: an edge is
  sent to the other clusters that hold both ends, to the shard of the blocks of its ends.
* Search: every member is a query. A greedy beam search runs from the medoid until it
  finds nothing nearer; then the range grows over the graph from the members found within
  ``MIN_COSINE - SLACK``. Where one of these stands in a cluster that the query has not been
  to, the query visits that cluster in the next round and is searched there from its medoid,
  until nobody has a new cluster to visit. Only pairs that meet the exact cosine count
  (verify). A pair that shares clusters is counted in the first one, others as distinct pairs.
* Audit, of every index: the links of ``AUDIT`` classes are counted by brute force over all
  classes, in blocks. While less than ``RECALL`` of them are found, in all or in the mean of the
  classes that have links, the index is built anew with one more centroid a vector, and from
  ``MAX_OVERLAP`` on with twice as many. If all centroids don't do, every pair of a label is
  compared, in blocks.

Cases: vectors that are null, empty, zero, or hold null or non-finite components, and null
labels, link with nothing and are their own component (``component_id`` = ``vec_id``,
kept); a null id never names a component that has another id (its row isn't kept unless
no vector of the component has an id); repeated rows are copies that link with each other; other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import stored
from tillroll.llm.components import connected_components

MIN_COSINE, SLACK = 0.93, 0.05
SAMPLE, SHARD, BLOCK, MAX_CENTROIDS, ROUNDS = 8192, 512, 4096, 1024, 8
NEAREST, DEGREE, ALPHA, BEAM, QUERIES = 24, 12, 1.2, 12, 256
AUDIT, RECALL, MAX_OVERLAP = 512, 0.9, 4
PAIRS = 1 << 19  # neighbours looked at in one step of a search (memory only)
DEAL = 16384  # rows of a cluster that one task sends to the next level


def classes_of(rows: DataFrame) -> DataFrame:
    """(cid, label, vector, n, first): distinct valid vectors of a label."""
    x = F.transform("embedding", lambda v: v.cast("double"))
    good = F.col("label").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0) \
        & ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))) \
        & F.exists(x, lambda v: v != 0)
    classes = rows.where(F.coalesce(good, F.lit(False))).groupBy("label", "embedding").agg(
        F.count("*").alias("n"), F.min("vec_id").alias("first"))
    return classes.withColumn("cid", F.monotonically_increasing_id())


def _units(vectors) -> np.ndarray:
    """Unit vectors, as rows, of a list column whose lists have one length."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    x = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow in the squares
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _longs(column: pa.ChunkedArray) -> np.ndarray:
    return column.to_numpy().astype(np.int64)


def _lists(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(row, value) of every item of a list column of longs."""
    lists = column.combine_chunks()
    row = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    return row, lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)


def _padded(column: pa.ChunkedArray) -> np.ndarray:
    """The lists of a column as rows of equal length, padded by -1."""
    row, value = _lists(column)
    n = np.bincount(row, minlength=len(column))
    out = np.full((len(column), n.max(initial=1)), -1, np.int64)
    out[row, np.arange(len(row)) - (np.cumsum(n) - n)[row]] = value
    return out


def _k_means(x: np.ndarray, k: int) -> np.ndarray:
    c = x[:: max(1, len(x) // k)][:k]
    for _ in range(ROUNDS):
        near = (x @ c.T).argmax(axis=1)
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        c = np.where(size > 0, sums / np.maximum(size, 1e-300), c)
    return c


def _nearest(x: np.ndarray, c: np.ndarray, most: int) -> np.ndarray:
    return np.argsort(-(x @ c.T), axis=1, kind="stable")[:, :most]


def centroids(classes: DataFrame, n: int, k: int) -> dict[int, np.ndarray]:
    """Spherical k-means for each vector length, on at most ``SAMPLE`` classes by hash."""
    step = max(1, -(-n // SAMPLE))
    rows = classes.where(F.pmod(F.xxhash64("cid"), F.lit(step)) == 0).orderBy(F.xxhash64("cid")) \
        .limit(SAMPLE).select("embedding").toArrow().column(0).combine_chunks()
    sizes = pc.list_value_length(rows)
    return {d: _k_means(_units(rows.filter(pc.equal(sizes, d))), k) for d in pc.unique(sizes).to_pylist()}


def assigned(classes: DataFrame, centers: dict[int, np.ndarray], overlap: int) -> DataFrame:
    """cid, n, label, vector length, vector and the clusters of each class."""
    fields = {f.name: f.dataType.simpleString() for f in classes.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(3)
            sizes = pc.list_value_length(vectors)
            for d in pc.unique(sizes).to_pylist():
                some = batch.filter(pc.equal(sizes, d))
                c = centers.get(d, np.ones((1, d)))
                near = np.sort(_nearest(_units(some.column(3)), c, overlap), axis=1)
                clusters = pa.ListArray.from_arrays(
                    np.arange(0, near.size + 1, near.shape[1], dtype=np.int32), near.astype(np.int64).ravel())
                yield pa.RecordBatch.from_arrays(
                    [*some.columns[:3], pa.array(np.full(len(near), d, np.int32)), some.column(3), clusters],
                    ["cid", "n", "label", "dim", "embedding", "clusters"])

    return classes.select("cid", "n", "label", "embedding").mapInArrow(
        run, f"cid long, n long, label {fields['label']}, dim int, embedding {fields['embedding']}, "
             "clusters array<long>")


def finer(rows: DataFrame, overlap: int, levels: int) -> DataFrame:
    """``rows`` of ``assigned`` one level down: each cluster is cut by centroids fitted on a sample
    of its own, and a class stays in the ``overlap`` nearest ones below its clusters. ``levels``: how
    many are left, this one included."""
    path = ["dim", "cluster"]
    own = rows.select("cid", "label", "dim", "embedding", F.explode("clusters").alias("cluster"))
    need = F.ceil(F.pow(F.max("size") / (SHARD * overlap), 1 / levels))
    sizes = own.groupBy(*path, "label").agg(F.count("*").alias("size")).groupBy(*path).agg(
        F.sum("size").alias("size"), F.least(F.lit(MAX_CENTROIDS), need).cast("int").alias("k"))
    sizes = stored(sizes.select(*path, "k", F.ceil(F.col("size") / SAMPLE).alias("step"),
                                F.ceil(F.col("size") / DEAL).alias("parts")), "levels")
    own = own.drop("label").join(sizes, path)

    def fit(key: tuple, part: pa.Table) -> pa.Table:
        c = _k_means(_units(part["embedding"]), part["k"][0].as_py())
        return pa.table({"dim": pa.array([key[0].as_py()], pa.int32()), "cluster": [key[1].as_py()],
                         "centers": pa.array([c.ravel()], pa.list_(pa.float64()))})

    # the same class in every sample of its hash; the smallest clusters are their own sample
    chosen = own.where(F.pmod(F.xxhash64("cid", F.lit(2)), "step") == 0)
    books = stored(chosen.groupBy(*path).applyInArrow(fit, "dim int, cluster long, centers array<double>"), "centers")
    dealt = own.select("cid", *path, "embedding", F.pmod(F.xxhash64("cid", F.lit(3)), "parts").alias("part"))
    # a cluster whose sample is empty by chance keeps itself as its only child
    each = sizes.join(books, path, "left").select(*path, "centers", F.explode(F.expr(
        "sequence(0L, parts - 1)")).alias("part"))

    def pick(key: tuple, part: pa.Table, book: pa.Table) -> pa.Table:
        x = _units(part["embedding"]) if len(part) else np.zeros((0, key[0].as_py()))
        flat = book["centers"][0].as_py()
        c = np.array(flat).reshape(-1, x.shape[1]) if flat else np.ones((1, x.shape[1]))
        near = _nearest(x, c, overlap)
        far = -np.einsum("nd,nod->no", x, c[near])
        return pa.table({"cid": np.repeat(_longs(part["cid"]), near.shape[1]), "far": far.ravel(),
                         "cluster": key[1].as_py() * MAX_CENTROIDS + near.ravel()})

    key = [*path, "part"]
    below = dealt.groupBy(*key).cogroup(each.groupBy(*key)).applyInArrow(
        pick, "cid long, far double, cluster long")
    best = below.groupBy("cid").agg(F.slice(F.sort_array(F.collect_list(F.struct(
        "far", "cluster"))), 1, overlap).alias("best"))  # overlap squared at most
    return rows.drop("clusters").join(
        best.select("cid", F.sort_array("best.cluster").alias("clusters")), "cid")


CLUSTER = ["label", "dim", "cluster"]
SHARD_KEY = [*CLUSTER, "lo", "hi"]


def members(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """Rows of ``assigned`` in each of their shards, ``b`` their own block."""
    each = rows.select("*", F.explode("clusters").alias("cluster")).join(sizes, CLUSTER)
    dealt = each.select("*", F.expr("pmod(xxhash64(cid), blocks)").alias("b"),
                        F.explode(F.expr("sequence(0L, blocks - 1)")).alias("o"))
    return dealt.select(*CLUSTER, F.least("b", "o").alias("lo"), F.greatest("b", "o").alias("hi"),
                        "b", "cid", "n", "embedding", "clusters")


def robust_prune(x: np.ndarray, nodes: np.ndarray, near: np.ndarray) -> np.ndarray:
    """``DEGREE`` of each node's candidates ``near`` (nearest first; -1: none), padded by -1."""
    out = np.full((len(nodes), DEGREE), -1, np.int64)
    for at in range(0, len(nodes), 512):
        cand = near[at:at + 512]
        y = x[cand]
        to_node = 1 - np.einsum("qcd,qd->qc", y, x[nodes[at:at + 512]])
        alive = cand >= 0
        rows = np.arange(len(cand))
        for r in range(DEGREE):
            pick = alive.argmax(axis=1)
            ok = alive[rows, pick]
            if not ok.any():
                break
            out[at:at + 512][ok, r] = cand[rows, pick][ok]
            to_pick = 1 - np.einsum("qcd,qd->qc", y, y[rows, pick])
            alive &= (ALPHA * to_pick > to_node) | ~ok[:, None]
            alive[rows, pick] = False
    return out


def build(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (from, to) of the shard's graph: pruned neighbours and the edges back."""
    m, k = len(x), min(NEAREST, len(x) - 1)
    if k < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    near = np.zeros((m, k), np.int64)
    for at in range(0, m, 512):
        s = x[at:at + 512] @ x.T
        s[np.arange(len(s)), at + np.arange(len(s))] = -2
        top = np.argpartition(-s, k - 1, axis=1)[:, :k]
        near[at:at + 512] = np.take_along_axis(
            top, np.argsort(-np.take_along_axis(s, top, 1), axis=1, kind="stable"), 1)
    # a few far members for the first, long steps of the search
    far = np.random.default_rng(m).integers(0, m, (m, 4))
    far = np.where(far == np.arange(m)[:, None], -1, far)
    kept = np.concatenate([robust_prune(x, np.arange(m), near), far], axis=1)
    a, b = np.repeat(np.arange(m), kept.shape[1]), kept.ravel()
    a, b = a[b >= 0], b[b >= 0]
    return np.r_[a, b], np.r_[b, a]


def _adjacency(m: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, to): the neighbours of node v are to[first[v]:first[v + 1]]."""
    a, b = np.divmod(np.unique(a * m + b), m)
    return np.searchsorted(a, np.arange(m + 1)), b


def _neighbours(first: np.ndarray, to: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(k, j): every neighbour j of every nodes[k]."""
    n = first[nodes + 1] - first[nodes]
    k = np.repeat(np.arange(len(nodes)), n)
    return k, to[np.arange(len(k)) + (first[nodes] - np.cumsum(n) + n)[k]]


def _cosines(q: np.ndarray, x: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Cosine of each pair q[i], x[j], a bounded number of pairs at a time."""
    out = np.empty(len(i), q.dtype)
    for c in range(0, len(i), PAIRS // 16):
        at = slice(c, c + PAIRS // 16)
        out[at] = np.einsum("nd,nd->n", q[i[at]], x[j[at]])
    return out


def search(q: np.ndarray, x: np.ndarray, first: np.ndarray, to: np.ndarray) -> np.ndarray:
    """found[i, j]: 2 where vector j was found within MIN_COSINE of query i, 1 where it was found
    within MIN_COSINE - SLACK only. The walk compares single precision, a link double."""
    m = len(x)
    found = np.zeros((len(q), m), np.uint8)
    narrow_x = x.astype(np.float32)
    medoid = int((x @ x.mean(axis=0)).argmax())
    step = max(1, min(QUERIES, (1 << 21) // m))
    for at in range(0, len(q), step):
        part = q[at:at + step].astype(np.float32)
        each = np.arange(len(part))
        seen = np.zeros((len(part), m), bool)
        seen[:, medoid] = True
        beam = np.full((len(part), 1), medoid)
        score = (part @ narrow_x[medoid])[:, None]
        done = np.zeros((len(part), 1), bool)
        near = [(each, beam[:, 0], score[:, 0])]
        while not done.all():
            pick = np.where(done, -2, score).argmax(axis=1)
            live = np.flatnonzero(~done[each, pick])
            done[each, pick] = True
            k, j = _neighbours(first, to, beam[live, pick[live]])
            i = live[k]
            fresh = ~seen[i, j]
            i, j = i[fresh], j[fresh]
            seen[i, j] = True
            s = _cosines(part, narrow_x, i, j)
            near.append((i, j, s))
            n = np.bincount(i, minlength=len(part))  # i ascends
            place = np.arange(len(i)) - (np.cumsum(n) - n)[i]
            shape = len(part), int(n.max(initial=0))
            more, more_score, more_done = (np.zeros(shape, np.int64), np.full(shape, -2, np.float32),
                                           np.ones(shape, bool))
            more[i, place], more_score[i, place], more_done[i, place] = j, s, False
            beam, score, done = (np.concatenate(v, 1) for v in (
                (beam, more), (score, more_score), (done, more_done)))
            if beam.shape[1] > BEAM:
                top = np.argpartition(-score, BEAM - 1, axis=1)[:, :BEAM]
                beam, score, done = (np.take_along_axis(v, top, 1) for v in (beam, score, done))
        i, j, s = (np.concatenate(v) for v in zip(*near))
        while len(i):  # the range grows from all that was near
            inside = s >= MIN_COSINE - SLACK
            i, j, s = i[inside], j[inside], s[inside]
            found[at + i, j] = 1
            close = s >= MIN_COSINE - 1e-4
            exact = _cosines(q[at:at + step], x, i[close], j[close]) >= MIN_COSINE
            found[at + i[close][exact], j[close][exact]] = 2
            piece = np.cumsum(first[j + 1] - first[j]) // PAIRS
            grown = []
            for c in np.split(np.arange(len(i)), np.flatnonzero(np.diff(piece)) + 1):
                k, to_j = _neighbours(first, to, j[c])
                from_i = i[c][k]
                fresh = ~seen[from_i, to_j]
                new = np.divmod(np.unique(from_i[fresh] * m + to_j[fresh]), m)
                seen[new] = True
                grown.append((*new, _cosines(part, narrow_x, *new)))
            i, j, s = (np.concatenate(v) for v in zip(*grown))
    return found


def _shared(a: np.ndarray, b: np.ndarray, below: int | None = None) -> np.ndarray:
    """True where rows of ``a`` and ``b`` (clusters, padded by -1) have one in common (under ``below``)."""
    out = np.zeros(len(a), bool)
    for p in range(a.shape[1]):
        for r in range(b.shape[1]):
            same = (a[:, p] == b[:, r]) & (a[:, p] >= 0)
            out |= same if below is None else same & (a[:, p] < below)
    return out


def _forest(found: np.ndarray) -> np.ndarray:
    """For each member the smallest member that links reach in the shard."""
    m = len(found)
    root = np.arange(m)
    while True:
        best = np.concatenate([np.where(found[at:at + 512] == 2, root, m).min(axis=1, initial=m)
                               for at in range(0, m, 512)])
        new = np.minimum(root, best)
        new = new[new]
        if (new == root).all():
            return root
        root = new


RESULT = "cid long, n long, links long, partners long, other long, other_n long, cluster long"


def _result(size: int, **columns) -> pa.Table:
    """Rows of ``RESULT``, null where a column isn't given."""
    names = [c.split()[0] for c in RESULT.split(", ")]
    return pa.table({c: pa.array(columns[c], pa.int64()) if c in columns else pa.nulls(size, pa.int64())
                     for c in names})


def _own_links(part: pa.Table, found: np.ndarray, key: tuple) -> pa.Table:
    """Links and linked classes of each member that this shard is the first to hold, and a class
    that its links reach."""
    cluster, lo, hi = (k.as_py() for k in key[2:])
    cid, n, b, clusters = _longs(part["cid"]), _longs(part["n"]), _longs(part["b"]), _padded(part["clusters"])
    links, partners = np.zeros(len(cid), np.int64), np.zeros(len(cid), np.int64)
    for at in range(0, len(cid), QUERIES):
        i, j = np.nonzero(found[at:at + QUERIES] == 2)
        own = (np.minimum(b[at + i], b[j]) == lo) & (np.maximum(b[at + i], b[j]) == hi)
        i, j = i[own], j[own]
        own = ~_shared(clusters[at + i], clusters[j], cluster)
        i, j = i[own], j[own]
        rows = slice(at, at + QUERIES)
        partners[rows] = np.bincount(i, minlength=len(partners[rows]))
        np.add.at(links[rows], i, n[j])
    return _result(len(cid), cid=cid, n=n, links=links, partners=partners, other=cid[_forest(found)])


def _new_clusters(cid: np.ndarray, found: np.ndarray, clusters: np.ndarray, been: pa.ChunkedArray) -> pa.Table:
    """Clusters of what each query has near, but those it has been to."""
    known, code = np.unique(clusters, return_inverse=True)
    code = code.reshape(clusters.shape)
    at_row, at_cluster = _lists(been)
    place = np.minimum(np.searchsorted(known, at_cluster), len(known) - 1)
    hit = known[place] == at_cluster
    at_row, place = at_row[hit], place[hit]
    out = []
    for at in range(0, len(cid), QUERIES):
        i, j = np.nonzero(found[at:at + QUERIES])
        go = np.zeros((min(QUERIES, len(cid) - at), len(known)), bool)
        for p in range(code.shape[1]):
            go[i, code[j, p]] = True
        mine = slice(*np.searchsorted(at_row, (at, at + QUERIES)))
        go[at_row[mine] - at, place[mine]] = False
        go[:, known < 0] = False
        i, c = np.nonzero(go)
        out.append((cid[at + i], known[c]))
    q, c = (np.concatenate(v) for v in zip(*out))
    return _result(len(q), cid=q, cluster=c)


def _graph(part: pa.Table, lists: pa.Table, cid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The united adjacency of a shard's members."""
    order = np.argsort(cid)
    row, b = _lists(lists["to"])
    a = _longs(lists["a"])[row]
    a, b = (order[np.searchsorted(cid[order], v)] for v in (a, b))
    return _adjacency(len(cid), a, b)


def compare_all(shards: DataFrame) -> DataFrame:
    """Every pair of each shard, without a graph: rows of ``RESULT``."""
    def compare(key: tuple, part: pa.Table) -> pa.Table:
        x = _units(part["embedding"])
        found = np.zeros((len(x), len(x)), np.uint8)
        for at in range(0, len(x), 512):
            found[at:at + 512] = 2 * (x[at:at + 512] @ x.T >= MIN_COSINE)
        np.fill_diagonal(found, 0)
        return _own_links(part, np.maximum(found, found.T), key)

    return shards.groupBy(*SHARD_KEY).applyInArrow(compare, RESULT)


def adjacency(shards: DataFrame, sizes: DataFrame) -> DataFrame:
    """(shard, a, to): the lists of each shard's graph, and those that others send to it."""
    kind = shards.schema["label"].dataType.simpleString()

    def graph(key: tuple, part: pa.Table) -> pa.Table:
        cluster, lo, hi = (k.as_py() for k in key[2:])
        a, b = build(_units(part["embedding"]))
        cid, block, clusters = _longs(part["cid"]), _longs(part["b"]), _padded(part["clusters"])
        a, b = np.divmod(np.unique(a * len(cid) + b), len(cid))
        sent = [(np.full(len(a), cluster), np.ones(len(a), np.int8), a, b)]
        for p in range(clusters.shape[1]):
            for r in range(clusters.shape[1]):
                c = clusters[a, p]
                go = (c == clusters[b, r]) & (c >= 0) & (
                    (c != cluster) | ((block[a] == block[b]) & (lo != hi)))
                sent.append((c[go], np.zeros(go.sum(), np.int8), a[go], b[go]))
        c, here, a, b = (np.concatenate(v) for v in zip(*sent))
        order = np.lexsort((b, a, here, c))
        c, here, a, b = c[order], here[order], a[order], b[order]
        new = np.ones(len(c), bool)
        new[1:] = (np.diff(c) != 0) | (np.diff(here) != 0) | (np.diff(a) != 0)
        start = np.flatnonzero(new)
        if not len(start):
            return pa.table({"label": part["label"].slice(0, 0), "dim": pa.array([], pa.int32()),
                             **{k: pa.array([], pa.int64()) for k in ("cluster", "lo", "hi", "a")},
                             "to": pa.array([], pa.list_(pa.int64()))})
        outside = here[start] == 0
        return pa.table({
            "label": part["label"].take(pa.array(np.zeros(len(start), np.int64))),
            "dim": np.full(len(start), key[1].as_py(), np.int32), "cluster": c[start],
            "lo": pa.array(np.full(len(start), lo), mask=outside),
            "hi": pa.array(np.full(len(start), hi), mask=outside), "a": cid[a[start]],
            "to": pa.ListArray.from_arrays(np.r_[start, len(c)].astype(np.int32), cid[b])})

    schema = f"label {kind}, dim int, cluster long, lo long, hi long, a long, to array<long>"
    lists = stored(shards.groupBy(*SHARD_KEY).applyInArrow(graph, schema), "adjacency")
    # lists for other shards, cut by the blocks of the ends
    sent = lists.where("lo is null").join(sizes, CLUSTER).select(
        "*", F.expr("pmod(xxhash64(a), blocks)").alias("b"),
        F.explode(F.expr("sequence(0L, blocks - 1)")).alias("o"))
    sent = sent.select(*CLUSTER, F.least("b", "o").alias("lo"), F.greatest("b", "o").alias("hi"), "a", F.expr(
        "if(blocks = 1, to, filter(to, x -> pmod(xxhash64(x), blocks) = o))").alias("to"))
    return lists.where("lo is not null").union(sent.where(F.size("to") > 0))


def search_members(shards: DataFrame, lists: DataFrame) -> DataFrame:
    """Every member searched in its own shards: rows of ``RESULT``, with the clusters to visit."""
    def hunt(key: tuple, part: pa.Table, graph: pa.Table) -> pa.Table:
        x, cid = _units(part["embedding"]), _longs(part["cid"])
        found = search(x, x, *_graph(part, graph, cid))
        np.fill_diagonal(found, 0)
        found = np.maximum(found, found.T)
        return pa.concat_tables([_own_links(part, found, key), _new_clusters(
            cid, found, _padded(part["clusters"]), part["clusters"])])

    return shards.groupBy(*SHARD_KEY).cogroup(lists.groupBy(*SHARD_KEY)).applyInArrow(hunt, RESULT)


def search_visitors(visitors: DataFrame, shards: DataFrame, lists: DataFrame, sizes: DataFrame) -> DataFrame:
    """Visitors (rows of ``assigned`` with ``go``, clusters to visit, and ``been``, all they have been to,
    these included) searched there: rows of ``RESULT``, a pair each, with the clusters to visit next.
    A visitor meets each member once, in the shard of its own block; visitors of a
    shard are dealt to tasks of at most about ``BLOCK``."""
    each = visitors.select("*", F.explode("go").alias("cluster"))
    parts = each.groupBy(*CLUSTER).agg(F.ceil(F.count("*") / BLOCK).alias("parts"))
    parts = stored(parts.join(sizes, CLUSTER), "visited")
    guest = each.join(parts, CLUSTER).select(
        *CLUSTER, F.explode(F.expr("sequence(0L, blocks - 1)")).alias("lo"),
        F.expr("pmod(xxhash64(cid, 5), parts)").alias("part"), "cid", "n", "embedding", "clusters", "been")
    host = shards.where("lo = hi").join(parts, CLUSTER).select(
        *CLUSTER, "lo", F.explode(F.expr("sequence(0L, parts - 1)")).alias("part"),
        "cid", "n", "embedding", "clusters", F.lit(None).cast("array<long>").alias("been"))
    there = lists.where("lo = hi").join(parts, CLUSTER).select(
        *CLUSTER, "lo", F.explode(F.expr("sequence(0L, parts - 1)")).alias("part"), "a", "to")

    def hunt(part: pa.Table, graph: pa.Table) -> pa.Table:
        if not len(part):
            return _result(0)
        q, x = part.filter(pc.is_valid(part["been"])), part.filter(pc.is_null(part["been"]))
        if not len(q) or not len(x):
            return _result(0)
        cid, n, clusters = _longs(x["cid"]), _longs(x["n"]), _padded(x["clusters"])
        own, own_n, own_clusters = _longs(q["cid"]), _longs(q["n"]), _padded(q["clusters"])
        found = search(_units(q["embedding"]), _units(x["embedding"]), *_graph(x, graph, cid))
        out = [_new_clusters(own, found, clusters, q["been"])]
        for at in range(0, len(own), QUERIES):
            i, j = np.nonzero(found[at:at + QUERIES] == 2)
            apart = ~_shared(own_clusters[at + i], clusters[j])  # others were searched as members
            i, j = at + i[apart], j[apart]
            out.append(_result(len(i), cid=own[i], n=own_n[i], other=cid[j], other_n=n[j]))
        return pa.concat_tables(out)

    key = [*CLUSTER, "lo", "part"]
    return guest.unionByName(host).groupBy(*key).cogroup(there.groupBy(*key)).applyInArrow(hunt, RESULT)


def index_and_search(rows: DataFrame, exact: bool = False) -> tuple[DataFrame, DataFrame]:
    """(cid, links, partners): links and linked classes of each class; and pairs of classes that
    join all that links join. ``exact``: every pair of a shard is compared, without a graph."""
    sizes = stored(rows.select("label", "dim", F.explode("clusters").alias("cluster")).groupBy(*CLUSTER).agg(
        F.ceil(F.count("*") / BLOCK).alias("blocks")), "shard-sizes")
    shards = stored(members(rows, sizes), "shards")
    if exact:
        found = stored(compare_all(shards), "found")
        rounds = []
    else:
        lists = adjacency(shards, sizes)
        found = stored(search_members(shards, lists), "found")
        rounds = []
        visitors, out = rows.withColumn("been", F.col("clusters")), found
        while True:
            go = out.where("cluster is not null").groupBy("cid").agg(F.collect_set("cluster").alias("new"))
            visitors = stored(visitors.join(go, "cid").select(
                *rows.columns, F.array_except("new", "been").alias("go"),
                F.array_union("been", "new").alias("been")).where(F.size("go") > 0), "visitors")
            if visitors.isEmpty():
                break
            out = stored(search_visitors(visitors, shards, lists, sizes), "found-away")
            rounds.append(out)
    members_found = found.where("cluster is null")
    totals, joined = members_found.select("cid", "links", "partners"), members_found.select("cid", "other")
    if rounds:
        pairs = rounds[0]
        for out in rounds[1:]:
            pairs = pairs.union(out)
        pairs = pairs.where("cluster is null").select(
            F.least(F.struct("cid", "n"), F.struct(F.col("other").alias("cid"), F.col("other_n").alias("n"))).alias("a"),
            F.greatest(F.struct("cid", "n"), F.struct(F.col("other").alias("cid"), F.col("other_n").alias("n"))).alias("b"))
        pairs = stored(pairs.distinct(), "pairs")
        one = F.lit(1).cast("long").alias("partners")
        totals = totals.union(pairs.select("a.cid", F.col("b.n"), one)).union(pairs.select("b.cid", F.col("a.n"), one))
        joined = joined.union(pairs.select("a.cid", F.col("b.cid").alias("other")))
    totals = totals.groupBy("cid").agg(F.sum("links").alias("links"), F.sum("partners").alias("partners"))
    return totals, joined.where("cid <> other")


def audit(rows: DataFrame, totals: DataFrame, queries: int = AUDIT) -> float:
    """Share of the links of ``queries`` classes (by hash) that were found: brute force of these
    vectors against all classes. The smaller one of the share of all their links and the mean share
    of a class that has links, so a dense group doesn't hide sparse pairs."""
    n, h = rows.count(), F.xxhash64("cid", F.lit(1))
    some = rows if n <= 4 * queries else rows.where(  # leaves well over ``queries`` to the sort
        F.shiftrightunsigned(h, 33) < int((1 << 31) * 2.0 * queries / n))
    asked = some.orderBy(h).limit(queries).select("cid", "label", "unit").toArrow()
    groups: dict = {}
    for i, (label, u) in enumerate(zip(asked.column("label").to_pylist(), asked.column("unit").to_pylist())):
        groups.setdefault((label, len(u)), []).append((i, u))
    groups = {key: (np.array([i for i, _ in g]), _units(pa.array([u for _, u in g]))) for key, g in groups.items()}
    cids = asked.column("cid").to_pylist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(len(cids), np.int64)
        for batch in batches:
            for (label, d), (at, q) in groups.items():
                part = batch.column(2).filter(pc.and_(pc.equal(batch.column(0), label), pc.equal(batch.column(1), d)))
                if len(part):
                    n[at] += (q @ _units(part).T >= MIN_COSINE).sum(axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(n)), pa.int64()), pa.array(n)], ["i", "n"])

    true = np.zeros(len(cids))
    for r in rows.select("label", "dim", "unit").mapInArrow(run, "i long, n long").groupBy("i").agg(
            F.sum("n").alias("n")).collect():
        true[r["i"]] = r["n"] - 1  # every class finds itself
    chosen = totals.join(F.broadcast(totals.sparkSession.createDataFrame(
        [(c,) for c in cids], "cid long")), "cid")
    partners = {r["cid"]: r["partners"] for r in chosen.collect()}
    got = np.array([partners.get(c, 0) for c in cids], float)
    some = true > 0
    return float(min(got[some].sum() / true[some].sum(), (got[some] / true[some]).mean())) if some.any() else 1.0


def clustered(classes: DataFrame, n: int, wanted: int, overlap: int) -> DataFrame:
    """Rows of ``assigned`` in about ``wanted`` clusters a label, by as many levels as that takes."""
    levels = 1
    while MAX_CENTROIDS ** levels < wanted:
        levels += 1
    rows = stored(assigned(classes, centroids(classes, n, int(np.ceil(wanted ** (1 / levels)))), overlap), "assigned")
    for left in range(levels - 1, 0, -1):
        rows = stored(finer(rows, overlap, left), "assigned")
    return rows


def near_duplicates(vectors: DataFrame, overlap: int = 2) -> DataFrame:
    """One row per row of ``vectors`` (vec_id, embedding, label): vec_id, n_links,
    component_id, kept."""
    rows = vectors.select("vec_id", "embedding", "label")
    classes = stored(classes_of(rows), "classes")
    sizes = classes.groupBy("label").count().agg(F.sum("count"), F.max("count")).first()
    n, most = sizes[0] or 0, sizes[1] or 0
    if not n:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"),
                           F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    wanted = -(-most // SHARD)
    exact = False
    while True:
        spread = stored(assigned(classes, {}, 1), "assigned") if exact else clustered(
            classes, n, wanted, min(overlap, wanted))
        totals, joined = index_and_search(spread, exact)
        totals = stored(totals, "totals")
        if exact or audit(spread.withColumnRenamed("embedding", "unit"), totals) >= RECALL:
            break
        if overlap >= min(wanted, MAX_CENTROIDS):  # one cluster: all of a label meet in some pair of blocks
            exact = True
        else:
            overlap = overlap + 1 if overlap < MAX_OVERLAP else 2 * overlap
    linked = connected_components(joined)
    named = classes.join(totals, "cid", "left").join(linked.withColumnRenamed("node", "cid"), "cid", "left") \
        .select("label", "embedding", "first", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                F.coalesce("component", "cid").alias("component"))
    named = stored(named, "classes-linked")
    names = stored(named.groupBy("component").agg(F.min("first").alias("component_id")), "names")
    known = stored(named.join(names, "component"), "classes-named")
    joined = rows.alias("r").join(known.alias("k"), (F.col("r.label") == F.col("k.label")) & (
        F.col("r.embedding") == F.col("k.embedding")), "left")
    component = F.when(F.col("k.component").isNull(), F.col("r.vec_id")).otherwise(F.col("k.component_id"))
    return joined.select(
        "r.vec_id", F.coalesce("k.n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), F.col("r.vec_id").eqNullSafe(component).alias("kept"))

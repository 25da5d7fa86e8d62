"""Main text of web pages: markup first (``html_markup``), then the host's suffix arrays.

Markup gives the blocks of a page's text. On a page with an article or main element that is the
result: what such pages repeat inside it belongs to the article. On pages without one, menus and
notices in plain elements are left; these are told by what the pages of a host repeat.

Host suffix array. The blocks that a host's distinct pages show beside their articles (all blocks,
where there is no article element) are token streams, with a mark between blocks. Distinct streams, each
with the number of its pages, are dealt by a hash into groups of one host, of about ``GROUP_PAGES``
streams and ``GROUP_CHARS`` characters. In a group the streams are concatenated and all
suffixes sorted (prefix doubling to the end); the common lengths of neighbours (LCP) cut
the array into intervals of suffixes that agree in ``RUN`` tokens or more. An interval on at least
``SHARE`` of the group's pages is a repeat: what has that share of the host has it in some group.
The pages of the whole host that hold its runs of ``RUN`` tokens are then counted, and runs
on ``SHARE`` of the host's pages, and ``MIN_PAGES`` at least, are boilerplate.

From the pages without an article element, blocks go whose tokens are *all* covered by
such runs. A block with a token of its own stays whole, so articles that open alike lose
nothing. A hot host is many groups; copies of a page count once.

Cases: null html gives an empty text; null and repeated ids, urls and rows keep their rows; a
null url is a host of its own name ''; other columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import slices, stored
from tillroll.llm.html_markup import blocks_of

RUN, GROUP_PAGES, GROUP_CHARS, SHARE, MIN_PAGES = 8, 256, 4_000_000, 0.5, 5
#: Stands between blocks in a stream.
MARK = np.uint64(0xB10C)


def blocks(page: str) -> list[str]:
    """The text blocks of a page that markup doesn't exclude."""
    return blocks_of(page)[0]


def parsed(pages: DataFrame) -> DataFrame:
    """page_id, url, host, text (blocks joined by two line ends), named (the page has an article or
    main element) and beside (the blocks to hold against the host's other pages)."""
    kinds = {c: pages.schema[c].dataType.simpleString() for c in ("page_id", "url")}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            found = [blocks_of(p) for p in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(["\n\n".join(f[0]) for f in found], pa.string()),
                 pa.array([f[1] for f in found], pa.bool_()),
                 pa.array([None if not f[1] else "\n\n".join(f[2]) for f in found], pa.string())],
                ["page_id", "url", "host", "text", "named", "beside"])

    host = F.lower(F.regexp_extract(F.coalesce(F.col("url").cast("string"), F.lit("")),
                                    r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))
    rows = pages.select("page_id", "url", host.alias("host"), F.coalesce(
        F.col("html").cast("string"), F.lit("")).alias("html")).mapInArrow(
        run, f"page_id {kinds['page_id']}, url {kinds['url']}, host string, text string, named boolean, "
             "beside string")
    return rows.withColumn("beside", F.coalesce("beside", "text"))


def stream_of(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Token numbers (64-bit hashes) of a text with a mark before, between and after its blocks, and
    the number of each token's block (marks: that of the block after)."""
    parts = [b.split() for b in text.split("\n\n")] if text else []
    words = pd.Series([w for ws in parts for w in ws], dtype=object)
    hashes = pd.util.hash_array(words.to_numpy(), categorize=True) if len(words) else np.zeros(0, np.uint64)
    sizes = np.array([len(p) for p in parts], np.int64)
    at = np.cumsum(sizes) - sizes  # first word of each block
    tokens = np.insert(hashes, np.append(at, len(hashes)), MARK)
    return tokens, np.append(np.repeat(np.arange(len(parts)), sizes + 1), len(parts))


def suffix_array(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes of a sequence in order, and the common length of each with the one before (the
    first: 0). Ranks by 1, 2, 4, ... tokens are kept: they give the lengths without a scan."""
    n = len(tokens)
    ranks = [np.unique(tokens, return_inverse=True)[1].astype(np.int64)]
    width = 1
    while width < n and int(ranks[-1].max()) < n - 1:
        last = ranks[-1]
        after = np.zeros(n, np.int64)  # past the end: below all
        after[:n - width] = last[width:] + 1
        ranks.append(np.unique(last * (n + 1) + after, return_inverse=True)[1].astype(np.int64))
        width *= 2
    array = np.argsort(ranks[-1], kind="stable")
    common = np.zeros(n, np.int64)
    a, b = array[:-1].copy(), array[1:].copy()
    for level in range(len(ranks) - 1, -1, -1):
        step = 1 << level
        fits = (a + step <= n) & (b + step <= n)
        same = np.zeros(len(a), bool)
        same[fits] = ranks[level][a[fits]] == ranks[level][b[fits]]
        common[1:][same] += step
        a[same] += step
        b[same] += step
    return array, common


def repeats(texts: list[str], pages: list[int], least: float, run: int = RUN) -> pd.DataFrame:
    """The repeats of ``run`` tokens or more on at least ``least`` pages (text i stands on
    ``pages[i]``): ``hash`` of the first ``run`` tokens, ``length`` that all places share, ``pages``."""
    streams = [stream_of(t)[0] for t in texts]
    none = pd.DataFrame({c: np.zeros(0, np.int64) for c in ("hash", "length", "pages")})
    if not streams:
        return none
    sizes = [len(s) for s in streams]
    owner = np.repeat(np.arange(len(texts)), np.array(sizes) + 1)
    # a number of its own ends each stream, so no repeat crosses two
    joined = np.concatenate([np.append(s, np.uint64(i)) for i, s in enumerate(streams)])
    own_end = np.cumsum(np.array(sizes) + 1) - 1
    codes = np.unique(np.delete(joined, own_end), return_inverse=True)[1] + len(texts)
    numbers = np.empty(len(joined), np.int64)
    numbers[own_end] = np.arange(len(texts))
    numbers[np.setdiff1d(np.arange(len(joined)), own_end, assume_unique=True)] = codes
    array, common = suffix_array(numbers)
    group = np.cumsum(common < run)  # neighbours that agree in run tokens are one interval
    left = own_end[owner[array]] - array  # tokens up to the stream's end
    inside = left >= run
    array, group, common, left = array[inside], group[inside], common[inside], left[inside]
    if not len(array):
        return none
    first = np.append(True, group[1:] != group[:-1])
    starts = np.flatnonzero(first)
    shared = np.where(first, left, np.minimum(common, left))
    length = np.minimum.reduceat(shared, starts)
    place = np.cumsum(first) - 1
    seen = np.unique(place * len(texts) + owner[array])  # an interval's text counts once
    weight = np.bincount(seen // len(texts), np.array(pages)[seen % len(texts)], len(starts))
    many = weight >= least
    return pd.DataFrame({"hash": _run_hashes(joined, array[starts[many]], run), "length": length[many],
                         "pages": weight[many].astype(np.int64)})


def _run_hashes(tokens: np.ndarray, at: np.ndarray, run: int = RUN) -> np.ndarray:
    out = np.zeros(len(at), np.uint64)
    for i in range(run):
        out = out * np.uint64(0x9E3779B97F4A7C15) + tokens[at + i]
    return out.view(np.int64)


def runs_in(text: str, asked: np.ndarray) -> np.ndarray:
    """Places in ``asked`` of the runs that the text holds."""
    tokens, _ = stream_of(text)
    return np.flatnonzero(np.isin(asked, _run_hashes(tokens, np.arange(max(0, len(tokens) - RUN + 1)))))


def without_boilerplate(text: str, runs: np.ndarray) -> str:
    """The text without the blocks that the runs cover from the first token to the last."""
    tokens, block = stream_of(text)
    if len(tokens) < RUN:
        return text
    at = np.arange(len(tokens) - RUN + 1)
    change = np.zeros(len(tokens) + 1, np.int64)
    hit = at[np.isin(_run_hashes(tokens, at), runs)]
    np.add.at(change, hit, 1)
    np.add.at(change, hit + RUN, -1)
    bare = (np.cumsum(change)[:-1] == 0) & (tokens != MARK)
    own = np.bincount(block[bare], minlength=block[-1] + 1)
    return "\n\n".join(b for b, n in zip(text.split("\n\n"), own) if n)


def _part(parts: str = "parts"):
    return F.expr(f"pmod(xxhash64(content), {parts})").alias("part")


def host_boilerplate(pages: DataFrame, share: float = SHARE, min_pages: int = MIN_PAGES,
                     group_pages: int = GROUP_PAGES, group_chars: int = GROUP_CHARS) -> DataFrame:
    """(host, parts, runs): hashes of the runs on at least ``share`` of the host's distinct pages, of
    ``pages`` as ``parsed`` gives them; ``parts`` is how many tasks the host is dealt to."""
    rows = pages.where("beside <> ''").select(
        "host", "beside", F.unhex(F.md5(F.col("beside").cast("binary"))).alias("content"),
        F.xxhash64("text", "beside").alias("page"))
    # distinct streams with the number of their distinct pages
    counts = rows.select("host", "content", "page", F.length("beside").alias("chars")).distinct().groupBy(
        "host", "content").agg(F.count("*").alias("pages"), F.max("chars").alias("chars"))
    counts = stored(counts, "streams")
    sizes = stored(counts.groupBy("host").agg(
        F.sum("pages").alias("host_pages"), F.greatest(
            F.ceil(F.count("*") / group_pages), F.ceil(F.sum("chars") / group_chars)).alias("parts")).where(
        F.col("host_pages") >= min_pages), "host-pages")

    def first_in_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()  # hashes of the rows of one split
        for batch in batches:
            keys = list(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()))
            new = [not (k in seen or seen.add(k)) for k in keys]
            yield batch.filter(pa.array(new, pa.bool_()))

    texts = rows.select("host", "beside", "content")
    dealt = texts.mapInArrow(first_in_task, texts.schema).join(sizes, "host").select(
        "host", _part(), "content", "beside").repartition("host", "part").dropDuplicates(
        ["host", "part", "content"])
    streams = stored(dealt.join(counts, ["host", "content"]).select(
        "host", "part", "content", "beside", "pages"), "host-streams")

    def candidates(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        found = repeats(group["beside"].tolist(), group["pages"].tolist(), share * group["pages"].sum())
        return pd.DataFrame({"host": key[0], "run": found["hash"]})

    some = stored(streams.groupBy("host", "part").applyInPandas(
        candidates, "host string, run long").distinct().groupBy("host").agg(
        F.collect_list("run").alias("asked")).join(sizes, "host"), "run-candidates")

    @F.arrow_udf("array<int>")
    def held(texts: pa.Array, asked: pa.Array) -> pa.Array:
        return pa.array([runs_in(t.as_py(), np.array(a.as_py(), np.int64)) for t, a in zip(texts, asked)],
                        pa.list_(pa.int32()))

    each_part = some.select("host", "asked", F.explode(F.expr("sequence(0L, parts - 1)")).alias("part"))
    hits = streams.join(each_part, ["host", "part"]).select(
        "host", "pages", held(F.col("beside"), F.col("asked")).alias("at"))
    counted = hits.select("host", "pages", F.explode("at").alias("at")).groupBy("host", "at").agg(
        F.sum("pages").alias("pages"))
    return counted.join(some, "host").where(
        (F.col("pages") >= min_pages) & (F.col("pages") >= share * F.col("host_pages"))).groupBy(
        "host", "parts").agg(F.collect_set(F.get("asked", F.col("at"))).alias("runs"))


def main_text(pages: DataFrame, share: float = SHARE, min_pages: int = MIN_PAGES) -> DataFrame:
    """One row per row of ``pages`` (page_id, url, html): page_id, url, text, n_chars."""
    rows = stored(parsed(pages), "pages")
    boilerplate = stored(host_boilerplate(rows, share, min_pages), "boilerplate-runs")

    @F.arrow_udf("string")
    def cleaned(texts: pa.Array, runs: pa.Array) -> pa.Array:
        return pa.array([t.as_py() if not r.is_valid else without_boilerplate(
            t.as_py(), np.array(r.as_py(), np.int64)) for t, r in zip(texts, runs)], pa.string())

    # a host's pages go to as many tasks as its streams did
    open_pages = rows.where("NOT named").withColumn("content", F.xxhash64("text")).join(
        boilerplate.select("host", "parts"), "host", "left").select(
        "page_id", "url", "host", "text", _part("coalesce(parts, 1L)"))
    cut = open_pages.join(boilerplate.select("host", "runs", F.explode(F.expr(
        "sequence(0L, parts - 1)")).alias("part")), ["host", "part"], "left").select(
        "page_id", "url", cleaned(F.col("text"), F.col("runs")).alias("text"))
    named = rows.where("named").select("page_id", "url", "text")
    return named.union(cut).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))

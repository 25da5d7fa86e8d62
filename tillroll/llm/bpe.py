"""Byte-level BPE by a tokenization automaton.

The automaton reads tokens and accepts exactly the token sequences that the merge rules
give. It starts as one state with an arc for every byte. The merge rules then
act one after the other, each as a gadget: rule (a, b) -> t lets an arc t run
beside every path a, b, and the state behind an arc a loses its arc b, because the rule would
have merged them. What a state accepts depends only on the arc that led to it, so
the states are the tokens, and the gadgets' tables (parts, time of birth, cuts)
determine every arc: the state behind p has an arc t if undoing the younger of
both, again and again, meets no cut that was made before. A rule whose path does not exist at
its time makes no arc.

It is made deterministic over bytes. The arcs' labels form a tree, and a table (states by 256 bytes)
says for every state, the longest end of what was read that begins a label, where the next byte leads; each
state lists the labels that end there. One step of the table a byte, and of the listed labels
the one whose arc leaves the state that was reached before it: each byte string has one accepted path, so
one label at each place fits, and nothing is tried again. Whether two tokens are joined by an arc
is derived from the gadgets on first use and kept in a bounded table. Decoding emits
the labels of the arcs.

Cases: a null text counts as empty (no tokens); special strings in a text become
their own ids, as in the library's default; null and repeated ids and repeated rows keep
their rows; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import WordCache, slices

VOCABULARY = "byte_bpe_50k.json"
CACHE_WORDS, CACHE_ARCS = 250_000, 500_000
#: Fixed value: how byte-level BPE splits a text into words.
SPLIT = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
START = -1


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@cache
def byte_symbols() -> dict[int, str]:
    """The visible character that stands for each byte: itself where printable, else the
    next one from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Automaton:
    def __init__(self, vocab: dict[str, int], merges: list, special: dict[str, int]):
        byte_of = {c: b for b, c in byte_symbols().items()}
        label = {t: bytes(byte_of[c] for c in t) for t in vocab}
        self.labels = {i: label[t] for t, i in vocab.items()} | {
            i: t.encode() for t, i in special.items()}
        self.special = special
        self.left, self.right, self.born, self.cut = {}, {}, {START: -1}, {}
        self.arcs: dict[int, bool] = {}
        self.token: dict[bytes, int] = {}
        for c, b in byte_of.items():
            self.born[vocab[c]] = -1
            self.token[bytes([b])] = vocab[c]
        for time, rule in enumerate(merges):
            a, b = rule.split(" ") if isinstance(rule, str) else rule
            self._add_gadget(time, vocab[a], vocab[b], vocab[a + b], label[a + b])
        self._compile()

    def _compile(self) -> None:
        """``step``: the state behind state * 256 + byte; ``ends``: the (token, length) of the labels that
        end in a state, the longest first. Made level by level of the labels' tree."""
        children: dict[int, int] = {}
        own, depth = [None], [0]
        for label, t in self.token.items():
            at = 0
            for n, byte in enumerate(label, 1):
                key = at << 8 | byte
                at = children.get(key)
                if at is None:
                    at = children[key] = len(own)
                    own.append(None)
                    depth.append(n)
            own[at] = (t, len(label))
        keys, states = (np.fromiter(x, np.int64, len(children)) for x in (children.keys(), children.values()))
        order = np.argsort(np.array(depth)[states], kind="stable")
        keys, states = keys[order], states[order]
        levels = np.array(depth)[states]
        step = np.zeros((len(own), 256), np.int32)
        other = np.zeros(len(own), np.int64)  # the next shorter end that begins a label
        self.ends: list[tuple] = [()] * len(own)
        step[0, keys[levels == 1] & 255] = states[levels == 1]
        for level in range(1, int(levels.max()) + 1):
            here = states[levels == level]
            step[here] = step[other[here]]
            for state in here.tolist():
                shorter = self.ends[other[state]]
                self.ends[state] = (own[state], *shorter) if own[state] else shorter
            below = levels == level + 1
            parent, byte, child = keys[below] >> 8, keys[below] & 255, states[below]
            other[child] = step[other[parent], byte]
            step[parent, byte] = child
        self.step = memoryview(step.reshape(-1))

    def _add_gadget(self, time: int, a: int, b: int, t: int, label: bytes) -> None:
        if a in self.born and b in self.born and t not in self.born and self._open(a, b, time):
            self.left[t], self.right[t], self.born[t] = a, b, time
            self.token[label] = t
            self.cut[a, b] = time

    def _open(self, p: int, t: int, before: int) -> bool:
        """Whether the state behind p has an arc t when the rules below ``before`` have acted."""
        while True:
            if self.cut.get((p, t), before) < before:
                return False
            if self.born[p] > self.born[t]:  # p was made when t was there: ask its last part
                before, p = self.born[p], self.right[p]
            elif self.born[t] >= 0:  # a rule meets its own left part first, hence + 1
                before, t = self.born[t] + 1, self.left[t]
            else:
                return True

    def has_arc(self, p: int, t: int) -> bool:
        key = (p + 1) << 32 | t
        found = self.arcs.get(key)
        if found is None:
            if len(self.arcs) >= CACHE_ARCS:
                self.arcs.clear()
            found = self.arcs[key] = self._open(p, t, 1 << 60)
        return found

    def encode_word(self, word: bytes) -> list[int]:
        """The accepted path that spells the word."""
        step, ends, has_arc, state = self.step, self.ends, self.has_arc, 0
        behind, sizes = [START], [0]  # the last token of each prefix, and its length
        for at, byte in enumerate(word, 1):
            state = step[state << 8 | byte]
            for t, size in ends[state]:
                if has_arc(behind[at - size], t):
                    break
            behind.append(t)
            sizes.append(size)
        path, at = [], len(word)
        while at:
            path.append(behind[at])
            at -= sizes[at]
        path.reverse()
        return path

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.labels.__getitem__, ids))


class Tokenizer:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        model = spec["model"]
        self.automaton = Automaton(model["vocab"], model["merges"], special)
        self.words = WordCache(self._word, CACHE_WORDS)
        longest_first = sorted(special, key=len, reverse=True)
        self.cuts = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")") \
            if special else None

    def _word(self, word: str) -> bytes:
        return np.array(self.automaton.encode_word(word.encode()), np.int32).tobytes()

    def encode(self, text: str) -> np.ndarray:
        find, ids = self.words.__getitem__, []
        for i, part in enumerate(self.cuts.split(text) if self.cuts else [text]):
            if i % 2:
                ids.append(np.int32(self.automaton.special[part]).tobytes())
            else:
                ids += map(find, SPLIT.findall(part))
        return np.frombuffer(b"".join(ids), np.int32)

    def decode(self, ids: np.ndarray) -> str:
        return self.automaton.decode(ids.tolist()).decode("utf-8", "replace")


@cache
def tokenizer(path: str) -> Tokenizer:
    """Compiled once in each worker process."""
    return Tokenizer(path)


def encode(docs: DataFrame, path: str | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, ids (array of int), decoded (the
    text that the ids give), and the columns of ``docs`` named in ``keep``."""
    path = path or vocabulary_path()
    kinds = [(c, docs.schema[c].dataType.simpleString()) for c in ("doc_id", *keep)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokenizer(path)
        for batch in slices(batches, 128):
            ids = [coder.encode(t) for t in batch.column(0).to_pylist()]
            ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids)))
            yield pa.RecordBatch.from_arrays(
                [lists, pa.array([coder.decode(i) for i in ids], pa.string()), *batch.columns[1:]],
                ["ids", "decoded", *(c for c, _ in kinds)])

    found = docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_text"),
                        *(c for c, _ in kinds)).mapInArrow(
        run, "ids array<int>, decoded string, " + ", ".join(f"{c} {k}" for c, k in kinds))
    return found.select("doc_id", "ids", "decoded", *keep)


def digests(encoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of encoded documents, and their other columns."""
    rest = [c for c in encoded.columns if c not in ("doc_id", "ids", "decoded")]
    return encoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256)
        .alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"), *rest)

"""Token counts: greedy longest-match piece counts from a linear-time automaton.

A vocabulary trie gets a failure link and a popped-token count for every node:
when no edge fits the next byte, the automaton follows the link, which stands
for "the longest pieces that cover what was read are cut off, the rest goes
on", and adds the count of pieces cut.  Each byte is read once, no piece is
ever built, and the count equals greedy longest-match-first segmentation.

A vocabulary with word-end marks has pieces for the inside of words and pieces
for their ends: an inner piece never ends a word, and a final one only ends it.
Every node therefore also holds the number of pieces that its string takes when
the word ends there; without marks every piece may stand in both places.

Node arrays are built once on the driver from the vocabulary file (its size
bounds them) and broadcast.  Texts are counted in Arrow batches: the distinct
words of a batch advance through the automaton together, one byte position a
step, as numpy arrays.

A null or blank text has 0 words and 0 tokens.  A word that the vocabulary
cannot cover counts as one unknown token.  Words are whole: no length cap.
Repeated rows are counted each on their own; an empty table gives an empty
result; other columns of the input are not read.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = "/opt/tokenizers/word_bpe_49k.json"
#: Words of a batch go through the automaton in groups of at most so many bytes.
STEP_BYTES = 1 << 22


@dataclass(frozen=True)
class Automaton:
    """Edges (sorted ``node * 256 + byte`` keys with their targets), failure link
    (-1: none), popped count and number of pieces at a word's end (-1: none cover it)
    of every node.  Node 0 is the root."""

    keys: np.ndarray
    targets: np.ndarray
    fail: np.ndarray
    pops: np.ndarray
    ends: np.ndarray


def build(pieces: Iterable[bytes], final: Iterable[bytes] | None = None) -> Automaton:
    """The automaton of a vocabulary; empty pieces are ignored.  ``final`` are the pieces
    that end a word if others do than those inside (``pieces``)."""
    inside = {p for p in pieces if p}
    closing = inside if final is None else {p for p in final if p}
    edges: list[dict[int, int]] = [{}]
    strings = [b""]
    for piece in sorted(inside | closing):
        node = 0
        for n, byte in enumerate(piece, 1):
            node = edges[node].setdefault(byte, len(edges))
            if node == len(edges):
                edges.append({})
                strings.append(piece[:n])
    inner = [s in inside for s in strings]
    at_end: dict[bytes, int] = {b"": 0}

    def pieces_to_end(s: bytes) -> int:  # as deep as a piece is long
        if s not in at_end:
            cut = len(s) if s in closing else next((n for n in range(len(s) - 1, 0, -1) if s[:n] in inside), 0)
            rest = pieces_to_end(s[cut:]) if cut else -1
            at_end[s] = rest + 1 if rest >= 0 else -1
        return at_end[s]

    ends = [pieces_to_end(s) for s in strings]
    fail, pops = [-1] * len(edges), [0] * len(edges)
    level = [0]
    while level:  # breadth first: links point to shorter strings
        below = []
        for u in level:
            for byte, v in edges[u].items():
                below.append(v)
                if inner[v]:
                    fail[v], pops[v] = 0, 1
                    continue
                z, n = fail[u], pops[u]
                while z >= 0 and byte not in edges[z]:
                    n += pops[z]
                    z = fail[z]
                if z >= 0:
                    fail[v], pops[v] = edges[z][byte], n
        level = below
    flat = sorted((u * 256 + b, v) for u, e in enumerate(edges) for b, v in e.items())
    keys, targets = (np.array(x, np.int64) for x in (zip(*flat, strict=True) if flat else ((), ())))
    return Automaton(keys, targets, np.array(fail, np.int64), np.array(pops, np.int64), np.array(ends, np.int64))


def count_words(a: Automaton, words: list[bytes]) -> np.ndarray:
    """Number of greedy longest-match pieces of each word (1 if it cannot be covered)."""
    out = np.ones(len(words), np.int64)
    if not len(a.keys):
        return out
    length = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(-length, kind="stable")
    lo = 0
    while lo < len(order):
        # neighbours in length order share one padded matrix of bounded size
        hi = lo + max(1, STEP_BYTES // max(1, int(length[order[lo]])))
        part = order[lo:hi]
        out[part] = _lockstep(a, [words[i] for i in part], length[part])
        lo = hi
    return out


def _lockstep(a: Automaton, words: list[bytes], length: np.ndarray) -> np.ndarray:
    joined = np.frombuffer(b"".join(words), np.uint8)
    first = np.concatenate(([0], np.cumsum(length)[:-1]))
    state, count = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
    broken = np.zeros(len(words), bool)
    for t in range(int(length[0]) if len(length) else 0):
        alive = np.flatnonzero((length > t) & ~broken)  # longest first: a prefix of the words
        if not len(alive):
            break
        byte = joined[first[alive] + t].astype(np.int64)
        while len(alive):
            key = state[alive] * 256 + byte
            at = np.searchsorted(a.keys, key)
            at[at == len(a.keys)] = 0
            hit = a.keys[at] == key
            state[alive[hit]] = a.targets[at[hit]]
            alive, byte = alive[~hit], byte[~hit]
            link = a.fail[state[alive]]
            broken[alive[link < 0]] = True
            alive, byte, link = alive[link >= 0], byte[link >= 0], link[link >= 0]
            count[alive] += a.pops[state[alive]]
            state[alive] = link
    last = a.ends[state]
    return np.where(broken | (last < 0), 1, count + last)


def read_marked_vocabulary(path: str = VOCABULARY, mark: str = "</w>") -> tuple[list[bytes], list[bytes]]:
    """Pieces for the inside of words and pieces for their ends (those that carry ``mark``)
    of a byte-level word vocabulary (``model.vocab`` of a tokenizer file), as bytes."""
    # byte-level vocabularies write printable bytes as themselves and the rest as
    # the characters from 256 on, in byte order
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}
    with open(path, encoding="utf-8") as f:
        vocab = [p for p in json.load(f)["model"]["vocab"] if not p.startswith("<|")]

    def as_bytes(pieces: Iterable[str]) -> list[bytes]:
        return sorted({bytes(of[c] for c in p) for p in pieces if p and all(c in of for c in p)})

    return as_bytes(p for p in vocab if not p.endswith(mark)), as_bytes(p.removesuffix(mark) for p in vocab if p.endswith(mark))


def read_vocabulary(path: str = VOCABULARY) -> list[bytes]:
    """Distinct piece strings of a byte-level word vocabulary, word-end marks removed."""
    inside, final = read_marked_vocabulary(path)
    return sorted({*inside, *final})


def token_counts(df: DataFrame, pieces: Iterable[bytes], id_col: str = "doc_id", text: str = "text", final: Iterable[bytes] | None = None) -> DataFrame:
    """``doc_id, n_words, n_tokens``: A-Z lower-cased words between ASCII white space.
    ``final``: the pieces at the ends of words, if others than ``pieces``."""
    spark = df.sparkSession
    built = build(pieces, final)
    # plain arrays: executors need no class of this package to read them
    shared = spark.sparkContext.broadcast((built.keys, built.targets, built.fail, built.pops, built.ends))
    narrow = df.select(F.col(id_col).alias("doc_id"), F.col(text).cast("string").alias("text"))
    schema = f"doc_id {narrow.schema['doc_id'].dataType.simpleString()}, n_words bigint, n_tokens bigint"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        a = Automaton(*shared.value)
        for batch in batches:
            number: dict[bytes, int] = {}
            each = []
            for t in batch["text"]:
                each.append(np.array([number.setdefault(w, len(number)) for w in t.encode().lower().split()] if t is not None else [], np.int64))
            counts = count_words(a, list(number))
            batch["n_words"] = [len(x) for x in each]
            batch["n_tokens"] = [int(counts[x].sum()) for x in each]
            yield batch[["doc_id", "n_words", "n_tokens"]]

    return narrow.mapInPandas(run, schema)

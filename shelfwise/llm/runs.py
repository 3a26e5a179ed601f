"""Periodic runs of words: stretches that repeat one and the same word sequence, and texts with them collapsed.

Every document is searched on its own, by the runs theorem: a run with period ``p`` starts a Lyndon word of ``p`` words
at some place, in the order of the words or in its reverse, and that word is the longest Lyndon word starting there.
So each place gives at most two candidates, whose periods are extended to both sides by longest common extensions.
These are constant-time lookups: the string depth of a lowest common ancestor in the suffix tree of the document, and
of its reversal for the left side, read as the minimum of a range of the tree's Euler tour.

A pair of neighbouring words inside a run stands there once in every period, so three times or more as the exponent is
at least four.  Pairs that are rarer in their stretch of the document close that stretch, over and over until none is
left; only what remains goes into the trees, which is exact and leaves most prose out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from shelfwise.llm.common import as_bytes, keyed, pieces


class Ids(dict):
    """Numbers for words, in the order of their first appearance."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


class SuffixTree:
    """Ukkonen's tree of a sequence of whole numbers whose last one is unique, with constant-time extensions."""

    def __init__(self, text: list[int], heads: int):
        """Symbols below ``heads`` are separators, each of which stands once in the text."""
        self.text, self.heads, self.wide = text, heads, max(text) + 1
        self._grow()
        self._tour()

    def _grow(self) -> None:
        text, wide, n = self.text, self.wide, len(self.text)
        start, end, link, suffix = [0], [0], [0], [-1]
        edges: dict[int, int] = {}  # parent * wide + first symbol: child
        node = at = length = rest = 0
        for i, symbol in enumerate(text):
            rest += 1
            waiting = 0  # an inner node of this step whose suffix link is still open
            while rest:
                if not length:
                    at = i
                key = node * wide + text[at]
                child = edges.get(key)
                if child is None:
                    edges[key] = len(start)
                    start.append(i)
                    end.append(n)
                    link.append(0)
                    suffix.append(i - rest + 1)
                    if waiting:
                        link[waiting] = node
                    waiting = node
                else:
                    first = start[child]
                    size = end[child] - first
                    if length >= size:
                        node = child
                        at += size
                        length -= size
                        continue
                    if text[first + length] == symbol:
                        length += 1
                        if waiting:
                            link[waiting] = node
                        break
                    middle = len(start)
                    edges[key] = middle
                    edges[middle * wide + symbol] = middle + 1
                    edges[middle * wide + text[first + length]] = child
                    start += (first, i)
                    end += (first + length, n)
                    link += (0, 0)
                    suffix += (-1, i - rest + 1)
                    start[child] = first + length
                    if waiting:
                        link[waiting] = middle
                    waiting = middle
                rest -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    at = i - rest + 1
        self.size = [e - s for s, e in zip(start, end)]
        self.suffix = suffix
        keys = np.fromiter(edges.keys(), np.int64, len(edges))
        children = np.fromiter(edges.values(), np.int64, len(edges))
        order = np.argsort(keys)
        self.parent, self.symbol = np.divmod(keys[order], wide)
        self.child = children[order]

    def _families(self, order: np.ndarray) -> tuple[list[int], list[int]]:
        """Children of all nodes side by side, last one first, and where each node's begin."""
        begins = np.searchsorted(self.parent[order], np.arange(len(self.size) + 1)).tolist()
        return self.child[order].tolist(), begins

    def _tour(self) -> None:
        """String depths along the Euler tour, as a table of range minima; the suffixes' places; their ranks."""
        backwards = np.lexsort((-self.symbol, self.parent))
        children, begins = self._families(backwards)
        size, suffix = self.size, self.suffix
        tour, place, ranked = [], [0] * len(self.text), []
        stack = [(0, 0)]
        while stack:
            node, depth = stack.pop()
            if node >= 0:
                depth += size[node]
                if suffix[node] >= 0:
                    place[suffix[node]] = len(tour)
                    ranked.append(suffix[node])
                for c in children[begins[node] : begins[node + 1]]:
                    stack.append((c, depth))
                    stack.append((-1, depth))
            tour.append(depth)
        self.place = np.array(place)
        self.rank = np.empty(len(self.text), dtype=np.int64)
        self.rank[ranked] = np.arange(len(ranked))
        rows = [np.array(tour, dtype=np.int32)]
        while 1 << len(rows) <= len(tour):
            step, low = 1 << (len(rows) - 1), rows[-1]
            rows.append(np.minimum(low[:-step], low[step:]))
        self.minima = rows

    def reversed_ranks(self) -> np.ndarray:
        """Ranks of the suffixes in the reverse order of the words; separators stay before all words."""
        symbol = np.where(self.symbol < self.heads, self.symbol + self.wide, self.symbol)
        children, begins = self._families(np.lexsort((symbol, self.parent)))
        suffix, ranked, stack = self.suffix, [], [0]
        while stack:
            node = stack.pop()
            if suffix[node] >= 0:
                ranked.append(suffix[node])
            stack += children[begins[node] : begins[node + 1]]
        rank = np.empty(len(self.text), dtype=np.int64)
        rank[ranked] = np.arange(len(ranked))
        return rank

    def extensions(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many symbols the suffixes at ``a`` and ``b`` (never the same) have in common."""
        x, y = self.place[a], self.place[b]
        low, high = np.minimum(x, y), np.maximum(x, y)
        level = np.frexp(high - low + 1)[1] - 1
        out = np.empty(len(low), dtype=np.int64)
        for k in np.unique(level).tolist():
            own, row = level == k, self.minima[k]
            out[own] = np.minimum(row[low[own]], row[high[own] - (1 << k) + 1])
        return out


def lyndon_ends(rank: np.ndarray) -> np.ndarray:
    """The next smaller suffix of every suffix: where the longest Lyndon word that starts there ends."""
    ranks, stack = rank.tolist(), []
    ends = [len(ranks)] * len(ranks)
    for i in range(len(ranks) - 1, -1, -1):
        own = ranks[i]
        while stack and ranks[stack[-1]] > own:
            stack.pop()
        if stack:
            ends[i] = stack[-1]
        stack.append(i)
    return np.array(ends)


def find_runs(stretches: list[np.ndarray], min_length: int, min_exponent: int) -> np.ndarray:
    """Rows (stretch, start in it, length, period) of all runs of a document's stretches of word numbers."""
    count = len(stretches)
    bounds = np.cumsum([0] + [len(s) + 1 for s in stretches])
    text = np.empty(bounds[-1], dtype=np.int64)
    words = np.unique(np.concatenate(stretches), return_inverse=True)[1] + count + 1
    owner = np.repeat(np.arange(count), np.diff(bounds))
    ends = bounds[1:] - 1
    text[ends] = np.arange(count)
    inner = np.ones(len(text), dtype=bool)
    inner[ends] = False
    text[inner] = words
    n = len(text)
    tree = SuffixTree(text.tolist(), count + 1)
    mirror = SuffixTree(text[::-1].tolist() + [count], count + 1)
    found = []
    for rank in (tree.rank, tree.reversed_ranks()):
        at = np.flatnonzero(inner)
        period = lyndon_ends(rank)[at] - at
        right = tree.extensions(at, at + period)
        left = mirror.extensions(n - at, n - at - period)
        length = left + period + right
        good = (length >= min_length) & (length >= min_exponent * period)
        found.append(np.stack([at - left, length, period], axis=1)[good])
    rows = np.unique(np.concatenate(found), axis=0)
    own = owner[rows[:, 0]]
    return np.column_stack([own, rows[:, 0] - bounds[own], rows[:, 1:]])


def crowded_stretches(words: np.ndarray, doc: np.ndarray, min_length: int, min_exponent: int) -> list[tuple[int, int]]:
    """Word ranges [start, end) that can hold runs: every pair of neighbours repeats often enough within its range."""
    least = min_exponent - 1
    pair = words[:-1] * (int(words.max(initial=0)) + 1) + words[1:]
    at = np.flatnonzero(doc[:-1] == doc[1:])
    pair = np.unique(pair[at], return_inverse=True)[1]
    own, size = doc[at], int(pair.max(initial=0)) + 1
    while len(at):
        _, kind, times = np.unique(own * size + pair, return_inverse=True, return_counts=True)
        alive = times[kind] >= least
        at, own, pair, before = at[alive], own[alive], pair[alive], len(at)
        opens = np.ones(len(at), dtype=bool)
        opens[1:] = (np.diff(at) != 1) | (np.diff(own) != 0)
        own = np.cumsum(opens) - 1
        long = np.bincount(own, minlength=1)[own] >= min_length - 1
        at, own, pair = at[long], own[long], pair[long]
        if len(at) == before:
            break
    starts = np.flatnonzero(np.diff(own, prepend=-1))
    return list(zip(at[starts].tolist(), (at[np.append(starts[1:], len(at)) - 1] + 2).tolist())) if len(at) else []


def batch_runs(texts: list[bytes], min_length: int, min_exponent: int) -> list[tuple[list[bytes], np.ndarray]]:
    """Words of every text, and its runs as sorted rows (start, length, period)."""
    cut = [t.split() for t in texts]
    ids, sizes = Ids(), [len(c) for c in cut]
    words = np.fromiter((ids[w] for c in cut for w in c), np.int64, sum(sizes))
    doc = np.repeat(np.arange(len(cut)), sizes)
    first = np.concatenate([[0], np.cumsum(sizes)])
    by_doc: dict[int, list[tuple[int, int]]] = {}
    for start, end in crowded_stretches(words, doc, min_length, min_exponent):
        by_doc.setdefault(int(doc[start]), []).append((start, end))
    out = []
    for d, own in enumerate(cut):
        rows = np.empty((0, 3), dtype=np.int64)
        if d in by_doc:
            spans = by_doc[d]
            found = find_runs([words[a:b] for a, b in spans], min_length, min_exponent)
            starts = np.array([a for a, _ in spans])[found[:, 0]] + found[:, 1] - first[d]
            rows = np.column_stack([starts, found[:, 2:]])
            rows = rows[np.lexsort((rows[:, 2], rows[:, 0]))]
        out.append((own, rows))
    return out


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words joined by spaces, without those that some run holds behind its first period."""
    if not len(runs):
        return b" ".join(words)
    cover = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(cover, runs[:, 0] + runs[:, 2], 1)
    np.add.at(cover, runs[:, 0] + runs[:, 1], -1)
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(cover[:-1]) == 0).tolist()])


RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def periodic_runs(
    docs: DataFrame, min_length: int = 6, min_exponent: int = 4, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per input row: the id, ``n_words``, ``runs`` (start, length, period; by start, then period), ``kept_text``.

    Words are runs of bytes other than space and 0x09-0x0D, compared byte by byte and numbered from 0.  A run is a
    stretch with smallest period ``p`` of at least ``min_length`` words and ``min_exponent * p`` words that cannot be
    extended; ``kept_text`` leaves out the words that some run holds behind its first ``p``, joined by one space.
    Runs may overlap, and all of them count.  A null, empty or blank text has no words and no runs.  Rows are judged
    one by one, so repeated rows and null ids give a row each.  An empty table gives an empty result; other columns
    are not read.  A task holds the trees of one document at a time, in proportion to its words.
    """
    if min_exponent < 3 or min_length < 2:
        raise ValueError("runs need an exponent of at least 3 and at least 2 words")
    rows = keyed(docs, id_col, text_col)
    key = rows.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in pieces(batches, 2000, 4_000_000):
            found = batch_runs(as_bytes(some.column(1)), min_length, min_exponent)
            every = np.concatenate([r for _, r in found]) if found else np.empty((0, 3), dtype=np.int64)
            bounds = np.concatenate([[0], np.cumsum([len(r) for _, r in found])])
            runs = pa.StructArray.from_arrays([pa.array(every[:, k]) for k in range(3)], fields=list(RUN))
            yield pa.RecordBatch.from_arrays(
                [
                    some.column(0),
                    pa.array([len(w) for w, _ in found], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), runs),
                    pa.array([collapsed(w, r) for w, r in found], pa.binary()).cast(pa.string()),
                ],
                names=["_id", "n_words", "runs", "kept_text"],
            )

    fields = "n_words long, runs array<struct<start:long,length:long,period:long>>, kept_text string"
    return rows.mapInArrow(run, f"_id {key}, {fields}").withColumnRenamed("_id", id_col)

"""URL rules as one wildcard automaton: every pattern advances with each symbol, in the bits of a few words.

A URL is read as a row of symbols: a boundary, the host's bytes, a boundary, the path's bytes.  Rules become glob
patterns over those symbols.  All patterns stand one after another in 64-bit words; a step shifts every state by one,
carries across words, and masks with the symbol's row (Shift-And).  Many URLs step at the same time.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BOUNDARY = 256  # a symbol that no byte equals
ANY, STAR = -1, -2
ONE = np.uint64(1)


@dataclass(frozen=True)
class Rule:
    """``text`` is host and path, as ``example.com/en/``; ``*`` and ``?`` in it are wildcards inside host or path."""

    text: str
    verdict: str

    def symbols(self) -> list[int]:
        """The pattern: any subdomains, the host, a boundary, the path's start, anything after."""
        host, slash, path = self.text.partition("/")
        wild = {ord("*"): STAR, ord("?"): ANY}
        part = lambda s: [wild.get(b, b) for b in s.encode()]
        return [BOUNDARY, STAR, ord("."), *part(host), BOUNDARY, *part(slash + path), STAR]


class Automaton:
    """Bit rows of all patterns; bit p is set when a pattern's first symbols up to p have been read."""

    def __init__(self, patterns: Sequence[Sequence[int]]):
        size = sum(sum(s != STAR for s in p) for p in patterns)
        self.words = max(1, -(-size // 64))
        self.mask = np.zeros((257, self.words), dtype=np.uint64)
        self.loop, self.start = np.zeros(self.words, dtype=np.uint64), np.zeros(self.words, dtype=np.uint64)
        self.final: list[int] = []
        at = 0
        for pattern in patterns:
            self._set(self.start, at)
            for symbol in pattern:
                if symbol == STAR:
                    self._set(self.loop, at - 1)  # stays there for any further byte
                    continue
                for s in range(256) if symbol == ANY else [symbol]:
                    self._set(self.mask[s], at)
                at += 1
            self.final.append(at - 1)

    @staticmethod
    def _set(row: np.ndarray, bit: int) -> None:
        row[bit // 64] |= ONE << np.uint64(bit % 64)

    def run(self, texts: list[np.ndarray]) -> np.ndarray:
        """For every symbol row: which patterns have matched it whole, as booleans."""
        order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
        lengths = np.array([len(texts[i]) for i in order])
        states = np.zeros((len(texts), self.words), dtype=np.uint64)
        offsets = np.concatenate([[0], np.cumsum(lengths)])[:-1]
        flat = np.concatenate([texts[i] for i in order]) if texts else np.zeros(0, dtype=np.int64)
        alive = len(texts)
        for step in range(int(lengths.max(initial=0))):
            while alive and lengths[alive - 1] <= step:
                alive -= 1
            symbol, old = flat[offsets[:alive] + step], states[:alive]
            moved = old << ONE
            moved[:, 1:] |= old[:, :-1] >> np.uint64(63)
            moved &= ~self.start  # the last state of one pattern does not enter the next
            if step == 0:
                moved |= self.start
            stay = old & self.loop
            stay[symbol == BOUNDARY] = 0  # a wildcard does not run over a boundary
            states[:alive] = (moved & self.mask[symbol]) | stay
        hits = np.empty((len(texts), len(self.final)), dtype=bool)
        for k, bit in enumerate(self.final):
            hits[order, k] = (states[:, bit // 64] >> np.uint64(bit % 64) & ONE).astype(bool)
        return hits


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path: both empty for a null or a text without ``://``."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    before = F.substring_index(url, "://", 1)
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.char_length(before) + 4))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    empty = F.lit("")
    return F.coalesce(F.translate(host, upper, upper.lower()), empty), F.coalesce(path, empty)


def judge_urls(
    pages: DataFrame,
    rules: Sequence[Rule],
    default: str = "allow",
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """Per input row: the id, ``host``, ``path``, the longest ``rule`` that fits (or null) and its ``verdict``.

    A rule fits its host and all subdomains if the path starts with the rule's path; of equally long rules the first
    named wins.  Without a fitting rule the verdict is ``default``.  A null URL or one without ``://`` has an empty
    host and path and fits no rule; repeated rows and rows without id keep a row each; a very long URL is read whole;
    an empty table gives an empty result; other columns are not read.
    """
    rules = list(rules)
    rank = sorted(range(len(rules)), key=lambda i: (-len(rules[i].text), i))
    automaton = Automaton([rules[i].symbols() for i in rank])
    names = np.array([rules[i].text for i in rank] + [None], dtype=object)
    verdicts = np.array([rules[i].verdict for i in rank] + [default], dtype=object)
    rows = pages.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{url_col}`").cast("string").alias("_url"))
    host, path = url_parts(F.col("_url"))
    rows = rows.select("_id", host.alias("host"), path.alias("path"))
    key = rows.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edge = np.array([BOUNDARY])
        for part in batches:
            texts = [
                np.concatenate([edge, np.frombuffer(b"." + h.encode(), np.uint8), edge, np.frombuffer(p.encode(), np.uint8)])
                for h, p in zip(part.column(1).to_pylist(), part.column(2).to_pylist())
            ]
            hits = automaton.run(texts)
            first = np.where(hits.any(axis=1), hits.argmax(axis=1), len(rules)) if rules else np.zeros(len(texts), int)
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(names[first], pa.string()), pa.array(verdicts[first], pa.string())],
                names=["id", "host", "path", "rule", "verdict"],
            )

    found = rows.mapInArrow(run, f"id {key}, host string, path string, rule string, verdict string")
    return found.withColumnRenamed("id", id_col)

"""Language identification: spans of a text by Viterbi over per-word scores.

Training counts character trigrams of words (with word ends) per language over all labelled documents, hashed into a
table of fixed size, and the letters' scripts per language.  A word's scripts narrow the languages that may claim it;
the others get a word score from the trigram log-probabilities.  Viterbi with a penalty for every change of language
labels the words; the text's language is the one whose spans hold most letters.
"""

from __future__ import annotations

import re
import sys
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.common import keyed, pieces

SLOTS = 1 << 15  # trigram slots per language: the model's size does not grow with the corpus
CACHE = 200_000  # words held per task
PENALTY = 20.0  # nats that a change of language costs
UNKNOWN = "und"


def _numerals() -> list[tuple[int, int]]:
    """Ranges of the characters that patterns take for word characters without a digit, and that are no letters."""
    odd = [c for c in range(0x80, sys.maxunicode + 1) if (t := chr(c)).isnumeric() and not t.isalpha() and not t.isdecimal()]
    starts = [c for i, c in enumerate(odd) if i == 0 or odd[i - 1] != c - 1]
    ends = [c for i, c in enumerate(odd) if i + 1 == len(odd) or odd[i + 1] != c + 1]
    return list(zip(starts, ends))


NUMERALS = _numerals()
LETTER = r"[^\W\d_" + "".join(f"{chr(a)}-{chr(b)}" for a, b in NUMERALS) + "]"
WORD = re.compile(rf"{LETTER}+(?:['’]{LETTER}+)*")
PLAIN_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")  # the same, and quicker, for texts without such numerals


def word_patterns():
    """A function that gives the pattern of a text's words."""
    odd = np.zeros(sys.maxunicode + 1, dtype=bool)
    for a, b in NUMERALS:
        odd[a : b + 1] = True

    def pattern(text: str) -> re.Pattern:
        if text.isascii() or not odd[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)].any():
            return PLAIN_WORD
        return WORD

    return pattern


# fixed values: first code points of script ranges (Unicode blocks) and the script that begins there
SCRIPT_EDGES = (
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0780, "other"), (0x0900, "devanagari"), (0x0980, "indic"), (0x0E00, "thai"),
    (0x0E80, "other"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "other"), (0x1E00, "latin"),
    (0x1F00, "greek"), (0x2000, "other"), (0x3040, "kana"), (0x3100, "other"), (0x3400, "han"), (0xA000, "other"),
    (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "other"), (0x20000, "han"),
)
EDGES = np.array([e for e, _ in SCRIPT_EDGES])
SCRIPTS = sorted({s for _, s in SCRIPT_EDGES})
SCRIPT_AT = np.array([SCRIPTS.index(s) for _, s in SCRIPT_EDGES])


def trigram_slots(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Slots of every word's trigrams, one word after another, and where each word's begin."""
    flat = np.frombuffer("".join(f"\x02{w}\x03" for w in words).encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    sizes = np.array([len(w) for w in words])
    a = flat[:-2] * np.uint64(0x9E3779B1) + flat[1:-1] * np.uint64(0x85EBCA77) + flat[2:] * np.uint64(0xC2B2AE3D)
    a ^= a >> np.uint64(15)
    a *= np.uint64(0x27D4EB2F165667C5)
    slots = (a >> np.uint64(40)).astype(np.int64) % SLOTS
    ends = np.cumsum(sizes + 2)  # a word of n letters has n trigrams with its two end marks
    inside = np.ones(len(flat), dtype=bool)
    inside[ends - 1] = inside[ends - 2] = False
    return slots[inside[:-2]], np.concatenate([[0], np.cumsum(sizes)])[:-1]


def word_scripts(words: list[str]) -> np.ndarray:
    """Script of every word, by its first letter."""
    first = np.fromiter((ord(w[0]) for w in words), np.int64, len(words))
    return SCRIPT_AT[np.searchsorted(EDGES, first, side="right") - 1]


def held_out(id_col: Column) -> Column:
    return F.crc32(id_col.cast("string").cast("binary")) % 5 == 0


@dataclass
class Model:
    """``scores`` is (slots, languages), ``allowed`` is (scripts, languages): which languages use a script."""

    languages: list[str]
    scores: np.ndarray
    allowed: np.ndarray

    def shared(self, spark: SparkSession):
        """A broadcast of the plain parts: workers need no copy of this package to read it."""
        return spark.sparkContext.broadcast((self.languages, self.scores, self.allowed))

    def words(self, words: list[str]) -> np.ndarray:
        """Log-probability of every word in every language; languages that do not use its script are out."""
        slots, starts = trigram_slots(words)
        out = np.add.reduceat(self.scores[slots], starts, axis=0)
        usable = self.allowed[word_scripts(words)]
        usable[~usable.any(axis=1)] = True  # a script that no language was learned with narrows nothing
        return np.where(usable, out, out.min(axis=1, keepdims=True) - 50.0)


def train(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> Model:
    """Counts over all given documents with text and language; the driver gets one row per language and slot."""
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    rows = rows.select(F.col(f"`{lang_col}`").cast("string").alias("lang"), F.col(f"`{text_col}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}

        def add(lang: str, counted: Counter) -> None:
            words = list(counted)
            times = np.fromiter(counted.values(), np.int64, len(words))
            slots, _ = trigram_slots(words)
            own = totals.setdefault(lang, np.zeros(SLOTS + len(SCRIPTS), dtype=np.int64))
            own += np.bincount(
                slots, np.repeat(times, [len(w) for w in words]), minlength=SLOTS + len(SCRIPTS)
            ).astype(np.int64)
            np.add.at(own, SLOTS + word_scripts(words), times)

        seen: dict[str, Counter] = {}
        pattern = word_patterns()
        for part in pieces(batches):
            for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                counted = seen.setdefault(lang, Counter())
                low = text.lower()
                counted.update(pattern(low).findall(low))
                if len(counted) > CACHE:
                    add(lang, seen.pop(lang))
        for lang, counted in seen.items():
            if counted:
                add(lang, counted)
        for lang, own in totals.items():
            used = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(used)), pa.array(used.astype(np.int32)), pa.array(own[used])],
                names=["lang", "slot", "n"],
            )

    summed = rows.mapInArrow(run, "lang string, slot int, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n"))
    found = summed.toPandas()
    languages = sorted(found["lang"].unique())
    counts = np.zeros((SLOTS + len(SCRIPTS), len(languages)))
    for k, lang in enumerate(languages):
        own = found[found["lang"] == lang]
        counts[own["slot"], k] = own["n"]
    grams, scripts = counts[:SLOTS] + 0.5, counts[SLOTS:]
    allowed = scripts > 0.001 * scripts.sum(axis=0, keepdims=True)
    return Model(languages, np.log(grams / grams.sum(axis=0, keepdims=True)).astype(np.float32), allowed)


def viterbi(scores: np.ndarray, penalty: float) -> np.ndarray:
    """Best language of every word, where each change of language costs ``penalty``.

    Whole texts in one language are told without walking them.  Take the best language overall, and what others gain
    over it in runs of words.  If no run anywhere gains the penalty, and the best run at the start and the best at the
    end do not gain it together, every path with a change pays more for its changes than its runs can gain.
    """
    n, k = scores.shape
    best = int(scores.sum(axis=0).argmax())
    run = np.cumsum(scores - scores[:, [best]], axis=0, dtype=np.float64)
    before = np.minimum.accumulate(np.vstack([np.zeros(k), run[:-1]]), axis=0)
    ends = max(0.0, run.max()) + max(0.0, (run[-1] - run).max())
    if (run - before).max() < penalty and ends < penalty:
        return np.full(n, best)
    rows = scores.astype(np.float64).tolist()
    now, seen = rows[0], []
    for row in rows[1:]:
        floor = max(now) - penalty
        seen.append(now)
        now = [(a if a >= floor else floor) + b for a, b in zip(now, row)]
    path = [now.index(max(now))]
    for now in reversed(seen):
        top = max(now)
        path.append(path[-1] if now[path[-1]] >= top - penalty else now.index(top))
    return np.array(path[::-1])


def label_spans(text: str | None, model: Model, score_of, penalty: float, pattern=None) -> tuple[str, float, list[dict]]:
    word = pattern(text or "") if pattern else WORD
    words = word.findall(text or "")
    if not words or not model.languages:
        return UNKNOWN, 0.0, []
    path = viterbi(score_of(" ".join(words).lower().split(" ")), penalty)
    letters = np.fromiter(map(len, words), np.int64, len(words))
    share = np.bincount(path, letters, minlength=len(model.languages))
    lang = int(share.argmax())
    edges = [0, *(np.flatnonzero(np.diff(path)) + 1).tolist(), len(words)]
    if len(edges) == 2:
        first, last = word.search(text).start(), text.rindex(words[-1]) + len(words[-1])
        places = [(first, last)]
    else:
        at = [m.span() for m in word.finditer(text)]
        places = [(at[a][0], at[b - 1][1]) for a, b in zip(edges, edges[1:])]
    spans = [{"start": p, "end": q, "lang": model.languages[path[a]]} for (p, q), a in zip(places, edges)]
    return model.languages[lang], float(share[lang] / share.sum()), spans


def _scorer(model: Model):
    """Scores of a text's words; every distinct word is scored once while the cache lasts."""
    index: dict[str, int] = {}
    table = np.zeros((0, len(model.languages)), dtype=np.float32)

    def score_of(words: list[str]) -> np.ndarray:
        nonlocal table
        new = list({w for w in words if w not in index})
        if len(index) + len(new) > CACHE:
            index.clear()
            new, table = list(set(words)), table[:0]
        if new:
            found = model.words(new)
            index.update(zip(new, range(len(index), len(index) + len(new))))
            have = len(index) - len(new)
            if len(index) > len(table):
                table = np.concatenate([table, np.zeros((max(len(index), 2 * len(table)) - len(table), table.shape[1]), np.float32)])
            table[have : len(index)] = found
        return table[np.fromiter(map(index.__getitem__, words), np.int64, len(words))]

    return score_of


def label_documents(
    docs: DataFrame, model: Model, penalty: float = PENALTY, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per input row: the id, ``lang_pred``, ``score`` (share of letters in its spans) and ``spans``.

    ``und`` with score 0 and no spans stands for a null text, one without letters, and for a model that has learned
    nothing.  Texts are read whole; repeated rows and rows without id keep a row each; ties go to the language that
    sorts first; an empty table gives an empty result; other columns are not read.
    """
    rows = keyed(docs, id_col, text_col)
    key = rows.schema["_id"].dataType.simpleString()
    shared = model.shared(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*shared.value)
        score_of, pattern = _scorer(model), word_patterns()
        for part in pieces(batches, 500):
            found = [label_spans(t, model, score_of, penalty, pattern) for t in part.column(1).to_pylist()]
            spans = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array([f[0] for f in found], pa.string()),
                    pa.array([f[1] for f in found], pa.float64()),
                    pa.array([f[2] for f in found], spans),
                ],
                names=["_id", "lang_pred", "score", "spans"],
            )

    schema = f"_id {key}, lang_pred string, score double, spans array<struct<start:int,end:int,lang:string>>"
    return rows.mapInArrow(run, schema).withColumnRenamed("_id", id_col)


def keep_identified(docs: DataFrame, model: Model, penalty: float = PENALTY, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose text has a recognised language."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        score_of, pattern = _scorer(model), word_patterns()
        for part in pieces(batches, 500):
            texts = part.column(place).to_pylist()
            yield part.filter(pa.array([label_spans(t, model, score_of, penalty, pattern)[0] != UNKNOWN for t in texts], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def label_languages(docs: DataFrame, penalty: float = PENALTY, id_col: str = "doc_id") -> DataFrame:
    """Learn from the labelled documents whose ``crc32(id as text) mod 5`` is not 0, then label all documents.

    Adds ``held_out`` (that remainder is 0; a null id counts as not held out and is not learned from).
    """
    model = train(docs.where(~held_out(F.col(id_col))))
    found = label_documents(docs, model, penalty, id_col)
    return found.select(
        id_col, F.coalesce(held_out(F.col(id_col)), F.lit(False)).alias("held_out"), "lang_pred", "score", "spans"
    )

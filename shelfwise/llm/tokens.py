"""Token ids and piece counts of whole texts, with what they have in common looked up once inside a task.

What lies in a plain Latin range is cut into pre-tokens here, by patterns that equal the library's own on that range;
each distinct pre-token then goes through the library once.  What lies outside (other scripts, combining marks, rare
white space) is cut by the library: for counts into its pre-tokens, for ids it takes whole words.  Texts with special
strings go through it whole.
"""

from __future__ import annotations

import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CACHE = 600_000  # words held per task; when full the table starts anew, which changes no result

# fixed values: the pre-token patterns of the two tokenizer files, on the plain range (the first one in lower case);
# letter runs stand first, as no other alternative can begin with a letter
LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
WORD_PATTERN = rf"[a-zß-öø-ɏ]+|[0-9]|'s|'t|'re|'ve|'m|'ll|'d|[^\s{LETTERS}0-9]+"
BYTE_PATTERN = rf" ?[{LETTERS}]+| ?[0-9]+|'s|'t|'re|'ve|'m|'ll|'d| ?[^\s{LETTERS}0-9]+|\s+(?!\S)|\s+"

READY = "\0"  # stands in no pre-token of the plain range; before one that is written as the model reads it
OTHER = r"[^\t\n\r -~À-įı-ɏ]"  # a character outside the plain range


def load(path: str):
    """The tokenizer with one thread: Spark's tasks are the parallelism."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class PreTokens:
    """Cuts texts into the pre-tokens of one of the two tokenizer kinds, told apart by their normaliser."""

    def __init__(self, path: str):
        self.tokenizer = load(path)
        self.lower = self.tokenizer.normalizer is not None
        self.findall = re.compile(WORD_PATTERN if self.lower else BYTE_PATTERN).findall
        self.other = re.compile(OTHER).search
        found = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = "|".join(re.escape(t) for t in found) or r"[^\s\S]"
        self.holds_special = re.compile(self.special).search
        probe = "It's 12.5%, I'M  here \n\n  now: ÀÉß_x__ ça\tva? 'LL end  "
        if self.counts(cut := self.split(probe)) != [len(self.encode(t)) for t in cut] or [
            i for t in cut for i in self.encode(t)
        ] != self.encode(probe):
            raise ValueError(f"{path} cuts texts by other patterns")

    def encode(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def split(self, text: str) -> list[str] | None:
        """Pre-tokens in order, or None for a text with special strings, which the library has to take whole.

        Those of a text outside the plain range come from the library's own normaliser and pre-tokenizer, as the model
        reads them, behind a mark.
        """
        if self.holds_special(text):
            return None
        if self.other(text):
            own = self.tokenizer.normalizer
            cut = self.tokenizer.pre_tokenizer.pre_tokenize_str(own.normalize_str(text) if own else text)
            return [READY + t for t, _ in cut]
        return self.findall(text.lower() if self.lower else text)

    def tokens(self, distinct: list[str]) -> list:
        """The library's tokens of each pre-token: the bare model where bytes stand for themselves."""
        model, out = self.tokenizer.model.tokenize, [None] * len(distinct)
        rest = []
        for i, t in enumerate(distinct):
            if t[0] == READY:
                out[i] = model(t[1:])
            elif t.isascii() and not t.isspace():
                out[i] = model("Ġ" + t[1:] if t[0] == " " else t)
            else:
                rest.append(i)
        for i, e in zip(rest, self.tokenizer.encode_batch_fast([distinct[i] for i in rest], add_special_tokens=False)):
            out[i] = e
        return out

    def counts(self, distinct: list[str]) -> list[int]:
        return [len(x) for x in self.tokens(distinct)]


class WordEncoder(PreTokens):
    """Little-endian unsigned 32-bit ids of whole texts, for a tokenizer that drops white space.

    No token reaches over white space, nor from a letter to a mark after it, so texts are split there and every distinct
    word is encoded once: a plain one by its pre-tokens, any other by the library.  What texts hold is then a list of
    places in a table of words, from which their ids are gathered.  Texts with special strings go to the library whole.
    """

    def __init__(self, path: str):
        super().__init__(path)
        if not self.lower:
            raise ValueError(f"{path} keeps white space")
        from tokenizers import pre_tokenizers

        shown = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        # how the model writes the bytes of the plain characters beyond ASCII
        self.table = {c: shown(chr(c))[0][0] for c in range(0xC0, 0x250)}
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.flat, self.bounds = np.empty(0, dtype="<u4"), np.zeros(1, dtype=np.int64)

    def _add(self, new: list[str]) -> None:
        """Ids of words whose ASCII letters are in lower case."""
        model, cut, table = self.tokenizer.model.tokenize, self.findall, self.table
        odd = [w for w in new if self.other(w)]
        rest = dict(zip(odd, self.tokenizer.encode_batch_fast(odd, add_special_tokens=False)))
        ids = [
            rest[w].ids
            if w in rest
            else [x.id for t in cut(w if w.isascii() else w.lower()) for x in model(t if t.isascii() else t.translate(table))]
            for w in new
        ]
        self.place.update(zip(new, range(len(self.place), len(self.place) + len(new))))
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        self.flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(ids), "<u4", int(sizes.sum()))])
        self.bounds = np.concatenate([self.bounds, self.bounds[-1] + np.cumsum(sizes)])

    def batch(self, texts: pa.Array | list[str | None]) -> list[bytes]:
        """Ids of every text; a null is an empty text."""
        texts = pa.array(texts, pa.string()) if isinstance(texts, list) else texts
        texts = texts.fill_null("")
        special = pc.match_substring_regex(texts, self.special)
        apart = pc.replace_substring_regex(pc.ascii_lower(texts), "([a-z])([,.;:!?])", r"\1 \2")
        cut = pc.ascii_split_whitespace(pc.if_else(special, "", apart))
        words, ends = cut.flatten().dictionary_encode(), cut.offsets.to_numpy()
        distinct = words.dictionary.to_numpy(zero_copy_only=False).tolist()
        known = list(map(self.place.get, distinct))
        new = [w for w, p in zip(distinct, known) if p is None]
        if len(self.place) + len(new) > CACHE:
            self.clear()
            new, known = distinct, [None] * len(distinct)
        added = iter(range(len(self.place), len(self.place) + len(new)))
        self._add(new)
        places = np.array([next(added) if p is None else p for p in known], dtype=np.int64)[words.indices.to_numpy()]
        first, size = self.bounds[places], self.bounds[places + 1] - self.bounds[places]
        stops = np.concatenate([[0], np.cumsum(size)])
        ids = self.flat[np.repeat(first - stops[:-1], size) + np.arange(stops[-1])]
        at = stops[ends - ends[0]].tolist()
        out = [ids[a:b].tobytes() for a, b in zip(at, at[1:])]
        for i in np.flatnonzero(special.to_numpy(zero_copy_only=False)).tolist():
            out[i] = np.array(self.encode(texts[i].as_py()), dtype="<u4").tobytes()
        return out

    def ids(self, text: str | None) -> bytes:
        return self.batch([text])[0]

"""SentencePiece ids and decoded texts of whole documents, from a table of distinct marked words.

The library marks white space and puts one mark before the text.  Where no piece holds a mark behind another character,
no piece crosses from one marked word (marks, then characters without a mark) to the next, so each can be segmented
alone.  A task keeps a table of the distinct marked words it has met, each segmented and decoded once by the library;
documents are places in that table, and their ids are gathered from it by position.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from shelfwise.llm.common import keyed, pieces

MARK = "▁"
TABLE = 300_000  # marked words held per task; when full the table starts anew, which changes no result
LONG = 1 << 16  # characters of a marked word that is segmented without being kept
marked = re.compile(" +[^ ]*").findall


def separable(model: str) -> bool:
    """Whether pieces of the model's file never cross marks, and its texts are taken as they are."""
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    with open(model, "rb") as file:
        proto.ParseFromString(file.read())
    rule, kinds = proto.normalizer_spec, {p.type for p in proto.pieces}
    plain = rule.add_dummy_prefix and not rule.remove_extra_whitespaces and not rule.precompiled_charsmap
    own = proto.SentencePiece.USER_DEFINED
    return (
        plain
        and rule.escape_whitespaces
        and not proto.trainer_spec.treat_whitespace_as_suffix
        and own not in kinds
        and not any(MARK in p.piece.lstrip(MARK) for p in proto.pieces)
        and any(p.piece == MARK for p in proto.pieces)
    )


class PieceTable:
    """Distinct marked words with their ids and decoded text."""

    def __init__(self, model: str, whole: bool):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=model)
        self.whole = whole
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.ids, self.bounds, self.decoded = np.empty(0, dtype=np.int32), np.zeros(1, dtype=np.int64), []

    def segment(self, words: list[str]) -> tuple[list[list[int]], list[str]]:
        """Ids and decoded text of marked words; the library's own first mark stands for one of theirs."""
        ids = self.library.encode([w[1:] for w in words], num_threads=1)
        alone = self.library.piece_to_id(MARK)
        ids = [i if i else [alone] for i in ids]
        return ids, [" " + t for t in self.library.decode(ids, num_threads=1)]

    def learn(self, words: list[str]) -> None:
        ids, decoded = self.segment(words)
        self.place.update(zip(words, range(len(self.place), len(self.place) + len(words))))
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter((i for own in ids for i in own), np.int32, int(sizes.sum()))
        self.ids = np.concatenate([self.ids, flat])
        self.bounds = np.concatenate([self.bounds, self.bounds[-1] + np.cumsum(sizes)])
        self.decoded += decoded

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[str]]:
        """Ids and decoded text of every text."""
        if self.whole:
            ids = self.library.encode(texts, num_threads=1)
            return [np.array(i, dtype=np.int32) for i in ids], self.library.decode(ids, num_threads=1)
        cuts = [marked(" " + t.replace(MARK, " ")) if t else [] for t in texts]
        wanted = set().union(*cuts)
        long = {w for w in wanted if len(w) > LONG}
        new = [w for w in wanted if w not in self.place]
        if len(new) + len(self.place) > TABLE:
            self.clear()
            new = list(wanted)
        self.learn(new)
        get, text_of = self.place.__getitem__, self.decoded.__getitem__
        codes = [np.fromiter(map(get, c), np.int64, len(c)) for c in cuts]
        ids = [self._gather(c) for c in codes]
        decoded = ["".join(map(text_of, c.tolist()))[1:] for c in codes]
        if long:
            self.clear()
        return ids, decoded

    def _gather(self, codes: np.ndarray) -> np.ndarray:
        """The ids of the words at these places, one after another."""
        first, size = self.bounds[codes], self.bounds[codes + 1] - self.bounds[codes]
        shift = first - np.concatenate([[0], np.cumsum(size)[:-1]]) if len(codes) else first
        return self.ids[np.repeat(shift, size) + np.arange(int(size.sum()))]


def encode_pieces(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per input row: the id, ``ids`` (as the library encodes the whole text) and ``decoded`` (the ids decoded).

    No begin or end ids and no sampling; nothing is cut.  A model whose pieces may cross marks, or that changes texts
    before it cuts them, gets whole texts instead of marked words.  A null text is an empty one: no ids, an empty
    decoded text.  Rows are taken one by one, so repeated rows and null ids give a row each; an empty table gives an
    empty result; other columns are not read.
    """
    rows = keyed(docs, id_col, text_col)
    key, whole = rows.schema["_id"].dataType.simpleString(), not separable(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = PieceTable(model, whole)
        for some in pieces(batches, 1000, 4_000_000):
            ids, decoded = table.encode([t or "" for t in some.column(1).to_pylist()])
            bounds = np.concatenate([[0], np.cumsum([len(i) for i in ids])])
            flat = np.concatenate(ids) if ids else np.empty(0, dtype=np.int32)
            lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat, pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [some.column(0), lists, pa.array(decoded, pa.string())], names=["_id", "ids", "decoded"]
            )

    return rows.mapInArrow(run, f"_id {key}, ids array<int>, decoded string").withColumnRenamed("_id", id_col)

"""Token counts without token ids.

Documents are taken in blocks of bounded size.  A block holds its distinct pre-tokens once and a sparse table of how
often each document has each of them; the pieces of every distinct pre-token are counted once, joined to that table
by index, and summed per document.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from shelfwise.llm.common import keyed, pieces
from shelfwise.llm.tokens import PreTokens

BLOCK_CHARS = 8_000_000  # a block ends with the document that reaches this; a longer document is a block of its own


def _block_counts(cutter: PreTokens, texts: list[str]) -> np.ndarray:
    index: dict[str, int] = {}
    docs, tokens, times, extra = [], [], [], np.zeros(len(texts), dtype=np.int64)
    for d, text in enumerate(texts):
        cut = cutter.split(text)
        if cut is None:  # special strings: the library takes the whole text
            extra[d] = len(cutter.encode(text))
            continue
        frequency = Counter(cut)
        tokens.append(np.fromiter((index.setdefault(t, len(index)) for t in frequency), np.int64, len(frequency)))
        times.append(np.fromiter(frequency.values(), np.int64, len(frequency)))
        docs.append(np.full(len(frequency), d))
    if index:
        weights = np.array(cutter.counts(list(index)), dtype=np.int64)
        joined = weights[np.concatenate(tokens)] * np.concatenate(times)
        np.add.at(extra, np.concatenate(docs), joined)
    return extra


def token_counts(
    docs: DataFrame, tokenizer: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per input row: the id, ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens).

    A null text counts as empty (0 bytes, 0 tokens); repeated rows and rows without id keep a row each; special
    strings inside texts are what the tokenizer takes them for; nothing is cut or padded; an empty table gives an
    empty result; other columns are not read.
    """
    rows = keyed(docs, id_col, text_col)
    key = rows.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = PreTokens(tokenizer)

        def out(ids: list[pa.Array], texts: list[str]) -> pa.RecordBatch:
            n = _block_counts(cutter, texts)
            size = pa.array([len(t.encode()) for t in texts], pa.int64())
            return pa.RecordBatch.from_arrays(
                [pa.concat_arrays(ids), size, pa.array(n), pa.array(n > limit)],
                names=["id", "n_bytes", "n_tokens", "over_limit"],
            )

        ids, texts, held = [], [], 0
        for part in pieces(batches, 500):
            some = [t or "" for t in part.column(1).to_pylist()]
            ids.append(part.column(0))
            texts += some
            held += sum(map(len, some))
            if held >= BLOCK_CHARS:
                yield out(ids, texts)
                ids, texts, held = [], [], 0
        if texts:
            yield out(ids, texts)

    found = rows.mapInArrow(run, f"id {key}, n_bytes long, n_tokens long, over_limit boolean")
    return found.withColumnRenamed("id", id_col)

"""Packing, token counts and token files against the library itself."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelfwise.llm import tokenfile
from shelfwise.llm.common import pieces
from shelfwise.llm.packing import Plan, best_fit, pack_documents, plan_packing, reduce_dominated
from shelfwise.llm.tokencount import token_counts
from shelfwise.llm.tokenfile import build_index, find_slots, lookup, read_token_files, write_token_files
from shelfwise.llm.tokens import PreTokens, WordEncoder

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [
    "It's 12.5%, I'M  here \n\n  now: ÀÉß_x__ ça\tva? 'LL end  ",
    " leading", "trailing  ", "a\r\nb", "  ", "\n", "don't'S 're x's", "x²³½ ٣ Ⅷ", "İstanbul ΣΑΣ ſ K Å", "e\u0301 \u0301x",
    "a\u00a0b\u2003c\x0bd\x1ce", "<|endoftext|>a <|startoftext|> <|endoftext|", "日本語 русский", "\U0001f600!? ÷×", "...,.;-_",
    "naïve Œuvre ǅ ŉ ɏ", "1234567 12,3", "a" * 5000,
]


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_pre_tokens_give_the_librarys_ids(path):
    library, cutter = Tokenizer.from_file(path), PreTokens(path)
    rng = random.Random(5)
    parts = [c for t in TEXTS for c in t]
    for text in TEXTS + ["".join(rng.choice(parts) for _ in range(60)) for _ in range(300)]:
        want = library.encode(text, add_special_tokens=False).ids
        cut = cutter.split(text)
        assert (cut is None) == ("<|endoftext|>" in text or "<|startoftext|>" in text)
        if cut is not None:
            assert sum(cutter.counts(cut)) == len(want), text
        if path == WORD:
            assert np.frombuffer(WordEncoder.ids(encoder(), text), "<u4").tolist() == want, text


_ENCODER = []


def encoder():
    if not _ENCODER:
        _ENCODER.append(WordEncoder(WORD))
    return _ENCODER[0]


def fewest(pieces, capacity):
    """Smallest number of bins by trying all assignments."""
    best = len(pieces)

    def go(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(pieces):
            best = len(rooms)
            return
        for k in range(len(rooms)):
            if rooms[k] >= pieces[i]:
                go(i + 1, [*rooms[:k], rooms[k] - pieces[i], *rooms[k + 1 :]])
        go(i + 1, [*rooms, capacity - pieces[i]])

    go(0, [])
    return best


def filled(plan):
    bins = {}
    for length, _, count, each, first, offset in plan.rows:
        for nth in range(count):
            bins.setdefault(first + nth // each, []).append((offset + nth % each * length, length))
    return bins


def test_fixed_sets_belong_to_a_best_packing():
    rng = random.Random(3)
    for _ in range(150):
        pieces = [rng.randint(1, 12) for _ in range(rng.randint(1, 8))]
        plan, histogram = Plan(), {p: pieces.count(p) for p in set(pieces)}
        left = reduce_dominated(histogram, 12, plan)
        rest = [k for k, v in left.items() for _ in range(v)]
        assert plan.sequences + (fewest(rest, 12) if rest else 0) == fewest(sorted(pieces, reverse=True), 12), pieces
        best_fit(left, 12, plan)
        for own in filled(plan).values():
            own.sort()
            assert own[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(own, own[1:])) and sum(own[-1]) <= 12
        assert sorted(n for own in filled(plan).values() for _, n in own) == sorted(pieces)


def test_large_instance_is_near_the_bound():
    rng = random.Random(1)
    lengths = [min(4096, int(rng.lognormvariate(6.5, 1.2)) + 1) for _ in range(50_000)]
    plan = plan_packing({k: lengths.count(k) for k in set(lengths)}, 4096)
    assert plan.sequences <= -(-sum(lengths) // 4096) + 3


def test_plan_does_not_grow_with_equal_pieces():
    for n in (10, 1000, 1_000_000):
        for histogram in ({2500: n, 1500: n}, {3000: n, 1000: 2 * n, 90: n}, {1366: 3 * n, 1365: n}):
            plan = plan_packing(histogram, 4096)
            assert len(plan.rows) < 20
            assert sum(r[2] for r in plan.rows) == sum(histogram.values())


def pieces_of(text, end, capacity=4096):
    ids = np.array([*Tokenizer.from_file(WORD).encode(text or "", add_special_tokens=False).ids, end], dtype="<u4")
    return [(at, len(ids[at : at + capacity]), zlib.crc32(ids[at : at + capacity].tobytes())) for at in range(0, len(ids), capacity)]


def test_packing_of_odd_rows(spark, odd, nothing):
    got = pack_documents(odd, WORD).toPandas()
    want = sorted((p for r in odd.collect() for p in pieces_of(r.text, 1)))
    assert sorted(zip(got.start, got.length, got.ids_crc32)) == want
    for _, own in got.groupby("sequence_id"):
        own = own.sort_values("offset")
        ends = (own.offset + own.length).tolist()
        assert [0, *ends[:-1]] == own.offset.tolist() and ends[-1] <= 4096
    assert pack_documents(nothing, WORD).count() == 0
    assert pack_documents(odd, WORD, end_id=None).where("doc_id < 3").count() == 0


def test_counts_of_odd_rows(odd, nothing):
    library = Tokenizer.from_file(BYTE)
    got = sorted((r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts(odd, BYTE).collect())
    want = []
    for r in odd.collect():
        n = len(library.encode(r.text or "", add_special_tokens=False).ids)
        want.append((r.doc_id or 0, len((r.text or "").encode()), n, n > 1024))
    assert got == sorted(want)
    assert token_counts(nothing, BYTE).count() == 0


def test_perfect_hash():
    rng = np.random.default_rng(0)
    for n in (1, 2, 3, 7, 100, 5000):
        keys = np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64))
        displacement, slot = build_index(keys)
        assert sorted(slot) == list(range(len(keys)))
        assert (find_slots(keys, displacement, len(keys)) == slot).all()


def test_files_of_odd_rows(spark, odd, nothing, documents, tmp_path):
    write_token_files(odd, str(tmp_path / "odd"), WORD)
    got = read_token_files(spark, str(tmp_path / "odd"), with_ids=True).toPandas()
    want = sorted((len(i), zlib.crc32(i)) for i in (encoder().ids(r.text) + b"\2\0\0\0" for r in odd.collect()))
    assert sorted(zip(got.ids.map(len), got.ids_crc32)) == want
    got = got.sort_values("start")
    assert got.start.tolist() == [0, *got.n_tokens.cumsum().tolist()[:-1]]
    assert got.key.tolist()[2:] == sorted(got.key.tolist()[2:])  # the two rows without id come first
    write_token_files(nothing, str(tmp_path / "none"), WORD)
    assert read_token_files(spark, str(tmp_path / "none")).count() == 0
    write_token_files(documents, str(tmp_path / "all"), WORD)
    found = lookup(spark, str(tmp_path / "all"), [5, 17, -3, 10**12]).collect()
    texts = {r.doc_id: r.text for r in documents.where("doc_id in (5, 17)").collect()}
    assert {r.key: bytes(r.ids) for r in found} == {k: encoder().ids(t) + b"\2\0\0\0" for k, t in texts.items()}
    assert len(found) == len(texts)


def test_lookup_opens_only_shards_that_hold_a_key(spark, documents, tmp_path, monkeypatch):
    monkeypatch.setattr(tokenfile, "SHARD_BYTES", 20_000)
    path = str(tmp_path / "small")
    twice = documents.select("doc_id", "text").unionByName(documents.where("doc_id = 7").selectExpr("doc_id", "'again' AS text"))
    write_token_files(twice, path, WORD)
    shards = spark.read.parquet(path).select("part", "seq", "first_key", "last_key").collect()
    assert len(shards) > 20
    for asked in ([7], [3, 150], [-1, 10**9], []):
        found = lookup(spark, path, asked)
        want = {k: sorted(r.text or "" for r in twice.where(F.col("doc_id") == k).collect()) for k in asked}
        got = [(r.key, bytes(r.ids)) for r in found.collect()]
        assert sorted(got) == sorted((k, encoder().ids(t) + b"\2\0\0\0") for k, ts in want.items() for t in ts)
        opened = {(r.part, r.seq) for r in found.collect()}
        assert opened <= {(s.part, s.seq) for s in shards if any(s.first_key <= k <= s.last_key for k in asked)}
        assert len(opened) <= 2 * len(asked)


def test_index_of_keys_that_do_not_stand_together():
    shard = tokenfile._shard(0, 0, [9, 4, 9, 1], [bytes(4 * n) for n in (1, 2, 3, 4)], 2)
    found = list(tokenfile._documents([pa.RecordBatch.from_pylist([shard])], np.array([1, 5, 9]), True))[0].to_pydict()
    assert sorted(zip(found["key"], found["n_tokens"])) == [(1, 4), (9, 1), (9, 3)]


def test_batches_are_bounded_by_rows_and_bytes():
    texts = ["a" * 5, None, "", "b" * 30, "c" * 3, "d" * 3, "e" * 3]
    whole = pa.RecordBatch.from_arrays([pa.array(range(7)), pa.array(texts)], names=["i", "t"])
    for rows, size, want in ((3, 10, [3, 1, 3]), (2, 100, [2, 2, 2, 1]), (100, 1, [3, 1, 1, 1, 1])):
        parts = list(pieces(iter([whole]), rows, size))
        assert pa.Table.from_batches(parts).equals(pa.Table.from_batches([whole]))
        if size != 1:
            assert [p.num_rows for p in parts] == want
    assert list(pieces(iter([whole.slice(0, 0)]))) == []

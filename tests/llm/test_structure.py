"""Periodic runs, sentence pieces and conversation repair against plain versions."""

import hashlib
import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from shelfwise.llm import conversation, piececode, runs
from shelfwise.llm.queries import QUERIES
from tests.llm.conftest import SF, sentence

PIECES = public_tokenizers.path("piece_bpe_32k.model")


def plain_runs(w, least, exponent):
    out = set()
    for p in range(1, len(w) // exponent + 1):
        i = 0
        while i + p < len(w):
            j = i
            while j + p < len(w) and w[j] == w[j + p]:
                j += 1
            size = j + p - i
            smaller = any(all(w[k] == w[k + q] for k in range(i, i + size - q)) for q in range(1, p))
            if j > i and size >= max(least, exponent * p) and not smaller:
                out.add((i, size, p))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_runs_equal_a_plain_search():
    rng = random.Random(5)
    for _ in range(400):
        docs = []
        for _ in range(3):
            letters = "abcde"[: rng.choice([1, 2, 3, 5])]
            w = [rng.choice(letters) for _ in range(rng.randint(0, 50))]
            while rng.random() < 0.6:
                unit = [rng.choice(letters) for _ in range(rng.randint(1, 5))]
                at = rng.randint(0, len(w))
                w[at:at] = (unit * 8)[: rng.randint(1, 8 * len(unit))]
            docs.append(w)
        least, exponent = rng.choice([2, 6]), rng.choice([3, 4, 5])
        found = runs.batch_runs([" ".join(w).encode() for w in docs], least, exponent)
        for w, (_, got) in zip(docs, found):
            assert [tuple(r) for r in got.tolist()] == plain_runs(w, least, exponent)


def test_suffix_tree_extensions():
    rng = np.random.default_rng(3)
    text = rng.integers(1, 4, 300).tolist() + [0]
    tree = runs.SuffixTree(text, 1)
    order = sorted(range(len(text)), key=lambda i: text[i:])
    assert [int(r) for r in np.argsort(tree.rank)] == order
    a, b = rng.integers(0, 300, 500), rng.integers(0, 300, 500)
    a, b = a[a != b], b[a != b]
    for i, j, n in zip(a.tolist(), b.tolist(), tree.extensions(a, b).tolist()):
        assert text[i : i + n] == text[j : j + n] and text[i + n] != text[j + n]


def test_collapsed_rows(spark, odd, nothing):
    got = runs.periodic_runs(odd, 6, 4).collect()
    assert len(got) == odd.count()
    by_id = {r.doc_id: r for r in got}
    assert by_id[9].kept_text == "stop" and [tuple(r) for r in by_id[9].runs] == [(0, 60, 1)]
    assert by_id[1].kept_text == "" and by_id[1].n_words == 0 and by_id[1].runs == []
    text = next(r.text for r in odd.collect() if r.doc_id == 6)
    assert by_id[6].kept_text.encode() == b" ".join(text.encode().split())
    assert sum(r.doc_id is None for r in got) == 2 and sum(r.doc_id == 4 for r in got) == 3
    assert runs.periodic_runs(nothing).count() == 0
    assert runs.periodic_runs(odd).columns == ["doc_id", "n_words", "runs", "kept_text"]
    with pytest.raises(ValueError):
        runs.periodic_runs(odd, 6, 2)


def test_runs_query_by_hand(spark, tmp_path):
    texts = [(i, sentence(i, 30 + i)) for i in range(40)] + [(40, None), (None, "a b " * 9), (41, "x " * 50), (90, "")]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in QUERIES["op11_periodic_runs"](spark, str(tmp_path)).collect()}
    for i, text in texts:
        w, h = (text or "").split(), None if i is None else zlib.crc32(str(i).encode())
        if h is not None and h % 10 == 0 and w:
            g = h // 10
            a = g % len(w)
            p = 1 + (len(w) - a) // (3 + g % 8)
            w = [w[a + (k - a) % p] if k >= a else x for k, x in enumerate(w)]
        found = plain_runs(w, 6, 4)
        gone = {k for s, n, p in found for k in range(s + p, s + n)}
        best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None, None, None))
        shown = "".join(f"{s},{n},{p}\n" for s, n, p in found)
        row = got[i]
        assert (row.n_runs, row.start, row.length, row.period) == (len(found), *best)
        assert row.exponent_milli == (1000 * best[1] // best[2] if found else None)
        assert row.runs_sha256 == hashlib.sha256(shown.encode()).hexdigest()
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        assert row.collapsed_sha256 == hashlib.sha256(kept.encode()).hexdigest()


def test_pieces_equal_the_library():
    library, table = sentencepiece.SentencePieceProcessor(model_file=PIECES), piececode.PieceTable(PIECES, False)
    assert piececode.separable(PIECES)
    rng = random.Random(2)
    parts = list("ab c  \n\t▁é日😀\x00� ​0129.,<>/s") + ["<s>", "</s>", "<unk>", "<0x0A>", "the ", " ▁", "  "]
    texts = ["", " ", "  ", " a", "a ", "▁", "▁▁ x", "\n", "a" * 70_000 + " b", " " * 1000 + "x", sentence(1, 20_000)]
    texts += ["".join(rng.choice(parts) for _ in range(rng.randint(0, 60))) for _ in range(5000)]
    for k in range(0, len(texts), 700):
        some = texts[k : k + 700]
        ids, decoded = table.encode(some)
        assert [i.tolist() for i in ids] == library.encode(some)
        assert decoded == library.decode(library.encode(some))


def test_piece_rows(spark, odd, nothing, monkeypatch):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    want = sorted((r.doc_id or -1, library.encode(r.text or "")) for r in odd.collect())
    got = piececode.encode_pieces(odd, PIECES).collect()
    assert sorted((r.doc_id or -1, r.ids) for r in got) == want
    assert all(r.decoded == library.decode(r.ids) for r in got)
    assert piececode.encode_pieces(nothing, PIECES).count() == 0
    small = piececode.PieceTable(PIECES, False)
    monkeypatch.setattr(piececode, "TABLE", 5)
    for part in (["a b c", "d e f g"], ["h a", "b c d e f g h"]):
        assert [i.tolist() for i in small.encode(part)[0]] == library.encode(part)


def test_pieces_query_equals_the_library(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    got = {r.doc_id: r for r in QUERIES["op12_sentence_pieces"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = library.encode(d.text or "")
        row = got[d.doc_id]
        assert row.n_tokens == len(ids) and row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def plain_repair(symbols):
    """Least (cost, audit) over all edit strings, by states and rows from left to right."""
    step = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}

    def inserted(states):
        for _ in range(3):
            for q, (c, t) in list(states.items()):
                for r in "ua":
                    to = step[r].get(q)
                    if to is not None:
                        states[to] = min(states.get(to, (1 << 60, "")), (c + 5, t + "I"))
        return states

    states = inserted({0: (0, "")})
    for s in symbols:
        new: dict = {}
        for q, (c, t) in states.items():
            moves = [(q, 2, "D")]
            if not s.isdigit():
                more = 5 * s.isupper()
                moves += [(step[s.lower()][q], more, "K")] if q in step.get(s.lower(), {}) else []
                moves += [(step[r][q], 1 + more, "R") for r in "ua" if q in step[r]]
            for to, cost, letter in moves:
                new[to] = min(new.get(to, (1 << 60, "")), (c + cost, t + letter))
        states = inserted(new)
    return min(states[q] for q in (0, 3) if q in states)


def root(cell):
    cost, audit = min(c for c in (cell[conversation.INDEX[0, 0]], cell[conversation.INDEX[0, 3]]) if c)
    return cost, audit.replace("L", "K")


def test_interval_parse_equals_left_to_right():
    rng = random.Random(4)
    kinds = "suaoSUAO1234"
    strings = ["".join(t) for n in (1, 2) for t in itertools.product(kinds, repeat=n)]
    strings += ["".join(rng.choice(kinds) for _ in range(rng.randint(3, 12))) for _ in range(300)]
    for s in strings:
        assert root(conversation.parse([conversation.row_cell(c) for c in s])) == plain_repair(s)
    long = "".join(rng.choice("uauauas1UAo") for _ in range(60))
    cells = [conversation.parse([conversation.row_cell(c) for c in long[i : i + 7]]) for i in range(0, 60, 7)]
    assert root(conversation.parse(cells)) == plain_repair(long)


def plain_report(rows):
    """Report and repaired lines of one conversation's rows (turn, role, text), in order."""
    seen, symbols, faults = set(), "", []
    for _, role, text in rows:
        body = text.strip(" \t\n\x0b\x0c\r")
        fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
        seen.add((role, text))
        kind = role[:1] if role[:1] in ("s", "u", "a") else "o"
        drop = fault in ("blank", "duplicate")
        symbols += "1234"["suao".index(kind)] if drop else kind.upper() if fault else kind
        faults.append(fault)
    cost, audit = plain_repair(symbols)
    lines, at = [], 0
    for letter in audit:
        role, text = ("", "") if letter == "I" else rows[at][1:]
        at += letter != "I"
        if letter != "D":
            turn = len(lines) - bool(lines and lines[0][0].startswith("s"))
            lines.append((role if letter == "K" else ("user", "assistant")[turn % 2], text))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    initials = [r[:1] for _, r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit), lines


def odd_conversations():
    rng = random.Random(9)
    rows = []
    for conv in [None, *range(40)]:
        for turn in range(rng.choice([1, 2, 5, 9, 40])):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "User"])
            text = rng.choice(["Yes.", "No!", f"Line {turn}.", "cut off", " \n", "", None, "Why?\t", "last\n.", f"{turn} é日."])
            rows.append((conv, None if rng.random() < 0.05 and turn == 0 else turn * 2 if conv == 7 else turn, role, text))
    rows += [(100, t, ("user", "assistant")[t % 2], f"Turn {t}.") for t in range(700)]
    return rows


def test_conversation_repair(spark):
    rows = odd_conversations()
    more = [(*r, "x", 1, 2) for r in rows]
    table = spark.createDataFrame(more, "conv_id long, turn long, role string, text string, pos string, place int, _conv int")
    fixed = conversation.repair_conversations(table)
    report = {r.conv_id: tuple(r)[1:] for r in fixed.report.collect()}
    turns: dict = {}
    for r in sorted(fixed.turns.collect(), key=lambda r: r.place):
        turns.setdefault(r.conv_id, []).append((r.role, r.text))
    by_conv: dict = {}
    for conv, turn, role, text in rows:
        by_conv.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    assert set(report) == set(by_conv)
    for conv, own in by_conv.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0))
        want, lines = plain_report(own)
        assert report[conv] == want, conv
        assert turns.get(conv, []) == lines
    assert report[100] == (0, 0, 0, 0, 0, 0, "K" * 700)
    empty = conversation.repair_conversations(table.limit(0), table)
    assert empty.report.count() == 42 and empty.turns.count() == 0
    assert conversation.repair_conversations(table.limit(0)).report.count() == 0


def test_repeated_rows_are_duplicates(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "assistant", "Yes."), (1, 1, "assistant", "Yes.")]
    fixed = conversation.repair_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert tuple(fixed.report.first()) == (1, 0, 0, 1, 0, 1, 2, "KKD")
    assert sorted((r.place, r.role, r.edit) for r in fixed.turns.collect()) == [(0, "user", "K"), (1, "assistant", "K")]

"""SimHash groups, vector links and repeated windows against brute force."""

import random

import numpy as np
import xxhash

from shelfwise.llm.common import local_roots
from shelfwise.llm.simhash import links_within, simhash_groups, within
from shelfwise.llm.substring import drop_repeated_windows
from shelfwise.llm.vectors import link_vectors


def roots(near):
    return local_roots(near | near.T)


def plain_fingerprint(text, k=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + k]), 42) for i in range(max(1, len(words) - k + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def same_groups(rows, radius):
    fps = [plain_fingerprint(r.text) for r in rows]
    near = np.array([[(a ^ b).bit_count() <= radius for b in fps] for a in fps])
    root = roots(near)
    ids = {}
    for r, g in zip(rows, root):
        ids.setdefault(g, []).append(r.doc_id)
    least = {g: min((i for i in v if i is not None), default=None) for g, v in ids.items()}
    return sorted((str(r.doc_id), f"{f:016x}", str(least[g])) for r, f, g in zip(rows, fps, root))


def test_simhash_groups(documents, odd, nothing):
    small = odd.where("doc_id is null or doc_id <> 5")
    for docs, radius in ((documents, 2), (small, 2), (small, 5)):
        rows = docs.select("doc_id", "text").collect()
        got = simhash_groups(docs, radius=radius).collect()
        assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got) == same_groups(rows, radius)
    assert simhash_groups(nothing).count() == 0


def test_bit_planes():
    rng = np.random.default_rng(1)
    block = rng.integers(0, 1 << 63, 150, dtype=np.uint64)
    block[1:40] = block[0] ^ (np.uint64(1) << rng.integers(0, 64, 39).astype(np.uint64))
    for radius in (0, 1, 2, 3, 7, 30):
        want = np.array([[(int(a) ^ int(b)).bit_count() <= radius for b in block] for a in block])
        np.fill_diagonal(want, False)
        assert (within(block, radius) == want).all()


def test_crowded_buckets_are_divided_without_loss(spark):
    rng = random.Random(4)
    fps = {rng.getrandbits(12) << 4 | rng.getrandbits(2) for _ in range(700)} | {rng.getrandbits(63) for _ in range(50)}
    fps = sorted(fps)
    links = links_within(spark.createDataFrame([(f,) for f in fps], "fp long"), 2, bucket=16).collect()
    at = {f: i for i, f in enumerate(fps)}
    got = np.zeros((len(fps), len(fps)), dtype=bool)
    for link in links:
        got[at[link.a], at[link.b]] = got[at[link.b], at[link.a]] = True
    near = np.array([[a != b and (a ^ b).bit_count() <= 2 for b in fps] for a in fps])
    assert (roots(got) == roots(near)).all()


def unit(v):
    if not v or any(x is None for x in v):
        return None
    a = np.array(v, dtype=float)
    if not np.isfinite(a).all() or not a.any():
        return None
    a = a / np.abs(a).max()
    return a / np.linalg.norm(a)


def linked(rows):
    vs = [unit(r[1]) for r in rows]
    near = np.zeros((len(vs), len(vs)), dtype=bool)
    for size in {len(v) for v in vs if v is not None}:
        at = [i for i, v in enumerate(vs) if v is not None and len(v) == size]
        same = np.array([vs[i] for i in at])
        near[np.ix_(at, at)] = same @ same.T >= 0.95
    np.fill_diagonal(near, False)
    root = roots(near)
    first: dict = {}
    for r, g in zip(rows, root):
        first[g] = min(r[0], first.get(g, r[0]))
    least = [first[g] for g in root]
    return [(r[0], int(near[i].sum()), least[i], r[0] == least[i]) for i, r in enumerate(rows)]


def test_vector_links(spark):
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((6, 16))
    rows = []
    for i in range(400):
        v = centres[i % 6] + rng.standard_normal(16) * (0.12 if i % 3 else 3)
        rows.append((i, [float(x) for x in np.float32(v)]))
    rows += [(400, None), (401, []), (402, [0.0] * 16), (403, [float("nan")] * 16), (404, [None] + [1.0] * 15)]
    rows += [(405, [float("inf")] + [0.0] * 15), (406, [1.0, 2.0]), (407, [2.0, 4.0]), (408, rows[1][1]), (409, rows[1][1])]
    rows += [(410, [1e-200] * 16), (411, [1e200] * 16)]
    table = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "vec_id long, embedding array<double>, id int, unit string, node int")
    for block in (512, 8):
        got = sorted(tuple(r) for r in link_vectors(table, block=block).collect())
        assert got == linked(rows)
    assert link_vectors(table.limit(0)).count() == 0


def test_vector_recall_on_the_given_table(spark):
    rng, rows = np.random.default_rng(5), []
    for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect():
        v = np.array(r.embedding)
        near = [v + 0.3 * rng.uniform(0.1, 1) * w / np.linalg.norm(w) for w in rng.standard_normal((3, len(v)))]
        rows += [(4 * r.vec_id + k, x.tolist()) for k, x in enumerate([v, *near])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = {w[0]: w[1] for w in linked(rows)}
    got = {r.vec_id: r.n_links for r in link_vectors(table).collect()}
    assert all(got[k] <= want[k] for k in want)
    assert sum(got.values()) >= 0.9 * sum(want.values()) > 0


def plain_windows(rows, window):
    docs = sorted({(r.doc_id is not None, r.doc_id or 0, r.text or "") for r in rows}, key=lambda d: d[:2])
    seen, out = set(), {}
    for has, i, text in docs:
        words = text.encode().split()
        gone = set()
        for s in range(len(words) - window + 1):
            w = tuple(words[s : s + window])
            if w in seen:
                gone.update(range(s, s + window))
            seen.add(w)
        out[has, i, text] = (len(words), len(gone), b" ".join(w for k, w in enumerate(words) if k not in gone).decode())
    return out


def test_repeated_windows(documents, odd, nothing, spark):
    for window in (20, 7, 1):
        want = plain_windows(documents.collect(), window)
        got = drop_repeated_windows(documents, window).collect()
        assert {(True, r.doc_id): (r.n_words, r.n_removed, r.kept_text) for r in got} == {k[:2]: v for k, v in want.items()}
        for r in got[:50]:
            assert sum(s.end - s.start for s in r.removed) == r.n_removed
    unique = odd.where("doc_id is not null and doc_id <> 4")
    want = plain_windows(unique.collect(), 20)
    got = drop_repeated_windows(unique, 20).collect()
    assert {(True, r.doc_id): (r.n_words, r.n_removed, r.kept_text) for r in got} == {k[:2]: v for k, v in want.items()}
    assert drop_repeated_windows(nothing).count() == 0


def test_repeated_rows_are_one_document(odd):
    got = drop_repeated_windows(odd, 20).collect()
    assert len(got) == odd.count()
    twice = [r for r in got if r.doc_id == 4 and r.n_words == 60]
    assert len(twice) == 2 and twice[0] == twice[1]
    assert twice[0].n_removed == 60  # the same passage stands in a row without id, which comes first
    assert all(r.n_removed == 0 for r in got if r.doc_id is None)

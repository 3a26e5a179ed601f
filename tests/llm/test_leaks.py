"""Leaks whose parts stand in another order than in the item."""

import random
import re

from shelfwise.llm import decontam
from tests.llm.conftest import sentence
from tests.llm.test_text import plain_leaks


def test_leaks_in_another_order(spark):
    rng, items, docs = random.Random(5), [], []
    for i in range(20):
        words = [f"w{rng.randrange(10**6)}" for _ in range(60)]
        items.append((i, " ".join(words)))
        swapped = words[30:] + words[:30] if i % 2 else words[40:] + words[20:40] + words[:20]
        docs.append((i, f"{sentence(i, 30)} {' '.join(swapped)} {sentence(i + 50, 30)}"))
    docs.append((99, sentence(99, 200)))
    table = spark.createDataFrame(docs, "doc_id long, text string")
    items = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in decontam.benchmark_leaks(table, items).collect()}
    want = plain_leaks(table.collect(), items.collect())
    assert {(i, i) for i in range(1, 20, 2)} <= want
    assert set(got) <= want and len(got) >= 0.9 * len(want)


def test_index_is_not_broadcast(spark):
    """The listed fingerprints are some 300 rows an item; only tables of a row an item or shingle may be broadcast."""
    items = spark.createDataFrame([(i, sentence(i, 40)) for i in range(20)], "item_id long, text string")
    docs = spark.createDataFrame([(i, f"{sentence(i, 40)} {sentence(i + 50, 30)}") for i in range(20)], "doc_id long, text string")
    found = decontam.benchmark_leaks(docs, items)
    assert {(r.doc_id, r.item_id) for r in found.collect()} >= {(i, i) for i in range(20)}
    plan = found._jdf.queryExecution().optimizedPlan().toString().split("\n")
    index = [line for line in plan if "Join" in line and "value#" in line and "block#" in line]
    assert index and all("merge" in line and "broadcast" not in line for line in index)


def test_index_lists_near_values_in_small_code(spark):
    """All values within two bits of a block's, without a generated method that grows with their number."""
    prints = [0, -1, 0x0123456789ABCDEF, -(2**63)]
    items = spark.createDataFrame(list(enumerate(prints)), "item int, item_fp long")
    listed = decontam.hamming_index(items, radius=20, count=8)
    got = [(r["item"], r.block, r.value) for r in listed.collect()]
    byte = lambda fp, j: (fp >> 8 * j) & 255
    want = {(i, j, v) for i, fp in enumerate(prints) for j in range(8) for v in range(256) if (v ^ byte(fp, j)).bit_count() <= 2}
    assert len(got) == len(want) and set(got) == want
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
    code = listed._jdf.queryExecution().explainString(mode)
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", code)]
    assert sizes and max(sizes) < 8000  # HotSpot compiles no larger method

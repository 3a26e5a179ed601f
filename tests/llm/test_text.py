"""URL rules, language spans, benchmark leaks and secrets."""

import pickle
import random
import subprocess
import sys
import unicodedata
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from shelfwise.llm import decontam, langid, secrets
from shelfwise.llm.queries import ORACLES, QUERIES, URL_RULES
from shelfwise.llm.urlfilter import Rule, judge_urls
from tests.llm.conftest import SF, sentence

ODD_URLS = [
    None, "", "no scheme/en/", "http://", "http://COM/", "http://com", "http://com/", "http://x.com?/a/", "a://b://c.com/x",
    "http://example.com/en/", "http://www.example.com/en/1", "http://xwww.example.com/en/", "http://a.www.example.com/en/?q",
    "http://example.com/EN/", "http://notexample.com/en/", "http://x.net/es/", "http://x.net/es", "http://net/fr/#a",
    "http://x.org/a.com/", "http://é.net/fr/ü", "http://a.net/x/es/", "http://a\nb.com/\nc?d", "http://.com/", "http://x.com/" + "y" * 50_000,
]


def plain_rule(url):
    host, path = "", ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([i for i in map(rest.find, "/?#") if i >= 0], default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:]
        path = path[: min([i for i in map(path.find, "?#") if i >= 0], default=len(path))]
    fits = []
    for r in URL_RULES:
        h, p = r.text.split("/", 1)
        if ("." + host).endswith("." + h) and path.startswith("/" + p):
            fits.append((len(r.text), r.text, r.verdict))
    best = max(fits, default=(0, None, "allow"))
    return host, path, best[1], best[2]


def test_url_rules(spark):
    table = spark.createDataFrame([(i, u, "h", "p") for i, u in enumerate(ODD_URLS)], "page_id long, url string, host string, path string")
    got = {r.page_id: tuple(r)[1:] for r in judge_urls(table, URL_RULES).collect()}
    assert got == {i: plain_rule(u) for i, u in enumerate(ODD_URLS)}
    assert judge_urls(table.limit(0), URL_RULES).count() == 0
    assert {r.verdict for r in judge_urls(table, [], default="block").collect()} == {"block"}


def test_wildcards_and_many_rules(spark):
    rules = [Rule("shop*.org/a?c/*/z", "block"), *[Rule(f"site{i}.example.org/part{i}/", "block") for i in range(60)]]
    urls = ["http://shop12.org/abc/x/y/z9", "http://shop.org/ac/x/z", "http://u.site59.example.org/part59/q", "http://site5.example.org/part6/"]
    table = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: r.rule for r in judge_urls(table, rules).collect()}
    assert got == {0: rules[0].text, 1: None, 2: "site59.example.org/part59/", 3: None}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want, got = con.execute(ORACLES[name]).df(), QUERIES[name](spark, SF).toPandas()
    columns = sorted(want.columns)
    plain = lambda d: sorted(map(tuple, d[columns].astype(object).where(d[columns].notna(), None).astype(str).values))
    assert columns == sorted(got.columns) and plain(got) == plain(want)


def test_names_of_queries():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_languages(spark, odd, nothing):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.label_languages(table).join(table.select("doc_id", "lang"), "doc_id").where("held_out and lang is not null")
    right, total = got.select(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert total > 100 and right > 0.97
    rows = {(r.doc_id, r.lang_pred, r.held_out): r for r in langid.label_languages(odd).collect()}
    found = {k[:2] for k in rows}
    assert {(1, "und"), (2, "und"), (3, "und"), (10, "und"), (4, "en"), (5, "en")} <= found
    assert all(0 <= r.score <= 1 for r in rows.values())
    assert langid.label_languages(nothing).count() == 0
    assert {r.lang_pred for r in langid.label_languages(odd.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_letterless_texts_have_no_language(spark):
    model = langid.train(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    texts = ["½ ² Ⅷ 12", "①②③", "_ 1_2", "٣ ५", "½ the ² and"]
    got = langid.label_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model)
    assert [r.lang_pred != "und" for r in got.orderBy("doc_id").collect()] == [False, False, False, False, True]
    assert langid.keep_identified(spark.createDataFrame([(t,) for t in texts], "text string"), model).count() == 1
    assert all(bool(langid.WORD.match(chr(c))) == unicodedata.category(chr(c)).startswith("L") for c in range(0x3000))
    pattern = langid.word_patterns()
    for text in [*texts, "plain", "Ärger ³ x", "日本 ㊿"]:
        assert pattern(text).findall(text) == langid.WORD.findall(text)


def test_model_travels_without_the_package(spark, tmp_path):
    """What the stage broadcasts and what its closure holds load in a process that has no copy of the package."""
    model = langid.Model(["a"], np.zeros((langid.SLOTS, 1), np.float32), np.ones((len(langid.SCRIPTS), 1), bool))
    shared = model.shared(spark)
    (tmp_path / "b.pkl").write_bytes(pickle.dumps(shared.value))

    (tmp_path / "f.pkl").write_bytes(cloudpickle.dumps((langid.Model, langid._scorer, langid.label_spans, langid.word_patterns)))
    code = (
        "import pickle; M, s, f, w = pickle.load(open('f.pkl', 'rb')); m = M(*pickle.load(open('b.pkl', 'rb')));"
        "print(f('one two', m, s(m), 20.0, w())[0])"
    )
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=60)
    assert done.stdout.strip() == "a", done.stderr


def test_mixed_text_is_cut_into_spans(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.train(table)
    one = {r.lang: r.text for r in table.where("lang is not null").dropDuplicates(["lang"]).collect()}
    text = one["en"][:400] + " " + one["de"][:900]
    row = langid.label_documents(spark.createDataFrame([(1, text)], "doc_id long, text string"), model).first()
    assert row.lang_pred == "de" and 0.5 < row.score < 1
    assert [s.lang for s in row.spans] == ["en", "de"]


def plain_viterbi(scores, penalty):
    best = scores[0].copy()
    for s in scores[1:]:
        best = np.maximum(best, best.max() - penalty) + s
    return best.max()


def test_viterbi_reaches_the_best_score():
    rng = np.random.default_rng(3)
    for _ in range(200):
        scores = rng.normal(size=(rng.integers(1, 40), 3)) * rng.choice([0.2, 2.0])
        path = langid.viterbi(scores, 3.0)
        total = scores[np.arange(len(path)), path].sum() - 3.0 * (np.diff(path) != 0).sum()
        assert abs(total - plain_viterbi(scores, 3.0)) < 1e-6


def words_of(text):
    return "".join(c if c.isalnum() else " " for c in (text or "").lower()).split()


def plain_leaks(docs, items):
    found = set()
    for d in docs:
        words = words_of(d.text)
        for item in items:
            own = words_of(item.text)
            if not own or not words:
                continue
            k = min(5, len(own))
            cut = lambda w: Counter(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1)))
            want, n = cut(own), min(len(own), len(words))
            for s in range(len(words) - n + 1):
                have = cut(words[s : s + n])
                shared = sum((have & want).values())
                if shared / sum((have | want).values()) >= 0.8:
                    found.add((d.doc_id, item.item_id))
                    break
    return found


def test_leaks(spark, odd, nothing):
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    rows = items.collect()
    rng, docs = random.Random(2), []
    for i in range(60):
        words = rows[i % len(rows)].text.split()
        for _ in range(i % 4):
            words[rng.randrange(len(words))] = "changed"
        if i % 5 == 0:
            words.insert(len(words) // 2, "put in")
        docs.append((i, f"{sentence(i, 25)} {' '.join(words)}, {sentence(i + 100, 25)}" if i % 7 else " ".join(words), "x", 1))
    table = spark.createDataFrame(docs, "doc_id long, text string, item string, n int")
    want = plain_leaks(table.collect(), rows)
    got = decontam.benchmark_leaks(table, items).collect()
    found = {(r.doc_id, r.item_id) for r in got}
    assert found <= want and len(found) >= 0.97 * len(want) > 10
    assert all(r.similarity >= 0.8 and r.distance <= 20 for r in got)
    short = spark.createDataFrame([(1, "seven ocean"), (2, None), (3, ""), (4, sentence(1, 60))], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontam.benchmark_leaks(odd, short).collect()}
    assert {(4, 4), (7, 4), (8, 4), (None, 4)} <= got and got == plain_leaks(odd.collect(), short.collect())
    assert decontam.benchmark_leaks(nothing, items).count() == 0
    assert decontam.benchmark_leaks(odd, items.limit(0)).count() == 0


def test_given_documents_leak_as_by_brute_force(spark, documents):
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    want = plain_leaks(documents.where("length(text) < 6000").collect(), items.collect())
    got = decontam.benchmark_leaks(documents.where("length(text) < 6000"), items).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want


def test_decontamination_stays_native(spark, documents):
    plan = decontam.benchmark_leaks(documents, spark.read.parquet(f"{SF}/benchmark.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "InArrow" not in plan


def secret_rows():
    rng = random.Random(9)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    out = []
    for i in range(300):
        key = "AKIA" + "".join(rng.choice(letters) for _ in range(16))
        hexa = "".join(rng.choice("0123456789abcdef") for _ in range(40))
        number = "".join(rng.choice("0123456789") for _ in range(16))
        pick = [f"key {key} here", f'token = "{hexa}" then', f"password={hexa[:18]} and", f"card {number} paid", f"see http://a.b/{hexa}/x"]
        out.append((i, f"{sentence(i, 20)} {pick[i % 5]} {sentence(i + 999, 20)}", f"src/{i}", i % 5 < 3))
    return out


def test_secrets(spark, odd, nothing):
    rows = secret_rows()
    table = spark.createDataFrame([(*r[:3], 1.0, "c") for r in rows], "doc_id long, text string, source string, length double, candidate string")
    got = {r.doc_id: r.is_secret for r in secrets.scan_secrets(table).collect()}
    assert len(got) == 300
    assert sum(got[r[0]] == r[3] for r in rows) >= 295
    masked = {r.doc_id: r.text for r in secrets.mask_secrets(table).collect()}
    for i, text, _, secret in rows:
        assert (secrets.MASK in masked[i]) == got[i] and (got[i] or masked[i] == text)
    assert secrets.scan_secrets(nothing).count() == 0
    again = secrets.mask_secrets(odd)
    assert again.columns == odd.columns and again.count() == odd.count()


def test_forest_from_given_labels(spark):
    rows = secret_rows()
    table = spark.createDataFrame([r[:3] for r in rows], "doc_id long, text string, source string")
    found = secrets.features(secrets.candidates(table, "doc_id", "text", "source"), secrets.dictionary(table))
    labels = spark.createDataFrame([(r[0], float(r[3])) for r in rows if r[0] % 2], "_id long, label double")
    got = {r.doc_id: r.is_secret for r in secrets.scan_secrets(table, found.join(labels, "_id")).collect()}
    held = [r for r in rows if r[0] % 2 == 0]
    assert sum(got[r[0]] == r[3] for r in held) >= 0.95 * len(held)


def test_secret_scan_stays_native(spark, documents):
    plan = secrets.scan_secrets(documents)._jdf.queryExecution().toString()
    assert "Python" not in plan and "InArrow" not in plan

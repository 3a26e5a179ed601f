"""The registered queries of the training-data operators, over whole tables and with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm import (
    conversation,
    decontam,
    langid,
    packing,
    piececode,
    runs,
    secrets,
    simhash,
    substring,
    tokencount,
    tokenfile,
    urlfilter,
    vectors,
)
from shelfwise.session import checkpoint_root, scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

WORD_TOKENIZER, BYTE_TOKENIZER = "word_bpe_49k.json", "byte_bpe_50k.json"
PIECE_MODEL = "piece_bpe_32k.model"


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_best_fit_packing")
def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document, closed with id 1, in sequences of at most 4096 tokens."""
    path = public_tokenizers.path(WORD_TOKENIZER)
    return packing.pack_documents(table(spark, sf_dir, "documents"), path, capacity=4096, end_id=1)


URL_RULES = (
    urlfilter.Rule("com/", "allow"),
    urlfilter.Rule("example.com/en/", "block"),
    urlfilter.Rule("www.example.com/en/", "allow"),
    urlfilter.Rule("net/es/", "block"),
    urlfilter.Rule("net/fr/", "block"),
)

URL_SQL = r"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
parts AS (
  SELECT page_id, translate(coalesce(regexp_extract(rest, '^[^/?#]*'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM cut),
ruled AS (
  SELECT *, CASE
      WHEN ('.' || host) LIKE '%.www.example.com' AND path LIKE '/en/%' THEN 'www.example.com/en/'
      WHEN ('.' || host) LIKE '%.example.com' AND path LIKE '/en/%' THEN 'example.com/en/'
      WHEN ('.' || host) LIKE '%.net' AND path LIKE '/es/%' THEN 'net/es/'
      WHEN ('.' || host) LIKE '%.net' AND path LIKE '/fr/%' THEN 'net/fr/'
      WHEN ('.' || host) LIKE '%.com' AND path LIKE '/%' THEN 'com/' END AS rule FROM parts)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' ELSE 'allow' END AS verdict FROM ruled
"""


@query("op4_url_wildcards", URL_SQL)
def url_wildcards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's URL against the rules; allowed where none fits."""
    return urlfilter.judge_urls(table(spark, sf_dir, "pages"), URL_RULES, default="allow")


@query("op5_token_counts")
def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level tokens of every document."""
    path = public_tokenizers.path(BYTE_TOKENIZER)
    return tokencount.token_counts(table(spark, sf_dir, "documents"), path, limit=1024)


@query("op7_simhash_groups")
def simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose fingerprints over 3-word shingles are linked at 2 or fewer bits."""
    return simhash.simhash_groups(table(spark, sf_dir, "documents"), shingle=3, radius=2)


VECTORS_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.95),
reach AS (
  SELECT vec_id AS id, vec_id AS root FROM embeddings
  UNION SELECT l.b, r.root FROM reach r JOIN links l ON l.a = r.id WHERE r.root < l.b),
heads AS (SELECT id, min(root) AS component_id FROM reach GROUP BY id),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN heads ON id = vec_id LEFT JOIN counts ON a = vec_id
"""


@query("op2_embedding_pstable", VECTORS_SQL)
def embedding_pstable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of cosine 0.95 or more between all vectors, whatever their labels."""
    return vectors.link_vectors(table(spark, sf_dir, "embeddings"), threshold=0.95)


@query("op3_secret_scan")
def secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate of every document with the forest's verdict."""
    return secrets.scan_secrets(table(spark, sf_dir, "documents"))


@query("op6_language_spans")
def language_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the four fifths that are not held out."""
    found = langid.label_languages(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "held_out", "lang_pred", "score")


@query("op8_benchmark_leaks")
def benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a window 0.8 similar to a benchmark item, with their best window."""
    return decontam.benchmark_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op9_token_files")
def token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written as id files in ascending doc_id order and read back through their index."""
    checkpoint_root(spark)
    path = scratch_path(spark, "token-files")
    tokenfile.write_token_files(
        table(spark, sf_dir, "documents"), path, public_tokenizers.path(WORD_TOKENIZER), end_id=2
    )
    found = tokenfile.read_token_files(spark, path)
    return found.select(F.col("key").alias("doc_id"), "start", "n_tokens", "ids_crc32")


WINDOWS_SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
starts AS (
  SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS s FROM w WHERE len(words) >= 20),
repeated AS (
  SELECT doc_id, s, row_number() OVER (PARTITION BY array_to_string(words[s:s + 19], ' ') ORDER BY doc_id, s) AS nth
  FROM starts),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS p FROM repeated WHERE nth > 1),
gone_lists AS (SELECT doc_id, list(p) AS ps FROM gone GROUP BY doc_id),
kept AS (
  SELECT w.doc_id, len(words) AS n_words, coalesce(len(ps), 0) AS n_removed,
         list_filter(list_zip(words, range(1, len(words) + 1)), lambda x: ps IS NULL OR NOT list_contains(ps, x[2])) AS k
  FROM w LEFT JOIN gone_lists USING (doc_id))
SELECT doc_id, n_words, n_removed, sha256(array_to_string(list_transform(k, lambda x: x[1]), ' ')) AS kept_sha256 FROM kept
"""


@query("op10_repeated_windows", WINDOWS_SQL)
def repeated_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the words of 20-word windows that also start earlier."""
    found = substring.drop_repeated_windows(table(spark, sf_dir, "documents"), window=20)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


# CRC-32 of the texts of ``names(k)``, bit by bit, as ``crc(k, h)``
CRC_SQL = """
steps AS (
  SELECT k, 0 AS i, 4294967295::BIGINT AS reg FROM names
  UNION ALL
  SELECT k, i + 1, CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END FROM (
    SELECT k, i, CASE WHEN i % 8 = 0 THEN xor(reg, ascii(substr(k, i // 8 + 1, 1))::BIGINT) ELSE reg END AS x
    FROM steps WHERE i < 8 * length(k))),
crc AS (SELECT k, xor(reg, 4294967295) AS h FROM steps WHERE i = 8 * length(k))
"""

RUNS_SQL = (
    r"""
WITH RECURSIVE names AS (SELECT DISTINCT CAST(doc_id AS VARCHAR) AS k FROM documents WHERE doc_id IS NOT NULL),
"""
    + CRC_SQL
    + r""",
cut AS (
  SELECT doc_id, h, regexp_extract_all(coalesce(text, ''), '[^ 	-]+') AS w
  FROM documents LEFT JOIN crc ON k = CAST(doc_id AS VARCHAR)),
planned AS (
  SELECT *, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a,
         CASE WHEN h % 10 = 0 AND len(w) > 0 THEN 1 + (len(w) - (h // 10) % len(w)) // (3 + (h // 10) % 8) END AS p FROM cut),
words AS (
  SELECT doc_id, CASE WHEN a IS NULL THEN w
    ELSE list_transform(range(0, len(w)), lambda i: w[CASE WHEN i >= a THEN a + (i - a) % p ELSE i END + 1]) END AS w FROM planned),
grams AS (
  SELECT doc_id, i - 1 AS i, hash(w[i], w[i + 1], w[i + 2], w[i + 3], w[i + 4]) AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM words)),
pairs AS (
  SELECT a.doc_id, a.i, b.i - a.i AS q FROM grams a JOIN grams b ON a.doc_id = b.doc_id AND a.g = b.g AND b.i > a.i
  JOIN (SELECT doc_id, len(w) AS n FROM words) l ON l.doc_id = a.doc_id AND 4 * (b.i - a.i) <= n),
islands AS (
  SELECT doc_id, q, min(i) AS s, max(i) + 5 + q - min(i) AS l
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM pairs)
  GROUP BY doc_id, q, island),
found AS (
  SELECT doc_id, s, l, min(q) AS q FROM islands WHERE l >= greatest(6, 4 * q) GROUP BY doc_id, s, l),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY l::DECIMAL(38, 0) * 1000000000000 // q DESC, s, q) AS best FROM found),
lists AS (
  SELECT doc_id, count(*) AS n_runs, max(s) FILTER (best = 1) AS start, max(l) FILTER (best = 1) AS length,
         max(q) FILTER (best = 1) AS period, string_agg(concat(s, ',', l, ',', q, chr(10)), '' ORDER BY s, q) AS shown
  FROM ranked GROUP BY doc_id),
gone AS (
  SELECT doc_id, list(x) AS xs FROM (SELECT DISTINCT doc_id, unnest(range(s + q, s + l)) AS x FROM found) GROUP BY doc_id)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
       sha256(coalesce(shown, '')) AS runs_sha256,
       sha256(array_to_string(CASE WHEN xs IS NULL THEN w
         ELSE list_transform(list_filter(range(0, len(w)), lambda i: NOT list_contains(xs, i)), lambda i: w[i + 1]) END, ' '))
         AS collapsed_sha256
FROM words LEFT JOIN lists USING (doc_id) LEFT JOIN gone USING (doc_id)
"""
)


def with_periods(docs: DataFrame) -> DataFrame:
    """A tenth of the documents, by the CRC of their id, made periodic from some word on."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    cut = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), words.alias("w"), F.size(words).alias("n"))
    cut = cut.withColumn("a", F.when(F.col("n") > 0, F.expr("cast(g % n as int)")))
    cut = cut.withColumn("p", F.expr("cast(1 + (n - a) div (3 + g % 8) as int)"))
    again = F.expr("slice(flatten(array_repeat(slice(w, a + 1, p), cast((n - a) div p + 1 as int))), 1, n - a)")
    damaged = F.array_join(F.concat(F.expr("slice(w, 1, a)"), again), " ")
    return cut.select("doc_id", F.when(F.col("a").isNull(), F.col("text")).otherwise(damaged).alias("text"))


@query("op11_periodic_runs", RUNS_SQL)
def periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of six words and four periods or more in every document, a tenth of them made periodic."""
    found = runs.periodic_runs(with_periods(table(spark, sf_dir, "documents")), min_length=6, min_exponent=4)
    shown = F.transform("runs", lambda r: F.concat_ws(",", *[r[f].cast("string") for f in ("start", "length", "period")]))
    best = F.expr(
        "aggregate(runs, cast(null as struct<start:long,length:long,period:long>), (b, r) -> if(b is null"
        " or r.length * b.period > b.length * r.period, r, b))"
    )
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"best.{f}").alias(f) for f in ("start", "length", "period")],
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(shown, lambda r: F.concat(r, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("kept_text", 256).alias("collapsed_sha256"),
    )


@query("op12_sentence_pieces")
def sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SentencePiece ids of every document, and what they decode to."""
    found = piececode.encode_pieces(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECE_MODEL))
    return found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def _step(edit: str, cost: int, *states: str) -> str:
    """SQL: the least of some states' lpad(cost) || audit, each one edit further."""
    after = [f"lpad(CAST(CAST(left({s}, 9) AS BIGINT) + {cost} AS VARCHAR), 9, '0') || substr({s}, 10) || '{edit}'" for s in states]
    return ", ".join(after)


CONVERSATION_SQL = (
    r"""
WITH RECURSIVE given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
names AS (SELECT DISTINCT k FROM given),
"""
    + CRC_SQL
    + r""",
damaged AS (
  SELECT conv_id, turn, CASE WHEN h % 20 = 4 THEN 'user' ELSE role END AS role,
         CASE h % 20 WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(0, CASE WHEN h % 20 = 3 THEN 2 ELSE 1 END)) AS copy
  FROM given JOIN crc USING (k) WHERE h % 20 <> 0),
tagged AS (SELECT *, md5(concat(length(role), ':', role, text)) AS tag FROM damaged),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, tag, copy) AS pos,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen FROM tagged),
judged AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^ 	-]') THEN 'blank' WHEN seen > 1 THEN 'duplicate'
                 WHEN NOT regexp_matches(text, '[.!?][ 	-]*\z') THEN 'truncated' ELSE '' END AS fault,
         left(role, 1) AS kind,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) || left(role, 1) AS pair FROM placed),
tally AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(fault = 'blank') AS blank,
         count_if(fault = 'duplicate') AS duplicate, count_if(fault = 'truncated') AS truncated,
         count_if(pair NOT IN ('su', 'ua', 'au')) AS illegal, max(pos) AS n
  FROM judged GROUP BY conv_id),
states AS (
  SELECT conv_id, n, 0 AS pos, '000000000' AS s0, CAST(NULL AS VARCHAR) AS s1, '000000005I' AS s2, '000000010II' AS s3 FROM tally
  UNION ALL
  SELECT conv_id, n, pos, s0, s1, t2, least(t3, """
    + _step("I", 5, "t2")
    + r""") FROM (
    SELECT conv_id, n, pos, t0 AS s0, t1 AS s1, t3, least(t2, """
    + _step("I", 5, "t0", "t1", "t3")
    + r""") AS t2 FROM (
      SELECT s.conv_id, n, s.pos + 1 AS pos, """
    + _step("D", 2, "s0")
    + r""" AS t0,
        least("""
    + _step("D", 2, "s1")
    + r""", CASE WHEN stays AND kind = 's' THEN """
    + _step("L", 0, "m0")
    + r""" END) AS t1,
        least("""
    + _step("D", 2, "s2")
    + r""", CASE WHEN stays AND kind = 'u' THEN least("""
    + _step("K", 0, "m0", "m1", "m3")
    + r""") END, CASE WHEN stays THEN least("""
    + _step("R", 1, "m0", "m1", "m3")
    + r""") END) AS t2,
        least("""
    + _step("D", 2, "s3")
    + r""", CASE WHEN stays AND kind = 'a' THEN """
    + _step("K", 0, "m2")
    + r""" END, CASE WHEN stays THEN """
    + _step("R", 1, "m2")
    + r""" END) AS t3
      FROM (SELECT *, """
    + ", ".join(
        f"lpad(CAST(CAST(left(s{i}, 9) AS BIGINT) + CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END AS VARCHAR), 9, '0')"
        f" || substr(s{i}, 10) AS m{i}"
        for i in range(4)
    )
    + r""" FROM (
        SELECT s.*, j.kind, j.fault, j.fault NOT IN ('blank', 'duplicate') AS stays FROM states s
        JOIN judged j ON j.conv_id IS NOT DISTINCT FROM s.conv_id AND j.pos = s.pos + 1)) s))),
roots AS (SELECT conv_id, least(s0, s3) AS best FROM states WHERE pos = n),
audits AS (SELECT conv_id, CAST(left(best, 9) AS BIGINT) AS cost, substr(best, 10) AS edits FROM roots),
letters AS (
  SELECT conv_id, i, edits[i] AS edit, i - len(regexp_replace(edits[1:i], '[^I]', '', 'g')) AS pos,
         i - len(regexp_replace(edits[1:i], '[^D]', '', 'g')) - CASE WHEN contains(edits, 'L') THEN 1 ELSE 0 END AS place
  FROM (SELECT *, unnest(range(1, len(edits) + 1)) AS i FROM audits)),
turns AS (
  SELECT l.conv_id, l.i, concat(CASE WHEN l.edit IN ('K', 'L') THEN j.role WHEN l.place % 2 = 1 THEN 'user' ELSE 'assistant' END, ':',
         CASE WHEN l.edit = 'I' THEN '' ELSE j.text END) AS line
  FROM letters l LEFT JOIN judged j ON j.conv_id IS NOT DISTINCT FROM l.conv_id AND j.pos = l.pos WHERE l.edit <> 'D'),
repaired AS (SELECT conv_id, string_agg(line, chr(10) ORDER BY i) AS whole FROM turns GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost,
       coalesce(replace(edits, 'L', 'K'), '') AS audit, sha256(coalesce(whole, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN tally t ON t.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN audits a ON a.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM o.conv_id
"""
)


def with_faults(rows: DataFrame) -> DataFrame:
    """Turns dropped, emptied, cut, repeated or given to the user, by the CRC of conversation and turn."""
    shown = [F.coalesce(F.col(n).cast("string"), F.lit(" ")) for n in ("conv_id", "turn")]
    kind = F.crc32(F.concat_ws(":", *shown).cast("binary")) % 20
    role, text = (F.coalesce(n, F.lit(" ")) for n in ("role", "text"))
    return rows.where(kind != 0).select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.explode(F.sequence(F.lit(1), F.when(kind == 3, 2).otherwise(1))).alias("copy"),
    )


@query("op13_conversation_repair", CONVERSATION_SQL)
def conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, damaged by rule, with its faults and its cheapest repair."""
    given = table(spark, sf_dir, "conversations")
    fixed = conversation.repair_conversations(with_faults(given), given)
    lines = F.array_sort(F.collect_list(F.struct("place", F.concat_ws(":", "role", "text").alias("line"))))
    whole = fixed.turns.groupBy(F.col("conv_id").alias("_id")).agg(
        F.sha2(F.array_join(F.transform(lines, lambda t: t["line"]), "\n"), 256).alias("whole")
    )
    out = fixed.report.join(whole, F.col("conv_id").eqNullSafe(F.col("_id")), "left")
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    return out.withColumn("repaired_sha256", F.coalesce("whole", nothing)).drop("_id", "whole")

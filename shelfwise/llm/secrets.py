"""Secret scan in DataFrame functions alone: candidates by pattern, false positives removed by a random forest.

Candidates are long runs of key characters with a digit, or values of at least 6 characters assigned to a telling name,
also with blanks around the sign.  Not found: shorter values, values on the line after their name, what follows a
blank, quote, comma, semicolon, equals sign or colon inside a value, names grown onto other letters (``mypassword=``)
or not listed, and letter-only keys without a name.  Each candidate is described by
its length, its character transitions, how much of it dictionary words cover, its path and its neighbouring words; the
dictionary is counted over the distinct texts of the whole corpus, outside candidates.  A random forest learned from labelled findings gives the verdict.
"""

from __future__ import annotations

from math import ceil

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import written
from shelfwise.session import broadcast_if_small, cut_lineage

# fixed values: what a candidate looks like, and names that announce a secret
RUN = r"(?<![A-Za-z0-9+/_\-])(?=[A-Za-z+/_\-]*[0-9])[A-Za-z0-9+/_\-]{12,}"
NAMES = r"(?i)(?:password|passwd|pwd|secret|token|api_?key|access_?key|auth)"
VALUE = r"[^\s\"'=:,;]{6,}"
ASSIGN = r"(?<![A-Za-z])" + NAMES + r"[\"']?[\x20\t]*(?::=|=>|[=:])[\x20\t]*[\"']?"
BLANKS = r"[\x20\x09-\x0D]+"
MARK = "\ufdd0"  # no character of any text; stands before assigned values while they are looked up
KEYS = r"(?<![A-Za-z0-9])(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9-]{10,})(?![A-Za-z0-9])"
CANDIDATE = f"{KEYS}|{RUN}|{MARK}{VALUE}"  # in marked texts
PLACEHOLDER = (
    r"(?i)^(?:<.*>|\$?[{(\[].*[})\]]|\$[{(].*|%\(?\w*\)?s?|(.)\1*|your[-_].*|example(?:[-_].*)?|changeme|placeholder|redacted|undefined)[.)]?$"
)
WORDS = r"^\p{L}+(?:[-_./]\p{L}+)*[.!?)\]}]?$"
MASK = "[SECRET]"
PATH_HINT = r"(?i)(?:test|example|sample|fixture|mock|doc)"

SAMPLE = 20_000  # labelled findings that the forest is fitted on at most
TREES, DEPTH = 20, 6
DICTIONARY_SHARE = 2e-4  # a dictionary word stands in such a share of the distinct texts, and in two of them

FEATURES = (
    "length", "digits", "uppers", "lowers", "others", "transitions", "distinct", "hex_only", "digits_only",
    "dictionary", "path_hint", "path_depth", "inside_path", "named", "named_before", "assigned_before", "word_before",
    "word_after", "assigned",
)


def marked(text: Column) -> Column:
    """The text with ``MARK`` before every value that a telling name announces; its words keep their places."""
    return F.regexp_replace(F.replace(text, F.lit(MARK), F.lit("\ufdd1")), f"({ASSIGN})(?={VALUE})", f"$1{MARK}")


def dictionary(docs: DataFrame, text_col: str = "text", share: float = DICTIONARY_SHARE) -> DataFrame:
    """(word): lower-case letter words of 3 letters or more that stand outside candidates in a ``share`` of the distinct
    texts, and in two of them at least.  Copies of a text and repetitions inside it count once.
    """
    texts = docs.select(F.col(f"`{text_col}`").cast("string").alias("_t")).where(F.length("_t") > 0)
    texts = texts.withColumn("_h", F.xxhash64("_t"))
    copies = cut_lineage(texts.groupBy("_h").agg(F.count(F.lit(1)).alias("n")))
    least = max(2, ceil(share * copies.count()))
    copied = broadcast_if_small(copies.where(F.col("n") > 1).select("_h"))
    once = texts.join(copied, "_h", "left_anti").select("_t")
    once = once.unionByName(texts.join(copied, "_h", "left_semi").dropDuplicates(["_h"]).select("_t"))
    outside = F.lower(F.regexp_replace(marked(F.col("_t")), CANDIDATE, " "))
    every = once.select(F.explode(F.array_distinct(F.split(outside, r"[^\p{L}]+"))).alias("word"))
    every = every.where(F.length("word").between(3, 40))
    return every.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least).select("word")


def candidates(docs: DataFrame, id_col: str, text_col: str, path_col: str | None) -> DataFrame:
    """(_id, _path, word_index, candidate, assigned, word, before, before2, after), one row per candidate in reading
    order; ``assigned`` is 1 for the value of a telling name."""
    path = F.col(f"`{path_col}`").cast("string") if path_col else F.lit(None).cast("string")
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), marked(F.col(f"`{text_col}`").cast("string")).alias("_t"), path.alias("_path"))
    rows = rows.where(F.col("_t").rlike(CANDIDATE))
    found = F.element_at(
        F.transform(
            F.array(F.split("_t", BLANKS, -1)),
            lambda w: F.transform(
                F.filter(F.sequence(F.lit(0), F.size(w) - 1), lambda i: F.get(w, i).rlike(CANDIDATE)),
                lambda i: F.struct(
                    i.alias("word_index"),
                    F.get(w, i).alias("word"),
                    F.coalesce(F.get(w, i - 1), F.lit("")).alias("before"),
                    F.coalesce(F.get(w, i - 2), F.lit("")).alias("before2"),
                    F.coalesce(F.get(w, i + 1), F.lit("")).alias("after"),
                ),
            ),
        ),
        1,
    )
    placed = rows.select("_id", "_path", F.explode(found).alias("f")).select("_id", "_path", "f.*")
    hit = F.posexplode(F.regexp_extract_all("word", F.lit(CANDIDATE), F.lit(0)))
    placed = placed.select("*", hit.alias("nth", "match"))
    plain = lambda c: F.replace(F.col(c), F.lit(MARK), F.lit("")).alias(c)
    return placed.select(
        "_id", "_path", "word_index", *map(plain, ("word", "before", "before2", "after")), "nth",
        F.col("match").startswith(MARK).cast("double").alias("assigned"), plain("match").alias("candidate"),
    )


def _share(value: Column, kind: str) -> Column:
    return F.length(F.regexp_replace(value, f"[^{kind}]", "")) / F.greatest(F.length(value), F.lit(1))


def features(found: DataFrame, words: DataFrame) -> DataFrame:
    """The forest's columns beside every candidate; ``words`` is the dictionary."""
    value = F.col("candidate")
    kind = F.regexp_replace(F.regexp_replace(F.regexp_replace(value, "[0-9]", "#"), "[A-Z]", "^"), "[a-z]", "~")
    changes = F.length(F.regexp_replace(kind, r"(.)\1+", "$1")) - 1
    plain = lambda c: F.lower(F.regexp_replace(c, r"[^\p{L}]", ""))
    path = F.coalesce(F.col("_path"), F.lit(""))
    described = found.select(
        "*",
        F.length(value).cast("double").alias("length"),
        _share(value, "0-9").alias("digits"),
        _share(value, "A-Z").alias("uppers"),
        _share(value, "a-z").alias("lowers"),
        _share(value, "^A-Za-z0-9").alias("others"),
        (changes / F.greatest(F.length(value) - 1, F.lit(1))).alias("transitions"),
        (F.size(F.array_distinct(F.split(value, ""))) / F.length(value)).alias("distinct"),
        value.rlike("^[0-9a-fA-F]+$").cast("double").alias("hex_only"),
        value.rlike("^[0-9]+$").cast("double").alias("digits_only"),
        path.rlike(PATH_HINT).cast("double").alias("path_hint"),
        F.size(F.split(path, "/")).cast("double").alias("path_depth"),
        F.col("word").rlike("://|@|/.*/").cast("double").alias("inside_path"),
        F.col("word").rlike(NAMES + r"[\"']?[=:]").cast("double").alias("named"),
        F.concat_ws(" ", "before2", "before").rlike(NAMES).cast("double").alias("named_before"),
        F.col("before").rlike("[=:]$").cast("double").alias("assigned_before"),
        plain(F.col("before")).alias("_before"),
        plain(F.col("after")).alias("_after"),
        F.filter(F.split(F.lower(value), r"[^\p{L}]+"), lambda w: F.length(w) >= 3).alias("_runs"),
        F.monotonically_increasing_id().alias("_row"),
    )
    described = cut_lineage(described)
    asked = described.select(
        "_row",
        F.explode(
            F.concat(
                F.transform("_runs", lambda w: F.struct(F.lit("in").alias("use"), w.alias("w"))),
                F.array(F.struct(F.lit("before").alias("use"), F.col("_before").alias("w"))),
                F.array(F.struct(F.lit("after").alias("use"), F.col("_after").alias("w"))),
            )
        ).alias("a"),
    ).select("_row", "a.use", F.col("a.w").alias("word"))
    known = asked.join(words, "word").groupBy("_row").agg(
        F.sum(F.when(F.col("use") == "in", F.length("word"))).alias("covered"),
        F.max((F.col("use") == "before").cast("double")).alias("word_before"),
        F.max((F.col("use") == "after").cast("double")).alias("word_after"),
    )
    out = described.join(known, "_row", "left")
    out = out.withColumn("dictionary", F.coalesce(F.col("covered"), F.lit(0)) / F.col("length"))
    return out.fillna(0.0, ["word_before", "word_after"]).drop("_before", "_after", "_runs", "covered")


def drawn(labelled: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """At most ``sample`` labelled feature rows: (features, label, weight).

    Findings with the same features and label are one row, weighted by how many they are.  Of each label at most half
    of ``sample`` rows come, by hash, so that a rare label stands beside a frequent one.
    """
    columns = [F.col(c).cast("double").alias(c) for c in (*FEATURES, "label")]
    rows = labelled.select(*columns).groupBy(*FEATURES, "label").agg(F.count(F.lit(1)).cast("double").alias("weight"))
    rows = cut_lineage(rows)
    out = rows.limit(0)
    for label in (0.0, 1.0):
        order = [F.xxhash64(*FEATURES), *FEATURES]
        out = out.unionByName(rows.where(F.col("label") == label).orderBy(*order).limit(sample // 2))
    return cut_lineage(out.coalesce(1))


def fit(rows: DataFrame, seed: int = 11) -> RandomForestClassificationModel:
    """A forest from the rows of ``drawn``."""
    ready = VectorAssembler(inputCols=list(FEATURES), outputCol="vector").transform(rows)
    forest = RandomForestClassifier(
        featuresCol="vector", labelCol="label", weightCol="weight", numTrees=TREES, maxDepth=DEPTH, seed=seed,
        featureSubsetStrategy="onethird",
    )
    return forest.fit(cut_lineage(ready.select("vector", "label", "weight")))


def weak_labels(found: DataFrame) -> DataFrame:
    """Findings with a sure label, for a corpus that brings none.

    1 for known key formats, for key-like values right after a telling name, and for other values assigned to one:
    with blanks around the sign only if they hold more than letters.  0 for assigned values that are placeholders or
    dictionary words, and, without a name, for values without any letter, mostly of dictionary words, or in addresses.
    Assigned digits alone, and letters alone beyond blanks, can be either and stay without a label.
    """
    value = F.col("candidate")
    key_format = value.rlike(f"^{KEYS}$")
    key_like = value.rlike("^[A-Za-z0-9+/_-]{12,}$") & value.rlike("[0-9]") & value.rlike("[A-Za-z]")
    named = (F.col("named") > 0) | ((F.col("named_before") > 0) & F.col("before").rlike("[=:]$"))
    assigned, common = F.col("assigned") > 0, F.col("dictionary") > 0.5
    empty = value.rlike(PLACEHOLDER) | (value.rlike(WORDS) & common)
    unsure = (F.col("digits_only") > 0) | (value.rlike(WORDS) & (F.col("named") == 0))
    harmless = (F.col("digits_only") > 0) | (F.col("inside_path") > 0) | common | ~key_like
    label = F.when(key_format, 1.0).when(assigned & empty, 0.0).when(named & key_like, 1.0)
    label = label.when(assigned, F.when(~unsure, 1.0)).when(harmless, 0.0)
    return found.withColumn("label", label).where(F.col("label").isNotNull())


def scan_secrets(
    docs: DataFrame,
    labelled: DataFrame | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    path_col: str | None = "source",
    threshold: float = 0.5,
) -> DataFrame:
    """One row per candidate: id, ``word_index``, ``nth``, ``candidate``, ``probability`` and ``is_secret``.

    ``nth`` counts candidates inside one word.  ``labelled`` brings findings described by ``features`` with a
    ``label`` of 0 or 1; without it the sure cases among the corpus's own findings are the labels.  With labels of one kind
    only, that kind is the verdict on everything.  Null and empty texts hold no candidate; texts are scanned whole;
    repeated rows and rows without id give their findings each; an empty table gives an empty result; other columns
    are not read.
    """
    found = written(features(candidates(docs, id_col, text_col, path_col), dictionary(docs, text_col)), "findings")
    known = labelled if labelled is not None else weak_labels(found)
    sample = drawn(known)
    kinds = [r["label"] for r in sample.select("label").distinct().collect()]
    if len(kinds) > 1:
        scored = VectorAssembler(inputCols=list(FEATURES), outputCol="vector").transform(found)
        scored = fit(sample).transform(scored)
        scored = scored.withColumn("_p", F.element_at(vector_to_array("probability"), 2))
    else:
        scored = found.withColumn("_p", F.lit(float(kinds[0]) if kinds else 0.0))
    return scored.select(
        F.col("_id").alias(id_col),
        "word_index",
        "nth",
        "candidate",
        F.round("_p", 6).alias("probability"),
        (F.col("_p") >= threshold).alias("is_secret"),
    )


def masked_text(text: Column, places: Column, mask: str) -> Column:
    """``text`` with ``mask`` at ``places``, a map of word index to the places of candidates inside that word."""

    def masked_word(word: Column, which: Column) -> Column:
        hits = F.regexp_extract_all(word, F.lit(CANDIDATE), F.lit(0))
        shown = F.transform(hits, lambda m, n: F.when(F.array_contains(which, n), F.lit(mask)).otherwise(m))
        return F.array_join(F.zip_with(F.split(word, CANDIDATE, -1), shown, lambda r, m: F.concat(r, F.coalesce(m, F.lit("")))), "")

    whole = marked(text)
    gaps = F.regexp_extract_all(whole, F.lit(BLANKS), F.lit(0))
    words = F.transform(
        F.split(whole, BLANKS, -1),
        lambda w, i: F.when(F.map_contains_key(places, i), masked_word(w, F.element_at(places, i))).otherwise(w),
    )
    joined = F.array_join(F.zip_with(words, gaps, lambda w, g: F.concat(w, F.coalesce(g, F.lit("")))), "")
    return F.replace(joined, F.lit(MARK), F.lit(""))


def mask_secrets(
    docs: DataFrame, mask: str = MASK, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source"
) -> DataFrame:
    """The same rows and columns, with ``mask`` in place of every confirmed secret, just where it was found.

    The same characters elsewhere, as part of another word, stay.  Rows are told apart by id and text, so rows that
    share an id keep their own secrets; columns may have any names.
    """
    text = F.col(f"`{text_col}`")
    base = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_all"),
        F.struct(F.col(f"`{id_col}`").alias("id"), F.xxhash64(text).alias("tag")).alias("_key"),
        text.cast("string").alias("_text"),
        (F.col(f"`{path_col}`").cast("string") if path_col else F.lit(None).cast("string")).alias("_path"),
    )
    secrets = scan_secrets(base, None, "_key", "_text", "_path").where("is_secret")
    words = secrets.groupBy(F.col("_key").alias("_found"), "word_index").agg(F.collect_set("nth").alias("nths"))
    places = words.groupBy("_found").agg(F.map_from_entries(F.collect_list(F.struct("word_index", "nths"))).alias("_places"))
    joined = base.join(places, F.col("_key").eqNullSafe(F.col("_found")), "left")
    clean = F.when(F.col("_places").isNotNull(), masked_text(F.col("_text"), F.col("_places"), mask)).otherwise(F.col("_text"))
    return joined.select(*[(clean if c == text_col else F.col("_all").getField(c)).alias(c) for c in docs.columns])

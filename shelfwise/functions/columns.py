"""Scalar column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_double(c: Column | str) -> Column:
    return as_column(c).try_cast("double")


def or_zero(c: Column | str) -> Column:
    return F.coalesce(to_double(c), F.lit(0.0))


def text_or(default: str | None, *candidates: Column | str) -> Column:
    """First candidate that is neither NULL nor blank."""
    filled = [F.when(F.trim(as_column(c)) != "", as_column(c)) for c in candidates]
    return F.coalesce(*filled, F.lit(default))


def parse_price(c: Column | str) -> Column:
    """Number as given, else the first run of digits, dots and commas (commas dropped), else 0."""
    c = as_column(c).cast("string")
    run = F.replace(F.regexp_extract(c, r"[\d.,]+", 0), F.lit(","), F.lit(""))
    return F.coalesce(c.try_cast("double"), run.try_cast("double"), F.lit(0.0))


def parse_flag(c: Column | str) -> Column:
    return F.coalesce(F.lower(F.trim(as_column(c).cast("string"))).isin("true", "1", "yes"), F.lit(False))


def price_band(price: Column | str) -> Column:
    """Right-closed bins (0,20] (20,50] (50,100] (100,inf); anything else is NULL."""
    p = as_column(price)
    return (
        F.when((p > 0) & (p <= 20), "budget")
        .when((p > 20) & (p <= 50), "mid_range")
        .when((p > 50) & (p <= 100), "premium")
        .when(p > 100, "luxury")
    )


def clip01(c: Column) -> Column:
    """Clip to [0, 1]; NULL stays NULL."""
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(0.0)), F.lit(1.0)))


def seeded_hash(key: Column | str, salt: str, seed: int = 42) -> Column:
    return F.md5(F.concat_ws(":", as_column(key), F.lit(salt), F.lit(str(seed))))


def seeded_draw(key: Column | str, salt: str, n: int, seed: int = 42) -> Column:
    """Integer in [0, n) fixed by (key, salt, seed): the same on every run and partitioning."""
    head = F.conv(F.substring(seeded_hash(key, salt, seed), 1, 8), 16, 10).cast("bigint")
    return (head % F.lit(n)).cast("int")


def json_slice(text: Column | str) -> Column:
    """Text from the first ``{`` to the last ``}``, NULL when there is no such span."""
    return F.nullif(F.regexp_extract(as_column(text), r"(?s)\{.*\}", 0), F.lit(""))


def json_or_raw(text: Column | str) -> Column:
    """The JSON object inside a text, or the text itself under the key ``raw``."""
    found = json_slice(text)
    return F.when(F.try_parse_json(found).isNotNull(), found).otherwise(F.to_json(F.struct(as_column(text).alias("raw"))))


def base_url(url: Column | str) -> Column:
    parts = F.split(as_column(url), "/")
    return F.when(F.size(parts) >= 3, F.concat(F.get(parts, F.lit(0)), F.lit("//"), F.get(parts, F.lit(2))))


def after_marker(url: Column | str, marker: str) -> Column:
    """Path piece after the last ``marker``, without query string and slashes; NULL if absent."""
    u = as_column(url)
    tail = F.substring_index(F.substring_index(u, marker, -1), "?", 1)
    return F.when(u.contains(marker), F.trim(tail, F.lit("/")))


def shop_domain(url: Column | str) -> Column:
    host = F.get(F.split(F.get(F.split(as_column(url), "//"), F.lit(1)), "/"), F.lit(0))
    return F.replace(host, F.lit(".myshopify.com"), F.lit(""))


def clean_title(c: Column | str) -> Column:
    """Lower-case letters and digits, single blanks, capitalised words."""
    words = F.regexp_replace(F.lower(F.trim(as_column(c))), r"[^\p{L}\p{N}]+", " ")
    return F.initcap(F.trim(words))

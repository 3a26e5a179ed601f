"""Product facts from raw HTML pages and their addresses."""

from __future__ import annotations

from collections.abc import Iterator
from html import unescape
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.columns import after_marker, base_url, parse_price, shop_domain

VOID_TAGS = frozenset(  # fixed values
    "area base br col embed hr img input link meta param source track wbr".split()
)
MIN_DESCRIPTION = 20


class _PageFacts(HTMLParser):
    """Title, meta values and the texts of elements that look like a price or description."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.title = self.price_meta = self.description_meta = None
        self.found: dict[str, list[str]] = {}
        self._open: list[tuple[str, list[str], list[str]]] = []

    def handle_starttag(self, tag, attrs):
        a = {k: v or "" for k, v in attrs}
        if tag == "meta":
            if a.get("property") == "product:price:amount" and a.get("content"):
                self.price_meta = self.price_meta or a["content"]
            if a.get("name") == "description" and a.get("content"):
                self.description_meta = self.description_meta or a["content"]
        if tag in VOID_TAGS:
            return
        rules = []
        for word in ("price", "Price", "description"):
            if word in a.get("class", ""):
                rules.append(f"class:{word}")
            if a.get("id") == word:
                rules.append(f"id:{word}")
        if tag == "title" and self.title is None:
            rules.append("title")
        self._open.append((tag, rules, []))

    def handle_data(self, data):
        if not self._open or self._open[-1][0] in ("script", "style"):
            return
        for _, rules, text in self._open:
            if rules:
                text.append(data)

    def handle_endtag(self, tag):
        if not any(t == tag for t, _, _ in self._open):
            return
        while self._open:
            name, rules, text = self._open.pop()
            self._keep(rules, "".join(text))
            if name == tag:
                return

    def close(self):
        super().close()
        while self._open:
            _, rules, text = self._open.pop()
            self._keep(rules, "".join(text))

    def _keep(self, rules, text):
        for rule in rules:
            if rule == "title":
                self.title = self.title or text
            elif text.strip():
                self.found.setdefault(rule, []).append(text.strip())


# fixed values: the order in which the places are tried
PRICE_PLACES = ("class:price", "class:Price", "meta", "id:price", "id:Price")
DIGIT_PRICE_PLACES = ("class:price", "id:price", "meta")
DESCRIPTION_PLACES = ("class:description", "id:description", "meta")


def page_facts(html: str, strict: bool = False) -> tuple[str, str | None, str]:
    """(title, price text, description); ``strict`` wants digits in prices and longer descriptions."""
    page = _PageFacts()
    page.feed(html or "")
    page.close()

    def first(places, meta, accept):
        for place in places:
            texts = [meta] if place == "meta" else page.found.get(place, [])
            for text in texts:
                if text and (place == "meta" or accept(text)):
                    return text
        return None

    places = DIGIT_PRICE_PLACES if strict else PRICE_PLACES
    price = first(places, page.price_meta, lambda t: not strict or any(c.isdigit() for c in t))
    description = first(
        DESCRIPTION_PLACES, page.description_meta, lambda t: not strict or len(t) > MIN_DESCRIPTION
    )
    return page.title or "", price, description or ""


def _plain_title(html: str) -> Column:
    """Title text of a page that needs no parser, else NULL.

    Such a page mentions no price or description anywhere and its title stands
    before any script, style, comment or drawing and holds no markup.
    """
    low = F.lower(html)
    at = F.instr(low, "<title")
    clear = at > 0
    for other in ("<script", "<style", "<!--", "<svg"):
        clear = clear & ((F.instr(low, other) == 0) | (F.instr(low, other) > at))
    clear = clear & ~low.contains("price") & ~low.contains("description")
    head = F.substr(F.col(html), at)
    pattern = r"(?i)^<title[^>]*>([^<]*)</title\s*>"
    return F.when(clear & head.rlike(pattern), F.regexp_extract(head, pattern, 1))


def extract_pages(pages: DataFrame, key: str = "page_id", html: str = "html", strict: bool = False) -> DataFrame:
    """Title, price and description per page, over whole pages.

    Pages without price or description marks are settled by column expressions
    and send only their title to Python; the others go through the parser.
    """
    key_type = dict(pages.dtypes)[key]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = pd.DataFrame({key: pdf[key], "title": pdf["plain"], "price_text": None, "description": ""})
            coded = out["title"].str.contains("&", regex=False, na=False).to_numpy(dtype=bool)
            out.loc[coded, "title"] = out.loc[coded, "title"].map(unescape)
            parsed = pdf["whole"].notna().to_numpy()
            if parsed.any():
                facts = [page_facts(whole, strict) for whole in pdf.loc[parsed, "whole"]]
                out.loc[parsed, ["title", "price_text", "description"]] = pd.DataFrame(facts, dtype=object).to_numpy()
            yield out

    split = pages.select(key, html, _plain_title(html).alias("plain"))
    split = split.select(key, "plain", F.when(F.col("plain").isNull(), F.col(html)).alias("whole"))
    schema = f"{key} {key_type}, title string, price_text string, description string"
    found = split.mapInPandas(run, schema)
    return found.withColumn("price", parse_price("price_text")).drop("price_text")


def url_facts(df: DataFrame, url: str = "url") -> DataFrame:
    return df.withColumns(
        {
            "base_url": base_url(url),
            "product_slug": after_marker(url, "/product/"),
            "handle": after_marker(url, "/products/"),
            "shop_domain": shop_domain(url),
            "is_store": ~F.col(url).contains("/product/"),
        }
    )

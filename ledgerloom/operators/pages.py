"""Records out of stored web pages."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import spread_rows

# Not part of the visible page: comments, scripts and style sheets.
HIDDEN = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
ANCHOR = r"(?is)(<a\s[^>]*>)"

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


def _attribute(tag: Column, name: str) -> Column:
    """Value of a tag's attribute, quoted either way or bare; NULL if the tag lacks it."""
    shapes = [rf'(?is)\s{name}\s*=\s*"([^"]*)"', rf"(?is)\s{name}\s*=\s*'([^']*)'", rf"(?is)\s{name}\s*=\s*([^\s\"'>]+)"]
    return F.coalesce(*[F.when(tag.rlike(s), F.regexp_extract(tag, s, 1)) for s in shapes])


def _absolute(link: Column, base: Column) -> Column:
    """Link as a browser would follow it from a page at ``base``."""
    scheme = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*):", 1)
    site = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1)
    plain = F.regexp_replace(base, r"[?#].*$", "")
    folder = F.when(F.length(plain) > F.length(site), F.regexp_replace(plain, r"[^/]*$", "")).otherwise(
        F.concat(site, F.lit("/"))
    )
    return (
        F.when(link.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*:"), link)
        .when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
        .when(link.startswith("/"), F.concat(site, link))
        .when(link.startswith("#"), F.concat(F.regexp_replace(base, r"#.*$", ""), link))
        .when(link == "", base)
        .otherwise(F.concat(folder, link))
    )


def page_links(
    pages: DataFrame,
    link_class: str | None = None,
    exclude: Sequence[str] = (),
    url: str = "url",
    html: str = "html",
    absolute: bool = True,
) -> DataFrame:
    """One row (source, link) per anchor with a target, optionally only anchors of a class; excluded links dropped."""
    tags = F.regexp_extract_all(F.regexp_replace(html, HIDDEN, ""), F.lit(ANCHOR), F.lit(1))
    anchors = pages.select(F.col(url).alias("source"), F.explode(tags).alias("_tag"))
    if link_class is not None:
        classes = F.split(F.coalesce(_attribute(F.col("_tag"), "class"), F.lit("")), r"\s+")
        anchors = anchors.where(F.array_contains(classes, link_class))
    found = anchors.select("source", F.replace(_attribute(F.col("_tag"), "href"), F.lit("&amp;"), F.lit("&")).alias("link"))
    found = found.where(F.col("link").isNotNull())
    if absolute:
        found = found.withColumn("link", _absolute(F.col("link"), F.col("source")))
    return found.where(~F.col("link").isin(*exclude)) if exclude else found


class _SpecReader(HTMLParser):
    """Collects the text of elements by class: title/value pairs inside items, a level's breadcrumb, the address."""

    def __init__(self, classes: dict[str, str], level: str):
        super().__init__(convert_charrefs=True)
        self.classes, self.level = classes, level
        self.open: list[tuple[str, str | None]] = []
        self.text: dict[int, list[str]] = {}
        self.pair: dict[str, str] = {}
        self.details: dict[str, str] = {}
        self.district: str | None = None
        self.address: str | None = None

    def handle_starttag(self, tag, attrs):
        if tag in VOID:
            return
        values = dict(attrs)
        names = (values.get("class") or "").split()
        role = next((r for r, c in self.classes.items() if c in names), None)
        if role == "breadcrumb" and (self.district is not None or values.get("level") != self.level):
            role = None
        if role == "address" and self.address is not None:
            role = None
        if role == "item":
            self.pair = {}
        self.open.append((tag, role))
        if role:
            self.text[len(self.open)] = []

    def handle_data(self, data):
        for parts in self.text.values():
            parts.append(data)

    def handle_endtag(self, tag):
        if not any(name == tag for name, _ in self.open):
            return
        while self.open:
            depth = len(self.open)
            name, role = self.open.pop()
            if role:
                self._finish(role, " ".join("".join(self.text.pop(depth)).split()))
            if name == tag:
                return

    def _finish(self, role: str, text: str):
        if role in ("title", "value"):
            self.pair.setdefault(role, text)
        elif role == "item" and len(self.pair) == 2:
            self.details[self.pair["title"]] = self.pair["value"]
        elif role == "breadcrumb":
            self.district = text
        elif role == "address":
            self.address = text


def page_records(
    pages: DataFrame,
    item: str,
    title: str,
    value: str,
    breadcrumb: str,
    address: str,
    level: str = "3",
    url: str = "url",
    html: str = "html",
) -> DataFrame:
    """One row per page: (url, details map of title to value, district, address); a missing part is NULL.

    The arguments name the CSS classes of the parts. Items that lack a title or a value are skipped.
    """
    classes = {"item": item, "title": title, "value": value, "breadcrumb": breadcrumb, "address": address}

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for link, text in zip(batch["url"], batch["html"]):
                reader = _SpecReader(classes, level)
                reader.feed(text or "")
                reader.close()
                while reader.open:
                    reader.handle_endtag(reader.open[-1][0])
                rows.append((link, reader.details, reader.district, reader.address))
            yield pd.DataFrame(rows, columns=["url", "details", "district", "address"])

    source = pages.select(F.col(url).alias("url"), F.col(html).alias("html"))
    return spread_rows(source).mapInPandas(read, "url string, details map<string,string>, district string, address string")


def details_to_columns(records: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Chosen map entries as columns, NULL where a page lacks them."""
    picked = [F.try_element_at("details", F.lit(k)).alias(k) for k in keys]
    return records.select("url", *picked, "district", "address")

"""Fields of HTML pages: links and titles by pattern, blocks by CSS class."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wicketflow.functions.text import url_segment

# Elements that never have an end tag.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split())
# Class or tag.class of each field inside a match block.
MATCH_FIELDS = {"inningsinfo1": "innings-info-1", "inningsinfo2": "innings-info-2",
                "date": "span.bold", "matchstatus": "match-status"}

# A link's tag up to the value of its href; other attributes are stepped over as a whole.
LINK = (r"""(?i)<a(?=[\s/])(?:"[^"]*"|'[^']*'|[^"'>])*?[\s"'/]href\s*=\s*"""
        r"""("[^"]*"|'[^']*'|[^\s"'>]+)""")


def page_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """One row per link of a page, with the page's title and the link's place on the page.

    Tags and attributes may be in either case, `href` anywhere in its tag, and its value in
    either kind of quotes or in none.
    """
    found = F.regexp_extract_all(html, F.lit(LINK), F.lit(1))
    hrefs = F.transform(found, lambda x: F.regexp_replace(x, "^[\"']|[\"']$", ""))
    return pages.select(
        url, F.regexp_extract(html, "(?i)<title[^>]*>([^<]*)</title>", 1).alias("title"),
        F.posexplode(hrefs).alias("position", "href"))


class _Blocks(HTMLParser):
    """Collects, per element of the block class, its first link and the text of its fields."""

    def __init__(self, block: str, fields: dict[str, str]):
        super().__init__(convert_charrefs=True)
        self.block = block
        self.fields = {name: tuple(spec.rpartition(".")[::2]) for name, spec in fields.items()}
        self.open: list[tuple[str, dict | None, str | None]] = []
        self.blocks: list[dict] = []

    def handle_starttag(self, tag, attrs):
        attributes = dict(attrs)
        classes = (attributes.get("class") or "").split()
        inside = [block for _, block, _ in self.open if block is not None]
        started = None
        if self.block in classes:
            started = {"link": None, "text": {}}
            self.blocks.append(started)
            inside.append(started)
        named = None
        for block in inside:
            if block["link"] is None and attributes.get("href") is not None:
                block["link"] = attributes["href"]
            for name, (wanted_tag, wanted_class) in self.fields.items():
                if wanted_class in classes and wanted_tag in ("", tag) \
                        and name not in block["text"]:
                    block["text"][name] = []
                    named = name
        if tag not in VOID:
            self.open.append((tag, started, named))

    def handle_endtag(self, tag):
        for depth in range(len(self.open) - 1, -1, -1):
            if self.open[depth][0] == tag:
                del self.open[depth:]
                return

    def handle_data(self, data):
        named = {name for _, _, name in self.open if name}
        for _, block, _ in self.open:
            if block is not None:
                for name in named & block["text"].keys():
                    block["text"][name].append(data)


def class_blocks(pages: DataFrame, block: str, fields: dict[str, str],
                 html: str = "html") -> DataFrame:
    """One row per element of a CSS class: text of each named field and the first link inside.

    `fields` maps an output column to a class, or to `tag.class`. The element
    tree decides what lies inside a block, which a pattern cannot; pages are
    parsed in Arrow batches where they lie, without a shuffle.
    """
    keep = [c for c in pages.columns if c != html]
    types = {f.name: f.dataType.simpleString() for f in pages.schema}
    columns = [*keep, "block", *fields, "link"]
    ddl = ", ".join([*[f"`{c}` {types[c]}" for c in keep], "block int",
                     *[f"`{c}` string" for c in fields], "link string"])

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for record in batch.itertuples(index=False):
                values = record._asdict()
                parser = _Blocks(block, fields)
                parser.feed(values[html] or "")
                for number, found in enumerate(parser.blocks):
                    text = {n: "".join(found["text"][n]).strip() if n in found["text"] else None
                            for n in fields}
                    rows.append([*[values[c] for c in keep], number, *text.values(),
                                 found["link"]])
            yield pd.DataFrame(rows, columns=columns)

    return pages.select(*keep, html).mapInPandas(parse, ddl)


def match_list(pages: DataFrame, season: str = "ipl", html: str = "html") -> DataFrame:
    """Series index pages (season, html) to one row per match."""
    found = class_blocks(pages.select(season, html), "default-match-block", MATCH_FIELDS, html)
    return found.select(
        F.col(season).alias("ipl"), "date", url_segment(F.col("link"), 6).alias("eventid"),
        "inningsinfo1", "inningsinfo2", "matchstatus",
        F.regexp_replace("link", "scorecard", "commentary").alias("commentary_link"))

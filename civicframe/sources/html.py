"""Rows and fields from stored HTML pages."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicframe.functions.text import drop_blank, extract_all, squeeze
from civicframe.session import spread

# Character references that occur in ordinary page text.
NAMED_CHARACTERS = {
    "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&nbsp;": "\u00a0",
    "&copy;": "©", "&middot;": "·", "&amp;": "&",
}


def unescape(x: Column) -> Column:
    for name, char in NAMED_CHARACTERS.items():
        x = F.replace(x, F.lit(name), F.lit(char))
    return x


def links(df: DataFrame, page: str, html: str) -> DataFrame:
    """Distinct (page, link): href of every anchor, fragment and trailing slash removed."""
    found = extract_all(F.col(html), r"""<a\s[^>]*href=["']([^"']*)["']""", 1)
    link = F.regexp_replace(F.trim(F.regexp_replace(F.col("link"), "#.*$", "")), "(.)/$", "$1")
    exploded = df.select(page, F.explode(found).alias("link"))
    return exploded.select(page, link.alias("link")).filter("link <> ''").distinct()


def strip_tags(x: Column) -> Column:
    return squeeze(unescape(F.regexp_replace(x, "<[^>]*>", "")))


def tag_texts(html: Column, tag: str) -> Column:
    """Texts of all elements of one kind, without blanks."""
    inner = extract_all(html, rf"(?is)<{tag}(?:\s[^>]*)?>(.*?)</{tag}>", 1)
    return drop_blank(F.transform(inner, lambda v: strip_tags(v)))


def body_text(html: Column) -> Column:
    """All text nodes of the body, script and style content included, joined by blanks."""
    body = F.regexp_replace(html, "(?is)^.*?<body[^>]*>", "")
    no_comments = F.regexp_replace(body, "(?s)<!--.*?-->", " ")
    return squeeze(unescape(F.regexp_replace(no_comments, "<[^>]*>", " ")))


VOID_TAGS = {"br", "img", "hr", "input", "meta", "link"}


class _Reader(HTMLParser):
    """Base for the small readers below: keeps the text of the element being read."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.text: list[str] | None = None

    def handle_data(self, data):
        if self.text is not None:
            self.text.append(data)

    def take(self) -> str:
        out = " ".join("".join(self.text or []).split())
        self.text = None
        return out


class _TableReader(_Reader):
    """Rows of the first table that carries a class."""

    def __init__(self, wanted: str):
        super().__init__()
        self.wanted, self.depth, self.done, self.rows = wanted, 0, False, []

    def handle_starttag(self, tag, attrs):
        if tag == "table" and not self.done:
            classes = (dict(attrs).get("class") or "").split()
            if self.depth or self.wanted in classes:
                self.depth += 1
        elif self.depth == 1 and tag == "tr":
            self.rows.append([])
        elif self.depth == 1 and tag in ("td", "th") and self.rows:
            self.text = []

    def handle_endtag(self, tag):
        if not self.depth:
            return
        if self.depth == 1 and tag in ("td", "th") and self.text is not None:
            self.rows[-1].append(self.take() or None)
        elif tag == "table":
            self.depth -= 1
            self.done = self.depth == 0


class _SectionReader(_Reader):
    """Texts below headings: list items of the first list, or the first element that follows."""

    def __init__(self, list_title: str, block_title: str):
        super().__init__()
        self.list_title, self.block_title = list_title, block_title
        self.heading, self.state, self.block_tag = None, None, None
        self.items, self.blocks, self.nested = [], [], 0

    def handle_starttag(self, tag, attrs):
        if tag in ("h2", "h3"):
            self.heading, self.text, self.state = tag, [], None
        elif self.state == "list" and tag == "ul":
            self.state = "in_list"
        elif self.state == "in_list" and tag == "li":
            self.text = []
        elif self.state == "block":
            self.state, self.block_tag, self.nested = "in_block", tag, 0
            self.text = []
        elif self.state == "in_block":
            self._flush()
            self.nested += tag == self.block_tag

    def _flush(self):
        got = self.take()
        if got:
            self.blocks.append(got)
        self.text = []

    def handle_endtag(self, tag):
        if self.heading == tag and self.text is not None:
            title = self.take()
            if title == self.list_title and tag == "h2":
                self.state = "list"
            elif title == self.block_title:
                self.state = "block"
            self.heading = None
        elif self.state == "in_list" and tag == "li" and self.text is not None:
            got = self.take()
            if got:
                self.items.append(got)
        elif self.state == "in_list" and tag == "ul":
            self.state = None
        elif self.state == "in_block":
            self._flush()
            if tag == self.block_tag:
                if self.nested == 0:
                    self.state, self.text = None, None
                self.nested -= 1


def key_value_table(df: DataFrame, page: str, html: str, css_class: str) -> DataFrame:
    """Rows of the first table with the class, first two cells as X1 and X2, none of them missing."""
    types = dict(df.dtypes)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key, text in zip(batch[page], batch[html]):
                reader = _TableReader(css_class)
                reader.feed(text or "")
                rows += [
                    (key, i, r[0], r[1]) for i, r in enumerate(reader.rows)
                    if len(r) > 1 and r[0] is not None and r[1] is not None
                ]
            yield pd.DataFrame(rows, columns=[page, "row_no", "X1", "X2"])

    return spread(df.select(page, html)).mapInPandas(read, f"{page} {types[page]}, row_no int, X1 string, X2 string")


def section_items(html: Column, list_title: str = "Areas of Interest",
                  block_title: str = "Research Interests") -> Column:
    """Struct of the list items and the block texts below the two headings."""

    @F.pandas_udf("areas array<string>, research array<string>")
    def read(pages: pd.Series) -> pd.DataFrame:
        out = []
        for text in pages:
            reader = _SectionReader(list_title, block_title)
            reader.feed(text or "")
            out.append((reader.items, reader.blocks))
        return pd.DataFrame(out, columns=["areas", "research"])

    return read(html)


def profile_rows(df: DataFrame, html: str, title_pattern: str, email_pattern: str) -> DataFrame:
    """Fields of a profile page: title, e-mail, interests and their number."""
    text = body_text(F.col(html))
    staged = spread(df).withColumn("__text", text).withColumn("__items", section_items(F.col(html)))
    interests = F.concat("__items.areas", "__items.research")
    return staged.withColumns({
        "scraped_title": F.trim(F.regexp_extract("__text", title_pattern, 0)),
        "scraped_email": F.trim(F.regexp_extract("__text", email_pattern, 0)),
        "scraped_interests": F.array_join(interests, "; "),
        "n_interest_items": F.size(interests),
    }).drop("__text", "__items")

"""HTML documents to section texts.

Only the tag walk needs Python (nested ``div`` elements need a stack); it runs in Arrow batches
and returns all sections of a document in one array. Everything after it - category, white
space, title removal, joining - is column expressions on that array, so the job has no shuffle.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .fixed_values import SECTION_CATEGORIES, SECTION_ID_MARKS, SECTION_KEYWORDS
from .text import squeeze_spaces

SECTION_TYPE = T.ArrayType(
    T.StructType(
        [
            T.StructField("ord", T.IntegerType()),
            T.StructField("sec_id", T.StringType()),
            T.StructField("title", T.StringType()),
            T.StructField("text", T.StringType()),
        ]
    )
)

# Elements whose text is not part of the page text.
SILENT_ELEMENTS = {"script", "style", "template", "rt", "rp"}
RUBY_PARTS = {"rt", "rp"}

# Tags of common elements in their plain form, which need none of the parser's care for damaged ones.
_COMMON = "(div|span|p|b|i|br|ul|ol|li|a|strong|em|table|tr|td|th|h[1-6])"
PLAIN_START = re.compile(rf'<{_COMMON}((?: [a-z]+="[^"&]*")*)>')
PLAIN_END = re.compile(rf"</{_COMMON}>")
PLAIN_VALUE = re.compile(r' ([a-z]+)="([^"&]*)"')


class _SectionWalk(HTMLParser):
    """Collects text pieces for each open ``div.section`` and its first ``div.sectiontitle``."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.page, self.sections = [], []
        self._open = []  # one entry per open div: (section it starts, title it starts)
        self._silent = []  # open silent elements with the number of divs around each

    def updatepos(self, i, j):
        return j  # lines are not counted

    def parse_starttag(self, i):
        plain = PLAIN_START.match(self.rawdata, i)
        if plain is None:
            return super().parse_starttag(i)
        if plain[1] == "div":
            self.handle_starttag("div", PLAIN_VALUE.findall(plain[2]))
        return plain.end()

    def parse_endtag(self, i):
        plain = PLAIN_END.match(self.rawdata, i) if self.cdata_elem is None else None
        if plain is None:
            return super().parse_endtag(i)
        self.handle_endtag(plain[1])
        return plain.end()

    def handle_starttag(self, tag, attrs):
        if tag in SILENT_ELEMENTS:
            self._end_ruby(tag in RUBY_PARTS)
            self._silent.append((tag, len(self._open)))
        if tag != "div":
            return
        attrs = dict(attrs)
        classes = (attrs.get("class") or "").split()
        section = title = None
        if "sectiontitle" in classes:
            title = []
            for outer, _ in self._open:
                if outer is not None and outer["title"] is None:
                    outer["title"] = title
        if "section" in classes:
            section = {"id": attrs.get("id") or "", "title": None, "text": []}
            self.sections.append(section)
        self._open.append((section, title))

    def handle_endtag(self, tag):
        if tag in SILENT_ELEMENTS:
            last = next((n for n in range(len(self._silent) - 1, -1, -1) if self._silent[n][0] == tag), None)
            if last is not None:
                del self._silent[last:]
        self._end_ruby(tag == "ruby")
        if tag == "div" and self._open:
            self._open.pop()
            while self._silent and self._silent[-1][1] > len(self._open):
                self._silent.pop()

    def _end_ruby(self, ends):
        """Parts of a ruby text may stay open until the next part or the end of the ruby element."""
        while ends and self._silent and self._silent[-1][0] in RUBY_PARTS:
            self._silent.pop()

    def handle_data(self, data):
        piece = data.strip()
        if not piece or self._silent:
            return
        self.page.append(piece)
        for section, title in self._open:
            if section is not None:
                section["text"].append(piece)
            if title is not None:
                title.append(piece)


def _walk(html: str | None) -> list[tuple[str | None, str | None, str]]:
    """``(sec_id, title, text)`` of each section."""
    if not html:
        return []
    walk = _SectionWalk()
    walk.feed(html)
    walk.close()
    if not walk.sections:
        return [(None, None, " ".join(walk.page))]
    return [(s["id"], None if s["title"] is None else "".join(s["title"]), " ".join(s["text"])) for s in walk.sections]


@F.arrow_udf(SECTION_TYPE)
def html_sections(html: pa.Array) -> pa.Array:
    """All sections of each page in document order; a page without any is one section."""
    pages = [_walk(page) for page in html.to_pylist()]
    sizes = np.array([len(own) for own in pages], np.int32)
    edges = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    order = np.arange(edges[-1], dtype=np.int32) - np.repeat(edges[:-1], sizes)
    parts = [pa.array(order, pa.int32()), *(pa.array([s[n] for own in pages for s in own], pa.string()) for n in range(3))]
    return pa.ListArray.from_arrays(edges, pa.StructArray.from_arrays(parts, ["ord", "sec_id", "title", "text"]))


def title_category(title: Column) -> Column:
    """Category of a section title: the first category with a keyword contained in it."""
    letters = F.regexp_replace(F.lower(title), r"[^a-z\s]", "")
    result = None
    for category, words in SECTION_KEYWORDS.items():
        hit = letters.rlike("|".join(words))
        result = F.when(hit, category) if result is None else result.when(hit, category)
    return result.otherwise("other")


def id_category(sec_id: Column) -> Column:
    """Category by marks in the section id, for sections without a title element."""
    result = None
    for mark, category in SECTION_ID_MARKS:
        hit = sec_id.contains(mark)
        result = F.when(hit, category) if result is None else result.when(hit, category)
    return result.otherwise("other")


def section_category(section: Column) -> Column:
    return F.when(section["title"].isNotNull(), title_category(section["title"])).otherwise(
        id_category(section["sec_id"])
    )


def without_title(text: Column, title: Column) -> Column:
    """Drop the title where the text starts with it."""
    begins = title.isNotNull() & text.startswith(title)
    return F.when(begins, F.trim(F.substring(text, F.length(title) + 1, F.length(text)))).otherwise(text)


def categorised(sections: Column) -> Column:
    """Section array with the final text and the category of each entry."""
    return F.transform(
        sections,
        lambda s: F.struct(
            s["ord"].alias("ord"),
            section_category(s).alias("category"),
            without_title(squeeze_spaces(s["text"]), s["title"]).alias("text"),
            (F.length(squeeze_spaces(s["text"])) > 0).alias("filled"),
        ),
    )


def joined_text(sections: Column, category: str) -> Column:
    """Texts of one category in document order, one space between, blank sections left out.

    A text that only becomes blank by losing its title still counts, but not ahead of the first
    text that is not blank.
    """
    texts = F.transform(
        F.filter(sections, lambda s: (s["category"] == category) & s["filled"]), lambda s: s["text"]
    )
    first = F.array_position(F.transform(texts, lambda t: F.length(t) > 0), True)
    return F.when(first > 0, F.array_join(F.slice(texts, first.cast("int"), F.size(texts)), " ")).otherwise("")


def with_sections(df: DataFrame, html_col: str = "Resume_html") -> DataFrame:
    """Add ``skills_text``, ``experience_text``, ``education_text`` and ``other_text``.

    Null or empty HTML gives four empty strings. The input rows and columns stay as they are.
    """
    parsed = df.withColumn("_sections", html_sections(F.col(html_col)))
    parsed = parsed.withColumn("_sections", categorised(F.col("_sections")))
    return parsed.withColumns(
        {
            f"{c}_text": F.coalesce(joined_text(F.col("_sections"), c), F.lit("")) for c in SECTION_CATEGORIES
        }
    ).drop("_sections")


def section_rows(df: DataFrame, id_col: str, html_col: str) -> DataFrame:
    """Long form ``(id, ord, sec_id, title, category, text)``, one row per section."""
    exploded = df.select(id_col, F.explode(html_sections(F.col(html_col))).alias("s"))
    return exploded.select(
        id_col,
        F.col("s.ord").alias("ord"),
        F.col("s.sec_id").alias("sec_id"),
        F.col("s.title").alias("title"),
        section_category(F.col("s")).alias("category"),
        without_title(squeeze_spaces(F.col("s.text")), F.col("s.title")).alias("text"),
    )


def coverage_measures() -> list[Column]:
    """How many documents there are and have each section, and in percent."""
    has = {c: F.length(f"{c}_text") > 0 for c in ("skills", "experience", "education")}
    has["any"] = has["skills"] | has["experience"] | has["education"]
    counts = [F.count_if(v).alias(f"{k}_n") for k, v in has.items()]
    shares = [(F.count_if(v) * 100.0 / F.count("*")).alias(f"{k}_pct") for k, v in has.items()]
    return [F.count("*").alias("total"), *counts, *shares]


def section_coverage(df: DataFrame) -> DataFrame:
    """One row of ``coverage_measures``."""
    return df.agg(*coverage_measures())

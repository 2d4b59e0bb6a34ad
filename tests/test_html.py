import random
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from sheafmill.functions import html

PAGE = """
<div class="outer"><p>Profile of a gardener</p>
  <div class="section" id="SECTION_EXPR7"><div class="wrap"><div class="sectiontitle">Experience</div></div>
    <div><ruby>Head<rt>reading</ruby> of the rose garden,<br>eight
       seasons</div><div>Nursery, <b>two</b> seasons</div></div>
  <div class="section first" id="SECTION_OTHR1"><span>Likes trees</span></div>
  <div class="section" id="SECTION_HILT9"><div class="sectiontitle">Skills</div><ul><li>Pruning</li><li>Grafting, soil</li></ul></div>
  <div class="section" id="SECTION_EDUC2"><template>hidden</template><div class="sectiontitle">Education</div>School of Horticulture</div>
</div>
"""
EXPECTED = ("Pruning Grafting, soil", "Head of the rose garden, eight seasons Nursery, two seasons", "School of Horticulture", "Likes trees")


def parse(spark, page):
    row = html.with_sections(spark.createDataFrame([(page,)], "Resume_html string")).first()
    return row.skills_text, row.experience_text, row.education_text, row.other_text


def test_sections(spark):
    assert parse(spark, PAGE) == EXPECTED


def test_plain_tags_are_read_like_any(monkeypatch):
    """Tags in plain form skip the parser's own reading of a tag; pages of damaged markup among them give the same sections."""
    rng, asked = random.Random(5), []
    parts = [
        '<div class="section" id="A1">', '<div class="sectiontitle">', "</div>", "<div>", '<DIV class="section x">', "<div  class=section>", "<p>", "</p>", "<br/>", "<script>",
        "</script>", "<b>", "</b>", "a &amp; b", "text", "<", "<div", "</div", "<!--", "<title>", "</title>", '<div class="a &amp; section">', '<div class="x" class="section">', "<rt>", "</ruby>", " ",
    ]
    pages = [PAGE] + ["".join(rng.choice(parts) for _ in range(rng.randint(1, 14))) for _ in range(3000)]
    for name in ("parse_starttag", "parse_endtag"):
        slow = getattr(HTMLParser, name)
        monkeypatch.setattr(HTMLParser, name, lambda self, i, slow=slow: asked.append(i) or slow(self, i))
    found = [html._walk(page) for page in pages[:1]]
    assert len(asked) < PAGE.count("<") // 4
    found += [html._walk(page) for page in pages[1:]]
    for name in ("parse_starttag", "parse_endtag", "updatepos"):
        monkeypatch.delattr(html._SectionWalk, name)
    assert found == [html._walk(page) for page in pages]


def test_unclosed_silent_elements_lose_nothing_after_them(spark):
    later = '<div class="section" id="SECTION_EDUC1"><div class="sectiontitle">Education</div>Later text</div>'
    for part in ("<ruby>a<rt>x", "<ruby>a<rp>(<rt>x<rp>)", "<template>x", "<rt>x"):
        page = f'<div class="section" id="SECTION_EXPR1"><div class="sectiontitle">Experience</div><p>{part}</p></div>' + later
        assert parse(spark, page)[2] == "Later text"
    assert parse(spark, "<div><ruby>a<rt>x<rt>y</ruby> b</div>")[3] == "a b"


def test_no_sections(spark):
    assert parse(spark, "<div>Just <b>some</b> text<script>x()</script></div>") == ("", "", "", "Just some text")


@pytest.mark.parametrize("page", ["", None])
def test_blank(spark, page):
    assert parse(spark, page) == ("", "", "", "")


@pytest.mark.parametrize(
    "sec_id, place",
    [("SECTION_SKLL100", 0), ("SUMM", 1), ("CERT9", 2), ("NAME_EXPR", 3), ("skll", 3), ("", 3)],
)
def test_id_fallback(spark, sec_id, place):
    got = parse(spark, f'<div class="section" id="{sec_id}"><p>React</p></div>')
    assert got[place] == "React" and sum(map(len, got)) == 5


@pytest.mark.parametrize(
    "title, category",
    [
        ("Summary of Qualifications", "experience"), ("Qualifications", "education"), ("Technical Skills!", "skills"),
        ("Skills & Experience", "skills"), ("Training", "education"), ("Hobbies", "other"), ("", "other"),
    ],
)
def test_titles(spark, title, category):
    df = spark.createDataFrame([(title,)], "t string")
    assert df.select(html.title_category(F.col("t")).alias("c")).first().c == category


def test_nested_sections_repeat(spark):
    page = '<div class="section" id="EXPR"><p>outer</p><div class="section" id="EXPR"><p>inner</p></div></div>'
    assert parse(spark, page)[1] == "outer inner inner"


def test_title_with_inner_tags_stays(spark):
    page = '<div class="section"><div class="sectiontitle">Work <b>History</b></div><p>text</p></div>'
    # the title reads "WorkHistory", the body "Work History text": nothing to strip, no keyword
    assert parse(spark, page)[3] == "Work History text"


def test_several_of_one_kind(spark):
    page = "".join(f'<div class="section" id="SKLL"><p>{x}</p></div>' for x in ("a", "", "b"))
    assert parse(spark, page)[0] == "a b"


def test_entities_comments_and_broken_tags(spark):
    assert parse(spark, '<div class="section" id="SKLL"><p>R&amp;D<!-- x --> now</div></div><p>rest')[0] == "R&D now"


def test_coverage_and_input_unchanged(spark):
    df = spark.createDataFrame([(PAGE, "IT"), ("<p>x</p>", "OTHER")], "Resume_html string, Category string")
    parsed = html.with_sections(df)
    assert df.columns == ["Resume_html", "Category"] and parsed.count() == 2
    row = html.section_coverage(parsed).first()
    assert (row.total, row.skills_n, row.any_n, row.skills_pct) == (2, 1, 1, 50.0)


def test_rows(spark):
    rows = html.section_rows(spark.createDataFrame([(7, PAGE)], "id int, h string"), "id", "h").orderBy("ord").collect()
    assert [(r.ord, r.category, r.title) for r in rows] == [
        (0, "experience", "Experience"), (1, "other", None), (2, "skills", "Skills"), (3, "education", "Education"),
    ]

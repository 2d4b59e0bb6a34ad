"""Views over the warehouse tables that the named queries read.

The tables hold no section pages, so ``profiles`` writes one HTML page per customer from fields
that vary with its columns. The view text is plain SQL that any engine can run; it keeps the
source fields beside the page, so results can be checked without parsing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.vectors import from_array
from ..session import spread

PROFILE_FIELDS = """
SELECT c_custkey AS doc_id, c_mktsegment AS category, c_acctbal AS balance, c_nationkey AS nation,
  CASE c_custkey % 5 WHEN 0 THEN 'Skills' WHEN 1 THEN 'Technical Skills' WHEN 2 THEN 'Core Competencies'
    WHEN 3 THEN 'Areas of Expertise' ELSE 'Highlights' END AS title_skills,
  CASE c_custkey % 4 WHEN 0 THEN 'Experience' WHEN 1 THEN 'Work History' WHEN 2 THEN 'Professional Summary'
    ELSE 'Summary of Qualifications' END AS title_exp,
  CASE c_custkey % 3 WHEN 0 THEN 'Education & Training' WHEN 1 THEN 'Qualifications' ELSE 'Certifications' END AS title_edu,
  c_custkey % 7 = 3 AS skills_untitled, c_custkey % 11 = 4 AS exp_untitled, c_custkey % 13 = 5 AS no_sections,
  CASE c_custkey % 6 WHEN 0 THEN 'Python, Java, SQL and machine learning' WHEN 1 THEN 'JS, Node.js, React.js, CSS3'
    WHEN 2 THEN 'C++, C#, .NET and databases' WHEN 3 THEN 'AWS, k8s, Docker, CI/CD'
    WHEN 4 THEN 'ML, NLP, Spark, Hadoop clusters' ELSE 'Excel, PowerPoint, SAP, CRM' END
  || '; ' ||
  CASE (c_nationkey * 3 + c_custkey) % 8 WHEN 0 THEN 'project management' WHEN 1 THEN 'budgets and forecasts'
    WHEN 2 THEN 'Linux, Unix.' WHEN 3 THEN 'Tableau dashboards' WHEN 4 THEN 'agile, scrum, JIRA'
    WHEN 5 THEN 'SEO and branches' WHEN 6 THEN 'REST APIs' ELSE 'SQL, ETL, Python' END AS skills_src,
  CASE c_custkey % 9 WHEN 0 THEN 'CEO' WHEN 1 THEN 'Director of Sales' WHEN 2 THEN 'Project Manager'
    WHEN 3 THEN 'Lead Engineer' WHEN 4 THEN 'Senior Analyst' WHEN 5 THEN 'Sales Associate'
    WHEN 6 THEN 'Junior Developer' WHEN 7 THEN 'Intern' ELSE 'Consultant' END AS job,
  CASE c_custkey % 9 WHEN 0 THEN 7 WHEN 1 THEN 6 WHEN 2 THEN 5 WHEN 3 THEN 4 WHEN 4 THEN 3 WHEN 5 THEN 2
    WHEN 6 THEN 1 ELSE 0 END AS job_rank,
  1 + c_custkey % 31 AS years,
  CASE WHEN c_custkey % 5 = 4 THEN 0 ELSE 1 + c_custkey % 31 END AS years_named,
  CASE c_custkey % 5 WHEN 0 THEN '@+ years of experience' WHEN 1 THEN 'over @ years in forestry'
    WHEN 2 THEN '@ yrs working abroad' WHEN 3 THEN 'about @ yrs, @ years of exp' ELSE 'worked with teams' END AS years_phrase,
  CASE c_custkey % 8 WHEN 0 THEN 'PhD in Geology' WHEN 1 THEN 'Master of Science in Forestry' WHEN 2 THEN 'MBA from Utrecht'
    WHEN 3 THEN 'Bachelor of Arts in Music' WHEN 4 THEN 'Associate''s degree in Welding'
    WHEN 5 THEN 'Diploma in Ceramics' WHEN 6 THEN 'Riverside High School' ELSE 'courses by post' END AS degree_src,
  CASE c_custkey % 8 WHEN 0 THEN 'phd' WHEN 1 THEN 'masters' WHEN 2 THEN 'masters' WHEN 3 THEN 'bachelors'
    WHEN 4 THEN 'associates' WHEN 5 THEN 'diploma' WHEN 6 THEN 'high_school' ELSE 'unknown' END AS degree_named
FROM {customer}
"""

PROFILE_TEXTS = (
    """
SELECT *,
  job || ' at Supplier#' || lpad(CAST(doc_id % 100 AS STRING), 9, '0') || ' in NATION_' || CAST(nation AS STRING)
    || ', ' || replace(years_phrase, '@', CAST(years AS STRING)) AS exp_src,
  degree_src || ', '
    || CASE nation % 4 WHEN 0 THEN 'State University' WHEN 1 THEN 'City College' WHEN 2 THEN 'Technical Institute'
       ELSE 'Open Campus' END AS edu_src,
  c_name_of_page AS name_src
FROM (SELECT *, 'Customer ' || CAST(doc_id AS STRING) AS c_name_of_page FROM ("""
    + PROFILE_FIELDS
    + """) f) g
"""
)

PROFILES_SQL = (
    """
SELECT *,
  CASE WHEN no_sections THEN '<div><p>' || skills_src || '</p><p>' || exp_src || '</p></div>' ELSE
  '<div id="document"><div class="section firstsection" id="SECTION_NAME' || CAST(doc_id AS STRING)
  || '"><div class="name"><span>' || name_src || '</span></div></div><div class="section" id="SECTION_HILT1">'
  || CASE WHEN skills_untitled THEN '' ELSE '<div class="heading"><div class="sectiontitle">' || title_skills || '</div></div>' END
  || '<div class="paragraph">' || skills_src || '</div></div><!-- gap --><div class="section" id="SECTION_EXPR2">'
  || CASE WHEN exp_untitled THEN '' ELSE '<div class="heading"><div class="sectiontitle">' || title_exp || '</div></div>' END
  || '<div class="paragraph">  ' || job || ' at Supplier#' || lpad(CAST(doc_id % 100 AS STRING), 9, '0')
  || ' in <b>NATION_' || CAST(nation AS STRING) || ',</b><br> ' || replace(years_phrase, '@', CAST(years AS STRING))
  || '</div></div><div class="section" id="SECTION_EDUC3"><div class="sectiontitle">' || replace(title_edu, '&', '&amp;')
  || '</div><p>' || edu_src || '</p><script>var x = "hidden";</script></div></div>' END AS html
FROM ("""
    + PROFILE_TEXTS
    + """) t
"""
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page per customer with the fields it was written from."""
    return spark.sql(PROFILES_SQL, customer=spread(read_table(spark, sf_dir, "customer")))


def baskets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the distinct names of their parts and the distinct words of those names.

    The line items are grouped on the order key before orders are joined, so that join reuses the
    grouping's partitioning and only orders move.
    """
    lines = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    parts = read_table(spark, sf_dir, "part").select("p_partkey", "p_name")
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    named = lines.join(parts, lines.l_partkey == parts.p_partkey)
    grouped = named.groupBy("l_orderkey").agg(F.array_sort(F.collect_set("p_name")).alias("names"))
    words = F.array_sort(F.array_distinct(F.flatten(F.transform("names", lambda n: F.split(n, " ")))))
    return grouped.join(orders, grouped.l_orderkey == orders.o_orderkey).select(
        F.col("o_orderkey").alias("order_id"), "names", words.alias("words"), F.col("o_orderpriority").alias("category")
    )


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, with the language as class."""
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text", F.col("lang").alias("category"))
    return spread(documents)


def judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality and toxicity judgements with a four-way class."""
    labels = read_table(spark, sf_dir, "labels")
    return labels.select("doc_id", "quality", "toxic", (F.col("quality") * 2 + F.col("toxic")).alias("label"))


def ranked_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with a class that follows from two of four numbers, urgency and status; every fifth order is for testing."""
    orders = spread(read_table(spark, sf_dir, "orders"))
    urgency = F.substring("o_orderpriority", 1, 1).cast("double")
    status = F.instr(F.lit("FOP"), F.col("o_orderstatus")).cast("double")
    numbers = F.array(urgency, status, (F.col("o_custkey") % 11).cast("double"), F.floor(F.col("o_totalprice") / 10_000).cast("double"))
    label = F.when(urgency <= 2, 1.0).otherwise(0.0) + F.when(status == 2, 2.0).otherwise(0.0)
    split = F.when(F.col("o_orderkey") % 5 == 0, "test").otherwise("train")
    return orders.select("o_orderkey", label.alias("label"), split.alias("split"), from_array(numbers, 4).alias("flat"))


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
LINE_CLASSES = ["AF", "AO", "NF", "NO", "RF", "RO"]


def flagged_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with return flag and status together as class, on a column per flag and per status beside two that do not tell it."""
    lines = spread(read_table(spark, sf_dir, "lineitem"))
    both = F.concat("l_returnflag", "l_linestatus")
    marks = [F.col("l_returnflag") == f for f in "ANR"] + [F.col("l_linestatus") == s for s in "FO"]
    numbers = F.array(*(m.cast("double") for m in marks), F.col("l_quantity"), F.col("l_discount"))
    label = F.array_position(F.array(*map(F.lit, LINE_CLASSES)), both) - 1
    split = F.when(F.col("l_orderkey") % 5 == 0, "test").otherwise("train")
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return lines.select(F.struct(*keys).alias("line"), label.cast("double").alias("label"), split.alias("split"), from_array(numbers, 7).alias("flat"))


def vecs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "embeddings")


def section_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles after the parse stage: section texts, tokens and attributes."""
    from ..functions.html import with_sections
    from ..functions.text import with_section_attributes

    parsed = with_sections(profiles(spark, sf_dir).select("doc_id", "category", "html"), "html")
    whole = F.concat_ws(" ", "other_text", "skills_text", "experience_text", "education_text")
    return with_section_attributes(parsed).withColumn("full_text", whole).drop("html")

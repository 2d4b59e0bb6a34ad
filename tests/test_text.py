import pytest
from pyspark.sql import functions as F

from sheafmill.functions import entities, text
from sheafmill.functions.handcrafted import BASE_NAMES, degree_code, handcrafted


def one(spark, value, fn):
    return spark.createDataFrame([(value,)], "t string").select(fn(F.col("t")).alias("r")).first().r


@pytest.mark.parametrize(
    "value, years",
    [
        ("21+ years of experience at sea", 21),
        ("baked bread for over 14 years in Ghent", 14),
        ("2 years in a mill, then 9 years of experience on the docks", 9),
        ("some 6 yrs, all told 11 yrs exp", 11),
        ("88888888888888888888 years of experience", 0),
        ("kept the harbour lights", 0),
        ("", 0),
        (None, 0),
    ],
)
def test_years(spark, value, years):
    assert one(spark, value, text.years_experience) == years


@pytest.mark.parametrize(
    "value, level",
    [
        ("wrote a PhD on tides", "phd"),
        ("holds the Ph.D", "phd"),
        ("Master of Science, oceanography", "masters"),
        ("evening MBA while at sea", "masters"),
        ("Bachelor of Arts, Old Norse", "bachelors"),
        ("Associate's degree, ship repair", "associates"),
        ("sailed as a cook", "associates"),
        ("Bachelor of Science first and a Master of Science after it", "masters"),
        ("holds a certification for cranes", "diploma"),
        ("Harbour High School", "high_school"),
        ("learnt on deck", "unknown"),
        ("éas", "unknown"),
        ("", "unknown"),
        (None, "unknown"),
    ],
)
def test_degree(spark, value, level):
    assert one(spark, value, text.degree_level) == level


@pytest.mark.parametrize(
    "value, rank",
    [
        ("Vice  President", 7), ("CTO", 7), ("Director", 6), ("project manager", 5), ("Staff engineer", 4), ("Sr. analyst", 3),
        ("mid-level dev", 2), ("entry level", 1), ("trainee", 0), ("leader", 0), (None, 0),
    ],
)
def test_seniority(spark, value, rank):
    assert one(spark, value, text.seniority) == rank


def test_word_tokens(spark):
    tokens = one(spark, "I am a Good programmer. C# and Node.js, CI/CD; C++!  Really...", text.word_tokens)
    assert tokens == ["good", "programmer", "node.js", "ci/cd", "c++", "really"]
    assert one(spark, "", text.word_tokens) == []
    assert one(spark, None, text.word_tokens) == []


def test_lemmas(spark):
    tokens = one(spark, "running companies successfully with classes, boxes, men, analysis, aws, status", text.section_tokens)
    assert tokens == ["running", "company", "successfully", "class", "box", "man", "analysis", "aws", "status"]


def test_lemma_table(spark):
    df = spark.createDataFrame([(1, ["ran", "x", "ran"]), (2, []), (3, None)], "id int, t array<string>")
    lemmas = spark.createDataFrame([("ran", "run"), ("unused", "u")], "form string, lemma string")
    out = {r.id: r.t for r in text.lemmatise_with_table(df, "id", "t", lemmas).collect()}
    assert out == {1: ["run", "x", "run"], 2: [], 3: None}


@pytest.mark.parametrize(
    "value, expected",
    [("moved a dock's rosters to aws with docker", {"docker", "amazon web services"}), ("wrote the crane's control in c++", {"cplusplus"}), ("stock lists in ms sql", {"sql"})],
)
def test_synonyms(spark, value, expected):
    assert expected <= set(one(spark, value, text.skill_tokens))


def test_item_set(spark):
    assert one(spark, "python java python sql", lambda c: text.item_set(text.skill_tokens(c))) == ["java", "python", "sql"]


def test_attributes(spark):
    df = spark.createDataFrame(
        [("Python Java SQL", "10 years of experience on a tug", "Master of Science"), (None, None, None)],
        "skills_text string, experience_text string, education_text string",
    )
    rows = text.with_section_attributes(df).collect()
    assert (rows[0].years_experience, rows[0].degree_level, rows[0].num_skills) == (10, "masters", 3)
    assert (rows[1].skills_tokens, rows[1].years_experience, rows[1].degree_level, rows[1].num_skills) == ([], 0, "unknown", 0)
    stats = text.token_statistics(text.with_section_attributes(df)).first()
    assert stats.with_years == 1 and stats.total == 2


def test_tokens_to_text_and_encoder_input(spark):
    df = spark.createDataFrame([(["a", "b c"],), ([],), (None,)], "t array<string>")
    assert [r.r for r in df.select(text.tokens_to_text(F.col("t")).alias("r")).collect()] == ["a b c", "", ""]
    assert one(spark, "", text.encoder_input) == "empty" and one(spark, None, text.encoder_input) == "empty"
    assert one(spark, "x" * 600, text.encoder_input) == "x" * 600
    assert one(spark, "x" * 600, lambda c: text.encoder_input(c, 512)) == "x" * 512


def test_entities(spark):
    docs = spark.createDataFrame([(1, "Acme Corp, of Paris; acme corp again. New York!"), (2, ""), (3, None)], "id int, t string")
    known = spark.createDataFrame([("Acme Corp", "ORG"), ("PARIS", "GPE"), ("new york", "GPE"), ("york", "ORG")], "phrase string, type string")
    out = {r.id: (r.org_count, r.gpe_count) for r in entities.entity_counts(docs, "id", "t", known).collect()}
    assert out == {1: (2, 2), 2: (0, 0), 3: (0, 0)}


def test_entities_in_the_row_like_joined_ones(spark):
    texts = ["Acme Corp, of Paris; acme corp again. New York!", "", None, "in new york city and york and new-york", "PARIS paris", "the old port authority of new york", "straße ÉTÉ"]
    docs = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    known = [("Acme Corp", "ORG"), ("PARIS", "GPE"), ("new york", "GPE"), ("york", "ORG"), ("york", "GPE"), ("Old Port Authority of New York", "ORG"), ("été", "GPE"), ("", "GPE"), ("paris", "OTHER"), (None, "ORG")]
    known = spark.createDataFrame(known, "phrase string, type string")
    joined = {r.id: (r.org_count, r.gpe_count) for r in entities.entity_counts(docs, "id", "t", known, 6).collect()}
    for most in (1 << 20, 0):
        found = entities.with_entity_counts(docs, "id", "t", known, most_bytes=most)
        assert {r.id: (r.org_count, r.gpe_count) for r in found.collect()} == joined
        assert found.columns == ["id", "t", "org_count", "gpe_count"]
    assert joined[5] == (2, 2) and joined[3] == (1, 2)
    nothing = entities.with_entity_counts(docs, "id", "t", known.where("false")).collect()
    assert {(r.org_count, r.gpe_count) for r in nothing} == {(0, 0)}


def test_handcrafted(spark):
    df = spark.createDataFrame(
        [(5, "bachelors", 2, ["a", "b"], ["c"], None, "Senior clerk"), (None, "what", None, None, None, None, None)],
        "years_experience bigint, degree_level string, num_skills int, skills_tokens array<string>, "
        "experience_tokens array<string>, education_tokens array<string>, t string",
    )
    rows = [r.h for r in df.select(handcrafted("t").alias("h")).collect()]
    assert rows == [[5.0, 4.0, 2.0, 2.0, 1.0, 0.0, 12.0, 3.0], [0.0] * 8] and len(BASE_NAMES) == 8
    codes = spark.createDataFrame([("bachelors",), ("masters",), ("phd",), (None,)], "l string")
    assert [r.c for r in codes.select(degree_code(F.col("l")).alias("c")).collect()] == [4, 5, 6, 0]


LEMMAS = {
    "series": "series", "species": "species", "movies": "movie", "cookies": "cookie", "news": "news", "bias": "bias", "texas": "texas",
    "physics": "physics", "economics": "economics", "analytics": "analytics", "logistics": "logistics", "buses": "bus", "biases": "bias",
    "companies": "company", "processes": "process", "boxes": "box", "metrics": "metric", "houses": "house", "status": "status", "statuses": "status",
    "skills": "skill", "analysis": "analysis", "analyses": "analysis", "women": "woman", "class": "class", "databases": "database", "viruses": "virus",
}


def test_lemmas_written_by_hand(spark):
    df = spark.createDataFrame([(w,) for w in LEMMAS], "w string")
    assert {r.w: r.l for r in df.select("w", text.noun_lemma(F.col("w")).alias("l")).collect()} == LEMMAS

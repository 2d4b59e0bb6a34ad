"""Text functions as column expressions; all of them run inside the JVM, row by row, without a shuffle."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from .fixed_values import (
    DEGREE_PATTERNS,
    ENGLISH_STOP_WORDS,
    IRREGULAR_NOUNS,
    SENIORITY_PATTERNS,
    SKILL_SYNONYMS,
    YEARS_PATTERNS,
)


def no_tokens() -> Column:
    return F.array().cast("array<string>")


def _literal_map(mapping: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])


def squeeze_spaces(text: Column) -> Column:
    """Runs of white space become one space; both ends trimmed."""
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def clean_text(text: Column) -> Column:
    """Lower case, only ``a-z 0-9 . + # /`` and single spaces left."""
    return squeeze_spaces(F.regexp_replace(F.lower(text), r"[^a-z0-9\s.+#/]", " "))


def word_tokens(text: Column, stop_words: Iterable[str] = ENGLISH_STOP_WORDS) -> Column:
    """Words of the cleaned text, in order, without stop words and one-letter words.

    ``#`` separates words and dots at the end of a word are dropped; inner dots, ``+`` and ``/``
    stay, so ``node.js``, ``c++`` and ``ci/cd`` are single words. Null gives an empty array.
    """
    spaced = F.regexp_replace(clean_text(text), "#", " ")
    undotted = F.regexp_replace(spaced, r"\.+( |$)", "$1")
    stop = list(stop_words)

    def keep(word: Column) -> Column:
        long_enough = F.length(word) > 1
        return long_enough & ~word.isin(stop) if stop else long_enough

    return F.coalesce(F.filter(F.split(F.trim(undotted), " +"), keep), no_tokens())


def noun_lemma(word: Column, keep: Iterable[str] = tuple(SKILL_SYNONYMS)) -> Column:
    """Singular form by the usual English noun suffix rules.

    There is no dictionary to look a candidate up in, so short words, words in ``keep`` and
    endings that are rarely plural (``ss us is os``) are left alone. ``lemmatise_with_table``
    uses a dictionary instead.
    """
    irregular = _literal_map(IRREGULAR_NOUNS)
    size = F.length(word)
    drop = lambda n, tail="": F.concat(F.substring(word, F.lit(1), size - n), F.lit(tail))
    return (
        F.when(word.isin(list(IRREGULAR_NOUNS)), F.element_at(irregular, word))
        .when((size < 4) | ~word.endswith("s") | word.isin(list(keep)), word)
        .when(word.endswith("ies") & (size > 4), drop(3, "y"))
        .when(word.rlike("(sses|shes|ches|xes|zzes)$"), drop(2))
        .when(word.rlike("(ss|us|is|os)$"), word)
        .otherwise(drop(1))
    )


def lemmatise(tokens: Column) -> Column:
    return F.transform(tokens, lambda t: noun_lemma(t))


def lemmatise_with_table(df: DataFrame, id_col: str, tokens_col: str, lemmas: DataFrame) -> DataFrame:
    """Replace tokens through a dictionary table ``(form, lemma)``; other tokens pass.

    The dictionary may be of any size: Spark broadcasts it when its measured size allows, and
    otherwise shuffles the words, where AQE splits the few that make up much of any text. The
    words of a document are put together again by position, first map-side.
    """
    table = lemmas.groupBy("form").agg(F.min("lemma").alias("lemma"))
    words = df.select(id_col, F.posexplode(tokens_col).alias("pos", "form")).join(table, "form", "left")
    placed = F.struct("pos", F.coalesce("lemma", "form").alias("word"))
    again = words.groupBy(id_col).agg(F.sort_array(F.collect_list(placed)).alias("_placed"))
    again = again.select(id_col, F.col("_placed.word").alias("_words"))
    return df.join(again, id_col, "left").withColumn(tokens_col, F.coalesce("_words", tokens_col)).drop("_words")


def section_tokens(text: Column, stop_words: Iterable[str] = ENGLISH_STOP_WORDS) -> Column:
    """Words, then lemmas: the token list of an experience or education text."""
    return lemmatise(word_tokens(text, stop_words))


def normalise_synonyms(tokens: Column, synonyms: dict[str, str] = SKILL_SYNONYMS) -> Column:
    """Token-wise lookup; the set test is hashed, only hits reach the map."""
    table = _literal_map(synonyms)
    keys = list(synonyms)
    return F.transform(tokens, lambda t: F.when(t.isin(keys), F.element_at(table, t)).otherwise(t))


def skill_tokens(
    text: Column,
    synonyms: dict[str, str] = SKILL_SYNONYMS,
    stop_words: Iterable[str] = ENGLISH_STOP_WORDS,
) -> Column:
    return normalise_synonyms(section_tokens(text, stop_words), synonyms)


def item_set(tokens: Column) -> Column:
    """Distinct tokens, sorted."""
    return F.array_sort(F.array_distinct(tokens))


def tokens_to_text(tokens: Column) -> Column:
    return F.coalesce(F.array_join(tokens, " "), F.lit(""))


def years_experience(text: Column) -> Column:
    """Largest number of years named by any of the patterns; 0 when there is none."""
    lowered = F.lower(text)
    hits = F.concat(*[F.regexp_extract_all(lowered, F.lit("(?U)" + p), F.lit(1)) for p in YEARS_PATTERNS])
    return F.coalesce(F.array_max(F.transform(hits, lambda x: x.try_cast("bigint"))), F.lit(0).cast("bigint"))


def _first_match(text: Column, patterns: list, default) -> Column:
    lowered = F.lower(text)
    result = None
    for pattern, value in patterns:
        hit = lowered.rlike("(?U)" + pattern)
        result = F.when(hit, F.lit(value)) if result is None else result.when(hit, F.lit(value))
    return result.otherwise(F.lit(default))


def degree_level(text: Column) -> Column:
    """Highest degree named in the text, else ``unknown``."""
    return _first_match(text, DEGREE_PATTERNS, "unknown")


def seniority(text: Column) -> Column:
    """Rank 0 to 7 of the most senior job title named in the text."""
    return _first_match(text, SENIORITY_PATTERNS, 0)


def encoder_input(text: Column, max_chars: int | None = None) -> Column:
    """Text handed to a sentence encoder: blank becomes ``empty``.

    The whole text is used unless ``max_chars`` is given.
    """
    filled = F.when(F.length(F.coalesce(text, F.lit(""))) > 0, text).otherwise(F.lit("empty"))
    return filled if max_chars is None else F.substring(filled, 1, max_chars)


def with_section_attributes(df: DataFrame, lemmas: DataFrame | None = None, id_col: str = "ID") -> DataFrame:
    """Add the token lists of the three sections, years, degree and the skill count.

    With a dictionary ``lemmas`` (``form, lemma``) words are looked up there instead of following the noun rules; ``id_col`` must be
    unique for that.
    """
    if lemmas is None:
        tokens = {s: section_tokens(F.col(f"{s}_text")) for s in ("skills", "experience", "education")}
    else:
        for s in ("skills", "experience", "education"):
            df = lemmatise_with_table(df.withColumn(f"{s}_tokens", word_tokens(F.col(f"{s}_text"))), id_col, f"{s}_tokens", lemmas)
        tokens = {s: F.col(f"{s}_tokens") for s in ("skills", "experience", "education")}
    return df.withColumns(
        {
            "skills_tokens": normalise_synonyms(tokens["skills"]),
            "experience_tokens": tokens["experience"],
            "education_tokens": tokens["education"],
            "years_experience": years_experience(F.col("experience_text")),
            "degree_level": degree_level(F.col("education_text")),
        }
    ).withColumn("num_skills", F.size("skills_tokens"))


def token_measures() -> list[Column]:
    """Mean token counts of the sections and the number of rows with years found."""
    return [
        F.avg("num_skills").alias("avg_skills_tokens"),
        F.avg(F.size("experience_tokens")).alias("avg_experience_tokens"),
        F.avg(F.size("education_tokens")).alias("avg_education_tokens"),
        F.count_if(F.col("years_experience") > 0).alias("with_years"),
        F.count("*").alias("total"),
    ]


def token_statistics(df: DataFrame) -> DataFrame:
    """One row of ``token_measures``."""
    return df.agg(*token_measures())


def degree_histogram(df: DataFrame) -> DataFrame:
    return df.groupBy("degree_level").agg(F.count("*").alias("n"))

"""Organisation and place mentions, found through a phrase table.

This is a lookup of known phrases, not a statistical recogniser.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

#: Bytes of a phrase table that one automaton is made of in every worker; larger tables are joined.
AUTOMATON_BYTES = 32 << 20
ENTITY_TYPES = ("ORG", "GPE")

ENTITY_WORD = r"[\p{L}\p{N}_]+"


def phrase_words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(ENTITY_WORD), F.lit(0))


def phrase_key(text: Column) -> Column:
    """Spelling under which phrases are compared."""
    return F.array_join(phrase_words(text), " ")


def _phrases(words: Column, size: int) -> Column:
    last = F.size(words) - size
    starts = F.when(last >= 0, F.sequence(F.lit(1), F.greatest(last, F.lit(0)) + 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.array_join(F.slice(words, i, F.lit(size)), " "))


def entity_counts(
    df: DataFrame, id_col: str, text_col: str, gazetteer: DataFrame, max_words: int = 3, max_chars: int | None = None
) -> DataFrame:
    """``(id, org_count, gpe_count)`` of the distinct known phrases in each text.

    ``gazetteer`` has ``phrase`` and ``type`` (``ORG`` or ``GPE``). It may be of any size: Spark
    broadcasts it when its measured size allows. Distinct phrases are taken inside each row before
    anything is joined. The whole text is read unless ``max_chars`` is given.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    text = text if max_chars is None else F.substring(text, 1, max_chars)
    known = gazetteer.select(phrase_key(F.col("phrase")).alias("phrase"), "type").distinct()
    words = df.select(id_col, phrase_words(text).alias("w"))
    every = F.array_distinct(F.concat(*[_phrases(F.col("w"), n) for n in range(1, max_words + 1)]))
    hits = words.select(id_col, F.explode(every).alias("phrase")).join(known, "phrase")
    counts = hits.groupBy(id_col).agg(
        F.count_if(F.col("type") == "ORG").alias("org_count"), F.count_if(F.col("type") == "GPE").alias("gpe_count")
    )
    return df.select(id_col).join(counts, id_col, "left").na.fill(0, ["org_count", "gpe_count"])


def with_entity_counts(df: DataFrame, id_col: str, text_col: str, gazetteer: DataFrame, max_chars: int | None = None, most_bytes: int = AUTOMATON_BYTES) -> DataFrame:
    """``df`` with ``org_count`` and ``gpe_count``: the distinct known phrases in each text, counted where the text is.

    One Aho-Corasick automaton finds all phrases, of any number of words, in one pass over the words of a row; nothing is
    joined. A table of more than ``most_bytes`` is joined by phrase instead, with the same counts. ``id_col`` must be
    unique for that.
    """
    known = gazetteer.select(phrase_key(F.col("phrase")).alias("phrase"), "type").where(F.col("type").isin(*ENTITY_TYPES) & (F.col("phrase") != "")).distinct()
    size = known.agg(F.coalesce(F.sum(F.octet_length("phrase") + 16), F.lit(0)), F.max(F.size(F.split("phrase", " ")))).first()
    text = F.coalesce(F.col(text_col), F.lit(""))
    text = text if max_chars is None else F.substring(text, 1, max_chars)
    if size[0] > most_bytes:
        counts = entity_counts(df, id_col, text_col, gazetteer, size[1], max_chars)
        return df.join(counts, id_col)
    types: dict[str, int] = {}
    for r in known.collect():  # ``most_bytes`` at most
        types[r["phrase"]] = types.get(r["phrase"], 0) | 1 << ENTITY_TYPES.index(r["type"])
    shared = df.sparkSession.sparkContext.broadcast(types)

    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for phrase, kinds in shared.value.items():
            automaton.add_word(f" {phrase} ", (phrase, kinds))
        automaton.make_automaton()
        for batch in batches:
            found = [dict(v for _, v in automaton.iter(f" {words} ")) if len(automaton) else {} for words in batch.to_pylist()]
            yield pa.array([[sum(k >> n & 1 for k in own.values()) for n in range(len(ENTITY_TYPES))] for own in found], pa.list_(pa.int64()))

    both = F.arrow_udf(count, "array<long>")(F.array_join(phrase_words(text), " "))
    return df.withColumn("_entities", both).withColumns({"org_count": F.col("_entities")[0], "gpe_count": F.col("_entities")[1]}).drop("_entities")

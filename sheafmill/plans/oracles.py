"""SQL that states the expected result of each named query, for a plain SQL engine.

Profiles are checked against the fields they were written from wherever that is possible, so the
SQL does not repeat the parsing it checks.
"""

from __future__ import annotations

from ..functions import fixed_values as fv
from .views import LINE_CLASSES, PROFILES_SQL

PROFILES = "(" + PROFILES_SQL.replace("{customer}", "customer") + ")"
DOCS = "(SELECT doc_id, text, lang AS category FROM documents)"
JUDGED = "(SELECT doc_id, quality, toxic, quality * 2 + toxic AS label FROM labels)"
BASKETS = """(SELECT o_orderkey AS order_id, list_sort(list(DISTINCT p_name)) AS names,
  list_sort(list_distinct(flatten(list(string_split(p_name, ' '))))) AS words, any_value(o_orderpriority) AS category
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey GROUP BY o_orderkey)"""


def quoted(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


STOPS = quoted(fv.ENGLISH_STOP_WORDS)


def sql_clean(text: str) -> str:
    return f"trim(regexp_replace(regexp_replace(lower({text}), '[^a-z0-9\\s.+#/]', ' ', 'g'), '\\s+', ' ', 'g'))"


def sql_words(text: str, stops: str | None = STOPS) -> str:
    undotted = f"trim(regexp_replace(replace({sql_clean(text)}, '#', ' '), '\\.+( |$)', '\\1', 'g'))"
    keep = "length(w) > 1" + (f" AND w NOT IN ({stops})" if stops else "")
    return f"list_filter(string_split_regex({undotted}, ' +'), lambda w: {keep})"


def sql_lemma(w: str) -> str:
    irregular = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in fv.IRREGULAR_NOUNS.items())
    return f"""CASE WHEN {w} IN ({quoted(fv.IRREGULAR_NOUNS)}) THEN CASE {w} {irregular} END
      WHEN length({w}) < 4 OR right({w}, 1) <> 's' OR {w} IN ({quoted(fv.SKILL_SYNONYMS)}) THEN {w}
      WHEN right({w}, 3) = 'ies' AND length({w}) > 4 THEN left({w}, -3) || 'y'
      WHEN right({w}, 4) IN ('sses', 'shes', 'ches', 'zzes') OR right({w}, 3) = 'xes' THEN left({w}, -2)
      WHEN right({w}, 2) IN ('ss', 'us', 'is', 'os') THEN {w} ELSE left({w}, -1) END"""


def sql_lemmas(text: str) -> str:
    return f"list_transform({sql_words(text)}, lambda x: {sql_lemma('x')})"


def sql_skills(text: str) -> str:
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in fv.SKILL_SYNONYMS.items())
    return f"list_transform({sql_lemmas(text)}, lambda y: CASE y {cases} ELSE y END)"


# Section texts of a profile page from its source fields.
SKILLS_TEXT = "CASE WHEN no_sections THEN '' ELSE skills_src END"
EXPERIENCE_TEXT = "CASE WHEN no_sections THEN '' ELSE exp_src END"
EDUCATION_TEXT = "CASE WHEN no_sections THEN '' ELSE edu_src END"
OTHER_TEXT = "CASE WHEN no_sections THEN skills_src || ' ' || exp_src ELSE name_src END"

SECTION_TABLE = f"""(SELECT doc_id, category, {sql_skills(SKILLS_TEXT)} AS skills_tokens,
  {sql_lemmas(EXPERIENCE_TEXT)} AS experience_tokens, {sql_lemmas(EDUCATION_TEXT)} AS education_tokens,
  CASE WHEN no_sections THEN 0 ELSE years_named END AS years_experience,
  CASE WHEN no_sections THEN 'unknown' ELSE degree_named END AS degree_level,
  concat_ws(' ', {OTHER_TEXT}, {SKILLS_TEXT}, {EXPERIENCE_TEXT}, {EDUCATION_TEXT}) AS full_text
  FROM {PROFILES})"""

DOCUMENT_DEGREE = "CASE " + " ".join(
    "WHEN regexp_matches(lower(text), '"
    + pattern.replace(r"\b", "(^|[^\\pL\\pN_])", 1)[: -len(r"\b")].replace("\\'", "''")
    + "([^\\pL\\pN_]|$)') THEN '"
    + level
    + "'"
    for pattern, level in fv.DEGREE_PATTERNS
) + " ELSE 'unknown' END"


def title_case() -> str:
    return """CASE WHEN title IN ('Skills', 'Technical Skills', 'Core Competencies', 'Areas of Expertise', 'Highlights')
      THEN 'skills' WHEN title IN ('Experience', 'Work History', 'Professional Summary', 'Summary of Qualifications')
      THEN 'experience' ELSE 'education' END"""


SECTION_ROWS = f"""(SELECT doc_id, 0 AS ord, 'SECTION_NAME' || doc_id AS sec_id, NULL AS title, name_src AS text FROM {PROFILES} WHERE NOT no_sections
  UNION ALL SELECT doc_id, 1, 'SECTION_HILT1', CASE WHEN skills_untitled THEN NULL ELSE title_skills END, skills_src FROM {PROFILES} WHERE NOT no_sections
  UNION ALL SELECT doc_id, 2, 'SECTION_EXPR2', CASE WHEN exp_untitled THEN NULL ELSE title_exp END, exp_src FROM {PROFILES} WHERE NOT no_sections
  UNION ALL SELECT doc_id, 3, 'SECTION_EDUC3', title_edu, edu_src FROM {PROFILES} WHERE NOT no_sections
  UNION ALL SELECT doc_id, 0, NULL, NULL, skills_src || ' ' || exp_src FROM {PROFILES} WHERE no_sections)"""


def sql_split(rows: str, id_col: str, cls: str, test: float, val: float, seed: int) -> str:
    """Largest-remainder quotas and a plain ranking of every class."""
    return f"""
WITH keyed AS (SELECT {id_col}, {cls}, row_number() OVER (PARTITION BY {cls} ORDER BY md5('{seed}-' || {id_col}), CAST({id_col} AS VARCHAR)) AS rn FROM {rows}),
c AS (SELECT {cls} AS cls, count(*) AS n FROM {rows} GROUP BY 1),
a AS (SELECT cls, n, n / sum(n) OVER () * (sum(n) OVER () - ceil(sum(n) OVER () * {float(test)}::DOUBLE)) AS exact,
  sum(n) OVER () - ceil(sum(n) OVER () * {float(test)}::DOUBLE) AS draws FROM c),
b AS (SELECT cls, n, floor(exact) + CASE WHEN row_number() OVER (ORDER BY exact - floor(exact) DESC, cls) <= draws - sum(floor(exact)) OVER () THEN 1 ELSE 0 END AS m FROM a),
d AS (SELECT cls, n, m, m / sum(m) OVER () * (sum(m) OVER () - ceil(sum(m) OVER () * {val / (1 - test)!r}::DOUBLE)) AS exact,
  sum(m) OVER () - ceil(sum(m) OVER () * {val / (1 - test)!r}::DOUBLE) AS draws FROM b),
e AS (SELECT cls, n, m, floor(exact) + CASE WHEN row_number() OVER (ORDER BY exact - floor(exact) DESC, cls) <= draws - sum(floor(exact)) OVER () THEN 1 ELSE 0 END AS tr FROM d)
SELECT {id_col}, {cls}, CASE WHEN rn <= n - m THEN 'test' WHEN rn <= n - tr THEN 'val' ELSE 'train' END AS split
FROM keyed JOIN e ON {cls} = cls"""


DOC_SPLIT = sql_split(DOCS, "doc_id", "category", 0.15, 0.15, 42)


def sql_top(items: str, rows: str, n: int) -> str:
    return f"(SELECT item, count(*) AS n FROM (SELECT unnest({items}) AS item FROM {rows}) GROUP BY item ORDER BY n DESC, item LIMIT {n})"


def sql_itemsets(rows: str, items: str, min_support: float, key: str = "order_id") -> str:
    """Frequent sets of up to three items by self-joins; ``items`` is already a distinct list."""
    return f"""
base AS (SELECT {key} AS id, unnest({items}) AS item FROM {rows}),
tot AS (SELECT count(*) AS n_rows FROM {rows}),
one AS (SELECT [item] AS items, count(*) AS freq FROM base GROUP BY item),
two AS (SELECT [a.item, b.item] AS items, count(*) AS freq FROM base a JOIN base b ON a.id = b.id AND a.item < b.item GROUP BY a.item, b.item),
three AS (SELECT [a.item, b.item, c.item] AS items, count(*) AS freq FROM base a JOIN base b ON a.id = b.id AND a.item < b.item
  JOIN base c ON a.id = c.id AND b.item < c.item GROUP BY a.item, b.item, c.item),
four AS (SELECT [a.item, b.item, c.item, e.item] AS items, count(*) AS freq FROM base a JOIN base b ON a.id = b.id AND a.item < b.item
  JOIN base c ON a.id = c.id AND b.item < c.item JOIN base e ON a.id = e.id AND c.item < e.item GROUP BY a.item, b.item, c.item, e.item),
sets AS (SELECT items, freq, n_rows, freq / n_rows AS support FROM
  (SELECT * FROM one UNION ALL SELECT * FROM two UNION ALL SELECT * FROM three UNION ALL SELECT * FROM four), tot
  WHERE freq >= ceil({min_support}::DOUBLE * n_rows))"""


RULES = """
masks AS (SELECT items, support AS s, unnest(range(1, (1 << len(items)) - 1)) AS mask FROM sets WHERE len(items) > 1),
parts AS (SELECT s, [items[i] FOR i IN range(1, len(items) + 1) IF ((mask >> (i - 1)) & 1) = 1] AS a,
  [items[i] FOR i IN range(1, len(items) + 1) IF ((mask >> (i - 1)) & 1) = 0] AS c FROM masks),
rules AS (SELECT array_to_string(a, '|') AS antecedents, array_to_string(c, '|') AS consequents, array_to_string(a, ', ') AS a_text,
  array_to_string(c, ', ') AS c_text, x.support AS antecedent_support, y.support AS consequent_support, s AS support,
  s / x.support AS confidence, s / x.support / y.support AS lift, 1.0::DOUBLE AS representativity, s - x.support * y.support AS leverage,
  (1 - y.support) / (1 - s / x.support) AS conviction,
  (s - x.support * y.support) / greatest(s * (1 - x.support), x.support * (y.support - s)) AS zhangs_metric,
  s / (x.support + y.support - s) AS jaccard, (s / x.support - y.support) / (1 - y.support) AS certainty,
  (s / x.support + s / y.support) / 2 AS kulczynski
  FROM parts JOIN sets x ON x.items = a JOIN sets y ON y.items = c WHERE s / x.support / y.support >= 1.0)"""

WORD_RULES = "WITH " + sql_itemsets(BASKETS, "words", 0.05) + "," + RULES
MEASURES = [
    "antecedent_support", "consequent_support", "support", "confidence", "lift", "representativity", "leverage",
    "conviction", "zhangs_metric", "jaccard", "certainty", "kulczynski",
]


def r6(name: str) -> str:
    return f"round({name}, 6) AS {name}"


def sql_pairs(top_n: int) -> str:
    return f"""(WITH t AS (SELECT order_id, unnest(names) AS item FROM {BASKETS}),
k AS (SELECT t.* FROM t JOIN {sql_top('names', BASKETS, top_n)} USING (item))
SELECT a.item AS src, b.item AS dst, count(*) AS weight FROM k a JOIN k b ON a.order_id = b.order_id AND a.item < b.item GROUP BY 1, 2)"""


EDGES = f"(SELECT * FROM {sql_pairs(200)} WHERE weight >= 5)"
DEGREES = f"(SELECT id, count(*) AS degree FROM (SELECT src AS id FROM {EDGES} UNION ALL SELECT dst FROM {EDGES}) GROUP BY id)"


def sql_class_scores(rows: str, t: str, p: str, grp: str = "1") -> str:
    return f"""
WITH r AS (SELECT {grp} AS grp, {t} AS t, {p} AS p FROM {rows}),
k AS (SELECT DISTINCT grp, t AS c FROM r UNION SELECT DISTINCT grp, p FROM r),
s AS (SELECT k.grp, c, count(*) FILTER (t = c) AS nt, count(*) FILTER (p = c) AS np, count(*) FILTER (t = c AND p = c) AS tp
  FROM k JOIN r ON k.grp = r.grp GROUP BY k.grp, c)
SELECT grp, round(sum(tp) / sum(nt), 6) AS accuracy,
  round(avg(CASE WHEN nt + np = 0 THEN 0 ELSE 2 * tp / (nt + np) END), 6) AS macro_f1,
  round(avg(CASE WHEN nt > 0 THEN tp / nt END), 6) AS balanced_accuracy,
  round(avg(CASE WHEN np > 0 THEN tp / np ELSE 0 END), 6) AS macro_precision,
  round(avg(CASE WHEN nt > 0 THEN tp / nt ELSE 0 END), 6) AS macro_recall FROM s GROUP BY grp"""


def sql_agreement(rows: str, u: str, v: str, grp: str = "1") -> str:
    return f"""
WITH p AS (SELECT {grp} AS grp, {u} AS u, {v} AS v, count(*) AS n FROM {rows} GROUP BY 1, 2, 3),
w AS (SELECT *, sum(n) OVER (PARTITION BY grp, u) AS nu, sum(n) OVER (PARTITION BY grp, v) AS nv, sum(n) OVER (PARTITION BY grp) AS t FROM p),
mi AS (SELECT grp, sum(n / t * ln(n * t / (nu * nv))) AS mi, sum(n * (n - 1) / 2) AS same FROM w GROUP BY grp),
hu AS (SELECT grp, -sum(n / t * ln(n / t)) AS h, sum(n * (n - 1) / 2) AS a, any_value(t) AS t FROM (SELECT DISTINCT grp, u, nu AS n, t FROM w) GROUP BY grp),
hv AS (SELECT grp, -sum(n / t * ln(n / t)) AS h, sum(n * (n - 1) / 2) AS b FROM (SELECT DISTINCT grp, v, nv AS n, t FROM w) GROUP BY grp)
SELECT grp, round(mi / ((hu.h + hv.h) / 2), 6) AS nmi,
  round((same - a * b / (hu.t * (hu.t - 1) / 2)) / ((a + b) / 2 - a * b / (hu.t * (hu.t - 1) / 2)), 6) AS ari
FROM mi JOIN hu USING (grp) JOIN hv USING (grp)"""


ORDER_SCORES = "(SELECT o_orderpriority AS classifier, o_orderstatus AS mode, round(max(o_totalprice), 6) AS macro_f1 FROM orders GROUP BY 1, 2)"


def sql_terms(text: str, stops: str | None = STOPS) -> str:
    """List of words and bigrams of a text."""
    words = f"regexp_extract_all(lower({text}), '[\\pL\\pN_]{{2,}}')"
    if stops:
        words = f"list_filter({words}, lambda w: w NOT IN ({stops}))"
    return f"(SELECT list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM (SELECT {words} AS w))"


def sql_tfidf(rows: str, terms: str, n: int, name: str = "x") -> str:
    """CTEs ``{name}_vocab`` and ``{name}_weights`` over ``rows(doc_id, split, ...)``."""
    return f"""{name}_tf AS (SELECT doc_id, split, term, count(*) AS tf FROM (SELECT doc_id, split, unnest({terms}) AS term FROM {rows}) GROUP BY ALL),
{name}_vocab AS (SELECT term, sum(tf)::BIGINT AS tf, count(*) AS df FROM {name}_tf WHERE split = 'train' GROUP BY term HAVING count(*) >= 2
  ORDER BY 2 DESC, term LIMIT {n}),
{name}_raw AS (SELECT doc_id, split, term, (1 + ln(t.tf)) * (ln((1 + nd) / (1 + df)) + 1) AS w FROM {name}_tf t JOIN {name}_vocab v USING (term),
  (SELECT count(*) AS nd FROM {rows} WHERE split = 'train')),
{name}_weights AS (SELECT doc_id, split, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM {name}_raw)"""


FLAT_ROWS = f"""flat_rows AS (SELECT doc_id, category, split, {sql_terms('text')} AS terms FROM {DOCS} JOIN ({DOC_SPLIT}) USING (doc_id, category))"""
PROFILE_SPLIT = sql_split("(SELECT c_custkey AS doc_id, c_mktsegment AS category FROM customer)", "doc_id", "category", 0.15, 0.15, 42)


def feature_queries() -> dict[str, str]:
    q: dict[str, str] = {}
    flat = "WITH " + FLAT_ROWS + ", " + sql_tfidf("flat_rows", "terms", 8000)
    q["fea_1_terms"] = f"SELECT doc_id, array_to_string({sql_terms('text')}, '|') AS terms FROM documents"
    q["fea_2_vocabulary"] = flat + " SELECT term, tf, df FROM x_vocab"
    q["fea_3_tfidf_weights"] = flat + " SELECT doc_id, term, round(weight, 6) AS weight FROM x_weights"
    joined = {c: f"array_to_string({c}_tokens, ' ')" for c in ("skills", "experience", "education")}
    rows = f"s_rows AS (SELECT *, {', '.join(f'{sql_terms(t, None)} AS {c}_terms' for c, t in joined.items())} FROM {SECTION_TABLE} JOIN ({PROFILE_SPLIT}) USING (doc_id, category))"
    q["fea_4_section_tfidf"] = (
        "WITH " + rows + ", " + ", ".join(sql_tfidf("s_rows", f"{c}_terms", 3000, c) for c in joined)
        + " UNION ALL ".join(f" SELECT doc_id, '{c}' AS section, term, round(weight, 6) AS weight FROM {c}_weights" for c in joined)
    )
    org = "(SELECT count(*) FROM supplier WHERE s_name = 'Supplier#' || lpad(CAST(doc_id % 100 AS VARCHAR), 9, '0'))"
    gpe = "(SELECT count(*) FROM nation WHERE n_name = 'NATION_' || p.nation)"
    q["txt_25_entity_counts"] = f"SELECT doc_id, {org} AS org_count, {gpe} AS gpe_count FROM {PROFILES} p"
    degree = "CASE degree_level " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in fv.DEGREE_CODES.items()) + " END"
    senior = "CASE " + " ".join(f"WHEN regexp_matches(lower(full_text), '{p}') THEN {v}" for p, v in fv.SENIORITY_PATTERNS) + " ELSE 0 END"
    def ten_numbers(table: str) -> str:
        return f"""SELECT doc_id, years_experience::DOUBLE AS years_experience, ({degree})::DOUBLE AS degree_code,
      len(skills_tokens)::DOUBLE AS num_skills, len(skills_tokens)::DOUBLE AS skills_len, len(experience_tokens)::DOUBLE AS experience_len,
      len(education_tokens)::DOUBLE AS education_len, length(full_text)::DOUBLE AS text_length, ({senior})::DOUBLE AS seniority,
      org_count::DOUBLE AS org_count, gpe_count::DOUBLE AS gpe_count
      FROM {table} JOIN ({q['txt_25_entity_counts']}) USING (doc_id)"""

    q["fea_6_handcrafted"] = ten_numbers(SECTION_TABLE)
    numbers = "(" + " + ".join(f"h.{n} ** 2" for n in ("years_experience", "degree_code", "num_skills", "skills_len", "experience_len", "education_len", "text_length", "seniority")) + ")"
    terms = " UNION ALL ".join(f"SELECT doc_id, weight FROM {c}_weights" for c in joined)
    vocab = " + ".join(f"(SELECT count(*) FROM {c}_vocab)" for c in joined)
    q["fea_5_section_stack"] = (
        "WITH " + rows + ", " + ", ".join(sql_tfidf("s_rows", f"{c}_terms", 3000, c) for c in joined)
        + f""", h AS ({q['fea_6_handcrafted']}), t AS (SELECT doc_id, count(*) AS n, sum(weight ** 2) AS q FROM ({terms}) GROUP BY doc_id)
      SELECT doc_id, split, ({vocab} + 8)::INTEGER AS section_width, (coalesce(n, 0) + 8)::INTEGER AS section_entries,
        round(sqrt(coalesce(q, 0) + {numbers}), 6) AS section_length FROM s_rows JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)"""
    )
    ten = "[years_experience, degree_code, num_skills, skills_len, experience_len, education_len, text_length, seniority, org_count, gpe_count]"
    semantic = f"""h AS ({q['fea_6_handcrafted']}),
      """ + (scaled := f"""raw AS (SELECT doc_id, split, list_concat(list_transform(embedding, lambda v: v::DOUBLE), {ten}) AS v
        FROM h JOIN ({PROFILE_SPLIT}) USING (doc_id) JOIN embeddings ON doc_id % (SELECT count(*) FROM embeddings) = vec_id),
      cells AS (SELECT doc_id, split, generate_subscripts(v, 1) AS i, unnest(v) AS v FROM raw),
      scale AS (SELECT i, avg(v) AS m, stddev_pop(v) AS s FROM cells WHERE split = 'train' GROUP BY i),
      semantic AS (SELECT doc_id, split, count(*) AS n, sum(((v - m) / CASE WHEN s = 0 THEN 1 ELSE s END) ** 2) AS q FROM cells JOIN scale USING (i) GROUP BY ALL)""")
    stage_table = f"(SELECT * REPLACE (whole AS full_text) FROM {SECTION_TABLE} JOIN (SELECT doc_id, concat_ws(' ', skills_src, exp_src, edu_src) AS whole FROM {PROFILES}) USING (doc_id))"
    all_numbers = " + ".join(f"h.{n} ** 2" for n in ten.strip("[]").split(", "))
    q["pip_2_feature_stage"] = (
        "WITH " + rows + ", " + ", ".join(sql_tfidf("s_rows", f"{c}_terms", 3000, c) for c in joined)
        + f""", h AS ({ten_numbers(stage_table)}), {scaled},
      f_rows AS (SELECT doc_id, split, {sql_terms('full_text')} AS terms FROM {stage_table} JOIN ({PROFILE_SPLIT}) USING (doc_id, category)), {sql_tfidf("f_rows", "terms", 8000)},
      f AS (SELECT doc_id, count(*) AS n, sum(weight ** 2) AS q FROM x_weights GROUP BY doc_id), t AS (SELECT doc_id, count(*) AS n, sum(weight ** 2) AS q FROM ({terms}) GROUP BY doc_id)
      SELECT doc_id, split, coalesce(f.n, 0)::INTEGER AS flat_entries, (coalesce(t.n, 0) + 10)::INTEGER AS section_entries, semantic.n::INTEGER AS semantic_entries,
        round(sqrt(coalesce(f.q, 0)), 6) AS flat_length, round(sqrt(coalesce(t.q, 0) + {all_numbers}), 6) AS section_length, round(sqrt(semantic.q), 6) AS semantic_length
      FROM semantic JOIN h USING (doc_id) LEFT JOIN f USING (doc_id) LEFT JOIN t USING (doc_id)"""
    )
    q["fea_10_semantic_features"] = f"""WITH {semantic}
      SELECT doc_id, split, n::INTEGER AS semantic_width, n::INTEGER AS semantic_entries, round(sqrt(q), 6) AS semantic_length FROM semantic"""
    q["fea_11_combined"] = f"""WITH {semantic},
      f_rows AS (SELECT doc_id, split, {sql_terms('full_text')} AS terms FROM {SECTION_TABLE} JOIN ({PROFILE_SPLIT}) USING (doc_id, category)), """ + sql_tfidf("f_rows", "terms", 8000) + """,
      t AS (SELECT doc_id, count(*) AS n, sum(weight ** 2) AS q FROM x_weights GROUP BY doc_id)
      SELECT doc_id, split, ((SELECT count(*) FROM x_vocab) + semantic.n)::INTEGER AS combined_width, (coalesce(t.n, 0) + semantic.n)::INTEGER AS combined_entries,
        round(sqrt(coalesce(t.q, 0) + semantic.q), 6) AS combined_length FROM semantic LEFT JOIN t USING (doc_id)"""
    q["fea_9_embedding_join"] = """SELECT doc_id, len(embedding)::INTEGER AS dims, round(list_sum(list_transform(embedding, lambda x: x::DOUBLE)), 6) AS total
      FROM documents LEFT JOIN embeddings ON doc_id = vec_id"""
    cells = "(SELECT vec_id, generate_subscripts(embedding, 1)::INTEGER - 1 AS i, unnest(embedding)::DOUBLE AS v FROM embeddings)"
    q["fea_10_standardised"] = f"SELECT vec_id, i, round((v - avg(v) OVER (PARTITION BY i)) / stddev_pop(v) OVER (PARTITION BY i), 6) AS value FROM {cells}"
    chi = flat + """, shares AS (SELECT category, count(*) / sum(count(*)) OVER () AS p FROM flat_rows WHERE split = 'train' GROUP BY category),
      sums AS (SELECT term, sum(weight) AS total FROM x_weights WHERE split = 'train' GROUP BY term),
      seen AS (SELECT term, category, sum(weight) AS o FROM x_weights JOIN (SELECT doc_id, category FROM flat_rows) USING (doc_id) WHERE split = 'train' GROUP BY ALL),
      scores AS (SELECT term, sum((coalesce(o, 0) - p * total) ** 2 / (p * total)) AS score FROM sums CROSS JOIN shares LEFT JOIN seen USING (term, category) GROUP BY term)"""
    q["fea_12_chi2_scores"] = chi + " SELECT term, round(score, 6) AS score FROM scores"
    q["fea_12_chi2_selected"] = chi + """ SELECT doc_id, term, round(weight, 6) AS weight FROM x_weights
      WHERE term IN (SELECT term FROM scores ORDER BY round(score, 10) DESC, term DESC LIMIT 4000)"""
    q["fea_13_max_abs"] = f"SELECT vec_id, i, round(v / max(abs(v)) OVER (PARTITION BY i), 6) AS value FROM {cells}"
    q["fea_14_non_negative"] = f"SELECT vec_id, i, round(v, 6) AS value FROM {cells} WHERE v > 0"
    q["fea_16_zero_rows"] = "WITH " + FLAT_ROWS + ", " + sql_tfidf("flat_rows", "terms", 8000) + """
      SELECT count(*) FILTER (doc_id NOT IN (SELECT doc_id FROM x_weights)) AS zero_rows, count(*) AS total FROM flat_rows WHERE split = 'train'"""
    return q


def sql_dbscan(points: str, eps: float, min_points: int, id_col: str) -> str:
    """Density clusters of ``points(id, x)`` over all pairs, with a recursive closure."""
    return f"""
WITH RECURSIVE pts AS {points},
near AS (SELECT a.id AS a, b.id AS b FROM pts a JOIN pts b ON list_distance(a.x, b.x) <= {eps}),
core AS (SELECT a AS id FROM near GROUP BY a HAVING count(*) >= {min_points}),
links AS (SELECT a, b FROM near WHERE a IN (FROM core) AND b IN (FROM core)),
reach AS (SELECT id AS a, id AS b FROM core UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
comp AS (SELECT a AS id, min(b) AS root FROM reach GROUP BY a),
lab AS (SELECT id, dense_rank() OVER (ORDER BY root) - 1 AS cluster FROM comp),
edge AS (SELECT a AS id, min(cluster) AS cluster FROM near JOIN lab ON b = lab.id WHERE a NOT IN (FROM core) GROUP BY a)
SELECT pts.id AS {id_col}, coalesce(lab.cluster, edge.cluster, -1)::BIGINT AS cluster FROM pts LEFT JOIN lab ON lab.id = pts.id LEFT JOIN edge ON edge.id = pts.id"""


def cluster_queries() -> dict[str, str]:
    q: dict[str, str] = {}
    vec = "(SELECT vec_id AS id, list_transform(embedding, lambda v: v::DOUBLE) AS x, label FROM embeddings)"
    grown = """SELECT label, max(n) OVER () AS n, max(n) OVER () - n AS n_synthetic FROM"""
    train = sql_split(JUDGED, "doc_id", "label", 0.15, 0.15, 42)
    q["res_1_smote_counts"] = f"{grown} (SELECT label, count(*) AS n FROM ({train}) WHERE split = 'train' GROUP BY label)"
    unit = lambda text: f"('0x' || substr(md5({text}), 1, 8))::BIGINT / 4294967296"
    q["res_1_smote_rows"] = f"""
      WITH e AS (SELECT vec_id, label, list_transform(embedding, lambda v: v::DOUBLE) AS x FROM embeddings),
      c AS (SELECT label, count(*) AS n FROM e GROUP BY 1),
      m AS (SELECT max(n) AS hi, least(5, min(n) - 1) AS k FROM c),
      need AS (SELECT label, (hi - n) // n AS each, (hi - n) % n AS odd, k FROM c, m WHERE hi > n),
      base AS (SELECT e.*, k, each + CASE WHEN row_number() OVER (PARTITION BY e.label ORDER BY md5('42-' || vec_id), vec_id::VARCHAR) <= odd THEN 1 ELSE 0 END AS copies
        FROM e JOIN need USING (label)),
      near AS (SELECT a.vec_id, b.x AS y, row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.x, b.x), b.vec_id) AS rank
        FROM base a JOIN e b ON a.label = b.label AND a.vec_id <> b.vec_id),
      numbered AS (SELECT *, unnest(range(1, copies + 1)) AS copy FROM base),
      drawn AS (SELECT *, floor({unit("vec_id || '-' || copy || '-42'")} * k) + 1 AS rank, {unit("copy || '-' || vec_id || '-43'")} AS u FROM numbered),
      grown AS (SELECT d.vec_id, label, true AS synthetic, list_transform(range(1, 65), lambda i: x[i] + u * (y[i] - x[i])) AS v FROM drawn d JOIN near USING (vec_id, rank)
        UNION ALL SELECT vec_id, label, false, x FROM e)
      SELECT vec_id, label, synthetic, unnest(range(64))::INT AS i, round(unnest(v), 6) AS value FROM grown"""
    def sql_silhouette(rows: str) -> str:
        return f"""
      WITH s AS (SELECT * FROM {rows}),
      p AS (SELECT a.id, a.label AS own, b.label AS other, sum(list_distance(a.x, b.x)) AS total, count(*) AS n FROM s a, s b GROUP BY ALL),
      i AS (SELECT id, total / (n - 1) AS inside FROM p WHERE own = other AND n > 1),
      o AS (SELECT id, min(total / n) AS outside FROM p WHERE own <> other GROUP BY id)
      SELECT round(avg(coalesce((outside - inside) / greatest(inside, outside), 0)), 6) AS silhouette, 0.0::DOUBLE AS error FROM o LEFT JOIN i USING (id)"""

    q["eva_4_silhouette"] = sql_silhouette(vec)
    sweeps = []
    for eps in (1.05, 1.1, 1.15, 1.2, 1.25):
        found = f"(SELECT vec_id AS id, c.cluster, x, v.label AS truth FROM ({sql_dbscan(vec, eps, 5, 'vec_id')}) c JOIN {vec} v ON v.id = c.vec_id)"
        inner = f"(SELECT id, x, cluster AS label FROM {found} WHERE cluster >= 0)"
        sweeps.append(f"""SELECT {eps}::DOUBLE AS eps, n_clusters, n_noise, CASE WHEN n_clusters < 2 THEN -1 ELSE silhouette END AS silhouette,
          CASE WHEN n_clusters < 2 THEN 0 ELSE nmi END AS nmi, ari
          FROM (SELECT count(DISTINCT cluster) FILTER (cluster >= 0) AS n_clusters, count(*) FILTER (cluster < 0) AS n_noise FROM {found}),
            (SELECT nmi, ari FROM ({sql_agreement(found, 'truth', 'cluster')})), ({sql_silhouette(inner)})""")
    q["clu_4_dbscan_sweep"] = " UNION ALL ".join(f"({s})" for s in sweeps)
    q["clu_5_best_k"] = "SELECT count(DISTINCT c_mktsegment)::INTEGER AS k FROM customer"
    q["clu_7_plane"] = "SELECT c_custkey, min(c_custkey) OVER (PARTITION BY c_mktsegment) AS first_of_cluster, true AS near FROM customer"
    q["fea_7_directions"] = "SELECT i::INTEGER AS i, j::INTEGER AS j, (i = j)::INTEGER::DOUBLE AS product FROM range(50) a(i), range(50) b(j)"
    q["fea_7_whole_rank"] = "SELECT vec_id, round(sqrt(list_sum(list_transform(embedding, lambda v: v::DOUBLE ** 2))), 6) AS length, 1.0::DOUBLE AS explained_variance FROM embeddings"
    q["clu_3_ward_known_groups"] = "SELECT c_custkey, min(c_custkey) OVER (PARTITION BY c_nationkey) AS first_of_cluster FROM customer"
    q["clu_4_dbscan"] = sql_dbscan(vec, 1.2, 5, "vec_id")
    q["clu_4_dbscan_customers"] = sql_dbscan(
        "(SELECT c_custkey AS id, [c_nationkey::DOUBLE, c_acctbal / 1000] AS x FROM customer)", 0.5, 5, "c_custkey"
    )
    return q


def build() -> dict[str, str]:
    q: dict[str, str] = {}
    q["txt_1_section_rows"] = f"SELECT doc_id, ord, sec_id, title FROM {SECTION_ROWS}"
    q["txt_2_title_category"] = f"SELECT title, {title_case()} AS category, count(*) AS n FROM {SECTION_ROWS} WHERE title IS NOT NULL GROUP BY title"
    q["txt_3_id_category"] = f"""SELECT doc_id, ord, CASE ord WHEN 0 THEN 'other' WHEN 1 THEN 'skills' WHEN 2 THEN 'experience' ELSE 'education' END AS category
      FROM {SECTION_ROWS} WHERE title IS NULL AND sec_id IS NOT NULL"""
    q["txt_4_squeeze_spaces"] = "SELECT doc_id, trim(regexp_replace(text, '[\\s\\pZ]+', ' ', 'g')) AS text FROM documents"
    q["txt_5_without_title"] = f"SELECT doc_id, {title_case()} AS category, text FROM {SECTION_ROWS} WHERE title IS NOT NULL"
    q["txt_6_joined_sections"] = f"SELECT doc_id, {EXPERIENCE_TEXT} AS experience_text, {OTHER_TEXT} AS other_text FROM {PROFILES}"
    q["txt_7_page_fallback"] = """SELECT page_id, '' AS skills_text, true AS has_text, false AS has_script, false AS has_style FROM pages"""
    q["txt_8_section_columns"] = f"""SELECT doc_id, {SKILLS_TEXT} AS skills_text, {EXPERIENCE_TEXT} AS experience_text,
      {EDUCATION_TEXT} AS education_text, {OTHER_TEXT} AS other_text FROM {PROFILES}"""
    q["txt_9_coverage"] = f"""SELECT count(*) AS total, n AS skills_n, n AS experience_n, n AS education_n, n AS any_n,
      round(n * 100.0 / count(*), 6) AS skills_pct, round(n * 100.0 / count(*), 6) AS experience_pct,
      round(n * 100.0 / count(*), 6) AS education_pct, round(n * 100.0 / count(*), 6) AS any_pct
      FROM {PROFILES}, (SELECT count(*) AS n FROM {PROFILES} WHERE NOT no_sections) GROUP BY n"""
    q["txt_10_clean"] = f"SELECT doc_id, {sql_clean('text')} AS clean FROM documents"
    q["txt_11_words"] = f"SELECT doc_id, array_to_string({sql_words('text', None)}, ' ') AS words FROM documents"
    q["txt_12_words_without_stops"] = f"SELECT doc_id, array_to_string({sql_words('text')}, ' ') AS words FROM documents"
    q["txt_13_lemmas"] = f"SELECT doc_id, array_to_string({sql_lemmas('text')}, ' ') AS words FROM documents"
    q["txt_13_lemma_table"] = f"""WITH l AS (SELECT DISTINCT unnest({sql_words('text')}) AS form FROM benchmark),
      w AS (SELECT doc_id, {sql_words('text')} AS words FROM documents),
      e AS (SELECT doc_id, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM w),
      j AS (SELECT doc_id, string_agg(CASE WHEN form IS NULL THEN w ELSE substr(w, 1, 3) END, ' ' ORDER BY i) AS words FROM e LEFT JOIN l ON w = form GROUP BY doc_id)
      SELECT doc_id, coalesce(j.words, '') AS words FROM w LEFT JOIN j USING (doc_id)"""
    q["txt_14_skill_synonyms"] = f"SELECT doc_id, array_to_string({sql_skills('skills_src')}, '|') AS skills FROM {PROFILES}"
    q["txt_15_item_sets"] = f"SELECT doc_id, array_to_string(list_sort(list_distinct({sql_skills('skills_src')})), '|') AS items FROM {PROFILES}"
    q["txt_16_section_tokens"] = f"""SELECT doc_id, array_to_string({sql_lemmas('exp_src')}, ' ') AS experience,
      array_to_string({sql_lemmas('edu_src')}, ' ') AS education FROM {PROFILES}"""
    q["txt_17_years"] = f"SELECT doc_id, years_named AS years FROM {PROFILES}"
    q["txt_18_degree"] = f"SELECT doc_id, degree_named AS degree FROM {PROFILES}"
    q["txt_18_degree_in_documents"] = f"SELECT doc_id, {DOCUMENT_DEGREE} AS degree FROM documents"
    q["txt_19_item_count"] = f"SELECT doc_id, CAST(len(skills_tokens) AS INTEGER) AS num_skills FROM {SECTION_TABLE}"
    q["txt_20_section_attributes"] = f"""SELECT doc_id, array_to_string(skills_tokens, '|') AS skills, array_to_string(experience_tokens, '|') AS experience,
      array_to_string(education_tokens, '|') AS education, years_experience, degree_level, CAST(len(skills_tokens) AS INTEGER) AS num_skills FROM {SECTION_TABLE}"""
    q["txt_21_token_statistics"] = f"""SELECT round(avg(len(skills_tokens)), 6) AS avg_skills_tokens, round(avg(len(experience_tokens)), 6) AS avg_experience_tokens,
      round(avg(len(education_tokens)), 6) AS avg_education_tokens, count(*) FILTER (years_experience > 0) AS with_years, count(*) AS total FROM {SECTION_TABLE}"""
    q["txt_21_degree_histogram"] = f"SELECT degree_level, count(*) AS n FROM {SECTION_TABLE} GROUP BY 1"
    q["txt_22_seniority"] = f"SELECT doc_id, job_rank AS seniority FROM {PROFILES}"
    q["txt_23_tokens_to_text"] = f"SELECT order_id, array_to_string(names, ' ') AS text FROM {BASKETS}"
    q["txt_24_encoder_input"] = "SELECT conv_id, turn, coalesce(nullif(text, ''), 'empty') AS text FROM conversations"

    q["spl_1_split"] = DOC_SPLIT
    q["spl_1_split_events"] = sql_split("events", "event_id", "event_type", 0.2, 0.1, 7)
    q["spl_2_folds"] = f"""WITH c AS (SELECT category AS cls, count(*) AS n FROM {DOCS} GROUP BY 1),
      s AS (SELECT cls, n, sum(n) OVER (ORDER BY cls) - n AS start FROM c),
      dealt AS (SELECT cls, (start + i) % 5 AS f, count(*) AS size FROM (SELECT cls, start, unnest(range(n)) AS i FROM s) GROUP BY 1, 2),
      ends AS (SELECT cls, f, sum(size) OVER (PARTITION BY cls ORDER BY f) AS hi FROM dealt),
      r AS (SELECT doc_id, category, row_number() OVER (PARTITION BY category ORDER BY md5('42-' || doc_id)) AS rn FROM {DOCS})
      SELECT doc_id, category, CAST(min(f) AS INTEGER) AS fold FROM r JOIN ends ON category = cls AND rn <= hi GROUP BY 1, 2"""
    q["spl_3_class_distribution"] = f"""SELECT category, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS pct,
      min(count(*)) OVER () AS min_class, max(count(*)) OVER () AS max_class FROM {DOCS} GROUP BY category"""
    q["spl_4_distinct_classes"] = f"SELECT count(DISTINCT category) AS n_classes FROM {DOCS}"
    q["set_1_union_of_splits"] = f"SELECT doc_id, category FROM {DOCS}"
    q["set_2_train_and_val"] = f"SELECT category, count(*) AS n FROM ({DOC_SPLIT}) WHERE split <> 'test' GROUP BY category"
    q["set_4_item_intersection"] = f"""SELECT order_id, array_to_string(list_sort(list_intersect(names, top)), '|') AS items
      FROM {BASKETS}, (SELECT list(item) AS top FROM {sql_top('names', BASKETS, 10)})"""
    q["lbl_1_encoded"] = f"SELECT doc_id, category, CAST(dense_rank() OVER (ORDER BY category) - 1 AS DOUBLE) AS label, category AS decoded FROM {DOCS}"
    q["res_2_class_weights"] = f"""SELECT doc_id, label, round(rows / (classes * n), 6) AS weight FROM {JUDGED}
      JOIN (SELECT label, count(*) AS n FROM {JUDGED} GROUP BY 1) USING (label), (SELECT count(*) AS rows, count(DISTINCT label) AS classes FROM {JUDGED})"""

    q["min_1_top_items"] = f"SELECT item, n FROM {sql_top('names', BASKETS, 30)}"
    q["min_2_transactions"] = f"""SELECT order_id, array_to_string(list_sort(list_intersect(names, top)), '|') AS items
      FROM {BASKETS}, (SELECT list(item) AS top FROM {sql_top('names', BASKETS, 40)})"""
    q["min_2_one_hot"] = f"""SELECT order_id, {', '.join(f'list_contains(words, top[{i + 1}]) AS item_{i}' for i in range(5))}
      FROM {BASKETS}, (SELECT list(item ORDER BY n DESC, item) AS top FROM {sql_top('words', BASKETS, 5)})"""
    q["min_3_frequent_itemsets"] = (
        "WITH " + sql_itemsets(BASKETS, "words", 0.05) + " SELECT array_to_string(items, '|') AS items, freq, round(support, 6) AS support FROM sets"
    )
    q["min_4_rules"] = WORD_RULES + f" SELECT antecedents, consequents, {r6('lift')} FROM rules"
    q["min_5_rule_measures"] = WORD_RULES + f" SELECT antecedents, consequents, {', '.join(map(r6, MEASURES))} FROM rules"
    q["min_6_sorted_rules"] = WORD_RULES + f" SELECT antecedents, consequents, {r6('lift')}, {r6('confidence')} FROM rules ORDER BY lift DESC"
    q["min_7_rules_by_category"] = " UNION ALL ".join(
        f"""SELECT * FROM (WITH cat AS (SELECT category FROM {BASKETS} GROUP BY 1 ORDER BY count(*) DESC, category LIMIT 1 OFFSET {i}),
        rws AS (SELECT b.* FROM {BASKETS} b JOIN cat USING (category)), {sql_itemsets('rws', 'words', 0.1)}, {RULES}
        SELECT category, antecedents, consequents, {r6('support')}, {r6('confidence')}, {r6('lift')} FROM rules, cat)"""
        for i in range(5)
    )
    q["snk_4_top_rules"] = WORD_RULES + f""" SELECT a_text AS antecedents, c_text AS consequents, {', '.join(map(r6, MEASURES))}
      FROM rules ORDER BY rules.lift DESC, rules.confidence DESC, rules.support DESC, a_text, c_text LIMIT 50"""
    q["coo_1_pairs"] = f"SELECT * FROM {sql_pairs(50)}"
    q["coo_2_edges"] = f"SELECT * FROM {EDGES}"
    q["coo_3_nodes"] = f"""SELECT item AS id, n AS frequency FROM {sql_top('names', BASKETS, 1000000)}
      WHERE item IN (SELECT src FROM {EDGES} UNION SELECT dst FROM {EDGES})"""
    q["coo_4_degree_centrality"] = f"""SELECT id, round(degree / (total - 1), 6) AS centrality FROM {DEGREES}, (SELECT count(*) AS total FROM {DEGREES})
      ORDER BY degree DESC, id LIMIT 20"""
    q["coo_5_view_nodes"] = f"SELECT id, degree, degree * 30 AS node_size FROM {DEGREES} ORDER BY degree DESC, id LIMIT 25"
    q["coo_5_view_edges"] = f"""WITH t AS (SELECT id FROM {DEGREES} ORDER BY degree DESC, id LIMIT 25),
      k AS (SELECT * FROM {EDGES} WHERE src IN (FROM t) AND dst IN (FROM t))
      SELECT src, dst, weight, round(weight / (SELECT max(weight) FROM k) * 3, 6) AS edge_width FROM k"""

    q["eva_1_classification_metrics"] = f"SELECT * EXCLUDE (grp) FROM ({sql_class_scores(JUDGED, 'label', 'quality')})"
    q["eva_1_metrics_by_group"] = sql_class_scores("lineitem", "l_returnflag", "substr(l_linestatus, 1, 1)", "l_linestatus")
    q["eva_2_confusion_matrix"] = f"""SELECT truth, {', '.join(f'count(*) FILTER (quality = {i}) AS pred_{i}' for i in range(4))}
      FROM (SELECT unnest(range(4))::INTEGER AS truth) LEFT JOIN {JUDGED} ON label = truth GROUP BY truth"""
    q["eva_3_metric_table"] = f"""SELECT classifier, {', '.join(f"max(macro_f1) FILTER (mode = '{m}') AS {m}" for m in 'FOP')}
      FROM {ORDER_SCORES} GROUP BY classifier"""
    q["eva_5_6_cluster_agreement"] = f"SELECT nmi, ari FROM ({sql_agreement(JUDGED, 'quality', 'toxic')})"
    q["eva_5_6_agreement_by_group"] = sql_agreement("lineitem", "l_returnflag", "l_linenumber % 4", "l_linestatus")
    urgent = "(CASE WHEN CAST(substr(o_orderpriority, 1, 1) AS INT) <= 2 THEN 1 ELSE 0 END + CASE WHEN o_orderstatus = 'O' THEN 2 ELSE 0 END)"
    for name in ("cls_1_forest_known_answer", "cls_2_boosting_known_answer"):
        q[name] = f"SELECT o_orderkey, {urgent} AS predicted FROM orders"
    classes = ", ".join(f"'{c}'" for c in LINE_CLASSES)
    keys = "l_orderkey, l_linenumber, l_partkey, l_suppkey"
    q["cls_3_svm_known_answer"] = f"SELECT {keys}, list_position([{classes}], l_returnflag || l_linestatus) - 1 AS predicted FROM lineitem"
    q["cls_11_best_row"] = f"SELECT * FROM {ORDER_SCORES} ORDER BY macro_f1 DESC, mode, classifier LIMIT 1"
    q.update(feature_queries())
    q.update(cluster_queries())
    q["src_1_csv_documents"] = "SELECT doc_id, md5(coalesce(text, '')) AS text_md5, lang AS category FROM documents"
    q["src_1_damaged_csv"] = """SELECT c_custkey, c_name AS name, c_mktsegment AS segment, NULL AS record FROM customer WHERE c_custkey % 10 NOT IN (3, 5, 7)
      UNION ALL SELECT NULL, NULL, NULL, CASE c_custkey % 10 WHEN 3 THEN c_custkey || ',' || c_name WHEN 5 THEN c_custkey || ',"' || c_name || '",' || c_mktsegment || ',extra'
        ELSE 'x' || c_custkey END FROM customer WHERE c_custkey % 10 IN (3, 5, 7)"""
    q["src_4_second_table"] = "SELECT s_suppkey::INTEGER AS s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier"
    q["snk_3_result_files"] = "SELECT c_mktsegment, c_custkey::INTEGER AS c_custkey, count(*) OVER (PARTITION BY c_mktsegment)::INTEGER AS n FROM customer"
    known = lambda t: f"array_to_string(list_transform({sql_words(t)}, lambda x: CASE WHEN length(x) % 2 = 0 THEN left(x, 3) ELSE x END), '|')"
    q["pip_1_parse_with_dictionary"] = f"SELECT doc_id, {known(EXPERIENCE_TEXT)} AS experience_words, {known(EDUCATION_TEXT)} AS education_words FROM {PROFILES}"
    q["pip_1_report"] = f"SELECT * FROM ({q['txt_9_coverage']}) JOIN ({q['txt_21_token_statistics']}) USING (total)"
    q["pip_1_report_degrees"] = q["txt_21_degree_histogram"]
    q["src_2_canonical_columns"] = "SELECT page_id AS ID, html AS Resume_html, url FROM pages"
    q["src_3_dense_ids"] = "SELECT row_number() OVER (ORDER BY c_custkey) - 1 AS row_id, c_custkey, c_name FROM customer"
    q["snk_1_src_5_stored_splits"] = DOC_SPLIT
    q["snk_2_src_6_stored_features"] = q["fea_13_max_abs"]
    q["pip_1_parse_stage"] = f"""SELECT doc_id, category, split, {EXPERIENCE_TEXT} AS experience_text, {EDUCATION_TEXT} AS education_text,
      array_to_string({sql_skills(SKILLS_TEXT)}, '|') AS skills, CASE WHEN no_sections THEN 0 ELSE years_named END AS years_experience,
      CASE WHEN no_sections THEN 'unknown' ELSE degree_named END AS degree_level FROM {PROFILES} JOIN ({PROFILE_SPLIT}) USING (doc_id, category)"""
    return q

"""Language-model scores, quality, page texts and the pipeline against brute force, invariants and held-out rows."""

import html as entities
import math
import re
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sheafmill.llm import html_main, mixing, quality, queries, simhash, substring
from tests.llm.test_substring_packing_bpe import brute_dedup, check_packing

SF = "/root/testdata/sf0.001"


def table(name, *columns):
    t = pq.read_table(f"{SF}/{name}.parquet")
    return list(zip(*(t[c].to_pylist() for c in columns)))


def brute_base(rows):
    """(id, held out, tokens, known, training tokens, base score) of each (id, text)."""
    tokens = [[*(t or "").encode().lower().split(), None] for _, t in rows]
    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows]
    counts = Counter(t for own, h in zip(tokens, held) if not h for t in own)
    total, distinct = sum(counts.values()), len(counts)
    return [(i, h, len(own), sum(counts[t] > 0 for t in own), total, sum(math.log10((counts[t] + 1) / (total + distinct + 1)) for t in own)) for (i, _), own, h in zip(rows, tokens, held)]


def same_base(found, rows):
    got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in found), key=str)
    want = sorted(brute_base(rows), key=str)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5] for g in got], [w[5] for w in want], rtol=1e-9)


def test_mixing_query(spark):
    found = queries.op6_mixing(spark, SF).collect()
    same_base(found, table("documents", "doc_id", "text"))
    assert all(r.score < 0 and math.isfinite(r.score) for r in found)
    own = [r for r in found if not r.held_out]
    assert sum(r.score for r in own) > sum(r.base_score for r in own)
    held = [r for r in found if r.held_out]
    assert sum(r.bits_per_byte for r in held) / len(held) < 4


@pytest.mark.parametrize("book", [1 << 17, 3])
def test_mixing_odd_rows(odd_documents, book):
    found = mixing.score(odd_documents, "doc_id", "text", book).collect()
    same_base(found, [(r.doc_id, r.text) for r in odd_documents.collect()])
    assert all(r.score < 0 and math.isfinite(r.score) for r in found)
    assert mixing.score(odd_documents.where("false"), "doc_id", "text").count() == 0


def test_mixing_scores_do_not_depend_on_how_much_is_scored_at_a_time(spark, monkeypatch):
    rng = np.random.default_rng(6)
    rows = [(i, " ".join(f"w{k}" for k in rng.integers(0, 90, 25))) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    found = []
    for most in (1 << 20, 200):
        monkeypatch.setattr(mixing, "SCORED", most)
        monkeypatch.setattr(mixing, "HELD_TOKENS", most)
        found.append({r.doc_id: (r.n_tokens, r.n_known, r.base_score, r.score) for r in mixing.score(docs, "doc_id", "text", 40).collect()})
    assert found[0].keys() == found[1].keys()
    assert all(np.allclose(found[0][i], found[1][i], rtol=1e-9) for i in found[0])


def test_mixing_learns_what_follows(spark):
    rng = np.random.default_rng(1)
    rows = [(i, " ".join(f"a{k} b{k}" for k in rng.integers(0, 40, 60))) for i in range(300)]
    rows += [(1000 + i, " ".join(rng.permutation(t.split()).tolist())) for i, t in rows[:60]]
    rows = [(i, t) for i, t in rows if i < 1000 or zlib.crc32(str(i).encode()) % 7 == 2]
    found = {r.doc_id: r for r in mixing.score(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text").collect()}
    held = [found[i] for i, _ in rows if found[i].held_out and i < 1000]
    shuffled = [found[i] for i, _ in rows if i >= 1000]
    mean = lambda some: sum(r.score for r in some) / len(some)
    assert mean(held) > 0.75 * sum(r.base_score for r in held) / len(held)  # half of the tokens follow from the one before
    assert mean(held) > mean(shuffled)


def test_bits_do_not_depend_on_how_many_tokens_are_laid_out_at_a_time(monkeypatch):
    book = mixing.Book([b"a", b"b", b"", b"c"], [50, 20, 10, 1], 7)
    symbols, words = np.random.default_rng(4).integers(0, 5, 300), [b"xy", b"z", b"caf\xc3\xa9"] * 3
    laid = [(book.slots(symbols, np.array([0, 7, 120]), 16), mixing.spelling(words))]
    monkeypatch.setattr(mixing, "BLOCK_TOKENS", 7)
    monkeypatch.setattr(mixing, "BLOCK_WORDS", 2)
    laid.append((book.slots(symbols, np.array([0, 7, 120]), 16), mixing.spelling(words)))
    for one, two in zip(*laid):
        assert all((x == y).all() for x, y in zip([*one[0], *one[1:]], [*two[0], *two[1:]]))


def test_token_counts_split_at_ascii_white_space_only(spark, monkeypatch):
    texts = [" A b\x0b\x0cB ", "", None, "\u00a0x y\x1cz \u00c9", "a"] * 3
    want = Counter(t for text in texts for t in mixing.tokens_of(text))
    for most in (1 << 20, 3):
        monkeypatch.setattr(mixing, "HELD_TOKENS", most)
        found = mixing.token_counts(spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1))
        assert {bytes(r.token): r.n for r in found.collect()} == want


def test_codes_are_a_whole_binary_tree():
    book = mixing.Book([b"a", b"b", b"", b"c"], [50, 20, 10, 1], 7)
    codes = ["".join(map(str, book.bits[s : s + n])) for s, n in zip(book.starts, book.lengths)]
    assert sum(2.0 ** -len(c) for c in codes) == 1 and len(set(codes)) == 5
    assert not any(a != b and b.startswith(a) for a in codes for b in codes)


def test_quality_query(spark):
    found = {r.doc_id: r for r in queries.op10_quality(spark, "/root/testdata/sf0.01").collect()}
    t = pq.read_table("/root/testdata/sf0.01/labels.parquet")
    held, right = 0, 0
    for i, label in zip(t["doc_id"].to_pylist(), t["quality"].to_pylist()):
        r = found[i]
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
        held += r.held_out
        right += r.held_out and r.predicted == label
    assert len(found) == 1000 and held > 50 and right >= 0.93 * held


def test_quality_odd_rows(spark, odd_documents):
    labels = spark.createDataFrame([(1, 1), (2, 1), (4, 0), (7, 0), (8, 1), (None, 0), (9, None), (999, 0)], "doc_id long, quality int")
    model = quality.fit(odd_documents, labels, "doc_id", "text", "quality")
    found = quality.score(odd_documents, "doc_id", "text", model, keep=["text", "id", "n_words"]).collect()
    assert sorted(map(str, (r.doc_id for r in found))) == sorted(str(r.doc_id) for r in odd_documents.collect())
    assert all(0 <= r.score <= 1 for r in found) and len({r.score for r in found if not (r.text or "").split()}) == 1
    none = quality.fit(odd_documents, labels.where("false"), "doc_id", "text", "quality")
    assert {r.score for r in quality.score(odd_documents, "doc_id", "text", none).collect()} == {0.5}
    assert quality.score(odd_documents.where("false"), "doc_id", "text", model).count() == 0


def test_features_depend_on_the_text_alone():
    texts = ["a b a b", None, "", "A  B\tA b", "x " * 50]
    features, offsets = quality.indicators(texts)
    alone = [quality.indicators([t])[0].tolist() for t in texts]
    assert [features[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == alone
    assert alone[1] == alone[2] == [0]


def test_descent_reaches_the_optimum():
    rng = np.random.default_rng(0)
    rows = [np.unique(rng.integers(1, 30, 8)).astype(np.int32) for _ in range(60)]
    labels = np.array([int(r.min() < 4) for r in rows])
    ratios = rng.normal(size=30)
    flat, offsets = np.concatenate(rows), np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    x = np.zeros((60, 30))
    for i, r in enumerate(rows):
        x[i, r] = ratios[r] / np.linalg.norm(ratios[r])
    sign = np.where(labels, 1.0, -1.0)
    objective = lambda w: w @ w / 2 + np.maximum(0, 1 - sign * (x @ w)).sum()
    w = quality.descend(flat, offsets, labels, ratios, epochs=500)
    assert all(objective(w) <= objective(w + 0.02 * rng.normal(size=30)) + 1e-4 for _ in range(300))


def plain_article(page):
    inner = re.search(r"<article>(.*?)</article>", page, re.S).group(1)
    return " ".join(entities.unescape(re.sub(r"<[^>]+>", " ", re.sub(r"</?b>", "", inner))).split())


def test_pages_query(spark):
    found = {r.page_id: r for r in queries.op9_html(spark, SF).collect()}
    for i, url, page in table("pages", "page_id", "url", "html"):
        assert (found[i].url, found[i].text, found[i].n_chars) == (url, plain_article(page), len(plain_article(page)))


PAGE = """<html><head><title>T</title><style>p{}</style></head><body class="has-sidebar"><header><h1>Site</h1></header><nav><a href=/>Home</a></nav>
<div class="cookie-notice">We use cookies</div><div id=content><h1>Head &amp; line</h1><p>One <i>t</i>wo&nbsp;three<br>four<p>Five<script>var a="<p>no</p>";</script> six
<div class="ad-box"><p>Buy</p></div><form><input>Name</form><aside>Side</aside></div><section class="comments"><p>First!</p></section><footer>Foot</footer></body></html>"""


def test_page_without_article_element():
    assert html_main.main_text(PAGE) == "Head & line One two three four Five six"


@pytest.mark.parametrize("page", [None, "", "   ", "<", "<<>>", "<p", "<!-- open", "<script>x", "</div></p>", "<nav>only menu</nav>"])
def test_pages_with_nothing(page):
    assert html_main.main_text(page) in ("", "<", "<<>>", "<p", "< < >>", "<<>>")


def test_template_text_goes_and_copies_stay(spark):
    article = lambda n: f"<html><body><div><div class=c><p>Share this page</p><p>Own text number {n} with several words about topic {n * 7}</p><p>Second paragraph {n * 3} of the page goes on and on</p></div><p>Posted by the staff</p></div></body></html>"
    rows = [(n, "http://Site.example/a%d" % n, article(n)) for n in range(12)] + [(100 + n, "http://copies.example/x", article(1)) for n in range(8)]
    rows += [(200, None, None), (201, "http://alone.example/", article(5)), (None, "bad url", article(6))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    found = {r.page_id: r.text for r in html_main.extract(pages, "page_id", "url", "html").collect()}
    for n in range(12):
        assert found[n] == f"Own text number {n} with several words about topic {n * 7} Second paragraph {n * 3} of the page goes on and on"
    assert all("Own text number 1 " in found[100 + n] for n in range(8))
    assert found[200] == "" and found[201].startswith("Share this page") and len(found) == 23
    assert html_main.extract(pages.where("false"), "page_id", "url", "html").count() == 0


def test_class_words_exclude_only_as_whole_words_and_around_no_article():
    page = "<body><div class='layout has-sidebar'><div class='post with-comments'><article><p>The whole article</p></article></div></div><div class='comments'>First!</div></body>"
    assert html_main.main_text(page) == "The whole article"
    assert html_main.main_text("<body><div class='widget'><article>Kept</article></div></body>") == "Kept"
    assert html_main.main_text("<body><article>Own</article><div class='related'><article>Teaser</article></div></body>") == "Own"
    assert html_main.main_text("<body><div class='sidebar'>Side</div><div class='page has-sidebar'>Body</div></body>") == "Body"


def extracted(spark, bodies):
    pages = spark.createDataFrame([(n, f"http://h.example/{n}", f"<html><body>{b}</body></html>") for n, b in enumerate(bodies)], "page_id long, url string, html string")
    return {r.page_id: r.text for r in html_main.extract(pages, "page_id", "url", "html").collect()}


def test_short_article_beside_a_long_menu(spark):
    menu = "<div class=x><ul>" + "".join(f"<li>Entry {k} of the long unlabelled menu</li>" for k in range(40)) + "</ul></div>"
    found = extracted(spark, [f"{menu}<div class=y><p>Short text {n}</p></div><div class=z><p>Imprint and terms</p></div>" for n in range(12)])
    assert found == {n: f"Short text {n}" for n in range(12)}


def test_template_text_stays_where_it_is_data(spark):
    # the line stands after the lead on some pages and before it on others: in no order with the template, so it is data
    lead, line = "<p>Lead of every page</p>", "<p>A line of the article</p>"
    frame = lambda n, inner: f"<div class=a><h2>Top</h2></div><div class=c><p>Own text {n} with words of its own</p>{inner}</div><div class=b><h3>End</h3></div>"
    found = extracted(spark, [frame(n, lead + line if n % 2 else line + lead) for n in range(12)])
    assert all("A line of the article" in found[n] or "Lead of every page" in found[n] for n in range(12))
    assert all("Top" not in found[n] and f"Own text {n}" in found[n] for n in range(12))
    # a run of the menu that is also a paragraph of one article
    bodies = [f"<div class=m><b>Home</b><i>Shop</i></div><div class=c><p>Own text {n} with words of its own</p>{'<p>Home</p>' if n == 3 else ''}</div>" for n in range(40)]
    assert extracted(spark, bodies) == {n: f"Own text {n} with words of its own" + (" Home" if n == 3 else "") for n in range(40)}


def test_only_tokens_on_nearly_all_pages_are_gathered_by_host(spark):
    rows = [("h", -1, 40, 1, 1, 0), ("h", 5, 40, 1, 1, 9), ("h", 6, 38, 2, 2, 9), ("h", 7, 37, 3, 3, 9), ("h", 8, 5, 4, 4, 9), ("i", -1, 5, 4, 4, 0), ("i", 8, 5, 4, 4, 2)]
    found = html_main.supported(spark.createDataFrame(rows, "host string, token long, pages long, a long, b long, at long")).collect()
    assert {(r.host, r.of): {t.token for t in r.tokens} for r in found} == {("h", 40): {-1, 5, 6}, ("i", 5): {-1, 8}}


def test_pipeline(spark):
    found = corpus_pipeline.run(spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:3]:
        before, kept = kept, stage(spark, kept, SF).cache()
        assert kept.columns == docs.columns
        ids = {r.doc_id for r in kept.select("doc_id").collect()}
        gone = {r.doc_id for r in before.select("doc_id").collect()} - ids
        if name == "quality":
            label = dict(table("labels", "doc_id", "quality"))
            judged = [label[i] for i in gone if i in label]
            assert ids and judged and judged.count(0) >= 0.8 * len(judged)
        if name == "near_duplicates":
            texts = {r.doc_id: r.text for r in before.collect()}
            prints = {i: simhash.fingerprint(t) for i, t in texts.items()}
            least = {i: i for i in texts}
            for _ in texts:  # the smallest id spreads over links until nothing changes
                moved = {i: min(least[j] for j in texts if (prints[i] ^ prints[j]).bit_count() <= 3) for i in texts}
                if moved == least:
                    break
                least = moved
            assert ids == {i for i in texts if least[i] == i} and gone
        if name == "passages":
            rows = [(r.doc_id, r.text) for r in before.collect()]
            want = {i: t for i, _, n, t in brute_dedup(rows) if n}
            want = {i: want.get(i, t) for i, t in rows}
            assert {r.doc_id: r.text for r in kept.collect()} == want
            assert all(r.n_chars == len(r.text) for r in kept.collect())
    check_packing(found, [(r.doc_id, r.text) for r in kept.collect()])


def test_near_duplicates_of_repeated_and_missing_ids(spark):
    long = "the cat sat on the mat and went home to sleep for a very long time again today"
    other = "wholly unlike words stand here so that nothing of the first text is found again in it"
    rows = [(1, long), (1, long), (1, other), (2, long), (None, long), (None, "no other text is like this one at all"), (None, "no other text is like this one at all"), (3, None), (4, "")]
    kept = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), SF)
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([(1, long), (1, other), (None, rows[5][1]), (3, None)], key=str)


def test_pipeline_stages_take_odd_rows(spark, odd_documents):
    docs = odd_documents.select("doc_id", "text", "id", F.lit("s").alias("source"))
    for _, stage in corpus_pipeline.STAGES[1:3]:
        kept = stage(spark, docs, SF)
        assert kept.columns == docs.columns and kept.count() > 0
        assert stage(spark, docs.where("false"), SF).count() == 0
    scored = corpus_pipeline.quality_filter(spark, docs, SF)
    assert scored.columns == docs.columns
    assert corpus_pipeline.quality_filter(spark, docs.where("false"), SF).count() == 0


def test_substring_of_all_queries_is_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    assert [n for n in names if re.match(r"op\d+_", n)] and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)) and "pipeline" in names
    assert set(entry.oracle_sql()) <= set(names) and substring.WINDOW == 13


@pytest.mark.parametrize(
    "page",
    ["<a " * 300_000, "<div>x " * 100_000, '<a b="' * 150_001, "<script " * 100_000, "<div>" * 60_000 + "</x>" * 60_000 + "</div>" * 500, "<b>" * 40_000 + "<p>x</p>" * 40_000,
     "<article class=comment>x" * 40_000, "<header>x" * 60_000, '<div class="menu">' * 40_000 + "<article>x"],
)
def test_time_of_bad_pages_grows_with_their_length(page):
    def took(text):
        start = time.process_time()
        html_main.main_text(text)
        return time.process_time() - start

    took(page[: len(page) // 8])
    assert took(page) < 20 * took(page[: len(page) // 8]) + 0.5  # a square would be 64 times


def test_articles_of_pages_without_names(spark):
    """No element, class or id says what it is: the container is where the data is."""

    def bare(page):
        page = re.sub(r"<(/?)(?:article|nav|header|footer|aside|main|section|form)\b[^>]*>", r"<\1div>", page)
        return re.sub(r"<(div|p|span|ul|li|a|h1|h2|h3)\b[^>]*>", r"<\1>", page)

    rows = table("pages", "page_id", "url", "html")
    pages = spark.createDataFrame([(i, u, bare(h)) for i, u, h in rows], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_main.extract(pages, "page_id", "url", "html").collect()}
    assert sum(got[i] == html_main.main_text(h) for i, _, h in rows) >= 0.9 * len(rows)

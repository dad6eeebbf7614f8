"""Language, toxicity, main text and top-k search: brute force, held-out accuracy, edge cases."""

import html
import os
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ingotflow.llm import language_id, main_text, topk, toxicity

SYLLABLES = {"xx": "ka to mi ru ne so", "yy": "bri gol dwe stan pfu", "zz": "éla oui çan tré ñor"}


def prose(rnd, lang, n=40):
    syllables = SYLLABLES[lang].split()
    return " ".join("".join(rnd.choices(syllables, k=rnd.randint(1, 3))) for _ in range(n)).capitalize() + "."


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(4)
    return [(i, prose(rnd, lang), lang) for i, lang in enumerate(rnd.choices(["xx", "xx", "yy", "zz"], k=240))]


@pytest.fixture(scope="module")
def filters(spark, texts):
    rows = [*texts[:120], (900, None, "xx"), (901, "Nothing to learn", None), (902, "", "yy")]
    return language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))


def test_held_out_language(spark, texts, filters):
    df = spark.createDataFrame([(i, t, lang, "clash") for i, t, lang in texts[120:]],
                               "doc_id long, text string, truth string, score string")
    rows = language_id.identify(df, filters, keep=(F.col("truth"),)).collect()
    assert len(rows) == 120 and all(r.lang_pred == r.truth and 0 < r.score <= 1 for r in rows)


def test_filters_equal_exact_sets(texts):
    """Bloom filters give what exact n-gram sets give, up to rare false positives."""
    members = {}
    for _, text, lang in texts[:60]:
        members.setdefault(lang, set()).update(language_id.grams([text.encode()])[0].tolist())
    names = sorted(members)
    model = language_id.LanguageFilters.build(
        names, [np.array(sorted(members[n]), np.uint32) for n in names])
    for _, text, _ in texts[60:]:
        grams = language_id.grams([text.encode()])[0].tolist()
        exact = [sum(g in members[n] for g in grams) / len(grams) for n in names]
        (pred,), (score,) = model.predict([text])
        assert pred == names[int(np.argmax(exact))] and abs(score - max(exact)) < 0.01


def test_languages_beyond_one_plane():
    rnd = np.random.default_rng(2)
    members = [rnd.integers(0, 1 << 32, 50, dtype=np.uint32) for _ in range(70)]
    model = language_id.LanguageFilters.build([f"l{i}" for i in range(70)], members)
    for i in (0, 8, 63, 64, 69):
        cells = language_id.cells(members[i])
        found = model.planes[cells[0]] & model.planes[cells[1]] & model.planes[cells[2]]
        assert (found[:, i // 64] >> np.uint64(i % 64) & np.uint64(1)).all()


def test_language_edges(spark, filters):
    rows = [(1, None), (2, ""), (3, "123 !? …"), (4, "ka"), (5, "ÉLA"), (6, "漢字"), (7, "katomi " * 50_000),
            (7, "katomi " * 50_000), (None, "briгol")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: (r.lang_pred, r.score) for r in language_id.identify(df, filters).collect()}
    assert out[1] == out[2] == out[3] == ("und", 0)
    assert out[4][0] == out[7][0] == "xx" and out[6] == ("xx", 0)
    kept = language_id.accepted(df, filters, 0.25)
    assert kept.columns == df.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 4, 5, 7, 7]
    assert language_id.identify(df.limit(0), filters).count() == 0
    nothing = language_id.fit(df.select("doc_id", "text", F.lit(None).cast("string").alias("lang")))
    assert {r.lang_pred for r in language_id.identify(df, nothing).collect()} == {"und"}


def test_bound_comes_from_known_documents(spark, texts, filters):
    df = spark.createDataFrame(texts[120:], "doc_id long, text string, lang string")
    bound = language_id.score_bound(df, filters)
    scores = [r.score for r in language_id.identify(df, filters).collect()]
    assert bound == pytest.approx(language_id.BOUND_SHARE * min(scores), rel=0.05)
    assert language_id.score_bound(df.limit(0), filters) == 0
    foreign = spark.createDataFrame([(i, "quxly wombat zephyr fjord " * 5, None) for i in range(3)], df.schema)
    assert language_id.accepted(foreign.union(df), filters, bound).count() == 120


def test_sample_is_bounded(spark, texts):
    df = spark.createDataFrame(texts * 2, "doc_id long, text string, lang string")
    taken = Counter(r.label for r in language_id.sample_of(df, "lang", "text", "doc_id", 10).collect())
    assert set(taken) == set(SYLLABLES) and set(taken.values()) == {10}
    one = spark.range(2000).selectExpr("1 AS doc_id", "'same' AS text", "'xx' AS lang")
    rows = language_id.sample_of(one.union(df.select("doc_id", "text", "lang")), "lang", "text", "doc_id", 5).collect()
    assert Counter(r.label for r in rows) == dict.fromkeys(SYLLABLES, 5)
    lowest = sorted({(r.h, r.text) for r in df.where("lang = 'yy'").selectExpr("xxhash64(doc_id, text) AS h", "text").collect()})
    assert {r.text for r in rows if r.label == "yy"} == {t for _, t in lowest[:5]}


@pytest.fixture(scope="module")
def insults():
    """Documents whose toxic ones hold invented insults, and labels."""
    rnd = random.Random(9)
    rows = []
    for i in range(400):
        words = prose(rnd, "xx", 60).split()
        toxic = i % 4 == 0
        for _ in range(4 if toxic else 0):
            words.insert(rnd.randrange(60), rnd.choice(["Grobnik", "smelter", "grobniks", "vurt"]))
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def test_held_out_toxicity(spark, insults):
    documents = spark.createDataFrame([r[:2] for r in insults] + [(900, None), (901, ""), (None, "vurt")],
                                      "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in insults] + [(901, None), (None, 1)],
                                   "doc_id long, toxic int")
    grammar = toxicity.fit(documents, labels.where("doc_id % 3 <> 1"))
    rows = toxicity.score(documents, grammar).collect()
    truth = {r[0]: r[2] for r in insults}
    assert len(rows) == 403
    assert all(r.predicted == truth[r.doc_id] for r in rows if r.doc_id in truth)
    empty = [r for r in rows if r.doc_id in (900, 901)]
    assert all(r.predicted == 0 and 0 <= r.score < 0.7 for r in empty)
    none = toxicity.fit(documents, labels.where("toxic = 0"))
    assert {r.predicted for r in toxicity.score(documents, none).collect()} == {0}
    assert toxicity.score(documents.limit(0), grammar).count() == 0


def test_grammar_reads_clauses():
    grammar = toxicity.Grammar({"vurt": 2.0, "grob*": 3.0})
    aimed, negated, reported, threat = np.exp(toxicity.PRIOR)

    def weigh(text):
        amounts, _ = grammar.clause(toxicity.WORD.findall(text))
        return float(toxicity.total_of(amounts[None], toxicity.PRIOR)[0])

    def close(text, expected):
        return weigh(text) == pytest.approx(expected)

    assert close("a vurt and a grobnik", 5) and close("you vurt", 2 * aimed) and close("vurt that is you", 2 * aimed)
    assert close("he is not vurt", 2 * aimed * negated) and weigh("not a vurt") < weigh("a vurt")
    assert close('it said "vurt"', 2 * reported) and close('"x" vurt', 2) and close('a "vurt', 2 * reported)
    assert weigh("the train will kill time") == 0 and close("i will kill you", threat * aimed)
    none = grammar.evidence(None)
    assert not none[0].any() and none[1] == 0 and not grammar.evidence("plain words")[0].any()
    one, two = (grammar.evidence(t)[0].sum() for t in ("vurt. vurt", "vurt vurt"))
    assert two > one == 4  # matches of one clause count the more


def test_composed_machine_equals_plain_reading():
    """The composed states against each word's context read off the clause, and the parts one by one."""
    rnd = random.Random(12)
    vocabulary = ["x", "vurt", "grobnik", "you", "not", "said", '"', "kill", "him", "never"]
    grammar = toxicity.Grammar({"vurt": 2.0, "grob*": 3.0})
    for _ in range(2000):
        words = rnd.choices(vocabulary, k=rnd.randrange(14))
        expected, matches = np.zeros(2 * toxicity.CONTEXTS), 0
        for i, word in enumerate(words):
            near = words[max(0, i - 3):i]
            aimed = not {"you", "him"}.isdisjoint(near + words[i + 1:i + 4])
            context = (aimed + 2 * (not {"not", "never"}.isdisjoint(near))
                       + 4 * ("said" in words[:i] or words[:i].count('"') % 2 == 1))
            if word in ("vurt", "grobnik"):
                expected[context] += 2 if word == "vurt" else 3
            elif word == "kill" and aimed:
                expected[toxicity.CONTEXTS + context] += 1
            else:
                continue
            matches += 1
        found, n = grammar.clause(words)
        assert n == matches and (found == expected).all()
    symbols = [rnd.randrange(5) for _ in range(200)]
    parts = [toxicity.within_reach(toxicity.TARGET), toxicity.within_reach(toxicity.NEGATION),
             toxicity.once(toxicity.REPORT), toxicity.between(toxicity.QUOTE)]
    alone = zip(*([part.output[s] for s in part.states(symbols)] for part in parts))
    assert [toxicity.FORWARD.output[s] for s in toxicity.FORWARD.states(symbols)] == [sum(o, ()) for o in alone]


def test_factors_are_fitted():
    """Where the sample says that negated insults mean nothing, their factor falls; others stay by the prior."""
    rnd = np.random.default_rng(3)
    label = np.repeat([0.0, 1.0], 200)
    amounts = np.zeros((400, 2 * toxicity.CONTEXTS))
    amounts[label == 1, 0] = rnd.uniform(1, 6, 200)
    amounts[label == 0, 2] = rnd.uniform(4, 9, 200)  # negated
    factors, curve = toxicity.fit_factors(amounts, np.full(400, 50.0), label, np.ones(400))
    assert factors[1] < toxicity.PRIOR[1] - 0.3 and factors[2] == pytest.approx(toxicity.PRIOR[2], abs=0.05)
    grammar = toxicity.Grammar({}, factors, curve)
    assert ((grammar.score(amounts, np.full(400, 50.0)) >= 0.5) == label).mean() > 0.97


PAGE = """<html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body><header>Site
</header><nav><a href="/">Home</a></nav><div class="ad box">Buy</div><div id="cookie-notice">We use</div>%s
<form><input value="x">Send</form><aside>More</aside><div class="comments"><p>First!</p></div><footer>&copy; X
</footer></body></html>"""
BODY = "<h1>Title &amp; all</h1><p>One <b>bo</b>ld\n  word &lt;tag&gt;.<br>Line<ul><li>item</ul><p>Last"


def test_marked_article():
    expected = "Title & all One bold word <tag>. Line item Last"
    assert main_text.extract(PAGE % f"<article>{BODY}</article>") == expected
    assert main_text.extract(PAGE % f"<main>{BODY}<div class='share'>Share</div></main>") == expected
    assert main_text.extract(f"<body><nav>x</nav><article>{BODY}") == expected


def test_surge_and_dive_without_article():
    long = "<p>" + "Real prose goes here in some length. " * 5 + "</p>"
    page = PAGE % ("<p><a href=x>Link one</a></p>" * 6 + long * 3 + "<p><a href=x>Link two</a></p>" * 6)
    assert main_text.extract(page) == " ".join(["Real prose goes here in some length. " * 5] * 3).replace("  ", " ").strip()


@pytest.mark.parametrize("opening", [
    "<div class='container has-sidebar'>", "<div class='with-nav'>", "<div class='no-comments'>", "<div id='header-wrap'>",
    "<form action='x'>", "<div role='search'>", "<div class='related'><form>", "<section class='share-layout'><div>"])
def test_text_inside_a_wrapper(opening):
    comments = "<div class='comments'><article>%s</article></div>" % ("So I think. " * 3)
    expected = "Title & all One bold word <tag>. Line item Last"
    assert main_text.extract(PAGE % f"{opening}<article>{BODY}</article>{comments}</div>") == expected
    long = "Real prose goes here in some length. " * 9
    page = PAGE % f"{opening}<nav>Menu</nav>" + f"<p>{long}</p>" * 3
    assert main_text.extract(page.replace("</body></html>", "")).count("Real prose") == 27
    page = f"<html><body>{opening}<p>{long}</p><p>{long}</p></div></form></body></html>"
    assert main_text.extract(page) == " ".join([long.strip()] * 2)


@pytest.mark.parametrize("page, text", [
    ("<p class=\"a\"\">one</p><p title=it's>two</p>", "one two"),
    ("<article><ul><li class='share'>Share<li>body text</ul></article>", "body text"),
    ("<article><dl><dt class=ad>x<dd>y<dt>z</dl><table><tr><td class=ad>a<td>b<tr><td>c</table></article>", "y z b c"),
    ("<article><div class='social-history'>S</div><p id='related-work'>R</p><p class='search-engine-history'>H</p>"
     "<div class='related-posts'>X</div><div class='share-buttons'>X</div></article>", "S R H"),
    ("<article><p hidden>h</p><noscript>n</noscript><p aria-hidden=true>a</p></article>", "h n a"),
    ("<main><p>Main text.</p></main><article>Teaser</article>", "Main text."),
    ("<p class=ad>" + "<b>" * 30 + "gone<div>stays here</div>", "stays here"),
    ("<article>a <b>c <p x=\"1>2\">q</p> 1 < 2 &lt;</article>", "a c q 1 < 2 <"),
    ("<article>one <b two</article>", "one"),
    ("<p>Short opening.</p>" + "<p>Real prose goes here in some length.</p>" * 9,
     " ".join(["Short opening."] + ["Real prose goes here in some length."] * 9)),
])
def test_markup_and_names(page, text):
    assert main_text.extract(page) == text


def test_windows_decide_on_marked_pages():
    teaser, prose = "<article>See more</article>", "<p>" + "Real prose goes here in some length. " * 20 + "</p>"
    outside = main_text.extract(f"{teaser}<div>{prose * 4}</div>")
    assert outside.count("Real prose") == 80  # the mark is of something else
    assert main_text.extract(f"<article>{prose}</article><div><p>{'A remark. ' * 30}</p></div>").count("remark") == 0


BLOCK_TAGS = "p|h[1-6]|br|ul|ol|li|div|article|section|blockquote|pre|table|tr|td|th|dl|dt|dd|hr|main|body|header|footer|nav|aside"


def plain_extract(page):
    """The article between its tags, for pages as regular as the given ones."""
    page = re.sub(r"<!--.*?-->|<(script|style)\b.*?</\1>", "", page or "", flags=re.S)
    page = re.sub(r"<(nav|footer|header|aside|form)\b.*?</\1>|<div class=\"[^\"]*\">.*?</div>", "\n", page, flags=re.S)
    text = re.sub(rf"</?(?:{BLOCK_TAGS})\b[^>]*>", "\0", re.search(r"<article\b[^>]*>(.*)</article>", page, re.S)[1])
    blocks = (re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", "", b))).strip() for b in text.split("\0"))
    return " ".join(filter(None, blocks))


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no driver tables here")
def test_given_pages_equal_a_plain_extraction(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    for page in pages:
        assert main_text.extract(page.html) == plain_extract(page.html)
        # the method finds the same without any mark
        assert main_text.extract(re.sub("(</?)article", r"\1div", page.html)) == plain_extract(page.html)


def test_comments_stay_out_and_captions_in():
    comments = "<div class='comments'><article>%s</article></div>" % ("So I think. " * 30)
    assert main_text.extract(PAGE % f"{comments}<article>Short.</article>{comments}") == "Short."
    figure = "<figure><img src=x><figcaption>A river</figcaption></figure>"
    assert main_text.extract(f"<article><p>One</p>{figure}<p>Two</p></article>") == "One A river Two"


@pytest.mark.parametrize("page", [None, "", "<html>", "<!-- open", "<script>x", "<p", "</p></p>", "<a href='"])
def test_pages_without_text(page):
    assert main_text.extract(page) == ""


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"], exclude_characters="<&"), max_size=20), max_size=8))
def test_paragraphs_come_back(parts):
    page = "<article>" + "".join(f"<p>{html.escape(p)}</p>" for p in parts) + "</article>"
    assert main_text.extract(page) == " ".join(filter(None, (main_text.SPACE.sub(" ", p).strip() for p in parts)))


def test_hostile_markup_is_linear():
    for page in ("<p>" * 50_000, "<div>" * 50_000 + "x", "<a " * 50_000, "<!--" * 50_000, "<a href='" * 20_000):
        main_text.extract(page)


def test_pages_table(spark):
    rows = [(1, "u", f"<article>{BODY}</article>", "c"), (1, None, None, "c"), (None, "v", "plain text", "c")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    out = main_text.extract_pages(df).collect()
    assert len(out) == 3 and all(r.n_chars == len(r.text) for r in out)
    assert main_text.extract_pages(df.limit(0)).count() == 0


def brute_topk(rows, k, every):
    out = []
    valid = [(i, [int(np.floor(256 * x)) for x in v]) for i, v in rows
             if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    for q, v in dict((str(r), r) for r in valid if r[0] % every == 0).values():
        scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in valid if i != q)
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize("blocks", [(1000, 1000), (3, 7)])
def test_topk_equals_brute_force(spark, blocks):
    rnd = random.Random(1)
    rows = [(i, [rnd.choice([0.0, 0.0, rnd.uniform(-1, 1), 0.5]) for _ in range(6)]) for i in range(60)]
    rows += [(7, rows[7][1]), (10, rows[10][1]), (20, [1.0] * 4), (61, [1.0] * 9), (62, None), (63, [None] * 6),
             (64, [float("nan")] * 6), (65, [float("inf")] * 6), (None, [1.0] * 6), (66, []), (70, [0.0] * 6)]
    df = spark.createDataFrame([(i, v, 3) for i, v in rows], "vec_id long, embedding array<double>, score int")
    out = topk.search(df, F.col("vec_id") % 10 == 0, k=5, query_rows=blocks[0], candidate_rows=blocks[1])
    assert sorted(map(tuple, out.collect())) == brute_topk(rows, 5, 10)


def test_topk_of_little(spark):
    df = spark.createDataFrame([(0, [1.0])], "vec_id long, embedding array<float>")
    asks = F.col("vec_id") % 10 == 0
    assert topk.search(df, asks).count() == 0 and topk.search(df.limit(0), asks).count() == 0
    two = df.union(spark.createDataFrame([(1, [0.5])], df.schema))
    assert [tuple(r) for r in topk.search(two, asks).collect()] == [(0, 1, 1, 256 * 128)]


def test_topk_blocks_meet_in_separate_partitions(spark):
    rng = random.Random(8)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(4)]) for i in range(200)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    try:
        out = topk.search(df, F.col("vec_id") % 10 == 0, k=5, query_rows=7, candidate_rows=30).collect()
    finally:
        spark.conf.set(setting, before)
    kept = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    assert sorted(map(tuple, out)) == brute_topk(kept, 5, 10)

"""Quality, HTML extraction, chat formatting and line dedup: brute force, round trips and edge rows."""

import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from attrition.llm import chat, html_tree, line_runs, quality_bt
from attrition.llm.queries import ORACLES, QUERIES

# extra columns have the names that the operators use inside
EXTRA = ["source", "keeper", "a", "b", "n", "drops", "gone", "kept", "drop_id", "n_lines", "n_dropped", "_n_lines", "batch", "quality", "f"]


def _docs(spark, rows):
    return spark.createDataFrame([(i, t, *["x"] * len(EXTRA)) for i, t in rows],
                                 "doc_id bigint, text string, " + ", ".join(f"{c} string" for c in EXTRA))


# --- quality -----------------------------------------------------------------

def test_newton_fit_orders_separable_pairs():
    rng = np.random.default_rng(0)
    good, bad = rng.normal(1, 1, (200, 3)), rng.normal(-1, 1, (50, 3))
    diff = quality_bt.preference_pairs(good, bad)
    assert len(diff) == 200 * quality_bt.PARTNERS
    w = quality_bt.fit_bradley_terry(diff)
    assert (diff @ w > 0).mean() > 0.95
    # the gradient of the penalised loss vanishes
    p = 1 / (1 + np.exp(diff @ w))
    assert np.abs(quality_bt.RIDGE * w - (p[:, None] * diff).mean(0)).max() < 1e-4


def test_quality_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    out = QUERIES["op1_quality_bt"](spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = out.join(labels, "doc_id").filter("held_out").select("predicted", "quality").collect()
    assert len(rows) > 80
    assert sum(r.predicted == r.quality for r in rows) / len(rows) >= 0.95
    assert out.count() == 1000 and out.filter("score between 0 and 1").count() == 1000


def _plain_features(text):
    """The features of a text, counted byte by byte and word by word."""
    data = (text or "").encode()
    if not data:
        return [0.0] * 20
    space, stops, letters = b" \t\n\x0b\x0c\r", b".,;:", lambda c: 65 <= c <= 90 or 97 <= c <= 122 or c >= 128
    words, word = [], b""
    for c in data + b" ":
        if c in space:
            words += [word] if word else []
            word = b""
        else:
            word += bytes([c])
    kinds = {"upper": lambda c: 65 <= c <= 90, "digit": lambda c: 48 <= c <= 57, "space": lambda c: c in space, "stop": lambda c: c in stops,
             "mark": lambda c: not (letters(c) or 48 <= c <= 57 or c in space or c in stops), "bang": lambda c: c == 33,
             "bar": lambda c: c == 124, "symbol": lambda c: c in b"*#$%&@~^=+<>{}[]\\_`", "line": lambda c: c == 10,
             "high": lambda c: 128 <= c < 192}
    share = {k: sum(1 for c in data if is_it(c)) / (len(data) + 30) for k, is_it in kinds.items()}
    w = max(1, len(words))
    repeats = sum(1 for i, x in enumerate(words) if x in words[:i]) if len(words) < 3000 else len(words) - len(dict.fromkeys(words))
    again = sum(1 for x, y in zip(words, words[1:]) if x == y) / (w + 3.75)
    tail = 0
    for x in words:
        while x and x[-1] in b"*#$%&!|~^":
            x, tail = x[:-1], tail + 1
    total = sum(len(x) for x in words)
    return [math.log(1 + len(data)), *share.values(), total / w / 10, sum(len(x) > 20 for x in words) / w,
            (repeats if words else 1) / (w + 3.75), again, tail / (total + 30),
            *[math.log(1 + 20 * x) for x in (share["upper"], share["mark"], share["bar"], again)]]


def test_quality_equals_a_plain_loop(spark):
    """Features, pairs, the fit and the scores of sf0.001 without the operator's code."""
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").toPandas().sort_values("doc_id")
    votes = {}
    for r in spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality").collect():
        votes.setdefault(r.doc_id, set()).add(r.quality)
    x = np.array([_plain_features(t) for t in docs.text])
    learn = [i for i, d in enumerate(docs.doc_id) if zlib.crc32(str(d).encode()) % 3 != 1 and votes.get(d) in ({0}, {1})]
    y = np.array([min(votes[docs.doc_id.iloc[i]]) for i in learn])
    t = x[learn]
    scale = np.where(t.std(0) < 1e-9, 1, t.std(0))
    z = (t - t.mean(0)) / scale
    good, bad, rng = z[y == 1], z[y == 0], np.random.default_rng(11)
    n = max(len(good), len(bad)) * 8
    draw = lambda m: [k for _ in range(-(-n // m)) for k in rng.permutation(m)][:n]
    first, second = draw(len(good)), draw(len(bad))
    d = np.array([good[i] - bad[j] for i, j in zip(first, second)])
    w = np.zeros(20)
    for _ in range(5000):   # steps of a bounded length down the gradient of the same strictly convex loss, by its curvature
        p = 1 / (1 + np.exp(d @ w))
        grad = 1e-3 * w - (p[:, None] * d).mean(0)
        curve = (d.T * (p * (1 - p))) @ d / len(d) + 1e-3 * np.eye(20)
        step = np.linalg.solve(curve, grad)
        w -= step * min(1, 0.5 / max(1e-12, np.abs(step).max()))
        if np.abs(step).max() < 1e-10:
            break
    assert np.abs(grad).max() < 1e-8
    s = z @ w
    cut = float(np.quantile(s, (y == 0).mean(), method="midpoint"))
    want = dict(zip(docs.doc_id, 1 / (1 + np.exp(-((x - t.mean(0)) / scale @ w - cut)))))
    got = QUERIES["op1_quality_bt"](spark, sf).collect()
    assert len(got) == len(docs) and len(learn) > 50
    assert max(abs(r.score - want[r.doc_id]) for r in got) < 0.01
    assert all(r.predicted == (want[r.doc_id] >= 0.5) for r in got if abs(want[r.doc_id] - 0.5) > 0.01)


def test_quality_edge_rows_and_missing_labels(spark):
    docs = _docs(spark, [(1, None), (2, ""), (3, "word " * 50_000), (3, "word " * 50_000), (None, "x")])
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    out = {(r.doc_id, r.score, r.predicted) for r in quality_bt.op1_digest(docs, none).collect()}
    assert {(d, s) for d, s, _ in out} == {(i, 0.5) for i in (1, 2, 3, None)}
    odd = spark.createDataFrame([(1, 0, 0), (1, 1, 0), (2, None, 0), (None, 1, 0)], "doc_id bigint, quality int, toxic int")
    assert quality_bt.op1_digest(docs, odd).count() == 5
    assert quality_bt.op1_digest(docs.limit(0), none).count() == 0


# --- HTML ----------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var a="</p>";</script></head>
<body class="has-sidebar"><header><h1>Site name</h1></header><nav><ul><li><a href="/a">Home</a></li></ul></nav>
<div class="cookie-notice"><p>We use cookies, really, many.</p></div>
<div id="content"><article><header><h1>Head &amp; line</h1></header>
<p>First   paragraph, with <b>bold</b>, and a&nbsp;comma, &lt;tag&gt;.<p>Second one
breaks<br>off. <a href="x">link</a></p><div class="ad">Buy now, please, do.</div>
<ul><li>one, two</li><li>three</li></ul><form><p>Mail</p><input></form></article>
<aside><p>Related, text, here, with, many, commas, indeed.</p></aside>
<section id="comments"><p>A reader, who, writes, a, lot, of, commas, here, on, and, on.</p></section></div>
<footer>&copy; 2020</footer></body></html>"""


def test_extracts_the_article_only():
    assert html_tree.main_text(PAGE).split("\n") == [
        "Head & line", "First paragraph, with bold, and a comma, <tag>.", "Second one breaks off. link", "one, two", "three"]


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("plain words", "plain words"), ("<p>a<p>b", "a\nb"), ("<!-- x", ""), ("<script>x", ""),
    ("<article><h1>T</h1><p><b>unclosed<br><p>next", "T\nunclosed\nnext"), ("a < b & c", "a < b & c"),
    ("<body><div><p>one, two</p><p>three</p></div>", "one, two\nthree"), ("<td>x</b></td>", "x"),
    ("<form><main><p>asp page, all in a form</p></main></form>", "asp page, all in a form"),
    ("<body><nav>menu</nav></body>", ""), ("<article>&#x41;&eacute;&bogus;</article>", "Aé&bogus;"),
    ('<article><p title="a>b">q</p></article>', "q")])
def test_small_pages(page, text):
    assert html_tree.main_text(page) == text


LONG = "Some words of the body, with commas, and enough of them to make a paragraph that counts."


@pytest.mark.parametrize("page, text", [
    (f'<body><div class="page-header"><h1>Site</h1></div><div class="post"><div class="post-header"><h1>Title</h1></div>'
     f'<p>{LONG}</p><p>{LONG}</p></div><div class="sidebar"><p>{LONG}</p></div></body>', f"Title\n{LONG}\n{LONG}"),
    (f'<body><h1>Title</h1><article><p>{LONG}</p></article><p>We use cookies, and more, of the like, here and there.</p></body>',
     f"Title\n{LONG}"),
    (f'<body><div><p>{LONG}</p><p>{LONG}</p></div><div><p>{LONG}</p></div><div><a href="#">one</a><a href="#">two</a></div></body>',
     f"{LONG}\n{LONG}\n{LONG}"),
    (f'<body><main><div id="comments"><p>{LONG}</p><p>{LONG}</p></div><p>{LONG}</p><div hidden><p>{LONG}</p></div></main></body>', LONG),
    (f'<body><article><p>{LONG}</p><article class="comment"><p>{LONG}</p></article><table><tr><td>1<td>2</table></article>',
     f"{LONG}\n1\n2"),
    (f'<body><article><p>{LONG}</p><div class="share-buttons">Share</div><p class="notice">Notice</p><select><option>x</select></article>', LONG)])
def test_other_layouts(page, text):
    assert html_tree.main_text(page) == text


@pytest.mark.parametrize("part", [
    '<section id="discussion"><p>x, y</p></section>', '<h2 id="related-work">x, y</h2>', '<h2 id="search">x, y</h2>',
    '<div id="social-impact"><p>x, y</p></div>', '<p class="search-engines">x, y</p>', '<section id="cookies"><p>x, y</p></section>'])
def test_words_of_a_slug_cut_nothing(part):
    post = f'<article class="post hentry category-social tag-newsletter"><p>{LONG}</p>{part}<p>{LONG}</p></article>'
    assert html_tree.main_text(f"<body>{post}</body>") == f"{LONG}\nx, y\n{LONG}"
    assert html_tree.main_text(f"<body><div class='layout'>{post.replace('article', 'div')}</div></body>") == f"{LONG}\nx, y\n{LONG}"


@pytest.mark.parametrize("part", [
    '<div class="related-reading"><a href="#">x, y</a></div>', '<div class="comment-list"><p>x, y</p></div>',
    '<article class="comment"><p>x, y</p></article>', '<div class="SocialBar">x, y</div>', '<div id="disqus_thread">x, y</div>'])
def test_whole_names_of_noise_are_cut(part):
    assert html_tree.main_text(f"<body><article><p>{LONG}</p>{part}<p>{LONG}</p></article></body>") == f"{LONG}\n{LONG}"


LINKS = '<ul><li><a href="#">one, two</a></li><li><a href="#">three</a></li></ul>'


@pytest.mark.parametrize("page, text", [
    (f'<div><div><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p></div><h2>Next</h2><section><p>Short.</p></section><pre>x = 1</pre>'
     f'<h3><a href="#n">Note</a></h3><p>End.</p><h2>Elsewhere</h2>{LINKS}</div>', f"{LONG}\n{LONG}\n{LONG}\nNext\nShort.\nx = 1\nNote\nEnd."),
    (f'<main><p>Lead.</p><article><p>{LONG}</p></article><article><p>Part two.</p></article>{LINKS}</main>', f"Lead.\n{LONG}\nPart two."),
    (f'<main><h1>Title</h1><p>Lead.</p><div><article><p>{LONG}</p></article>{LINKS}</div></main>', f"Title\nLead.\n{LONG}"),
    (f'<body><h1>Title</h1><p>Lead.</p><article><p>{LONG}</p></article><h2>More</h2><article><p>Part two.</p></article><p>Imprint</p></body>',
     f"Title\nLead.\n{LONG}\nMore\nPart two.")])
def test_siblings_of_the_container_stay(page, text):
    assert html_tree.main_text(page) == text


NOISE_NAMES = """user-comments reader-comments fb-comments right-rail global-footer footer-legal cookie-policy-banner
    privacy-notice gdpr-consent-message google-ad sticky-ad mobile-menu site-header cookie-banner site-footer page-footer
    left-rail main-nav site-nav top-menu legal-notice copyright-notice sidebar-inner post-comments article-comments
    masthead-wrap banner-ads inline-advert consent-banner facebook-comments userComments cookie_banner""".split()
CONTENT_NAMES = """lunch-menu body-text article-body post-content entry-summary lead-paragraph pull-quote code-block
    related-work search-engines social-impact cookie-recipe menu-engineering comment-syntax ad-hoc-networks header-files
    notice-periods review-text figure-wrap step-list faq-answer table-wrap story-header hero-banner key-points
    author-bio results-section method-notes share-prices navigation-systems""".split()


@pytest.mark.parametrize("inside", [True, False])
def test_compound_names(inside):
    for name in NOISE_NAMES + CONTENT_NAMES:
        part = f'<div class="{name}"><p>x, y</p></div>'
        frame = ("article", "") if inside else ("div", ' class="layout"')
        page = f"<body><{frame[0]}{frame[1]}><p>{LONG}</p>{part}<p>{LONG}</p></{frame[0]}></body>"
        kept = name in CONTENT_NAMES and (inside or name not in ("lunch-menu", "story-header", "hero-banner"))
        assert html_tree.main_text(page) == (f"{LONG}\nx, y\n{LONG}" if kept else f"{LONG}\n{LONG}"), (name, inside)


def test_classes_of_code_and_headings_are_not_judged_by_their_last_word():
    page = f'<article><p>{LONG}</p><h2 class="user-comments">On comments</h2><pre><span class="hljs-comment">// x</span></pre><p>{LONG}</p></article>'
    assert html_tree.main_text(page) == f"{LONG}\nOn comments\n// x\n{LONG}"


@pytest.mark.parametrize("tags", ["<ul><li>", "<div>", "<b>", "<table><tr><td>", "<dl><dd>", "<section><p>", "<a><i>"])
def test_time_is_linear_in_the_depth(tags):
    import time
    n = 40_000
    start = time.process_time()
    html_tree.main_text(tags * n + "core, text" + "</x></i></b></div>" * n)
    assert time.process_time() - start < 5


def test_long_and_deep_pages_end():
    deep = "<div>" * 3000 + "<p>core, text</p>" + "</div>" * 3000
    assert html_tree.main_text(deep) == "core, text"
    long = "<article>" + "".join(f"<p>word{i}, and</p>" for i in range(20_000)) + "</article>"
    assert html_tree.main_text(long).count("\n") == 19_999


def test_pages_query_equals_the_parts_of_its_articles(spark):
    import html
    import re
    sf = "/root/testdata/sf0.001"
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    for r in QUERIES["op2_html_tree"](spark, sf).collect():
        inner = re.search(r"<article>(.*)</article>", pages[r.page_id], re.S)[1]
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
        assert r.text == "\n".join(p for p in parts if p) and r.n_chars == len(r.text)
    none = spark.createDataFrame([(1, None, None, 2), (1, None, None, 2)], "page_id bigint, url string, html string, text int")
    assert [tuple(r) for r in html_tree.extract_pages(none).collect()] == [(1, None, "", 0)] * 2
    assert html_tree.extract_pages(none.limit(0)).count() == 0


# --- chat ------------------------------------------------------------------------

NASTY = [chat.TRAP, "&", "&amp;", "&lt;|", "<", "|", "<|im_sep|>", "&#10;", "\n", "", None, "a\r\nb", "<<|im_end|>", "\U0001f600", "\\"]


def test_chat_round_trip_with_hostile_texts(spark):
    rng = random.Random(3)
    rows, want = [], {}
    for c in range(60):
        turns = []
        for t in range(rng.randint(1, 9)):
            turns.append((t, rng.choice(["user", "assistant", "system", "odd\nrole|<|", None]), rng.choice(NASTY)))
        want[c] = [(r or "", x or "") for _, r, x in turns]
        rng.shuffle(turns)
        rows += [(c, t, r, x, "x") for t, r, x in turns]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, formatted string")
    out = chat.format_chat(df, segments=True)
    back = {r.conv_id: [(t.role, t.text) for t in r.turns] for r in chat.read_back(out).collect()}
    assert back == want
    for r in out.collect():
        assert "".join(s.piece for s in r.segments) == r.formatted
        loss = [s.piece.replace("&lt;|", "<|").replace("&amp;", "&") for s in r.segments if s.loss]
        assert loss == [x for role, x in want[r.conv_id] if role == "assistant"]


def test_chat_merges_neighbours_and_handles_edges(spark):
    df = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 1, "user", "b"), (None, 5, None, None)],
                               "conv_id bigint, turn bigint, role string, text string")
    got = {r.conv_id: r.formatted for r in chat.format_chat(df).collect()}
    assert got == {1: "<|im_start|>user\na<|im_sep|>b<|im_sep|>b<|im_end|>\n", None: "<|im_start|>\n<|im_end|>\n"}
    digest = {r.conv_id: r for r in chat.op4_digest(df.limit(0)).collect()}
    assert list(digest) == [-1] and digest[-1].n_turns == 2
    said = "".join(f"{r}\n{chat.TRAP}\n" for r in ("user", "assistant"))
    assert digest[-1].turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
    assert digest[-1].loss_sha256 == hashlib.sha256(chat.TRAP.encode()).hexdigest()


def test_the_digest_reads_the_loss_mask(spark, monkeypatch):
    df = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "assistant", "b&<|")], "conv_id bigint, turn bigint, role string, text string")
    real = chat.format_chat

    def unmasked(turns, segments=False):
        out = real(turns, segments)
        wrong = F.transform("segments", lambda s: s.withField("loss", F.lit(False)))
        return out.withColumn("segments", wrong) if segments else out

    chars = lambda: {r.conv_id: r.loss_chars for r in chat.op4_digest(df).collect()}
    assert chars() == {1: 4, -1: len(chat.TRAP)}
    monkeypatch.setattr(chat, "format_chat", unmasked)
    assert chars() == {1: 0, -1: 0}


# --- line dedup ----------------------------------------------------------------------

def _brute_lines(rows, min_chars=20, min_docs=3):
    strip = " \t\n\x0b\x0c\r"

    def key(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(strip))

    holders = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            if i is not None and len(key(line)) >= min_chars:
                holders.setdefault(key(line), set()).add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (i is not None and len(holders.get(key(x), ())) >= min_docs and max(holders[key(x)]) != i)]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("batches, fanout", [(1, 2), (4, 2), (7, 3)])
def test_line_dedup_equals_brute_force(spark, batches, fanout):
    rng = random.Random(batches)
    pool = [f"Common line number {i} of the pool" for i in range(12)] + ["short", "", " \t", "Été " * 6, "exactly twenty chars", "nineteen characters"]
    rows = [(i, "\n".join(rng.choice([x, f"  {x.upper()}\t"]) for x in rng.choices(pool, k=rng.randint(0, 6)))) for i in range(60)]
    rows += [(5, rows[5][1]), (None, pool[0]), (70, None), (71, ""), (72, "\n".join(pool) * 300)]
    docs = _docs(spark, rows)
    out = line_runs.line_counts(docs, n_batches=batches, fanout=fanout)
    got = sorted(((r.doc_id, r.n_lines, r.n_dropped, hashlib.sha256((r.text or "").encode()).hexdigest())
                  for r in out.collect()), key=str)
    assert got == _brute_lines(rows)
    cut = line_runs.dedup_lines(docs, n_batches=batches, fanout=fanout)
    assert cut.columns == docs.columns
    assert sorted((r.doc_id or -1, r.text or "") for r in cut.collect()) == sorted((r.doc_id or -1, r.text or "") for r in out.collect())
    assert cut.filter("gone <> 'x' or kept <> 'x'").count() == 0
    assert line_runs.op9_digest(docs.limit(0)).count() == 0


def test_settled_keys_are_not_written_again(spark):
    runs = line_runs.LineRuns(spark, fanout=100)
    one = spark.createDataFrame([(d, 1, 1) for d in (9, 8, 7)] + [(9, 2, 2)], "doc_id bigint, a bigint, b bigint")
    two = spark.createDataFrame([(d, 1, 1) for d in (3, 2)] + [(3, 2, 2)], "doc_id bigint, a bigint, b bigint")
    runs.add(one)
    runs.add(two)
    last = spark.read.parquet(runs.paths()[-1]).collect()
    assert [(r.a, r.n, r.keeper) for r in last] == [(2, 1, 3)]
    assert [tuple(r) for r in runs.condemned().collect()] == [(1, 1, 9)]


def test_runs_compact_by_level(spark):
    runs = line_runs.LineRuns(spark, fanout=2)
    for d in range(5):
        runs.add(spark.createDataFrame([(d, d % 2, 0)], "doc_id bigint, a bigint, b bigint"))
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    assert {tuple(r) for r in runs.condemned().collect()} == {(0, 0, 4)}


# --- oracles ---------------------------------------------------------------------------

@pytest.mark.parametrize("key", sorted(ORACLES))
def test_oracle_on_small_tables(spark, key):
    import check_oracle as CO
    import duckdb
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "conversations", "benchmark", "labels", "pages", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    assert CO.compare(QUERIES[key](spark, sf).toPandas(), con.sql(ORACLES[key]).df()) == "ok"


def test_held_out_is_the_crc_of_the_id(spark):
    import zlib
    rows = spark.range(200).select("id", quality_bt.held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 3 == 1) for r in rows)

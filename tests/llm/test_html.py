import html as entities
import re
import time

import numpy as np
import pytest

from sitewise.llm import html as H
from sitewise.llm.boosting import boost

SCHEMA = "page_id long, url string, html string"
PARAGRAPH = " ".join("The quick brown fox jumps over the lazy dog, and then it rests." for _ in range(6))


@pytest.fixture(scope="module")
def pages(spark):
    return spark.read.parquet("/root/testdata/sf0.01/pages.parquet")


def from_markup(page):
    """The article's headings and paragraphs, as these pages mark them."""
    article = re.search(r"<article>(.*?)(</article>|$)", page, re.S)[1]
    parts = (entities.unescape(re.sub(r"<[^>]*>", lambda m: " " if m[0] == "<br>" else "", p)) for p in re.split(r"</?(?:p|h1)>", article))
    return "\n".join(t for t in (re.sub(r"[\x20\x09-\x0D]+", " ", p).strip() for p in parts) if t)


def test_every_page_of_the_table(pages):
    got = {r.page_id: r for r in H.main_text(pages).collect()}
    rows = pages.collect()
    assert len(got) == len(rows)
    for r in rows:
        text = from_markup(r.html) if r.html else ""
        assert (got[r.page_id].text, got[r.page_id].url, got[r.page_id].n_chars) == (text, r.url, len(text))


def test_other_rows_and_tables(spark, pages):
    page = pages.where("html is not null").first().html
    rows = [(1, "u", None), (2, None, ""), (3, "u", page), (3, "u", page), (None, "u", page), (4, "u", page.replace("</article>", "<p>" + from_markup(page).replace("\n", " ") * 50 + "</p></article>"))]  # not the first </p>: a script holds that
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' as text", "1 as n_chars")
    got = H.main_text(df).collect()
    assert [r.text for r in got[:2]] == ["", ""] and got[0].n_chars == 0
    assert got[2] == got[3] and got[4].text == got[2].text == from_markup(page) and got[5].n_chars > 250_000
    assert H.main_text(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize(
    "markup,text",
    [
        ("<p>a &lt;b&gt; &amp;amp; &#233;&eacute;</p>", "a <b> &amp; éé"), ("<p>a<p>b<p>c", "a\nb\nc"), ("<p>a <b>b</b>c<br>d\n\te</p>", "a bc d e"), ("<ul><li>a<li>b</ul>", "a\nb"),
        ("<p>a<!-- <p>no</p> -->b</p>", "ab"), ("<p>a<script>if (a<b) '</p>'</script>b", "ab"), ('<p title="x>y">a</p>', "a"), ("a < b", "a < b"), ("<p>a</span></div>b</p>c", "ab\nc"),
        ("<div>a<p>b</p>c</div>d", "a\nb\nc\nd"), ("<style>x</style><title>t</title><textarea>q</textarea>", ""), ("<table><tr><td>a<td>b<tr><td>c</table>", "a\nb\nc"), ("<p>a<!-- open", "a"),
        ("<a href='x>y</a><p>z</p>", "y\nz"), ("<select><option>a</select><button>b</button>c", "c"), ("a<hr>b", "a\nb"), ("<P>A</P><BR>", "A"), ("<p>a&nbsp; b</p>", "a b"), ("", ""),
    ],
)
def test_reading(markup, text):
    nodes = H.parse(markup)
    assert H.text_of(nodes, np.ones(len(nodes.tag), dtype=bool)) == text


@pytest.mark.parametrize("piece,close", [("<a", ""), ("<" + "a" * 1000, ""), ('<a "', ""), ('<a "', ">"), ("<a '\"", ">"), ("<!-- --", ""), ("<!-- a -->", ""), ('<a class="', ">"), ("<div><dd></dd>", ""), ("<div></b></section>", ""), ("<p><b>", ""), ("&", ""), ("<script>", "")])
def test_bad_markup_takes_linear_time(piece, close):
    page = (piece * (500_000 // len(piece)) + close) * 2
    began = time.process_time()
    assert H.parse(page).tag
    assert time.process_time() - began < 6  # a second or two; a quadratic scan takes hours


@pytest.mark.parametrize("start,one,other", [("<ul><li><ul>", "<div>", "<li></li>"), ("<dl><dt><dl>", "<div>", "<dt></dt>"), ("<table><tr><td><table>", "<div>", "<td></td>"), ("<i><div><b>", "<u>", "</i>"), ("<p><div>", "<b>", "<p></p></section>")])
def test_deep_markup_takes_linear_time(start, one, other):
    n = 1_000_000 // len(one + other)
    page = start + one * n + other * n
    began = time.process_time()
    assert H.parse(page).tag
    assert time.process_time() - began < 6


@pytest.mark.parametrize("piece", ["<p>a</p>", "<script", "<style>", "<", "<body", "<article", "</article", "<p>a</p></article"])
def test_fitting_on_a_truncated_page_takes_linear_time(piece):
    page = "<html><body><article>" + "<p>word and word, again.</p>" * 20 + piece * 10_000
    began = time.process_time()
    H._words(page)
    for k in range(1, 5):
        H._shortened(page, k)
    assert time.process_time() - began < 1


def test_pages_are_shortened_like_the_pattern_says(pages):
    import re

    rows = [r.html for r in pages.limit(40).collect() if r.html] + ["<article><p>a</p><p>b</p>c</article>d</article>", "<article", "<article>x</article><p>y</p></article>", "<article>x<p>y</p>"]
    for page in rows:
        for k in range(1, 5):
            assert H._shortened(page, k) == re.sub(r"(<article[^>]*>(?:.*?</p>){1,%d}).*?(?=</article>)" % k, r"\1", page, count=1, flags=re.S)
        assert H._words(page) == re.sub(r"<(script|style).*?</\1>|<[^>]*>", " ", page, flags=re.S).replace("<", " ").split()


def test_unnamed_main_elements(pages):
    rows = [r.html for r in pages.collect() if r.html]
    bare = [p.replace("<article>", "<div>").replace("</article>", "</div>") for p in rows]
    for sample in (rows[:100], bare[:100]):
        got = H.extract_batch(bare[100:], H.fit(sample))
        assert np.mean([g == from_markup(p) for g, p in zip(got, rows[100:], strict=True)]) >= 0.9


def test_marked_boilerplate_goes(pages):
    model = H.fit([r.html for r in pages.where("html is not null").collect()])
    around = '<html><body><nav><a href="/">Home</a> <a href="/b">B</a></nav>{}<footer>&copy; all</footer></body></html>'
    for inside, want in (
        ("<article><h1>Title</h1><p>{p}</p></article><div class='comments'><p>{p}</p></div>", "Title\n" + PARAGRAPH),
        ("<main><p>{p}</p><ul><li>{p}</li></ul></main><form><p>Sign up</p><input></form><div class='cookie-notice'>Cookies.</div>", PARAGRAPH + "\n" + PARAGRAPH),
    ):
        assert H.extract_batch([around.format(inside.format(p=PARAGRAPH))], model) == [want]


def brute_decode(parent, keep):
    best, choice = -np.inf, None
    for bits in range(1 << len(parent)):
        c = [bool(bits >> i & 1) for i in range(len(parent))]
        if all(not c[i] or c[parent[i]] for i in range(1, len(parent))):
            value = sum(np.log(keep[i] if c[i] else 1 - keep[i]) for i in range(len(parent)))
            if value > best:
                best, choice = value, c
    return choice


def test_decoding_equals_brute_force():
    r = np.random.default_rng(1)
    for _ in range(60):
        n = int(r.integers(1, 10))
        parent = [-1] + [int(r.integers(0, i)) for i in range(1, n)]
        keep = r.uniform(0.02, 0.98, n)
        assert H.decode(parent, keep).tolist() == brute_decode(parent, keep)


def test_boosting_learns_an_interaction():
    r = np.random.default_rng(2)
    x = r.standard_normal((2000, 6))
    y = ((x[:, 0] > 0) ^ (x[:, 3] > 0.5)).astype(float)
    model = boost(x[:1500], y[:1500])
    assert ((model.predict(x[1500:]) > 0.5) == y[1500:]).mean() > 0.95


def test_copies_of_a_page_are_one_page_of_the_sample(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(H, "fit", lambda pages: seen.extend(pages))
    rows = [(i, "u", f"<p>{i // 100}</p>") for i in range(1000)] + [(1001, "u", None), (1002, "u", "")]
    H.main_text(spark.createDataFrame(rows, SCHEMA), sample=5)
    assert len(seen) == len(set(seen)) == 5 and "" not in seen

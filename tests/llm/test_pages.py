import html as entities
import re

import numpy as np

from payscore.llm import html, trees

SF = "/root/testdata/sf0.01"


def article(source):
    inside = source.split("<article>", 1)[1].split("</article>")[0]
    inside = re.sub(r"<[^>]*$", "", inside)
    inside = re.sub(r"<br>", " ", re.sub(r"</?(?:p|h1)>", "\n", inside))
    lines = entities.unescape(re.sub(r"<[^>]+>", "", inside)).split("\n")
    return "\n".join(x for x in (" ".join(line.split()) for line in lines) if x)


def test_given_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r.page_id: r for r in html.op10_html(spark, SF).collect()}
    for r in pages.collect():
        assert got[r.page_id].text == article(r.html) and got[r.page_id].n_chars == len(got[r.page_id].text) and got[r.page_id].url == r.url


def test_other_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    fitted = html.fit_pages(pages)
    long = "This is a long paragraph of text, with several words &amp; signs. It goes on for a while, and ends here."
    sources = [
        f'<body><div class="menu"><a href=x>One</a><a>Two</a></div><div class="content"><h1>Title here</h1><p>{long}</p><div class="ad">Buy now!</div>'
        f'<p>{long}</p></div><div class="comments"><p>I like this a lot, it was great to read.</p></div><footer>&copy; 2020</footer></body>',
        f"<main><p>{long}<script>if (a<b) '</p>'</script> more</p><form><label>Name</label><input></form></main><aside><p>Related: other things to read.</p></aside>",
        None, "", "<p", "<article", "no markup", "<article>" + "<div>" * 3000 + long, f"<article><p>{long}" * 2000,
    ]
    df = spark.createDataFrame([(i, None, s, "x") for i, s in enumerate(sources)] * 2, "page_id long, url string, html string, text string")
    rows = html.main_texts(df, fitted).collect()
    assert len(rows) == 2 * len(sources)
    got = {r.page_id: r.text for r in rows}
    plain = entities.unescape(long)
    assert got[0] == f"Title here\n{plain}\n{plain}"
    assert got[1] == f"{plain} more"
    assert got[2] == got[3] == got[4] == got[5] == ""


def test_missing_end_tags():
    none = trees.Trees(np.zeros((0, 15), np.int64), np.zeros((0, 15)), np.zeros((0, 16)), 0.0)
    page = "<html><head><meta charset=x><title>T</title><body><article><p>One two three.</p>{}</article></body></html>"
    inside = {
        "<p>End.</p>": "End.", "<div><svg><g>no</div><p>End.</p>": "End.", "<div><noscript><p>no</div><p>End.</p>": "End.",
        "<div><select><option>no<option>no</div><p>End.</p>": "End.", "<div><object><object>no</object>no</object>End.</div>": "End.",
        "<p>A <button>b</button> <math><mi>x</mi></math></p><p>End.": "A b\nx\nEnd.", "<p>A <svg><text>no</text></svg> End.</p>": "A End.",
    }
    for source, want in inside.items():
        assert html.texts_of(none, [page.format(source)]) == ["One two three.\n" + want]
        assert html.texts_of(none, [page.format(source).replace("<body>", "</head><body>")]) == ["One two three.\n" + want]
    assert html.texts_of(none, ["<head><title>T</title><article><p>One two.</p></article>"]) == ["One two."]


def test_states_never_contradict():
    rng = np.random.default_rng(1)
    source = "<body>" + "".join(f"<div><p>text {k}<section><ul><li>x<li>y</ul></section></div>" for k in range(20)) + "</body>"
    page = html.Page(source)
    page.features()
    for _ in range(50):
        states = page.decode(rng.random(len(page.tags)))
        for i in range(1, len(states)):
            assert states[i] >= states[page.parents[i]]


def test_trees_learn():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(3000, 6))
    y = ((x[:, 0] > 0.3) ^ (x[:, 3] > 0)).astype(float)
    fitted = trees.fit_trees(x[:2000], y[:2000])
    assert ((fitted.probability(x[2000:]) > 0.5) == y[2000:]).mean() > 0.95
    assert trees.fit_trees(x[:5], np.ones(5)).probability(x).min() > 0.5


def test_empty_table(spark):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert html.main_texts(none, html.fit_pages(none)).count() == 0

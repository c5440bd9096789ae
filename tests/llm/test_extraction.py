import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillrank.llm import extraction


def page(rnd, k, marked=True):
    def text(n):
        return " ".join(f"w{rnd.randint(0, 999)}" for _ in range(n)) + "."

    body = [f"T{k} &amp; more", *[text(rnd.randint(2, 80)) for _ in range(rnd.randint(3, 8))]]
    inside = f"<h1>{body[0]}</h1>" + "".join(f"<p>{t}" for t in body[1:])
    menu = "".join(f'<li><a href="/{j}">item {j}</a></li>' for j in range(6))
    wrap = ("<nav><ul>", "</ul></nav>", "<article>", "</article>", "<footer>", "</footer>") if marked else ("<div><ul>", "</ul></div>", "<div>", "</div>", "<div>", "</div>")
    extra = '<aside class="sidebar"><p>Read this too.</p></aside><div class="comments"><p>First! Great post.</p></div><form><label>Mail</label></form>' if marked else ""
    html = f"<html><head><title>x</title><style>p{{}}</style></head><body>{wrap[0]}{menu}{wrap[1]}<script>var a='</p>';</script><!-- <p>no</p> -->{wrap[2]}{inside}{wrap[3]}{extra}{wrap[4]}&copy; site <a href='/a'>about</a>{wrap[5]}</body></html>"
    return html, "\n".join(["T%d & more" % k, *body[1:]])


def test_extraction(spark):
    rnd = random.Random(7)
    rows = [(k, "u", *page(rnd, k)) for k in range(60)]
    rows += [(100, None, None, ""), (101, "u", "", ""), (102, "u", "<article><p>a &lt; b<br>c\n\n d</p><p>cut &am", "a < b c d\ncut &am")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, want string").withColumn("text", F.lit("clash"))
    got = {r["page_id"]: r for r in extraction.extract(df).collect()}
    assert {k: r["text"] for k, r in got.items()} == {r[0]: r[3] for r in rows}
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())
    assert extraction.extract(df.limit(0)).count() == 0


def test_trees_read_structure_alone():
    """Without telling tags, the trees still tell articles from menus in most elements."""
    rnd = random.Random(8)
    trees = extraction.Trees(*extraction._examples([page(rnd, k)[0] for k in range(80)]))
    share = []
    for k in range(20):
        html, want = page(rnd, k, marked=False)
        got = set(extraction.main_text(html, trees).split("\n"))
        share.append(len(got & set(want.split("\n"))) / len(got | set(want.split("\n"))))
    assert np.mean(share) > 0.7


def test_marks_count_alike_at_every_length():
    rate = [extraction.Page(f"<p>{'so; it: is! ' * n}</p>").features()[-1, 10] for n in (100, 800, 900, 5000)]
    assert np.allclose(rate, rate[0], rtol=0.01) and rate[0] > 20


def test_decoding_has_no_orphans():
    rnd = np.random.default_rng(0)
    parsed = extraction.Page("<div>a<div>b<p>c</p><p>d</p></div><ul><li>e<li>f</ul></div><div>g</div>")
    for _ in range(50):
        kept = parsed.decode(rnd.normal(size=len(parsed.tag)) * 3)
        assert all(kept[p] for k, p in enumerate(parsed.parent) if k and kept[k])


@pytest.fixture(scope="module")
def trees():
    rnd = random.Random(11)
    return extraction.Trees(*extraction._examples([page(rnd, k)[0] for k in range(100)]))


LINES = [
    "The council met again on Monday to talk about a new bridge over the river.",
    "Nobody could agree on its price, but most members want it to be built before winter comes, and so does the mayor.",
    "Trees along the northern bank will be kept; a small park may follow in two years.",
    "Shops near the old crossing fear that their customers will stay away while the road is closed.",
    "A vote will be held next week in the old town hall, where all citizens may speak for three minutes.",
]
LINKED = [x.replace("new bridge", "<a href='/b'>new bridge</a>").replace("small park", "<a href='/p'>small park</a>") for x in LINES]
HEAD = "Bridge plans divide the town"
MENU = ["Home", "News", "Sport", "Contact"]


def written():
    """(html, kept blocks) of pages written by hand: every article style among every kind of surroundings."""
    def tags(tag, lines):
        return "".join(f"<{tag}>{x}</{tag}>" for x in lines)

    def menu(link, open_, close):
        return open_ + "<ul>" + "".join(f"<li><a href=#>{m}</a>" if link else f"<li>{m}" for m in MENU) + "</ul>" + close

    plain, linked = [HEAD, *LINES], [HEAD, *LINES]
    articles = [
        ("<article><h1>%s</h1>%s</article>" % (HEAD, tags("p", LINES)), plain),
        ("<article class=post><h1>%s</h1>%s</article>" % (HEAD, tags("p", LINKED)), linked),
        ("<main><div><div class='inner'><h1>%s</h1>%s</div></div></main>" % (HEAD, tags("p", LINKED)), linked),
        ("<div id='post-body'><h1>%s</h1>%s<h2>Costs</h2><ul>%s</ul><blockquote>%s</blockquote></div>" % (HEAD, tags("p", LINKED[:2]), tags("li", LINKED[2:4]), LINES[4]), [*linked[:3], "Costs", *LINES[2:]]),
        ("<div class='layout content'><section><article><header><h1>%s</h1></header>%s<pre>%s</pre></article></section></div>" % (HEAD, tags("div", LINKED[:3]), LINES[3]), [HEAD, *LINES[:4]]),
        ("<div><h1>%s</h1>%s</div>" % (HEAD, tags("p", LINES * 2)), [HEAD, *LINES, *LINES]),
    ]
    arounds = [
        (menu(True, "<nav>", "</nav>"), "<footer>&copy; The Town Post <a href=/i>imprint</a></footer>"),
        (menu(False, "<div class='main-menu'>", "</div>"), "<div class='site-footer'>All rights reserved.</div>"),
        ("<div class='cookie-notice'>We use cookies to make this site better.</div>" + menu(True, "<header>", "</header>"), "<div class=comments><p>I like this bridge a lot, and so do all of my neighbours.</p><p>No!</p></div>"),
        (menu(True, "<div>", "</div>"), "<aside><h3>Read on</h3><p>How the last bridge was built, and who paid for it in the end.</p></aside><form><label>Mail</label><p>Subscribe</p></form>"),
        ("<div class='ad banner'><p>Buy one umbrella and get a second one free.</p></div>", "<section id=comments><article><div class=comment-body><p>First comment, with a lot of words about nothing in particular.</p></div></article></section><footer><p><a href=/i>Imprint</a></p></footer>"),
    ]
    for before, after in arounds:
        for article, kept in articles:
            yield f"<html><head><title>t</title></head><body>{before}{article}{after}</body></html>", kept


def test_extraction_of_pages_written_by_hand(trees):
    right = found = wanted = 0
    for html, kept in written():
        got = extraction.main_text(html, trees).split("\n")
        right += sum((Counter(got) & Counter(kept)).values())
        found, wanted = found + len(got), wanted + len(kept)
    assert 2 * right / (found + wanted) >= 0.95


def test_a_link_changes_no_verdict(trees):
    for html, kept in list(written())[:5]:
        assert extraction.main_text(html, trees) == "\n".join(kept)
    body = "".join(f"<p>{x}</p>" for x in LINKED[:3])
    got = extraction.main_text(f"<article class=post>{body}</article><footer>(c) site</footer>", trees)
    assert got == "\n".join(LINES[:3])
    notice = "<div class='cookie-notice'>We use cookies.</div><article><p>" + LINES[0] + "</p></article>"
    assert extraction.main_text(notice, trees) == LINES[0]


def test_trees_use_all_kinds_of_features(trees):
    used = Counter(f for feature, limit, _ in trees.trees for f, cut in zip(feature, limit) if np.isfinite(cut))
    kinds = {"tokens": range(4), "links": (6, 7, 13), "density": (8, 9, 10, 11, 14), "depth": (15,), "siblings": (16, 17, 18)}
    assert all(sum(used[f] for f in columns) >= 20 for columns in kinds.values()), used
    assert max(used.values()) < 0.25 * sum(used.values())


def test_extraction_of_repeated_long_and_broken_pages(spark, trees):
    long = "<article>" + "".join(f"<p>{LINES[k % 5]} {k}</p>" for k in range(30000)) + "</article>"
    rows = [(1, "u", long), (2, "u", "<article><p>a b c</p></article><script>var x = '<p>never closed"), (3, "u", None)]
    rows += [(4, "u", page(random.Random(1), 4)[0])] * 5 + [(None, "u", "<main><p>no key</p></main>")]
    got = extraction.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    text = {r["page_id"]: r["text"] for r in got}
    assert len(got) == len(rows) and len({r["text"] for r in got if r["page_id"] == 4}) == 1
    assert text[1].count("\n") == 29999 and text[2] == "a b c" and text[3] == "" and text[None] == "no key"

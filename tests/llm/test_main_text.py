import math
import random
import time
from xml.etree import ElementTree

import pytest
from pyspark.sql import functions as F

from followgraph.llm import html_extract as H

PAGES = [
    (None, ""),
    ("", ""),
    ("plain words only", "plain words only"),
    ("<nav>menu</nav>", ""),
    ("<p>a<p>b &nbsp; c<script>x<", "a b c"),
    (
        "<html><head><title>T</title><style>p{}</style></head><body><header><a href='/'>Home</a></header><nav><ul><li><a href='/a'>One</a></li></ul></nav>"
        "<main><article><h1>A title</h1><p>First   paragraph,\n with <b>bold</b> text &amp; more.</p><p>Be.</p><ul><li>one<li>two</ul>"
        "<aside>Related things</aside><script>var t='</p>';</script></article></main><footer>&copy; x</footer></body></html>",
        "A title First paragraph, with bold text & more. Be. one two",
    ),
    (
        '<body class="has-sidebar"><div id="top-menu"><a href="/">Home</a></div><div class="wrap"><div class="col"><h2>News today</h2><p>Long text, with commas, and a full stop. '
        'And more of it.</p><p>Short.</p></div><div class="sidebar"><p>Popular now, with some longer text, too.</p></div></div>'
        '<div class="comments"><article class="comment"><p>Great post, I agree with all of it, really, every word.</p></article></div>'
        '<form><label>Mail</label><input></form><div class="cookie-notice">We use cookies, as all do.</div></body>',
        "News today Long text, with commas, and a full stop. And more of it. Short.",
    ),
    ("<article><h1>X&amp</h1><p><b>X&am<br><p>Sh is.</p><p>Y</p></article><footer>f", "X& X&am Sh is. Y"),
    ("<article>a<b>b</b>c <i>d</i></article>", "abc d"),
    ("<div hidden>no</div><div style='display: none'>no</div><div aria-hidden=true>no</div><p>yes</p>", "yes"),
]


@pytest.mark.parametrize("html, want", PAGES)
def test_pages(html, want):
    assert H.main_text(html) == want


def test_table(spark):
    long_page = "<article>" + "<p>word, and word.</p>" * 20_000 + "</article>"
    rows = [(i, h) for i, (h, _) in enumerate(PAGES)] + [(0, None), (100, long_page)]
    df = spark.createDataFrame(rows, "page_id long, html string").withColumn("text", F.lit("clash"))
    got = H.extract(df)
    assert got.columns == df.columns
    by_id = {r.page_id: r.text for r in got.collect()}
    assert got.count() == len(rows) and by_id[100] == " ".join(["word, and word."] * 20_000)
    assert [by_id[i] for i in range(len(PAGES))] == [t for _, t in PAGES]
    assert H.extract(df.limit(0)).count() == 0


def test_paths_outside_the_container_lose():
    """Without any telling names the branch with the most text and punctuation is taken."""
    blocks = "".join(f"<p>Sentence {i}, with a comma, and an end.</p>" for i in range(8))
    html = f"<div><div class=x1><a href=/>Link</a></div><div class=x2>{blocks}</div><div class=x3>tiny</div></div>"
    assert H.main_text(html).startswith("Sentence 0") and "tiny" not in H.main_text(html) and "Link" not in H.main_text(html)


def _prose(n: int) -> str:
    return ("Some words of a sentence, and its end. " * (n // 39 + 1))[:n].strip()


def test_no_section_of_the_text_is_lost():
    lead, body, more = _prose(200), _prose(800), _prose(330)
    assert H.main_text(f"<div class=lead><p>{lead}</p></div><div class=body><p>{body}</p></div>") == f"{lead} {body}"
    cut = f"<div><div class=part-a><p>{more}</p></div><div class=part-b><h2>Heading</h2>{f'<p>{body}</p>' * 4}</div><div class=part-c><p>{lead}</p></div></div>"
    assert H.main_text(cut) == " ".join([more, "Heading", *[body] * 4, lead])


def test_an_article_that_is_a_card_is_not_the_main_text():
    body = _prose(900)
    card = "<article class=card><h3>Other</h3><p>Teaser.</p></article>"
    html = f"<div class=text><p>{body}</p><p>{body}</p></div><div class=more>{card * 3}</div>"
    assert H.main_text(html).startswith(f"{body} {body}")


def test_paths_of_a_page_with_an_article_meet_the_threshold():
    """Short scraps beside the article go by their ratio; text of the page beside it stays, and the
    article's own short sections do."""
    body = f"<p>{_prose(90)}</p>" * 6
    html = f"<div class=x>tiny</div><article><div class=y>Yes.</div>{body}</article><div class=z><p>{_prose(120)}</p></div>"
    assert H.main_text(html) == " ".join(["Yes.", *[_prose(90)] * 6, _prose(120)])


def test_names_inside_an_article_are_a_prior():
    body = _prose(1500)
    for page in (
        '<main><div class="elementor-widget-container">%s</div></main>',
        '<article class="post social-science">%s</article>',
        '<article><div class="text-share-block">%s</div></article>',
        '<form id="aspnetForm"><div>%s</div><input></form>',
    ):
        assert H.main_text(page % body) == body, page
    # beside a text, or as comments, or without an article, they are believed
    assert H.main_text(f"<article><p>{body}</p><div class=share>{body}</div></article>") == body
    assert H.main_text(f"<article>Short. <div class=comments>{body}</div></article>") == "Short."
    assert H.main_text(f"<div class=sidebar>{body}</div>") == ""
    assert H.main_text("<form><p>Write to us, please. We answer.</p></form>") == ""


@pytest.mark.parametrize("tag", ["div", "b", "main", "p", "i><p", "form", "button><div"])
def test_time_grows_with_depth(tag):
    def seconds(n):
        page = "".join(f"<{tag}>w{i} " for i in range(n))
        start = time.process_time()
        H.main_text(page)
        return time.process_time() - start

    seconds(1000)
    assert seconds(32_000) < 40 * max(seconds(2_000), 0.02)


def _by_hand(html: str, least: float) -> str:
    """Sections by their ratios, from a tree and plain tuples."""
    blocks = []

    def walk(node, path):
        path = (*path, ".".join([node.tag, *sorted(node.get("class", "").split())]))
        if (node.text or "").strip():
            blocks.append((path, " ".join(node.text.split())))
        for child in node:
            walk(child, path)
            if (child.tail or "").strip():
                blocks.append((path, " ".join(child.tail.split())))

    walk(ElementTree.fromstring(html), ())
    section = [p[: min([i for i, e in enumerate(p) if e.split(".")[0] in H.LEAVES], default=len(p))] for p, _ in blocks]

    def ratio(path):
        texts = [t for p, t in blocks if p == path]
        return sum(map(len, texts)) / len(texts) * (1 + sum(c in ".,;:!?" for t in texts for c in t) / len(texts))

    own = [ratio(p) for p, _ in blocks]
    fused = []
    for i in range(len(blocks)):
        w = [math.exp(-((j - i) ** 2) / 2) if abs(j - i) <= 3 else 0.0 for j in range(len(blocks))]
        fused.append(math.sqrt(own[i] * sum(a * b for a, b in zip(w, own)) / sum(w)))
    size = [len(t) for _, t in blocks]
    mean = sum(f * n for f, n in zip(fused, size)) / sum(size)
    inner = [any(e.split(".")[0] in ("article", "main") for e in s) for s in section]
    most = sum(f * n for f, n, a in zip(fused, size, inner) if a) > 0.5 * sum(f * n for f, n in zip(fused, size))
    kept = []
    for s, (_, text) in zip(section, blocks):
        at = [i for i, other in enumerate(section) if other == s]
        value = sum(fused[i] * size[i] for i in at) / sum(size[i] for i in at)
        if value * (8 if most and inner[at[0]] else 1) >= min(least * mean, 60):
            kept.append(text)
    return " ".join(kept)


def test_ratios_against_plain_tuples():
    rng = random.Random(5)
    differs = 0
    for _ in range(150):
        def tree(depth):
            tag = rng.choice(["div", "div", "section", "article", "p", "ul"])
            name = rng.choice(["", "", " class='x'", " class='y z'"])
            n = rng.choice([3, 20, 150, 600])
            text = "".join(rng.choice(["word ", "longer ", "a, ", "end. "]) for _ in range(n // 5 + 1))
            inner = "".join(tree(depth + 1) for _ in range(rng.randint(0, 3))) if depth < 4 and tag not in ("p", "ul") else ""
            return f"<{tag}{name}>{text if not inner or rng.random() < 0.4 else ''}{inner}</{tag}>"

        page = f"<div>{tree(0)}{tree(0)}{tree(1)}</div>"
        for least in (0.15, 0.6):
            want = _by_hand(page, least)
            assert H.main_text(page, least) == want
            differs += want != _by_hand(page, 0.0)
    assert differs > 10

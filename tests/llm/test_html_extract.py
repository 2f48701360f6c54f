import math
import random
import re
import tracemalloc

import pytest

from loomspark.llm import html_extract
from loomspark.llm.html_extract import blocks_of, extract_pages, main_text, ratios

SITE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li></ul></nav><div class="ad">Buy now, it is cheap.</div>
%s<div class="sidebar"><p>Most read, this week.</p></div><form>Your mail: <input><button>Go</button></form>
<footer>&copy; 2020 Us. All rights, reserved.</footer></body></html>"""
BODY = "<h1>Head</h1><p><b>One &amp; two,\n three.<br><p>Short.</p><p>A longer paragraph, with words. And more of them, really.</p><div class='comments'><p>Great post, thanks. I really liked this one, a lot.</p></div>"
WANT = "Head\nOne & two, three.\nShort.\nA longer paragraph, with words. And more of them, really."


@pytest.mark.parametrize("around", ["<article>%s</article>", "<main>%s</main>", "<div id='story'>%s</div>", "<div class='x'><section>%s</section></div>"])
def test_article_without_the_rest(around):
    assert main_text(SITE % (around % BODY)) == WANT


@pytest.mark.parametrize(
    ("page", "want"),
    [
        (None, ""),
        ("", ""),
        ("plain &lt;text&gt;\n only", "plain <text> only"),
        ("<p>a<p>b", "a\nb"),
        ("<article><p>x<!-- open", "x"),
        ("<article><ul><li>one<li>two</ul><table><tr><td>a<td>b</table></article>", "one\ntwo\na\nb"),
        ("<script>only()</script>", ""),
        ("<form>Your name, please: <input></form>", ""),
        ("<form><div class='content with-sidebar'>" + "<p>A paragraph of words, here.</p>" * 20 + "</div></form>", "\n".join(["A paragraph of words, here."] * 20)),
        ("<article><header><h1>T</h1></header><p>x y</p><aside>no</aside></article>", "T\nx y"),
    ],
)
def test_markup(page, want):
    assert main_text(page) == want


@pytest.mark.parametrize("around", ["<article>%s</article>", "<main>%s</main>", "<div id='story'>%s</div>"])
def test_reference_lists_and_linked_headings_stay(around):
    text = ("A sentence of the article, with words. " * 10).strip()
    sources = [f"Source {i}" for i in range(20)]
    body = "<h2><a href='/h'>Linked head</a></h2>" + f"<p>{text}</p>" * 5 + "<h2>Sources</h2><ul>" + "".join(f"<li><a href='/{s}'>{s}</a></li>" for s in sources) + "</ul>"
    assert main_text(SITE % (around % body)) == "\n".join(["Linked head", *[text] * 5, "Sources", *sources])


def test_linked_heading_where_nothing_encloses():
    text = ("A sentence of the article, with words. " * 10).strip()
    short = "".join(f"<h4>Part {i}</h4>" for i in range(9))
    page = f"<body><h2><a href='/h'>Linked head</a></h2>{short}" + f"<p>{text}</p>" * 5 + "</body>"
    assert main_text(page).startswith("Linked head\nPart 0")


@pytest.mark.parametrize(
    ("body", "want"),
    [
        ("<header class='entry-header'><h1>Head</h1></header>{0}", "Head\n{0}"),
        ("<div class='article-header'><h1>Head</h1></div>{0}<p class='warning'>Mind this, please.</p>", "Head\n{0}\nMind this, please."),
        ("<h1>Head</h1>{0}<div class='ad'>Buy it, now.</div>{0}<p class='advert'>And this, too.</p>", "Head\n{0}\n{0}"),
        ("<h1>Head</h1>{0}<section id='comments'><article class='comment'>{0}</article></section>", "Head\n{0}"),
        ("<div class='widget'><h1>Head</h1>{0}{0}</div>", "Head\n{0}\n{0}"),  # holds the content
    ],
)
@pytest.mark.parametrize("around", ["<article>%s</article>", "<main><article>%s</article></main>", "<div role='main'>%s</div>"])
def test_words_of_classes_are_a_prior(body, want, around):
    text = "\n".join(["A sentence of the article, with words. And another one, of more words."] * 4)
    html = "".join(f"<p>{x}</p>" for x in text.split("\n"))
    assert main_text(SITE % (around % body.format(html))) == want.format(text)


def random_names(page, rng):
    """Without elements that tell what they are, and with classes that tell nothing."""
    for tag in ("article", "nav", "footer", "aside", "header", "main"):
        page = re.sub(rf"<{tag}\b[^>]*>", "<div>", page).replace(f"</{tag}>", "</div>")
    page = re.sub(r" class=(?:'[^']*'|\"[^\"]*\")", "", page)
    return re.sub("<div", lambda _: f"<div class='{''.join(rng.choices('bcdfghjk', k=7))}'", page)


def paragraphs(n, rng):
    return [" ".join(rng.choices(["word", "more,", "text", "longer.", "a", "of"], k=rng.randint(20, 60))) for _ in range(n)]


def test_paths_decide_without_names():
    rng = random.Random(3)
    for _ in range(30):
        text = paragraphs(rng.randint(4, 12), rng)
        article = "<article><h1>A head line</h1>" + "".join(f"<p>{x}</p>" for x in text) + "</article>"
        teasers = "<aside>" + "".join(f"<div><p>Teaser number {i} of it</p></div>" for i in range(6)) + "</aside>"
        page = random_names(SITE % (article + teasers), rng)
        assert main_text(page) == "\n".join(["A head line", *text])


def test_paths_change_the_result(monkeypatch):
    """Where nothing names the article, constant ratios take in what the paths leave out."""
    rng = random.Random(5)
    text = paragraphs(6, rng)
    teasers = "".join(f"<div class='t{i % 2}'><p>Teaser {i} of it</p><p>by a person</p></div>" for i in range(8))
    page = "<body>" + "<div class='q'>" + "".join(f"<p>{x}</p>" for x in text) + "</div>" + teasers + "</body>"
    assert main_text(page) == "\n".join(text)
    monkeypatch.setattr(html_extract, "ratios", lambda blocks, against, width=2: [1.0] * len(blocks))
    assert main_text(page) != "\n".join(text)


def unnamed_page(rng):
    """A page of div elements whose classes tell nothing: (html, the article's text). Around the article stand short lines, teasers
    of a sentence, lists without links and small print, some beside it in one element."""
    name = lambda: "".join(rng.choices("bcdfghjk", k=6))
    sentence = lambda k: " ".join(rng.choices(["word", "more", "text", "longer", "a", "of", "some"], k=k)).capitalize()
    head = sentence(rng.randint(3, 8))
    body = [p.capitalize() + "." for p in paragraphs(rng.randint(3, 14), rng)]
    body.insert(rng.randint(1, len(body)), sentence(4) + ".")  # a short one
    article = f"<div class='{name()}'><h1>{head}</h1>" + "".join(f"<p>{x}</p>" for x in body) + "</div>"
    item, note, row = name(), name(), name()

    def noise():
        kind = rng.randrange(4)
        if kind == 0:
            return f"<div class='{note}'><p>{sentence(rng.randint(2, 6))}</p></div>"
        if kind == 1:
            return f"<div class='{item}'>" + "".join(f"<div class='{row}'><p>{sentence(rng.randint(3, 7))}</p><p>by {sentence(2)}</p></div>" for _ in range(rng.randint(3, 9))) + "</div>"
        if kind == 2:
            return f"<div class='{name()}'><ul>" + "".join(f"<li>{sentence(2)}</li>" for _ in range(rng.randint(3, 8))) + "</ul></div>"
        return f"<div class='{name()}'><span>{sentence(5)}</span><div>{sentence(4)}</div></div>"

    before, after = "".join(noise() for _ in range(rng.randint(1, 3))), "".join(noise() for _ in range(rng.randint(1, 3)))
    middle = article if rng.random() < 0.5 else f"<div class='{name()}'>{noise()}{article}{noise()}</div>"
    return f"<html><body>{before}{middle}{after}</body></html>", "\n".join([head, *body])


def test_ratios_decide_on_pages_without_names(monkeypatch):
    rng = random.Random(17)
    pages = [unnamed_page(rng) for _ in range(200)]
    right = sum(main_text(page) == want for page, want in pages)
    real = html_extract.ratios
    monkeypatch.setattr(html_extract, "ratios", lambda blocks, prior, width=2: [1.0] * len(blocks))
    alike = sum(main_text(page) == want for page, want in pages)
    monkeypatch.setattr(html_extract, "ratios", lambda blocks, prior, width=2: [1 / (1 + x) for x in real(blocks, prior, width)])
    against = sum(main_text(page) == want for page, want in pages)
    print(f"of 200 pages right by ratios {right}, by constant ones {alike}, by inverted ones {against}")
    assert right >= 195 and alike <= 60 and against <= 60


@pytest.mark.parametrize("name", ["related-work", "informed-consent", "share-price-table", "warning-signs", "socialHistory", "cookie-recipe", "ad-hoc-networks"])
def test_sections_of_full_paragraphs_stay_whatever_their_name(name):
    text = "A sentence of the article, with words. And another one, of more words here."
    for kind in ("class", "id"):
        body = "<h1>Head</h1>" + f"<p>{text}</p>" * 4 + f"<section {kind}='{name}'><h2>Sub</h2><p>{text}</p></section>"
        assert main_text(SITE % f"<article>{body}</article>") == "\n".join(["Head", *[text] * 4, "Sub", text])


@pytest.mark.parametrize(
    "aside",
    [
        "<div class='comments'><h3>Comments</h3>" + "<div class='comment'><p>Great post, thanks. I really liked this one, a lot, and more than a lot of it.</p></div>" * 12 + "</div>",
        "<div class='newsletter-box'><p>Subscribe to our letter, for weekly news.</p></div>",
        "<div class='related-posts'><h3>Related</h3><ul><li><a href='/x'>One of them</a></li><li><a href='/y'>Two</a></li></ul></div>",
        "<div class='related-work'><ul><li><a href='/x'>One of them</a></li><li><a href='/y'>Two</a></li></ul></div>",
        "<div id='cookieNotice'>We use them, for all you do. Accept all of them, please.</div>",
    ],
)
def test_named_asides_in_an_article_go(aside):
    text = "A sentence of the article, with words. And another one, of more words here."
    assert main_text(SITE % f"<article><h1>Head</h1>{f'<p>{text}</p>' * 4}{aside}</article>") == "\n".join(["Head", *[text] * 4])


def test_article_in_two_siblings():
    rng = random.Random(7)
    text = paragraphs(10, rng)
    page = "<body><div class='one'>" + "".join(f"<p>{x}</p>" for x in text[:9]) + f"</div><div class='two'><p>{text[9]}</p></div></body>"
    assert main_text(page) == "\n".join(text)


def test_ratios_against_a_plain_reading():
    rng = random.Random(9)
    page = "<body>" + "".join(f"<div class='{rng.choice('xyz')}'><p>{p}</p><a href='/'>link, text</a> rest.</div>" for p in paragraphs(12, rng)) + "</body>"
    blocks = blocks_of(page)
    paths = []
    for b in blocks:
        e, path = b.element, []
        while e:
            path.append(e.path)
            e = e.parent
        paths.append(tuple(path))
    by = {p: [b for b, q in zip(blocks, paths, strict=True) if p == q] for p in set(paths)}
    plain = {p: sum(len(b.text) - b.linked for b in bs) / len(bs) * math.sqrt(0.5 + sum(len(re.findall("[.,;:!?]", b.text)) for b in bs) / len(bs)) for p, bs in by.items()}
    smooth = {}
    for i, p in enumerate(paths):
        near = [(plain[paths[j]], 0.5 ** abs(i - j)) for j in range(max(0, i - 2), min(len(paths), i + 3))]
        smooth.setdefault(p, []).append(sum(v * w for v, w in near) / sum(w for _, w in near))
    want = [math.sqrt(plain[p] * sum(smooth[p]) / len(smooth[p])) for p in paths]
    assert ratios(blocks, {}) == pytest.approx(want)


def test_long_and_broken_pages_end():
    assert main_text("<div>" * 3000 + "deep") == "deep"
    assert len(main_text("<article>" + "<p>word, here.</p>" * 20_000 + "</article>").split("\n")) == 20_000
    main_text('<a "' * 3000)
    assert main_text("<div>x</b></section></li>" * 20_000).count("x") == 20_000


def test_memory_is_linear_in_the_depth():
    tracemalloc.start()
    assert main_text("<div class='abcdef'>" * 50_000 + "<p>deep, text.") == "deep, text."
    assert tracemalloc.get_traced_memory()[1] < 200e6
    tracemalloc.stop()


def test_rows(spark):
    rows = [(1, "u", SITE % f"<article>{BODY}</article>", 5), (1, "u", None, 5), (None, None, "<p>é</p>", 6)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = extract_pages(df)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in got.collect()) == [(0, "é", 1), (1, "", 0), (1, WANT, len(WANT))]
    assert extract_pages(df.limit(0)).count() == 0

"""Main text of generated pages whose article is known."""

import html
import itertools
import random

import pytest

from sourcetrail.llm import html_text

LONG = "long article text that goes on and on"
PAGES = {
    "header of the entry": ('<article><div class="entry-header"><h1>Head</h1></div><div><p>{}</p></div></article>', "Head\n{}"),
    "header element": ("<article><header><h1>Head</h1></header><div><p>{}</p></div></article>", "Head\n{}"),
    "layout class": ('<div class="content with-sidebar"><p>{}</p></div>', "{}"),
    "doubtful wrapper": ('<div class="widget"><p>{}</p><div class="ad"><p>buy</p></div></div>', "{}"),
    "wrapper of an article": ('<div class="hidden-header"><article><p>{}</p></article></div>', "{}"),
    "page in a form": ("<form action=x><div><p>{}</p></div><footer>f</footer></form>", "{}"),
    "form in an article": ("<article><p>{}</p><form><p>Mail me</p></form></article>", "{}"),
    "two sections": ("<article><section><p>{}</p></section><section><p>short</p></section></article>", "{}\nshort"),
    "intro beside": ("<div><p>Intro</p><div><p>{}</p></div></div>", "Intro\n{}"),
    "long comments": ('<div class=story><p>{}</p></div><section id="comments"><p>' + LONG * 9 + "</p></section>", "{}"),
    "side bar in main": ('<main><p>{}</p><div class="sidebar"><p>side</p></div><div class="share">share</div></main>', "{}"),
    "links beside": ('<div><p><a href=/a>other things to read</a></p><div><p>{}</p></div></div>', "{}"),
    "body class": ("</body><body class='no-sidebar comments-open'><p>{}</p>", "{}"),
    "only comments": ('<section id="comments"><p>{}</p></section>', ""),
    "nothing": ("", ""),
}


@pytest.mark.parametrize("name", PAGES)
def test_text_of_an_article_stays(name):
    source, text = (x.format(LONG) for x in PAGES[name])
    page = html_text.parse(f"<html><body><nav><a href=/>Home</a></nav>{source}</body></html>")
    best = html_text.best_container(page)
    assert html_text.extract(page, None) == text
    assert html_text.extract(page, page.paths[best] if best >= 0 else None) == text


WORDS = "house garden king river Straße étage señor & < 雪 quick".split()
JUNK = [
    "<nav><ul><li><a href=/a>one</a><li><a href=/b>two</a></ul></nav>", '<div class="ad">buy now, all of you, buy</div>', "<!-- <p>no</p> -->",
    '<aside><p>aside text of some length</p></aside>', "<script>if (a<b) { '</p>' }</script>", '<div class="cookie-notice"><p>we use cookies</p></div>',
    '<div id="sidebar"><p>more to read</p></div>', "<form><p>mail address</p><input></form>", "<style>p{color:red}</style>",
    '<section class="comments"><p>a reader says a lot about it, and a lot more than that</p></section>',
]


def test_generated_pages():
    rng = random.Random(6)
    for wrap, _ in itertools.product(["article", "main", "div class=story", "div class='post with-sidebar'", "section id=text"], range(40)):
        texts, parts = [], []
        for _ in range(rng.randrange(2, 9)):
            words = [rng.choice(WORDS) for _ in range(rng.randrange(5, 40))]
            texts.append(" ".join(words))
            shown = [rng.choice([html.escape, html.escape, lambda w: "".join(f"&#{ord(c)};" for c in w)])(w) for w in words]
            shown = [f"<{t}>{w}</{t}>" if (t := rng.choice([None, None, None, "b", "i", "span"])) else w for w in shown]
            body = rng.choice([" ", "\n  ", "<br>"]).join(shown)
            opened = rng.choice(["p", "p", "h2", "blockquote", "ul><li"])
            parts.append(f"<{opened}>{body}" + ("" if opened == "p" and rng.random() < 0.5 else "".join(f"</{t}>" for t in reversed(opened.split("><")))))
        for _ in range(rng.randrange(4)):  # between the blocks, after what an open paragraph ends with
            parts.insert(rng.randrange(len(parts) + 1), rng.choice(JUNK))
        around = [rng.choice(JUNK) for _ in range(rng.randrange(5))]
        cut = rng.randrange(len(around) + 1)
        inner = f"<{wrap}>{''.join(parts)}</{wrap.split()[0]}>"
        source = f"<html><head><title>t</title></head><body>{''.join(around[:cut])}{inner}{''.join(around[cut:])}<footer><p>all rights</p></footer></body></html>"
        page = html_text.parse(source)
        assert html_text.extract(page, None) == "\n".join(texts), source

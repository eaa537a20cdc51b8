"""Pages of one host whose articles are known, in shapes that surround or cut them differently."""

import random

import pytest

from pitchlake.llm import wrappers


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(n))


def texts(pages):
    whole = None
    for page in pages:
        one = wrappers.wrapper_of(wrappers.parse(page))
        whole = one if whole is None else wrappers.merge(whole, one)
    paths, dropped = wrappers.article_paths(whole)
    return [wrappers.main_text(wrappers.parse(p), paths, dropped) for p in pages]


def host(shape, n=6, seed=3):
    """(pages, articles): ``shape`` gets a page's random words and number."""
    rng = random.Random(seed)
    made = [shape(lambda k: words(rng, k), i) for i in range(n)]
    head = "<html><body><nav><a href=/>Home</a></nav>"
    return [f"{head}{page}<footer>All rights reserved</footer></body></html>" for page, _ in made], [
        "\n".join(blocks) for _, blocks in made]


def recipe(w, i):
    a = [w(4), w(30), w(40)]
    return (f"<article><h1>{a[0]}</h1><p class=by>By the cooks</p><h2>Ingredients</h2><p>{a[1]}</p>"
            f"<h3>Method</h3><p>{a[2]}</p></article>",
            [a[0], "By the cooks", "Ingredients", a[1], "Method", a[2]])


def shared_quote(w, i):
    a = [w(20), w(20)]
    quote = "To be or not to be" if i % 2 else w(5)
    return (f"<article><p>{a[0]}</p><blockquote>{quote}</blockquote><p>{a[1]}</p></article>",
            [a[0], quote, a[1]])


def in_a_form(w, i):
    a = [w(5), w(60)]
    return (f"<form id=aspnet method=post><input type=hidden value=x><div class=page><h1>{a[0]}</h1>"
            f"<p>{a[1]}</p></div></form>", a)


def article_in_a_form(w, i):
    a = [w(5), w(60)]
    return (f"<form><article><h1>{a[0]}</h1><p>{a[1]}</p><form class=x><p>Send mail</p></form></article>"
            "</form>", a)


def long_comments(w, i):
    a = [w(40)]
    return (f"<div class=story><p>{a[0]}</p></div><div class=comments><p>{w(50)}</p><p>{w(60)}</p>"
            f"<p>{w(70)}</p></div>", a)


def responses(w, i):
    a = [w(40), w(30)]
    return (f"<article><p>{a[0]}</p><p>{a[1]}</p><section class=responses><p>{w(90)}</p><p>{w(20)}</p>"
            "</section></article>", a)


def siblings(w, i):
    a = [w(40), w(45), w(50)]
    return (f"<div id=page><div class=a><p>{a[0]}</p></div><div class=b><p>{a[1]}</p></div>"
            f"<div class=c><p>{a[2]}</p></div><div class=pager><p>{w(3)}</p></div></div>", a)


def teaser(w, i):
    a = [w(5), w(80), w(60)]
    return (f"<div class=story><h1>{a[0]}</h1><p>{a[1]}</p><p>{a[2]}</p></div>"
            f"<section><article><p>{w(6)}</p></article></section>", a)


def signup_inside(w, i):
    a = [w(30), w(30)]
    return (f"<article><p>{a[0]}</p><form><p>Your mail address</p><input></form><p>{a[1]}</p>"
            "<div class=follow>Follow us everywhere</div></article>", a)


def marked_article(w, i):
    a = [w(30), w(40)]
    return f"<article class='post no-comments ad-free'><p>{a[0]}</p><p>{a[1]}</p></article>", a


SHAPES = [recipe, shared_quote, in_a_form, article_in_a_form, long_comments, responses, siblings, teaser,
          signup_inside, marked_article]


@pytest.mark.parametrize("shape", SHAPES)
@pytest.mark.parametrize("seed", range(3))
def test_articles_come_out_whole(shape, seed):
    pages, articles = host(shape, seed=seed)
    assert texts(pages) == articles


@pytest.mark.parametrize("shape", [in_a_form, long_comments, siblings, teaser, marked_article])
def test_single_pages(shape):
    pages, articles = host(shape, n=1)
    assert texts(pages) == articles


def test_hosts_on_spark(spark):
    made = {f.__name__: host(f) for f in SHAPES}
    rows = [(i, f"http://{name}.example/{i}", page) for name, (pages, _) in made.items()
            for i, page in enumerate(pages)]
    found = wrappers.extract(spark.createDataFrame(rows, "page_id int, url string, html string").repartition(4))
    for r in found.collect():
        assert r["__text"] == made[r.url.split("/")[2].split(".")[0]][1][r.page_id]

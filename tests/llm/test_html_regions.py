"""Names of elements, nested articles, and the region scan against all regions."""

import random

import pytest

from lociflow.llm import html_text

COMMENT = "<article class='comment'><p>great post thank you so much for it</p></article>"


@pytest.mark.parametrize(
    ("page", "want"),
    [
        # comments as articles inside the article, below a noise section or by their own class
        (f"<article><p>the real text of the article</p><section class='comments'>{COMMENT.replace(' class', ' id')}{COMMENT}</section></article>", "the real text of the article"),
        (f"<article><p>the real text of the article</p>{COMMENT}</article>", "the real text of the article"),
        # comments as articles beside it, longer than the article
        (f"<article><p>the real text of the article</p></article><div class='comments'>{COMMENT * 9}</div>", "the real text of the article"),
        # compound names, on a page without a main element
        ("<div><p>the real text of the page</p></div><div class='user-comments'><p>i do not agree with this at all</p></div>", "the real text of the page"),
        ("<div><p>the real text of the page</p></div><div id='siteFooter'><p>all rights are reserved by us</p></div>", "the real text of the page"),
        ("<div class='content-sidebar-wrap'><p>the real text of the page</p></div>", "the real text of the page"),
        ("<div class='has-sidebar'><p>the real text of the page</p></div>", "the real text of the page"),
        # everything would be noise by parts: then parts say nothing
        ("<div class='share-post'><p>the real text of the page</p></div>", "the real text of the page"),
        # as many names as a page likes
        (f"<article><div class='{' '.join(f'u-{k}' for k in range(45))}'><p>the real text</p><div class='comments'><p>i disagree with all of it</p></div></div></article>", "the real text"),
        (f"<article>{''.join(f'<div class=c{k}>' for k in range(3000))}<p>the real text</p><div class='comments'><p>i disagree with all of it</p></div></article>", "the real text"),
    ],
)
def test_noise_follows_the_path(page, want):
    assert html_text.main_text(page, {}) == want


def test_labels_overrule_parts(spark):
    page = lambda k: f"<html><body><div class='login-box'><p>{'sign in to read on ' * 5}</p></div><article><h1>Head {k}</h1><div class='notice-body'><p>{'what the notice says here ' * 5}</p></div></article></body></html>"
    weights = html_text.fit_weights(spark.createDataFrame([(k, page(k)) for k in range(60)], "page_id long, html string"))
    plain = page(0).replace("article>", "div>")
    assert "notice says" not in html_text.main_text(plain, {}) and "notice says" in html_text.main_text(plain, weights)
    assert "sign in" not in html_text.main_text(plain, weights)


def test_scan_finds_the_best_of_all_regions():
    rng = random.Random(4)
    for _ in range(300):
        items = []
        for _ in range(rng.randrange(1, 25)):
            if rng.random() < 0.5:
                items.append(rng.choice(["p", "div", "li", "a"]))
            else:
                scope = html_text.Scope(("comments",), None, None) if rng.random() < 0.2 else None
                n = rng.randrange(1, 20)
                items.append(html_text.Block(f"b{len(items)}", rng.choice(["p", "div", "li", "nav"]), n, rng.choice([0, n]), scope, -1, -1))
        weights = {f"tag {t}": -rng.random() * 3 for t in ("p", "div", "li", "a")}
        noise = html_text.Noise(weights, None)
        score = [0.0 if isinstance(x, html_text.Block) and noise(x) else html_text._block_score(x, weights) * x.words if isinstance(x, html_text.Block) else html_text._tag_score(x, weights) for x in items]
        texts = lambda a, b: [x.text for x in items[a:b] if isinstance(x, html_text.Block) and not noise(x)]  # noqa: E731, B023
        regions = {(a, b): sum(score[a:b]) for a in range(len(items)) for b in range(a + 1, len(items) + 1)}
        best = max(regions.values())
        got = html_text.best_region(items, weights, noise)
        if best <= 0:
            assert got == []
        else:
            assert got in [texts(a, b) for (a, b), s in regions.items() if abs(s - best) < 1e-9]

"""Operator 1: what counts as a constant or as furniture."""
from cinespark.llm import wrappers

SCHEMA = "page_id long, url string, html string"


def page(k, inner="", head="<h1>Site name</h1>"):
    return f"<html><body><div class='wrap'>{head}<div class='text'><p>Body {k} of the page with its own words {k * 7}.</p>{inner}</div></div></body></html>"


def texts(spark, rows, parts=1):
    return {r.page_id: r.text for r in wrappers.extract(spark.createDataFrame(rows, SCHEMA).repartition(parts)).collect()}


def test_text_of_one_page_is_no_constant(spark):
    rows = [(k, f"http://a.org/{k}", page(k)) for k in range(12)]
    odd = {3: "<blockquote>Said once only.</blockquote>", 5: "<h2>Only here</h2>", 7: "<table><tr><td>One cell</td></tr></table>"}
    rows = [(k, u, page(k, odd.get(k, ""))) for k, u, _ in rows] + [(20 + k, f"http://a.org/copy{k}", page(3, odd[3])) for k in range(5)]
    got = texts(spark, rows, 3)
    assert "Said once only." in got[3] and got[20] == got[3] and "Only here" in got[5] and "One cell" in got[7]


def test_text_of_all_pages_is_a_constant(spark):
    got = texts(spark, [(k, f"http://a.org/{k}", page(k, "<h3>Read on</h3>")) for k in range(12)], 3)
    assert all("Body" in t and "Read on" not in t and "Site name" not in t for t in got.values())


def test_copies_in_many_tasks_are_one_page(spark):
    rows = [(k, f"http://a.org/{k}", page(k % 2, "<h3>Told in both</h3>")) for k in range(40)]
    assert all("Told in both" in t for t in texts(spark, rows, 8).values())


ARTICLE = "<p>The words of the article, one after the other.</p><p>And some more of them to read.</p>"
LOOSE = ["<main class='has-sidebar'>{}</main>", "<div id='content' class='with-sidebar'>{}</div>", "<article class='post category-social tag-legal'>{}</article>",
         "<article id='how-to-search-the-side-of-a-notice'>{}</article>", "<div id='notice-of-the-great-change'>{}</div>", "<div class='sidebar'>{}</div>",
         "<section role='main' class='comments'>{}</section>", "<div class='category-social'>{}</div>", "<div class='social'><div class='post'>{}</div></div>"]


def test_loose_words_do_not_make_an_article_furniture(spark):
    rows = [(k, f"http://h{k}.org/", f"<html><body class='no-sidebar'>{x.format(ARTICLE)}<div class='site-footer'>Foot</div></body></html>") for k, x in enumerate(LOOSE)]
    want = "The words of the article, one after the other.\nAnd some more of them to read."
    assert texts(spark, rows) == dict.fromkeys(range(len(LOOSE)), want)


def test_furniture_names_still_drop():
    names = ["site-header", "main-nav", "sidebar-left", "cookie-banner", "related-posts", "newsletter-signup", "comments", "footer-links"]
    for name in names:
        page = f"<div class='{name}'><p>away with a good many words that are longer than the rest of it all</p></div><article>{ARTICLE}</article>"
        assert "away" not in wrappers.main_text(page, None), name
        assert "away" not in wrappers.main_text(f"<article>{ARTICLE}<div class='{name}'><p>away</p></div></article>", None), name

"""Pages: hostile markup in linear time, inline adverts, names within articles, and boilerplate without telling names."""

import random
import time

import pytest
from gridpulse.llm import site_tree

RNG = random.Random(5)


def sentence(n=14):
    return " ".join("".join(RNG.choices("abcdefghijklmnop", k=RNG.randint(2, 9))) for _ in range(n)) + "."


@pytest.mark.parametrize(
    "bit", ['<b x="', "<a '", "<!", "<div>", "</p>", "<div></p>", "<", "&", "<!--", "<a<", "<p class='", "<span class=ad>", "<li>", "<x "]
)
@pytest.mark.parametrize("end", ["", ">", '">'])
def test_hostile_markup_takes_linear_time(bit, end):
    start = time.perf_counter()
    site_tree.main_text("<p>before</p>" + (bit * 400_000)[:400_000] + end + " after")
    assert time.perf_counter() - start < 6


def test_an_open_quote_does_not_swallow_the_page():
    page = '<p>one</p><a href="x>two</a><p class="c">three</p><p>four</p>'
    assert site_tree.main_text(page).split()[0] == "one" and "four" in site_tree.main_text(page)
    assert site_tree.main_text("<p>a < b and c > d</p>") == "a < b and c > d"
    assert site_tree.main_text("<p>kept<p title='a>b'>also</p><p class") == "kept also"


def test_names_within_an_article_are_no_verdict():
    page = """<article><h2 id="legal-history">A</h2><p class="notice">B</p><section id="search-engines">C</section>
      <div class="content related">D</div><p id="social-life">E</p></article>"""
    assert site_tree.main_text(page) == "A B C D E"


def test_containers_and_whole_names_still_tell():
    for inside in (
        '<div class="related-posts">x</div>', '<div class="site-footer"><p>x</p></div>', '<ul class="main-nav"><li>x</li></ul>',
        '<div id="sidebar">x</div>', '<section class="comments">x</section>', '<p class="advert">x</p>', '<aside>x</aside>', '<p hidden>x</p>',
    ):
        assert site_tree.main_text(f"<article><p>A</p>{inside}<p>B</p></article>") == "A B", inside
    assert site_tree.main_text('<p class="cookie-notice">x</p><p>A</p>') == "A"


def test_inline_elements_that_are_no_content():
    page = "<p>A <span class='advert'>Buy <b>now</b> <span>x</span></span>B <a class=share href=#>Share</a><span hidden>no</span> C</p>"
    assert site_tree.main_text(page) == "A B C"
    assert site_tree.main_text("<p>A <span class='ad'>x</p><p>B</p>") == "A B"  # left open: ends with its block
    assert site_tree.main_text("<div>A <span class='ad'>x<div>y</div>z</span> B</div>") == "A B"
    assert site_tree.main_text("<p>A <span class='name'>B</span></p>") == "A B"


def test_the_tree_tells_boilerplate_with_neutral_names(spark):
    """Nothing in the names tells: what stands on every page goes, what differs stays, and listed words in an article do no harm."""
    rows, want = [], {}
    for i in range(12):
        own = [sentence() for _ in range(3)]
        body = f"<div class='x2'><p>{own[0]}</p><p class='legal'>{own[1]}</p><h2 id='social-search'>{own[2]}</h2></div>"
        page = f"<html><body><div class='x1'><p>Welcome to the house of pages.</p></div>{body}<div class='x3'><p>Made with care in a small town.</p></div></body></html>"
        rows.append((i, f"https://neutral.example/{i}", page))
        want[i] = own
    rows += [rows[0], (None, None, None), (99, "https://neutral.example/99", "")]
    frame = spark.createDataFrame([(*r, "clash", 1) for r in rows], "page_id long, url string, html string, node string, value int")
    found = site_tree.extract(frame.repartition(3)).collect()
    assert len(found) == len(rows) and sum(r.page_id == 0 for r in found) == 2
    for r in found:
        if r.page_id in want:
            assert r.text.startswith(want[r.page_id][0]) and "Welcome" not in r.text and "small town" not in r.text
            assert want[r.page_id][2] in r.text
        else:
            assert r.text == "" and r.n_chars == 0


def test_one_deeply_nested_page_costs_no_more_rounds(spark):
    pages = [(i, "https://deep.example/", f"<div><p>{sentence()}</p></div>") for i in range(6)]
    pages.append((99, "https://deep.example/", "<div>" * 2_000 + "deep words" + "</div>" * 2_000))
    start = time.perf_counter()
    found = {r.page_id: r.text for r in site_tree.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert found[99] == "deep words" and time.perf_counter() - start < 60

"""Pages nested deeper than any recursion, and stray tags in large numbers."""

import time

from sparkprep.llm import html_text


def text_of(page):
    return html_text.main_text(page, html_text.Roles())


def test_deep_pages_keep_their_text_in_order(spark):
    deep = "".join(f"<div>in{i}" for i in range(3000)) + "".join(f"out{i}</div>" for i in reversed(range(3000)))
    page = f"<html><body><article><p>first</p>{deep}<p>last</p></article></body></html>"
    plain = "<html><body><article><p>one</p><p>two</p></article></body></html>"
    df = spark.createDataFrame([(1, "http://a.com/1", page), (2, "http://a.com/2", plain),
                                (3, "http://a.com/3", "<div>" * 5000), (4, None, "<b>" * 5000 + "x" + "<p>" * 5000 + "y")],
                               "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html_text.extracted(df).collect()}
    words = ["first", *(f"in{i}" for i in range(2999)), "in2999out2999",
             *(f"out{i}" for i in reversed(range(2999))), "last"]
    assert got[1].split("\n\n") == words
    assert got[2] == "one\n\ntwo" and got[3] == "" and got[4] == "x\n\ny"


def test_order_at_the_limit():
    for depth in range(html_text.DEPTH - 4, html_text.DEPTH + 4):
        page = "<div>" * depth + "a<div>b<div>c</div>d<section>e</section>f</div>g" + "</div>" * depth + "h"
        assert text_of(page).split("\n\n") == list("abcdefgh")


def test_time_grows_with_the_page():
    def seconds(n):
        page = "<article>" + "<div><p>x</span></i></td>" * n + "</article>"
        t0 = time.process_time()
        text_of(page)
        return time.process_time() - t0

    seconds(100)
    assert seconds(8000) < 12 * max(seconds(2000), 0.02)

"""What the wrappers of a host decide, and that order, partitioning and generated names do not."""

import random
import time
from collections import defaultdict

from sparkprep.llm import html_text
from tests.conftest import SF_SMALL

WORDS = "river stone letter window garden summer engine paper north silver candle market".split()


def story(i, k, n=40):
    draw = random.Random(f"{i} {k}")
    return " ".join(draw.choice(WORDS) for _ in range(n)) + f" {i} {k}"


def plain_page(i, names=("content", "side", "note")):
    """No article, no main, no listed word; a notice, a link list and a box that repeat on every page."""
    content, side, note = names
    links = "".join(f'<li><a href="/{i}/{k}">{story(i, k, 3)}</a></li>' for k in range(6))
    return (f'<body><div class="{side}"><ul>{links}</ul></div><div class="{note}">We moved house this week.</div>'
            f'<div class="{content}"><h1>Title {i}</h1>' + "".join(f"<p>{story(i, k)}</p>" for k in range(3))
            + f'<div class="{note}">Write to the office for more.</div></div>'
            f'<div class="tail">Printed in the old town.</div></body>')


def wanted(i):
    return [f"Title {i}", *(story(i, k) for k in range(3))]


def generated(i):
    draw = random.Random(i)
    return tuple("".join(draw.choices("abcdefghijkl", k=9)) for _ in range(3))


def frame(spark, pages):
    return spark.createDataFrame([(i, "http://one.example/x", p) for i, p in pages.items()],
                                 "page_id long, url string, html string")


def wrapper_of(pages):
    whole = {}
    for page in pages:
        html_text.joined(whole, html_text.shape(html_text.parse(page)))
    return whole


def test_the_wrapper_decides_on_pages_without_article(spark):
    pages = {i: plain_page(i) for i in range(12)}
    for n in (1, 7):
        got = {r["page_id"]: r["text"] for r in html_text.extracted(frame(spark, pages).repartition(n)).collect()}
        assert {i: t.split("\n\n") for i, t in got.items()} == {i: wanted(i) for i in pages}
    bare = html_text.main_text(pages[3], html_text.Roles())
    assert "We moved house" in bare and story(3, 0, 3) in bare and "Printed" in bare


def test_generated_class_names(spark):
    pages = {i: plain_page(i, generated(i)) for i in range(60)}
    got = {r["page_id"]: r["text"] for r in html_text.extracted(frame(spark, pages)).collect()}
    for i, text in got.items():
        assert [b for b in text.split("\n\n") if b in wanted(i)] == wanted(i)
        for gone in ("We moved house", "Printed in", "Write to the office"):
            assert gone not in text


def test_any_order_gives_one_wrapper():
    pages = [plain_page(i) for i in range(9)] + [plain_page(i, generated(i)) for i in range(9)] + ["", "<p>x"]
    first = wrapper_of(pages)
    for seed in range(5):
        random.Random(seed).shuffle(pages)
        assert wrapper_of(pages) == first
    text = html_text.expression(wrapper_of(plain_page(i) for i in range(4)))
    assert "<p>#</>+" in text and "<h1>#</>" in text and "<div.tail>text</>" in text
    assert "<i.x>" not in text
    some = wrapper_of(["<div><ul><li>a</ul></div>", "<div><ul><li>a<li>b</ul><h2>c</h2></div>"])
    assert html_text.expression(some) == "<root><div><ul><li>#</>+</><h2>text</>?</></>"


def test_spark_sums_the_same_wrapper(spark):
    pages = {i: plain_page(i, generated(i) if i % 3 else ("content", "side", "note")) for i in range(30)}
    rows = html_text.wrappers(html_text.inferred(frame(spark, pages).repartition(5))).collect()
    got = {r["path"]: html_text.Shape(*r[2:]) for r in rows}
    assert got == html_text.trimmed(wrapper_of(pages.values()))


def test_given_pages_against_one_task(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    got = {r["page_id"]: r["text"] for r in html_text.extracted(rows.repartition(6)).collect()}
    hosts, ids = defaultdict(dict), {}
    for r in rows.select("page_id", "html", html_text.host_of(rows["url"]).alias("host")).collect():
        hosts[r["host"] or ""][r["page_id"]] = r["html"]
    for pages in hosts.values():
        seen, blocks = defaultdict(set), set()
        for page in filter(None, pages.values()):
            own, held = html_text.block_hashes(html_text.parse(page))
            blocks.add(own)
            for b in held:
                seen[b].add(own)
        constant = [b for b, on in seen.items()
                    if len(on) >= html_text.LEAST_PAGES and len(on) > html_text.MOST * len(blocks)]
        whole = wrapper_of(p for p in pages.values() if p)
        roles = html_text.decided(html_text.trimmed(whole), constant) if whole else html_text.Roles()
        ids |= {i: html_text.main_text(p, roles) if p else "" for i, p in pages.items()}
    assert got == ids


def test_names_that_never_repeat_cost_linear_time_and_no_wrapper():
    def seconds(n):
        pages = ["<body>" + "".join(f'<div class="{w}">{w}</div>' for k in range(7) for w in generated(f"{i} {k}"))
                 + "</body>" for i in range(n)]
        t0 = time.process_time()
        kept = html_text.trimmed(wrapper_of(pages))
        assert len(kept) <= 20 * 2 * 23
        return time.process_time() - t0

    seconds(50)
    assert seconds(800) < 12 * max(seconds(200), 0.02)

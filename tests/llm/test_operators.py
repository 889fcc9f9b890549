"""The text operators against DuckDB, brute force and the public tokenizer library."""

import hashlib
import random
import re
import signal
import string
import textwrap
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sparkprep.llm import bpe, dedup, html_text, jaccard, licenses, mixing, quality, secret_scan, token_edit
from sparkprep.llm.queries import ORACLES, QUERIES, vocabulary_path
from tests.conftest import SF_SMALL

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i % 977}x{i}" for i in range(30_000))
NEAR = " ".join(f"term{i}" for i in range(200))
TEXTS = [None, "", " \n\t", "one", "One", "a b c", "Café  naïve \U0001f600 中文\nline\r\nend", LONG, LONG + " tail",
         NEAR, NEAR, NEAR + " more", NEAR.replace("term150", "other"), "same  words here", "same words\there",
         'password = "abcdef123" and AKIA' + "B" * 16 + " " + "0a" * 14, "<|endoftext|> it's 12 o'clock"]


def table(spark, texts=TEXTS, first=0):
    rows = [(first + i, t, None if i % 5 == 0 else "en", None if i % 4 == 0 else f"s{i % 3}",
             None if t is None else len(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_duckdb(spark, duck, name):
    got = QUERIES[name](spark, SF_SMALL)
    cols = sorted(got.columns)
    want = duck.execute(f"SELECT {', '.join(cols)} FROM ({ORACLES[name]()})").fetchall()

    def plain(rows):
        return Counter(tuple(f"{v:.9g}" if isinstance(v, float) else str(v) for v in r) for r in rows)

    assert plain(tuple(r) for r in got.select(*cols).collect()) == plain(want)


def brute_sets(texts, n):
    out = {}
    for i, t in texts.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        k = min(n, len(words))
        out[i] = {tuple(words[j:j + k]) for j in range(len(words) - k + 1)} if words else set()
    return out


def brute_components(sets, p):
    label = {i: i for i in sets}
    ids = sorted(sets)
    for x, i in enumerate(ids):
        for j in ids[:x]:
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= p * len(sets[i] | sets[j]):
                a, b = sorted((label[i], label[j]))
                label = {k: a if v == b else v for k, v in label.items()}
    return label


@pytest.mark.parametrize("words,p", [(4, 85), (5, 80), (2, 50)])
def test_join_equals_brute_force(spark, words, p):
    drift = [" ".join(f"term{i}" for i in range(k, 120 + k)) for k in range(0, 40, 4)]
    short = ["x y z", "x y z w", "x y z w v", "p q r s t u v w", "p q r s t u v w x"]
    texts = dict(enumerate(TEXTS + drift + short))
    got = {r[0]: (r[1], r[2]) for r in jaccard.classes(
        table(spark, TEXTS + drift + short), similarity=jaccard.Similarity(words, p, 100)).collect()}
    sets = brute_sets(texts, words)
    label = brute_components(sets, p)
    assert got == {i: (len(sets[i]), label[i]) for i in texts}


def test_rows_with_null_ids_are_compared(spark):
    alone = " ".join(f"lone{i}" for i in range(60))
    rows = [(-3, NEAR), (7, "p q r s t u v w x y z"), (None, NEAR + " more"), (None, alone), (None, alone + " end"),
            (None, None), (None, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], SCHEMA)
    got = Counter(tuple(r) for r in jaccard.classes(docs, similarity=jaccard.Similarity(5, 80, 100)).collect())
    assert got == Counter({(-3, 196, -3): 1, (7, 7, 7): 1, (None, 197, -3): 1, (None, 56, None): 1,
                           (None, 57, None): 1, (None, 0, None): 2})
    kept = corpus_pipeline.near_dedup(spark, docs, SF_SMALL)
    assert kept.schema == docs.schema
    left = Counter((r["doc_id"], (r["text"] or "")[:5]) for r in kept.collect())
    assert left == Counter({(-3, "term0"): 1, (7, "p q r"): 1, (None, "lone0"): 1, (None, ""): 2})


def test_block_counts_settle_for_every_band():
    for s in (jaccard.Similarity(4, 85), jaccard.Similarity(5, 80), jaccard.Similarity(3, 50)):
        for i in range(28):
            k, empties = s.blocks(i)
            high = s.edge(i + 1) - 1
            assert k - empties > s.bound(high, s.partner(high))


def test_bpe_equals_the_tokenizers_library(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(vocabulary_path())
    got = {r["doc_id"]: r for r in bpe.encoded(table(spark), vocabulary_path()).collect()}
    for i, t in enumerate(TEXTS):
        ids = library.encode(t or "", add_special_tokens=False).ids
        assert got[i]["ids"] == ids
        assert got[i]["decoded"] == library.decode(ids, skip_special_tokens=False)


def test_exact_dedup_and_ids(spark):
    got = {r["doc_id"]: r for r in dedup.verdicts(table(spark)).collect()}
    assert [got[i]["keep_id"] for i in (0, 1, 2, 9, 10, 13, 14)] == [0, 0, 2, 9, 9, 13, 13]
    assert got[1]["group_size"] == 2 and not got[1]["kept"] and got[0]["kept"]
    assert got[2]["text_sha256"] == hashlib.sha256(b" ").hexdigest()
    clash = dedup.verdicts(table(spark), digest=lambda c: c.substr(1, 0)).collect()
    assert {r["doc_id"]: r["keep_id"] for r in clash} == {i: r["keep_id"] for i, r in got.items()}


def test_secret_base_counts(spark):
    out = {r["doc_id"]: r for r in secret_scan.digests(secret_scan.scanned(table(spark))).collect()}
    assert (out[15]["n_assign"], out[15]["n_access"], out[15]["n_hex"]) == (1, 1, 1)
    assert (out[0]["n_assign"], out[0]["n_access"], out[0]["n_hex"]) == (0, 0, 0)


def test_allow_list_takes_linear_time():
    def late(*_):
        raise TimeoutError

    scanner, old = secret_scan.Scanner(), signal.signal(signal.SIGALRM, late)
    try:
        for text in ("a" * 1000 + "12345", "Ab" * 500 + "12345", "/ab" * 400 + "12345", "/a-b" * 400 + "12345"):
            signal.setitimer(signal.ITIMER_REAL, 5)
            scanner.spans(text)
    finally:
        signal.setitimer(signal.ITIMER_REAL, 0)
        signal.signal(signal.SIGALRM, old)


def test_allow_list_covers_its_own_characters():
    key, scan = "q7Zr2LkX9vBn4TyWc8Hj5MpDf3Gs6RtKe1UaYoNi", secret_scan.Scanner().entropy
    for before, after in (("example/keys/", ""), ("sample_", ""), ("", "/dummy"), ("aXxXx" * 3, key + "xxxx" + key),
                          ("550e8400-e29b-41d4-a716-446655440000/", "")):
        spans = scan(f"see {before}{key}{after} there")
        at = 4 + len(before)
        assert any(a < at + len(key) and b > at for _, a, b in spans), before
    assert scan("key-qWzXvKpJtBnMrGhYdLcFsQxZwVkPjN1234")
    for text in ("550e8400-e29b-41d4-a716-446655440000", "2024-01-01T12_30_45Z", "0123456789abcdefgh",
                 "path/to/some/placeholder/file-name", "x" * 60):
        assert not scan(text), text


@pytest.mark.parametrize("chars,recall", [
    (string.hexdigits[:16], (0.95, 0.97, 0.99)), (string.ascii_lowercase + string.digits, (0.95, 0.97, 0.99)),
    (string.ascii_uppercase + "234567", (0.93, 0.97, 0.99)), (string.ascii_letters + string.digits, (0.94, 0.97, 0.99)),
    (string.ascii_letters + string.digits + "+/", (0.94, 0.97, 0.99)), (string.ascii_letters, (0.92, 0.97, 0.99)),
    (string.ascii_lowercase, (0.88, 0.95, 0.98)), (string.ascii_uppercase, (0.88, 0.95, 0.98))])
def test_recall_of_random_keys(chars, recall):
    scan, draw = secret_scan.Scanner().entropy, random.Random(7)
    for length, least in zip((16, 20, 32), recall):
        keys = ["".join(draw.choices(chars, k=length)) for _ in range(1000)]
        assert sum(bool(scan(f"see {k} there")) for k in keys) >= 1000 * least, length


def test_words_and_names_are_no_keys():
    scan = secret_scan.Scanner().entropy
    for text in ("internationalization", "getElementsByClassNameOrDefaultValue", "AbstractSingletonProxyFactoryBean",
                 "/usr/local/lib/python3/site-packages/pyspark", "IMG_20240101_123456", "MAX_BUFFER_SIZE_BYTES",
                 "Donaudampfschifffahrtsgesellschaft", "4465758382889437", "keep-alive_x86_64-linux-gnu"):
        assert not scan(text), text


@pytest.mark.parametrize("name,notice", [(n, t) for n, ts in sorted(licenses.TEMPLATES.items()) for t in ts])
def test_license_notices_in_all_forms(name, notice):
    scanner, words = licenses.LicenseScanner(), "It reads data and writes it again for the use of others, in the team. "
    wrapped = {w + pre: "\n".join(textwrap.wrap(notice, int(w), initial_indent=pre, subsequent_indent=pre,
                                                break_long_words=False, break_on_hyphens=False))
               for w in ("40", "70", "72", "80") for pre in ("", "# ", " * ", "// ", " " * 20)}
    for form, block in {"one": notice, "long line": words * 40 + notice + " " + words * 40, **wrapped}.items():
        for text in (block, f"import os\n\n{block}\n\nx = 1\n", f"Copyright A. B.\n{words * 30}\n{block}\n{words * 9}"):
            _, found = scanner.matches(text)
            assert [(m["license"], m["missing"], m["added"]) for m in found] == [(name, 0, 0)], form
            assert words_in(notice) <= words_in(text[found[0]["start"]:found[0]["end"]])
    twice = f"{wrapped['70# ']}\n{words * 3}\n{notice}\n"
    assert [m["license"] for m in scanner.matches(twice)[1]] == [name] * 2
    many = (wrapped["72"] + "\n" + words + "\n") * 60
    assert [m["license"] for m in scanner.matches(many)[1]] == [name] * 60


def words_in(text):
    return set(licenses.words_of(text))


def test_license_wording_is_confirmed():
    scanner, gpl = licenses.LicenseScanner(), licenses.TEMPLATES["GPL-3.0"][1]
    assert not scanner.matches(gpl.replace("version 3", "version 4"))[1]
    assert not scanner.matches("A license of our own.\nPermission is granted to nobody.")[1]
    changed = textwrap.fill(gpl.replace("redistribute", "hand on"), 72)
    assert [(m["license"], m["missing"], m["added"]) for m in scanner.matches(changed)[1]] == [("GPL-3.0", 1, 2)]


def host_texts(pages):
    whole = {}
    for page in pages:
        html_text.joined(whole, html_text.shape(html_text.parse(page)))
    return [html_text.main_text(page, html_text.decided(html_text.trimmed(whole))) for page in pages]


@pytest.mark.parametrize("region", ["article", "main", "div"])
def test_listed_words_alone_drop_no_article_text(region):
    def page(i):
        story = " ".join(f"w{i}x{j}" for j in range(80))
        kept = (f'<h2 id="related-work">Related {i}</h2><section id="discussion"><p>Talk {i}</p><p>More {i}</p></section>'
                f'<h2 id="search">Search {i}</h2><table><tr class="header"><td>Cell {i}</td></tr></table>'
                f'<p class="notice">Notice {i}</p><p>A <span class="search-term">term {i}</span> inside</p>'
                f'<div data-id="ad" data-role="menu">Data {i}</div><aside>Quote {i}</aside>')
        gone = (f'<div class="share"><a href="/s{i}">Tell {i}</a> <a href="/t{i}">Pass {i}</a></div>'
                f'<div class="newsletter">Join {i}<form><input name="m"></form></div>'
                f'<p>See <a class="share" href="/u{i}">Press {i}</a></p><ul class="comments">'
                + "".join(f'<li class="comment">Remark {i} {k}</li>' for k in range(3)) + "</ul>")
        return f"<body><div class=ad>Buy {i}</div><{region}><h1>T{i}</h1><p>{story}</p>{kept}{gone}</{region}></body>"

    for i, text in enumerate(host_texts([page(i) for i in range(6)])):
        for word in ("Related", "Talk", "More", "Search", "Cell", "Notice", "term", "Data", "Quote"):
            assert f"{word} {i}" in text, word
        assert f"A term {i} inside" in text
        for word in ("Buy", "Tell", "Pass", "Join", "Press", "Remark"):
            assert f"{word} {i}" not in text, word


@pytest.mark.parametrize("region", ["article", "main", "div"])
def test_constant_text_and_link_lists_inside_the_region(spark, region):
    def page(i, host):
        story = " ".join(f"w{i}x{j}" for j in range(80))
        return (f"http://{host}.example/{i}",
                f"<body><{region}><h1>T{i}</h1><p>{story}</p><p>Hand in your mail for our letters.</p>"
                f"<h2>References</h2><p>Source {i}</p><table><tr><th>Year</th></tr><tr><td>Cell {i}</td></tr></table>"
                f"<ul><li>Point {i}</li><li>Second {i}</li></ul><h2>Our letters</h2><p>Write to us.</p>"
                f"<div><ul><li><a href='/a'>Read {i}</a></li><li><a href='/b'>Next {i}</a></li></ul></div></{region}>")

    rows = [(i, *page(i, "one")) for i in range(6)] + [(10 + k, *page(99, "two")) for k in range(4)]
    docs = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = {r["page_id"]: r["text"] for r in html_text.extracted(docs).collect()}
    for i in range(6):
        blocks = got[i].split("\n\n")
        assert blocks[0] == f"T{i}" and blocks[1].startswith(f"w{i}x0 ")
        assert blocks[2:] == ["References", f"Source {i}", "Year", f"Cell {i}", f"Point {i}", f"Second {i}"]
    for k in range(4):  # copies of one page are no evidence
        assert "Source 99" in got[10 + k] and "Write to us." in got[10 + k]


def test_empty_tables(spark):
    none = table(spark, TEXTS[:1]).where("doc_id < 0")
    path = vocabulary_path()
    for out in (quality.verdicts(none), dedup.verdicts(none), mixing.planned(none), jaccard.classes(none),
                secret_scan.scanned(none), licenses.scanned(none), bpe.digests(none, path),
                token_edit.counted(token_edit.cleaning_edits(none), path)):
        assert out.count() == 0
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert html_text.extracted(pages).count() == 0


def test_null_and_odd_rows(spark):
    docs, path = table(spark), vocabulary_path()
    for out in (licenses.scanned(docs), token_edit.counted(token_edit.cleaning_edits(docs), path),
                quality.verdicts(docs), mixing.planned(docs)):
        assert out.count() == len(TEXTS)
    pages = spark.createDataFrame([(1, None, None), (2, "http://a.example/x", ""), (3, "x", "<p>Hi &amp; bye")],
                                  "page_id long, url string, html string")
    got = {r["page_id"]: r for r in html_text.extracted(pages).collect()}
    assert set(got) == {1, 2, 3} and got[1]["n_chars"] == got[2]["n_chars"] == 0


def test_pipeline_stages_against_brute_force(spark):
    filler = [" ".join(f"d{k}w{i}" for i in range(30 + k)) for k in range(6)]
    docs = table(spark, TEXTS + filler).withColumn("id", F.lit("a name that clashes"))
    columns, kept = docs.columns, []
    for name, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, SF_SMALL).cache()
        assert docs.columns == columns
        kept.append({r["doc_id"]: r["text"] for r in docs.collect()})
    clean, exact, near = kept
    assert all(len((t or "").split()) >= 10 for t in clean.values())
    assert set(range(len(TEXTS), len(TEXTS) + len(filler))) <= set(near)
    first = {}
    for i in sorted(clean):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", clean[i]), i)
    assert set(exact) == set(first.values())
    label = brute_components(brute_sets(exact, 5), 80)
    assert set(near) == set(label.values())
    mix = corpus_pipeline.source_mix(spark, docs, SF_SMALL).cache()
    assert mix.columns == columns
    times = Counter(r["doc_id"] for r in mix.collect())
    assert set(times) <= set(near) and max(times.values()) <= 2
    tokens = corpus_pipeline.bpe_tokens(spark, mix, SF_SMALL).collect()
    assert Counter(r["doc_id"] for r in tokens) == times
    for r in tokens:
        assert r["decoded_sha256"] == hashlib.sha256(near[r["doc_id"]].encode()).hexdigest()



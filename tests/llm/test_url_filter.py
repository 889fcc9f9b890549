"""The dated list against a plain loop over entries and captures."""

import datetime as dt
import random

from pyspark.sql import functions as F

from sparkprep.llm import url_filter

D = dt.date


def plain(captures, entries):
    """(url, date) -> blocked, domain, category, start."""
    days = {}
    for domain, date, action, category in entries:
        if domain is not None and date is not None:
            key = (domain.lower(), category or "", date)
            days[key] = days.get(key, False) or action == "add"
    spans = []
    for (domain, category, date), added in days.items():
        later = [d for (a, c, d) in days if (a, c) == (domain, category) and d > date]
        if added:
            spans.append((domain, category, date, min(later, default=None)))
    out = []
    for url, date in captures:
        host = url.split("://", 1)[1].split("/")[0].lower() if url and "://" in url else None
        hits = [s for s in spans if host and date and (host == s[0] or host.endswith("." + s[0]))
                and s[2] <= date and (s[3] is None or date < s[3])]
        best = min(hits, key=lambda s: (-len(s[0]), date - s[2], s[1])) if hits else (None,) * 4
        out.append((url, date, bool(hits), best[0], best[1], best[2]))
    return sorted(out, key=str)


def got(captures, entries):
    rows = url_filter.filtered(captures, entries).select("url", "fetched_on", "blocked", "list_domain", "category",
                                                         "listed_on").collect()
    return sorted((tuple(r) for r in rows), key=str)


LIST = "domain string, date date, action string, category string"
CAPTURES = "url string, fetched_on date"


def test_far_dates_and_open_intervals(spark):
    entries = [("a.com", D(2024, 1, 1), "add", "x"), ("a.com", D(2103, 5, 5), "remove", "x"),
               ("b.com", D(2101, 1, 1), "add", "x"), ("c.com", D(1950, 1, 1), "add", None)]
    captures = [("http://a.com/", D(2105, 1, 1)), ("http://a.com/", D(2103, 5, 4)), ("http://b.com/", D(2102, 1, 1)),
                ("http://b.com/", D(2100, 12, 31)), ("http://w.c.com/", D(9999, 12, 31)), ("http://c.com", D(1960, 1, 1))]
    want = plain(captures, entries)
    assert [r[2] for r in want].count(True) == 4
    assert got(spark.createDataFrame(captures, CAPTURES), spark.createDataFrame(entries, LIST)) == want


def test_random_lists_as_a_plain_loop(spark):
    rng = random.Random(4)
    names = ["a.com", "x.a.com", "b.org", "y.x.a.com", "com", "c.net"]
    day = lambda: D(2024, 1, 1) + dt.timedelta(days=rng.randrange(400))
    entries = [(rng.choice([*names, "A.com", None]), rng.choice([day(), day(), None]),
                rng.choice(["add", "add", "remove", None]), rng.choice(["spam", "mal", None])) for _ in range(120)]
    captures = [(rng.choice([f"https://{rng.choice(names)}/p", f"http://q.{rng.choice(names)}", None, "not a url"]),
                 rng.choice([day(), day(), day(), None])) for _ in range(300)]
    assert got(spark.createDataFrame(captures, CAPTURES), spark.createDataFrame(entries, LIST)) == plain(captures, entries)


def test_an_interval_has_rows_for_captured_blocks_only(spark):
    captures = spark.createDataFrame([("http://a.com/1", D(2024, 3, 1)), ("http://a.com/2", D(2090, 3, 1))], CAPTURES)
    entries = spark.createDataFrame([("a.com", D(1990, 1, 1), "add", "x"), ("z.com", D(1990, 1, 1), "add", "x")], LIST)
    assert [r["blocked"] for r in url_filter.filtered(captures, entries).collect()] == [True, True]
    assert url_filter.intervals(entries).count() == 2  # open intervals are one row


def test_empty_tables_odd_urls_and_clashing_names(spark):
    captures = spark.createDataFrame(
        [("http://[2001:DB8::1]:80/x", D(2024, 1, 2), "mine", True, 5), ("http://u:p@a.com.:8080?q", D(2024, 1, 2), "m", None, 6),
         (None, None, None, None, None)], "url string, fetched_on date, HOST string, blocked boolean, `odd name` int")
    entries = spark.createDataFrame([("[2001:db8::1]", D(2024, 1, 1), "add", "x"), ("a.com", D(2024, 1, 2), "add", "x")], LIST)
    out = url_filter.filtered(captures, entries)
    assert out.columns == ["url", "fetched_on", "odd name", "host", "blocked", "list_domain", "category", "listed_on"]
    rows = {r["odd name"]: r for r in out.collect()}
    assert rows[5]["host"] == "[2001:db8::1]" and rows[5]["blocked"] and rows[6]["host"] == "a.com" and rows[6]["blocked"]
    assert rows[None]["host"] is None and not rows[None]["blocked"]
    assert url_filter.filtered(captures.limit(0), entries).collect() == []
    assert out.where(F.lit(False)).count() == 0
    assert not any(r["blocked"] for r in url_filter.filtered(captures, entries.limit(0)).collect())

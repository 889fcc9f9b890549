"""Compression selects and ranks templates; word comparison of all of them agrees."""

import random
import time

import pytest

from sparkprep.llm import licenses
from tests.conftest import SF_SMALL

FILLER = "it reads data and writes it again for the use of others while the river turns near old houses".split()
SCANNER, EVERY = licenses.LicenseScanner(), licenses.LicenseScanner(margin=-9.0)


def rows(matches):
    return [(m["start"], m["end"], m["license"], m["missing"], m["added"]) for m in matches]


@pytest.mark.parametrize("name", sorted(licenses.TEMPLATES))
def test_reworded_notices_against_every_template(name):
    draw = random.Random(name)
    for notice in licenses.TEMPLATES[name]:
        for _ in range(4):
            words = notice.split()
            for _ in range(draw.randint(0, licenses.LicenseScanner.allowed(licenses.words_of(notice)))):
                words[draw.randrange(len(words))] = draw.choice(FILLER)
            around = [" ".join(draw.choices(FILLER, k=draw.choice((0, 5, 80, 900)))) for _ in range(2)]
            text = f"{around[0]}\nCopyright A. B.\n{' '.join(words)}\n{around[1]}"
            assert rows(SCANNER.matches(text)[1]) == rows(EVERY.matches(text)[1])
        assert [m["license"] for m in SCANNER.matches(notice)[1]] == [name]


def test_given_documents_against_every_template(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    got = {r["doc_id"]: rows(m.asDict() for m in r["matches"]) for r in licenses.scanned(docs).collect()}
    assert got == {r["doc_id"]: rows(EVERY.matches(r["text"] or "")[1]) for r in docs.collect()}
    assert any(got.values())


@pytest.mark.parametrize("name,other", [("LGPL-3.0", "GPL-3.0"), ("AGPL-3.0", "GPL-3.0"), ("BSD-2-Clause", "BSD-3-Clause")])
def test_compression_decides_between_wordings_that_hold_each_other(name, other, monkeypatch):
    notice = licenses.NOTICES[name][-1]
    assert [m["license"] for m in SCANNER.matches(notice)[1]] == [name]
    unranked = licenses.LicenseScanner()
    monkeypatch.setattr(unranked, "saved", lambda data, index, plain=None: 100 + (unranked.templates[index][0] == other))
    assert [m["license"] for m in unranked.matches(notice)[1]] != [name]


def test_the_margin_prunes():
    notice = licenses.words_of(licenses.NOTICES["LGPL-3.0"][0])
    (reach,) = (r for r, those in SCANNER.by_reach.items() if any(SCANNER.templates[i][1] == notice for i in those))
    names = [SCANNER.templates[i][0] for *_, i in sorted(SCANNER.winners(notice, reach), reverse=True)]
    assert names[0] == "LGPL-3.0" and "MPL-2.0" not in names and "Zlib" not in names
    assert len(names) < len(SCANNER.by_reach[reach])


def test_enough_licenses_and_time_in_proportion():
    assert len(licenses.TEMPLATES) >= 15

    def seconds(n):
        t0 = time.process_time()
        SCANNER.matches(("license " + " ".join(FILLER) + " Released under the MIT License. ") * n)
        return time.process_time() - t0

    seconds(5)
    assert seconds(400) < 12 * max(seconds(100), 0.02)


def test_clashing_columns_and_repeated_rows(spark):
    docs = spark.createDataFrame([(1, "Released under the MIT License.", "x", 2), (1, "Released under the MIT License.", "x", 2),
                                  (None, None, None, None)], "id long, text string, matches string, n_blocks int")
    got = sorted((str(r["id"]), r["n_blocks"], len(r["matches"])) for r in licenses.scanned(docs, "id").collect())
    assert got == [("1", 1, 1), ("1", 1, 1), ("None", 0, 0)]

"""Cross-document line frequency: an absolute limit per host, by broadcast and by join."""

import pytest

from sparkprep.llm import quality

SCHEMA = "doc_id long, text string, source string, n_chars long, host string, line string"
FOOTER = "Subscribe to our letter and follow us on all of the usual channels today"


LETTERS = str.maketrans("0123456789", "abcdefghij")


def own(i, n=3):
    """Lines of this document only (in letters: digits do not tell lines apart)."""
    return "\n".join(" ".join(f"w{i}x{k}y{j}" for j in range(12)) for k in range(n)).translate(LETTERS)


@pytest.mark.parametrize("size", [800, 1000])
@pytest.mark.parametrize("broadcast", [20_000, 0])
def test_the_limit_does_not_grow_with_the_host(spark, size, broadcast):
    rows = [(i, own(i) + "\n" + f"{FOOTER.upper() if i % 2 else FOOTER} {i:04d}" if i < 45 else own(i), "s", 1, "h", "l")
            for i in range(size)]
    # letters' case and digits do not tell lines apart
    rows += [(5000 + i, f"{FOOTER} {5000 + i}", "s", 1, "h", "l") for i in range(30)]
    limits = quality.Limits(broadcast_lines=broadcast)
    got = {r["doc_id"]: r for r in quality.verdicts(spark.createDataFrame(rows, SCHEMA), limits=limits).collect()}
    assert len(got) == len(rows)
    for i in range(45):
        assert got[i]["clean_text"] == own(i) and got[i]["kept"] and got[i]["words_left"] == 36
    assert all(got[i]["clean_text"] == own(i) and got[i]["kept"] for i in range(45, size))
    assert all(not got[5000 + i]["kept"] and got[5000 + i]["words_left"] == 0 for i in range(30))


def test_default_limit_and_hosts_apart(spark):
    rows = [(i, own(i) + "\n" + FOOTER, "a" if i < 41 else "b", 1, "h", "l") for i in range(81)]
    rows += [(200 + i, own(0) + "\n" + FOOTER, "b", 1, None, None) for i in range(60)]  # one text many times
    rows += [(300, None, None, None, None, None), (301, "", None, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    for limits in (quality.Limits(), quality.Limits(broadcast_lines=0)):
        got = {r["doc_id"]: r for r in quality.verdicts(df, limits=limits).collect()}
        assert all(FOOTER not in got[i]["clean_text"] for i in range(41))  # 41 documents of a
        # 40 documents of b and 60 copies of one more are 41 texts
        assert all(FOOTER not in got[i]["clean_text"] for i in [*range(41, 81), *range(200, 260)])
        assert not got[300]["kept"] and got[301]["clean_text"] == ""
    fewer = df.where("doc_id <> 50")
    got = {r["doc_id"]: r for r in quality.verdicts(fewer).collect()}
    assert all(FOOTER in got[i]["clean_text"] for i in range(41, 81) if i != 50)


@pytest.mark.parametrize("broadcast", [20_000, 0])
def test_lines_on_a_large_share_of_a_host_go_below_the_absolute_limit(spark, broadcast):
    rows = [(i, own(i) + "\n" + FOOTER, "small", 1, "h", "l") for i in range(6)]
    rows += [(100 + i, own(i) + "\n" + FOOTER, "five", 1, "h", "l") for i in range(5)]  # not more than 5
    rows += [(200 + i, own(i) + ("\n" + FOOTER if i < 7 else ""), None, 1, "h", "l") for i in range(140)]  # 5% exactly
    rows += [(400 + i, own(i) + ("\n" + FOOTER if i < 8 else ""), "=", 1, "h", "l") for i in range(140)]  # beyond
    rows += [(600 + i, own(0), "=", 1, "h", "l") for i in range(40)]  # copies of one text count once
    rows += [(700 + i, FOOTER, "small", 1, "h", "l") for i in range(2)]
    rows += [(800, None, "small", 1, "h", "l"), (801, None, None, None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    limits = quality.Limits(max_share=quality.CORPUS.max_share, broadcast_lines=broadcast)
    got = {r["doc_id"]: r for r in quality.verdicts(docs, limits=limits).collect()}
    assert len(got) == len(rows)
    gone = {i for i, r in got.items() if r["clean_text"] != (rows[[x[0] for x in rows].index(i)][1] or "")}
    assert gone == {*range(6), *range(400, 408), 700, 701}
    assert not got[700]["kept"] and got[700]["words_left"] == 0 and got[0]["words_left"] == 36


def test_query_and_pipeline_remove_lines_by_share(spark, tmp_path):
    import corpus_pipeline
    from sparkprep.llm.queries import op4_quality_rules

    rows = [(i, FOOTER + "\n" + "abcdefghij"[i], "s", 1, "h", "l") for i in range(10)]
    docs = spark.createDataFrame(rows, SCHEMA)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = op4_quality_rules(spark, str(tmp_path)).collect()
    assert len(got) == 10 and all(r["words_left"] == 1 and not r["base_failed"] and not r["kept"] for r in got)
    assert corpus_pipeline.quality_rules(spark, docs, str(tmp_path)).count() == 0

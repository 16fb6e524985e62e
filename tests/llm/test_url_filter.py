"""URL rules against a plain reading, segmentation, and verdicts of the classifier."""

import itertools
import math

import pytest
from pyspark.sql import types as T

from revlens.llm import queries, url_filter
from revlens.llm.common import read
from revlens.llm.url_filter import RULES, Rule, UrlSpec, viterbi
from tests.llm.helpers import FOLD, rows

SCHEMA = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
                       T.StructField("html", T.StringType()), T.StructField("host", T.StringType()),
                       T.StructField("word", T.StringType()), T.StructField("pages", T.LongType())])


def plain(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = "".join(itertools.takewhile(lambda c: c not in "/?#", rest))
    path = "".join(itertools.takewhile(lambda c: c not in "?#", rest[len(host):]))
    host = host.translate(FOLD)
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return host, path, max((r.name for r in fits), key=len, default=None)


URLS = [None, "", "no scheme.com/x", "http://", "http://com/", "http://a.com", "http://A.COM/x?y#z", "x://www.example.com/en/1",
        "https://example.com/en/", "https://example.com/en", "https://m.example.com/en/2", "https://badexample.com/en/1",
        "ftp://x.net/es/1", "http://x.net/fr/?q", "http://x.net/de/", "http://net/fr/a://b/c", "http://é.ORG/Ünï/9 \n x",
        "http://x.org:8080/a/b", "http://example.com?en/", "://host.org/p", "a://b://c/d", "http://" + "a" * 2000 + ".org/" + "b/" * 500]


def pages(spark, urls, html="the cheap pills are at the farm of the casino"):
    return spark.createDataFrame([(i, u, html, "clash", "clash", 1) for i, u in enumerate(urls)], SCHEMA)


def test_parts_and_rules(spark):
    got = {r["page_id"]: r for r in rows(url_filter.judge(pages(spark, URLS)))}
    assert {i: (g["host"], g["path"], g["rule"]) for i, g in got.items()} == dict(enumerate(map(plain, URLS)))
    by_name = {r.name: r.verdict for r in RULES}
    assert all(g["verdict"] == by_name[g["rule"]] for g in got.values() if g["rule"])
    assert got[0]["verdict"] == got[1]["verdict"] == "allow"


def test_query_on_testdata(spark):
    sf = "/root/testdata/sf0.01"
    got = {r["page_id"]: r for r in rows(queries.op5_url_filter(spark, sf))}
    urls = {r["page_id"]: r["url"] for r in read(spark, sf, "pages").select("page_id", "url").collect()}
    assert {i: (g["host"], g["path"], g["rule"]) for i, g in got.items()} == {i: plain(u) for i, u in urls.items()}
    shady = ("casino", "bets", "pills", "spam", "adult")
    for g in got.values():
        if g["rule"] is None:
            assert (g["verdict"] == "block") == any(w in g["host"] for w in shady), g


def test_concatenated_names_are_split_and_judged(spark):
    text = " ".join(["the best casino bonus and cheap pills for garden tools", "garden tools of the city library"] * 30)
    urls = [f"http://www.{n}.org/p/{i}" for i, n in enumerate(
        ["bestcasinobonus", "cheappills", "gardentools", "citylibrary", "thegarden", "citytools"] * 5)]
    got = rows(url_filter.judge(pages(spark, urls, text), UrlSpec(rules=())))
    assert {g["host"]: g["verdict"] for g in got} == {
        "www.bestcasinobonus.org": "block", "www.cheappills.org": "block", "www.gardentools.org": "allow",
        "www.citylibrary.org": "allow", "www.thegarden.org": "allow", "www.citytools.org": "allow"}
    assert all(g["rule"] is None for g in got)


def brute_split(run, counts, total, spec):
    def cost(words):
        return sum(math.log10(total) - (math.log10(counts[w]) if w in counts
                                        else math.log10(spec.unknown) - len(w)) for w in words)
    cuts = [[run[i:j] for i, j in zip((0, *c), (*c, len(run)))]
            for n in range(len(run)) for c in itertools.combinations(range(1, len(run)), n)]
    return min(map(cost, cuts))


@pytest.mark.parametrize("run", ["cheappills", "thecat", "xqzthe", "aaaa", "t"])
def test_viterbi_is_optimal(run):
    counts, spec = {"cheap": 5, "pills": 3, "the": 90, "cat": 4, "he": 7, "a": 20, "aa": 3}, UrlSpec()
    words = viterbi(run, counts, 200, spec)
    assert "".join(words) == run
    cost = sum(math.log10(200) - (math.log10(counts[w]) if w in counts else -len(w)) for w in words)
    assert abs(cost - brute_split(run, counts, 200, spec)) < 1e-9
    if run == "cheappills":
        assert words == ["cheap", "pills"]


def test_word_counts(spark):
    html = "<style>p{hidden}</style><p class='no'>Two two</p><!-- x --><b>été</b> two<br>words"
    got = {r["word"]: r["n"] for r in url_filter.word_counts(pages(spark, ["a", "b"], html)).collect()}
    assert got == {"two": 6, "words": 2}


def test_empty_table_and_custom_rules(spark):
    assert url_filter.judge(pages(spark, [])).collect() == []
    got = rows(url_filter.judge(pages(spark, ["http://a.b.org/x/1"] * 2), UrlSpec(rules=(Rule("block", "b.org", "/x"),))))
    assert [(g["rule"], g["verdict"]) for g in got] == [("b.org/x", "block")] * 2


def test_names_with_seeds_that_no_text_holds(spark):
    text = "free online games to rent or lo an nu de are ing city garden tools library " * 40
    shady = [*url_filter.SEEDS, "onlinepoker", "freemalware", "onlinegambling", "gardenviagra", "freetorrent"]
    fine = ["onlinegames", "citylibrary", "gardentools", "freetools", "cityrent"]
    urls = [f"http://www.{n}.org/p" for n in [*shady, *fine * 10]]
    got = {g["host"]: g["verdict"] for g in rows(url_filter.judge(pages(spark, urls, text), UrlSpec(rules=())))}
    assert got == {f"www.{n}.org": "block" if n in shady else "allow" for n in [*shady, *fine]}

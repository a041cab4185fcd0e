import re

from questlog.llm import url_filters
from questlog.llm.queries import BLOCKED_WORDS, SITE_RULES
from questlog.llm.url_filters import LOWER, UPPER, site_rule, url_verdicts, word_rule

RULES = [site_rule(*r) for r in SITE_RULES] + [word_rule("block", w) for w in BLOCKED_WORDS]
URLS = [
    None, "", "no scheme", "://", "http://A.Example.ORG/es/x?y", "http://example.org/es", "https://xexample.org/es/", "http://example.org/en/12#t",
    "http://example.com/de/", "http://EXAMPLE.com/DE/", "http://com/fr/1", "http://org", "http://org/", "http://org:80/", "x://y://org/",
    "http://a.net/casino", "http://a.net/casinos?ADS=1", "http://a.net/?u=http://org/", "http://h.net#/org/", "http://a b.org/\nx", "http://ünï.org/é",
]


def plain(url):
    url = url or ""
    host = path = ""
    if "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest, maxsplit=1)[0]
        path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
        host = host.translate(str.maketrans(UPPER, LOWER))
    fits = [(len(h + p), h + p, v) for v, h, p in SITE_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        return host, path, max(fits)[1], max(fits)[2]
    words = re.split("[^a-z0-9]+", url.translate(str.maketrans(UPPER, LOWER)))
    return host, path, None, "block" if set(words) & set(BLOCKED_WORDS) else "allow"


def test_every_kind_of_url(spark):
    rows = [(i if i else None, u) for i, u in enumerate(URLS)] + [(3, "http://org/"), (3, "http://org/")]
    pages = spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "'x' AS host", "1 AS token", "2 AS row", "3 AS id")
    got = url_verdicts(pages, RULES, "allow").collect()
    seen = [(r["page_id"], r["host"], r["path"], r["matched"] if r["field"] == "site" else None, r["verdict"]) for r in got]
    assert sorted(map(str, seen)) == sorted(str((i, *plain(u))) for i, u in rows)


def test_rules_without_tokens_and_longest_word(spark):
    rules = [site_rule("block", "-", "/"), word_rule("allow", "ab"), word_rule("block", "abc")]
    pages = spark.createDataFrame([(1, "x://-/"), (2, "x://a/ab/abc"), (3, "x://a/abcd")], "page_id long, url string")
    assert {r[0]: r["verdict"] for r in url_verdicts(pages, rules, "none").collect()} == {1: "block", 2: "block", 3: "none"}


def test_many_rules_are_joined_by_shuffle(spark, monkeypatch):
    pages = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string")
    by_broadcast = sorted(url_verdicts(pages, RULES, "allow").collect(), key=str)
    monkeypatch.setattr(url_filters, "BROADCAST_RULES", 0)
    assert sorted(url_verdicts(pages, RULES, "allow").collect(), key=str) == by_broadcast


def test_no_rows(spark):
    assert url_verdicts(spark.createDataFrame([], "page_id long, url string"), RULES, "allow").collect() == []

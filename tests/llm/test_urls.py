import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import urls

RULES = {"org/": "allow", "example.org/es/": "block", "example.org/en/1": "block", "com/fr/": "allow", "com/de/": "block"}


def brute(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url[url.index("://") + 3:]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[:min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fits = [r for r in RULES if (host == r.partition("/")[0] or host.endswith("." + r.partition("/")[0])) and path.startswith("/" + r.partition("/")[2])]
    return host, path, max(fits, key=len, default=None)


URLS = [None, "", "no scheme", "http://A.Example.ORG/es/x?y#z", "http://example.org/en/12", "https://m.example.org/en/2", "https://org/", "https://org", "https://x.org?q=/es/", "http://notexample.org/es/",
        "http://a.com/fr/1", "http://a.com/de/1#x", "http://com/de/", "http://a.com/frx", "x://b.com/de/://c.org/", "http://É.ORG/", "http://a.net\n/x", "http://user@a.net:80/p", "http://", "://", "http://a.com/de/1"]


def test_rules_against_brute_force(spark):
    pages = spark.createDataFrame([(i, u, "old") for i, u in enumerate(URLS)], "page_id long, url string, verdict string")
    outcomes = spark.createDataFrame([], "url string, good int")
    got = {r["page_id"]: r for r in urls.judge(pages, outcomes).collect()}
    assert len(got) == len(URLS)
    for i, u in enumerate(URLS):
        host, path, rule = brute(u)
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, rule), u
        assert got[i]["verdict"] == RULES.get(rule, got[i]["verdict"]) and got[i]["verdict"] in ("allow", "block")


def test_hosts_with_bad_pages_are_blocked_and_small_samples_shrunk(spark):
    outcomes = [(f"http://good{k}.a.net/{i}", 1) for k in range(20) for i in range(20)] + [(f"http://bad.a.net/{i}", 0) for i in range(200)]
    outcomes += [("http://one.a.net/1", 0), ("http://null.a.net/1", None), (None, 0)] + [(f"http://x.worse.net/{i}", 0) for i in range(40)]
    pages = spark.createDataFrame([(1, "http://good1.a.net/"), (2, "http://bad.a.net/"), (3, "http://one.a.net/"), (4, "http://new.a.net/"), (5, "http://y.worse.net/"), (6, "http://q.other.info/")], "page_id long, url string")
    got = {r["page_id"]: r for r in urls.judge(pages, spark.createDataFrame(outcomes, "url string, good int")).collect()}
    assert got[1]["verdict"] == "allow" and got[2]["verdict"] == "block"
    assert 0 < got[3]["reputation"] and got[2]["reputation"] < got[3]["reputation"] < got[1]["reputation"]
    assert got[5]["reputation"] < got[4]["reputation"]
    assert all(0 <= r["bound"] <= r["reputation"] <= 1 for r in got.values())


def test_repeated_and_missing_pages(spark):
    pages = spark.createDataFrame([(1, "http://a.net/")] * 3, "page_id long, url string")
    assert urls.judge(pages, spark.createDataFrame([("http://a.net/x", 1)], "url string, good int")).count() == 3
    assert urls.judge(pages.limit(0), spark.createDataFrame([], "url string, good int")).count() == 0


@pytest.mark.parametrize("url, doc_id", [("http://a/en/12", 12), ("http://a/en/12.html?x=3", 12), ("http://a/en/7/", 7), ("http://a/en/x", None), (None, None)])
def test_outcomes_come_from_the_shown_document(spark, url, doc_id):
    pages = spark.createDataFrame([(url,)], "url string")
    labels = spark.createDataFrame([(12, 1), (12, 0), (7, 1)], "doc_id long, quality int")
    assert [r["good"] for r in urls.labelled_pages(pages, labels).collect()] == ([] if doc_id is None else [0 if doc_id == 12 else 1])


SITES = [("a.net", "a.net", "net"), ("x.y.a.co.uk", "a.co.uk", "co.uk"), ("co.uk", "co.uk", "co.uk"), ("me:pw@a.net:8080", "a.net", "net"), ("10.0.0.1:80", "10.0.0.1", "10.0.0.1"), ("[::1]:80", "[::1]", "[::1]"),
         ("[::1]", "[::1]", "[::1]"), ("localhost", "localhost", "localhost"), ("", "", ""), ("www.a.com.", "a.com", "com"), ("x.taco.uk", "taco.uk", "uk"), ("b.com.br", "b.com.br", "com.br"), ("1.2.3.4.5", "4.5", "5")]


def test_registered_domains_of_sites(spark):
    got = spark.createDataFrame([(h,) for h, _, _ in SITES], "host string").withColumn("site", urls.site_of(F.col("host"))).withColumn("suffix", urls.suffix_of(F.col("site")))
    got = {r["host"]: (r["domain"], r["suffix"]) for r in got.withColumn("domain", urls.domain_of(F.col("site"), F.col("suffix"))).collect()}
    assert got == {h: (d, s) for h, d, s in SITES}


def test_suffixes_of_a_list(spark, tmp_path):
    (tmp_path / "list.txt").write_text("// a comment\nuk\nco.uk\n*.ck  // each label below\n!www.ck\nGitHub.io\n\ncom\n")
    rules = urls.public_suffixes(spark, str(tmp_path / "list.txt"))
    assert sorted(r["rule"] for r in rules.collect()) == ["!www.ck", "*.ck", "co.uk", "com", "github.io", "uk"]
    sites = spark.createDataFrame([(s,) for s in ("a.b.co.uk", "b.uk", "x.y.foo.ck", "x.www.ck", "me.github.io", "a.net", "10.0.0.1", "")], "site string")
    assert {r["site"]: r["suffix"] for r in urls.listed_suffixes(sites, rules).collect()} == {
        "a.b.co.uk": "co.uk", "b.uk": "uk", "x.y.foo.ck": "foo.ck", "x.www.ck": "ck", "me.github.io": "github.io"}


def test_ports_and_users_share_a_reputation_and_lists_part_domains(spark, tmp_path):
    (tmp_path / "list.txt").write_text("io\ngithub.io\n")
    outcomes = spark.createDataFrame([(f"http://u@bad.github.io:81/{i}", 0) for i in range(60)] + [(f"http://good{k}.github.io/{i}", 1) for k in range(9) for i in range(60)], "url string, good int")
    pages = spark.createDataFrame([(1, "http://bad.github.io/x"), (2, "http://BAD.github.io:8080/"), (3, "http://a.bad.github.io/"), (4, "http://a.good1.github.io/")], "page_id long, url string")
    got = {r["page_id"]: r for r in urls.judge(pages, outcomes, suffixes=urls.public_suffixes(spark, str(tmp_path / "list.txt"))).collect()}
    assert got[1]["reputation"] == got[2]["reputation"] and got[2]["host"] == "bad.github.io:8080"
    assert [got[i]["verdict"] for i in (1, 2, 3, 4)] == ["block", "block", "block", "allow"]

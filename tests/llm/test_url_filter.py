import pytest

from tillwarden.llm import url_filter

RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block")]


def pages(spark, rows):
    df = spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(rows)], "page_id long, url string, html string")
    return df.selectExpr("*", "'x' AS host", "'y' AS rule", "'z' AS src")


def test_hosts_paths_and_rules(spark):
    urls = [
        "HTTP://A.Example.COM/en/x?q#f", "https://www.example.com/en/1", "x://example.com", "http://net/es/", "http://anet/es/", None, "", "no scheme", "a://b://c/d?e",
        "http://H?x", "http://x.net/ES/", "http://xcom/", "http://É.com/ö#", "http://sub.www.example.com/en/é?",
    ]
    found = [tuple(r)[1:5] for r in url_filter.judge(pages(spark, [(u, None) for u in urls]), RULES).orderBy("page_id").collect()]
    assert found[:2] == [("a.example.com", "/en/x", "example.com/en/", "block"), ("www.example.com", "/en/1", "www.example.com/en/", "allow")]
    # no rule fits an empty path: the method decides
    assert found[2][:3] == ("example.com", "", None)
    assert found[3] == ("net", "/es/", "net/es/", "block") and found[4] == ("anet", "/es/", None, "allow")
    assert found[5] == ("", "", None, "allow") == found[7]
    assert found[8][:2] == ("b:", "//c/d") and found[9][:2] == ("h", "")
    assert found[10] == ("x.net", "/ES/", None, "allow")
    assert found[11] == ("xcom", "/", None, "allow") and found[6] == found[5]
    assert found[12] == ("É.com", "/ö", "com/", "allow") and found[13][2] == "www.example.com/en/"


def link(*hosts):
    return "".join(f'<a class=x href="http://{h}/p">t</a>' for h in hosts)


def test_trust_goes_along_links_and_distrust_against_them(spark):
    rows = [
        ("http://good.com/a", link("friend.org")), ("http://friend.org/a", link("far.org")), ("http://far.org/", None),
        ("http://bad.net/es/a", "<a href='/own'>"), ("http://fan.org/", link("bad.net")), ("http://lone.org/", "<a href='#'>"),
    ]
    found = {r.host: r for r in url_filter.judge(pages(spark, rows), RULES).collect()}
    assert [found[h].verdict for h in ("friend.org", "far.org", "fan.org", "lone.org")] == ["allow", "allow", "block", "allow"]
    assert found["friend.org"].trust > 0 == found["fan.org"].trust
    # a host without links keeps what reaches it
    assert found["far.org"].trust > found["friend.org"].trust
    assert found["fan.org"].distrust > 0 == found["friend.org"].distrust


def test_ranks_are_those_of_a_plain_loop(spark):
    pairs = [("a", "b", 2), ("a", "c", 1), ("b", "a", 1), ("c", "c", 3), ("d", "a", 1), ("a", "e", 1)]
    total = {s: sum(w for x, _, w in pairs if x == s) for s, _, _ in pairs}
    edges = spark.createDataFrame([("k", s, d, w / total[s]) for s, d, w in pairs], "kind string, src string, dst string, share double")
    seeds = spark.createDataFrame([("k", "a", 0.75), ("k", "d", 0.25)], "kind string, host string, seed double")
    ranks = {"a": 0.75, "d": 0.25}
    for _ in range(5):
        new = {"a": 0.75 * 0.15, "d": 0.25 * 0.15}
        for s, score in ranks.items():
            for x, d, w in pairs:
                if x == s:
                    new[d] = new.get(d, 0) + 0.85 * score * w / total[s]
            if s not in total:
                new[s] = new.get(s, 0) + 0.85 * score
        ranks = new
    found = {r.host: r.score for r in url_filter.propagate(edges, seeds, rounds=5).collect()}
    assert found == pytest.approx(ranks) and sum(found.values()) == pytest.approx(1)


def test_repeated_and_no_rows(spark):
    rows = [("http://a.com/", None)] * 3
    assert url_filter.judge(pages(spark, rows), RULES).count() == 3
    assert url_filter.judge(pages(spark, rows).limit(0), RULES).count() == 0


def test_small_scores_count_as_large_ones_do(spark):
    """Each host of a chain gives a share of 1 in 20,000 of its distrust to the next, so the last one has less than 5e-13."""
    rows = [("http://bad.net/es/a", None)]
    for near, far in (("bad.net", "h1.org"), ("h1.org", "h2.org"), ("h2.org", "h3.org")):
        rows += [(f"http://{far}/", link(near)), (f"http://many-{far}/", link(near) * 19_999)]
    found = {r.host: r for r in url_filter.judge(pages(spark, rows), RULES).collect()}
    assert 0 < found["h3.org"].distrust < 5e-13
    assert [found[h].verdict for h in ("h1.org", "h2.org", "h3.org")] == ["block"] * 3

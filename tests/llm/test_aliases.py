import re

import pytest
from pyspark.sql import functions as F

from marginflow.llm import aliases
from marginflow.llm.queries import URL_RULES, op11_aliases

PAGES = "page_id long, url string, html string, host int, node int, alias int"


def canonical(href):
    return f'<html><head><link rel="canonical" href="{href}"></head></html>'


def made(spark, rows):
    return spark.createDataFrame([(i, u, h, 1, 2, 3) for i, u, h in rows], PAGES)


def rules(spark, rows=URL_RULES):
    return spark.createDataFrame(rows, "host string, path string, verdict string")


def verdicts(df):
    return {r.page_id: (r.rule, r.verdict, r.reason) for r in df.collect()}


def split(url):
    """Host, path and address by hand."""
    if url is None or "://" not in url:
        return "", "", None
    tail = url.split("://", 1)[1]
    own = re.match(r"[^/?#]*", tail)[0]
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in own)
    after = tail[len(own):].split("#")[0]
    return low, after.split("?")[0], low + after if low else None


def brute(rows, told, links=()):
    """Verdicts by a plain graph search; links are (address, address)."""
    def own(host, path):
        fits = [(-len(h + p), v, h + p) for h, p, v in told
                if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return min(fits)[1:] if fits else None

    near = {}
    for a, b in links:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    out = {}
    for i, url in rows:
        host, path, address = split(url)
        mine = own(host, path)
        seen, queue = {address}, [address]
        while queue:
            for b in near.get(queue.pop(), ()):
                if b not in seen:
                    seen.add(b)
                    queue.append(b)
        others = [x for a in seen if a and a in near and (x := own(*split("://" + a)[:2]))]
        if mine:
            out[i] = (mine[1], mine[0], "rule")
        elif others:
            out[i] = (None, min(x[0] for x in others), "alias")
        else:
            out[i] = (None, "allow", "default")
    return out


def test_urls_and_rules(spark):
    urls = ["http://EN.Example.com/en/1?x#y", "https://www.example.com/en/", "http://a.www.example.com/en/z", "http://x.net/es/9",
            "http://net/fr/", "http://xnet/fr/", "http://example.com", "http://example.com?en/", "no scheme", None, "",
            "://h/p", "http://É.com/En/", "http://a.org/en/#f?g", "http://y.net/ES/1", "a://b.net/es/://c", "http:///x"]
    rows = list(enumerate(urls))
    got = aliases.decide(made(spark, [(i, u, None) for i, u in rows]), rules(spark))
    assert {r.page_id: (r.host, r.path) for r in got.collect()} == {i: split(u)[:2] for i, u in rows}
    assert verdicts(got) == brute(rows, URL_RULES)


def test_decisions_reach_aliases(spark):
    rows = [
        (1, "http://a.org/1", canonical("http://b.net/es/1")),            # its canonical address is blocked
        (2, "https://c.org/2", canonical("//a.org/1")),                   # and through another page
        (3, "http://d.org/3#f", '<meta content="0; URL=\'http://e.com/3\'" http-equiv=Refresh>' + canonical("http://b.net/fr/3")),
        (4, "http://b.net/fr/4", canonical("http://e.com/4")),            # a rule of its own stays
        (5, "http://f.org/x/5", canonical("6?q=1&amp;r=2")),              # beside it, in the same folder
        (6, "http://f.org/x/6?q=1&r=2", "<link href=http://b.net/es/6 rel='shortlink CANONICAL'>"),
        (7, "http://g.org/7", "<!-- " + canonical("http://b.net/es/7") + " --> <link rel=stylesheet href=http://b.net/es/7>"),
        (8, "http://h.org", canonical("/8")), (9, "http://h.org/8", canonical("javascript:x") + canonical("#top")),
        (10, "http://h.org/8?", canonical("http://EXAMPLE.com/en/8")),
        (11, "http://i.org/11", canonical("http://i.org/11#self")), (12, None, canonical("http://b.net/es/1")),
    ]
    links = [("a.org/1", "b.net/es/1"), ("c.org/2", "a.org/1"), ("d.org/3", "e.com/3"), ("d.org/3", "b.net/fr/3"),
             ("b.net/fr/4", "e.com/4"), ("f.org/x/5", "f.org/x/6?q=1&r=2"), ("f.org/x/6?q=1&r=2", "b.net/es/6"),
             ("h.org", "h.org/8"), ("h.org/8?", "example.com/en/8")]
    got = verdicts(aliases.decide(made(spark, rows), rules(spark)))
    assert got == brute([(i, u) for i, u, _ in rows], URL_RULES, links)
    assert got[1] == got[2] == got[5] == got[6] == (None, "block", "alias") and got[3] == (None, "allow", "alias")
    assert got[7] == got[9] == (None, "allow", "default") and got[4][1] == "block"


def test_long_chains_hubs_and_given_links(spark):
    pages = [(i, f"http://s{i}.org/p", None) for i in range(400)]
    pages += [(1000 + i, "http://same.org/x", canonical("http://hub.org/")) for i in range(150)]  # one page in many rows
    pairs = [(f"s{i}.org/p", f"s{i + 1}.org/p") for i in range(0, 60)] + [(f"s{i}.org/p", "hub.org/") for i in range(100, 350)]
    pairs += [("s30.org/p", "q.net/es/"), ("hub.org/", "r.net/fr/1")]
    given = spark.createDataFrame([(f"http://{a}", f"https://{b}#x") for a, b in pairs] + [(None, "http://q.net/es/"), ("x", "y")],
                                  "source string, target string")
    got = verdicts(aliases.decide(made(spark, pages), rules(spark), links=given))
    want = brute([(i, u) for i, u, _ in pages], URL_RULES, [*pairs, ("same.org/x", "hub.org/")])
    assert got == want and got[0] == got[60] == got[349] == got[1000] == (None, "block", "alias")
    assert got[61] == got[399] == (None, "allow", "default")


def test_odd_rows(spark, nothing):
    long = "http://z.org/" + "a" * 100_000
    rows = [(None, "http://b.net/es/", None), (1, long, "x" * 200_000 + canonical("http://b.net/es/1")), (1, long, ""), (2, "", ""), (3, None, None)]
    got = aliases.decide(made(spark, rows), rules(spark))
    assert sorted((r.page_id is not None, r.page_id, r.verdict) for r in got.collect() if r.page_id) == [
        (True, 1, "block"), (True, 1, "block"), (True, 2, "allow"), (True, 3, "allow")]
    assert got.count() == 5 and got.columns == ["page_id", "host", "path", "rule", "verdict", "reason"]
    assert aliases.decide(made(spark, rows[:0]), rules(spark)).count() == 0
    free = aliases.decide(made(spark, rows), rules(spark).where("false")).collect()
    assert {(r.rule, r.verdict, r.reason) for r in free} == {(None, "allow", "default")}
    nulls = rules(spark, [(None, "/", "block"), ("net", None, "block"), ("org", "/", None), ("ORG", "/", "block"), ("org", "/", "allow"), ("org", "/", "allow")])
    assert verdicts(aliases.decide(made(spark, [(1, long, None)]), nulls)) == {1: ("org/", "allow", "rule")}


def test_no_python_in_the_plan(spark):
    df = op11_aliases(spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|InArrow", plan)
    import inspect
    source = inspect.getsource(aliases)
    assert not re.search(r"udf|Pandas|mapIn|\.rdd|collect\(\)", source)


@pytest.mark.parametrize("rows", [0, 400])
def test_query_against_plain_version(spark, rows):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").limit(rows).select("page_id", "url").collect()
    got = verdicts(op11_aliases(spark, "/root/testdata/sf0.01").where(F.col("page_id").isin([r.page_id for r in pages]) if rows else "true"))
    if rows:
        assert got == brute([(r.page_id, r.url) for r in pages], URL_RULES)
    assert len(got) == 250

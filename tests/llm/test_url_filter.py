import pytest
from pyspark.sql import functions as F

from costlens.llm.queries import URL_RULES, op3_url_filter
from costlens.llm.url_filter import NotSettledError, propagate, url_verdicts

SCHEMA = "page_id long, url string, html string, host string, verdict string"


def judged(spark, pages, rules=URL_RULES):
    rows = [(i, u, h, "x", "y") for i, (u, h) in enumerate(pages)]
    got = {}
    for r in url_verdicts(spark.createDataFrame(rows, SCHEMA), rules).collect():
        got[r.page_id] = r
    assert len(got) == len(pages)
    return [got[i] for i in range(len(pages))]


def test_hosts_paths_and_rules(spark):
    urls = [
        None, "", "no scheme", "HTTP://WWW.Example.COM/De/1", "http://a.example.com/de/1?x#y", "http://a.example.net/en/",
        "http://a.example.net?x=/en/", "http://net/", "http://botnet/", "ftp://x.org/fr/#z", "http://x.org/frx", "http://É.org/",
        "http://example.net/en", "//a.net/", "x://y://z.net/",
    ]
    got = [(r.host, r.path, r.rule) for r in judged(spark, [(u, None) for u in urls])]
    assert got == [
        ("", "", None), ("", "", None), ("", "", None), ("www.example.com", "/De/1", None),
        ("a.example.com", "/de/1", "example.com/de/"), ("a.example.net", "/en/", "example.net/en/"), ("a.example.net", "", None),
        ("net", "/", "net/"), ("botnet", "/", None), ("x.org", "/fr/", "org/fr/"), ("x.org", "/frx", None), ("É.org", "/", None),
        ("example.net", "/en", "net/"), ("", "", None), ("y:", "//z.net/", None),
    ]


def test_distrust_flows_back_to_hosts_that_link_to_blocked_ones(spark):
    link = lambda *hosts: "".join(f'<a HREF = "https://{h}/p">x</a>' for h in hosts)
    got = judged(spark, [
        ("http://farm.test/", link("spam.net", "spam2.net")),
        ("http://spam.net/", None), ("http://spam2.net/", "<a href='/in'>x</a>"),
        ("http://good.org/fr/", link("blog.test")), ("http://good.org/en/", None), ("http://blog.test/", link("good.org")),
        ("http://lone.test/", None), (None, link("spam.net")),
    ])
    verdicts = [r.verdict for r in got]
    assert verdicts == ["block", "block", "block", "allow", "allow", "allow", "allow", "allow"]
    assert got[0].distrust > got[0].trust == 0 and got[5].trust > 0 == got[6].trust


def test_scores_equal_power_iteration(spark):
    edges = [("t", "a", "b"), ("t", "b", "c"), ("t", "c", "a"), ("t", "a", "d"), ("u", "a", "b")]
    seeds = [("t", "a", 0.75), ("t", "d", 0.25), ("u", "a", 1.0)]
    got = propagate(spark.createDataFrame(edges, "kind string, src string, dst string"),
                    spark.createDataFrame(seeds, "kind string, host string, seed double"), 0.85, 1e-9)
    got = {(r.kind, r.host): r.score for r in got.collect()}
    for kind in "tu":
        seed = {h: s for k, h, s in seeds if k == kind}
        out = {}
        for k, s, d in edges:
            if k == kind:
                out.setdefault(s, []).append(d)
        score = dict(seed)
        for _ in range(400):
            moved = {}
            for s, to in out.items():
                for d in to:
                    moved[d] = moved.get(d, 0) + 0.85 * score.get(s, 0) / len(to)
            kept = sum(moved.values())
            score = {h: moved.get(h, 0) + seed.get(h, 0) * (1 - kept) for h in {*moved, *seed}}
        for h, v in score.items():
            assert got[kind, h] == pytest.approx(v, abs=1e-8)
        assert sum(score.values()) == pytest.approx(1)


def test_empty_table(spark):
    assert url_verdicts(spark.createDataFrame([], SCHEMA), URL_RULES).count() == 0


def test_scores_that_do_not_settle_fail(spark):
    edges = spark.createDataFrame([("t", "a", "b"), ("t", "b", "a")], "kind string, src string, dst string")
    seeds = spark.createDataFrame([("t", "a", 1.0)], "kind string, host string, seed double")
    with pytest.raises(NotSettledError):
        propagate(edges, seeds, 0.99, 1e-9, most_steps=9)


def names_above(host):
    labels = host.split(".")
    domain = ".".join(labels[-2:]) if len(labels) > 1 else ""
    above = ".".join(labels[1:]) if len(labels) > 2 else ""
    return [(a, b) for a, b in ((host, above), (above, domain)) if a and b and a != b]


def test_whole_table_equals_power_iteration(spark):
    """No page of this table has an absolute link: all edges are those of names."""
    sf = "/root/testdata/sf0.01"
    got = op3_url_filter(spark, sf).collect()
    assert len(got) == spark.read.parquet(f"{sf}/pages.parquet").count()
    edges = {e for r in got if r.host for a, b in names_above(r.host) for e in ((a, b), (b, a))}
    assert len(edges) > 50
    scores = {}
    for kind, verdict in (("trust", "allow"), ("distrust", "block")):
        seeds = {}
        for r in got:
            if r.rule and r.verdict == verdict:
                seeds[r.host] = seeds.get(r.host, 0) + 1
        seeds = {h: n / sum(seeds.values()) for h, n in seeds.items()}
        out = {}
        for a, b in edges:
            out.setdefault(a, []).append(b)
        score = dict(seeds)
        for _ in range(300):
            moved = {}
            for a, to in out.items():
                for b in to:
                    moved[b] = moved.get(b, 0) + 0.85 * score.get(a, 0) / len(to)
            kept = sum(moved.values())
            score = {h: moved.get(h, 0) + seeds.get(h, 0) * (1 - kept) for h in {*moved, *seeds}}
        scores[kind] = score
    by_score = set()
    for r in got:
        trust, distrust = (scores[k].get(r.host, 0) for k in ("trust", "distrust"))
        assert (r.trust, r.distrust) == pytest.approx((trust, distrust), abs=1e-4)
        if not r.rule and abs(trust - distrust) > 2e-4:
            assert r.verdict == ("block" if distrust > trust else "allow")
            by_score.add(r.verdict)
    assert by_score == {"allow", "block"}


def test_hosts_of_many_labels(spark):
    got = judged(spark, [(f"http://{'a.' * 50_000}example.com/de/", None), ("http://x.example.com/", None), ("http://..com/", None), ("http://./", None)])
    assert [r.verdict for r in got] == ["block", "block", "allow", "allow"]

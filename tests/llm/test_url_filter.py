import duckdb

from citylake.llm import url_filter as U

ROWS = [
    (1, "http://A.Example.com/en/x?y", "<a href='https://far.org/q'>"),
    (2, "https://www.example.com/en/", None),
    (3, "https://x.www.example.com/en/a#b", ""),
    (4, "https://example.com", '<a href="//spam.org/">'),
    (5, "https://example.com/de", '<a href="http://good.org/a"><a HREF=http://good.org/b>'),
    (6, "http://b.net/es/1", '<a href="http://spam.org">'),
    (7, "http://b.net/de/1", None),
    (8, "ftp://spam.org/p?http://com/", '<a href="http://b.net/es/">'),
    (9, "http://good.org/", '<a href="/local"><a href="http://ok.com/">'),
    (10, None, "<a href='http://spam.org'>"),
    (11, "no scheme com/", None),
    (12, "http://notcom/en/", None),
    (13, "http://sub.spam.org/fr/", None),
    (13, "http://sub.spam.org/fr/", None),
    (14, "http:///only/path", None),
    (15, "http://ÉX.com?q", None),
]


def pages(spark, rows=ROWS):
    return spark.createDataFrame([(*r, "z", "z", "z") for r in rows], "page_id long, url string, html string, host string, rule string, kind string")


def test_hosts_paths_and_rules(spark):
    have = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in U.judged(pages(spark)).collect()}
    assert have[1] == ("a.example.com", "/en/x", "example.com/en/", "block")
    assert have[2] == ("www.example.com", "/en/", "www.example.com/en/", "allow")
    assert have[3] == ("x.www.example.com", "/en/a", "www.example.com/en/", "allow")
    assert have[4][:3] == ("example.com", "", None)
    assert have[5][2:] == ("com/", "allow")
    assert have[6][2:] == ("net/es/", "block")
    assert have[8][:3] == ("spam.org", "/p", None)
    assert have[10] == ("", "", None, "allow") and have[11] == ("", "", None, "allow")
    assert have[12][2] is None and have[14][:2] == ("", "/only/path") and have[15][0] == "Éx.com"


def test_distrust_flows_back_and_trust_forward(spark):
    have = {r.page_id: r.verdict for r in U.judged(pages(spark)).collect()}
    assert have[8] == "block"  # points to a blocked host
    assert have[9] == "allow"  # a trusted host points to it
    assert have[7] == "block"  # its host has only blocked pages


def test_sql_gives_the_same(spark, tmp_path):
    pages(spark).select("page_id", "url", "html").write.parquet(str(tmp_path / "p"))
    con = duckdb.connect()
    con.sql(f"create view pages as select * from '{tmp_path}/p/*.parquet'")
    want = sorted(map(str, con.sql(U.OP2_SQL).fetchall()))
    out = U.judged(pages(spark)).select("page_id", "host", "path", "rule", "verdict").collect()
    assert sorted(str(tuple(r)) for r in out) == want


def test_hosts_hang_on_all_domains_above_them(spark):
    """Domains without pages of their own link hosts: distrust reaches a host that has no seed and no link."""
    rows = [(1, "http://a.x.org/fr/", None), (2, "http://b.x.org/", None), (3, "http://c.y.info/", None)]
    edges = {(r.src, r.dst) for r in U.host_edges(U.located(pages(spark, [(*r,) for r in rows]))).collect()}
    up = {("a.x.org", "x.org"), ("b.x.org", "x.org"), ("x.org", "org"), ("c.y.info", "y.info"), ("y.info", "info")}
    assert edges == up | {(b, a) for a, b in up}
    rules = (("a.x.org", "/fr/", "block"),)
    have = {r.page_id: (r.rule, r.verdict) for r in U.judged(pages(spark, rows), rules).collect()}
    assert have == {1: ("a.x.org/fr/", "block"), 2: (None, "block"), 3: (None, "allow")}


def test_propagation_equals_power_iteration(spark):
    edges = [("a", "b", 2.0), ("a", "c", 1.0), ("b", "c", 1.0), ("c", "a", 1.0), ("d", "c", 3.0)]
    seeds = [("a", 3, 0), ("c", 1, 0), ("d", 0, 2)]
    have = {r.host: (r.trust, r.distrust) for r in U.propagate(
        spark.createDataFrame(edges, "src string, dst string, weight double"), spark.createDataFrame(seeds, "host string, allowed long, blocked long")
    ).collect()}
    for column, step, base in ((0, [(s, d, w) for s, d, w in edges], {"a": 0.75, "c": 0.25}), (1, [(d, s, w) for s, d, w in edges], {"d": 1.0})):
        score = dict(base)
        for _ in range(U.ROUNDS):
            new = {h: (1 - U.DAMPING) * v for h, v in base.items()}
            for s, d, w in step:
                new[d] = new.get(d, 0) + U.DAMPING * w / sum(x[2] for x in step if x[0] == s) * score.get(s, 0)
            score = new
        assert all(abs(have.get(h, (0, 0))[column] - v) < 1e-12 for h, v in score.items())


def test_empty_table_and_plain_plan(spark):
    none = pages(spark).limit(0)
    assert U.judged(none).collect() == []
    plan = U.judged(pages(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Cartesian" not in plan

"""Urls, rules and shrunken rates."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from probity.llm import reputation
from probity.llm.queries import URL_RULES


@pytest.mark.parametrize(
    ("url", "host", "path"),
    [
        (None, "", ""),
        ("", "", ""),
        ("example.com/en/", "", ""),
        ("http://Example.COM", "example.com", ""),
        ("http://a.b?x=/y", "a.b", ""),
        ("http://a.b#x/y", "a.b", ""),
        ("http://a.b/c/d?e#f", "a.b", "/c/d"),
        ("x://a://b/c", "a:", "//b/c"),
        ("http:///p", "", "/p"),
        ("http://user@a.b:80/é\n#z", "user@a.b:80", "/é\n"),
        ("http://ÄB.com/", "Äb.com", "/"),
    ],
)
def test_host_and_path(spark, url, host, path):
    row = spark.createDataFrame([(url,)], "url STRING")
    got = row.select(*[c.alias(n) for c, n in zip(reputation.host_and_path(F.col("url")), "hp", strict=True)])
    assert tuple(got.first()) == (host, path)


@pytest.mark.parametrize(
    ("host", "path", "rule"),
    [
        ("example.com", "/en/x", "example.com/en/"),
        ("m.example.com", "/en/", "example.com/en/"),
        ("www.example.com", "/en/", "www.example.com/en/"),
        ("a.www.example.com", "/en/", "www.example.com/en/"),
        ("myexample.com", "/en/", "com/"),
        ("example.com", "/en", "com/"),
        ("example.com", "", None),
        ("com", "/", "com/"),
        ("a.net", "/es/1", "net/es/"),
        ("a.net", "/de/1", None),
        ("net.org", "/es/1", None),
    ],
)
def test_the_longest_rule_that_fits(spark, host, path, rule):
    row = spark.createDataFrame([(host, path)], "host STRING, path STRING")
    name, verdict = reputation.first_rule(F.col("host"), F.col("path"), URL_RULES)
    got = row.select(name.alias("n"), verdict.alias("v")).first()
    assert got["n"] == rule
    assert got["v"] == next((r.verdict for r in URL_RULES if r.name == rule), None)


def judged(spark, pages, outcomes):
    p = spark.createDataFrame([(*r, "x", "y") for r in pages], "page_id LONG, url STRING, host STRING, bad STRING")
    o = spark.createDataFrame([(*r, "x") for r in outcomes], "page_id LONG, bad INT, url STRING")
    return {r["page_id"]: r["verdict"] for r in reputation.judge(p, o, []).collect()}


def test_bad_hosts_are_blocked_and_little_evidence_blocks_nothing(spark):
    pages = [(i, f"http://bad{i % 4}.evil.org/{i}") for i in range(400)]
    pages += [(1000 + i, f"http://good{i % 8}.fine.org/{i}") for i in range(800)]
    pages += [(5000, "http://new.evil.org/"), (5001, "http://once.other.org/"), (5002, None), (None, "http://good1.fine.org/")]
    outcomes = [(i, 1) for i in range(300)] + [(1000 + i, int(i % 50 == 0)) for i in range(600)]
    outcomes += [(5001, 1), (5002, None), (9999, 1), (None, 1)]
    got = judged(spark, pages, outcomes)
    assert {got[i] for i in range(400)} == {"block"}
    assert {got[1000 + i] for i in range(800)} == {"allow"}
    assert got[5000] == "block"  # by its domain
    assert got[5001] == got[5002] == got[None] == "allow"


def test_posteriors_are_those_of_the_formulas(spark):
    hosts = [("a.x.org", 10, 1), ("b.x.org", 20, 12), ("c.y.org", 5, 0), ("d.co.uk", 8, 4), ("e.d.co.uk", 0, 0)]
    got = reputation.host_posteriors(spark.createDataFrame(hosts, "host STRING, n LONG, bad LONG")).collect()

    def groups(key):
        out = {}
        for h, n, b in hosts:
            m, c = out.get(key(h), (0, 0))
            out[key(h)] = (m + n, c + b)
        return out

    def strength(found):
        found = [g for g in found.values() if g[0]]
        n, bad = sum(g[0] for g in found), sum(g[1] for g in found)
        mean = bad / n
        noise, more = mean * (1 - mean), len(found) - 1
        spread = sum(b * b / m for m, b in found) - n * mean * mean - noise * more
        room = noise * (n - sum(m * m for m, _ in found) / n - more)
        if room <= 0:
            return mean, 10.0
        return mean, min(max(room / spread - 1 if spread > 0 else 1e4, 1.0), 1e4)

    uk = lambda h: h.endswith(".co.uk")
    suffix = lambda h: "co.uk" if uk(h) else h.split(".")[-1]
    domain = lambda h: ".".join(h.split(".")[-3 if uk(h) else -2 :])
    by_suffix, by_domain, by_host = groups(suffix), groups(domain), groups(lambda h: h)
    mean, s1 = strength(by_suffix)
    s2, s3 = strength(by_domain)[1], strength(by_host)[1]
    for r in got:
        (sn, sb), (dn, db) = by_suffix[suffix(r["host"])], by_domain[domain(r["host"])]
        n, b = by_host[r["host"]]
        rate = (sb - db + mean * s1) / (sn - dn + s1)
        rate = (db - b + rate * s2) / (dn - n + s2)
        rate = (b + rate * s3) / (n + s3)
        assert math.isclose(r["bad_rate"], rate, rel_tol=1e-9)
        lower = rate - 1.645 * math.sqrt(rate * (1 - rate) / (n + s3 + 1))
        assert math.isclose(r["lower"], lower, rel_tol=1e-9, abs_tol=1e-12)


def test_no_rows_and_no_outcomes(spark):
    assert judged(spark, [], [(1, 1)]) == {}
    assert judged(spark, [(1, "http://a.b/"), (2, "x")], []) == {1: "allow", 2: "allow"}


def test_public_suffixes_by_a_table(spark, tmp_path):
    (tmp_path / "rules.dat").write_text(
        "// comment\ncom\n\nCO.uk  // more\nuk\n*.ck\n!www.ck\ngithub.io\n  io\nkawasaki.jp\n*.kawasaki.jp\njp\n"
    )
    rules = reputation.read_suffixes(spark, str(tmp_path / "rules.dat"))
    want = {
        "a.b.com": 1, "com": 1, "x.co.uk": 2, "co.uk": 2, "x.uk": 1, "a.b.ck": 2, "ck": 1, "b.ck": 2, "www.ck": 1,
        "a.www.ck": 1, "me.github.io": 2, "x.io": 1, "a.b.kawasaki.jp": 3, "kawasaki.jp": 2, "local": 1, "": 1, "a.zz": 1,
        "a..com": 1, ".": 1,
    }
    hosts = spark.createDataFrame([(h,) for h in want], "host STRING")
    assert {r["host"]: r["labels"] for r in reputation.suffix_lengths(hosts, rules).collect()} == want
    one = spark.createDataFrame([("a.x.github.io", 50, 50), ("b.y.github.io", 60, 0)], "host STRING, n LONG, bad LONG")
    apart = {r["host"]: r["bad_rate"] for r in reputation.host_posteriors(one, suffixes=rules).collect()}
    assert apart["a.x.github.io"] > 0.8 > 0.2 > apart["b.y.github.io"]


def test_query_equals_its_sql_where_the_method_decides(spark, tmp_path):
    """Pages whose verdicts depend on posteriors of all three levels."""
    import duckdb
    from compare import oracle_bag, spark_bag

    from probity.llm.oracle import OP9
    from probity.llm.queries import op9_url_reputation

    hosts = [f"h{k}.bad{k % 3}.org" for k in range(12)] + [f"h{k}.good{k % 4}.org" for k in range(12)] + ["new.bad1.org", "x.co.uk"]
    pages, labels = [], []
    for i in range(1500):
        host = hosts[i * 7 % len(hosts)]
        pages.append((i, f"https://{host}/p{i}", "<p>"))
        if i % 3 and not host.startswith("new"):
            labels.append((i, int((".good" in host) ^ (i % 29 == 0)), 0))
    pages += [(9000, "http://www.example.com/en/a", ""), (9001, None, ""), (9002, "http://a.net/es/", "")]
    for name, rows, schema in (
        ("pages", pages, "page_id LONG, url STRING, html STRING"),
        ("labels", labels, "doc_id LONG, quality INT, toxic INT"),
    ):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / f"{name}.parquet"))
    con = duckdb.connect()
    for name in ("pages", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tmp_path}/{name}.parquet/*.parquet')")
    query = op9_url_reputation(spark, str(tmp_path))
    assert spark_bag(query) == oracle_bag(con, OP9)
    verdicts = {(r["host"], r["verdict"]) for r in query.collect() if r["rule"] is None}
    assert ("new.bad1.org", "block") in verdicts and ("h0.good0.org", "allow") in verdicts
    assert {v for h, v in verdicts if ".bad" in h} == {"block"}

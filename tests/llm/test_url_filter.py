import random

from mobility.llm import url_filter as op

RULES = op.RULES


def _judge(url, rules, listed):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        end = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
        rest = rest[end:]
        path = rest[: min((rest.find(c) for c in "?#" if c in rest), default=len(rest))]
    fits = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    if fits:
        r = max(fits, key=lambda r: (len(r[0] + r[1]), len(r[0]), r[2] == "block"))
        return host, path, r[0] + r[1], r[2]
    labels = host.split(".")
    on_list = any(".".join(labels[i:]) in listed for i in range(len(labels)))
    return host, path, None, "block" if on_list else "allow"


def _check(spark, urls, rules, listed, **kw):
    df = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id long, url string, host string")
    got = op.judge(df, rules, spark.createDataFrame([(x,) for x in listed], "domain string"), **kw)
    result = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in got.collect()}
    lower = {x.lower() for x in listed if x}
    assert result == {i: _judge(u, rules, lower) for i, u in enumerate(urls)}
    return got


URLS = [None, "", "no scheme/es/", "http://", "https://EXAMPLE.org/es/x?y", "http://a.example.org/en/17#f", "http://a.example.org/en/2",
        "http://x.com/fr/", "http://x.com/de/", "http://xcom/de/", "http://com/de/1", "http://y.net/?u=http://z.com/de/", "http://ÄB.net#a/b",
        "http://org", "http://org/", "http://example.org?/es/", "http://spam.net/a\nb", "ftp://bad.spam.net/x", "http://notspam.net/", "http://" + "a." * 3000 + "spam.net/"]


def test_rules_hosts_and_paths(spark):
    got = _check(spark, URLS + URLS, RULES, ["spam.net", "SPAM.net", "other.test", ""])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Join" not in plan


def test_membership_is_exact_over_many_hosts_and_blocks(spark):
    rng = random.Random(3)
    hosts = [f"h{i}.site{rng.randrange(900)}.net" for i in range(3000)]
    listed = rng.sample(hosts, 300) + [f"site{i}.net" for i in range(0, 900, 50)]
    urls = [f"http://{h}/p" for h in hosts]
    _check(spark, urls, [], listed)
    _check(spark, urls, [], listed, block_keys=100)


def test_all_none_and_nothing_listed(spark):
    urls = ["http://a.net/", "http://b.net/"]
    _check(spark, urls, [], ["net"])
    _check(spark, urls, [], [])
    _check(spark, [], RULES, ["net"])

import random

import pytest

from conftest import rows
from matchspark.llm.url_rules import judge_urls

SCHEMA = "page_id long, url string"
RULES = "host string, path string, action string"


def split_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = rest
    for c in "/?#":
        host = host.split(c, 1)[0]
    path = rest[len(host) :].split("?", 1)[0].split("#", 1)[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def brute(urls, rules, default="allow"):
    best = {}
    for host, path, action in rules:
        if host is not None and action in ("allow", "block"):
            key = (host, path or "")
            best[key] = max(best.get(key, action), action)
    out = []
    for page_id, url in urls:
        host, path = split_url(url)
        fits = [
            (len(h + p), len(h), a, h + p) for (h, p), a in best.items()
            if (host == h or host.endswith("." + h)) and path.startswith(p) and host
        ]
        top = max(fits) if fits else None
        out.append((page_id, host, path, top[3] if top else None, top[2] if top else default))
    return out


@pytest.mark.parametrize("per_block", [100_000, 7])
def test_equals_brute_force(spark, per_block):
    rng = random.Random(per_block)
    labels = ["a", "b", "org", "com", "x-y", "é"]
    paths = ["", "/", "/a", "/a/", "/a/b", "/a/b/c", "/\U0010ffff", "/é"]
    host = lambda: ".".join(rng.choice(labels) for _ in range(rng.randint(1, 4)))
    rules = [(host(), rng.choice(paths), rng.choice(["allow", "block"])) for _ in range(60)]
    rules += [("org", "/" + "a" * k, "block") for k in range(1, 6)] + [(None, "/", "block"), ("a", None, "allow"), ("b", "/", None)]
    urls = [(i, f"{rng.choice(['http', 'x'])}://{host().upper()}{rng.choice(paths)}{rng.choice(['', '?q=://z', '#f/a', 'z'])}") for i in range(300)]
    urls += [(300, None), (301, ""), (302, "no scheme"), (303, "://"), (304, "http://org"), (305, "http://org/aaaaaaaa"), (306, "f:///a")]
    urls += [(306, "f:///a"), (None, "http://org/a"), (307, "http://" + "a." * 3000 + "org/" + "a" * 50_000)]
    df = spark.createDataFrame(urls, SCHEMA)
    got = judge_urls(df, spark.createDataFrame(rules, RULES), rules_per_block=per_block)
    assert rows(got.drop("url")) == sorted(brute(urls, rules), key=lambda r: tuple((v is not None, v) for v in r))


def test_clashing_columns_no_rules_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "http://a.org/x", "old", "old")], "page_id long, url string, HOST string, f_host string")
    none = spark.createDataFrame([], RULES)
    one = spark.createDataFrame([("org", "/", "block")], RULES)
    assert rows(judge_urls(df, none, default="block")) == [(1, "http://a.org/x", "old", "a.org", "/x", None, "block")]
    assert rows(judge_urls(df, one)) == [(1, "http://a.org/x", "old", "a.org", "/x", "org/", "block")]
    assert judge_urls(df.limit(0), one).count() == 0
    assert judge_urls(df.limit(0), none).count() == 0


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(1, "http://a.org/x")], SCHEMA)
    plan = judge_urls(df, spark.createDataFrame([("org", "/", "block")], RULES))._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))


def test_columns_called_like_working_columns_stay(spark):
    rows = [(1, "http://x.org/a", "h", "p", "f", 5), (2, None, "h", "p", "f", 6)]
    urls = spark.createDataFrame(rows, "page_id long, url string, `__host` string, `__path` string, `__f_host` string, `a.b` int")
    rules = spark.createDataFrame([("org", "/", "block")], "host string, path string, action string")
    got = judge_urls(urls, rules)
    assert got.columns == [*urls.columns, "host", "path", "rule", "verdict"]
    assert sorted(tuple(r) for r in got.collect()) == [
        (1, "http://x.org/a", "h", "p", "f", 5, "x.org", "/a", "org/", "block"), (2, None, "h", "p", "f", 6, "", "", None, "allow"),
    ]

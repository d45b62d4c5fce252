import random

from eventide.llm import url_rules as U


def brute(url, rules, default="allow"):
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host, rest = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut]), rest[cut:]
        path = rest[:min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])]
    fit = [r for r in rules if None not in r and (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    if not fit:
        return host, path, None, default
    best = min(fit, key=lambda r: (-len(r[0]), -len(r[1]), r[2]))
    return host, path, best[0] + best[1], best[2]


def run(spark, urls, rules, parts=4):
    df = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)],
                               "page_id long, url string, host string, stack string").repartition(parts)
    table = spark.createDataFrame(rules, "host string, path string, verdict string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in U.judge(df, table).collect()}
    assert got == {i: brute(u, rules) for i, u in enumerate(urls)}


def test_cases(spark):
    urls = [None, "", "no scheme", "http://", "://x.com/a", "HTTP://WWW.Example.COM/en/a?b#c", "http://example.com/EN/", "http://com/",
            "http://evilexample.com/en/", "http://example.com", "http://example.com?x=/en/", "http://a.b.example.com/en/x://y/z",
            "http://example.com:80/en/", "http://É.example.com/en/é", "http://..com/", "http://x\x01example.com/en/",
            "http://m.net/es/1", "http://net/fr/", "http://m.net/", "http://" + "a." * 200 + "net/fr/" + "p" * 5000]
    run(spark, urls + urls, list(U.RULES))
    run(spark, urls, [])
    run(spark, urls, [("", "", "block"), (None, "/", "block"), ("com", "/", "block"), ("com", "/", "allow"), ("com", "", "block")])


def test_random(spark):
    rng = random.Random(1)
    host = lambda: ".".join(rng.choice("abc") for _ in range(rng.randint(1, 4)))
    path = lambda: "/" + "".join(rng.choice("xy/") for _ in range(rng.randint(0, 4)))
    rules = list({(host(), path(), rng.choice(["allow", "block"])) for _ in range(60)})
    run(spark, [f"http://{host()}{path()}" for _ in range(400)] + ["http://a.b/x"] * 300, rules, 9)


def test_empty_table_and_whole_table(spark, sf):
    assert U.judge(spark.createDataFrame([], "page_id long, url string"), U.rule_table(spark)).count() == 0
    pages = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url").collect()
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in U.op9_url_rules(spark, sf).collect()}
    assert got == {r["page_id"]: brute(r["url"], U.RULES) for r in pages}


def test_main_path_is_native(spark, sf):
    plan = U.op9_url_rules(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))

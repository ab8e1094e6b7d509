"""Robots rules and decisions against the standard library's parser."""

import random
from urllib.robotparser import RobotFileParser

from pyspark.sql import functions as F

from linkloom.operators import robots as R

AGENT = "testbot-1/1.0 (x)"
PATHS = ["/de/5", "/en/15", "/en/25", "/fr/8?page=2&ref=x", "/es/9"]

# status, body, verdicts on PATHS (deny / allow when unreachable)
CASES = [
    (200, "User-agent: *\nDisallow: /de", "FTTTT", "FTTTT"),
    (200, "User-agent: *\nAllow: /en/1\nDisallow: /en", "TTFTT", "TTFTT"),
    (200, "User-agent: *\nDisallow: /en\nAllow: /en/1", "TFFTT", "TFFTT"),
    (200, "User-agent: *\nDisallow: /\n\nUser-agent: testbot\nDisallow: /es", "TTTTF", "TTTTF"),
    (200, "", "TTTTT", "TTTTT"),
    (503, None, "FFFFF", "TTTTT"),
    (403, None, "FFFFF", "FFFFF"),
    (404, None, "TTTTT", "TTTTT"),
    (200, "User-agent: *\nDisallow: /*.html\nDisallow: /fr/8?page", "TTTFT", "TTTFT"),
    (200, "User-agent: testbot\nCrawl-delay: 5\n\nUser-agent: *\nDisallow: /", "TTTTT", "TTTTT"),
    (200, "User-agent: other\nUser-agent: TestBot\nDisallow: /en # x\n#\nDisallow: /d%65", "FFFTT", "FFFTT"),
    (200, "Disallow: /de\nUser-agent: *\n\nDisallow: /en", "TTTTT", "TTTTT"),
    (200, "User-agent: *\nUser-agent: testbot\nDisallow: /\n\nUser-agent: test\nDisallow: /es", "TTTTF", "TTTTF"),
    (200, "User-agent: *\nDisallow:\nDisallow: /de", "TTTTT", "TTTTT"),
]


def verdicts(spark, cases, on_unreachable, paths):
    rows = [(f"h{i}", c[0], c[1]) for i, c in enumerate(cases)]
    robots = spark.createDataFrame(rows, "host string, status int, body string")
    urls = [(f"h{i}", j, f"http://h{i}{p}") for i in range(len(cases)) for j, p in enumerate(paths)]
    df = spark.createDataFrame(urls, "domain string, j int, url string")
    out = {}
    for r in R.robots_filter(df, robots, AGENT, on_unreachable).collect():
        out[r.domain, r.j] = r.allowed
    return ["".join("TF"[not out[f"h{i}", j]] for j in range(len(paths))) for i in range(len(cases))]


def test_cases(spark):
    assert verdicts(spark, CASES, "deny", PATHS) == [c[2] for c in CASES]
    assert verdicts(spark, CASES, "allow", PATHS) == [c[3] for c in CASES]


def test_random_bodies_equal_the_library(spark):
    rng = random.Random(7)
    parts = ["User-agent: *", "User-agent: testbot", "User-agent: other", "Disallow: /a", "Allow: /a/b", "Disallow:",
             "Disallow: /", "", "# note", "Allow: /", "Disallow: /a%2fb", "disallow : /c?x=1", "Crawl-delay: 2",
             "nonsense", "Sitemap: http://x/", "User-agent: *  # all", "  ", "Disallow: /c?"]
    paths = ["/", "/a", "/a/b/c", "/c?x=1&y=2", "/c", "/d", "/a%2Fb", "/%61"]
    cases = [(200, "\n".join(rng.choices(parts, k=rng.randint(1, 9)))) for _ in range(300)]
    want = []
    for _, body in cases:
        parser = RobotFileParser()
        parser.parse(body.splitlines())
        want.append("".join("TF"[not parser.can_fetch(AGENT, "http://h" + p)] for p in paths))
    got = verdicts(spark, cases, "deny", paths)
    assert [(c[1], g) for c, g in zip(cases, got)] == [(c[1], w) for c, w in zip(cases, want)]


def test_rules_in_order(spark):
    body = "User-agent: a\nUser-agent: *\nAllow: /x\nDisallow:\n\nUser-agent: b\nDisallow: /y"
    df = spark.createDataFrame([("h", 200, body)], "host string, status int, body string")
    rows = R.robots_rules(df).orderBy("group_ord", "agent", "rule_ord").collect()
    assert [(r.group_ord, r.agent, r.allow, r.prefix) for r in rows] == [
        (1, "*", True, "/x"), (1, "*", True, ""), (1, "a", True, "/x"), (1, "a", True, ""),
        (2, "b", False, "/y"),
    ]


def test_no_host_and_unknown_host(spark):
    robots = spark.createDataFrame([("h", 200, "")], "host string, status int, body string")
    df = spark.createDataFrame([("", "x"), ("g", "http://g/"), ("h", "http://h/")], "domain string, url string")
    got = {r.domain: r.allowed for r in R.robots_filter(df, robots, AGENT).collect()}
    assert got == {"": False, "g": False, "h": True}
    got = {r.domain: r.allowed for r in R.robots_filter(df, robots, AGENT, "allow").collect()}
    assert got == {"": False, "g": True, "h": True}


def test_one_row_per_url(spark):
    robots = spark.createDataFrame(
        [("h", 200, "User-agent: *\n" + "Disallow: /x\n" * 50)], "host string, status int, body string"
    )
    df = spark.range(20).select(F.lit("h").alias("domain"), F.lit("http://h/x").alias("url"))
    assert R.robots_filter(df, robots, AGENT).count() == 20


def test_copies_of_an_answer_count_once(spark):
    rows = [("h", 503, None)] + [("h", 200, "User-agent: *\nDisallow: /x\nAllow: /")] * 30
    robots = spark.createDataFrame(rows, "host string, status int, body string")
    assert R.robots_rules(robots).count() == 2
    df = spark.createDataFrame([("h", "http://h/x"), ("h", "http://h/y")], "domain string, url string")
    got = {r.url: r.allowed for r in R.robots_filter(df, robots, AGENT).collect()}
    assert got == {"http://h/x": False, "http://h/y": True}


def test_choice_among_copies(spark):
    rules, other = "User-agent: *\nDisallow: /x", "User-agent: *\nDisallow: /y"
    copies = {
        "none-and-good": [(0, None), (None, None), (200, rules)],
        "good-without-body": [(200, None), (204, rules)],
        "failed-and-good": [(503, None), (404, None), (200, rules), (0, None)],
        "two-good": [(200, other), (200, rules)],
        "moved": [(302, None), (0, None)],
        "gone": [(500, None), (404, None), (0, None)],
        "refused": [(404, None), (403, None), (503, None)],
        "down": [(503, None), (0, None), (None, "x")],
        "nothing": [(0, None), (None, None)],
    }
    rows = [(h, s, b) for h, answers in copies.items() for s, b in answers]
    for order in (rows, rows[::-1], rows * 3):
        df = spark.createDataFrame(order, "host string, status int, body string").repartition(3)
        best = {r.host: (r.status, r.body) for r in R.one_answer(df).collect()}
        assert best == {
            "none-and-good": (200, rules), "good-without-body": (204, rules), "failed-and-good": (200, rules),
            "two-good": (200, rules), "moved": (302, None), "gone": (404, None), "refused": (403, None),
            "down": (503, None), "nothing": (None, None),
        }
        urls = spark.createDataFrame([(h, f"https://{h}{p}") for h in copies for p in ("/x", "/z")], "domain string, url string")
        got = {r.url[8:]: (r.if_deny, r.if_allow) for r in R.robots_verdicts(urls, df, "bot/1").collect()}
        assert got["none-and-good/x"] == (False, False) and got["none-and-good/z"] == (True, True)
        assert got["gone/x"] == (True, True) and got["refused/x"] == (False, False)
        assert got["down/x"] == got["nothing/x"] == got["moved/x"] == (False, True)

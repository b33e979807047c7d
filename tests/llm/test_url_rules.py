import random

import duckdb
import pytest

from lexiframe.llm import queries
from lexiframe.llm.url_rules import Rule, host_path_rule, judge_urls, rarest_token_index, rule_table, word_rules

from .cases import counted

RULES = [host_path_rule(*r) for r in queries.HOST_PATH_RULES] + word_rules()
ODD = [
    None, "", "no scheme", "http://", "http://example.org", "http://EXAMPLE.org/es/x", "https://a.b.example.org/en/12?x#y", "://org/",
    "http://xorg/", "http://.org/", "http://org/", "http://com?/fr/", "http://a.com/fr", "http://a.com/FR/", "http://a.com/fr/?q=/de/",
    "ftp://user@h.com:80/de/", "http://a.com#x/fr/", "http://example.org/es//en/1", "http://ÉX.example.org/en/1é", "a://b://c.org/",
    "http://m.casino-win.example.com/en/4", "http://casinos.com/", "http://x.com/my-casino", "http://free-bets.net", "http://x.com/a\n/de/",
    "http://notexample.org/es/", "http://example.org/en/1" + "9" * 9000,
]


def brute(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    n = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:n])
    m = min([rest.find(c, n) for c in "?#" if c in rest[n:]], default=len(rest))
    path = rest[n:m]
    fits = [(len(h + p), h + p, v) for h, p, v in queries.HOST_PATH_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        return host, path, max(fits)[1], max(fits)[2]
    return host, path, None, None


def test_like_every_rule_on_every_url(spark):
    rng = random.Random(1)
    made = [f"http{rng.choice(['', 's'])}://{rng.choice(['', 'www.', 'm.x.'])}{rng.choice(['example', 'ex-ample', 'EXAMPLE'])}.{rng.choice(['org', 'com', 'net'])}"
            f"{rng.choice(['', '/', '/es/', '/en/', '/fr/', '/de/'])}{rng.choice(['', '1', '12', 'x?y', '#z'])}" for _ in range(400)]  # fmt: skip
    urls = ODD + made
    df = spark.createDataFrame([(i, u, "clash", "clash") for i, u in enumerate(urls)], "page_id long, url string, host string, rule string")
    got = {r["page_id"]: r for r in judge_urls(df, RULES).collect()}
    for i, u in enumerate(urls):
        host, path, rule, verdict = brute(u)
        r = got[i]
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule), u
        if verdict:
            assert r["verdict"] == verdict
        else:
            assert r["verdict"] == ("block" if r["pattern_rule"] else "allow")
    by_url = {u: got[i] for i, u in enumerate(urls)}
    assert by_url["http://m.casino-win.example.com/en/4"]["verdict"] == "block"
    assert by_url["http://casinos.com/"]["verdict"] == "allow"
    assert by_url["http://free-bets.net"]["pattern_rule"] == "free-bets"


def test_repeats_empty_and_rules_without_literals(spark):
    df = spark.createDataFrame([(1, "http://a.org/x")] * 3 + [(None, "http://a.com/9")], "page_id long, url string")
    assert len(judge_urls(df, RULES).collect()) == 4
    assert judge_urls(df.limit(0), RULES).collect() == []
    digit = Rule("digits", "[0-9]", "block", (), 1)
    assert sorted(r["verdict"] for r in judge_urls(df, [digit]).collect()) == ["allow"] * 3 + ["block"]
    assert {r["verdict"] for r in judge_urls(df, rule_table(spark, [])).collect()} == {"allow"}


def test_filed_under_the_rarest_token(spark):
    tokens = spark.createDataFrame([("com",)] * 5 + [("fr",)] * 2 + [("example",)] * 9 + [("org",)] * 3, "token string")
    got = {r["rule"]: r["token"] for r in rarest_token_index(rule_table(spark, RULES[:5]), tokens).collect()}
    assert got == {"org/": "org", "example.org/es/": "es", "example.org/en/1": "en", "com/fr/": "fr", "com/de/": "de"}


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.01"])
def test_sql(spark, folder):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{folder}/pages.parquet'")
    res = con.execute(queries.ORACLES["op8_url_rules"])
    names = [d[0] for d in res.description]
    want = [tuple(r) for r in res.fetchall()]
    got = [tuple(r) for r in queries.op8_url_rules(spark, folder).select(*names).collect()]
    assert counted(got) == counted(want)

"""URL rules: fixed rules, mined rules against a count over all token sets."""

from itertools import combinations

from pyspark.sql import functions as F

from shardloom.llm import url_rules as U
from shardloom.llm.catalog import LLM_QUERIES

from ..conftest import SF_MID

CASES = {
    "http://EXAMPLE.com/en/1": ("example.com", "/en/1", "example.com/en/", "block"),
    "https://www.example.com/en/x?y#z": ("www.example.com", "/en/x", "www.example.com/en/", "allow"),
    "https://m.www.example.com/en/": ("m.www.example.com", "/en/", "www.example.com/en/", "allow"),
    "https://notexample.com/en/": ("notexample.com", "/en/", "com/", "allow"),
    "http://a.net/es/1": ("a.net", "/es/1", "net/es/", "block"),
    "http://a.net/esp": ("a.net", "/esp", None, "allow"),
    "http://a.com?x=/en/": ("a.com", "", None, "allow"),
    "a://b://net/fr/": ("b:", "//net/fr/", None, "allow"),
    "http://net/fr/\n2": ("net", "/fr/\n2", "net/fr/", "block"),
    "no scheme": ("", "", None, "allow"), "": ("", "", None, "allow"), None: ("", "", None, "allow"),
    "http://ÉCOLE.Com/a b": ("École.com".replace("É", "É").replace("cole", "cole"), "/a b", "com/", "allow"),
}


def test_host_path_and_longest_rule(spark):
    rows = [(i, u, "h", "r") for i, u in enumerate(CASES)]
    pages = spark.createDataFrame(rows + [(None, "http://a.net/es/", "h", "r"), rows[0]], "page_id bigint, url string, host string, rule string")
    labels = spark.createDataFrame([], "url string, bad boolean")
    got = U.judge(pages, labels).collect()
    assert len(got) == len(rows) + 2
    by_id = {r.page_id: r for r in got}
    for i, (u, want) in enumerate(CASES.items()):
        assert tuple(by_id[i])[1:] == want, u
    assert by_id[None].verdict == "block"
    assert U.judge(pages.limit(0), labels).count() == 0


def _labelled(spark):
    rows = []
    for i in range(400):
        bad = i % 4 == 0
        host = ("spam.example.org" if i % 8 == 0 else "news.example.org") if bad else ("news.example.org" if i % 2 else "spam.example.org" if i % 100 == 2 else "blog.example.org")
        rows.append((f"http://{host}/{'promo' if bad else 'text'}/{i}?ref=x", bad))
    return spark.createDataFrame(rows, "url string, bad boolean")


def test_mined_rules_are_all_strong_rules(spark):
    mining = U.Mining(support=0.01, least=5, confidence=0.9)
    df = _labelled(spark).select(U.tokens(F.col("url")).alias("tokens"), "bad")
    rows = [(frozenset(r.tokens), r.bad) for r in df.collect()]
    strong = {}
    for items in {frozenset(c) for t, b in rows if b for n in range(1, len(t) + 1) for c in combinations(sorted(t), n)}:
        seen = [b for t, b in rows if items <= t]
        if sum(seen) >= max(5, 0.01 * len(rows)) and sum(seen) / len(seen) >= 0.9:
            strong[items] = sum(seen) / len(seen)
    best = {a for a in strong if not any(b < a and strong[b] >= strong[a] for b in strong)}
    got = {frozenset(r.antecedent): r.confidence for r in U.mine(df, mining).collect()}
    assert set(got) == best and best
    assert all(abs(got[a] - strong[a]) < 1e-9 for a in got)


def test_pages_meet_mined_rules(spark):
    pages = spark.createDataFrame([(1, "https://x.example.org/promo/9"), (2, "https://x.example.org/text/9"), (3, "https://x.example.com/promo/9")], "page_id bigint, url string")
    got = {r.page_id: r.verdict for r in U.judge(pages, _labelled(spark), mining=U.Mining(support=0.01, least=5, confidence=0.9)).collect()}
    assert got == {1: "block", 2: "allow", 3: "allow"}       # 3: the fixed rule com/ decides


def test_query_judges_every_page(spark):
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{SF_MID}/pages.parquet").collect()}
    rows = LLM_QUERIES["op5_url_rules"](spark, SF_MID).collect()
    assert sorted(r.page_id for r in rows) == sorted(pages)
    for r in rows:
        rest = pages[r.page_id].split("://", 1)[1]
        host = rest.split("/")[0].split("?")[0].split("#")[0].lower()
        assert r.host == host and (r.host + r.path) == (host + rest[len(host):].split("?")[0].split("#")[0])
        fits = [(len(h + p), h + p, a) for h, p, a in U.RULES if (host == h or host.endswith("." + h)) and r.path.startswith(p)]
        if fits:
            assert (r.rule, r.verdict) == max(fits)[1:]
        else:
            assert r.rule is None and r.verdict in ("allow", "block")

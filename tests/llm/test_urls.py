import numpy as np
import pytest

from spelltide.llm import urls
from spelltide.llm.queries import RULES

# Url, host, path, longest rule.
CASES = [
    ("https://Blog.Example.NET/en/1?x#y", "blog.example.net", "/en/1", "example.net/en/"),
    ("http://x.net", "x.net", "", None),
    ("http://x.net/", "x.net", "/", "net/"),
    ("http://example.com/de/a", "example.com", "/de/a", "example.com/de/"),
    ("http://badexample.com/de/a", "badexample.com", "/de/a", None),
    ("http://a.org/fr/", "a.org", "/fr/", "org/fr/"),
    ("http://a.org/FR/", "a.org", "/FR/", None),
    ("http://a.org?u=http://x.net/", "a.org", "", None),
    ("x.net/en/", "", "", None),
    ("://net/q", "net", "/q", "net/"),
    ("a\nb://h.net/p\nq#", "h.net", "/p\nq", "net/"),
    (None, "", "", None),
    ("", "", "", None),
]


def test_hosts_paths_and_rules(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "page_id long, url string")
    model = urls.fit(urls.rule_labels(df, RULES), "url", "accepted")
    out = {r.page_id: r for r in urls.judge(df.selectExpr("*", "1 as _url_text2"), model, RULES).collect()}
    for i, (_, host, path, rule) in enumerate(CASES):
        assert (out[i].host, out[i].path, out[i].rule) == (host, path, rule)
        assert out[i].verdict in ("allow", "block")
        if rule:
            assert out[i].verdict == ("allow" if rule in ("example.net/en/", "org/fr/") else "block")


def brute(counts_rows, text):
    """Mean log P by blending each order into the next lower one, from plain counts."""
    def symbols(t):
        return [urls.END] * urls.ORDER + [int(urls._CLASS[b]) for b in t.encode()] + [urls.END]

    seen = {}
    for t in counts_rows:
        line = symbols(t)
        for i in range(urls.ORDER, len(line)):
            for k in range(urls.ORDER + 1):
                own = seen.setdefault(tuple(line[i - k : i]), {})
                own[line[i]] = own.get(line[i], 0) + 1

    def p(context, s):
        below = p(context[1:], s) if context else 1 / urls.SYMBOLS
        own = seen.get(tuple(context), {})
        total = sum(own.values())
        return (own.get(s, 0) + urls.SMOOTHING * below) / (total + urls.SMOOTHING) if total >= urls.LEAST_SEEN else below

    line = symbols(text)
    return np.mean([np.log(p(line[i - urls.ORDER : i], line[i])) for i in range(urls.ORDER, len(line))])


def test_scores_equal_a_direct_computation(spark):
    good = [f"https://news.site{i}.org/story/{i}" for i in range(60)]
    bad = [f"http://win-casino{i}.biz/?click={i}" for i in range(60)]
    rows = [(u, True) for u in good] + [(u, False) for u in bad]
    model = urls.fit(spark.createDataFrame(rows, "url string, accepted boolean"), "url", "accepted")
    df = spark.createDataFrame([(i, u) for i, u in enumerate(["https://news.site9.org/story/x", "http://casino.biz/?click", "", "é" * 30_000])], "page_id long, url string")
    hosts = "pmod(xxhash64(regexp_extract(url, '://([^/]*)', 1)), 5) = 0"
    held = {r.url for r in spark.createDataFrame(rows, "url string, ok boolean").where(hosts).collect()}
    want = [brute([u for u in good if u not in held], t) - brute([u for u in bad if u not in held], t) for (t,) in df.select("url").collect()]
    out = sorted(urls.judge(df, model, []).collect(), key=lambda r: r.page_id)
    assert [r.score for r in out] == pytest.approx(want, abs=1e-5)
    assert [r.verdict for r in out[:2]] == ["allow", "block"]


def test_no_labels_and_empty_table(spark):
    df = spark.createDataFrame([], "page_id long, url string")
    model = urls.fit(urls.rule_labels(df, RULES), "url", "accepted")
    assert urls.judge(df, model, RULES).count() == 0
    one = spark.createDataFrame([(1, "http://q.com/"), (1, "http://q.com/"), (None, None)], "page_id long, url string")
    assert [r.verdict for r in urls.judge(one, model, RULES).collect()] == ["allow"] * 3


def test_whole_hosts_are_held_out(spark):
    """A host's urls lie on one side: a model that knows one host's paths gains nothing for the threshold from that."""
    rows = [(f"http://h{i % 7}.org/{i}", i % 7 < 4) for i in range(700)]
    model = urls.fit(spark.createDataFrame(rows, "url string, accepted boolean"), "url", "accepted")
    held = {r.h for r in spark.range(7).selectExpr("concat('h', id, '.org') AS h").where("pmod(xxhash64(h), 5) = 0").collect()}
    counted = [u for u, _ in rows if u.split("/")[2] not in held]
    good = [u for u, ok in rows if ok and u in counted]
    text = "http://h1.org/55"
    bad = [u for u, ok in rows if not ok and u in counted]
    have = urls.judge(spark.createDataFrame([(1, text)], "page_id long, url string"), model, []).first().score
    assert have == pytest.approx(brute(good, text) - brute(bad, text), abs=1e-5) or model.threshold == 0


def test_columns_with_the_new_names(spark):
    df = spark.createDataFrame([(1, "http://a.net/x", "h", "p", "r", "v", 9)], "page_id long, url string, host string, path string, rule string, verdict string, score int")
    model = urls.fit(urls.rule_labels(df, RULES), "url", "accepted")
    got = urls.judge(df, model, RULES).first()
    assert (got.host, got.path, got.rule, got.verdict) == ("a.net", "/x", "net/", "block")

import math
from collections import Counter, defaultdict

import pytest

from siltstone.llm import urls as U
from siltstone.llm.common import table
from tests.conftest import SMALL


def _parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
    path = rest[end:]
    return host, path[: min((path.find(c) for c in "?#" if c in path), default=len(path))]


def _rule(host, path):
    best = None
    for r in U.RULES:
        if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path):
            if best is None or len(r.host + r.path) > len(best.host + best.path):
                best = r
    return best


def _check(rows, urls):
    got = sorted((repr(r.page_id), r.host, r.path, repr(r.rule)) for r in rows)
    expected = []
    for page, url in urls:
        host, path = _parts(url)
        rule = _rule(host, path)
        expected.append((repr(page), host, path, repr(rule and rule.host + rule.path)))
    assert got == sorted(expected)
    for r in rows:
        assert r.verdict in ("allow", "block")
        if r.rule:
            assert r.verdict == _rule(r.host, r.path).verdict


def test_hosts_paths_and_rules(spark):
    urls = [(r.page_id, r.url) for r in table(spark, SMALL, "pages").collect()]
    _check(U.op7_url_language_models(spark, SMALL).collect(), urls)


def test_odd_rows(spark, odd_dir):
    urls = [(r.page_id, r.url) for r in table(spark, odd_dir, "pages").collect()]
    rows = U.op7_url_language_models(spark, odd_dir).collect()
    _check(rows, urls)
    more = ["x://net/", "x://a.NET/y", "x://net", "x://anet/", "HTTP://org/fr/?/", "a://b://c/d", "://é.org/fr/#z", "x://\n/y"]
    df = spark.createDataFrame(list(enumerate(more)), "page_id long, url string")
    _check(U.judged(df).collect(), list(enumerate(more)))


def _ratio(text, counts):
    """Witten-Bell interpolation, one character at a time."""
    chars, total = "^" * U.ORDER + text + "$", 0.0
    for i in range(U.ORDER, len(chars)):
        p = {}
        for c in counts:
            p[c] = 1 / U.SYMBOLS
            for order in range(U.ORDER + 1):
                after = counts[c][chars[i - order : i]]
                if after:
                    p[c] = (after[chars[i]] + len(after) * p[c]) / (sum(after.values()) + len(after))
        total += math.log(p["allow"]) - math.log(p["block"])
    return total / (len(text) + 1)


def test_scores_equal_a_plain_model(spark):
    rows = [(f"good{i % 7}.example/a{i}", "allow") for i in range(40)]
    rows += [(f"bad-{i % 5}.example/b{i}", "block") for i in range(30)] + [("good1.example/b1", None), ("", None)]
    df = spark.createDataFrame(rows, "_text string, _label string")
    scores, threshold = U.scored(df)
    got = {r._text: r.score for r in scores.collect()}
    held = {r._text for r in spark.createDataFrame(rows, "t string, l string").selectExpr("t AS _text").where(f"pmod(xxhash64('held', _text), {U.HELD_OUT}) = 0").collect()}
    counts = {"allow": defaultdict(Counter), "block": defaultdict(Counter)}
    for text, label in rows:
        if label and text not in held:
            chars = "^" * U.ORDER + text + "$"
            for i in range(U.ORDER, len(chars)):
                for order in range(U.ORDER + 1):
                    counts[label][chars[i - order : i]][chars[i]] += 1
    assert got == pytest.approx({t: _ratio(t, counts) for t, _ in rows}, rel=1e-9)
    assert threshold is not None
    assert all((got[t] >= threshold) == (label == "allow") for t, label in rows if label)


def test_held_out_urls_are_told_apart(spark):
    """On URLs that no model has seen, the method repeats the rules' verdicts."""
    pages = table(spark, "/root/testdata/sf0.1", "pages").select("page_id", "url")
    rows = U.with_rule(pages).selectExpr("concat(host, path) AS _text", "_ruled AS _label")
    scores, threshold = U.scored(rows)
    held = rows.distinct().where(f"_label IS NOT NULL AND pmod(xxhash64('held', _text), {U.HELD_OUT}) = 0")
    found = held.join(scores, "_text").collect()
    right = sum((r.score >= threshold) == (r._label == "allow") for r in found)
    assert len(found) > 50 and right / len(found) > 0.9


def test_without_examples_all_is_allowed(spark, empty_dir):
    df = spark.createDataFrame([(1, "http://a.example.com/x")], "page_id long, url string")
    assert U.judged(df).first().verdict == "allow"
    assert U.op7_url_language_models(spark, empty_dir).count() == 0


def test_queries_fragments_and_schemes_are_judged(spark):
    """URLs without a rule that differ from each other only behind the path, or have no ://."""
    said = {"allow": ["?u=news", "#news"], "block": ["?u=free-bets", "#free-bets"]}
    ruled = {"allow": "http://a.example.net/en/go", "block": "http://a.net/go"}
    rows = [(f"{v}{i}", f"{ruled[v]}{said[v][i % 2]}{i}") for v in ruled for i in range(60)]
    more = [f"http://a.com/go{end}" for v in said for end in said[v]] + ["go?u=news", "go?u=free-bets"]
    rows += [(url, url) for url in more] + [("null", None), ("empty", "")]
    got = {r.page_id: r for r in U.judged(spark.createDataFrame(rows, "page_id string, url string")).collect()}
    assert [got[url].verdict for url in more] == ["allow", "allow", "block", "block", "allow", "block"]
    assert len({got[url].score for url in more}) == len(more)
    assert got["null"].score == got["empty"].score
    assert all(got[url].path == "/go" for url in more[:4])

from __future__ import annotations

import math
import random
import zlib

import duckdb
import numpy as np
import pytest

from marketloom.llm import url_filter as uf
from marketloom.llm.labelled_urls import ALLOWED, BLOCKED


@pytest.mark.parametrize(
    ("url", "want"),
    [
        (None, ("", "")), ("no scheme", ("", "")), ("http://A.Com", ("a.com", "")), ("http://A.Com?x=/y", ("a.com", "")), ("http://a.com/B?c#d", ("a.com", "/B")),
        ("http://a.com#/x", ("a.com", "")), ("x://y://z/w", ("y:", "//z/w")), ("http:///p", ("", "/p")), ("http://ÄÖ.com/", ("ÄÖ.com", "/")),
    ],
)
def test_host_and_path(url, want):
    assert uf.host_and_path(url) == want


@pytest.mark.parametrize(
    ("url", "rule"),
    [
        ("http://a.com/", "com/"), ("http://a.com", None), ("http://com/", "com/"), ("http://acom/", None), ("http://example.com/en/1", "example.com/en/"),
        ("http://b.example.com/en/", "example.com/en/"), ("http://www.example.com/en/", "www.example.com/en/"), ("http://x.www.example.com/en/", "www.example.com/en/"),
        ("http://www.example.com/de/", "com/"), ("http://x.net/es/1", "net/es/"), ("http://x.net/en/", None), ("http://x.net/fr/", "net/fr/"), ("http://x.net/ES/", None), (None, None),
    ],
)
def test_rules(url, rule):
    verdicts = dict(uf.RULES)
    found = uf.Judge(uf.RULES)(url)
    assert found[2] == rule and (rule is None or found[3] == verdicts[rule])


def test_rules_equal_brute_force():
    r = random.Random(1)
    rules = uf.by_host(uf.RULES)
    for _ in range(2000):
        host = ".".join(r.choice(["www", "example", "com", "net", "a"]) for _ in range(r.randrange(1, 5)))
        path = r.choice(["", "/", "/en/", "/en/x", "/es/", "/fr", "/fr/y"])
        fits = [(rule, v) for rule, v in uf.RULES if f".{host}".endswith("." + rule.split("/", 1)[0]) and path.startswith("/" + rule.split("/", 1)[1])]
        assert uf.rule_for(host, path, rules) == max(fits, key=lambda f: len(f[0]), default=(None, None))


def test_accuracy_on_urls_left_out():
    """Five folds of the labelled table."""
    right = total = 0
    both = (uf.ALLOWED, uf.BLOCKED)
    try:
        for fold in range(5):
            uf.ALLOWED, uf.BLOCKED = ([u for k, u in enumerate(part) if k % 5 != fold] for part in (ALLOWED, BLOCKED))
            uf.trained.cache_clear()
            judge = uf.Judge(())
            for part, verdict in ((ALLOWED, "allow"), (BLOCKED, "block")):
                found = [judge(u)[3] for k, u in enumerate(part) if k % 5 == fold]
                right, total = right + found.count(verdict), total + len(found)
    finally:
        uf.ALLOWED, uf.BLOCKED = both
        uf.trained.cache_clear()
    assert right >= 0.8 * total


def test_labelled_hosts_are_not_those_of_the_pages():
    con = duckdb.connect()
    hosts = [uf.host_and_path(u)[0] for (u,) in con.execute("SELECT url FROM '/root/testdata/sf0.01/pages.parquet' WHERE url IS NOT NULL").fetchall()]
    theirs = {label for h in hosts for label in h.split(".")}
    ours = {label for u in ALLOWED + BLOCKED for label in uf.host_and_path(u)[0].split(".")}
    assert ours & theirs <= {"www", "blog", "m", "com", "net", "org"}
    assert len(set(ALLOWED + BLOCKED)) == len(ALLOWED + BLOCKED)


@pytest.mark.parametrize(
    ("host", "verdict"),
    [
        ("roulette-casino-night.org", "block"), ("pills4less.net", "block"), ("betsandodds.de", "block"), ("ads.tracking-hub.io", "block"), ("spam-central.net", "block"),
        ("river-history.org", "allow"), ("www.astronomers-club.net", "allow"), ("blog.fishing-villages.es", "allow"), ("cathedrals.fr", "allow"), ("thistledown.org", "allow"),
    ],
)
def test_hosts_in_neither_list(host, verdict):
    assert host not in {uf.host_and_path(u)[0] for u in ALLOWED + BLOCKED}
    assert uf.Judge(())(f"https://{host}/en/7")[3] == verdict


def test_regression_equals_a_naive_one(monkeypatch):
    monkeypatch.setattr(uf, "ALLOWED", ALLOWED[:6])
    monkeypatch.setattr(uf, "BLOCKED", BLOCKED[:4])
    monkeypatch.setattr(uf, "ROUNDS", 12)
    uf.trained.cache_clear()
    try:
        w, b = uf.trained()
        judged = [uf.Judge(()).probability(*uf.host_and_path(u)) for u in (ALLOWED[0], BLOCKED[7], "", "https://x.y/z")]
    finally:
        uf.trained.cache_clear()

    def row(url):
        host, path = uf.host_and_path(url)
        found = set()
        for mark, part in (("h", host), ("p", path)):
            text = "^" + part + "$"
            for n in (3, 4, 5):
                for k in range(len(text) - n + 1):
                    found.add(zlib.crc32((mark + text[k : k + n]).encode()) % uf.WIDTH)
        return {f: len(found) ** -0.5 for f in found}

    data = [(row(u), 0, 0.5 / 7) for u in [*ALLOWED[:6], ""]] + [(row(u), 1, 0.5 / 4) for u in BLOCKED[:4]]
    weights, bias = [0.0] * uf.WIDTH, 0.0

    def chance(features):
        return 1 / (1 + math.exp(-(sum(weights[f] * v for f, v in features.items()) + bias)))

    for _ in range(12):
        apart = [(features, share * (chance(features) - label)) for features, label, share in data]
        step = [uf.PENALTY * x for x in weights]
        for features, a in apart:
            for f, v in features.items():
                step[f] += a * v
        weights = [x - 20 * s for x, s in zip(weights, step, strict=True)]
        bias -= 2 * sum(a for _, a in apart)
    assert np.allclose(w, weights, atol=1e-12) and math.isclose(b, bias, abs_tol=1e-12)
    assert np.allclose(judged, [chance(row(u)) for u in (ALLOWED[0], BLOCKED[7], "", "https://x.y/z")])


def test_very_long_urls():
    host = "a" * 100_000
    assert uf.Judge(uf.RULES)(f"https://{host}.net/es/{'b' * 300_000}?q")[:4] == (f"{host}.net", f"/es/{'b' * 300_000}", "net/es/", "block")


def test_rows(spark):
    rows = [(1, "http://casino-empire.example.org/en/1", "x"), (2, "https://www.bird-migration.example.org/en/1", "x"), (None, None, None), (1, "http://casino-empire.example.org/en/1", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string")
    got = sorted(((r.page_id, r.host, r.path, r.rule, r.verdict) for r in uf.judge(pages).collect()), key=repr)
    casino = (1, "casino-empire.example.org", "/en/1", None, "block")
    assert got == [casino, casino, (2, "www.bird-migration.example.org", "/en/1", None, "allow"), (None, "", "", None, "allow")]
    assert uf.judge(pages.limit(0)).collect() == []

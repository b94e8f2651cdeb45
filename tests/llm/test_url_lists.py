"""The temporal list join against plain Python, with times in days and in seconds."""

import random

import pytest
from pyspark.sql import functions as F

from recordqa.llm import url_lists


def decide(captures, events):
    """(id, n_active, decision, pattern) of (id, host, time), entry by entry."""
    history: dict = {}
    for name, pattern, action, at in set(events):
        history.setdefault((name, pattern), []).append((at, action))
    spans = []
    for (name, pattern), steps in history.items():
        steps.sort()
        for n, (at, action) in enumerate(steps):
            if action == "add":
                spans.append((name, pattern, at, steps[n + 1][0] if n + 1 < len(steps) else None))
    out = []
    for ident, host, at in captures:
        tails = {host.split(".", n)[-1] for n in range(host.count("."))} | {host}
        active = [(-len(p), name != "allow", p, name) for name, p, lo, hi in spans if p in tails and lo <= at and (hi is None or at < hi)]
        best = min(active, default=(0, 0, None, "none"))
        out.append((ident, len(active), best[3], best[2]))
    return sorted(out)


@pytest.mark.parametrize("tick, start", [(1, 0), (1, -40), (86_400, 1_600_000_000)])
def test_evaluate(spark, tick, start):
    rng = random.Random(tick)
    hosts = ["a.example", "www.a.example", "x.www.a.example", "b.example", "b.test"]
    moment = lambda: start + tick * rng.randrange(80) + (rng.randrange(3) if tick > 1 else 0)
    events = [(rng.choice(["block", "allow"]), rng.choice(hosts), rng.choice(["add", "add", "remove"]), moment()) for _ in range(150)]
    captures = [(n, rng.choice(hosts), moment()) for n in range(400)]
    df = spark.createDataFrame([(n, f"http://{h}/", t) for n, h, t in captures], "page_id long, url string, fetched long")
    got = url_lists.evaluate(df, spark.createDataFrame(events, "list string, pattern string, action string, at long"))
    assert sorted(tuple(r) for r in got.select("page_id", "n_active", "decision", "pattern").collect()) == decide(captures, events)


def test_an_interval_is_one_or_two_rows_however_long(spark):
    spans = [(0, 0), (5, 5), (3, 4), (7, 8), (-3, 2), (0, 2**40), (1_600_000_000, 1_600_000_000 + 10 * 365 * 86_400)]
    df = spark.createDataFrame([(n, lo, hi) for n, (lo, hi) in enumerate(spans)], "n int, lo long, hi long")
    found = url_lists.dyadic(df)
    assert found.groupBy("n").count().where("count > 2").count() == 0
    for r in found.groupBy("n", "lo", "hi", "level").agg(F.min("block").alias("a"), F.max("block").alias("b")).collect():
        assert r.a * 2**r.level <= r.lo and r.hi < (r.b + 1) * 2**r.level and 2**r.level >= r.hi - r.lo + 1


def test_very_long_urls(spark):
    url = "http://h.example/" + "d" * 200_000 + "/x"
    df = spark.createDataFrame([(1, url, 5)], "page_id long, url string, fetched long")
    events = spark.createDataFrame([("block", "h.example/" + "d" * 200_000 + "/", "add", 1)], "list string, pattern string, action string, at long")
    assert [r.decision for r in url_lists.evaluate(df, events).collect()] == ["block"]

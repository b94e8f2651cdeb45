"""The pipeline's stages against plain Python, on benchmark documents and on odd rows."""

import re

import brute
import corpus_pipeline as pipeline
import pytest
from pyspark.sql import functions as F

from recordqa.llm import mixing, tiling
from recordqa.llm.common import table

DDL = "doc_id long, text string, lang string, source string, n_chars long, _r1 long, taken int, spans string"
FUNCTIONS = dict(pipeline.STAGES)


def rows(df):
    return sorted((tuple(r) for r in df.select(*pipeline.COLUMNS).collect()), key=str)


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return table(spark, sf_dir, "documents")


@pytest.fixture(scope="module")
def plain(docs):
    return rows(docs)


def test_language_keeps_what_is_written_in_a_language(spark, docs, plain, sf_dir):
    assert rows(FUNCTIONS["language"](spark, docs, sf_dir)) == [r for r in plain if re.search(r"[^\W\d_]", r[1] or "")]


def test_simhash_keeps_one_of_each_component(spark, docs, plain, sf_dir):
    kept = {c for _, _, c in brute.simhash_components([(r[0], r[1]) for r in plain])}
    assert rows(FUNCTIONS["simhash"](spark, docs, sf_dir)) == [r for r in plain if r[0] in kept] and len(kept) < len(plain)


def test_decontamination_drops_covered_items(spark, docs, plain, sf_dir):
    tokens = lambda t: re.findall(r"\w+", (t or "").lower())
    items = [tokens(r.text) for r in table(spark, sf_dir, "benchmark").collect()]
    seeds: dict = {}
    for n, item in enumerate(items):
        for i in range(len(item) - 4):
            seeds.setdefault(tuple(item[i : i + 5]), []).append((n, i))

    def dirty(text):
        words, pairs = tokens(text), {}
        for d in range(len(words) - 4):
            for n, i in seeds.get(tuple(words[d : d + 5]), ()):
                pairs.setdefault(n, []).append((d, i))
        return any(sum(t[2] for t in tiling.tiles(p, 5)) >= 0.5 * len(items[n]) for n, p in pairs.items())

    assert rows(FUNCTIONS["decontamination"](spark, docs, sf_dir)) == [r for r in plain if not dirty(r[1])]


def test_secrets_are_masked(spark, docs, plain, sf_dir):
    def masked(r):
        spans = [tuple(map(int, s.split(":")[1:])) for s in brute.secrets(r[1])[4].split(",") if s]
        if not spans:
            return r
        out, at = [], 0
        for start, end in sorted(spans):
            if start >= at:
                out += [r[1][at:start], "[SECRET]"]
            at = max(at, end)
        text = "".join(out) + r[1][at:]
        return (r[0], text, r[2], r[3], len(text))

    assert rows(FUNCTIONS["secrets"](spark, docs, sf_dir)) == sorted((masked(r) for r in plain), key=str)


def test_mixing_takes_what_the_targets_say(spark, docs, sf_dir):
    got = FUNCTIONS["mixing"](spark, docs, sf_dir)
    targets = {(r.source_size, r.target) for r in mixing.mix_documents(docs).select("source_size", "target").distinct().collect()}
    taken = got.groupBy("source").agg(F.sum("taken").alias("t")).collect()
    assert sum(r.t for r in taken) == pytest.approx(sum(t for _, t in targets), abs=len(targets))
    assert got.where("taken > 2 * size or taken <= 0").count() == 0


def test_run_applies_all_stages(spark, docs, sf_dir):
    out = pipeline.run(spark, sf_dir)
    assert out.columns[:5] == pipeline.COLUMNS and 0 < out.count() < docs.count()
    step = docs
    for _, function in pipeline.STAGES[:4]:
        step = function(spark, step, sf_dir)
        assert step.columns == pipeline.COLUMNS
    assert out.join(step, "doc_id", "left_anti").count() == 0


def test_odd_rows(spark, sf_dir):
    text = "the and of to in that was with by it " * 6
    data = [
        (1, text, "en", "a", 5), (1, text, "en", "a", 5), (None, text, "en", None, None), (2, None, None, None, None),
        (3, "", "en", "b", 0), (4, "12 %% !!", None, "b", 8), (5, "der die und das " * 9 + "token = abcdef123", "de", "b", 1),
        (6, "x" * 300_000, "en", "c", 300_000), (7, text.upper(), "en", "a", 1),
    ]
    df = spark.createDataFrame([(*r, 1, 2, "s") for r in data], DDL)
    names = {}
    for name, function in pipeline.STAGES:
        out = function(spark, df, sf_dir)
        assert out.columns[:5] == pipeline.COLUMNS
        names[name] = out.select(*pipeline.COLUMNS).collect()
        assert function(spark, df.limit(0), sf_dir).collect() == []
    assert {r.doc_id for r in names["language"]} == {1, None, 5, 6, 7} and len(names["language"]) == 6
    # all texts without words share fingerprint zero; upper case is the same text, copies go
    assert sorted((r.doc_id for r in names["simhash"]), key=str) == [1, 2, 4, 5, 6]
    assert len(names["decontamination"]) == 9
    assert [r.text[-8:] for r in names["secrets"] if r.doc_id == 5] == ["[SECRET]"] and len(names["secrets"]) == 9
    assert {r.doc_id for r in names["mixing"]} <= {1, None, 4, 5, 6, 7}


def test_no_labels_reject_nothing(spark, sf_dir):
    df = spark.createDataFrame([(1, "words of some kind", None, "a", 5), (2, None, None, "a", 0)], "doc_id long, text string, lang string, source string, n_chars long")
    assert len(FUNCTIONS["language"](spark, df, sf_dir).collect()) == 2

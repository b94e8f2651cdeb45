"""The corpus operators against plain Python, on rows chosen to hurt."""

import os
import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from recordqa.llm import common, embeddings, language, mixing, queries, secrets, simhash, suffixes, tiling, toxicity, url_lists, warc
from workload.compare import compare, duck

DOC = "doc_id long, text string, lang string, source string, n_chars long, id string, k1 long, spans string, label int"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(n, seed):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randrange(50)) for _ in range(n))


BASE = prose(300, 1)
TEXTS = [
    (0, BASE),
    (1, BASE),
    (2, BASE.replace("alpha", "alfa", 1)),
    (3, None),
    (4, ""),
    (5, " \n\t "),
    (6, "one"),
    (7, prose(4000, 2)),
    (8, "x" * 5000),
    (9, "Ünïcødé — ſecret 𝒳 " * 40),
    (9, "Ünïcødé — ſecret 𝒳 " * 40),
    (None, BASE),
    (10, prose(80, 3) + " " + BASE[500:1100] + " " + prose(60, 4)),
    (11, BASE[300:900]),
]


@pytest.fixture(scope="module")
def docs(spark):
    """Documents with nulls, repeated rows, long texts and columns whose names clash with results."""
    rows = [(i, t, None if n % 3 else "en", None if n % 4 == 0 else f"s{n % 2}", None, "x", 5, "y", 1) for n, (i, t) in enumerate(TEXTS)]
    return spark.createDataFrame(rows, DOC)


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


def tuples(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_sql_twin(spark, sf_dir, name):
    ok, message, _ = compare(spark, duck(sf_dir), sf_dir, queries.QUERIES[name], queries.ORACLE[name])
    assert ok, message


def test_simhash(docs):
    assert tuples(simhash.simhash_components(docs)) == brute.simhash_components(TEXTS)


def test_simhash_of_benchmark_documents(spark, sf_dir):
    texts = [tuple(r) for r in common.table(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    assert tuples(queries.op2_simhash(spark, sf_dir)) == brute.simhash_components(texts)


def test_simhash_empty(none):
    assert simhash.simhash_components(none).collect() == []


@pytest.mark.parametrize("max_rows", [2_000_000, 3_000])
def test_fingerprint_links_connect_exactly_the_close(spark, max_rows):
    rng = random.Random(5)
    prints = {0, 2**64 - 1}
    for _ in range(40):
        p = rng.getrandbits(64)
        for flips in (0, 1, 2, 3, 4, 5, 6):
            prints.add(p ^ sum(1 << b for b in rng.sample(range(64), flips)))
    signed = [p - (1 << 64) if p >= 1 << 63 else p for p in prints]
    links = simhash.fingerprint_links(spark.createDataFrame([(s,) for s in signed], "fp long"), max_rows=max_rows)
    got = {r.node: r.component for r in common.components(links).collect()}
    exact = brute.roots(signed, [(a, b) for n, a in enumerate(signed) for b in signed[:n] if ((a ^ b) & (2**64 - 1)).bit_count() <= 4])
    assert {s: got.get(s, s) for s in signed} == exact


def test_components_of_a_chain_a_star_and_a_loop(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (300, 299), (299, 301), (301, 300)]
    got = {r.node: r.component for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: v for k, v in brute.roots({x for e in edges for x in e}, edges).items() if k != v}


def test_components_without_edges(spark):
    assert common.components(spark.createDataFrame([(1, 1)], "a long, b long")).collect() == []


PAGES = [(1, "<p>a</p>"), (2, "<p>a</p>"), (3, None), (4, ""), (5, "é" * 20_000), (None, "<p>a</p>"), (6, "only"), (7, "twice"), (7, "twice")]


@pytest.mark.parametrize("least", [0, 9])
def test_warc(spark, least):
    pages = spark.createDataFrame([(i, f"http://h/{i}\r\nX: y" if i else None, h, 1, "k") for i, h in PAGES], "page_id long, url string, html string, id int, key string")
    archive = warc.write_archive(pages, min_revisit_bytes=least)
    page = lambda c: F.nullif(F.col(c), F.lit("null")).cast("long")
    records = warc.read_records(spark, archive, with_bytes=True)
    got = records.select(page("id"), "payload_bytes", "payload_digest", "record_type", page("refers_to"))
    assert tuples(got) == brute.warc(PAGES, least)
    assert spark.read.parquet(archive.payloads).count() == len({h or "" for _, h in PAGES})
    for r in records.collect():
        head, _, rest = bytes(r.record).partition(b"\r\n\r\n")
        block = b"" if r.record_type == "revisit" else bytes(r.payload)
        assert rest == block + b"\r\n\r\n" and f"Content-Length: {len(block)}".encode() in head
        assert head.startswith(b"WARC/1.1\r\nWARC-Type: ") and b"\nX:" not in head
    narrow = warc.read_records(spark, archive).select(page("id"), "payload_bytes", "payload_digest", "record_type", page("refers_to"))
    assert tuples(narrow) == brute.warc(PAGES, least)


def test_warc_empty(spark):
    archive = warc.write_archive(spark.createDataFrame([], "page_id long, url string, html string"))
    assert warc.read_records(spark, archive).collect() == []


def test_warc_query(spark, sf_dir):
    pages = [tuple(r) for r in common.table(spark, sf_dir, "pages").select("page_id", "html").collect()]
    assert tuples(queries.op3_warc(spark, sf_dir)) == brute.warc(pages)


SECRETS = [
    "password = hunter2222 and token:abc secret=token:abcdefgh API_KEY: 'abcdef' apikey=xyz123.",
    "AKIA" + "A1" * 8 + " AKIAX AKIA" + "B" * 30 + " deadbeef " + "0123456789abcdef" * 3,
    "é𝒳 token = \"" + "ab12" * 10 + "\" tail AKIA" + "C" * 16,
    "AKIA" + "Q" * 16 + " then " + "Zz9/" * 12 + " at https://host.example/x?y=1",
    "Zz9/" * 12 + " alone, postgres://u:p@h/db alone",
    "AKIA" + "Q" * 16 + " " + "w " * 300 + "Zz9/" * 12 + " far",
    "paſſword=abcdefgh toKen=abcdefgh",
    "password=" + "password=" * 50,
    None,
    "",
]


def test_secrets(spark):
    rows = [(n, t, "a", 1) for n, t in enumerate(SECRETS)] + [(3, SECRETS[3], "b", 2), (None, SECRETS[0], "c", 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string, base int")
    got = secrets.find_secrets(df).select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2(secrets.joined(F.col("base")), 256), secrets.joined(F.col("spans"))
    )
    assert tuples(got) == sorted(((i, *brute.secrets(t)) for i, t, _, _ in rows), key=str)
    assert secrets.find_secrets(df.limit(0)).collect() == []


def test_weak_parts_need_their_complement():
    assert "opaque:" in brute.secrets(SECRETS[3])[4] and "endpoint:" in brute.secrets(SECRETS[3])[4]
    assert brute.secrets(SECRETS[4])[4] == "" and "opaque:" not in brute.secrets(SECRETS[5])[4]


def test_secrets_plan_has_no_python(spark, sf_dir):
    plan = queries.op8_secrets(spark, sf_dir)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_masked(spark):
    text = "ab SECRET cd KEY ef"
    df = spark.createDataFrame([(text, [(3, 0, "x", 9), (5, 0, "x", 12), (13, 0, "x", 16)])], f"text string, s array<{secrets.SPAN}>")
    assert df.select(secrets.masked(F.col("text"), F.col("s"))).first()[0] == "ab [SECRET] [SECRET] ef"


@pytest.mark.parametrize("length, anchor", [(40, 20), (40, 5), (7, 7)])
def test_suffixes(docs, length, anchor):
    got = suffixes.remove_repeats(docs, length=length, anchor=anchor, batches=3)
    assert tuples(got) == sorted(((i, *r) for (i, _), r in zip(TEXTS, brute.repeats([t for _, t in TEXTS], length))), key=str)


def test_suffixes_in_pieces(docs, monkeypatch):
    datas = [t.encode() for _, t in TEXTS if t and len(t.encode()) >= 40]
    whole = [set(i for _, a, b, _ in suffixes.minimizers(d, 40, 20) for i in range(a, b + 1)) for d in datas]
    anchors = [{i: at for at, a, b, _ in suffixes.minimizers(d, 40, 20) for i in range(a, b + 1)} for d in datas]
    monkeypatch.setattr(suffixes, "PIECE", 64)
    for data, starts, at in zip(datas, whole, anchors):
        assert starts == set(range(len(data) - 39))
        assert {i: p for p, a, b, _ in suffixes.minimizers(data, 40, 20) for i in range(a, b + 1)} == at


def test_suffixes_of_benchmark_documents(spark, sf_dir):
    texts = [tuple(r) for r in common.table(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    expected = sorted(((i, *r, r[1] > 0) for (i, _), r in zip(texts, brute.repeats([t for _, t in texts]))), key=str)
    assert tuples(queries.op9_suffixes(spark, sf_dir)) == expected


def test_suffixes_empty(none):
    assert suffixes.remove_repeats(none).collect() == []


def test_suffix_levels_double(spark):
    family, met = suffixes.SuffixFamily(), []
    for b in range(5):
        rows = [(b, 1, b, b, 0, 0, 0), (100, 1, b, b, 9, 0, 0), (100, 1, b, b, 50, 0, 0), (200 + b // 4, b, b, b, 0, 0, 0)]
        entries = spark.createDataFrame(rows, "head long, stretch long, k1 long, k2 long, first int, lead int, reach int")
        met.append({r[0] for r in family.add(entries).collect()})
    assert [rank for rank, _ in family.levels] == [2, 0]
    assert met == [{100}, {100, 200}, {100, 200}, {100, 200}, {100}]
    heads = spark.createDataFrame([(100,)], "head long")
    assert [(r.head, r.n) for r in family.classes(heads).collect()] == [(100, 10)]


@pytest.mark.parametrize("parts", [2, 3])
def test_stored_suffix_family_finds_what_new_texts_repeat(spark, tmp_path, parts):
    texts = [(i, t) for i, t in enumerate(dict.fromkeys(t or "" for _, t in TEXTS))]
    texts += [(100 + i, t[5:] + "!") for i, t in texts if len(t) > 100][:5]
    kinds = "doc_id long, text string"
    everything = suffixes.keyed_texts(spark.createDataFrame(texts, kinds))
    seen: list = []
    for part in range(parts):
        new = [t for t in texts if t[0] % parts == part]
        seen += new
        family = suffixes.SuffixFamily.open(spark, str(tmp_path / f"family-{part - 1}")) if part else suffixes.SuffixFamily()
        keyed = spark.createDataFrame(new, kinds).select("*", F.xxhash64(F.lit("id"), F.col("doc_id").cast("string")).alias("k1"))
        spans = suffixes.add_batch(family, suffixes.keyed_texts(keyed), everything, 40, 20)
        covered: dict = {}
        for r in spans.join(keyed, "k1").select("doc_id", "start", "end").collect():
            covered.setdefault(r[0], set()).update(range(r[1], r[2]))
        expected = dict(zip([i for i, _ in seen], brute.repeats([t for _, t in seen], 40)))
        assert {i: len(covered.get(i, ())) for i, _ in new} == {i: expected[i][1] for i, _ in new}
        family.save(str(tmp_path / f"family-{part}"))
    assert any(n for _, n, *_ in expected.values())
    stored = spark.read.parquet(str(tmp_path / "family-0"))
    assert stored.count() and set(stored.columns) == {*suffixes.CLASS, *suffixes.PLACE, "n", "rank"}
    with pytest.raises(ValueError):
        suffixes.SuffixFamily().save(str(tmp_path / "none"))


def test_suffix_hashes_tell_strings_apart():
    rng = random.Random(4)
    data = bytes(rng.choice(b"ab") for _ in range(3000)) + b"ab" * 700 + b"a" * 900
    by_hash: dict = {}
    for base, _, first, last, _, stretch in suffixes._entries(data, 40, 20):
        for a, b, h in zip(first.tolist(), last.tolist(), stretch.tolist()):
            by_hash.setdefault(h, set()).add(data[base + a : base + b + 40])
    assert len(by_hash) > 100 and all(len(v) == 1 for v in by_hash.values())


def test_tiling(spark):
    item = prose(40, 9).split()
    moved = " ".join(item[20:] + ["between"] + item[:20])
    partial = prose(50, 11) + " " + " ".join(item[:12])
    docs = [(1, moved.upper()), (2, partial), (3, None), (4, ""), (5, "%% ".join(item)), (1, moved.upper()), (None, " ".join(item)), (6, prose(3000, 12))]
    df = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, item int, covered string")
    items = spark.createDataFrame([(7, " ".join(item)), (8, None), (9, "too short"), (None, prose(10, 13))], "item_id long, text string")
    got = tiling.contaminated(df, items).select("k1", "item", "n_tiles", "covered", "item_tokens")
    assert tuples(got) == sorted([(1, 7, 2, 40, 40), (5, 7, 1, 40, 40), (None, 7, 1, 40, 40)], key=str)
    assert tiling.contaminated(df.limit(0), items).collect() == [] and tiling.contaminated(df, items.limit(0)).collect() == []


def greedy(doc, item, k):
    """Covered tokens by trying all matches, longest first."""
    used_d, used_i, covered = set(), set(), 0
    while True:
        best = None
        for i in range(len(item)):
            for d in range(len(doc)):
                n = 0
                while i + n < len(item) and d + n < len(doc) and item[i + n] == doc[d + n] and i + n not in used_i and d + n not in used_d:
                    n += 1
                if n >= k and (best is None or n > best[0]):
                    best = (n, i, d)
        if best is None:
            return covered
        n, i, d = best
        used_i.update(range(i, i + n))
        used_d.update(range(d, d + n))
        covered += n


def test_tiles_equal_brute_force():
    rng = random.Random(3)
    for _ in range(60):
        item, doc = [rng.randrange(4) for _ in range(25)], [rng.randrange(4) for _ in range(60)]
        pairs = [(d, i) for d in range(58) for i in range(23) if doc[d : d + 3] == item[i : i + 3]]
        assert sum(t[2] for t in tiling.tiles(pairs, 3)) == greedy(doc, item, 3)


def test_mixing_handles_odd_rows(docs, none):
    rows = mixing.mix_documents(docs).collect()
    assert len(rows) == len(TEXTS) and all(0 <= r.taken <= 2 * r.size for r in rows)
    by = {}
    for r in rows:
        by.setdefault((r.source_size, r.target), []).append(r.taken)
    assert all(abs(sum(v) - t) < 1 for (_, t), v in by.items())
    assert mixing.mix_documents(none).collect() == []
    key = lambda x: sorted(map(str, x))
    assert key(mixing.mix_documents(docs.repartition(7)).collect()) == key(rows)


def test_targets_equal_a_loop(spark):
    rng = random.Random(4)
    sizes = {f"s{n:02d}": rng.choice([0, 1, 10, 1000, 100_000]) * rng.randrange(1, 9) for n in range(23)} | {None: 77}
    names = sorted(k for k in sizes if k) + [None]
    weight = {s: float((5, 2, 1)[n % 3]) for n, s in enumerate(names)}
    budget, target, open_ = 1.5 * sum(sizes.values()), {}, set(names)
    while True:
        level = (budget - sum(target.values())) / sum(weight[s] for s in open_)
        full = [s for s in open_ if level * weight[s] > 2 * sizes[s]]
        if not full:
            break
        target |= {s: 2.0 * sizes[s] for s in full}
        open_ -= set(full)
    target |= {s: level * weight[s] for s in open_}
    got = mixing.source_targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()
    assert {r.source: pytest.approx(r.target) for r in got} == target


def unit(v):
    return [float(x) for x in np.asarray(v) / np.linalg.norm(v)]


def test_embeddings(spark):
    rng = np.random.default_rng(0)
    rows, n = [], 0
    for _ in range(60):
        centre = rng.normal(size=32)
        for _ in range(rng.integers(1, 6)):
            rows.append((n, unit(centre + rng.normal(size=32) * 0.08), int(rng.integers(2))))
            n += 1
    rows += [(n + i, rows[0][1], rows[0][2]) for i in range(5)]  # copies
    rows += [(n + 10, None, 1), (n + 11, [0.0] * 32, 1), (n + 12, [float("nan")] * 32, 1), (n + 13, [None] * 32, 1), (n + 14, rows[1][1], None)]
    rows += [(n + 15, [2.0 * x for x in rows[0][1]], rows[0][2]), (n + 16, [], 1), (n + 17, [1.0, 0.0], 1), (n + 18, [1.0, 0.0], 1), (n + 19, [float("inf")] * 32, 1)]
    sound = [r for r in rows if r[1] and r[2] is not None and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1])]
    cosine = lambda a, b: float(np.dot(a, b) / np.linalg.norm(a) / np.linalg.norm(b))
    links = [(a[0], b[0]) for i, a in enumerate(sound) for b in sound[:i] if a[2] == b[2] and len(a[1]) == len(b[1]) and cosine(a[1], b[1]) >= 0.98]
    root = brute.roots([r[0] for r in rows], links)
    exact = sorted(((i, sum(i in x for x in links), root[i], root[i] == i) for i, _, _ in rows), key=str)
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<double>, label int, dim int, h1 string")
    assert tuples(embeddings.near_duplicates(df)) == exact
    assert tuples(embeddings.near_duplicates(df, block=8)) == exact
    assert embeddings.near_duplicates(df.limit(0)).collect() == []


def test_embedding_recall(spark, sf_dir):
    rows = common.table(spark, "/root/testdata/sf0.1" if os.path.isdir("/root/testdata/sf0.1") else sf_dir, "embeddings").toPandas()
    planted = rows.sample(200, random_state=1)
    noise = np.random.default_rng(2).normal(size=(200, len(rows.embedding[0]))) * 0.018
    more = planted.assign(vec_id=planted.vec_id + 10**6, embedding=[unit(v + e) for v, e in zip(planted.embedding, noise)])
    both = [(int(r.vec_id), [float(x) for x in r.embedding], int(r.label)) for r in [*rows.itertuples(), *more.itertuples()]]
    x = np.array([b[1] for b in both])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([b[2] for b in both])
    exact = ((x @ x.T >= 0.98) & (label[:, None] == label[None, :])).sum() - len(both)
    got = embeddings.near_duplicates(spark.createDataFrame(both, "vec_id long, embedding array<double>, label int"))
    found = got.agg(F.sum("n_links")).first()[0]
    assert exact > 100 and 0.9 * exact <= found <= exact


@pytest.mark.parametrize("share", [1 / 3, 1.0])
def test_embedding_recall_in_one_large_cluster(spark, share):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(1500, 64))
    near = int(share * len(x))
    noise = rng.normal(size=(near, 64))
    x[:near] = unit(rng.normal(size=64)) + noise / np.linalg.norm(noise, axis=1, keepdims=True) * 0.12
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    exact = (x @ x.T >= 0.98).sum() - len(x)
    df = spark.createDataFrame([(n, unit(v), 1) for n, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    found = embeddings.near_duplicates(df).agg(F.sum("n_links")).first()[0]
    assert exact > 0.9 * near * (near - 1) and 0.9 * exact <= found <= exact


def test_language(spark, sf_dir):
    docs = common.table(spark, "/root/testdata/sf0.01" if os.path.isdir("/root/testdata/sf0.01") else sf_dir, "documents")
    part = F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0
    model = language.fit(docs.where(~part))
    got = language.identify(docs.where(part), model, F.col("text"), host=F.col("source"), keep=["doc_id", "lang"])
    cols = [c.alias(n) for c, n in zip([F.col("doc_id"), F.col("`lang`")], ["doc_id", "x"])]
    assert len(cols) == 2 and model.langs == ("de", "en", "es", "fr")
    rows = language.identify(docs.where(part).withColumnRenamed("lang", "truth"), model, F.col("text"), host=F.col("source"), keep=["truth"]).collect()
    assert len(rows) == docs.where(part).count() and sum(r.truth == r.text_lang for r in rows) >= 0.98 * len(rows)
    assert sum(r.truth == r.lang for r in rows) >= 0.98 * len(rows) and not any(r.rejected for r in rows)
    assert got.count() == len(rows)


def test_language_evidence(spark):
    train = spark.createDataFrame([("the and of to in", "en")] * 3 + [("der die und das ist", "de")] * 3 + [("x", None), (None, "fr")], "text string, lang string")
    model = language.fit(train)
    rows = [(0, "und das", "de", "a.example.de")] * 8 + [(1, "qqq", "de-DE", "a.example.de"), (2, None, "de", "a.example.de"), (3, "", None, None), (4, "12 34 !!", None, "b.example.de"), (5, "the of", None, None)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "n long, text string, decl string, host string, posterior string, _x int")
    got = language.identify(df, model, F.col("text"), F.col("decl"), F.col("host"), keep=["n"]).collect()
    by = {r.n: r for r in got}
    assert len(got) == len(rows) and by[0].lang == "de" and by[5].lang == "en"
    assert by[1].lang == "de" and by[1].posterior > by[1].text_posterior  # host and declaration decide
    assert by[2].rejected and by[3].rejected and by[4].rejected and by[4].lang == "de" and not by[1].rejected
    assert language.identify(df.limit(0), model, F.col("text"), keep=["n"]).collect() == []
    blank = language.fit(train.limit(0))
    assert all(r.rejected and r.lang is None for r in language.identify(df, blank, F.col("text"), keep=["n"]).collect())


def test_language_rejects_what_is_in_none(spark, sf_dir):
    model = language.fit(common.table(spark, "/root/testdata/sf0.01" if os.path.isdir("/root/testdata/sf0.01") else sf_dir, "documents"))
    rng = random.Random(1)
    noise = " ".join("".join(rng.choice("bcdfghjklmnpqrstvwxz") for _ in range(rng.randrange(2, 9))) for _ in range(40))
    foreign = [
        "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem.",
        "Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar. Akıl ve vicdana sahiptirler ve birbirlerine karşı.",
        "Όλοι οι άνθρωποι γεννιούνται ελεύθεροι και ίσοι στην αξιοπρέπεια και τα δικαιώματα.",
        "すべての人間は、生まれながらにして自由であり、かつ、尊厳と権利とについて平等である。",
        noise,
    ]
    listed = {
        "en": "All human beings are born free and equal in dignity and rights. They are endowed with reason and conscience.",
        "de": "Alle Menschen sind frei und gleich an Würde und Rechten geboren. Sie sind mit Vernunft und Gewissen begabt.",
        "fr": "Tous les êtres humains naissent libres et égaux en dignité et en droits. Ils sont doués de raison et de conscience.",
        "es": "Todos los seres humanos nacen libres e iguales en dignidad y derechos y, dotados como están de razón y conciencia.",
    }
    df = spark.createDataFrame([(None, t) for t in foreign] + list(listed.items()), "truth string, text string")
    for r in language.identify(df, model, F.col("text"), keep=["truth"]).collect():
        assert r.rejected == (r.truth is None) and r.truth in (None, r.lang)


def test_page_parts(spark):
    html = "<!DOCTYPE html><HTML class=x lang='fr-CA'><script>var lang='de'</script><body>Bon&nbsp;jour<!-- no --></body>"
    df = spark.createDataFrame([(html, "https://u@WWW.Example.co:80/x"), (None, None), ("<p>", "mailto:x")], "html string, url string")
    got = df.select(F.trim(language.page_text(F.col("html"))), language.page_declared(F.col("html")), language.page_host(F.col("url"))).collect()
    assert [tuple(r) for r in got] == [("Bon jour", "fr-CA", "www.example.co"), ("", None, None), ("", None, None)]


def test_url_lists(spark):
    events = [
        ("block", "bad.example", "add", 10), ("block", "bad.example", "remove", 20), ("block", "bad.example", "add", 30),
        ("allow", "ok.bad.example", "add", 0), ("block", "site.example/x/", "add", 5), ("block", "site.example/x/", "remove", 5),
        ("block", "dup.example", "add", 1), ("block", "dup.example", "add", 1), (None, "a", "add", 1), ("block", None, "add", 1), ("block", "c", None, 1), ("block", "c", "add", None),
    ]
    captures = [
        (1, "http://bad.example/", 9), (2, "http://bad.example/", 10), (3, "http://www.bad.example/a", 19), (4, "http://bad.example", 20),
        (5, "http://BAD.example", 1000), (6, "http://ok.bad.example/", 15), (7, "http://site.example/x/y", 6), (8, None, 1), (9, "nonsense", 1),
        (10, "http://dup.example", None), (11, "http://dup.example", 500), (11, "http://dup.example", 500), (None, "http://dup.example", 2),
    ]
    df = spark.createDataFrame([(*c, "x", 1) for c in captures], "page_id long, url string, fetched long, decision string, row int")
    ev = spark.createDataFrame(events, "list string, pattern string, action string, at long")
    got = url_lists.evaluate(df, ev).select("page_id", "n_active", "decision").collect()
    expected = {(1, 0, "none"), (2, 1, "block"), (3, 1, "block"), (4, 0, "none"), (5, 1, "block"), (6, 2, "allow"), (7, 0, "none"),
                (8, 0, "none"), (9, 0, "none"), (10, 0, "none"), (11, 1, "block"), (None, 1, "block")}
    assert {tuple(r) for r in got} == expected and len(got) == len(captures)
    assert url_lists.evaluate(df.limit(0), ev).collect() == []
    assert {r.decision for r in url_lists.evaluate(df, ev.limit(0)).collect()} == {"none"}


def test_toxicity_held_out(spark, sf_dir):
    big = "/root/testdata/sf0.1" if os.path.isdir("/root/testdata/sf0.1") else sf_dir
    docs, labels = common.table(spark, big, "documents"), common.table(spark, big, "labels")
    got = toxicity.score_documents(docs, toxicity.fit(docs, labels)).where("held_out").join(labels, "doc_id").collect()
    hit = sum(r.predicted == 1 for r in got if r.toxic) / max(1, sum(r.toxic for r in got))
    false = sum(r.predicted == 1 for r in got if not r.toxic) / max(1, sum(not r.toxic for r in got))
    assert hit >= 0.85 and false <= 0.02


def labelled(spark, rows):
    """Documents and labels of (text, toxic) rows."""
    df = spark.createDataFrame([(n, t, x) for n, (t, x) in enumerate(rows)], "doc_id long, text string, toxic int")
    return df.select("doc_id", "text"), df.select("doc_id", "toxic")


def insults():
    """900 toxic texts, of which each of 50 terms is in 2 %, and 2,100 harmless ones."""
    rows = [(prose(30, 10_000 + n) + f" {term(n % 50)} " + prose(30, 20_000 + n), 1) for n in range(900)]
    return rows + [(prose(60, 30_000 + n), 0) for n in range(2_100)]


def term(n):
    rng = random.Random(n)
    return "".join(rng.choice("bdfgkmprstvz") + rng.choice("aeiou") for _ in range(5))


def test_toxicity_learns_rare_terms_whatever_is_copied(spark):
    rows, terms = insults(), {term(n) for n in range(50)}
    base = prose(200, 7) + " oddity rarity " + prose(200, 8)
    near = [(base.replace(" ", f" extra{n} ", 1), 1) for n in range(60)]
    plain = toxicity.fit(*labelled(spark, rows)).words
    copied = toxicity.fit(*labelled(spark, rows + rows[:1] * 1_500 + near)).words
    for words in (plain, copied):
        assert len(terms & set(words)) >= 45 and len(set(words) - terms) <= 2
    assert not {"oddity", "rarity"} & set(copied)


def test_toxicity_weights_without_hits_give_the_share_of_toxic_texts():
    for toxic in (10, 50, 90):
        points = np.array([[0.0, 0.0, 40, n < toxic] for n in range(100)], float)
        bias, *rest = toxicity._logistic(points)
        assert abs(1 / (1 + np.exp(-bias)) - toxic / 100) < 0.02 and np.allclose(rest, toxicity.PRIOR[1:])


def test_toxicity_sample_bounds_texts_of_repeated_ids(spark, monkeypatch):
    docs, labels = labelled(spark, insults()[:400] + insults()[-400:])
    again = docs.withColumn("text", F.concat("text", F.lit(" once more")))
    sizes: dict = {}
    monkeypatch.setattr(toxicity, "stage", lambda df, name: sizes.setdefault(name, []).append(df.count()) or common.stage(df, name))
    toxicity.fit(docs.unionByName(again), labels, sample_docs=300)
    assert sizes["toxicity-sample"] == [300] and sizes["toxicity-drawn"] == [600]
    sizes.clear()
    toxicity.fit(docs, labels, sample_docs=300)
    assert sizes["toxicity-sample"] == sizes["toxicity-drawn"] == [300]


def test_toxicity_of_terms_that_harmless_texts_quote(spark):
    rows, terms = insults(), [term(n) for n in range(10)]
    rows = [(t.replace(term(20), terms[0] + "t"), x) for t, x in rows]
    # terms of common use: a tenth of toxic texts; harmless texts quote them, and one has a misspelling, one a wrong label
    rows = [(f"{prose(20, 5 * n)} {terms[n % 10]} {t}" if x else t, x) for n, (t, x) in enumerate(rows)]
    rows += [(f'{prose(20, 70_000 + n)} they said "{terms[n % 10]}" to us {prose(20, 80_000 + n)}', 0) for n in range(300)]
    rows += [(f'{prose(20, 91_000 + n)} they said "{terms[0]}t" to us', 0) for n in range(3)] + [(prose(20, 95_000 + n) + f" {terms[0]}t", 0) for n in range(2)]
    model = toxicity.fit(*labelled(spark, rows))
    assert set(terms) <= set(model.words) and terms[0] + "t" not in model.harmless
    score = toxicity.Scorer(model).score
    assert score(f"you {terms[0]}t and you {terms[3]}")[1] > 0
    assert score(f"you {terms[3]} of {prose(10, 1)}")[0] > score(f'they said "{terms[3]}" of {prose(10, 1)}')[0]


def test_toxicity_scores():
    model = toxicity.Model(words={"wretch": 1.0, "scoundrel": 1.0}, stems={"vill": 1.0}, harmless=frozenset({"wrench"}))
    score = toxicity.Scorer(model).score
    assert score("")[1:] == (0.0, 0.0) and score("a wrench and a bench")[1] == 0.0
    assert score("you wretch")[1] == 1.0 and score("you wretchh")[1] == 0.8 and score("scoundrle")[1] == 0.0 and score("scondrel")[1] == 0.8
    assert score("villainous")[1] == 1.0
    assert score('they said "wretch" then')[1:] == (0.0, 1.0)
    assert score("wretch scoundrel")[0] > score("wretch")[0] > score("")[0]


def test_automaton_finds_what_distances_find():
    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, last = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        return row[-1]

    rng = random.Random(1)
    terms = ["".join(rng.choice("abc") for _ in range(rng.randrange(5, 8))) for _ in range(30)]
    trie = toxicity.Trie(terms)
    for _ in range(2000):
        token = "".join(rng.choice("abc") for _ in range(rng.randrange(4, 9)))
        near = [t for t in terms if distance(token, t) <= 1]
        assert (trie.near(token) is not None) == bool(near)


def test_toxicity_odd_rows(docs, none, spark):
    labels = spark.createDataFrame([(0, 1), (0, 0), (None, 1), (1, None), (2, 0)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    got = toxicity.score_documents(docs, model).collect()
    assert len(got) == len(TEXTS) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert toxicity.score_documents(none, model).collect() == []
    assert toxicity.fit(none, labels).words == {} and toxicity.fit(docs, labels.limit(0)).words == {}

"""Many matches in one text, and benchmark items of odd ids and lengths."""

import random
import time
import tracemalloc

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from recordqa.llm import queries, secrets, simhash, tiling


def test_many_matches_in_one_text_take_less_than_quadratic_time(spark):
    rng = random.Random(2)

    def text(n):
        kinds = ["password: abcdef%06d" % n, "%032x" % rng.getrandbits(128), "AKIA" + "B" * 16, "Zz9/" * 12, "https://h.example/x"]
        return " ".join(rng.choice(kinds) for _ in range(n))

    took = {}
    for n in (10, 5_000, 50_000):
        t = text(n)
        df = spark.createDataFrame([(1, t)], "doc_id long, text string")
        began = time.perf_counter()
        got = secrets.find_secrets(df).select("n_assign", "n_access", "n_hex", F.sha2(secrets.joined(F.col("base")), 256), secrets.joined(F.col("spans"))).first()
        took[n] = time.perf_counter() - began
        if n <= 5_000:
            assert tuple(got) == brute.secrets(t)
        else:
            assert got[0] + got[1] + got[2] > 25_000
    assert took[50_000] < 40 * max(took[5_000], 1.0)


def test_opaque_parts_that_a_base_finding_touches_are_left_out(spark):
    texts = ["AKIA" + "Q" * 16 + " token=" + "Zz9/" * 12, "AKIA" + "Q" * 16 + " " + "Zz9/" * 12, "a" * 30 + "Z" * 40 + " AKIA" + "Q" * 16, None]
    df = spark.createDataFrame(list(enumerate(texts)) + [(1, texts[1])], "doc_id long, text string")
    got = {(r.doc_id, r.s) for r in secrets.find_secrets(df).select("doc_id", secrets.joined(F.col("spans")).alias("s")).collect()}
    assert got == {(n, brute.secrets(t)[4]) for n, t in enumerate(texts)}


def test_items_keep_the_type_of_their_ids_and_short_ones_are_found_whole(spark):
    items = spark.createDataFrame(
        [("q-1", "one two three four five six seven"), ("q-2", "what is it"), ("q-3", "Paris"), ("q-4", ""), ("q-5", None), (None, "nine ten")], "item_id string, text string"
    )
    docs = [(1, "so one two three four five six seven here"), (2, "What is it? it is"), (3, "is it what"), (4, "paris"), (5, "x nine, TEN x"), (6, None)]
    got = tiling.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), items)
    assert sorted(((r.k1, r.item, r.n_tiles, r.covered, r.coverage) for r in got.collect()), key=str) == [
        (1, "q-1", 1, 7, 1.0), (2, "q-2", 1, 3, 1.0), (4, "q-3", 1, 1, 1.0), (5, None, 1, 2, 1.0),
    ]
    assert "op10_tiling" in queries.QUERIES


@pytest.mark.parametrize("alike", [True, False])
def test_a_crowded_head_is_linked_whole_in_bounded_memory(alike):
    rng = random.Random(4)
    centre = rng.getrandbits(48)
    if alike:
        low = {centre ^ sum({1 << rng.randrange(48) for _ in range(3)}) for _ in range(3_000)}
    else:
        low = {c ^ 1 << rng.randrange(48) for c in (rng.getrandbits(48) for _ in range(500)) for _ in range(6)}
    prints = np.array(sorted(low), np.uint64)
    n = len(prints)
    tracemalloc.start()
    found = list(simhash._meet(np.zeros(n, np.int32), prints, np.zeros(n, np.int8), 48, 2, 20_000))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    got = brute.roots(prints.tolist(), [(a, b) for x, y in found for a, b in zip(x.tolist(), y.tolist())])
    near = np.argwhere(np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 4)
    assert got == brute.roots(prints.tolist(), [(int(prints[a]), int(prints[b])) for a, b in near if a < b])
    assert sum(len(x) for x, _ in found) < n
    assert peak < 12_000_000  # all variants at once would take n * 1,177 * 16 bytes, 30 MB and more


def test_fingerprints_of_odd_texts():
    odd = [None, "", " \t\n", "A", " a b  c ", "a b c d", "\x0ba b c d e\x0c", "É Ä b\xa0c \x1c d \x85 e", "x\x00 y z w v", "😀 😀 😀 😀 A"]
    long = " ".join(random.Random(1).choice(["Ab", "c", "dé", "e  f"]) for _ in range(simhash.CHUNK + 5_000))
    for text in [*odd, long]:
        assert simhash.fingerprint(text) == brute.simhash(text), text


def test_an_odd_distance_is_refused(spark):
    with pytest.raises(ValueError, match="even"):
        simhash.fingerprint_links(spark.createDataFrame([(1,)], "fp long"), max_bits=3)


def test_runs_by_place_tile_like_runs_of_pairs():
    rng = random.Random(8)
    for k in (1, 2, 3):
        for _ in range(80):
            item, doc = [rng.randrange(3) for _ in range(rng.randrange(k, 20))], [rng.randrange(3) for _ in range(50)]
            seeds = lambda t: [tuple(t[n : n + k]) for n in range(len(t) - k + 1)]
            first = {s: seeds(item).index(s) for s in seeds(item)}
            hits = [{"place": first[s], "dpos": d} for d, s in enumerate(seeds(doc)) if s in first]
            pairs = [(d, i) for d, a in enumerate(seeds(doc)) for i, b in enumerate(seeds(item)) if a == b]
            got = tiling.greedy(tiling.diagonal_runs(tiling._by_place(hits), [first[s] for s in seeds(item)]), k)
            assert sorted(got) == tiling.tiles(pairs, k)


def test_one_token_repeated_in_both_texts_is_not_multiplied(spark):
    items = spark.createDataFrame([(1, "la " * 60), (2, "la " * 20 + "lo"), (3, "la la la")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "la " * 200_000), (2, "la la lo"), (3, "la " * 12)], "doc_id long, text string")
    began = time.perf_counter()
    got = {(r.k1, r.item, r.covered) for r in tiling.contaminated(docs, items).collect()}
    assert got == {(1, 1, 60), (1, 2, 20), (1, 3, 3), (3, 2, 12), (3, 3, 3)}
    assert time.perf_counter() - began < 60

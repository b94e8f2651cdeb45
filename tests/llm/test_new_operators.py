"""Filter audit, conversation trie and personal data against plain Python."""

import itertools
import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from recordqa.llm import conversation_trie as trie, filter_audit, personal_data as pii, queries
from recordqa.llm.common import table


def tuples(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# --- filter audit

PROSE = " ".join(f"w{n}" for n in range(120))
AUDIT = [
    (1, PROSE, "en"), (2, PROSE, "de"), (2, PROSE, "de"), (3, PROSE + " #", "en"), (4, "w " * 150, "en"), (5, PROSE.upper(), None),
    (6, None, None), (7, "", ""), (None, PROSE, "en"), (None, "", "en"), (8, "SHORT *", "fr"), (9, "x" * 300_000, "en"), (10, "W " * 150 + "$", "fr"),
    (11, "ÄÖ " * 60 + "a b", "de"), (1, PROSE + " other", "en"),
]
LABELS = [(1, 1, 0), (2, 1, 1), (2, 0, 1), (4, None, 1), (6, 1, None), (None, 1, 1), (8, 0, 0), (99, 1, 1)]
DOC = "doc_id long, text string, lang string, mask int, digest string, part string, n long"
LABEL = "doc_id long, quality int, toxic int, part string, n long"


def test_audit(spark):
    docs = spark.createDataFrame([(*r, 1, "d", "p", 2) for r in AUDIT], DOC)
    labels = spark.createDataFrame([(*r, "p", 3) for r in LABELS], LABEL)
    assert tuples(filter_audit.audit(docs, labels)) == brute.filter_audit(AUDIT, LABELS)
    none = filter_audit.audit(docs, labels.limit(0))
    assert tuples(none) == brute.filter_audit(AUDIT, [])
    assert filter_audit.audit(docs.limit(0), labels).collect() == []


def test_removal_step_is_the_first_failing_place():
    rng = np.random.default_rng(3)
    fails = rng.random((50, 5)) < 0.4
    orders, positions = filter_audit.orders_of(5)
    assert len(orders) == 120 and all(positions[o[s], n] == s for n, o in enumerate(orders) for s in range(5))
    steps = filter_audit.removal_steps(fails, positions)
    for c, n in itertools.product(range(50), range(120)):
        assert steps[c, n] == next((s for s, f in enumerate(orders[n]) if fails[c, f]), 5)


# --- conversation trie

TURN = "conv_id long, turn int, role string, text string, base long, path string, key string"


def talks(seed, n=60):
    rng = random.Random(seed)
    rows = []
    for c in [*range(n), 100, 101, 205, 300, 301, 399, -1, -5, -100, 7000]:
        for t in range(rng.choice([0, 1, 2, 3, 5, 8])):
            rows.append((c, t, rng.choice(["user", "assistant"]) if t else "user", rng.choice(["hi", "", "café \U0001f600", "long " * 9])))
    rows += [(500 + c, t, "user", f"same {t}") for c in range(40) for t in range(6)]  # copies
    rows += [(800, t, "user", f"deep {t % 3}") for t in range(300)] + [(900, t, "user", f"deep {t % 3}") for t in range(299)]
    rows += [(1, None, None, None), (1, None, "a", "tie"), (1, None, "a", "tie"), (2, 0, "user", "hi"), (None, 0, "user", "lost")]
    return rows


@pytest.mark.parametrize("block, spines", [(4 << 20, 4096), (600, 2)])
def test_trie(spark, monkeypatch, block, spines):
    monkeypatch.setattr(trie, "BLOCK_BYTES", block)
    monkeypatch.setattr(trie, "SPINES", spines)
    monkeypatch.setattr(trie, "PIECE_BYTES", 30 if spines == 2 else 1 << 18)
    rows = talks(1)
    turns = spark.createDataFrame([(*r, 1, "p", "k") for r in rows], TURN)
    assert tuples(trie.prefix_trie(trie.respliced(turns))) == brute.prefix_trie(rows)


def test_trie_of_little(spark):
    turns = spark.createDataFrame([(1, 0, "user", "hi", 1, "p", "k")], TURN)
    assert tuples(trie.prefix_trie(trie.respliced(turns))) == brute.prefix_trie([(1, 0, "user", "hi")])
    assert trie.prefix_trie(trie.respliced(turns.limit(0))).collect() == []


def test_trie_of_benchmark_conversations(spark, sf_dir):
    rows = [tuple(r) for r in table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert tuples(queries.op12_conversation_trie(spark, sf_dir)) == brute.prefix_trie(rows)


# --- personal data

PLAIN = [
    "mail jane.doe+x@example.co.uk, a@b.c%d@e.f x@y @a.b a@@b.c", "1.2.3.4.5.6.7.8 256.1.1.1 00.0.0.0255 1.2.3 1.2.3.4", "4111 1111 1111 1111 4111-1111-1111-1112",
    "+1 (743) 555-3824 +12 345 +1((((9 ++49 30 1234567 x", "9" * 30, None, "", "١.٢.٣.٤ café@example.com \U0001f600 1.1.1.1", "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7 8 9 0",
]


def test_base_patterns_are_found_as_stated():
    rng = random.Random(8)
    texts = PLAIN + ["".join(rng.choice("ab1290..@@+- ()%é") for _ in range(400)) for _ in range(300)]
    for t in texts:
        base, _ = pii.identifiers(t or "")
        counts = [sum(k == n for k, _, _ in base) for n in range(4)]
        assert (*counts, pii.hashlib.sha256(pii.joined(base).encode()).hexdigest()) == brute.personal_data(t), t


DISGUISED = {
    "email": [
        "jane (at) example [dot] com", "jane at example dot com", "joe [AT] mail.example.org", "joe@example dot co dot uk", "ｊane＠ｅxample．com",
        "jane​@exam­ple.com", "jоe@exаmple.com", "hans klammeraffe beispiel punkt de", "ana arroba ejemplo punto es",
    ],
    "ip": ["10[.]0[.]0[.]1", "192 dot 168 dot 1 dot 10", "one nine two dot one six eight dot one dot one", "1O.0.0.l2"],
    "card": ["four one one one one one one one one one one one one one one one", "4lll-1111-1111-1111", "４111 1111 1111 1111"],
    "phone": ["plus four nine one five one two three four five six seven", "+1 five five five 123 4567 0", "＋1 743 555 3824", "+49–151–1234567"],
}


@pytest.mark.parametrize("kind, source", [(k, s) for k, all_of in DISGUISED.items() for s in all_of])
def test_disguises_map_back_to_their_source(kind, source):
    for before, after in (("", ""), ("see é\U0001f600 ", " , please"), ("one​ two zero (", ") dot")):
        text = before + source + after
        base, added = pii.identifiers(text)
        assert (pii.KINDS.index(kind), len(before), len(before) + len(source)) in added, text
        assert pii.redacted(text, base + added).startswith(before + f"[{kind.upper()}]")


def test_prose_is_left_alone():
    for t in [
        "See us at example.com today.", "We looked at the dot on it.", "Meet me at nine. One two three four five.", "It rose 3 point 5 percent at the point of sale.",
        "un deux trois, nous allons au bois", "version 1.2.3 at 10.30", "a (b) [c] {d} at (the) dot", "Null, eins, zwei und drei Punkte.",
    ]:
        assert pii.identifiers(t) == ([], []), t


def test_offsets_survive_many_steps():
    rng = random.Random(4)
    pieces = ["jane (at) ex.com", "x", "é", "​", " one two ", "１", "[.]", " dot ", "plus 1", "\U0001f600", "1O1", " (at) "]
    for _ in range(400):
        text = "".join(rng.choice(pieces) for _ in range(12))
        tape = pii.normalise(text)
        for i in range(len(tape.text)):
            at, to = tape.source(i, i + 1)
            assert 0 <= at < to <= len(text)
            if to - at == 1 and tape.text[i].isalpha() and tape.text[i].isascii():
                assert text[at].translate(pii.look_alikes()) == tape.text[i]


@pytest.mark.parametrize("unit", ["a", "1", " ", "+1", "1 ", "@a.", "a@b.c ", "one ", "1.", "( ", " dot", "a at b ", "éа", "l1"])
def test_very_long_texts_take_linear_time(unit):
    import time

    began = time.process_time()
    pii.identifiers(unit * (500_000 // len(unit)))
    assert time.process_time() - began < 10


def test_personal_data(spark):
    rows = [(n if n % 4 else None, t) for n, t in enumerate([*PLAIN, *DISGUISED["email"], PLAIN[0]])]
    docs = spark.createDataFrame([(*r, "x", 1, "s") for r in rows], "doc_id long, text string, id string, n_email int, spans string")
    got = tuples(pii.find_personal_data(docs).select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256"))
    assert got == sorted(((i, *brute.personal_data(t)) for i, t in rows), key=str)
    whole = pii.find_personal_data(docs, with_text=True)
    assert whole.where("spans LIKE 'email:%' AND redacted LIKE '%[EMAIL]%'").count() == 11
    assert pii.find_personal_data(docs.limit(0)).collect() == []


def test_personal_data_of_benchmark_documents(spark, sf_dir):
    texts = [tuple(r) for r in table(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    got = queries.op13_personal_data(spark, sf_dir)
    assert got.columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    assert tuples(got.drop("spans")) == sorted(((i, *brute.personal_data(t)) for i, t in texts), key=str)
    counts = F.size(F.expr("filter(split(spans, ','), x -> x <> '')"))
    assert got.where(counts < F.col("n_email") + F.col("n_ip") + F.col("n_card") + F.col("n_phone")).count() == 0

"""Language identification: what stays, what goes, and the scorer against plain Python."""

import math
import os
import random
import unicodedata

import numpy as np
import pytest
from pyspark.sql import functions as F

from recordqa.llm import language
from recordqa.llm.common import table

KEPT = {
    "en": [
        "The quarterly maintenance window for the storage cluster has been moved to Thursday evening.",
        "Heat the oven to 180 degrees and grease a baking tin with plenty of butter.",
        "The compiler rejects this program because the variable is used before it is defined.",
        "ok thanks, see you", "She walked home through the rain without an umbrella.",
        "Please find attached the minutes of our last meeting.", "Cats sleep most of the day and hunt at night.",
        "Paracetamol is commonly used to reduce fever and mild pain.", "Prices rose by two percent in March, the bank said on Monday.",
        "Click the button below to confirm your subscription.", "My grandmother kept bees behind the old mill.",
        "Quantum computers could break many public key schemes.", "The trio from Łódź plays with Dvořák's nephew in the café tonight.",
        "Nobody knows why the lighthouse went dark that winter.", "Add the flour gradually and keep stirring until smooth.",
        "The committee postponed its decision until after the holidays.", "Your parcel could not be delivered because nobody was at home.",
        "Whales breathe air and give birth to live young.", "The bridge was closed to lorries after the flood.", "Remember to back up your files before upgrading.",
    ],
    "de": [
        "Der Zug nach Hamburg fährt heute von Gleis sieben ab.", "Bitte schicken Sie mir die Unterlagen bis Freitag.",
        "Katzen schlafen den größten Teil des Tages.", "Das Gericht wies die Klage am Montag zurück.",
        "Kochen Sie die Kartoffeln etwa zwanzig Minuten in Salzwasser.", "Ich habe gestern meinen Schlüssel im Büro vergessen.",
    ],
    "fr": [
        "Le train pour Lyon partira du quai numéro sept à midi.", "Veuillez trouver ci-joint le compte rendu de notre dernière réunion.",
        "Les chats dorment la plus grande partie de la journée.", "Le tribunal a rejeté la plainte lundi matin.",
        "J'ai oublié mes clés au bureau hier soir.", "Où sont passées les neiges d'antan ? Peut-être là-bas.",
    ],
    "es": [
        "El tren para Sevilla sale hoy de la vía número siete.", "Adjunto encontrará el acta de nuestra última reunión.",
        "Los gatos duermen la mayor parte del día.", "El tribunal rechazó la demanda el lunes por la mañana.",
        "Cueza las patatas durante veinte minutos en agua con sal.", "Mañana viajaremos al pueblo con los niños.",
    ],
}
#: Neighbours with the same letters (Portuguese, Italian, Dutch) cannot be told from the known languages by these means.
GONE = [
    "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem.",
    "Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar. Akıl ve vicdana sahiptirler ve birbirlerine karşı.",
    "Όλοι οι άνθρωποι γεννιούνται ελεύθεροι και ίσοι στην αξιοπρέπεια και τα δικαιώματα.",
    "Все люди рождаются свободными и равными в своем достоинстве и правах.",
    "すべての人間は、生まれながらにして自由であり、かつ、尊厳と権利とについて平等である。",
    "Toate ființele umane se nasc libere și egale în demnitate și în drepturi. Ele sunt înzestrate cu rațiune și conștiință.",
    "Všichni lidé rodí se svobodní a sobě rovní co do důstojnosti a práv.",
    "Tất cả mọi người sinh ra đều được tự do và bình đẳng về nhân phẩm và quyền lợi.",
]


@pytest.fixture(scope="module")
def model(spark, sf_dir):
    return language.fit(table(spark, "/root/testdata/sf0.01" if os.path.isdir("/root/testdata/sf0.01") else sf_dir, "documents"))


def test_prose_of_known_languages_stays_and_other_scripts_and_noise_go(spark, model):
    rng = random.Random(1)
    noise = " ".join("".join(rng.choice("bcdfghjklmnpqrstvwxz") for _ in range(rng.randrange(2, 9))) for _ in range(40))
    mixed = KEPT["en"][0] + " " + KEPT["es"][5] + " " + KEPT["de"][2] + " " + KEPT["fr"][5]
    rows = [(k, t) for k, texts in KEPT.items() for t in texts] + [(None, t) for t in [*GONE, noise]] + [("mixed", mixed)]
    df = spark.createDataFrame(rows, "truth string, t string")
    got = language.identify(df, model, F.col("t"), keep=["truth", "t"]).collect()
    known = [r for r in got if r.truth]
    assert [r.t for r in known if r.rejected] == []
    assert sum(r.lang == r.truth for r in known) >= 0.85 * len(known)
    assert [r.t for r in got if not r.truth and not r.rejected] == []


def plain_score(model, text):
    """The scorer, letter by letter."""
    text, k = f" {text.lower()} ", len(model.langs)
    letter = [c.isalpha() and ord(c) < 0x40000 for c in text]
    words, run = [], ""
    for c, is_letter in zip(text, letter):
        if is_letter:
            run += c
        elif run:
            words.append(run)
            run = ""
    grams, mask = [], (1 << 64) - 1
    f = [int(x) for x in language._FACTORS]
    mixed = lambda c, is_letter, n: (ord(c) if is_letter else 32) * f[n]
    for i in range(len(text) - 2):
        a, b, c = (mixed(text[i + n], letter[i + n], n) for n in range(3))
        keys = [b * f[2]] * letter[i + 1] + [a + b] * (letter[i] or letter[i + 1]) + [a + b + c] * letter[i + 1]
        for key in keys:
            key &= mask
            key ^= key >> 32
            grams.append((key * f[0] & mask) >> (64 - language.BUCKETS.bit_length() + 1))
    total = np.array([sum(model.logs[g, i] for g in grams) for i in range(k)])
    if not words:
        return total, 0.0, 0
    top = int(total.argmax())
    few, many = language.STRANGE_WORDS
    strange = sum(any(not model.alphabet[ord(c)].any() for c in w) for w in words)
    one = strange * math.log(many / few) + (len(words) - strange) * math.log((1 - many) / (1 - few))
    letters = "".join(words)
    core = sum(bool(model.core[ord(c), top]) for c in letters)
    even = min(max(model.core[:, top].sum() / model.alphabet[:, top].sum(), 0.05), language.CORE_SHARE - 0.05)
    two = core * math.log(even / language.CORE_SHARE) + (len(letters) - core) * math.log((1 - even) / (1 - language.CORE_SHARE))
    foreign = max(one, two) + math.log1p(math.exp(-abs(one - two)))
    bound = lambda x: min(max(x, -language.MOST), language.MOST)
    return np.array([max(language.TEMPER * (t - total[top]), -language.MOST) for t in total]), bound(foreign), len(words)


def test_scorer_equals_plain_python(model):
    scorer = language.Scorer(model)
    for text in [*KEPT["en"][:4], KEPT["de"][2], GONE[0], GONE[2], GONE[4], "", "12 !", "x", "a😀b", "𝒳𝒴 z", "Ünï"]:
        (a, b, n), (x, y, m) = scorer(text), plain_score(model, text)
        assert n == m and b == pytest.approx(y) and a == pytest.approx(x), text


def test_long_texts_are_read_whole_in_chunks(model, monkeypatch):
    text = " ".join(KEPT["de"]) * 3
    whole = language.Scorer(model)(text)
    monkeypatch.setattr(language, "CHUNK", 37)
    cut = language.Scorer(model)(text)
    assert cut[0] == pytest.approx(whole[0]) and cut[2] == whole[2] and cut[1] == pytest.approx(whole[1], abs=3)


def test_emoji_are_no_letters(spark, model):
    df = spark.createDataFrame([("😀 😀 😀",), ("12 34",), (None,)], "t string")
    assert all(r.rejected and r.n_words == 0 for r in language.identify(df, model, F.col("t")).collect())


def test_alphabet_holds_marks_that_the_language_uses():
    alphabet, core = language.letter_tables({ord(c): n for c, n in {"e": 500, "a": 300, "n": 150, "é": 40, "ł": 0}.items()})
    assert all(alphabet[ord(c)] for c in "azéíú") and not any(alphabet[ord(c)] for c in "łñűж")
    assert sorted(chr(c) for c in np.flatnonzero(core)) == ["a", "e"]
    assert unicodedata.normalize("NFC", "é") == "é"

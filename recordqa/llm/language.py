"""Language identification by Bayesian evidence fusion.

The text's likelihood under each language is combined with the declared markup language, the
address suffix and a host prior. What declarations and suffixes say about languages, and what
hosts publish, is counted by grouped aggregation of text posteriors; hosts are smoothed towards
their domain, and domains towards the whole corpus.
"""

from __future__ import annotations

import functools
import math
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from recordqa.llm.common import map_rows, stage, text_or_empty

#: Labelled texts a model is fitted on, at most; they are drawn by hash.
SAMPLE_DOCS = 20_000
#: Letter n-grams are counted in this many hash buckets.
BUCKETS = 1 << 15
#: Characters handled at once: bounds memory on very long texts.
CHUNK = 1 << 18
#: Letter n-grams overlap, so their likelihoods count for less than independent evidence would.
TEMPER = 0.3
#: The most the text may speak for one language over another, in nats.
MOST = 40.0
#: Pseudo-counts of smoothing: groups towards their parents, tables towards independence.
SMOOTH = 5.0
#: Probability, before any evidence, that a text is in none of the known languages.
FOREIGN = 0.01
#: Share of the n-gram model that is the mean of all languages and of a uniform one. It bounds what one n-gram can say, so
#: words and letters that the labelled texts happen to lack do not outweigh those they share with a text.
SHARED = 0.3
#: A letter that makes up less than this share of a language's letters is a stranger in its texts.
STRANGE = 1e-4
#: Share of words with a letter outside the alphabet, in texts of a language (names, quotations, what labelled
#: texts lack) and in texts of none of the known ones.
STRANGE_WORDS = (0.02, 0.2)
#: The most frequent letters that make up this share of a language's letters; noise draws letters evenly.
CORE = 0.8
#: Least share of core letters that is expected of a text of the language, whatever its words.
CORE_SHARE = 0.55
#: Letters that a labelled text counts for, however long it is.
WEIGHT = 1000
_FACTORS = tuple(np.uint64(f) for f in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


@functools.cache
def _letters() -> np.ndarray:
    """Which code points of the first four planes are letters; beyond them there are none."""
    return np.array([chr(c).isalpha() for c in range(0x40000)])


def _chunks(text: str) -> Iterator[np.ndarray]:
    """Code points of a text in lower case between blanks, in chunks that overlap by two."""
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), "<u4")
    for at in range(0, max(1, len(codes) - 2), CHUNK):
        yield codes[at : at + CHUNK + 2]


def _is_letter(part: np.ndarray) -> np.ndarray:
    return np.where(part < len(_letters()), _letters()[np.minimum(part, len(_letters()) - 1)], False)


def _buckets(part: np.ndarray, letter: np.ndarray) -> np.ndarray:
    """Buckets of the letter n-grams of a chunk (1 to 3 letters, other characters as one kind of end)."""
    c = np.where(letter, part, 32).astype(np.uint64)
    mixed = [c[i : len(c) - 2 + i] * f for i, f in enumerate(_FACTORS)]
    first, mid = letter[:-2], letter[1:-1]
    one, two, three = mixed[1] * _FACTORS[2], mixed[0] + mixed[1], mixed[0] + mixed[1] + mixed[2]
    keys = np.concatenate([one[mid], two[first | mid], three[mid]])
    keys ^= keys >> np.uint64(32)
    return (keys * _FACTORS[0] >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)


@dataclass
class Model:
    """Languages; log-probabilities of n-gram buckets, one row per bucket and one column per language; per language
    which code points belong to its alphabet and which are its core letters."""

    langs: tuple[str, ...]
    logs: np.ndarray
    alphabet: np.ndarray
    core: np.ndarray


def letter_tables(counts: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """(alphabet, core) of a language from the counts of its letters, as flags by code point.

    To the alphabet belongs what is no stranger, the whole of a-z for a language that writes Latin letters, and a
    Latin letter under marks that the language puts on others.
    """
    n = len(_letters())
    alphabet, core = np.zeros(n, bool), np.zeros(n, bool)
    total = sum(counts.values())
    known = {c for c, k in counts.items() if c < n and k >= STRANGE * total}
    marks = {m for c in known for m in unicodedata.normalize("NFD", chr(c))[1:]}
    alphabet[list(known)] = True
    if 2 * sum(k for c, k in counts.items() if 97 <= c <= 122) > total:
        alphabet[97:123] = True
        for c in range(0xC0, 0x250):
            base, *on = unicodedata.normalize("NFD", chr(c))
            if "a" <= base <= "z" and on and marks.issuperset(on):
                alphabet[c] = True
    held = 0
    for c, k in sorted(counts.items(), key=lambda x: (-x[1], x[0])):
        if c < n and held < CORE * total:
            core[c] = True
            held += k
    return alphabet, core


class Scorer:
    def __init__(self, model: Model):
        self.model = model
        sizes = np.maximum(model.alphabet.sum(axis=0), 1)
        even = np.clip(model.core.sum(axis=0) / sizes, 0.05, CORE_SHARE - 0.05)  # share of core letters in noise
        self.core_odds = np.log(even / CORE_SHARE), np.log((1 - even) / (1 - CORE_SHARE))
        self.strange = ~model.alphabet.any(axis=1)
        few, many = STRANGE_WORDS
        self.strange_odds = math.log(many / few), math.log((1 - many) / (1 - few))

    def __call__(self, text: str) -> tuple[np.ndarray, float, int]:
        """Tempered log-likelihoods, bounded, of the languages and of none of them; number of words with letters.

        A text is of none of them by its letters (words with letters strange to all) or as noise (letters drawn
        evenly, by the core letters of the language its n-grams fit best).
        """
        model, k = self.model, len(self.model.langs)
        total, core = np.zeros(k), np.zeros(k, np.int64)
        strange = letters = words = 0
        for part in _chunks(text):
            letter = _is_letter(part)
            mid, first = letter[1:-1], letter[:-2]
            starts = mid & ~first
            words += int(starts.sum())
            total += model.logs.take(_buckets(part, letter), axis=0).sum(axis=0)
            codes = part[1:-1][mid]
            letters += len(codes)
            core += model.core[codes].sum(axis=0)
            odd = np.flatnonzero(self.strange[codes])
            if len(odd):
                strange += len(np.unique(np.cumsum(starts)[mid][odd]))
        foreign = 0.0
        if words and k:
            top = int(total.argmax())
            by_alphabet = strange * self.strange_odds[0] + max(words - strange, 0) * self.strange_odds[1]
            by_noise = core[top] * self.core_odds[0][top] + (letters - core[top]) * self.core_odds[1][top]
            foreign = float(np.clip(np.logaddexp(by_alphabet, by_noise), -MOST, MOST))
            total = np.maximum(TEMPER * (total - total[top]), -MOST)
        return total, foreign, words


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", sample_docs: int = SAMPLE_DOCS) -> Model:
    """N-grams and letters by language from at most ``sample_docs`` labelled texts, the first by hash of the text.

    Texts without a label are left out; none at all give a model without languages, which rejects everything.
    """
    known = docs.where(F.col(lang_col).isNotNull() & (F.col(lang_col) != "") & F.col(text_col).isNotNull())
    narrow = known.select(F.xxhash64(text_col).alias("h"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    # the cut is the hash of the last text drawn; copies fold into one row per task before they meet
    cut = narrow.select("h").distinct().orderBy("h").limit(sample_docs).agg(F.max("h")).first()[0]
    sample = narrow.where(F.col("h") <= F.lit(cut)).dropDuplicates(["h"])

    def count(batch):
        by: dict = {}
        for lang, text in zip(batch["lang"], batch["text"]):
            counts, letters = by.setdefault(lang, (np.zeros(BUCKETS, np.int64), np.zeros(len(_letters()), np.int64)))
            own = np.zeros(len(letters), np.int64)
            for part in _chunks(text):
                letter = _is_letter(part)
                counts += np.bincount(_buckets(part, letter), minlength=BUCKETS)
                own += np.bincount(part[1:-1][letter[1:-1]], minlength=len(own))
            letters += own * WEIGHT // max(1, own.sum())
        for lang, both in by.items():
            for letters, counts in enumerate(both):
                at = np.flatnonzero(counts)
                yield {"lang": [lang] * len(at), "letters": [bool(letters)] * len(at), "at": at.tolist(), "n": counts[at].tolist()}

    part = map_rows(sample.select("lang", "text"), count, "lang string, letters boolean, at int, n long")
    # at most a row per language and bucket or letter
    counts = part.groupBy("lang", "letters", "at").agg(F.sum("n").alias("n")).collect()
    langs = tuple(sorted({r.lang for r in counts}))
    table, alphabets = np.zeros((BUCKETS, len(langs))), {x: {} for x in langs}
    for lang, letters, at, n in counts:
        if letters:
            alphabets[lang][at] = n
        else:
            table[at, langs.index(lang)] += n
    own = table / np.maximum(table.sum(axis=0), 1.0)
    mean = (own.sum(axis=1, keepdims=True) + 1.0 / BUCKETS) / (len(langs) + 1)
    tables = [letter_tables(alphabets[x]) for x in langs]
    stacked = [np.stack(t, axis=1) if langs else np.zeros((len(_letters()), 0), bool) for t in zip(*tables)] or [np.zeros((len(_letters()), 0), bool)] * 2
    return Model(langs, np.log((1 - SHARED) * own + SHARED * mean), *stacked)


def suffix_of(host: Column) -> Column:
    """The last label of a host name."""
    return F.nullif(F.lower(F.regexp_extract(host, r"\.([A-Za-z]+)\.?$", 1)), F.lit(""))


def domain_of(host: Column) -> Column:
    """The last two labels of a host name, or the whole where there are fewer."""
    return F.nullif(F.lower(F.regexp_extract(host, r"([^.]+(?:\.[^.]+)?)\.?$", 1)), F.lit(""))


def identify(
    rows: DataFrame,
    model: Model,
    text: Column,
    declared: Column | None = None,
    host: Column | None = None,
    min_posterior: float = 0.5,
    keep: list[str] = (),
) -> DataFrame:
    """``keep`` columns and, per row: lang, posterior, text_lang, text_posterior, n_words, rejected.

    Evidence that is absent (null declared language, null host, a text without letters) says nothing. Evidence tables
    are counted from the texts' own posteriors; a row's own count is taken out of its host's and domain's prior. A row
    is rejected if its text has no letters or the known languages together do not reach ``min_posterior``, where the
    posteriors leave room for a text of none of them (``Scorer``); a text that could be in either of two known
    languages stays. The lang of a rejected row is the best guess, null if the model knows none. Ties go to the first language in order. Repeated rows get a row each, empty tables
    give none.

    Texts are scanned once and not shuffled with: likelihoods, a few numbers per row, are written first. Tables of
    declarations and suffixes are joined like those of hosts, so none needs to be small.
    """
    langs = model.langs
    spark = rows.sparkSession
    absent = F.lit(None).cast("string")
    shared, scorer = spark.sparkContext.broadcast(model), []

    def score(batch):
        if not scorer:
            scorer.append(Scorer(shared.value))
        found = [scorer[0](t) for t in batch["_text"]]
        yield {**{n: batch[n] for n in batch if n != "_text"}, "_ll": [f[0].tolist() for f in found], "_foreign": [f[1] for f in found], "_n": [f[2] for f in found]}

    host = F.lower(host) if host is not None else absent
    declared = F.lower(F.regexp_extract(declared, r"^\s*([A-Za-z]+)", 1)) if declared is not None else absent
    base = rows.select(
        *keep,
        F.nullif(declared, F.lit("")).alias("_declared"),
        suffix_of(host).alias("_suffix"),
        F.nullif(host, F.lit("")).alias("_host"),
        domain_of(host).alias("_domain"),
        text_or_empty(text).alias("_text"),
    )
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema if f.name != "_text")
    scored = map_rows(base, score, f"{schema}, _ll array<double>, _foreign double, _n int")
    if not langs:
        return scored.select(
            *keep, absent.alias("lang"), F.lit(0.0).alias("posterior"), absent.alias("text_lang"),
            F.lit(0.0).alias("text_posterior"), F.col("_n").alias("n_words"), F.lit(True).alias("rejected"),
        )
    k = len(langs)
    vector = lambda fn: F.array(*[fn(i) for i in range(k)])

    def normal(logs: Column) -> Column:
        """Probabilities of log weights."""
        bound = F.transform(F.array(F.struct(logs.alias("l"), F.array_max(logs).alias("m"))), lambda s: F.transform(s["l"], lambda x: F.exp(x - s["m"])))[0]
        return F.transform(F.array(bound), lambda w: F.transform(w, lambda x: x / F.aggregate(w, F.lit(0.0), lambda a, b: a + b)))[0]

    def known(logs: Column) -> Column:
        """Probabilities of the languages beside that of none of them."""
        none = F.col("_foreign") + math.log(FOREIGN / (1 - FOREIGN))
        return F.slice(normal(F.concat(logs, F.array(F.when(F.col("_n") > 0, none).otherwise(math.log(FOREIGN))))), 1, k)

    # a text without letters counts nowhere, a foreign one next to nothing
    even = F.transform(F.col("_ll"), lambda x: x - math.log(k))
    scored = stage(scored.withColumn("_p", F.when(F.col("_n") > 0, known(even))), "language-text")
    voted = scored.where("_p is not null")
    sums = [F.sum(F.col("_p")[i]).alias(f"s{i}") for i in range(k)]
    whole = voted.agg(*sums).first()
    total = sum(x or 0.0 for x in whole)
    prior = [((x or 0.0) + 1.0) / (total + k) for x in whole]

    def counted(column: str, name: str) -> DataFrame:
        by = voted.where(F.col(column).isNotNull()).groupBy(column).agg(*sums)
        return by.select(column, vector(lambda i: F.col(f"s{i}")).alias(name))

    joined = scored
    for column, name in (("_declared", "_cd"), ("_suffix", "_cs"), ("_host", "_ch"), ("_domain", "_cm")):
        joined = joined.join(counted(column, name), column, "left")
    zero = vector(lambda i: F.lit(0.0))
    own = F.coalesce("_p", zero)
    less = lambda c, i: F.greatest(F.lit(0.0), F.coalesce(F.col(c), zero)[i] - own[i])
    mass = lambda c: sum((less(c, i) for i in range(1, k)), less(c, 0))
    domain = lambda i: (less("_cm", i) + SMOOTH * prior[i]) / (mass("_cm") + SMOOTH)
    hosts = lambda i: (less("_ch", i) + SMOOTH * domain(i)) / (mass("_ch") + SMOOTH)

    def ratio(c: str, i: int) -> Column:
        """log P(value | language) / P(value), smoothed towards 1; nothing where the value is absent."""
        among = (less(c, i) + SMOOTH * prior[i]) / (mass(c) + SMOOTH)
        return F.when(F.col(c).isNull(), F.lit(0.0)).otherwise(F.log(among) - math.log(prior[i]))

    logs = vector(lambda i: F.when(F.col("_n") > 0, F.col("_ll")[i]).otherwise(0.0) + F.log(hosts(i)) + ratio("_cd", i) + ratio("_cs", i))
    names = F.array(*[F.lit(x) for x in langs])
    best = lambda p: names[F.array_position(p, F.array_max(p)).cast("int") - 1]
    out = joined.withColumn("_logs", logs).withColumn("_post", known(F.col("_logs")))
    return out.select(
        *keep,
        best(F.col("_post")).alias("lang"),
        F.array_max("_post").alias("posterior"),
        F.when(F.col("_n") > 0, best(own)).alias("text_lang"),
        F.when(F.col("_n") > 0, F.array_max(own)).otherwise(0.0).alias("text_posterior"),
        F.col("_n").alias("n_words"),
        ((F.col("_n") == 0) | (F.aggregate("_post", F.lit(0.0), lambda a, b: a + b) < min_posterior)).alias("rejected"),
    )


#: Parts of a page that hold no prose, and tags.
_SILENT = r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->"
_TAG = r"(?s)<[^>]*>"


def page_text(html: Column) -> Column:
    """The text of a page: no scripts, styles, comments, tags or entities."""
    plain = F.regexp_replace(F.regexp_replace(text_or_empty(html), _SILENT, " "), _TAG, " ")
    return F.regexp_replace(plain, r"&#?\w{1,10};", " ")


def page_declared(html: Column) -> Column:
    """The language the html element declares, null if none."""
    return F.nullif(F.regexp_extract(html, r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z-]+)", 1), F.lit(""))


def page_host(url: Column) -> Column:
    return F.nullif(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1)), F.lit(""))

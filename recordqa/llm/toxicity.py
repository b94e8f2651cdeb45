"""Toxicity: Levenshtein automata over a lexicon trie, and context-window scores.

The lexicon is learned from labelled documents: words, and stems that words begin with. A
token is run through the trie with the state of a Levenshtein automaton beside it, so one walk
finds all terms within the edit distance. Hits inside quotations count less than others.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from recordqa.llm.common import bounded_batches, empty, map_rows, stage, text_or_empty
from recordqa.llm.simhash import simhash_components

#: Labelled documents a model is fitted on, at most; they are drawn by hash.
SAMPLE_DOCS = 20_000
MIN_STEM, MAX_STEM = 4, 8
#: Distinct toxic texts that hold an entry, and its log odds, at least.
LEAST, ODDS = 3, 2.0
#: Evidence (log-likelihood ratio, one degree of freedom) that a neighbour of a term is toxic itself: 95 %.
SURE = 3.84
#: Terms shorter than this have no misspellings.
MIN_FUZZY = 5
WINDOW = 8
_TOKEN = re.compile(r"\w+")
_MARKS = re.compile(r"[\"“”„«»]")
#: Words that report what others say, in the four languages of the corpus.
REPORTING = frozenset(
    "said says quote quoted quoting called wrote reported sagte schrieb zitat nannte dit écrit citation appelé dijo "
    "escribió cita llamó".split()
)


#: Weights before any evidence: bias, log of the mass outside and inside quotation, log of the length.
PRIOR = (-3.0, 2.5, 0.5, 0.0)


class Trie:
    """Terms by letters; walks carry the rows of a Levenshtein automaton."""

    def __init__(self, words, stems=()):
        self.root: dict = {}
        for kind, terms in (("word", words), ("stem", stems)):
            for term in terms:
                node = self.root
                for letter in term:
                    node = node.setdefault(letter, {})
                node[kind] = term
        self.words, self.stems = set(words), set(stems)
        #: A term within one edit of a token has its first or its last half there, and its length to one letter.
        self.heads: dict[str, set[int]] = {}
        self.tails: dict[str, set[int]] = {}
        for w in self.words:
            if len(w) >= MIN_FUZZY:
                reach = range(len(w) - 1, len(w) + 2)
                self.heads.setdefault(w[: len(w) // 2], set()).update(reach)
                self.tails.setdefault(w[len(w) // 2 :], set()).update(reach)
        self.head_sizes = sorted({len(h) for h in self.heads})
        self.tail_sizes = sorted({len(t) for t in self.tails})

    def stem_of(self, token: str) -> str | None:
        node = self.root
        for letter in token:
            node = node.get(letter)
            if node is None:
                return None
            if "stem" in node:
                return node["stem"]
        return None

    def near(self, token: str) -> str | None:
        """The term of least distance, at most one edit away (ties: first in order).

        States are those of the Levenshtein automaton (letters read, edits made) at a node of the trie; once the
        edit is made only the one exact path goes on.
        """
        n, none = len(token), ()
        if not (
            any(n in self.heads.get(token[:k], none) for k in self.head_sizes)
            or any(n in self.tails.get(token[-k:], none) for k in self.tail_sizes)
        ):
            return None
        best = (2, "")
        stack = [(self.root, 0, 0)]
        while stack:
            node, i, edits = stack.pop()
            if i == n and len(term := node.get("word", "")) >= MIN_FUZZY:
                best = min(best, (edits, term))
            own = token[i] if i < n else None
            if own in node:
                stack.append((node[own], i + 1, edits))
            if edits:
                continue
            if own:
                stack.append((node, i + 1, 1))  # the token has a letter too many
            for letter, child in node.items():
                if len(letter) == 1:
                    stack.append((child, i, 1))  # the token lacks a letter
                    if own and letter != own:
                        stack.append((child, i + 1, 1))  # the token has another letter
        return best[1] if best[0] <= 1 else None


@dataclass
class Model:
    """A fitted model: lexicon, words known to be harmless neighbours, weights of the score."""

    words: dict[str, float] = field(default_factory=dict)  # term: weight, 0 to 1
    stems: dict[str, float] = field(default_factory=dict)
    harmless: frozenset = frozenset()
    weights: tuple[float, ...] = PRIOR
    _trie: Trie | None = field(default=None, repr=False, compare=False)

    @property
    def trie(self) -> Trie:
        if self._trie is None:
            self._trie = Trie(self.words, self.stems)
        return self._trie

    def __getstate__(self):
        return {**self.__dict__, "_trie": None}


class Scorer:
    """Scores texts with a model; remembers up to ``most`` tokens."""

    def __init__(self, model: Model, most: int = 500_000):
        self.model, self.known, self.most = model, {}, most

    def value(self, token: str) -> float:
        """What a token weighs: the evidence of its term or stem, 0.8 of that for a misspelled term."""
        model, trie = self.model, self.model.trie
        exact = max(model.words.get(token, 0.0), model.stems.get(trie.stem_of(token), 0.0))
        if exact:
            return exact
        if len(token) >= MIN_FUZZY - 1 and token not in model.harmless and (term := trie.near(token)):
            return 0.8 * model.words[term]
        return 0.0

    def masses(self, text: str) -> tuple[float, float, int]:
        """Sums of hit weights outside and inside quotation; number of tokens."""
        known, low = self.known, text.lower()
        if len(known) > self.most:
            known.clear()
        found, hits = _TOKEN.findall(low), []
        for token in set(found):
            v = known.get(token)
            if v is None:
                v = known[token] = self.value(token)
            if v:
                hits.append(token)
        if not hits:
            return 0.0, 0.0, len(found)
        marks = [m.start() for m in _MARKS.finditer(low)]
        tokens = [(m[0], m.start()) for m in _TOKEN.finditer(low)]
        wanted, abuse, quoted = set(hits), 0.0, 0.0
        for n, (token, start) in enumerate(tokens):
            if token not in wanted:
                continue
            window = tokens[max(0, n - WINDOW) : n + WINDOW + 1]
            first, last = window[0][1], window[-1][1] + len(window[-1][0])
            marked = any(first <= m < start for m in marks) and any(start < m <= last + 1 for m in marks)
            if marked or any(t in REPORTING for t, _ in window):
                quoted += known.get(token) or self.value(token)
            else:
                abuse += known.get(token) or self.value(token)
        return abuse, quoted, len(tokens)

    def score(self, text: str) -> tuple[float, float, float]:
        """(score, abuse mass, quoted mass)"""
        abuse, quoted, n = self.masses(text)
        bias, wa, wq, wn = self.model.weights
        # the length matters only where there is something to dilute
        z = bias + wa * math.log1p(abuse) + wq * math.log1p(quoted) + wn * math.log1p(n) * (abuse + quoted > 0)
        return 1 / (1 + math.exp(-z)), abuse, quoted


def held_out(id_col: Column) -> Column:
    """Rows never learned from: CRC-32 of the id as text, divisible by 5."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def plain_words(text: str) -> tuple[set, set]:
    """Words of a text of three letters or more; those of them that occur outside quotation, by the rule of ``masses``."""
    low = text.lower()
    words = _TOKEN.findall(low)
    every = {w for w in words if len(w) > 2}
    marks = np.array([m.start() for m in _MARKS.finditer(low)])
    reports = np.array([w in REPORTING for w in words], dtype=bool)
    if len(marks) < 2 and not reports.any():
        return every, every
    spans = np.array([m.span() for m in _TOKEN.finditer(low)])
    at = np.arange(len(words))
    first, last = np.maximum(0, at - WINDOW), np.minimum(len(words) - 1, at + WINDOW)
    before = np.searchsorted(marks, spans[:, 0]) - np.searchsorted(marks, spans[first, 0])
    after = np.searchsorted(marks, spans[last, 1] + 1, "right") - np.searchsorted(marks, spans[:, 0], "right")
    told = np.r_[0, np.cumsum(reports)]
    plain = ~(((before > 0) & (after > 0)) | (told[last + 1] > told[first]))
    return every, {words[n] for n in np.flatnonzero(plain)} & every


COUNTS = ("bad", "good", "bad_plain", "good_plain")


def _word_counts(learn: DataFrame) -> DataFrame:
    """word, toxic and harmless groups that hold it, and that hold it outside quotation.

    ``learn`` has text, toxic and grp: texts of one group are near copies and count once; null is a group of its own.
    """

    def alone(batch):
        seen: dict = {}
        for text, toxic in zip(batch["text"], batch["toxic"]):
            every, plain = plain_words(text)
            for word in every:
                n = seen.setdefault(word, [0, 0, 0, 0])
                n[1 - toxic] += 1
                n[3 - toxic] += word in plain
        yield {"word": list(seen), **{c: [v[i] for v in seen.values()] for i, c in enumerate(COUNTS)}}

    def grouped(batch):
        seen: dict = {}
        for text, toxic, grp in zip(batch["text"], batch["toxic"], batch["grp"]):
            every, plain = plain_words(text)
            for word in every:
                seen[word, grp, toxic] = seen.get((word, grp, toxic), False) or word in plain
        yield {"word": [k[0] for k in seen], "grp": [k[1] for k in seen], "toxic": [k[2] for k in seen], "plain": [int(v) for v in seen.values()]}

    single = map_rows(learn.where("grp is null").select("text", "toxic"), alone, "word string, " + ", ".join(f"{c} long" for c in COUNTS))
    held = map_rows(learn.where("grp is not null").select("text", "toxic", "grp"), grouped, "word string, grp long, toxic int, plain int")
    held = held.groupBy("word", "grp", "toxic").agg(F.max("plain").alias("plain"))
    toxic, plain = F.col("toxic").cast("long"), F.col("plain").cast("long")
    held = held.select("word", toxic.alias("bad"), (1 - toxic).alias("good"), (toxic * plain).alias("bad_plain"), ((1 - toxic) * plain).alias("good_plain"))
    return single.unionByName(held).groupBy("word").agg(*[F.sum(c).alias(c) for c in COUNTS])


def _odds(kind: str, n_bad: int, n_good: int) -> Column:
    """Log odds of being in toxic rather than harmless groups; ``kind`` is "" or "_plain"."""
    return F.log((F.col(f"bad{kind}") + 0.5) / (n_bad + 1)) - F.log((F.col(f"good{kind}") + 0.5) / (n_good + 1))


def _evidence(kind: str, n_bad: int, n_good: int) -> Column:
    """Log-likelihood ratio against being as common in toxic groups as in harmless ones, 0 where it is rarer."""
    bad, good, n = F.col(f"bad{kind}"), F.col(f"good{kind}"), n_bad + n_good
    part = lambda x, of: F.when(x > 0, x * F.log(x / of)).otherwise(0.0)
    both = bad + good
    ratio = part(bad, both * n_bad / n) + part(good, both * n_good / n)
    ratio = ratio + part(n_bad - bad, (n - both) * n_bad / n) + part(n_good - good, (n - both) * n_good / n)
    return F.when(bad * n_good > good * n_bad, 2 * ratio).otherwise(0.0)


def _strong(counts: DataFrame, n_bad: int, n_good: int, least: int, kind: str) -> dict[str, float]:
    """Entries that toxic groups hold far more often, at all or outside quotation, with weights by their log odds.

    The evidence must be such that of all entries tested about one would pass by chance. All that pass are kept: they
    are words of the bounded sample of labelled texts, whatever the size of the corpus.
    """
    needed = 2 * math.log(max(2, counts.count()))
    found = counts
    for k in ("", "_plain"):
        odds, sure = _odds(k, n_bad, n_good), _evidence(k, n_bad, n_good)
        passes = (F.col(f"bad{k}") >= least) & (odds > ODDS) & (sure > needed)
        found = found.withColumn(f"odds{k}", F.when(passes, odds))
    found = found.withColumn("odds", F.greatest("odds", "odds_plain")).where("odds is not null")
    return {r[0]: min(1.0, r[1] / 6) for r in found.select(kind, "odds").collect()}


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        sample_docs: int = SAMPLE_DOCS) -> Model:
    """Learns lexicon and weights from at most ``sample_docs`` labelled documents outside the held-out fold.

    Labels decide on their own which documents are sampled, by hash of the id; if ids repeat, so that they have more
    texts than ``sample_docs``, a hash of the text decides which are used. Rows with a null id or label are left out, of repeated labels the highest holds. Equal texts count once, with their highest label, and in the lexicon
    near copies (SimHash) do, once as toxic and once as harmless. Four fifths of the sample give the lexicon, the rest the weights.
    Words and stems enter by evidence, not by the share of toxic documents that hold them.
    Without toxic or without harmless documents the lexicon is empty and scores are those of the prior weights.
    """
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(F.col(id_col)))
    known = known.groupBy(F.col(id_col).alias("_id")).agg(F.max(F.col(label_col).cast("int")).alias("toxic"))
    drawn = known.orderBy(F.xxhash64("_id"), "_id").limit(sample_docs)  # bounded, so it may be broadcast
    texts = docs.select(F.col(id_col).alias("_id"), text_or_empty(text_col).alias("text"))
    joined = texts.join(F.broadcast(drawn), "_id")
    once = joined.groupBy("text").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    part = F.pmod(F.xxhash64("text"), F.lit(5))
    once = stage(once.select(F.xxhash64("text").alias("h"), "text", "toxic", part.alias("part")), "toxicity-drawn")
    # an id that repeats brings all its texts: of those the bound holds as well
    least = once.select("h").orderBy("h").limit(sample_docs)
    sample = stage(once.join(F.broadcast(least), "h", "left_semi"), "toxicity-sample")
    empty(once)
    learn, tune = sample.where("part <> 0"), sample.where("part = 0")
    # a group of near copies shares rare words by chance
    close = simhash_components(learn, id_col="h").where("component_id is not null").select("h", "component_id")
    close = stage(close, "toxicity-groups")
    several = close.groupBy("component_id").count().where("count > 1").select("component_id")
    grp = close.join(several, "component_id").select("h", F.col("component_id").alias("grp"))
    learn = stage(learn.join(grp, "h", "left").select("text", "toxic", "grp", "h"), "toxicity-learn")
    groups = learn.groupBy("toxic").agg(F.countDistinct(F.coalesce("grp", "h")))
    totals = {r[0]: r[1] for r in groups.collect()}
    n_good, n_bad = totals.get(0, 0), totals.get(1, 0)
    if not (n_good and n_bad):
        return Model()
    counts = stage(_word_counts(learn), "toxicity-words")
    size = F.col("n")
    stems = (
        counts.where(F.length("word") > MIN_STEM)
        .select(*COUNTS, "word", F.explode(F.sequence(F.lit(MIN_STEM), F.lit(MAX_STEM))).alias("n"))
        .where(size < F.length("word"))
        .groupBy(F.substring(F.col("word"), F.lit(1), size).alias("stem"))
        .agg(*[F.sum(c).alias(c) for c in COUNTS], F.count(F.lit(1)).alias("variants"))
        .where(F.col("variants") >= 3)
        .select("stem", *[F.least(c, F.lit(n_bad if c.startswith("bad") else n_good)).alias(c) for c in COUNTS])
    )
    found = _strong(stems, n_bad, n_good, 3 * LEAST, "stem")
    # of nested stems the shortest stands for all
    shortest: dict[str, float] = {}
    for stem in sorted(found, key=lambda s: (len(s), s)):
        if not any(stem[:n] in shortest for n in range(MIN_STEM, len(stem))):
            shortest[stem] = found[stem]
    words = _strong(counts, n_bad, n_good, LEAST, "word")
    model = Model(words=words, stems=shortest)

    def neighbours(batch):
        trie = model.trie
        kept = [w for w in batch["word"] if len(w) >= MIN_FUZZY - 1 and w not in trie.words and trie.near(w)]
        yield {"word": kept}

    # a neighbour that toxic texts hold more often, at all or outside quotation, is a misspelling that some quote
    toxic = [(_evidence(k, n_bad, n_good) > SURE) & (_odds(k, n_bad, n_good) > 1) for k in ("", "_plain")]
    near = map_rows(counts.where(F.col("good") > 0).where(~(toxic[0] | toxic[1])).select("word"), neighbours, "word string")
    model = Model(words, model.stems, frozenset(r[0] for r in near.collect()))
    scorer = Scorer(model)

    def features(batch):
        both = [scorer.masses(t) for t in batch["text"]]
        yield {**{n: [b[i] for b in both] for i, n in enumerate(("abuse", "quoted", "n"))}, "toxic": batch["toxic"]}

    points = map_rows(tune.select("text", "toxic"), features, "abuse double, quoted double, n long, toxic int").toPandas()
    return Model(words, model.stems, model.harmless, _logistic(points.to_numpy()))


def _logistic(points: np.ndarray, prior=PRIOR, strength: float = 0.1) -> tuple[float, ...]:
    """Weights of a logistic regression on log masses and length, pulled towards ``prior``; damped Newton steps."""
    hit = points[:, 0] + points[:, 1] > 0
    x = np.column_stack([np.ones(len(points)), np.log1p(points[:, :2]), np.log1p(points[:, 2]) * hit])
    y, w, at = points[:, 3], np.array(prior), np.array(prior)

    def value(w):
        z = x @ w
        return (y * z - np.logaddexp(0, z)).sum() - strength / 2 * ((w - at) ** 2).sum()

    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + strength * np.eye(4), x.T @ (y - p) - strength * (w - at))
        while value(w + step) < value(w) and np.abs(step).max() > 1e-9:  # a whole step can overshoot
            step = step / 2
        w = w + step
        if np.abs(step).max() < 1e-9:
            break
    return tuple(float(v) for v in w)


def score_documents(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, held_out, score, predicted, abuse, quoted.

    A null or empty text has no hits and gets the score of none; repeated rows get a row each; a null id
    counts as the empty text in ``held_out``; other columns are ignored. One scan, no shuffle.
    """
    bounded_batches(docs.sparkSession)
    shared, scorer = docs.sparkSession.sparkContext.broadcast(model), []

    def rows(batch):
        if not scorer:
            scorer.append(Scorer(shared.value))
        found = [scorer[0].score(t) for t in batch["text"]]
        yield {"id": batch["id"], "score": [f[0] for f in found], "abuse": [f[1] for f in found], "quoted": [f[2] for f in found]}

    narrow = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    kind = narrow.schema["id"].dataType.simpleString()
    scored = map_rows(narrow, rows, f"id {kind}, score double, abuse double, quoted double")
    return scored.select(
        F.col("id").alias(id_col),
        held_out(F.col("id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "abuse",
        "quoted",
    )

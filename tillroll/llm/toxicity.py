"""Toxicity: gradient-boosted trees over dense text features.

Features of a text: densities of lexicon words (a fixed list and words and
word beginnings learned from labelled texts), of lexicon words near a
second-person word, of obfuscated lexicon words (digits and signs for
letters); rates of second-person words, capitals, shouting, punctuation,
digits and signs inside words, drawn-out letters; lengths.  The trees are
histogram-based with logistic loss; isotonic regression on texts that the
trees did not see turns their sums into probabilities.

Fitting uses at most ``SAMPLE`` labelled rows of each class, those with the
smallest hash of their id (a bounded sample; the sampled ids are broadcast).
Another hash deals it to ``PARTS`` parts: the features that the trees learn
from use a lexicon learned without the text's own part, and the calibration
uses trees learned without it.  Scoring is a narrow map over all documents.

Defined cases: NULL and empty texts have all features 0 and are scored like
any text; of repeated labels of an id the highest counts, repeated rows are
scored each; without labelled rows of both classes every score is the share
of toxic ones among what there is (0 if none); very long texts are scored whole,
one row at a time; an empty table gives an empty result; lang, source and doc_id
are no inputs of a score; other columns are not read.
"""
from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import map_batches, random_key, save, ship

SAMPLE = 6000          # labelled rows of each class that a model is fitted on, at most
LEXICON = 4000         # learned words, and as many word beginnings, at most
PARTS = 4
STEM = 4               # letters of a word's beginning

# Common insults and vulgar words (English, German, French, Spanish).
INSULTS = frozenset("""
asshole bastard bitch clown coward creep cretin crap degenerate dickhead disgusting dumb dumbass fool freak garbage
idiot idiotic imbecile jerk kys loser lowlife moron moronic parasite pathetic pig retard scum scumbag shit shithead slut
stupid subhuman trash twat ugly useless vermin vile whore worthless
abschaum arschloch blödmann dreck drecksau dummkopf ekelhaft hurensohn miststück schwachkopf trottel vollidiot wertlos
abruti connard connasse crétin débile ordure pourriture raclure salaud salope minable
asqueroso basura cabrón escoria estúpido gilipollas idiota imbécil mierda patético pendejo perdedor inútil
""".split())
SECOND_PERSON = frozenset("""
you your yours yourself u ur youre du dich dir dein deine deinen euch euer ihr tu te toi ton ta tes vous votre vos
tú ti tus usted ustedes vosotros vuestro vuestra
""".split())
# Signs written for letters.
LOOKALIKES = str.maketrans("013457@$!|€", "oieastasiie")

_WORD = re.compile(r"[^\W_]+")
_MIXED = re.compile(r"\b(?=\w*[^\W\d_])[^\W_]*[0-9@$!|€*][\w@$!|€*]*[^\W\d_]+\b")
_DRAWN = re.compile(r"([^\W\d_])\1{2,}")
NAMES = ("lexicon", "lexicon_log", "learned", "learned_log", "stems", "stems_log", "near_you", "obfuscated", "you", "capitals", "shouted",
         "exclaimed", "asked", "punctuation", "digits", "signs_in_words", "drawn_out", "log_words", "word_length")

_BYTE = np.arange(256)
_UPPER = ((_BYTE >= 65) & (_BYTE <= 90)) | ((_BYTE >= 0xC0) & (_BYTE <= 0xDE) & (_BYTE != 0xD7))
_DIGIT = (_BYTE >= 48) & (_BYTE <= 57)
_PUNCT = np.isin(_BYTE, [ord(c) for c in "!\"#$%&'()*+,-./:;<=>@[\\]^_`{|}~"])


def features(text: str, learned: frozenset[str], stems: frozenset[str]) -> list[float]:
    if not text:
        return [0.0] * len(NAMES)
    lower = text.lower()
    words = _WORD.findall(lower)
    n = max(1, len(words))
    fixed = [i for i, w in enumerate(words) if w in INSULTS]
    taught = [i for i, w in enumerate(words) if w in learned]
    begun = sum(w[:STEM] in stems for w in words)
    you = [i for i, w in enumerate(words) if w in SECOND_PERSON]
    hits = {*fixed, *taught}
    near = sum(any(j in hits for j in range(i - 3, i + 4)) for i in you) if hits else 0
    mixed = _MIXED.findall(lower)
    hidden = sum((p := m.translate(LOOKALIKES).replace("*", "")) in INSULTS or p in learned for m in mixed)
    bytes_of = np.bincount(np.frombuffer(text.encode("latin-1", "replace"), np.uint8), minlength=256)
    size = len(text)
    raw = _WORD.findall(text) if bytes_of[_UPPER].sum() > 1 else ()
    shouted = sum(len(w) > 2 and w.isupper() for w in raw)
    return [len(fixed) / n, np.log1p(len(fixed)), len(taught) / n, np.log1p(len(taught)), begun / n, np.log1p(begun), near / n,
            hidden / n, len(you) / n, bytes_of[_UPPER].sum() / size, shouted / n, bytes_of[33] / size, bytes_of[63] / size,
            bytes_of[_PUNCT].sum() / size, bytes_of[_DIGIT].sum() / size, len(mixed) / n, len(_DRAWN.findall(lower)) / n, np.log1p(n), size / n]


@dataclass
class Trees:
    """Boosted regression trees of one depth on binned features."""
    rounds: int = 80
    depth: int = 3
    rate: float = 0.15
    bins: int = 48
    smooth: float = 1.0
    least: float = 3.0          # sum of second derivatives on each side of a split
    base: float = 0.0
    nodes: list = field(default_factory=list)  # per tree: (feature, threshold) of 2**depth - 1 nodes, 2**depth leaves

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Trees:
        cuts = [np.unique(np.quantile(c, np.linspace(0, 1, self.bins + 1)[1:-1])) for c in x.T]
        for i, c in enumerate(x.T):  # rare features: cuts between their values, not only the common one
            if len(cuts[i]) < self.bins // 2 and len(v := np.unique(c)) > 1:
                mids = (v[1:] + v[:-1]) / 2
                cuts[i] = np.unique(np.concatenate([cuts[i], mids[np.linspace(0, len(mids) - 1, min(len(mids), self.bins // 2)).astype(int)]]))[:4 * self.bins]
        binned = np.stack([np.searchsorted(c, v, "left") for c, v in zip(cuts, x.T)])
        wide = max(len(c) for c in cuts) + 1
        p = np.average(y, weights=weight)
        self.base = float(np.log(p / (1 - p)))
        total = np.full(len(y), self.base)
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-total))
            grad, hess = weight * (p - y), weight * p * (1 - p)
            at = np.zeros(len(y), np.int64)
            feature, threshold = np.zeros((1 << self.depth) - 1, np.int64), np.full((1 << self.depth) - 1, np.inf)
            for level in range(self.depth):
                width = 1 << level
                best, pick, where = np.full(width, 1e-6), np.zeros(width, np.int64), np.full(width, -1)
                for f, b in enumerate(binned):
                    g, h = (np.bincount(at * wide + b, v, width * wide).reshape(width, wide).cumsum(1) for v in (grad, hess))
                    left, right, all_g, all_h = h, h[:, -1:] - h, g[:, -1:], h[:, -1:]
                    gain = g**2 / (left + self.smooth) + (all_g - g)**2 / (right + self.smooth) - all_g**2 / (all_h + self.smooth)
                    gain[(left < self.least) | (right < self.least)] = 0
                    gain[:, len(cuts[f]):] = 0
                    top = gain.argmax(1)
                    better = gain[np.arange(width), top] > best
                    best[better], pick[better], where[better] = gain[np.arange(width), top][better], f, top[better]
                first = width - 1
                for k in range(width):
                    if where[k] >= 0:
                        feature[first + k], threshold[first + k] = pick[k], cuts[pick[k]][where[k]]
                at = at * 2 + (x[np.arange(len(y)), feature[first + at]] > threshold[first + at])
            g, h = np.bincount(at, grad, 1 << self.depth), np.bincount(at, hess, 1 << self.depth)
            leaves = -self.rate * g / (h + self.smooth)
            self.nodes.append((feature, threshold, leaves))
            total += leaves[at]
        return self

    def sums(self, x: np.ndarray) -> np.ndarray:
        out, row = np.full(len(x), self.base), np.arange(len(x))
        for feature, threshold, leaves in self.nodes:
            at = np.zeros(len(x), np.int64)
            for level in range(self.depth):
                first = (1 << level) - 1
                at = at * 2 + (x[row, feature[first + at]] > threshold[first + at])
            out += leaves[at]
        return out


def isotonic(score: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: (scores, probabilities), both ascending, to interpolate between."""
    order = np.argsort(score, kind="stable")
    blocks: list[list[float]] = []  # weight, weight * y, weight * score
    for s, v, w in zip(score[order], y[order], weight[order]):
        blocks.append([w, w * v, w * s])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    b = np.array(blocks)
    return b[:, 2] / b[:, 0], b[:, 1] / b[:, 0]


@dataclass
class Model:
    learned: frozenset[str]
    stems: frozenset[str]
    trees: Trees | None
    knots: tuple[np.ndarray, np.ndarray] | None
    constant: float = 0.0

    def scores(self, texts: Sequence[str]) -> np.ndarray:
        if self.trees is None or not len(texts):
            return np.full(len(texts), self.constant)
        x = np.array([features(t, self.learned, self.stems) for t in texts])
        return np.clip(np.interp(self.trees.sums(x), *self.knots), 0, 1)


def fold(doc_id: Column, folds: int) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def learn_lexicon(texts: DataFrame) -> list[tuple[frozenset[str], frozenset[str]]]:
    """(words, word beginnings) that toxic texts hold far more often: in three
    different ones at least, and at twenty times the share among clean ones.
    One pair for each part of the sample, learned without it, and one from all."""
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}\p{N}]+"), F.lit(0)))
    distinct = save(texts.dropDuplicates(["text"]).select("part", "toxic", words.alias("_w")), "toxic-words")
    n = {(r["part"], r["toxic"]): r["count"] for r in distinct.groupBy("part", "toxic").count().collect()}
    cells = [(p, t) for p in range(PARTS) for t in (1, 0)]
    begun = F.array_distinct(F.transform(F.filter("_w", lambda w: F.length(w) >= STEM), lambda w: F.substring(w, 1, STEM)))
    found = []
    for kind in (F.col("_w"), begun):
        counts = distinct.select("part", "toxic", F.explode(kind).alias("w")).groupBy("w").agg(
            *[F.count_if((F.col("part") == p) & (F.col("toxic") == t)).alias(f"n{p}{t}") for p, t in cells])
        bad, good = (sum((F.col(f"n{p}{t}") for p in range(PARTS)), F.lit(0)) for t in (1, 0))
        # what is telling without a part is telling enough with it to be on this list
        some = counts.where((bad >= 3) & (bad / max(1, sum(n.get((p, 1), 0) for p in range(PARTS))) >= 10 * good / max(1, sum(n.get((p, 0), 0) for p in range(PARTS)))))
        found.append(some.orderBy(bad.desc(), "w").limit(LEXICON).collect())

    def telling(rows, without: int | None) -> frozenset[str]:
        parts = [p for p in range(PARTS) if p != without]
        size = {t: max(1, sum(n.get((p, t), 0) for p in parts)) for t in (1, 0)}
        total = [(r["w"], sum(r[f"n{p}1"] for p in parts), sum(r[f"n{p}0"] for p in parts)) for r in rows]
        return frozenset(w for w, bad, good in total if bad >= 3 and bad / size[1] >= 20 * good / size[0])

    return [(telling(found[0], p), telling(found[1], p)) for p in [*range(PARTS), None]]


def fit(docs: DataFrame, labels: DataFrame, folds: int = 5, held_out: int = 0) -> Model:
    """Learn from labelled documents whose crc32(doc_id) mod ``folds`` is not ``held_out``."""
    known = (labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & (fold(F.col("doc_id"), folds) != held_out))
             .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")).withColumn("key", random_key("doc_id", seed="toxic")))
    chosen = known.where("toxic = 1").orderBy("key").limit(SAMPLE).unionByName(known.where("toxic = 0").orderBy("key").limit(SAMPLE))
    # at most 2 * SAMPLE ids
    part = (F.conv(F.substring(random_key("doc_id", seed="part"), 1, 8), 16, 10).cast("long") % PARTS).cast("int")
    sample = save(docs.select("doc_id", "text").join(F.broadcast(chosen.drop("key")), "doc_id").dropDuplicates(["doc_id"])
                  .select(part.alias("part"), "toxic", F.coalesce("text", F.lit("")).alias("text")), "toxic-sample")
    lexicons = learn_lexicon(sample)
    share = {int(r["toxic"]): r["count"] for r in known.groupBy("toxic").count().collect()}
    constant = share.get(1, 0) / max(1, sum(share.values()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [features(t, *lexicons[p]) for p, t in zip(b.column(0).to_pylist(), b.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(x, pa.list_(pa.float64()))], ["part", "toxic", "x"])

    rows = map_batches(sample, run, "part int, toxic int, x array<double>").toPandas()
    y, part = rows["toxic"].to_numpy(float), rows["part"].to_numpy()
    if any(len(set(y[part != p])) < 2 for p in range(PARTS)):
        return Model(*lexicons[-1], None, None, constant)
    x = np.array(rows["x"].tolist())
    # each class weighs as among all labelled rows, so scores are probabilities there
    weight = np.array([share[k] / (y == k).sum() for k in (0, 1)])[y.astype(int)]
    weight /= weight.mean()
    unseen = np.zeros(len(y))
    for p in range(PARTS):
        unseen[part == p] = Trees().fit(x[part != p], y[part != p], weight[part != p]).sums(x[part == p])
    return Model(*lexicons[-1], Trees().fit(x, y, weight), isotonic(unseen, y, weight), constant)


def scorer(spark, model: Model):
    """A column function: text -> score double."""
    ship(spark)
    known = spark.sparkContext.broadcast(model)  # lexicons and trees of bounded size

    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        return pd.Series(known.value.scores([t or "" for t in text]))

    return score


def op4(spark, sf_dir: str) -> DataFrame:
    from tillroll.llm.common import read

    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    score = scorer(spark, fit(docs, read(spark, sf_dir, "labels")))
    return (docs.select("doc_id", score("text").alias("score"))
            .select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")))

"""Language identification with a sparse multinomial logistic regression.

Character 1- to 3-grams of the lower-cased text (anything but letters counts
as one space) are hashed into ``BUCKETS`` places; weights are 1 + log tf times
idf, scaled to length 1.  The document frequencies come from all learning
documents (partial sums per task, summed by Spark).  The regression is fitted
on a bounded sample by follow-the-regularised-leader with elastic-net
penalties: of every language the learning documents with the smallest hashes of
id and text, as many of each as ``SAMPLE`` allows in all and ``LEAST`` at any
rate, so rare languages are in it whole.  Only keys are counted and ordered to
draw it, and the few texts are fetched by their keys.  A temperature fitted on a
held-back fifth of the sample calibrates the scores, and the languages' true
shares are put into the bias.  Predicting is a narrow map over all documents.

Defined cases: NULL text or one without a letter: ``und``, score 0; NULL lang
teaches nothing; repeated rows count in the frequencies and shares, are fitted
once and predicted each; of equally likely languages the first by name is
predicted; without learning documents everything is ``und``; very long texts
are counted in slices, with the counts of the whole; an empty table gives an
empty result; lang, source and doc_id are no inputs of a prediction; other
columns are not read.
"""
from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import map_batches, random_key, save, ship
from tillroll.llm.toxicity import fold

BUCKETS = 1 << 14
SAMPLE = 4000      # documents the regression is fitted on, at most
LEAST = 50         # documents of each language in it, if there are as many, also beyond SAMPLE
BINS = 1 << 12     # parts of the range of keys that are counted (three hexadecimal digits)
GROUP_DOCS, GROUP_CHARS = 48, 1 << 18
UNKNOWN = "und"

_LETTER = re.compile(r"[^\W\d_]")
_NOT_LETTERS = re.compile(r"[\W\d_]+")


def has_letter(text: str | None) -> bool:
    return bool(text) and _LETTER.search(text) is not None


def _clean(text: str) -> str:
    return _NOT_LETTERS.sub(" ", f" {text.lower()} ")


def _counts(clean: list[str], starts: int | None = None) -> np.ndarray:
    """(len(clean), BUCKETS) counts of the n-grams, of those that begin among
    the first ``starts`` characters if that is given."""
    out = np.zeros(len(clean) * BUCKETS, np.int64)
    owner = np.repeat(np.arange(len(clean)), [len(c) for c in clean])
    cp = np.frombuffer("".join(clean).encode("utf-32-le"), np.uint32).astype(np.uint64)
    h = np.zeros(len(cp), np.uint64)
    for n in range(1, 4):  # n-grams that start at each character and stay in its text
        h = h[:len(cp) - n + 1] * np.uint64(0x9E3779B97F4A7C15) + cp[n - 1:] + np.uint64(n)
        slot = (((h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - 14)).astype(np.int64)
        first, last = owner[:len(h)], owner[n - 1:]
        slot += first * BUCKETS
        out += np.bincount((slot if n == 1 else slot[first == last])[:starts], minlength=len(out))
    return out.reshape(-1, BUCKETS)


def grams(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
    """(row, bucket, count, rows) for groups of the texts in order; a very long
    text is counted slice by slice, each with the two characters that its last
    n-grams reach beyond it."""
    group: list[str] = []
    held = 0

    def out(counts: np.ndarray):
        at = np.flatnonzero(counts)
        return at // BUCKETS, at % BUCKETS, counts.reshape(-1)[at], len(counts)

    for t in texts:
        if group and (len(group) >= GROUP_DOCS or held + len(t) > GROUP_CHARS):
            yield out(_counts(group))
            group, held = [], 0
        if len(t) > GROUP_CHARS:
            total, clean = np.zeros((1, BUCKETS), np.int64), _clean(t)
            for a in range(0, len(clean), GROUP_CHARS):
                total += _counts([clean[a:a + GROUP_CHARS + 2]], GROUP_CHARS)
            yield out(total)
        else:
            group.append(_clean(t))
            held += len(t)
    if group:
        yield out(_counts(group))


@dataclass
class Model:
    langs: list[str]
    idf: np.ndarray | None = None
    weights: np.ndarray | None = None  # BUCKETS + 1 (bias) x languages
    temperature: float = 1.0

    def vectors(self, row, bucket, count, rows):
        value = (1 + np.log(count)) * self.idf[bucket]
        norm = np.sqrt(np.bincount(row, value * value, rows))
        return value / np.maximum(norm, 1e-12)[row]

    def logits(self, texts: list[str]) -> np.ndarray:
        parts = [np.zeros((0, len(self.langs)))]
        for row, bucket, count, rows in grams(texts):
            value = self.vectors(row, bucket, count, rows)
            part = np.stack([np.bincount(row, value * self.weights[bucket, k], rows) for k in range(len(self.langs))], 1)
            parts.append(part + self.weights[-1])
        return np.concatenate(parts)

    def predict(self, texts: Sequence[str | None]) -> tuple[list[str], np.ndarray]:
        lang, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
        known = [i for i, t in enumerate(texts) if has_letter(t)]
        if self.langs and known:
            p = softmax(self.logits([texts[i] for i in known]) / self.temperature)
            for i, k, s in zip(known, p.argmax(1), p.max(1)):
                lang[i], score[i] = self.langs[k], s
        return lang, score


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


class Examples:
    """Sparse rows end to end: buckets and values between offsets, and labels."""

    def __init__(self, offsets: np.ndarray, buckets: np.ndarray, values: np.ndarray, labels: np.ndarray, rows: np.ndarray | None = None):
        self.parts = offsets, buckets, values, labels
        self.rows = np.arange(len(labels)) if rows is None else rows

    def __len__(self) -> int:
        return len(self.rows)

    def __getitem__(self, i: int) -> tuple[np.ndarray, np.ndarray, int]:
        """(buckets, values, label) of a row, with the bias as last bucket."""
        offsets, buckets, values, labels = self.parts
        at = slice(offsets[self.rows[i]], offsets[self.rows[i] + 1])
        return np.append(buckets[at], BUCKETS), np.append(values[at], 1.0).astype(float), int(labels[self.rows[i]])

    def part(self, which: np.ndarray) -> Examples:
        return Examples(*self.parts, self.rows[which])

    @property
    def labels(self) -> np.ndarray:
        return self.parts[3][self.rows]


def ftrl(examples: Sequence[tuple[np.ndarray, np.ndarray, int]], classes: int, epochs: int = 3, alpha: float = 1.0, beta: float = 1.0,
         l1: float = 0.02, l2: float = 0.02, seed: int = 7) -> np.ndarray:
    """Weights (BUCKETS + 1, classes), the last row the bias, by
    follow-the-regularised-leader: per coordinate the closed-form minimum of
    the linearised losses so far, a proximal term and both penalties."""
    z, n = np.zeros((BUCKETS + 1, classes)), np.zeros((BUCKETS + 1, classes))

    def weights(zi, ni):
        return np.where(np.abs(zi) <= l1, 0.0, -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(ni)) / alpha + l2))

    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for e in rng.permutation(len(examples)):
            bucket, value, label = examples[e]
            zi, ni = z[bucket], n[bucket]
            w = weights(zi, ni)
            p = softmax(value @ w)
            p[label] -= 1
            g = value[:, None] * p
            g2 = g * g
            z[bucket] = zi + g - (np.sqrt(ni + g2) - np.sqrt(ni)) / alpha * w
            n[bucket] = ni + g2
    return weights(z, n)


def fit_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the smallest log loss, by golden section on its logarithm."""
    if not len(labels):
        return 1.0

    def loss(log_t: float) -> float:
        p = softmax(logits / np.exp(log_t))
        return -np.log(np.maximum(p[np.arange(len(labels)), labels], 1e-12)).mean()

    a, b, g = -1.5, 3.0, (5**0.5 - 1) / 2
    for _ in range(40):
        c, d = b - g * (b - a), a + g * (b - a)
        a, b = (a, d) if loss(c) < loss(d) else (c, b)
    return float(np.exp((a + b) / 2))


def sample_sizes(counts: dict[str, int]) -> dict[str, int]:
    """Documents of each language in the sample: all of the rare ones, and as
    many of each other as ``SAMPLE`` allows, ``LEAST`` at any rate."""
    left, each = SAMPLE, 0
    for i, c in enumerate(sorted(counts.values())):
        each = left // (len(counts) - i)
        if c > each:
            break
        left -= c
        each = c
    return {lang: min(c, max(each, LEAST)) for lang, c in counts.items()}


def draw(learning: DataFrame) -> tuple[DataFrame, dict[str, int], dict[str, int]]:
    """The sample of ``learning`` (lang, text, key), and the numbers of its rows
    and of all rows by language.  Distinct keys are counted by bins of their
    range; only the bin in which a language's share ends is ordered."""
    spark = learning.sparkSession
    keys = (learning.groupBy("lang", "key").agg(F.count(F.lit(1)).alias("rows"))
            .withColumn("bin", F.conv(F.substring("key", 1, 3), 16, 10).cast("int")))
    keys = save(keys, "lang-keys")
    bins = save(keys.groupBy("lang", "bin").agg(F.count(F.lit(1)).alias("keys"), F.sum("rows").alias("rows")), "lang-bins")
    counts, distinct = {}, {}
    for r in bins.groupBy("lang").agg(F.sum("keys").alias("keys"), F.sum("rows").alias("rows")).orderBy("lang").collect():  # a row a language
        counts[r["lang"]], distinct[r["lang"]] = r["rows"], r["keys"]
    sizes = sample_sizes(distinct)
    wanted = spark.createDataFrame(list(sizes.items()), "lang string, wanted long")
    before = F.sum("keys").over(Window.partitionBy("lang").orderBy("bin")) - F.col("keys")  # at most BINS rows a language
    taken = (bins.withColumn("before", before).join(wanted, "lang").where("before < wanted")
             .select("lang", "bin", "keys", F.least("keys", F.col("wanted") - F.col("before")).alias("taken")))
    near = keys.join(taken, ["lang", "bin"])
    place = F.row_number().over(Window.partitionBy("lang", "bin").orderBy("key"))
    last = near.where("taken < keys").withColumn("place", place).where("place <= taken")
    chosen = save(near.where("taken = keys").select("lang", "key").unionByName(last.select("lang", "key")), "lang-chosen")
    return learning.join(chosen, ["lang", "key"]).dropDuplicates(["lang", "key"]).select("key", "lang", "text"), sizes, counts


def fit(docs: DataFrame, folds: int = 3, held_out: int = 1) -> Model:
    """Learn from documents with a lang whose crc32(doc_id) mod ``folds`` is not ``held_out``."""
    learning = (docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold(F.col("doc_id"), folds) != held_out))
                .select("doc_id", "lang", "text", random_key("doc_id", "text", seed="lang").alias("key")))

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, total = np.zeros(BUCKETS, np.int64), 0
        for b in batches:
            for row, bucket, _, rows in grams([t for t in b.column(0).to_pylist() if t]):
                df += np.bincount(bucket, minlength=BUCKETS)
                total += rows
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1), pa.int32()), pa.array(np.append(df[at], total), pa.int64())], ["bucket", "df"])

    counted = map_batches(learning.select("text"), frequencies, "bucket int, df long").groupBy("bucket").agg(F.sum("df").alias("df")).toPandas()
    df = dict(zip(counted["bucket"], counted["df"]))  # at most BUCKETS + 1 rows
    total = df.pop(-1, 0)
    if not total:
        return Model([])
    idf = np.full(BUCKETS, np.log(1 + total) + 1)
    idf[list(df)] = np.log((1 + total) / (1 + np.array(list(df.values())))) + 1

    chosen, sizes, counts = draw(learning)
    sample = save(chosen.repartition(8, "key"), "lang-sample")
    langs = sorted(counts)
    model = Model(langs, idf)
    place = {name: i for i, name in enumerate(langs)}

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(k, lang, t) for k, lang, t in zip(*[c.to_pylist() for c in b.columns]) if has_letter(t)]
            at = 0
            for row, bucket, count, n in grams([t for _, _, t in rows]):
                value = model.vectors(row, bucket, count, n)
                cuts = np.searchsorted(row, np.arange(1, n))
                mine = rows[at:at + n]
                at += n
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k for k, _, _ in mine]), pa.array([place[x] for _, x, _ in mine], pa.int32()),
                     pa.array([x.astype(np.int32) for x in np.split(bucket, cuts)], pa.list_(pa.int32())),
                     pa.array([x.astype(np.float32) for x in np.split(value, cuts)], pa.list_(pa.float32()))], ["key", "label", "bucket", "value"])

    rows = map_batches(sample, sparse, "key string, label int, bucket array<int>, value array<float>").toArrow()
    label = rows["label"].to_numpy()
    examples = Examples(np.concatenate([[0], np.cumsum(pc.list_value_length(rows["bucket"]).to_numpy())]),
                        pc.list_flatten(rows["bucket"]).to_numpy(), pc.list_flatten(rows["value"]).to_numpy(), label,
                        np.lexsort((label, rows["key"].to_numpy().astype(str))))
    del rows
    back = np.arange(len(examples)) % 5 == 0
    kept_back, taught = examples.part(back), examples.part(~back)
    model.weights = ftrl(taught if len(taught) else examples, len(langs))
    logits = np.array([v @ model.weights[b] for b, v, _ in kept_back]).reshape(len(kept_back), len(langs))
    model.temperature = fit_temperature(logits, kept_back.labels)
    # the sample's shares of the languages are replaced by the true ones
    model.weights[-1] += model.temperature * np.log([counts[x] / sizes[x] for x in langs])
    return model


def identifier(spark, model: Model):
    """A column function: text -> struct of lang_pred and score."""
    ship(spark)
    known = spark.sparkContext.broadcast(model)  # BUCKETS x languages weights

    @F.pandas_udf("lang_pred string, score double")
    def identify(text: pd.Series) -> pd.DataFrame:
        lang, score = known.value.predict(text.tolist())
        return pd.DataFrame({"lang_pred": lang, "score": score})

    return identify


def op7(spark, sf_dir: str) -> DataFrame:
    from tillroll.llm.common import read

    docs = read(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    identify = identifier(spark, fit(docs))
    return (docs.select("doc_id", identify("text").alias("_found"))
            .select("doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), "_found.lang_pred", "_found.score"))

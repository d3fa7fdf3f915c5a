"""Toxicity by class-conditional Kneser-Ney language models (operator 5).

Two interpolated bigram models, of toxic and of ordinary text:

    P_c(w|u) = max(N_c(uw) - D, 0) / N_c(u) + g_c(u) * R_c(w|u)      pairs of the class
    R_c(w|u) = max(N(uw) - D', 0) / N(u)    + g(u)   * P_c(w)        pairs of both classes together
    P_c(w)   = max(T_c(w) - E_c, 0) / T_c   + h_c    * P(w)          T_c(w): distinct words before w in the class
    P(w)     = count of w / count of all words                       all documents

where g and h give back what the discounts take. The shared counts of pairs and of words smooth what is rare in a
class: a pair or word that one sample meets by chance is not taken for an expression of that class. Every discount is
n1 / (n1 + 2 n2) of its own counts of counts. Words are lower-cased runs of letters and digits, known by 64-bit hashes;
the table of shared counts grows with the corpus. Of it a model needs the words of its labelled sample only: for any
other word P(w) is a factor of both classes and leaves the difference. So what is broadcast is bounded by the sample,
``TRAIN_DOCS`` documents and ``TRAIN_CHARS`` characters of each class.

A text's signals, from the differences of log-likelihoods of its words (toxic less ordinary), are the mean over its
words, and, over the square root of their number, the sums of what single words exceed ``MARGIN`` by: on the toxic side
of the whole models, and on either side of the word models P_c(w). The mean alone finds few of the texts that hold
some toxic words among hundreds of others (held-out AUC 0.61 to 0.85 on the given tables, 0.96 to 0.999 with the others).
A logistic curve, fitted on a fold of the labelled rows that the counts do not use, turns the signals into a score.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import textcore as tc
from .common import columns, packed, stored, table, unpacked

#: Labelled rows of each class, at most, that the class models are fitted on.
TRAIN_DOCS = 4000
#: Characters of all of them, at most, which bounds the pairs that reach the driver and are broadcast; a text of more than a tenth of it is not among them.
TRAIN_CHARS = 16_000_000
#: Nats by which one word must favour a class before its excess counts as an expression of that class.
MARGIN = 2.5
SIGNALS = 4

#: Word separators: ASCII white space, controls and punctuation.
BREAKS = np.zeros(256, bool)
BREAKS[:128] = [not chr(i).isalnum() for i in range(128)]
START = np.uint64(0)


def word_hashes(data, offs) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, row = tc.spans(data, offs, BREAKS)
    return tc.hash_spans(data, starts, ends, tc.LOWER_TABLE), row


def previous(words, row) -> np.ndarray:
    u = np.empty_like(words)
    u[1:] = words[:-1]
    if len(words):
        u[np.r_[True, row[1:] != row[:-1]]] = START
    return u


def _summed_counts(words: np.ndarray):
    key, n = np.unique(words, return_counts=True)
    return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n)], ["w", "n"])


def _word_counts(batches):
    held, size = [], 0
    for _, data, offs in tc.chunks(batches, "text"):
        words, _ = word_hashes(data, offs)
        held.append(words)
        size += len(words)
        if size > 2_000_000:
            yield _summed_counts(np.concatenate(held))
            held, size = [], 0
    if size:
        yield _summed_counts(np.concatenate(held))


def _pair_counts(batches):
    """Counts by class of word pairs (u, w)."""
    for rows, data, offs in tc.chunks(batches, "text", 4 << 20):
        w, row = word_hashes(data, offs)
        u = previous(w, row)
        toxic = rows.column(1).to_numpy(zero_copy_only=False).astype(bool)[row]
        _, first, inverse = np.unique(tc.mix(u + np.uint64(1)) ^ w, return_index=True, return_inverse=True)
        n = [np.bincount(inverse[toxic == c], minlength=len(first)).astype(np.int32) for c in (False, True)]
        yield pa.RecordBatch.from_arrays([pa.array(u[first].view(np.int64)), pa.array(w[first].view(np.int64)), pa.array(n[0]), pa.array(n[1])], ["u", "w", "n0", "n1"])


def discount(counts: np.ndarray) -> float:
    """n1 / (n1 + 2 n2) of positive counts; a half where none is 1."""
    one, two = int((counts == 1).sum()), int((counts == 2).sum())
    return one / (one + 2 * two) if one else 0.5


class Model:
    """Both class models over a vocabulary of word hashes, from pair counts and the shared probability of words."""

    def __init__(self, u: np.ndarray, w: np.ndarray, counts: list[np.ndarray], shared: dict[str, np.ndarray], total: int):
        self.vocabulary = np.union1d(np.unique(u), np.unique(w))
        size = len(self.vocabulary)
        key = np.searchsorted(self.vocabulary, u) * size
        key += np.searchsorted(self.vocabulary, w)
        order = np.argsort(key)
        self.pairs = key[order]
        del key
        first, second = (self.pairs // size).astype(np.int32), (self.pairs % size).astype(np.int32)
        counts = [n[order] for n in counts]
        spread = np.zeros(size)
        spread[np.searchsorted(self.vocabulary, shared["w"])] = shared["n"] / total

        def level(n):
            d = discount(n[n > 0])
            context, kinds = np.bincount(first, n, size), np.bincount(first[n > 0], minlength=size)
            left = np.where(context > 0, d * kinds / np.maximum(context, 1), 1.0)
            return np.maximum(n - d, 0) / np.maximum(context[first], 1), left

        pooled, pooled_left = level(counts[0] + counts[1])
        self.direct, self.left, self.word, self.other = [], [], [], []
        for n in counts:
            own, own_left = level(n)
            kinds = np.bincount(second[n > 0], minlength=size)
            d, all_kinds = discount(kinds[kinds > 0]), max(1, int(kinds.sum()))
            h = d * int((kinds > 0).sum()) / all_kinds if kinds.any() else 1.0
            self.direct.append((own + own_left[first] * pooled).astype(np.float32))
            self.left.append((own_left * pooled_left).astype(np.float32))
            self.word.append((np.maximum(kinds - d, 0) / all_kinds + h * spread).astype(np.float32))
            self.other.append(h)

    def gains(self, words: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Differences of log-likelihood of every word: of the whole models, and of the word models."""
        size = len(self.vocabulary)
        w = np.minimum(np.searchsorted(self.vocabulary, words), size - 1)
        known = self.vocabulary[w] == words
        u, after = np.empty_like(w), np.empty_like(known)
        u[1:], after[1:] = w[:-1], known[:-1]
        if len(w):
            head = np.r_[True, row[1:] != row[:-1]]
            u[head] = np.searchsorted(self.vocabulary, START)
            after[head] = self.vocabulary[u[head]] == START
        both = np.flatnonzero(known & after)
        key = u[both] * size + w[both]
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        hit = self.pairs[at] == key
        both, at = both[hit], at[hit]
        whole, word = [], []
        for c in (0, 1):
            q = np.where(known, self.word[c][w], self.other[c])
            p = np.where(after, self.left[c][u], 1.0) * q
            p[both] += self.direct[c][at]
            word.append(np.log(q))
            whole.append(np.log(p))
        return whole[1] - whole[0], word[1] - word[0]

    def signals(self, data, offs) -> np.ndarray:
        """By row, ``SIGNALS`` numbers; zeros for a row without a word."""
        words, row = word_hashes(data, offs)
        whole, word = self.gains(words, row)
        rows = len(offs) - 1
        n = np.maximum(np.bincount(row, minlength=rows), 1)
        excess = [np.bincount(row, np.maximum(x - MARGIN, 0), rows) / np.sqrt(n) for x in (whole, word, -word)]
        return np.stack([np.bincount(row, whole, rows) / n, *excess], 1)


def fold(column="doc_id"):
    """The fold of a document: crc32 of its id as text, modulo 5; 0 is held out. Null for a null id."""
    return F.crc32(F.col(column).cast("string")) % 5


def _arrays(df: DataFrame) -> dict[str, np.ndarray]:
    t = df.toArrow()
    return {c: t[c].to_numpy() for c in t.column_names}


def _signalled(model):
    def run(batches):
        for rows, data, offs in tc.chunks(batches, "text"):
            yield pa.RecordBatch.from_arrays([rows.column(1), *(pa.array(x.copy()) for x in model.value.signals(data, offs).T)], ["toxic", *(f"x{k}" for k in range(SIGNALS))])

    return run


class Curve:
    """A logistic curve over the scaled signals, fitted by Newton steps with a small ridge."""

    def __init__(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray, steps: int = 80):
        self.centre, self.scale = x.mean(0), np.where(x.std(0) > 0, x.std(0), 1.0)
        f, weight = self._scaled(x), weight / weight.sum()
        self.w = np.zeros(f.shape[1])
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(f @ self.w, -30, 30)))
            h = (f * (weight * p * (1 - p))[:, None]).T @ f + 1e-4 * np.eye(len(self.w))
            self.w += np.clip(np.linalg.solve(h, f.T @ (weight * (y - p)) - 1e-4 * self.w), -2, 2)

    def _scaled(self, x):
        return np.c_[(x - self.centre) / self.scale, np.ones(len(x))]

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self._scaled(x) @ self.w, -30, 30)))


def word_counts(docs: DataFrame) -> DataFrame:
    """(w, n): how often each word, by hash, occurs in all of ``docs``."""
    return docs.select("text").mapInArrow(_word_counts, "w long, n long").groupBy("w").agg(F.sum("n").alias("n"))


def model_of(docs: DataFrame, sample: DataFrame) -> Model:
    """The class models of ``sample`` (text, toxic), with shared counts of ``docs``."""
    counts = sample.select("text", "toxic").mapInArrow(_pair_counts, "u long, w long, n0 int, n1 int")
    counts = stored(counts.groupBy("u", "w").agg(F.sum("n0").cast("int").alias("n0"), F.sum("n1").cast("int").alias("n1")), "pairs")
    shared = stored(word_counts(docs), "words")
    total = shared.agg(F.sum("n")).first()[0] or 1
    own = _arrays(shared.join(counts.select("w").distinct(), "w"))
    pairs = _arrays(counts)
    return Model(pairs["u"].view(np.uint64), pairs["w"].view(np.uint64), [pairs["n0"], pairs["n1"]], {"w": own["w"].view(np.uint64), "n": own["n"]}, total)


def within(docs: DataFrame, picked: DataFrame, chars: int | None = None) -> DataFrame:
    """Of ``picked`` (doc_id, toxic, fold), in order of a hash, those whose texts have not more than ``chars`` characters in all by class."""
    chars = chars or TRAIN_CHARS
    sizes = docs.join(F.broadcast(picked), "doc_id").groupBy("doc_id", "toxic", "fold").agg(F.sum(F.coalesce(F.length("text"), F.lit(0))).alias("n"))
    order = Window.partitionBy("toxic").orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, 0)  # TRAIN_DOCS rows of numbers
    return sizes.where(F.col("n") <= chars // 10).withColumn("sum", F.sum("n").over(order)).where(F.col("sum") <= chars).select("doc_id", "toxic", "fold")


def train(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS):
    """(broadcast model, curve), or None where a class has no labelled training row with a word."""
    spark = docs.sparkSession
    named = columns(labels, doc_id="long", toxic="int").where("toxic in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    named = named.withColumn("fold", fold()).where("fold <> 0")
    there = [named.where(F.col("toxic") == k).count() for k in (0, 1)]
    each = min(train_docs, *there)
    if not each:
        return None
    picked = [named.where(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(each) for k in (0, 1)]
    sample = docs.join(F.broadcast(within(docs, picked[0].union(picked[1]))), "doc_id").select("text", "toxic", "fold").where("text rlike '[^\\\\x00-\\\\x7F]|[0-9A-Za-z]'")
    sample = stored(sample.dropDuplicates(["text"]), "labelled")
    fitted = sample.where("fold <> 4")
    if fitted.select("toxic").distinct().count() < 2:
        return None
    held = spark.sparkContext.broadcast(model_of(docs, fitted))
    tuned = sample.where("fold = 4") if sample.where("fold = 4").select("toxic").distinct().count() == 2 else sample
    points = _arrays(tuned.select("text", "toxic").mapInArrow(_signalled(held), "toxic int, " + ", ".join(f"x{k} double" for k in range(SIGNALS))))
    y = points["toxic"].astype(float)
    return held, Curve(np.stack([points[f"x{k}"] for k in range(SIGNALS)], 1), y, np.where(y == 1, there[1], there[0]).astype(float))


def _scores(trained, data, offs) -> np.ndarray:
    """Scores of a chunk's rows; a row without a word, which has no evidence, gets at most 0.49."""
    if trained is None:
        return np.zeros(len(offs) - 1)
    model, curve = trained
    score = curve(model.value.signals(data, offs))
    starts, _, row = tc.spans(data, offs, BREAKS)
    bare = np.bincount(row, minlength=len(score)) == 0
    score[bare] = np.minimum(score[bare], 0.49)
    return score


def _scorer(trained):
    def run(batches):
        for rows, data, offs in tc.chunks(batches, "text"):
            score = _scores(trained, data, offs)
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], ["doc_id", "score", "predicted"])

    return run


def score(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted.

    Null, empty and blank texts have no evidence: they get at most 0.49. Without labelled training rows of both classes
    every score is 0. A doc_id labelled more than once is toxic if any label says so; equal texts of the sample count
    once. A null doc_id is not held out, and is never trained on. Repeated rows are scored each; long texts are read
    whole; extra columns are ignored; an empty table gives no rows.
    """
    docs = columns(docs, doc_id="long", text="string")
    scored = docs.mapInArrow(_scorer(train(docs, labels, train_docs)), "doc_id long, score double, predicted int")
    return scored.select("doc_id", F.coalesce(fold() == 0, F.lit(False)).alias("held_out"), "score", "predicted")


def keep_ordinary(docs: DataFrame, labels: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with all their columns.

    Texts are scored where the rows are: the verdict is a column of the same pass, so nothing is joined back.
    """
    trained = train(columns(docs, doc_id="long", text="string"), labels, **how)

    def run(batches):
        for rows, data, offs in tc.chunks(batches, "text"):
            yield rows.filter(pa.array(_scores(trained, data, offs) < 0.5))

    rows = packed(docs, text=F.col("text").cast("string"))
    return unpacked(rows.mapInArrow(run, rows.schema), docs.columns)


def op5_toxicity_kn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))

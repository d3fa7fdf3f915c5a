"""Quality rules with line sequence labelling (operator 1).

A linear-chain conditional random field marks every line of a text as content or boilerplate. A line is
described by binary signals (symbols, case, digits, repetition, length, ending), packed in one code, so that the
emission scores are a table over codes. Weights are fitted on a bounded sample of labelled documents. The labels are of
documents, those of lines are hidden: a document's quality only makes its own kind of line likelier, by ``OWN_SHARE``.
Lines are labelled first by how often their code occurs in documents of either quality, and then, in ``ROUNDS`` rounds of
hard expectation-maximisation, by Viterbi decoding under the field fitted to the labels so far. So documents get lines of
both kinds, and transitions are learned where the kind changes. The most likely labelling of each text is found by
Viterbi decoding, vectorised over the texts of a chunk. The share of words on content lines decides.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textcore as tc
from .common import columns, table

#: Labelled documents of each class, at most, that the field is fitted on.
TRAIN_DOCS = 2000
#: The share of a document's lines that are taken to be of its own kind, before they are looked at.
OWN_SHARE = 0.6
ROUNDS = 2
CONTENT_SHARE = 0.5
MIN_WORDS = 10
MAX_REPEAT = (100, 20)  # 100 * n_repeat_words > 20 * n_words fails
WINDOW = 5
FEATURES = ("symbols", "many_symbols", "pipes", "capitals", "digits", "repeated_line", "repeated_words", "few_words", "long", "sentence_end", "exclaims", "long_words")

_NEWLINE = np.zeros(256, bool)
_NEWLINE[10] = True


def _flags(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars.encode())] = True
    return out


_SYMBOL, _PIPE, _DIGIT, _BANG = _flags("#*$%&|<>"), _flags("|"), _flags("0123456789"), _flags("!")
_UPPER, _LOWER = _flags("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _flags("abcdefghijklmnopqrstuvwxyz")
_END = _flags(".?!:;\"')")


def _per(positions: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """How many of the ascending positions lie in each span."""
    return np.searchsorted(positions, ends) - np.searchsorted(positions, starts)


def measure(data: np.ndarray, offs: np.ndarray) -> tuple[dict, np.ndarray, np.ndarray, np.ndarray]:
    """Base counts by row; row, feature code and words of every line that has a word."""
    n = len(offs) - 1
    starts, ends, row = tc.spans(data, offs)
    hashes = tc.hash_spans(data, starts, ends)
    n_words = np.bincount(row, minlength=n)
    heads = np.flatnonzero(((data & 0xC0) != 0x80) & ~tc.SPACE[data])
    word_chars = _per(heads, offs[:-1], offs[1:])
    symbols = np.flatnonzero(_SYMBOL[data])
    n_symbols = _per(symbols, offs[:-1], offs[1:])

    s, r = tc.shingles(hashes, row, WINDOW, short=False)
    covered = np.zeros(len(starts), bool)
    if len(s):
        key = tc.mix(s ^ tc.mix(r.astype(np.uint64) + np.uint64(1)))
        _, inverse, count = np.unique(key, return_inverse=True, return_counts=True)
        at = np.flatnonzero(row[: len(row) - WINDOW + 1] == row[WINDOW - 1 :])[count[inverse] > 1]
        step = np.zeros(len(starts) + 1, np.int64)
        step[at] += 1
        step[at + WINDOW] -= 1
        covered = np.cumsum(step[:-1]) > 0
    n_repeat = np.bincount(row[covered], minlength=n)

    a, b, line_row = tc.spans(data, offs, _NEWLINE)
    words = _per(starts, a, b)
    has = words > 0
    a, b, line_row, words = a[has], b[has], line_row[has], words[has]
    lines = len(a)
    key = tc.mix(tc.hash_spans(data, a, b) ^ tc.mix(line_row.astype(np.uint64) + np.uint64(1))) if lines else np.zeros(0, np.uint64)
    unique, first, inverse, count = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
    n_dup = np.bincount(line_row, minlength=n) - np.bincount(line_row[first], minlength=n)

    size = b - a
    sym, up, low = _per(symbols, a, b), _per(np.flatnonzero(_UPPER[data]), a, b), _per(np.flatnonzero(_LOWER[data]), a, b)
    rep = np.concatenate([[0], np.cumsum(covered)])
    first_word = np.searchsorted(starts, a)
    last = data[ends[first_word + words - 1] - 1] if lines else np.zeros(0, np.uint8)
    bits = (
        sym * 50 > size,
        sym * 10 > size,
        _per(np.flatnonzero(_PIPE[data]), a, b) > 1,
        up > low,
        _per(np.flatnonzero(_DIGIT[data]), a, b) * 5 > size,
        count[inverse] > 1,
        (rep[first_word + words] - rep[first_word]) * 3 > words,
        words <= 3,
        words >= 12,
        _END[last],
        _per(np.flatnonzero(_BANG[data]), a, b) * 4 > words,
        size > 14 * words,
    )
    code = np.zeros(lines, np.int64)
    for k, bit in enumerate(bits):
        code |= bit.astype(np.int64) << k
    base = {"n_words": n_words, "word_chars": word_chars, "n_symbols": n_symbols, "n_dup_lines": n_dup, "n_repeat_words": n_repeat}
    return base, line_row, code, words


def _padded(sequences: list[np.ndarray]) -> np.ndarray:
    width = max(map(len, sequences))
    x = np.full((len(sequences), width), -1, np.int64)
    for i, s in enumerate(sequences):
        x[i, : len(s)] = s
    return x


_CODES = np.arange(1 << len(FEATURES))
_BITS = np.concatenate([(_CODES[:, None] >> np.arange(len(FEATURES))) & 1, np.ones((len(_CODES), 1), int)], 1).astype(float)


def log_likelihood(w: np.ndarray, t: np.ndarray, x: np.ndarray, y: np.ndarray, scale: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Log-likelihood of the labels ``y`` of the padded codes ``x`` (-1: no line), each sequence weighing ``scale``, and its
    gradients by feature weights and transitions."""
    live = x >= 0
    safe, gold = np.where(live, x, 0), np.where(live, y, 0)
    e = (_BITS @ w)[safe]
    alpha = np.empty_like(e)
    alpha[:, 0] = e[:, 0]
    width = x.shape[1]
    for i in range(1, width):
        v = np.logaddexp(alpha[:, i - 1, 0, None] + t[0], alpha[:, i - 1, 1, None] + t[1]) + e[:, i]
        alpha[:, i] = np.where(live[:, i, None], v, alpha[:, i - 1])
    z = np.logaddexp(alpha[:, -1, 0], alpha[:, -1, 1])
    path = (np.take_along_axis(e, gold[:, :, None], 2)[:, :, 0] * live).sum(1) + (t[gold[:, :-1], gold[:, 1:]] * live[:, 1:]).sum(1)
    beta, grad_t = np.zeros_like(e), np.zeros_like(t)
    np.add.at(grad_t, (gold[:, :-1], gold[:, 1:]), live[:, 1:] * scale[:, None])
    for i in range(width - 2, -1, -1):
        nxt = e[:, i + 1] + beta[:, i + 1]
        v = np.logaddexp(t[:, 0] + nxt[:, 0, None], t[:, 1] + nxt[:, 1, None])
        on = live[:, i + 1]
        beta[:, i] = np.where(on[:, None], v, 0.0)
        pair = np.exp(alpha[on, i, :, None] + t + nxt[on, None, :] - z[on, None, None])
        grad_t -= (pair * scale[on, None, None]).sum(0)
    p = np.exp(alpha + beta - z[:, None, None])
    weight = np.broadcast_to(scale[:, None], x.shape)[live]
    hist = [np.bincount(safe[live], weight * ((gold[live] == k) - p[live][:, k]), len(_CODES)) for k in (0, 1)]
    return float(((path - z) * scale).sum()), np.stack([h @ _BITS for h in hist], 1), grad_t


def fit(sequences: list[np.ndarray], labels: list[np.ndarray], quality: list[int], steps: int = 80, l2: float = 1e-3) -> tuple[np.ndarray, np.ndarray]:
    """Emission table (codes x 2) and transitions (2 x 2) of the field; label 1 is content.

    Gradient ascent (Adam) on the mean log-likelihood, the documents of either quality weighing alike. Sequences are cut to
    64 lines.
    """
    parts = [(s[i : i + 64], y[i : i + 64], q) for s, y, q in zip(sequences, labels, quality, strict=True) for i in range(0, len(s), 64)]
    x, y = _padded([p for p, _, _ in parts]), _padded([p for _, p, _ in parts])
    q = np.array([k for _, _, k in parts])
    scale = np.where(q == 1, 0.5 / max(1, (q == 1).sum()), 0.5 / max(1, (q == 0).sum())) / (x >= 0).sum(1)
    values = (np.zeros((len(FEATURES) + 1, 2)), np.zeros((2, 2)))
    moment = [(np.zeros_like(v), np.zeros_like(v)) for v in values]
    for step in range(1, steps + 1):
        _, *grads = log_likelihood(*values, x, y, scale)
        for value, grad, (m, v) in zip(values, grads, moment, strict=True):
            grad = grad - l2 * value
            m += 0.1 * (grad - m)
            v += 0.01 * (grad * grad - v)
            value += 0.2 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return _BITS @ values[0], values[1]


def fit_hidden(sequences: list[np.ndarray], quality: list[int], own: float = OWN_SHARE, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """The field of sequences whose documents' quality alone is known."""
    code, size = np.concatenate(sequences), np.array([len(s) for s in sequences])
    row, good = np.repeat(np.arange(len(size)), size), np.repeat(np.array(quality), size) == 1
    prior = np.where(good, 1, -1) * np.log(own / (1 - own))
    weight = 1 / size[row]
    share = [np.bincount(code[good == k], weight[good == k], len(_CODES)) for k in (False, True)]
    share = [(n + 0.5 * 2.0 ** -len(FEATURES)) / (n.sum() + 0.5) for n in share]
    label = (np.log(share[1][code]) - np.log(share[0][code]) + prior >= 0).astype(np.int64)
    cut = np.cumsum(size)[:-1]
    for _ in range(rounds):
        emission, transition = fit(sequences, np.split(label, cut), quality)
        scores = emission[code]
        scores[:, 1] += prior
        label = viterbi(row, np.arange(len(code)), len(size), scores, transition).astype(np.int64)
    return fit(sequences, np.split(label, cut), quality)


def viterbi(row: np.ndarray, code: np.ndarray, n_rows: int, emission: np.ndarray, transition: np.ndarray) -> np.ndarray:
    """The most likely labels of all lines (sorted by row), ties to content."""
    length = np.bincount(row, minlength=n_rows)
    first = np.concatenate([[0], np.cumsum(length)[:-1]])
    order = np.argsort(-length, kind="stable")
    order = order[length[order] > 0]
    e = emission[code]
    label = np.zeros(len(code), np.int8)
    if not len(order):
        return label
    start, size = first[order], length[order]
    back = np.zeros((len(code), 2), np.int8)
    score = e[start]
    for i in range(1, int(size[0])):
        m = int(np.searchsorted(-size, -i, "left"))
        at = start[:m] + i
        step = score[:m, :, None] + transition
        pick = step[:, 1, :] >= step[:, 0, :]
        back[at] = pick
        score[:m] = np.where(pick, step[:, 1, :], step[:, 0, :]) + e[at]
    now = (score[:, 1] >= score[:, 0]).astype(np.int8)
    label[start + size - 1] = now
    for i in range(int(size[0]) - 1, 0, -1):
        m = int(np.searchsorted(-size, -i, "left"))
        at = start[:m] + i
        now[:m] = back[at, label[at]]
        label[at - 1] = now[:m]
    return label


def _codes(batches):
    for rows, data, offs in tc.chunks(batches, "text"):
        _, row, code, _ = measure(data, offs)
        cut = np.searchsorted(row, np.arange(rows.num_rows + 1))
        out = [code[a:b].astype("<i2").tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([rows.column(1), pa.array(out, pa.binary())], ["quality", "codes"])


def train(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS) -> tuple[np.ndarray, np.ndarray] | None:
    """The field, fitted on at most ``train_docs`` labelled documents of each class; None if a class has none."""
    named = columns(labels, doc_id="long", quality="int").where("quality in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    picked = [named.where(F.col("quality") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_docs) for k in (0, 1)]
    sample = columns(docs, doc_id="long", text="string").join(F.broadcast(picked[0].union(picked[1])), "doc_id")
    rows = sample.select("text", "quality").mapInArrow(_codes, "quality int, codes binary").collect()
    pairs = sorted((r.quality, bytes(r.codes)) for r in rows if r.codes)
    if len({q for q, _ in pairs}) < 2:
        return None
    return fit_hidden([np.frombuffer(c, "<i2").astype(np.int64) for _, c in pairs], [q for q, _ in pairs])


SCHEMA = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, content_share double"


def _judge(model, share: float):
    def run(batches):
        for rows, data, offs in tc.chunks(batches, "text"):
            n = rows.num_rows
            base, row, code, words = measure(data, offs)
            label = viterbi(row, code, n, *model) if model else np.ones(len(code), np.int8)
            total = np.bincount(row, words, n)
            content = np.bincount(row, words * label, n) / np.maximum(total, 1)
            failed = (base["n_words"] < MIN_WORDS) | (MAX_REPEAT[0] * base["n_repeat_words"] > MAX_REPEAT[1] * base["n_words"])
            cols = [pa.array(v.astype(np.int64)) for v in base.values()]
            yield pa.RecordBatch.from_arrays([rows.column(0), *cols, pa.array(failed), pa.array(~failed & (content >= share)), pa.array(content)], [f.split()[0] for f in SCHEMA.split(", ")])

    return run


def judge(docs: DataFrame, labels: DataFrame, share: float = CONTENT_SHARE, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """One row per row of ``docs``: the base counts, base_failed, kept and content_share.

    A null text counts as empty: no words, so base_failed. With no labelled document of a class that has a line, every
    line is content and the base rules alone decide. Long texts are read whole. A doc_id labelled more than once takes its least label. Repeated rows
    are judged each; extra columns are ignored; an empty table gives no rows.
    """
    model = train(docs, labels, train_docs)
    return columns(docs, doc_id="long", text="string").mapInArrow(_judge(model, share), SCHEMA)


def op1_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))

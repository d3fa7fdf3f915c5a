"""Ranked lexical search over a clustered index (operator 12).

**Order of documents.** Recursive graph bisection splits documents into two halves again and again, and swaps documents between halves
while that lowers the cost of the gaps of both halves' postings, sum over terms of d1 log2(n1 / (d1 + 1)) + d2 log2(n2 / (d2 + 1)).
It is fitted on a bounded sample (``SAMPLE_DOCS`` documents by hash, of each the ``SAMPLE_TERMS`` terms of smallest hash).
Every document then goes down the tree to the side where its terms' postings are denser, so that all documents, the
sample among them, are clustered by the same rule. A leaf's documents are cut into blocks of bounded size, by hash: a leaf that
holds a third of all rows has as many more blocks.

**Index.** One row a block: its documents, its terms (64-bit hashes, sorted) with their numbers of documents and largest impacts, and the postings.
A document is known by its place in the block; its doc_id is looked up for the results, and for ties.

**Search.** The bound of a block for a query is the sum of its terms' weights times their largest impacts there. Blocks are visited in
falling order of their bound, in three waves; after a wave, a query's blocks whose bound is below its k-th best score so far are
never visited, those that equal it are, as a smaller doc_id may win. So the results are those of scoring everything.
Queries come in batches of bounded size; a task keeps the k best for each query of its batch, whatever it has read.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import textcore as tc
from .common import columns, shared_dir, stored, table
from .toxicity_kn import word_hashes

K = 20
#: Documents that the bisection is fitted on, about; terms of each, at most; terms that the tree knows, at most.
SAMPLE_DOCS, SAMPLE_TERMS, TREE_TERMS = 2048, 128, 1 << 15
#: 2 ** DEPTH clusters.
DEPTH, SWAPS = 6, 12
#: A block holds about so many documents and postings.
BLOCK_DOCS, BLOCK_POSTINGS = 2048, 1 << 20
#: Distinct terms of all queries of a batch, about.
BATCH_TERMS = 1_000_000
#: Blocks of the first two waves, for each query.
WAVES = (8, 64)


def postings(data, offs):
    """By row: number of terms; then row, term and occurrences of each different term of a row, sorted."""
    words, row = word_hashes(data, offs)
    order = np.lexsort((words, row))
    w, r = words[order], row[order]
    at = np.flatnonzero(np.r_[True, (w[1:] != w[:-1]) | (r[1:] != r[:-1])]) if len(w) else np.empty(0, np.int64)
    return np.bincount(row, minlength=len(offs) - 1), r[at], w[at], np.diff(np.r_[at, len(w)])


class Tree:
    """Nodes in heap order, each with a weight for every known term and a threshold of their mean."""

    def __init__(self, sketches: list[np.ndarray], depth: int = DEPTH):
        self.depth, n = depth, len(sketches)
        flat = np.concatenate(sketches) if n else np.empty(0, np.uint64)
        doc = np.repeat(np.arange(n), [len(s) for s in sketches])
        terms, df = np.unique(flat, return_counts=True)
        many = np.lexsort((terms, -df))[:TREE_TERMS]
        self.terms = np.sort(terms[many[df[many] > 1]])
        doc, term = self._known(doc, flat)
        self.weights, self.least = np.zeros((2**depth - 1, len(self.terms)), np.float32), np.zeros(2**depth - 1)
        node = np.zeros(n, np.int64)
        for at in range(2**depth - 1):
            mine = np.flatnonzero(node == at)
            if len(mine) > 1:
                place = np.full(n, -1)
                place[mine] = np.arange(len(mine))
                own = place[doc] >= 0
                self._split(at, place[doc[own]], term[own], len(mine))
            node[mine] = 2 * at + 1 + self._right(np.full(len(mine), at), *self._of(mine, doc, term, n))

    @staticmethod
    def _of(mine, doc, term, n):
        place = np.full(n, -1)
        place[mine] = np.arange(len(mine))
        own = place[doc] >= 0
        return place[doc[own]], term[own]

    def _known(self, row, words):
        if not len(self.terms):
            return row[:0], np.empty(0, np.int64)
        at = np.minimum(np.searchsorted(self.terms, words), len(self.terms) - 1)
        hit = self.terms[at] == words
        return row[hit], at[hit]

    def _split(self, at, doc, term, n):
        """Halves of n documents with the edges (doc, term), bettered by swaps; then the node's weights and threshold."""
        v = len(self.terms)
        side = np.arange(n) * 2 >= n
        for _ in range(SWAPS):
            right = side[doc]
            d1, d2 = np.bincount(term[~right], minlength=v), np.bincount(term[right], minlength=v)
            n1, n2 = n - side.sum(), side.sum()
            cost = lambda a, b: a * np.log2(n1 / (np.maximum(a, 0) + 1)) + b * np.log2(n2 / (np.maximum(b, 0) + 1))  # noqa: E731, B023
            now = cost(d1, d2)
            gain = np.bincount(doc, np.where(right, (now - cost(d1 + 1, d2 - 1))[term], (now - cost(d1 - 1, d2 + 1))[term]), n)
            left, rest = np.flatnonzero(~side), np.flatnonzero(side)
            left, rest = left[np.argsort(-gain[left], kind="stable")], rest[np.argsort(-gain[rest], kind="stable")]
            m = min(len(left), len(rest))
            swapped = np.flatnonzero(gain[left[:m]] + gain[rest[:m]] > 1e-9)
            if not len(swapped):
                break
            side[left[swapped]], side[rest[swapped]] = True, False
        d1, d2 = np.bincount(term[~side[doc]], minlength=v), np.bincount(term[side[doc]], minlength=v)
        self.weights[at] = np.log2((d1 + 1) / (n - side.sum())) - np.log2((d2 + 1) / side.sum())
        self.least[at] = np.median(self._means(np.full(n, at), doc, term))

    def _means(self, node, row, term):
        n = len(node)
        return np.bincount(row, self.weights[node[row], term], n) / np.maximum(np.bincount(row, minlength=n), 1)

    def _right(self, node, row, term):
        return self._means(node, row, term) < self.least[node]

    def leaves(self, rows: int, row, words) -> np.ndarray:
        """The leaf of each of ``rows`` documents with the given terms."""
        row, term = self._known(row, words)
        node = np.zeros(rows, np.int64)
        for _ in range(self.depth):
            node = 2 * node + 1 + self._right(node, row, term)
        return node - (2**self.depth - 1)


def _sketches(batches):
    for rows, data, offs in tc.chunks(batches, "text"):
        _, row, words, _ = postings(data, offs)
        starts = np.searchsorted(row, np.arange(rows.num_rows + 1))
        yield pa.RecordBatch.from_arrays([pa.array([words[a : min(b, a + SAMPLE_TERMS)].tobytes() for a, b in zip(starts[:-1], starts[1:])], pa.binary())], ["terms"])


def fit(docs: DataFrame) -> Tree:
    """The bisection tree of a sample of ``docs`` (doc_id, text): what reaches the driver is bounded by the sample's parameters."""
    share = min(1.0, SAMPLE_DOCS / max(1, docs.count()))
    picked = docs.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) < int(share * (1 << 30)))
    found = picked.select("text").mapInArrow(_sketches, "terms binary").limit(2 * SAMPLE_DOCS).collect()
    return Tree([np.frombuffer(t, np.uint64) for t in sorted(bytes(r.terms) for r in found)])


def _measured(tree: Tree):
    def run(batches):
        total = np.zeros((4, 2**tree.depth), np.int64)
        for rows, data, offs in tc.chunks(batches, "text"):
            n, row, words, _ = postings(data, offs)
            leaf = tree.leaves(rows.num_rows, row, words)
            for k, x in enumerate((np.ones(len(n)), n > 0, n, np.bincount(row, minlength=len(n)))):
                total[k] += np.bincount(leaf, x, total.shape[1]).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.shape[1], dtype=np.int32)), *map(pa.array, total)], ["leaf", "docs", "with_terms", "terms", "postings"])

    return run


def _binaries(data: np.ndarray, counts: np.ndarray) -> pa.Array:
    ends = np.r_[0, np.cumsum(counts)] * data.itemsize
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])


def _forward(tree: Tree, parts: dict[int, int]):
    """Rows of a document: its block, and its terms with their occurrences."""
    most = np.array([parts.get(k, 1) for k in range(2**tree.depth)])

    def run(batches):
        for rows, data, offs in tc.chunks(batches, "text"):
            n, row, words, tf = postings(data, offs)
            leaf = tree.leaves(rows.num_rows, row, words)
            block = leaf * (1 << 32) + rows.column(1).to_numpy() % most[leaf]
            counts = np.bincount(row, minlength=len(n))
            yield pa.RecordBatch.from_arrays([pa.array(block), rows.column(0), pa.array(n), _binaries(words, counts), _binaries(tf.astype(np.uint32), counts)], ["block", "doc_id", "n", "terms", "tfs"])

    return run


def _narrow(x: np.ndarray) -> bytes:
    """Unsigned integers in the fewest bytes that hold them; the reader knows their number."""
    return x.astype(np.min_scalar_type(int(x.max()) if len(x) else 0)).tobytes()


def _wide(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, f"u{len(raw) // n}" if n else np.uint8).astype(np.int64)


_BLOCK = "block long, leaf int, ids array<long>, m binary, terms binary, df binary, top binary, place binary, tf binary"


def _inverted(documents: int, length: int):
    """One row of the index of all rows of a block."""

    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by([("doc_id", "ascending"), ("n", "ascending"), ("terms", "ascending")])
        terms, tf = (np.frombuffer(b"".join(t[c].to_pylist()), kind) for c, kind in (("terms", np.uint64), ("tfs", np.uint32)))
        counts = np.array([len(x) for x in t["terms"].to_pylist()]) // 8
        place, tf = np.repeat(np.arange(len(counts)), counts), tf.astype(np.int64)
        m = 75 + (25 * t["n"].to_numpy().astype(np.int64) * documents) // max(length, 1)
        order = np.lexsort((place, terms))
        place, tf = place[order], tf[order]
        found, start, df = np.unique(terms[order], return_index=True, return_counts=True)
        top = np.maximum.reduceat(impact(tf, m[place]), start) if len(start) else start
        block = t["block"][0].as_py()
        row = {"block": block, "leaf": block >> 32, "ids": t["doc_id"].to_pylist(), "m": m.tobytes(), "terms": found.tobytes(), "df": _narrow(df), "top": _narrow(top), "place": _narrow(place), "tf": _narrow(tf)}
        kinds = [("block", pa.int64()), ("leaf", pa.int32()), ("ids", pa.list_(pa.int64())), *((c, pa.binary()) for c in ("m", "terms", "df", "top", "place", "tf"))]
        return pa.Table.from_pylist([row], pa.schema(kinds))

    return run


def impact(tf, m):
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


@dataclass
class Index:
    """Blocks of postings under ``path``, in folders by cluster; documents with a term, and terms of all documents."""

    spark: SparkSession
    path: str
    documents: int
    length: int

    def blocks(self, *names: str, leaves: list[int] | None = None) -> DataFrame:
        rows = self.spark.read.schema(_BLOCK).parquet(self.path)
        return (rows if leaves is None else rows.where(F.col("leaf").isin(leaves))).select(*names)


def build(docs: DataFrame) -> Index:
    """The clustered index of every row of ``docs`` (doc_id, text). Null texts have no terms; a null doc_id is one, after all
    others; repeated rows are documents of their own."""
    spark = docs.sparkSession
    docs = columns(docs, doc_id="long", text="string")
    tree = fit(docs)
    sizes = docs.select("text").mapInArrow(_measured(tree), "leaf int, docs long, with_terms long, terms long, postings long")
    sizes = sizes.groupBy("leaf").agg(*(F.sum(c).alias(c) for c in ("docs", "with_terms", "terms", "postings"))).collect()  # one row a cluster
    parts = {r.leaf: max(1, -(-r.docs // BLOCK_DOCS), -(-r.postings // BLOCK_POSTINGS)) for r in sizes}
    documents, length = sum(r.with_terms for r in sizes), sum(r.terms for r in sizes)
    spread = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 40)).alias("spread")
    forward = docs.select("doc_id", spread, "text").mapInArrow(_forward(tree, parts), "block long, doc_id long, n long, terms binary, tfs binary")
    path = f"{shared_dir(spark)}/search-{uuid.uuid4().hex}"
    forward.groupBy("block").applyInArrow(_inverted(documents, length), _BLOCK).write.partitionBy("leaf").parquet(path)
    return Index(spark, path, documents, length)


@dataclass
class Batch:
    """Queries with their terms: names, and (query, term, occurrences) as arrays; ``terms`` sorted, with their weights."""

    names: list
    query: np.ndarray
    term: np.ndarray
    times: np.ndarray
    terms: np.ndarray
    weight: np.ndarray | None = None

    def found(self, terms: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Of the batch's terms, which a block has, and where."""
        have = np.frombuffer(terms, np.uint64)
        if not len(have):
            return np.zeros(len(self.terms), bool), np.zeros(len(self.terms), np.int64)
        at = np.minimum(np.searchsorted(have, self.terms), len(have) - 1)
        return have[at] == self.terms, at

    def bounds(self, terms: bytes, top: bytes) -> np.ndarray:
        has, at = self.found(terms)
        most = np.where(has, _wide(top, len(terms) // 8)[at], 0) if len(terms) else np.zeros(len(self.terms), np.int64)
        out = np.zeros(len(self.names), np.int64)
        np.add.at(out, self.query, self.times * self.weight[self.term] * most[self.term])
        return out


def _terms(batches):
    for rows, data, offs in tc.chunks(batches, "text"):
        _, row, words, tf = postings(data, offs)
        yield pa.RecordBatch.from_arrays([rows.column(0).take(pa.array(row)), rows.column(1).take(pa.array(row)), pa.array(words.view(np.int64)), pa.array(tf)], ["item_id", "q", "term", "times"])


def batches_of(items: DataFrame):
    """The queries (item_id, text) in batches of about BATCH_TERMS terms; equal rows are one query."""
    items = columns(items, item_id="long", text="string").where("text is not null").distinct()
    pairs = stored(items.select("item_id", F.xxhash64("item_id", "text").alias("q"), "text").mapInArrow(_terms, "item_id long, q long, term long, times long"), "queries")
    n = -(-pairs.count() // BATCH_TERMS)
    for k in range(n):
        t = pairs.where(F.pmod("q", F.lit(n)) == k).toPandas()
        t = t.sort_values(["q", "term"])
        _, first, query = np.unique(t["q"].to_numpy(), return_index=True, return_inverse=True)
        terms, term = np.unique(t["term"].to_numpy().view(np.uint64), return_inverse=True)
        ids = t["item_id"].to_numpy()[first]
        yield Batch([None if i is None or i != i else int(i) for i in ids], query, term, t["times"].to_numpy(), terms)


def _frequencies(batch: Batch):
    def run(batches):
        df = np.zeros(len(batch.terms), np.int64)
        for b in batches:
            for terms, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                has, at = batch.found(terms)
                df[has] += _wide(n, len(terms) // 8)[at[has]]
        k = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(df[k])], ["t", "df"])

    return run


def _bounds(batch: Batch):
    def run(batches):
        for b in batches:
            for leaf, terms, top in zip(*(c.to_pylist() for c in b.columns)):
                bound = batch.bounds(terms, top)
                k = np.flatnonzero(bound)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), leaf, np.int32)), pa.array(k), pa.array(bound[k])], ["leaf", "q", "bound"])

    return run


def _better(score, ids, null, k):
    """Places of the k best by score, then id, null last."""
    if len(score) > 4 * k:
        few = np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k])
    else:
        few = np.arange(len(score))
    return few[np.lexsort((ids[few], null[few], -score[few]))[:k]]


def _visited(batch: Batch, low: np.ndarray, high: np.ndarray, k: int):
    """For each query its k best of the blocks whose bound is at least ``low`` and below ``high``."""
    start = np.searchsorted(batch.query, np.arange(len(batch.names) + 1))

    def run(batches):
        best = {}
        for b in batches:
            for ids, m, terms, df, top, place, tf in zip(*(c.to_pylist() for c in b.columns)):
                bound = batch.bounds(terms, top)
                visits = np.flatnonzero((bound >= low) & (bound < high))
                if not len(visits):
                    continue
                null = np.array([i is None for i in ids])
                ids = np.array([i or 0 for i in ids], np.int64)
                df = _wide(df, len(terms) // 8)
                total, ends = int(df.sum()), np.cumsum(df)
                place = _wide(place, total)
                worth = impact(_wide(tf, total), np.frombuffer(m, np.int64)[place])
                has, at = batch.found(terms)
                for q in visits.tolist():
                    p = np.arange(start[q], start[q + 1])
                    p = p[has[batch.term[p]]]
                    where = at[batch.term[p]]
                    n = df[where]
                    each = np.repeat(ends[where] - np.cumsum(n), n) + np.arange(n.sum())
                    score = np.zeros(len(ids), np.int64)
                    np.add.at(score, place[each], np.repeat(batch.times[p] * batch.weight[batch.term[p]], n) * worth[each])
                    hit = np.flatnonzero(score)
                    hit = hit[_better(score[hit], ids[hit], null[hit], k)]
                    had = best.get(q, (score[:0], ids[:0], null[:0]))
                    s, i, z = (np.r_[x, y] for x, y in zip(had, (score[hit], ids[hit], null[hit])))
                    keep = _better(s, i, z, k)
                    best[q] = s[keep], i[keep], z[keep]
        for q, (s, i, z) in best.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(s), q)), pa.array([batch.names[q]] * len(s), pa.int64()), pa.array(i, mask=z), pa.array(s)], ["q", "item_id", "doc_id", "score"])

    return run


def _best(rows: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("q").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search_batch(index: Index, batch: Batch, k: int = K) -> tuple[DataFrame, dict[str, int]]:
    """(item_id, rank, doc_id, score) of the batch, and how many blocks its queries had to offer and visited."""
    spark = index.spark
    df = index.blocks("terms", "df").mapInArrow(_frequencies(batch), "t long, df long").groupBy("t").agg(F.sum("df").alias("df")).collect()  # one row a term of the batch
    batch.weight = np.zeros(len(batch.terms), np.int64)
    for r in df:
        batch.weight[r.t] = math.floor(1000 * math.log((2 * index.documents + 2) / (2 * r.df + 1)))
    bounds = stored(index.blocks("leaf", "terms", "top").mapInArrow(_bounds(batch), "leaf int, q long, bound long"), "bounds")
    ranked = bounds.withColumn("k", F.row_number().over(Window.partitionBy("q").orderBy(F.col("bound").desc(), "leaf")))
    cuts = {w: np.zeros(len(batch.names), np.int64) for w in WAVES}
    for w in WAVES:
        for r in ranked.where(F.col("k") <= w).where(F.col("k") == w).select("q", "bound").collect():  # one row a query
            cuts[w][r.q] = r.bound
    top, least = np.full(len(batch.names), np.iinfo(np.int64).max), np.ones(len(batch.names), np.int64)
    found, seen = None, {"offered": bounds.count(), "visited": 0}
    for w in (*WAVES, None):
        low = least if w is None else np.maximum(least, cuts[w])
        limits = spark.createDataFrame([(q, int(a), int(b)) for q, (a, b) in enumerate(zip(low, top))], "q long, low long, high long")
        open_ = bounds.join(limits, "q").where("bound >= low and bound < high").groupBy("leaf").agg(F.count("*").alias("n")).collect()  # one row a cluster
        if open_:
            seen["visited"] += sum(r.n for r in open_)
            rows = index.blocks("ids", "m", "terms", "df", "top", "place", "tf", leaves=[r.leaf for r in open_]).mapInArrow(_visited(batch, low, top, k), "q long, item_id long, doc_id long, score long")
            rows = stored(_best(rows, k).drop("rank"), "found")
            found = rows if found is None else found.unionByName(rows)
            for r in _best(found, k).where(F.col("rank") == k).collect():  # one row a query
                least[r.q] = max(1, r.score)
        top = np.minimum(top, low)
    if found is None:
        found = spark.createDataFrame([], "q long, item_id long, doc_id long, score long")
    return _best(found, k).select("item_id", "rank", "doc_id", "score"), seen


def search(index: Index, items: DataFrame, k: int = K) -> DataFrame:
    """The k documents of highest score above 0 for every query of ``items`` (item_id, text).

    Equal scores go by ascending doc_id, null last. Null texts and texts without a term have no results; a null item_id is an
    id; equal rows are one query, rows of one id with other texts are each their own. Long texts are read whole; extra
    columns are ignored; empty tables give no rows.
    """
    out = None
    for batch in batches_of(items):
        rows, _ = search_batch(index, batch, k)
        out = rows if out is None else out.unionByName(rows)
    return index.spark.createDataFrame([], "item_id long, rank int, doc_id long, score long") if out is None else out


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(build(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"))


_SPLIT = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

ORACLE = f"""
with d as materialized (select row_number() over () as r, doc_id, {_SPLIT} as terms from documents where text is not null),
s as (select r, doc_id, len(terms)::bigint as n from d where len(terms) > 0),
g as (select count(*)::bigint as docs, sum(n)::bigint as length from s),
i as (select dense_rank() over (order by item_id, text) as q, item_id, text from (select distinct item_id, text from benchmark)),
q as (select q, item_id, term, count(*)::bigint as times from (select q, item_id, unnest({_SPLIT}) as term from i) group by all),
p as materialized (select r, term, count(*)::bigint as tf from (select r, unnest(terms) as term from d) where term in (select term from q) group by all),
w as (select term, floor(1000 * ln((2 * docs + 2) / (2 * df + 1)::double))::bigint as w from (select term, count(*)::bigint as df from p group by term), g),
x as (select q, item_id, r, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // length))))::bigint as score
      from q join p using (term) join w using (term) join s using (r), g group by all)
select item_id, row_number() over (partition by q order by score desc, doc_id nulls last)::int as rank, doc_id, score from x where score > 0 qualify rank <= {K}
"""

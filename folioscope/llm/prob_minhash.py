"""MinHash near-duplicate detection with ProbMinHash signatures (operator 10).

Texts are weighted sets of five-word shingles, a shingle's weight being its count in the text. Each element
sends a Poisson process of arrivals of rate equal to its weight; an arrival falls into a random register and
the earliest one stays, and an element ends as soon as its next arrival is later than every register of its
text. The share of equal registers estimates the probability Jaccard similarity

    J_P(x, y) = sum over d of 1 / sum over d' of max(x_d'/x_d, y_d'/y_d),

which is the plain Jaccard similarity where all weights are equal. Registers are banded, buckets give candidate
pairs, and every candidate is verified with the exact J_P of the two texts.

Plan: (1) one Arrow pass makes signatures, stored once; (2) texts of equal word sequence collapse to one node, which
gets a number of its own, before any comparison; (3) buckets with the same members collapse to one; (4) within a bucket
of different components, candidates are, round by round, the edges of a maximum spanning forest of each block of
``BLOCK`` members, in buckets of several blocks those of a forest over one member of each component, the closest few of
each member outside the bucket's largest component, and then every pair that is left; each round is verified by exact J_P
and joined into components before the next. The last round verifies where the members meet, so that links leave a task
but never the pairs of a group. A pair is verified if it shares a band and its registers do not tell it from the threshold:
``least_agreement`` is set so low that the estimate loses a tenth, at most, of what the bands lose by themselves.

No task grows with a bucket: members of the largest component of a bucket are compared in blocks with the others only,
so the work on a hot bucket grows with the number of its members outside that component. The joins on buckets leave
a hot bucket to the engine's splitting of skewed partitions.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textcore as tc
from .common import columns, packed, partitions_for, stored, table, unpacked

K = 5
THRESHOLD = 0.8
BANDS = 26
ROWS = 5
#: Registers of a signature; the first BANDS * ROWS are banded, all estimate.
REGISTERS = 256
BLOCK = 4000
BLOCK_BYTES = 32 << 20
#: Links that are united at once within a task, and bytes of links for a task.
LINKS_AT_ONCE = 1_000_000
LINK_BYTES = 16 << 20
_GOLD = 0x9E3779B97F4A7C15


def least_agreement(threshold: float, bands: int, rows: int, registers: int) -> float:
    """The share of equal registers below which a pair of that similarity falls a tenth as often as all bands miss it."""
    allowed, tail = (1 - threshold**rows) ** bands / 10, 0.0
    for k in range(registers + 1):
        tail += math.comb(registers, k) * threshold**k * (1 - threshold) ** (registers - k)
        if tail > allowed:
            return k / registers
    return 1.0


def weighted_shingles(data, offs, k=K):
    """Distinct shingles by row: hashes, rows, counts (sorted by row)."""
    starts, ends, row = tc.spans(data, offs)
    hashes = tc.hash_spans(data, starts, ends)
    s, r = tc.shingles(hashes, row, k)
    key = tc.mix(s ^ tc.mix(r.astype(np.uint64) + np.uint64(1)))
    _, first, count = np.unique(key, return_index=True, return_counts=True)
    order = np.argsort(r[first], kind="stable")
    first, count = first[order], count[order]
    return s[first], r[first], count, hashes, row


def signatures(elements, row, weight, n_rows: int, m: int) -> np.ndarray:
    """n_rows x m registers, each the element of the earliest arrival (0 where a row has no element)."""
    times = np.full(n_rows * m, np.inf)
    best = np.zeros(n_rows * m, np.uint64)
    limit = np.full(n_rows, np.inf)
    rate = 1.0 / weight
    clock = np.zeros(len(elements))
    i = 0
    while len(elements):
        i += 1
        u = tc.mix(elements + np.uint64(i * _GOLD % (1 << 64)))
        clock = clock - np.log1p((u >> np.uint64(11)) * -(2.0**-53)) * rate
        live = clock < limit[row]
        if not live.all():
            elements, row, rate, clock, u = elements[live], row[live], rate[live], clock[live], u[live]
        slot = row * m + ((tc.mix(u) >> np.uint64(32)) * np.uint64(m) >> np.uint64(32)).astype(np.int64)
        np.minimum.at(times, slot, clock)
        won = times[slot] == clock
        best[slot[won]] = elements[won]
        limit = times.reshape(n_rows, m).max(1)
    return best.reshape(n_rows, m)


def sequence_keys(hashes, row, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of each row's word sequence, as two signed 64-bit arrays."""
    n = np.bincount(row, minlength=n_rows)
    first = np.concatenate([[0], np.cumsum(n)])
    at = (np.arange(len(row)) - first[row]).astype(np.uint64)
    out = []
    for seed in (0x5851F42D4C957F2D, 0x14057B7EF767814F):
        c = np.concatenate([np.zeros(1, np.uint64), np.cumsum(tc.mix(hashes + at * np.uint64(seed)), dtype=np.uint64)])
        out.append(tc.mix(c[first[1:]] - c[first[:-1]] + n.astype(np.uint64)).view(np.int64))
    return out[0], out[1]


def _signed(bands: int, rows: int, k: int, registers: int = REGISTERS):
    def run(batches):
        seeds = tc.mix(np.arange(1, bands + 1, dtype=np.uint64))
        for rows_, data, offs in tc.chunks(batches, "text", 1 << 20):
            n = rows_.num_rows
            s, r, w, hashes, row = weighted_shingles(data, offs, k)
            full = signatures(s, r, w.astype(float), n, registers)
            sig = full[:, : bands * rows].reshape(n, bands, rows)
            b = np.zeros((n, bands), np.uint64) + seeds
            for j in range(rows):
                b = tc.mix(b + sig[:, :, j] * tc.SHINGLE[j])
            k1, k2 = sequence_keys(hashes, row, n)
            some = np.bincount(row, minlength=n) > 0
            sizes = np.where(some, bands, 0)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(b[some].ravel().view(np.int64)))
            short = [x.tobytes() for x in (tc.mix(full) >> np.uint64(48)).astype("<u2")]
            yield pa.RecordBatch.from_arrays([rows_.column(0), pa.array(np.diff(offs).astype(np.int32)), pa.array(k1), pa.array(k2), lists, pa.array(short, pa.binary())], ["doc_id", "bytes", "k1", "k2", "bands", "sig"])

    return run


def similarity(x: np.ndarray, xw: np.ndarray, y: np.ndarray, yw: np.ndarray) -> float:
    """Exact J_P of two weighted sets (distinct elements, positive weights)."""
    if not len(x) or not len(y):
        return float(len(x) == len(y))
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    if not len(i):
        return 0.0
    a, b = xw[i].astype(float), yw[j].astype(float)
    only_x, only_y = xw.sum() - a.sum(), yw.sum() - b.sum()
    ratio = a / b
    ends, at = np.unique(ratio, return_inverse=True)
    a_by, b_by = np.bincount(at, a, len(ends)), np.bincount(at, b, len(ends))
    above = only_x + a_by[::-1].cumsum()[::-1]  # ratio at least as large: x decides
    below = only_y + b_by.cumsum() - b_by
    return float((1.0 / (above[at] / a + below[at] / b)).sum())


def _verifier(threshold: float, k: int):
    def side(column):
        data, offs = tc.text_buffers(column)
        s, r, w, _, _ = weighted_shingles(data, offs, k)
        cut = np.searchsorted(r, np.arange(len(offs)))
        return s, w, cut

    def run(batches):
        for rows, _, _ in tc.chunks(batches, "text_a"):
            sa, wa, ca = side(rows.column(2))
            sb, wb, cb = side(rows.column(3))
            sim = np.array([similarity(sa[ca[i] : ca[i + 1]], wa[ca[i] : ca[i + 1]], sb[cb[i] : cb[i + 1]], wb[cb[i] : cb[i + 1]]) for i in range(rows.num_rows)])
            keep = pa.array(sim >= threshold)
            yield pa.RecordBatch.from_arrays([rows.column(0).filter(keep), rows.column(1).filter(keep)], ["a", "b"])

    return run


def _keyed(batches):
    """The rows with the keys k1, k2 of their texts."""
    for rows, data, offs in tc.chunks(batches, "text"):
        starts, ends, row = tc.spans(data, offs)
        k1, k2 = sequence_keys(tc.hash_spans(data, starts, ends), row, rows.num_rows)
        yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(k1), pa.array(k2)], [*rows.schema.names, "k1", "k2"])


def keyed(rows: DataFrame) -> DataFrame:
    from pyspark.sql.types import LongType, StructField, StructType

    return rows.mapInArrow(_keyed, StructType([*rows.schema.fields, StructField("k1", LongType()), StructField("k2", LongType())]))


def _contracted(batches):
    """Links (u, v) with the connectivity of the given ones, from each node to the least of those it is linked to, by
    union-find over ``LINKS_AT_ONCE`` links at a time."""
    up: dict[int, int] = {}

    def root(x):
        while up[x] != x:
            up[x] = x = up[up[x]]
        return x

    def out():
        found = [(x, root(x)) for x in up]
        found = [(x, r) for x, r in found if x != r]
        return pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([r for _, r in found], pa.int64())], ["u", "v"])

    size = 0
    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = root(up.setdefault(a, a)), root(up.setdefault(b, b))
            if a != b:
                up[max(a, b)] = min(a, b)
        size += batch.num_rows
        if size >= LINKS_AT_ONCE:
            yield out()
            up, size = {}, 0
    if up:
        yield out()


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """(node, component): the least node of each connected component, of links (a, b) that are stored.

    Links are contracted within tasks, as many as their size asks for. Until every node has one link, to a node that has
    none, they are joined by alternating large and small stars: every round is two hash aggregates and a join over the
    links, the rounds grow with the logarithm of the longest path, and each is stored in the shared folder. Nodes that
    are their own component may be missing.
    """

    def flat(edges):
        ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("from"), F.lit(0).alias("to")).union(edges.select("v", F.lit(0), F.lit(1)))
        return ends.groupBy("x").agg(F.sum("from").alias("from"), F.max("to").alias("to")).where("from > 1 or from + to > 1").isEmpty()

    links = links.select("a", "b")
    edges = stored(links.coalesce(partitions_for(links, LINK_BYTES, 1)).mapInArrow(_contracted, "u long, v long"), name)
    while not flat(edges):
        both = edges.union(edges.select(F.col("v"), F.col("u")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        edges = stored(small.where("u <> v").distinct(), name)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))


def _forest(sig: np.ndarray, least: float) -> list[tuple[int, int]]:
    """Edges of a maximum spanning forest of the agreement graph (Prim), those below ``least`` left out."""
    m, width = sig.shape
    best, parent = np.full(m, -1.0), np.zeros(m, np.int64)
    out_of = np.ones(m, bool)
    now, edges = 0, []
    for _ in range(m - 1):
        out_of[now] = False
        rest = np.flatnonzero(out_of)
        agree = (sig[rest] == sig[now]).sum(1) / width
        closer = agree > best[rest]
        best[rest[closer]] = agree[closer]
        parent[rest[closer]] = now
        now = int(rest[np.argmax(best[rest])])
        if best[now] >= least:
            edges.append((int(parent[now]), now))
    return edges


def _others(component: np.ndarray, side: np.ndarray):
    """(member, candidates of other components): members of side 1 against those of side 0, or, where all are of side
    2, those outside the largest component against all before them and all of that component."""
    if side[0] == 2:
        _, inverse, size = np.unique(component, return_inverse=True, return_counts=True)
        main = inverse == size.argmax()
        for i in np.flatnonzero(~main):
            yield i, np.flatnonzero((component != component[i]) & (main | (np.arange(len(component)) < i)))
    else:
        left = np.flatnonzero(side == 0)
        for i in np.flatnonzero(side == 1):
            yield i, left[component[left] != component[i]]


def _closest(sig, component, side, least: float, most: int):
    """(member, others): of the candidates of each member the closest ``most`` that agree to ``least``."""
    for i, other in _others(component, side):
        agree = (sig[other] == sig[i]).mean(1)
        near = np.flatnonzero(agree >= least)
        if len(near) > most:
            near = near[np.argpartition(-agree[near], most)[:most]]
        yield i, other[near]


def _left(sig, component, side, least: float, band: int, rows: int, bands: int):
    """(member, others): all candidates that agree to ``least``, for which this bucket's band is the first or second equal
    one: a pair that meets in many buckets comes from two at most. The second counts because registers are compared by
    16 bits, and a band can look equal that is not."""
    banded = sig[:, : rows * bands].reshape(len(sig), bands, rows)[:, : band + 1]
    for i, other in _others(component, side):
        other = other[(sig[other] == sig[i]).mean(1) >= least]
        if len(other):
            same = (banded[other] == banded[i]).all(2)
            yield i, other[same[:, band] & (same[:, :band].sum(1) <= 1)]


def _groups(batches):
    """Lists of the rows' values by column, for each group of rows that are sorted by group (the first column)."""
    held: list[list] = []
    for batch in batches:
        for row in zip(*(x.to_pylist() for x in batch.columns), strict=True):
            if held and row[0] != held[0][0]:
                yield list(zip(*held, strict=True))
                held = []
            held.append(row)
    if held:
        yield list(zip(*held, strict=True))


def _group_arrays(columns_):
    _, band, side, nodes, component, sig = columns_[:6]
    return band[0], np.array(side), np.array(nodes, np.int64), np.array(component, np.int64), np.frombuffer(b"".join(sig), "<u2").reshape(len(nodes), -1)


def _candidates(least: float, most: int | None):
    """Pairs of nodes from rows (group, band, side, node, component, sig): forest edges, or the closest ``most``."""

    def run(batches):
        for columns_ in _groups(batches):
            _, side, nodes, component, sig = _group_arrays(columns_)
            if len(nodes) < 2 or (most and len(set(columns_[4])) < 2):
                continue
            found = _closest(sig, component, side, least, most) if most else ((i, np.array([j])) for i, j in _forest(sig, least))
            pairs = [(nodes[i], nodes[j]) for i, others in found for j in others]
            if pairs:
                pairs = np.array(pairs)
                yield pa.RecordBatch.from_arrays([pa.array(pairs.min(1)), pa.array(pairs.max(1))], ["a", "b"])

    return run


def _concerned(least: float, rows: int, bands: int):
    """(group, node) of the members of ``_left`` pairs, each once."""

    def run(batches):
        for columns_ in _groups(batches):
            band, side, nodes, component, sig = _group_arrays(columns_)
            wanted = np.zeros(len(nodes), bool)
            if len(set(columns_[4])) > 1:
                for i, others in _left(sig, component, side, least, band, rows, bands):
                    if len(others):
                        wanted[i] = True
                        wanted[others] = True
            if wanted.any():
                n = int(wanted.sum())
                yield pa.RecordBatch.from_arrays([pa.array([columns_[0][0]] * n, pa.int64()), pa.array(nodes[wanted])], ["group", "node"])

    return run


def _links_within(threshold: float, least: float, rows: int, bands: int, k: int):
    """Links (a, b) that join components, of all ``_left`` pairs of rows with their text, verified in the group's task."""

    def run(batches):
        for columns_ in _groups(batches):
            band, side, nodes, component, sig = _group_arrays(columns_)
            if len(set(columns_[4])) < 2:
                continue
            data, offs = tc.text_buffers(pa.array(columns_[6], pa.large_string()))
            s, r, w, _, _ = weighted_shingles(data, offs, k)
            cut = np.searchsorted(r, np.arange(len(offs)))
            up = {c: c for c in columns_[4]}

            def root(x, up=up):
                while up[x] != x:
                    up[x] = x = up[up[x]]
                return x

            links = []
            for i, others in _left(sig, component, side, least, band, rows, bands):
                mine = slice(cut[i], cut[i + 1])
                for j in others:
                    a, b = root(int(component[i])), root(int(component[j]))
                    if a != b:
                        other = slice(cut[j], cut[j + 1])
                        if similarity(s[mine], w[mine], s[other], w[other]) >= threshold:
                            up[max(a, b)] = min(a, b)
                            links.append((int(nodes[i]), int(nodes[j])))
            if links:
                yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in links], pa.int64()), pa.array([x for _, x in links], pa.int64())], ["a", "b"])

    return run


def _dealt(rows: DataFrame) -> DataFrame:
    return rows.repartition("group").sortWithinPartitions("group", "node").select("group", "band", "side", "node", "component", "sig")


def in_blocks(placed: DataFrame, block: int) -> DataFrame:
    """Rows (bucket, band, node, component, sig) of buckets of over one component, each bucket in blocks."""
    size = placed.groupBy("bucket").agg(F.count("*").alias("n"), F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("bucket", F.ceil(F.col("n") / block).alias("blocks"))
    own = F.pmod(F.xxhash64("node", F.lit(1)), F.col("blocks"))
    return placed.join(size, "bucket").withColumns({"group": F.xxhash64("bucket", own), "side": F.lit(2)})


def against_largest(placed: DataFrame, block: int) -> DataFrame:
    """The rows of buckets of over one component in groups such that every pair of different components of a bucket is in
    one: blocks of the largest component (side 0) with blocks of the rest (1), and the latter with each other."""
    size = placed.groupBy("bucket", "component").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"))
    size = size.groupBy("bucket").agg(F.max(F.struct("n", "bytes", "component")).alias("most"), F.sum("n").alias("n"), F.sum("bytes").alias("bytes")).where("most.n < n")
    blocks = lambda n, size: F.ceil(F.greatest(n / block, size / BLOCK_BYTES))
    size = size.select("bucket", F.col("most.component").alias("main"), blocks(F.col("most.n"), F.col("most.bytes")).alias("mains"), blocks(F.col("n") - F.col("most.n"), F.col("bytes") - F.col("most.bytes")).alias("rests"))
    h = F.xxhash64("node", F.lit(1))
    rows = placed.join(size, "bucket").withColumns({"is_main": F.col("component") == F.col("main"), "at": F.pmod(h, F.when(F.col("component") == F.col("main"), F.col("mains")).otherwise(F.col("rests")))})
    place = lambda kind, i, j, side: F.struct(F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"), side.cast("int").alias("side"))
    upto = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
    mine = F.transform(upto("rests"), lambda j: place("m", F.col("at"), j, F.lit(0)))
    rest = F.concat(
        F.transform(upto("mains"), lambda i: place("m", i, F.col("at"), F.lit(1))),
        F.transform(upto("rests"), lambda j: place("r", F.least(j, F.col("at")), F.greatest(j, F.col("at")), F.when(j == F.col("at"), 2).when(j > F.col("at"), 0).otherwise(1))),
    )
    rows = rows.withColumn("to", F.explode(F.when(F.col("is_main"), mine).otherwise(rest)))
    return rows.select(F.xxhash64("bucket", "to.kind", "to.i", "to.j").alias("group"), "band", F.col("to.side").alias("side"), "node", "component", "sig")


def classes(docs: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS, k: int = K, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """(doc_id, k1, k2) of every row, and of every distinct text (k1, k2, class_id, first): the least doc_id of its class,
    and whether it is the text that stands for the class, the least by (doc_id, k1, k2), null last."""
    docs = columns(docs, doc_id="long", text="string")
    sigs = stored(docs.mapInArrow(_signed(bands, rows, k), "doc_id long, bytes int, k1 long, k2 long, bands array<long>, sig binary"), "signatures")
    nodes = sigs.groupBy("k1", "k2").agg(F.min("doc_id").alias("doc_id"), F.max("bytes").cast("long").alias("bytes"), F.min(F.struct("bands", "sig")).alias("s"))
    nodes = stored(nodes.select(F.monotonically_increasing_id().alias("node"), "k1", "k2", "doc_id", "bytes", "s.bands", "s.sig"), "nodes")

    keys = nodes.select("node", F.posexplode("bands").alias("band", "bucket"))
    sets = keys.groupBy("bucket").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y")).where("n > 1")
    distinct = sets.groupBy("n", "x", "y").agg(F.min("bucket").alias("bucket")).select("bucket")
    member = stored(keys.join(distinct, "bucket", "left_semi").join(nodes.select("node", "bytes", "sig"), "node").select("bucket", "band", "node", "bytes", "sig"), "members")

    chosen = nodes.join(member.select("node").distinct(), "node", "left_semi").select("node", F.col("doc_id").alias("of"), "k1", "k2")
    unnamed = keyed(docs.where("doc_id is null")).groupBy("k1", "k2").agg(F.first("text").alias("text"))
    named = keyed(docs.where("doc_id is not null")).join(chosen.withColumnRenamed("of", "doc_id"), ["doc_id", "k1", "k2"]).select("node", "text").dropDuplicates(["node"])
    texts = stored(named.union(unnamed.join(chosen.where("of is null"), ["k1", "k2"]).select("node", "text")), "texts")

    def verified(pairs: DataFrame) -> DataFrame:
        a = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
        b = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
        both = pairs.join(a, "a").join(b, "b").select("a", "b", "text_a", "text_b")
        return both.mapInArrow(_verifier(threshold, k), "a long, b long")

    def one_each(placed: DataFrame) -> DataFrame:
        large = placed.groupBy("bucket").count().where(F.col("count") > block).select("bucket")
        some = placed.join(large, "bucket", "left_semi").groupBy("bucket", "component").agg(F.min("node").alias("node"), F.min("band").alias("band"))
        return some.join(nodes.select("node", "sig"), "node")

    least = least_agreement(threshold, bands, rows, REGISTERS)
    label, links, tested = None, None, None

    def placed() -> DataFrame:
        if label is None:
            return member.withColumn("component", F.col("node"))
        return member.join(label, "node", "left").withColumn("component", F.coalesce("component", "node"))

    for groups, most in ((in_blocks, None), (lambda p, n: in_blocks(one_each(p), n), None), (against_largest, 2)):
        pairs = _dealt(groups(placed(), block)).mapInArrow(_candidates(least, most), "a long, b long").distinct()
        pairs = stored(pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti"), "pairs")
        if pairs.isEmpty():
            continue
        more = stored(verified(pairs), "links")
        links = more if links is None else links.union(more)
        tested = pairs if tested is None else tested.union(pairs)
        label = components(links)
    rest = stored(against_largest(placed(), block), "left")
    concerned = _dealt(rest).mapInArrow(_concerned(least, rows, bands), "group long, node long")
    rest = rest.join(concerned, ["group", "node"]).join(texts, "node").repartition("group").sortWithinPartitions("group", "node")
    rest = rest.select("group", "band", "side", "node", "component", "sig", "text")
    more = stored(rest.mapInArrow(_links_within(threshold, least, rows, bands, k), "a long, b long"), "links")
    if not more.isEmpty():
        label = components(more if links is None else links.union(more))

    classed = nodes.select("node", "k1", "k2", "doc_id")
    classed = classed.withColumn("component", F.col("node")) if label is None else classed.join(label, "node", "left").withColumn("component", F.coalesce("component", "node"))
    lead = F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "k1", "k2")
    first = classed.groupBy("component").agg(F.min(lead).alias("lead"))
    classed = classed.join(first, "component").select("k1", "k2", F.col("lead.doc_id").alias("class_id"), ((F.col("lead.k1") == F.col("k1")) & (F.col("lead.k2") == F.col("k2"))).alias("first"))
    return sigs.select("doc_id", "k1", "k2"), classed


def near_duplicates(docs: DataFrame, **how) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, class_id, kept.

    A class is a connected component of pairs with J_P >= threshold; class_id is its least doc_id, and ``kept``
    marks the rows of that doc_id and of the text that stands for the class. Texts of equal word sequence are one class;
    so are all null, empty or blank texts. Rows that repeat a doc_id with another text are classed by their own text. A
    null doc_id is never a class's name unless the class has no other. Extra columns are ignored. An empty table gives no
    rows.
    """
    rows, classed = classes(docs, **how)
    return rows.join(classed, ["k1", "k2"]).select("doc_id", "class_id", (F.col("first") & F.col("doc_id").eqNullSafe(F.col("class_id"))).alias("kept"))


def keep_one(docs: DataFrame, **how) -> DataFrame:
    """``docs``, all columns, with one row of each class: of the text that stands for it the row of the least doc_id, or one
    of equal such rows. So a unique text stays whatever its doc_id: null, or that of another text."""
    _, classed = classes(docs, **how)
    firsts = classed.where("first").select("k1", "k2", F.col("class_id").alias("id"))
    rows = keyed(packed(docs, id=F.col("doc_id").cast("long"), text=F.col("text").cast("string")))
    named = rows.where("id is not null").join(firsts, ["k1", "k2", "id"], "left_semi").dropDuplicates(["k1", "k2", "id"])
    unnamed = rows.where("id is null").groupBy("k1", "k2").agg(F.first("row").alias("row")).join(firsts.where("id is null"), ["k1", "k2"], "left_semi")
    return unpacked(named.select("row").union(unnamed.select("row")), docs.columns)


def op10_prob_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))

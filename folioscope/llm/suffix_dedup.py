"""Exact substring deduplication by merged Burrows-Wheeler transforms (operator 2).

Removes each byte covered by a LENGTH-byte string that also starts earlier in the corpus. Suffixes of a whole corpus
cannot be ordered in one place, so they are first dealt to places where all that can be equal meets:

1. Every LENGTH-byte window has an anchor, its least-hashed GRAM-byte string (leftmost of equals). Equal windows
   have equal anchors at equal offsets. A run of windows with one anchor occurrence is a *context* of at most
   2 * LENGTH bytes. Contexts go to tasks by anchor as packed columns (one row per task and bucket); equal contexts
   are resolved at once, before the shuffle and after it: all but the earliest are removed whole.
2. Where an anchor keeps several different contexts, these become strings of shard Burrows-Wheeler transforms, and
   the transforms are merged by iterative interleave refinement: round h refines the interleave of the shards from
   the order of (h-1)-byte prefixes to that of h-byte prefixes by one stable pass over the merged transform, and the
   blocks it keeps are the suffixes that share h bytes. After LENGTH rounds the blocks are the repeated intervals
   (common prefix of at least LENGTH); suffixes are never sorted again. In each block all but the earliest window
   are removed.
3. Removed runs are joined to the texts, which are hashed without them.

An anchor with more than ``MOST_CONTEXTS`` different contexts (the edge of a passage in a great many texts) is resolved
by hashes of its windows instead, which spread over all tasks; anchors that a sample shows to be that common are
spread by context from the start. Both ways give the same result, so the sample decides only the routing.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textcore as tc
from .common import columns, partitions_for, stored, table

LENGTH = 100
GRAM = 40
MOST_CONTEXTS = 20_000
BUCKET_BYTES = 4 << 20
MERGE_BYTES = 1 << 20
FLUSH_ROWS = 600_000
#: Routing of very common anchors: share of the sampled documents, and how many anchors, at most.
COMMON_SHARE, COMMON_MOST, SAMPLE_ROWS = 0.02, 4096, 4000
_POS_BITS = 21
_FIELDS = (("h", "<u8"), ("c", "<u8"), ("doc", "<i8"), ("tie", "<i8"), ("start", "<u4"), ("n", "<u1"))


def _prefix(data: np.ndarray) -> np.ndarray:
    p = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(tc.TABLE[data] * tc._power_table(tc._BASE)[: len(data)], out=p[1:])
    return p


def _span_hash(p: np.ndarray, a, b, salt: int) -> np.ndarray:
    return tc.mix((p[b] - p[a]) * tc._power_table(tc._INV_BASE)[a] + np.uint64(salt) * (b - a).astype(np.uint64))


def contexts(data: np.ndarray, offs: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """Runs of windows with one anchor in a buffer under 2**21 bytes: row, start, windows, anchor hash, context hash."""
    n = len(data)
    sizes = np.diff(offs)
    if not (sizes >= length).any():
        z = np.zeros(0, np.int64)
        return z, z, z, z.astype(np.uint64), z.astype(np.uint64)
    p = _prefix(data)
    at = np.arange(n - gram + 1)
    grams = _span_hash(p, at, at + gram, 1)
    key = (grams >> np.uint64(_POS_BITS) << np.uint64(_POS_BITS)) | at.astype(np.uint64)
    low, width, want = key, 1, length - gram + 1
    while width * 2 <= want:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if width < want:
        low = np.minimum(low[: len(low) - (want - width)], low[want - width :])
    anchor = (low & np.uint64((1 << _POS_BITS) - 1)).astype(np.int64)
    step = np.zeros(n + 1, np.int32)
    long = sizes >= length
    np.add.at(step, offs[:-1][long], 1)
    np.add.at(step, offs[1:][long] - length + 1, -1)
    valid = np.cumsum(step[: len(anchor)]) > 0
    row_start = np.zeros(len(anchor), bool)
    row_start[offs[:-1][long]] = True
    first = valid.copy()
    first[1:] &= (anchor[1:] != anchor[:-1]) | ~valid[:-1] | row_start[1:]
    start = np.flatnonzero(first)
    stop = np.concatenate([start[1:], [len(anchor)]])
    count = np.add.reduceat(valid.astype(np.int64), start) if len(start) else stop
    row = np.searchsorted(offs, start, "right") - 1
    a = anchor[start]
    c = _span_hash(p, start, start + count - 1 + length, 3) ^ tc.mix((a - start).astype(np.uint64))
    return row, start - offs[row], count, grams[a], c


def _parts(batches, length: int):
    """Buffers of at most 1 MB of text: doc ids and text hashes, bytes, offsets, and the start of each piece in its text."""
    most = 1 << 20
    for rows, data, offs in tc.chunks(batches, "text", most):
        ids = rows.column(0).to_numpy(zero_copy_only=False), rows.column(1).to_numpy(zero_copy_only=False)
        if len(data) <= most:
            yield ids, data, offs, np.zeros(rows.num_rows, np.int64)
        else:
            for s in range(0, max(1, len(data) - length + 1), most - length):
                piece = data[s : s + most - 1]
                yield ids, piece, np.array([0, len(piece)]), np.array([s])


def _collapse(t: dict[str, np.ndarray]) -> tuple[dict, dict]:
    """Occurrences split in the earliest of each (h, c) and the rest."""
    order = np.lexsort((t["start"], t["tie"], t["doc"], t["c"], t["h"]))
    t = {k: v[order] for k, v in t.items()}
    same = (t["h"][1:] == t["h"][:-1]) & (t["c"][1:] == t["c"][:-1])
    first = np.concatenate([[True], ~same])[: len(order)]
    rest = ~first
    if rest.any():  # a row that repeats the earliest place itself is not later
        lead = np.maximum.accumulate(np.where(first, np.arange(len(first)), 0))
        rest &= (t["doc"] != t["doc"][lead]) | (t["tie"] != t["tie"][lead]) | (t["start"] != t["start"][lead])
    return {k: v[first] for k, v in t.items()}, {k: v[rest] for k, v in t.items()}


def _packed(t: dict[str, np.ndarray], buckets: int, common: np.ndarray):
    """Rows (bucket, payload): the earliest occurrences by bucket, and as bucket -1 - k the resolved ones."""
    keep, gone = _collapse(t)
    out = []
    key = np.where(np.isin(keep["h"], common), tc.mix(keep["h"] ^ keep["c"]), keep["h"]) if len(common) else keep["h"]
    for part, bucket in ((keep, (key % np.uint64(buckets)).astype(np.int64)), (gone, -1 - gone["doc"] % buckets)):
        if not len(bucket):
            continue
        order = np.lexsort((part["start"], part["tie"], part["doc"], bucket))
        cols = {k: v[order].astype(d) for (k, d), v in zip(_FIELDS, (part[k] for k, _ in _FIELDS), strict=True)}
        b = bucket[order]
        cut = np.flatnonzero(np.concatenate([[True], b[1:] != b[:-1], [True]]))
        out += [(int(b[i]), b"".join(v[i:j].tobytes() for v in cols.values())) for i, j in zip(cut[:-1], cut[1:], strict=True)]
    return pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.binary())], ["bucket", "payload"])


def _unpacked(payload: bytes) -> dict[str, np.ndarray]:
    n, at, out = len(payload) // sum(np.dtype(d).itemsize for _, d in _FIELDS), 0, {}
    for k, d in _FIELDS:
        out[k] = np.frombuffer(payload, d, n, at)
        at += n * np.dtype(d).itemsize
    return out


def _dealt(length: int, gram: int, buckets: int, common: np.ndarray):
    def run(batches):
        held, size = [], 0
        for ids, data, offs, shift in _parts(batches, length):
            row, start, count, h, c = contexts(data, offs, length, gram)
            held.append({"h": h, "c": c, "doc": ids[0][row], "tie": ids[1][row], "start": start + shift[row], "n": count})
            size += len(row)
            if size >= FLUSH_ROWS:
                yield _packed({k: np.concatenate([x[k] for x in held]) for k in held[0]}, buckets, common)
                held, size = [], 0
        if size:
            yield _packed({k: np.concatenate([x[k] for x in held]) for k in held[0]}, buckets, common)

    return run


RESOLVED = "doc_id long, tie long, start long, n int, anchor long, way int"
_REMOVED, _MERGE, _SPREAD = 0, 1, 2


def _resolved(common: np.ndarray, most: int, windows: bool = False):
    """Rows RESOLVED: removed runs of windows, and contexts still to compare (by merge, or spread by window)."""

    def rows(t, way):
        return pa.RecordBatch.from_arrays([pa.array(t["doc"].astype(np.int64)), pa.array(t["tie"].astype(np.int64)), pa.array(t["start"].astype(np.int64)), pa.array(t["n"].astype(np.int32)), pa.array(t["h"].astype(np.uint64).view(np.int64)), pa.array(np.broadcast_to(np.int32(way), len(t["doc"])).copy())], [f.split()[0] for f in RESOLVED.split(", ")])

    def run(batches):
        held = []
        for batch in batches:
            for bucket, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if bucket < 0:
                    yield rows(_unpacked(payload), _REMOVED)
                else:
                    held.append(_unpacked(payload))
        if not held:
            return
        keep, gone = _collapse({k: np.concatenate([x[k] for x in held]) for k, _ in _FIELDS})
        del held
        yield rows(gone, _REMOVED)
        if not windows and len(keep["h"]):
            new = np.concatenate([[True], keep["h"][1:] != keep["h"][:-1]])
            group = np.cumsum(new) - 1
            count = np.bincount(group)[group]
            spread = (count > most) | (np.isin(keep["h"], common) if len(common) else False)
            for way, mask in ((_MERGE, (count > 1) & ~spread), (_SPREAD, spread)):
                if mask.any():
                    yield rows({k: v[mask] for k, v in keep.items()}, way)

    return run


def _cut(length: int):
    """(anchor, way, doc_id, tie, start, n, context) of the wanted contexts of each text."""

    def run(batches):
        for batch in batches:
            out = []
            for doc, tie, text, wanted in zip(*(batch.column(k) for k in range(4)), strict=True):
                raw = (text.as_py() or "").encode()
                for w in wanted.as_py():
                    piece = raw[w["start"] : w["start"] + w["n"] - 1 + length]
                    if len(piece) == w["n"] - 1 + length:
                        out.append((w["anchor"], w["way"], doc.as_py(), tie.as_py(), w["start"], w["n"], piece))
            cols = list(zip(*out, strict=True)) or [()] * 7
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["anchor", "way", "doc_id", "tie", "start", "n", "context"])

    return run


def shard_bwt(flat: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Multi-string transform (0 before a string's first symbol) and the suffix starts in order, of strings of symbols
    from 1 laid end to end, each closed by its own end mark; marks order as the strings do."""
    ends = np.cumsum(sizes + 1) - 1
    sym = np.zeros(int(ends[-1]) + 1, np.uint16)
    body = np.ones(len(sym), bool)
    body[ends] = False
    sym[body] = flat
    n = len(sym)
    rank = sym.astype(np.int64) + len(sizes)
    rank[ends] = np.arange(len(sizes))
    width, longest, base = 1, int(sizes.max()) + 1, n + len(sizes) + 65537
    while True:
        key = rank * base
        key[: n - width] += rank[width:] + 1
        order = np.argsort(key, kind="stable")
        new = key[order]
        step = np.concatenate([[0], np.cumsum(new[1:] != new[:-1])])
        rank = np.empty(n, np.int64)
        rank[order] = step
        width *= 2
        if width >= longest or step[-1] == n - 1:
            break
    before = np.zeros(n, np.uint16)
    before[1:] = sym[:-1]
    return before[order], order


def merge_bwt(one: np.ndarray, two: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Interleave (True: from ``two``) of two transforms, and the common prefix of each suffix with the one before it, in
    symbols, at most ``length`` (-1 for the first).

    A place becomes the start of a block in the round that tells its suffix from the one before it, and stays one: so the
    number of the round less one is their common prefix. Rounds stop early when nothing changes.
    """
    n0, n = len(one), len(one) + len(two)
    marks0, marks = int((one == 0).sum()), int((one == 0).sum() + (two == 0).sum())
    z = np.zeros(n, bool)
    z[n0:] = True
    starts = np.zeros(n, bool)
    common = np.full(n, length, np.int16)
    if n:
        starts[0], common[0] = True, -1
    merged = np.empty(n, np.uint16)
    for h in range(length):
        merged[~z] = one
        merged[z] = two
        order = np.argsort(merged, kind="stable")[marks:]
        block = np.cumsum(starts)[order]
        symbol = merged[order]
        new_z, new_starts = np.empty(n, bool), np.empty(n, bool)
        new_z[:marks0], new_z[marks0:marks], new_z[marks:] = False, True, z[order]
        new_starts[:marks] = True
        if n > marks:
            new_starts[marks] = True
            new_starts[marks + 1 :] = (block[1:] != block[:-1]) | (symbol[1:] != symbol[:-1])
        stable = np.array_equal(z, new_z) and np.array_equal(starts, new_starts)
        common[new_starts & ~starts] = h
        z, starts = new_z, new_starts
        if stable:
            break
    return z, common


def merge_all(shards: list[tuple[np.ndarray, np.ndarray]], length: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix starts in order and common prefixes, at most ``length``, of several shards (of one: merged with an empty one),
    merged two by two."""
    if len(shards) == 1:
        shards = [*shards, (np.zeros(0, np.uint16), np.zeros(0, np.int64))]
    while True:
        done = []
        for i in range(0, len(shards) - 1, 2):
            (b0, s0), (b1, s1) = shards[i], shards[i + 1]
            last = len(shards) == 2
            z, common = merge_bwt(b0, b1, length if last else 4 * length)
            bwt, suffix = np.empty(len(z), np.uint16), np.empty(len(z), np.int64)
            bwt[~z], bwt[z], suffix[~z], suffix[z] = b0, b1, s0, s1
            done.append((bwt, suffix))
        shards = done + shards[len(done) * 2 :]
        if len(shards) == 1:
            return shards[0][1], common


def symbols(raw: np.ndarray, lead: np.ndarray, widths=(4, 2, 1)) -> tuple[np.ndarray, int]:
    """Dense codes from 1 of the symbols that start at ``lead``, of as many bytes as keep the codes in 16 bits."""
    for width in widths:
        code = np.zeros(len(raw), np.uint32)
        for k in range(width):
            code[: len(raw) - k] |= raw[k:].astype(np.uint32) << np.uint32(8 * k)
        known, inverse = np.unique(code[lead(width)], return_inverse=True)
        if len(known) < 65535:
            return (inverse + 1).astype(np.uint16), width
    raise AssertionError("one byte always fits")


def covered_windows(strings: list[bytes], doc, tie, start, n, length: int = LENGTH, shards: int = 2, widths=(4, 2, 1)):
    """(string, offset) of windows, among the first n of each string, that an earlier window, by (doc, tie, start), equals.

    Symbols are up to 4 bytes wide: a string becomes one string of symbols for each phase, so that every offset starts
    a suffix, and a window is length / width symbols, which divides the rounds.
    """
    widths = [w for w in widths if length % w == 0]
    raw = np.frombuffer(b"".join(strings), np.uint8)
    size = np.array([len(x) for x in strings])
    base = np.concatenate([[0], np.cumsum(size)])

    def lead(width):
        return np.concatenate([np.arange(b + p, b + m - width + 1, width) for b, m in zip(base[:-1].tolist(), size.tolist(), strict=True) for p in range(width)])

    flat, width = symbols(raw, lead, widths)
    at = lead(width)
    sizes = np.maximum((size[:, None] - np.arange(width)) // width, 0).ravel()
    cut = np.linspace(0, len(strings), min(shards, len(strings)) + 1).astype(int) * width
    first = np.concatenate([[0], np.cumsum(sizes)])
    mark = np.concatenate([[0], np.cumsum(sizes + 1)])
    built = []
    for a, b in zip(cut[:-1], cut[1:], strict=True):
        bwt, suffix = shard_bwt(flat[first[a] : first[b]], sizes[a:b])
        built.append((bwt, suffix + mark[a]))
    suffix, common = merge_all(built, length // width)
    origin = np.full(int(mark[-1]), -1, np.int64)
    body = np.ones(len(origin), bool)
    body[mark[1:] - 1] = False
    origin[body] = at
    # a repeated interval is a run of suffixes that share a window's length with the one before
    block, place = np.cumsum(common < length // width), origin[suffix]
    block, place = block[place >= 0], place[place >= 0]
    owner = np.searchsorted(base, place, "right") - 1
    offset = place - base[owner]
    mine = offset < n[owner]
    block, owner, offset = block[mine], owner[mine], offset[mine]
    d, t, s = doc[owner], tie[owner], start[owner] + offset
    order = np.lexsort((s, t, d, block))
    block, owner, offset, d, t, s = block[order], owner[order], offset[order], d[order], t[order], s[order]
    lead_ = np.maximum.accumulate(np.where(np.concatenate([[True], block[1:] != block[:-1]]), np.arange(len(block)), 0))
    later = (d != d[lead_]) | (t != t[lead_]) | (s != s[lead_])
    return owner[later], offset[later]


def _merged(length: int):
    """Removed runs (doc_id, tie, start, n) from rows sorted by anchor, in lots of whole anchors of about MERGE_BYTES."""

    def solve(lot):
        doc, tie, start, n = (np.array([x[k] for x in lot]) for k in range(1, 5))
        owner, offset = covered_windows([x[5] for x in lot], doc, tie, start, n, length)
        order = np.lexsort((offset, owner))
        owner, offset = owner[order], offset[order]
        if len(owner):
            first = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (offset[1:] != offset[:-1] + 1)]))
            count = np.diff(np.concatenate([first, [len(owner)]]))
            o = owner[first]
            return pa.RecordBatch.from_arrays([pa.array(doc[o]), pa.array(tie[o]), pa.array(start[o] + offset[first]), pa.array(count.astype(np.int32))], ["doc_id", "tie", "start", "n"])
        return None

    def run(batches):
        lot, size, anchor = [], 0, None
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[0] != anchor and size >= MERGE_BYTES:
                    out = solve(lot)
                    if out is not None:
                        yield out
                    lot, size = [], 0
                anchor = row[0]
                lot.append(row)
                size += len(row[5])
        if len(lot) > 1:
            out = solve(lot)
            if out is not None:
                yield out

    return run


def _by_window(length: int, buckets: int):
    """Packed windows of contexts, by hash of the window."""

    def run(batches):
        held, size = [], 0
        for batch in batches:
            for doc, tie, start, n, raw in zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True):
                data = np.frombuffer(raw, np.uint8)
                p = _prefix(data)
                a = np.arange(n)
                held.append({"h": _span_hash(p, a, a + length, 5), "c": _span_hash(p, a, a + length, 7), "doc": np.full(n, doc), "tie": np.full(n, tie), "start": start + a, "n": np.ones(n, np.int64)})
                size += n
                if size >= FLUSH_ROWS:
                    yield _packed({k: np.concatenate([x[k] for x in held]) for k in held[0]}, buckets, np.zeros(0, np.uint64))
                    held, size = [], 0
        if size:
            yield _packed({k: np.concatenate([x[k] for x in held]) for k in held[0]}, buckets, np.zeros(0, np.uint64))

    return run


#: Tells texts of one doc_id apart.
TIE = "xxhash64(text)"
SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _stripped(length: int, with_text: bool):
    def run(batches):
        for batch in batches:
            cols = [[], [], [], []]
            texts = []
            for text, runs in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                raw = (text or "").encode()
                size = len(raw)
                removed = spans = 0
                if runs:
                    cover = np.zeros(size + 1, np.int32)
                    a = np.array([r["start"] for r in runs])
                    b = np.minimum(a + np.array([r["n"] for r in runs]) - 1 + length, size)
                    ok = a < b
                    np.add.at(cover, a[ok], 1)
                    np.add.at(cover, b[ok], -1)
                    gone = np.cumsum(cover[:-1]) > 0
                    removed = int(gone.sum())
                    spans = int((gone & ~np.concatenate([[False], gone[:-1]])).sum())
                    raw = np.frombuffer(raw, np.uint8)[~gone].tobytes()
                for c, v in zip(cols, (size, removed, spans, hashlib.sha256(raw).hexdigest()), strict=True):
                    c.append(v)
                texts.append(raw.decode("utf-8", "ignore") if with_text else None)
            arrays = [batch.column(0), *(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.string())]
            names = [f.split()[0] for f in SCHEMA.split(", ")]
            if with_text:
                arrays, names = [*arrays, pa.array(texts, pa.string())], [*names, "text"]
            yield pa.RecordBatch.from_arrays(arrays, names)

    return run


def _anchors_once(length: int, gram: int):
    def run(batches):
        for ids, data, offs, _ in _parts(batches, length):
            row, _, _, h, _ = contexts(data, offs, length, gram)
            pair = np.unique(np.stack([row.astype(np.uint64), h], 1), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(pair[:, 1].copy().view(np.int64))], ["h"])

    return run


def common_anchors(docs: DataFrame, length: int, gram: int, share: float = COMMON_SHARE) -> np.ndarray:
    """Anchors in at least ``share`` of a sample of about SAMPLE_ROWS documents, at most COMMON_MOST. A hint for routing only. The sample
    is by hash where the documents are: no text moves."""
    part = min(1.0, SAMPLE_ROWS / max(1, docs.count()))
    sample = docs.where(F.pmod(F.xxhash64("doc_id", "tie"), F.lit(1 << 30)) < int(part * (1 << 30))).select("doc_id", "tie", "text")
    found = sample.mapInArrow(_anchors_once(length, gram), "h long").groupBy("h").count().where(F.col("count") >= max(20, int(share * SAMPLE_ROWS)))
    rows = found.orderBy(F.desc("count"), "h").limit(COMMON_MOST).collect()
    return np.array(sorted(r.h for r in rows), np.int64).view(np.uint64)


def removed_runs(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, most: int = MOST_CONTEXTS, share: float = COMMON_SHARE) -> DataFrame:
    """(doc_id, tie, start, n): runs of n window starts whose windows also start earlier."""
    texts = docs.where("doc_id is not null and octet_length(text) >= " + str(length)).select("doc_id", F.expr(TIE).alias("tie"), "text")
    buckets = partitions_for(docs, BUCKET_BYTES)
    common = common_anchors(texts, length, gram, share)
    dealt = texts.mapInArrow(_dealt(length, gram, buckets, common), "bucket long, payload binary").repartition(buckets, "bucket")
    found = stored(dealt.mapInArrow(_resolved(common, most), RESOLVED), "anchors")
    wanted = found.where("way > 0").groupBy("doc_id", "tie").agg(F.collect_list(F.struct("start", "n", "anchor", "way")).alias("wanted"))
    cut = texts.join(wanted, ["doc_id", "tie"]).select("doc_id", "tie", "text", "wanted").mapInArrow(_cut(length), "anchor long, way int, doc_id long, tie long, start long, n int, context binary")
    cut = stored(cut, "contexts")
    merge = cut.where(f"way = {_MERGE}").select("anchor", "doc_id", "tie", "start", "n", "context").repartition(buckets, "anchor").sortWithinPartitions("anchor", "doc_id", "tie", "start")
    merged = merge.mapInArrow(_merged(length), "doc_id long, tie long, start long, n int")
    spread = cut.where(f"way = {_SPREAD}").select("doc_id", "tie", "start", "n", "context").mapInArrow(_by_window(length, buckets), "bucket long, payload binary").repartition(buckets, "bucket")
    spread = spread.mapInArrow(_resolved(np.zeros(0, np.uint64), 0, windows=True), RESOLVED).select("doc_id", "tie", "start", "n")
    return found.where(f"way = {_REMOVED}").select("doc_id", "tie", "start", "n").union(merged).union(spread)


def deduplicated(docs: DataFrame, with_text: bool = False, **how) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, with ``with_text``, the
    remaining text (a code point that is cut loses all its bytes).

    A null text is empty. Rows that repeat a doc_id and its text hold one place, and do not remove each other; other texts
    of the same doc_id are documents of their own, in the order of a hash of the text. Rows with a null doc_id have no
    place in the order: nothing is removed from them or by them. Extra columns are ignored; an empty table gives no rows.
    """
    docs = columns(docs, doc_id="long", text="string")
    runs = removed_runs(docs, **how).groupBy("doc_id", "tie").agg(F.collect_list(F.struct("start", "n")).alias("runs"))
    schema = SCHEMA + (", text string" if with_text else "")
    length = how.get("length", LENGTH)
    return docs.withColumn("tie", F.expr(TIE)).join(runs, ["doc_id", "tie"], "left").select("doc_id", "text", "runs").mapInArrow(_stripped(length, with_text), schema)


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicated(table(spark, sf_dir, "documents"))

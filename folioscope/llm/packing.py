"""Packing token pieces into fixed-length sequences (operator 9).

First-fit decreasing with a tournament tree of bin capacities, run independently in randomised groups of
documents. A hash of doc_id and text deals the documents to partitions and orders them there; consecutive
documents of about ``GROUP_TOKENS`` ids form a group, so groups are random, of bounded size, and the same on
every run. Within a group texts longer than a sequence give full pieces, the remainders are placed largest first
into the first bin with room, and the gaps that stay open are closed with cuts of the emptiest bins. The last
bin is left as sequences of power-of-two lengths, which need no padding.

Tokenising is cached by piece: this tokenizer lowers case and joins neither across ASCII white space nor from an
ASCII letter to ASCII punctuation or a digit (but for an apostrophe before a letter), so each distinct piece is
encoded once per worker and texts are assembled from the cached ids with array gathers.
"""

from __future__ import annotations

import os
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textcore as tc
from .common import columns, partitions_for, table

CAPACITY = 4096
END_ID = 2
GROUP_TOKENS = 2_000_000
PARTITION_BYTES = 8 << 20
CACHE_SLOTS = 1 << 21
CACHED_IDS = 6_000_000
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


_LETTER, _OTHER, _QUOTE = np.zeros(256, bool), np.zeros(256, bool), 39
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_OTHER[33:127] = True
_OTHER &= ~_LETTER
_SPECIAL = ("<|startoftext|>", "<|endoftext|>")


def pieces(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of spans that the tokenizer treats independently of each other."""
    starts, ends, row = tc.spans(data, offs)
    raw = data.tobytes()
    if len(data) < 2 or any(x.encode() in raw for x in _SPECIAL):
        return starts, ends, row
    letter, other = _LETTER[data], _OTHER[data]
    cut = (letter[:-1] & other[1:]) | (other[:-1] & letter[1:] & (data[:-1] != _QUOTE))
    at = np.flatnonzero(cut) + 1
    at = at[~np.isin(at, offs)]
    starts = np.sort(np.concatenate([starts, at]), kind="stable")
    return starts, np.sort(np.concatenate([ends, at]), kind="stable"), np.searchsorted(offs, starts, "right") - 1


class WordIds:
    """Ids of texts, piece by piece, through a cache of fixed size with two places for each hash."""

    def __init__(self, path: str, slots: int = CACHE_SLOTS, most_ids: int = CACHED_IDS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # the tasks are the parallelism
        from tokenizers import Tokenizer

        self.encoder, self.slots, self.most_ids = Tokenizer.from_file(path), slots, most_ids
        self.between = self.encoder.token_to_id(_SPECIAL[1])
        self.kind = np.uint16 if self.encoder.get_vocab_size() <= 1 << 16 else np.uint32
        self._clear()

    def _clear(self) -> None:
        self.key, self.at = np.zeros(self.slots, np.uint64), np.zeros(self.slots, np.int32)
        self.first, self.size = np.zeros(1 << 16, np.int32), np.zeros(1 << 16, np.int32)
        self.ids, self.known, self.used = np.empty(1 << 18, self.kind), 0, 0

    def _store(self, flat: np.ndarray, size: np.ndarray) -> np.ndarray:
        n = self.known + len(size)
        while n > len(self.first):
            self.first, self.size = np.r_[self.first, np.zeros_like(self.first)], np.r_[self.size, np.zeros_like(self.size)]
        while self.used + len(flat) > len(self.ids):
            self.ids = np.r_[self.ids, np.empty_like(self.ids)]
        self.ids[self.used : self.used + len(flat)] = flat
        self.first[self.known : n] = self.used + np.cumsum(size) - size
        self.size[self.known : n] = size
        new = np.arange(self.known, n, dtype=np.int32)
        self.known, self.used = n, self.used + len(flat)
        return new

    def _encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if self.between is None or any(_SPECIAL[1] in w for w in words):
            got = [e.ids for e in self.encoder.encode_batch_fast(words, add_special_tokens=False)]
            return np.array([i for x in got for i in x], self.kind), np.array([len(x) for x in got], np.int64)
        # one call, the pieces kept apart by a special token
        flat = np.array(self.encoder.encode_batch_fast([_SPECIAL[1].join(words)], add_special_tokens=False)[0].ids, self.kind)
        at = np.flatnonzero(flat == self.between)
        return flat[flat != self.between], np.diff(np.r_[-1, at, len(flat)]) - 1

    def encode(self, data: np.ndarray, offs: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows, each row's ids followed by ``end_id``, and their offsets."""
        starts, ends, row = pieces(data, offs)
        n, mask = len(offs) - 1, np.uint64(self.slots - 1)
        if self.used > self.most_ids:
            self._clear()
        end = self._store(np.array([end_id], self.kind), np.ones(1, np.int64))
        h = tc.hash_spans(data, starts, ends, tc.LOWER_TABLE)
        one, two = (h & mask).astype(np.int64), (h >> np.uint64(32) & mask).astype(np.int64)
        here = self.key[one] == h
        at = self.at[np.where(here, one, two)]
        miss = np.flatnonzero(~here & (self.key[two] != h))
        if len(miss):
            new, first, inverse = np.unique(h[miss], return_index=True, return_inverse=True)
            first = miss[first]
            raw = data.tobytes()
            learnt = self._store(*self._encode([raw[a:b].decode("utf-8", "replace") for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)]))
            at[miss] = learnt[inverse]
            place = np.where(self.key[one[first]] == 0, one[first], two[first])
            self.key[place], self.at[place] = new, learnt
            agree = self.key[place] == new  # where two share a place, the last stays
            self.at[place[agree]] = learnt[agree]
        count = np.bincount(row, minlength=n)
        at = np.insert(at, np.cumsum(count), end[0])
        size = self.size[at]
        stop = np.cumsum(size, dtype=np.int64)
        src = np.repeat((self.first[at] - (stop - size)).astype(np.int32), size)
        src += np.arange(len(src), dtype=np.int32)
        return self.ids[src], np.r_[0, stop[np.cumsum(count + 1) - 1]] if n else np.zeros(1, np.int64)


class Tournament:
    """Bins in a row, each inner node holding the larger room of its two sides: first fit in log time."""

    def __init__(self, bins: int, capacity: int):
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.room = [capacity] * (2 * self.leaves)

    def place(self, size: int) -> int:
        room, i = self.room, 1
        while i < self.leaves:
            i *= 2
            if room[i] < size:
                i += 1
        at = i - self.leaves
        room[i] -= size
        while i > 1:
            i //= 2
            left, right = room[2 * i], room[2 * i + 1]
            room[i] = left if left >= right else right
        return at


def pack(sizes: list[int], capacity: int = CAPACITY) -> list[list[tuple[int, int, int]]]:
    """Sequences of pieces (item, start, length). All are full but for some of power-of-two length."""
    full, rest = [], []
    for k, n in enumerate(sizes):
        cut = n - n % capacity
        full += [[(k, s, capacity)] for s in range(0, cut, capacity)]
        if n > cut:
            rest.append((n - cut, k, cut))
    rest.sort(key=lambda x: (-x[0], x[1]))
    tree, bins = Tournament(len(rest), capacity), []
    for n, k, start in rest:
        at = tree.place(n)
        if at == len(bins):
            bins.append([])
        bins[at].append((k, start, n))
    room = [capacity - sum(p[2] for p in b) for b in bins]
    order = sorted(range(len(bins)), key=lambda b: room[b])
    bins, room = [bins[b] for b in order], [room[b] for b in order]
    i, j = 0, len(bins) - 1
    while i < j:
        if not room[i]:
            i += 1
        elif not bins[j]:
            j -= 1
        else:
            k, start, n = bins[j].pop()
            take = min(n, room[i])
            if take < n:
                bins[j].append((k, start + take, n - take))
            bins[i].append((k, start, take))
            room[i] -= take
            room[j] += take
    last = bins[j] if bins else []
    tail, used = [], sum(p[2] for p in last)
    for bit in reversed(range(used.bit_length())):
        if used >> bit & 1:
            want, got = 1 << bit, []
            while want:
                k, start, n = last.pop()
                take = min(n, want)
                if take < n:
                    last.append((k, start + take, n - take))
                got.append((k, start, take))
                want -= take
            tail.append(got)
    return full + [b for b in bins[:j] if b] + tail


_cache: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """The worker's encoder, kept from task to task (a task's own closure would carry a copy of the dict)."""
    if path not in _cache:
        _cache[path] = WordIds(path)
    return _cache[path]


def _packer(path: str, capacity: int, end_id: int, group_tokens: int):
    def flush(names, sizes, blocks, base):
        ids = np.concatenate(blocks)
        first = np.r_[0, np.cumsum(sizes)]
        rows = []
        sequences = pack(sizes, capacity)
        for q, pieces in enumerate(sequences):
            at = 0
            for k, start, n in pieces:
                crc = zlib.crc32(ids[first[k] + start : first[k] + start + n].astype("<u4").tobytes())
                rows.append((names[k], start, n, crc, sizes[k], base + q, at))
                at += n
        cols = list(zip(*rows, strict=True))
        return len(sequences), pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], [f.split()[0] for f in SCHEMA.split(", ")])

    def run(batches):
        words, base = word_ids(path), TaskContext.get().partitionId() << 32
        names, sizes, blocks, total = [], [], [], 0
        for rows, data, offs in tc.chunks(batches, "text"):
            ids, at = words.encode(data, offs, end_id)
            names += rows.column(0).to_pylist()
            sizes += np.diff(at).tolist()
            blocks.append(ids)
            total += len(ids)
            if total >= group_tokens:
                n, out = flush(names, sizes, blocks, base)
                base += n
                yield out
                names, sizes, blocks, total = [], [], [], 0
        if names:
            yield flush(names, sizes, blocks, base)[1]

    return run


def pack_documents(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, group_tokens: int = GROUP_TOKENS, partition_bytes: int = PARTITION_BYTES) -> DataFrame:
    """Pieces (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) of ``docs`` (doc_id, text).

    A text's ids are those of the tokenizer file without special tokens, then ``end_id``; a null or empty text is
    ``end_id`` alone. Every id of every row lies in exactly one piece; rows that repeat a doc_id are packed each.
    Sequences are full, or of a power-of-two length. A null doc_id stays null. Extra columns are ignored; an empty
    table gives no rows.
    """
    n = partitions_for(docs, partition_bytes)
    dealt = columns(docs, doc_id="long", text="string").withColumn("h", F.xxhash64("doc_id", "text"))
    dealt = dealt.repartition(n, "h").sortWithinPartitions("h", "doc_id").select("doc_id", "text")
    return dealt.mapInArrow(_packer(path or tokenizer_path(), capacity, end_id, group_tokens), SCHEMA)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))

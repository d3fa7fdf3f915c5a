"""Merging two layouts of a page, against a plain reading of the rules."""

import random

import pytest

from folioscope.operators import page_merge as pm

LINE = "file string, page_num int, line_num int, block string, text string, bbox array<double>"
BLOCK = "file string, page_num int, block string, ord int, bbox array<double>"


def area(b):
    return max(0.0, b[2] - b[0]) * max(0.0, b[3] - b[1])


def cover(a, b):
    if area(a) > 0:
        return max(0.0, min(a[2], b[2]) - max(a[0], b[0])) * max(0.0, min(a[3], b[3]) - max(a[1], b[1])) / area(a)
    x, y = (a[0] + a[2]) / 2, (a[1] + a[3]) / 2
    return float(b[0] <= x <= b[2] and b[1] <= y <= b[3])


def apart(a, b):
    dx, dy = max(0.0, b[0] - a[2], a[0] - b[2]), max(0.0, b[1] - a[3], a[1] - b[3])
    return (dx * dx + dy * dy) ** 0.5


def link(box, blocks):
    best = min(blocks, key=lambda b: (-round(cover(box, b[2]), 6), area(b[2]), b[1], b[0]))
    return best[0] if cover(box, best[2]) > 0 else min(blocks, key=lambda b: (apart(box, b[2]), area(b[2]), b[1], b[0]))[0]


def page(lines, blocks, own):
    """lines (n, block, text, box), blocks (name, order, box), own (n, block, text) -> [(block, text, source)]"""
    order = {b: o if o is not None else 1 << 30 for b, o, _ in blocks}
    boxed = [(b, order[b], x) for b, _, x in blocks if x is not None]
    lines = sorted(lines)
    to = [link(x, boxed) if x is not None else None for *_, x in lines]
    for i, (_, block, *_) in enumerate(lines):
        if to[i] is None:
            votes = {}
            for j, other in enumerate(lines):
                if to[j] is not None and other[1] == block:
                    votes[to[j]] = votes.get(to[j], 0) + 1
            if votes:
                to[i] = min(votes, key=lambda b: (-votes[b], order[b], b))
            else:
                to[i] = next((t for t in reversed(to[:i]) if t), None) or next((t for t in to[i:] if t), None) or min(boxed, key=lambda b: (b[1], b[0]))[0]
    out = []
    for b in sorted(order, key=lambda b: (order[b], b)):
        kept = [(b, t, "text-layer") for (_, _, t, _), x in zip(lines, to) if x == b]
        out += kept or [(b, t, "atr") for _, x, t in sorted(own) if x == b]
    return out


def random_page(rng):
    n = rng.randint(1, 6)
    box = lambda: (lambda x, y: [x, y, x + rng.choice([0, 10, 20, 40]), y + rng.choice([0, 5, 10, 30])])(float(rng.randrange(0, 60, 5)), float(rng.randrange(0, 90, 5)))
    blocks = [(f"b{k}", rng.choice([0, 1, 2, 3, None]), box() if k == 0 or rng.random() < 0.8 else None) for k in range(n)]
    lines = [(i, rng.choice(["p", "q", "r", None]), f"t{i}", box() if rng.random() < 0.5 else None) for i in rng.sample(range(1, 40), rng.randint(1, 14))]
    own = [(i + 1, rng.choice(blocks)[0], f"o{i}") for i in range(rng.randint(0, 6))]
    return lines, blocks, own


@pytest.mark.parametrize("seed", range(3))
def test_by_brute_force(spark, seed):
    rng = random.Random(seed)
    pages = {(f"d{i % 7}", i // 7 + 1): random_page(rng) for i in range(60)}
    needs = {k: i % 6 == 0 for i, k in enumerate(pages)}
    bare = [k for i, k in enumerate(pages) if i % 11 == 5]  # no line in the layer
    frame = lambda rows, schema: spark.createDataFrame(rows, schema)
    layer = frame([(*k, n, b, t, x) for k, (lines, *_) in pages.items() if k not in bare for n, b, t, x in lines], LINE)
    blocks = frame([(*k, b, o, x) for k, (_, bs, _) in pages.items() for b, o, x in bs], BLOCK)
    own = frame([(*k, n, b, t, None) for k, (*_, own) in pages.items() for n, b, t in own], LINE)
    got = {}
    for r in sorted(pm.merged(frame([(*k, v) for k, v in needs.items()], "file string, page_num int, needs_atr boolean"), layer, blocks, own).collect(), key=lambda r: r.line_num):
        got.setdefault((r.file, r.page_num), []).append((r.block, r.text, r.text_source))
    for k, (lines, bs, own_) in pages.items():
        want = [(b, t, "atr") for _, b, t in sorted(own_)] if needs[k] or k in bare else page(lines, bs, own_)
        assert got.get(k, []) == want, k


def test_long_page_and_nearest(spark):
    """Twenty thousand lines on one page, half of them beside every block."""
    rows = [("d", 1, i, "p", str(i), [200.0 if i % 2 else 10.0, float(i * 10), 210.0 if i % 2 else 20.0, float(i * 10 + 8)]) for i in range(1, 20_001)]
    blocks = spark.createDataFrame([("d", 1, f"b{k}", k, [0.0, k * 1000.0, 100.0, k * 1000.0 + 999]) for k in range(201)], BLOCK)
    got = {r.line_num: r.to for r in pm.linked(spark.createDataFrame(rows, LINE), blocks).collect()}
    assert len(got) == 20_000
    for i, to in got.items():
        k = i * 10 // 1000
        assert to == f"b{k}" or i % 2 and to == f"b{k + 1}", i


def test_problems_and_empty(spark):
    docs = spark.createDataFrame([("a", 2, 2, None), ("b", 2, 3, [2]), ("c", 1, 1, [9])], "file string, atr_pages int, layer_pages int, forced array<int>")
    pages = spark.createDataFrame([("a", 1, False), ("b", 1, False), ("b", 2, True), ("c", 1, True)], "file string, page_num int, needs_atr boolean")
    layer = spark.createDataFrame([("a", 1, 1, "p", "t", None), ("b", 1, 1, "p", "t", None)], LINE)
    blocks = spark.createDataFrame([("a", 1, "b0", 0, [0.0, 0.0, 1.0, 1.0]), ("b", 1, "b0", 0, None)], BLOCK)
    found = sorted((r.file, r.page_num or 0, r.problem) for r in pm.problems(docs, pages, layer, blocks).collect())
    assert found == [("a", 0, "not_mixed"), ("b", 0, "page_mismatch"), ("b", 1, "atr_page_missing"), ("c", 0, "forced_mismatch")]
    assert pm.merged(pages.limit(0), layer.limit(0), blocks.limit(0), layer.limit(0)).count() == 0

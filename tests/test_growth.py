"""Work that grows with the tables is done once: scans of the input in a query's plan, rows that a step makes, and the rare ways beside them."""

import random
import re
from collections import Counter, defaultdict
from itertools import zip_longest

import pytest
from pyspark.sql import functions as F

from folioscope import queries as q
from folioscope.operators import compare, lexicon, lines as ln

TEXTS = ["the river and the stones\nof the river", "the rivver, thee stones\n\nand rivers", "river STONES the 12 oueussd", None, "", "x"]


@pytest.fixture
def tables(spark, tmp_path):
    rows = [(i, t, "en", "st"[i % 2]) for i, t in enumerate(TEXTS * 12 + ["a stoness by the rivvver"])]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    return str(tmp_path)


def scans(df):
    return df._jdf.queryExecution().sparkPlan().toString().count("FileScan parquet")


@pytest.mark.parametrize(("name", "most"), [("token_status_report", 0), ("line_recoverability", 1), ("nearest_attested", 0)])
def test_tokens_are_cut_once(spark, tables, name, most):
    df = q.queries()[name](spark, tables)
    assert scans(df) == most and df.count() > 0  # what is kept on the way is not read again


@pytest.mark.parametrize("ids", [lambda i: i, lambda i: i // 3, lambda i: None if i % 4 else i])
@pytest.mark.parametrize("by", [None, "source"])
def test_lexicon_of_texts(spark, ids, by):
    rows = [(ids(i), t, "ab"[i % 2]) for i, t in enumerate(TEXTS * 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    lines = docs.select(F.col("doc_id").alias("file"), "source", "text")
    want = lexicon.document_frequency(lexicon.tokens(lines), by=by)
    got = lexicon.text_frequency(docs, by=by)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and want.count() > 5


def test_misreadings_of_the_lexicon(spark):
    pairs = (("rn", "m"), ("m", "rn"), ("aa", "a"), ("a", "aa"), ("", "x"), ("x", ""))
    words = ["modern", "modem", "modm", "baa", "ba", "baaa", "aab", "xab", "ab", "abx", "m", "rn"]
    want = {(t, c) for t in words for c in words if t != c for a, b in pairs for i in range(len(t)) if t.startswith(a, i) and t[:i] + b + t[i + len(a) :] == c}
    df = spark.createDataFrame([(w, 20) for w in words], "token string, df int")
    got = [(r.token, r.candidate) for r in lexicon.confused(df.select("token"), df, pairs).collect()]
    assert len(got) == len(set(got)) and set(got) == want and ("xab", "ab") in want and ("ab", "xab") in want and ("ab", "abx") not in want


def planned(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_lines_are_asked_what_they_are_after_their_words(spark):
    from folioscope.operators import scoring

    lines = spark.createDataFrame([("d", 1, 1, "oueussd", "ces_Latn"), ("d", 1, 1, "12,5 cm ppole", "ces_Latn")], "file string, page_num int, line_num int, text string, lang string")
    found = scoring.shape_witness(lines, spark.createDataFrame([("other", 3)], "token string, df long"))
    assert [r.clauses for r in found.collect()] == [["vowel_run"]]  # of two lines of one number, the one without a measurement
    plan = planned(found)
    assert plan.count("12,5") == 0 and plan.index("rozm") < plan.index("Join Inner")  # the tests of lines are above the join


def test_suspects_hold_all_faults(spark):
    from folioscope.functions import signals as s

    words = ["oueussd", "sektlll", "SEKTLLL", "'rragment", "RRagment", "vansasaasasa", "vans1asaasasa", "aßaß", "İİİabc", "naïve", "Naiade", "xxxx", "ΣΣΣσς", "anananan", "ananana'", "tak", "edelite", "", "\U00010400\U00010400\U00010400a"]
    rows = spark.createDataFrame([(w,) for w in words], "p string")
    for lang in ("''", "'deu'"):
        got = rows.select("p", F.expr(s.shape_suspect("p")).alias("some"), F.expr(s.shape_piece("p")).alias("x")).select("p", "some", F.expr(f"{s.shape_judged('x')} and size({s.shape_faults('x', lang)}) > 0").alias("fault")).collect()
        assert all(r.some for r in got if r.fault) and sum(r.fault for r in got) > 5 and not all(r.some for r in got)


def test_shapes_are_judged_once_each(spark, tables):
    plan = planned(q.queries()["token_shapes"](spark, tables))
    assert "Generate explode(split(" in plan and plan.index("Filter") < plan.index("Generate")  # whole words come out of the texts, what is judged are rows


def test_rollup_counts_no_third_group(spark, tables):
    df = q.queries()["token_df_rollup"](spark, tables)
    assert "Expand" not in planned(df) and df.where("source is null").count() == df.select("token").distinct().count()


def test_bands_follow_the_blocks(spark):
    from folioscope.operators import page_merge

    box = lambda a, b: [0.0, float(a), 100.0, float(b)]
    lines = spark.createDataFrame([("d", 1, i, box(i * 10, i * 10 + 8)) for i in range(40)] + [("d", 2, 1, box(0, 9))], "file string, page_num int, line_num int, l array<double>")
    boxed = spark.createDataFrame([("d", 1, f"b{k}", k, box(k * 80, k * 80 + 79)) for k in range(5)] + [("d", 2, "b0", 0, box(0, 9))], "file string, page_num int, block string, ord int, b array<double>")
    high_lines, high_blocks = page_merge.by_height(lines, boxed)
    assert high_lines.count() <= 2 * 41 and high_blocks.count() <= 3 * 6
    to = {(r.page_num, r.line_num): r.to for r in page_merge.linked(lines.withColumnRenamed("l", "bbox"), boxed.withColumnRenamed("b", "bbox")).collect()}
    assert to == {(1, i): f"b{i // 8}" for i in range(40)} | {(2, 1): "b0"}


@pytest.mark.parametrize("name", ["pack_estimates", "change_labels"])
def test_changes_are_made_once(spark, tables, name):
    assert scans(q.queries()[name](spark, tables)) == 0  # the lines are not read again for each use of the changes


@pytest.mark.parametrize("name", ["pack_top", "pack_tail"])
def test_packs_read_kept_changes(spark, tables, name):
    assert scans(q.queries()[name](spark, tables)) == 0


def test_pairs_are_dealt_once(spark):
    """Repeats, keys with nulls, nulls in text and category, and rows of one side, against plain Python; the tables move once."""
    rng = random.Random(5)
    row = lambda: (rng.choice(["a", "b", None]), rng.randrange(3), rng.choice([1, 2, None]), rng.choice(["x", "y", "z", None]), rng.choice(["Clear", "Trash", None]))
    sides = [[(*row(), f"{side}{i}") for i in range(60)] for side in "ba"]
    base, arm = (spark.createDataFrame(s, "file string, page_num int, line_num int, text string, categ string, source string") for s in sides)
    want, queues = [], [defaultdict(list) for _ in sides]
    for rows, queue in zip(sides, queues):
        for r in sorted(rows, key=lambda r: (r[3] is not None, r[3] or "", r[5])):
            queue[r[:3]].append(r[3:])
    for key in {*queues[0], *queues[1]}:
        met = zip_longest(*(queue.get(key, []) for queue in queues)) if None not in key else [(b, None) for b in queues[0].get(key, [])] + [(None, a) for a in queues[1].get(key, [])]
        for b, a in met:
            either = [next((x for x in ((a or (None,) * 3)[i], (b or (None,) * 3)[i]) if x is not None), None) for i in (0, 2)]
            want.append((*key, b and b[1], a and a[1], *either))
    pairs = compare.paired(base, arm, "text", "source", keep=("source",))
    assert Counter(tuple(r) for r in pairs.drop("occurrence").collect()) == Counter(want) and len(want) > 70
    assert pairs._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


def test_lines_of_all_ends(spark):
    texts = ["", "a", "a\nb\n", "a\r\nb\rc\n\rd", "\f", "a\fb\r\f\nc", "\n\n\u2028é\x0b\n", "a\r", None, "\n" * 5 + "x"]
    got = ln.explode_lines(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), page_lines=2)
    want = []
    for i, t in enumerate(texts):
        page = 0
        for sheet in [] if t is None else t.split("\f"):
            lines = re.split("\r\n|\r|\n", sheet)
            want += [(str(i), page + k // 2 + 1, k % 2 + 1, x) for k, x in enumerate(lines)]
            page += (len(lines) + 1) // 2
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)

import pytest

from folioscope.operators import aggregate, lines, passes, scoring
from folioscope.params import DEFAULT, Params, ghost_words

SCHEMA = "file string, page_num int, line_num int, text string, lang string, lang_score double, perplex double"
CASES = {
    "": "Empty",
    "12 34 56": "Non-text",
    "XVII": "Non-text",
    "Pohled na zámek od jihu": "Clear",
    "The quick brown fox jumps over the lazy dog": "Clear",
    "@@## ~~ ^^": "Non-text",
    "č.neg. 1234": "Clear",
    "S O U P I S": "Clear",
}


def test_categories_of_single_lines(spark):
    rows = spark.createDataFrame([("d", 1, i, t, "ces_Latn", 0.95, 120.0) for i, t in enumerate(CASES)], SCHEMA)
    got = scoring.process(rows, passes=False).select("original_text", "categ", "quality_score").collect()
    assert {r.original_text: r.categ for r in got} == CASES
    for r in got:
        if r.categ == "Clear":
            assert r.quality_score >= DEFAULT.noisy_max
        if r.categ == "Trash":
            assert r.quality_score < DEFAULT.trash_max


def test_repairs(spark):
    rows = spark.createDataFrame([("d", 1, 1, "vyt1ačená zpráva o 2ámku", None, None, None), ("d", 1, 2, "S O U P I S nálezů", None, None, None)], SCHEMA)
    got = [r.text for r in scoring.prefilter(rows).orderBy("line_num").collect()]
    assert got == ["vytlačená zpráva o zámku", "Soupis nálezů"]


def test_disabled_rule_is_skipped():
    assert any(r[0] == "rule_allcaps" for r in scoring.rules(DEFAULT))
    assert not any(r[0] == "rule_allcaps" for r in scoring.rules(DEFAULT.but(disabled=frozenset({"rule_allcaps"}))))
    with pytest.raises(ValueError):
        Params(trash_max=0.9)
    assert "uo" in ghost_words() and not {"no", "bo"} & set(ghost_words())


def _rows(spark, categs, **more):
    data = [("d", i // 40 + 1, i % 40 + 1, f"t{i}", c, more.get("q", 0.6), 0.9, True) for i, c in enumerate(categs)]
    return spark.createDataFrame(data, "file string, page_num int, line_num int, text string, categ string, quality_score double, lang_score double, s boolean")


def test_surrounded_crosses_pages_and_needs_five_lines(spark):
    got = passes.surrounded(_rows(spark, ["Trash", "Trash", "Noisy", "Trash", "Trash"])).orderBy("page_num", "line_num").collect()
    assert [r.categ for r in got] == ["Trash"] * 5
    assert [r.categ for r in passes.surrounded(_rows(spark, ["Trash", "Noisy", "Trash", "Trash"])).orderBy("line_num").collect()][1] == "Noisy"


def test_runs_ignore_empty_lines(spark):
    categs = ["Clear", "Noisy", "Empty", "Noisy", "Noisy", "Noisy"] + ["Clear"] * 8
    rows = _rows(spark, categs).selectExpr("*", "categ = 'Noisy' as flag")
    got = passes.suspicious_runs(rows, flag="flag").orderBy("page_num", "line_num").collect()
    assert [r.categ for r in got][1:6] == ["Trash", "Empty", "Trash", "Trash", "Trash"]
    rows = _rows(spark, ["Clear", "Noisy", "Noisy", "Noisy"] + ["Clear"] * 8).selectExpr("*", "categ = 'Noisy' as flag")
    assert "Trash" not in [r.categ for r in passes.suspicious_runs(rows, flag="flag").collect()]


def test_modal_tie_takes_least_name(spark):
    rows = spark.createDataFrame([("d", 1, 1, "x", "Trash"), ("d", 1, 2, "x", "Clear"), ("d", 1, 3, None, "Noisy"), ("d", 1, 4, None, "Noisy")], "file string, page_num int, line_num int, text string, categ string")
    assert [r.categ for r in passes.dedup_modal(rows).orderBy("line_num").collect()] == ["Clear", "Clear", "Noisy", "Noisy"]


def test_page_stats_of_an_empty_page_are_null(spark):
    rows = spark.createDataFrame([("0001", 1, 1, "", "Empty", 0.0, 0, 0), ("NA", 1, 1, "a", "Clear", 0.9, 1, 1)], "file string, page_num int, line_num int, text string, categ string, quality_score double, word_count int, char_count int")
    got = {r.file: r for r in aggregate.page_stats(rows).collect()}
    assert got["0001"].clear_ratio is None and got["0001"].empty_ratio == 1.0 and got["0001"].avg_quality_score is None
    assert got["NA"].clear_ratio == 1.0 and got["NA"].total_word_count == 1


def test_split_words_and_hyphens(spark):
    rows = spark.createDataFrame([("d", 1, 1, "na zám- {zámku}"), ("d", 1, 2, "ku stál"), ("d", 1, 3, "dlou-"), ("d", 1, 4, "hé-"), ("d", 1, 5, "ho konec")], "file string, page_num int, line_num int, text string")
    got = {r.line_num: r for r in lines.split_braces(rows.where("line_num < 3")).collect()}
    assert got[1].text == "na zámku" and got[1].split_ws == "zám" and got[2].split_we == "ku" and got[2].text == "stál"
    joined = lines.join_hyphens(rows.where("line_num > 2")).collect()
    assert [(r.text, r.n_joined) for r in joined] == [("dlouhého konec", 3)]


def test_pages_after_a_form_feed(spark):
    docs = spark.createDataFrame([("a", "1\n2\n3\f4\f\f5\n6\n7"), ("b", "x\ry\r\nz"), ("c", None), ("d", "")], "doc_id string, text string")
    got = [(r.file, r.page_num, r.line_num, r.text) for r in lines.explode_lines(docs, page_lines=2).orderBy("file", "page_num", "line_num").collect()]
    assert got == [("a", 1, 1, "1"), ("a", 1, 2, "2"), ("a", 2, 1, "3"), ("a", 3, 1, "4"), ("a", 4, 1, ""), ("a", 5, 1, "5"), ("a", 5, 2, "6"), ("a", 6, 1, "7"), ("b", 1, 1, "x"), ("b", 1, 2, "y"), ("b", 2, 1, "z"), ("d", 1, 1, "")]

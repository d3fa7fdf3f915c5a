"""Structured lines, notation and shape clauses of single lines."""

import pytest

from folioscope.functions import signals as s
from folioscope.operators import scoring
from folioscope.params import DEFAULT

STRUCTURED = {
    "12,5 cm": True, "145-167mm": True, "0,46m": True, "3 m": False, "o 5 m": False, "výška 12": True, "výška": False, "rozm. 12": True, "pr. dna - 7": True,
    "clouCelRa pr. 4": False, "dna a hrdla 4": True, "v - 112": True, "v: 1": False, "Plocha: 3; sonda: XIV.": True, "AB123/45-X": True, "tab. IV obr č. 12": True, "inv. 45": True, "kat.12": True,
    "čp. 12": True, "12. 3. 1998": True, "12. 3.": False, "1998": False, "datum 5": True, "datum": False, "updatum 5": False, "2. Popis lokality 15": True, "Literatura:": True, "literatura dila": False, "a.b.": True,
    "sektlll": False, "": False,
}
NOTATION = {
    "II/C": True, "S-VIII-b": True, "KK-XIII": True, "o-e": False, "Sonda: III/B": True, "rez: 4": True, "Řez: 4": True, "Autor: III": False, "1 ks": True, "12 kusů.": True, "3 m": False, "Reg.Bez.Aussig.": True,
    "radius prox.sin.": True, "malakofauna": False, "Equus caballus": False, "www.example.org/x": True, "a.b@c.cz": True, "Bez e-mailu se to neobejde.": False, "2,10 m": False, "Ch. i6dn.283/54": False,
}
CLAUSES = {
    "oueussd": ["vowel_run"], "sektlll": ["triple"], "cuxoaid": ["vowel_run"], "rragment": ["initial_geminate"], "vansasaasasa": ["low_variety"], "lllll": ["triple", "initial_geminate"], "Tthts I": ["initial_geminate"],
    "NINNNIC": ["triple", "low_variety"], "Poaceae": [], "Equus caballus": [], "S-VIIIb": [], "edelite": [], "Naiade": ["vowel_run"], "XXVIII": [], "": [], "okraj sekt,III,konec": [], "  ": [], "ooo": [],
}


def _truth(spark, cases, sql):
    rows = spark.createDataFrame([(t,) for t in cases], "t string").withColumn("w", s_words())
    return {r.t: r.v for r in rows.selectExpr("t", f"{sql} as v").collect()}


def s_words():
    from pyspark.sql import functions as F

    return F.expr(s.words("t"))


def test_structured_lines(spark):
    assert _truth(spark, STRUCTURED, s.structured("t", "w")) == STRUCTURED


def test_notation(spark):
    assert _truth(spark, NOTATION, s.notation("t")) == NOTATION


def test_clauses_of_shape(spark):
    assert _truth(spark, CLAUSES, s.shape_clauses("t", "'ces_Latn'")) == CLAUSES
    assert _truth(spark, ["Naiade", "oueussd"], s.shape_clauses("t", "'deu_Latn'")) == {"Naiade": [], "oueussd": ["vowel_run"]}
    assert _truth(spark, ["Naiade"], s.shape_clauses("t", "cast(null as string)")) == {"Naiade": ["vowel_run"]}
    assert _truth(spark, ["Naiade"], s.shape_clauses("t", "''", DEFAULT.but(witness_allowed=("Naiade",)))) == {"Naiade": []}


def test_witness_with_a_lexicon(spark):
    rows = [("d", 1, i, t, "ces_Latn") for i, t in enumerate(["oueussd edelite", "Naiade", "ppole", "12,5 cm oueussd", "č oueussd", None, "", "x12yzab"])]
    lines = spark.createDataFrame(rows, "file string, page_num int, line_num int, text string, lang string")
    got = lambda **k: {r.line_num: r.clauses for r in scoring.shape_witness(lines, **k).collect()}
    assert got() == {0: ["vowel_run"], 1: ["vowel_run"], 2: ["initial_geminate"]}
    lexicon = spark.createDataFrame([("naiade", 3), ("ppole", 2), ("oueussd", 1)], "token string, df long")
    assert got(lexicon=lexicon) == {0: ["vowel_run"], 2: ["initial_geminate"]}
    assert got(lexicon=lexicon, convict=True) == {0: ["vowel_run", "no_vocabulary"], 2: ["initial_geminate", "no_vocabulary"]}
    assert got(lexicon=lexicon.limit(0)) == got() and scoring.shape_witness(lines.limit(0)).count() == 0


@pytest.mark.parametrize(("changes", "category"), [({}, "Clear"), ({"witness_floor": True}, "Noisy"), ({"witness_floor": True, "disabled": frozenset({"rule_short_garbage_witness_floor"})}, "Clear")])
def test_floor_turns_clear_into_noisy_only(spark, changes, category):
    lines = spark.createDataFrame([("d", 1, 1, "oueussd", "ces_Latn", 0.99, 50.0), ("d", 1, 2, "Pohled na zámek od jihu", "ces_Latn", 0.99, 50.0), ("d", 1, 3, "12 34", None, None, None)], "file string, page_num int, line_num int, text string, lang string, lang_score double, perplex double")
    got = {r.line_num: (r.categ, r.rule) for r in scoring.process(lines, DEFAULT.but(**changes), passes=False).collect()}
    assert got[1][0] == category and got[2][0] == "Clear" and got[3][0] == "Non-text"
    assert (got[1][1] == "rule_short_garbage_witness_floor") == (category == "Noisy")

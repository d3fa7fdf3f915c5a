"""Changes of constants over a corpus: arms, their lines and pages against labels, and the verdict on them."""

from __future__ import annotations

from dataclasses import fields

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioscope.operators import aggregate, passes, scoring
from folioscope.operators.ordered import checkpointed
from folioscope.params import DEFAULT, Params

#: Constants that only the score, the rules and the passes read; arms that differ in no others share their signals.
LATE = frozenset(
    "ppl_max length_max w_valid w_weird w_perplexity w_length w_garbage w_vowel w_lang w_gibberish w_fused trash_max noisy_max density_norm vowel_low short_penalty hard_sweep_lang hard_sweep_ppl ppl_extreme extreme_lang ppl_absolute ppl_inverted "
    "lowppl_clear lowppl_czech czech_density mostly_readable surrounded_margin run_min page_majority rot_inverted weird_inverted rot_high_conf garbage_clear_max garbage_lang_max garbage_median_max garbage_noisy_max clean_clear_min clean_median_min "
    "clean_recover_min blend_weight blend_long_words blend_min_lines disabled".split()
)


def early(p: Params) -> tuple:
    """What of the constants the signals depend on."""
    return tuple((f.name, getattr(p, f.name)) for f in fields(p) if f.name not in LATE)


def reach(lines: DataFrame, arms: dict[str, Params], with_passes: bool = True) -> DataFrame:
    """The lines under each arm, with its name in ``arm``. Signals are the work: they are computed and written once for all
    arms whose signals agree; those of the shape witness, one column more, are with them if some arm has it."""
    alone = lambda p: p.but(witness=False, witness_floor=False)
    witnessed = {early(alone(p)) for p in arms.values() if p.witness or p.witness_floor}
    ready: dict[tuple, DataFrame] = {}
    out = None
    for name, p in arms.items():
        shared = early(alone(p))
        if shared not in ready:
            dealt = lines.repartition(int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions")), "file", "page_num")
            whole = p.but(witness_floor=True) if shared in witnessed else p
            ready[shared] = checkpointed(scoring.with_signals(scoring.prefilter(dealt, whole), whole))
        rows = ready[shared] if p.witness or p.witness_floor else ready[shared].drop("shape_clauses")
        rows = scoring.categorised(scoring.with_score(rows, p), p)
        rows = (passes.document_passes(rows, p) if with_passes else rows).withColumn("arm", F.lit(name))
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out


def ablation(base: Params = DEFAULT) -> dict[str, Params]:
    """Arms that lack one rule each, beside the whole."""
    names = dict.fromkeys(r[0] for r in scoring.rules(base) if r[0].startswith("rule_"))
    return {"base": base} | {f"-{n}": base.but(disabled=base.disabled | {n}) for n in names}


def line_results(pairs: DataFrame, *by: str) -> DataFrame:
    """Labelled lines (gold, ref, arm: categories) by the columns of ``by``: those a change fixes and breaks, and by how much
    more Clear lines it loses than it wins back. Lines without a label do not count."""
    right = lambda c: F.col(c).eqNullSafe(F.col("gold"))
    clear = F.when(F.col("gold") == "Clear", right("ref").cast("long") - right("arm").cast("long"))
    return pairs.where("gold is not null").groupBy(*by).agg(F.count("*").alias("labelled"), F.count_if(right("arm") & ~right("ref")).alias("fixed"), F.count_if(right("ref") & ~right("arm")).alias("broken"), F.coalesce(F.sum(clear), F.lit(0)).alias("clear_loss"))


def page_errors(lines: DataFrame, *by: str, pred: str = "categ", least: int = 3, coverage: float = 0.0) -> DataFrame:
    """How predicted pages differ from labelled ones, over the labelled lines of pages with enough of them: pages, those with
    a band and those that agree in it, summed errors of the Clear and Trash shares, and their means. Null where no page counts."""
    count = lambda c, k: F.count_if(F.col("gold").isNotNull() & (F.col(c) == k))
    each = [count(c, k).alias(f"{s}{k[0].lower()}") for c, s in (("gold", "g"), (pred, "p")) for k in ("Clear", "Noisy", "Trash")]
    pages = lines.groupBy(*by, "file", "page_num").agg(F.count("*").alias("all"), F.count("gold").alias("n"), *each).where((F.col("n") >= least) & (F.col("n") / F.col("all") >= coverage))
    band = lambda s: aggregate.quality_band(*(F.col(f"{s}{k}") for k in "cnt"))
    clear, trash = (F.col("pc") - F.col("gc")) / F.col("n"), (F.col("pt") - F.col("gt")) / F.col("n")
    sums = pages.groupBy(*by).agg(
        F.count("*").alias("pages"), F.count(band("g")).alias("band_pages"), F.count_if(band("g") == band("p")).alias("band_agree"), F.sum(F.abs(clear)).alias("clear_abs"), F.sum(F.abs(trash)).alias("trash_abs"), F.sum(clear).alias("clear_signed")
    )
    share = lambda a, b: F.round(F.try_divide(F.col(a).cast("double"), F.col(b)), 4)
    return sums.withColumns({"band_agreement": share("band_agree", "band_pages"), "clear_share_mae": share("clear_abs", "pages"), "trash_share_mae": share("trash_abs", "pages"), "clear_share_bias": share("clear_signed", "pages")})


def worse(arm: str, ref: str):
    """Array of what in the page errors of ``arm`` is worse than in those of ``ref`` (structs); empty where nothing is."""
    tests = {"band agreement": F.col(f"{arm}.band_agree") < F.col(f"{ref}.band_agree"), "Clear share": F.col(f"{arm}.clear_abs") > F.col(f"{ref}.clear_abs") + 1e-9, "Trash share": F.col(f"{arm}.trash_abs") > F.col(f"{ref}.trash_abs") + 1e-9}
    return F.array_compact(F.array(*(F.when(t, F.lit(k)) for k, t in tests.items())))


def page_check(results: DataFrame, errors: DataFrame, moves: DataFrame, ref: str, revert: str = "", record_only: tuple[str, ...] = (), flip_share: float = 0.005, move_share: float = 0.01) -> DataFrame:
    """One row an arm: its role, whether it qualifies and why not, and the verdict on all.

    ``results`` are ``line_results`` by (arm, source), ``errors`` are ``page_errors`` by arm (the reference's among them), and
    ``moves`` are (arm, pages, band_flips, moved). A candidate qualifies that fixes more labelled lines than it breaks, in no
    source breaks more than it fixes or loses Clear lines, worsens no page error, and matters: enough pages flip or move.
    ``revert`` names the state before a shipped change; the change fails where going back to it would mend what a
    candidate may not spoil. The verdict is REVERT if it fails, else HOLD if an arm qualifies, else GO.
    """
    back = F.col("arm") == revert
    lines = results.groupBy("arm").agg(
        F.sum("fixed").alias("fixed"), F.sum("broken").alias("broken"), F.sort_array(F.collect_set(F.when(F.col("broken") > F.col("fixed"), F.col("source")))).alias("net_broken"), F.sort_array(F.collect_set(F.when(F.col("clear_loss") > 0, F.col("source")))).alias("clear_lost"),
        F.sort_array(F.collect_set(F.when(F.col("broken") < F.col("fixed"), F.col("source")))).alias("net_fixed"), F.sort_array(F.collect_set(F.when(F.col("clear_loss") < 0, F.col("source")))).alias("clear_won"),
    )
    sums = F.struct("pages", "band_pages", "band_agree", "clear_abs", "trash_abs")
    own = errors.select("arm", sums.alias("mine"))
    base = errors.where(F.col("arm") == ref).agg(F.first(sums).alias("base"))  # one row
    rows = moves.where(F.col("arm") != ref).join(lines, "arm", "left").join(own, "arm", "left").join(F.broadcast(base), F.lit(True), "left")
    none = F.array().cast("array<string>")
    said = lambda column, text: F.transform(F.coalesce(column, none), lambda s: F.concat(F.lit(f"{text} "), s))
    when = lambda test, text: F.when(test, F.array(F.lit(text))).otherwise(none)
    immaterial = (F.col("pages") == 0) | ((F.col("band_flips") < flip_share * F.col("pages")) & (F.col("moved") < move_share * F.col("pages")))
    against = F.concat(
        said(F.col("net_broken"), "net broken on"), said(F.col("clear_lost"), "Clear lost on"), when(F.coalesce(F.col("fixed") <= F.col("broken"), F.lit(True)), "labelled lines not improved"), said(worse("mine", "base"), "pages worse in"), when(immaterial, "immaterial")
    )
    spoilt = F.concat(said(F.col("net_fixed"), "net broken on"), said(F.col("clear_won"), "Clear lost on"), said(worse("base", "mine"), "pages worse in"))
    role = F.when(F.col("arm").isin(*record_only, "") & (F.col("arm") != ""), "record only").when(back, "revert").otherwise("candidate")
    rows = rows.withColumn("role", role).withColumn("reasons", F.when(back, spoilt).otherwise(against))
    rows = rows.withColumn("holds", F.when(back, F.size("reasons") > 0).otherwise(F.size("reasons") == 0))
    every = Window.partitionBy()  # the arms, a handful
    failed, found = F.max((F.col("role") == "revert") & F.col("holds")).over(every), F.max((F.col("role") == "candidate") & F.col("holds")).over(every)
    verdict = F.when(failed, "REVERT").when(found, "HOLD").otherwise("GO")
    return rows.select("arm", "role", "holds", "reasons", verdict.alias("verdict"))


def ratio_violations(pages: DataFrame) -> DataFrame:
    """Per ratio column of a page table: values out of [0, 1], values that the page's own counts do not give, and nulls."""
    full = F.nullif(F.col("num_lines") - F.col("empty"), F.lit(0))
    names = ("clear", "noisy", "trash", "non-text", "empty")
    one = lambda c: F.round(F.col(f"`{c}`") / (F.nullif(F.col("num_lines"), F.lit(0)) if c == "empty" else full), 4)
    rows = pages.select(F.explode(F.array(*(F.struct(F.lit(f"{c}_ratio").alias("column"), F.col(f"`{c}_ratio`").alias("value"), one(c).alias("want")) for c in names))).alias("x")).select("x.*")
    wrong = ~F.coalesce(F.abs(F.col("value") - F.col("want")) <= 1e-9, F.col("value").isNull() & F.col("want").isNull())
    return rows.groupBy("column").agg(F.count_if((F.col("value") < 0) | (F.col("value") > 1)).alias("outside"), F.count_if(wrong).alias("wrong"), F.count_if(F.col("value").isNull()).alias("missing"))

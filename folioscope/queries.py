"""Registry of the library's own queries over the driver's tables, and their SQL equivalents.

``documents`` split at line feeds is the line table: file is the doc_id, a page has 40 lines. ``_banded`` adds the
columns that model runs would supply, as simple functions of the row that SQL can state as well.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.functions import signals as s
from folioscope.operators import aggregate, change, compare, evaluate, lexicon, lines as ln, passes, record, sampling, scoring
from folioscope.params import ABBREVIATION_CHAIN, CONTENTS_ENTRY, DIMENSIONS, HEADINGS, LABELS, MEASURED, NEUTRAL, PIECE_COUNT, ROTATABLE, SHORT_EXCEPTION, SHORT_VALID, TAXON_ENDINGS, UNITS, VOWELS, WORD_AND_CHAIN

_Q: dict = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        _Q[f.__name__] = f
        if sql is not None:
            _SQL[f.__name__] = sql
        return f

    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _lines(spark, sf_dir) -> DataFrame:
    return ln.explode_lines(_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"))


_L = r"""with raw as (select doc_id, lang, source, unnest(string_split(text, chr(10))) as text, generate_subscripts(string_split(text, chr(10)), 1) - 1 as i from documents),
l as (select doc_id::varchar as file, (i // 40 + 1)::int as page_num, (i % 40 + 1)::int as line_num, text, lang, source from raw)
"""
_KEYS = "file, page_num, line_num"


def _signal(name: str, spark: str, duck: str):
    def run(spark_session, sf_dir, expr=spark):
        return _lines(spark_session, sf_dir).select("file", "page_num", "line_num", F.expr(expr).alias("value"))

    run.__name__ = name
    return query(_L + f"select {_KEYS}, {duck} as value from l")(run)


def _n(pattern: str, of: str = "text") -> str:
    return f"(length({of}) - length(regexp_replace({of}, '{pattern}', '', 'g')))"


_WS = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_safe = lambda a, b: f"case when {b} = 0 then 0 else {a}::double / {b} end"
_signal("garbage_density", s.garbage_density("text"), _safe(_n(r"[^\p{L}\p{N} ]"), "length(text)"))
_signal("symbol_ratio", s.symbol_ratio("text"), _safe(_n(rf"[^\p{{L}}\p{{N}}{_WS}]"), "length(text)"))
_signal("digit_ratio", s.digit_ratio("text"), _safe(_n(r"\p{Nd}"), "length(text)"))
_signal("vowel_ratio", s.vowel_ratio("text"), _safe(_n(f"[{VOWELS}]"), f"({_n(r'\p{L}')} + {_n(rf'[^\p{{L}}\p{{N}}{_WS}]')})"))
_signal("rotatable_ratio", s.rotatable_ratio("text"), _safe(_n(f"[{ROTATABLE}]", "lower(text)"), _n(r"\p{L}")))
_signal("has_diacritics", s.has_diacritics("text"), "regexp_matches(text, '[áčďéěíňóřšťúůýžÁČĎÉĚÍŇÓŘŠŤÚŮÝŽ]')")
_signal("word_count", f"size({s.words('text')})", rf"len(regexp_extract_all(text, '[^{_WS}]+'))")
_signal("wx_words", s.wx_words(s.parts(s.words("text"))), rf"len(list_filter(regexp_extract_all(text, '[^{_WS}]+'), lambda w: regexp_matches(w, '[wW][^.–-]*[wW]|[xX][^.–-]*[xX]')))")
_signal("all_caps_lines", s.all_caps(s.words("text")), rf"len(list_filter(regexp_extract_all(text, '[^{_WS}]+'), lambda w: regexp_matches(w, '\p{{L}}'))) > 0 and len(list_filter(regexp_extract_all(text, '[^{_WS}]+'), lambda w: regexp_matches(w, '\p{{L}}') and not (w = upper(w) and regexp_matches(w, '[\p{{Lu}}\p{{Lt}}]') and not regexp_matches(w, '\p{{Ll}}')))) = 0")
_signal("diacritic_language", s.diacritic_language("text"), "case when " + _n(r"\p{L}") + " = 0 then null when " + _n("[áčďéěíňóřšťúůýžÁČĎÉĚÍŇÓŘŠŤÚŮÝŽ]") + "::double / " + _n(r"\p{L}") + " >= 0.07 then 'ces' when " + _n("[äöüßÄÖÜ]") + "::double / " + _n(r"\p{L}") + " >= 0.07 then 'deu' end")
_signal("fused_long_words", f"size(filter({s.cores(s.words('text'))}, c -> length(c) > 14))", rf"len(list_filter(regexp_extract_all(text, '[^{_WS}]+'), lambda w: length(trim(w, '.,;:!?()[]\"''/\')) > 14))")


def _banded(spark, sf_dir) -> DataFrame:
    rows = _lines(spark, sf_dir).withColumn("d", F.expr(s.garbage_density("text"))).withColumn("f", F.col("file").cast("long"))
    rows = rows.withColumn("quality_score", F.expr("round(least(1D, 0.3D + length(text) / 150D) * (1 - least(d * 4, 1D)), 4)"))
    return rows.withColumns({
        "categ": F.expr("case when text = '' then 'Empty' when not text rlike '\\\\p{L}' then 'Non-text' when quality_score < 0.45 then 'Trash' when quality_score < 0.75 then 'Noisy' else 'Clear' end"),
        "lang_score": F.expr("((f * 7 + line_num * 13) % 100) / 100D"), "perplex": F.expr("20D + (length(text) * 37) % 977"), "word_count": F.expr("size(filter(split(text, ' +'), w -> w <> ''))"), "char_count": F.length("text"),
        "flag": F.expr("(f + floor((line_num + page_num) / 5)) % 3 = 0"), "gold": F.expr("case (f * 3 + line_num) % 7 when 0 then 'Trash' when 1 then 'Noisy' when 2 then 'Clear' end"),
    }).drop("d", "f")


_B = _L + r""", b0 as (select *, round(least(1.0::double, 0.3::double + length(text) / 150.0::double) * (1 - least(case when length(text) = 0 then 0 else length(regexp_replace(text, '[\p{L}\p{N} ]', '', 'g'))::double / length(text) end * 4, 1.0::double)), 4) as quality_score from l),
b as (select *, case when text = '' then 'Empty' when not regexp_matches(text, '\p{L}') then 'Non-text' when quality_score < 0.45 then 'Trash' when quality_score < 0.75 then 'Noisy' else 'Clear' end as categ,
 ((file::bigint * 7 + line_num * 13) % 100) / 100.0::double as lang_score, 20.0::double + (length(text) * 37) % 977 as perplex, len(list_filter(string_split(text, ' '), lambda w: w <> '')) as word_count, length(text) as char_count,
 (file::bigint + (line_num + page_num) // 5) % 3 = 0 as flag, case (file::bigint * 3 + line_num) % 7 when 0 then 'Trash' when 1 then 'Noisy' when 2 then 'Clear' end as gold from b0)
"""


@query(_L + f"select {_KEYS}, text from l")
def lines_explode(spark, sf_dir):
    return _lines(spark, sf_dir).select("file", "page_num", "line_num", "text")


@query(_B + f"select {_KEYS}, categ, quality_score from b")
def banded_lines(spark, sf_dir):
    return _banded(spark, sf_dir).select("file", "page_num", "line_num", "categ", "quality_score")


@query(_B + """, m as (select file, page_num, lang, row_number() over (partition by file, page_num order by n desc, lang) as k from (select file, page_num, lang, count(*) as n from b where categ in ('Clear', 'Noisy') group by file, page_num, lang)),
g as (select file, page_num, count(*) filter (categ = 'Clear') as clear, count(*) filter (categ = 'Noisy') as noisy, count(*) filter (categ = 'Trash') as trash, count(*) filter (categ = 'Non-text') as "non-text", count(*) filter (categ = 'Empty') as empty,
 coalesce(sum(word_count) filter (categ in ('Clear', 'Noisy')), 0)::bigint as total_word_count, coalesce(sum(char_count) filter (categ in ('Clear', 'Noisy')), 0)::bigint as total_char_count,
 avg(quality_score) filter (categ in ('Clear', 'Noisy')) as avg_quality_score, avg(lang_score) filter (categ in ('Clear', 'Noisy')) as avg_lang_score, avg(perplex) filter (categ in ('Clear', 'Noisy')) as avg_perplex,
 count(*) as num_lines,
 count(*) filter (categ = 'Clear') / nullif(count(*) filter (categ <> 'Empty'), 0)::double as clear_ratio, count(*) filter (categ = 'Noisy') / nullif(count(*) filter (categ <> 'Empty'), 0)::double as noisy_ratio,
 count(*) filter (categ = 'Trash') / nullif(count(*) filter (categ <> 'Empty'), 0)::double as trash_ratio, count(*) filter (categ = 'Non-text') / nullif(count(*) filter (categ <> 'Empty'), 0)::double as "non-text_ratio",
 count(*) filter (categ = 'Empty') / count(*)::double as empty_ratio from b group by file, page_num)
select g.*, m.lang as main_lang from g left join m on m.file = g.file and m.page_num = g.page_num and k = 1""")
def page_stats(spark, sf_dir):
    return aggregate.page_stats(_banded(spark, sf_dir), digits=None)


@query(_B + """, p as (select file, page_num, avg(quality_score) filter (categ in ('Clear', 'Noisy')) as s from b group by all)
select file, avg(s) as mean, median(s) as median, min(s) as min, max(s) as max, count(*) as pages from p group by file""")
def quality_summary(spark, sf_dir):
    return aggregate.quality_summary(_banded(spark, sf_dir), digits=None).drop("by_categ")


@query(_B + """, p as (select file, page_num, count(*) filter (categ = 'Clear') c, count(*) filter (categ = 'Noisy') n, count(*) filter (categ = 'Trash') t from b group by all)
select file, page_num, case when c + n + t = 0 then null when c >= n and c >= t then 'Clear' when n >= t then 'Noisy' else 'Trash' end as band from p""")
def page_bands(spark, sf_dir):
    p = aggregate.page_stats(_banded(spark, sf_dir))
    return p.select("file", "page_num", aggregate.quality_band(F.col("clear"), F.col("noisy"), F.col("trash")).alias("band"))


@query(_B + f""", n as (select file, text, categ, row_number() over (partition by file, text order by n desc, categ) k from (select file, text, categ, count(*) as n from b group by file, text, categ))
select b.file, page_num, line_num, n.categ, n.categ <> b.categ as pp_dedup from b join n on n.file = b.file and n.text = b.text and k = 1""")
def dedup_modal(spark, sf_dir):
    return passes.dedup_modal(_banded(spark, sf_dir)).select("file", "page_num", "line_num", "categ", "pp_dedup")


_W = "over (partition by file order by page_num, line_num)"


@query(_B + f""", w as (select *, coalesce(lag(categ, 1) {_W} = 'Trash' and lag(categ, 2) {_W} = 'Trash' and lead(categ, 1) {_W} = 'Trash' and lead(categ, 2) {_W} = 'Trash', false) and categ = 'Noisy' and quality_score < 0.70 and count(*) over (partition by file) >= 5 as hit from b)
select {_KEYS}, case when hit then 'Trash' else categ end as categ, hit as pp_surrounded_trash from w""")
def surrounded_islands(spark, sf_dir):
    return passes.surrounded(_banded(spark, sf_dir)).select("file", "page_num", "line_num", "categ", "pp_surrounded_trash")


@query(_B + f""", w as (select *, avg(case when categ not in ('Empty', 'Non-text') then (categ = 'Clear')::int end) over p as c, avg(case when categ not in ('Empty', 'Non-text') then (lang_score >= 0.75)::int end) over p as t,
 median(case when categ not in ('Empty', 'Non-text') then quality_score end) over p as m from b window p as (partition by file, page_num)),
r as (select *, case when c <= 0.05 and t < 0.5 and m < 0.55 and categ = 'Noisy' and quality_score < 0.8 then 'Trash' when c > 0.6 and m > 0.8 and categ = 'Trash' and lang_score >= 0.75 and quality_score >= 0.45 then 'Noisy' end as x from w)
select {_KEYS}, coalesce(x, categ) as categ, x is not null as pp_page_context from r""")
def page_context(spark, sf_dir):
    return passes.page_context(_banded(spark, sf_dir)).select("file", "page_num", "line_num", "categ", "pp_page_context")


@query(_B + f""", s as (select *, categ not in ('Empty', 'Non-text') as on_ from b),
i as (select *, sum((not flag)::int) over (partition by file, on_ order by page_num, line_num rows between unbounded preceding and current row) as island from s),
r as (select *, sum(flag::int) over (partition by file, on_, island) as run, avg(flag::int) over (partition by file, on_) as share from i),
h as (select *, on_ and flag and (share >= 0.6 or run >= 4) as hit from r)
select {_KEYS}, case when hit then 'Trash' else categ end as categ, hit and categ <> 'Trash' as pp_inverted_run from h""")
def suspicious_runs(spark, sf_dir):
    return passes.suspicious_runs(_banded(spark, sf_dir), flag="flag").select("file", "page_num", "line_num", "categ", "pp_inverted_run")


@query(_B + f""", m as (select *, count(*) filter (word_count >= 4) over p as n, median(case when word_count >= 4 then perplex end) over p as page, median(case when word_count >= 4 then perplex end) over (partition by file) as doc from b window p as (partition by file, page_num))
select {_KEYS}, round(exp(0.5 * ln(perplex) + 0.5 * ln(coalesce(case when n >= 3 then page end, doc))), 2) as perplex_blend from m""")
def perplexity_blend(spark, sf_dir):
    return passes.blended_perplexity(_banded(spark, sf_dir)).select("file", "page_num", "line_num", "perplex_blend")


@query(_L + """, t as (select file, page_num, line_num, case when line_num % 3 = 0 and regexp_matches(text, '\\p{L}$') then text || '-' else text end as text from l),
o as (select *, regexp_matches(text, '\\p{L}-$') as op from t),
g as (select *, coalesce(sum((not op)::int) over (partition by file, page_num order by line_num rows between unbounded preceding and 1 preceding), 0) as g from o)
select file, page_num, min(line_num) as line_num, string_agg(case when op then text[:-2] else text end, '' order by line_num) as text, count(*) as n_joined from g group by file, page_num, g""")
def hyphen_join(spark, sf_dir):
    rows = _lines(spark, sf_dir).withColumn("text", F.expr("if(line_num % 3 = 0 and text rlike '\\\\p{L}$', concat(text, '-'), text)"))
    return ln.join_hyphens(rows)


@query(_B + f"select {_KEYS}, categ, gold as gold_categ from b")
def gold_join(spark, sf_dir):
    b = _banded(spark, sf_dir)
    gold = b.where("gold is not null").select("file", "page_num", "line_num", F.col("gold").alias("gold_categ"))
    return compare.with_gold(b, gold).select("file", "page_num", "line_num", "categ", "gold_categ")


def _pairs(spark, sf_dir, *keep):
    b = _banded(spark, sf_dir)
    base = b.where("line_num % 11 <> 0")
    arm = b.where("line_num % 13 <> 0").withColumn("categ", F.expr("case when quality_score < 0.5 then 'Trash' when quality_score < 0.7 then 'Noisy' else categ end"))
    return compare.paired(base, arm, "text", keep=keep)


_P = _B + """, arm as (select file, page_num, line_num, case when quality_score < 0.5 then 'Trash' when quality_score < 0.7 then 'Noisy' else categ end as arm from b where line_num % 13 <> 0),
base as (select file, page_num, line_num, categ as base from b where line_num % 11 <> 0), p as (select * from base full join arm using (file, page_num, line_num))
"""


@query(_P + "select base, arm, count(*) as n, count(*) / sum(count(*)) over ()::double as share from p where base <> arm group by base, arm")
def arm_transitions(spark, sf_dir):
    return compare.transitions(_pairs(spark, sf_dir))


@query(_P + "select count(*) filter (arm is null) as only_base, count(*) filter (base is null) as only_arm, count(*) filter (base <> arm) as changed, count(*) as rows from p")
def unpaired_lines(spark, sf_dir):
    return compare.unpaired(_pairs(spark, sf_dir))


def _confusion(spark, sf_dir):
    return compare.confusion(_banded(spark, sf_dir).where("gold is not null"), "gold", "categ")


_C = _B + ", t as (select gold, categ as pred, count(*) as n from b where gold is not null group by all)\n"


@query(_C + "select * from t")
def confusion(spark, sf_dir):
    return _confusion(spark, sf_dir)


_F1 = _C + """, g as (select gold as label, sum(n) as support from t group by 1), q as (select pred as label, sum(n) as predicted from t group by 1), h as (select gold as label, n as hits from t where gold = pred),
r as (select label, coalesce(support, 0)::bigint as support, coalesce(predicted, 0)::bigint as predicted, coalesce(hits, 0)::bigint as hits from g full join q using (label) left join h using (label)),
pr as (select *, case when predicted = 0 then 0 else hits / predicted::double end as precision, case when support = 0 then 0 else hits / support::double end as recall from r),
c as (select *, case when precision + recall = 0 then 0 else 2 * precision * recall / (precision + recall) end as f1 from pr)
"""


@query(_F1 + "select * from c")
def precision_recall(spark, sf_dir):
    return compare.per_class(_confusion(spark, sf_dir))


@query(_F1 + "select avg(f1) as macro_f1, sum(f1 * support) / sum(support) as weighted_f1, sum(hits)::double / sum(support) as accuracy from c")
def f1_macro(spark, sf_dir):
    return compare.averages(compare.per_class(_confusion(spark, sf_dir)))


@query(_C + """, g as (select gold as label, sum(n) / (select sum(n) from t)::double as p from t group by 1), q as (select pred as label, sum(n) / (select sum(n) from t)::double as q from t group by 1)
select sum((coalesce(p, 0) + 1e-12) * ln((coalesce(p, 0) + 1e-12) / (coalesce(q, 0) + 1e-12))) as kl from g full join q using (label)""")
def kl_divergence(spark, sf_dir):
    return compare.kl_divergence(_confusion(spark, sf_dir))


@query(_C + "select sum(n * case when gold = pred then 0 when gold = 'Clear' and pred in ('Trash', 'Non-text') then 3 when gold = 'Clear' and pred = 'Noisy' then 1 when gold = 'Noisy' and pred in ('Trash', 'Non-text') then 2 when gold in ('Non-text', 'Empty') and pred = 'Clear' then 2 when gold = 'Trash' and pred = 'Clear' then 2 when gold = 'Trash' and pred = 'Noisy' then 1 when gold = 'Noisy' and pred = 'Clear' then 0.5 else 1 end::double) / sum(n) as mean_cost from t")
def costed_flips(spark, sf_dir):
    return compare.costed_flips(_confusion(spark, sf_dir))


@query(_C + """, x as (select sum(n) as t, sum(n) filter (gold = pred) as same from t), g as (select gold as l, sum(n) as a from t group by 1), q as (select pred as l, sum(n) as b from t group by 1), c as (select sum(a * b)::double as c from g join q using (l))
select (same / t::double - c / (t::double * t)) / (1 - c / (t::double * t)) as kappa from x, c""")
def kappa(spark, sf_dir):
    return compare.kappa(_confusion(spark, sf_dir))


@query(_L + r", k as (select distinct file, source, unnest(regexp_extract_all(lower(text), '\p{L}{2,}')) as token from l) select token, count(distinct file) as df from k group by token")
def token_df(spark, sf_dir):
    return lexicon.document_frequency(lexicon.tokens(_lines(spark, sf_dir).select("file", "text")))


@query(_L + r", k as (select distinct file, source, unnest(regexp_extract_all(lower(text), '\p{L}{2,}')) as token from l) select token, source, count(*) as df from k group by token, source union all select token, null, count(*) from k group by token")
def token_df_rollup(spark, sf_dir):
    return lexicon.text_frequency(_table(spark, sf_dir, "documents"), by="source")


_LEX = _L + r", k as (select distinct file, unnest(regexp_extract_all(lower(text), '\p{L}{2,}')) as token from l), x as (select token, count(*) as df from k group by token)" + "\n"


_NEIGHBOURS = _LEX + """, r as (select token from x where df < 3), c as (select token as candidate, df from x where df >= 20),
rd as (select token, token as k, 0 as i from r union all select token, token[1:i - 1] || token[i + 1:], i from r, unnest(range(1, length(token) + 1)) as u(i)),
cd as (select candidate, df, candidate as k, 0 as j from c union all select candidate, df, candidate[1:i - 1] || candidate[i + 1:], i from c, unnest(range(1, length(candidate) + 1)) as u(i))
select distinct token, candidate, df from rd join cd using (k) where token <> candidate and (length(token) = length(candidate) and i = j or abs(length(token) - length(candidate)) = 1 and (i = 0 or j = 0))"""


@query(_NEIGHBOURS)
def deletes_join(spark, sf_dir):
    lex = lexicon.document_frequency(lexicon.tokens(_lines(spark, sf_dir).select("file", "text")))
    return lexicon.neighbours(lex.where("df < 3"), lex.where("df >= 20"))


@query(_NEIGHBOURS)  # its name of earlier rounds
def one_edit_neighbours(spark, sf_dir):
    return deletes_join(spark, sf_dir)


@query(_B + r""", f as (select regexp_replace(lower(text), '[^\p{L}\p{N}_]', '', 'g') as family, categ, text from b), g as (select family, categ, count(*) as n from f where family <> '' group by all), v as (select family, count(distinct text)::int as variants from f group by 1)
select family, sum(n)::bigint as lines, any_value(variants) as variants, string_agg(categ || ':' || n, '|' order by categ) as mix from g join v using (family) group by family""")
def family_mix(spark, sf_dir):
    return lexicon.families(_banded(spark, sf_dir))


@query(_B + "select text, n, row_number() over (order by n desc, text) as rank, sum(n) over (order by n desc, text rows unbounded preceding) / sum(n) over ()::double as cum_share from (select text, count(*) as n from b group by text)")
def top_groups_cumshare(spark, sf_dir):
    return compare.ranked_groups(_banded(spark, sf_dir), "text")


_HASH = "(('0x' || substr(md5('{seed}|' || {key}), 1, 13))::bigint / 4503599627370496.0::double)"


@query("with n as (select source as stratum, count(*) as n from documents group by 1), e as (select *, n * 100 / sum(n) over ()::double as e from n), f as (select *, floor(e) as f from e), r as (select *, row_number() over (order by e - f desc, stratum) as k, 100 - sum(f) over () as left_ from f), "
       "a as (select stratum, least(n, f + (k <= left_)::int) as take from r), d as (select doc_id, source, row_number() over (partition by source order by " + _HASH.format(seed=0, key="doc_id::varchar") + ", doc_id) as k from documents) select doc_id, source from d join a on source = stratum where k <= take")
def stratified_sample(spark, sf_dir):
    return sampling.stratified(_table(spark, sf_dir, "documents").select("doc_id", "source"), "source", "doc_id", 100).select("doc_id", "source")


@query("select doc_id, source from (select doc_id, source, row_number() over (partition by source order by " + _HASH.format(seed=0, key="doc_id::varchar") + ", doc_id) as k from documents) where k <= 5")
def cap_per_source(spark, sf_dir):
    return sampling.cap_per_group(_table(spark, sf_dir, "documents").select("doc_id", "source"), "source", "doc_id", 5)


@query("select doc_id, case when h < 80 then 'train' when h < 90 then 'dev' else 'test' end as split from (select doc_id, floor(" + _HASH.format(seed=23, key="doc_id::varchar") + " * 100) as h from documents)")
def hash_split(spark, sf_dir):
    return sampling.split(_table(spark, sf_dir, "documents").select("doc_id"), "doc_id")


@query(_B + ", x as (select quality_score as s, (gold = categ)::int as y from b where gold is not null) select least(9, floor(s * 10 + 1e-9))::int as bin, count(*) as n, avg(s) as mean_score, avg(y) as share from x group by 1")
def calibration_bins(spark, sf_dir):
    return compare.calibration_bins(_banded(spark, sf_dir).where("gold is not null").withColumn("y", F.expr("cast(gold = categ as int)")), "quality_score", "y")


@query(_B + ", x as (select quality_score as s, count(*) as n, sum((gold <> categ)::int) as e from b where gold is not null group by 1) select s as confidence, sum(n) over w / sum(n) over ()::double as coverage, sum(e) over w / (sum(n) over w)::double as error from x window w as (order by s desc rows unbounded preceding)")
def coverage_curve(spark, sf_dir):
    return compare.coverage_curve(_banded(spark, sf_dir).where("gold is not null").withColumn("y", F.expr("cast(gold = categ as int)")), "quality_score", "y")


@query(_B + ", r as (select rank() over (order by quality_score) + (count(*) over (partition by quality_score) - 1) / 2.0::double as a, rank() over (order by char_count) + (count(*) over (partition by char_count) - 1) / 2.0::double as b from b) select corr(a, b) as spearman from r")
def spearman(spark, sf_dir):
    return compare.spearman(_banded(spark, sf_dir).select("quality_score", "char_count"), "quality_score", "char_count")


@query(_B + ", r as (select (gold = 'Clear')::int as y, rank() over (order by quality_score) + (count(*) over (partition by quality_score) - 1) / 2.0::double as r from b where gold is not null) select (sum(r * y) - sum(y) * (sum(y) + 1) / 2.0) / (sum(y) * (count(*) - sum(y)))::double as auc from r")
def auc(spark, sf_dir):
    return compare.auc(_banded(spark, sf_dir).where("gold is not null").withColumn("y", F.expr("cast(gold = 'Clear' as int)")), "quality_score", "y")


@query(_L + f"select {_KEYS}, string_agg(text, chr(10)) over (partition by file, page_num order by line_num rows between 2 preceding and 2 following) as context from l")
def context_window(spark, sf_dir):
    return compare.context(_lines(spark, sf_dir)).select("file", "page_num", "line_num", "context")


@query(_B + f", x as (select *, case when line_num % 4 = 1 then categ end as v from b) select {_KEYS}, coalesce(last_value(v ignore nulls) over (partition by file order by page_num, line_num rows between unbounded preceding and current row), first_value(v ignore nulls) over (partition by file order by page_num, line_num rows between current row and unbounded following)) as filled from x")
def forward_fill(spark, sf_dir):
    rows = _banded(spark, sf_dir).withColumn("v", F.expr("case when line_num % 4 = 1 then categ end"))
    return compare.fill(rows, "v", ["file"], ["page_num", "line_num"]).select("file", "page_num", "line_num", "filled")


@query("select coalesce(d.doc_id, l.doc_id) as doc_id, lang, coalesce(case when quality = 1 then source || '!' end, source) as source from documents d full join (select doc_id, max(quality) as quality from labels group by 1) l on d.doc_id = l.doc_id")
def upsert_merge(spark, sf_dir):
    old = _table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    new = _table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").alias("q")).join(old, "doc_id", "left").select("doc_id", F.expr("case when q = 1 then concat(source, '!') end").alias("source"))
    return compare.upsert(old, new, ["doc_id"], ["source"])


@query("select doc_id from documents where doc_id not in (select doc_id from labels where doc_id is not null)")
def doc_anti(spark, sf_dir):
    return _table(spark, sf_dir, "documents").join(_table(spark, sf_dir, "labels"), "doc_id", "left_anti").select("doc_id")


@query("select doc_id from documents intersect select doc_id from labels")
def doc_intersect(spark, sf_dir):
    return _table(spark, sf_dir, "documents").select("doc_id").intersect(_table(spark, sf_dir, "labels").select("doc_id"))


@query("select doc_id, (if(doc_id % 3 = 0, 'slk', if(doc_id % 3 = 1, lang, 'ces')) || '_Latn') as label, case when doc_id % 3 = 2 then 'ces_Latn' when doc_id % 3 = 0 then 'slk_Latn' else 'ces_Latn' end as lang, case when doc_id % 3 = 1 then 0.75 else (doc_id % 100) / 100.0 end::double as score from documents")
def lang_remap(spark, sf_dir):
    d = _table(spark, sf_dir, "documents").select("doc_id", F.expr("concat(if(doc_id % 3 = 0, 'slk', if(doc_id % 3 = 1, lang, 'ces')), '_Latn')").alias("label"))
    d = d.withColumn("r", F.expr(s.remapped_language("label", "((doc_id % 100) / 100D)", ("ces", "deu", "eng", "fra", "pol", "ita", "slk"))))
    return d.select("doc_id", "label", "r.lang", "r.score")


@query("select doc_id, 'CTX' || (1880 + doc_id % 140)::varchar || lpad(doc_id::varchar, 6, '0') as file, ((1880 + doc_id % 140) // 10 * 10)::bigint as decade from documents")
def decade_strata(spark, sf_dir):
    d = _table(spark, sf_dir, "documents").select("doc_id", F.expr("concat('CTX', 1880 + doc_id % 140, lpad(cast(doc_id as string), 6, '0'))").alias("file"))
    return d.withColumn("decade", ln.decade())


@query("select label, row_number() over (order by try_cast(label as bigint) is null, try_cast(label as bigint), label) as position from (select distinct case when doc_id % 5 = 0 then 'p' || (doc_id % 97) else (doc_id % 97)::varchar end as label from documents)")
def natural_sort(spark, sf_dir):
    from pyspark.sql import Window

    d = _table(spark, sf_dir, "documents").select(F.expr("if(doc_id % 5 = 0, concat('p', doc_id % 97), cast(doc_id % 97 as string))").alias("label")).distinct()
    return d.select("label", F.row_number().over(Window.orderBy(ln.natural_key("label"))).alias("position"))


@query("select doc_id, '  ' || source || ' ' as raw, trim(source) as category, (doc_id::double)::bigint::varchar as locator, array_to_string(list_sort(list_distinct([lang, source])), ',') as pages, case when quality_ >= 0.8 then 'accept' when quality_ < 0.3 then 'review' else 'escalate' end as lane, case when quality_ >= 0.99 then 'full' when quality_ > 0 then 'partial' else 'none' end as recovered from (select *, (doc_id % 100) / 100.0::double as quality_ from documents)")
def label_rules(spark, sf_dir):
    d = _table(spark, sf_dir, "documents").withColumn("quality_", F.expr("(doc_id % 100) / 100D"))
    raw = F.concat(F.lit("  "), "source", F.lit(" "))
    return d.select(
        "doc_id", raw.alias("raw"), evaluate.normalised_category(raw).alias("category"), evaluate.locator(F.concat(F.lit(" "), "doc_id", F.lit(".0"))).alias("locator"),
        F.array_join(delimiter=",", col=evaluate.page_list(F.concat("lang", F.lit(", "), "source", F.lit(",, "), "lang"))).alias("pages"), evaluate.lane(F.col("quality_"), 0.8, 0.3).alias("lane"), evaluate.recoverability_band(F.col("quality_").cast("string")).alias("recovered"),
    )


@query(_B + f"select {_KEYS}, file || ':' || page_num || ':' || line_num as line_id, categ in ('Empty', 'Non-text') and word_count = 0 as fast_track, case when quality_score < 0.55 then 'Trash' when quality_score < 0.8 then 'Noisy' else 'Clear' end as band, case when word_count >= 5 then '5+' else greatest(word_count, 1)::varchar end as bucket from b")
def line_rules(spark, sf_dir):
    b = _banded(spark, sf_dir)
    return b.select("file", "page_num", "line_num", evaluate.line_id().alias("line_id"), evaluate.fast_track(F.col("categ"), F.col("word_count")).alias("fast_track"), evaluate.band_category(F.col("quality_score")).alias("band"), evaluate.word_bucket(F.col("word_count")).alias("bucket"))


@query(_B + """, n as (select file, text, categ, count(*) as n from b group by all), m as (select *, max(n) over p as most, sum(n) over p as total, count(*) over p as kinds from n window p as (partition by file, text)),
t as (select file, text, any_value(total)::bigint as lines, any_value(most) as most, any_value(kinds) as kinds, count(*) filter (n = most) as tied, min(categ) filter (n = most) as winner from m group by file, text)
select file, text, lines, case when kinds = 1 then 'unanimous' when tied > 1 then 'tie' when 2 * most > lines then 'strict majority' else 'bare plurality' end as shape, winner from t""")
def vote_shapes(spark, sf_dir):
    return evaluate.votes(_banded(spark, sf_dir))


@query(_B + r""", f as (select regexp_replace(lower(text), '[^\p{L}\p{N}_]', '', 'g') as family, categ from b), g as (select family, categ, count(*) as n from f where family <> '' group by all)
select family, arg_max(categ, (n, -ascii(categ), -ascii(substr(categ, 2)))) as dominant, count(*) > 1 as contested from g group by family""")
def family_verdicts(spark, sf_dir):
    return lexicon.families(_banded(spark, sf_dir)).select("family", evaluate.dominant(F.col("mix")).alias("dominant"), evaluate.contested(F.col("mix")).alias("contested"))


@query(_P + ", g as (select p.*, b.gold from p join b using (file, page_num, line_num) where b.gold is not null and base is not null and arm is not null), r as (select *, map {'Trash': 0, 'Noisy': 1, 'Clear': 2} as k from g), "
       "d as (select gold, base, arm, abs(k[base] - k[gold]) as was, abs(k[arm] - k[gold]) as now from r) "
       "select base, arm, case when arm = gold and base <> gold then 'fixed' when base = gold and arm <> gold then 'broken' else 'neither' end as verdict, case when now < was then 'closer' when now > was then 'farther' when now = was then 'same' else 'n/a' end as nearer, count(*) as n from d group by all")
def change_verdicts(spark, sf_dir):
    pairs = _pairs(spark, sf_dir).where("base is not null and arm is not null").join(_banded(spark, sf_dir).where("gold is not null").select("file", "page_num", "line_num", "gold"), ["file", "page_num", "line_num"])
    gold, base, arm = F.col("gold"), F.col("base"), F.col("arm")
    return pairs.groupBy("base", "arm", compare.verdict(gold, base, arm).alias("verdict"), evaluate.nearer(gold, base, arm).alias("nearer")).agg(F.count("*").alias("n"))


@query(_B + ", o as (select file, page_num, line_num, k as option, case when k = categ then quality_score else (1 - quality_score) / 4.0::double end as p, k = gold as y from b, (select unnest(['Clear', 'Noisy', 'Trash', 'Non-text', 'Empty']) as k) where gold is not null), e as (select sum((p - y::int) * (p - y::int)) as e from o group by file, page_num, line_num) select avg(e) as brier, count(*) as items from e")
def brier_score(spark, sf_dir):
    names = F.array(*map(F.lit, ("Clear", "Noisy", "Trash", "Non-text", "Empty")))
    o = _banded(spark, sf_dir).where("gold is not null").withColumn("option", F.explode(names))
    o = o.withColumns({"p": F.expr("if(option = categ, quality_score, (1 - quality_score) / 4)"), "y": F.expr("option = gold")})
    return evaluate.brier(o, ["file", "page_num", "line_num"], "p", "y")


@query(_B + ", x as (select least(9, greatest(0, ceil(quality_score * 10)::int - 1)) as bin, quality_score as c, (gold = categ)::int as h from b where gold is not null), y as (select bin, count(*) as n, avg(c) as c, avg(h) as h from x group by bin) select sum(abs(h - c) * n) / sum(n)::double as ece, sum(n)::bigint as n from y")
def calibration_error(spark, sf_dir):
    return evaluate.calibration_error(_banded(spark, sf_dir).where("gold is not null").withColumn("y", F.expr("gold = categ")), "quality_score", "y")


@query(_B + ", x as (select quality_score as s, count(*) as n, sum((gold <> categ)::int) as e from b where gold is not null group by 1), c as (select s as confidence, sum(n) over w / sum(n) over ()::double as coverage, sum(e) over w / (sum(n) over w)::double as error from x window w as (order by s desc rows unbounded preceding)) select confidence, coverage, error from c where error <= 0.6 order by confidence limit 1")
def threshold_pick(spark, sf_dir):
    rows = _banded(spark, sf_dir).where("gold is not null").withColumn("y", F.expr("cast(gold = categ as int)"))
    return evaluate.pick_threshold(compare.coverage_curve(rows, "quality_score", "y"), 0.6)


@query(_P + ", g as (select coalesce(base = gold, false) as x, coalesce(arm = gold, false) as y from p join b using (file, page_num, line_num) where gold is not null), c as (select count(*) filter (x and not y) as only_one, count(*) filter (y and not x) as only_two from g), n as (select *, only_one + only_two as n, least(only_one, only_two) as k from c) "
       "select only_one, only_two, round(case when n = 0 then 1 else least(1, 2 * list_sum(list_transform(range(0, k + 1), lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) - n * ln(2))))) end, 6) as p_value from n")
def mcnemar_arms(spark, sf_dir):
    gold = _banded(spark, sf_dir).where("gold is not null").select("file", "page_num", "line_num", "gold")
    return evaluate.mcnemar(_pairs(spark, sf_dir).join(gold, ["file", "page_num", "line_num"]), "gold", "base", "arm")


@query(_B + "select count(*) as n, avg(abs(quality_score - lang_score)) as mae, sqrt(avg((quality_score - lang_score) * (quality_score - lang_score))) as rmse, corr(quality_score, lang_score) as pearson, 1 - sum((quality_score - lang_score) * (quality_score - lang_score)) / (var_pop(quality_score) * count(*)) as r2 from b")
def score_regression(spark, sf_dir):
    return evaluate.regression_metrics(_banded(spark, sf_dir), "quality_score", "lang_score")


@query(_B + ", s as (select source as stratum, count(*) as population, count(*) filter (gold is not null) as n, count(*) filter (gold = categ) as k from b group by source), p as (select *, k / n::double as p from s) select stratum, population, n, k, round(p * population, 3) as estimate, round((p - 1.96 * sqrt(p * (1 - p) / n)) * population, 3) as low, round((p + 1.96 * sqrt(p * (1 - p) / n)) * population, 3) as high from p")
def stratum_estimates(spark, sf_dir):
    s_ = _banded(spark, sf_dir).groupBy(F.col("source").alias("stratum")).agg(F.count("*").alias("population"), F.count_if(F.col("gold").isNotNull()).alias("n"), F.count_if(F.col("gold") == F.col("categ")).alias("k"))
    return s_.withColumn("e", evaluate.scaled_estimate(F.col("k"), F.col("n"), F.col("population"))).select("stratum", "population", "n", "k", "e.*")


def _arm(spark, sf_dir):
    return _banded(spark, sf_dir).withColumns({"categ": F.expr("case when quality_score < 0.5 then 'Trash' when quality_score < 0.7 then 'Noisy' else categ end"), "quality_score": F.expr("round(quality_score * (1 + (cast(file as long) % 3) / 50D), 4)")})


_PAGES = _B + """, v as (select *, 'ref' as side from b union all select * replace (case when quality_score < 0.5 then 'Trash' when quality_score < 0.7 then 'Noisy' else categ end as categ, round(quality_score * (1 + (file::bigint % 3) / 50.0::double), 4) as quality_score), 'arm' from b),
q as (select side, file, page_num, count(*) filter (categ = 'Clear') as c, count(*) filter (categ = 'Noisy') as n, count(*) filter (categ = 'Trash') as t, avg(quality_score) filter (categ in ('Clear', 'Noisy')) as s from v group by all),
w as (select *, case when c + n + t = 0 then null when c >= n and c >= t then 'Clear' when n >= t then 'Noisy' else 'Trash' end as band from q),
x as (select r.file, r.page_num, r.band as band_ref, a.band as band_arm, r.s as score_ref, a.s as score_arm, a.c - r.c as d_clear, a.n - r.n as d_noisy, a.t - r.t as d_trash,
 case when r.s is null and a.s is null then null when r.s is null or a.s is null then 100 when abs(a.s - r.s) > 1e-12 then least(100, floor(abs(a.s - r.s) * 100 + 1e-9))::int end as moved
 from w r join w a on a.file = r.file and a.page_num = r.page_num where r.side = 'ref' and a.side = 'arm' and (r.c, r.n, r.t, r.s, r.band) is distinct from (a.c, a.n, a.t, a.s, a.band))
"""


@query(_PAGES + "select file, page_num, band_ref, band_arm, d_clear, d_noisy, d_trash, moved from x")
def page_changes(spark, sf_dir):
    return evaluate.page_changes(evaluate.page_profile(_banded(spark, sf_dir)), evaluate.page_profile(_arm(spark, sf_dir))).drop("score_ref", "score_arm")


@query(_PAGES + "select count(*) as pages_changed, count(*) filter (band_ref is distinct from band_arm) as band_flips, count(*) filter (moved >= 1) as moved_ge_1, count(*) filter (moved >= 5) as moved_ge_5 from x")
def page_change_summary(spark, sf_dir):
    return evaluate.page_change_summary(evaluate.page_changes(evaluate.page_profile(_banded(spark, sf_dir)), evaluate.page_profile(_arm(spark, sf_dir))))


@query(_B + ", h as (select floor(quality_score * 100 + 1e-9)::int as bin, count(*) as n from b group by 1), c as (select bin, sum(n) over (order by bin) as c, sum(n) over () as total from h), p as (select unnest([0.05, 0.25, 0.5, 0.75, 0.95])::double as point) select point, round((min(bin) + 0.5) / 100.0::double, 3) as value from c, p where c >= point * total group by point")
def score_quantiles(spark, sf_dir):
    return evaluate.binned_quantiles(_banded(spark, sf_dir), "quality_score")


@query("select count(*) as labels, count(distinct l.doc_id) as keys, count(distinct d.doc_id) as matched, count(*) filter (d.doc_id is null) as unmatched from labels l left join (select distinct doc_id from documents) d on d.doc_id = l.doc_id")
def label_preflight(spark, sf_dir):
    return evaluate.preflight(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), ["doc_id"])


@query(_B + "select source, count(*) as n, count(*) filter (gold = categ) as agree, count(*) filter (gold = categ) / count(*)::double as share from b where gold is not null group by source")
def stratum_agreement(spark, sf_dir):
    return evaluate.stratum_agreement(_banded(spark, sf_dir), "source", "gold", "categ")


@query(_B + ", k as (select case when word_count >= 5 then '5+' else greatest(word_count, 1)::varchar end as bucket, categ from b) select bucket, count(*) as n, count(*) filter (categ = 'Clear') as clear, count(*) filter (categ = 'Noisy') as noisy, count(*) filter (categ = 'Trash') as trash from k group by bucket")
def bucket_counts(spark, sf_dir):
    b = _banded(spark, sf_dir).withColumn("bucket", evaluate.word_bucket(F.col("word_count")))
    return b.groupBy("bucket").agg(F.count("*").alias("n"), *(F.count_if(F.col("categ") == c).alias(c.lower()) for c in ("Clear", "Noisy", "Trash")))


_BEFORE, _AFTER = r"(?:^|[^\p{L}\p{N}_])", r"(?:$|[^\p{L}\p{N}_])"
_ONE = lambda x: f"(?:{'|'.join(x)})"
_SEG = r"(?:[IVXLCDM]{1,6}|[A-ZÁČĎÉĚÍŇÓŘŠŤŮÚÝŽ]{1,4}|[A-Za-z]|\d{1,3}[a-z]?)"
_CZ = "[A-ZÁČĎÉĚÍŇÓŘŠŤŮÚÝŽa-záčďéěíňóřšťúůýž]"
_C = _L + f"""
, c as (select file, page_num, line_num, array_to_string(regexp_extract_all(text, '[^{_WS}]+'), ' ') as t from l), d as (select *, lower(t) as low, {_n(r'\p{Nd}', 't')} as digits, string_split_regex(lower(t), '[^\\p{{L}}\\p{{N}}_]+') as words from c)
"""


@query(_C + f"""select {_KEYS},
 regexp_matches(low, '{_BEFORE}\\p{{Nd}}+(?:[.,]\\p{{Nd}}+)?(?:\\s*{_ONE(UNITS)}|m){_AFTER}')
 or (digits > 0 and (len(list_intersect(words, {list(MEASURED)})) > 0 or regexp_matches(low, '{_BEFORE}rozm\\.')
     or len(list_filter(words, lambda w: w in ('dna', 'hrdla', 'okraje'))) + len(regexp_extract_all(low, '{_BEFORE}(?:pr|hl)\\.')) >= 2))
 or (digits > 1 and regexp_matches(low, '{_BEFORE}{_ONE(DIMENSIONS)}\\.?\\s*[:=-]\\s*\\p{{Nd}}')) as measurement,
 (regexp_matches(t, '{_BEFORE}\\p{{Nd}}{{1,2}}\\s*[./-]\\s*\\p{{Nd}}{{1,2}}(?:\\s*[./-]\\s*\\p{{Nd}}{{2,4}})?{_AFTER}') and regexp_matches(t, '{_BEFORE}(?:18|19|20)\\p{{Nd}}{{2}}{_AFTER}'))
 or (digits > 0 and (len(list_intersect(words, ['datum', 'date', 'podpis', 'sign', 'spis', 'číslo', 'cislo', 'ref'])) > 0 or regexp_matches(low, '{_BEFORE}č\\.?\\s*j{_AFTER}'))) as dated,
 regexp_matches(t, '{CONTENTS_ENTRY}') as contents,
 lower(rtrim(t, ' :;.-–—')) in {HEADINGS} as heading,
 (regexp_matches(t, '^{_SEG}(?:[/-]{_SEG}){{1,4}}$') and regexp_matches(t, '[A-ZÁČĎÉĚÍŇÓŘŠŤŮÚÝŽ0-9]')) or regexp_matches(t, '(?i){PIECE_COUNT}')
 or (regexp_matches(t, '^{_CZ}{{3,20}}\\s*:\\s*{_SEG}(?:[/-]{_SEG}){{0,4}}$') and list_contains(list_transform({list(LABELS)}, lambda x: strip_accents(x)), strip_accents(lower(trim(string_split(t, ':')[1])))))
 or regexp_matches(t, '{ABBREVIATION_CHAIN}|{WORD_AND_CHAIN}') or regexp_matches(t, '(?i)https?://\\S+|www\\.[\\w-]+\\.\\w{{2,4}}\\S*|\\be-?mail\\b\\s*:|[\\w.+-]+@[\\w-]+\\.[\\w.-]+') as notation
from d""")
def line_kinds(spark, sf_dir):
    rows = _lines(spark, sf_dir).select("file", "page_num", "line_num", F.expr(f"array_join({s.words('text')}, ' ')").alias("t"))
    kinds = {"measurement": s.measurement, "dated": s.dated, "contents": s.contents_entry, "heading": s.heading, "notation": s.notation}
    return rows.select("file", "page_num", "line_num", *(F.expr(f("t")).alias(k) for k, f in kinds.items()))


@query(rf"""with p as (select distinct trim(x, '.,;:!?()[]"''/\') as c from (select unnest(string_split_regex(text, '(?:[{_WS}]|[,/;:()\[\]{{}}<>"„“”«»=_?!*#.–-])+')) as x from documents)), q as (select c, regexp_replace(c, '\P{{L}}', '', 'g') as a from p),
j as (select * from q where length(a) >= 4 and lower(c) not in {tuple(dict.fromkeys(NEUTRAL + SHORT_EXCEPTION + SHORT_VALID))} and not regexp_matches(a, '^[IVXLCDM]{{1,7}}$') and not (length(a) >= 5 and regexp_matches(a, '(?i)(?:{'|'.join(TAXON_ENDINGS)})$'))),
f as (select c, regexp_matches(c, '[{VOWELS}]{{3,}}') as v, length(a) <= 8 and len(list_filter(range(1, length(c) - 1), lambda i: lower(c[i]) = lower(c[i + 1]) and lower(c[i]) = lower(c[i + 2]) and regexp_matches(c[i], '\p{{L}}'))) > 0 as t,
 regexp_matches(c, '(?i)^[bcdfghjklmnpqrstvwxz]') and lower(c[1]) = lower(c[2]) as g, length(a) >= 7 and len(list_distinct(string_split(lower(a), ''))) <= length(a) * 0.5 as w from j)
select c as token, array_to_string(list_filter([case when v then 'vowel_run' end, case when t then 'triple' end, case when g then 'initial_geminate' end, case when w then 'low_variety' end], lambda x: x is not null), '|') as clauses from f where v or t or g or w""")
def token_shapes(spark, sf_dir):
    cut = _table(spark, sf_dir, "documents").select(F.explode_outer(F.expr(s.shape_cut("text"))).alias("p"))  # outer: else a filter cuts it a second time
    x = cut.where(s.shape_suspect("p")).select(F.expr(s.shape_piece("p")).alias("x")).where(s.shape_judged("x")).distinct()
    rows = x.select(F.col("x.c").alias("token"), F.expr(s.shape_faults("x", "''")).alias("f")).where("size(f) > 0")
    return rows.select("token", F.array_join("f", "|").alias("clauses"))


@query()
def shape_witness(spark, sf_dir):
    lexicon_ = lexicon.text_frequency(_table(spark, sf_dir, "documents"))
    return scoring.shape_witness(_lines(spark, sf_dir), lexicon_, min_df=3).withColumn("clauses", F.array_join("clauses", "|"))


_LAB = _B + """, v as (select *, case when quality_score < 0.5 then 'Trash' when quality_score < 0.7 then 'Noisy' else categ end as arm from b)
"""


def _labelled(spark, sf_dir):
    return _banded(spark, sf_dir).withColumns({"ref": F.col("categ"), "arm": F.expr("case when quality_score < 0.5 then 'Trash' when quality_score < 0.7 then 'Noisy' else categ end")})


@query(_LAB + """select source, count(*) as labelled, count(*) filter (arm = gold and categ <> gold) as fixed, count(*) filter (categ = gold and arm <> gold) as broken,
 coalesce(sum((categ = gold)::int - (arm = gold)::int) filter (gold = 'Clear'), 0)::bigint as clear_loss from v where gold is not null group by source""")
def line_results(spark, sf_dir):
    return change.line_results(_labelled(spark, sf_dir), "source")


_ERR = _LAB + """, u as (select *, 'ref' as side, categ as pred from v union all select *, 'arm', arm from v),
p as (select side, file, page_num, count(gold) as n, count(*) filter (gold = 'Clear') as gc, count(*) filter (gold = 'Noisy') as gn, count(*) filter (gold = 'Trash') as gt, count(*) filter (gold is not null and pred = 'Clear') as pc, count(*) filter (gold is not null and pred = 'Noisy') as pn, count(*) filter (gold is not null and pred = 'Trash') as pt from u group by all having count(gold) >= 3),
z as (select *, case when gc + gn + gt = 0 then null when gc >= gn and gc >= gt then 'Clear' when gn >= gt then 'Noisy' else 'Trash' end as gb, case when pc + pn + pt = 0 then null when pc >= pn and pc >= pt then 'Clear' when pn >= pt then 'Noisy' else 'Trash' end as pb from p),
e as (select side, count(*) as pages, count(gb) as band_pages, count(*) filter (gb = pb) as band_agree, sum(abs(pc - gc) / n::double) as clear_abs, sum(abs(pt - gt) / n::double) as trash_abs, sum((pc - gc) / n::double) as clear_signed from z group by side)
"""


def _page_errors(spark, sf_dir):
    rows = _labelled(spark, sf_dir)
    both = rows.withColumns({"side": F.lit("ref"), "pred": F.col("ref")}).unionByName(rows.withColumns({"side": F.lit("arm"), "pred": F.col("arm")}))
    return change.page_errors(both, "side", pred="pred")


@query(_ERR + "select side, pages, band_pages, band_agree, round(clear_abs, 6) as clear_abs, round(trash_abs, 6) as trash_abs, round(clear_signed, 6) as clear_signed from e")
def page_errors(spark, sf_dir):
    return _page_errors(spark, sf_dir).select("side", "pages", "band_pages", "band_agree", *(F.round(c, 6).alias(c) for c in ("clear_abs", "trash_abs", "clear_signed")))


@query()
def page_check(spark, sf_dir):
    rows = _labelled(spark, sf_dir)
    profile = lambda c: evaluate.page_profile(rows.withColumn("categ", F.col(c)))
    total = rows.select("file", "page_num").distinct().agg(F.count("*").alias("pages"))
    moved = evaluate.page_change_summary(evaluate.page_changes(profile("ref"), profile("arm"))).select("band_flips", F.col("moved_ge_5").alias("moved"))
    moves = total.join(moved, F.lit(True)).select(F.lit("arm").alias("arm"), "pages", "band_flips", "moved")  # one row each
    found = change.page_check(change.line_results(rows, "source").withColumn("arm", F.lit("arm")), _page_errors(spark, sf_dir).withColumnRenamed("side", "arm"), moves, "ref")
    return found.withColumn("reasons", F.array_join("reasons", "; "))


@query(_PAGES.replace("\n", " ", 1) + ", g as (select unnest(['clear_ratio', 'noisy_ratio', 'trash_ratio', 'non-text_ratio', 'empty_ratio']) as \"column\"), k as (select file, page_num, count(*) as n, count(*) filter (categ = 'Empty') as e from b group by all) select \"column\", 0 as outside, 0 as wrong, (select count(*) from k where n = e and \"column\" <> 'empty_ratio') as missing from g")
def ratio_violations(spark, sf_dir):
    return change.ratio_violations(aggregate.page_stats(_banded(spark, sf_dir)))


@query(_B + ", o as (select 'x' || file as file, line_num % 3 = 0 as odd, page_num, line_num + case when line_num % 3 = 0 then 1000 else 0 end as line_num from b where line_num % 2 = 0) select substr(file, 2) as file, page_num, line_num from o where odd")
def key_problems(spark, sf_dir):
    rows = _banded(spark, sf_dir)
    return record.key_problems(rows.where("line_num % 2 = 0").select("file", "page_num", F.expr("line_num + if(line_num % 3 = 0, 1000, 0)").alias("line_num")), rows)


@query(_B + ", n as (select file, max(page_num) + 1 as c from b group by file), p as (select file, unnest(range(1, c + 1))::int as page_num from n), k as (select file, page_num, count(*) as n from b group by all) select p.file, p.page_num, case when k.n > 0 then 'text' else 'empty' end as content_status, coalesce(k.n, 0) as n_lines from p left join k on k.file = p.file and k.page_num = p.page_num")
def page_rows(spark, sf_dir):
    rows = _banded(spark, sf_dir)
    return record.page_rows(rows.groupBy("file").agg((F.max("page_num") + 1).alias("page_count")), rows)


@query(_L + "select file, page_num, string_agg(text, chr(10) order by line_num) as content from l group by all")
def page_texts(spark, sf_dir):
    return record.page_texts(_lines(spark, sf_dir))


@query(_B + """, x as (select file, page_num, line_num, least(1.0::double, char_count / 200.0::double) as valid, least(1.5::double, word_count / 20.0::double) as weird, (char_count % 10) / 10.0::double as vowel, (word_count % 8) / 10.0::double as density, perplex, lang_score, char_count from b)
select file, page_num, line_num, round(least(1, greatest(0, (0.35 * valid + 0.18 * (1 - least(weird, 1)) + 0.08 * (1 - least(perplex / 1000, 1)) + 0.02 * least(char_count / 100.0::double, 1)
 + (0.18::double * (1 - least(density / 0.35::double, 1)) * case when char_count <= 12 and weird = 0 and density < 0.35 then 0.5::double else 1 end + case when char_count <= 12 and weird = 0 and density < 0.35 then 0.09::double else 0 end)
 + 0.07::double * case when vowel < 0.2::double then vowel / 0.2::double when vowel > 0.7::double then greatest(0, 1 - (vowel - 0.7::double) / 0.3::double) else 1 end + 0.05::double * lang_score + 0.04::double * (1 - 0.25::double) + 0.03::double * (1 - 0.5::double)) / 1.0::double
 - case when char_count <= 12 and (weird > 0 or density >= 0.35::double) then 0.2::double else 0 end)), 6) as score from x""")
def composite_quality(spark, sf_dir):
    x = _banded(spark, sf_dir).selectExpr("file", "page_num", "line_num", "least(1D, char_count / 200D) as valid", "least(1.5D, word_count / 20D) as weird", "(char_count % 10) / 10D as vowel", "(word_count % 8) / 10D as density", "perplex", "lang_score", "char_count")
    score = s.quality_score("valid", "perplex", "char_count", "weird", "vowel", "density", "lang_score", "0.25D", "0.5D")
    return x.select("file", "page_num", "line_num", F.round(F.expr(score), 6).alias("score"))


def _scored(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", F.expr("case lang when 'en' then 'eng_Latn' when 'de' then 'deu_Latn' when 'fr' then 'fra_Latn' else 'spa_Latn' end").alias("lang"), F.lit(0.9).alias("lang_score"), F.expr("50D + n_chars % 300").alias("perplex"))
    return ln.explode_lines(docs)


@query()
def category_cascade(spark, sf_dir):
    return scoring.process(_scored(spark, sf_dir)).select("file", "page_num", "line_num", "categ", "reason", "rule", "quality_score")


@query()
def arm_reach(spark, sf_dir):
    arms = change.reach(_scored(spark, sf_dir), {"base": scoring.DEFAULT, "strict": scoring.DEFAULT.but(trash_max=0.65), "floor": scoring.DEFAULT.but(witness_floor=True)})
    return arms.groupBy("arm", "categ").agg(F.count("*").alias("n"))


@query()
def deciding_rules(spark, sf_dir):
    return scoring.process(_scored(spark, sf_dir)).groupBy("rule", "categ").agg(F.count("*").alias("n"))


@query()
def html_text(spark, sf_dir):
    from folioscope.sources.formats import read_column

    return read_column(_table(spark, sf_dir, "pages"), "page_id", "html", "html")


def _all() -> None:
    from folioscope import queries_changes  # noqa: F401  it registers its own here


def queries() -> dict:
    _all()
    return dict(_Q)


def oracle_sql() -> dict:
    _all()
    return dict(_SQL)

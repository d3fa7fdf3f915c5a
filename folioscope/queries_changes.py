"""Registered queries on rules, layouts, packs and manifests, with their SQL; ``folioscope.queries`` adds them to its own."""

from __future__ import annotations

from pyspark.sql import functions as F

from folioscope.operators import bundle, concordance as concordance_, damage, evaluate, importance, layout_stats, lexicon, packs, page_merge as page_merge_, quality_model, recover, rule_effects as effects_, scoring, sketches
from folioscope.operators.ordered import checkpointed, shared_dir
from folioscope.plans import manifest, versions
from folioscope.queries import _B, _HASH, _KEYS, _L, _P, _banded, _lines, _pairs, _scored, _table, query

#: An ordered list of rules over the banded lines, whose conditions read alike in both dialects.
_RULES = [
    effects_.Entry(("empty",), "word_count = 0", "Empty"),
    effects_.Entry(("rule_rare",), "perplex >= 900 and lang_score < 0.5", "Trash"),
    effects_.Entry(("rule_short", "rule_small"), "word_count <= 2 and char_count < 6", "Noisy"),
    effects_.Entry(("rule_short",), "word_count <= 2 and char_count < 12", "Trash"),
    effects_.Entry(("rule_symbols",), "quality_score < 0.4", "Trash"),
    effects_.Entry(("rule_easy",), "perplex < 120 and word_count >= 3", "Clear"),
    effects_.Entry(("rule_never",), "char_count < 0", "Trash"),
    effects_.Entry(("rule_long",), "char_count > 60 and perplex < 120 and word_count >= 3", "Clear"),
    effects_.Entry(("rule_dull",), "lang_score < 0.25 and word_count >= 3", "Noisy"),
    effects_.Entry(("rule_low",), "quality_score < 0.6", "Noisy"),
    effects_.Entry(("rule_same",), "quality_score >= 0.95", "Clear"),
    effects_.Entry(("default",), "true", "Clear"),
]


def _case(*disabled: str, what: str = "categ") -> str:
    """The list as a CASE without the entries of the disabled rules: category, or the deciding entry's owners."""
    left = [e for e in _RULES if not set(e.owners) & set(disabled)]
    return "case " + " ".join(f"when {e.when} then '{e.categ if what == 'categ' else '+'.join(e.owners)}'" for e in left) + " end"


def _effects_sql() -> str:
    rules = effects_.names(_RULES)
    held = lambda r: " or ".join(f"({e.when})" for e in _RULES if r in e.owners)
    arms = " union all ".join(f"select '{r}' as rule, gold, {_case()} as base, {_case(r)} as pred, ({held(r)}) as held, list_contains(string_split({_case(what='owners')}, '+'), '{r}') as mine from b" for r in rules)
    return _B + f""", arms as ({arms}), whole as (select '' as rule, gold, {_case()} as pred from b),
c as (select rule, gold, pred, count(*) as n from (select rule, gold, pred from arms union all select rule, gold, pred from whole) where gold is not null group by all),
s as (select rule, label, sum(support) as support, sum(predicted) as predicted, sum(hits) as hits from (
  select rule, gold as label, n as support, 0 as predicted, case when gold = pred then n else 0 end as hits from c union all select rule, pred, 0, n, 0 from c) group by all),
f as (select rule, avg(coalesce(2 * hits / nullif(support + predicted, 0)::double, 0)) as f1 from s group by rule),
lo as (select rule, sum(n) filter (gold = 'Clear' and pred in ('Trash', 'Non-text')) as lost from c group by rule),
a as (select rule, count(*) filter (held) as holds, count(*) filter (mine) as fires, count(*) filter (base is distinct from pred) as decisive, count(*) filter (base = 'Clear' and pred in ('Trash', 'Non-text')) as clear_loss, count(gold) as gold_n from arms group by rule)
select a.*, case when fires = 0 then case when rule = 'rule_small' then 'INERT' else 'DEAD' end when decisive = 0 then 'REDUNDANT-HERE' else 'LOAD-BEARING' end as class,
 round(f1 - (select f1 from f where rule = ''), 9) + 0.0 as gold_macro_f1_delta, coalesce(lost, 0)::bigint as gold_clear_loss, (select coalesce(lost, 0)::bigint from lo where rule = '') as gold_clear_loss_base
from a left join f using (rule) left join lo using (rule)"""


@query(_effects_sql())
def rule_effects(spark, sf_dir):
    return effects_.effects(effects_.masks(_banded(spark, sf_dir), _RULES, "gold"), _RULES, gated=("rule_small",))


def _greedy_sql() -> str:
    """Every step by its own tables: arms x, their confusions p, label sums s, macro-F1 f, losses q, candidates k, and the state g."""
    mask = " + ".join(f"case when {e.when} then {1 << i} else 0 end" for i, e in enumerate(_RULES))
    rules = effects_.names(_RULES)
    values = ", ".join(f"('{r}', {effects_.bits(_RULES, r)}, {1 << i})" for i, r in enumerate(rules))
    steps = [f"t as materialized (select mask, gold, count(*)::bigint as n from (select ({mask})::bigint as mask, gold from b where gold is not null) group by all)", f"r as (select * from (values {values}) as r(rule, bits, id))", "g0 as (select 0::bigint as off, 0::bigint as gone, false as stopped)"]
    for k in range(len(rules)):
        steps += [
            f"x{k} as (select '' as rule, off from g{k} where not stopped union all select r.rule, g.off | r.bits from g{k} g, r where not g.stopped and g.gone & r.id = 0)",
            f"p{k} as materialized (select rule, gold, list_extract({[e.categ for e in _RULES]}, log2(((mask & ~off) & -(mask & ~off))::double)::int + 1) as pred, sum(n) as n from x{k}, t group by all)",
            f"s{k} as (select rule, label, sum(s) as s, sum(p) as p, sum(h) as h from (select rule, gold as label, n as s, 0 as p, case when gold = pred then n else 0 end as h from p{k} union all select rule, pred, 0, n, 0 from p{k}) group by all)",
            f"f{k} as (select rule, avg(coalesce(2 * h / nullif(s + p, 0)::double, 0)) as f1 from s{k} group by rule)",
            f"q{k} as (select rule, coalesce(sum(n) filter (gold <> pred), 0) as flips, coalesce(sum(n) filter (gold = 'Clear' and pred in ('Trash', 'Non-text')), 0) as lost from p{k} group by rule)",
            f"k{k} as materialized (select q.rule, q.flips::bigint as flips, greatest(0, q.lost - z.lost)::bigint as clear_loss, round(y.f1 - f.f1, 9) + 0.0 as macro_drop from q{k} q join f{k} f using (rule), q{k} z, f{k} y where q.rule <> '' and z.rule = '' and y.rule = '')",
            f"g{k + 1} as materialized (select g.off | r.bits as off, g.gone | r.id as gone, {k + 1} as step, c.*, c.clear_loss > 0 or c.macro_drop > 1e-9 as stopped from (select * from k{k} order by clear_loss, macro_drop, flips, rule limit 1) c join r on r.rule = c.rule, g{k} g)",
        ]
    out = " union all ".join([f"select step, rule, flips, clear_loss, macro_drop from g{k + 1} where not stopped union all select null, k{k}.* from k{k}, g{k + 1} where stopped" for k in range(len(rules))])
    return _B + ", " + ",\n".join(steps) + "\n" + out


@query(_greedy_sql())
def greedy_rules(spark, sf_dir):
    return effects_.eliminate(effects_.masks(_banded(spark, sf_dir), _RULES, "gold"), _RULES)


@query()
def cascade_effects(spark, sf_dir):
    """The rules of the cascade over all lines, against what the lines' labels would be by a threshold of the score."""
    rows = scoring.with_score(scoring.with_signals(scoring.prefilter(_scored(spark, sf_dir).repartition("file", "page_num"))))
    rows = rows.withColumn("gold", F.expr("case when raw_score < 0.5 then 'Trash' when raw_score < 0.8 then 'Noisy' else 'Clear' end"))
    entries = effects_.cascade()
    return effects_.effects(effects_.masks(rows, entries, "gold"), entries)


#: Two layouts of the documents: blocks of eight lines with boxes; a text layer in blocks of five lines, some of them shifted,
#: some without boxes, one block of a page and the pages that need recognition without any.
_Y = "line_num * 10"


def _layouts(spark, sf_dir):
    rows = _lines(spark, sf_dir).select("file", "page_num", "line_num", "text", F.expr("cast(file as long)").alias("f"))
    box = lambda a, b, c, d: F.array(*(F.expr(x).cast("double") for x in (a, b, c, d)))
    own = rows.select("file", "page_num", "line_num", F.expr("concat('b', floor((line_num - 1) / 8))").alias("block"), "text", box("0", _Y, "100", f"{_Y} + 9").alias("bbox"))
    blocks = own.groupBy("file", "page_num", "block").agg(F.floor((F.min("line_num") - 1) / 8).cast("int").alias("ord"), F.array(F.lit(0.0), F.min(F.col("bbox")[1]), F.lit(100.0), F.max(F.col("bbox")[3])).alias("bbox"))
    shift = "((f + line_num) % 7 - 3) * 3"
    layer = rows.where("not line_num between 25 and 32 and line_num % 9 <> 0 and (f + page_num) % 4 <> 0")
    boxed = "(f + line_num) % 5 <> 0 and floor((line_num - 1) / 5) % 3 <> 1"
    layer = layer.select("file", "page_num", "line_num", F.expr("concat('p', floor((line_num - 1) / 5))").alias("block"), "text", F.when(F.expr(boxed), box("5", f"{_Y} + {shift}", "95", f"{_Y} + 8 + {shift}")).alias("bbox"))
    pages = rows.select("file", "page_num", F.expr("(f + page_num) % 4 = 0").alias("needs_atr")).distinct()
    return pages, layer, blocks, own


_LAYOUTS = _L + """, r as (select *, file::bigint as f from l),
own as (select file, page_num, line_num, 'b' || ((line_num - 1) // 8) as block, text from r),
blocks as (select file, page_num, block, min((line_num - 1) // 8) as ord, min(line_num * 10)::double as y0, max(line_num * 10 + 9)::double as y1 from own group by all),
layer as (select file, page_num, line_num, 'p' || ((line_num - 1) // 5) as block, text, (f + line_num) % 5 <> 0 and ((line_num - 1) // 5) % 3 <> 1 as boxed,
  (line_num * 10 + ((f + line_num) % 7 - 3) * 3)::double as t from r where not line_num between 25 and 32 and line_num % 9 <> 0 and (f + page_num) % 4 <> 0),
pair as (select y.file, y.page_num, y.line_num, b.block, ord, greatest(0, least(t + 8, y1) - greatest(t, y0)) / 8 as cover, (y1 - y0) * 100 as area, greatest(0, y0 - t - 8, t - y1) as far from layer y join blocks b using (file, page_num) where boxed),
link as (select file, page_num, line_num, arg_min(block, (case when cover > 0 then 0 else 1 end, case when cover > 0 then -round(cover, 6) else far end, area, ord)) as dest from pair group by all),
x as (select y.*, dest from layer y left join link using (file, page_num, line_num)),
vote as (select file, page_num, block, arg_min(dest, (-n, ord)) as most from (select x.file, x.page_num, x.block, dest, count(*) as n, min(ord) as ord from x join blocks b on b.file = x.file and b.page_num = x.page_num and b.block = dest group by all) group by all),
k as (select x.*, coalesce(dest, most) as known from x left join vote using (file, page_num, block)),
w as (select *, coalesce(last_value(known ignore nulls) over (partition by file, page_num order by line_num), first_value(known ignore nulls) over (partition by file, page_num order by line_num rows between current row and unbounded following), 'b0') as into_ from k),
kept as (select distinct file, page_num from layer),
out as (select w.file, w.page_num, ord, w.into_ as block, line_num as n, text, 'text-layer' as text_source from w join blocks b on b.file = w.file and b.page_num = w.page_num and b.block = into_
  union all select own.file, own.page_num, case when kept.file is not null then ord end, own.block, line_num, text, 'atr' from own left join kept using (file, page_num) join blocks b using (file, page_num, block)
    where kept.file is null or not exists (select 1 from w where w.file = own.file and w.page_num = own.page_num and w.into_ = own.block))
"""


@query(_LAYOUTS + "select file, page_num, row_number() over (partition by file, page_num order by ord, n)::int as line_num, block, text, text_source from out")
def page_merge(spark, sf_dir):
    return page_merge_.merged(*_layouts(spark, sf_dir)).drop("bbox")


#: The documents as files of two listings: some new, gone, rewritten alike, rewritten longer.
_LISTINGS = """with old as (select 'd' || doc_id as path, make_timestamp(2024, 1, 1, 0, (doc_id % 60)::int, 0.0) as modified, n_chars as size from documents where doc_id % 7 <> 0),
new as (select 'd' || doc_id as path, make_timestamp(2024, 1, 1, case when doc_id % 5 in (0, 1) then 1 else 0 end, (doc_id % 60)::int, 0.0) as modified, n_chars + case when doc_id % 5 = 0 then 1 else 0 end as size from documents where doc_id % 11 <> 0)
"""


@query(_LISTINGS + """select coalesce(o.path, n.path) as path, case when o.path is null then 'new' when n.path is null then 'gone' when o.modified = n.modified and o.size = n.size then 'same' when o.size = n.size then 'unsure' else 'changed' end as state,
 coalesce(n.size, o.size) as size from old o full join new n on o.path = n.path""")
def manifest_diff(spark, sf_dir):
    at = lambda hour: F.expr(f"make_timestamp(2024, 1, 1, {hour}, cast(doc_id % 60 as int), 0)")
    d = _table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("d"), "doc_id").alias("path"), "n_chars")
    old = d.where("doc_id % 7 <> 0").select("path", at("0").alias("modified"), F.col("n_chars").alias("size"), F.lit("").alias("digest"))
    new = d.where("doc_id % 11 <> 0").select("path", at("if(doc_id % 5 in (0, 1), 1, 0)").alias("modified"), F.expr("n_chars + if(doc_id % 5 = 0, 1, 0)").alias("size"))
    return manifest.differences(old, new).select("path", "state", "size")


@query(_B + ", d as (select file, page_num, line_num, categ from b where (file::bigint + line_num) % 3 <> 0 or line_num % 10 = 1) select file, page_num, line_num, categ from b where not exists (select 1 from d where d.file = b.file and d.page_num = b.page_num and d.line_num = b.line_num and d.categ = b.categ)")
def undecided_lines(spark, sf_dir):
    b = _banded(spark, sf_dir)
    return manifest.undecided(b, b.where("(cast(file as long) + line_num) % 3 <> 0 or line_num % 10 = 1"), "categ").select("file", "page_num", "line_num", "categ")


@query("select doc_id, lang, case when doc_id % 9 = 0 then upper(source) else source end as source, 2 as version from documents where doc_id % 13 <> 0")
def published_documents(spark, sf_dir):
    """All documents published, then again with some changed and some gone; read back from the last version."""
    import uuid

    target = f"{shared_dir(spark)}/published-{uuid.uuid4().hex}"
    d = _table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    versions.publish(spark, target, {"documents": versions.Write(d, ["doc_id"])}, buckets=16)
    again = d.where("doc_id % 13 <> 0").withColumn("source", F.expr("if(doc_id % 9 = 0, upper(source), source)"))
    last = versions.publish(spark, target, {"documents": versions.Write(again, ["doc_id"])})
    return last.table(spark, "documents").withColumn("version", F.lit(last.number))


_CHANGES = _P + r""", ch as (select p.file || ':' || p.page_num || ':' || p.line_num as id, source as collection, p.file as doc, p.file::bigint as f, p.line_num, text, base, arm, regexp_replace(lower(text), '[^\p{L}\p{N}_]', '', 'g') as key from p join b using (file, page_num, line_num) where base <> arm),
gs as (select key, count(*) as occurrences, count(distinct (collection, doc)) as documents, min(id) as example from ch group by key order by occurrences desc, key limit 50)
"""


def _changes(spark, sf_dir):
    """Made once and kept, as all that is asked of changes reads them several times; few of the lines, so they are dealt into fewer parts."""
    rows = _pairs(spark, sf_dir, "source").where("base <> arm")
    rows = rows.select(F.concat_ws(":", "file", "page_num", "line_num").alias("id"), F.col("source").alias("collection"), F.col("file").alias("doc"), "text", F.col("base").alias("from"), F.col("arm").alias("to"), F.col("file").cast("long").alias("f"), "line_num")
    return checkpointed(rows.hint("rebalance"))


@query(_CHANGES + """, t as (select key, text, count(*) as n from ch where key in (select key from gs) group by all),
v as (select key, list(text order by n desc, text) as v from t group by key),
m as (select key, string_agg(move || ' ' || n, '; ' order by n desc, move) as transitions from (select key, base || '->' || arm as move, count(*) as n from ch where key in (select key from gs) group by all) group by key)
select row_number() over w as rank, gs.key, occurrences, round(sum(occurrences) over w / (select count(*) from ch)::double, 3) as cumulative_share, v[1] as text, len(v) as variants, array_to_string(v[2:4], ' | ') as other_variants, documents, example, transitions
from gs join v using (key) join m using (key) window w as (order by occurrences desc, gs.key)""")
def pack_top(spark, sf_dir):
    return packs.top_groups(_changes(spark, sf_dir), 50)


@query(_CHANGES + ", x as (select ch.*, " + _HASH.format(seed=7, key="id") + """ as h, count(*) over (partition by key) as group_occurrences, count(*) over () as n from ch where key not in (select key from gs)),
s as (select * from x order by h, id limit 200) select row_number() over (order by h, id) as position, id, text, base as "from", arm as "to", group_occurrences, least(1.0::double, 200 / n::double) as inclusion from s""")
def pack_tail(spark, sf_dir):
    rows = _changes(spark, sf_dir)
    return packs.tail_sample(rows, packs.top_groups(rows, 50), 200, seed=7)


_LABELLED = _CHANGES + """, ref as (select * from ch where f % 3 <> 0),
top as (select key, case length(key) % 4 when 1 then 'Clear' when 2 then 'Noisy' when 3 then 'Trash' end as label from (select key, count(*) as n from ref group by key having count(*) > 1 or length(key) < 6)),
tl as (select id, case length(text) % 3 when 0 then 'Clear' when 1 then 'Noisy' else 'Trash' end as label from ref where (f + line_num) % 3 = 0),
la as (select ch.id, ch.key, ch.base, ch.arm, case when top.label is not null then 'top' when top.key is not null then 'excluded' when ref.id is not null then 'tail' else 'new' end as bucket, coalesce(top.label, case when top.key is null and ref.id is not null then tl.label end) as label
  from ch left join top on top.key = ch.key left join ref on ref.id = ch.id and ref.key not in (select key from top) left join tl on tl.id = ch.id)
"""


def _labelled_changes(spark, sf_dir):
    rows = _changes(spark, sf_dir)
    reference = rows.where("f % 3 <> 0")
    keyed = reference.withColumn("key", packs.family_key("text"))
    top = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1 or length(key) < 6").select("key", F.expr("case length(key) % 4 when 1 then 'Clear' when 2 then 'Noisy' when 3 then ' Trash ' else ' ' end").alias("label"))
    tail = reference.where("(f + line_num) % 3 = 0").select("id", F.expr("case length(text) % 3 when 0 then 'Clear' when 1 then 'Noisy' else 'Trash' end").alias("label"))
    return packs.labelled(rows.drop("f", "line_num"), reference.drop("f", "line_num"), top, tail)


@query(_LABELLED + 'select id, key, base as "from", arm as "to", bucket, label from la')
def change_labels(spark, sf_dir):
    return _labelled_changes(spark, sf_dir).drop("collection", "doc", "text")


@query(_LABELLED + """, k as (select map {'Trash': 0, 'Noisy': 1, 'Clear': 2} as k), d as (select la.*, abs(k[base] - k[label]) as was, abs(k[arm] - k[label]) as now from la, k),
x as (select *, unnest(['fixed', 'broken', 'neither', 'closer', 'farther', 'clear_loss', 'clear_demoted']) as measure from d),
y as (select *, label is not null and case measure when 'fixed' then label = arm and label <> base when 'broken' then label = base and label <> arm when 'neither' then label <> arm and label <> base when 'closer' then now < was when 'farther' then now > was
  when 'clear_loss' then label = 'Clear' and arm in ('Trash', 'Non-text') and base not in ('Trash', 'Non-text') else label = 'Clear' and base = 'Clear' and arm <> 'Clear' end as hit from x),
s as (select measure, count(*) filter (bucket = 'top' and hit) as top, count(*) filter (bucket = 'tail' and hit) as tail, count(*) filter (bucket = 'tail' and label is not null) as sampled, count(*) filter (bucket = 'tail') as population, count(*) filter (bucket = 'top') as top_lines from y group by measure),
e as (select *, tail / nullif(sampled, 0)::double as p from s), h as (select *, 1.96 * sqrt(p * (1 - p) / sampled) as half, top + coalesce(p * population, 0) as t from e)
select measure, top, tail, sampled, population, round(p * population, 3) as estimate, round((p - half) * population, 3) as low, round((p + half) * population, 3) as high, round(t, 3) as total, round(t / (top_lines + population)::double, 4) as share from h""")
def pack_estimates(spark, sf_dir):
    return packs.estimates(_labelled_changes(spark, sf_dir))


_SEVERE = _B + """, x as (select file, page_num, (line_num * 7 + char_count) % 4 as severity, round(quality_score - ((line_num * 7 + char_count) % 4) * 0.05::double, 2) as score from b)
"""


def _severe(spark, sf_dir):
    """Scores are rounded in binary, as the SQL does: places of a decimal tie are those of the product, not of its shortest decimal."""
    return _banded(spark, sf_dir).selectExpr("file", "page_num", "(line_num * 7 + char_count) % 4 as severity", "round((quality_score - ((line_num * 7 + char_count) % 4) * 0.05D) * 100D, 0) / 100D as score")


@query(_SEVERE + ", p as (select file, count(*) filter (a.severity < b.severity) as pairs, count(*) filter (a.severity < b.severity and a.score >= b.score - 1e-9) as concordant from x a join x b using (file) group by file) select * from p")
def concordance(spark, sf_dir):
    return concordance_.concordance(_severe(spark, sf_dir), ["file"], "severity", "score", [0, 1, 2, 3])


@query(_SEVERE + ", p as (select count(*) as pairs, count(*) filter (a.score >= b.score - 1e-9) as concordant from x a join x b using (file, page_num) where a.severity < b.severity) select *, round(concordant / pairs::double, 4) as accuracy from p")
def monotonicity(spark, sf_dir):
    return concordance_.monotonicity(concordance_.concordance(_severe(spark, sf_dir), ["file", "page_num"], "severity", "score", [0, 1, 2, 3]))


_BOXES = _L + """, x as (select *, line_num * 12 + case when line_num % 7 = 0 then 25 else 0 end - case when line_num > 20 then 260 else 0 end + (file::bigint % 3) as top, 8 + (length(text) % 5) as h from l where line_num % 11 <> 5),
m as (select file, page_num, coalesce(median(h) filter (h > 5), median(h))::double as m from x group by all),
g as (select x.*, m, top - lag(top + h) over (partition by file, page_num order by line_num) as gap from x join m using (file, page_num)),
p as (select *, 1 + sum(coalesce((gap < -m or gap > 1.5 * m)::int, 0)) over (partition by file, page_num order by line_num) as paragraph from g)
"""


def _boxes(spark, sf_dir):
    rows = _lines(spark, sf_dir).where("line_num % 11 <> 5").withColumns({"t": F.expr("cast(line_num * 12 + if(line_num % 7 = 0, 25, 0) - if(line_num > 20, 260, 0) + cast(file as long) % 3 as double)"), "h": F.expr("8 + length(text) % 5")})
    return rows.select("file", "page_num", "line_num", "text", F.array(F.lit(0.0), "t", F.lit(100.0), F.col("t") + F.col("h")).alias("bbox"))


@query(_BOXES + "select file, page_num, line_num, gap::double as gap, paragraph::bigint as paragraph from p")
def paragraph_gaps(spark, sf_dir):
    return layout_stats.paragraph_breaks(_boxes(spark, sf_dir)).select("file", "page_num", "line_num", "gap", "paragraph")


@query(_BOXES + "select file, page_num, paragraph::bigint as paragraph, string_agg(text, chr(10) order by line_num) as text from p group by all")
def paragraph_texts(spark, sf_dir):
    return layout_stats.paragraph_texts(_boxes(spark, sf_dir))


@query(_L + "select file, page_num, line_num, [greatest(0, least(1000, round_even(10 * (line_num - 3) * (1000.0::double / 595), 0)))::int, greatest(0, least(1000, round_even((length(text) + 0.5::double) * (1000.0::double / 842), 0)))::int, 1000, 1000]::varchar as box from l")
def scaled_boxes(spark, sf_dir):
    box = F.array(F.expr("cast(10 * (line_num - 3) as double)"), F.expr("length(text) + 0.5D"), F.lit(600.0), F.lit(2000.0))
    return _lines(spark, sf_dir).select("file", "page_num", "line_num", layout_stats.scaled_box(box, F.lit(595.0), F.lit(842.0)).cast("string").alias("box"))


@query(r"""with t as (select page_id, unnest(regexp_extract_all(regexp_replace(html, '(?is)<!--.*?-->|<!\[CDATA\[.*?\]\]>|<script\b.*?</script\s*>|<style\b.*?</style\s*>', '', 'g'), '<(?:[A-Za-z_][\w.-]*:)?([A-Za-z_][\w.-]*)', 1)) as element from pages)
select page_id, lower(element) as element, count(*) as n from t group by all""")
def element_counts(spark, sf_dir):
    return layout_stats.element_counts(_table(spark, sf_dir, "pages"), ["page_id"], "html")


@query("""with d as (select event_id, '{"user": ' || user_id || ', "props": [' || props || ', "' || event_type || '", null, true, {"deep": [[' || user_id || ', "x"]]}]}' as j from events),
n as (select event_id, fullkey, type, atom from d, json_tree(d.j) where type not in ('OBJECT', 'ARRAY'))
select event_id, replace(replace(replace(replace(fullkey, '$.', ''), '[', '.'), ']', ''), '"', '') as path, case type when 'VARCHAR' then 'string' when 'BOOLEAN' then 'boolean' when 'NULL' then 'null' else 'number' end as kind, case when type <> 'NULL' then atom->>'$' end as value from n""")
def json_leaves(spark, sf_dir):
    e = _table(spark, sf_dir, "events")
    j = F.concat(F.lit('{"user": '), "user_id", F.lit(', "props": ['), "props", F.lit(', "'), "event_type", F.lit('", null, true, {"deep": [['), "user_id", F.lit(', "x"]]}]}'))
    return layout_stats.json_leaves(e.select("event_id", j.alias("j")), ["event_id"], "j")


@query()  # estimates; tests hold them against exact figures
def sketch_summary(spark, sf_dir):
    pages = sketches.sketched(_banded(spark, sf_dir), ["source", "file", "page_num"], "text", "quality_score")
    return sketches.estimated(sketches.merged(sketches.merged(pages, ["source", "file"]), ["source"]))


_DAMAGE_KEY = "concat_ws('|', file, page_num, line_num)"


@query(_L + f"select {_KEYS}, {', '.join(f'{damage.damaged(n, chr(116) + chr(101) + chr(120) + chr(116), chr(101) + chr(112) + chr(115), _DAMAGE_KEY, damage.DUCK)} as {n}' for n in damage.OPERATORS)} from (select *, (line_num % 10) / 12.0::double as eps from l)")
def damage_operators(spark, sf_dir):
    rows = _lines(spark, sf_dir).withColumn("eps", F.expr("(line_num % 10) / 12D"))
    return rows.select("file", "page_num", "line_num", *damage.operator_columns("text", "eps", _DAMAGE_KEY))


@query()  # variants are tested by their operators, keys and bands
def damage_variants(spark, sf_dir):
    return damage.items(_banded(spark, sf_dir)).withColumn("ops", F.array_join("ops", "+"))


def _training(spark, sf_dir):
    lines = _banded(spark, sf_dir).withColumn("lang", F.expr("case lang when 'en' then 'eng_Latn' when 'de' then 'deu_Latn' when 'fr' then 'fra_Latn' else 'spa_Latn' end"))
    return quality_model.dataset(lines.select("file", "page_num", "line_num", "text", "categ", "word_count", "lang", "lang_score", "perplex"), each=1)


@query()  # a trained model: tests hold its splits and its error
def quality_predictions(spark, sf_dir):
    rows = _training(spark, sf_dir)
    model, names = quality_model.train(rows, iterations=10)
    return quality_model.predicted(model, names, rows.where("split <> 'train'")).select("file", "page_num", "line_num", "provenance", "number", "split", "raw_score", F.round("prediction", 6).alias("prediction"))


def _featured(spark, sf_dir):
    rows = scoring.with_score(scoring.with_signals(scoring.prefilter(_scored(spark, sf_dir).repartition("file", "page_num"))))
    return rows.withColumn("gold", F.expr("case when (cast(file as long) * 3 + line_num) % 7 = 0 then 'Trash' when raw_score < 0.6 then 'Noisy' when raw_score < 0.8 then 'Clear' end"))


@query()  # every line under every setting; tests hold single settings against scoring with them
def constant_trials(spark, sf_dir):
    found = importance.evaluated(_featured(spark, sf_dir), importance.sampled(16, seed=1))
    return found.select("trial", *(F.round(c, 6).alias(c) for c in importance.METRICS))


@query()  # ranks of forests over settings
def constant_importance(spark, sf_dir):
    return importance.constant_importance(spark, _featured(spark, sf_dir), n=32)


_RANKED = """with i as (select source as run, lang as constant, avg(n_chars) + count(*) / 7.0::double as importance from documents group by all),
r as (select *, row_number() over (partition by run order by importance desc, constant) as rank, (select count(distinct run) from i) as runs from i)
select constant, count(*) filter (rank <= 2) as appearances, count(*) filter (rank <= 2) >= greatest(2, any_value(runs) // 2) as robust, case when count(*) = any_value(runs) then round(avg(rank), 2) else 999.0 end::double as average_rank from r group by constant"""


@query(_RANKED)
def rank_consensus(spark, sf_dir):
    i = _table(spark, sf_dir, "documents").groupBy(F.col("source").alias("run"), F.col("lang").alias("constant")).agg((F.avg("n_chars") + F.count("*") / 7.0).alias("importance"))
    return importance.consensus(i, 2)


def _bundle_sql(by: str) -> str:
    """The metrics of the arm's categories against the labels, weighted, by a column or over all."""
    keep = f"{by} as g" if by else "0 as g"
    out = f"g as {by}, " if by else ""
    cost = "case when a = 'Clear' and b in ('Trash', 'Non-text') then 3 when a = 'Clear' and b = 'Noisy' then 1 when a = 'Noisy' and b in ('Trash', 'Non-text') then 2 when a = 'Noisy' and b = 'Clear' then 0.5 when a = 'Trash' and b = 'Clear' then 2 when a in ('Non-text', 'Empty') and b = 'Clear' then 2 else 1 end"
    rates = ", ".join(f"""sum(case when b = '{k}' then w else 0 end) / sum(w) as "{k.lower()}_rate\"""" for k in ("Clear", "Noisy", "Trash", "Non-text", "Empty"))
    return _B + f""", c as (select {keep}, gold as a, categ as b, count(*) as n, sum(1.0::double + line_num % 3) as w from b where gold is not null group by all),
p as (select g, sum(n)::bigint as line_count, sum(case when a <> b then n else 0 end)::bigint as flip_count, sum(case when a <> b then w else 0 end) / sum(w) as flip_rate, {rates}, sum(case when a <> b then w * {cost} else 0 end) / sum(w) as costed_score,
  sum(case when a = 'Clear' and b in ('Trash', 'Non-text') then n else 0 end)::bigint as gold_clear_loss from c group by g),
lb as (select g, label, sum(p) as p, sum(q) as q, sum(h) as h from (select g, a as label, w as p, 0 as q, case when a = b then w else 0 end as h from c union all select g, b, 0, w, 0 from c) group by all),
t as (select *, sum(p) over (partition by g) as t, 2 * h / (p + q) as f from lb),
s as (select g, avg(f) as macro_f1, sum(f * p) / any_value(t) as weighted_f1, sum((p / t + 1e-12) * ln((p / t + 1e-12) / (q / t + 1e-12))) as kl_divergence from t group by g)
select {out}p.* exclude (g), s.* exclude (g) from p join s using (g)"""


@query(_bundle_sql("source"))
def metric_bundle(spark, sf_dir):
    return bundle.metric_bundle(_banded(spark, sf_dir).withColumn("w", F.expr("1D + line_num % 3")), "source", pred="categ", weight="w")


@query(_bundle_sql(""))
def metric_bundle_all(spark, sf_dir):
    return bundle.metric_bundle(bundle.checked_weights(_banded(spark, sf_dir).withColumn("w", F.expr("1D + line_num % 3")), "w"), pred="categ", weight="w")


_CONFUSED = ", ".join(f"('{a}', '{b}')" for a, b in recover.CONFUSIONS)
_RECOVER = _B + rf""", k as (select file, page_num, line_num, categ, unnest(regexp_extract_all(lower(text), '\p{{L}}{{4,}}')) as token from b), k0 as (select distinct file, unnest(regexp_extract_all(lower(text), '\p{{L}}{{2,}}')) as token from b),
x as (select token, count(*) as df from k0 group by token), st as (select token as candidate, df from x where df >= 10), q as (select distinct token from k where token not in (select candidate from st)), pairs as (select * from (values {_CONFUSED}) as t(a, b)),
rd as (select token, token as k, 0 as i from q union all select token, token[1:i - 1] || token[i + 1:], i from q, unnest(range(1, length(token) + 1)) as u(i)),
cd as (select candidate, candidate as k, 0 as j from st union all select candidate, candidate[1:i - 1] || candidate[i + 1:], i from st, unnest(range(1, length(candidate) + 1)) as u(i)),
found as (select token, candidate, 0 as m from q join st on q.token = strip_accents(candidate)
 union all select token, candidate, 1 from (select token, token[1:i - 1] || b || token[i + length(a):] as c from q, pairs, unnest(range(1, length(token) + 1)) as u(i) where contains(token, a) and substr(token, i, length(a)) = a) join st on c = candidate where token <> candidate
 union all select token, candidate, 1 from q join st on token[1] = token[2] and token[2:] = candidate
 union all select token, candidate, 2 from rd join cd using (k) where token <> candidate and (length(token) = length(candidate) and i = j or abs(length(token) - length(candidate)) = 1 and (i = 0 or j = 0))),
best as (select token, candidate, min(m) as m from found group by all),
status as (select token, case when token in (select candidate from st) then 'attested' when token in (select token from best) then 'recoverable' else 'unattested' end as status from (select distinct token from k))
"""


def _tokens4(spark, sf_dir):
    rows = _banded(spark, sf_dir).select("file", "page_num", "line_num", "categ", "text")
    return lexicon.tokens(rows, min_letters=4), checkpointed(lexicon.text_frequency(_table(spark, sf_dir, "documents")))


@query(_RECOVER + "select file, page_num, line_num, count(*) as tokens, count(*) filter (status = 'attested') as attested, count(*) filter (status = 'recoverable') as recoverable, count(*) filter (status <> 'unattested') / count(*)::double as score from k join status using (token) group by all")
def line_recoverability(spark, sf_dir):
    tokens, table = _tokens4(spark, sf_dir)
    return recover.recoverability(tokens, table, ["file", "page_num", "line_num"], kinds=table.where("length(token) >= 4"))


@query(_RECOVER + "select categ, status, count(*) as tokens, count(distinct token) as kinds, count(*) / sum(count(*)) over (partition by categ)::double as share from k join status using (token) group by categ, status")
def token_status_report(spark, sf_dir):
    return recover.status_report(*_tokens4(spark, sf_dir), "categ")


@query(_RECOVER + ", r as (select best.*, df, row_number() over (partition by token order by df desc, candidate) as rank from best join st using (candidate)) select token, candidate, df, ['diacritics', 'confusion', 'edit1'][m + 1] as mechanism, rank from r where rank <= 3")
def nearest_attested(spark, sf_dir):
    _, table = _tokens4(spark, sf_dir)  # the lexicon has every token of the lines
    return recover.nearest_attested(recover.judged(table.where("length(token) >= 4"), table)[1])


_SPELLINGS = (" Clear", "NOISY ", "trash", "non_text", "Non-Text", "nontext", "EMPTY", "Other ", "  ", "Clear-ish", "non text")


@query(f"""with x as (select doc_id, list_extract([{', '.join(f"'{x}'" for x in _SPELLINGS)}], (doc_id % {len(_SPELLINGS) + 1})::int + 1) as raw from documents), y as (select *, replace(lower(trim(coalesce(raw, ''))), '_', '-') as k from x)
select doc_id, raw, case when k in ('non-text', 'nontext') then 'Non-text' when k in ('clear', 'noisy', 'trash', 'empty') then upper(k[1]) || k[2:] else trim(coalesce(raw, '')) end as category from y""")
def category_names(spark, sf_dir):
    """Categories as people write them, and what is no category, by their normal names."""
    names = F.array(*map(F.lit, _SPELLINGS))
    raw = F.get(names, (F.col("doc_id") % (len(_SPELLINGS) + 1)).cast("int"))
    return _table(spark, sf_dir, "documents").select("doc_id", raw.alias("raw"), evaluate.normalised_category(raw).alias("category"))

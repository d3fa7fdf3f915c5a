"""Training data for models of the quality score, and a boosted baseline on them, by ``pyspark.ml``.

A document is on one side of every split, and a text stands once in the set, so that nothing of what a model is judged by has been seen in training.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.operators import damage, evaluate, scoring
from folioscope.operators.ordered import checkpointed
from folioscope.operators.sampling import split, unit_hash
from folioscope.params import DEFAULT, Params

#: Columns that the baseline sees; perplexity is one more, for models that may see it.
FEATURES = ("lang_score", "word_count", "char_count", "garbage_density", "word_weird", "vowel_ratio", "rot_ratio", "fused_words", "gibberish")
TARGET = "raw_score"


def scored_items(items: DataFrame, models: DataFrame | None = None, p: Params = DEFAULT) -> DataFrame:
    """``items`` of ``damage.items`` with signals, ``raw_score``, ``categ`` and ``reason`` of the rules, no document passes. ``models`` (file, page_num,
    line_num, lang, lang_score, perplex) are the frozen outputs for the source lines; a variant has those of its line."""
    rows = items if models is None else items.join(models.select("file", "page_num", "line_num", "lang", "lang_score", "perplex"), ["file", "page_num", "line_num"], "left")
    rows = rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "file", "page_num", "line_num", "number")
    return scoring.categorised(scoring.with_score(scoring.with_signals(scoring.prefilter(rows, p), p), p), p)


def once_by_text(rows: DataFrame) -> DataFrame:
    """Of the items whose texts agree but for blanks, one: an original before a variant, then the first by file, page, line and number."""
    key = F.trim(F.regexp_replace("text", r"[\p{Z}\s]+", " "))
    order = F.struct((F.col("provenance") != "original").alias("p"), "file", "page_num", "line_num", "number")
    return rows.groupBy(key.alias("_k")).agg(F.min_by(F.struct(*rows.columns), order).alias("r")).select("r.*")


def assigned(rows: DataFrame, seed: int = 23, gold: DataFrame | None = None, shares=(("train", 80), ("val", 10), ("test", 10))) -> DataFrame:
    """``rows`` with ``split`` by a hash of the document; documents of ``gold`` (file) are in test."""
    out = split(rows, "file", shares, seed)
    if gold is None:
        return out
    listed = gold.select("file").distinct().withColumn("_gold", F.lit(True))
    return out.join(listed, "file", "left").withColumn("split", F.when(F.col("_gold"), "test").otherwise(F.col("split"))).drop("_gold")


def balanced(rows: DataFrame, bins: int = 20, most: int | None = None, seed: int = 23) -> DataFrame:
    """At most ``most`` training rows in each bin of the target, those of least hash; other splits stay whole."""
    if most is None:
        return rows
    from pyspark.sql import Window

    bin_ = F.least(F.lit(bins - 1), F.greatest(F.lit(0), F.floor(F.col(TARGET) * bins).cast("int")))
    key = F.concat_ws(":", "file", "page_num", "line_num", "provenance", "number")
    train = rows.where("split = 'train'").withColumns({"_b": bin_, "_h": unit_hash(key, seed), "_i": key})
    first = F.row_number().over(Window.partitionBy("_b").orderBy("_h", "_i"))  # a constant bound: tasks send that many rows a bin
    return train.withColumn("_n", first).where(F.col("_n") <= most).drop("_b", "_h", "_i", "_n").unionByName(rows.where("split <> 'train'"))


def dataset(lines: DataFrame, seed: int = 23, each: int = 3, per_document: int | None = None, gold: DataFrame | None = None, bins: int = 20, most: int | None = None, p: Params = DEFAULT) -> DataFrame:
    """The training set of scored ``lines`` (see ``damage.items``): items with features, target, category and split.

    Items that the pre-filter takes (they have no score) are left out, repeated texts stand once. Written once to the shared folder.
    """
    models = lines.select("file", "page_num", "line_num", *(c if c in lines.columns else F.lit(None).cast(t).alias(c) for c, t in (("lang", "string"), ("lang_score", "double"), ("perplex", "double"))))
    rows = scored_items(damage.items(lines, seed, each, per_document), models, p)
    keep = ["file", "page_num", "line_num", "source_categ", "provenance", "number", "band", "ops", "text", *FEATURES, "perplex", TARGET, "categ", "reason"]
    rows = checkpointed(rows).where("stage = 'Process'").select(*keep)
    return checkpointed(balanced(assigned(once_by_text(rows), seed, gold), bins, most, seed))


def train(rows: DataFrame, perplexity: bool = False, iterations: int = 20, depth: int = 5, seed: int = 23):
    """(model, features): gradient-boosted trees on the rows of split ``train``; nulls are read as 0."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor

    names = [*FEATURES, *(["perplex"] if perplexity else [])]
    steps = [VectorAssembler(inputCols=[f"f_{n}" for n in names], outputCol="features"), GBTRegressor(labelCol=TARGET, maxIter=iterations, maxDepth=depth, seed=seed, stepSize=0.1)]
    return Pipeline(stages=steps).fit(_numbers(rows.where("split = 'train'"), names)), names


def _numbers(rows: DataFrame, names: list[str]) -> DataFrame:
    return rows.withColumns({f"f_{n}": F.coalesce(F.col(n).cast("double"), F.lit(0.0)) for n in names})


def predicted(model, names: list[str], rows: DataFrame) -> DataFrame:
    """``rows`` with ``prediction``, cut to 0 and 1."""
    out = model.transform(_numbers(rows, names)).withColumn("prediction", F.least(F.lit(1.0), F.greatest(F.lit(0.0), "prediction")))
    return out.drop("features", *(f"f_{n}" for n in names))


def metrics(rows: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """By split: the regression metrics of ``prediction`` against the target, and how often both are in the same band."""
    same = F.avg((evaluate.band_category(F.col(TARGET), p) == evaluate.band_category(F.col("prediction"), p)).cast("int")).alias("band_agreement")
    return evaluate.regression_metrics(rows, TARGET, "prediction", "split").join(rows.groupBy("split").agg(same), "split")


def shared_documents(rows: DataFrame) -> DataFrame:
    """Documents (file, splits) that are on more than one side; a sound set has none."""
    return rows.groupBy("file").agg(F.count_distinct("split").alias("splits")).where("splits > 1")

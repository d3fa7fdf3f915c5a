"""The batch job: files to scored lines, page statistics and records, each written once.

Lines are staged before they are aggregated, so the expensive scoring runs once and a lost executor repeats only its
own tasks; later steps read columns they need from the staged table. All tables appear together, see ``versions``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from folioscope.operators import aggregate, record, scoring
from folioscope.params import DEFAULT, Params
from folioscope.plans.versions import Write, publish
from folioscope.sources.formats import read_files


def run(spark: SparkSession, source: str, target: str, p: Params = DEFAULT, kind: str | None = None) -> dict[str, DataFrame]:
    """Tables ``lines``, ``pages``, ``records`` and ``errors`` as one version of ``target``, read back. A run that fails leaves the version before,
    one that finds nothing new leaves its files."""
    table = read_files(spark, source, kind)
    writes = {
        "errors": Write(table.where("error is not null").select("file", "kind", "error"), ["file"]), "lines": Write(scoring.process(table.where("error is null").drop("error"), p), ["file"]),
        "pages": Write(lambda done: aggregate.page_stats(done["lines"]), ["file"]), "records": Write(lambda done: record.records(done["lines"]), ["file"]),
    }
    version = publish(spark, target, writes)
    return {t: version.table(spark, t) for t in ("lines", "pages", "records", "errors")}


def arms(lines: DataFrame, base: Params, *others: Params) -> list[DataFrame]:
    """The same lines under several sets of constants, paired with the first: for transitions and labels."""
    from folioscope.operators.change import reach
    from folioscope.operators.compare import paired

    table = reach(lines, {str(i): p for i, p in enumerate((base, *others))})
    one = lambda i: table.where(f"arm = '{i}'")
    return [paired(one(0), one(i + 1), "text") for i in range(len(others))]

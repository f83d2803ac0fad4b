"""Mixing sources to target weights by Poisson replication.

Each source gets the repetition rate that brings its share of all characters to its target weight. A
document's number of copies inverts the Poisson distribution of that rate at a uniform number drawn from a
digest of seed and document id, so a retried task draws the same. Copies are exploded and sorted by a digest
of document and copy, which is a global shuffle. All of it is built-in functions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyglass.llm.common import DOCUMENT_COLUMNS, table

SEED = 17
# Target share of characters by source. Sources that are not listed keep their documents once each.
TARGET_WEIGHTS = {"src0": 0.24} | {f"src{i}": 0.04 for i in range(1, 20)}
PART_RATE = 64.0
DRAW, COUNT = "__mix_draw", "__mix_count"


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) of 52 bits from the digest of the parts; a null part counts as an empty text."""
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def poisson_steps(rate: float) -> list[float]:
    """The cumulative distribution up to where its tail is below the resolution of ``uniform``."""
    out, total, k = [], 0.0, 0
    while True:
        total += math.exp(-rate + (k * math.log(rate) if k else 0.0) - math.lgamma(k + 1))
        out.append(total)
        k += 1
        if k > rate and (total >= 1.0 or k > rate + 12 * math.sqrt(rate) + 30):
            return out


def repetition_rates(docs: DataFrame, weights: dict[str, float], column: str) -> dict[str, float]:
    """Mean copies per document of each listed source present; one row per listed source reaches the driver."""
    sizes = (
        docs.filter(F.col(column).isin(list(weights)))
        .groupBy(column)
        .agg(F.sum(F.coalesce(F.char_length("text"), F.lit(0))).cast("double").alias("size"))
        .collect()
    )
    size = {row[column]: row["size"] for row in sizes if row["size"] > 0 and weights[row[column]] > 0}
    total, weight = sum(sorted(size.values())), math.fsum(weights[s] for s in size)
    rates = {s: weights[s] / weight * total / n for s, n in size.items()}
    return rates | {row[column]: (0.0 if weights[row[column]] <= 0 else 1.0) for row in sizes if row[column] not in size}


def _sum_of_draws(steps: Column, parts: int, seed: int) -> Column:
    """Sum of one inverted draw per part, each from its own digest."""

    def add(total: Column, part: Column) -> Column:
        u = uniform(F.lit(str(seed)), F.col("doc_id"), part)
        return total + F.size(F.filter(steps, lambda t: t <= u))

    return F.aggregate(F.sequence(F.lit(1), F.lit(parts)), F.lit(0), add)


def copies(rates: dict[str, float], column: str, seed: int) -> Column:
    """Poisson count of a document. A rate above 64 is drawn as a sum of equal smaller parts."""
    out = F.lit(1)
    for source, rate in rates.items():
        if rate <= 0:
            count = F.lit(0)
        else:
            parts = math.ceil(rate / PART_RATE)
            steps = F.array(*[F.lit(x) for x in poisson_steps(rate / parts)])
            if parts == 1:
                count = F.size(F.filter(steps, lambda t: t <= F.col(DRAW)))
            else:
                count = _sum_of_draws(steps, parts, seed)
        out = F.when(F.col(column) == source, count).otherwise(out)
    return out.cast("int")


def mix(
    docs: DataFrame, weights: dict[str, float] = TARGET_WEIGHTS, column: str = "source", seed: int = SEED
) -> DataFrame:
    """Documents repeated to the target weights, in globally shuffled order, with ``copy`` and ``shuffle_key``.

    Null or unlisted sources keep each document once. Sources without characters keep theirs once as well.
    Rows that repeat a document id are drawn alike. An empty table gives an empty one. Further columns
    stay, but for those named ``copy`` and ``shuffle_key``, which are replaced.
    """
    rates = repetition_rates(docs, weights, column)
    drawn = docs.withColumn(DRAW, uniform(F.lit(str(seed)), F.col("doc_id")))
    counted = drawn.withColumn(COUNT, copies(rates, column, seed)).filter(F.col(COUNT) > 0).drop(DRAW, "copy", "shuffle_key")
    copied = counted.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col(COUNT)))).drop(COUNT)
    keyed = copied.withColumn(
        "shuffle_key", F.substring(F.md5(F.concat_ws(":", F.lit(f"{seed}s"), F.col("doc_id"), F.col("copy"))), 1, 16)
    )
    return keyed.orderBy("shuffle_key", "doc_id", "copy")


def op7_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*DOCUMENT_COLUMNS)
    return mix(docs).withColumn("copy", F.col("copy").cast("bigint"))


_listed = ", ".join(f"('{s}', {w})" for s, w in TARGET_WEIGHTS.items())


def mix_sql(source: str = "documents") -> str:
    """``mix`` in SQL over the table or common table ``source`` (without WITH)."""
    return f"""
weights as (select * from (values {_listed}) as t(source, w)),
sizes as (
  select source, cast(sum(length(coalesce(text, ''))) as double) as size from {source}
  where source in (select source from weights) group by source
),
rates as (
  select s.source, cast(w as double) / sum(cast(w as double)) over () * sum(size) over () / size as rate
  from sizes s join weights using (source) where size > 0
),
steps as (
  select source, k, sum(exp(-rate + case when k > 0 then k * ln(rate) else 0 end - lgamma(k + 1)))
    over (partition by source order by k) as cdf
  from rates, (select unnest(range(200)) as k)
),
drawn as (
  select d.*, ('0x' || substr(md5('{SEED}:' || coalesce(cast(doc_id as varchar), '')), 1, 13))::ubigint::double / 4503599627370496.0 as u
  from {source} d
),
counted as (
  select drawn.*, case when source in (select source from rates)
    then (select count(*) from steps where steps.source = drawn.source and cdf <= u) else 1 end as n
  from drawn
),
mixed as (
  select doc_id, text, lang, source, n_chars, copy,
    substr(md5('{SEED}s:' || coalesce(cast(doc_id as varchar) || ':', '') || copy), 1, 16) as shuffle_key
  from (select *, unnest(range(1, n + 1)) as copy from counted)
)"""


QUERIES = {"op7_mix": op7_mix}
ORACLE = {"op7_mix": f"with {mix_sql()} select * from mixed"}

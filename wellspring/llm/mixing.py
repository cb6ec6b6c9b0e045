"""Mixing sources to target weights.

Tokens are counted per source, repetition rates follow from the targets, and
every document is emitted ``floor(rate)`` times plus one hash-seeded Bernoulli
copy.  Only the table of sources (one row each, made by a partial aggregate)
is ever brought together; documents never move.

Defined cases: a null text has size 0; a null source is a source of its own
and comes last; a source of size 0 has target 0 and its documents are not
emitted; a null id draws like the text "null"; equal ids draw alike, so
repeated rows are taken equally often; an empty table gives no rows; the
columns this module adds replace input columns of the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A word: no blank, tab, line feed, vertical tab, form feed or return.
WORD = r"[^\x20\x09-\x0D]+"
SEED = "mix-1"
ADDED = ("size", "source_size", "target", "rate", "copies", "taken")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, source: str, weights: tuple, share: float, cap: float) -> DataFrame:
    """(source, source_size, target), one row per source.

    Resharing the excess by weight until no source is above its ceiling ends at
    min(ceiling, level * weight) with one level for all.  Sources become full in
    the order of ceiling / weight.  Supposing the first k full gives the level
    (total - their ceilings) / (weight of the others); no such level is above the true
    one, which is among them, so it is their largest.  The windows run over one
    row per source, never over documents.
    """
    per = sized.groupBy(F.col(source).alias("_source")).agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("_source").asc_nulls_last())
    index = F.row_number().over(by_name) - 1
    weight = F.element_at(F.array(*[F.lit(int(w)).cast("long") for w in weights]), (index % len(weights) + 1).cast("int"))
    per = per.select("_source", "source_size", weight.alias("_w"))
    by_ratio = Window.orderBy(F.col("source_size") / F.col("_w"), F.col("_source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    per = per.select(
        "*",
        F.coalesce(F.sum("source_size").over(before), F.lit(0)).alias("_full"),
        F.coalesce(F.sum("_w").over(before), F.lit(0)).alias("_w_full"),
        F.sum("source_size").over(everything).alias("_all"),
        F.sum("_w").over(everything).alias("_w_all"),
    )
    level = (share * F.col("_all") - cap * F.col("_full")) / (F.col("_w_all") - F.col("_w_full"))
    ceiling = cap * F.col("source_size").cast("double")
    per = per.withColumn("_level", F.max(level).over(everything))
    target = F.least(ceiling, F.col("_level") * F.col("_w")) if share < cap else ceiling
    return per.select("_source", "source_size", target.alias("target"))


def uniform(key: Column, seed: str) -> Column:
    """A number in [0, 1) fixed by key and seed: 52 bits of an MD5."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def mixing_rates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple = (5, 2, 1),
    share: float = 1.5,
    cap: float = 2.0,
    seed: str = SEED,
) -> DataFrame:
    """``docs`` with size, source_size, target, rate, copies and taken (= copies * size)."""
    sized = docs.drop(*ADDED).withColumn("size", word_count(F.col(text_col)))
    targets = source_targets(sized, source_col, weights, share, cap)
    rate = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(cap))).otherwise(F.lit(0.0))
    extra = uniform(F.col(id_col), seed) < F.col("rate") - F.floor("rate")
    return (
        sized.join(targets, sized[source_col].eqNullSafe(targets["_source"]), "left")
        .drop("_source")
        .withColumn("rate", rate)
        .withColumn("copies", (F.floor("rate") + extra.cast("int")).cast("int"))
        .withColumn("taken", F.col("copies") * F.col("size"))
    )


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mixed documents themselves: each row ``copies`` times, with the columns of ``docs``."""
    carried = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"),
        F.col(id_col).alias("__id"),
        F.col(text_col).alias("__text"),
        F.col(source_col).alias("__source"),
    )
    rated = mixing_rates(carried, "__id", "__text", "__source", **options).where("copies > 0")
    return rated.select("__row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("__row.*")


def op3_mixing(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    return mixing_rates(docs).select("doc_id", "size", "source_size", "target", "taken", "copies")


ORACLE_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents
), per AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS i
  FROM sized GROUP BY source
), w AS (
  SELECT *, CASE i % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w FROM per
), tried AS (
  SELECT a.source,
         (1.5 * (SELECT sum(source_size) FROM w)
          - 2.0 * coalesce(sum(b.source_size), 0)) / ((SELECT sum(w) FROM w) - coalesce(sum(b.w), 0)) AS level,
         any_value(a.w) AS w, any_value(a.source_size) AS source_size
  FROM w a LEFT JOIN w b ON b.source_size::DOUBLE / b.w < a.source_size::DOUBLE / a.w
  GROUP BY a.source
), lv AS (
  SELECT max(CAST(level AS DOUBLE)) AS level FROM tried
), targets AS (
  SELECT source, source_size,
         CAST(least(2.0 * source_size, (SELECT level FROM lv) * w) AS DOUBLE) AS target
  FROM w
), rated AS (
  SELECT s.doc_id, s.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN least(t.target / t.source_size, 2.0) ELSE 0.0 END AS rate,
         CAST(CAST('0x' || substr(md5('mix-1:' || coalesce(CAST(s.doc_id AS VARCHAR), 'null')), 1, 13) AS BIGINT) AS DOUBLE)
           / 4503599627370496.0 AS u
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       CAST((floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) * size AS BIGINT) AS taken,
       CAST(floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END AS INTEGER) AS copies
FROM rated
"""

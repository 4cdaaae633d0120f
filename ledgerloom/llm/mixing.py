"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every source gets a target in words; it is reached by complete epochs first and then by a weighted sample without replacement:
each document draws an exponential key scaled by its quality weight, keys are sorted within the source, and a prefix sum of the
sizes cuts the order where the words left over after the complete epochs are used up.

Prefix sums never need a source in one task. Keys fall into bins; bins are summed first (with map-side combine), the sums are
added up over the bins of a source, and only then each bin adds up its own rows. Bins are even steps of the key's logarithm: a key
is an exponential number over a weight, and the logarithm of such a number is spread with a density of 1/e at most wherever the
weight moves it, so no bin expects more than 1/(e * BINS) of a source's rows, whatever the weights.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import cut, words

#: Bins per unit of the natural logarithm of a sampling key, at every size.
BINS = 1 << 10
#: A document is repeated so many times at most.
MOST_EPOCHS = 3
#: Characters that count against the quality weight of a text.
SYMBOLS = "#$%&*+<=>@[]^_`{|}~"


def quality_weight(text: Column) -> Column:
    """Share of ordinary characters to the fourth power, 0.05 at least and 1 at most; 1 for empty and NULL texts."""
    share = F.length(F.translate(text, SYMBOLS, "")) / F.length(text)
    weight = share * share * share * share
    return F.when(F.coalesce(F.length(text), F.lit(0)) == 0, F.lit(1.0)).otherwise(F.greatest(F.lit(0.05), weight))


def uniform(seed: str, *columns: Column) -> Column:
    """A number in (0, 1) that depends on the seed and the columns alone."""
    digits = F.substring(F.md5(F.concat_ws("|", F.lit(seed), *[F.coalesce(c.cast("string"), F.lit("~")) for c in columns])), 1, 12)
    return (F.conv(digits, 16, 10).cast("long") + 0.5) / float(1 << 48)


def key_bin(key: Column) -> Column:
    """The bin of a sampling key; larger keys never have smaller bins."""
    return F.floor(F.log(key) * BINS).cast("int")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), epochs: int = MOST_EPOCHS) -> DataFrame:
    """(source, source_size) to (source, source_size, target).

    Sources by code point, NULL last, weigh ``weights`` in turn and share the sum of all sizes by weight. A target stops at
    ``epochs`` times its source's size; what is above is shared again by weight until no target is above. That is the same as
    one level L with target = min(epochs * size, L * weight), found by going through the sources by epochs * size / weight.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(w) for w in weights])
    s = sizes.withColumn("weight", F.element_at(cycle, ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")))
    s = s.withColumn("most", F.col("source_size") * epochs).withColumn("ratio", F.col("most") / F.col("weight"))
    by_ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before, rest = by_ratio.rowsBetween(Window.unboundedPreceding, -1), by_ratio.rowsBetween(0, Window.unboundedFollowing)
    s = s.withColumn("left", F.sum("source_size").over(Window.partitionBy()) - F.coalesce(F.sum("most").over(before), F.lit(0)))
    s = s.withColumn("level", F.col("left") / F.sum("weight").over(rest)).withColumn("fits", F.col("level") <= F.col("ratio"))
    level = F.min(F.when(F.col("fits"), F.struct("ratio", "level"))).over(Window.partitionBy())["level"]
    s = s.withColumn("level", level)
    target = F.least(F.col("most").cast("double"), F.col("level") * F.col("weight"))
    return s.select("source", "source_size", F.coalesce(target, F.col("most").cast("double")).alias("target"))


def mix(documents: DataFrame, weight: Column | None = None, weights: tuple[int, ...] = (1, 2, 3), epochs: int = MOST_EPOCHS, seed: str = "mix") -> DataFrame:
    """One row per document: doc_id, size (words), source, source_size, target, taken (words the mix takes, repeats counted).

    Reads doc_id, text and source; other columns are ignored. ``weight`` is a positive column over the documents (default:
    ``quality_weight``). ``taken`` is the number of complete epochs times the size, plus the size if the document is in the
    sample; the document at the cut gives its first words only, so a source's words add up to its target's whole part. NULL and
    empty texts have size 0 and are never taken. Rows with one doc_id are separate documents with one key; ties
    go to the smaller size. An empty table gives no rows. Keys depend on the seed and the doc_id, on the text where there is no
    doc_id, so reruns agree.
    """
    weight = quality_weight(F.col("text")) if weight is None else weight
    own = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("~"), F.md5(F.coalesce("text", F.lit("")))))
    key = -F.log(uniform(seed, own)) / weight
    rows = documents.select("doc_id", "source", words(F.col("text")).cast("long").alias("size"), key.alias("key"))
    rows = cut(rows.withColumn("bin", key_bin(F.col("key"))))
    bins = rows.groupBy("source", "bin").agg(F.sum("size").alias("bin_size"))
    targets = source_targets(bins.groupBy("source").agg(F.sum("bin_size").alias("source_size")), weights, epochs)
    earlier = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.withColumn("before", F.coalesce(F.sum("bin_size").over(earlier), F.lit(0))).drop("bin_size")
    full = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    t = targets.withColumn("epochs", full.cast("long"))
    t = t.withColumn("budget", F.floor("target").cast("long") - F.col("epochs") * F.col("source_size")).withColumnRenamed("source", "s")
    bins = bins.join(t, bins["source"].eqNullSafe(t["s"])).drop("s").withColumnsRenamed({"source": "b_source", "bin": "b_bin"})
    joined = rows.join(bins, rows["source"].eqNullSafe(bins["b_source"]) & (rows["bin"] == bins["b_bin"]))
    in_bin = Window.partitionBy("source", "bin").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("before") + F.coalesce(F.sum("size").over(in_bin), F.lit(0))
    sampled = F.greatest(F.lit(0), F.least(F.col("size"), F.col("budget") - start))
    taken = (F.col("epochs") * F.col("size") + sampled).cast("long")
    return joined.select("doc_id", "size", "source", "source_size", "target", taken.alias("taken"))


def mix_sql(documents: str = "documents", seed: str = "mix", epochs: int = MOST_EPOCHS) -> str:
    """The same in DuckDB SQL: doc_id, size, source_size, target, taken."""
    return f"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
         length(translate(text, '{SYMBOLS}', ''))::DOUBLE / nullif(length(text), 0) AS share,
         (('0x' || substr(md5('{seed}|' || coalesce(doc_id::VARCHAR, '~' || md5(coalesce(text, '')))), 1, 12))::BIGINT + 0.5::DOUBLE) / 281474976710656.0::DOUBLE AS u
  FROM {documents}
), k AS (
  SELECT *, -ln(u) / coalesce(greatest(0.05::DOUBLE, share * share * share * share), 1::DOUBLE) AS key FROM d
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight
  FROM d GROUP BY source
), r AS (
  SELECT *, {epochs} * source_size AS most, ({epochs} * source_size)::DOUBLE / weight AS ratio FROM s
), l AS (
  SELECT *, ((sum(source_size) OVER () - coalesce(sum(most) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
         / sum(weight) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS level FROM r
), t AS (
  SELECT source, source_size,
         coalesce(least(most::DOUBLE, (SELECT level FROM l WHERE level <= ratio ORDER BY ratio, level LIMIT 1) * weight), most::DOUBLE) AS target
  FROM l
), b AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs FROM t
), c AS (
  SELECT k.doc_id, k.size, b.source_size, b.target, b.epochs, floor(b.target)::BIGINT - b.epochs * b.source_size AS budget,
         coalesce(sum(k.size) OVER (PARTITION BY k.source ORDER BY key, k.doc_id NULLS FIRST, k.size
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM k JOIN b ON k.source IS NOT DISTINCT FROM b.source
)
SELECT doc_id, size, source_size, target, (epochs * size + greatest(0, least(size, budget - start)))::BIGINT AS taken FROM c"""

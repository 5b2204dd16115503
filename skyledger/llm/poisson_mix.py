"""Mixing sources to target weights by Poisson replication.

A source's repetition rate is total * weight / size. A document's number of copies inverts the Poisson distribution
of that rate at a uniform number hashed from (seed, doc_id): the number of k with F(k) <= u. Copies are
exploded and dealt out by the hash of (seed, doc_id, copy), which also orders each partition: a global shuffle.

Rates over 500 are drawn as sums of equal smaller draws, as exp() would underflow. A null source is a source of its own;
a source without a target weight has weight 0 and goes. Equal ids draw the same number, so repeated rows are repeated alike. A null id counts as
the text 'null'. Null and empty texts are rows like others; texts aren't read. An empty table gives no rows. All columns are kept, whatever their
names, besides ``copy`` and ``shuffle_key``; where the table has these, the new ones get underscores in front.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch, fresh

SEED = "mix-1"
PART = 500.0
BROADCAST_SOURCES = 10_000  # of some hundred bytes each; beyond, the rates are joined by salted shuffle
SALTS = 64


def square_root_weights(sizes: DataFrame) -> DataFrame:
    """Target weights between the sources' own shares and equal ones: proportional to the root of their sizes."""
    roots = sizes.agg(F.sum(F.sqrt("size"))).first()[0] or 1.0
    return sizes.select("source", (F.sqrt("size") / F.lit(roots)).alias("weight"))


def _uniform(seed: str, doc_id: Column, part: Column) -> Column:
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(":"), part.cast("string")))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / float(1 << 52)


def rates(sizes: DataFrame, weights: DataFrame) -> DataFrame:
    """(r_source, rate, parts, cdf): the distribution function of each source's draws, until it is 1 in doubles."""
    total = sizes.agg(F.sum("size")).first()[0] or 0
    w = weights.select(F.col("source").alias("w_source"), "weight")
    rate = sizes.join(w, F.expr("source <=> w_source"), "left").select("source", F.round(total * F.coalesce("weight", F.lit(0.0)) / F.col("size"), 9).alias("rate"))
    rate = rate.withColumn("parts", F.greatest(F.ceil(F.col("rate") / PART), F.lit(1)).cast("int")).withColumn("part_rate", F.col("rate") / F.col("parts"))
    first = F.exp(-F.col("part_rate"))
    steps = F.sequence(F.lit(1), F.ceil(F.col("part_rate") + 12 * F.sqrt("part_rate") + 30).cast("int"))
    grown = F.aggregate(
        steps,
        F.struct(first.alias("p"), F.array(first).alias("f")),
        lambda acc, k: F.struct((acc["p"] * F.col("part_rate") / k).alias("p"), F.concat(acc["f"], F.array(F.element_at(acc["f"], -1) + acc["p"] * F.col("part_rate") / k)).alias("f")),
    )
    return rate.select(F.col("source").alias("r_source"), "rate", "parts", grown["f"].alias("cdf"))


def poisson_mix(docs: DataFrame, weights: DataFrame | None = None, seed: str = SEED) -> DataFrame:
    """Rows of ``docs`` repeated by their draws, with ``copy`` (from 1) and ``shuffle_key``, shuffled globally. ``weights`` has source and weight."""
    scratch = Scratch(docs.sparkSession)
    sizes = scratch.save(docs.groupBy("source").agg(F.count(F.lit(1)).alias("size")))
    # Written, as it is joined with texts: the plan then knows its size.
    table = scratch.save(rates(sizes, square_root_weights(sizes) if weights is None else weights))
    inner = {c: fresh(f"mix_{c}", docs) for c in ("source", "parts", "cdf", "salt", "uniform", "copies")}
    copy, shuffle_key = fresh("copy", docs), fresh("shuffle_key", docs)
    dealt = table.select(*(F.col(a).alias(inner[b]) for a, b in (("r_source", "source"), ("parts", "parts"), ("cdf", "cdf"))))
    same = F.col("source").eqNullSafe(F.col(inner["source"]))
    if sizes.count() <= BROADCAST_SOURCES:
        drawn = docs.join(F.broadcast(dealt), same)
    else:  # a source's documents are dealt to SALTS partitions
        salted = dealt.withColumn("r_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salted = salted.withColumnRenamed("r_salt", fresh("r_salt", docs))
        drawn = docs.withColumn(inner["salt"], F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")).join(salted, same & (F.col(inner["salt"]) == F.col(salted.columns[-1])))
    uniform = F.transform(F.sequence(F.lit(0), F.col(inner["parts"]) - 1), lambda part: _uniform(seed, F.col("doc_id"), part))
    drawn = drawn.withColumn(inner["uniform"], uniform)  # a hash for each part, not for each entry of the function
    copies = F.aggregate(F.transform(inner["uniform"], lambda u: F.size(F.filter(inner["cdf"], lambda c: c <= u))), F.lit(0), lambda a, b: a + b)
    out = drawn.withColumn(inner["copies"], copies).where(F.col(inner["copies"]) > 0).withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(inner["copies"]))))
    out = out.withColumn(shuffle_key, F.md5(F.concat(F.lit(f"{seed}#"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit("#"), F.col(copy).cast("string"))))
    return out.select(*(F.col(f"`{c}`") for c in docs.columns), copy, shuffle_key).repartition(shuffle_key).sortWithinPartitions(shuffle_key)


ORACLE = f"""
WITH RECURSIVE s AS (SELECT source, count(*) AS size FROM documents GROUP BY source),
r AS (SELECT source, round((SELECT sum(size) FROM s) * (sqrt(size) / (SELECT sum(sqrt(size)) FROM s)) / size, 9) AS rate FROM s),
c(source, rate, k, p, f) AS (
  SELECT source, rate, 0, exp(-rate), exp(-rate) FROM r
  UNION ALL SELECT source, rate, k + 1, p * rate / (k + 1), f + p * rate / (k + 1) FROM c WHERE k < ceil(rate + 12 * sqrt(rate) + 30)),
u AS (SELECT *, ('0x' || substr(md5('{SEED}:' || doc_id || ':0'), 1, 13))::BIGINT / 4503599627370496.0 AS u FROM documents),
n AS (SELECT u.doc_id, u.text, u.lang, u.source, u.n_chars, count(*) AS copies FROM u JOIN c ON u.source = c.source AND c.f <= u.u GROUP BY ALL)
SELECT doc_id, text, lang, source, n_chars, copy::INT AS copy, md5('{SEED}#' || doc_id || '#' || copy) AS shuffle_key
FROM (SELECT *, unnest(range(1, copies + 1)) AS copy FROM n)
"""

"""URL filter by host and path rules: a blocked Bloom filter, then an exact hash join.

A rule ``host/path`` fits a URL whose host is the rule's or a subdomain of it and whose path starts with the rule's;
the longest rule string wins (then the longest host, then the smaller string). Each distinct (host, path) yields one
candidate key for each (label count, path length) that occurs among the rules. Candidates probe the blocked filter: a block of
eight 32-bit words, one bit in each. Those that hit go to an exact hash join, which removes false positives.

Only DataFrame functions are used. Null URLs and those without ``://`` have an empty host and path, fit no rule and get the
default verdict. Repeated rows stay, and so do rows without an id; other columns of the table are not read and may have any name; an empty table
gives no rows. Very long URLs are judged whole. Of rules of one host and path, that with the longest string, then the smallest, counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
KEYS_PER_BLOCK = 8
MAX_BLOCKS = 1 << 17  # 131,072 rows of eight words: the most that is broadcast
BROADCAST_RULES = 100_000
SALTS_OF_NO_HOST = 1024
#: Odd multipliers, one for each word of a block.
SALTS = [2 * i * 0x2C9277B5 % 0x7FFFFFFF | 1 for i in range(1, 9)]


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(_rest(url), "^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    return F.when(F.locate("://", url) > 0, F.substring(url, F.locate("://", url) + 3, F.length(url))).otherwise("")


def _bits(key: Column) -> list[Column]:
    low = F.shiftrightunsigned(F.xxhash64(key), 34)
    return [F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.shiftrightunsigned(low * F.lit(s), 26), F.lit(32)).cast("int")) for s in SALTS]


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def _key(host: Column, path: Column) -> Column:
    return F.concat(host, F.lit("\n"), path)


def filter_urls(pages: DataFrame, rules: DataFrame, default: str = "allow", url_col: str = "url") -> DataFrame:
    """``pages`` (its id column ``page_id``) with host, path, rule and verdict; ``rules`` has rule and verdict."""
    parsed = rules.select("rule", "verdict", F.translate(F.regexp_extract("rule", "^[^/]*", 0), UPPER, LOWER).alias("rule_host"), F.regexp_extract("rule", "^[^/]*(.*)$", 1).alias("rule_path"))
    parsed = parsed.select("*", _key(F.col("rule_host"), F.col("rule_path")).alias("key"), F.size(F.split("rule_host", r"\.")).alias("labels"), F.length("rule_path").alias("chars"))
    n = parsed.count()
    blocks = 1
    while blocks * KEYS_PER_BLOCK < n and blocks < MAX_BLOCKS:
        blocks *= 2
    # As many as host names have labels times lengths of paths: what URLs allow bounds them, not the number of rules.
    shapes = [(r.labels, r.chars) for r in parsed.select("labels", "chars").distinct().collect()]

    urls = pages.select("page_id", host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    urls = urls.withColumns({"host": F.coalesce("host", F.lit("")), "path": F.coalesce("path", F.lit(""))})
    if not shapes:
        return urls.select("*", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))

    bloom = parsed.select(_block(F.col("key"), blocks).alias("block"), *(b.alias(f"w{i}") for i, b in enumerate(_bits(F.col("key"))))).groupBy("block").agg(*(F.bit_or(f"w{i}").alias(f"w{i}") for i in range(8)))
    count = F.size(F.split("host", r"\."))
    known = F.array(*(F.struct(F.lit(k).alias("labels"), F.lit(c).alias("chars")) for k, c in sorted(shapes)))  # folded to one constant
    fitting = F.filter(known, lambda x: (x["labels"] <= count) & (x["chars"] <= F.length("path")))
    keys = F.transform(fitting, lambda x: _key(F.concat_ws(".", F.slice(F.split("host", r"\."), -x["labels"], x["labels"])), F.substring(F.col("path"), F.lit(1), x["chars"])))
    asked = urls.where("host <> ''").select("host", "path").distinct().select("host", "path", F.explode(keys).alias("key"))
    asked = asked.withColumn("block", _block(F.col("key"), blocks)).join(F.broadcast(bloom), "block")
    hit = F.lit(True)
    for i, bit in enumerate(_bits(F.col("key"))):
        hit = hit & (F.col(f"w{i}").bitwiseAND(bit) != 0)
    exact = parsed.select("key", "rule", "verdict", F.struct(F.length("rule").alias("l"), F.length("rule_host").alias("h"), (-F.col("chars")).alias("c")).alias("rank"))
    exact = exact.groupBy("key").agg(F.min(F.struct("rule", "verdict", "rank")).alias("x")).select("key", "x.*")
    found = asked.where(hit).select("host", "path", "key").join(F.broadcast(exact) if n <= BROADCAST_RULES else exact, "key")
    best = found.groupBy("host", "path").agg(F.max_by(F.struct("rule", "verdict"), "rank").alias("x")).select("host", "path", "x.rule", "x.verdict")
    # URLs without a host are many rows of one key; they are dealt out by a salt. The other side is written first, so that a hot URL can be split among tasks.
    scratch = Scratch(pages.sparkSession)
    best = scratch.save(best.withColumn("salt", F.lit(0)))
    salted = urls.withColumn("salt", F.when(F.col("host") == "", F.pmod(F.xxhash64("page_id"), F.lit(SALTS_OF_NO_HOST)).cast("int")).otherwise(0))
    return salted.join(best, ["host", "path", "salt"], "left").select("page_id", "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))


#: Fixed values of the contract.
RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]

ORACLE = f"""
WITH r(rule, verdict) AS (VALUES {", ".join(f"('{a}', '{b}')" for a, b in RULES)}),
p AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
u AS (SELECT row_number() OVER () AS n, page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
m AS (SELECT u.n, r.rule, r.verdict, row_number() OVER (PARTITION BY u.n ORDER BY length(r.rule) DESC) AS k FROM u JOIN r
      ON (u.host = split_part(r.rule, '/', 1) OR ends_with(u.host, '.' || split_part(r.rule, '/', 1)))
     AND starts_with(u.path, substr(r.rule, strpos(r.rule, '/'))))
SELECT u.page_id, u.host, u.path, m.rule, coalesce(m.verdict, 'allow') AS verdict FROM u LEFT JOIN m ON u.n = m.n AND m.k = 1
"""

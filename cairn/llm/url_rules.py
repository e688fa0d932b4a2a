"""URL filters: explicit host-and-path rules, then association rules mined by FP-growth.  JVM side only.

A url is taken apart into tokens - scheme, every domain its host belongs to, path segments with their depth,
file type, names of query parameters; numbers are one token - and FP-growth mines, from labelled urls,
combinations of tokens that go with ``block``.  Rules below the support or confidence asked for
are pruned, as are rules that a rule on fewer of the same tokens already covers.  Matching is by inverted
index: rules are listed by token, a url's tokens are looked up there, and a rule whose tokens were all hit
fires.  Explicit rules are listed by host in the same way, and the longest that fits wins over what was mined.

Itemsets are bounded before mining, and no rule is lost by it.  Only tokens that occur in ``least`` blocked urls or more can
be in a rule.  Tokens that occur in exactly the same labelled urls are one item, which the token that sorts first stands
for: a rule with some of them says what the rule with that one says.  If a labelled url still has more than ``MAX_ITEMS``
items, whose combinations would be too many to list, mining raises and names the support to ask for instead of cutting.

All of this is per distinct url, so a url that a third of the pages share is judged once; urls with an empty host,
null ones among them, are judged where they are, and the join that hands verdicts back is one that Spark splits where a
url is hot.

Defined cases: a null url, or one without ``://``, has empty host and path, no rule and verdict ``allow``; without
labels nothing is mined and all else is allowed; equal urls get equal verdicts; page ids may be null or
repeat; columns besides id and url, whatever their names, are ignored; an empty table gives none.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.llm.common import durable, forget, tidy

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Fixed values of the query: (verdict, host, path).
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]
MIN_SUPPORT, MIN_CONFIDENCE, LEAST, MAX_ITEMS = 0.005, 0.9, 3, 20
NO_RULES = "SELECT 0L AS rule, array('') AS tokens, 0D AS confidence, 0D AS support WHERE false"


def _rest(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.expr("substring(url, locate('://', url) + 3)")).otherwise(F.lit(""))


def parts(df: DataFrame) -> DataFrame:
    """Adds host and path to a frame with the column ``url``."""
    rest = F.coalesce(_rest(F.col("url")), F.lit(""))
    host = F.translate(F.regexp_extract("_rest", r"^([^/?#]*)", 1), UPPER, LOWER)
    return df.withColumn("_rest", rest).withColumn("host", host).withColumn("path", F.regexp_extract("_rest", r"^[^/?#]*([^?#]*)", 1)).drop("_rest")


def domains(host: Column) -> Column:
    """The host and every domain it is part of: a.b.c, b.c, c."""
    labels = F.split(host, r"\.")
    each = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.array_distinct(each))


def url_tokens() -> Column:
    """The distinct tokens of a row with url, host and path."""
    segments = F.filter(F.split(F.translate("path", UPPER, LOWER), "/"), lambda s: s != "")
    plain = lambda s: F.regexp_replace(s, r"[0-9]+", "#")
    placed = F.transform(segments, lambda s, i: F.concat(F.lit("p"), (i + 1).cast("string"), F.lit(":"), plain(s)))
    query = F.regexp_extract("url", r"^[^?#]*\?([^#]*)", 1)
    names = F.transform(F.filter(F.split(query, "&"), lambda s: s != ""), lambda s: F.concat(F.lit("q:"), F.substring_index(s, "=", 1)))
    first = F.array(F.concat(F.lit("s:"), F.substring_index(F.lower("url"), "://", 1)), F.concat(F.lit("x:"), F.regexp_extract("path", r"\.([A-Za-z0-9]+)/?$", 1)))
    of_host = F.transform(domains(F.col("host")), lambda d: F.concat(F.lit("d:"), d))
    return F.when(F.col("host") == "", F.array().cast("array<string>")).otherwise(F.array_distinct(F.concat(first, of_host, placed, names)))


def items_of(labelled: DataFrame, least: int) -> DataFrame:
    """row, block, items: each labelled url's tokens that may be in a rule, one for all that occur in the same urls."""
    rows = parts(labelled.where("url is not null and block is not null"))
    rows = durable(rows.select(F.monotonically_increasing_id().alias("row"), "block", url_tokens().alias("tokens")), "url-tokens")
    listed = rows.select("row", "block", F.explode("tokens").alias("token"))
    # three sums tell sets of rows apart: their number, and two of 64 bits over hashes of their members
    same = [F.count("*").alias("n"), F.expr("bit_xor(xxhash64(row))").alias("x"), F.expr("bit_xor(xxhash64('', row))").alias("y")]
    seen = listed.groupBy("token").agg(F.count_if("block").alias("blocked"), *same).where(F.col("blocked") >= least)
    chosen = seen.groupBy("n", "x", "y").agg(F.min("token").alias("token")).select("token")
    items = listed.join(chosen, "token").groupBy("row").agg(F.collect_list("token").alias("items"))
    return rows.select("row", "block").join(items, "row", "left").withColumn("items", F.coalesce("items", F.array().cast("array<string>")))


def mine(spark: SparkSession, labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE, least: int = LEAST) -> DataFrame:
    """rule (id), tokens, confidence, support from a frame (url, block): token combinations that go with block, in a share
    ``min_support`` of the labelled urls and in ``least`` of them at the least."""
    from pyspark.ml.fpm import FPGrowth

    items = durable(items_of(labelled, least), "url-items")
    with tidy(spark):
        n, most = items.agg(F.count("*"), F.max(F.size("items"))).first()
    if not n:
        return spark.sql(NO_RULES)
    times = max(math.ceil(min_support * n), least)
    support = (times - 0.5) / n  # the miner rounds up: no product of fractions decides
    if most > MAX_ITEMS:  # only items that are frequent by themselves count
        often = items.select(F.explode("items").alias("token")).groupBy("token").count().where(F.col("count") >= times)
        with tidy(spark):
            most = items.select("row", F.explode("items").alias("token")).join(often, "token").groupBy("row").count().agg(F.max("count")).first()[0] or 0
        if most > MAX_ITEMS:
            raise ValueError(f"a labelled url has {most} items in over {support:.4g} of all: 2 ** {most} combinations; ask for a higher min_support")
    label = F.when(F.col("block"), F.lit("=block")).otherwise(F.lit("=allow"))
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=min_confidence).fit(items.select(F.array_append("items", label).alias("items")))
    rules = model.associationRules.where(F.array_join("consequent", " ") == "=block")
    rules = durable(rules.select(F.array_sort("antecedent").alias("tokens"), "confidence", "support").withColumn("rule", F.xxhash64("tokens")), "url-rules")
    forget(spark, items)
    return general(rules)


def general(rules: DataFrame) -> DataFrame:
    """Without the rules whose tokens, and the domains these imply, hold all those of another, at least as sure, rule."""
    listed = lambda tokens: rules.select("rule", F.size("tokens").alias("n"), "confidence", F.explode(tokens).alias("token"))
    of_domain = lambda t: F.transform(domains(F.substring(t, 3, 1 << 30)), lambda d: F.concat(F.lit("d:"), d))
    implied = F.array_distinct(F.flatten(F.transform("tokens", lambda t: F.when(F.startswith(t, F.lit("d:")), of_domain(t)).otherwise(F.array(t)))))
    small, large = listed("tokens").alias("a"), listed(implied).alias("b")
    pairs = small.join(large, (F.col("a.token") == F.col("b.token")) & (F.col("a.rule") != F.col("b.rule")) & (F.col("a.confidence") >= F.col("b.confidence")))
    covered = pairs.groupBy(F.col("a.rule").alias("by"), F.col("b.rule").alias("rule"), F.col("a.n").alias("n")).count().where("count = n").select("rule").distinct()
    return rules.join(covered, "rule", "left_anti").select("rule", "tokens", "confidence", "support")


def fires(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """The distinct urls (of a frame url, host, path) at which a mined rule fires, with the surest rule's confidence."""
    index = rules.select("rule", F.size("tokens").alias("n"), "confidence", F.explode("tokens").alias("token"))
    hits = urls.select("url", F.explode(url_tokens()).alias("token")).join(index, "token")
    return hits.groupBy("url", "rule", "n", "confidence").count().where("count = n").groupBy("url").agg(F.max("confidence").alias("confidence"))


def explicit(urls: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """url, rule, verdict of the longest explicit rule that fits, for the urls that one fits."""
    spark = urls.sparkSession
    if not rules:
        return urls.select("url", F.lit("").alias("rule"), F.lit("").alias("rule_verdict")).where("false")
    quote = lambda s: "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"
    table = spark.sql("SELECT * FROM VALUES " + ", ".join(f"({', '.join(map(quote, r))})" for r in rules) + " AS t(rule_verdict, rule_host, rule_path)")
    fits = urls.select("url", "path", F.explode(domains(F.col("host"))).alias("rule_host")).join(table, "rule_host").where(F.startswith("path", "rule_path"))
    name = F.concat("rule_host", "rule_path")
    best = F.max_by(F.struct(name.alias("rule"), F.col("rule_verdict")), F.struct(F.length(name), name, "rule_verdict"))
    return fits.groupBy("url").agg(best.alias("best")).select("url", "best.rule", "best.rule_verdict")


def judge(pages: DataFrame, mined: DataFrame, rules: list[tuple[str, str, str]], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict, confidence (of what was mined, where it fires)."""
    rows = parts(pages.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url")))
    urls = rows.where("host <> ''").select("url", "host", "path").distinct()
    known = urls.join(explicit(urls, rules), "url", "left").join(fires(urls, mined), "url", "left")
    verdict = F.coalesce("rule_verdict", F.when(F.col("confidence").isNotNull(), F.lit("block")).otherwise(F.lit("allow")))
    known = known.select(F.col("url").alias("_url"), "rule", verdict.alias("verdict"), "confidence")
    # urls without a host find nothing, so they need not meet in one task: their keys are like no url with a host
    key = F.when(F.col("host") != "", F.col("url")).otherwise(F.concat(F.lit("\0"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.spark_partition_id().cast("string")))
    out = rows.withColumn("_key", key).join(known, F.col("_key") == F.col("_url"), "left")
    return out.select("page_id", "host", "path", "rule", F.coalesce("verdict", F.lit("allow")).alias("verdict"), "confidence")


def held_out(url: str = "url") -> Column:
    """Urls that no rule is learnt from, to measure precision on: those whose first 32 bits of md5 are 1 mod 5."""
    return F.conv(F.substring(F.md5(F.col(url).cast("binary")), 1, 8), 16, 10).cast("long") % 5 == 1


def ruled(pages: DataFrame, rules: list[tuple[str, str, str]], url_col: str = "url") -> DataFrame:
    """Labelled urls (url, block): the distinct urls that an explicit rule decides, but for those held out.  What is mined
    from them carries the explicit rules' verdicts over to urls that none of them fits."""
    urls = parts(pages.select(F.col(f"`{url_col}`").cast("string").alias("url"))).where("host <> ''").select("url", "host", "path").distinct()
    return explicit(urls.where(~held_out()), rules).select("url", (F.col("rule_verdict") == "block").alias("block"))


def op8_url_filter(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return judge(pages, mine(spark, ruled(pages, RULES)), RULES)

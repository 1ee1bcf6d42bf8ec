"""URL filter: given rules first, then association rules mined from labelled URLs by FP-growth.

*Tokens.*  A URL is the set of its host labels (``h:``), their parts between hyphens (``w:``), its path
segments with every digit run as 0 (``p:``), the file ending (``e:``) and its query keys (``q:``).

*Mining.*  A labelled URL is a transaction of its frequent tokens and its label.  Tokens that occur in exactly the same labelled
rows are one item (two 64-bit sums over the rows' hashes name the set of rows), so a URL that very many rows share gives
one item and not all subsets of its tokens.  Spark's FP-growth finds the frequent item sets; the rules that lead to
``block`` are kept by support, confidence and lift.  A rule goes if one with an item less is as
confident: whatever matches it also matches that one, so no verdict of a URL changes.

*Matching.*  The inverted index holds each rule under its rarest token.  The distinct token sets of the undecided
URLs are exploded, meet the index by token, and keep the rules all of whose tokens they have; a URL with such a rule is
blocked, and the most confident one is named (ties: more support, then the smaller text).  The answer goes back to the rows by token
set; a set that very many rows share is answered by broadcast.  A URL that no rule matches is allowed.

Work and memory: FP-growth counts in all tasks.  The number of item sets is 2 ** k for a URL with k frequent items; an
item takes at least ``SUPPORT`` of the labelled rows.

Defined results: a null URL or one without ``://`` has the empty host and path and no tokens, and is allowed; null,
repeated and tied rows are judged alike, each row by itself; without labels every URL that no given rule decides is
allowed; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plinth.llm.graph import answer, written
from plinth.llm.text import small_side

#: (host, path, verdict) of the given rules.
RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"),
         ("com", "/de/", "block")]
#: Least share and least number of labelled rows of an item set, and least confidence and lift of a rule.
SUPPORT, LEAST_ROWS, CONFIDENCE, LIFT = 0.005, 5, 0.5, 1.0
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host (after the first ``://``, A-Z lower-cased) and the path up to a query or fragment."""
    rest = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1), F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def given_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule whose host is ``host`` or a parent of it and whose path begins ``path``; else nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def url_tokens(url: Column) -> Column:
    """The sorted distinct tokens of a URL."""
    host, path = host_and_path(url)
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)://[^?#]*\?([^#]*)", 1)
    parts = lambda text, cut: F.filter(F.split(text, cut), lambda x: x != "")
    marked = lambda mark, items: F.transform(items, lambda x: F.concat(F.lit(mark), x))
    words = F.filter(F.flatten(F.transform(parts(host, r"\."), lambda x: F.when(x.contains("-"), F.split(x, "-")).otherwise(F.array().cast("array<string>")))),
                     lambda x: x != "")
    ending = parts(F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1), ",")
    keys = F.filter(F.transform(parts(query, "&"), lambda x: F.regexp_extract(x, r"^([^=]*)", 1)), lambda x: x != "")
    masked = F.transform(parts(path, "/"), lambda x: F.regexp_replace(x, r"[0-9]+", "0"))
    return F.array_sort(F.array_distinct(F.concat(marked("h:", parts(host, r"\.")), marked("w:", words), marked("p:", masked),
                                                  marked("e:", ending), marked("q:", keys))))


def mine(labelled: DataFrame, support: float = SUPPORT, least: int = LEAST_ROWS, confidence: float = CONFIDENCE, lift: float = LIFT) -> DataFrame:
    """(rule, confidence, support, anchor) of the kept rules of (url, verdict): the tokens that lead to ``block``.

    ``support`` of a rule is the share of labelled rows that have its tokens and are to be blocked.
    """
    spark = labelled.sparkSession
    key = F.struct(F.monotonically_increasing_id(), "url", "verdict")
    rows = written(spark, labelled.where(F.col("verdict").isNotNull()).select(
        url_tokens(F.col("url")).alias("tokens"), "verdict", F.xxhash64(key).alias("one"), F.xxhash64(F.lit(1), key).alias("two")), "labelled-urls")
    total = rows.count()
    if not total:
        return spark.createDataFrame([], "rule array<string>, confidence double, support double, anchor string")
    share = max(support, least / total)
    wide = "decimal(38,0)"
    counts = (rows.select(F.explode("tokens").alias("token"), "one", "two").groupBy("token")
              .agg(F.count(F.lit(1)).alias("rows"), F.sum(F.col("one").cast(wide)).alias("one"), F.sum(F.col("two").cast(wide)).alias("two"))
              .where(F.col("rows") >= share * total))
    items = written(spark, counts.groupBy("rows", "one", "two").agg(F.array_sort(F.collect_list("token")).alias("tokens"))
                    .select(F.element_at("tokens", 1).alias("item"), "tokens", "rows"), "url-items")
    # rows without a frequent token count in the supports all the same
    label = F.concat(F.lit("v:"), F.col("verdict"))
    named = rows.select(label.alias("label"), "one", "two", F.explode(F.array_insert("tokens", 1, label)).alias("item"))
    used = items.select("item").unionByName(rows.select(label.alias("item")).distinct())
    known = written(spark, named.join(small_side(used), "item").groupBy("one", "two").agg(F.collect_list("item").alias("items")).select("items"),
                    "url-transactions")
    model = FPGrowth(itemsCol="items", minSupport=share, minConfidence=confidence).fit(known)
    found = written(spark, model.associationRules.where((F.element_at("consequent", 1) == "v:block") & (F.col("lift") > lift))
                    .select(F.array_sort("antecedent").alias("items"), "confidence", "support"), "url-rules")
    shorter = found.select(F.col("items").alias("less"), F.col("confidence").alias("as_good"))
    useless = (found.select("items", "confidence", F.explode("items").alias("x")).withColumn("less", F.array_remove("items", F.col("x")))
               .join(shorter, "less").where("as_good >= confidence").select("items").distinct())
    full = (found.join(useless, "items", "left_anti").select("*", F.explode("items").alias("item")).join(small_side(items), "item")
            .groupBy("items", "confidence", "support")
            .agg(F.array_sort(F.flatten(F.collect_list("tokens"))).alias("rule"), F.min(F.struct("rows", "item")).alias("rare")))
    return written(spark, full.select("rule", "confidence", "support", F.col("rare.item").alias("anchor")), "url-index")


def match(urls: DataFrame, index: DataFrame) -> DataFrame:
    """``urls`` with (mined_rule, confidence) of the most confident rule that a row's ``tokens`` match, or nulls."""
    spark = urls.sparkSession
    total = urls.count()
    sets = written(spark, urls.groupBy("tokens").agg(F.count(F.lit(1)).alias("size")), "url-sets")
    rank = F.struct((-F.col("confidence")).alias("worst"), (-F.col("support")).alias("rare"), F.array_join("rule", " ").alias("mined_rule"))
    best = (sets.select("tokens", "size", F.explode("tokens").alias("anchor")).join(small_side(index), "anchor")
            .where(F.size(F.array_except("rule", "tokens")) == 0).groupBy("tokens", "size").agg(F.min(rank).alias("best")))
    groups = sets.join(best, ["tokens", "size"], "left").select("tokens", "size", "best.mined_rule", (-F.col("best.worst")).alias("confidence"))
    return answer(urls, written(spark, groups, "url-verdicts"), ["tokens"], "size", total)


def judge(pages: DataFrame, labelled: DataFrame, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, mined_rule, confidence) of every row of (page_id, url).

    ``rule`` is the given rule that decides; otherwise ``mined_rule`` is the rule mined from ``labelled`` (url, verdict)
    that blocks the URL, if there is one.
    """
    index = mine(labelled)
    host, path = host_and_path(F.col("url"))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", host.alias("host"), path.alias("path"))
    rule, verdict = given_rule(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": rule, "verdict": verdict})
    rest = written(pages.sparkSession, rows.where("verdict is null").withColumn("tokens", url_tokens(F.col("url"))), "undecided-urls")
    mined = match(rest, index).withColumn("verdict", F.when(F.col("mined_rule").isNotNull(), "block").otherwise("allow"))
    out = ["page_id", "host", "path", "rule", "verdict"]
    given = rows.where("verdict is not null").select(*out, F.lit(None).cast("string").alias("mined_rule"), F.lit(None).cast("double").alias("confidence"))
    return given.unionByName(mined.select(*out, "mined_rule", "confidence"))


def labelled_urls(pages: DataFrame, labels: DataFrame, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """(url, verdict): the URLs that a given rule decides, and those whose path ends in the id of a labelled document,
    which is to be blocked if it is toxic or of quality 0."""
    host, path = host_and_path(F.col("url"))
    _, verdict = given_rule(host, path, rules)
    number = F.regexp_extract(path, r"/([0-9]{1,18})(?:\.[a-z]+)?/?$", 1).try_cast("long")
    bad = F.max((F.coalesce("quality", F.lit(1)) == 0) | (F.coalesce("toxic", F.lit(0)) == 1))
    marks = labels.where("quality is not null or toxic is not null").groupBy(F.col("doc_id").cast("long").alias("_doc")).agg(bad.alias("_bad"))
    named = pages.select("url", number.alias("_doc")).join(marks, "_doc").select("url", F.when(F.col("_bad"), "block").otherwise("allow").alias("verdict"))
    return pages.select("url", verdict.alias("verdict")).where("verdict is not null").unionByName(named)


def op11_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return judge(pages, labelled_urls(pages, spark.read.parquet(f"{sf_dir}/labels.parquet")))

"""URL filter by association rules (operator 7, native).

Given rules on host and path decide first.  For the other urls, Spark's
FP-growth mines combinations of url tokens from labelled pages, each labelled
transaction carrying its label as one more item.  A combination becomes a
blocking rule when enough labelled pages hold it (support), enough of these are
blocked (confidence), and no shorter rule inside it is at least as sure.  Rules
match through an inverted index: a rule is filed under its rarest token, a url
looks up its tokens, and the few rules found are checked in full.

FP-growth keeps the items above the support on the driver: at most (items per
url) / support of them, whatever the table's size.  The rule table joins by its
key token; Spark broadcasts it only when it has measured it as small.

Edge cases: a null url, or one without ``://``, has empty host and path, no
tokens, and is allowed; pages without a label only take part in matching; null
labels count as good; with no labels at all no rule is mined; rows are never
merged; only page_id and url are read.
"""

from __future__ import annotations

from collections.abc import Sequence
from string import ascii_lowercase, ascii_uppercase

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The contract's rules as (host, path, verdict).
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)

MIN_SUPPORT = 0.002      # share of labelled pages that hold the combination
MIN_PAGES = 10           # and at least so many of them
MIN_CONFIDENCE = 0.7     # share of these that are blocked
_BLOCK = "label=block"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def with_parts(pages: DataFrame) -> DataFrame:
    """Add host and path."""
    url = F.coalesce("url", F.lit(""))
    return pages.withColumns({
        "host": F.translate(F.regexp_extract(url, _PARTS, 1), ascii_uppercase, ascii_lowercase),
        "path": F.regexp_extract(url, _PARTS, 2),
    })


def given_rule(rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """A struct (size, rule, verdict) of the longest rule that fits host and path, or null."""
    if not rules:
        return F.lit(None).cast("struct<size: int, rule: string, verdict: string>")
    host, path = F.col("host"), F.col("path")
    fits = [F.when(((host == h) | host.endswith("." + h)) & path.startswith(p),
                   F.struct(F.lit(len(h + p)).alias("size"), F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")))
            for h, p, v in rules]
    return F.array_max(F.array(*fits))


def tokens(url: str = "url") -> Column:
    """Distinct tokens of a url: host labels, path parts, ending, query names, fragment."""
    def tagged(tag: str, parts: Column) -> Column:
        return F.transform(F.array_remove(parts, ""), lambda x: F.concat(F.lit(tag), x))

    text = F.coalesce(F.col(url), F.lit(""))
    query = F.regexp_extract(text, r"(?s)^.*?://[^?#]*\?([^#]*)", 1)
    ending = F.regexp_extract("path", r"\.([A-Za-z0-9]{1,8})/?$", 1)
    return F.array_distinct(F.concat(
        tagged("h:", F.split("host", r"\.")),
        tagged("p:", F.split("path", "/")),
        tagged("x:", F.array(ending)),
        tagged("q:", F.transform(F.split(query, "&"), lambda x: F.substring_index(x, "=", 1))),
        tagged("f:", F.array(F.regexp_extract(text, "(?s)#(.*)$", 1))),
    ))


def mine_rules(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE,
               min_pages: int = MIN_PAGES) -> DataFrame:
    """Blocking rules from rows (items array, blocked boolean).

    Returns key (the rule's rarest token), items (sorted) and confidence.
    """
    marked = labelled.select(F.when(F.col("blocked"), F.array_append("items", _BLOCK)).otherwise(F.col("items"))
                             .alias("items"))
    support = min(1.0, max(min_support, min_pages / max(1, marked.count())))
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=min_confidence).fit(marked)
    rules = (model.associationRules.where(F.col("consequent") == F.array(F.lit(_BLOCK)))
             .select(F.sort_array("antecedent").alias("items"), "confidence"))
    single = (model.freqItemsets.where("size(items) = 1")
              .select(F.col("items")[0].alias("item"), F.col("freq")))
    inner = rules.select(F.col("items").alias("part"), F.col("confidence").alias("sure"), F.col("items")[0].alias("item"))
    weak = (rules.select("items", "confidence", F.explode("items").alias("item")).join(inner, "item")
            .where((F.size("part") < F.size("items")) & (F.size(F.array_except("part", "items")) == 0)
                   & (F.col("sure") >= F.col("confidence"))).select("items").distinct())
    pruned = rules.join(weak, "items", "left_anti")
    return (pruned.select("items", "confidence", F.explode("items").alias("item")).join(single, "item")
            .groupBy("items").agg(F.min(F.struct("freq", "item"))["item"].alias("key"),
                                  F.max("confidence").alias("confidence")))


def judge(pages: DataFrame, labelled: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES,
          min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE,
          min_pages: int = MIN_PAGES) -> DataFrame:
    """page_id, host, path, rule and verdict of each page, and the confidence of the mined rule that blocked it.

    ``labelled`` has url and blocked.
    """
    train = with_parts(labelled.select("url", "blocked")).select(tokens().alias("items"), "blocked")
    mined = mine_rules(train.where("size(items) > 0"), min_support, min_confidence, min_pages)
    split = (with_parts(pages.select("page_id", "url"))
             .withColumn("given", given_rule(rules)))
    open_urls = split.where("given is null and url is not null").select("url", tokens().alias("own"))
    hits = (open_urls.select("url", "own", F.explode("own").alias("key")).join(mined, "key")
            .where(F.size(F.array_except("items", "own")) == 0)
            .groupBy("url").agg(F.max("confidence").alias("mined_confidence")))
    verdict = F.coalesce(F.col("given.verdict"),
                         F.when(F.col("mined_confidence").isNotNull(), F.lit("block")).otherwise(F.lit("allow")))
    return (split.join(hits, "url", "left")
            .select("page_id", "host", "path", F.col("given.rule").alias("rule"), verdict.alias("verdict"),
                    F.when(F.col("given").isNull(), F.col("mined_confidence")).alias("mined_confidence")))


def document_number() -> Column:
    """The doc_id that a page's url names: the path part after a two-letter language, else null."""
    return F.expr("try_cast(nullif(regexp_extract(path, '^/[a-z]{2}/([0-9]+)(?:[./]|$)', 1), '') as bigint)")


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages; a page is labelled by the row of ``labels`` of the document its url names, blocked if of low quality
    or toxic."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    labels = (spark.read.parquet(f"{sf_dir}/labels.parquet")
              .select("doc_id",
                      (F.coalesce(F.col("quality") == 0, F.lit(False)) | F.coalesce(F.col("toxic") == 1, F.lit(False)))
                      .alias("blocked")))
    named = with_parts(pages).select("url", document_number().alias("doc_id"))
    return judge(pages, named.join(labels, "doc_id").select("url", "blocked"))

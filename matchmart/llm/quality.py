"""Rule bitmask ledger for text quality (operator 9, native).

``ledger`` measures every text once and evaluates every rule of ``RULES``
once; bit *i* of ``failed`` says that rule *i* rejected the document.  Policies
are named, versioned masks over these bits, so a new policy, or an ablation
that leaves one rule out, reads the ledger and never the texts.

Everything is a column expression inside one row: no shuffle, no Python.  The
repeated 3-word windows of a text are found by sorting the hashes of its own
windows, and only texts that repeat one sort (hash, place) pairs.

Edge cases: a null text has no words and fails ``few_words``; an empty table
gives an empty ledger; rows are never merged, so repeated rows and repeated
doc_ids each keep their own entry; the row's own columns travel in one struct
``doc``, so no column name can clash.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_SPACE = r"[\x20\x09-\x0D]"
_SYMBOLS = "#*$%&|<>"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_letters", "n_upper")


@dataclass(frozen=True)
class Rule:
    """``fails`` takes a function from a measure's name to its column."""
    name: str
    fails: Callable[[Callable[[str], Column]], Column]


# The first two are the contract's base rules; the order of the
# list is the order of the bits and must only ever be appended to.
RULES: tuple[Rule, ...] = (
    Rule("few_words", lambda m: m("n_words") < 50),
    Rule("repeated_words", lambda m: 100 * m("n_repeat_words") > 50 * m("n_words")),
    Rule("symbols", lambda m: 10 * m("n_symbols") > m("n_words")),
    Rule("repeated_lines", lambda m: 10 * m("n_dup_lines") > 4 * m("n_lines")),
    Rule("upper_case", lambda m: 10 * m("n_upper") > 3 * m("n_letters")),
    Rule("no_letters", lambda m: 2 * m("n_letters") < m("word_chars")),
    Rule("long_words", lambda m: m("word_chars") > 25 * m("n_words")),
)


@dataclass(frozen=True)
class Policy:
    """A document is rejected when it fails one of the named rules."""
    name: str
    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(1 << i for i, rule in enumerate(RULES) if rule.name in self.rules)


POLICIES: tuple[Policy, ...] = (
    Policy("base", 1, ("few_words", "repeated_words")),
    Policy("prose", 1, ("few_words", "repeated_words", "symbols", "repeated_lines", "upper_case")),
    Policy("prose", 2, tuple(rule.name for rule in RULES)),
)
BASE, PRODUCTION = POLICIES[0], POLICIES[-1]


def _removed(text: Column, pattern: str) -> Column:
    """How many code points the pattern's matches have."""
    return (F.length(text) - F.length(F.regexp_replace(text, pattern, ""))).cast("long")


def ledger(docs: DataFrame) -> DataFrame:
    """One row per document: struct ``doc``, the measures, and ``failed`` (a bit per rule).

    The row leaves through a generator, because Spark would push a filter on it
    below all the projections and repeat them in the filter's condition.
    """
    t = F.col("t")
    counted = (
        docs.select(F.struct("*").alias("doc"), F.coalesce("text", F.lit("")).alias("t"))
        .select(
            "doc",
            F.array_remove(F.split(t, _SPACE + "+"), "").alias("words"),
            F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
            F.length(F.regexp_replace(t, _SPACE + "+", "")).cast("long").alias("word_chars"),
            (F.length(t) - F.length(F.translate(t, _SYMBOLS, ""))).cast("long").alias("n_symbols"),
            _removed(t, r"\p{L}+").alias("n_letters"),
            _removed(t, r"\p{Lu}+").alias("n_upper"),
        )
    )
    kept = ["doc", "word_chars", "n_symbols", "n_letters", "n_upper"]
    words = F.col("words")
    windows = counted.select(
        *kept,
        F.size("words").cast("long").alias("n_words"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.slice(F.transform(words, lambda x, i: F.xxhash64(x, F.get(words, i + 1), F.get(words, i + 2))),
                1, F.greatest(F.size(words) - 2, F.lit(0))).alias("h"),
    )
    kept += ["n_words", "n_lines", "n_dup_lines"]
    none = F.expr("cast(array() as array<struct<h: bigint, i: int>>)")
    pairs = windows.select(
        *kept,
        F.when(F.size(F.array_distinct("h")) < F.size("h"),
               F.sort_array(F.transform("h", lambda x, i: F.struct(x.alias("h"), i.alias("i")))))
        .otherwise(none).alias("pairs"))
    p = F.col("pairs")

    def same(x: Column, i: Column) -> Column:
        return F.coalesce(x["h"] == F.get(p, i)["h"], F.lit(False))

    places = pairs.select(*kept, F.sort_array(F.transform(
        F.filter(p, lambda x, i: same(x, i - 1) | same(x, i + 1)), lambda x: x["i"])).alias("places"))
    at = F.col("places")
    measured = places.select(*kept, F.aggregate(
        F.transform(at, lambda x, i: F.least(F.lit(3), x - F.coalesce(F.get(at, i - 1), x - 3)).cast("long")),
        F.lit(0).cast("long"), lambda a, b: a + b).alias("n_repeat_words"))
    bits = [F.when(rule.fails(F.col), F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long"))
            for i, rule in enumerate(RULES)]
    failed = bits[0]
    for bit in bits[1:]:
        failed = failed.bitwiseOR(bit)
    return measured.select(F.inline(F.array(F.struct("doc", *MEASURES, failed.alias("failed")))))


def rejected(policy: Policy, failed: str = "failed") -> Column:
    return F.col(failed).bitwiseAND(F.lit(policy.mask).cast("long")) != 0


def ablation(entries: DataFrame, policies: Sequence[Policy] = POLICIES) -> DataFrame:
    """For each policy and each of its rules, what the rule does and what would change without it.

    ``entries`` is a ledger (only ``failed`` is read).  Documents are first
    counted by their failure bits, so at most one row per combination of bits
    goes on.  Returns policy, version, rule, n_docs, n_rejected, n_failed (of
    this rule), n_alone (rejected by this rule only), n_kept_without.
    """
    counts = entries.groupBy("failed").agg(F.count("*").alias("n"))
    plans = [(p.name, p.version, rule.name, p.mask, 1 << i)
             for p in policies for i, rule in enumerate(RULES) if rule.name in p.rules]
    entry = F.explode(F.array(*[F.struct(F.lit(a).alias("policy"), F.lit(b).alias("version"), F.lit(c).alias("rule"),
                                         F.lit(d).cast("long").alias("mask"), F.lit(e).cast("long").alias("bit"))
                                for a, b, c, d, e in plans])).alias("e")
    hits = counts.select("failed", "n", entry).select(
        "e.*", "n", F.expr("failed & e.mask").alias("seen"))

    def total(condition: str) -> Column:
        return F.coalesce(F.sum(F.when(F.expr(condition), F.col("n"))), F.lit(0)).cast("long")

    return hits.groupBy("policy", "version", "rule").agg(
        F.sum("n").alias("n_docs"), total("seen <> 0").alias("n_rejected"), total("(seen & bit) <> 0").alias("n_failed"),
        total("seen = bit").alias("n_alone"), total("(seen & ~bit) = 0").alias("n_kept_without"))


def kept_documents(docs: DataFrame, policy: Policy = PRODUCTION) -> DataFrame:
    """The rows of ``docs`` that the policy keeps, with their own columns."""
    return ledger(docs).where(~rejected(policy)).select("doc.*")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger of all documents under the production policy."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return ledger(docs).select(
        F.col("doc.doc_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        rejected(BASE).alias("base_failed"), (~rejected(PRODUCTION)).alias("kept"), "failed")


OP9_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT doc_id, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls,
    length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
    length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols,
    length(t) - length(regexp_replace(t, '\p{L}+', '', 'g')) AS n_letters,
    length(t) - length(regexp_replace(t, '\p{Lu}+', '', 'g')) AS n_upper
  FROM t
), p AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 2], ' ') AS seq FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 2)) AS i FROM w)
), q AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, seq) AS n FROM p) WHERE n > 1
), r AS (
  SELECT doc_id, count(DISTINCT i + j) AS n_repeat_words FROM q, generate_series(0, 2) AS s(j) GROUP BY doc_id
), m AS (
  SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
    CAST(n_symbols AS BIGINT) AS n_symbols, CAST(len(ls) AS BIGINT) AS n_lines,
    CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words, n_letters, n_upper
  FROM w LEFT JOIN r ON w.doc_id = r.doc_id
), f AS (
  SELECT *, CAST(n_words < 50 AS BIGINT) + 2 * CAST(100 * n_repeat_words > 50 * n_words AS BIGINT)
    + 4 * CAST(10 * n_symbols > n_words AS BIGINT) + 8 * CAST(10 * n_dup_lines > 4 * n_lines AS BIGINT)
    + 16 * CAST(10 * n_upper > 3 * n_letters AS BIGINT) + 32 * CAST(2 * n_letters < word_chars AS BIGINT)
    + 64 * CAST(word_chars > 25 * n_words AS BIGINT) AS failed FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed & 3 <> 0 AS base_failed,
  failed = 0 AS kept, CAST(failed AS BIGINT) AS failed FROM f
"""

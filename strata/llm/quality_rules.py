"""Host-level quality rules, in built-in DataFrame functions only.

Every document is measured in its own row; rule failures are counted by host,
each host's failure rate is shrunk towards the corpus by a beta prior that is
fitted to all hosts, and the host's verdict is joined back to its documents. A host
with few documents stays near the corpus rate, so a handful of bad pages neither
condemns a small site nor a few good ones clear it.

A word is ``[^\\x20\\x09-\\x0D]+``. Rules of a document:

* short: fewer than 20 words (base)
* repeated: over 30 % of its words lie in 8-word windows that occur twice (base)
* symbols: symbols ``#*$%&|<>`` above a tenth of the characters in words
* lines: over half of its lines with a word equal an earlier line

With p the corpus rate of documents failing any rule, the prior's mean, a host is

* rejected when its shrunk rate is over halfway from p to 1: all its documents go
* trusted when its shrunk rate is below TRUST times p: a document of it that breaks a
  rule beyond the base ones (a table, a listing) is kept
* neither otherwise: documents that break any rule go

A document that breaks a base rule goes in any case.

Cases: null or blank text has no words, so it is rejected as short; a null host
is a host of its own; repeated rows are judged alike and all returned; an empty
table gives an empty result; columns of other names pass through the filter.
Texts are measured whole, however long; a document's measures stay in its row. Windows
are compared by 64-bit hashes within one document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.tables import free_name, saved

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
TRUST = 0.5
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_SPACES = " \t\n\x0b\f\r"
_SYMBOLS = "#*$%&|<>"
_EMPTY = "array<struct<gram:bigint,at:int>>"


def _without(text: Column, chars: str) -> Column:
    return F.length(F.translate(text, chars, ""))


def _covered(positions: Column) -> Column:
    """Words in windows that start at the (ascending) positions: each adds what
    lies beyond the window before it."""
    steps = F.transform(
        positions,
        lambda p, i: F.when(i == 0, F.lit(WINDOW)).otherwise(F.least(F.lit(WINDOW), p - F.get(positions, i - 1))),
    )
    return F.aggregate(steps, F.lit(0).cast("long"), lambda total, x: total + x.cast("long"))


def measured(docs: DataFrame, text_col: str, prefix: str = "") -> DataFrame:
    """docs with the measures and rule outcomes as columns ``prefix`` + name.

    Each step is generated from a one-element array: the optimizer moves neither
    projections nor filters through a generator, so no later step (a filter on a
    rule, say) can write out an array's expression again, let alone inside a
    lambda. Documents without a repeated window skip the sort.
    """
    c = lambda name: F.col(f"`{prefix}{name}`")
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    add = lambda df, **cols: df.select(
        "*", F.inline(F.array(F.struct(*[v.alias(prefix + k) for k, v in cols.items()])))
    )
    df = add(
        docs,
        words=F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != ""),
        lines=F.filter(F.split(text, "\n"), lambda x: _without(x, _SPACES) > 0),
        word_chars=_without(text, _SPACES).cast("long"),
        n_symbols=(F.length(text) - _without(text, _SYMBOLS)).cast("long"),
    )
    df = add(
        df,
        hashes=F.transform(c("words"), lambda w: F.xxhash64(w)),
        n_words=F.size(c("words")).cast("long"),
        n_lines=F.size(c("lines")).cast("long"),
        n_dup_lines=(F.size(c("lines")) - F.size(F.array_distinct(c("lines")))).cast("long"),
    )
    df = add(
        df,
        grams=F.when(
            c("n_words") > WINDOW,
            F.transform(
                F.sequence(F.lit(1), (c("n_words") - (WINDOW - 1)).cast("int")),
                lambda i: F.xxhash64(F.slice(c("hashes"), i, WINDOW)),
            ),
        ).otherwise(F.array().cast("array<bigint>")),
    )
    df = add(
        df,
        ranked=F.when(
            F.size(F.array_distinct(c("grams"))) < F.size(c("grams")),
            F.sort_array(F.transform(c("grams"), lambda g, i: F.struct(g.alias("gram"), i.alias("at")))),
        ).otherwise(F.array().cast(_EMPTY)),
    )
    near = lambda x, other: F.coalesce(F.get(c("ranked"), other)["gram"] == x["gram"], F.lit(False))
    df = add(
        df,
        twice=F.sort_array(
            F.transform(
                F.filter(c("ranked"), lambda x, i: F.when(i > 0, near(x, i - 1)).otherwise(False) | near(x, i + 1)),
                lambda x: x["at"],
            )
        ),
    )
    df = add(df, n_repeat_words=_covered(c("twice")))
    short = c("n_words") < MIN_WORDS
    repeated = c("n_repeat_words") * 100 > c("n_words") * MAX_REPEAT_PERCENT
    df = add(df, base_failed=short | repeated)
    failed = c("base_failed") | (c("n_symbols") * 10 > c("word_chars")) | (c("n_dup_lines") * 2 > c("n_lines"))
    return add(df, rule_failed=failed).drop(
        *[f"{prefix}{x}" for x in ("words", "lines", "hashes", "grams", "ranked", "twice")]
    )


def host_rates(rows: DataFrame) -> DataFrame:
    """rows(host, rule_failed) -> (host, n_docs, n_failed, rate, rejected, trusted).

    The prior's mean is the corpus rate p; its strength follows from the part of
    the variance between hosts that binomial noise does not explain (the
    analysis-of-variance estimate of the intra-host correlation).
    """
    counts = saved(
        rows.groupBy("host").agg(F.count("*").alias("n_docs"), F.sum(F.col("rule_failed").cast("long")).alias("n_failed")),
        "host-counts",
    )
    n, k = F.col("n_docs").cast("double"), F.col("n_failed").cast("double")
    hosts, docs, failed, squares, pairs = counts.agg(
        F.count("*"), F.sum("n_docs"), F.sum("n_failed"), F.sum(n * n), F.sum(k * k / n)
    ).first()
    p, strength = beta_prior(hosts, docs or 0, failed or 0, squares or 0.0, pairs or 0.0)
    rate = (k + p * strength) / (n + strength)
    return counts.withColumns({"rate": rate, "rejected": rate > (1 + p) / 2, "trusted": rate < TRUST * p})


def beta_prior(hosts: int, docs: int, failed: int, squares: float, pairs: float) -> tuple[float, float]:
    """(mean, strength) from the number of hosts, documents, failures, the sum of
    n squared and the sum of k * k / n over hosts."""
    if not docs:
        return 0.0, 1.0
    p = failed / docs
    noise = p * (1 - p)
    between = pairs - docs * p * p  # sum of n * (rate - p) ** 2
    spread = docs - squares / docs - (hosts - 1)
    rho = (between - (hosts - 1) * noise) / (spread * noise) if noise > 0 and spread > 0 else 0.0
    rho = min(0.999, max(0.001, rho))
    return p, 1 / rho - 1


def verdict(base_failed: Column, rule_failed: Column, rejected: Column, trusted: Column) -> Column:
    """Whether a document is kept."""
    return ~base_failed & ~rejected & (~rule_failed | trusted)


def judged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """One row per document: id, the measures, base_failed, kept, its host's rate."""
    own = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{host_col}`").alias("host"), F.col(f"`{text_col}`").alias("text")
    )
    rows = saved(measured(own, "text").drop("text"), "measures")
    hosts = host_rates(rows).select(F.col("host").alias("verdict_host"), "rate", "rejected", "trusted")
    return rows.join(hosts, F.col("host").eqNullSafe(F.col("verdict_host")), "left").select(
        "doc_id", *MEASURES, "base_failed",
        verdict(F.col("base_failed"), F.col("rule_failed"), F.col("rejected"), F.col("trusted")).alias("kept"),
        F.round("rate", 6).alias("host_rate"),
    )


def passing(docs: DataFrame, text_col: str = "text", host_col: str = "source") -> DataFrame:
    """docs without the rejected ones; same columns. Texts are measured twice, for the
    host rates and to filter: carrying them beside the first outcome took an executor's
    memory beyond its limit (see the README's figures)."""
    rows = measured(docs.select(F.col(f"`{host_col}`").alias("host"), F.col(f"`{text_col}`").alias("text")), "text")
    prefix = free_name([c[:2] for c in docs.columns], "q_")
    hosts = host_rates(rows.select("host", "rule_failed"))
    hosts = hosts.select(*[F.col(c).alias(f"{prefix}v_{c}") for c in ("host", "rejected", "trusted")])
    base_failed, rule_failed = F.col(f"`{prefix}base_failed`"), F.col(f"`{prefix}rule_failed`")
    own = measured(docs, text_col, prefix).where(~base_failed).select(*[f"`{c}`" for c in docs.columns], rule_failed)
    same = F.col(f"`{host_col}`").eqNullSafe(F.col(f"{prefix}v_host"))
    kept = verdict(F.lit(False), rule_failed, F.col(f"{prefix}v_rejected"), F.col(f"{prefix}v_trusted"))
    return own.join(hosts, same, "left").where(kept).select(*[f"`{c}`" for c in docs.columns])


ORACLE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT rid, doc_id, source, t,
    list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM d
), spots AS (
  SELECT rid, ws, unnest(range(1, len(ws) - 6)) AS i FROM w WHERE len(ws) >= 8
), g AS (
  SELECT rid, i, count(*) OVER (PARTITION BY rid, array_to_string(list_slice(ws, i, i + 7), ' ')) AS c FROM spots
), r AS (
  SELECT rid, count(DISTINCT i + j) AS n FROM (SELECT rid, i, unnest(range(0, 8)) AS j FROM g WHERE c > 1) GROUP BY rid
), f AS (
  SELECT w.rid, doc_id, source,
    len(ws)::BIGINT AS n_words,
    length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    len(ls) AS n_lines,
    (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
    coalesce(r.n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN r ON w.rid = r.rid
), b AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM f
), x AS (
  SELECT *, base_failed OR n_symbols * 10 > word_chars OR n_dup_lines * 2 > n_lines AS rule_failed FROM b
), h AS (
  SELECT source, count(*)::DOUBLE AS n, sum(rule_failed::INT)::DOUBLE AS k FROM x GROUP BY source
), s AS (
  SELECT count(*) AS hosts, sum(n) AS docs, sum(k) / sum(n) AS p, sum(n * n) AS squares, sum(k * k / n) AS pairs FROM h
), e AS (
  SELECT p, CASE WHEN p * (1 - p) > 0 AND docs - squares / docs - (hosts - 1) > 0
    THEN (pairs - docs * p * p - (hosts - 1) * p * (1 - p)) / ((docs - squares / docs - (hosts - 1)) * p * (1 - p))
    ELSE 0 END AS rho FROM s
), m AS (
  SELECT p, 1 / least(0.999::DOUBLE, greatest(0.001::DOUBLE, rho)) - 1 AS strength FROM e
), v AS (
  SELECT source, p, (k + p * strength) / (n + strength) AS rate FROM h, m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND rate <= (1 + p) / 2 AND (NOT rule_failed OR rate < 0.5 * p) AS kept, round(rate, 6) AS host_rate
FROM x JOIN v ON x.source IS NOT DISTINCT FROM v.source
"""

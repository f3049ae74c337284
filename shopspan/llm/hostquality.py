"""Quality rules on documents and on the hosts they come from, in DataFrame functions only.

Every document is measured and judged by base rules. Failures are then summed by host. A host's failure
rate is shrunk towards the rate of all hosts by a beta prior whose strength is fitted to how much hosts
differ, so a small host needs more evidence. Documents of hosts that mostly fail go as well.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopspan.sources.staging import staged

LEAST_WORDS = 20
#: Per cent of a document's words that may lie in repeated windows of REPEAT_WINDOW words.
MOST_REPEATED_PERCENT = 30
REPEAT_WINDOW = 8
#: Hosts with a larger shrunk failure rate lose all documents.
MOST_HOST_FAILURES = 0.5
#: Bounds of the prior's strength, in documents.
PRIOR_STRENGTH = (1.0, 1e6)
SYMBOLS = "[#*$%&|<>]"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the columns MEASURES (which replace columns of these names)."""
    names = [c for c in docs.columns if c not in MEASURES]
    body = F.coalesce(F.col(text), F.lit(""))
    # In Java's patterns \s is 0x20 and 0x09-0x0D, and \S any other character.
    parts = docs.withColumn("_words", F.filter(F.split(body, r"\s+"), lambda w: w != ""))
    many = F.size("_words") >= REPEAT_WINDOW
    parts = parts.withColumn("_windows", F.when(many, F.transform(
        F.sequence(F.lit(1), F.size("_words") - (REPEAT_WINDOW - 1)),
        lambda i: F.xxhash64(F.slice("_words", i, REPEAT_WINDOW)),
    )))
    parts = parts.withColumn("_ordered", F.when(
        F.size(F.array_distinct("_windows")) < F.size("_windows"),
        F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
    ))
    parts = parts.withColumn("_places", F.sort_array(F.transform(
        F.filter("_ordered", lambda x, k: (
            x["h"].eqNullSafe(F.get(F.col("_ordered"), k - 1)["h"]) | x["h"].eqNullSafe(F.get(F.col("_ordered"), k + 1)["h"])
        )),
        lambda x: x["i"],
    )))
    lines = F.filter(F.split(body, "\n"), lambda line: line.rlike(r"\S"))
    covered = F.aggregate(
        "_places", F.struct(F.lit(0).alias("words"), F.lit(0).alias("end")),
        lambda s, p: F.struct(
            (s["words"] + p + REPEAT_WINDOW - F.greatest(p, s["end"])).alias("words"), (p + REPEAT_WINDOW).alias("end")
        ),
        lambda s: s["words"],
    )
    return parts.select(
        *[F.col(c) for c in names],
        F.size("_words").cast("long").alias("n_words"),
        F.char_length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        (F.size(F.split(body, SYMBOLS)) - 1).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
    ).withColumn(
        "base_failed",
        (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")),
    )


def host_verdicts(judged: DataFrame, host: str = "source") -> DataFrame:
    """(host, documents, failures, shrunk_rate, host_failed) from rows with a host and base_failed."""
    hosts = staged(
        judged.where(F.col(host).isNotNull()).groupBy(F.col(host).alias("host"))
        .agg(F.count(F.lit(1)).alias("documents"), F.sum(F.col("base_failed").cast("long")).alias("failures")),
        "hosts",
    )
    rate = F.col("failures") / F.col("documents")
    total = hosts.agg(F.sum("documents").alias("n"), F.sum("failures").alias("f"), F.count(F.lit(1)).alias("hosts")).first()
    if not total["n"]:
        return hosts.select("*", F.lit(0.0).alias("shrunk_rate"), F.lit(False).alias("host_failed"))
    mean = total["f"] / total["n"]
    spread = hosts.agg(F.sum(F.col("documents") * (rate - mean) * (rate - mean)).alias("s")).first()["s"]
    between = (spread - total["hosts"] * mean * (1 - mean)) / total["n"]
    low, high = PRIOR_STRENGTH
    strength = min(max(mean * (1 - mean) / between - 1, low), high) if between > 0 else high
    shrunk = (F.col("failures") + mean * strength) / (F.col("documents") + strength)
    return hosts.select("*", shrunk.alias("shrunk_rate"), (shrunk > MOST_HOST_FAILURES).alias("host_failed"))


def judge(docs: DataFrame, host: str = "source") -> DataFrame:
    """Measures and verdicts of every row.

    Needs doc_id, text and the host column; other columns are not read. Returns doc_id, MEASURES,
    shrunk_rate of the host, and kept (neither the document nor its host failed). A null text has no words
    and fails; a document without host is judged alone; repeated rows count as documents each; null ids
    stay; rates at the limit pass. Empty table: empty result.

    Scale: one scan without shuffle measures; sums by host are combined per task first, so a host with a
    third of all rows is one row per task. Only measures, never texts, meet the host verdicts.
    """
    rows = measured(docs.select("doc_id", "text", F.col(host).alias("host"))).drop("text")
    rows = staged(rows, "measures")
    verdicts = host_verdicts(rows, "host").select("host", "shrunk_rate", "host_failed")
    return rows.join(verdicts, "host", "left").select(
        "doc_id", *MEASURES, "shrunk_rate",
        (~F.col("base_failed") & ~F.coalesce("host_failed", F.lit(False))).alias("kept"),
    )


def without_failures(docs: DataFrame, host: str = "source") -> DataFrame:
    """The rows of ``docs`` that :func:`judge` keeps, with their own columns.

    The base rules run twice, for the sums by host and for the filter: that costs less than a stored copy
    of all texts, and measures that the rules do not use are pruned from both passes.
    """
    whole = docs.select(F.struct("*").alias("row"), F.col("text").alias("body"), F.col(host).alias("host"))
    # The generator keeps the filter below from being pushed into the measures, which would repeat them.
    rows = measured(whole, "body").select("row", "host", F.explode(F.array("base_failed")).alias("base_failed"))
    bad = host_verdicts(rows, "host").where("host_failed").select("host")
    return rows.where("not base_failed").join(bad, "host", "left_anti").select("row.*")


ORACLE_SQL = r"""
WITH base AS (
  SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS body,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
  FROM documents
),
windows AS (
  SELECT rid, i, array_to_string(words[i:i + 7], chr(31)) AS win
  FROM (SELECT rid, words, unnest(range(1, len(words) - 6)) AS i FROM base WHERE len(words) >= 8)
),
twice AS (SELECT rid, i FROM windows QUALIFY count(*) OVER (PARTITION BY rid, win) > 1),
covered AS (
  SELECT rid, count(DISTINCT i + k) AS n FROM twice, (SELECT unnest(range(0, 8)) AS k) GROUP BY rid
),
lines AS (
  SELECT *, list_filter(string_split(body, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines FROM base
),
measures AS (
  SELECT l.doc_id, l.source, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(length(body) - length(regexp_replace(body, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words
  FROM lines l LEFT JOIN covered c USING (rid)
),
judged AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM measures
),
hosts AS (
  SELECT source, count(*) AS n, sum(CAST(base_failed AS INT)) AS f FROM judged WHERE source IS NOT NULL GROUP BY source
),
total AS (SELECT sum(f) / sum(n) AS mean, sum(n) AS n, count(*) AS hosts FROM hosts),
spread AS (SELECT (sum(h.n * (h.f / h.n - t.mean) ** 2) - any_value(t.hosts * t.mean * (1 - t.mean))) / any_value(t.n) AS between_hosts
           FROM hosts h, total t),
prior AS (
  SELECT mean, CASE WHEN between_hosts > 0 THEN least(greatest(mean * (1 - mean) / between_hosts - 1, 1.0), 1e6) ELSE 1e6 END AS k
  FROM total, spread
),
verdicts AS (SELECT source, (f + mean * k) / (n + k) AS shrunk_rate FROM hosts, prior)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce(shrunk_rate <= 0.5, TRUE) AS kept
FROM judged LEFT JOIN verdicts USING (source)
"""

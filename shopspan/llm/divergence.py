"""How the sources of a language differ in their words.

A CountVectorizer per language, with a least document frequency and no limit of the vocabulary, finds the terms that are kept. Occurrences
are summed per source, first within blocks of text, which gives one exact sparse count vector a source without a vector per document;
smoothed shares of those are compared between sources and with the language as a whole.

A term that two sources both lack has the same two shares everywhere, so a pair's sum is evaluated over entries only: the value of all
terms as if both lacked them, plus what each source's own terms change, plus what changes again where both have the term.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopspan.llm.importance import words_of
from shopspan.llm.words import lists, signed, text_blocks, word_hashes
from shopspan.sources.staging import new_staging_path, staged

LEAST_DOCUMENTS = 10
#: The largest integer: a vectorizer drops no term for want of room.
VOCABULARY = 2**31 - 1
#: A vocabulary passes the driver and is broadcast, so a vectorizer gets at most about as many distinct terms; a language with more is
#: dealt to several by the hash of the term.
TERMS_AT_ONCE = 2_000_000
TOP = 10
_SCALE = 1_000_000_000
#: Stands in every document, so that no fit is without a vocabulary. No term holds a space.
_ALWAYS = " "


#: Of all different terms, one in so many, picked by its hash, is counted exactly to tell how many there are.
_PICK = 512
#: Folders over which languages are dealt, so that a fit reads little but its own language.
_FOLDERS = 16

_LETTERS = np.zeros(256, dtype=bool)
_LETTERS[[*range(0x61, 0x7B), *range(0x80, 0x100)]] = True


#: Text whose words are summed at once, before Spark sums them.
_BLOCK_BYTES = 8 << 20
_TOKENS = "lang string, source string, terms array<string>, picked array<long>, counts array<long>, summed boolean"


def _tokens(batches):
    """Runs of letters A-Z, lower-cased, a-z, and characters outside ASCII; and the hashes of the picked ones.

    A document's row has each of its terms once. After the rows of a block's documents comes one for each of its groups, ``summed``: its different terms and their counts.
    """
    for rows, data, offsets in text_blocks(batches, "text", _BLOCK_BYTES):
        data, words = words_of(data, offsets, _LETTERS)
        ends = np.zeros(len(words.start) + 1, dtype=np.int32)
        np.cumsum(words.length, out=ends[1:])
        # The words are all there is between the other bytes, one after the other.
        letters = np.ascontiguousarray(data[_LETTERS[data]])
        terms = pa.StringArray.from_buffers(len(words.start), pa.py_buffer(ends), pa.py_buffer(letters))
        hashes = word_hashes(data, words)
        # Each document's different words once, with how often they stand in it.
        of_doc = np.repeat(np.arange(len(rows)), words.counts)
        entries, times = _different(hashes, of_doc)
        of_doc = of_doc[entries]
        at = entries[hashes[entries] % np.uint64(_PICK) == 0]
        doc_sizes = np.bincount(of_doc, minlength=len(rows))
        picked = np.bincount(np.repeat(np.arange(len(rows)), words.counts)[at], minlength=len(rows))
        yield _token_rows(rows, lists(terms.take(pa.array(entries)), doc_sizes), lists(signed(hashes[at]), picked), None)
        lang, source = (rows.column(c).dictionary_encode() for c in ("lang", "source"))
        place = lang.indices.to_numpy().astype(np.int64) * len(source.dictionary) + source.indices.to_numpy()
        _, first, group = np.unique(place, return_index=True, return_inverse=True)
        one, n = _different(hashes[entries], group[of_doc], times)
        sizes = np.bincount(group[of_doc[one]], minlength=len(first))
        yield _token_rows(rows.take(pa.array(first)), lists(terms.take(pa.array(entries[one])), sizes), None, lists(n, sizes))


def _different(hashes, owner, times=None):
    """Places of one each of the different hashes of every owner, in the order of owners, and how often they stand there."""
    order = np.argsort(hashes)
    # Small integers are sorted by radix.
    small = owner.astype(np.uint16) if len(owner) and owner.max() < 1 << 16 else owner
    order = order[np.argsort(small[order], kind="stable")]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (hashes[order[1:]] != hashes[order[:-1]]) | (owner[order[1:]] != owner[order[:-1]])
    starts = np.flatnonzero(new)
    if times is None:
        return order[starts], np.diff(starts, append=len(order))
    return order[starts], np.add.reduceat(times[order], starts) if len(starts) else times


def _token_rows(rows, terms, picked, counts):
    numbers = pa.list_(pa.int64())
    return pa.RecordBatch.from_arrays(
        [rows.column("lang"), rows.column("source"), terms, pa.nulls(len(rows), numbers) if picked is None else picked,
         pa.nulls(len(rows), numbers) if counts is None else counts, pa.array([counts is not None] * len(rows), pa.bool_())],
        ["lang", "source", "terms", "picked", "counts", "summed"],
    )


def _share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(1e9 (count + 2) / (total + 2 terms)), exact for every count; only counts beyond 8e9 need decimals."""
    places = total + 2 * terms
    large = F.call_function("div", (count + 2).cast("decimal(20,0)") * F.lit(_SCALE).cast("decimal(10,0)"), places.cast("decimal(20,0)"))
    return 1 + F.when(count < 8_000_000_000, F.call_function("div", (count + 2) * F.lit(_SCALE).cast("long"), places)).otherwise(large)


def _apart(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q)); below 2^63, as shares are at most 1e9 + 1."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def source_counts(docs: DataFrame, least_documents: int = LEAST_DOCUMENTS, terms_at_once: int = TERMS_AT_ONCE) -> tuple[DataFrame, DataFrame]:
    """(lang, source) of every group, and (lang, source, term, n) of every kept term that occurs in the group."""
    spark = docs.sparkSession
    texts = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    # Tokens are written once: every language is fitted and summed from them.
    path = new_staging_path(spark, "terms")
    folder = F.pmod(F.xxhash64("lang"), F.lit(_FOLDERS)).cast("int")
    texts.mapInArrow(_tokens, _TOKENS).withColumn("folder", folder).write.partitionBy("summed", "folder").parquet(path)
    written = spark.read.schema(_TOKENS + ", folder int").parquet(path)
    rows = written.where("not summed")
    groups = staged(rows.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("documents")), "groups")
    distinct = {
        r.lang: r.n * _PICK for r in rows.select("lang", F.explode_outer("picked").alias("term"))
        .groupBy("lang").agg(F.approx_count_distinct("term").alias("n")).collect()
    }
    kept, n_kept = [], 0
    for r in groups.groupBy("lang").agg(F.sum("documents").alias("documents")).orderBy("lang").collect():
        if r.documents < least_documents:
            continue
        of_lang = rows.where((F.col("folder") == F.pmod(F.xxhash64(F.lit(r.lang)), F.lit(_FOLDERS)).cast("int")) & (F.col("lang") == r.lang))
        shards = max(-(-distinct[r.lang] // terms_at_once), 1)
        for shard in range(shards):
            mine = F.col("terms") if shards == 1 else F.filter("terms", lambda t: F.pmod(F.xxhash64(t), F.lit(shards)) == shard)
            one = of_lang.select(F.concat(F.array(F.lit(_ALWAYS)), mine).alias("terms"))
            model = CountVectorizer(
                inputCol="terms", outputCol="vector", minDF=float(least_documents), vocabSize=VOCABULARY
            ).fit(one)
            n_kept += len(model.vocabulary)
            vocabulary = spark.createDataFrame([(t,) for t in model.vocabulary if t != _ALWAYS], "term string")
            kept.append(staged(vocabulary.select(F.lit(r.lang).alias("lang"), "term"), "vocabulary"))
    vocabularies = kept[0] if kept else spark.createDataFrame([], "lang string, term string")
    for part in kept[1:]:
        vocabularies = vocabularies.unionByName(part)
    # No larger than one vectorizer's vocabulary, the kept terms go to every task, and others are dropped before the shuffle.
    known = F.broadcast(vocabularies) if n_kept <= terms_at_once else vocabularies
    entries = written.where("summed").select("lang", "source", F.explode(F.arrays_zip("terms", "counts")).alias("e")).select(
        "lang", "source", F.col("e.terms").alias("term"), F.col("e.counts").alias("n")
    )
    summed = entries.join(known, ["lang", "term"]).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"))
    return groups.select("lang", "source"), staged(summed, "counts")


def divergence(docs: DataFrame, least_documents: int = LEAST_DOCUMENTS, top: int = TOP, terms_at_once: int = TERMS_AT_ONCE) -> DataFrame:
    """lang, source, part, item, value and rank: how far each source of a language is from the others, and by which terms.

    ``docs`` needs lang, source and text; other columns are not read; nulls count as ''. A language keeps the V terms that stand in
    ``least_documents`` of its documents or more. A source, as well as the language, gives a term with ``n`` occurrences among its N of
    kept terms the share p = 1 + floor(1e9 (n + 2) / (N + 2 V)). Two shares are floor((p - q)^2 / (p + q)) apart. Part ``pair``
    has every other source of the language, ``value`` summed over all kept terms (0 without any). Part ``term`` has the ``top`` terms that the
    source gives a larger share than the language does and that occur in it. Ranks count from 1 within lang, source and part, by falling value, then
    by item in UTF-8 order. Repeated rows count as often as they stand there. A language with one source has no pairs; one with
    fewer documents than ``least_documents`` keeps no term. An empty table gives an empty result.

    Scale: documents are read once and their tokens staged, by language. Occurrences are summed per block of text and per task before they
    are shuffled, so a hot source or term costs one row a task. Terms are told apart by 64-bit hashes within a block of eight megabytes. What passes the driver is one vocabulary of about ``terms_at_once`` terms at most. The join on terms pairs sources, not
    documents: a term meets at most as many pairs as the result has.
    """
    groups, counts = source_counts(docs, least_documents, terms_at_once)
    of_term = staged(counts.groupBy("lang", "term").agg(F.sum("n").alias("n")), "terms")
    langs = of_term.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("n").alias("total"))
    own = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    # One row per source: its total, and its share of a term that it lacks.
    sources = staged(
        groups.join(own, ["lang", "source"], "left").join(langs.select("lang", "terms"), "lang", "left")
        .select("lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("terms", F.lit(0)).alias("terms"))
        .withColumn("none", F.when(F.col("terms") > 0, _share(F.lit(0), F.col("total"), F.col("terms")))),
        "sources",
    )
    shares = staged(
        counts.join(sources, ["lang", "source"]).withColumn("p", _share(F.col("n"), F.col("total"), F.col("terms")))
        .select("lang", "source", "term", "n", "p", "none"),
        "shares",
    )
    return _pairs(sources, shares).unionByName(_terms(shares, of_term, langs, top))


def _pairs(sources: DataFrame, shares: DataFrame) -> DataFrame:
    left = sources.select("lang", "source", "terms", F.col("none").alias("p0"))
    right = sources.select("lang", F.col("source").alias("item"), F.col("none").alias("q0"))
    both_lack = _apart(F.col("p0"), F.col("q0"))
    pairs = left.join(right, "lang").where("source <> item").withColumn("base", both_lack)
    # What a source's terms change against a source without them; equal shares of a source count once, with their number.
    equal = shares.groupBy("lang", "source", "p").agg(F.count(F.lit(1)).alias("times"), F.first("none").alias("p0"))
    alone = (
        equal.join(right, "lang").where("source <> item").groupBy("lang", "source", "item")
        .agg(F.sum(F.col("times") * (_apart(F.col("p"), F.col("q0")) - both_lack)).alias("change"))
    )
    other = shares.select("lang", "term", F.col("source").alias("item"), F.col("p").alias("q"), F.col("none").alias("q0"))
    p, q, p0, q0 = (F.col(c) for c in ("p", "q", "p0", "q0"))
    met = (
        shares.select("lang", "term", "source", "p", F.col("none").alias("p0")).join(other, ["lang", "term"]).where("source < item")
        .groupBy("lang", "source", "item")
        .agg(F.sum(_apart(p, q) - _apart(p, q0) - _apart(p0, q) + _apart(p0, q0)).alias("change"))
    )
    turned = [F.col("lang"), F.col("item").alias("source"), F.col("source").alias("item"), F.col("change")]
    changes = (
        alone.unionByName(alone.select(*turned)).unionByName(met).unionByName(met.select(*turned))
        .groupBy("lang", "source", "item").agg(F.sum("change").alias("change"))
    )
    value = F.coalesce(F.col("terms") * F.col("base"), F.lit(0)) + F.coalesce("change", F.lit(0))
    ranks = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return pairs.join(changes, ["lang", "source", "item"], "left").select(
        "lang", "source", F.lit("pair").alias("part"), "item", value.cast("long").alias("value")
    ).withColumn("rank", F.row_number().over(ranks))


def _terms(shares: DataFrame, of_term: DataFrame, langs: DataFrame, top: int) -> DataFrame:
    lang_shares = of_term.join(langs, "lang").select("lang", "term", _share(F.col("n"), F.col("total"), F.col("terms")).alias("q"))
    larger = shares.join(lang_shares, ["lang", "term"]).where("p > q")
    # Spark keeps the first rows of a source within each task before it shuffles them.
    ranks = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return larger.select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _apart(F.col("p"), F.col("q")).alias("value")
    ).withColumn("rank", F.row_number().over(ranks)).where(F.col("rank") <= top)


#: The query, straight from the definitions.
ORACLE_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
),
groups AS (SELECT DISTINCT lang, source FROM docs),
said AS (SELECT rid, lang, source, unnest(terms) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS n FROM said GROUP BY lang, term HAVING count(DISTINCT rid) >= 10),
langs AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
counted AS (SELECT lang, source, term, count(*) AS n FROM said JOIN kept USING (lang, term) GROUP BY ALL),
filled AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, v, sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang, g.source) AS total
  FROM groups g JOIN kept k USING (lang) JOIN langs USING (lang) LEFT JOIN counted c USING (lang, source, term)
),
shares AS (
  SELECT lang, source, term, n, CAST(1 + (CAST(n AS HUGEINT) + 2) * 1000000000 // CAST(total + 2 * v AS HUGEINT) AS HUGEINT) AS p FROM filled
),
lang_shares AS (
  SELECT lang, term, CAST(1 + (CAST(n AS HUGEINT) + 2) * 1000000000 // CAST(total + 2 * v AS HUGEINT) AS HUGEINT) AS q
  FROM kept JOIN langs USING (lang)
),
summed AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN summed s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
),
top_terms AS (
  SELECT lang, source, 'term' AS part, term AS item, CAST((p - q) * (p - q) // (p + q) AS BIGINT) AS value
  FROM shares JOIN lang_shares USING (lang, term) WHERE n > 0 AND p > q
)
SELECT * FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM top_terms)
) WHERE part = 'pair' OR rank <= 10
"""

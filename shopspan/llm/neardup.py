"""Near-duplicate documents by min-max hashing.

Each document is a set of distinct word shingles. Under every permutation both the smallest and the
largest value are kept, so 128 hash evaluations give 256 signature values; each value matches with
probability equal to the Jaccard similarity, and the two of a permutation vary less together than two
independent minima. Consecutive values form bands.

Documents that share a band with another one fall into candidate groups. Inside a group every pair is
compared by signature, and pairs that may reach the similarity are confirmed on the full shingle sets.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopspan.llm.components import connected_components
from shopspan.llm.membership import may_be_in
from shopspan.llm.substring import text_key
from shopspan.llm.words import LOWER, Sequences, as_long, find_words, lists, mix, signed, text_blocks, word_hashes
from shopspan.sources.staging import staged

PERMUTATIONS = 128
VALUES = 2 * PERMUTATIONS
#: Bands are as wide as this probability, that a pair at the similarity shares none, allows.
MISSED = 1e-4
#: Bands that link texts first; what they join counts as one text in the other bands.
FIRST_BANDS = 4
#: Shingles in one block of a candidate group; larger groups are split and compared block against block.
BLOCK_SHINGLES = 1 << 21
#: Pairs below the similarity by this many standard deviations of the signature estimate are not confirmed.
DEVIATIONS = 5.5

_rng = np.random.default_rng(20240501)
_MULTIPLIERS = _rng.integers(0, 2**63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SECOND = np.uint64(0xC2B2AE3D27D4EB4F)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of every text, one after the other, and how many each has."""
    data = LOWER[data]
    words = find_words(data, offsets)
    counts = words.counts
    n = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    ends = np.cumsum(n)
    start = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(words.first[:-1] - (ends - n), n)
    stop = np.minimum(start + size, np.repeat(words.first[1:], n))
    shingles = Sequences(word_hashes(data, words)).of(start, stop) + (stop - start).astype(np.uint64)
    for a, b in zip((ends - n).tolist(), ends.tolist()):
        shingles[a:b].sort()
    new = np.ones(len(shingles), dtype=bool)
    new[1:] = shingles[1:] != shingles[:-1]
    new[(ends - n)[n > 0]] = True
    total = np.concatenate([[0], np.cumsum(new)])
    return shingles[new], total[ends] - total[ends - n]


def signatures(sets: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """One-byte minima and maxima of the non-empty sets, eight in a 64-bit word."""
    starts = (np.cumsum(counts) - counts)[counts > 0]
    out = np.empty((len(starts), VALUES), dtype=np.uint8)
    if len(starts):
        for k, a in enumerate(_MULTIPLIERS):
            v = sets * a
            out[:, k] = np.minimum.reduceat(v, starts) >> np.uint64(16)
            out[:, PERMUTATIONS + k] = np.maximum.reduceat(v, starts) >> np.uint64(16)
    return out.view(np.int64)


def _sketch(size: int):
    schema = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("n_shingles", pa.int64()), ("key1", pa.int64()),
                        ("key2", pa.int64()), ("values", pa.list_(pa.int64()))])

    def run(batches):
        for rows, data, offsets in text_blocks(batches, "text"):
            sets, n = shingle_sets(data, offsets, size)
            full = n > 0
            starts = (np.cumsum(n) - n)[full]
            keys = np.zeros((2, len(n)), dtype=np.uint64)
            if len(starts):
                keys[0, full] = np.add.reduceat(mix(sets), starts)
                keys[1, full] = np.add.reduceat(mix(sets * _SECOND), starts)
            values = signatures(sets, n)
            yield pa.RecordBatch.from_arrays(
                [as_long(rows.column("doc_id")), rows.column("text_key"), pa.array(n.astype(np.int64)), pa.array(signed(keys[0])),
                 pa.array(signed(keys[1])), lists(values.ravel(), np.where(full, values.shape[1], 0))],
                schema=schema)

    return run


def band_width(percent: int) -> int:
    """One-byte values in a band: as many as keep a pair at the similarity together, eight at most."""
    share = percent / 100
    return max(r for r in range(1, 9) if r == 1 or (1 - share**r) ** (VALUES // r) <= MISSED)


def _band_keys(width: int) -> list[Column]:
    """Bands of ``width`` bytes, cut natively out of the 64-bit words that hold the values."""
    keys = []
    for at in range(0, VALUES - width + 1, width):
        word, shift = divmod(8 * at, 64)
        key = F.shiftrightunsigned(F.col("values")[word], shift) if shift else F.col("values")[word]
        if shift + 8 * width > 64:
            key = key.bitwiseOR(F.shiftleft(F.col("values")[word + 1], 64 - shift))
        keys.append(key.bitwiseAND(F.lit((1 << 8 * width) - 1)) if width < 8 else key)
    return keys


def _linker(size: int, percent: int):
    share = percent / 100
    least = math.floor(VALUES * share - DEVIATIONS * math.sqrt(VALUES * share * (1 - share)))
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by("node")
        node = table.column("node").to_numpy()
        block = table.column("block").to_numpy()
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        values = pa.concat_arrays(table.column("values").chunks).flatten().to_numpy().view(np.uint8)
        values = values.reshape(len(node), VALUES)
        parts = [shingle_sets(d, o, size) for _, d, o in text_blocks(iter(table.select(["text"]).to_batches()), "text")]
        sets, n = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        start = np.cumsum(n) - n
        group = np.arange(len(node))
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        links = []
        for p in left.tolist():
            others = right[np.searchsorted(right, p) + 1:] if i == j else right
            others = others[group[others] != group[p]]
            others = others[(100 * np.minimum(n[others], n[p]) >= percent * np.maximum(n[others], n[p]))]
            if not len(others):
                continue
            others = others[(values[others] == values[p]).sum(axis=1) >= least]
            if not len(others):
                continue
            own = sets[start[p]: start[p] + n[p]]
            ends = np.cumsum(n[others])
            where = np.arange(ends[-1]) + np.repeat(start[others] - (ends - n[others]), n[others])
            theirs = sets[where]
            found = own[np.minimum(np.searchsorted(own, theirs), len(own) - 1)] == theirs
            shared = np.add.reduceat(found.astype(np.int64), ends - n[others])
            for q in others[100 * shared >= percent * (n[p] + n[others] - shared)].tolist():
                if group[q] != group[p]:
                    low, high = sorted((group[p], group[q]))
                    group[group == high] = low
        for q in np.flatnonzero(group != np.arange(len(node))).tolist():
            if node[group[q]] != node[q]:
                links.append((node[group[q]], node[q]))
        a, b = (np.array(x, dtype=np.int64) for x in (zip(*links) if links else ((), ())))
        return pa.Table.from_arrays([pa.array(a), pa.array(b)], schema=schema)

    return run


def _linked(shared: DataFrame) -> DataFrame:
    """(node, component) of the nodes that share a ``band`` with another one; each is linked to the band's smallest."""
    heads = shared.groupBy("band").agg(F.min("node").alias("a"), F.max("node").alias("z")).where("a < z")
    return connected_components(shared.join(heads.select("band", "a"), "band").select("a", F.col("node").alias("b")))


def _candidate_groups(firsts: DataFrame, percent: int) -> DataFrame:
    """(node, component) of all nodes that are linked by shared bands, the component being the smallest node.

    A few bands go first. They join most of a group of near copies, which in the other bands stands as its smallest node: there
    a large group has one row of a band and value, where its members would have one each and link to as many heads as there are bands.
    """
    # One number stands for a band's place and value: where two of them collide, the sets are compared in vain.
    bands = [F.xxhash64(F.lit(k), key) for k, key in enumerate(_band_keys(band_width(percent)))]
    joined = _linked(firsts.select("node", F.explode(F.array(*bands[:FIRST_BANDS])).alias("band")))
    rest = F.explode(F.array(*bands[FIRST_BANDS:])).alias("band")
    alone = firsts.join(joined, "node", "left_anti").select("node", rest)
    as_one = firsts.join(joined, "node").select(F.col("component").alias("node"), rest).distinct()
    again = _linked(alone.unionByName(as_one)).select(F.col("node").alias("component"), F.col("component").alias("smallest"))
    both = joined.join(again, "component", "full")
    return both.select(F.coalesce("node", "component").alias("node"), F.coalesce("smallest", "component").alias("component"))


def _classes(docs: DataFrame, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Sketches of all rows, each with a ``row`` number, and the classes of texts with equal shingle sets.

    A class has its key1, key2, n_shingles; its component's first row is ``first_row``, whose doc_id is
    ``component_id``. Rows with an id come before rows without, smaller ids, then smaller text keys first.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("text_key", text_key())
    sketches = staged(rows.mapInArrow(_sketch(words), (
        "doc_id long, text_key long, n_shingles long, key1 long, key2 long, values array<long>"
    )).withColumn("row", F.monotonically_increasing_id()), "minmax")
    keys = ["key1", "key2", "n_shingles"]
    first = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "text_key", "row")).alias("first")
    # Sorted, so that the smallest node of a component is its first class. Staged, as below, so that joins with it read
    # plain shuffles, whose hot keys (exact copies) Spark can split.
    equal = staged(
        sketches.where("n_shingles > 0").groupBy(*keys).agg(first).select(*keys, "first.*")
        .orderBy("nameless", "doc_id", "text_key").drop("nameless").withColumn("node", F.monotonically_increasing_id()),
        "sets",
    )
    firsts = staged(
        sketches.where("n_shingles > 0").select(*keys, "row", "values")
        .join(equal.select(*keys, "node", F.col("row").alias("first_row")), keys)
        .where("row = first_row").select("node", "n_shingles", "values"), "firsts",
    )
    groups = staged(_candidate_groups(firsts, percent).join(firsts, "node"), "groups")
    sizes = groups.groupBy("component").agg(
        F.ceil(F.sum("n_shingles") / F.lit(BLOCK_SHINGLES)).cast("int").alias("blocks")
    )
    wanted = groups.select("node").join(equal, "node").select(
        "node", F.col("doc_id").alias("first_id"), F.col("text_key").alias("first_key")
    )
    # Only texts of groups are dealt, but for a few that the filter cannot tell from them. A row that stands in the table
    # more than once gives its text once.
    texts = (
        rows.where(may_be_in(wanted.select("first_key"))(F.col("text_key"))).join(wanted, (rows.text_key == wanted.first_key) & rows.doc_id.eqNullSafe(wanted.first_id))
        .select("node", "text").dropDuplicates(["node"])
    )
    members = (
        groups.join(sizes, "component")
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .join(texts, "node")
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("component", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                "block", "node", "values", "text")
    )
    links = members.groupBy("component", "i", "j").applyInArrow(_linker(words, percent), "a long, b long")
    own = F.struct("doc_id", "row", "text_key")
    leaders = equal.select(F.col("node").alias("component"), own.alias("leader"))
    led = connected_components(links).join(leaders, "component").select("node", "leader")
    leader = F.coalesce("leader", own)
    return sketches, staged(equal.join(led, "node", "left").select(
        *keys, leader["doc_id"].alias("component_id"), leader["row"].alias("first_row"), leader["text_key"].alias("first_key")
    ), "classes")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """Classes of documents linked by shingle sets with a Jaccard similarity of ``percent`` or more.

    ``docs`` needs doc_id and text; other columns are not read. Returns, for every row,
    doc_id, n_shingles, component_id (smallest doc_id reachable over links, itself included) and kept
    (doc_id is that smallest one). Words are lower-cased in A-Z. A text with fewer words than a shingle
    is one shingle; null, empty and blank texts have none and stay alone. Rows are judged by their texts: those
    that repeat an id with another text may be in another class. A null doc_id never names a component: the
    row joins that of its equals and near copies with ids (not kept); of a component without any id, whose
    component_id is null, one row is kept. Ties do not arise: the smallest id decides. An empty table gives an
    empty result.

    Scale: texts with equal sets collapse before any pair is formed, each remaining one emits 32 to 42 band
    rows, and a band's documents link to its smallest node, so candidates grow with documents, never with pairs. What the
    first bands join counts once in the others, so near copies of one text have few links each.
    Groups are compared in tasks of bounded size that return only a spanning forest of confirmed links.
    A pair at exactly 85 % shares no band with probability (1 - 0.85^8)^32, about 4e-5 (at 90 %: 1e-8); for
    80 % bands are narrower: (1 - 0.8^6)^42, about 3e-6.
    """
    sketches, classes = _classes(docs, words, percent)
    return (
        sketches.join(classes, ["key1", "key2", "n_shingles"], "left")
        .withColumn("component_id", F.coalesce("component_id", "doc_id"))
        .withColumn("kept", F.expr("doc_id <=> component_id and (doc_id is not null or row = coalesce(first_row, row))"))
        .select("doc_id", "n_shingles", "component_id", "kept")
    )


def without_near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with the first row of every component, rows without id included.

    Rows with an id come first, the smallest id of all. Texts without words stay; a row that repeats an id with the
    same text stays once, and one that repeats it with another text is judged by that text.
    """
    sketches, classes = _classes(docs, words, percent)
    key = ["kept_id", "kept_null", "kept_key"]
    named = [F.coalesce("doc_id", F.lit(0)).alias(key[0]), F.col("doc_id").isNull().alias(key[1]), F.col("text_key").alias(key[2])]
    blank = sketches.where("n_shingles = 0").select(*named).distinct()
    first = classes.select(
        F.coalesce("component_id", F.lit(0)).alias(key[0]), F.col("component_id").isNull().alias(key[1]), F.col("first_key").alias(key[2])
    ).distinct()
    # Blank rows without id all stay; of others only one row of an id and text.
    several = sketches.where("n_shingles > 0 or doc_id is not null").select(*named).groupBy(*key).count().where("count > 1").drop("count")
    kept = staged(first.unionByName(blank).join(several.withColumn("several", F.lit(True)), key, "left"), "kept")
    # Rows whose text is no one's copy stay where they are; only the others, which may go, are dealt by their key.
    suspects = sketches.select(*named).join(kept.where("several is null"), key, "left_anti").select("kept_key")
    suspect = may_be_in(suspects)(text_key())
    place = _unused(docs, "key")
    rows = docs.where(suspect).withColumn(place, F.struct(
        F.coalesce(docs["doc_id"].cast("long"), F.lit(0)).alias("id"), docs["doc_id"].isNull().alias("null"), text_key().alias("text")
    ))
    joined = lambda of: rows.join(
        of.select(F.struct(F.col(key[0]).alias("id"), F.col(key[1]).alias("null"), F.col(key[2]).alias("text")).alias(place)), place, "left_semi"
    )
    once = joined(kept.where("several is null"))
    # Keyed anew, so that repeated rows are cut down within tasks before they are dealt again.
    again = _unused(docs, "again")
    repeated = joined(kept.where("several")).withColumn(again, F.col(place)["text"]).dropDuplicates([place, again]).drop(again)
    return docs.where(~suspect).unionByName(once.unionByName(repeated).drop(place))


def _unused(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` does not have."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


#: The query with three words and 85 %: sets of shingles, links by counting, closure of the links.
ORACLE_SQL = r"""
WITH RECURSIVE base AS (
  SELECT row_number() OVER () AS rid, doc_id, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
  FROM documents
),
shingles AS (
  SELECT DISTINCT rid, array_to_string(words[i:i + 2], ' ') AS s
  FROM (SELECT rid, words, unnest(range(1, greatest(len(words) - 1, 2))) AS i FROM base WHERE len(words) > 0)
),
sizes AS (SELECT rid, count(*) AS n FROM shingles GROUP BY rid),
shared AS (
  SELECT a.rid AS a, b.rid AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.rid < b.rid GROUP BY 1, 2
),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.rid = a JOIN sizes y ON y.rid = b
  WHERE 100 * shared.n >= 85 * (x.n + y.n - shared.n)
),
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reached AS (
  SELECT a, b FROM both_ways
  UNION
  SELECT r.a, l.b FROM reached r JOIN both_ways l ON l.a = r.b
),
lowest AS (SELECT a AS rid, min(doc_id) AS low FROM reached JOIN base ON rid = b GROUP BY a)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, coalesce(least(low, doc_id), doc_id) AS component_id,
       coalesce(least(low, doc_id), doc_id) = doc_id AS kept
FROM base LEFT JOIN sizes USING (rid) LEFT JOIN lowest USING (rid)
"""

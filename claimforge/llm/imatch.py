"""I-Match document fingerprints with randomised lexicons.

The lexicon is all terms of the corpus whose inverse document frequency lies in a band:
neither the words that every text has nor those of one text and its copies. A
fingerprint is one hash per randomised subset of the lexicon, taken over the sorted
distinct terms that the text has in that subset. Dense subsets tell apart texts that
differ in a word or two; sparse ones, which hold a few of a text's terms, still agree
when a part of the text was changed. The likeness of two fingerprints is the share of
equal hashes among the subsets in which either text has a term.

A large group of copies or near copies would push its own terms over the upper end of the
band. There, a document of such a group counts only as one over the size of the group: it
is found by the least hashes of its word triples, most of which near copies share.

A term in the band is in at least ``LEAST_SHARE`` of all documents, so the lexicon has at
most (distinct terms per document) / ``LEAST_SHARE`` terms however large the corpus is.
It reaches the tasks as a bit map of fixed size: a term outside that falls on a set bit
counts as a lexicon term, in all texts alike. Terms are 64-bit hashes throughout.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from claimforge.llm.shared import let, stored, table, text_or_empty

# Band of document shares: idf = -ln(share) between 2.3 and 5.3.
LEAST_SHARE, MOST_SHARE = 0.005, 0.1
MAP_BITS = 16
SEED = 4242
# Least hashes of a text's word triples; one is hot if this share of the documents have it,
# so at most SKETCH / HOT_SHARE are. A document weighs ONE if it is in no hot group.
SKETCH, HOT_SHARE, ONE = 8, 0.005, 1 << 20
BUCKETS = 256
# One subset of all terms, then some of every 8th, 32nd, 64th and 128th term.
SUBSETS = [0] + [3] * 3 + [5] * 6 + [6] * 6 + [7] * 8
# Ranges of documents in which each finds the next one.
RANGE_ROWS, MOST_RANGES = 5_000, 1_024


def term_hashes(text: Column) -> Column:
    """Hashes of the words of a text in order, lower-cased, without punctuation."""
    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda word: word != F.lit(""))
    return F.transform(words, lambda word: F.xxhash64(F.lit(SEED), word))


def terms(text: Column) -> Column:
    """Hashes of the distinct words of a text."""
    return F.array_distinct(term_hashes(text))


def sketch(text: Column) -> Column:
    """The least hashes of the word triples of a text, at least one; shorter ones end the text."""

    def least(hashes: Column) -> Column:
        triples = F.transform(hashes, lambda h, i: F.xxhash64(h, F.get(hashes, i + 1), F.get(hashes, i + 2)))
        return F.slice(F.sort_array(F.array_distinct(triples)), 1, SKETCH)

    found = let(term_hashes(text), least)
    return F.when(F.size(found) == 0, F.array(F.lit(0).cast("long"))).otherwise(found)


def hot_groups(docs: DataFrame, n: int) -> list[list[dict[str, int]]]:
    """Hashes of ``sketch`` that a large share of the ``n`` documents have, and how many, in buckets."""
    found = docs.select(F.explode(sketch(text_or_empty())).alias("h")).groupBy("h").agg(F.count(F.lit(1)).alias("c"))
    buckets: list[list[dict[str, int]]] = [[] for _ in range(BUCKETS)]
    for row in found.where(F.col("c") >= max(2, math.ceil(HOT_SHARE * n))).collect():
        buckets[row["h"] % BUCKETS].append({"h": row["h"], "c": row["c"]})
    return buckets


def lost_weight(text: Column, groups: list[list[dict[str, int]]]) -> Column:
    """What a document weighs less than ``ONE``: a group's size is one that half of its sketch has."""
    if not any(groups):
        return F.lit(0).cast("long")
    buckets = F.from_json(F.lit(json.dumps(groups)), "array<array<struct<h: bigint, c: bigint>>>")

    def size(h: Column) -> Column:
        bucket = F.get(buckets, F.pmod(h, F.lit(BUCKETS)).cast("int"))
        return F.coalesce(F.get(F.filter(bucket, lambda x: x["h"] == h), F.lit(0))["c"], F.lit(1).cast("long"))

    def middle(sizes: Column) -> Column:
        return F.get(sizes, F.floor((F.size(sizes) - 1) / 2).cast("int"))

    group = let(F.sort_array(F.transform(sketch(text), size), asc=False), middle)
    # Whole numbers, so that sums don't depend on their order.
    return F.lit(ONE) - F.floor(F.lit(ONE) / group).cast("long")


def lexicon_map(docs: DataFrame, least: float = LEAST_SHARE, most: float = MOST_SHARE) -> list[int]:
    """Bit map of the terms in the band, as 64-bit words; all documents are counted.

    ``least`` is a share of the rows, ``most`` one of the documents' weight, where a large
    group of copies or near copies counts about once. Document frequencies are pre-aggregated
    per task, then shuffled by term and stored. The driver receives the words of the map that have a
    bit, at most 2 ** (MAP_BITS - 6), and the hot groups.
    """
    text = text_or_empty()
    n = docs.count()
    groups = hot_groups(docs, n)
    # A null term per document sums up what all weigh less, in the same pass.
    every = F.concat(terms(text), F.array(F.lit(None).cast("long")))
    found = (
        # Two steps: beside the explode the weight would be computed for every term.
        docs.select(every.alias("terms"), lost_weight(text, groups).alias("lost"))
        .select(F.explode("terms").alias("term"), "lost")
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("df"), F.sum("lost").alias("lost"))
    )
    found = stored(found, "terms")
    all_lost = next((row.lost for row in found.where("term is null").collect()), 0)
    found = found.where("term is not null")
    weight = F.col("df") * F.lit(ONE) - F.col("lost")
    # A term of one document alone tells nothing, however small the corpus.
    band = found.where(
        (F.col("df") >= max(2, math.ceil(least * n))) & (weight <= max(2 * ONE, int(most * (n * ONE - all_lost))))
    )
    place = F.pmod(F.col("term"), F.lit(1 << MAP_BITS))
    words = (
        band.select(F.shiftright(place, 6).alias("word"), F.expr("shiftleft(1L, cast(pmod(term, 64L) as int))").alias("bit"))
        .groupBy("word")
        .agg(F.bit_or("bit").alias("bits"))
        .collect()
    )
    bits = [0] * (1 << (MAP_BITS - 6))
    for row in words:
        bits[row["word"]] = row["bits"]
    return bits


def fingerprint(text: Column, bits: list[int]) -> Column:
    """One hash per subset, null where the text has no term in it.

    A text without any lexicon term has the hash of the whole text in the first place.
    """
    # A folded constant; spelled as one text, not as thousands of literals.
    words = F.from_json(F.lit(str(bits)), "array<bigint>")

    def known(term: Column) -> Column:
        place = F.pmod(term, F.lit(1 << MAP_BITS))
        word = F.get(words, F.shiftright(place, 6).cast("int"))
        return F.bit_get(word, F.pmod(term, F.lit(64)).cast("int")) == 1

    def hashes(own: Column) -> Column:
        found = []
        for number, rate in enumerate(SUBSETS):
            # Each subset looks at other bits of a second hash.
            part = F.filter(own, _in_subset(7 * number % 57, rate)) if rate else own
            found.append(let(part, lambda p: F.when(F.size(p) > 0, F.xxhash64(p))))
        whole = F.when(F.size(own) == 0, F.xxhash64(F.lit(-1), text)).otherwise(found[0])
        return F.array(whole, *found[1:])

    own = F.transform(F.filter(terms(text), known), lambda term: F.xxhash64(F.lit(SEED + 1), term))
    return let(F.sort_array(own), hashes)


def _in_subset(start: int, count: int):
    """One term in 2 ** count: those with ``count`` zero bits from bit ``start`` on."""
    return lambda term: F.shiftrightunsigned(term, start).bitwiseAND(F.lit((1 << count) - 1)) == 0


def likeness(left: Column, right: Column) -> Column:
    """Equal hashes among the subsets where either has one, 0 to 1."""
    either = F.zip_with(left, right, lambda a, b: a.isNotNull() | b.isNotNull())
    equal = F.zip_with(left, right, lambda a, b: F.coalesce(a == b, F.lit(False)))
    count = F.size(F.filter(either, lambda x: x))
    return F.when(count == 0, F.lit(0.0)).otherwise(F.size(F.filter(equal, lambda x: x)) / count)


def spelled(hashes: Column) -> Column:
    """A fingerprint as text: hexadecimal hashes, empty between dashes where there is none."""
    return F.array_join(F.transform(hashes, lambda h: F.coalesce(F.lower(F.hex(h)), F.lit(""))), "-")


def with_next(docs: DataFrame, order: str, *carried: str) -> DataFrame:
    """``docs`` with ``next_<c>`` of the row that follows by ``order``; the first follows the last.

    Rows are ordered by ``order`` (null first), then by the first carried column. They are
    dealt into ranges of about ``RANGE_ROWS`` rows, at most ``MOST_RANGES``, by quantiles of
    the order; the first row of a range is also sent to the range before, so that no row
    needs any other range. Equal order values are split by a hash of the carried value.
    """
    tie = F.xxhash64(carried[0])
    # One number that orders rows like (order, tie) does, up to rounding.
    share = (tie / F.lit(2.0**64) + 0.5).cast("double")
    key = F.when(F.col(order).isNull(), F.lit(-2e19) + share * 1e19).otherwise(F.col(order).cast("double") + share)
    keys = docs.select(key.alias("key"))
    n = keys.count()
    ranges = max(1, min(MOST_RANGES, n // RANGE_ROWS))
    points = []
    if ranges > 1:
        shares = [i / ranges for i in range(1, ranges)]
        points = sorted(set(keys.select(F.percentile_approx("key", shares, 10_000)).first()[0]))
    # A struct keeps the columns of the rows apart from those that are added here.
    rows = docs.select(
        F.struct("*").alias("row"), F.struct(F.col(order).alias("at"), tie.alias("tie")).alias("place"),
        _range_of(key, points).alias("range"),
    )
    heads = rows.groupBy("range").agg(F.min("place").alias("head"))
    # At most MOST_RANGES rows; the range before the first is the last.
    alone = W.orderBy("range")
    last = F.max("range").over(W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    heads = heads.withColumn("before", F.coalesce(F.lag("range").over(alone), last))
    placed = rows.join(F.broadcast(heads), "range")
    at = F.array_compact(
        F.array(
            F.struct(F.col("range").alias("range"), F.lit(0).alias("guest")),
            F.when(
                F.col("place").eqNullSafe(F.col("head")), F.struct(F.col("before").alias("range"), F.lit(1).alias("guest"))
            ),
        )
    )
    placed = placed.select("row", "place", F.inline(at).alias("range", "guest"))
    follow = W.partitionBy("range").orderBy("guest", "place")
    added = {f"next_{c}": F.lead(F.col("row")[c]).over(follow) for c in carried}
    found = placed.select("row", "guest", *[value.alias(name) for name, value in added.items()])
    kept = [F.col("row")[c].alias(c) for c in docs.columns if c not in added]
    return found.where(F.col("guest") == 0).select(*kept, *added)


def _range_of(key: Column, points: list[float]) -> Column:
    """How many points are not above the key, in two short searches."""
    points = points or [math.inf]
    step = max(1, math.isqrt(len(points)))
    every = F.array(*[F.lit(p) for p in points])
    coarse = F.array(*[F.lit(p) for p in points[step - 1 :: step]])
    blocks = F.size(F.filter(coarse, lambda p: p <= key))
    return blocks * step + F.size(F.filter(F.slice(every, blocks * step + 1, step), lambda p: p <= key))


def fingerprints(docs: DataFrame, bits: list[int] | None = None) -> DataFrame:
    """``docs`` with ``hashes``, the fingerprint of each whole text.

    A null text counts as empty; empty texts have equal fingerprints, as all equal texts
    do. Repeated rows stay; an empty table gives an empty result; a column named
    ``hashes`` is replaced.
    """
    bits = lexicon_map(docs.select("text")) if bits is None else bits
    docs = docs.drop(*[name for name in docs.columns if name.lower() == "hashes"])
    return docs.withColumn("hashes", fingerprint(text_or_empty(), bits))


def op1_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", text_or_empty().alias("text"))
    bits = lexicon_map(docs)
    rows = with_next(fingerprints(docs, bits), "doc_id", "text", "hashes")
    size, half = F.length("text"), F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), size - half), F.substring("next_text", F.lit(1), half))
    rows = rows.select("doc_id", size.cast("long").alias("n_chars"), "hashes", "next_hashes", edited.alias("edited"))
    rows = rows.withColumn("edited_hashes", fingerprint(F.col("edited"), bits))
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        spelled(F.col("hashes")).alias("fingerprint"),
        spelled(F.col("edited_hashes")).alias("edited_fingerprint"),
        likeness(F.col("hashes"), F.col("edited_hashes")).alias("near_edited"),
        likeness(F.col("hashes"), F.col("next_hashes")).alias("near_next"),
    )

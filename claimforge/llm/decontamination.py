"""Removal of benchmark passages: n-gram windows of the test items found in documents.

The windows of all items (``n`` consecutive normalised words; a shorter item is one
window) and their sub-grams of up to four words are hash sets that are broadcast. Any
occurrence of an ``n``-word window covers a four-gram that starts at a multiple of
``n - 3``, so a document is scanned at every ``n - 3``-rd word only, for all its
length; nothing is missed. A document word sequence around a hit is then cut into
windows, which are compared with the items' as texts. Case is folded per word while
scanning, which can only add hits, and exactly (A-Z) when verifying.

All steps are DataFrame functions. A scan emits one marker row per document and one
row per hit; only hits are shuffled, by document.
"""

from __future__ import annotations

from functools import reduce
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimforge.llm.shared import let, stored, table, text_or_empty

WINDOW = 10
GRAM = 4
# Words and gaps of a text before its letters are folded.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
# Characters of windows, or bytes of grams, that go to every executor; beyond, rows are shuffled.
MOST_BROADCAST = 256 << 20


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, GAP), lambda word: word != F.lit(""))


def folded(text: Column) -> Column:
    """``text`` with A-Z in lower case, nothing else."""
    return F.translate(text, ascii_uppercase, ascii_lowercase)


def joined(words: Column, start: Column, length: int) -> Column:
    return F.array_join(F.slice(words, start + 1, F.lit(length)), " ")


def item_windows(benchmark: DataFrame, n: int = WINDOW) -> DataFrame:
    """``item, words, window``: the distinct windows of every item and their number of words.

    An item without words has none; a null id is an empty one; rows that repeat an id
    are one item.
    """
    # Two steps: a lambda must not compute the words again for every window.
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
        words_of(folded(text_or_empty())).alias("all"),
    ).where(F.size("all") > 0)

    def cut(words: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size(words) - n, F.lit(0)))
        return F.transform(starts, lambda at: joined(words, at, n))

    size = F.least(F.size("all"), F.lit(n)).alias("words")
    return items.select("item", size, F.explode(let(F.col("all"), cut)).alias("window")).distinct()


def gram_key(words: Column, at: Column, size: int) -> Column:
    return F.xxhash64(F.lit(size), *[F.lower(F.get(words, at + i)) for i in range(size)])


def window_grams(windows: DataFrame) -> DataFrame:
    """``key``: the distinct grams of the windows, of four words or of all if there are fewer."""

    def grams(size: int) -> DataFrame:
        own = windows.where(F.col("words") >= GRAM if size == GRAM else F.col("words") == size)

        def cut(words: Column) -> Column:
            return F.transform(F.sequence(F.lit(0), F.size(words) - size), lambda at: gram_key(words, at, size))

        return own.select(F.explode(let(F.split("window", " "), cut)).alias("key"))

    return reduce(DataFrame.unionByName, map(grams, range(1, GRAM + 1))).distinct()


def scan_steps(lengths: list[int]) -> dict[int, int]:
    """Gram size -> distance of the places to look at, for windows of these lengths."""
    steps = {size: 1 for size in lengths if size < GRAM}
    long = [size for size in lengths if size >= GRAM]
    return steps | ({GRAM: min(long) - GRAM + 1} if long else {})


def bounded(df: DataFrame, size: Column) -> DataFrame:
    """``df`` for a broadcast if it is small enough, else for a shuffle."""
    total = df.agg(F.sum(size)).first()[0] or 0
    return F.broadcast(df) if total <= MOST_BROADCAST else df


def scan(docs: DataFrame, windows: DataFrame, n: int = WINDOW, *columns: str) -> DataFrame:
    """One marker row (``at`` null) per document and one row per place where a gram is found.

    A marker has ``columns`` and ``n_words``; a hit has the words around it (``around``,
    from word ``from`` on) and the gram's place and size (``at``, ``gram``).
    """
    lengths = sorted(row.words for row in windows.select("words").distinct().collect())
    steps = scan_steps(lengths)
    base = docs.select(
        F.struct(*columns).alias("doc"),
        F.monotonically_increasing_id().alias("row"),
        words_of(text_or_empty()).alias("words"),
    )
    place = "struct<at:int,gram:int,key:bigint>"
    marker = F.array(F.lit(None).cast(place))

    def places(size: int, step: int) -> Column:
        last = F.size("words") - size
        at = F.when(last >= 0, F.sequence(F.lit(0), last, F.lit(step))).otherwise(F.array().cast("array<int>"))
        found = F.transform(at, lambda i: F.struct(i.alias("at"), F.lit(size).alias("gram"), gram_key(F.col("words"), i, size).alias("key")))
        return found.cast(f"array<{place}>")

    # ``words`` leaves this step as a column, so it is computed once per document.
    base = base.select("doc", "row", "words", F.concat(marker, *[places(*x) for x in steps.items()]).alias("places"))
    grams = bounded(window_grams(windows), F.lit(16)).withColumn("found", F.lit(True))
    rows = base.select("doc", "row", "words", F.explode("places").alias("p"))
    # A marker has some key of its own, so that markers don't meet where the join is a shuffle.
    key = F.coalesce("p.key", "row").alias("key")
    rows = rows.select("doc", "row", "words", "p.at", "p.gram", key).join(grams, "key", "left")
    first = F.greatest(F.col("at") + F.col("gram") - n, F.lit(0))
    mark = F.col("at").isNull()
    return rows.where(mark | F.col("found")).select(
        "row",
        F.when(mark, F.col("doc")).alias("doc"),
        F.size("words").cast("long").alias("n_words"),
        "at",
        "gram",
        F.when(~mark, first).alias("from"),
        F.when(~mark, F.slice("words", first + 1, F.col("at") + n - first)).alias("around"),
    )


def verified(hits: DataFrame, windows: DataFrame) -> DataFrame:
    """``row, hit, items``: per document the places of words inside a window, and the items.

    A document's places and items are as many as its words and the items at most.
    """
    lengths = sorted(row.words for row in windows.select("words").distinct().collect())
    text = F.transform("around", folded)

    def starts(size: int) -> Column:
        """The places at which a window that holds the gram may start."""
        low = F.greatest(F.col("at") + F.col("gram") - size, F.lit(0)) - F.col("from")
        high = F.least(F.col("at"), F.col("n_words").cast("int") - size) - F.col("from")
        usable = (high >= low) & (F.col("gram") == min(size, GRAM))
        places = F.when(usable, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda at: F.struct(at.alias("start"), F.lit(size).alias("words")))

    # Without items there is no row here, whatever the length.
    spans = F.concat(*map(starts, lengths or [1]))
    found = hits.select("row", "from", text.alias("around"), F.explode(spans).alias("s"))
    window = F.array_join(F.slice("around", F.col("s.start") + 1, F.col("s.words")), " ")
    found = found.select("row", (F.col("from") + F.col("s.start")).alias("start"), "s.words", window.alias("window"))
    known = bounded(windows, F.length("window"))
    hit = found.join(known, ["words", "window"]).groupBy("row").agg(
        F.collect_set(F.struct("start", "words")).alias("spans"), F.array_sort(F.collect_set("item")).alias("items")
    )
    inside = F.transform("spans", lambda s: F.sequence(s.start, s.start + s.words - 1))
    return hit.select("row", F.array_distinct(F.flatten(inside)).alias("hit"), "items")


def find(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, *columns: str) -> DataFrame:
    """``doc`` (a struct of ``columns``), ``n_words``, ``hit`` (places of hit words) and ``items``.

    One row per row of ``docs``, repeated rows included; a null or empty text has no
    words. An empty benchmark hits nothing. The words of one text are held in memory,
    a few times its size; nothing else grows with the length of a text but its hits.
    """
    windows = stored(item_windows(benchmark, n), "windows")
    rows = stored(scan(docs, windows, n, *columns), "scan")
    # Stored, so that a small set of hit documents is known to be small and broadcast.
    hit = stored(verified(rows.where("at is not null"), windows), "hits")
    markers = rows.where("at is null").select("row", "doc", "n_words")
    none = {"hit": "array<int>", "items": "array<string>"}
    filled = [F.coalesce(F.col(name), F.array().cast(kind)).alias(name) for name, kind in none.items()]
    return markers.join(hit, "row", "left").select("doc", "n_words", *filled)


def decontaminate(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, remove: str = "spans") -> DataFrame:
    """``docs`` without the passages of ``benchmark`` (or without the documents that have one).

    ``remove="spans"`` cuts every hit word with the gap after it out of the text, and
    ``"documents"`` drops the row. All other texts and columns stay as they are.
    """
    if remove not in ("spans", "documents"):
        raise ValueError(f"remove is spans or documents, not {remove!r}")
    found = find(docs, benchmark, n, *docs.columns)
    if remove == "documents":
        return found.where(F.size("hit") == 0).select("doc.*")
    text = F.col("doc.text")

    def without(parts: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(parts.words) - 1)
        kept = F.transform(
            F.array_except(places, F.col("hit")), lambda i: F.concat(F.get(parts.words, i), F.get(parts.gaps, i + 1))
        )
        return F.concat(F.get(parts.gaps, F.lit(0)), F.array_join(kept, ""))

    # As many gaps as words and one more: before the first word and after each.
    parts = F.struct(words_of(text).alias("words"), F.split(text, WORD).alias("gaps"))
    cleaned = F.when(F.size("hit") == 0, text).otherwise(let(parts, without))
    return found.select(*[cleaned.alias(name) if name == "text" else F.col("doc")[name].alias(name) for name in docs.columns])


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), WINDOW, "doc_id")
    return found.select(
        "doc.doc_id",
        "n_words",
        F.size("hit").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("hit") > 0).alias("contaminated"),
    )


_WORDS = (
    f"regexp_extract_all(translate(coalesce(text, ''), '{ascii_uppercase}', '{ascii_lowercase}'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)
OP12_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS id, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, w, least(len(w), {WINDOW}) AS n FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM b)),
hits AS (
  SELECT id, i, s.n, item_id
  FROM (SELECT id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM windows)) s
  JOIN windows ON windows.n = s.n AND win = array_to_string(w[i:i + s.n - 1], ' ')),
covered AS (
  SELECT id, count(DISTINCT p) AS n_hit FROM (SELECT id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY id),
items AS (
  SELECT id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT id, item_id::VARCHAR AS item FROM hits) GROUP BY id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (id) LEFT JOIN items USING (id)
"""

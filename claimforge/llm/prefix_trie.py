"""Conversations that share first turns, as a trie of prefixes, screened by a count-min sketch.

A prefix is named by 128 bits: the exclusive or of hashes of (place, role, text) over
its turns. That is a running fold, so a conversation of any length is folded in pieces.
All prefixes are counted in a count-min sketch of bounded size, whose cells only need to
tell one from more. An estimate of one proves that a prefix belongs to one conversation:
its node is complete where it stands, and so are all below it. Only prefixes with a
greater estimate are shuffled, by name, and grouped exactly.

Sums over subtrees need no walk from level to level. A node's smallest member stands for
it; a member that stands for a node stands for all its deeper ones too. So what a
conversation stands for is summed up once per conversation, and a node's subtree is the
sum over its members, less what its smallest member stands for above it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from claimforge.llm.shared import stored, table, text_or_empty

# A conversation takes its first turns, up to HEADS - 1, from the first of FAMILY ids.
FAMILY, HEADS = 5, 9
# Turns of a conversation that one window holds at most.
PIECE = 1 << 16
# Rows of the sketch and cells of each; beyond the most, more prefixes are grouped exactly.
SKETCH_ROWS, LEAST_CELLS, MOST_CELLS, SLICE = 3, 1 << 12, 1 << 24, 1 << 12
# Bytes of one piece of a node's list of ids.
CHUNK_BYTES = 1 << 20
# A parent with more than one child in so many is one of so many at most.
HEAVY = 1000
NOTHING = hashlib.sha256(b"").hexdigest()
NAME = ["d1", "d2"]
PARENT = ["p1", "p2"]


# Sequences ------------------------------------------------------------------


def numbered(conversations: DataFrame) -> DataFrame:
    """``conv_id, part, at, k1, k2, size``: every turn's content as two hashes, and its bytes.

    Turns are ordered by ``turn``, null first, then by their hashes; null roles and texts
    are empty. ``at`` counts from 0 within a conversation's rows of one range partition,
    so a conversation may fill many. Rows without a conv_id belong to no conversation.
    """
    content = [text_or_empty("role"), text_or_empty("text")]
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        *[F.xxhash64(F.lit(seed), *content).alias(f"k{seed}") for seed in (1, 2)],
        F.octet_length(content[1]).cast("long").alias("size"),
        # Splits rows that repeat one turn.
        F.monotonically_increasing_id().alias("id"),
    )
    order = ["conv_id", "turn", "k1", "k2", "id"]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "k1", "k2", "size")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, count = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            conv, n = batch.column(0).to_numpy(), batch.num_rows
            if not n:
                continue
            starts = np.flatnonzero(np.append(True, conv[1:] != conv[:-1]))
            lengths = np.diff(np.append(starts, n))
            at = np.arange(n) - np.repeat(starts, lengths)
            if conv[0] == last:
                at[: lengths[0]] += count
            last, count = conv[-1], at[-1] + 1
            yield pa.record_batch(
                [batch.column(0), pa.array(np.full(n, part)), pa.array(at), *batch.columns[1:]],
                names=["conv_id", "part", "at", "k1", "k2", "size"],
            )

    return stored(rows.mapInArrow(run, "conv_id long, part long, at long, k1 long, k2 long, size long"), "turns")


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The turns and the conversations (``conv_id, length``) after heads were exchanged.

    Conversation c gets the first h turns of c - c % 5 (all if it has fewer, none if it
    does not exist) and its own after the first h; h is crc32 of c in decimal, modulo 9.
    Turns are ``conv_id, depth, k1, k2, size, length``, depth counting from 1.
    """
    rows = numbered(conversations)
    before = W.partitionBy("conv_id").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    pieces = rows.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"))
    pieces = stored(pieces.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0))), "pieces")
    totals = pieces.groupBy("conv_id").agg(F.sum("n").alias("total"))
    family = F.col("conv_id") - F.col("conv_id") % FAMILY
    own = totals.withColumn("family", family).withColumn(
        "h", F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS
    )
    head = totals.select(F.col("conv_id").alias("family"), F.col("total").alias("head_total"))
    head = own.join(head, "family", "left").withColumn("head", F.least("h", F.coalesce("head_total", F.lit(0))))
    length = F.col("head") + F.greatest(F.col("total") - F.col("h"), F.lit(0))
    convs = stored(head.select("conv_id", "family", "h", "head", length.alias("length")), "conversations")
    # One row per conversation and range partition, so no conversation meets in one task.
    placed = rows.join(pieces.join(convs, "conv_id"), ["conv_id", "part"])
    placed = placed.withColumn("at", F.col("start") + F.col("at"))
    kept = placed.where(F.col("at") >= F.col("h")).select(
        "conv_id", (F.col("at") - F.col("h") + F.col("head") + 1).alias("depth"), "k1", "k2", "size", "length"
    )
    given = rows.join(pieces.where(F.col("conv_id") == family), ["conv_id", "part"])
    given = given.select(F.col("conv_id").alias("family"), (F.col("start") + F.col("at")).alias("at"), "k1", "k2", "size")
    given = given.where(F.col("at") < HEADS - 1).join(convs, "family").where(F.col("at") < F.col("h"))
    given = given.select("conv_id", (F.col("at") + 1).alias("depth"), "k1", "k2", "size", "length")
    return stored(kept.unionByName(given), "rebuilt"), convs.select("conv_id", "length")


def folded_before(rows: DataFrame, fold, combine, **values: Column) -> DataFrame:
    """``rows`` with the fold of each value over a conversation's rows of less depth (0 for none).

    Folded in pieces of ``PIECE`` depths, then over the pieces.
    """
    rows = rows.withColumn("piece", F.expr(f"depth div {PIECE}"))
    inside = W.partitionBy("conv_id", "piece").orderBy("depth").rowsBetween(W.unboundedPreceding, -1)
    across = W.partitionBy("conv_id").orderBy("piece").rowsBetween(W.unboundedPreceding, -1)
    totals = rows.groupBy("conv_id", "piece").agg(*[fold(value).alias(f"{name}_above") for name, value in values.items()])
    totals = totals.select(
        "conv_id", "piece", *[F.coalesce(fold(f"{name}_above").over(across), F.lit(0)).alias(f"{name}_above") for name in values]
    )
    near = {name: F.coalesce(fold(value).over(inside), F.lit(0)) for name, value in values.items()}
    rows = rows.withColumns(near).join(totals, ["conv_id", "piece"])
    both = {name: combine(F.col(name), F.col(f"{name}_above")) for name in values}
    return rows.withColumns(both).drop("piece", *totals.columns[2:])


def prefixes(turns: DataFrame) -> DataFrame:
    """``conv_id, depth, length, size`` with the names of the prefix and of its parent."""
    terms = {f"p{seed}": F.xxhash64(F.lit(seed), "depth", "k1", "k2") for seed in (1, 2)}
    found = folded_before(turns, F.bit_xor, Column.bitwiseXOR, **terms)
    names = [F.col(p).bitwiseXOR(term).alias(f"d{p[1]}") for p, term in terms.items()]
    return stored(found.select("conv_id", "depth", "length", "size", *names, *PARENT), "prefixes")


# Screening ------------------------------------------------------------------


def cells(d1: np.ndarray, d2: np.ndarray, row: int, width: int) -> np.ndarray:
    name = d1.astype(np.uint64) + np.uint64(row) * (d2.astype(np.uint64) | np.uint64(1))
    # The high bits take part, so that the rows differ in more than a shift.
    return ((name ^ (name >> np.uint64(32))) & np.uint64(width - 1)).astype(np.int64)


def sketch_of(rows: DataFrame, width: int) -> np.ndarray:
    """Bits of the cells that count more than one prefix, per row of the sketch.

    Tasks count 0, 1, more in ``SKETCH_ROWS * width`` bytes and send slices of them;
    slices are added up one at a time. The driver gets ``SKETCH_ROWS * width`` bits.
    """
    slice_ = min(SLICE, width)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((SKETCH_ROWS, width), np.uint8)
        for batch in batches:
            d1, d2 = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for row in range(SKETCH_ROWS):
                found, n = np.unique(cells(d1, d2, row, width), return_counts=True)
                counts[row, found] = np.minimum(counts[row, found] + n, 2)
        slices = counts.reshape(-1, slice_)
        used = np.flatnonzero(slices.any(axis=1))
        for at in range(0, len(used), 256):
            some = used[at : at + 256]
            yield pa.record_batch([pa.array(some), pa.array([x.tobytes() for x in slices[some]])], names=["place", "data"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, total = None, None

        def bits() -> pa.RecordBatch:
            return pa.record_batch([pa.array([place]), pa.array([np.packbits(total > 1).tobytes()])], names=["place", "data"])

        for batch in batches:
            for at, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if at != place:
                    if place is not None:
                        yield bits()
                    place, total = at, np.zeros(slice_, np.uint8)
                total = np.minimum(total + np.frombuffer(data, np.uint8), 2)
        if place is not None:
            yield bits()

    kind = "place long, data binary"
    slices = rows.select(*NAME).mapInArrow(count, kind).repartition("place").sortWithinPartitions("place")
    out = np.zeros((SKETCH_ROWS * width // slice_, slice_ // 8), np.uint8)
    for row in slices.mapInArrow(add, kind).collect():
        out[row.place] = np.frombuffer(row.data, np.uint8)
    return out.reshape(SKETCH_ROWS, width // 8)


def screened(rows: DataFrame) -> DataFrame:
    """``rows`` with ``single`` and ``parent_single``: proven to be of one conversation.

    The sketch has two cells per prefix or more, up to ``MOST_CELLS`` in a row.
    """
    width = LEAST_CELLS
    total = rows.count()
    while width < min(2 * total, MOST_CELLS):
        width *= 2
    sketch = rows.sparkSession.sparkContext.broadcast(sketch_of(rows, width))

    def single(bits: np.ndarray, d1: np.ndarray, d2: np.ndarray) -> np.ndarray:
        proven = np.zeros(len(d1), bool)
        for row in range(SKETCH_ROWS):
            at = cells(d1, d2, row, width)
            proven |= bits[row, at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1 == 0
        return proven

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = sketch.value
        for batch in batches:
            columns = {name: batch.column(name) for name in batch.schema.names}
            names = {name: columns[name].to_numpy() for name in (*NAME, *PARENT)}
            # The root is everybody's parent.
            deep = columns["depth"].to_numpy() > 1
            columns["single"] = pa.array(single(bits, names["d1"], names["d2"]))
            columns["parent_single"] = pa.array(single(bits, names["p1"], names["p2"]) & deep)
            yield pa.record_batch(list(columns.values()), names=list(columns))

    kind = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    return stored(rows.mapInArrow(run, f"{kind}, single boolean, parent_single boolean"), "screened")


# Nodes ----------------------------------------------------------------------


def id_digests(members: DataFrame) -> DataFrame:
    """Per name the SHA-256 of its conv_ids in decimal, ascending, comma-joined.

    Many tasks write the list in pieces, also of one name; the digest of one name then
    reads its pieces in order, holding one at a time.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, first, ids, held = None, None, [], 0

        def flush() -> pa.RecordBatch:
            rows = [[x] for x in (*name, first, ",".join(ids))]
            return pa.record_batch([pa.array(x) for x in rows], names=[*NAME, "first", "ids"])

        for batch in batches:
            for *own, conv_id in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if own != name or held > CHUNK_BYTES:
                    if ids:
                        yield flush()
                    name, first, ids, held = own, conv_id, [], 0
                ids.append(str(conv_id))
                held += len(ids[-1]) + 1
        if ids:
            yield flush()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, state, out = None, None, []
        for batch in batches:
            for *own, _, ids in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if own == name:
                    state.update(b",")
                else:
                    if name is not None:
                        out.append((*name, state.hexdigest()))
                    name, state = own, hashlib.sha256()
                state.update(ids.encode())
            if len(out) > 1000:
                yield pa.record_batch([pa.array(x) for x in zip(*out, strict=True)], names=[*NAME, "ends"])
                out = []
        if name is not None:
            out.append((*name, state.hexdigest()))
            yield pa.record_batch([pa.array(x) for x in zip(*out, strict=True)], names=[*NAME, "ends"])

    order = [*NAME, "conv_id"]
    pieces = members.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    pieces = pieces.mapInArrow(write, "d1 long, d2 long, first long, ids string")
    pieces = pieces.repartition(*NAME).sortWithinPartitions(*NAME, "first")
    return pieces.mapInArrow(digest, "d1 long, d2 long, ends string")


def with_parents(rows: DataFrame, children: DataFrame, members: DataFrame) -> DataFrame:
    """``rows`` with ``parent_conv_id``, the smallest member of their parent.

    Parents with many children, fewer than ``HEAVY`` of them, are broadcast, and their
    children keep out of each other's way in the join of the others: all would meet in
    one task. A parent that was not grouped is of one conversation: the row's own.
    """
    spark = rows.sparkSession
    total = children.agg(F.sum("n_children")).first()[0] or 0
    heavy = children.where(F.col("n_children") * HEAVY > total).select(*NAME).collect()
    names = members.select(F.col("d1").alias("p1"), F.col("d2").alias("p2"), "parent")
    if not heavy:
        found = rows.join(names, PARENT, "left").withColumn("parent_conv_id", F.coalesce("parent", "conv_id"))
        return found.drop("parent")
    few = F.broadcast(spark.createDataFrame(heavy, "p1 long, p2 long"))
    known = names.join(few, PARENT).select(*PARENT, F.col("parent").alias("known")).collect()
    known = F.broadcast(spark.createDataFrame(known, "p1 long, p2 long, known long"))
    own = F.when(F.col("known").isNull(), F.col("p1")).otherwise(F.xxhash64("conv_id", "depth")).alias("p1")
    placed = rows.join(known, PARENT, "left").select(*[own if c == "p1" else c for c in rows.columns], "known")
    found = placed.join(names, PARENT, "left")
    return found.withColumn("parent_conv_id", F.coalesce("known", "parent", "conv_id")).drop("parent", "known")


def nodes(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """The trie's nodes from ``turns`` and ``convs`` as ``rebuilt`` returns them.

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (null at the root),
    ``n_convs``, ``n_children``, ``n_leaves`` and ``saved_tokens`` (over the subtree) and
    ``ends_sha256``. Equal conversations share all nodes; conversations without turns
    belong to the root only; without conversations there is no node.
    """
    spark = turns.sparkSession
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n")).first()
    rows = screened(prefixes(turns))
    shared, alone = rows.where("not single"), rows.where("single")
    smallest = [F.min(name).alias(name) for name in ("conv_id", "depth", "size", *PARENT)]
    found = stored(shared.groupBy(*NAME).agg(F.count(F.lit(1)).alias("n_convs"), *smallest), "shared")

    entered = alone.where("not parent_single")
    children = found.select(*PARENT).unionByName(entered.select(*PARENT)).groupBy(*PARENT)
    children = stored(children.agg(F.count(F.lit(1)).alias("n_children")), "children")
    at_root = children.where("p1 = 0 and p2 = 0").first()
    kept = children.select(F.col("p1").alias("d1"), F.col("p2").alias("d2"), "n_children")
    saving = (F.col("n_convs") - 1) * F.col("size")
    found = found.join(kept, NAME, "left").na.fill(0, ["n_children"]).withColumn("saving", saving)
    found = stored(folded_before(found, F.sum, Column.__add__, above=F.col("saving")), "shared")

    # What each conversation stands for: its savings, and the leaf at its end.
    zero = F.lit(0).cast("long")
    stands = found.select("conv_id", "saving", (F.col("n_children") == 0).cast("long").alias("leaf"))
    stands = stands.unionByName(
        alone.where("depth = length").select("conv_id", zero.alias("saving"), (zero + 1).alias("leaf"))
    )
    stands = stored(stands.groupBy("conv_id").agg(F.sum("saving").alias("saving"), F.sum("leaf").alias("leaf")), "stands")
    total = stands.agg(F.sum("saving").alias("saving"), F.sum("leaf").alias("leaf")).first()
    below = shared.select("conv_id", *NAME).join(stands, "conv_id").groupBy(*NAME)
    below = below.agg(F.sum("saving").alias("sum_saving"), F.sum("leaf").alias("n_leaves"))

    ending = shared.where("depth = length").select(*NAME, "conv_id")
    turnless = convs.where("length = 0").select(zero.alias("d1"), zero.alias("d2"), "conv_id")
    ends = stored(id_digests(ending.unionByName(turnless)), "ends")
    root_ends = ends.where("d1 = 0 and d2 = 0").first()

    smallest_member = found.select(*NAME, F.col("conv_id").alias("parent"))
    found = found.join(below, NAME, "left").join(ends, NAME, "left").select(
        "conv_id", "depth", *PARENT, "n_convs", "n_children",
        F.coalesce("n_leaves", zero).alias("n_leaves"),
        (F.coalesce("sum_saving", zero) - F.col("above")).alias("saved_tokens"),
        F.coalesce("ends", F.lit(NOTHING)).alias("ends_sha256"),
    )
    end = F.when(F.col("depth") == F.col("length"), F.sha2(F.col("conv_id").cast("string").cast("binary"), 256))
    single = alone.select(
        "conv_id", "depth", *PARENT, "parent_single", (zero + 1).alias("n_convs"),
        (F.col("depth") < F.col("length")).cast("long").alias("n_children"), (zero + 1).alias("n_leaves"),
        zero.alias("saved_tokens"), F.coalesce(end, F.lit(NOTHING)).alias("ends_sha256"),
    )
    inner = single.where("parent_single").drop("parent_single").withColumn("parent_conv_id", F.col("conv_id"))
    outer = found.unionByName(single.where("not parent_single").drop("parent_single"))
    top = outer.where("depth = 1").withColumn("parent_conv_id", F.lit(root.conv_id).cast("long"))
    deep = with_parents(outer.where("depth > 1"), kept, smallest_member)
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    n_children = at_root.n_children if at_root else 0
    first = [] if root.conv_id is None else [
        (root.conv_id, 0, None, root.n, n_children, (total.leaf or 0) if n_children else 1, total.saving or 0,
         root_ends.ends if root_ends else NOTHING)
    ]
    kind = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
    parts = [spark.createDataFrame(first, kind), inner, top, deep]
    return parts[0].unionByName(parts[1].select(*columns)).unionByName(parts[2].select(*columns)).unionByName(parts[3].select(*columns))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nodes(*rebuilt(table(spark, sf_dir, "conversations")))


# Turns of one conversation have different numbers here, so their order among equals is not spelled out.
OP13_SQL = f"""
WITH t AS (
  SELECT conv_id, [coalesce(role, ''), coalesce(text, '')] AS said,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS i
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, list(said ORDER BY i) AS own FROM t GROUP BY conv_id),
h AS (
  SELECT *, xor(4294967295::BIGINT, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ord(x)::BIGINT)),
    lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)),
      lambda v, k: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384::BIGINT) ELSE v // 2 END))) % {HEADS} AS h
  FROM c),
r AS (
  SELECT a.conv_id, list_concat(coalesce(b.own[1:a.h], []), a.own[a.h + 1:]) AS s
  FROM h a LEFT JOIN h b ON b.conv_id = a.conv_id - a.conv_id % {FAMILY}),
p AS (
  SELECT conv_id, depth, len(s) AS length, s[1:depth] AS path, s[1:depth - 1] AS above, strlen(s[depth][2]) AS size
  FROM (SELECT *, unnest(range(0, len(s) + 1)) AS depth FROM r)),
n AS (
  SELECT depth, path, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(above) AS above,
         coalesce(any_value(size), 0) AS size,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE length = depth), '')) AS ends
  FROM p GROUP BY depth, path),
k AS (
  SELECT n.*, u.conv_id AS parent_conv_id FROM n LEFT JOIN n u ON u.depth = n.depth - 1 AND u.path = n.above),
m AS (
  SELECT k.*, coalesce(n_children, 0) AS n_children
  FROM k LEFT JOIN (SELECT depth - 1 AS depth, parent_conv_id AS conv_id, count(*) AS n_children
                    FROM k WHERE depth > 0 GROUP BY ALL) USING (depth, conv_id)),
subtree AS (
  SELECT p.depth, p.path, count(*) FILTER (WHERE m.n_children = 0) AS n_leaves,
         sum((m.n_convs - 1) * m.size)::BIGINT AS saved_tokens
  FROM m JOIN p ON p.conv_id = m.conv_id AND p.depth <= m.depth GROUP BY p.depth, p.path)
SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends AS ends_sha256
FROM m JOIN subtree USING (depth, path)
"""

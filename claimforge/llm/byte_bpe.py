"""Byte-level BPE encoding and decoding around one global shuffle of distinct words.

1. Documents are split by the tokenizer's pattern, a block of documents at a time. A
   block explodes into one row per distinct word of it, numbered by first occurrence;
   where a word stands is kept as one array of word numbers per document. So a word
   that is everywhere makes one row per block, not one per occurrence. Arrays and words
   are written to a table bucketed by block.
2. All (place, word) rows, a place being block and number, are shuffled and sorted by
   word: equal words of all blocks are neighbours in one task, which encodes each
   distinct word once.
3. The ids join their block's arrays, which lie bucketed and are not moved, and every
   document is put together by position.
4. Decoding replaces ids by the bytes of the vocabulary's token table.

Rows of a block, never of the corpus, meet in one task.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimforge.llm.shared import arrow_batches, table
from claimforge.session import scratch_dir

# Characters of a block; a longer document is a block of its own.
BLOCK_CHARS = 32 << 20
# A place is 63 bits: the partition, the block in it, the word or document in the block. More
# of any is an error, not a mixed-up text.
PART_BITS, PART_BLOCK_BITS, PLACE_BITS = 20, 15, 28
DOCUMENT, WORD = 0, 1
BYTES, DIGESTS = ("ids", "decoded"), ("ids_sha256", "decoded_sha256")
SPLIT = "kind int, block long, place long, id long, data binary"
CODED = "block long, items binary, sizes binary, ids binary"
# Encoded words that a task holds before it hands them on.
HELD_WORDS = 1 << 21


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: base64 of a token's bytes and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def pack(codes: np.ndarray) -> bytes:
    """32-bit numbers as four byte planes, which compress well when numbers are small."""
    return np.ascontiguousarray(codes, "<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def unpack(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(4, -1).T.copy().view("<u4").ravel()


def gather(codes: np.ndarray, starts: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The slices ``values[starts[c]:starts[c + 1]]`` of all codes, one after the other."""
    sizes = starts[codes + 1] - starts[codes]
    ends = np.cumsum(sizes)
    if not len(ends) or not ends[-1]:
        return values[:0]
    shift = starts[codes] - (ends - sizes)
    return values[np.repeat(shift, sizes) + np.arange(ends[-1])]


def offsets(sizes) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(np.fromiter(sizes, np.int64))))


def split_words(docs: DataFrame, pattern: str, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``row, text`` to the rows of ``SPLIT``: documents with word numbers, and words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        find = regex.compile(pattern).findall
        schema = pa.schema([("kind", pa.int32()), ("block", pa.int64()), ("place", pa.int64()),
                            ("id", pa.int64()), ("data", pa.binary())])
        part = TaskContext.get().partitionId()
        first = block = part << PART_BLOCK_BITS
        if part >> PART_BITS:
            raise ValueError(f"more than {1 << PART_BITS} partitions of documents")

        def flush(ids: list, codes: list, numbers: dict) -> pa.RecordBatch:
            n, m = len(ids), len(numbers)
            if block - first >> PART_BLOCK_BITS or max(n, m) >> PLACE_BITS:
                raise ValueError("a partition has too many blocks, or a block too many words, to number them")
            return pa.record_batch(
                [
                    pa.array(np.repeat(np.int32([DOCUMENT, WORD]), [n, m])),
                    pa.array(np.full(n + m, block)),
                    pa.array((block << PLACE_BITS) + np.concatenate((np.arange(n), np.arange(m)))),
                    pa.array(ids + [None] * m, pa.int64()),
                    pa.array(codes + [word.encode() for word in numbers], pa.binary()),
                ],
                schema=schema,
            )

        ids, codes, numbers, chars = [], [], {}, 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py() or ""
                if ids and chars + len(text) > block_chars:
                    yield flush(ids, codes, numbers)
                    ids, codes, numbers, chars, block = [], [], {}, 0, block + 1
                words = find(text)
                for word in words:
                    if word not in numbers:
                        numbers[word] = len(numbers)
                ids.append(doc_id)
                codes.append(pack(np.fromiter(map(numbers.__getitem__, words), np.uint32, len(words))))
                chars += len(text)
        if ids:
            yield flush(ids, codes, numbers)

    return docs.mapInArrow(run, SPLIT)


def encode_words(words: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """``place, data`` to rows of ``CODED``: per block some word numbers and their ids.

    Each distinct word is encoded once: its rows are neighbours.
    """
    shared = words.sparkSession.sparkContext.broadcast(ranks)

    def by_block(places: list, which: list, codes: list) -> pa.RecordBatch:
        places = np.concatenate(places)
        order = np.argsort(places)
        places, which = places[order], np.array(which)[order]
        starts, values = offsets(map(len, codes)), np.fromiter(itertools.chain.from_iterable(codes), np.uint32)
        blocks, first = np.unique(places >> PLACE_BITS, return_index=True)
        rows = []
        for block, a, b in zip(blocks, first, [*first[1:], len(places)], strict=True):
            items, own = places[a:b] & (1 << PLACE_BITS) - 1, which[a:b]
            steps, sizes = np.diff(items, prepend=0), np.diff(starts)[own]
            rows.append((block, pack(steps), pack(sizes), pack(gather(own, starts, values))))
        columns = zip(*rows, strict=True)
        kinds = (pa.int64(), pa.binary(), pa.binary(), pa.binary())
        return pa.record_batch(
            [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)],
            names=["block", "items", "sizes", "ids"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _piece_encoder(shared.value, pattern)
        last, places, which, codes = None, [], [], []
        for batch in batches:
            for word in batch.column(1).to_pylist():
                if word != last or not codes:
                    last = word
                    codes.append(encode(word))
                which.append(len(codes) - 1)
            places.append(batch.column(0).to_numpy())
            if len(which) >= HELD_WORDS:
                yield by_block(places, which, codes)
                places, which, codes = [], [], []
        if which:
            yield by_block(places, which, codes)

    return words.repartition("data").sortWithinPartitions("data").mapInArrow(run, CODED)


def _piece_encoder(ranks: dict[bytes, int], pattern: str) -> Callable[[bytes], list[int]]:
    import tiktoken

    encoding = tiktoken.Encoding("given", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return encoding._encode_single_piece


def assemble(
    split: DataFrame,
    coded: DataFrame,
    finish: Callable[[pa.Array, pa.Array], dict[str, pa.Array]] | None = None,
    schema: str = "doc_id long, ids binary",
) -> DataFrame:
    """``doc_id, ids`` (little-endian 32-bit) of every document, block by block.

    ``finish`` may turn a block's ids and documents into other columns in the same task;
    a further Python step would need a second worker beside this one.
    """

    def run(docs: pa.Table, words: pa.Table) -> pa.Table:
        items = [np.cumsum(unpack(x), dtype=np.int64) for x in words["items"].to_pylist()]
        order = np.argsort(np.concatenate([*items, np.empty(0, np.int64)]))
        sizes = np.concatenate([*map(unpack, words["sizes"].to_pylist()), np.empty(0, np.uint32)])
        values = np.concatenate([*map(unpack, words["ids"].to_pylist()), np.empty(0, np.uint32)])
        values = gather(order, offsets(sizes), values)
        starts = offsets(sizes[order])
        codes = docs["data"].to_pylist()
        ids = [gather(unpack(x).astype(np.int64), starts, values).astype("<u4").tobytes() for x in codes]
        doc_ids, ids = docs["id"].combine_chunks(), pa.array(ids, pa.binary())
        return pa.table(finish(doc_ids, ids) if finish else {"doc_id": doc_ids, "ids": ids})

    docs = split.where(F.col("kind") == DOCUMENT).select("block", "id", "data").groupBy("block")
    return docs.cogroup(coded.groupBy("block")).applyInArrow(run, schema)


def encode(
    docs: DataFrame, ranks: dict[bytes, int], pattern: str, block_chars: int = BLOCK_CHARS
) -> DataFrame:
    """``doc_id, ids`` for every row of ``docs`` (``doc_id, text``, other columns are ignored).

    A null or empty text gives no ids; null and repeated doc_ids give a row each; an
    empty table gives an empty result. Ids are little-endian unsigned 32-bit integers.
    Each match of ``pattern`` is encoded by ``ranks`` alone; there are no special tokens.
    """
    return assemble(*_coded_blocks(docs, ranks, pattern, block_chars))


def _coded_blocks(
    docs: DataFrame, ranks: dict[bytes, int], pattern: str, block_chars: int
) -> tuple[DataFrame, DataFrame]:
    """The stored blocks, and their words' ids."""
    spark = docs.sparkSession
    path = scratch_dir(spark, "bpe")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    split = split_words(docs.select(F.col("doc_id").cast("long"), "text"), pattern, block_chars)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    write = split.write.option("compression", "zstd").option("path", path).partitionBy("kind")
    with arrow_batches(spark, 1000):
        write.bucketBy(buckets, "block").saveAsTable(name)
    split = spark.table(name)
    words = split.where(F.col("kind") == WORD).select("place", "data")
    return split, encode_words(words, ranks, pattern)


def token_table(ranks: dict[bytes, int]) -> tuple[np.ndarray, bytes]:
    """Where each id's bytes begin, and the bytes of all ids; as large as the vocabulary."""
    tokens = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    return offsets(map(len, tokens)), b"".join(tokens)


def _decoded(
    doc_ids: pa.Array, ids: pa.Array, tokens: tuple[np.ndarray, bytes], digests: bool
) -> dict[str, pa.Array]:
    """Columns of ``decode`` for some documents."""
    starts, blob = tokens[0], np.frombuffer(tokens[1], np.uint8)
    counts, first, second = [], [], []
    for data in ids:
        data = data.as_py() or b""
        decoded = gather(np.frombuffer(data, "<u4").astype(np.int64), starts, blob).tobytes()
        counts.append(len(data) // 4)
        first.append(hashlib.sha256(data).hexdigest() if digests else data)
        second.append(hashlib.sha256(decoded).hexdigest() if digests else decoded)
    kind, names = (pa.string(), DIGESTS) if digests else (pa.binary(), BYTES)
    columns = doc_ids, pa.array(counts, pa.int64()), pa.array(first, kind), pa.array(second, kind)
    return dict(zip(["doc_id", "n_tokens", *names], columns, strict=True))


def decode(encoded: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """``doc_id, ids`` with ``n_tokens`` and ``decoded`` bytes.

    The token-byte table is the vocabulary, whose size does not depend on the data: it
    is broadcast, and a batch of ids is looked up in it at once. An id that the table
    doesn't have is an error.
    """
    shared = encoded.sparkSession.sparkContext.broadcast(token_table(ranks))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = _decoded(batch.column(0), batch.column(1), shared.value, False)
            yield pa.record_batch(list(columns.values()), names=list(columns))

    return encoded.mapInArrow(run, "doc_id long, n_tokens long, ids binary, decoded binary")


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded_digests(table(spark, sf_dir, "documents"))


def encoded_digests(docs: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``doc_id, n_tokens`` and the digests of each row's ids and of the bytes they decode to."""
    import public_tokenizers

    ranks = read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    shared = docs.sparkSession.sparkContext.broadcast(token_table(ranks))
    blocks = _coded_blocks(docs, ranks, public_tokenizers.PATTERN, block_chars)
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return assemble(*blocks, lambda doc_ids, ids: _decoded(doc_ids, ids, shared.value, True), schema)

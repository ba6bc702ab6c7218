"""Token ids in patched frame-of-reference files.

A file holds the ids of consecutive documents in blocks of 128: a block keeps its
minimum, the differences from it packed at the width that holds nine tenths of them,
and a list of exceptions (place and difference) for the others. The starts of all
blocks are indexed, so a reader unpacks only the blocks it needs.

Documents are put in ascending doc_id order by range; every range task writes its
files as rows of a Parquet table (``part, file, n_docs, n_ids, data``), which any
store that Spark reaches can keep. No order over all documents passes one task: where
a file's ids begin in the whole is a prefix sum over the files' counts.
"""

from __future__ import annotations

import itertools
import re
import struct
import sys
import types
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from claimforge.llm.byte_bpe import gather, offsets
from claimforge.llm.shared import arrow_batches, stored, table

MAGIC = b"PFOR1\0\0\0"
BLOCK = 128
PERCENTILE = 90
# Blocks that are packed or unpacked at a time: half a million ids, 16 MB as single bits.
SLAB = 1 << 12
# Ids of a file; a longer document is a file of its own.
FILE_IDS = 4 << 20
# Distinct chunks and pre-tokens whose ids a worker keeps before it starts afresh, and the
# characters it cuts into chunks at a time.
MAX_CHUNKS, MAX_PIECES, SLICE_CHARS = 400_000, 800_000, 4 << 20
# Characters of a text by which rows of one doc_id are dealt.
RANGE_CHARS = 64
# Texts that a worker is sent at a time.
BATCH_ROWS = 2000
HEADER = "<8sQQQ"
FILES = "part long, file long, n_docs long, n_ids long, data binary"


# The format -----------------------------------------------------------------


def _bits(values: np.ndarray) -> np.ndarray:
    """Bit lengths of unsigned 32-bit numbers."""
    return np.frexp(values.astype(np.float64))[1].astype(np.uint8)


def pack_blocks(values: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers as index, packed blocks and exceptions."""
    n = len(values)
    blocks = -(-n // BLOCK)
    if not blocks:
        return struct.pack("<Q", 0)
    parts = [_pack(values[at : at + SLAB * BLOCK]) for at in range(0, n, SLAB * BLOCK)]
    least, width, packed, rows, places, outliers = zip(*parts, strict=True)
    width = np.concatenate(width)
    starts = offsets(width.astype(np.int64) * (BLOCK // 8))
    exceptions = offsets(np.concatenate(rows))
    return b"".join(
        [
            struct.pack("<Q", n),
            *least,
            width.tobytes(),
            starts.astype("<u8").tobytes(),
            exceptions.astype("<u8").tobytes(),
            *packed,
            *places,
            *outliers,
        ]
    )


def _pack(values: np.ndarray) -> tuple[bytes, np.ndarray, bytes, np.ndarray, bytes, bytes]:
    """Of at most ``SLAB`` blocks: minima, widths, packed bits, and exceptions (a block's count, places, rests).

    Bits are bytes while they are packed, 32 of an id, so few blocks are packed at a time.
    """
    blocks = -(-len(values) // BLOCK)
    padded = np.full(blocks * BLOCK, values[-1], np.uint32)
    padded[: len(values)] = values
    padded = padded.reshape(blocks, BLOCK)
    least = padded.min(1)
    rest = padded - least[:, None]
    place = BLOCK * PERCENTILE // 100
    width = _bits(np.partition(rest, place, axis=1)[:, place])
    odd = _bits(rest) > width[:, None]
    rows, places = np.nonzero(odd)
    outliers = rest[odd]
    rest[odd] = 0
    starts = offsets(width.astype(np.int64) * (BLOCK // 8))
    packed = np.empty(starts[-1], np.uint8)
    for w in np.unique(width):
        if w:
            own = np.nonzero(width == w)[0]
            kind = 16 if w <= 16 else 32
            bits = np.unpackbits(rest[own].astype(f">u{kind // 8}").view(np.uint8), axis=1)
            bits = bits.reshape(len(own), BLOCK, kind)[:, :, kind - w :]
            data = np.packbits(bits.reshape(len(own), -1), axis=1)
            packed[starts[own][:, None] + np.arange(data.shape[1])] = data
    return (
        least.astype("<u4").tobytes(), width, packed.tobytes(), np.bincount(rows, minlength=blocks),
        places.astype(np.uint8).tobytes(), outliers.astype("<u4").tobytes(),
    )


def unpack_blocks(data: memoryview, first: int = 0, last: int | None = None) -> tuple[np.ndarray, int]:
    """The numbers ``first`` to ``last`` (all by default), and the bytes of the whole.

    Only the blocks that hold them are unpacked.
    """
    (n,) = struct.unpack_from("<Q", data)
    blocks, at = -(-n // BLOCK), 8
    if not blocks:
        return np.empty(0, np.uint32), at

    def take(kind: str, count: int) -> np.ndarray:
        nonlocal at
        part = np.frombuffer(data, kind, count, at)
        at += part.nbytes
        return part

    least, width = take("<u4", blocks), take("u1", blocks)
    starts, exceptions = take("<u8", blocks + 1).astype(np.int64), take("<u8", blocks + 1).astype(np.int64)
    packed = take("u1", starts[-1])
    places, outliers = take("u1", exceptions[-1]), take("<u4", exceptions[-1])
    last = n if last is None else min(last, n)
    if first >= last:
        return np.empty(0, np.uint32), at
    low, high = first // BLOCK, -(-last // BLOCK)
    out = np.zeros((high - low, BLOCK), np.uint32)
    for w in np.unique(width[low:high]):
        if not w:
            continue
        size, kind = int(w) * BLOCK // 8, 16 if w <= 16 else 32
        same = low + np.nonzero(width[low:high] == w)[0]
        for first_own in range(0, len(same), SLAB):
            own = same[first_own : first_own + SLAB]
            bits = np.zeros((len(own), BLOCK, kind), np.uint8)
            found = np.unpackbits(packed[starts[own][:, None] + np.arange(size)], axis=1)
            bits[:, :, kind - w :] = found.reshape(len(own), BLOCK, int(w))
            out[own - low] = np.packbits(bits.reshape(len(own), -1), axis=1).view(f">u{kind // 8}")
    from_, to = exceptions[low], exceptions[high]
    rows = np.repeat(np.arange(high - low), np.diff(exceptions[low : high + 1]))
    out[rows, places[from_:to]] = outliers[from_:to]
    out += least[low:high, None]
    return out.ravel()[first - low * BLOCK : last - low * BLOCK], at


def write_file(doc_ids: list[int | None], lengths: list[int], values: np.ndarray) -> bytes:
    """One file: header, document ids (and which are null), their lengths, all ids."""
    nulls = np.packbits(np.array([x is None for x in doc_ids], bool), bitorder="little").tobytes()
    ids = np.array([0 if x is None else x for x in doc_ids], "<i8").tobytes()
    sizes = pack_blocks(np.array(lengths, np.uint32))
    return struct.pack(HEADER, MAGIC, len(doc_ids), len(values), len(sizes)) + nulls + ids + sizes + pack_blocks(values)


def read_file(data: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Document ids, their lengths, and all token ids of a file."""
    magic, n_docs, n_ids, size = struct.unpack_from(HEADER, data)
    if magic != MAGIC:
        raise ValueError("not a token file")
    at = struct.calcsize(HEADER)
    nulls = np.unpackbits(np.frombuffer(data, np.uint8, -(-n_docs // 8), at), bitorder="little")[:n_docs]
    at += -(-n_docs // 8)
    ids = np.frombuffer(data, "<i8", n_docs, at).tolist()
    at += 8 * n_docs
    lengths, _ = unpack_blocks(memoryview(data)[at : at + size])
    values, _ = unpack_blocks(memoryview(data)[at + size :])
    if len(values) != n_ids or len(lengths) != n_docs:
        raise ValueError("a token file is damaged")
    return [None if null else x for x, null in zip(ids, nulls, strict=True)], lengths, values


# Tokenizing -----------------------------------------------------------------

# Lower-case texts made of these only are cut into pre-tokens here; all others are left
# to the library. The letters are ASCII and Latin-1 to Latin Extended-A, which composition
# leaves alone; lower-casing them gives one letter each (I with a dot excepted).
LETTERS = "a-z\u00df-\u00f6\u00f8-\u012f\u0131-\u017f"
PLAIN = rf"[!-@\[-~{LETTERS}]+"
PIECES = rf"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[0-9]|[!-/:-@\[-`{{-~]+"
WORD_END = "</w>"


class Numbers(dict):
    """Numbers its keys in the order in which they are first looked up."""

    def __missing__(self, key):
        number = self[key] = len(self)
        return number


class Coded:
    """Ids of numbered things: things come in order, their ids lie one after the other."""

    def __init__(self):
        self.starts, self.values = np.zeros(1, np.int64), np.empty(0, np.uint32)

    def add(self, sizes: np.ndarray, values: np.ndarray) -> None:
        self.starts = np.concatenate((self.starts, self.starts[-1] + np.cumsum(sizes)))
        self.values = np.concatenate((self.values, values))

    def of(self, numbers: np.ndarray) -> np.ndarray:
        return gather(numbers, self.starts, self.values)


class ChunkEncoder:
    """Ids of whole texts by a tokenizer that never joins text across white space.

    A text is cut at ASCII white space and each distinct chunk is encoded once. A plain
    chunk is cut further into the tokenizer's pre-tokens; distinct pre-tokens go to the
    library many at a time, joined by spaces, and the ids that end a word tell them
    apart. Chunks with any other character, or with a special token's mark, go to the
    library as they are. ASCII chunks are lower-cased first, which the tokenizer does
    anyway.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        size = self.library.get_vocab_size()
        self.ends = np.zeros(size, bool)
        for token, number in self.library.get_vocab().items():
            self.ends[number] = token.endswith(WORD_END)
        self.is_plain, self.pieces_of = re.compile(PLAIN).fullmatch, re.compile(PIECES).findall
        self.beyond = re.compile("[^\0-\u017f]").search
        self.chunks = self.pieces = None

    def _chunks(self, text: str) -> list[bytes]:
        data = text.encode()
        if b"<|" in data:
            return data.split()
        # Beyond Latin Extended-A a mark may join the letter before it, by its case.
        if len(data) == len(text) or not self.beyond(text):
            return data.lower().split()
        return [x.lower() if x.isascii() else x for x in data.split()]

    def __call__(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text; a few MB of text at a time are held as chunks."""
        at = 0
        while at < len(texts):
            some, held = [], 0
            while at < len(texts) and (not some or held < SLICE_CHARS):
                some.append(texts[at])
                held += len(texts[at])
                at += 1
            if self.chunks is None or len(self.chunks) > MAX_CHUNKS:
                self.chunks, self.chunk_ids = Numbers(), Coded()
            if self.pieces is None or len(self.pieces) > MAX_PIECES:
                self.pieces, self.piece_ids = Numbers(), Coded()
            known, look_up = len(self.chunks), self.chunks.__getitem__
            coded = [
                np.fromiter(map(look_up, chunks), np.int64, len(chunks)) for chunks in map(self._chunks, some)
            ]
            self._learn(list(itertools.islice(self.chunks, known, None)))
            yield from map(self.chunk_ids.of, coded)

    def _learn(self, chunks: list[bytes]) -> None:
        known, look_up = len(self.pieces), self.pieces.__getitem__
        parts, counts, odd = [], np.ones(len(chunks), np.int64), []
        for i, chunk in enumerate(chunks):
            if chunk.isalpha():
                parts.append(look_up(chunk.decode()))
                continue
            text = chunk.decode().lower()
            if "<|" not in text and "\u0130" not in text and self.is_plain(text):
                found = self.pieces_of(text)
                parts.extend(map(look_up, found))
                counts[i] = len(found)
            else:
                odd.append(i)
                counts[i] = 0
        self._encode(list(itertools.islice(self.pieces, known, None)))
        parts = np.array(parts, np.int64)
        bounds = offsets(counts)
        lengths = np.diff(self.piece_ids.starts)[parts] if len(parts) else parts
        sizes = np.diff(offsets(lengths)[bounds])
        values = self.piece_ids.of(parts)
        if odd:
            found = [x.ids for x in self.library.encode_batch_fast([chunks[i].decode() for i in odd], add_special_tokens=False)]
            places = np.repeat(offsets(sizes)[odd], list(map(len, found)))
            values = np.insert(values, places, np.fromiter(itertools.chain.from_iterable(found), np.uint32))
            sizes[odd] = list(map(len, found))
        self.chunk_ids.add(sizes, values)

    def _encode(self, pieces: list[str]) -> None:
        sizes, values = [np.empty(0, np.int64)], [np.empty(0, np.uint32)]
        for at in range(0, len(pieces), 1000):
            some = pieces[at : at + 1000]
            ids = np.array(self.library.encode(" ".join(some), add_special_tokens=False).ids, np.uint32)
            ends = np.nonzero(self.ends[ids])[0]
            if len(ends) != len(some) or ends[-1] != len(ids) - 1:
                raise ValueError("the tokenizer cuts pre-tokens otherwise than expected")
            sizes.append(np.diff(ends, prepend=-1))
            values.append(ids)
        self.piece_ids.add(np.concatenate(sizes), np.concatenate(values))


def worker_encoder(path: str) -> ChunkEncoder:
    """This worker process's encoder, kept from task to task for its known chunks."""
    state = sys.modules.setdefault("claimforge_worker_state", types.ModuleType("claimforge_worker_state"))
    if getattr(state, "path", None) != path:
        state.path, state.encoder = path, ChunkEncoder(path)
    return state.encoder


def write_tokens(
    docs: DataFrame, encoder: Callable[[], Callable[[list[str]], Iterable[np.ndarray]]], end_id: int
) -> DataFrame:
    """Encode ``doc_id, text`` and write the files; returns the table of files.

    A null or empty text has the end id alone. Null doc_ids come first, rows of one
    doc_id are ordered by text; an empty table has no files; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encode = encoder()
        part, file = TaskContext.get().partitionId(), 0
        ids, lengths, values, held = [], [], [], 0

        def flush() -> pa.RecordBatch:
            data = write_file(ids, lengths, np.concatenate(values))
            return pa.record_batch(
                [pa.array([x], pa.int64()) for x in (part, file, len(ids), held)] + [pa.array([data], pa.binary())],
                names=["part", "file", "n_docs", "n_ids", "data"],
            )

        for batch in batches:
            texts = [text or "" for text in batch.column(1).to_pylist()]
            for doc_id, found in zip(batch.column(0).to_pylist(), encode(texts), strict=True):
                if ids and held + len(found) + 1 > FILE_IDS:
                    yield flush()
                    ids, lengths, values, held, file = [], [], [], 0, file + 1
                ids.append(doc_id)
                lengths.append(len(found) + 1)
                values.append(np.append(found, np.uint32(end_id)))
                held += len(found) + 1
        if ids:
            yield flush()

    ordered = docs.select(F.col("doc_id").cast("long"), "text")
    # The head of the text splits rows without an id, or of one id, in the same order.
    head = F.substring("text", 1, RANGE_CHARS)
    ordered = ordered.repartitionByRange("doc_id", head).sortWithinPartitions("doc_id", "text")
    with arrow_batches(docs.sparkSession, BATCH_ROWS):
        return stored(ordered.mapInArrow(run, FILES), "tokens")


# Reading --------------------------------------------------------------------


def file_starts(files: DataFrame) -> DataFrame:
    """``part, file, start``: the ids in all files before; per part, then over parts."""
    counts = files.select("part", "file", "n_ids")
    parts = counts.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = W.partitionBy("part").orderBy("file").rowsBetween(W.unboundedPreceding, -1)
    within = counts.withColumn("within", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)))
    return within.join(parts, "part").select("part", "file", (F.col("base") + F.col("within")).alias("start"))


def read_tokens(files: DataFrame, row: Callable[[np.ndarray], object], kind: str) -> DataFrame:
    """``doc_id, start, n_tokens, value`` per document, ``value`` being ``row(its ids)``.

    Files are read where they lie; where a document starts in its file is then moved by
    the start of the file, so that no file's bytes are shuffled.
    """
    arrow = {"long": pa.int64(), "binary": pa.binary()}[kind]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, file, data in zip(*(batch.column(i).to_pylist() for i in (0, 1)), batch.column(2), strict=True):
                ids, lengths, values = read_file(data.as_py())
                ends = offsets(lengths)
                found = [row(values[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
                yield pa.record_batch(
                    [pa.array(np.full(len(ids), part)), pa.array(np.full(len(ids), file)), pa.array(ids, pa.int64()),
                     pa.array(ends[:-1]), pa.array(lengths.astype(np.int64)), pa.array(found, arrow)],
                    names=["part", "file", "doc_id", "inside", "n_tokens", "value"],
                )

    kinds = f"part long, file long, doc_id long, inside long, n_tokens long, value {kind}"
    found = files.select("part", "file", "data").mapInArrow(run, kinds).join(file_starts(files), ["part", "file"])
    return found.select("doc_id", (F.col("start") + F.col("inside")).alias("start"), "n_tokens", "value")


def crc_of(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    files = write_tokens(table(spark, sf_dir, "documents"), lambda: worker_encoder(path), 1)
    return read_tokens(files, crc_of, "long").withColumnRenamed("value", "ids_crc32")

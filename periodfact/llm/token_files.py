"""Operator 11: token ids as files of Simple-8b words.

A 64-bit word holds a selector (upper four bits) and as many ids as fit the
other 60 bits at the selector's width.  Selector 1 is the escape: its payload
is a place in the block's table of values that no width holds (2^60 and more).
Ids are cut into blocks of ``BLOCK_IDS``; a block is encoded on its own and the
file's footer keeps each block's offset, so any block can be read and decoded
alone, all words of one selector at once.

The files are a Spark data source, ``simple8b``: ``write_files`` puts rows into
ranges of (doc_id, hash of the ids), each range sorted and written by its task
to files of its own name; ids that repeat or are null are spread by the hash.
The driver's commit lists the files that count, in order, with the number of
ids before each (one line a file), so a lost or repeated task leaves nothing
behind that a reader sees.  ``read_files`` reads them back, a task for each file.

File: magic, blocks (words, then escapes), footer (offset of each block, escapes
of each block, doc_id, null mark and end of each document), trailer.

Defined results: a null text is empty (one id: the closing id).  Null ids come
first, rows of equal ids in the order of their hashes; every row is a document
of its own.  An empty table gives no file and an empty result.  Only ``doc_id``
and ``text`` are read.
"""

from __future__ import annotations

import json
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition,
                                    WriterCommitMessage)

from periodfact.llm.common import file_system, slices, text_of
from periodfact.llm.vocab import id_encoder

CLOSING_ID = 2
BLOCK_IDS = 8192
#: A task begins another file beyond so many ids (about 256 MB).
FILE_IDS = 128 << 20
FORMAT, MAGIC = "simple8b", b"S8BTOK01"
TRAILER = struct.Struct("<QQQQ8s")  # documents, ids, blocks, place of the footer, magic
LISTING = "_files.json"

#: Fixed values of the code: ids in a word and bits of each, by selector; 1 is the escape.
COUNTS = np.array([240, 1, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
BITS = np.array([0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
ESCAPE = 1
_FITS = np.array([1 << int(b) for b in np.delete(BITS, ESCAPE)], np.uint64)  # first value beyond each width
_LANES = np.delete(np.arange(16), ESCAPE)  # selectors by rising width


# -- words ------------------------------------------------------------------

def encode_block(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, escaped values) of some unsigned 64-bit values; each word takes the most values that fit."""
    n = len(values)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    need = np.searchsorted(_FITS, values, side="right")  # place in _LANES; len(_LANES): no width holds it
    here = np.arange(n)
    selector = np.full(n, ESCAPE)
    for lane in range(int(need.min()), min(int(need.max()), len(_LANES) - 1) + 1):
        wide = need > lane
        clear = np.minimum.accumulate(np.where(wide, here, n + 240)[::-1])[::-1] - here  # values up to the next misfit
        ok = (clear >= COUNTS[_LANES[lane]]) & (selector == ESCAPE)
        selector[ok] = _LANES[lane]
    taken, at, step = [], 0, COUNTS[selector].tolist()
    while at < n:
        taken.append(at)
        at += step[at]
    place = np.array(taken)
    kind = selector[place]
    words = kind.astype(np.uint64) << np.uint64(60)
    padded = np.concatenate([values, np.zeros(240, np.uint64)])
    for k in np.unique(kind):
        rows = np.flatnonzero(kind == k)
        if k == ESCAPE:
            words[rows] |= np.arange(len(rows), dtype=np.uint64)
        elif BITS[k]:
            lanes = np.arange(COUNTS[k])
            words[rows] |= np.bitwise_or.reduce(
                padded[place[rows][:, None] + lanes] << (lanes * BITS[k]).astype(np.uint64), axis=1)
    return words, values[place[kind == ESCAPE]]


def decode_block(words: np.ndarray, escaped: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` values of a block: all words of a selector at once."""
    kind = (words >> np.uint64(60)).astype(np.int64)
    end = np.cumsum(COUNTS[kind])
    out = np.zeros(int(end[-1]) if len(end) else 0, np.uint64)
    for k in np.unique(kind):
        rows = np.flatnonzero(kind == k)
        first = end[rows] - COUNTS[k]
        if k == ESCAPE:
            out[first] = escaped[(words[rows] & np.uint64((1 << 60) - 1)).astype(np.int64)]
        elif BITS[k]:
            lanes = np.arange(COUNTS[k])
            values = words[rows][:, None] >> (lanes * BITS[k]).astype(np.uint64)
            out[first[:, None] + lanes] = values & np.uint64((1 << int(BITS[k])) - 1)
    return out[:n]


# -- files ------------------------------------------------------------------

class FileWriter:
    """One file; holds at most a block of ids and the documents' ends."""

    def __init__(self, out) -> None:
        self.out, self.rest = out, np.zeros(0, np.uint64)
        self.place, self.offsets, self.escapes = len(MAGIC), [], []
        self.ids, self.nulls, self.ends, self.n = [], [], [], 0
        out.write(MAGIC)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.n += len(ids)
        self.ids.append(doc_id or 0)
        self.nulls.append(doc_id is None)
        self.ends.append(self.n)
        self.rest = np.concatenate([self.rest, ids.astype(np.uint64)])
        whole = len(self.rest) // BLOCK_IDS * BLOCK_IDS
        for at in range(0, whole, BLOCK_IDS):
            self._block(self.rest[at:at + BLOCK_IDS])
        self.rest = self.rest[whole:]

    def _block(self, values: np.ndarray) -> None:
        words, escaped = encode_block(values)
        self.offsets.append(self.place)
        self.escapes.append(len(escaped))
        raw = words.astype("<u8").tobytes() + escaped.astype("<u8").tobytes()
        self.out.write(raw)
        self.place += len(raw)

    def close(self) -> None:
        if len(self.rest):
            self._block(self.rest)
        for values, kind in ((self.offsets + [self.place], "<u8"), (self.escapes, "<u4"), (self.ids, "<i8"),
                             (self.nulls, "u1"), (self.ends, "<u8")):
            self.out.write(np.array(values, kind).tobytes())
        self.out.write(TRAILER.pack(len(self.ids), self.n, len(self.escapes), self.place, MAGIC))
        self.out.close()


class FileReader:
    """One file: its footer is read at once, blocks as they are asked for."""

    def __init__(self, file) -> None:
        self.file = file
        size = file.size()
        file.seek(size - TRAILER.size)
        docs, self.n, blocks, footer, magic = TRAILER.unpack(file.read(TRAILER.size))
        if magic != MAGIC:
            raise ValueError("not a file of Simple-8b token ids")
        file.seek(footer)
        raw, at, parts = file.read(size - TRAILER.size - footer), 0, []
        for count, kind in ((blocks + 1, "<u8"), (blocks, "<u4"), (docs, "<i8"), (docs, "u1"), (docs, "<u8")):
            parts.append(np.frombuffer(raw, kind, count, at))
            at += parts[-1].nbytes
        self.offsets, self.escapes, self.ids, self.nulls, self.ends = parts
        self._at, self._held = -1, np.zeros(0, np.uint64)

    def block(self, k: int) -> np.ndarray:
        if k != self._at:
            self.file.seek(int(self.offsets[k]))
            raw = np.frombuffer(self.file.read(int(self.offsets[k + 1] - self.offsets[k])), "<u8")
            words = len(raw) - int(self.escapes[k])
            self._held = decode_block(raw[:words], raw[words:], min(BLOCK_IDS, self.n - k * BLOCK_IDS))
            self._at = k
        return self._held

    def values(self, start: int, stop: int) -> np.ndarray:
        """The ids from number ``start`` up to ``stop``; only their blocks are read."""
        parts = [self.block(k)[max(0, start - k * BLOCK_IDS):stop - k * BLOCK_IDS]
                 for k in range(start // BLOCK_IDS, -(-stop // BLOCK_IDS))] if stop > start else []
        return np.concatenate(parts) if parts else np.zeros(0, np.uint64)

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(doc_id, start in the file, ids) in order."""
        start = 0
        for doc_id, null, end in zip(self.ids.tolist(), self.nulls.tolist(), self.ends.tolist()):
            yield (None if null else doc_id), start, self.values(start, end)
            start = end


@dataclass
class Written(WriterCommitMessage):
    part: int
    files: list  # (name, documents, ids) in order


@dataclass
class OneFile(InputPartition):
    name: str
    first: int  # ids before the file


class TokenFiles(DataSource):
    """Spark's reader and writer of the files; option ``path`` is a folder that all executors share."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "doc_id long, start long, n_tokens long, ids binary"

    def reader(self, schema):
        return TokenFileReader(self.options["path"])

    def writer(self, schema, overwrite: bool):
        return TokenFileWriter(self.options["path"], int(self.options.get("file_ids", FILE_IDS)))


class TokenFileWriter(DataSourceArrowWriter):
    def __init__(self, path: str, file_ids: int) -> None:
        self.path, self.file_ids = path, file_ids

    def write(self, iterator):
        """Rows (doc_id, ids as little-endian unsigned 32-bit integers) in their order."""
        fs, root = file_system(self.path)
        fs.create_dir(root, recursive=True)
        part, done, writer = TaskContext.get().partitionId(), [], None

        def close():
            writer.close()
            done.append((name, len(writer.ids), writer.n))

        for batch in iterator:
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), batch.column("ids")):
                if writer is not None and writer.n >= self.file_ids:
                    close()
                    writer = None
                if writer is None:
                    name = f"part-{part:06d}-{len(done):04d}-{uuid.uuid4().hex}.s8b"
                    writer = FileWriter(fs.open_output_stream(f"{root}/{name}"))
                writer.add(doc_id, np.frombuffer(ids.as_buffer(), "<u4"))
        if writer is not None:
            close()
        return Written(part, done)

    def commit(self, messages) -> None:
        listed, first = [], 0
        for message in sorted((m for m in messages if m is not None), key=lambda m: m.part):
            for name, docs, ids in message.files:
                listed.append({"name": name, "documents": docs, "ids": ids, "first": first})
                first += ids
        fs, root = file_system(self.path)
        fs.create_dir(root, recursive=True)
        with fs.open_output_stream(f"{root}/{LISTING}") as out:
            out.write(json.dumps(listed).encode())

    def abort(self, messages) -> None:
        fs, root = file_system(self.path)
        for message in messages:
            for name, _, _ in message.files if message is not None else ():
                fs.delete_file(f"{root}/{name}")


class TokenFileReader(DataSourceReader):
    def __init__(self, path: str) -> None:
        self.path = path

    def partitions(self):
        fs, root = file_system(self.path)
        with fs.open_input_stream(f"{root}/{LISTING}") as listed:
            files = json.loads(listed.read())
        return [OneFile(f["name"], f["first"]) for f in files] or [OneFile("", 0)]

    def read(self, partition):
        if not partition.name:
            return
        fs, root = file_system(self.path)
        with fs.open_input_file(f"{root}/{partition.name}") as file:
            rows, held = [], 0
            for doc_id, start, ids in FileReader(file).documents():
                rows.append((doc_id, partition.first + start, len(ids), ids.astype("<u4").tobytes()))
                held += len(ids)
                if held > 1 << 20 or len(rows) >= 4096:
                    yield _rows(rows)
                    rows, held = [], 0
            if rows:
                yield _rows(rows)


_READ = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _READ.types)], schema=_READ)


# -- the operator -----------------------------------------------------------

def token_ids(docs: DataFrame, ranks_path: str, closing_id: int | None = CLOSING_ID) -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit integers) of every row."""
    def run(batches):
        encode = id_encoder(ranks_path)
        closing = b"" if closing_id is None else np.array([closing_id], "<u4").tobytes()
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([encode(t) + closing for t in batch.column(1).to_pylist()], pa.binary())],
                names=["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids binary")


def write_files(docs: DataFrame, path: str, ranks_path: str, file_ids: int = FILE_IDS) -> None:
    """Write the ids of every text in the order of ``doc_id``; the texts are shuffled once, encoded where they are written."""
    ranged = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
              .withColumn("tie", F.xxhash64("text")).repartitionByRange("doc_id", "tie")
              .sortWithinPartitions("doc_id", "tie"))
    register(docs.sparkSession)
    token_ids(ranged, ranks_path).write.format(FORMAT).mode("append").option("file_ids", file_ids).save(path)


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids of every document in the files."""
    register(spark)
    return spark.read.format(FORMAT).load(path)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(TokenFiles)


def digests(read: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of what was read."""
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))

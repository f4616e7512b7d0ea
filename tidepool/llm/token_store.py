"""Token-id files: ids bit-packed at a fixed width, with block offsets for random access.

``write_token_files`` range-partitions documents by id, so that the files in
shard order hold them in ascending id order; each task streams its documents
through the tokenizer into one file in the shared store and yields one manifest
row.  The manifest is written by Spark's committer: a file that a lost or
repeated task attempt left behind is in no manifest and is never read.

File layout (integers little-endian):

    blocks     ids, each in ``bits`` bits (most significant first), ``block_ids``
               to a block, every block padded to whole bytes
    documents  id (int64), has-id flag (uint8), number of ids (int64): three arrays
    offsets    byte offset of every block (uint64)
    trailer    n_ids, n_docs, n_blocks, block_ids, bits (uint64 each), magic

Defined cases: a null text is an empty one; an empty text has the end id only;
null ids come first, in any order; repeated ids are documents of their own,
next to each other; texts of any length are encoded whole; an empty table gives
no files and no rows; other columns are not read, so their names don't matter.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidepool.llm import common
from tidepool.llm.encoding import encoder

MAGIC = b"TDPLIDS1"
BLOCK_IDS = 65_536
#: Ids that a reader unpacks at once.
READ_IDS = 1_000_000

MANIFEST = "shard int, path string, n_docs bigint, n_ids bigint"
DOCUMENTS = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"


def width(vocab_size: int) -> int:
    """Bits that hold every id of a vocabulary."""
    return max(1, int(vocab_size - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids (uint32) at ``bits`` bits each."""
    if len(ids) and int(ids.max()) >> bits:
        raise ValueError(f"an id needs more than {bits} bits")
    octets = ids.astype(">u4").view(np.uint8).reshape(-1, 4)
    if bits % 8 == 0:
        return octets[:, 4 - bits // 8:].tobytes()
    return np.packbits(np.unpackbits(octets, axis=1)[:, 32 - bits:].ravel()).tobytes()


def unpack(raw: bytes, n: int, bits: int) -> np.ndarray:
    """The first ``n`` ids of ``pack``'s bytes."""
    octets = np.zeros((n, 4), dtype=np.uint8)
    data = np.frombuffer(raw, dtype=np.uint8)
    if bits % 8 == 0:
        octets[:, 4 - bits // 8:] = data[: n * bits // 8].reshape(n, -1)
    else:
        spread = np.zeros((n, 32), dtype=np.uint8)
        spread[:, 32 - bits:] = np.unpackbits(data, count=n * bits).reshape(n, bits)
        octets[:] = np.packbits(spread, axis=1)
    return octets.reshape(-1).view(">u4").astype("<u4")


class TokenWriter:
    """Appends documents to one file."""

    def __init__(self, out, bits: int, block_ids: int = BLOCK_IDS):
        self.out, self.bits, self.block_ids = out, bits, block_ids
        self.held: list[np.ndarray] = []
        self.n_held = self.n_ids = self.at = 0
        self.docs: list[tuple[int | None, int]] = []
        self.offsets: list[int] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append((doc_id, len(ids)))
        self.held.append(ids)
        self.n_held += len(ids)
        self.n_ids += len(ids)
        if self.n_held >= self.block_ids:
            self._flush(whole_blocks=True)

    def _flush(self, whole_blocks: bool) -> None:
        ids = np.concatenate(self.held) if self.held else np.zeros(0, "<u4")
        end = len(ids) - len(ids) % self.block_ids if whole_blocks else len(ids)
        for i in range(0, end, self.block_ids):
            raw = pack(ids[i: min(i + self.block_ids, end)], self.bits)
            self.offsets.append(self.at)
            self.at += len(raw)
            self.out.write(raw)
        self.held, self.n_held = [ids[end:]], len(ids) - end

    def close(self) -> None:
        self._flush(whole_blocks=False)
        self.out.write(np.array([d or 0 for d, _ in self.docs], dtype="<i8").tobytes())
        self.out.write(np.array([d is not None for d, _ in self.docs], dtype=np.uint8).tobytes())
        self.out.write(np.array([n for _, n in self.docs], dtype="<i8").tobytes())
        self.out.write(np.array(self.offsets, dtype="<u8").tobytes())
        self.out.write(np.array([self.n_ids, len(self.docs), len(self.offsets), self.block_ids, self.bits], dtype="<u8").tobytes() + MAGIC)


class TokenFile:
    """Random access to one file by byte ranges."""

    def __init__(self, uri: str):
        filesystem, path = common.store_files(uri)
        self.file = filesystem.open_input_file(path)
        size, tail = self.file.size(), 40 + len(MAGIC)
        raw = self.file.read_at(tail, size - tail)
        if raw[40:] != MAGIC:
            raise ValueError(f"not a token file: {uri}")
        self.n_ids, self.n_docs, blocks, self.block_ids, self.bits = (int(x) for x in np.frombuffer(raw[:40], "<u8"))
        table = self.n_docs * 17 + blocks * 8
        raw = self.file.read_at(table, size - tail - table)
        n = self.n_docs
        self.doc_ids = np.frombuffer(raw, "<i8", n)
        self.has_id = np.frombuffer(raw, np.uint8, n, 8 * n).astype(bool)
        self.lengths = np.frombuffer(raw, "<i8", n, 9 * n)
        self.offsets = np.append(np.frombuffer(raw, "<u8", blocks, 17 * n), np.uint64(size - tail - table))
        self.starts = np.cumsum(self.lengths) - self.lengths

    def ids(self, begin: int, end: int) -> np.ndarray:
        """Ids at positions [begin, end) of this file; only the blocks that hold them are read."""
        if end <= begin:
            return np.zeros(0, "<u4")
        first, last = begin // self.block_ids, (end - 1) // self.block_ids
        lo, hi = int(self.offsets[first]), int(self.offsets[last + 1])
        raw = self.file.read_at(hi - lo, lo)
        out = []
        for b in range(first, last + 1):
            n = min(self.block_ids, self.n_ids - b * self.block_ids)
            out.append(unpack(raw[int(self.offsets[b]) - lo: int(self.offsets[b + 1]) - lo], n, self.bits))
        return np.concatenate(out)[begin - first * self.block_ids: end - first * self.block_ids]

    def document(self, k: int) -> np.ndarray:
        return self.ids(int(self.starts[k]), int(self.starts[k] + self.lengths[k]))

    def stream(self, size: int = READ_IDS) -> Iterator[tuple[int, np.ndarray, bool]]:
        """(document number, some of its ids, whether they are its last) over the whole file."""
        k, n = 0, self.n_docs
        while k < n:
            begin = int(self.starts[k])
            last = max(k, int(np.searchsorted(self.starts + self.lengths, begin + size, side="right")) - 1)
            if last == k:
                end = begin + int(self.lengths[k])
                for at in range(begin, max(end, begin + 1), size):
                    yield k, self.ids(at, min(at + size, end)), at + size >= end
            else:
                ids = self.ids(begin, int(self.starts[last] + self.lengths[last]))
                for j in range(k, last + 1):
                    at = int(self.starts[j]) - begin
                    yield j, ids[at: at + int(self.lengths[j])], True
            k = last + 1


def write_token_files(df: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
                      uri: str | None = None, block_ids: int = BLOCK_IDS) -> DataFrame:
    """Encode every text, append ``end_id``, write the files below ``uri``; the stored manifest, a row per file."""
    spark = df.sparkSession
    common.prepare(spark)
    uri = uri or common.scratch_uri(spark, "token-files")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, shard, writer, out = encoder(tokenizer), TaskContext.get().partitionId(), None, None
        path = f"{uri}/shard-{shard:06d}-{uuid.uuid4().hex[:8]}.ids"
        end = np.array([end_id], dtype="<u4")
        for batch in batches:
            if not batch.num_rows:
                continue
            if writer is None:
                filesystem, where = common.store_files(path)
                filesystem.create_dir(where.rpartition("/")[0], recursive=True)
                out = filesystem.open_output_stream(where, compression=None)
                writer = TokenWriter(out, width(max(enc.vocab_size, end_id + 1)), block_ids)
            for doc_id, ids in zip(batch.column(0).to_pylist(), enc.encode(batch.column(1))):
                writer.add(doc_id, np.concatenate((ids, end)))
        if writer is not None:
            writer.close()
            out.close()
            yield pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int32()), "path": [path], "n_docs": [len(writer.docs)], "n_ids": [writer.n_ids]})

    key, text = common.column(df, id_col).cast("bigint"), common.column(df, text_col)
    rows = df.select(key.alias("k"), text.alias("t"))
    # The text's hash only spreads repeated ids that have different texts.
    rows = rows.repartitionByRange(F.col("k").asc(), F.xxhash64("t").asc()).sortWithinPartitions("k")
    return common.stored(rows.mapInArrow(write, MANIFEST), "token-manifest")


def read_token_files(manifest: DataFrame) -> DataFrame:
    """A row per document, from the files: id, ids before it, number of ids, CRC-32 of its ids."""
    before = F.sum("n_ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))  # a row per file
    files = manifest.withColumn("start", F.coalesce(before, F.lit(0)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for r in batch.to_pylist():
                    file, crc, n = TokenFile(r["path"]), 0, 0
                    for k, ids, last in file.stream():
                        crc, n = zlib.crc32(ids, crc), n + len(ids)
                        if last:
                            yield (int(file.doc_ids[k]) if file.has_id[k] else None, r["start"] + int(file.starts[k]), n, crc)
                            crc = n = 0

        yield from common.batches(rows(), schema)

    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
    return files.repartitionByRange(max(1, manifest.count()), "shard").mapInArrow(read, DOCUMENTS)


def token_ids(spark: SparkSession, documents: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Write all documents and read them back."""
    return read_token_files(write_token_files(documents, tokenizer, end_id))

"""Token ids in files of fixed-width bit packing.

Every id takes the same number of bits, the fewest that hold the vocabulary.
Documents are dealt by a range shuffle, so file numbers follow ``doc_id``; each
task encodes its documents and writes files of about ``FILE_BYTES`` into a
folder that all executors reach, and one row per file tells what it holds. A
file is written under a name of its attempt and then renamed: a task that runs
twice leaves the same file.

File: a header (magic, bits, ids per block), the blocks, then the byte offset
of every block, the ids and the ends of the documents, and a trailer of fixed
length. Ids are little-endian bit fields; eight ids fill ``bits`` bytes, so a
block starts at a whole byte, and a reader finds any id by its block's offset
and unpacks with a few numpy operations for each of the eight places.

Defined cases: a null or empty text is one closing id; an empty table gives no
files and no rows; documents without doc_id come first; rows that share a
doc_id follow each other in the order of a hash of their texts; repeated rows
are stored as often as they come; further columns are ignored. An id beyond the
stated bits is an error.
"""
from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tideline.llm.common import whole
from tideline.llm.packing import Tokens, tokenizer_file
from tideline.operators.scale import running
from tideline.session import cut_lineage

CLOSING_ID = 2
BLOCK = 1 << 16            # ids in a block; a multiple of eight
FILE_BYTES = 64 << 20      # a file is closed behind the document that reaches this
MAGIC = b"TBP1"
HEADER = "<4sII"          # magic, bits, ids per block
TRAILER = "<QQQQQ4s"       # documents, those without id, ids, blocks, place of the index, magic
FILES = "part long, seq long, file string, n_docs long, n_ids long, n_bytes long"


def bits_for(vocabulary: int) -> int:
    """Fewest bits that hold the ids 0 .. vocabulary - 1."""
    return max(1, (vocabulary - 1).bit_length())


def _places(bits: int):
    """(id of the group, byte of the group, left shift) wherever one of eight ids meets a byte."""
    for j in range(8):
        for byte in range(j * bits // 8, ((j + 1) * bits - 1) // 8 + 1):
            yield j, byte, 8 * byte - j * bits


def packed(ids: np.ndarray, bits: int) -> bytes:
    """The ids as bit fields, filled up with zero bits to a whole byte."""
    if len(ids) and int(ids.max()) >> bits:
        raise ValueError(f"an id needs more than {bits} bits")
    groups = -(-len(ids) // 8)
    x = np.zeros((groups, 8), np.uint64)
    x.reshape(-1)[:len(ids)] = ids
    out = np.zeros((groups, bits), np.uint8)
    for j, byte, left in _places(bits):
        part = x[:, j] >> np.uint64(left) if left >= 0 else x[:, j] << np.uint64(-left)
        out[:, byte] |= part.astype(np.uint8)
    return out.tobytes()[:-(-len(ids) * bits // 8)]


def unpacked(data: bytes, bits: int, count: int) -> np.ndarray:
    """The first ``count`` ids of what ``packed`` returned."""
    groups = -(-count // 8)
    raw = np.zeros((groups, bits), np.uint8)
    flat = np.frombuffer(data, np.uint8)[:groups * bits]
    raw.reshape(-1)[:len(flat)] = flat
    out = np.zeros((groups, 8), np.uint64)
    for j, byte, left in _places(bits):
        part = raw[:, byte].astype(np.uint64)
        out[:, j] |= part << np.uint64(left) if left >= 0 else part >> np.uint64(-left)
    return (out & np.uint64((1 << bits) - 1)).astype(np.uint32).reshape(-1)[:count]


def _store(folder: str):
    """File system and path of a folder named by a path or URI."""
    from pyarrow import fs
    return fs.FileSystem.from_uri(folder)


class Writer:
    """One file under a temporary name until ``close``."""

    def __init__(self, store, path: str, bits: int, block: int = BLOCK):
        self.store, self.path, self.bits, self.block = store, path, bits, block
        self.temporary = f"{path}.{uuid.uuid4().hex}"
        self.out = store.open_output_stream(self.temporary)
        self.out.write(struct.pack(HEADER, MAGIC, bits, block))
        self.size, self.count = struct.calcsize(HEADER), 0
        self.waiting, self.held = [], 0
        self.offsets, self.ids, self.ends = [], [], []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.count += len(ids)
        self.ids.append(doc_id)
        self.ends.append(self.count)
        self.waiting.append(ids)
        self.held += len(ids)
        if self.held >= self.block:
            self._blocks(self.held - self.held % self.block)

    def _blocks(self, upto: int) -> None:
        held = np.concatenate(self.waiting) if self.waiting else np.zeros(0, np.uint32)
        for at in range(0, upto, self.block):
            data = packed(held[at:min(at + self.block, upto)], self.bits)
            self.offsets.append(self.size)
            self.out.write(data)
            self.size += len(data)
        self.waiting, self.held = [held[upto:]], len(held) - upto

    def close(self) -> int:
        """Bytes of the finished file."""
        self._blocks(self.held)
        missing = sum(i is None for i in self.ids)
        index = [np.array(self.offsets, "<u8"), np.array([i or 0 for i in self.ids], "<i8"),
                 np.array(self.ends, "<u8")]
        for part in index:
            self.out.write(part.tobytes())
        self.out.write(struct.pack(TRAILER, len(self.ids), missing, self.count, len(self.offsets), self.size, MAGIC))
        self.out.close()
        self.store.move(self.temporary, self.path)
        return self.size + sum(part.nbytes for part in index) + struct.calcsize(TRAILER)


class Reader:
    """Random access to one file."""

    def __init__(self, store, path: str):
        self.file = store.open_input_file(path)
        end = self.file.size()
        magic, self.bits, self.block = struct.unpack(
            HEADER, self._bytes(0, struct.calcsize(HEADER)))
        n_docs, missing, self.count, n_blocks, index, last = struct.unpack(
            TRAILER, self._bytes(end - struct.calcsize(TRAILER), struct.calcsize(TRAILER)))
        if magic != MAGIC or last != MAGIC:
            raise ValueError(f"{path} is no file of packed ids")
        words = np.frombuffer(self._bytes(index, 8 * (n_blocks + 2 * n_docs)), "<u8")
        self.offsets = words[:n_blocks].astype(np.int64)
        ids = words[n_blocks:n_blocks + n_docs].view("<i8").tolist()
        self.doc_ids = [None] * missing + ids[missing:]
        self.ends = words[n_blocks + n_docs:].astype(np.int64)

    def _bytes(self, at: int, length: int) -> bytes:
        self.file.seek(at)
        return self.file.read(length)

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids start .. stop - 1 of the file; reads only the bytes that hold them, block by block."""
        out = []
        while start < stop:
            number, first = divmod(start, self.block)
            last = min(stop - number * self.block, self.block)
            whole_from = first - first % 8                    # eight ids start at a whole byte
            at = self.offsets[number] + whole_from // 8 * self.bits
            data = self._bytes(int(at), -(-(last - whole_from) * self.bits // 8))
            out.append(unpacked(data, self.bits, last - whole_from)[first - whole_from:])
            start = number * self.block + last
        return np.concatenate(out) if out else np.zeros(0, np.uint32)

    def document(self, number: int) -> np.ndarray:
        return self.ids(int(self.ends[number - 1]) if number else 0, int(self.ends[number]))

    def checksums(self) -> Iterator[tuple[int | None, int, int, int]]:
        """(doc_id, start in the file, number of ids, crc32 of the ids as ``<u4``), one block in memory at a time."""
        held, base = np.zeros(0, "<u4"), 0
        start = 0
        for doc_id, end in zip(self.doc_ids, self.ends.tolist()):
            crc, at = 0, start
            while at < end:
                if at >= base + len(held):
                    base = at - at % self.block
                    held = self.ids(base, min(base + self.block, self.count)).astype("<u4")
                part = held[at - base:end - base]
                crc = zlib.crc32(part, crc)
                at += len(part)
            yield doc_id, start, end - start, crc
            start = end

    def close(self) -> None:
        self.file.close()


def write_ids(docs: DataFrame, folder: str, doc_id: str = "doc_id", text: str = "text", tokenizer: str | None = None,
              closing: int = CLOSING_ID, bits: int | None = None, file_bytes: int = FILE_BYTES,
              block: int = BLOCK) -> DataFrame:
    """Encode, pack and store; one row per file (part, seq, file, n_docs, n_ids, n_bytes), ordered by part and seq.

    ``folder`` is a path or URI that every executor can write to; ``bits``
    defaults to what the tokenizer's vocabulary needs.
    """
    if block % 8:
        raise ValueError("a block holds a multiple of eight ids")
    path = tokenizer or tokenizer_file()

    def run(batches):
        from pyspark import TaskContext
        tokens, out, part, seq = None, None, TaskContext.get().partitionId(), 0

        def done():
            size = out.close()
            return pa.RecordBatch.from_pylist([{
                "part": part, "seq": seq, "file": out.path, "n_docs": len(out.ids), "n_ids": out.count,
                "n_bytes": size}], schema=pa.schema([(n, pa.string() if n == "file" else pa.int64()) for n in
                                                     ("part", "seq", "file", "n_docs", "n_ids", "n_bytes")]))
        for batch in batches:
            for i, t in zip(*(c.to_pylist() for c in batch.columns)):
                if tokens is None:
                    tokens = Tokens(path)
                    store, base = _store(folder)
                    store.create_dir(base, recursive=True)
                    width = bits or bits_for(tokens.coder.n_vocab)
                if out is None:
                    out = Writer(store, f"{base}/ids-{part:06d}-{seq:06d}.tbp", width, block)
                out.add(i, np.append(tokens.ids(t), closing).astype(np.uint32))
                if (out.count * width) >> 3 >= file_bytes:
                    yield done()
                    out, seq = None, seq + 1
        if out is not None:
            yield done()

    x = docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole(text).alias("text"))
    order = ["doc_id", F.xxhash64("text")]
    dealt = x.repartitionByRange(*order).sortWithinPartitions(*order)
    return cut_lineage(dealt.mapInArrow(run, FILES))


def read_ids(files: DataFrame, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every stored document; ``start`` counts over all files in their order."""
    def run(batches):
        store, _ = _store(folder)
        for batch in batches:
            for file, upto, held in zip(*(c.to_pylist() for c in batch.columns)):
                reader = Reader(store, file)
                rows = list(zip(*reader.checksums()))
                reader.close()
                kinds = [pa.int64()] * 4
                if rows:
                    rows[1] = [upto - held + s for s in rows[1]]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds)],
                                                     names=["doc_id", "start", "n_tokens", "ids_crc32"])

    ahead = running(files, [], ["part", "seq"], F.floor(F.col("part") / 256), {"upto": (F.col("n_ids"), "sum")})
    tasks = max(1, files.count())                    # a file is a task's worth
    return (ahead.select("file", "upto", "n_ids").repartition(tasks)
                 .mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long"))


def stored_ids(spark: SparkSession, docs: DataFrame, folder: str, **options) -> DataFrame:
    """Write ``docs`` to ``folder`` and return what its files hold."""
    return read_ids(write_ids(docs, folder, **options), folder)

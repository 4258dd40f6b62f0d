"""Token ids of documents in binary files: each id in the fewest bits that the vocabulary needs, packed block by block.

A file, little-endian throughout:

    head      magic, version u16, bits u16, ids in a block u32
    blocks    of `block` ids each, the last may hold fewer: bits of the ids one after the other, lowest bit first, the
              last byte filled up with zeros
    offsets   u64 for each block and one more: where it begins in the file, the last where the blocks end
    checks    u32 for each block: crc32 of its bytes
    starts    u64 for each document and one more: how many ids of the file stand before it
    keys      i64 for each document, and u8 for each: 1 if it has a key
    tail      documents u64, ids u64, crc32 of offsets to keys u32, magic

A reader finds any document's blocks from the tail, the offsets and the starts, reads only them, and unpacks a block without
a loop over its ids: every id is looked up in the eight bytes that begin where it begins, shifted and masked.

Writing: rows are dealt by ranges of the key and sorted within them, and each task writes files of about FILE_BYTES, so files
follow each other in the order of the keys. A file's name is fresh for each attempt and counts only through the row that
names it, so lost or repeated tasks leave no trace. Where a file begins among all ids is a sum over the files before it; no
row meets another for it.

Tokenizing is the tokenizers library's, or gives its ids: see Ids. An added token's string is that token, as in the library.

Null and empty texts are the end id alone. Texts are encoded whole; one text's ids are in memory at a time. Null keys come first.
Rows that repeat a key follow each other in the order of a hash of their texts, then of the texts; rows equal in both are
alike. A key or a text with a third of all rows is dealt over several ranges. An empty table gives no file and an empty
result. Extra columns are not written.
"""

from __future__ import annotations

import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .common import lean, new_path, pieces_of, slabs, utf8, written
from .warc import opened

MAGIC, VERSION, BLOCK, END = b"GMIDS\x00\x00\x01", 1, 1 << 13, 0
#: A file is closed when its blocks hold so many bytes; bytes of blocks that are read at once.
FILE_BYTES, READ_BYTES = 32 << 20, 1 << 20
HEAD, TAIL = struct.Struct("<8sHHI"), struct.Struct("<QQI8s")
MANIFEST = "part int, file int, name string, docs long, ids long"
ROWS = "start long, n_tokens long, ids_crc32 long"


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


# ---- ids


class Ids:
    """A text -> its ids, as the tokenizers library has them without special tokens.

    A byte-level vocabulary whose ids stand in the order of its merges is also a table of ranks. Texts of common characters
    that hold no added token are merged by rank, which gives the same ids in a quarter of the time; all others, and all
    texts of another kind of vocabulary, go to the library itself."""

    #: The pattern of this kind of vocabulary, and what such a vocabulary states.
    WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
    KIND = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
    #: Characters whose class is the same in all libraries.
    COMMON = re.compile("[\t\n\r\x20-\x7e\xa1-\u017f]*")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.full = Tokenizer.from_file(path)
        self.bits = max(1, (self.full.get_vocab_size(with_added_tokens=True) - 1).bit_length())
        self.added = [t.content for t in self.full.get_added_tokens_decoder().values()]
        self.quick = self._ranked(json.load(open(path, encoding="utf-8")))

    def _ranked(self, said: dict):
        import tiktoken
        from tokenizers import pre_tokenizers

        model, kind = said["model"], said["pre_tokenizer"] or {}
        vocab, merges = model.get("vocab", {}), ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in model.get("merges", [])]
        letters = pre_tokenizers.ByteLevel.alphabet()
        order = [vocab.get(x, -1) for x in merges]
        plain = not said["normalizer"] and all(kind.get(k) == v for k, v in self.KIND.items()) and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        singles = [vocab.get(x, -1) for x in letters]
        if not plain or min(singles) < 0 or not order or max(singles) >= order[0] or any(a >= b for a, b in zip(order, order[1:])):
            return None
        # each byte's letter: printable ones stand for themselves, the others follow from 256 on
        own = [b for b in range(256) if chr(b) in letters]
        byte = {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(own))}
        ranks = {bytes(byte[c] for c in x): vocab[x] for x in [*letters, *merges]}
        return tiktoken.Encoding("ranks", pat_str=self.WORDS, mergeable_ranks=ranks, special_tokens={})

    def of(self, text: str) -> np.ndarray:
        if self.quick and self.COMMON.fullmatch(text) and not any(t in text for t in self.added):
            return np.array(self.quick.encode_ordinary(text), np.uint32)
        return np.array(self.full.encode(text, add_special_tokens=False).ids, np.uint32)


# ---- blocks


def packed(ids: np.ndarray, bits: int) -> bytes:
    """ids in `bits` bits each, lowest bit first."""
    if len(ids) and int(ids.max()) >> bits:
        raise ValueError(f"an id doesn't fit {bits} bits")
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    digits = (ids[:, None] >> np.arange(bits, dtype=np.uint32)) & np.uint32(1)
    return np.packbits(digits.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpacked(body: bytes, bits: int, n: int, first: int = 0) -> np.ndarray:
    """n ids from the one at place `first` on."""
    room = np.frombuffer(body + bytes(8), np.uint8)
    eight = np.lib.stride_tricks.as_strided(room[:8].view("<u8"), (len(body) + 1,), (1,))
    at = np.arange(first, first + n, dtype=np.int64) * bits
    return ((eight[at >> 3] >> (at & 7).astype(np.uint64)) & np.uint64((1 << bits) - 1)).astype(np.uint32)


class Writer:
    """A file being written to a stream that needs no seeking."""

    def __init__(self, folder: str, bits: int, block: int = BLOCK):
        files, path = opened(folder)
        files.create_dir(path, recursive=True)
        self.name, self.bits, self.block = f"{uuid.uuid4().hex}.ids", bits, block
        self.stream = files.open_output_stream(f"{path}/{self.name}")
        self.stream.write(HEAD.pack(MAGIC, VERSION, bits, block))
        self.offsets, self.checks, self.starts, self.keys = [HEAD.size], [], [0], []
        self.rest = np.zeros(0, np.uint32)

    @property
    def size(self) -> int:
        return self.offsets[-1] + len(self.rest) * self.bits // 8

    def add(self, key: int | None, ids: np.ndarray) -> None:
        self.keys.append(key)
        self.starts.append(self.starts[-1] + len(ids))
        self.rest = np.concatenate([self.rest, ids]) if len(self.rest) else ids
        full = len(self.rest) // self.block * self.block
        for k in range(0, full, self.block):
            self._put(self.rest[k : k + self.block])
        self.rest = self.rest[full:].copy() if full else self.rest

    def _put(self, ids: np.ndarray) -> None:
        body = packed(ids, self.bits)
        self.stream.write(body)
        self.offsets.append(self.offsets[-1] + len(body))
        self.checks.append(zlib.crc32(body))

    def close(self) -> tuple[str, int, int]:
        if len(self.rest):
            self._put(self.rest)
        side = b"".join([
            np.array(self.offsets, "<u8").tobytes(), np.array(self.checks, "<u4").tobytes(), np.array(self.starts, "<u8").tobytes(),
            np.array([k or 0 for k in self.keys], "<i8").tobytes(), np.array([k is not None for k in self.keys], np.uint8).tobytes(),
        ])
        self.stream.write(side + TAIL.pack(len(self.keys), self.starts[-1], zlib.crc32(side), MAGIC))
        self.stream.close()
        return self.name, len(self.keys), self.starts[-1]


class Reader:
    """Documents of a file by their place, from the blocks that hold them."""

    def __init__(self, file: pa.NativeFile):
        self.file, size = file, file.size()
        magic, version, self.bits, self.block = HEAD.unpack(file.read_at(HEAD.size, 0))
        self.docs, self.ids, crc, end = TAIL.unpack(file.read_at(TAIL.size, max(0, size - TAIL.size)))
        if magic != MAGIC or end != MAGIC or version != VERSION:
            raise ValueError("not a file of ids, or cut off")
        blocks = -(-self.ids // self.block)
        room = 8 * (blocks + 1) + 4 * blocks + 8 * (self.docs + 1) + 9 * self.docs
        side = file.read_at(room, size - TAIL.size - room)
        if zlib.crc32(side) != crc:
            raise ValueError("the index is broken")
        at, parts = 0, []
        for kind, n in (("<u8", blocks + 1), ("<u4", blocks), ("<u8", self.docs + 1), ("<i8", self.docs), ("u1", self.docs)):
            parts.append(np.frombuffer(side, kind, n, at))
            at += parts[-1].nbytes
        self.offsets, self.checks, self.starts, self.keys, self.keyed = (p.astype(np.int64) for p in parts)

    def ids_from(self, first: int, n: int) -> np.ndarray:
        """n ids of the file from a place on; only their blocks are read, and each is checked."""
        if not n:
            return np.zeros(0, np.uint32)
        a, z = first // self.block, (first + n - 1) // self.block + 1
        body, base = self.file.read_at(int(self.offsets[z] - self.offsets[a]), int(self.offsets[a])), self.offsets[a]
        for k in range(a, z):
            if zlib.crc32(body[self.offsets[k] - base : self.offsets[k + 1] - base]) != self.checks[k]:
                raise ValueError(f"block {k} is broken")
        if self.block * self.bits % 8 == 0:  # blocks follow each other without a gap
            return unpacked(body, self.bits, n, first - a * self.block)
        held = [unpacked(body[self.offsets[k] - base : self.offsets[k + 1] - base], self.bits, min(self.block, self.ids - k * self.block)) for k in range(a, z)]
        return np.concatenate(held)[first - a * self.block :][:n]

    def document(self, place: int) -> np.ndarray:
        return self.ids_from(int(self.starts[place]), int(self.starts[place + 1] - self.starts[place]))

    def documents(self) -> Iterator[tuple[int, int, np.ndarray]]:
        """(first, last + 1, their ids) of neighbouring documents, read together."""
        yield from ((i, j, self.ids_from(int(self.starts[i]), int(self.starts[j] - self.starts[i]))) for i, j in slabs(self.starts, 8 * READ_BYTES // self.bits))


# ---- tables


def write(docs: DataFrame, folder: str, vocabulary: str | None = None, key: str = "doc_id", text: str = "text", end: int = END) -> DataFrame:
    """part, file, name, docs, ids: a row for each file that counts; (part, file) is their order."""
    path = vocabulary or default_vocabulary()

    @lean
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, ids, out, done = TaskContext.get().partitionId(), None, None, []
        for batch in batches:
            ids = ids or Ids(path)
            body, at = utf8(batch.column(1))
            for i, k in enumerate(batch.column(0).to_pylist()):
                found = ids.of(body[at[i] : at[i + 1]].tobytes().decode("utf-8"))
                out = out or Writer(folder, ids.bits)
                out.add(k, np.append(found, np.uint32(end)))
                if out.size >= FILE_BYTES:
                    done.append(out.close())
                    out = None
        if out:
            done.append(out.close())
        columns = [pa.array([part] * len(done), pa.int32()), pa.array(range(len(done)), pa.int32()), *(pa.array([d[i] for d in done], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int64())))]
        yield pa.RecordBatch.from_arrays(columns, ["part", "file", "name", "docs", "ids"])

    rows = docs.select(F.col(key).cast("long").alias("__key"), F.coalesce(text, F.lit("")).alias("__text"))
    order = [F.col("__key").asc_nulls_first(), "__hash", "__place"]
    dealt = rows.withColumns({"__hash": F.xxhash64("__text"), "__place": F.monotonically_increasing_id()}).repartitionByRange(pieces_of(docs), *order)
    in_order = dealt.sortWithinPartitions(order[0], "__hash", "__text").select("__key", "__text")
    return written(in_order.mapInArrow(encode, MANIFEST), "token-files")


def read(files: DataFrame, folder: str, key: str = "doc_id", ids: bool = False) -> DataFrame:
    """key, start (ids of all documents before it), n_tokens, ids_crc32 of each document of the named files, with its ids if
    asked for."""
    before = F.coalesce(F.sum("ids").over(Window.orderBy("part", "file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = files.select("name", before.cast("long").alias("before"))  # a row for each file
    names = [key, "start", "n_tokens", "ids_crc32"] + ["ids"] * ids

    @lean
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, before in zip(*(c.to_pylist() for c in batch.columns)):
                source, path = opened(folder)
                with source.open_input_file(f"{path}/{name}") as f:
                    reader = Reader(f)
                    for i, j, found in reader.documents():
                        starts = reader.starts[i : j + 1] - reader.starts[i]
                        body = memoryview(found.astype("<u4").tobytes())
                        sums = [zlib.crc32(body[4 * a : 4 * b]) for a, b in zip(starts[:-1].tolist(), starts[1:].tolist())]
                        columns = [pa.array(reader.keys[i:j], pa.int64(), mask=reader.keyed[i:j] == 0), pa.array(before + reader.starts[i:j]), pa.array(np.diff(starts)), pa.array(sums, pa.int64())]
                        if ids:
                            columns.append(pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(found.astype(np.int64))))
                        yield pa.RecordBatch.from_arrays(columns, names)

    spread = placed.repartition(max(1, files.count()))
    return spread.mapInArrow(scan, f"{key} long, {ROWS}" + ", ids array<long>" * ids)


def round_trip(spark: SparkSession, docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    folder = new_path(spark, "ids")
    return read(write(docs, folder, vocabulary), folder)

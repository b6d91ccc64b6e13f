"""Token ids of documents, and their binary shards in training order.

A sequence's number is its document's number times the most sequences of a document, plus
its place in the document; a keyed Feistel permutation with cycle-walking scatters these
numbers over their whole range. Equal parts of the range are the shards, and the order in
the permuted range is the training order: a sequence's global slot is the number of
sequences before it. So tokens are made in one pass and shuffled once, without numbering
them first: numbers without gaps would need either every text encoded twice or all tokens
stored once more before the shuffle.

A shard file is an array of records of one fixed size. The manifest has the first slot and the
number of records of each, so slot k of a file is at (k - first_slot) * stride: reading is
sequential, and resuming at a slot is a seek. Files are written and read in pieces, whatever
their size. A file is written under a temporary name and renamed; a task that runs again
writes the same bytes.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, new_path

#: Token ids of a sequence; the record is a header and the ids, zero-padded.
SEQUENCE = 256
#: Bytes of text for a shard, on average, and shards at most: beyond, shards grow.
SHARD_TEXT, SHARDS = 1 << 20, 400_000
#: Records that are read at a time.
READ = 4096
HEADER = "<qiI"  # doc_id, sequence of the document, number of ids
KEY, ROUNDS = 0x5EED_0F_7EA1, 6


def stride(sequence: int = SEQUENCE) -> int:
    return struct.calcsize(HEADER) + 2 * sequence


def _mix(x: np.ndarray, salt: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = x + np.uint64(salt & (2**64 - 1))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def permute(index: np.ndarray, n: int, key: int = KEY) -> np.ndarray:
    """A keyed bijection of range(n): Feistel rounds on 2w bits, walked until below n."""
    w = np.uint64(max(1, ((max(n - 1, 1)).bit_length() + 1) // 2))
    mask = (np.uint64(1) << w) - np.uint64(1)
    out = index.astype(np.uint64)
    todo = np.ones(len(out), bool)
    while todo.any():
        x = out[todo]
        left, right = x >> w, x & mask
        for r in range(ROUNDS):
            left, right = right, left ^ (_mix(right, key * 0x9E3779B97F4A7C15 + r * 0xD1B54A32D192ED03) & mask)
        out[todo] = x = left << w | right
        todo[todo] = x >= np.uint64(n)
    return out.astype(np.int64)


def load(path: str | None = None, pattern: str | None = None) -> tiktoken.Encoding:
    """Byte-level pair encoding from a file of ranks, or the public one of 50,256 ids. It has
    no special tokens, so every text is encoded as it stands and decodes to itself."""
    if path is None or pattern is None:
        import public_tokenizers

        path, pattern = path or public_tokenizers.path("byte_bpe_50k.tiktoken"), pattern or public_tokenizers.PATTERN
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("veristrata", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def sequences(docs: DataFrame, machine: tiktoken.Encoding | None = None, length: int = SEQUENCE, key: int = KEY, shard_text: int = SHARD_TEXT) -> DataFrame:
    """shard, place, doc_id, seq, n, ids (little-endian uint16): each text cut into sequences
    of length ids, with their shard and place in training order. These depend on doc_id, the
    place in the text and the key only; sequences of equal doc_id are ordered by their
    content. A null or empty text has one empty sequence, so that every row has a slot; rows
    without a doc_id have the number after the largest."""
    machine = machine or load()
    if machine.n_vocab > 1 << 16:
        raise ValueError("ids need more than 16 bits")
    doc_id = F.col("doc_id").cast("long")
    size = F.octet_length(F.coalesce("text", F.lit("")))
    low, high, most, total = docs.agg(F.min(doc_id), F.max(doc_id), F.max(size), F.sum(size)).first()
    low, high = (0, 0) if low is None else (low, high)
    each = max(1, -(-(most or 0) // length))  # an id covers a byte at least
    span = high - low + 2
    scattered = span * each >= 1 << 62
    if scattered:  # numbers of such ids are hashes
        low, span = 0, (1 << 62) // each
    domain = span * each
    shards = min(SHARDS, max(1, -(-(total or 0) // shard_text)))
    width = -(-domain // shards)
    number = F.pmod(F.xxhash64(doc_id), F.lit(span)) if scattered else F.coalesce(doc_id - F.lit(low), F.lit(span - 1))
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, index = [], []
            for first, doc_id, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                ids = np.array(shared.value.encode_ordinary(text or ""), "<u2")
                for k in range(0, max(1, len(ids)), length):
                    part = ids[k : k + length]
                    rows.append((doc_id, k // length, len(part), part.tobytes()))
                    index.append(first * each + k // length)
            place = permute(np.array(index, np.int64), domain, key)
            cols = list(zip(*rows, strict=True)) or [[]] * 4
            cols = [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int32(), pa.binary()), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(place // width), pa.array(place), *cols], ["shard", "place", "doc_id", "seq", "n", "ids"])

    return docs.select(number.alias("number"), doc_id.alias("doc_id"), "text").mapInArrow(run, "shard long, place long, doc_id long, seq int, n int, ids binary")


def _open(path: str):
    """(filesystem, path in it) of a file or folder that all executors share."""
    from pyarrow import fs

    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path)


def write_shards(placed: DataFrame, path: str, length: int = SEQUENCE) -> DataFrame:
    """Write the shard files below path; the manifest: shard, file, first_slot, n_slots, sha256."""
    size, fits = stride(length), length

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _open(path)
        store.create_dir(root, recursive=True)
        done, shard, out, name, leaf, digest, n = [], None, None, "", "", None, 0

        def close() -> None:
            out.close()
            store.move(name, f"{root}/{leaf}")
            done.append((shard, f"{path}/{leaf}", n, digest.hexdigest()))

        for b in batches:
            records: list[bytes] = []
            for s, doc_id, seq, k, ids in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if k > fits:
                    raise ValueError("a sequence is longer than the record")
                if s != shard:
                    if out is not None:
                        out.write(data := b"".join(records))
                        digest.update(data)
                        close()
                    shard, records, digest, n = s, [], hashlib.sha256(), 0
                    leaf = f"shard-{s:08d}.bin"
                    name = f"{root}/{leaf}.{uuid.uuid4().hex[:12]}.tmp"  # of this attempt
                    out = store.open_output_stream(name)
                records.append(struct.pack(HEADER, -1 if doc_id is None else doc_id, seq, k) + ids + bytes(2 * (fits - k)))
                n += 1
            if out is not None:
                out.write(data := b"".join(records))
                digest.update(data)
        if out is not None:
            close()
        cols = list(zip(*done, strict=True)) or [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.string(), pa.int64(), pa.string()), strict=True)], ["shard", "file", "n_slots", "sha256"])

    rows = placed.repartition("shard").sortWithinPartitions("shard", "place", "doc_id", "seq", "ids")
    rows = rows.select("shard", "doc_id", "seq", "n", "ids")
    files = materialise(rows.mapInArrow(write, "shard long, file string, n_slots long, sha256 string"), "files")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # SHARDS rows at most
    return materialise(files.select("shard", "file", F.coalesce(F.sum("n_slots").over(before), F.lit(0)).alias("first_slot"), "n_slots", "sha256"), "manifest")


def read_shards(manifest: DataFrame, from_slot: int = 0, length: int = SEQUENCE, read: int = READ) -> DataFrame:
    """slot, shard, offset, doc_id, seq, n_tokens, ids (little-endian uint16) of the records from a
    slot on. Files before it are not opened, and its own is entered at the slot's offset."""
    size, head = stride(length), struct.calcsize(HEADER)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary())
        for b in batches:
            for shard, name, first, at, n in zip(*(c.to_pylist() for c in b.columns), strict=True):
                store, file = _open(name)
                with store.open_input_file(file) as f:
                    f.seek(at * size)
                    data = f.read(n * size)
                rows = []
                for k in range(n):
                    doc_id, seq, count = struct.unpack_from(HEADER, data, k * size)
                    rows.append((first + at + k, shard, (at + k) * size, doc_id, seq, count, data[k * size + head : k * size + head + 2 * count]))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], ["slot", "shard", "offset", "doc_id", "seq", "n_tokens", "ids"])

    at = F.greatest(F.lit(0).cast("long"), F.lit(from_slot) - F.col("first_slot"))
    some = manifest.where(F.col("first_slot") + F.col("n_slots") > from_slot)
    pieces = some.select("shard", "file", "first_slot", "n_slots", F.explode(F.sequence(at, F.col("n_slots") - 1, F.lit(read).cast("long"))).alias("at"))
    pieces = pieces.select("shard", "file", "first_slot", "at", F.least(F.lit(read).cast("long"), F.col("n_slots") - F.col("at")).alias("n"))
    tasks = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # given, so that few rows are not put into one task
    return pieces.repartition(tasks, "file", "at").mapInArrow(parse, "slot long, shard long, offset long, doc_id long, seq int, n_tokens long, ids binary")


def materialise_order(docs: DataFrame, path: str | None = None, machine: tiktoken.Encoding | None = None, key: int = KEY) -> DataFrame:
    """Write all documents as shards in training order; one row per record, read back from the
    files: slot, shard, offset, doc_id, seq, n_tokens, tokens_sha256.

    A null doc_id is stored as -1; a null or empty text has one record without ids. Rows of equal
    doc_id share their numbers: ties are ordered by sequence, then by content, so equal rows are
    interchangeable. A text of any length is cut into as many records as it needs. An empty
    table writes no file and gives no rows. Other columns are not read."""
    path = path or new_path(docs.sparkSession, "shards")
    rows = read_shards(write_shards(sequences(docs, machine, key=key), path))
    return rows.select("slot", "shard", "offset", "doc_id", "seq", "n_tokens", F.sha2("ids", 256).alias("tokens_sha256"))

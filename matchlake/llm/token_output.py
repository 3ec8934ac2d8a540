"""Token ids in training order.

Each task of the first pass tokenises its texts, ends each with the end token
and packs the stream into sequences of ``length`` ids; they are written once,
compressed.  The counts per partition (all that reaches the driver is their
sum) number the sequences, and a keyed Feistel network with cycle-walking
permutes these numbers: sequence i goes to slot p(i) of 0..n-1.  The second
pass sends each sequence to the partition of its range of slots, which writes
fixed-stride shards front to back: slot s is the ``s % per_shard``-th record of
shard ``s // per_shard``, so a reader needs no index and can stop and go on
anywhere.  Files are written under a task's own name and renamed, so a lost
executor or a repeated task leaves whole shards with the same bytes.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matchlake.llm.columns import lean, mix
from matchlake.llm.store import partitions, stored, text_of
from matchlake.session import scratch_dir

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: The pattern that splits text before the merges of this vocabulary (a fixed value that goes with the file).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
END = 50256             # the id that ends each text and fills the last sequence of a partition
LENGTH = 2048           # ids of a sequence
PER_SHARD = 4096        # sequences of a shard
KEY = 20240
_GROUP = 256            # sequences that are compressed together in the first pass
_ROUNDS = 4


def permuted(i: np.ndarray, n: int, key: int) -> np.ndarray:
    """The slot of each sequence: a keyed permutation of 0..n-1."""
    half = max(1, (int(n - 1).bit_length() + 1) // 2)
    low = np.uint64((1 << half) - 1)
    out, todo = i.astype(np.uint64), np.arange(len(i))
    while len(todo):
        x = out[todo]
        left, right = x >> np.uint64(half), x & low
        for r in range(_ROUNDS):
            left, right = right, left ^ (mix(right + np.uint64((key * _ROUNDS + r) * 0x9E3779B97F4A7C15 % (1 << 64))) & low)
        out[todo] = (left << np.uint64(half)) | right
        todo = todo[out[todo] >= n]           # walk on from slots beyond the last
    return out.astype(np.int64)


def encoder(ranks: bytes, pattern: str):
    """The tokenizer of a rank file, kept by the worker process."""
    import tiktoken

    kept = tiktoken.__dict__.setdefault("_by_content", {})
    key = (hashlib.sha256(ranks).digest(), pattern)
    if key not in kept:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines()) if a}
        kept[key] = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})
    return kept[key]


_PACKED = "part int, first long, n long, used array<int>, ids binary, pieces array<struct<seq:long,doc:long,at:int,len:int>>"
_PIECE = pa.struct([("seq", pa.int64()), ("doc", pa.int64()), ("at", pa.int32()), ("len", pa.int32())])


def _pack(ranks: bytes, pattern: str, end: int, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(ranks, pattern).encode_ordinary
        part, codec = TaskContext.get().partitionId(), pa.Codec("zstd", compression_level=9)
        buffer, used, first, pieces = np.zeros(_GROUP * length, np.uint16), 0, 0, []

        def flush() -> pa.RecordBatch:
            n = -(-used // length)
            buffer[used: n * length] = end
            lens = [length] * (n - 1) + [used - (n - 1) * length]
            seq, doc, at, size = (np.array(x) for x in zip(*pieces, strict=True))
            return pa.RecordBatch.from_arrays([
                pa.array([part], pa.int32()), pa.array([first]), pa.array([n]), pa.array([lens], pa.list_(pa.int32())),
                pa.array([codec.compress(buffer[: n * length].tobytes(), asbytes=True)], pa.binary()),
                pa.ListArray.from_arrays(pa.array([0, len(seq)], pa.int32()), pa.StructArray.from_arrays(
                    [pa.array(seq), pa.array(doc.tolist(), pa.int64()), pa.array(at.astype(np.int32)), pa.array(size.astype(np.int32))],
                    fields=list(_PIECE)))], ["part", "first", "n", "used", "ids", "pieces"])

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.array([*encode(text.as_py()), end], np.uint16)
                at = 0
                while at < len(ids):
                    room = min(len(ids) - at, length - used % length)
                    buffer[used: used + room] = ids[at: at + room]
                    pieces.append((first + used // length, doc, used % length, room))
                    used, at = used + room, at + room
                    if used == len(buffer):
                        yield flush()
                        first, used, pieces = first + _GROUP, 0, []
        if used:
            yield flush()
    return run


_SENT = "shard long, slot long, seq long, used int, ids binary, docs array<long>"


def _send(length: int, n: int, per_shard: int, key: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd", compression_level=9)
        for batch in batches:
            for row in batch.select([0, 1, 2, 3, 4, 5]).to_pylist():
                count = row["n"]
                raw = codec.decompress(row["ids"], decompressed_size=count * length * 2, asbytes=True)
                seq = row["start"] + row["first"] + np.arange(count)
                slot = permuted(seq, n, key)
                docs: list[list] = [[] for _ in range(count)]
                for p in row["pieces"]:
                    docs[p["seq"] - row["first"]].append(p["doc"])
                ids = [codec.compress(raw[k * length * 2: (k + 1) * length * 2], asbytes=True) for k in range(count)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(slot // per_shard), pa.array(slot), pa.array(seq), pa.array(row["used"], pa.int32()),
                    pa.array(ids, pa.binary()), pa.array(docs, pa.list_(pa.int64()))],
                    ["shard", "slot", "seq", "used", "ids", "docs"])
    return run


def shard_path(folder: str, shard: int) -> str:
    return f"{folder.rstrip('/')}/shard-{shard:08d}.bin"


def _write(folder: str, length: int, per_shard: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")
        store.create_dir(root, recursive=True)
        open_shard, out, temp, stride = -1, None, "", length * 2

        def close() -> None:
            if out is not None:
                out.close()
                store.move(temp, shard_path(root, open_shard))

        for batch in batches:
            rows = batch.to_pylist()
            shas = []
            for row in rows:
                if row["shard"] != open_shard:
                    close()
                    open_shard, temp = row["shard"], f"{shard_path(root, row['shard'])}.{uuid.uuid4().hex}"
                    out = store.open_output_stream(temp)
                raw = pa.decompress(row["ids"], decompressed_size=stride, codec="zstd", asbytes=True)
                out.write(raw)
                shas.append(hashlib.sha256(raw).hexdigest())
            yield pa.RecordBatch.from_arrays([
                batch.column("slot"), batch.column("seq"), batch.column("shard"),
                pa.array([row["slot"] % per_shard * stride for row in rows], pa.int64()),
                batch.column("used"), batch.column("docs"), pa.array(shas, pa.string())],
                ["slot", "sequence", "shard", "byte_offset", "n_tokens", "doc_ids", "sha256"])
        close()
    return run


def write_tokens(docs: DataFrame, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text",
                 vocabulary: str = VOCABULARY, pattern: str = PATTERN, end: int = END, length: int = LENGTH,
                 per_shard: int = PER_SHARD, key: int = KEY) -> DataFrame:
    """Writes the shards to ``folder`` (by default a new one in the shared
    folder) and returns one row per sequence: slot, sequence (its number before
    the permutation), shard, byte_offset, n_tokens (without filling), doc_ids
    (the documents whose ids it holds, in order) and sha256 of its bytes.

    Ids are unsigned 16-bit, little end first.  Null and empty texts are an end
    id alone; a row that is repeated is written as often as it stands; a null
    identifier is kept as null.  Which sequence holds which document follows
    the order in which Spark reads the rows.  Other columns are not read; an
    empty table writes no shard and gives an empty result.
    """
    spark = docs.sparkSession
    folder = folder or scratch_dir(spark, "token-shards")
    with open(vocabulary, "rb") as f:
        ranks = f.read()
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    packed = stored(rows.mapInArrow(lean(_pack(ranks, pattern, end, length)), _PACKED), "token-packed")
    # one row per partition of the first pass
    sizes = packed.groupBy("part").agg(F.sum("n").alias("n"))
    starts = stored(sizes.select("part", "n", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("start")), "token-starts")
    n = starts.agg(F.sum("n")).first()[0] or 0
    columns = "slot long, sequence long, shard long, byte_offset long, n_tokens int, doc_ids array<long>, sha256 string"
    if not n:
        return spark.createDataFrame([], columns)
    shards = -(-n // per_shard)
    parts = min(shards, max(partitions(spark), -(-shards // 64)))
    sent = packed.join(F.broadcast(starts.select("part", "start")), "part").select("first", "n", "used", "ids", "pieces", "start")
    sent = sent.mapInArrow(lean(_send(length, n, per_shard, key)), _SENT)
    ranged = sent.repartitionById(parts, (F.col("shard") * parts / shards).cast("int")).sortWithinPartitions("slot")
    return stored(ranged.mapInArrow(lean(_write(folder, length, per_shard)), columns), "token-index")


def read_slots(folder: str, first: int, count: int, length: int = LENGTH, per_shard: int = PER_SHARD) -> np.ndarray:
    """``count`` sequences from slot ``first`` on, as a (count, length) array."""
    store, root = fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")
    out = []
    while count > 0:
        n = min(count, per_shard - first % per_shard)
        with store.open_input_file(shard_path(root, first // per_shard)) as f:
            f.seek(first % per_shard * length * 2)
            out.append(np.frombuffer(f.read(n * length * 2), "<u2").reshape(-1, length))
        first, count = first + n, count - n
    return np.concatenate(out) if out else np.zeros((0, length), np.uint16)

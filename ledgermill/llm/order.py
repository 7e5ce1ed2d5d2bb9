"""Token sequences written in training order, as shards with a fixed stride.

Texts become token ids, an end token after each, cut into sequences of one length. Sequences are
numbered without gaps: those of a partition as they come, partitions by running sums. A keyed
Feistel network permutes the numbers; where it leaves the range it is applied again until it is
back inside (cycle-walking), so slots are a permutation too and nothing need be sorted or stored
to know them. Consecutive slots make a shard; a record's place in its file is slot times stride.
"""

from __future__ import annotations

import base64
import itertools
import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgermill.llm import files
from ledgermill.llm.common import arrow, shared_copy
from ledgermill.workspace import new_path, remove, stage

LENGTH, PER_SHARD, KEY = 256, 8192, 0x5EED
ROUNDS = 6
#: Shards in a row that one task writes, and that one task reads back.
SPAN, READ = 8, 16
#: Writing tasks at most; how hard sequences are compressed on their way to them, and how many
#: bytes of them a task packs together.
TASKS, LEVEL, BUFFER = 100_000, 6, 64 << 20


def default_vocabulary() -> str:
    """Where the public vocabulary of 50,256 byte pairs lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@lru_cache(maxsize=2)
def _coder(path: str) -> tuple[tiktoken.Encoding, int]:
    import public_tokenizers

    lines = files.content(path).splitlines()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    coder = tiktoken.Encoding("public", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                              special_tokens={})
    return coder, max(ranks.values()) + 1


def _mixed(x: np.ndarray, key: int) -> np.ndarray:
    """Well mixed 64 bits of x and a key."""
    x = (x + np.uint64(key)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _half(n: int) -> int:
    return max(1, -(-max(1, n - 1).bit_length() // 2))


def _round_keys(key: int) -> list[int]:
    with np.errstate(over="ignore"):
        return [int(_mixed(np.array([key], np.uint64), r + 1)[0]) for r in range(ROUNDS)]


def permute(numbers: np.ndarray, n: int, key: int = KEY, inverse: bool = False) -> np.ndarray:
    """Slots in 0..n-1 of numbers in 0..n-1, or numbers of slots."""
    half = np.uint64(_half(n))
    mask = np.uint64((1 << int(half)) - 1)
    keys = _round_keys(key)
    out = numbers.astype(np.uint64)
    todo = np.arange(len(out))
    with np.errstate(over="ignore"):
        while len(todo):
            left, right = out[todo] >> half, out[todo] & mask
            if inverse:
                for k in reversed(keys):
                    left, right = right ^ (_mixed(left, k) & mask), left
            else:
                for k in keys:
                    left, right = right, left ^ (_mixed(right, k) & mask)
            out[todo] = left << half | right
            todo = todo[out[todo] >= n]
    return out.astype(np.int64)


def token_bytes(vocabulary: str) -> int:
    """Bytes of a token in a record: two while the end token, the largest, fits."""
    return 2 if _coder(vocabulary)[1] < 1 << 16 else 4


def sequences(docs: DataFrame, length: int = LENGTH, vocabulary: str | None = None) -> DataFrame:
    """``doc_id``, ``part``, ``n_tokens`` and ``tokens`` (little-endian, two or four bytes each by
    the vocabulary's size, filled up with the end token) of every sequence. Null text is an empty
    one: only its end token."""
    path = shared_copy(docs.sparkSession, vocabulary or default_vocabulary())
    width = token_bytes(path)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, end = _coder(path)
        for batch in batches:
            texts, ids, part, count, tokens = batch.column(1), [], [], [], []
            for k, text in enumerate(texts):
                found = coder.encode_to_numpy(text.as_py() or "", disallowed_special=())
                n = len(found) + 1
                whole = -(-n // length)
                line = np.full(whole * length, end, f"<u{width}")
                line[: n - 1] = found
                line = line.tobytes()
                ids += [k] * whole
                part += range(whole)
                count += [length] * (whole - 1) + [n - length * (whole - 1)]
                tokens += [line[a:a + width * length] for a in range(0, len(line), width * length)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(ids, pa.int64())), pa.array(part, pa.int64()),
                 pa.array(count, pa.int64()), pa.array(tokens, pa.binary())],
                names=["doc_id", "part", "n_tokens", "tokens"])

    return docs.select("doc_id", F.col("text").cast("string")).transform(
        arrow, run, f"doc_id {kind}, part long, n_tokens long, tokens binary")


def numbered(found: DataFrame) -> tuple[DataFrame, int, str]:
    """The frame, written, with ``number`` from 0 without gaps; how many rows, and where they lie."""
    spark = found.sparkSession
    path = new_path(spark, "sequences")
    writer = found.withColumn("uid", F.monotonically_increasing_id()).write.option("compression", "zstd")
    writer.option("parquet.compression.codec.zstd.level", LEVEL).option(
        "parquet.page.size", 8 << 20).parquet(path)
    rows = spark.read.parquet(path)
    partition = F.shiftrightunsigned("uid", 33)
    counts = rows.groupBy(partition.alias("p")).count()
    before = Window.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    starts = stage(counts.select(
        "p", "count", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start")), "starts")
    n = starts.agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]
    inside = F.col("uid").bitwiseAND(F.lit((1 << 33) - 1))
    return (rows.withColumn("p", partition).join(starts.drop("count"), "p")
            .withColumn("number", F.col("start") + inside).drop("p", "start", "uid")), n, path


def shard_name(folder: str, shard: int) -> str:
    return f"{folder}/shard-{shard:08d}.bin"


def materialise(docs: DataFrame, folder: str, length: int = LENGTH, per_shard: int = PER_SHARD,
                key: int = KEY, vocabulary: str | None = None) -> DataFrame:
    """Write the shards and ``manifest.json`` into ``folder``; (doc_id, part, n_tokens, slot).

    A task writes a few shards in a row and puts each in place whole, so a lost executor's shards
    are written anew and the result stays the same. Rows are packed for the task that writes them
    before they are exchanged.
    """
    rows, n, held_at = numbered(sequences(docs, length, vocabulary))
    width = token_bytes(vocabulary or default_vocabulary())
    stride = width * length
    span = per_shard * SPAN
    schema = pa.schema([("group", pa.int64()), ("offsets", pa.binary()), ("lines", pa.binary()),
                        ("size", pa.int64())])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slots = permute(batch.column(3).to_numpy(), n, key)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(slots)],
                                             names=["doc_id", "part", "n_tokens", "slot"])

    narrow = stage(rows.select("doc_id", "part", "n_tokens", "number"), "numbered")
    placed = narrow.transform(arrow, place, narrow.withColumnRenamed("number", "slot").schema)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd", compression_level=LEVEL)

        def flush() -> pa.RecordBatch:
            slots = permute(np.concatenate(numbers), n, key)
            order = np.argsort(slots // span, kind="stable")
            slots, lines = slots[order], np.concatenate(held)[order]
            group, offsets = slots // span, (slots % span).astype("<u4")
            cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(group)]
            numbers.clear()
            held.clear()
            return pa.RecordBatch.from_pylist([
                {"group": int(group[a]), "offsets": offsets[a:b].tobytes(),
                 "lines": codec.compress(lines[a:b].tobytes(), asbytes=True), "size": stride * (b - a)}
                for a, b in itertools.pairwise(cuts)], schema)

        numbers: list[np.ndarray] = []
        held: list[np.ndarray] = []
        for batch in batches:
            numbers.append(batch.column(0).to_numpy())
            lines = b"".join(batch.column(1).to_pylist())
            held.append(np.frombuffer(lines, np.uint8).reshape(-1, stride))
            if sum(map(len, held)) * stride >= BUFFER:
                yield flush()
        if sum(map(len, held)):
            yield flush()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush() -> pa.RecordBatch:
            for k, at in enumerate(range(0, len(content), per_shard)):
                files.put(shard_name(folder, current * SPAN + k), content[at:at + per_shard].tobytes())
            return pa.RecordBatch.from_pylist([{"group": current, "bytes": content.nbytes}])

        codec = pa.Codec("zstd")
        current, content = -1, np.empty((0, stride), np.uint8)
        for batch in batches:
            for group, offsets, lines, size in zip(*(c.to_pylist() for c in batch.columns)):
                if group != current:
                    if current >= 0:
                        yield flush()
                    current = group
                    content = np.zeros((min(span, n - group * span), stride), np.uint8)
                lines = codec.decompress(lines, size, asbytes=True)
                content[np.frombuffer(offsets, "<u4")] = np.frombuffer(
                    lines, np.uint8).reshape(-1, stride)
        if current >= 0:
            yield flush()

    packed = rows.select("number", "tokens").transform(
        arrow, pack, "group long, offsets binary, lines binary, size long")
    # Each task gets a range of slots; they are uniform, so the ranges are even without sampling.
    groups = -(-n // span)
    tasks = max(1, min(groups, TASKS))
    place_of = F.floor(F.col("group") * tasks / max(1, groups)).cast("int")
    wrote = (packed.repartitionById(tasks, place_of).sortWithinPartitions("group")
             .transform(arrow, write, "group long, bytes long"))
    if wrote.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0] != n * stride:
        raise RuntimeError("shards are incomplete")
    files.put(f"{folder}/manifest.json", json.dumps(
        {"sequences": n, "length": length, "per_shard": per_shard, "key": key, "bytes_per_token": width}).encode())
    remove(docs.sparkSession, held_at)  # the shards hold all of it now
    return placed


def manifest(folder: str) -> dict:
    with files.open_random(f"{folder}/manifest.json") as file:
        return json.loads(file.read())


def read_from(folder: str, slot: int, count: int) -> list[np.ndarray]:
    """``count`` sequences from ``slot`` on, or as many as there are: how a reader resumes."""
    spec, out = manifest(folder), []
    stride, per_shard = spec["length"] * spec["bytes_per_token"], spec["per_shard"]
    stop = min(slot + count, spec["sequences"])
    while slot < stop:
        shard, at = divmod(slot, per_shard)
        n = min(per_shard - at, stop - slot)
        with files.open_random(shard_name(folder, shard)) as file:
            data = file.read_at(n * stride, at * stride)
        out += list(np.frombuffer(data, f"<u{spec['bytes_per_token']}").reshape(n, -1))
        slot += n
    return out


def read_back(spark: SparkSession, folder: str) -> DataFrame:
    """``slot``, ``shard``, ``byte_offset`` and ``record_crc32`` of every record in the files."""
    spec = manifest(folder)
    n, per_shard = spec["sequences"], spec["per_shard"]
    stride = spec["length"] * spec["bytes_per_token"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.column(0).to_pylist():
                first, last = shard * per_shard, min((shard + 1) * per_shard, n)
                with files.open_random(shard_name(folder, shard)) as file:
                    crcs = [zlib.crc32(file.read(stride)) for _ in range(first, last)]
                slots = np.arange(first, last)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(slots), pa.array(slots // per_shard), pa.array((slots - first) * stride),
                     pa.array(crcs, pa.int64())], names=["slot", "shard", "byte_offset", "record_crc32"])

    shards = -(-n // per_shard)
    return spark.range(0, shards, 1, max(1, min(-(-shards // READ), TASKS))).transform(
        arrow, run, "slot long, shard long, byte_offset long, record_crc32 long")


def training_order(docs: DataFrame, length: int = LENGTH, per_shard: int = PER_SHARD,
                   key: int = KEY, vocabulary: str | None = None) -> DataFrame:
    """Write all of ``docs`` in training order into the shared folder and read it back: one row per
    sequence with ``doc_id``, ``part`` (its number in the document), ``n_tokens`` (end token
    included, filling not), ``slot``, ``shard``, ``byte_offset`` and ``record_crc32``.

    Slots follow from the number of a sequence, and numbers from the input's partitions: the same
    files under the same split settings give the same order, other splits another one.
    Null and empty texts give one sequence with only the end token. Null and repeated ids are rows
    like any other. An empty table gives no shards and no rows; other columns are not read.
    """
    folder = new_path(docs.sparkSession, "training-order")
    placed = materialise(docs, folder, length, per_shard, key, vocabulary)
    found = stage(read_back(docs.sparkSession, folder), "read-back")  # written, so its size is known
    return placed.join(found, "slot").select(
        "doc_id", "part", "n_tokens", "slot", "shard", "byte_offset", "record_crc32")

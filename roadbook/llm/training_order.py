"""Operator 8: sequences of token ids as fixed-stride shards, in training order.

Documents are encoded, closed by an end id and cut into sequences of one length;
the last of a document is filled up. Sequences are numbered without gaps and a
keyed Feistel permutation, walked along its cycle until it lands below the
number of sequences, gives each its slot in the whole training order: a shuffle
of any size that needs no sort by random numbers and can be recomputed for any
slot. Slots are ranged into shards of equal numbers of sequences.

A shard is one file of records of one size, in the order of the slots, so a
reader finds a slot by arithmetic and may stop and go on anywhere. A record is
the document's id (8 bytes), the sequence's number within it (4), its ids in use
(4), then the ids (2 bytes each, little endian) and one closing byte.

Numbers do not depend on files or tasks: a document's sequences stand in the order
of a hash of its id and text. They are shuffled to 2**18 buckets of that hash, ranked
inside a bucket and stored; the buckets' counts, one number each, give every rank its
number. Stored ids are not filled up: the writer does that. Shards are written in
``WAVES`` ranges of slots, so no more than one wave's ids lie in shuffle files beside
the stored table and the shards, and the table goes once they are written.

Defined results: null and empty texts give one sequence, of the end id alone;
repeated rows are rows of their own; a null id is written as -1; an empty table
gives no sequence and no shard; columns other than id and text are not looked at.
Ids that are no whole numbers, and vocabularies of over 65,536 ids, are refused. A
row that one task meets over ``COPIES`` times, same id and same text, is dealt over
more buckets; only then does the order depend on how rows lie in files.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadbook.llm.common import Scratch, delete, free_shuffles, ship
from roadbook.llm.sentencepiece_codec import chunks, codec
from roadbook.session import shared_folder

LENGTH, SHARD = 512, 4096
HEAD, TAIL = 16, 1
WAVES = 3
BUCKET_BITS = 18
COPIES = 1024
ROUNDS = 6
KEY = 0x5EED5EED


def _mix(x: np.ndarray) -> np.ndarray:
    """A public 64-bit finaliser: each bit of x changes about half of the result's bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def permute(numbers: np.ndarray, n: int, key: int = KEY, back: bool = False) -> np.ndarray:
    """A permutation of 0..n-1 that the key chooses; ``back`` undoes it."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
    keys = _mix(np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(key % 2**64))
    out = np.asarray(numbers).astype(np.uint64)
    walking = np.arange(len(out))
    while len(walking):
        left, right = out[walking] >> shift, out[walking] & mask
        if back:
            for k in keys[::-1]:
                left, right = right ^ (_mix(left + k) & mask), left
        else:
            for k in keys:
                left, right = right, left ^ (_mix(right + k) & mask)
        out[walking] = left << shift | right
        walking = walking[out[walking] >= n]
    return out.astype(np.int64)


def sequences(df: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """``id, part, n_tokens, tokens`` (not filled up) with ``key``, the hash that orders documents."""
    if not isinstance(df.schema[id_col].dataType, T.IntegralType):
        raise TypeError(f"{id_col} is {df.schema[id_col].dataType.simpleString()}, but records hold whole numbers: number the rows first")
    if (size := codec(model).library.vocab_size()) > 2**16:
        raise ValueError(f"records hold 2 bytes an id, too few for a vocabulary of {size}")
    ship(df.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, seen = codec(model), Counter()
        end = own.library.eos_id()
        for batch in batches:
            start, keys = 0, _apart(batch.column(2).to_numpy(), seen)
            for texts in chunks(batch.column(1)):
                ids, n = own.encode(texts)
                n = n.astype(np.int64)
                used = n + 1  # with the end id; a full last one leaves it a sequence of its own
                parts = n // length + 1
                ends = np.cumsum(used)
                flat = np.empty(int(used.sum()), "<u2")
                flat[np.repeat(ends - used - (np.cumsum(n) - n), n) + np.arange(len(ids))] = ids
                flat[ends - 1] = end
                doc = np.repeat(np.arange(len(texts)), parts)
                part = np.arange(len(doc)) - np.repeat(np.cumsum(parts) - parts, parts)
                took = np.minimum(length, used[doc] - part * length)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, len(texts)).take(pa.array(doc)), pa.array(part.astype(np.int32)),
                     pa.array(took.astype(np.int32)), _binary(flat, 2 * took), pa.array(keys[start: start + len(texts)][doc])],
                    names=["id", "part", "n_tokens", "tokens", "key"])
                start += len(texts)

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = df.select(F.col(id_col).cast("long").alias("id"), text.alias("text"))
    return rows.select("id", "text", F.xxhash64("id", "text").alias("key")).mapInArrow(
        work, "id long, part int, n_tokens int, tokens binary, key long")


def _apart(keys: np.ndarray, seen: Counter) -> np.ndarray:
    """Keys, but those of a row met over ``COPIES`` times anew for every further such number of it."""
    out = keys.copy()
    for i, key in enumerate(keys.tolist()):
        if lot := seen[key] // COPIES:
            out[i] = _mix(np.array([(key + lot * 0x9E3779B97F4A7C15) % 2**64], np.uint64)).astype(np.int64)[0]
        seen[key] += 1
    return out


def _binary(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(values.tobytes())])


@dataclass(frozen=True)
class Order:
    """The stored sequences and what gives each its slot."""

    scratch: Scratch
    stored: DataFrame  # id, part, n_tokens, tokens, bucket, rank
    starts: np.ndarray  # the first number of each bucket
    total: int
    length: int
    shard: int
    key: int
    fill: bytes

    @property
    def shards(self) -> int:
        return -(-self.total // self.shard)

    def rows(self, first: int = 0, end: int | None = None) -> DataFrame:
        """``slot, shard, offset, id, part, n_tokens, tokens`` of shards ``first`` to ``end``, each whole and in order within one partition."""
        starts, total, key = self.starts, self.total, self.key

        @F.pandas_udf("long")
        def slot(bucket: pd.Series, rank: pd.Series) -> pd.Series:
            return pd.Series(permute(starts[bucket.to_numpy()] + rank.to_numpy(), total, key))

        stride = HEAD + 2 * self.length + TAIL
        placed = self.stored.withColumn("slot", slot("bucket", "rank")).withColumn("shard", F.floor(F.col("slot") / self.shard))
        if first > 0 or end is not None:
            placed = placed.where(F.col("shard").between(first, (self.shards if end is None else end) - 1))
        dealt = placed.select("slot", "shard", "id", "part", "n_tokens", "tokens").repartition("shard").sortWithinPartitions("shard", "slot")
        filled = F.rpad("tokens", 2 * self.length, F.lit(self.fill))
        return dealt.select("slot", "shard", (F.col("slot") % self.shard * stride).alias("offset"), "id", "part", "n_tokens", filled.alias("tokens"))


def store_order(df: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                shard: int = SHARD, key: int = KEY) -> Order:
    """Encode, number and store the sequences."""
    spark = df.sparkSession
    bucket = F.shiftrightunsigned("key", 64 - BUCKET_BITS).cast("int")
    inside = Window.partitionBy("bucket").orderBy("key", "id", "part")
    ranked = (sequences(df, model, id_col, text_col, length).withColumn("bucket", bucket)
              .withColumn("rank", F.row_number().over(inside).cast("long") - 1).drop("key"))
    scratch = Scratch(spark, "order")
    with free_shuffles(spark):
        stored = scratch.keep(ranked, compression="zstd")
        # one number a bucket, of which there are 2**18
        counts = stored.groupBy("bucket").count().toPandas()
    sizes = np.zeros(2**BUCKET_BITS, np.int64)
    sizes[counts["bucket"].to_numpy(np.int64)] = counts["count"].to_numpy(np.int64)
    fill = max(0, codec(model).library.unk_id()).to_bytes(2, "little")
    return Order(scratch, stored, np.cumsum(sizes) - sizes, int(sizes.sum()), length, shard, key, fill)


def in_training_order(df: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                      shard: int = SHARD, key: int = KEY) -> DataFrame:
    """``slot, shard, offset, id, part, n_tokens, tokens``, each shard whole and in order within one partition."""
    return store_order(df, model, id_col, text_col, length, shard, key).rows()


def write_shards(ordered: DataFrame, path: str, mode: str = "error") -> None:
    """One file for each shard under ``shard=<number>``, through Spark's own writer, to any store it reaches.

    The writer ends each record with the closing byte. A record's bytes go
    through it as they are, under the type of a string.
    """
    record = F.concat(_little("id", 8), _little("part", 4), _little("n_tokens", 4), F.col("tokens"))
    (ordered.select("shard", record.cast("string").alias("value"))
     .write.mode(mode).partitionBy("shard").option("lineSep", "\n").option("compression", "none")
     .option("maxRecordsPerFile", 0).text(path))


def write_in_waves(order: Order, path: str, waves: int = WAVES) -> None:
    """All shards, a range of them at a time: each wave's shuffle files are gone before the next one's are many."""
    ends = [order.shards * (w + 1) // waves for w in range(waves)]
    wanted = [(first, end) for first, end in zip([0, *ends], ends) if end > first]
    with free_shuffles(order.stored.sparkSession):
        for first, end in wanted:
            write_shards(order.rows(first, end), path, "error" if first == 0 else "append")


def delete_shards(spark: SparkSession, path: str) -> None:
    """Delete a folder of shards that nothing reads any more."""
    delete(spark, path)


def _little(column: str, size: int):
    """A number's lowest bytes, the lowest first."""
    value = F.coalesce(F.col(column).cast("long"), F.lit(-1))
    return F.concat(*[F.unhex(F.lpad(F.hex(F.shiftrightunsigned(value, 8 * i).bitwiseAND(255)), 2, "0")) for i in range(size)])


def read_shards(spark: SparkSession, path: str, length: int = LENGTH, shard: int = SHARD, start: int = 0) -> DataFrame:
    """The sequences from slot ``start`` on; earlier shards are not read."""
    stride = HEAD + 2 * length + TAIL
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).where(F.col("shard") >= start // shard)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = np.dtype([("id", "<i8"), ("part", "<i4"), ("n_tokens", "<i4"), ("tokens", "<u2", length), ("end", "u1")])
        assert kind.itemsize == stride
        met: set[int] = set()
        for batch in batches:
            for number, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows = np.frombuffer(content.as_buffer(), kind)
                if len(rows) > shard or number in met:
                    raise ValueError(f"shard {number} is not one file of at most {shard} sequences")
                met.add(number)
                slots = number * shard + np.arange(len(rows))
                rows, slots = rows[slots >= start], slots[slots >= start]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(slots), *[pa.array(rows[c].copy()) for c in ("id", "part", "n_tokens")],
                     _binary(rows["tokens"], np.full(len(rows), 2 * length))], names=["slot", "id", "part", "n_tokens", "tokens"])

    return files.select(F.col("shard").cast("long"), "content").mapInArrow(
        work, "slot long, id long, part int, n_tokens int, tokens binary")


def through_shards(df: DataFrame, model: bytes, path: str | None = None, id_col: str = "doc_id", text_col: str = "text",
                   length: int = LENGTH, shard: int = SHARD, key: int = KEY) -> DataFrame:
    """The columns of ``in_training_order``, as the shard files hold them that this writes.

    They stay, under ``path`` or else in a folder of their own in the shared one, until ``delete_shards``.
    """
    spark = df.sparkSession
    order = store_order(df, model, id_col, text_col, length, shard, key)
    if not order.total:
        return order.rows()
    path = path or f"{shared_folder(spark)}/shards-{uuid.uuid4().hex}"
    write_in_waves(order, path)
    order.scratch.drop(order.stored)
    stride = HEAD + 2 * length + TAIL
    return read_shards(spark, path, length, shard).select(
        "slot", F.floor(F.col("slot") / shard).alias("shard"), (F.col("slot") % shard * stride).alias("offset"),
        "id", "part", "n_tokens", "tokens")

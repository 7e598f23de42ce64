"""Operator 3: SimHash near-duplicates by tiled exact comparison.

A fingerprint bit is set if more than half of a text's shingle hashes have it.
Different fingerprints are laid in tiles of equal population counts: one count
for each of four segments of 16 bits. Two fingerprints cannot differ in fewer
bits than their counts differ in sum, so a tile is compared, by exclusive-or and
bit counts in numpy, only with tiles whose counts lie within the radius. No link
is lost and none is guessed.

Equal fingerprints are one row before the comparison, whatever their number, and
a tile pair hands on a spanning forest of the links it finds, so that hot groups
neither fill a task nor make pairs. A tile holds about ``TILE`` fingerprints; a
fuller set of counts is dealt over several tiles.

Defined results: null and empty texts and texts without words have fingerprint
zero, which links like any other; a text with fewer words than a shingle is one
shingle; repeated rows are rows of their own and group together; a row without
an id never names its component; an empty table gives an empty table; columns
other than the id and the text are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice, product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadbook.llm.common import Scratch, numbered, ship, type_of
from roadbook.llm.components import Forest, components

SHINGLE, RADIUS, SEED = 3, 2, 42
SEGMENTS = 4
TILE = 4096
# Shingles hashed, and pairs compared, at a time.
HASHED, COMPARED = 1 << 18, 1 << 20
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def shingle_hashes(text: bytes, size: int) -> Iterator[int]:
    # bytes.lower changes A-Z alone, and bytes.split knows just the six white-space bytes
    words = text.lower().split()
    shingles = zip(*(islice(words, i, None) for i in range(size))) if len(words) > size else [words] if words else []
    seed, join, hashed = SEED, b" ".join, xxhash.xxh64_intdigest
    return (hashed(join(s), seed) for s in shingles)


def fingerprint(text: bytes, size: int = SHINGLE) -> int:
    """The fingerprint as an unsigned number; long texts are hashed in parts."""
    hashes, total, ones = shingle_hashes(text, size), 0, np.zeros((8, 8), np.int64)
    while True:
        part = np.fromiter(islice(hashes, HASHED), np.uint64)
        if not len(part):
            break
        total += len(part)
        columns = part.astype(">u8").view(np.uint8).reshape(-1, 8)
        for i in range(8):
            ones[i] += np.bincount(columns[:, i], minlength=256) @ _BITS
    return int(np.packbits(2 * ones.ravel() > total).view(">u8")[0])


def fingerprints(df: DataFrame, text_col: str, keep: list[str], size: int = SHINGLE) -> DataFrame:
    """The columns ``keep`` and ``_print``, the fingerprint as a signed long."""
    ship(df.sparkSession)
    columns = keep if text_col in keep else [*keep, text_col]
    at = columns.index(text_col)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint((t or "").encode(), size) for t in batch.column(at).to_pylist()]
            signed = pa.array(np.array(prints, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], signed], names=[*keep, "__simhash_print"])

    schema = ", ".join([f"`{c}` {type_of(df, c)}" for c in keep] + ["__simhash_print long"])
    return df.select(*columns).mapInArrow(work, schema)


def _near(radius: int, segments: int) -> list[list[int]]:
    """Steps between population counts within the radius, one of each two opposite ones."""
    steps = [s for s in product(range(-radius, radius + 1), repeat=segments) if sum(map(abs, s)) <= radius]
    return [list(s) for s in steps if s >= (0,) * segments]


def links(prints: DataFrame, scratch: Scratch, radius: int = RADIUS, segments: int = SEGMENTS) -> DataFrame:
    """``a, b``: for different fingerprints, links that join all that lie within the radius.

    At most 17 to the power of ``segments`` different counts exist; that bounds
    the table of their frequencies.
    """
    width = 64 // segments
    counts = F.array(*[F.bit_count(F.shiftrightunsigned("print", i * width).bitwiseAND((1 << width) - 1)).cast("int")
                       for i in range(segments)])
    counted = prints.select("print", counts.alias("counts"))
    full = counted.groupBy("counts").agg(F.ceil(F.count(F.lit(1)) / TILE).alias("parts"))
    tiles = scratch.keep(
        counted.join(full, "counts")
        .withColumn("part", F.pmod(F.xxhash64("print"), "parts"))
        .groupBy("counts", "part").agg(F.collect_list("print").alias("prints")))

    steps = F.explode(F.array(*[F.array(*map(F.lit, s)) for s in _near(radius, segments)]))
    reach = (
        tiles.withColumn("step", steps)
        .withColumn("there", F.zip_with("counts", "step", lambda x, y: x + y))
        .select("counts", "part", F.col("prints").alias("here"), "there"))
    other = tiles.select(F.col("counts").alias("there"), F.col("part").alias("other"), F.col("prints").alias("prints"))
    same = F.col("counts") == F.col("there")
    pairs = (
        reach.join(other, "there")
        .where(~same | (F.col("part") <= F.col("other")))
        .select("here", "prints", (same & (F.col("part") == F.col("other"))).alias("same")))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for here, there, same in zip(*batch.columns):
                found = forest(here.values.to_numpy(), there.values.to_numpy(), same.as_py(), radius)
                if len(found):
                    yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], names=["a", "b"])

    return pairs.mapInArrow(work, "a long, b long")


def forest(here: np.ndarray, there: np.ndarray, same: bool, radius: int) -> np.ndarray:
    """Of the links between two tiles (or inside one), as many as it takes to join what they join."""
    joined = Forest()
    kept = []
    rows = max(1, COMPARED // max(1, len(there)))
    for start in range(0, len(here), rows):
        part = here[start: start + rows]
        near = np.bitwise_count(part[:, None] ^ there[None, :]) <= radius
        left, right = np.nonzero(near)
        if same:
            left, right = left[later := right > left + start], right[later]
        for a, b in zip(part[left].tolist(), there[right].tolist()):
            if joined.join(a, b):
                kept.append((a, b))
    return np.array(kept, np.int64).reshape(-1, 2)


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE,
                    radius: int = RADIUS) -> DataFrame:
    """``id_col, print, group, component_id`` for every row.

    ``group`` is the smallest fingerprint of the component, ``component_id`` its smallest id.
    """
    rows, named = _grouped(df, id_col, text_col, size, radius)
    return rows.join(named, "print").select(id_col, "print", "group", "component_id")


def _grouped(df: DataFrame, id_col: str, text_col: str, size: int, radius: int) -> tuple[DataFrame, DataFrame]:
    """Every row's id and print, and each print's group and component, both stored."""
    spark = df.sparkSession
    scratch = Scratch(spark, "simhash")
    rows = scratch.keep(fingerprints(df, text_col, [id_col], size).withColumnRenamed("__simhash_print", "print"))
    prints = scratch.keep(rows.groupBy("print").agg(F.min(id_col).alias("first")))
    found = scratch.keep(links(prints, scratch, radius))
    joined = components(found, scratch).withColumnRenamed("node", "print")
    grouped = (
        prints.join(joined, "print", "left")
        .withColumn("group", F.coalesce("component", "print")))
    least = grouped.groupBy("group").agg(F.min("first").alias("component_id"))
    return rows, scratch.keep(grouped.join(least, "group").select("print", "group", "component_id"))


def deduplicate(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE,
                radius: int = RADIUS) -> DataFrame:
    """One row of ``df`` for each component: one that has its smallest id, or none if no row of it has an id.

    Rows are judged by their texts: texts that share an id but are not linked are different
    components, and each keeps a row. Of several rows with the smallest id the one with
    the smallest hash stays. The caller's columns may have any names.
    """
    plain, names = numbered(df)
    id_, text, columns = names[id_col], names[text_col], list(names.values())
    rows, named = _grouped(plain, id_, text, size, radius)
    first = F.col(id_).eqNullSafe(F.col("component_id"))

    # an id that only one row has is told by the id; repeated and missing ones only with their text
    ids = (rows.join(named, "print").where(f"{id_} is not null").groupBy(F.col(id_).alias("one"))
           .agg(F.count(F.lit(1)).alias("rows"), F.bool_or(first).alias("stays")).where("stays"))
    sole = plain.join(ids.where("rows = 1").select("one"), F.col(id_) == F.col("one")).select(*columns)
    shared = plain.join(ids.where("rows > 1").select("one"), F.col(id_) == F.col("one"), "left_semi").unionByName(
        plain.where(f"{id_} is null"))
    judged = fingerprints(shared, text, columns, size).join(named, F.col("__simhash_print") == F.col("print")).where(first)
    # an aggregate, not a window: a component's rows are compared before they are shuffled
    kept = judged.groupBy("group").agg(F.min_by(F.struct(*columns), F.xxhash64(*columns)).alias("row")).select("row.*")
    return sole.unionByName(kept).toDF(*df.columns)


def as_hex(print_col: str = "print"):
    return F.lpad(F.lower(F.hex(print_col)), 16, "0")

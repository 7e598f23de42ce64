"""Operator 11: ranked lexical search, Block-Max MaxScore over document shards.

An index is a table. Documents are dealt to shards of a bounded size, as they are
read; a shard numbers its documents by length, shortest first, and holds one row
for each of its terms: postings in blocks of ``BLOCK``, each block packed to the
bytes that its numbers need and told by its first and last document and its
highest count. As documents are numbered by length, the first one of a block is
its shortest, so that and the highest count bound what a posting of the block can
score, once the statistics of the whole corpus are known.

A search works a shard at a time. For each query a term's highest block bound is
its list's bound. Lists are ordered by it; those whose bounds together stay below
the k-th best score so far are non-essential: a document that occurs in them alone
cannot win. Windows of documents are scored from the essential lists; what a
document may still get from the others is first bounded by their lists, then by
their blocks, and only blocks of documents that can still win are unpacked. The
shards' k best are merged by Spark, which keeps k rows a query before it shuffles.

Queries are dealt over groups of about ``ITEMS``; a group meets a shard through
the terms they share.

Defined results: a null text has no term, and a document or query without terms
finds and is found by nothing; scores of 0 are left out; equal scores by ascending
id, a null id last; ids are whole numbers; repeated rows of documents are
documents of their own, queries that are repeated with id and text are asked once;
an empty table gives an empty table; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadbook.llm.common import Scratch, ship

K = 10
# Postings of a block; bytes of text in a shard (a longer document is one by itself); documents scored at once.
BLOCK = 128
SHARD_BYTES = 16 << 20
WINDOW = 2048
# Queries that are answered together, about.
ITEMS = 1024

# Bytes that part terms, and A-Z in lower case; bytes from 0x80 on belong to terms.
_SPACE = 0x20
_FOLD = np.arange(256, dtype=np.uint8)
for _low, _high in ((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)):
    _FOLD[_low:_high + 1] = _SPACE
_FOLD[0x41:0x5B] += 0x20

INDEX = "shard long, term string, df int, total long, bounds binary, postings binary"
_ARROW = pa.schema([("shard", pa.int64()), ("term", pa.string()), ("df", pa.int32()), ("total", pa.int64()),
                    ("bounds", pa.binary()), ("postings", pa.binary())])


def _strings(starts: np.ndarray, data: np.ndarray, kind: pa.DataType) -> pa.Array:
    """An array of the pieces of ``data``; ``starts`` has one more entry than there are pieces."""
    return pa.Array.from_buffers(kind, len(starts) - 1, [None, pa.py_buffer(starts.astype(np.int32)), pa.py_buffer(data)])


def terms_of(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """All terms of the texts in order, and the number of each one's text."""
    texts = texts.fill_null("")
    if not isinstance(texts, pa.StringArray):
        texts = texts.cast(pa.string())
    _, places, data = texts.buffers()
    places = np.frombuffer(places, np.int32)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int32)
    raw = np.frombuffer(data, np.uint8)[places[0]:places[-1]] if data is not None else np.zeros(0, np.uint8)
    places = places - places[0]
    folded = _FOLD[raw]
    inside = folded != _SPACE
    cut = np.zeros(len(raw) + 1, bool)  # a text's first byte never goes on with the term before it
    cut[places] = True
    before, after = np.ones(len(raw), bool), np.ones(len(raw), bool)
    before[1:] = ~inside[:-1]
    after[:-1] = ~inside[1:]
    starts = np.flatnonzero(inside & (before | cut[:-1]))
    ends = np.flatnonzero(inside & (after | cut[1:]))
    bounds = np.concatenate([[0], np.cumsum(ends - starts + 1)])
    terms = _strings(bounds, folded[inside], pa.string()).dictionary_encode()
    return terms, np.searchsorted(places, starts, side="right") - 1


def _bytes_for(highest: np.ndarray) -> np.ndarray:
    return np.where(highest < 1 << 8, 1, np.where(highest < 1 << 16, 2, 4))


def _pack(out: np.ndarray, at: np.ndarray, width: np.ndarray, value: np.ndarray) -> None:
    """Write each value, low byte first, to its place."""
    for k in range(4):
        wide = width > k
        if not wide.any():
            break
        out[at[wide] + k] = (value[wide] >> 8 * k) & 255


def _shard(number: int, ids: pa.Array, texts: pa.Array) -> pa.RecordBatch:
    """The index rows of one shard: its documents (term null), then its lists."""
    terms, text = terms_of(texts)
    length = np.bincount(text, minlength=len(texts))
    order = np.argsort(length, kind="stable")
    order = order[length[order] > 0]  # a text without terms is no document
    place = np.zeros(len(texts), np.int64)
    place[order] = np.arange(len(order))
    known = ids.take(pa.array(order))
    held = np.concatenate([known.fill_null(0).to_numpy().astype(np.int64), length[order].astype(np.int64)])
    documents = [[number], [None], [len(order)], [len(text)], [known.is_null().to_numpy(False).tobytes()], [held.tobytes()]]

    size = max(1, len(order))
    found, count = np.unique(terms.indices.to_numpy().astype(np.int64) * size + place[text], return_counts=True)
    term, doc = np.divmod(found, size)
    begins = np.flatnonzero(np.diff(term, prepend=-1))
    df = np.diff(np.append(begins, len(term)))
    nth = np.arange(len(term)) - np.repeat(begins, df)
    first_of = np.flatnonzero(nth % BLOCK == 0)  # where blocks begin
    held_in = np.diff(np.append(first_of, len(term)))
    first, last = doc[first_of], doc[first_of + held_in - 1]
    most = np.maximum.reduceat(count, first_of) if len(first_of) else first_of
    for_doc, for_count = _bytes_for(last - first), _bytes_for(most)
    at = np.concatenate([[0], np.cumsum(held_in * (for_doc + for_count))])
    block, within = np.repeat(np.arange(len(first_of)), held_in), nth % BLOCK
    packed = np.zeros(at[-1], np.uint8)
    _pack(packed, at[block] + within * for_doc[block], for_doc[block], doc - first[block])
    _pack(packed, (at[:-1] + held_in * for_doc)[block] + within * for_count[block], for_count[block], count)

    list_of_block = np.cumsum(nth[first_of] == 0)  # counted from 1
    blocks = np.concatenate([[0], np.cumsum(np.bincount(list_of_block, minlength=len(df) + 1)[1:])])
    bounds = np.stack([first, last, most], axis=1).astype(np.int32)
    lists = [np.full(len(df), number), terms.dictionary.take(pa.array(term[begins])), df.astype(np.int32),
             np.add.reduceat(count, begins) if len(begins) else begins,
             _strings(blocks * 12, bounds.view(np.uint8).ravel(), pa.binary()), _strings(at[blocks], packed, pa.binary())]
    columns = [pa.concat_arrays([pa.array(a, f.type), b.cast(f.type) if isinstance(b, pa.Array) else pa.array(b, f.type)])
               for f, a, b in zip(_ARROW, documents, lists)]
    return pa.RecordBatch.from_arrays(columns, schema=_ARROW)


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    base, number = TaskContext.get().partitionId() << 32, 0
    waiting: list[pa.RecordBatch] = []
    size = 0

    def made() -> pa.RecordBatch:
        whole = pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]
        return _shard(base + number, whole.column(0), whole.column(1))

    for batch in batches:
        long = np.concatenate([[0], np.cumsum(pc.binary_length(batch.column(1)).fill_null(0).to_numpy().astype(np.int64))])
        start = 0
        while start < batch.num_rows:
            # as many rows as still fit, one at least
            end = int(np.searchsorted(long, long[start] + SHARD_BYTES - size, side="right")) - 1
            if end <= start and size == 0:
                end = start + 1
            if end > start:
                waiting.append(batch.slice(start, end - start))
                size += int(long[end] - long[start])
                start = end
            if start < batch.num_rows or size >= SHARD_BYTES:
                yield made()
                number, waiting, size = number + 1, [], 0
    if waiting:
        yield made()


def build_index(df: DataFrame, scratch: Scratch | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document in its shard, stored: ``INDEX``, with one row of ids and lengths and one a term for each shard."""
    ship(df.sparkSession)
    scratch = scratch or Scratch(df.sparkSession, "lexical")
    rows = df.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    return scratch.keep(rows.mapInArrow(_shards, INDEX))


def statistics(index: DataFrame) -> tuple[int, int]:
    """Documents with a term, and all their terms."""
    row = index.where("term is null").agg(F.sum(F.col("df").cast("long")), F.sum("total")).first()
    return row[0] or 0, row[1] or 0


def _query_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        terms, text = terms_of(batch.column(1))
        size = max(1, len(terms.dictionary))
        found, count = np.unique(text.astype(np.int64) * size + terms.indices.to_numpy(), return_counts=True)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(found // size)), terms.dictionary.take(pa.array(found % size)), pa.array(count, pa.int64())],
            names=["query", "term", "times"])


class _List:
    """A term's postings in one shard: block bounds at once, blocks when they are asked for."""

    def __init__(self, df: int, bounds: bytes, packed: bytes, shard: _Shard):
        self.shard, self.packed = shard, packed
        self.first, self.last, most = np.frombuffer(bounds, np.int32).reshape(-1, 3).astype(np.int64).T
        self.held = np.full(len(self.first), BLOCK)
        self.held[-1] = df - BLOCK * (len(self.first) - 1)
        self.for_doc, self.for_count = _bytes_for(self.last - self.first), _bytes_for(most)
        self.at = np.concatenate([[0], np.cumsum(self.held * (self.for_doc + self.for_count))])
        self.bound = impact(most, shard.slack[self.first])
        self.highest = int(self.bound.max())
        self.unpacked: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def block(self, b: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and what a posting in them is worth, before the term's weight."""
        if b not in self.unpacked:
            at, held, wide, high = int(self.at[b]), int(self.held[b]), int(self.for_doc[b]), int(self.for_count[b])
            docs = np.frombuffer(self.packed, f"<u{wide}", held, at) + self.first[b]
            counts = np.frombuffer(self.packed, f"<u{high}", held, at + held * wide).astype(np.int64)
            self.unpacked[b] = docs, impact(counts, self.shard.slack[docs])
        return self.unpacked[b]

    def within(self, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        """All postings in documents from low up to high."""
        blocks = range(int(np.searchsorted(self.last, low)), int(np.searchsorted(self.first, high)))
        if not blocks:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        docs, worth = (np.concatenate(x) for x in zip(*map(self.block, blocks)))
        a, b = np.searchsorted(docs, (low, high))
        return docs[a:b], worth[a:b]

    def blocks_of(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The block that a document is in, if any, and its bound, 0 if none."""
        b = np.searchsorted(self.last, docs)
        there = b < len(self.last)
        there[there] = self.first[b[there]] <= docs[there]
        return b, np.where(there, self.bound[np.minimum(b, len(self.last) - 1)], 0)

    def worth_in(self, docs: np.ndarray, blocks: np.ndarray) -> np.ndarray:
        """Exact worth in documents that may be in the given blocks."""
        worth = np.zeros(len(docs), np.int64)
        for b in np.unique(blocks).tolist():
            mine = np.flatnonzero(blocks == b)
            held, value = self.block(b)
            at = np.minimum(np.searchsorted(held, docs[mine]), len(held) - 1)
            worth[mine] = np.where(held[at] == docs[mine], value[at], 0)
        return worth


def impact(count: np.ndarray, slack: np.ndarray) -> np.ndarray:
    """A posting's worth: it grows with the count and falls with the document's length."""
    return (1_000_000_000 * count) // (1000 * count + 8 * slack)


class _Shard:
    def __init__(self, missing: bytes, held: bytes, documents: int, all_terms: int):
        ids, self.length = np.frombuffer(held, np.int64).reshape(2, -1)
        self.missing = np.frombuffer(missing, bool)
        self.ids = np.where(self.missing, np.iinfo(np.int64).max, ids)
        # the length term of a score; beyond 64 bits in whole numbers of any size
        longest = int(self.length.max(initial=0))
        length = self.length if 75 * longest * documents < 2**63 else self.length.astype(object)
        self.slack = (25 + (75 * length * documents) // all_terms).astype(np.int64)

    def best(self, lists: list[_List], weight: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k best documents for a query of lists with weights, and their scores."""
        bounds = np.array([t.highest for t in lists]) * weight
        order = np.argsort(bounds, kind="stable")
        lists, weight = [lists[i] for i in order], weight[order]
        reach = np.cumsum(bounds[order])  # what the lists up to each one may give together
        docs, scores, least = np.zeros(0, np.int64), np.zeros(0, np.int64), 1
        for low in range(0, len(self.ids), WINDOW):
            high = min(low + WINDOW, len(self.ids))
            essential = int(np.searchsorted(reach, least))  # lists before it cannot reach the k-th best together
            if essential == len(lists):
                break
            sums = np.zeros(high - low, np.int64)
            for t, w in zip(lists[essential:], weight[essential:]):
                at, worth = t.within(low, high)
                sums[at - low] += w * worth
            some = np.flatnonzero(sums)
            if essential:
                some = some[sums[some] + reach[essential - 1] >= least]
            if not len(some):
                continue
            have = sums[some]
            some = some + low
            # block maxima of the others bound what is still to come, before any block is unpacked
            blocks, most = [], []
            for t, w in zip(lists[:essential], weight[:essential]):
                b, bound = t.blocks_of(some)
                blocks.append(b)
                most.append(w * bound)
            may = have + np.sum(most, axis=0, dtype=np.int64) if most else have
            for i in range(essential - 1, -1, -1):
                alive = np.flatnonzero(may >= least)
                if len(alive) < len(some):
                    some, have, may = some[alive], have[alive], may[alive]
                    blocks, most = [b[alive] for b in blocks], [m[alive] for m in most]
                meets = np.flatnonzero(most[i])
                if len(meets):
                    worth = weight[i] * lists[i].worth_in(some[meets], blocks[i][meets])
                    have[meets] += worth
                    may[meets] += worth - most[i][meets]
            good = np.flatnonzero(have >= least)
            docs, scores = np.concatenate([docs, some[good]]), np.concatenate([scores, have[good]])
            if len(docs) > k:
                kept = np.lexsort((self.ids[docs], -scores))[:k]
                docs, scores = docs[kept], scores[kept]
            if len(docs) == k:
                least = max(1, int(scores.min()))
        return docs, scores


_FOUND = pa.schema([("query", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])


def _search(rows: pa.Table, documents: int, all_terms: int, k: int) -> pa.Table:
    """The k best documents of a shard for each query of a group."""
    rows = rows.combine_chunks()
    term = rows["term"]
    own = rows.filter(term.is_null())
    shard = _Shard(own["bounds"][0].as_py(), own["postings"][0].as_py(), documents, all_terms)
    queries: dict[int, list[tuple[_List, int]]] = {}
    met = rows.filter(term.is_valid()).select(["df", "bounds", "postings", "weight", "uses"])
    for df, bounds, packed, weight, uses in zip(*[c.to_pylist() for c in met.columns]):
        postings = _List(df, bounds, packed, shard)
        for use in uses:
            queries.setdefault(use["query"], []).append((postings, weight * use["times"]))
    found = []
    for query, terms in queries.items():
        docs, scores = shard.best([t for t, _ in terms], np.array([w for _, w in terms], np.int64), k)
        found.append(pa.Table.from_arrays([
            pa.array(np.full(len(docs), query)), pa.array(shard.ids[docs], mask=shard.missing[docs]), pa.array(scores)], schema=_FOUND))
    return pa.concat_tables(found) if found else _FOUND.empty_table()


def search(index: DataFrame, queries: DataFrame, scratch: Scratch | None = None, id_col: str = "item_id",
           text_col: str = "text", k: int = K) -> DataFrame:
    """``query_id, rank, doc_id, score``: the k best documents of the index for each query."""
    spark = index.sparkSession
    ship(spark)
    scratch = scratch or Scratch(spark, "lexical")
    documents, all_terms = statistics(index)
    asked = scratch.keep(queries.select(F.col(id_col).alias("query_id"), F.col(text_col).cast("string").alias("text")).distinct()
                         .withColumn("query", F.monotonically_increasing_id()))
    groups = max(1, -(-asked.count() // ITEMS))
    wanted = scratch.keep(asked.select("query", "text").mapInArrow(_query_terms, "query long, term string, times long"))

    # the weight of each term that is asked for, from all its lists
    lists = index.where("term is not null")
    df = lists.select("term", "df").join(wanted.select("term").distinct(), "term").groupBy("term").agg(F.sum("df").alias("n"))
    weight = F.floor(1000 * F.log(F.lit(2.0 * documents + 2) / (2 * F.col("n") + 1)))
    uses = (wanted.join(df, "term").select("term", weight.alias("weight"), "query", "times").where("weight > 0")
            .withColumn("group", F.pmod(F.xxhash64("query"), F.lit(groups)).cast("int"))
            .groupBy("group", "term", "weight").agg(F.collect_list(F.struct("query", "times")).alias("uses")))
    uses = scratch.keep(uses)

    columns = ["group", "shard", "term", "df", "bounds", "postings", "weight", "uses"]
    met = lists.join(uses, "term").select(*columns)
    own = index.where("term is null and df > 0").select(
        F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"), "shard", "term", "df", "bounds", "postings",
        F.lit(None).cast("long").alias("weight"), F.lit(None).cast(uses.schema["uses"].dataType).alias("uses"))
    found = met.union(own).groupBy("group", "shard").applyInArrow(
        lambda rows: _search(rows, documents, all_terms, k), "query long, doc_id long, score long")
    best = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(best).cast("int")).where(F.col("rank") <= k)
    return ranked.join(asked.select("query", "query_id"), "query").select("query_id", "rank", "doc_id", "score")

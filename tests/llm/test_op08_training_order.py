"""Operator 8: exact round trips of the permutation, the order and the files."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest
import sentencepiece

from roadbook.llm import training_order as to
from roadbook.llm.queries import PIECES, QUERIES
from roadbook.llm.sentencepiece_codec import read_model

from .conftest import TINY


@pytest.mark.parametrize("n", [1, 2, 3, 16, 17, 1000, 4097])
def test_permutation(n):
    one = to.permute(np.arange(n), n)
    assert sorted(one.tolist()) == list(range(n))
    assert to.permute(one, n, back=True).tolist() == list(range(n))
    if n >= 1000:
        assert (one != to.permute(np.arange(n), n, key=7)).mean() > 0.9
        assert abs(np.corrcoef(np.arange(n), one)[0, 1]) < 0.1


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


def plain(rows, library, length):
    """Every sequence of every document, filled up with the unknown id."""
    out = Counter()
    for i, text in rows:
        ids = library.encode(text or "") + [library.eos_id()]
        for part, start in enumerate(range(0, len(ids), length)):
            some = ids[start: start + length]
            out[-1 if i is None else i, part, len(some), tuple(some + [0] * (length - len(some)))] += 1
    return out


def found(rows, id_col="id"):
    return Counter((-1 if r[id_col] is None else r[id_col], r.part, r.n_tokens, tuple(np.frombuffer(r.tokens, "<u2").tolist())) for r in rows)


def test_query_holds_every_token_once(spark, documents, library):
    rows = QUERIES["op8_training_order"](spark, TINY).collect()
    assert found(rows, "doc_id") == plain([(r.doc_id, r.text) for r in documents.collect()], library, to.LENGTH)
    assert sorted(r.slot for r in rows) == list(range(len(rows)))
    assert all(r.shard == r.slot // to.SHARD and r.offset == r.slot % to.SHARD * (to.HEAD + 2 * to.LENGTH + to.TAIL) for r in rows)


def test_files_round_trip_and_resume(spark, strange, library, tmp_path):
    ordered = to.in_training_order(strange, read_model(PIECES), length=7, shard=50)
    path = str(tmp_path / "shards")
    to.write_shards(ordered, path)
    back = to.read_shards(spark, path, length=7, shard=50).collect()
    assert found(back) == plain([(r.doc_id, r.text) for r in strange.collect()], library, 7)
    assert {r.slot: bytes(r.tokens) for r in back} == {r.slot: bytes(r.tokens) for r in ordered.collect()}
    later = to.read_shards(spark, path, length=7, shard=50, start=123).collect()
    assert sorted(r.slot for r in later) == list(range(123, len(back)))
    files = list((tmp_path / "shards").glob("shard=*/part-*"))
    assert len(files) == -(-len(back) // 50) and {f.stat().st_size % (16 + 14 + 1) for f in files} == {0}


def test_empty(spark, strange):
    assert to.in_training_order(strange.limit(0), read_model(PIECES)).count() == 0


def test_query_returns_what_its_shards_hold(spark, documents, monkeypatch):
    paths, write = [], to.write_in_waves
    monkeypatch.setattr(to, "write_in_waves", lambda order, path: (paths.append(path), write(order, path)))
    frame = QUERIES["op8_training_order"](spark, TINY)
    rows = {r.slot: (r.shard, r.offset, r.doc_id, r.part, r.n_tokens, bytes(r.tokens)) for r in frame.collect()}
    ordered = to.in_training_order(documents, read_model(PIECES))
    assert [t for _, t in frame.dtypes] == [t for _, t in ordered.dtypes] and frame.columns == ["slot", "shard", "offset", "doc_id", *ordered.columns[4:]]
    assert {r.slot: (r.shard, r.offset, r.id, r.part, r.n_tokens, bytes(r.tokens)) for r in ordered.collect()} == rows
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(paths[0]).select("shard", "content").collect()
    contents, stride = {f.shard: bytes(f.content) for f in files}, to.HEAD + 2 * to.LENGTH + to.TAIL
    assert len(files) == len(contents) and sum(map(len, contents.values())) == stride * len(rows)
    for shard, offset, doc_id, part, n_tokens, tokens in rows.values():
        record = contents[shard][offset: offset + stride]
        assert record[:16] == doc_id.to_bytes(8, "little") + part.to_bytes(4, "little") + n_tokens.to_bytes(4, "little")
        assert record[16:-1] == tokens


def test_no_documents_no_shards(spark, documents):
    assert to.through_shards(documents.limit(0), read_model(PIECES)).count() == 0


def slots(rows):
    return {r.slot: (r.id, r.part, bytes(r.tokens)) for r in rows}


def test_order_does_not_depend_on_layout(spark, strange):
    model = read_model(PIECES)
    one = to.in_training_order(strange.coalesce(1), model, length=7, shard=50).collect()
    other = to.in_training_order(strange.repartition(5, "text"), model, length=7, shard=50).collect()
    assert slots(one) == slots(other)


def test_copies_met_often_are_dealt_apart(spark, library, monkeypatch):
    monkeypatch.setattr(to, "COPIES", 4)
    rows = [(7, "the same text")] * 30 + [(None, None)] * 20 + [(8, "another one")]
    keys = np.array([5] * 10 + [6], np.int64)
    apart = to._apart(keys, Counter())
    assert apart[:4].tolist() == [5] * 4 and apart[-1] == 6 and len(set(apart[:10].tolist())) == 3
    back = to.through_shards(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), read_model(PIECES), length=3, shard=5).collect()
    assert found(back) == plain(rows, library, 3) and sorted(r.slot for r in back) == list(range(len(back)))


@pytest.mark.parametrize("waves", [1, 3, 50])
def test_waves_write_the_same_shards(spark, strange, tmp_path, waves):
    order = to.store_order(strange, read_model(PIECES), length=7, shard=50)
    to.write_in_waves(order, str(tmp_path / "shards"), waves)
    back = to.read_shards(spark, str(tmp_path / "shards"), length=7, shard=50).collect()
    assert slots(back) == {s: (-1 if i is None else i, p, t) for s, (i, p, t) in slots(order.rows().collect()).items()}
    to.delete_shards(spark, str(tmp_path / "shards"))
    assert not (tmp_path / "shards").exists()


def test_refusals(spark, documents, strange, tmp_path):
    with pytest.raises(TypeError, match="whole numbers"):
        to.in_training_order(documents.selectExpr("string(doc_id) as doc_id", "text"), read_model(PIECES))
    path = str(tmp_path / "shards")
    order = to.store_order(strange, read_model(PIECES), length=7, shard=50)
    to.write_in_waves(order, path)
    to.write_shards(order.rows(), path, "append")  # a second file in every shard
    with pytest.raises(Exception, match="not one file"):
        to.read_shards(spark.newSession(), path, length=7, shard=50).repartition(1).count()

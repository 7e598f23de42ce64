"""The pipeline's stages, each against a plain version on what the stage before it kept."""

from __future__ import annotations

from collections import Counter

import sentencepiece

import corpus_pipeline
from roadbook.llm import mixing, toxicity
from roadbook.llm.common import table
from roadbook.llm.queries import PIECES

from .conftest import TINY
from .test_op03_simhash import plain_components, plain_print
from .test_op07_mixing import as_rows, plain


def test_stages_one_by_one(spark, tmp_path):
    docs, columns = table(spark, TINY, "documents"), table(spark, TINY, "documents").columns
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, TINY)
        made.write.parquet(str(tmp_path / name.replace(" ", "_")))
        docs = spark.read.parquet(str(tmp_path / name.replace(" ", "_")))
        kept.append(docs)
    clean, single, mixed, coded = kept
    assert clean.columns == single.columns == mixed.columns == columns

    labels = table(spark, TINY, "labels")
    documents = table(spark, TINY, "documents")
    chain, _ = toxicity.train(documents, labels, toxicity.categories())
    toxic = {r.doc_id for r in documents.collect() if chain.predict([r.text])[0, -1] >= chain.thresholds[-1]}
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in documents.collect()} - toxic

    rows = sorted((r.doc_id, r.text) for r in clean.collect())
    groups = plain_components([plain_print(t) for _, t in rows])
    assert {r.doc_id for r in single.collect()} == {rows[g][0] for g in groups}

    turns = {i[1]: n for i, _, n in plain(as_rows(single))}
    assert Counter(r.doc_id for r in mixed.collect()) == +Counter(turns)

    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    texts = {r.doc_id: r.text for r in mixed.collect()}
    assert Counter((r.doc_id, tuple(r.ids)) for r in coded.collect()) == Counter(
        (i, tuple(library.encode(texts[i] or ""))) for i in [r.doc_id for r in mixed.collect()])


def test_run_gives_the_last_stage(spark):
    rows = corpus_pipeline.run(spark, TINY)
    assert rows.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"] and rows.count() > 0


def test_stages_on_strange_rows(spark, strange):
    """Nulls, empty and long texts, repeated rows, a null id and columns named as the operators name theirs."""
    docs = strange.selectExpr("*", "size as __mix_key", "key as __simhash_print", "id as print", "size as n_tokens_")
    docs = corpus_pipeline.drop_near_duplicates(spark, docs, TINY)
    single = [tuple(r) for r in docs.collect()]
    assert docs.columns[-4:] == ["__mix_key", "__simhash_print", "print", "n_tokens_"]
    assert len(single) == len({plain_print(r[1]) for r in single}) and all(r[3] == r[6] for r in single)
    mixed = corpus_pipeline.mix_sources(spark, docs, TINY)
    assert mixed.columns == docs.columns and all(r["__mix_key"] == r["size"] for r in mixed.collect())
    assert set(map(tuple, mixed.collect())) <= set(single)
    coded = corpus_pipeline.encode_pieces(spark, mixed, TINY)
    assert coded.count() == mixed.count()
    for stage in (corpus_pipeline.drop_near_duplicates, corpus_pipeline.mix_sources, corpus_pipeline.encode_pieces):
        assert stage(spark, strange.limit(0), TINY).count() == 0


def test_repeated_runs_agree(spark, strange):
    one, two = (sorted((str(r.doc_id), r.turns) for r in mixing.queue(strange).collect()) for _ in range(2))
    assert one == two

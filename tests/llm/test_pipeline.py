from __future__ import annotations

import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline as C
from gridloom.llm import sentence_pieces as SP
from gridloom.llm.tables import read

from .fixtures import DOCS, brute_jaccard, brute_lines, documents


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([r for r in documents() if r[0] is not None], DOCS)


def test_stages_keep_the_columns(spark, docs, sf_dir):
    for name, stage in C.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns, name
        assert stage(spark, docs.limit(0), sf_dir).count() == 0


def test_lines_stage(spark, docs, sf_dir):
    rows = [tuple(r) for r in docs.collect()]
    want = sorted((i, t) for i, _, dropped, t in brute_lines(rows, 40, 5) if dropped)
    got = C.lines(spark, docs, sf_dir).collect()
    changed = {i for i, _ in want}
    assert sorted((r.doc_id, r.text) for r in got if r.doc_id in changed) == want and len(got) == len(rows)
    assert all(r.n_chars == len(r.text) for r in got if r.doc_id in changed)


def test_one_of_each_group_stays(spark, docs, sf_dir):
    rows = [tuple(r) for r in docs.collect()]
    want = sorted(i for i, _, c in brute_jaccard(rows, 5, 80, 100) if i == c)
    assert sorted(r.doc_id for r in C.near_copies(spark, docs, sf_dir).collect()) == want


def test_quality_keeps_most_good_rows_and_drops_most_bad_ones(spark, sf_dir):
    sf = sf_dir.replace("sf0.001", "sf0.01")
    kept = C.quality(spark, read(spark, sf, "documents"), sf).select("doc_id", F.lit(True).alias("kept")).distinct()
    by = read(spark, sf, "labels").join(kept, "doc_id", "left").groupBy("quality").agg(F.avg(F.coalesce("kept", F.lit(False)).cast("int")).alias("share"))
    share = {r.quality: r.share for r in by.collect()}
    assert share[1] > 0.97 and share[0] < 0.2


def test_run(spark, sf_dir):
    out = C.run(spark, sf_dir).collect()
    library = sentencepiece.SentencePieceProcessor(model_file=SP.MODEL)
    assert out and all(r.round_trip and r.n_pieces == len(r.ids) for r in out)
    texts = {r.doc_id: r.text for r in read(spark, sf_dir, "documents").collect()}
    whole = [r for r in out if library.encode(texts[r.doc_id]) == list(r.ids)]
    assert len(whole) > 0.5 * len(out)  # the others lost lines


def test_written_tables_go_with_their_scratch(spark, tmp_path, monkeypatch):
    from gridloom.llm import tables as T

    monkeypatch.setattr(T, "shared_dir", lambda spark: str(tmp_path))
    before = spark.conf.get("spark.checkpoint.dir", None)
    with T.scratch():
        assert T.materialize(spark.range(5)).count() == 5 and len(list(tmp_path.iterdir())) == 1
    assert list(tmp_path.iterdir()) == [] and spark.conf.get("spark.checkpoint.dir", None) == before

"""The corpus pipeline: each stage against a plain version on its own input, and hard rows."""

import collections
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from listflow.llm import boosting, line_rules, mixing, packing, quality, queries
from listflow.llm.textbytes import flat
from tests.llm.test_operators import COLUMNS, hard_rows, plain_join, word_list


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    docs, out, folder = queries.table(spark, sf_dir, "documents"), [], tmp_path_factory.mktemp("stages")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        made = stage(spark, docs, sf_dir)
        made.write.parquet(f"{folder}/{k}")
        out.append((docs.collect(), spark.read.parquet(f"{folder}/{k}").collect()))
        docs = spark.read.parquet(f"{folder}/{k}")
    return out


def test_stage_names_and_columns(spark, sf_dir, stages):
    assert len(corpus_pipeline.STAGES) == 5
    names = queries.table(spark, sf_dir, "documents").columns
    assert all(list(rows[0].asDict()) == names for _, rows in stages[:-1])


def test_quality_stage(spark, sf_dir, stages):
    before, after = stages[0]
    known = {r.doc_id: r.quality for r in queries.table(spark, sf_dir, "labels").collect()}
    learn = sorted(r.doc_id for r in before if r.doc_id in known and zlib.crc32(str(r.doc_id).encode()) % 5)
    text = {r.doc_id: r.text for r in before}
    x = quality.document_statistics(*flat(pa.array([text[i] for i in learn])))
    forest = boosting.fit(x, np.array([known[i] for i in learn], float))
    score = forest.scores(quality.document_statistics(*flat(pa.array([r.text for r in before]))))
    assert sorted(r.doc_id for r in after) == sorted(r.doc_id for r, s in zip(before, score) if s >= 0.3)


def test_rules_stage(stages):
    before, after = stages[1]
    judged = {r.doc_id: line_rules.judged(r.text or "") for r in before}
    assert {r.doc_id: (r.text, r.n_chars) for r in after} == {
        i: (j[-1], len(j[-1])) for i, j in judged.items() if j[6]}


def test_duplicate_stage(stages):
    before, after = stages[2]
    assert sorted(r.doc_id for r in after) == sorted({c for _, c, _ in plain_join([(r.doc_id, r.text) for r in before])})


def test_mixing_stage(spark, stages):
    before, after = stages[3]
    mixed = mixing.mix(spark.createDataFrame(before)).collect()
    text = {r.doc_id: r.text for r in before}
    times = collections.Counter(r.doc_id for r in after)
    assert all(r.text == text[r.doc_id] for r in after)
    cut = [r for r in mixed if r.taken != times[r.doc_id] * r.size]
    assert len({r.source for r in cut}) == len(cut)
    assert all(2 * abs(r.taken - times[r.doc_id] * r.size) <= r.size for r in cut)


def test_packing_stage(stages):
    before, after = stages[4]
    encode = packing.encoder(queries.vocabulary())
    tokens = sum(len(ids) + 1 for ids in encode([r.text for r in before]))
    assert tokens == sum(r.length for r in after)


def test_run_gives_the_last_stage(spark, sf_dir, stages):
    got = corpus_pipeline.run(spark, sf_dir).select("doc_id", "start", "length", "ids_crc32").collect()
    assert sorted(map(tuple, got)) == sorted((r.doc_id, r.start, r.length, r.ids_crc32) for r in stages[-1][1])


def test_stages_on_hard_rows(spark, sf_dir):
    docs = spark.createDataFrame(hard_rows(), COLUMNS)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        made = stage(spark, docs, sf_dir)
        assert made.columns == docs.columns
        extra = {(r.score, r.row, r.kept, r._row) for r in made.collect()}
        assert extra <= {(9.0, "r", True, 2), (None, None, None, None)}
        assert stage(spark, docs.filter("false"), sf_dir).count() == 0
    last = corpus_pipeline.STAGES[-1][1]
    assert last(spark, docs, sf_dir).select(F.sum("length")).first()[0] > 0
    assert last(spark, docs.filter("false"), sf_dir).count() == 0

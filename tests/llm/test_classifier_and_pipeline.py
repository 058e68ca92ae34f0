"""The classifier on rows it has not learnt from, and the pipeline stage by stage."""

from __future__ import annotations

import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from lakeloom.llm import QUERIES, load_all, quality_classifier
from lakeloom.llm.decontaminate import normalised
from lakeloom.llm.queries import vocabulary_path
from tests.llm.conftest import documents
from tests.llm.test_near_dedup import brute

load_all()
NUMBERS = {f"op{n}" for n in range(1, 11)}


def test_all_are_registered():
    names = entry.queries()
    assert {k.split("_")[0] for k in names if re.match(r"op\d+_", k)} == NUMBERS and "pipeline" in names


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    rows = QUERIES["op3_quality_classifier"](spark, folder).collect()
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    right = {0: [], 1: []}
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
        if r["held_out"] and r["doc_id"] in labels:
            right[labels[r["doc_id"]]].append(r["predicted"] == labels[r["doc_id"]])
    assert np.mean(right[1]) >= 0.95 and np.mean(right[0]) >= 0.85


def test_densities_as_the_textbook(spark):
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(0, 1, (80, 15)), rng.normal(1, 2, (120, 15))])
    y = [0] * 80 + [1] * 120
    rows = spark.createDataFrame([(int(k), [float(v) for v in row]) for k, row in zip(y, x, strict=True)], "quality int, x array<double>")
    model = quality_classifier.fit(rows)
    parts = [x[:80], x[80:]]
    covariances = [np.cov(p.T, bias=True) for p in parts]
    common = (80 * covariances[0] + 120 * covariances[1]) / 200
    a, b = quality_classifier.TO_DIAGONAL, quality_classifier.TO_COMMON
    common = (1 - a) * common + a * np.diag(np.diag(common))
    logs = []
    for p, c, prior in zip(parts, covariances, (0.4, 0.6), strict=True):
        c = (1 - b) * c + b * common
        d = x - p.mean(axis=0)
        density = np.linalg.slogdet(c)[1] + np.einsum("ij,jk,ik->i", d, np.linalg.inv(c), d)
        logs.append(np.log(prior) - 0.5 * density / quality_classifier.TEMPERATURE)
    assert model.score(x) == pytest.approx(1 / (1 + np.exp(logs[0] - logs[1])))


def test_classifier_of_messy_rows(spark, messy, nothing):
    vectors = quality_classifier.measured(messy)
    assert vectors.columns == ["doc_id", "x"] and vectors.count() == messy.count()
    labels = spark.createDataFrame([(1, 1), (6, 0), (None, 0)], "doc_id long, quality int")
    for known, expected in ((labels, None), (labels.where("quality = 1"), 1.0), (labels.where("false"), 0.5)):
        model = quality_classifier.fit(vectors.join(known, "doc_id"))
        scores = [r["score"] for r in quality_classifier.scored(vectors, model).collect()]
        assert len(scores) == messy.count() and all(0 <= s <= 1 for s in scores)
        assert expected is None or set(scores) == {expected}
    model = quality_classifier.fit(vectors.join(labels, "doc_id"))
    assert quality_classifier.scored(quality_classifier.measured(nothing), model).count() == 0


def test_pipeline_stage_by_stage(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    bench = [normalised(r["text"]) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    columns, at = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        at[name] = docs = docs.cache()
        if name != "bpe":
            assert docs.columns == columns and docs.schema == at["quality_rules"].schema
    rows = {k: {r["doc_id"]: r for r in v.collect()} for k, v in at.items()}
    before = {r["doc_id"]: r["text"] for r in at["line_dedup"].collect()}
    assert all(r["n_chars"] == len(r["text"]) for r in rows["line_dedup"].values())
    assert set(rows["near_dedup"]) == {c for _, c in brute(list(before.items()))}
    leaks = {i for i, r in rows["near_dedup"].items() if any(b in normalised(r["text"]) for b in bench)}
    assert not leaks & set(rows["decontaminate"]) and set(rows["near_dedup"]) - leaks == set(rows["decontaminate"])
    library = Tokenizer.from_file(vocabulary_path())
    for key, row in rows["bpe"].items():
        assert row["n_tokens"] == len(library.encode(rows["decontaminate"][key]["text"], add_special_tokens=False).ids)
    assert set(rows["bpe"]) == set(rows["decontaminate"])
    whole = entry.queries()["pipeline"](spark, folder)
    assert sorted(whole.collect()) == sorted(at["bpe"].collect())


def test_pipeline_of_messy_and_no_documents(spark, tmp_path):
    words = "some plain words that make a text long enough for the rules of all"
    rows = [(1, f"{words} one"), (1, f"{words} one"), (2, None), (None, f"{words} {words} two three"), (None, None, None), (3, "")]
    table = documents(spark, rows).select("doc_id", "text", "lang", "source", "n_chars")
    for name, docs in (("messy", table), ("none", table.where("doc_id > 9"))):
        path = str(tmp_path / name)
        docs.write.parquet(f"{path}/documents.parquet")
        spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
        spark.createDataFrame([], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
        result = corpus_pipeline.run(spark, path)
        assert result.count() <= 2 if name == "messy" else result.count() == 0
        for key in ("op1_pii_surrogates", "op2_near_dedup", "op3_quality_classifier", "op4_bpe", "op6_line_dedup", "op7_shards",
                    "op8_token_counts", "op10_quality_rules"):
            assert QUERIES[key](spark, path).count() == docs.count()
        assert QUERIES["op9_decontaminate"](spark, path).count() == 0


def test_queries_give_every_row(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select(F.count("*"), F.sum("doc_id")).first()
    for key in ("op1_pii_surrogates", "op2_near_dedup", "op4_bpe", "op8_token_counts"):
        assert QUERIES[key](spark, folder).select(F.count("*"), F.sum("doc_id")).first() == docs

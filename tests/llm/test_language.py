"""Cross-parsing against brute force, and held-out accuracy."""

import random

import numpy as np
import pytest

from innlake.llm import cross_parse
from tests.llm import cases
from tests.llm.test_tokens import joined

SF = "/root/testdata/sf0.01"


def phrases(text, sample):
    n = at = 0
    while at < len(text):
        end = at + 1
        while end < len(text) and text[at:end + 1] in sample:
            end += 1
        at, n = end, n + 1
    return n


def test_phrases_equal_greedy_parsing(monkeypatch):
    rng = random.Random(4)
    for segment in (7, 1024):
        monkeypatch.setattr(cross_parse, "SEGMENT", segment)
        for _ in range(60):
            samples = {k: "".join(rng.choice("abc ") for _ in range(rng.randint(1, 30))).encode() for k in "xyz"}
            texts = ["".join(rng.choice("abcd ") for _ in range(rng.randint(0, 40))) for _ in range(6)]
            found = cross_parse.Parser.fit(samples).phrases(*joined(texts))
            for i, text in enumerate(texts):
                cut = [text[a:a + segment].encode() for a in range(0, len(text), segment)]
                assert found[i].tolist() == [sum(phrases(c, samples[k]) for c in cut) for k in "xyz"]


def test_normal_form():
    data, offsets = joined(["a1 b", "", "  é,, x ", "12"])
    clean, places = cross_parse.normalised(data, offsets)
    assert [clean[a:z].tobytes().decode() for a, z in zip(places[:-1], places[1:])] == ["a b", "", "é x ", ""]


def test_accuracy_on_held_out_documents(spark):
    labels = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = cross_parse.query(spark, SF).join(labels, "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert len(held) > 100 and np.mean([r["lang"] == r["lang_pred"] for r in held]) > 0.98
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_awkward_documents(spark, tmp_path):
    folder = cases.saved(cases.documents(spark), tmp_path, "documents")
    found = cross_parse.query(spark, folder).collect()
    assert len(found) == len(cases.rows())
    by_id = {r["doc_id"]: r for r in found}
    for i in (6, 7, 8, 17):
        assert (by_id[i]["lang_pred"], by_id[i]["score"]) == ("und", 0.0)
    assert by_id[18]["lang_pred"] == "en" and by_id[None]["held_out"] is False


@pytest.mark.parametrize("rows", [[], [r[:2] + (None,) + r[3:] for r in cases.rows()]])
def test_nothing_to_learn_from(spark, tmp_path, rows):
    folder = cases.saved(cases.documents(spark, rows), tmp_path, "documents")
    assert {r["lang_pred"] for r in cross_parse.query(spark, folder).collect()} == ({"und"} if rows else set())


def test_stage_rejects_only_what_has_no_language(spark):
    docs = cases.documents(spark)
    kept = cross_parse.stage(spark, docs, "")
    assert kept.columns == docs.columns
    ids = {r["doc_id"] for r in kept.collect()}
    assert ids == {r[0] for r in cases.rows()} - {6, 7, 8, 17}
    assert kept.filter("lang is null").count() == 0

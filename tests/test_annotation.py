"""Annotation: keys, batches, validation, cache, merge, records and carry-forward."""

import json

import pytest
from pyspark.sql import functions as F

from leafwright.functions.vocabulary import CERTAINTY
from leafwright.operators import annotate, corpus, views

PARAGRAPHS = "article_id string, paragraph_id string, ord long, section_type string, section_title string, text string, sentences array<struct<sentence_id:string,start:int,end:int>>"
TEXT = "BMAX may help. It was 0.5 (p = 0.01)."


def unit(key="p1", text=TEXT, spans=((0, 14), (15, 37)), section="results", title="Results", k=0, article="a"):
    return (article, key, k, section, title, text, [(f"{key}-s{i + 1}", *s) for i, s in enumerate(spans)])


@pytest.fixture(scope="module")
def paragraphs(spark):
    rows = [unit(), unit("p2", "We did it.", ((0, 10),), "methods", "Methods", 1), unit("p3", "Thanks.", ((0, 7),), "funding", None, 2), unit("p4", "", (), "results", None, 3), unit("p1", "Other.", ((0, 6),), article="b")]
    return spark.createDataFrame(rows, PARAGRAPHS).cache()


@pytest.fixture(scope="module")
def cache(spark):
    return spark.createDataFrame([], f"pass string, cache_key string, {annotate.RESULT}")


def keys(paragraphs, kind=annotate.PARAGRAPH, model="m"):
    return {(r["article_id"], r["paragraph_id"]): r["cache_key"] for r in annotate.units(paragraphs, kind, model).collect()}


def test_units_and_keys(spark, paragraphs):
    found = keys(paragraphs)
    assert set(found) == {("a", "p1"), ("a", "p2"), ("b", "p1")}
    assert set(keys(paragraphs, annotate.SENTENCE)) == {("a", "p1"), ("b", "p1")}
    import hashlib

    body = json.dumps({"model": "m", "promptVersion": "paragraph-1", "text": TEXT, "sentences": [[0, 14], [15, 37]]}, ensure_ascii=False, separators=(",", ":"))
    assert found["a", "p1"] == hashlib.sha256(body.encode()).hexdigest()[:32]
    moved = spark.createDataFrame([unit("p9", k=9)], PARAGRAPHS)
    assert keys(moved)["a", "p9"] == found["a", "p1"] != keys(moved, model="n")["a", "p9"]
    assert keys(spark.createDataFrame([unit(spans=((0, 37),))], PARAGRAPHS))["a", "p1"] != found["a", "p1"]


def test_batches(spark):
    rows = [unit(f"p{k}", "x" * 50, tuple((i, i + 1) for i in range(n)), k=k) for k, n in enumerate((2, 2, 1, 9, 1, 3))]
    found = annotate.batched(spark.createDataFrame(rows, PARAGRAPHS), 4)
    assert [r["batch"] for r in found.orderBy("ord").collect()] == [0, 0, 1, 2, 3, 3]
    assert annotate.batched(spark.createDataFrame(rows, PARAGRAPHS), 4, max_requests=2).count() == 3


def as_unit(row):
    return dict(zip(("article_id", "paragraph_id", "ord", "section_type", "section_title", "text"), row[:6], strict=True)) | {"sentences": [dict(zip(("sentence_id", "start", "end"), s, strict=True)) for s in row[6]]}


def test_prompts():
    one = [as_unit(unit())]
    assert annotate.prompt(annotate.PARAGRAPH, one).split("\n")[:2] == ["## [p1] Results (results)", TEXT]
    assert "[p1-s2] It was 0.5 (p = 0.01)." in annotate.prompt(annotate.SENTENCE, one)


def test_quotes():
    assert annotate.quote_span(TEXT, 0, 14, " may ") == (5, 8)
    assert annotate.quote_span(TEXT, 15, 37, "may") is None and annotate.quote_span(TEXT, 0, 14, "0.5") is None and annotate.quote_span(TEXT, 0, 14, " ") is None


def test_sentence_responses():
    one = [as_unit(unit())]
    good = {"sentences": [{"id": "p1-s1", "certainty": "hedged", "hedges": ["may", "might"], "stats": []}, {"id": "p1-s2", "certainty": "measured", "hedges": [], "stats": [{"quote": "p = 0.01", "p": 0.01, "value": float("nan"), "metric": ""}, {"quote": "no"}]}]}
    found, warnings = annotate.parse_sentences(good, one)
    a, b = found["p1"]["sentences"]
    assert a["hedges"] == [{"start": 5, "end": 8}] and b["stats"][0]["p"] == 0.01 and b["stats"][0]["value"] is None and b["stats"][0]["metric"] is None
    assert found["p1"]["complete"] and len(warnings) == 2
    bad = {"sentences": [{"id": "p1-s1", "certainty": "sure"}, {"id": "p1-s1", "certainty": "hedged"}, {"id": "zz", "certainty": "hedged"}, 5]}
    found, warnings = annotate.parse_sentences(bad, one)
    assert found == {} and len(warnings) == 5
    assert annotate.parse_sentences({"sentences": {}}, one)[1] == ["response without sentences"]
    half, _ = annotate.parse_sentences({"sentences": [{"id": "p1-s1", "certainty": "hedged"}]}, one)
    assert not half["p1"]["complete"]


def test_paragraph_responses():
    one = [as_unit(unit())]
    rows = [{"id": "p1", "role": "bogus", "gist": "g", "plain": "p"}, {"id": "p1", "role": "result", "gist": " ", "plain": "p"}, {"id": "p1", "role": "result", "gist": " g ", "plain": "p"}, {"id": "p1", "role": "claim", "gist": "g", "plain": "p"}, {"id": "q"}]
    found, warnings = annotate.parse_paragraphs({"paragraphs": rows}, one)
    assert found["p1"]["role"] == "result" and found["p1"]["gist"] == "g" and len(warnings) == 4
    assert annotate.parse_paragraphs(None, one)[1] == ["response without paragraphs"] and annotate.parse_paragraphs({"paragraphs": []}, one)[1] == ["p1: no summary"]


def say(role, plain):
    return lambda _, batch: json.dumps({"paragraphs": [{"id": u["paragraph_id"], "role": role, "gist": "g", "plain": plain} for u in batch]})


@pytest.mark.parametrize(("role", "plain", "lost"), [("result", "It helps.", True), ("result", "It may help.", False), ("result", "It has potential.", False), ("method", "It helps.", False), ("claim", "This is not yet established.", False)])
def test_lost_hedges(paragraphs, cache, role, plain, lost):
    run = annotate.annotate(paragraphs.where("article_id = 'a' AND paragraph_id = 'p1'"), cache, annotate.PARAGRAPH, "m", say(role, plain))
    row = run.paragraphs.first()
    assert row["role"] == role and bool(row["merge_warnings"]) == lost


def test_a_run_and_its_repeat(spark, paragraphs, cache, tmp_path):
    calls = tmp_path / "calls"

    def counted(prompt, batch):
        with open(calls, "a") as f:
            f.write(f"{len(batch)}\n")
        return annotate.stub_caller(annotate.PARAGRAPH)(prompt, batch)

    run = annotate.annotate(paragraphs, cache, annotate.PARAGRAPH, "m", counted)
    stored = spark.createDataFrame(run.cache.collect(), run.cache.schema)
    assert stored.count() == 3
    record = {r["article_id"]: (r["applied"], r["cached"]) for r in run.record.collect()}
    assert record == {"a": (2, 0), "b": (1, 0)}
    n = len(calls.read_text().split())
    again = annotate.annotate(paragraphs, stored, annotate.PARAGRAPH, "m", counted)
    assert {r["article_id"]: (r["applied"], r["cached"]) for r in again.record.collect()} == {"a": (2, 2), "b": (1, 1)}
    assert len(calls.read_text().split()) == n
    forced = annotate.annotate(paragraphs, stored, annotate.PARAGRAPH, "m", counted, force=True)
    assert {r["article_id"]: r["cached"] for r in forced.record.collect()} == {"a": 0, "b": 0}
    looked = annotate.probed(annotate.units(paragraphs, annotate.PARAGRAPH, "m"), stored.limit(0), annotate.PARAGRAPH)
    assert {r["article_id"]: tuple(r)[1:] for r in annotate.estimate(looked, annotate.PARAGRAPH).collect()} == {"a": (2, 3, 0, 1), "b": (1, 1, 0, 1)}
    both = annotate.upserted(annotate.upserted(run.record.limit(0), run.record), again.record)
    assert {r["article_id"]: r["cached"] for r in both.collect()} == {"a": 2, "b": 1}


def test_sentence_run(spark, paragraphs, cache):
    def ask(_, batch):
        rows = [{"id": s["sentence_id"], "certainty": "hedged", "hedges": ["may"], "stats": []} for u in batch for s in u["sentences"]]
        return json.dumps({"sentences": rows if batch[0]["article_id"] == "a" else []})

    run = annotate.annotate(paragraphs, cache, annotate.SENTENCE, "m", ask)
    rows = {(r["article_id"], r["paragraph_id"]): r for r in run.paragraphs.collect()}
    one, two = rows["a", "p1"]["sentences"]
    assert one["certainty"] == "hedged" and [tuple(h) for h in one["hedges"]] == [(5, 8)] and two["hedges"] is None
    assert not rows["b", "p1"]["applied"] and rows["b", "p1"]["sentences"][0]["certainty"] is None
    stored = spark.createDataFrame(run.cache.collect(), run.cache.schema)
    assert stored.count() == 1 and stored.first()["sentences"][0]["sentence_id"] is None
    again = annotate.annotate(paragraphs.where("article_id = 'a'"), stored, annotate.SENTENCE, "m", lambda *_: "{}")
    assert again.record.first()["cached"] == 1
    assert [s["certainty"] for s in again.paragraphs.where("paragraph_id = 'p1'").first()["sentences"]] == ["hedged", "hedged"]
    marked = run.paragraphs.where("article_id = 'a' AND paragraph_id = 'p1'").select(views.marked_hedges(F.col("text"), F.col("sentences")[0]["start"], F.col("sentences")[0]["end"], F.col("sentences")[0]["hedges"])).first()[0]
    assert marked == "BMAX «may» help."


def test_incomplete_answers_are_merged_but_not_kept(paragraphs, cache):
    ask = lambda _, batch: json.dumps({"sentences": [{"id": batch[0]["sentences"][0]["sentence_id"], "certainty": "measured"}]})
    run = annotate.annotate(paragraphs.where("article_id = 'a'"), cache, annotate.SENTENCE, "m", ask)
    assert run.cache.count() == 0
    assert run.paragraphs.where("paragraph_id = 'p1'").first()["sentences"][0]["certainty"] == CERTAINTY[0]


def test_a_call_that_fails(paragraphs, cache):
    def ask(_, batch):
        raise OSError("down")

    run = annotate.annotate(paragraphs, cache, annotate.PARAGRAPH, "m", ask)
    assert run.record.where("article_id = 'a'").first()["warnings"] == ["call failed: down"] and run.cache.count() == 0


def test_carry_forward(spark, paragraphs, cache):
    old = annotate.annotate(paragraphs, cache, annotate.PARAGRAPH, "m").paragraphs
    changed = paragraphs.withColumn("text", F.when((F.col("paragraph_id") == "p2"), F.lit("We did more.")).otherwise(F.col("text")))
    new = annotate.merged(changed, old.limit(0).select("article_id", "paragraph_id", *annotate._RESULT_FIELDS[:3], F.lit(None).cast(annotate.RESULT.rsplit("sentences ", 1)[1]).alias("sentences"))).drop("applied", "merge_warnings")
    found = {(r["article_id"], r["paragraph_id"]): r["carried"] for r in corpus.carried(old, new).collect()}
    assert found == {("a", "p1"): True, ("a", "p2"): False, ("a", "p3"): False, ("a", "p4"): False, ("b", "p1"): True}
    figures = spark.createDataFrame([("a", "f1", ["g.jpg"])], "article_id string, xml_id string, files array<string>")
    fresh = spark.createDataFrame([("a", "f1", None), ("a", "f2", None)], "article_id string, xml_id string, files array<string>")
    assert {r["xml_id"]: r["files"] for r in corpus.carried_figures(figures, fresh).collect()} == {"f1": ["g.jpg"], "f2": None}


def test_certainty_bars(spark):
    rows = spark.createDataFrame([("measured",)] * 3 + [("hedged",)] + [(None,)], "certainty string")
    assert [(r["certainty"], r["n"], r["bar"]) for r in views.certainty_distribution(rows).collect()] == [("measured", 3, 38), ("supported", 0, 0), ("hedged", 1, 13), ("speculative", 0, 0)]

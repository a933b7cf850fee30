"""The corpus pipeline, stage by stage, against the plain versions of the operators."""

import random

import corpus_pipeline
from leafwright.llm import byte_bpe, common, decontaminate, minhash_dedup, quality

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r[0]: r[1] for r in spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality").collect()}
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        after = docs.collect()
        seen[name] = len(after)
        if name == "quality":
            kept = {r["doc_id"] for r in after}
            assert sum(labels[k] == (k in kept) for k in labels) >= 0.9 * len(labels)
        if name == "lines":
            assert {r["doc_id"] for r in after} == before.keys() and all(r["n_chars"] == len(r["text"]) for r in after)
        if name == "near_duplicates":
            want = minhash_dedup.brute_force(list(before.items()), 80)
            assert {r["doc_id"] for r in after} == {k for k, x in want.items() if x[2]}
        if name == "decontamination":
            items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
            found = {x[0] for x in decontaminate.brute_force(list(before.items()), items) if x[3]}
            assert {r["doc_id"] for r in after} == before.keys() - found and found
        if name == "tokens":
            bpe = byte_bpe.load(byte_bpe.DEFAULT_RANKS)
            assert {r["doc_id"]: r["n_tokens"] for r in after} == {k: len(bpe.encode(x or "")) // 4 for k, x in before.items()}
        else:
            assert docs.columns == columns
    assert corpus_pipeline.run(spark, SF).count() == seen["tokens"] > 0


def test_near_duplicate_stage_at_another_threshold(spark, monkeypatch):
    monkeypatch.setattr(corpus_pipeline, "NEAR_PERCENT", 80)
    r = random.Random(8)
    rows = []
    for k in range(60):
        words = [f"w{k}x{n}" for n in range(204)]
        rows.append((2 * k, " ".join(words)))
        for n in r.sample(range(0, 204, 6), 2 + k % 6):  # similarities from 0.95 to 0.70
            words[n] = f"v{k}x{n}"
        rows.append((2 * k + 1, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r["doc_id"] for r in corpus_pipeline.near_duplicate_stage(spark, docs, SF).collect()}
    want = {percent: {k for k, x in minhash_dedup.brute_force(rows, percent).items() if x[2]} for percent in (80, 85)}
    assert kept == want[80] < want[85]


def test_decontamination_stage_drops_one_passage_of_one_item(spark, docs, monkeypatch):
    item = "one two three four five six seven eight nine ten"
    items = spark.createDataFrame([(1, item), (2, "the of"), (3, None), (None, "never asked for this one at all by anyone here")], "item_id long, text string")
    monkeypatch.setattr(corpus_pipeline, "read_table", lambda *_: items)
    rows = [(1, "Before, TWO three four five six seven eight nine after"), (2, "two three four five six seven eight and nine"), (3, None), (4, ""), (5, "the of the of the of the of"), (None, item), (6, f"x {item} y"), (6, "clean row of the same id"), (7, "never asked for this one at all by anyone here")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS item", "2 AS length", "3 AS segment", "4 AS key")
    kept = corpus_pipeline.decontamination_stage(spark, frame, SF)
    assert kept.columns == frame.columns
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 2, 3, 4, 5, 7]


def test_stages_on_empty_and_odd_tables(spark, none, odd_docs):
    for frame in (none, odd_docs):
        for name, stage in corpus_pipeline.STAGES:
            found = stage(spark, frame, SF)
            rows = found.collect()
            assert name == "tokens" or found.columns == frame.columns
            assert name in ("quality", "near_duplicates") or len(rows) == frame.count()
            assert name == "quality" or sum(r["doc_id"] is None for r in rows) == frame.where("doc_id IS NULL").count()


def test_quality_stage_without_labels_keeps_all(spark, docs):
    for labels in ([], [(5, None), (6, None)], [(5, 7)]):
        machine = quality.train(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
        assert not machine.fitted
    learnt = quality.train(docs, spark.createDataFrame([(k, k % 2) for k in range(20)], "doc_id long, quality int"))
    assert learnt.fitted


def test_quality_stage_reads_a_table_without_labels(spark, docs, monkeypatch):
    monkeypatch.setattr(corpus_pipeline, "read_table", lambda *_: spark.createDataFrame([], "doc_id long, quality int"))
    kept = corpus_pipeline.quality_stage(spark, docs, SF)
    assert kept.schema == docs.schema and sorted(map(str, kept.collect())) == sorted(map(str, docs.collect()))


def test_a_worker_holds_the_models_of_one_operator(monkeypatch, docs):
    """Spark's workers outlive a stage; the models of all stages at once count as memory of the executor."""
    tasks = []
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, f, schema: tasks.append(f) or docs)
    byte_bpe.encode_documents(docs)
    minhash_dedup.signatures(docs)
    same, other = tasks
    byte_bpe.load(byte_bpe.DEFAULT_RANKS)
    list(same(iter([])))
    assert byte_bpe.load.cache_info().currsize == 1
    list(other(iter([])))
    assert byte_bpe.load.cache_info().currsize == 0
    assert common._resident.keys() >= {byte_bpe.__name__, decontaminate.__name__}


def test_token_stage_has_one_worker_a_task(spark, docs, rows):
    found = corpus_pipeline.token_stage(spark, docs, SF)
    assert found._jdf.queryExecution().executedPlan().toString().count("MapInArrow ") == 1
    bpe = byte_bpe.load(byte_bpe.DEFAULT_RANKS)
    apart = byte_bpe.decode_documents(byte_bpe.encode_documents(docs))
    want = {r["doc_id"]: (r["ids"], r["decoded"]) for r in apart.collect()}
    assert {r["doc_id"]: (r["ids"], r["decoded"]) for r in byte_bpe.round_trips(docs).collect()} == want
    assert want == {k: (bpe.encode(x or ""), (x or "").encode()) for k, x, *_ in rows}

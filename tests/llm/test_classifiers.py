"""Held-out accuracy of the classifiers and their awkward cases."""

import random

import numpy as np
import pytest

from leafwright.llm import quality, toxicity
from leafwright.llm.labelled import platt, remainder

SF = "/root/testdata/sf0.1"


def held_out(spark, query, label):
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", label)
    rows = query(spark, SF).join(labels, "doc_id").where("held_out").collect()
    return np.array([r[label] for r in rows]), np.array([r["predicted"] for r in rows])


def test_quality_held_out(spark):
    y, found = held_out(spark, quality.query, "quality")
    assert (y == found).mean() > 0.98 and (found[y == 1] == 1).mean() > 0.99


def test_toxicity_held_out(spark):
    y, found = held_out(spark, toxicity.query, "toxic")
    assert (found[y == 0] == 0).mean() > 0.99 and (found[y == 1] == 1).mean() >= 0.85


def test_interaction_identity():
    r = np.random.default_rng(1)
    machine = quality.FactorisationMachine(50, 4)
    machine.w, machine.v, machine.bias[0] = r.normal(size=50).astype(np.float32), r.normal(size=(50, 4)).astype(np.float32), 0.3
    index, value = np.array([1, 7, 30, 2, 9], np.int32), r.normal(size=5).astype(np.float32)
    rows = [(index[:3], value[:3]), (index[3:], value[3:])]
    want = [0.3 + sum(machine.w[i] * x for i, x in zip(ix, vx, strict=True)) + sum(machine.v[ix[a]] @ machine.v[ix[b]] * vx[a] * vx[b] for b in range(len(ix)) for a in range(b)) for ix, vx in rows]
    assert np.allclose(machine.logits(quality.Sparse(np.array([0, 3, 5]), index, value)), want, atol=1e-4)


def test_labels_of_the_held_out_part_are_never_read(spark):
    found = {r[0] for r in quality.sample(spark.createDataFrame([(k, "x") for k in range(400)], "doc_id long, text string"), spark.createDataFrame([(k, 1) for k in range(400)], "doc_id long, quality int"), "quality", {0: 9, 1: 999}, quality.DIVISOR, quality.HELD_OUT).collect()}
    import zlib

    assert found == {k for k in range(400) if zlib.crc32(str(k).encode()) % 4 != 2}


@pytest.mark.parametrize("word", ["loser", "vequance", "x", "a-b.c"])
def test_folded_weights_are_the_sum_over_landmarks(word):
    machine = toxicity.KernelMachine()
    r = random.Random(3)
    insults = {toxicity.codes(w): 1.0 for w in ("loser", "idiot", "moron", "disgustingbehaviour")}
    plain = [toxicity.codes("".join(r.choice("aeionrst") for _ in range(6))) for _ in range(40)]
    toxicity.fit(machine, insults, plain, plain)
    assert abs(toxicity.kernel("loser", "loser") - 1) < 1e-9
    assert toxicity.kernel("l.o.s.e.r", "loser") > 0.5 > toxicity.kernel("lantern", "loser")
    code = toxicity.codes(word)
    # The machine as the sum over its landmarks of coefficient and kernel value, from the kernel's definition.
    want = machine.bias + sum(a * dot(features(mark), features(code)) for mark, a in zip(machine.landmarks, machine.coefficients, strict=True)) if len(code) >= 3 else machine.bias
    assert len(machine.landmarks) > 20
    assert abs(machine.margins([code])[0] - want) < 1e-4


def features(code):
    from itertools import combinations

    own = {}
    for i, j, k in combinations(range(len(code)), 3):
        if code[i] and code[j] and code[k]:
            own[code[i], code[j], code[k]] = own.get((code[i], code[j], code[k]), 0) + toxicity.LAMBDA ** (k - i + 1)
    return own


def dot(a, b):
    scale = (sum(v * v for v in a.values()) * sum(v * v for v in b.values())) ** 0.5
    return sum(v * b.get(u, 0) for u, v in a.items()) / scale if scale else 0.0


def test_samples_are_bounded(spark, monkeypatch):
    from leafwright.llm import labelled

    monkeypatch.setattr(labelled, "SAMPLE_CHARS", 10)
    docs = spark.createDataFrame([(k, "x" * (k % 20)) for k in range(200)] + [(3, "aa"), (3, "zz"), (4, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(200)] + [(3, 1)], "doc_id long, toxic int")
    found = labelled.sample(docs, labels, "toxic", {0: 500, 1: 20}, 3, 1).collect()
    ids = [r["doc_id"] for r in found]
    assert len(ids) == len(set(ids)) and sum(r["label"] for r in found) <= 20 and all(len(r["text"] or "") <= 10 for r in found)


def test_gapped_and_inserted_insults():
    r = random.Random(4)
    plain = lambda: " ".join("".join(r.choice(["an", "er", "th", "on", "in", "ba", "cu", "ve", "mi", "pa", "ru", "que", "sol", "ta", "né", "gu"]) for _ in range(r.randint(1, 4))) for _ in range(25)) + "."
    rows = []
    for k in range(1200):
        text = plain()
        if k % 3 == 0:
            words = text.split()
            words[r.randrange(25)] = r.choice(["loser", "idiot", "scumbag"])
            words[r.randrange(25)] = r.choice(["loser", "idiot", "scumbag"])
            text = " ".join(words)
        rows.append((text, int(k % 3 == 0)))
    machine = toxicity.learn(rows)
    margin = dict(zip(("idiot", "i.d.i.o.t", "idi-ot", "i d i o t", "theron", "inanth"), machine.margins([toxicity.codes(w) for w in ("idiot", "i.d.i.o.t", "idi-ot", "i d i o t", "theron", "inanth")]), strict=True))
    assert min(margin[w] for w in ("idiot", "i.d.i.o.t", "idi-ot", "i d i o t")) > 0 > max(margin["theron"], margin["inanth"])
    import pyarrow as pa

    evidence = machine.evidence(pa.array(["an er i d i o t on", None, ""]))
    assert evidence[0, 0] > 0 and evidence[1, 0] == evidence[2, 0] == toxicity.LOWEST


def test_platt_recovers_order():
    z = np.linspace(-2, 2, 200)
    a, b = platt(z, (z > 0.5).astype(float))
    assert a > 0 and abs(b / -a - 0.5) < 0.2


def test_awkward_tables(spark, docs, none, odd_docs):
    labels = spark.createDataFrame([(5, 1, 0), (6, 0, 1), (None, 1, 1), (7, None, None), (5, 1, 0)], "doc_id long, quality int, toxic int")
    nobody = labels.where("false")
    for module in (quality, toxicity):
        for frame in (docs, odd_docs, none):
            for given in (labels, nobody):
                found = module.score(frame, module.train(frame, given)).collect()
                assert len(found) == frame.count() and all(0 <= x["score"] <= 1 for x in found)
    assert spark.range(1).select(remainder(4, "id")).first()[0] == 0xF4DBDF21 % 4
    kept = quality.accepted(odd_docs, quality.FactorisationMachine(), 0.0)
    assert kept.schema == odd_docs.schema and kept.count() == odd_docs.count()

import random
import zlib

from pyspark.sql import functions as F

from episodica.llm import toxicity


def data(spark, n=900):
    r = random.Random(2)
    rows, marks = [], []
    for i in range(n):
        w = [f"w{r.randrange(200)}" for _ in range(r.randrange(5, 60))]
        bad = r.random() < 0.25
        if bad:
            w[r.randrange(len(w))] = r.choice(["Vile,", "awful."])
        rows.append((i, " ".join(w), "en"))
        marks.append((i, int(bad)))
    return spark.createDataFrame(rows, "doc_id long, text string, score string"), spark.createDataFrame(marks, "doc_id long, toxic int"), dict(marks)


def test_held_out_accuracy(spark):
    docs, labels, marks = data(spark)
    out = toxicity.score(docs.drop("score"), toxicity.train(docs, labels)).withColumn("h", toxicity.held_out(F.col("doc_id"))).collect()
    held = [r for r in out if r.h]
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out)
    assert sum((r.score >= 0.5) == (marks[r.doc_id] == 1) for r in held) / len(held) > 0.97


def test_held_out_labels_are_not_read(spark):
    docs, labels, _ = data(spark, 200)
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = toxicity.train(docs, labels), toxicity.train(docs, flipped)
    assert (a.weights == b.weights).all() and a.bias == b.bias


def test_weights_are_those_of_plain_ftrl():
    """One coordinate at a time, as the method's paper has it."""
    import numpy as np

    r = random.Random(3)
    feats = [sorted({r.randrange(30) for _ in range(8)}) for _ in range(60)]
    labels = [int(3 in f or r.random() < 0.1) for f in feats]
    z, n, bias = {}, {}, 1 << toxicity.BITS
    often = [i for i in range(30) if sum(i in f for f in feats) >= toxicity.MIN_TEXTS]

    def weight(i):
        zi, ni, bar = z.get(i, 0.0), n.get(i, 0.0), 0.0 if i == bias else toxicity.L1
        return 0.0 if abs(zi) <= bar else -(zi - (bar if zi > 0 else -bar)) / ((toxicity.BETA + ni**0.5) / toxicity.ALPHA + toxicity.L2)

    for _ in range(toxicity.EPOCHS):
        for f, y in zip(feats, labels):
            own = [i for i in f if i in often] + [bias]
            w = {i: weight(i) for i in own}
            g = 1 / (1 + np.exp(-sum(w.values()))) - y
            for i in own:
                step = ((n.get(i, 0.0) + g * g) ** 0.5 - n.get(i, 0.0) ** 0.5) / toxicity.ALPHA
                z[i] = z.get(i, 0.0) + g - step * w[i]
                n[i] = n.get(i, 0.0) + g * g
    got = toxicity.ftrl([np.array(f, np.int32) for f in feats], labels)
    want = {i: weight(i) for i in often if weight(i)}
    assert dict(zip(got.slots.tolist(), got.weights.tolist())).keys() == want.keys() and want
    assert np.allclose(got.weights, [want[i] for i in got.slots.tolist()]) and np.isclose(got.bias, weight(bias))


def test_repeated_rows_train_once(spark):
    docs, labels, _ = data(spark, 200)
    plain = docs.drop("score")
    a, b = toxicity.train(plain, labels), toxicity.train(plain.unionByName(plain).unionByName(plain.limit(50)), labels)
    assert (a.slots == b.slots).all() and (a.weights == b.weights).all()
    other = docs.selectExpr("doc_id", "concat(text, ' more') as text").unionByName(plain)
    assert len(toxicity.train(other, labels, 10).slots) <= len(toxicity.train(plain, labels).slots) + 50


def test_awkward_rows(spark, rows, none):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (None, 1), (4, None)], "doc_id long, toxic int")
    out = toxicity.reject(rows, labels)
    assert out.columns == rows.columns
    assert toxicity.reject(none, labels).count() == 0
    clash = toxicity.score(rows, toxicity.train(rows, labels))
    assert clash.columns == [*rows.columns, "score_"] and {r.score for r in clash.collect()} == {r.score for r in rows.collect()}
    blank = toxicity.score(rows.drop("score"), toxicity.train(rows, labels.where("false")))
    assert {round(r.score, 6) for r in blank.collect()} == {toxicity.PRIOR}

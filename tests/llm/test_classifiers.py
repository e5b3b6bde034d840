import numpy as np
from pyspark.sql import functions as F

from shelfwise.llm import quality, toxicity
from shelfwise.llm.common import crc_mod

SMALL = "/root/testdata/sf0.01"


def auc(scores, labels):
    order = np.argsort(scores)
    rank = np.empty(len(order))
    rank[order] = np.arange(1, len(order) + 1)
    positives = labels == 1
    return (rank[positives].sum() - positives.sum() * (positives.sum() + 1) / 2) / (positives.sum() * (~positives).sum())


def held_out(spark, scored, label, held):
    got = scored.join(spark.read.parquet(f"{SMALL}/labels.parquet"), "doc_id").filter(held).select("score", label).toPandas()
    return auc(got["score"].to_numpy(), got[label].to_numpy())


def test_quality_on_documents_not_learnt_from(spark):
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.learn(docs, labels, crc_mod("doc_id", 5) != 0)
    scored = quality.score_quality(docs.select("doc_id", "text"), model)
    assert held_out(spark, scored, "quality", crc_mod("doc_id", 5) == 0) > 0.95
    kept = quality.drop_poor(docs, model)
    assert kept.columns == docs.columns and 0.7 * docs.count() < kept.count() < docs.count()


def test_toxicity_on_documents_not_learnt_from(spark):
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.learn(docs, labels, crc_mod("doc_id", 3) != 1)
    assert held_out(spark, toxicity.score_toxicity(docs, model), "toxic", crc_mod("doc_id", 3) == 1) > 0.85


def test_rules_compile_to_the_model_they_were_learnt_as(docs):
    rng = np.random.default_rng(0)
    x = rng.random((300, len(quality.STATISTICS)))
    y = ((x[:, 0] > 0.5) & (x[:, 3] < 0.7)).astype(float)
    model = quality.fit_rules(x, y)
    assert 0 < len(model.rules) < 200
    rows = [(int(i), x[i].tolist()) for i in range(50)]
    df = docs([(0, "")]).sparkSession.createDataFrame(rows, "i int, s array<double>")
    for i, score in df.select("i", model.score(F.col("s"))).collect():
        margin = model.intercept + sum(w for p, w in model.rules if all((x[i, f] <= v) if below else (x[i, f] > v) for f, below, v in p))
        assert abs(score - 1 / (1 + np.exp(-margin))) < 1e-9 and (score >= quality.THRESHOLD) == (y[i] == 1)


def test_edge_rows_and_missing_labels(spark, docs):
    rows = docs([(1, None), (2, ""), (2, ""), (None, "a b"), (3, "word " * 30_000)])
    for labels in ([], [(1, 1, 1), (None, 0, 0), (2, None, None)]):
        table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
        good = quality.score_quality(rows, quality.learn(rows, table, F.lit(True))).collect()
        bad = toxicity.score_toxicity(rows, toxicity.learn(rows, table, F.lit(True))).collect()
        assert len(good) == len(bad) == 5 and all(0 <= r.score <= 1 for r in good + bad)
    named = spark.createDataFrame([(1, "x", 3.0, 4)], "doc_id long, text string, _stats double, score int")
    assert quality.drop_poor(named, quality.RuleModel(5.0, ())).collect() == named.collect()
    assert quality.drop_poor(named.limit(0), quality.RuleModel(5.0, ())).count() == 0


def test_network_finds_the_words_that_matter():
    rng = np.random.default_rng(3)
    words = [f"w{i}".encode() for i in range(400)]
    texts, labels = [], []
    for i in range(300):
        some = [words[k] for k in rng.integers(0, 400, 60)]
        if i % 4 == 0:
            some[int(rng.integers(0, 60))] = [b"badword", b"badwords", b"awful"][i % 3]
        texts.append(toxicity.buckets_of(b" ".join(some)))
        labels.append(float(i % 4 == 0))
    labels = np.array(labels, np.float32)
    model = toxicity.train(texts[:200], labels[:200])
    toxicity.calibrate(model, texts[:200], labels[:200])
    scores = np.array([model.score(t) for t in texts[200:]])
    assert auc(scores, labels[200:]) > 0.97
    # Blocks of a long text give what the text gives at once.
    long = np.concatenate(texts * 2)
    assert np.allclose(model.pooled(long), np.max([model.pooled(long[:9000]), model.pooled(long[8000:])], axis=0))


def test_empty_tables_and_repeated_rows(spark, docs):
    labels = spark.createDataFrame([(1, 1, 1), (2, 0, 0)], "doc_id long, quality int, toxic int")
    some = docs([(1, "good words here"), (2, "other words"), (2, "other words")])
    good, bad = quality.learn(some, labels, F.lit(True)), toxicity.learn(some, labels, F.lit(True))
    assert quality.score_quality(docs([]), good).count() == toxicity.score_toxicity(docs([]), bad).count() == 0
    for scored in (quality.score_quality(some, good, keep=["doc_id"]), toxicity.score_toxicity(some, bad)):
        twice = [r.score for r in scored.collect() if r.doc_id == 2]
        assert len(twice) == 2 and twice[0] == twice[1]
    none = toxicity.learn(docs([]), labels, F.lit(True))
    assert toxicity.score_toxicity(some, none).count() == 3


def test_pooled_responses_are_those_of_a_plain_convolution():
    rng = np.random.default_rng(6)
    texts = [" ".join(f"w{i}" for i in rng.integers(0, 60, n)).encode() for n in (1, 2, 3, 40)]
    buckets = [toxicity.buckets_of(t) for t in texts]
    model = toxicity.train(buckets, np.array([0, 1, 0, 1], np.float32))
    for ids in buckets:
        plain = []
        for filters, bias in zip(model.filters, model.biases):
            width, dimension, n = filters.shape
            words = [*ids.tolist(), *[[toxicity.PAD] * ids.shape[1]] * (width - 1)]
            for f in range(n):
                best = 0.0
                for start in range(len(ids)):
                    response = float(bias[f])
                    for j in range(width):
                        word = sum(model.embedding[b].astype(float) for b in words[start + j])
                        response += sum(word[d] * float(filters[j, d, f]) for d in range(dimension))
                    best = max(best, response)
                plain.append(best)
        assert np.allclose(model.pooled(ids), plain, rtol=1e-4, atol=1e-5)

"""The quality classifier: statistics by hand, trees against a plain walk, held-out accuracy."""

import random
import zlib

import numpy as np

from paceline.llm import common, quality_trees as qt

DOCS = "doc_id long, text string, lang string, source string, score double"


def docs_of(spark, texts):
    return spark.createDataFrame([(i, t, "en", "a", 9.0) for i, t in enumerate(texts)], DOCS)


def plain(rng, n):
    return " ".join(f"{rng.choice('abcdefgh')}{rng.choice('lmnop')}{rng.randrange(400)}x" for _ in range(n)).capitalize() + "."


AWKWARD = [None, "", "  \n\t ", "one", "One  two", "x" * 300_000, "é ñ ß", "same", "same", "a b c " * 30_000, "\x00\x01 !"]


def named(text):
    return dict(zip(qt.FEATURES, qt.text_statistics([text.encode()])[0].astype(float)))


def test_statistics_of_a_text():
    got = named("The CAT sat.\nthe cat, 12 $$$\nThe CAT sat.")
    assert np.isclose(np.expm1(got["log_words"]), 10) and np.isclose(got["words_a_line"], 10 / 3)
    assert np.isclose(got["all_capitals"], 0.2) and np.isclose(got["no_letter"], 0.1) and np.isclose(got["with_digit"], 0.1)
    assert np.isclose(got["ends_in_stop"], 0.2) and np.isclose(got["ends_in_pause"], 0.1) and np.isclose(got["ends_in_symbol"], 0.1)
    assert np.isclose(got["function_words"], 0.3) and np.isclose(got["distinct_words"], 0.6) and np.isclose(got["top_word"], 0.3)
    assert np.isclose(got["distinct_lines"], 2 / 3) and np.isclose(got["words_once"], 0.3)
    assert np.isclose(got["distinct_triples"], 7 / 8) and np.isclose(got["upper_of_letters"], 8 / 24)
    assert np.isclose(sum(v for k, v in got.items() if k.startswith("share_")), 1)
    repeated = named("ha ha ha ha no no")
    assert np.isclose(repeated["repeats_last"], 4 / 6) and np.isclose(repeated["repeats_last_but_one"], 2 / 6)


def test_statistics_do_not_depend_on_neighbours():
    rng = random.Random(1)
    texts = [t.encode() for t in [*[plain(rng, rng.randrange(1, 60)) for _ in range(40)], *[a or "" for a in AWKWARD]]]
    together = qt.text_statistics(texts)
    assert np.isfinite(together).all()
    np.testing.assert_allclose(together, np.concatenate([qt.text_statistics([t]) for t in texts]), rtol=1e-6)


def test_flattened_trees_walk_like_plain_ones():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(3000, 6)).astype(np.float32)
    x[:, 5] = np.round(x[:, 5])
    y = ((x[:, 0] > 0.3) ^ (x[:, 5] > 0)).astype(int)
    model = qt.train(x, y, np.ones(len(x)), qt.QualityParams(trees=25, depth=3))
    z = qt.margins(model, x)
    assert ((z > 0) == y).mean() > 0.97
    for row in range(0, 3000, 211):
        total = model.base
        for t in range(25):
            node = 0
            while node < 7:
                node = 2 * node + 1 + bool(x[row, model.feature[t, node]] > model.cut[t, node])
            total += model.leaf[t, node - 7]
        assert np.isclose(total, z[row])


def test_training_without_two_classes():
    x = np.ones((5, 3), dtype=np.float32)
    assert (qt.margins(qt.train(x[:0], np.zeros(0, dtype=int), np.zeros(0)), x) == 0).all()
    assert (qt.margins(qt.train(x, np.ones(5, dtype=int), np.ones(5)), x) > 1).all()
    same = qt.train(x, np.array([0, 1, 1, 1, 1]), np.ones(5))
    assert np.allclose(qt.margins(same, x), qt.margins(same, x)[0])


def test_quality_is_learned_and_held_out(spark):
    rng = random.Random(8)
    good = [plain(rng, rng.randrange(5, 80)) for _ in range(400)]
    junk = [" ".join(f"{rng.choice('abc')}$$$ {rng.randrange(9)}" for _ in range(rng.randrange(5, 80))) for _ in range(100)]
    texts = [*good, *junk, *AWKWARD]
    labels = spark.createDataFrame([(i, int(i < 400)) for i in range(500)] + [(None, 1), (3, None), (7, 0), (9999, 0)],
                                   "doc_id long, quality int")
    docs = docs_of(spark, texts).union(docs_of(spark, texts[:5]))  # repeated rows
    sample = qt.training_sample(docs, labels, qt.QualityParams(sample_per_class=150))
    assert sample.where(common.held_out()).count() == 0 and sample.count() == sample.select("doc_id").distinct().count() <= 300
    model = qt.fit(docs, labels)
    out = qt.score_documents(docs, model, ["doc_id", "score"]).collect()
    assert len(out) == len(texts) + 5 and all(0 <= r["score"] <= 1 for r in out)
    unseen = [r for r in out if r["doc_id"] < 500 and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert np.mean([(r["score"] >= 0.3) == (r["doc_id"] < 400) for r in unseen]) > 0.95
    again = qt.score_documents(docs.repartition(5), qt.fit(docs.repartition(3), labels), ["doc_id"]).collect()
    assert sorted((r["doc_id"], r["score"]) for r in out) == sorted((r["doc_id"], r["score"]) for r in again)
    none = qt.fit(docs, labels.limit(0))
    assert {r["score"] for r in qt.score_documents(docs, none, ["doc_id"]).collect()} == {0.5}
    assert qt.score_documents(docs.limit(0), model, ["doc_id"]).count() == 0
    assert qt.fit(docs.limit(0), labels).base == 0


def test_scores_weigh_classes_by_their_numbers(spark):
    """Alike texts: the score is the share of quality 1, though classes are sampled evenly."""
    docs = docs_of(spark, ["same text"] * 400)
    labels = spark.createDataFrame([(i, int(i % 10 > 0)) for i in range(400)], "doc_id long, quality int")
    model = qt.fit(docs, labels, qt.QualityParams(sample_per_class=20))
    score = qt.score_documents(docs.limit(1), model, ["doc_id"]).first()["score"]
    assert 0.85 < score < 0.95

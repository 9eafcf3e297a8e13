import random

import numpy as np
import pytest

from skein.llm import cotrain

from .messy import messy


@pytest.fixture(scope="module")
def tables(spark):
    draw = random.Random(12)
    words = ["".join(draw.choices("abcdefghij", k=draw.randint(2, 8))) for _ in range(3000)]
    bad = ["zonk" + "".join(draw.choices("abcde", k=3)) for _ in range(200)]
    docs, labels, truth = [], [], {}
    for key in range(1500):
        text = draw.choices(words, k=draw.randint(20, 200))
        toxic, good = draw.random() < 0.15, draw.random() < 0.85
        for _ in range(4 * toxic):
            text.insert(draw.randrange(len(text)), draw.choice(bad))
        text = " ".join(text)
        text = text if good else text.upper().replace(" ", "!! ")
        source = f"src{draw.randrange(4) if good else 9}"
        docs.append((key, text, draw.choice(["en", "de", None]), source, len(text)))
        truth[key] = (int(good), int(toxic))
        if key < 900:
            labels.append((key, *truth[key]))
    labels += [(3, None, 1), (None, 1, 1), (99999, 0, 0), labels[0]]
    return (spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").repartition(4),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), truth)


def test_accuracy_on_rows_without_labels(tables):
    docs, labels, truth = tables
    rows = {r.doc_id: r for r in cotrain.score(docs, labels).collect()}
    assert len(rows) == len(truth)
    new = [k for k in truth if k >= 900]
    assert np.mean([(rows[k].p_toxic > 0.5) == bool(truth[k][1]) for k in new]) > 0.97
    assert np.mean([(rows[k].p_quality > 0.5) == bool(truth[k][0]) for k in new]) > 0.98
    clean = [k for k in new if truth[k] == (1, 0)]
    assert np.mean([rows[k].rejected for k in clean]) < 0.02


def test_views_teach_each_other(tables):
    docs, labels, _ = tables
    model = cotrain.fit(docs, labels)["quality"]
    odds = model.metadata_odds([cotrain.metadata_features("en", s, 500) for s in ("src1", "src9")])
    assert odds[0] > odds[1] + 1  # the source alone tells


def test_same_result_again(tables):
    docs, labels, _ = tables
    one, two = ({r.doc_id: r.p_toxic for r in cotrain.score(docs.repartition(n), labels).collect()} for n in (2, 5))
    assert one.keys() == two.keys() and max(abs(one[k] - two[k]) for k in one) < 1e-9


def test_messy_table(spark):
    labels = spark.createDataFrame([(3, 1, 0), (4, 0, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    docs = messy(spark)
    rows = cotrain.score(docs, labels, rows=True)
    assert rows.select("row.*").columns == docs.columns
    assert rows.count() == docs.count()
    none = cotrain.score(docs, labels.limit(0)).collect()
    assert {(r.p_quality, r.p_toxic, r.rejected) for r in none} == {(0.5, 0.5, False)}
    assert cotrain.score(messy(spark, 0), labels).collect() == []

import pickle
import random
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from entityframe.llm.toxicity import Examples, Vocabulary, _packed, _stems, _terms, _unpacked, drop_toxic, fit, toxicity, with_scores

SCHEMA = "doc_id long, text string, row int, toxicity string, score int"
LABELS = "doc_id long, quality int, toxic int"


def corpus(n=600, seed=1):
    chance = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(n):
        bad = i % 5 == 0
        text = [chance.choice(words) for _ in range(chance.randint(5, 80))]
        if bad:
            text += [chance.choice(["nasty", "vile", "rottenish", "rottener"]) for _ in range(chance.randint(1, 4))]
        chance.shuffle(text)
        rows.append((i, " ".join(text), 1, "x", 2))
        labels.append((i, 1, int(bad)))
    return rows, labels


def test_nearest_are_exact():
    random_ = np.random.default_rng(2)
    counts = [{int(t): int(random_.integers(1, 4)) for t in random_.choice(30, random_.integers(0, 5), replace=False)} for _ in range(500)]
    idf = random_.uniform(0.5, 3, 30)
    pairs = [(np.array(sorted(c), dtype=np.int64), np.array([c[x] for x in sorted(c)], dtype=np.int64)) for c in counts]
    index = Examples(pairs, list(range(500)), [i % 3 == 0 for i in range(500)], idf, neighbours=7, block=16)
    dense = np.zeros((500, 30))
    for i, c in enumerate(pairs):
        terms, weights = index._weigh(*c)
        dense[i, terms] = weights
    for c in pairs[:120]:
        terms, weights = index._weigh(*c)
        query = np.zeros(30)
        query[terms] = weights
        want = np.sort((dense @ query)[dense @ query > 0])[::-1][:7]
        places, cosines = index.nearest((terms, weights))
        assert cosines == pytest.approx(want)
        assert dense[index.ids[places]] @ query == pytest.approx(cosines)


def test_an_index_unpacks_in_little_memory():
    random_ = np.random.default_rng(4)
    pairs = [(np.sort(random_.choice(20_000, 300, replace=False)), random_.integers(1, 9, 300)) for _ in range(1000)]
    packed = pickle.dumps(Examples(pairs, list(range(1000)), [i % 4 == 0 for i in range(1000)], random_.uniform(0.5, 3, 20_000)))
    tracemalloc.start()
    index = pickle.loads(packed)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # Workers unpack it side by side: a few bytes for each of the 300,000 entries, no array for each example.
    assert most < 6_000_000
    assert [x[0] for x in index.scores(pairs[:20])] == [x[0] for x in pickle.loads(pickle.dumps(index)).scores(pairs[:20])]


def test_terms_of_a_batch_are_those_of_each_text():
    chance = random.Random(5)
    words = ["nasty", "nastier", "na", "rott", "rotten", "rottenish", "vile", "été", "x1"]
    texts = [" ".join(chance.choices(words, k=chance.randrange(30))) for _ in range(60)] + [None, "", "!?", "Nasty NASTY"]
    named = sorted({t for text in texts[:20] for t in _terms(text)} | {"nast*", "rotte*@2"})
    vocabulary = Vocabulary(named)
    for text, (terms, times) in zip(texts, vocabulary.counts(texts), strict=True):
        assert [named[t] for t in terms] == sorted(set(named) & _terms(text))
        stems = Counter(stem for word in (text or "").lower().split() for stem in _stems(word))
        assert [stems[named[t].split("@")[0]] for t in terms] == times.tolist()
    assert [terms.tolist() for terms, _ in Vocabulary([]).counts(["a b", None])] == [[], []]


def test_packed_terms_come_back():
    lists = [([3, 70_000], [1, 300]), ([], []), ([5], [70_000]), ([1, 2, 9], [1, 1, 2])]
    for some in (lists, lists[1:2], lists[1:], lists[3:]):
        cuts = np.cumsum([0, *(len(t) for t, _ in some)])
        packed = _packed(cuts, *(np.array(sum((x[i] for x in some), []), dtype=np.int64) for i in (0, 1)))
        batch = pa.RecordBatch.from_arrays(packed, names=["terms", "times"])
        assert [(t.tolist(), n.tolist()) for t, n in _unpacked(batch)] == some


def test_held_out_documents_are_scored_well(spark):
    rows, labels = corpus()
    got = toxicity(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, LABELS)).collect()
    assert len(got) == len(rows)
    truth = {i: y for i, _, y in labels}
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5)
        assert all(zlib.crc32(str(i).encode()) % 5 for i in r["evidence_ids"])
    apart = [r for r in got if r["held_out"]]
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in apart) >= 0.97 * len(apart)


def test_odd_rows_and_labels(spark):
    rows, labels = corpus()
    odd = [(9000, None, 1, "x", 2), (9001, "", 1, "x", 2), (None, "nasty vile nasty", 1, "x", 2), (9002, "nasty vile", 1, "x", 2), (9002, "w1 w2", 1, "x", 2), (9003, "w1 " * 100_000, 1, "x", 2)]
    labels += [(None, 1, 1), (77, 1, None), (5, 1, 7), (10**9, 1, 1), (9001, 1, 1), labels[0], (1, 0, 1)]
    docs = spark.createDataFrame(rows + odd, SCHEMA)
    model = fit(docs, spark.createDataFrame(labels, LABELS))
    found = [(r["row"]["text"], r["toxicity"]["score"]) for r in with_scores(docs, model).collect()]
    assert len(found) == len(rows) + len(odd)
    scores = dict(found)
    assert scores[None] == scores[""] == model.plain < 0.5 and scores["nasty vile nasty"] > 0.5
    kept = drop_toxic(docs, spark.createDataFrame(labels, LABELS))
    assert kept.columns == docs.columns
    texts = [r["text"] for r in kept.collect()]
    assert None in texts and "w1 w2" in texts and "nasty vile nasty" not in texts


@pytest.mark.parametrize("labels", [[], [(1, 1, 0)], [(1, 1, 1)]])
def test_without_both_labels(spark, labels):
    docs = spark.createDataFrame([(1, "a b", 1, "x", 2), (2, "c", 1, "x", 2)], SCHEMA)
    share = {r["score"] for r in toxicity(docs, spark.createDataFrame(labels, LABELS)).collect()}
    assert share == {float(bool(labels and labels[0][2]))}


def test_empty_table(spark):
    docs, labels = spark.createDataFrame([], SCHEMA), spark.createDataFrame([(1, 1, 1)], LABELS)
    assert toxicity(docs, labels).collect() == [] and drop_toxic(docs, labels).collect() == []


def test_few_examples_of_a_language_count(spark):
    rows, labels = corpus(n=2500)
    chance = random.Random(3)
    for i in range(3000, 3100):
        bad = i % 10 == 0
        text = [chance.choice([f"ö{j}" for j in range(100)]) for _ in range(40)] + ["übel", "gemein"] * bad
        rows.append((i, " ".join(text), 1, "x", 2))
        labels.append((i, 1, int(bad)))
    taught = [x for x in labels if x[0] < 3040]
    docs = spark.createDataFrame(rows, SCHEMA)
    model = fit(docs, spark.createDataFrame(taught, LABELS))
    # No example leaves the index, and every word of the examples is in it.
    assert len(model.ids) == len(taught) and {"ö7", "w7"} <= set(model.vocabulary.terms)
    scored = with_scores(docs.filter("doc_id >= 3040"), model).select("row.doc_id", "toxicity.score").collect()
    assert len(scored) == 60 and all((r["score"] >= 0.5) == (r["doc_id"] % 10 == 0) for r in scored)

import random

import pytest

from entityframe.llm.langid import Automata, fit, identify, normalise

SCHEMA = "doc_id long, text string, lang string, score string, pieces int"
PARTS = {"en": ["the", "ing", "th", "ou", "re", "wh"], "de": ["sch", "ung", "ei", "ü", "der", "keit"], "xx": ["qua", "zo", "mi", "la", "pe"]}


def pieces(text, sample):
    """Greedy longest pieces of `text` that occur in `sample`, a character at least."""
    count = at = 0
    while at < len(text):
        n = 1
        while at + n < len(text) and text[at : at + n + 1] in sample:
            n += 1
        if text[at : at + n] not in sample:
            n = 1
        count, at = count + 1, at + n
    return count


def sentence(lang, chance, words=40):
    return " ".join("".join(chance.choice(PARTS[lang]) for _ in range(chance.randint(1, 4))) for _ in range(words))


def test_pieces_match_brute_force():
    chance = random.Random(1)
    samples = {lang: normalise(sentence(lang, chance)) for lang in PARTS}
    automata = Automata(samples)
    texts = [normalise(sentence(chance.choice(list(PARTS)), chance, chance.randint(1, 60))) for _ in range(40)] + ["a", "ж", "жж th ж", "the"]
    got = automata.pieces(texts)
    for row, text in zip(got, texts, strict=True):
        spans = [text[a : a + 1024] for a in range(0, len(text), 1024)]
        assert row.tolist() == [sum(pieces(s, samples[lang]) for s in spans) for lang in automata.languages]


def test_held_out_accuracy_and_odd_texts(spark):
    chance = random.Random(2)
    rows = [(i, sentence(lang, chance), lang, "x", 1) for i, lang in enumerate(list(PARTS) * 20)]
    odd = [(1000, None, "en", "x", 1), (1001, "", "de", "x", 1), (1002, "12 %% _ 3", "de", "x", 1), (1003, "the " * 50_000, None, "x", 1), (None, "sch ung", None, "x", 1)]
    automata = fit(spark.createDataFrame(rows[:30] + odd, SCHEMA))
    assert automata.languages == sorted(PARTS)
    found = {r["doc_id"]: r for r in identify(spark.createDataFrame(rows[30:] + odd + rows[30:31], SCHEMA), automata).collect()}
    assert all(found[i]["lang_pred"] == lang for i, _, lang, *_ in rows[30:])
    assert [found[i]["lang_pred"] for i in (1000, 1001, 1002)] == ["und"] * 3
    assert found[1003]["lang_pred"] == "en" and found[None]["lang_pred"] == "de"
    assert all(0 <= r["score"] <= 1 for r in found.values())


def test_ties_and_one_language(spark):
    docs = spark.createDataFrame([(1, "same text", "b", "x", 1), (2, "same text", "a", "x", 1)], SCHEMA)
    assert {r["lang_pred"] for r in identify(docs, fit(docs)).collect()} == {"a"}
    one = identify(docs, fit(docs.filter("lang = 'b'"))).collect()
    assert {(r["lang_pred"], r["score"]) for r in one} == {("b", 1.0)}


@pytest.mark.parametrize("chars", [20, 200])
def test_sample_is_bounded(spark, chars):
    rows = [(i, "the thing " * 30, "en", "x", 1) for i in range(50)]
    automata = fit(spark.createDataFrame(rows, SCHEMA), chars=chars)
    assert len(automata.next) <= 2 * chars + 3


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert identify(docs, fit(docs)).collect() == []


def test_every_language_is_learned_and_groups_agree(spark):
    chance = random.Random(4)
    names = [f"l{i:03}" for i in range(230)]
    parts = {n: ["".join(chance.choice("abcdefghijklmnopqrstuvwxyzäöü") for _ in range(3)) for _ in range(6)] for n in names}
    rows = [(i, " ".join(chance.choice(parts[n]) + chance.choice(parts[n]) for _ in range(12)), n, "x", 1) for i, n in enumerate(names * 2)]
    automata = fit(spark.createDataFrame(rows[:230], SCHEMA))
    assert automata.languages == names
    odd = [(1000, None, None, "x", 1), (1001, "12", None, "x", 1), (None, "жж", None, "x", 1)]
    docs = spark.createDataFrame(rows[230:] + odd, SCHEMA)
    whole = sorted(map(tuple, identify(docs, automata).collect()), key=str)
    assert len(automata.parts(400_000)) > 2
    assert sorted(map(tuple, identify(docs, automata, 400_000).collect()), key=str) == whole
    truth = {i: n for i, _, n, *_ in rows[230:]}
    assert sum(truth[i] == lang for i, lang, *_ in whole if i in truth) >= 0.95 * len(truth)

import zlib
from collections import defaultdict

import numpy as np
import pytest

from entityframe.llm.packing import LENGTH, Packing, Problem, crossover, evolve, mutated, pack_documents, packed, token_sequences
from entityframe.llm.tokens import encoder, vocabulary_path

SCHEMA = "doc_id long, text string, piece int, offset string"


def whole(problem, packing):
    fills = np.bincount(packing.owner, weights=problem.lengths, minlength=len(packing.fills))
    return (packing.owner >= 0).all() and (fills == packing.fills).all() and fills.max(initial=0) <= problem.capacity and (fills > 0).all()


def problem(seed, n=300, low=200, high=1400):
    random = np.random.default_rng(seed)
    return Problem(np.sort(random.integers(low, high, n))[::-1], 2048), random


@pytest.mark.parametrize("seed", range(4))
def test_offspring_hold_every_piece_once(seed):
    task, random = problem(seed)
    a = packed(task, list(range(300)))
    b = packed(task, random.permutation(300).tolist())
    for child in (crossover(task, a, b, random), crossover(task, b, a, random), mutated(task, b, random)):
        assert whole(task, a) and whole(task, b) and whole(task, child)
        assert len(child.fills) >= task.bound


def test_evolution_beats_best_fit_where_that_is_not_optimal():
    gains = []
    for seed in range(6):
        task, _ = problem(seed, 120, 500, 900)
        start = packed(task, list(range(120)))
        best = evolve(task, [seed], population=10, generations=40)
        assert whole(task, best) and best.rank <= start.rank
        gains.append(start.rank > best.rank)
    assert any(gains)


def test_migrants_are_kept():
    task, _ = problem(5)
    first = evolve(task, [1])
    assert evolve(task, [2], [first]).rank <= first.rank
    assert isinstance(first, Packing)


@pytest.mark.parametrize("lengths", [[], [2048], [1], [1025] * 9, [682] * 9, [1024] * 7])
def test_bound_is_met_by_simple_cases(lengths):
    task = Problem(np.array(lengths, dtype=np.int64), 2048)
    best = evolve(task, [0])
    assert len(best.fills) == task.bound


def check(docs, rows, texts, length=LENGTH):
    ids = {k: np.append(encoder(vocabulary_path()).ids(t or ""), 0).astype("<u4") for k, t in texts.items()}
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[(r["doc_id"], r["text_hash"])].append(r)
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in by_sequence.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= length
    total = sum(r["length"] for r in rows)
    assert total == sum(len(x) for x in ids.values())
    crcs = sorted(r["ids_crc32"] for r in rows)
    want = []
    for x in ids.values():
        first = len(x) if len(x) <= length else len(x) % length or length
        cuts = [0, *range(first, len(x) + 1, length)]
        want += [zlib.crc32(x[a:b].tobytes()) for a, b in zip(cuts, cuts[1:])]
    assert crcs == sorted(want)
    return by_sequence, -(-total // length)


def test_documents_of_all_kinds(spark):
    texts = {
        i: t
        for i, t in enumerate(
            [None, "", "one", "one", "<|endoftext|> inside", "w" * 60_000, "some words " * 3000, "é ² ⅷ \x1c ０ x", *("abc " * n for n in range(1, 400, 7))]
        )
    }
    rows = [(i, t, 7, "x") for i, t in texts.items()]
    rows += [(3, "another text with id 3", 7, "x"), (None, "no id", 7, "x")]
    docs = spark.createDataFrame(rows, SCHEMA)
    placed = pack_documents(docs, shard=20).cache()
    by_sequence, bound = check(docs, placed.collect(), {n: r[1] for n, r in enumerate(rows)})
    assert len(by_sequence) <= bound + 3
    sequences = {r["sequence_id"]: r["ids"] for r in token_sequences(docs, placed).collect()}
    assert {k: len(v) for k, v in sequences.items()} == {k: sum(n for _, n in v) for k, v in by_sequence.items()}


def test_encoder_agrees_with_the_library():
    encode = encoder(vocabulary_path())
    for text in ["It's 'S we'll  !!", "a\n\n b \t c  ", "l’été œuvre 12ⅷ", "<|endoftext|>x", "日本 語", "x_1 __ 3²"]:
        assert encode.ids(text).tolist() == encode._whole.encode(text, add_special_tokens=False).ids


def test_empty_table(spark):
    assert pack_documents(spark.createDataFrame([], SCHEMA)).collect() == []

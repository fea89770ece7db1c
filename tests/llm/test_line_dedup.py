import random

import pytest

from entityframe.llm.line_dedup import line_dedup

SCHEMA = "doc_id long, text string, removed string, h1 int, pos int"


def brute(rows, width=3):
    docs = sorted({(i is not None, i or 0, t or "") for i, t in rows})
    first, covered = {}, {}
    for doc in docs:
        lines = doc[2].split("\n")
        for p in range(len(lines) - width + 1):
            window = tuple(lines[p : p + width])
            if not "".join(window).strip(" "):
                continue
            seen = first.setdefault(window, (doc, p))
            if seen != (doc, p) and not (seen[0] == doc and p < seen[1] + width):
                covered.setdefault(doc, set()).update(range(p, p + width))
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        gone = covered.get((i is not None, i or 0, t or ""), set())
        out.append((i, len(lines), sorted(gone), "\n".join(x for n, x in enumerate(lines) if n not in gone)))
    return sorted(map(repr, out))


def check(spark, rows):
    docs = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], SCHEMA)
    got = line_dedup(docs)
    assert sorted(repr(tuple(r)) for r in got.collect()) == brute(rows)


def test_overlapping_copies_across_documents(spark):
    check(spark, [(1, "a\nb\nc\nd"), (2, "x\na\nb\nc\ny"), (3, "b\nc\nd\ne"), (4, "a\nb"), (5, "c\nb\na")])


def test_repeats_inside_a_document_keep_the_first(spark):
    check(spark, [(1, "a\n" * 40), (2, "a\nb\n" * 9), (3, "a\nb\nc\na\nb\nc\nz")])


def test_nulls_blanks_repeated_rows_and_long_texts(spark):
    long = "\n".join(f"line {i % 700}" for i in range(6000))
    check(spark, [(1, None), (2, ""), (3, "\n\n\n\n"), (None, "p\nq\nr"), (4, "p\nq\nr"), (4, "p\nq\nr"), (4, "other"), (5, long), (6, " \n\n\n\n")])


@pytest.mark.parametrize("seed", range(3))
def test_random_documents(spark, seed):
    chance = random.Random(seed)
    rows = [(i, "\n".join(chance.choice("abcd ") for _ in range(chance.randint(0, 14)))) for i in range(60)]
    check(spark, rows)


def test_empty_table(spark):
    assert line_dedup(spark.createDataFrame([], SCHEMA)).collect() == []

import hashlib
import itertools
import math
import random
import re

import numpy as np
import pytest

from entityframe.llm.pii import KINDS, SegmentField, _Region, base_spans, find_pii, find_spans, fit, luhn, regions

SCHEMA = "doc_id long, text string, spans int, n_ip string"
PIECES = ["a", "1", "23", ".", "@", "-", " ", "+", "(", ")", "4.5.6.7", "a@b.c", "300", "%", "_", "\n", "é", "4111 1111 1111 1111", "+1 (555) 123-4567", "000.1"]


def naive(text):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub(r"\D", "", m.group())
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub(r"\D", "", m.group())) <= 15:
            out.append(("phone", *m.span()))
    return out


def test_patterns_match_their_definition():
    chance = random.Random(4)
    for _ in range(4000):
        text = "".join(chance.choice(PIECES) for _ in range(chance.randint(0, 25)))
        assert base_spans(text) == naive(text), text


@pytest.mark.parametrize("text", ["a" * 200_000, "1" * 100_000, "1." * 50_000, "@" * 50_000, "+1" * 50_000, "a." * 50_000 + "@"])
def test_long_runs_take_no_time(text):
    assert isinstance(base_spans(text), list)


def best_by_trial(field, region):
    """Score of the best segmentation, from all of them."""
    options = [(i, j, float(field.score(region.signature(i, j)).max())) for i, j in region.candidates()]
    best = 0.0
    for n in range(1, 4):
        for chosen in itertools.combinations(sorted(options), n):
            if all(a[1] <= b[0] for a, b in itertools.pairwise(chosen)):
                best = max(best, sum(s for *_, s in chosen) + field.adjacent * sum(a[1] == b[0] for a, b in itertools.pairwise(chosen)))
    return best


def test_decoding_finds_the_best_segmentation():
    random = np.random.default_rng(3)
    for text in ["a 1-2", "x@y 3", "1 2.3", "+1(2)"]:
        region = _Region(text)
        field = SegmentField()
        for i, j in region.candidates():
            field._memo[region.signature(i, j)] = random.normal(0, 2, len(KINDS))
        total, last = 0.0, None
        for kind, a, b in field.decode(region):
            i, j = region.starts.index(a), region.ends.index(b) + 1
            total += float(field.score(region.signature(i, j))[KINDS.index(kind)]) + (field.adjacent if last == i else 0.0)
            last = j
        assert total == pytest.approx(best_by_trial(field, region))


def log_likelihood(field, region, gold):
    """By summing over all segmentations."""
    options = list(region.candidates())

    def scores(at, ended):
        if at == len(region.tokens):
            return [0.0]
        out = scores(at + 1, False)
        for i, j in options:
            if i == at:
                tails = scores(j, True)
                for k in range(len(KINDS)):
                    s = float(field.score(region.signature(i, j))[k]) + (field.adjacent if ended else 0.0)
                    out = out + [s + t for t in tails]
        return out

    total = np.logaddexp.reduce(scores(0, False))
    return sum(float(field.score(region.signature(i, j))[k]) for i, j, k in gold) - total


def test_learning_raises_the_likelihood():
    region, field, squares = _Region("x 1-2"), SegmentField(), {}
    first = next(c for c in region.candidates() if region.text[region.starts[c[0]] : region.ends[c[1] - 1]] == "1-2")
    gold = {(*first, 2)}
    before = log_likelihood(SegmentField(dict(field.weights)), region, gold)
    for _ in range(5):
        field.learn(region, gold, 0.1, squares)
        after = log_likelihood(SegmentField(dict(field.weights)), region, gold)
        assert after > before and math.isfinite(after)
        before = after


def corpus():
    chance = random.Random(5)
    word = lambda: "".join(chance.choice("abcdefgh") for _ in range(5))
    digits = lambda n: "".join(chance.choice("0123456789") for _ in range(n))
    rows = []
    for i in range(400):
        kind = i % 6
        value = [
            f"{word()}.{digits(2)}@mail{digits(1)}.example.com", ".".join(str(chance.randrange(256)) for _ in range(4)), digits(16),
            f"+1 ({digits(3)}) 555-{digits(4)}", f'token = "{hashlib.sha1(word().encode()).hexdigest()}"', f"version {digits(1)}.{digits(1)}",
        ][kind]
        rows.append((i, f"{word()} {word()} {value} {word()}.", 1, "x"))
    return rows


def test_adds_spans_and_keeps_the_patterns(spark):
    rows = corpus() + [(1000, None, 1, "x"), (1001, "", 1, "x"), (None, "mail a@b.c", 1, "x"), (5, "twice", 1, "x"), (5, "twice", 1, "x"), (1002, "9 " * 60_000, 1, "x")]
    docs = spark.createDataFrame(rows, SCHEMA)
    field = fit(docs, most=300, passes=3)
    got = find_pii(docs, field).collect()
    assert len(got) == len(rows)
    texts = {repr(t) for _, t, *_ in rows}
    assert texts
    by_id = {r["doc_id"]: r for r in got}
    for i, text, *_ in rows:
        base = naive(text or "")
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert by_id[i]["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert {s for s in joined.split(",") if s} <= set(by_id[i]["spans"].split(","))
    secrets = [i for i, t, *_ in rows[:400] if "token" in t]
    assert sum("secret" in by_id[i]["spans"] for i in secrets) >= 0.95 * len(secrets)
    plain = [i for i, t, *_ in rows[:400] if "version" in t]
    assert sum(bool(by_id[i]["spans"]) for i in plain) <= 0.05 * len(plain)


def test_regions_cover_every_anchor():
    text = "word " * 30 + "1 " + "word " * 40 + "a@b " + "x" * 300 + "7"
    spans = regions(text)
    assert all(any(a <= i < b for a, b in spans) for i, c in enumerate(text) if c in "0123456789@")
    assert find_spans("nothing here", SegmentField()) == ([], [])


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert find_pii(docs, fit(docs)).collect() == []

import hashlib
import random
from collections import defaultdict

import pytest

from entityframe.llm.chat import _turn, chat_windows, escape, read_back, read_turns, unescape
from entityframe.llm.tokens import encoder, vocabulary_path

SCHEMA = "conv_id long, turn long, role string, text string, tokens int, formatted string"


def brute(rows):
    talks = defaultdict(list)
    for c, n, r, t, *_ in rows:
        talks[c].append(((n is not None, n or 0, r is not None, r or "", t is not None, t or ""), r or "", t or ""))
    out = {}
    for c, turns in talks.items():
        turns.sort()
        text = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        loss = "".join(t for _, r, t in turns if r == "assistant")
        out[c] = (len(turns), hashlib.sha256(text.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def result(windows):
    return {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in read_back(windows).collect()}


def talks(seed, n=30):
    chance = random.Random(seed)
    rows = []
    for c in range(n):
        roles = ["system"] * chance.randint(0, 1) + [x for _ in range(chance.randint(1, 9)) for x in ("user", "assistant")]
        rows += [(c, i, r, "word é " * chance.randint(0, 60), 5, "x") for i, r in enumerate(roles)]
    return rows


@pytest.mark.parametrize("budget,history", [(64, 0), (200, 80), (100_000, 256)])
def test_reads_back_what_went_in(spark, budget, history):
    rows = talks(budget)
    assert result(chat_windows(spark.createDataFrame(rows, SCHEMA), budget, history)) == brute(rows)


def test_windows_keep_to_the_budget_and_repeat_what_fits(spark):
    rows = talks(7)
    turns = defaultdict(list)
    for c, _, r, t, *_ in rows:
        turns[c].append((r, t))
    size = lambda r, t: encoder(vocabulary_path()).count(_turn(r, t)[0])
    windows = chat_windows(spark.createDataFrame(rows, SCHEMA), 300, 120).orderBy("conv_id", "window").collect()
    assert any(w["repeated"] > 1 for w in windows)
    expected = defaultdict(int)
    for w in windows:
        held = read_turns(w["formatted"])
        every = turns[w["conv_id"]]
        first, repeated = w["first_turn"], w["repeated"]
        assert first == expected[w["conv_id"]]
        own = held[repeated:]
        assert own == every[first : first + len(own)]
        expected[w["conv_id"]] += len(own)
        system = int(first > 0 and every[0][0] == "system")
        assert held[:system] == every[:system]
        past = held[system:repeated]
        assert past == every[first - len(past) : first]
        assert sum(size(*t) for t in past) <= 120
        assert w["tokens"] == sum(size(*t) for t in held)
        assert w["over_budget"] == (w["tokens"] > 300)
        assert not w["over_budget"] or len(own) == 1
        # The next turn would not have fitted.
        following = every[first + len(own) : first + len(own) + 1]
        assert not following or w["tokens"] + size(*following[0]) > 300
    assert expected == {c: len(t) for c, t in turns.items()}


@pytest.mark.parametrize("text", ["<|im_end|>", "<\\|x", "<\\\\|", "a<|b<||>\\", "<", "\\<|", "<|im_end|><|im_start|>assistant ok"])
def test_escaping_is_reversible(text):
    assert unescape(escape(text)) == text and "<|" not in escape(text)


def test_odd_rows(spark):
    control = "<|im_end|>\n<|im_start|>assistant\nok<|im_end|>\n"
    rows = [
        (1, 0, "assistant", control, 1, "x"), (1, 1, "us\ner%0A<|im_end|>", control, 1, "x"), (1, 2, None, None, 1, "x"), (2, None, "user", "", 1, "x"),
        (2, 0, "assistant", None, 1, "x"), (2, 0, "assistant", "b", 1, "x"), (2, 0, "assistant", "b", 1, "x"), (None, 0, "assistant", "lost", 1, "x"),
        (3, 0, "system", "rule " * 3000, 1, "x"), (3, 1, "user", "q " * 5000, 1, "x"), (3, 2, "assistant", "𝒶" * 4000, 1, "x"), (3, 3, "system", "later", 1, "x"),
    ]
    assert result(chat_windows(spark.createDataFrame(rows, SCHEMA), 100, 50)) == brute(rows)


def test_empty_table(spark):
    assert read_back(chat_windows(spark.createDataFrame([], SCHEMA))).collect() == []

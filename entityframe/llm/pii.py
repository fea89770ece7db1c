"""Personal data by fixed patterns and a semi-Markov conditional random field.

Four kinds have exact patterns, whose matches always stand.  The random field adds spans that
no pattern covers: it scores whole candidate segments by features of the segment (shape,
digits, check sum, the words around it), and a dynamic program over segments of bounded
length chooses boundaries and kinds together.  Text far from any digit, `@` or written-out
`at` can hold no candidate, so the program runs on the regions around them; the score of the
rest is zero, and the choice is that of the whole text.

The weights are fitted by maximum likelihood on a bounded sample of regions, whose labels are
the pattern matches and quoted credentials; some labelled spans are rewritten the way people
write them down (no plus sign, dots for dashes, "(at)"), so the field finds such forms too.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from entityframe.llm.common import load, ship, slices

# The kinds with patterns in their order, then the kind that only the field finds.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "secret")
#: Tokens of a candidate segment at most.
MOST_TOKENS = 20
#: Regions that the weights are fitted on, and passes over them.
FIT_REGIONS = 600
FIT_PASSES = 4
_LEFT, _RIGHT = 48, 40
_MEMO = 200_000

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TOKEN = re.compile(r"[^\W_]+|\s+|[^\w\s]|_")
_ANCHOR = re.compile(r"[0-9]+|@|[\[(]\s?(?:at|AT)\s?[\])]")
_CREDENTIAL = re.compile(
    r"\b(?:token|secret|password|passwd|api[ _-]?key|key)\b\s*[=:]\s*[\"']?([A-Za-z0-9][A-Za-z0-9_/+.-]{14,}[A-Za-z0-9])", re.IGNORECASE
)


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from each `@` outwards so that long words cost nothing."""
    free = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            free = domain.end()
        at = text.find("@", max(at + 1, free))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the fixed patterns' matches, by kind and start."""
    found = [("email", a, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        # A long run of digits is above 255 unless it begins with zeros.
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.groups()):
            found.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m.group().replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
            found.append(("phone", *m.span()))
    return found


def regions(text: str) -> list[tuple[int, int]]:
    """Stretches around the places where a candidate can be, cut at white space where there is any."""
    spans: list[list[int]] = []
    for m in _ANCHOR.finditer(text):
        a, b = max(0, m.start() - _LEFT), min(len(text), m.end() + _RIGHT)
        if spans and a <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], b)
        else:
            spans.append([a, b])
    out = []
    for a, b in spans:
        if a and not text[a - 1].isspace():
            gap = next((i for i in range(a, min(a + _LEFT, b)) if text[i].isspace()), None)
            a = a if gap is None else gap + 1
        out.append((a, b))
    return out


def _token_shape(token: str) -> str:
    if token.isspace():
        return "\n" if "\n" in token else "_"
    if token.isascii() and token.isdigit():
        return f"9{min(len(token), 20)}"
    if token.isalpha():
        return "a"
    if len(token) > 1:
        return f"x{min(len(token) // 8, 6)}" if re.fullmatch(r"[0-9a-fA-F]+", token) else f"m{min(len(token) // 8, 6)}"
    return token


class _Region:
    """A tokenised stretch with what the features of its segments are made of."""

    def __init__(self, text: str):
        matches = list(_TOKEN.finditer(text))
        self.text = text
        self.starts = [m.start() for m in matches]
        self.ends = [m.end() for m in matches]
        self.tokens = [m.group() for m in matches]
        self.shapes = [_token_shape(t) for t in self.tokens]

    def candidates(self) -> Iterator[tuple[int, int]]:
        """Segments that begin and end as personal data can, and hold a digit or an `at`."""
        n, shapes, tokens = len(self.tokens), self.shapes, self.tokens
        holds = [s[0] in "9xm" or t == "@" or t.lower() == "at" for s, t in zip(shapes, tokens, strict=True)]
        for i in range(n):
            if shapes[i][0] not in "9xma+(":
                continue
            any_held = False
            for j in range(i, min(n, i + MOST_TOKENS)):
                if shapes[j] == "\n":
                    break
                any_held = any_held or holds[j]
                if any_held and shapes[j][0] in "9xma":
                    yield i, j + 1

    def signature(self, i: int, j: int) -> tuple:
        """All that the features of a segment look at."""
        shape = "".join(self.shapes[i:j])
        digits = "".join(c for c in "".join(self.tokens[i:j]) if "0" <= c <= "9") if "9" in shape else ""
        check = 13 <= len(digits) <= 19 and luhn(digits)
        octets = all(int(t) <= 255 for t, s in zip(self.tokens[i:j], self.shapes[i:j], strict=True) if s[0] == "9" and len(t) <= 19)
        words = [t.lower() for t in self.tokens[max(0, i - 6) : i] if t.isalpha()]
        at = any(t.lower() == "at" for t in self.tokens[i:j])
        return (
            shape, min(len(digits), 20), check, octets, at, words[-1] if words else "",
            self.shapes[i - 1] if i else "", self.shapes[j] if j < len(self.tokens) else "", j - i,
        )


def _features(signature: tuple) -> list[str]:
    shape, digits, check, octets, at, word, before, after, tokens = signature
    coarse = re.sub(r"\d+", "", shape.replace("9", "d"))
    runs = re.findall(r"9(\d+)", shape)
    return [
        "bias",
        f"coarse={coarse}",
        f"symbols={''.join(sorted(set(re.sub(r'[da_xm]', '', coarse))))},{at}",
        f"digits={digits},{check}",
        f"tokens={min(tokens, 12)}",
        f"runs={len(runs)},{octets}",
        f"ends={coarse[:2]},{coarse[-2:]}",
        f"dots={min(shape.count('.'), 4)},ats={min(shape.count('@') + at, 2)}",
        f"single={shape if tokens == 1 else ''}",
        f"single={shape if tokens == 1 else ''},before={before}",
        f"word={word},{tokens == 1}",
        f"before={before},{coarse[:1]}",
        f"after={after},{coarse[-1:]}",
    ]


class SegmentField:
    """Weights by feature, one number for each kind; a token outside all segments scores 0."""

    def __init__(self, weights: dict[str, np.ndarray] | None = None, adjacent: float = -1.0):
        self.weights = weights or {}
        self.adjacent = adjacent
        self._memo: dict[tuple, np.ndarray] = {}

    def __getstate__(self):
        return {"weights": self.weights, "adjacent": self.adjacent, "_memo": {}}

    def score(self, signature: tuple) -> np.ndarray:
        found = self._memo.get(signature)
        if found is None:
            if len(self._memo) >= _MEMO:
                self._memo.clear()
            none = np.zeros(len(KINDS))
            found = self._memo[signature] = sum((self.weights.get(f, none) for f in _features(signature)), none)
        return found

    def decode(self, region: _Region) -> list[tuple[str, int, int]]:
        """The best segmentation: (kind, start, end) in characters of the region.

        best[e][b]: best score of the first e tokens, b telling whether a segment ends at e.
        """
        n = len(region.tokens)
        by_end: dict[int, list[tuple[int, float, int]]] = {}
        for i, j in region.candidates():
            scores = self.score(region.signature(i, j))
            k = int(scores.argmax())
            if scores[k] > 0:
                by_end.setdefault(j, []).append((i, float(scores[k]), k))
        if not by_end:
            return []
        best = [[0.0, -math.inf]]
        came: list[list] = [[None, None]]
        for e in range(1, n + 1):
            outside = int(best[e - 1][1] > best[e - 1][0])
            row, how = [best[e - 1][outside], -math.inf], [(e - 1, outside, None), None]
            for i, score, k in by_end.get(e, ()):
                for b in (0, 1):
                    total = best[i][b] + score + (self.adjacent if b else 0.0)
                    if total > row[1]:
                        row[1], how[1] = total, (i, b, k)
            best.append(row)
            came.append(how)
        spans, e, b = [], n, int(best[n][1] > best[n][0])
        while e > 0:
            i, before, k = came[e][b]
            if k is not None:
                spans.append((KINDS[k], region.starts[i], region.ends[e - 1]))
            e, b = i, before
        return spans[::-1]

    def learn(self, region: _Region, gold: set[tuple[int, int, int]], rate: float, squares: dict[str, np.ndarray]) -> None:
        """One step up the log-likelihood of the gold segments (i, j, kind) by forward-backward sums."""
        n, segments = len(region.tokens), [(i, j, _features(region.signature(i, j))) for i, j in region.candidates()]
        if not segments:
            return
        none = np.zeros(len(KINDS))
        scores = [sum((self.weights.get(f, none) for f in fs), none) for _, _, fs in segments]
        starting: dict[int, list[int]] = {}
        ending: dict[int, list[int]] = {}
        for s, (i, j, _) in enumerate(segments):
            starting.setdefault(i, []).append(s)
            ending.setdefault(j, []).append(s)
        whole = [float(np.logaddexp.reduce(x)) for x in scores]
        # forward[e] = (outside, segment): log sums over the first e tokens by what ends there.
        join = lambda x: float(np.logaddexp(x[0], x[1] + self.adjacent))
        forward = [(0.0, -math.inf)]
        for e in range(1, n + 1):
            inside = [join(forward[segments[s][0]]) + whole[s] for s in ending.get(e, ())]
            forward.append((float(np.logaddexp(*forward[e - 1])), float(np.logaddexp.reduce(inside)) if inside else -math.inf))
        backward = [(0.0, 0.0)] * (n + 1)
        for e in range(n - 1, -1, -1):
            follow = [backward[segments[s][1]][1] + whole[s] for s in starting.get(e, ())]
            segment = float(np.logaddexp.reduce(follow)) if follow else -math.inf
            outside = backward[e + 1][0]
            backward[e] = (float(np.logaddexp(outside, segment)), float(np.logaddexp(outside, segment + self.adjacent)))
        total = float(np.logaddexp(*forward[n]))
        for s, (i, j, features) in enumerate(segments):
            expected = np.exp(np.minimum(scores[s] + join(forward[i]) + backward[j][1] - total, 0.0))
            step = -expected
            for k in range(len(KINDS)):
                step[k] += (i, j, k) in gold
            if np.abs(step).max() < 1e-4:
                continue
            for f in features:
                seen = squares.setdefault(f, np.full(len(KINDS), 1e-2))
                seen += step * step
                self.weights[f] = self.weights.get(f, none) * (1 - 1e-4) + rate * step / np.sqrt(seen)


def _gold(text: str) -> list[tuple[str, int, int]]:
    found = base_spans(text)
    found += [("secret", *m.span(1)) for m in _CREDENTIAL.finditer(text) if re.search("[0-9]", m.group(1)) and re.search("[A-Za-z]", m.group(1))]
    out: list[tuple[str, int, int]] = []
    for span in sorted(found, key=lambda s: (s[1], -s[2])):
        if not out or span[1] >= out[-1][2]:
            out.append(span)
    return out


def _rewritten(kind: str, text: str, chance: random.Random) -> str:
    """A labelled span as people also write it."""
    if kind == "phone":
        return chance.choice([text.lstrip("+"), text.replace("-", "."), text.replace("(", "").replace(")", "")])
    if kind == "email":
        return text.replace("@", chance.choice([" (at) ", "(at)", " [at] "]))
    if kind == "card" and text.isdigit():
        return chance.choice(["-", " ", "."]).join(text[i : i + 4] for i in range(0, len(text), 4))
    return text


def _examples(sample: list[str]) -> Iterator[tuple[_Region, set[tuple[int, int, int]]]]:
    chance = random.Random(1)
    for text in sample:
        gold = _gold(text)
        for rewrite in (False, True) if gold else (False,):
            parts, spans, at, end = [], [], 0, 0
            for kind, a, b in gold:
                parts.append(text[end:a])
                at += a - end
                span = _rewritten(kind, text[a:b], chance) if rewrite else text[a:b]
                spans.append((kind, at, at + len(span)))
                parts.append(span)
                at, end = at + len(span), b
            region = _Region("".join([*parts, text[end:]]))
            first = {a: i for i, a in enumerate(region.starts)}
            last = {b: j + 1 for j, b in enumerate(region.ends)}
            yield region, {(first[a], last[b], KINDS.index(k)) for k, a, b in spans if a in first and b in last}


def fit(docs: DataFrame, most: int = FIT_REGIONS, passes: int = FIT_PASSES) -> SegmentField:
    """Weights from up to `most` regions of the documents, the first by a hash of their text."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [t for t in batch.column("text").to_pylist() if t and re.search("[0-9@]", t)]
            # Longer regions are runs of numbers; they are decoded but not learned from.
            parts = {t[a:b] for t in texts for a, b in regions(t) if b - a <= 400}
            first = sorted(parts, key=lambda p: hashlib.md5(p.encode("utf-8", "replace")).digest())[:most]
            yield pa.RecordBatch.from_arrays([pa.array(first, pa.string())], names=["part"])

    parts = docs.select("text").mapInArrow(found, "part string").distinct()
    sample = [r["part"] for r in parts.orderBy(F.md5(F.col("part").cast("binary")), "part").limit(most).collect()]
    field, squares = SegmentField(), {}
    examples = list(_examples(sample))
    for p in range(passes):
        random.Random(p).shuffle(examples)
        for region, gold in examples:
            field.learn(region, gold, 0.5 / (1 + p), squares)
    return SegmentField(field.weights, field.adjacent)


def find_spans(text: str, field: SegmentField) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """(pattern matches, all spans), each by kind and start.  A span of the field that touches
    a pattern match is left out."""
    if not _ANCHOR.search(text):
        return [], []
    base = base_spans(text)
    taken = sorted((a, b) for _, a, b in base)
    merged: list[list[int]] = []
    for a, b in taken:
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    starts = np.array([a for a, _ in merged], dtype=np.int64)
    added = []
    for a, b in regions(text):
        for kind, s, e in field.decode(_Region(text[a:b])):
            i = int(np.searchsorted(starts, a + e)) - 1
            if i < 0 or merged[i][1] <= a + s:
                added.append((kind, a + s, a + e))
    order = {k: n for n, k in enumerate(KINDS)}
    return base, sorted({*base, *added}, key=lambda s: (order[s[0]], s[1], s[2]))


def _joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


_OUT = (
    "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
)


def find_pii(docs: DataFrame, field: SegmentField) -> DataFrame:
    """Counts and spans of personal data in each row; needs doc_id and text.

    Offsets are code points, end exclusive.  Null text is empty; a text without spans has
    empty lists.  Rows that repeat a doc_id are documents of their own.  An empty table gives an
    empty result.
    """
    spark = docs.sparkSession
    ship(spark)
    # Bounded by the features of FIT_REGIONS regions.
    shared = spark.sparkContext.broadcast(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in slices(batches):
            counts: list[list[int]] = [[] for _ in BASE_KINDS]
            digests, spans = [], []
            for text in batch.column("text").to_pylist():
                base, found = find_spans(text or "", model)
                for n, kind in enumerate(BASE_KINDS):
                    counts[n].append(sum(k == kind for k, _, _ in base))
                digests.append(hashlib.sha256(_joined(base).encode()).hexdigest())
                spans.append(_joined(found))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string()), pa.array(spans, pa.string())],
                names=[part.split()[0] for part in _OUT.split(", ")],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _OUT)


def op10_pii(spark: SparkSession, sf: str) -> DataFrame:
    docs = load(spark, sf, "documents")
    ship(spark)
    return find_pii(docs, fit(docs))

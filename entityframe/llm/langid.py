"""Language identification by cross-parsing entropy.

For each language a suffix automaton is built over labelled text.  A text is parsed against
it from left to right into the longest pieces that occur there; a text in the same language
falls into few, long pieces.  The language that needs the fewest pieces for the text's
length wins.

The automata are fitted on a bounded sample of labelled texts of every language; every text is
parsed whole.  Languages whose automata do not fit one table are parsed group by group, and
the fewest pieces over all groups win.
Parsing runs over many pieces of text at once: one step moves all of them, in all languages,
by one character through the transition table.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from entityframe.llm.common import held_out, load, ship, slices, stage
from entityframe.sources.staging import release, staged_count

#: Characters of labelled text per language that an automaton is built on.
FIT_CHARS = 24_000
#: Labelled documents per language that may be looked at for that.
FIT_DOCUMENTS = 200
#: Entries of a transition table at most, unless one language alone needs more.
TABLE = 48_000_000
#: Texts are parsed in stretches of so many characters; a stretch's end also ends a piece.
STRETCH = 1024
UNKNOWN = "und"
_LANES = 4096
_PARSED = "doc_id long, text string, lang string, rate double, next double"


def normalise(text: str) -> str:
    """Lower-case letters; anything else between them is one space."""
    return re.sub(r"[\W\d_]+", " ", text.lower()).strip()


class Automata:
    """Suffix automata of all languages in one table: next[state, symbol], 0 where there is none.

    State `root[k]` is the start of language k.  Symbol 0 is any character that no labelled
    text has.
    """

    def __init__(self, texts: dict[str, str]):
        self.languages = sorted(texts)
        self.texts = texts
        self.alphabet = "".join(sorted(set().union(*texts.values()) | {" "}))
        self.symbols = {c: i + 1 for i, c in enumerate(self.alphabet)}
        self.root = []
        top = max(map(ord, self.alphabet)) + 1
        self.codes = np.zeros(top + 1, dtype=np.int32)
        self.codes[[ord(c) for c in self.alphabet]] = list(self.symbols.values())

    @cached_property
    def next(self) -> np.ndarray:
        rows: list[dict[int, int]] = [{}]
        root = []
        for language in self.languages:
            start = len(rows)
            root.append(start)
            rows.extend(_suffix_automaton([self.symbols[c] for c in self.texts[language]], start))
        self.root = root
        table = np.zeros((len(rows), len(self.alphabet) + 1), dtype=np.int32)
        for state, row in enumerate(rows):
            if row:
                table[state, list(row)] = list(row.values())
        return table

    def parts(self, table: int = TABLE) -> list[Automata]:
        """Automata of groups of the languages, in order, with tables of `table` entries at most."""
        groups: list[dict[str, str]] = [{}]
        states, alphabet = 1, {" "}
        for language in self.languages:
            text = self.texts[language]
            # An automaton has fewer than two states a character.
            more, wider = states + 2 * len(text) + 1, alphabet | set(text)
            if groups[-1] and more * (len(wider) + 1) > table:
                groups.append({})
                more, wider = 2 * len(text) + 2, set(text) | {" "}
            groups[-1][language] = text
            states, alphabet = more, wider
        return [self] if len(groups) == 1 else [Automata(g) for g in groups]

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "texts"}

    def encode(self, text: str) -> np.ndarray:
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        return self.codes[np.minimum(points, len(self.codes) - 1)]

    def pieces(self, texts: list[str]) -> np.ndarray:
        """Pieces of each text (normalised, not empty) in each language."""
        encoded = [self.encode(t) for t in texts]
        spans = [(i, a, min(a + STRETCH, len(e))) for i, e in enumerate(encoded) for a in range(0, len(e), STRETCH)]
        # Long stretches first, so that the lanes still running are a prefix.
        spans.sort(key=lambda s: s[1] - s[2])
        out = np.zeros((len(texts), len(self.languages)), dtype=np.int64)
        for at in range(0, len(spans), _LANES):
            part = spans[at : at + _LANES]
            lengths = np.array([b - a for _, a, b in part])
            block = np.zeros((lengths[0], len(part)), dtype=np.int32)
            for lane, (i, a, b) in enumerate(part):
                block[: b - a, lane] = encoded[i][a:b]
            counts = self._parse(block, lengths)
            np.add.at(out, [i for i, _, _ in part], counts.T)
        return out

    def _parse(self, block: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        # The table also sets the roots.
        table, width = self.next.ravel(), self.next.shape[1]
        roots = np.array(self.root, dtype=np.int32)[:, None]
        lanes = block.shape[1]
        state = np.broadcast_to(roots, (len(self.root), lanes)).copy()
        count = np.ones((len(self.root), lanes), dtype=np.int64)
        running = np.searchsorted(-lengths, -np.arange(len(block)), side="left")  # lanes with more than t characters
        from_root = self.next[np.array(self.root)]
        for t in range(len(block)):
            n = running[t]
            symbol, here = block[t, :n], state[:, :n]
            moved = table.take(here * width + symbol)
            ended = moved == 0
            # A piece ends before this character, unless nothing of it has been read.
            count[:, :n] += ended & (here != roots)
            again = np.where(ended, from_root[:, symbol], moved)
            unknown = again == 0
            # A character that no labelled text has is a piece on its own.
            count[:, :n] += unknown
            state[:, :n] = np.where(unknown, roots, again)
        # The last piece was counted from the start; it is empty if a text ended at a root.
        return count - (state == roots)

    def fewest(self, texts: list[str]) -> list[tuple[str | None, float, float]]:
        """(language, its pieces a character, those of the next language) of each text; ties go
        to the first by name.  Without a letter or a language the first is None."""
        clean = [normalise(t) for t in texts]
        some = [i for i, t in enumerate(clean) if t]
        out: list[tuple[str | None, float, float]] = [(None, np.inf, np.inf)] * len(texts)
        if some and self.languages:
            rates = self.pieces([clean[i] for i in some]) / np.array([[len(clean[i])] for i in some])
            for i, rate in zip(some, rates, strict=True):
                best = int(rate.argmin())
                out[i] = (self.languages[best], float(rate[best]), float(np.delete(rate, best).min(initial=np.inf)))
        return out


def _suffix_automaton(symbols: list[int], start: int) -> list[dict[int, int]]:
    """Transitions of the automaton of all substrings; states are numbered from `start`."""
    rows, link, length = [{}], [-1], [0]
    last = 0
    for s in symbols:
        now = len(rows)
        rows.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and s not in rows[p]:
            rows[p][s] = now
            p = link[p]
        if p >= 0:
            q = rows[p][s]
            if length[q] == length[p] + 1:
                link[now] = q
            else:
                twin = len(rows)
                rows.append(dict(rows[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and rows[p].get(s) == q:
                    rows[p][s] = twin
                    p = link[p]
                link[q] = link[now] = twin
        last = now
    return [{s: to + start for s, to in row.items()} for row in rows]


def fit(
    labelled: DataFrame,
    chars: int = FIT_CHARS,
    documents: int = FIT_DOCUMENTS,
) -> Automata:
    """Automata of every lang of labelled rows (doc_id, text, lang).

    Rows with a null lang or no text are not learned from.  Each language gives up to
    `documents` rows, in the order of a hash, until `chars` characters are reached; a text that
    would go beyond that is left out, unless there is no other, and then its beginning is used.
    The sample that reaches the driver is bounded by `chars` for each language.
    """
    known = labelled.filter(F.col("lang").isNotNull() & (F.length(F.trim("text")) > 0)).select(
        "lang", "text", F.xxhash64("doc_id", "text").alias("h"), F.length("text").alias("n")
    )
    # Ids first: a text is fetched only for rows that are used.
    order = Window.partitionBy("lang").orderBy(F.col("n") > chars, "h")
    chosen = known.select("lang", "h", "n").withColumn("r", F.row_number().over(order)).filter(F.col("r") <= documents)
    upto = F.sum("n").over(Window.partitionBy("lang").orderBy("r"))
    chosen = chosen.withColumn("upto", upto).filter((F.col("r") == 1) | (F.col("upto") <= chars))
    picked = known.join(stage(chosen.select("lang", "h"), "picked"), ["lang", "h"])
    rows = picked.select("lang", "h", F.substring("text", 1, chars).alias("text")).distinct().orderBy("lang", "h").collect()
    texts: dict[str, list[str]] = {}
    for row in rows:
        texts.setdefault(row["lang"], []).append(normalise(row["text"]))
    joined = {lang: " ".join(t for t in parts if t) for lang, parts in texts.items()}
    return Automata({lang: text for lang, text in joined.items() if text})


def identify(docs: DataFrame, automata: Automata, table: int = TABLE) -> DataFrame:
    """doc_id, lang_pred, score, pieces (a character) for each row; needs doc_id and text.

    A text that is null or has no letter is `und` with score 0.  A tie goes to the first
    language by name.  The score is the share of pieces that the language saves against the
    next one.  Each group of languages whose table has up to `table` entries is one pass over
    the texts.  An empty table gives an empty result.
    """
    ship(docs.sparkSession)
    none, far = F.lit(None).cast("string"), F.lit(float("inf"))
    parsed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", none.alias("lang"), far.alias("rate"), far.alias("next"))
    parts = automata.parts(table)
    before = staged_count(docs.sparkSession)
    for n, part in enumerate(parts, 1):
        parsed = _parsed(parsed, part, n < len(parts))
        if n < len(parts):
            parsed = stage(parsed, "parsed")
            # The pass before is not read again.
            release(docs.sparkSession, before, newest=1)
    unknown = F.col("lang").isNull()
    # How many more pieces the next language needs, in parts of what it needs.
    score = F.when(unknown, 0.0).when(F.col("next") == far, 1.0).otherwise(1 - F.col("rate") / F.col("next"))
    return parsed.select(
        "doc_id", F.coalesce("lang", F.lit(UNKNOWN)).alias("lang_pred"), score.alias("score"),
        F.when(unknown, 0.0).otherwise(F.col("rate")).alias("pieces"),
    )


def _parsed(docs: DataFrame, automata: Automata, more: bool) -> DataFrame:
    """The rows with the fewest pieces of these languages and those before; texts stay if `more`."""
    automata.next  # noqa: B018 (built once, here)
    # Bounded by the entries of one table.
    shared = docs.sparkSession.sparkContext.broadcast(automata)
    fields = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("rate", pa.float64()), ("next", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in slices(batches):
            texts = batch.column("text").to_pylist()
            rows = []
            old = zip(*(batch.column(c).to_pylist() for c in ("lang", "rate", "next")), strict=True)
            for (lang, rate, after), (new, least, second) in zip(old, model.fewest([t or "" for t in texts]), strict=True):
                # Languages come in the order of their names, so the earlier one wins a tie.
                if least < rate:
                    rows.append((new, least, min(rate, second)))
                else:
                    rows.append((lang, rate, min(after, least)))
            columns = list(zip(*rows, strict=True)) if rows else [[], [], []]
            text = batch.column("text").cast(pa.string()) if more else pa.nulls(batch.num_rows, pa.string())
            arrays = [batch.column("doc_id"), text, pa.array(columns[0], pa.string()), *(pa.array(c, pa.float64()) for c in columns[1:])]
            yield pa.RecordBatch.from_arrays(arrays, schema=fields)

    return docs.mapInArrow(run, _PARSED)


def op9_language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = load(spark, sf, "documents")
    apart = held_out("doc_id", 4, 2)
    automata = fit(docs.filter(~apart))
    return identify(docs, automata).select("doc_id", apart.alias("held_out"), "lang_pred", "score")

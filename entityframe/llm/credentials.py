"""Secret scan with linking of credentials that come in several parts.

Fixed patterns find assigned secrets, access identifiers and long hexadecimal strings; these
are reported wherever they stand.  A second set of patterns finds weak parts, such as a user
name, a key-like string or a host.  Alone these are ordinary text, so they are reported only
where the parts that make up a credential stand together: in one scope (text without a blank
line in it) and at most `reach` code points apart.

Parts are joined by intervals.  A scope is cut into cells a little wider than the reach; of each role a
cell keeps its first start and its last end only, which is all that a part in the same or a
neighbouring cell needs to know.  So a weak part meets a few rows, however many parts stand
around it.  Everything is keyed by a digest of the text: copies are linked once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from entityframe.llm.common import load, stage, text_or_empty

REACH = 200


def _any_case(word: str) -> str:
    """A pattern for the ASCII letters of `word` in either case, the same to every regex engine."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


def _words(*words: str) -> str:
    return "|".join(map(_any_case, words))


# The three patterns of the scan and the least lengths they ask for.
_ASSIGN = f"({_words('password', 'passwd', 'secret', 'token', 'api_?key')})[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
_ACCESS = "AKIA[A-Z0-9]{16,}"
_HEX = "[0-9a-f]{24,}"
_LEAST_VALUE = 6

_SET = "[\"']?\\x20*[:=]\\x20*[\"']?"
_LOGIN = f"(?:{_words('access[_-]?key[_-]?id', 'client[_-]?id', 'account[_-]?id', 'username', 'user', 'login')}){_SET}[A-Za-z0-9@._+-]{{3,}}"
_EMAIL = "[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]+\\.[A-Za-z0-9.-]*[A-Za-z0-9]"
_PASSPHRASE = f"(?:{_words('passphrase', 'passcode', 'pass', 'pwd', 'private[_-]?key', 'credential', 'auth')}){_SET}[^\\x00-\\x20\"'<>]{{6,}}"
_KEY = "[A-Za-z+/_-]{0,40}[0-9][A-Za-z0-9+/_-]{11,}={0,2}"
_URL = "(?:https?|ftps?|sftp|ssh|mysql|postgres|postgresql|mongodb|redis|amqp)://[^\\x00-\\x20\"'<>]+"
_HOST = f"(?:{_words('endpoint', 'hostname', 'host', 'server')}){_SET}[A-Za-z0-9.-]+(?::[0-9]{{1,5}})?"
_ADDRESS = "[0-9]{1,3}(?:\\.[0-9]{1,3}){3}(?::[0-9]{1,5})?"
_BREAK = "\\n[ \\t\\r]*\\n"

#: Kinds in the order in which spans at one place are listed; the first three are always reported.
KINDS = ("assign", "access", "hex", "identifier", "passphrase", "key", "endpoint")
_BASE = {"assign": _ASSIGN, "access": _ACCESS, "hex": _HEX}
_WEAK = {"endpoint": f"{_URL}|{_HOST}|{_ADDRESS}", "identifier": f"{_LOGIN}|{_EMAIL}", "passphrase": _PASSPHRASE, "key": _KEY}
# Alternatives and what each can begin with.
_FIRST = {
    _ASSIGN: "AaPpSsTt", _ACCESS: "A", _HEX: "0-9a-f", _URL: "afhmprs", _HOST: "EeHhSs", _ADDRESS: "0-9", _LOGIN: "AaCcLlUu",
    _EMAIL: "A-Za-z0-9._%+-", _PASSPHRASE: "AaCcPp", _KEY: "A-Za-z0-9+/_-",
}
#: What a part is to its neighbours.
ROLES = {
    "assign": "secret", "hex": "secret", "passphrase": "secret", "key": "secret",
    "access": "identifier", "identifier": "identifier", "endpoint": "endpoint",
}
#: Sets of roles in reach of which any one makes a weak part reportable.
NEEDS = {
    "identifier": ({"secret"},),
    "passphrase": ({"identifier"}, {"endpoint"}),
    "key": ({"identifier"},),
    "endpoint": ({"identifier", "secret"},),
}
_LEAST_KEY = 16

#: One pass over the text for each list of alternatives; in the last a weak part never starts
#: inside a reported one.
_PASSES = (*[(p,) for p in _BASE.values()], tuple(_FIRST))


def _plain(alternatives: tuple[str, ...]) -> str:
    return "|".join(f"(?:{p})" for p in alternatives)


def _quick(alternatives: tuple[str, ...]) -> str:
    """The same for the JVM, which tries alternatives one after the other at every letter: a look
    at the letter spares most of them, and a run that can't be cut short is not given back."""
    runs = [(p, p.replace("{1,64}@", "{1,64}+@").replace("{0,40}[", "{0,40}+[")) for p in alternatives]
    return "|".join(f"(?=[{_FIRST[p]}])(?:{quick})" for p, quick in runs)


def _whole(pattern: str) -> str:
    return f"\\A(?:{pattern})\\z"


def _weak_kind(match: Column) -> Column:
    """The kind of a match of the last pass: that of the first alternative, the order in which they are tried."""
    out = F.lit(None).cast("string")
    for kind, pattern in reversed(_WEAK.items()):
        out = F.when(match.rlike(_whole(pattern)), kind).otherwise(out)
    base = reduce(Column.__or__, [match.rlike(_whole(p)) for p in _BASE.values()])
    mixed = match.rlike("[A-Za-z]") & (F.length(match) >= _LEAST_KEY)
    return F.when(~base & ((out != "key") | mixed), out)


def _pieces(text: Column, number: int) -> Column:
    """The matches of one pass in order: how long the text from the last match to the end of
    this one is, how long the match is, blank lines before it, and its kind, null if dropped."""
    pattern = _quick(_PASSES[number])
    # A match starts where the last one ended: without \G a text's end would be searched from each of its places.
    found = F.regexp_extract_all(text, F.lit(f"(?s)\\G.*?(?:{pattern})"), F.lit(0))

    def piece(p: Column, i: Column) -> Column:
        match = F.regexp_extract(p, f"(?s)\\A.*?({pattern})\\z", 1)
        gap = F.substring(p, F.lit(1), F.length(p) - F.length(match))
        if number == 0:
            kind = F.when(F.length(F.regexp_extract(match, _whole(_ASSIGN), 2)) >= _LEAST_VALUE, "assign")
        elif number < len(_BASE):
            kind = F.lit(KINDS[number])
        else:
            kind = _weak_kind(match)
        return F.struct(
            F.lit(number).alias("number"),
            i.alias("i"),
            F.length(p).alias("length"),
            F.length(match).alias("own"),
            F.size(F.regexp_extract_all(gap, F.lit(_BREAK), F.lit(0))).alias("breaks"),
            kind.alias("kind"),
        )

    return F.transform(found, piece)


def find_parts(texts: DataFrame) -> DataFrame:
    """key, kind, start, end, scope: the parts of each text, from a frame of (key, found) with
    the pieces of its passes.  Rows of one key have the same pieces and count once."""
    once = texts.filter(F.size("found") > 0).groupBy("key").agg(F.first("found").alias("found"))
    pieces = once.select("key", F.explode("found").alias("p")).select("key", "p.*")
    before = Window.partitionBy("key", "number").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = pieces.withColumns({"end": F.sum("length").over(before), "scope": F.sum("breaks").over(before)})
    return placed.filter(F.col("kind").isNotNull()).select("key", "kind", (F.col("end") - F.col("own")).alias("start"), "end", "scope")


def _by_kind(name: str, values: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])[F.col(name)]


def link_parts(parts: DataFrame, reach: int = REACH) -> DataFrame:
    """The weak parts that stand within reach of what makes them a credential."""
    # A part begins at most reach + 1 code points behind the last one of its neighbour.
    cell = lambda place: F.call_function("div", place, F.lit(reach + 1).cast("bigint"))
    last = F.col("end") - 1
    held = parts.select("key", "scope", _by_kind("kind", ROLES).alias("role"), "start", "end", F.explode(F.sequence(cell(F.col("start")), cell(last))).alias("cell"))
    held = held.groupBy("key", "scope", "cell", "role").agg(F.min("start").alias("first"), F.max("end").alias("last"))
    weak = parts.filter(F.col("kind").isin(*NEEDS))
    asking = weak.withColumn("cell", F.explode(F.sequence(cell(F.col("start")) - 1, cell(last) + 1)))
    near = (F.col("last") + reach >= F.col("start")) & (F.col("first") <= F.col("end") + reach)
    met = asking.join(held, ["key", "scope", "cell"]).filter(near)
    roles = {role: F.max((F.col("role") == role).cast("int")) == 1 for role in sorted(set(ROLES.values()))}
    met = met.groupBy("key", "kind", "start", "end").agg(*[has.alias(role) for role, has in roles.items()])
    linked = F.lit(False)
    for kind, ways in NEEDS.items():
        enough = reduce(Column.__or__, [reduce(Column.__and__, [F.col(role) for role in sorted(way)]) for way in ways])
        linked = linked | ((F.col("kind") == kind) & enough)
    return met.filter(linked).select("key", "kind", "start", "end")


def _joined(spans: Column) -> Column:
    text = F.transform(spans, lambda s: F.concat_ws(":", F.element_at(F.array(*map(F.lit, KINDS)), s["rank"] + 1), s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(text, ",")


def scan_secrets(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_linked, base_spans, spans: what each row holds.

    Needs doc_id and text; other columns are ignored.  Null text is empty text, which holds
    nothing.  Places are code points from 0, ends exclusive.  Spans are arrays of (start, rank,
    end) in that order, rank being the place in KINDS; base_spans has the first three kinds.
    Rows with the same text have the same result, whatever their doc_id, also null; every row
    is returned.  Scopes, however long, are searched whole.  An empty table gives an empty
    result.
    """
    found = F.concat(*[_pieces(F.col("text"), n) for n in range(len(_PASSES))])
    read = docs.select("doc_id", text_or_empty("text").alias("text")).withColumn("found", found)
    key = F.when(F.size("found") > 0, F.sha2(F.col("text").cast("binary"), 256))
    rows = stage(read.select("doc_id", key.alias("key"), "found"), "pieces")
    parts = stage(find_parts(rows), "parts")
    always = parts.filter(F.col("kind").isin(*_BASE)).select("key", "kind", "start", "end")
    rank = _by_kind("kind", {kind: i for i, kind in enumerate(KINDS)})
    spans = always.unionByName(link_parts(parts, reach)).select("key", F.struct("start", rank.alias("rank"), "end").alias("span"))
    # The spans of one text, which is one row of the table.
    spans = stage(spans.groupBy("key").agg(F.sort_array(F.collect_list("span")).alias("spans")), "spans")
    none = F.array().cast(spans.schema["spans"].dataType)
    # Most rows hold nothing and need no join.
    some = rows.filter(F.col("key").isNotNull()).select("doc_id", "key").join(spans, "key", "left")
    some = some.select("doc_id", F.coalesce("spans", none).alias("spans"))
    rest = rows.filter(F.col("key").isNull()).select("doc_id", none.alias("spans"))
    count = lambda rank: F.size(F.filter("spans", lambda s: s["rank"] == rank)).cast("bigint")
    return some.unionByName(rest).select(
        "doc_id",
        *[count(i).alias(f"n_{kind}") for i, kind in enumerate(_BASE)],
        F.size(F.filter("spans", lambda s: s["rank"] >= len(_BASE))).cast("bigint").alias("n_linked"),
        F.filter("spans", lambda s: s["rank"] < len(_BASE)).alias("base_spans"),
        "spans",
    )


def op12_credential_links(spark, sf):
    found = scan_secrets(load(spark, sf, "documents"))
    digest = F.sha2(_joined(F.col("base_spans")).cast("binary"), 256)
    return found.select("doc_id", "n_assign", "n_access", "n_hex", digest.alias("base_sha256"), _joined(F.col("spans")).alias("spans"), "n_linked")


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _sql_kind() -> str:
    base = " OR ".join(f"regexp_matches(match, {_quoted(_whole(p))})" for p in _BASE.values())
    weak = " ".join(
        f"WHEN regexp_matches(match, {_quoted(_whole(p))}) THEN "
        + (f"CASE WHEN regexp_matches(match, '[A-Za-z]') AND length(match) >= {_LEAST_KEY} THEN 'key' END" if kind == "key" else f"'{kind}'")
        for kind, p in _WEAK.items()
    )
    return f"CASE WHEN {base} THEN NULL {weak} END"


def _sql_pass(number: int) -> str:
    pattern = _plain(_PASSES[number])
    kind = (
        f"CASE WHEN length(regexp_extract(match, {_quoted(_whole(_ASSIGN))}, 2)) >= {_LEAST_VALUE} THEN 'assign' END",
        "'access'", "'hex'", _sql_kind(),
    )[number]
    return f"""SELECT row, start, stop, scope, {kind} AS kind FROM (
    SELECT *, stop - length(match) AS start FROM (
      SELECT row, match, sum(length(p)) OVER w AS stop,
             sum(len(regexp_extract_all(left(p, length(p) - length(match)), {_quoted(_BREAK)}))) OVER w AS scope
      FROM (SELECT row, i, p, regexp_extract(p, {_quoted(f"(?s)\\A.*?({pattern})\\z")}, 1) AS match FROM (
        SELECT row, unnest(found) AS p, generate_subscripts(found, 1) AS i FROM (
          SELECT row, regexp_extract_all(text, {_quoted(f"(?s).*?(?:{pattern})")}) AS found FROM doc)))
      WINDOW w AS (PARTITION BY row ORDER BY i)))"""


def _sql_near(role: str) -> str:
    kinds = ", ".join(f"'{k}'" for k, r in ROLES.items() if r == role)
    return f"""EXISTS (SELECT 1 FROM part o WHERE o.row = p.row AND o.scope = p.scope AND o.kind IN ({kinds})
      AND o.stop + {REACH} >= p.start AND o.start <= p.stop + {REACH})"""


_SQL_ROLE = {role: _sql_near(role) for role in sorted(set(ROLES.values()))}
_SQL_LINKED = " OR ".join(
    f"kind = '{kind}' AND (" + " OR ".join(" AND ".join(f"near_{role}" for role in sorted(way)) for way in ways) + ")" for kind, ways in NEEDS.items()
)
_SQL_RANK = "CASE kind " + " ".join(f"WHEN '{k}' THEN {i}" for i, k in enumerate(KINDS)) + " END"
_SQL_JOINED = "coalesce(string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank){}, '')"

OP12_SQL = f"""
WITH doc AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents
), part AS (
  SELECT * FROM ({" UNION ALL ".join(_sql_pass(n) for n in range(len(_PASSES)))}) WHERE kind IS NOT NULL
), met AS (
  SELECT *, {", ".join(f"{sql} AS near_{role}" for role, sql in _SQL_ROLE.items())} FROM part p
), span AS (
  SELECT *, {_SQL_RANK} AS rank FROM met WHERE kind IN ('assign', 'access', 'hex') OR {_SQL_LINKED}
)
SELECT d.doc_id, {", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in _BASE)},
       sha256({_SQL_JOINED.format(" FILTER (rank < 3)")}) AS base_sha256, {_SQL_JOINED.format(" FILTER (rank IS NOT NULL)")} AS spans,
       count(*) FILTER (rank >= 3) AS n_linked
FROM doc d LEFT JOIN span s USING (row) GROUP BY d.row, d.doc_id
"""

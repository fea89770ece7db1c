import random
import tempfile
import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from entityframe.llm import merkle
from entityframe.llm.merkle import build, document_manifest, missing_nodes, prove, read_manifest
from entityframe.sources.staging import staged_count

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, tree int, block string, leaf string"


def digest(parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return digest("-" if x is None else f"{len(str(x).encode())}:{x}" for x in row)


def levels_of(digests):
    levels = [digests]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([digest(below[i : i + 8]) for i in range(0, len(below), 8)])
    return levels


def path(levels, at, claim):
    """The siblings of one leaf and the root that follows from its claimed digest."""
    beside = []
    for level in levels[:-1]:
        first = at // 8 * 8
        run = level[first : first + 8]
        beside += run[: at - first] + run[at - first + 1 :]
        run[at - first] = claim
        claim, at = digest(run), at // 8
    return beside, claim


def brute(rows):
    """What the query returns for each (doc_id, source, lang, n_chars, text), by following one leaf at a time."""
    by_lang = {}
    for row in rows:
        by_lang.setdefault(row[2], []).append(row)
    order = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = []
    for lang in order:
        own = sorted(by_lang[lang], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees.append((own, levels_of([leaf_of(r) for r in own])))
    top = levels_of([levels[-1][0] for _, levels in trees])
    out = []
    for tree, (own, levels) in enumerate(trees):
        for at, row in enumerate(own):
            i, text = row[0], row[4]
            claim = leaf_of(row)
            if i is not None and text is not None and zlib.crc32(str(i).encode()) % 3 == 0:
                claim = leaf_of((*row[:4], "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)))
            lower, subroot = path(levels, at, claim)
            upper, root = path(top, tree, subroot)
            out.append((i, leaf_of(row), levels[-1][0], top[-1][0], digest(lower + upper), root, root == top[-1][0]))
    return sorted(map(repr, out))


def rows_of(n, langs, seed=0):
    chance = random.Random(seed)
    words = ["Ab", "é", "Zß", "x", "ÀB", "\n", "😀Q"]
    return [
        (i, chance.choice(["s", None]), chance.choice(langs), chance.choice([i, None]), " ".join(chance.choices(words, k=chance.randrange(9))))
        for i in chance.sample(range(10 * n), n)
    ]


def run(spark, rows, query=None):
    docs = spark.createDataFrame([(*r, 1, "b", "l") for r in rows], SCHEMA)
    manifest = document_manifest(docs)
    got = prove(manifest, manifest.leaves.withColumn("claim", F.col("tampered")))
    names = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return sorted(repr(tuple(r[c] for c in names)) for r in got.collect())


def test_every_proof_as_followed_one_by_one(spark):
    rows = rows_of(1300, ["en", "en", "en", "de", "a", "Z"]) + rows_of(9, [None], 1)
    assert run(spark, rows) == brute(rows)


def test_odd_rows(spark):
    same = (5, "s", "en", 3, "Same")
    rows = [same] * 11 + [(None, None, None, None, None)] * 2 + [(None, "s", "en", 1, t) for t in ("A", "", None, "é" * 300_000)]
    rows += [(3, "s", "only", 0, "Alone"), (7, "s", "", 0, "X"), (8, "s", "￿", 0, "Y"), (9, "s", "\U0001f600", 0, "Z")]
    assert run(spark, rows) == brute(rows)


def test_one_row_and_none(spark):
    assert run(spark, [(1, "s", None, 0, "A")]) == brute([(1, "s", None, 0, "A")])
    assert run(spark, []) == []


def test_more_groups_than_a_block(spark):
    rows = rows_of(700, [f"l{i}" for i in range(600)])
    assert run(spark, rows) == brute(rows)


@pytest.mark.parametrize("size,known", [(1, [0]), (8, [3]), (9, [8]), (513, [0, 1, 512]), (5000, [7, 700, 4999]), (64, list(range(64)))])
def test_the_fetched_nodes_are_the_fewest(size, known):
    need = missing_nodes(known, size)
    assert len(need) == len(set(need))
    sizes = [size]
    while sizes[-1] > 1:
        sizes.append(-(-sizes[-1] // 8))
    derived = {(0, p) for p in known}
    for level in range(1, len(sizes)):
        derived |= {(level, p // 8) for of, p in list(derived) if of == level - 1}
    wanted = set()
    for p in known:
        for level in range(len(sizes) - 1):
            at = p // 8**level
            wanted |= {(level, q) for q in range(at // 8 * 8, min(at // 8 * 8 + 8, sizes[level])) if q != at}
    assert set(need) == wanted - derived


def test_some_rows_of_a_manifest_read_back(spark):
    rows = rows_of(900, ["en", "de"])
    manifest = document_manifest(spark.createDataFrame([(*r, 1, "b", "l") for r in rows], SCHEMA))
    place = tempfile.mkdtemp(prefix="manifest-")
    manifest.write(f"{place}/m")
    again = read_manifest(spark, f"{place}/m")
    assert again.root == manifest.root
    picked = [r[0] for r in rows[:40]]
    some = again.leaves.filter(F.col("doc_id").isin(picked)).withColumn("claim", F.col("leaf"))
    got = prove(again, some).select("doc_id", "proof_sha256", "verified").collect()
    want = {eval(r)[0]: eval(r)[4] for r in brute(rows)}
    assert len(got) == 40
    assert all(r["verified"] and r["proof_sha256"] == want[r["doc_id"]] for r in got)


def test_own_names_are_refused(spark):
    with pytest.raises(ValueError, match="tree"):
        build(spark.createDataFrame([(1, "a", "b", 2)], "doc_id long, lang string, leaf string, Tree int"), "lang", "doc_id")


def test_a_changed_node_is_noticed(spark):
    rows = rows_of(100, ["en", "de"])
    manifest = document_manifest(spark.createDataFrame([(*r, 1, "b", "l") for r in rows], SCHEMA))
    forged = F.when((F.col("level") == 1) & (F.col("pos") == 1), F.lit("0" * 64)).otherwise(F.col("digest"))
    bad = merkle.Manifest(manifest.leaves, manifest.trees, manifest.nodes.withColumn("digest", forged))
    some = bad.leaves.filter("pos = 0").withColumn("claim", F.col("leaf"))
    assert not any(r["verified"] for r in prove(bad, some).collect())


def test_rows_are_stored_no_more_often_than_needed(spark):
    rows = rows_of(100, ["en", "de"])
    before = staged_count(spark)
    document_manifest(spark.createDataFrame([(*r, 1, "b", "l") for r in rows], SCHEMA))
    # The leaves, sorted, with their places; the groups in order, numbered; one pass of nodes, the trees, the root.
    assert staged_count(spark) - before == 8

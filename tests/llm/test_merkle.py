"""Digests, proofs and verdicts against a plain tree in memory."""

import hashlib
import zlib

from pyspark.sql import functions as F

from shopgrain.llm import merkle
from shopgrain.llm.merkle import document_proofs, folded, manifest

DOCUMENTS = "doc_id long, source string, lang string, n_chars long, text string"
NAMES = ("doc_id", "source", "lang", "n_chars", "text")


def hashed(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return hashed(
        *("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row)
    )


def tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([hashed(*last[i : i + 3]) for i in range(0, len(last), 3)])
    return levels


def way(levels, i):
    steps = []
    for level in levels[:-1]:
        start = i // 3 * 3
        steps.append(("".join(level[start:i]), "".join(level[i + 1 : start + 3])))
        i //= 3
    return steps


def expected(rows):
    """Rows of (doc_id, source, lang, n_chars, text)."""
    sources = {}
    for row in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r))):
        sources.setdefault(row[1], []).append(row)
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([leaf_of(r) for r in sources[s]]) for s in order}
    top = tree([trees[s][-1][0] for s in order])
    out = []
    for nth, source in enumerate(order):
        levels = trees[source]
        for i, row in enumerate(sources[source]):
            steps = way(levels, i) + way(top, nth)
            text = row[4]
            if row[0] is not None and text and zlib.crc32(str(row[0]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            node = leaf_of((*row[:4], text))
            for left, right in steps:
                node = hashed(left, node, right)
            proof = hashed(*(left + right for left, right in steps))
            root = top[-1][0]
            out.append((row[0], levels[0][i], levels[-1][0], root, proof, node, node == root))
    return sorted(out, key=repr)


def found(df):
    columns = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    result = document_proofs(df, *NAMES)
    assert result.columns == columns
    return sorted((tuple(r) for r in result.collect()), key=repr)


def test_trees_of_many_sizes(spark):
    sizes = {f"s{n}": n for n in (1, 2, 3, 4, 9, 10, 27, 28, 82, 730)} | {"é": 5, "z": 1, "": 2}
    rows = []
    for source, n in sizes.items():
        for k in range(n):
            at = len(rows) * 7 % 1009 - 100
            rows.append((at, source, "en", None if k % 3 else k, f"line {k}\nand {source}\n"))
    rows += [(9, None, None, None, None), (3, None, "de", 4, "\n")]
    got = found(spark.createDataFrame(rows, DOCUMENTS).repartition(7))
    assert got == expected(rows)
    assert {r[6] for r in got} == {True, False}


def test_a_lone_leaf_is_the_root(spark):
    row = (5, "s", "en", 1, "x")
    got = found(spark.createDataFrame([row], DOCUMENTS))
    assert got == [(5, *[leaf_of(row)] * 3, hashed(), leaf_of(row), True)]


def test_nulls_repeats_long_texts_and_clashing_columns(spark):
    rows = [
        (None, "a", "en", 3, "no id\n"),
        (None, "a", "en", 3, "no id\n"),
        (None, None, None, None, None),
        (-4, "a", None, None, ""),
        (7, "a", "en", 1, "twice\n"),
        (7, "a", "en", 1, "twice\n"),
        (7, "a", "en", 1, "another text of the same id\n"),
        (8, "b", "", 10**12, "é\n" * 400_000),
        (0, "b", "-", 0, "-"),
    ]
    given = spark.createDataFrame(rows, DOCUMENTS)
    for name in ("tree", "pos", "digest", "path", "id", "size", "tie", "block", "members"):
        given = given.withColumn(name, F.lit("clash"))
    assert found(given) == expected(rows)


def test_one_source_repeated_many_times_is_spread(spark):
    rows = [(k % 5, "hot", "en", 1, "the same") for k in range(3000)]
    assert found(spark.createDataFrame(rows, DOCUMENTS).repartition(8)) == expected(rows)


def test_empty_table(spark):
    assert found(spark.createDataFrame([], DOCUMENTS)) == []


def test_few_levels_are_stored(spark, monkeypatch):
    written = []
    real = merkle.saved

    def saved(df, name):
        written.append(name)
        return real(df, name)

    monkeypatch.setattr(merkle, "saved", saved)
    leaves = spark.range(1000).select(
        F.lit("t").alias("tree"), "id", F.sha2(F.col("id").cast("string"), 256).alias("digest")
    )
    proven = manifest(leaves, ["id"], ("id",))
    # Seven levels above the leaves, written at every third; the tree of trees has one.
    assert written.count("tier") == 3 + 1
    away = proven.where(folded(F.col("digest")) != F.col("root"))
    assert proven.count() == 1000 and away.isEmpty()


def test_a_changed_sibling_is_caught(spark):
    leaves = spark.range(100).select(
        F.lit("t").alias("tree"), "id", F.sha2(F.col("id").cast("string"), 256).alias("digest")
    )
    proven = manifest(leaves, ["id"], ("id",))
    other = F.sha2(F.concat("digest", F.lit("!")), 256)
    assert proven.where(folded(other) == F.col("root")).isEmpty()

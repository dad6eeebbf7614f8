"""The Merkle manifest against a plain recursive one."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from ingotflow.llm import manifest

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, path string, n int, part string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    values = dict(zip(("doc_id", "text", "lang", "source", "n_chars"), row))
    return h(*("-" if values[c] is None else f"{len(str(values[c]).encode())}:{values[c]}" for c in COLUMNS))


def tree(leaves):
    """The root, and each leaf's list of (left, right) siblings."""
    paths, nodes, members = [[] for _ in leaves], list(leaves), [[i] for i in range(len(leaves))]
    while len(nodes) > 1:
        runs = [range(at, min(at + 8, len(nodes))) for at in range(0, len(nodes), 8)]
        for run in runs:
            for at in run:
                pair = ("".join(nodes[run.start:at]), "".join(nodes[at + 1:run.stop]))
                for leaf in members[at]:
                    paths[leaf].append(pair)
        nodes = [h(*(nodes[i] for i in run)) for run in runs]
        members = [[leaf for i in run for leaf in members[i]] for run in runs]
    return nodes[0], paths


def brute_force(rows):
    """``(doc_id, leaf, subroot, root, siblings)`` of every row."""
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for group in order:
        leaves = sorted(((r[0] is not None, r[0] or 0, leaf_of(r)) for r in groups[group]))
        trees[group] = ([(i if held else None, x) for held, i, x in leaves], *tree([x for *_, x in leaves]))
    root, tops = tree([trees[g][1] for g in order])
    return sorted(((i, x, trees[g][1], root, [*path, *top]) for g, top in zip(order, tops)
                   for (i, x), path in zip(trees[g][0], trees[g][2])), key=str)


def result(df):
    return sorted(((r.doc_id, r.leaf, r.subroot, r.root, [tuple(p) for p in r.path])
                   for r in manifest.build(df, COLUMNS).collect()), key=str)


def rows_of(sizes, seed=1):
    rnd = random.Random(seed)
    rows = []
    for lang, size in sizes.items():
        rows += [(rnd.randrange(10 ** 9), rnd.choice(["", "Ä b", "x" * rnd.randrange(40)]), lang,
                  rnd.choice(["s", None]), rnd.choice([0, None, 7]), "clash", 1, "clash") for _ in range(size)]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("sizes", [
    {"a": 1}, {"a": 9}, {"a": 513, "b": 64, "c": 65, "d": 1, "ü": 8, None: 7, "": 2}, {f"l{i}": 1 for i in range(70)}])
def test_equals_brute_force(spark, sizes):
    rows = rows_of(sizes)
    assert result(spark.createDataFrame(rows, SCHEMA)) == brute_force(rows)


def test_deep_group(spark):
    rows = rows_of({"a": 4700, "b": 3}, 3)
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    assert result(df) == brute_force(rows)


def test_ties_nulls_and_repeats(spark):
    rows = rows_of({"a": 40}, 2)
    rows += [(None, t, "a", None, None, "c", 1, "c") for t in ("x", "y", None, "x", "")] + rows[:9] + rows[:3]
    df = spark.createDataFrame(rows, SCHEMA)
    assert result(df) == result(df.repartition(5)) == brute_force(rows)


def test_empty_table(spark):
    assert manifest.build(spark.createDataFrame([], SCHEMA), COLUMNS).collect() == []


def test_folding_shows_tampering(spark):
    rows = rows_of({"a": 600, "b": 20}, 5)
    df = spark.createDataFrame(rows, SCHEMA)
    built = manifest.build(df, COLUMNS, extra={"other": manifest.leaf([F.col("text")]), "text": F.col("text")})
    folded = built.select("root", manifest.folded(F.col("path"), F.col("leaf")).alias("same"),
                          manifest.folded(F.col("path"), F.col("other")).alias("changed"),
                          manifest.siblings(F.col("path")).alias("siblings"), "path").collect()
    assert len(folded) == 620
    assert all(r.same == r.root != r.changed for r in folded)
    assert all(r.siblings == "".join(a + b for a, b in r.path) for r in folded)

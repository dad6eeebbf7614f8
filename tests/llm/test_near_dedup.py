"""Near duplicates and components against brute force."""

import random
import re

import numpy as np
import pytest

from ingotflow.llm import near_dedup
from ingotflow.llm.components import connected_components


def reach(nodes, links):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {n: root(n) for n in nodes}


def words_of(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lowered)


def set_of(text, size):
    words = words_of(text)
    size = min(size, len(words)) or 1
    return {tuple(words[i:i + size]) for i in range(len(words) - size + 1)}


def brute_force(rows, size):
    sets = [(i, set_of(t, size)) for i, t in rows]
    links = [(i, j) for n, (i, s) in enumerate(sets) for j, t in sets[:n]
             if s and t and 100 * len(s & t) >= 80 * len(s | t)]
    component = reach([i for i, _ in rows], links)
    return sorted((i, len(s), component[i], component[i] == i) for i, s in sets)


def edited(rnd, words, share):
    return [w if rnd.random() > share else f"x{rnd.randrange(10**6)}" for w in words]


def corpus(seed):
    """Base texts with copies from exact to distant, a shared passage, a frequent word pair."""
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = rnd.choices(vocabulary, k=60)
    texts = []
    for b in range(12):
        base = rnd.choices(vocabulary, k=rnd.randint(3, 200))
        texts += [" ".join(base)] * (1 + b % 3)
        texts += [" ".join(edited(rnd, base, rnd.choice([.01, .03, .05, .08, .1]))) for _ in range(b)]
        texts += [" ".join(passage + rnd.choices(vocabulary, k=rnd.randint(5, 90)))]
    return texts + ["", "one", "ONE", "one", " \n\t", "A b", "a\x0bB", "of the", "É b", "é b", "a b c " * 4000]


@pytest.mark.parametrize("size,seed", [(2, 1), (2, 2), (5, 3)])
def test_equals_brute_force(spark, size, seed):
    rows = [(3 * i + 1, t) for i, t in enumerate(corpus(seed))] + [(5000, None)]
    df = spark.createDataFrame([(i, t, "k", 1) for i, t in rows],
                               "doc_id long, text string, key string, id int")
    assert sorted(map(tuple, near_dedup.near_duplicates(df, size).collect())) == brute_force(rows, size)


@pytest.mark.parametrize("few", [1, 1000])
def test_long_lists(spark, monkeypatch, few):
    """Every list is long: stars and open pairs, of whole or of split lists, must find all links."""
    monkeypatch.setattr(near_dedup, "SHORT", 1)
    monkeypatch.setattr(near_dedup, "FEW", few)
    rnd = random.Random(5)
    base = [f"w{rnd.randrange(3000)}" for _ in range(250)]
    texts = [" ".join(edited(rnd, base, share)) for share in [.0, .02, .03, .05, .06, .07, .09] * 9]
    rows = list(enumerate(texts + corpus(7)[:40]))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, near_dedup.near_duplicates(df, 2).collect())) == brute_force(rows, 2)


def test_repeated_and_null_ids(spark):
    same = " ".join(f"w{i}" for i in range(40))
    rows = [(7, same), (7, "other words here"), (9, same), (3, "Other words here"), (None, same), (4, "z z z")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = [tuple(r) for r in near_dedup.near_duplicates(df, 2).collect()]
    assert sorted(o for o in out if o[0] is not None) == [
        (3, 2, 3, True), (4, 1, 4, True), (7, 2, 3, False), (7, 39, 3, False), (9, 39, 3, False)]
    assert [o for o in out if o[0] is None][0][3] is False


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert near_dedup.near_duplicates(df, 2).count() == 0


def test_word_hashes_across_pieces(monkeypatch):
    text = ("word " * 300 + "long" * 200 + " tail of it\n" * 20).encode()
    whole = near_dedup.word_hashes(text)
    monkeypatch.setattr(near_dedup, "_PIECE", 97)
    assert np.array_equal(near_dedup.word_hashes(text), whole)


def test_coordinates_agree_as_often_as_they_should():
    rnd = np.random.default_rng(1)
    shares = []
    for _ in range(200):
        x = rnd.integers(0, 1 << 63, 440, dtype=np.uint64)
        shares.append((near_dedup.signature(x[:400]) == near_dedup.signature(x[40:])).mean())
    assert abs(np.mean(shares) - (360 / 440) ** near_dedup.MINIMA) < 0.02


@pytest.mark.parametrize("seed", range(3))
def test_components_of_random_graphs(spark, seed):
    rnd = random.Random(seed)
    links = [(rnd.randrange(120), rnd.randrange(120)) for _ in range(60)]
    links += [(200 + i, 201 + i) for i in range(40)] + [(400, x) for x in range(300, 380)]
    nodes = {n for a, b in links if a != b for n in (a, b)}
    df = spark.createDataFrame(links, "a long, b long")
    assert dict(map(tuple, connected_components(df).collect())) == reach(nodes, links)

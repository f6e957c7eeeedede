import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from propensity.llm import common, components, ngram_join as join
from tests.llm.fixtures import components as plain, frame, sentence, texts

ORDER = lambda r: (r[0] is None, r[0] or 0, r[1], r[2] or 0)


def varied() -> list[tuple[int, str]]:
    """Copies of some texts at all distances around the threshold, sharing a passage."""
    draw, rows, passage = random.Random(5), [], sentence(99, 30)
    for family in range(6):
        words = sentence(100 + family, 80).split()
        for _ in range(8):
            copy = list(words)
            for _ in range(draw.randint(0, 6)):
                copy[draw.randrange(len(copy))] = f"edit{draw.randrange(40)}"
            rows.append((len(rows), " ".join(copy) + (" " + passage if family % 2 else "")))
    return rows


@pytest.mark.parametrize("rows, hot, tile", [(texts(), 64, 2048), (varied(), 64, 2048), (varied(), 3, 4)])
def test_components_equal_all_pairs(spark, monkeypatch, rows, hot, tile):
    monkeypatch.setattr(join, "HOT", hot)
    monkeypatch.setattr(join, "TILE", tile)
    monkeypatch.setattr(join, "STAR_ROUNDS", 1)
    got = [tuple(r) for r in join.linked_components(frame(spark, rows)).collect()]
    assert sorted(got, key=ORDER) == sorted(plain(rows), key=ORDER)


def test_empty_table(spark):
    assert join.linked_components(frame(spark, [])).collect() == []


def test_bitmaps_bound_the_difference():
    draw = np.random.default_rng(1)
    for n, m in ((3, 4), (200, 230), (900, 1300)):
        x = np.unique(draw.integers(0, 2**63, n, np.uint64))
        y = np.unique(np.concatenate([x[: n // 2], draw.integers(0, 2**63, m, np.uint64)]))
        a, b = join.bitmap(x), join.bitmap(y)
        width = min(len(a), len(b))
        differing = int(np.bitwise_count(join.folded(a, width) ^ join.folded(b, width)).sum())
        assert differing <= len(np.setxor1d(x, y))


def test_tiles_keep_every_pair_that_links():
    draw, rows, sets = np.random.default_rng(2), [], {}
    shared = np.unique(draw.integers(0, 2**63, 300, np.uint64))
    for node in range(40):
        keep = shared[draw.random(300) > draw.random() * 0.3]
        sets[node] = np.unique(np.concatenate([keep, draw.integers(0, 2**63, draw.integers(0, 60), np.uint64)]))
    for node, x in sorted(sets.items(), key=lambda s: len(s[1])):
        rows.append((1, 0, 0, len(x), node, node, 0, 0, join.bitmap(x)))
    linked = {(max(a, b), min(a, b)) for a in sets for b in sets if a != b and 7 * len(np.intersect1d(sets[a], sets[b])) >= 3 * (len(sets[a]) + len(sets[b]))}
    assert linked and linked <= join.tile_pairs(rows, 75)
    few = rows[:10]
    nodes = {r[4] for r in few}
    assert {p for p in linked if set(p) <= nodes} <= join.tile_pairs(few, 75)


def test_components_of_a_chain(spark):
    links = spark.range(40).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")).union(spark.sql("SELECT 90L, 90L"))
    assert {tuple(r) for r in components.components(links).collect()} == {(i, 0) for i in range(41)}


def test_hashed_words_are_the_words(monkeypatch):
    monkeypatch.setattr(common, "PIECE", 40)
    draw = random.Random(3)
    alphabet = [b"a", b"B", b"b", b" ", b"\t", b"\x0b", "é".encode(), " ".encode(), b"\x1f", b"x" * 70, b"x" * 71, b"y" * 300000]
    names: dict[int, bytes] = {}
    for size in (0, 1, 5, 60, 200, 200):
        raw = b"".join(draw.choice(alphabet) for _ in range(size))
        hashes, starts = common.hashed_words(raw)
        tokens = common.words(raw)
        assert len(hashes) == len(starts) == len(tokens)
        for value, start, token in zip(hashes.tolist(), starts.tolist(), tokens):
            assert raw[start : start + len(token)].lower() == token
            assert names.setdefault(value, token) == token
    assert len(set(names.values())) == len(names)


def test_sets_of_texts_hashed_together_are_those_of_each(monkeypatch):
    monkeypatch.setattr(common, "PIECE", 300)
    every = [t.encode() if t is not None else None for _, t in texts()]
    alone = [join.shingles(t, 5) for t in every]
    for got, expected, text in zip(join.shingle_sets(every, 5), alone, every, strict=True):
        words = common.words(text)
        grams = {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or {tuple(words)} - {()}
        assert got.tolist() == expected.tolist() == sorted(set(got.tolist())) and len(got) == len(grams)

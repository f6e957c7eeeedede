"""Small documents with every odd case, and plain versions to compare with."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node long, h string, place string"


def sentence(seed: int, words: int = 60) -> str:
    draw = random.Random(seed)
    return " ".join("".join(draw.choice("abcdefgh") for _ in range(draw.randint(2, 6))) for _ in range(words))


def texts() -> list[tuple[int | None, str | None]]:
    base = sentence(1)
    near = base.split()
    near[10] = "changed"
    far = base.split()
    far[::3] = ["other"] * len(far[::3])
    return [
        (1, base), (2, base), (3, " ".join(near)), (4, " ".join(far)), (5, None), (6, ""), (7, " \n\t "),
        (8, "two words"), (9, "TWO  words"), (10, sentence(2, 3000)), (11, sentence(3)), (11, sentence(3)),
        (None, sentence(4)), (None, None), (12, "ééé ñ 漢字 \U0001f600 a\n\nb"), (13, "123 456"), (14, "x" * 5000),
        (15, sentence(5, 400) + "\n" + base),
    ]


def frame(spark, rows=None):
    rows = texts() if rows is None else rows
    full = [(i, t, "en" if (i or 0) % 2 else None, None if i == 3 else f"s{(i or 0) % 3}", len(t or ""), 0, "h", "p") for i, t in rows]
    return spark.createDataFrame(full, SCHEMA)


def components(rows, size=5, percent=75):
    """Smallest id that each text reaches, by comparing all pairs."""
    sets = []
    for _, text in rows:
        words = (text or "").encode().lower().split()
        grams = {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}
        sets.append(grams or ({tuple(words)} if words else set()))
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    ids = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            ids[find(i)] = min(key, ids.get(find(i), key))
    return [(key, len(sets[i]), ids.get(find(i)) if sets[i] else key) for i, (key, _) in enumerate(rows)]

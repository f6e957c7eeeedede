"""Exact Jaccard join of documents on word n-grams: size-banded tiles, bitmap bounds, sorted arrays.

A document is the set of its distinct word n-grams, kept as 64-bit hashes; equal sets are one node (the
hash of the set). Two nodes link when the sizes of intersection and union are at least ``percent`` : 100.

1. ``_counts``: how often each hash of a fixed part of the hash space occurs. Hashes of more than ``HOT``
   sets go into a bit array. All sets are ordered alike: hashes seen to be rare first, hot ones last.
2. ``_scanned``, ``_prefixes``: two linked sets of n hashes share at least k of their first n - ceil(n percent / 100) + k hashes in any
   common order, so only these are shuffled, with k growing with n (``overlap``). With the rare first, a passage that many
   documents share brings no documents together, unless most of their text is shared.
3. A set with fewer than k hashes that any other set has links with nothing (``_shared``). Most sets end here.
4. Documents that share such a hash are compared with one of them, the hub (``_stars``), and so copies
   of a text fall into one component in linear work. This repeats with other hubs.
5. What still shares a hash across components is compared in full (``_tiled``; first only the most alike pair of each two
   components in a tile, which joins most of what is left): tiles of bounded size, bands
   of sizes within them, the places of the hash in both sets (what comes before the first common hash is not
   shared), and a bound from the number of differing bits of hashed bitmaps.
6. Pairs left by the bound are decided by intersecting the sorted hash arrays (``_linked``), which are made
   anew from the texts of these few documents.

No step caps a group. The order and the filters decide only how much work there is, never which links exist.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from propensity.llm import common
from propensity.llm.components import components
from propensity.session import discard, materialize, scratch

#: A hash of more sets than this is hot: it comes last in the common order.
HOT = 64
#: Share of the hash space in which occurrences are counted; it holds the prefix and the hot hashes it skips.
COUNTED = 0.4
#: One more hash must be shared for so many hashes of a set, and the prefix is as much longer.
STEP = 16
#: Rows of a hash's documents that one tile compares.
TILE = 2048
#: Tiles of so few rows are compared one by one.
SMALL_TILE = 12
#: Rows of a hash up to which its tile gets folded bitmaps: their weaker bound lets through some more of so few pairs.
FOLDED_ROWS = 64
STAR_ROUNDS = 2
#: Hubs that a node is compared with in a round.
HUBS = 3
#: Hashes collected by a task before it passes on its counts.
COUNT_ROWS = 1 << 21


def shingle_sets(texts: list[bytes | None], size: int) -> Iterator[np.ndarray]:
    """Of each text, its sorted distinct n-gram hashes; fewer words are one n-gram of their own; no word, no n-gram.

    Short texts are hashed together, up to a piece of bytes.
    """
    held, length = [], 0
    for text in texts:
        text = text or b""
        if held and length + len(text) > common.PIECE:
            yield from _sets(held, size)
            held, length = [], 0
        held.append(text)
        length += len(text) + 1
    if held:
        yield from _sets(held, size)


def _sets(texts: list[bytes], size: int) -> Iterator[np.ndarray]:
    tokens, starts = common.hashed_words(b" ".join(texts))
    offsets = np.cumsum([0, *(len(t) + 1 for t in texts)])
    bounds = np.searchsorted(starts, offsets).tolist()
    grams = common.gram_hashes(tokens, size)
    for start, end in zip(bounds, bounds[1:]):
        if end - start >= size:
            found = np.sort(grams[start : end - size + 1])
            new = np.ones(len(found), bool)
            np.not_equal(found[1:], found[:-1], out=new[1:])
            yield found[new]
        elif end > start:
            yield np.array([xxhash.xxh3_64_intdigest(tokens[start:end].tobytes(), seed=end - start)], np.uint64)
        else:
            yield np.empty(0, np.uint64)


def shingles(text: bytes | None, size: int) -> np.ndarray:
    """The set of one text."""
    return next(shingle_sets([text], size))


def node_of(hashes: np.ndarray) -> int:
    """The set's own 64-bit hash, as a signed long."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(hashes.tobytes())).astype(np.int64))


def prefix(hashes: np.ndarray, hot: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The first hashes in the common order, as many as two linked sets can't both miss; which are hot."""
    n = len(hashes)
    counted = int(np.searchsorted(hashes, np.uint64(int(COUNTED * 2**64))))
    is_hot = np.zeros(n, bool)
    is_hot[:counted] = common.maybe_in(hot, _bucket(hashes[:counted]))
    rest = np.arange(counted, n)
    first = np.concatenate([np.flatnonzero(~is_hot[:counted]), rest, np.flatnonzero(is_hot)])
    first = first[: n - -(-n * percent // 100) + overlap(n)]
    return hashes[first], is_hot[first]


def overlap(n: int) -> int:
    """Hashes that the prefixes of two linked sets share, if the smaller has n."""
    return 1 + n // STEP


def bitmap(hashes: np.ndarray) -> bytes:
    """The parity of the number of hashes in each of 2^k cells, at least four cells a hash (up to 65,536).

    Half as many cells are the exclusive or of both halves. Each cell in which two sets differ holds a
    hash that only one of them has.
    """
    cells = min(max(1024, 4 << (len(hashes) - 1).bit_length()), 65536)
    places = ((hashes >> np.uint64(20)) & np.uint64(cells - 1)).astype(np.int64)
    return np.packbits(np.bincount(places, minlength=cells) & 1, bitorder="little").tobytes()


def folded(bits: bytes, size: int) -> np.ndarray:
    """A bitmap as longs, folded to ``size`` bytes."""
    out = np.frombuffer(bits, np.uint64)
    while out.nbytes > size:
        out = out[: len(out) // 2] ^ out[len(out) // 2 :]
    return out


def sketch(hashes: np.ndarray) -> tuple[bytes, bytes]:
    """The bitmap, and the same folded to about a cell a hash, a quarter of the bytes: enough to tell most unlike sets apart."""
    bits = bitmap(hashes)
    return bits, folded(bits, max(32, len(bits) // 4)).tobytes()


def may_link(n: int, m: int, differing: int, percent: int) -> bool:
    """Whether sets of n and m hashes that differ in at least so many can link."""
    both = (n + m - differing) / 2
    return 100 * both >= percent * (n + m - both) and 100 * min(n, m) >= percent * max(n, m)


def _bucket(hashes: np.ndarray) -> np.ndarray:
    """What occurrences are counted by: half of a hash, as half as many bytes are shuffled. Collisions only make hashes hot."""
    return hashes & np.uint64(0xFFFFFFFF)


def _counts(docs: DataFrame, size: int) -> DataFrame:
    top = np.uint64(int(COUNTED * 2**64))

    def tell(held: list[np.ndarray]) -> pa.RecordBatch:
        values, n = np.unique(_bucket(np.concatenate(held)), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(common.signed(values)), pa.array(n)], ["h", "n"])

    def count(batches: Iterator) -> Iterator:
        seen, held, rows = set(), [], 0
        for batch in batches:
            for hashes in shingle_sets(batch.column(0).cast(pa.binary()).to_pylist(), size):
                if len(hashes) and (node := node_of(hashes)) not in seen:
                    seen.add(node)
                    held.append(hashes[: np.searchsorted(hashes, top)])
                    rows += len(held[-1])
            if rows > COUNT_ROWS:
                yield tell(held)
                held, rows = [], 0
        if held:
            yield tell(held)

    return common.in_batches(docs.select("text"), count, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))


def _scanned(docs: DataFrame, size: int, percent: int, hot) -> DataFrame:
    """(doc_id, node, n, first, cold) of each document; once a task and node, ``first`` is the prefix, whose hashes from ``cold`` on are hot.

    48 bits of a hash are enough to find who shares it.
    """

    def emit(batches: Iterator) -> Iterator:
        seen = set()
        for batch in batches:
            nodes, sizes, firsts, colds = [], [], [], []
            for hashes in shingle_sets(batch.column(1).cast(pa.binary()).to_pylist(), size):
                node = node_of(hashes) if len(hashes) else None
                first, cold = np.empty(0, np.uint64), 0
                if node is not None and node not in seen:
                    seen.add(node)
                    first, is_hot = prefix(hashes, hot.value, percent)
                    cold = len(first) - int(is_hot.sum())
                nodes.append(node)
                sizes.append(len(hashes))
                firsts.append(first >> np.uint64(16))
                colds.append(cold)
            offsets = np.cumsum([0, *map(len, firsts)]).astype(np.int32)
            values = common.signed(np.concatenate([np.empty(0, np.uint64), *firsts]))
            columns = [batch.column(0), pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64())]
            columns += [pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)), pa.array(colds, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "node", "n", "first", "cold"])

    key = docs.schema["doc_id"].dataType.simpleString()
    return common.in_batches(docs.select("doc_id", "text"), emit, f"doc_id {key}, node long, n long, first array<long>, cold int")


def _prefixes(scanned: DataFrame) -> DataFrame:
    """(h, node, n, at) of each prefix hash that another set may have; ``at`` hashes of the set come before it."""
    found = scanned.select("node", F.col("n").cast("int").alias("n"), "cold", F.posexplode("first").alias("at", "h"))
    found = found.select("h", "node", "n", "at", F.expr("if(at >= cold, int(1 + (node & 15)), 0)").alias("spread"))
    # the documents of a hot hash are spread over tasks, which don't see all of them; copies in other tasks repeat a row
    other = "spread > 0 or min(node) over (partition by h, spread) <> max(node) over (partition by h, spread)"
    found = found.withColumn("other", F.expr(other)).where("other")
    return found.dropDuplicates(["h", "spread", "node"]).select("h", "node", "n", "at")


def _shared(prefixes: DataFrame, percent: int) -> DataFrame:
    """Of ``_prefixes``, the sets that share enough hashes to link with any."""
    least = F.floor(F.ceil(F.col("n") * percent / 100) / STEP) + 1
    enough = prefixes.groupBy("node").agg(F.count("*").alias("hashes"), F.first("n").alias("n")).where(F.col("hashes") >= least)
    return prefixes.join(enough.select("node"), "node", "left_semi")


def _remade(docs: DataFrame, size: int, ids: DataFrame, nodes: DataFrame, names: list[str], make) -> DataFrame:
    """(doc_id, node, n, ``names``) of the given nodes, which ``make`` gives as a tuple, made from the texts of the documents ``ids`` that stand for them."""
    wanted = docs.sparkSession.sparkContext.broadcast(common.filter_bits(ids.select(F.xxhash64("doc_id").alias("h")), "h"))
    key = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator) -> Iterator:
        seen = set()
        for batch in batches:
            mine = pa.array(common.maybe_in(wanted.value, batch.column(2).to_numpy().view(np.uint64)))
            kept = batch.filter(mine)
            found, rows, made = [], [], []
            for row, hashes in enumerate(shingle_sets(kept.column(1).cast(pa.binary()).to_pylist(), size)):
                if len(hashes) and (node := node_of(hashes)) not in seen:
                    seen.add(node)
                    found.append((node, len(hashes)))
                    rows.append(row)
                    made.append(make(hashes))
            told = np.array(found, np.int64).reshape(-1, 2)
            columns = [kept.column(0).take(pa.array(rows, pa.int64())), pa.array(told[:, 0]), pa.array(told[:, 1])]
            columns += [pa.array([values[i] for values in made], pa.binary()) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "node", "n", *names])

    schema = ", ".join([f"doc_id {key}, node long, n long", *(f"{name} binary" for name in names)])
    told = common.in_batches(docs.select("doc_id", "text", F.xxhash64("doc_id").alias("h")), run, schema)
    return told.join(nodes, "node", "left_semi").dropDuplicates(["node"])


def _linked(pairs: DataFrame, sets: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Of distinct pairs (a, b), those that link: bitmaps first, then the sorted arrays of what is left."""

    def bounded(batches: Iterator) -> Iterator:
        for batch in batches:
            a, b, n, m, x, y = (batch.column(i).to_pylist() for i in range(6))
            keep = []
            for i in range(len(a)):
                least = min(len(x[i]), len(y[i]))
                differing = int(np.bitwise_count(folded(x[i], least) ^ folded(y[i], least)).sum())
                keep.append(may_link(n[i], m[i], differing, percent))
            yield pa.RecordBatch.from_arrays(batch.columns[:2], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    def exact(batches: Iterator) -> Iterator:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays(batch.columns[:2], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    def beside(pairs: DataFrame, of: DataFrame, *columns: str) -> DataFrame:
        for end in "ab":
            pairs = pairs.join(of.select(F.col("node").alias(end), *(F.col(c).alias(f"{c}_{end}") for c in columns)), end)
        return pairs.select("a", "b", *(f"{c}_{end}" for c in columns for end in "ab"))

    left = materialize(common.in_batches(beside(pairs, sets, "n", "bits"), bounded, "a long, b long"), "pairs")
    nodes = left.select(F.col("a").alias("node")).union(left.select("b")).distinct()
    if nodes.isEmpty():
        return left
    ids = sets.join(nodes, "node", "left_semi")
    arrays = materialize(_remade(docs, size, ids, nodes, ["hashes"], lambda hashes: (hashes.tobytes(),)), "arrays")
    return common.in_batches(beside(left, arrays, "hashes"), exact, "a long, b long")


def _stars(shared: DataFrame, salt: int, percent: int) -> DataFrame:
    """For each node, the HUBS hubs that most of its hashes propose: a document of the hash in another component.

    At first a hash proposes the set with the fewest hashes before it: copies of a text have hashes of their own, which are
    rare and come first, and the text itself has not. Later it proposes any.
    """
    order = F.xxhash64("node", F.lit(salt)).cast("double") if salt else F.col("at") / F.col("n")
    hubs = shared.groupBy("h").agg(F.min(F.struct(order.alias("o"), "node", "n", "root")).alias("hub"))
    pairs = (
        shared.join(hubs, "h")
        .where("root != hub.root")
        .where(f"100 * least(n, hub.n) >= {percent} * greatest(n, hub.n)")
        .groupBy("node", F.col("hub.node").alias("hub"))
        .agg(F.count("*").alias("times"))
    )
    # a node has no more hubs than prefix hashes
    most = F.slice(F.sort_array(F.collect_list(F.struct("times", "hub")), asc=False), 1, HUBS)
    best = pairs.groupBy("node").agg(most.alias("most")).select("node", F.explode("most.hub").alias("hub"))
    return best.select(F.greatest("node", "hub").alias("a"), F.least("node", "hub").alias("b")).distinct()


def _tiled(shared: DataFrame, sets: DataFrame, percent: int, best: bool) -> DataFrame:
    """Candidate pairs across components, from tiles of the documents of a hash.

    With ``best``, only the pair of each two components whose bitmaps differ least: what does not link is met again without.
    Rows of a hash that few sets have carry folded bitmaps, as most rows are of such; ``_linked`` bounds what is left by the whole ones.
    """
    runs = shared.groupBy("h").agg(F.min("n").alias("smallest"))
    # as in ``reachable``, for the smallest set of the hash: a row that can't meet it meets none
    reach = f"(n - at) * {100 + percent} >= {percent} * (n + greatest(smallest, n * {percent} / 100))"
    rows = shared.join(runs, "h").where(reach).select("h", "node", "n", "at", "root")
    runs = rows.groupBy("h").agg(F.count("*").alias("rows"), F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y")
    pieces = F.ceil(F.col("rows") / TILE).cast("int")
    rows = (
        rows.join(runs, "h")
        .withColumn("own", F.pmod(F.xxhash64("node"), pieces).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), pieces - 1)))
        .join(sets.select("node", "bits", "small"), "node")
        .withColumn("signs", F.when(F.col("rows") > FOLDED_ROWS, F.col("bits")).otherwise(F.col("small")))
        .select("h", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), "n", "node", "root", "own", "at", "signs")
    )

    def compare(batches: Iterator) -> Iterator:
        held: list[tuple] = []
        found: set[tuple[int, int]] = set()
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and row[:3] != held[0][:3]:
                    found |= tile_pairs(held, percent, best)
                    held = []
                held.append(row)
            if len(found) > 1 << 16:
                yield _pair_batch(found)
                found = set()
        yield _pair_batch(found | tile_pairs(held, percent, best))

    parts = rows.repartition("h", "p", "q").sortWithinPartitions("h", "p", "q", "n")
    return common.in_batches(parts, compare, "a long, b long", rows=4096).distinct()


def _pair_batch(pairs: set[tuple[int, int]]) -> pa.RecordBatch:
    both = np.array(sorted(pairs), np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["a", "b"])


def reachable(n, m, i, j, percent: int):
    """Whether sets of n and m hashes whose first common hash has i and j before it can link: the rest must hold the overlap.

    Pairs of which it is not the first are met where that is. Numbers or arrays; sizes are checked as well.
    """
    least = percent * (n + m)
    return ((n - i) * (100 + percent) >= least) & ((m - j) * (100 + percent) >= least) & (100 * n >= percent * m) & (100 * m >= percent * n)


def tile_pairs(rows: list[tuple], percent: int, best: bool = False) -> set[tuple[int, int]]:
    """Pairs of a tile's rows (h, p, q, n, node, root, own, at, bitmap), sorted by n, that may link.

    Bands are the sizes that share a bitmap width; a band meets itself and, on folded bitmaps, larger bands in reach.
    ``best`` keeps the pair of each two roots with the fewest differing bits.
    """
    cross = rows and rows[0][1] != rows[0][2]
    found: dict[tuple[int, int], tuple[int, int, int]] = {}

    def keep(a: int, b: int, r: int, s: int, differing: int) -> None:
        at = (min(r, s), max(r, s)) if best else (min(a, b), max(a, b))
        found[at] = min(found.get(at, (differing, a, b)), (differing, a, b))

    if len(rows) <= SMALL_TILE:
        for y in range(len(rows)):
            for x in range(y):
                (_, _, _, n, a, r, o, i, u), (_, _, _, m, b, s, p, j, v) = rows[x], rows[y]
                if r == s or cross and o == p or not reachable(n, m, i, j, percent):
                    continue
                width = min(len(u), len(v))
                differing = int(np.bitwise_count(folded(u, width) ^ folded(v, width)).sum())
                if may_link(n, m, differing, percent):
                    keep(a, b, r, s, differing)
        return {(max(a, b), min(a, b)) for _, a, b in found.values()}
    bands: dict[int, list[tuple]] = {}
    for r in rows:
        bands.setdefault(len(r[8]), []).append(r)
    widths = sorted(bands)
    for place, width in enumerate(widths):
        small = _band(bands[width], width)
        for other in widths[place:]:
            if 100 * bands[width][-1][3] < percent * bands[other][0][3]:
                break
            large = small if other == width else _band(bands[other], width)
            # rows of ``small`` by blocks, so that a tile takes some MB only
            for start in range(0, len(small[0]), 64):
                n, node, root, own, at = (c[start : start + 64, None] for c in small[:5])
                meet = (root != large[2]) & reachable(n, large[0], at, large[4], percent)
                if cross:
                    meet &= own != large[3]
                x, y = np.nonzero(meet)
                differing = np.zeros(len(x), np.int64)
                for word in range(small[5].shape[1]):
                    differing += np.bitwise_count(small[5][start + x, word] ^ large[5][y, word])
                sizes = n[x, 0] + large[0][y]
                near = (100 + percent) * (sizes - differing) >= 2 * percent * sizes
                x, y, differing = x[near], y[near], differing[near]
                for row in zip(node[x, 0].tolist(), large[1][y].tolist(), root[x, 0].tolist(), large[2][y].tolist(), differing.tolist()):
                    keep(*row)
    return {(max(a, b), min(a, b)) for _, a, b in found.values()}


def _band(rows: list[tuple], width: int) -> tuple[np.ndarray, ...]:
    columns = tuple(np.array([r[k] for r in rows], np.int64) for k in (3, 4, 5, 6, 7))
    return (*columns, np.stack([folded(r[8], width) for r in rows]))


def linked_components(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5, percent: int = 75) -> DataFrame:
    """(doc_id, n_shingles, component_id): the smallest key each document reaches by links, itself included.

    Null and wordless texts have no shingles and link with nothing. Every input row gives a row, so a repeated
    key repeats; rows of one key may lie in different components. A null key takes part in links, but names no component
    (a component of null keys only has a null id). Other columns of ``docs`` are ignored, whatever their names.
    """
    docs = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))
    with scratch(docs.sparkSession):
        return materialize(_components(docs, size, percent), "classes", outer=True)


def _components(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """The result of ``linked_components``, from tables that are deleted as soon as nothing reads them again."""
    session = docs.sparkSession
    hot = session.sparkContext.broadcast(common.filter_bits(_counts(docs, size).where(F.col("n") > HOT), "h"))
    whole = materialize(_scanned(docs, size, percent, hot), "whole")
    prefixes = materialize(_prefixes(whole), "prefixes")
    # whether a row's task listed its prefix is all that is kept of it
    scanned = materialize(whole.select("doc_id", "node", "n", (F.size("first") > 0).alias("listed")), "scanned")
    discard(whole)
    shared = materialize(_shared(prefixes, percent), "shared")
    discard(prefixes)
    nodes = materialize(shared.select("node").distinct(), "nodes")
    ids = scanned.where("listed").join(nodes, "node", "left_semi")
    sets = materialize(_remade(docs, size, ids, nodes, ["bits", "small"], sketch), "sets")
    roots = None
    for step in range(STAR_ROUNDS + 2):
        rows = shared.withColumn("root", F.col("node"))
        if roots is not None:
            rows = shared.drop("root").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        # hashes that more than one component has
        split = rows.groupBy("h").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("h")
        rooted = materialize(rows.join(split, "h").select("h", "node", "n", "at", "root"), "rooted")
        if step < STAR_ROUNDS:
            pairs = _stars(rooted, step, percent)
        else:
            pairs = _tiled(rooted, sets, percent, best=step == STAR_ROUNDS)
        with scratch(session):
            more = materialize(_linked(pairs, sets, docs, size, percent), "links", outer=True)
        # what is known goes on as one link a node
        with scratch(session):
            joined = materialize(components(more if roots is None else more.union(roots)), "roots", outer=True)
        discard(more, shared, *([] if roots is None else [roots]))
        shared, roots = rooted, joined
    classes = scanned.join(roots, "node", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("root", "node").alias("root")
    )
    least = classes.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    joined = classes.join(least, "root", "left")
    return joined.select("doc_id", "n_shingles", F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))

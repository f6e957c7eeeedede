"""Log-bilinear language model, trained with noise-contrastive estimation, that scores whole texts.

Tokens are lower-cased words and one end per text. A token's class is itself if it is one of the ``SHORTLIST``
most frequent training words, else one of ``BUCKETS`` buckets by its last bytes. The model predicts a class from the
two classes before it: score(w | v1, v2) = q_w . (C1 r_v1 + C2 r_v2) + b_w. Within a bucket, a token has its
add-one share of the bucket's training tokens, unseen words together one more count, so that
all probabilities of a position sum to one over known words and the unseen words of each bucket.

- Texts are cut into blocks with a dictionary each. Training counts of every word come from one shuffle of
  the dictionaries, without the shortlist, whose counts are aggregated before they are shuffled.
- Training reads every training token once, in ``ROUNDS`` slices. Each task runs minibatches from the common
  parameters over its blocks; the parameters are then averaged, weighted by tokens (AdaGrad within a task).
- As the score is a sum over both context positions, exp(score) factorises and the normaliser of every pair of
  classes is one matrix product. A task computes it once and then only looks up: log p is exactly normalised.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from propensity.llm import common
from propensity.session import materialize

SHORTLIST = 1534
BUCKETS = 512
#: Longest word of the shortlist in bytes, so that its size is bounded; longer ones go to their bucket.
WORD_BYTES = 64
BEGIN, END = 0, 1
DIMENSIONS = 32
NOISE = 48
BATCH = 2048
ROUNDS = 2
RATE = 0.05
#: Bytes of text in a block. A longer text is a block of its own.
BLOCK_BYTES = 8 << 20
CLASSES = 2 + SHORTLIST + BUCKETS


class _Ids(dict):
    """Numbers words in order of their first use."""

    def __missing__(self, word):
        self[word] = number = len(self)
        return number


def _blocks(docs: DataFrame) -> DataFrame:
    key = docs.schema["doc_id"].dataType
    arrow_key = pa.int64() if key.typeName() == "long" else None

    def pack(number: int, ids: _Ids, keys: list, held: list, runs: list) -> pa.RecordBatch:
        flat = np.concatenate(runs) if runs else np.empty(0, np.int32)
        trained = [r for r, h in zip(runs, held) if not h]
        counts = np.bincount(np.concatenate(trained), minlength=len(ids)) if trained else np.zeros(len(ids), np.int64)
        columns = [
            pa.array([number]),
            pa.array([keys], pa.list_(arrow_key) if arrow_key else None),
            pa.array([held]),
            pa.array([[len(r) for r in runs]], pa.list_(pa.int32())),
            pa.array([zstandard.compress(flat.tobytes(), 1)]),
            pa.array([list(ids)], pa.list_(pa.binary())),
            pa.array([counts.astype(np.int64)], pa.list_(pa.int64())),
        ]
        return pa.RecordBatch.from_arrays(columns, ["block", "keys", "held", "lengths", "ids", "words", "counts"])

    def cut(batches: Iterator) -> Iterator:
        number = TaskContext.get().partitionId() << 32
        ids, keys, held, runs, size = _Ids(), [], [], [], 0
        for batch in batches:
            for (doc, text), out in zip(common.keyed_bytes(batch), batch.column(2).to_pylist()):
                if size and size + len(text or b"") > BLOCK_BYTES:
                    yield pack(number, ids, keys, held, runs)
                    number, ids, keys, held, runs, size = number + 1, _Ids(), [], [], [], 0
                keys.append(doc)
                held.append(out)
                runs.append(np.array([ids[w] for w in common.words(text)], np.int32))
                size += len(text or b"")
        if keys:
            yield pack(number, ids, keys, held, runs)

    schema = f"block long, keys array<{key.simpleString()}>, held array<boolean>, lengths array<int>, ids binary"
    return common.in_batches(docs, cut, schema + ", words array<binary>, counts array<long>")


def bucket_of(word: bytes) -> int:
    return 2 + SHORTLIST + zlib.crc32(word[-3:]) % BUCKETS


def _bucket(word):
    return (F.lit(2 + SHORTLIST) + F.crc32(F.expr("substring(word, -3, 3)")) % BUCKETS).cast("int")


def sequence(classes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, ...]:
    """Per token, ends included: its class, the two before it, and where each text starts."""
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    out = np.empty(len(classes) + len(lengths), np.int64)
    word = np.ones(len(out), bool)
    word[ends] = False
    out[word] = classes
    out[ends] = END
    one = np.concatenate([[BEGIN], out[:-1]])
    one[starts] = BEGIN
    two = np.concatenate([[BEGIN], one[:-1]])
    two[starts] = BEGIN
    return out, one, two, starts


def initial(shares: np.ndarray) -> dict[str, np.ndarray]:
    """Parameters before training: the unigram model, with small random vectors."""
    draw = np.random.default_rng(7)
    near = lambda *shape: (0.1 * draw.standard_normal(shape)).astype(np.float32)
    eye = np.eye(DIMENSIONS, dtype=np.float32)
    return {"q": near(CLASSES, DIMENSIONS), "b": np.log(shares).astype(np.float32), "r": near(CLASSES, DIMENSIONS), "c1": eye.copy(), "c2": 0.5 * eye}


def _rows_added(to: np.ndarray, at: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Add ``rows`` to the rows ``at`` of ``to``; the distinct places."""
    order = np.argsort(at.astype(np.int16), kind="stable")  # a radix sort
    at = at[order]
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    to[at[first]] += np.add.reduceat(rows.take(order, 0), first, axis=0)
    return at[first]


def train(model: dict[str, np.ndarray], shares: np.ndarray, batches: Iterator[tuple], seed: int) -> int:
    """Noise-contrastive minibatches over (class, one before, two before), in place; the number of tokens."""
    draw = np.random.default_rng(seed)
    cumulated = np.cumsum(shares)
    log_noise = (np.log(shares) + np.log(NOISE)).astype(np.float32)
    squares = {k: np.full(v.shape, 1e-6, np.float32) for k, v in model.items()}
    seen = 0
    for w, v1, v2 in batches:
        seen += len(w)
        noise = np.searchsorted(cumulated, draw.random(NOISE) * cumulated[-1]).clip(0, CLASSES - 1)
        r1, r2, qw, qn = model["r"].take(v1, 0), model["r"].take(v2, 0), model["q"].take(w, 0), model["q"].take(noise, 0)
        context = r1 @ model["c1"] + r2 @ model["c2"]
        real = np.einsum("ij,ij->i", context, qw) + model["b"][w] - log_noise[w]
        fake = context @ qn.T + (model["b"][noise] - log_noise[noise])
        up = 0.5 - 0.5 * np.tanh(0.5 * real)
        fake *= 0.5
        down = np.tanh(fake, out=fake)
        down += 1
        down *= -0.5
        towards = up[:, None] * qw + down @ qn
        into = np.zeros_like(model["r"])
        at = np.union1d(_rows_added(into, v1, towards @ model["c1"].T), _rows_added(into, v2, towards @ model["c2"].T))
        _step(model, squares, "c1", slice(None), r1.T @ towards)
        _step(model, squares, "c2", slice(None), r2.T @ towards)
        _step(model, squares, "r", at, into[at])
        wide = np.concatenate([context, np.ones((len(w), 1), np.float32)], 1)
        out = np.zeros((CLASSES, DIMENSIONS + 1), np.float32)
        at = np.union1d(_rows_added(out, w, wide * up[:, None]), _rows_added(out, noise, down.T @ wide))
        _step(model, squares, "q", at, out[at, :-1])
        _step(model, squares, "b", at, out[at, -1])
    return seen


def _step(model: dict, squares: dict, name: str, at, gradient: np.ndarray) -> None:
    gradient = gradient / np.float32(BATCH)
    squares[name][at] += gradient * gradient
    model[name][at] += np.float32(RATE) * gradient / np.sqrt(squares[name][at])


def flat(model: dict[str, np.ndarray]) -> np.ndarray:
    wide = lambda m: np.pad(m, ((0, 0), (0, 1)))
    return np.concatenate([np.concatenate([model["q"], model["b"][:, None]], 1), wide(model["r"]), wide(model["c1"]), wide(model["c2"])])


def unflat(rows: np.ndarray) -> dict[str, np.ndarray]:
    q, r, c1, c2 = np.split(rows.astype(np.float32), [CLASSES, 2 * CLASSES, 2 * CLASSES + DIMENSIONS])
    return {"q": q[:, :-1].copy(), "b": q[:, -1].copy(), "r": r[:, :-1].copy(), "c1": c1[:, :-1].copy(), "c2": c2[:, :-1].copy()}


def tables(model: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Scores by (class before, class), by (class two before, class), and the log normaliser of both contexts."""
    first = (model["r"] @ model["c1"] @ model["q"].T + model["b"]).astype(np.float32)
    second = (model["r"] @ model["c2"] @ model["q"].T).astype(np.float32)
    high1, high2 = first[:, 1:].max(1, keepdims=True), second[:, 1:].max(1, keepdims=True)
    total = np.exp(first[:, 1:] - high1, dtype=np.float64) @ np.exp(second[:, 1:] - high2, dtype=np.float64).T
    return first, second, (np.log(total) + high1 + high2.T).astype(np.float32)


def _averaged(blocks: DataFrame, model: dict, shares: np.ndarray, shortlist, turn: int) -> dict:
    """One round: the texts whose place in their block is ``turn`` modulo ROUNDS."""
    start = blocks.sparkSession.sparkContext.broadcast((model, shares))

    def minibatches(batches: Iterator, seeds: list[int]) -> Iterator[tuple]:
        for batch in batches:
            for number, held, lengths, ids, words in zip(*(c.to_pylist() for c in batch.columns)):
                seeds.append(number)
                known = shortlist.value[0]
                of = np.array([known.get(w) or bucket_of(w) for w in words], np.int64)
                classes = of[np.frombuffer(zstandard.decompress(ids), np.int32)] if words else np.empty(0, np.int64)
                lengths, mine = np.array(lengths, np.int64), (np.arange(len(held)) % ROUNDS == turn) & ~np.array(held, bool)
                classes, lengths = classes[np.repeat(mine, lengths)], lengths[mine]
                if len(lengths):
                    w, one, two, _ = sequence(classes, lengths)
                    for i in range(0, len(w), BATCH):
                        yield w[i : i + BATCH], one[i : i + BATCH], two[i : i + BATCH]

    def fit(batches: Iterator) -> Iterator:
        model, shares = start.value
        model, seeds = {k: v.copy() for k, v in model.items()}, []
        steps = minibatches(batches, seeds)
        first = next(steps, None)
        if first is not None:
            chained = (x for part in ([first], steps) for x in part)
            seen = train(model, shares, chained, seeds[0])
            rows = flat(model)
            columns = [pa.array(np.arange(len(rows))), pa.array(np.full(len(rows), float(seen))), pa.array(list(rows), pa.list_(pa.float32()))]
            yield pa.RecordBatch.from_arrays(columns, ["row", "seen", "v"])

    trained = common.in_batches(blocks.select("block", "held", "lengths", "ids", "words"), fit, "row long, seen double, v array<float>", rows=1)
    means = [(F.sum(F.col("seen") * F.col("v")[i]) / F.sum("seen")).alias(f"v{i}") for i in range(DIMENSIONS + 1)]
    rows = trained.groupBy("row").agg(*means).toPandas().sort_values("row")
    return unflat(rows.drop(columns="row").to_numpy()) if len(rows) else model


def score(docs: DataFrame, held_out, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row.

    ``held_out`` is a boolean column over ``docs``; rows where it is true are scored but not learned from (null counts as
    false). Null texts are empty: they have the end token only. Repeated rows count as often as they occur.
    Without training rows there is nothing known, and every class is equally likely. Other columns are ignored.
    """
    session = docs.sparkSession
    docs = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"), F.coalesce(held_out, F.lit(False)).alias("held"))
    key_type = docs.schema["doc_id"].dataType.simpleString()
    blocks = materialize(_blocks(docs), "blocks")
    entries = blocks.select("block", F.posexplode(F.arrays_zip("words", "counts")).alias("at", "entry"))
    entries = entries.select("block", "at", F.col("entry.words").alias("word"), F.col("entry.counts").alias("n"))

    # all blocks are summed before anything is ranked or left out, so that the words do not depend on the layout
    vocabulary = materialize(entries.groupBy("word").agg(F.sum("n").alias("c")), "vocabulary")
    frequent = vocabulary.where(f"c > 1 and length(word) <= {WORD_BYTES}").orderBy(F.desc("c"), "word").limit(SHORTLIST).collect()
    chosen, counts = [bytes(r.word) for r in frequent], {i + 2: r.c for i, r in enumerate(frequent)}
    short = session.createDataFrame([(w, i + 2) for i, w in enumerate(chosen)], "word binary, class int")
    marked = entries.join(F.broadcast(short), "word", "left")  # SHORTLIST rows of WORD_BYTES at most
    others = vocabulary.join(F.broadcast(short), "word", "left_anti")
    tail = marked.where("class is null").join(others, "word").select("block", "at", _bucket("word").alias("class"), "c")
    buckets = others.where("c > 0").groupBy(_bucket("word").alias("class")).agg(F.sum("c").alias("tokens"), F.count("*").alias("kinds")).collect()
    ends = blocks.select(F.sum(F.size(F.filter("held", lambda h: ~h)))).first()[0] or 0

    mass = np.zeros(CLASSES)
    kinds = np.zeros(CLASSES)
    mass[END] = ends
    for k, c in counts.items():
        mass[k] = c
    for r in buckets:
        mass[r["class"]], kinds[r["class"]] = r.tokens, r.kinds
    tokens, vocabulary = int(mass.sum()), int(kinds.sum()) + sum(c > 0 for c in counts.values()) + (ends > 0)
    shares = (mass + 1) / (mass + 1).sum()

    known = session.sparkContext.broadcast(({w: i + 2 for i, w in enumerate(chosen)},))
    model = initial(shares)
    for turn in range(ROUNDS):
        model = _averaged(blocks, model, shares, known, turn)
    shared = session.sparkContext.broadcast((model, np.where(np.arange(CLASSES) >= 2 + SHORTLIST, mass + kinds + 1, 1)))

    listed = marked.where("class is not null").join(
        F.broadcast(session.createDataFrame(list(counts.items()), "class int, c long")), "class"
    )  # SHORTLIST rows
    coded = tail.select("block", "at", "class", "c").union(listed.select("block", "at", "class", "c"))
    coded = coded.groupBy("block").agg(F.collect_list(F.struct("at", "class", "c")).alias("codes"))
    rows = blocks.select("block", "keys", "held", "lengths", "ids").join(coded, "block", "left").drop("block")
    per_token, cache = np.log10(tokens + vocabulary + 1), {}

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            if not cache:
                cache["t"] = tables(shared.value[0])
            first, second, normal = cache["t"]
            within = shared.value[1]
            for i in range(batch.num_rows):
                keys, held, lengths = batch.column(0)[i].values, batch.column(1)[i].values, batch.column(2)[i].values.to_numpy().astype(np.int64)
                ids = np.frombuffer(zstandard.decompress(batch.column(3)[i].as_py()), np.int32)
                of, c = np.zeros(ids.max() + 1 if len(ids) else 0, np.int64), np.zeros(ids.max() + 1 if len(ids) else 0, np.int64)
                if len(ids):
                    codes = batch.column(4)[i].values
                    at = codes.field("at").to_numpy()
                    of[at], c[at] = codes.field("class").to_numpy(), codes.field("c").to_numpy()
                w, one, two, starts = sequence(of[ids], lengths)
                every = np.full(len(w), ends)
                word = np.ones(len(w), bool)
                word[starts + lengths] = False
                every[word] = c[ids]
                log_p = (first[one, w] + second[two, w] - normal[one, two]).astype(np.float64)
                log_p += np.where(w >= 2 + SHORTLIST, np.log((every + 1) / within[w]), 0)
                sums = [np.add.reduceat(x, starts) for x in (log_p / np.log(10), np.log10(every + 1.0) - per_token, (every > 0).astype(np.int64))]
                columns = [keys, held, pa.array(lengths + 1), pa.array(sums[2]), pa.array(np.full(len(lengths), tokens)), pa.array(sums[1]), pa.array(sums[0])]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    schema = f"doc_id {key_type}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return common.in_batches(rows, run, schema, rows=1)

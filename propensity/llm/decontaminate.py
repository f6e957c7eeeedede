"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment.

1. A seed is a run of words, or one with a word left out before its last. A pass over the documents finds words that begin a seed
   of a benchmark item (a bit array of fixed size over the items' seeds). As both forms are compared with both, a copy
   with every third word replaced has seeds, and so have copies with words inserted or left out. Around each hit the hashes of as many words as the longest item has, and some more, are kept; passages
   that overlap are one. No text is read or moved again.
2. Hits join the items' seeds. A passage and an item are a candidate if they share a seed that at most ``FEW`` items have, or
   two different seeds, or one and the item has at most ``SHORT`` (a longer one needs more for half its score).
3. Candidates that may reach the score by the words they share are aligned word by word: local alignment finds copies with words replaced, inserted or left out.
   The score is that of the best alignment as a share of the item's score against itself. A run of ``RUN`` equal words
   tells a copy whatever the score.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from propensity.llm import common
from propensity.session import materialize, scratch

SEED_WORDS = 3
FEW = 64
SHORT = 64
RUN = 25
#: Words kept around a hit, as a multiple of the longest item's.
SLACK = 1.25
MATCH, MISMATCH, GAP = 2, -1, -1
#: Words of a passage that are aligned at once, unless the item needs more.
WINDOW_WORDS = 4096
_WORD = re.compile(r"[^\W_]+")


def words(text: str | None) -> list[str]:
    """Lower-cased runs of letters and digits: case, punctuation and decoration hide no copy."""
    return _WORD.findall(text.lower()) if text else []


def _items(benchmark: DataFrame, key: str, text: str) -> DataFrame:
    """Word hashes and seed hashes of each item with SEED_WORDS words at least."""
    items = benchmark.select(F.col(key).alias("item_id"), F.col(text).cast("string").alias("text"))
    kind = items.schema["item_id"].dataType.simpleString()

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            each = [common.word_hashes(words(t)) for t in batch.column(1).to_pylist()]
            hashes, seeds = [common.signed(w) for w in each], [common.signed(np.unique(_seeds(w)[0])) for w in each]
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(hashes, longs), pa.array(seeds, longs)], ["item_id", "words", "seeds"])

    return common.in_batches(items, run, f"item_id {kind}, words array<long>, seeds array<long>").where("size(seeds) > 0")


def passages(hits: np.ndarray, reach: int, length: int) -> list[tuple[int, int]]:
    """Ranges of words within ``reach`` of a hit, united where they meet."""
    out: list[tuple[int, int]] = []
    for hit in hits.tolist():
        start, end = max(0, hit - reach), min(length, hit + reach + SEED_WORDS)
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], end)
        else:
            out.append((start, end))
    return out


def _passages(docs: DataFrame, seeds, reach: int) -> DataFrame:
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            rows = []
            for doc, text, place in zip(*(c.to_pylist() for c in batch.columns)):
                tokens = words(text)
                if len(tokens) < SEED_WORDS:
                    continue
                hashes = common.word_hashes(tokens)
                grams, places = _seeds(hashes)
                found = common.maybe_in(seeds.value, grams)
                grams, hits = grams[found], places[found]
                for start, end in passages(np.unique(hits), reach, len(tokens)) if len(hits) else ():
                    mine = grams[(hits >= start) & (hits < end)]
                    rows.append((doc, place, start, common.signed(hashes[start:end]), np.unique(common.signed(mine))))
            types = [batch.column(0).type, pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]
            columns = [pa.array(list(c), t) for c, t in zip(zip(*rows) if rows else [[]] * 5, types)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "place", "start", "words", "hits"])

    found = common.in_batches(docs, run, f"doc_id {kind}, place long, start long, words array<long>, hits array<long>")
    return found.withColumn("passage", F.xxhash64("doc_id", "place", "start", "words"))


def _seeds(each: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash for each run of SEED_WORDS words, and for each with a word left out before the last; and where they begin."""
    hashes, places = [], []
    for gap in (0, 1):
        last = max(0, len(each) - SEED_WORDS - gap + 1)
        total = np.zeros(last, np.uint64)
        for i in (*range(SEED_WORDS - 1), SEED_WORDS - 1 + gap):
            total = common.mixed(total + each[i : i + last])
        hashes.append(total)
        places.append(np.arange(last))
    return np.concatenate(hashes), np.concatenate(places)


def bound(item: np.ndarray, words: np.ndarray) -> int:
    """At least the score of any alignment: words of the item that the passage lacks cost as much as the cheapest change."""
    sums = np.zeros(len(item) + 1, np.int64)
    np.cumsum(np.where(np.isin(item, words), MATCH, max(MISMATCH, GAP)), out=sums[1:])
    return int((sums - np.minimum.accumulate(sums)).max())


def run_of(item: np.ndarray, words: np.ndarray) -> int:
    """Length of the longest run of words that an item shares with a passage."""
    longest, runs = 0, np.zeros(len(words) + 1, np.int32)
    for word in item:
        runs[1:] = np.where(words == word, runs[:-1] + 1, 0)
        longest = max(longest, int(runs.max()))
    return longest


def align(item: np.ndarray, words: np.ndarray) -> tuple[int, int, int]:
    """Best local alignment of an item with a passage: score, first word and end in the passage.

    A long passage is aligned in windows. An alignment that scores has at most as many matches as the item has words, which pay for twice
    as many gaps, so it takes up three times the item's words at most; windows overlap by that.
    """
    reach = 3 * len(item)
    size = max(WINDOW_WORDS, 2 * reach)
    if len(words) <= size:
        return _align(item, words)
    found = [(_align(item, words[at : at + size]), at) for at in range(0, len(words) - reach, size - reach)]
    return max(((score, at + start, at + end) for (score, start, end), at in found), key=lambda x: (x[0], -x[1]))


def _align(item: np.ndarray, words: np.ndarray) -> tuple[int, int, int]:
    cells = np.zeros((len(item) + 1, len(words) + 1), np.int32)
    gaps = -GAP * np.arange(len(words) + 1, dtype=np.int32)
    for i, word in enumerate(item, 1):
        here = np.where(words == word, MATCH, MISMATCH).astype(np.int32)
        best = cells[i - 1] + GAP
        best[1:] = np.maximum(best[1:], cells[i - 1, :-1] + here)
        np.maximum(best, 0, out=best)
        # a gap in the item costs alike per word, so the best start of one is a running maximum
        cells[i] = np.maximum.accumulate(best + gaps) - gaps
    i, j = np.unravel_index(int(np.argmax(cells)), cells.shape)
    score, end = int(cells[i, j]), int(j)
    while i and j and cells[i, j] > 0:
        step = MATCH if item[i - 1] == words[j - 1] else MISMATCH
        if cells[i, j] == cells[i - 1, j - 1] + step:
            i, j = i - 1, j - 1
        elif cells[i, j] == cells[i - 1, j] + GAP:
            i -= 1
        else:
            j -= 1
    return score, int(j), end


def contaminated(
    docs: DataFrame, benchmark: DataFrame, threshold: float = 0.5, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """(doc_id, item_id, score, start_word, end_word): each document's best passage for each item, from ``threshold`` on.

    Passages that share RUN words in a row with the item are told below the threshold too.

    Items of fewer than SEED_WORDS words can't be told from chance and match nothing; null texts have no words. Equal rows of
    either table give one row; of equally good passages the first is told. Null keys are kept. Other columns are ignored.
    """
    with scratch(docs.sparkSession):
        told = materialize(_told(docs, benchmark, threshold, key, text, item_key, item_text), "told", outer=True)
    best = told.groupBy("doc_id", "item_id").agg(F.max(F.struct("score", -F.col("start_word"), -F.col("end_word"))).alias("b"))
    return best.select("doc_id", "item_id", F.col("b.score").alias("score"), (-F.col("b.col2")).alias("start_word"), (-F.col("b.col3")).alias("end_word"))


def without(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.5, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of ``docs`` whose own text holds no copy, by key (null keys too) and hash of the text; all columns stay."""
    with scratch(docs.sparkSession):
        told = _told(docs, benchmark, threshold, key, text, "item_id", "text")
        told = told.select(F.col("doc_id").alias("key told"), F.col("place").alias("place told")).distinct()
        told = materialize(told, "contaminated", outer=True)
    hashed = told.select(F.xxhash64("key told", "place told").alias("h"))
    # texts that hold no copy stay where they are, all but a few
    apart, near = common.parted(docs, F.xxhash64(docs[key], _place(docs[text])), hashed, "h")
    same = near[key].eqNullSafe(told["key told"]) & (_place(near[text]) == told["place told"])
    return apart.union(near.join(told, same, "left_anti"))


def _place(text):
    return F.xxhash64(text.cast("string"))


def _told(docs: DataFrame, benchmark: DataFrame, threshold: float, key: str, text: str, item_key: str, item_text: str) -> DataFrame:
    """Each passage told, with the hash of its text as ``place``."""
    session = docs.sparkSession
    docs = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"), _place(docs[text]).alias("place"))
    items = materialize(_items(benchmark, item_key, item_text), "items")
    seeds = items.select("item_id", F.explode("seeds").alias("seed")).distinct()
    longest = items.agg(F.max(F.size("words"))).first()[0] or 0
    reach = int(SLACK * longest)
    wanted = session.sparkContext.broadcast(common.filter_bits(seeds, "seed"))
    found = materialize(_passages(docs, wanted, reach), "passages")
    hits = found.select("passage", F.explode("hits").alias("seed")).distinct()
    sizes = seeds.groupBy("item_id").agg((F.count("*") <= SHORT).alias("short"))
    kept = seeds.groupBy("seed").agg((F.count("*") <= FEW).alias("few"))
    candidates = (
        hits.join(seeds.join(kept, "seed").join(sizes, "item_id"), "seed")
        .groupBy("passage", "item_id")
        .agg(F.count("*").alias("seeds"), F.max(F.col("few") | F.col("short")).alias("telling"))
        .where("seeds >= 2 or telling")
    )
    texts = found.select("passage", "doc_id", "place", "start", F.col("words").alias("passage_words")).dropDuplicates(["passage"])
    pairs = candidates.join(items.select("item_id", "words").dropDuplicates(["item_id", "words"]), "item_id").join(texts, "passage")
    # words of the item that the passage lacks can't be matched: most candidates end here, before any alignment
    matched = F.size("words") - F.size(F.array_except("words", "passage_words"))
    pairs = pairs.where(matched >= F.least(F.lit(float(threshold)) * F.size("words"), F.lit(float(RUN))))
    pairs = pairs.select("doc_id", "item_id", "start", "words", "passage_words", "place")
    kinds = {f.name: f.dataType.simpleString() for f in pairs.schema}

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            scores, starts, ends, runs = [], [], [], []
            for i in range(batch.num_rows):
                item = batch.column(3)[i].values.to_numpy()
                passage = batch.column(4)[i].values.to_numpy()
                possible = bound(item, passage) >= MATCH * min(threshold * len(item), RUN)
                score, start, end = align(item, passage) if possible else (0, 0, 0)
                # a run of equal words has its own score at least
                runs.append(score >= MATCH * RUN and (score >= MATCH * threshold * len(item) or run_of(item, passage) >= RUN))
                first = batch.column(2)[i].as_py()
                scores.append(score / (MATCH * len(item)))
                starts.append(first + start)
                ends.append(first + end)
            columns = [batch.column(0), batch.column(1), pa.array(scores, pa.float64()), pa.array(starts, pa.int64()), pa.array(ends, pa.int64())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(runs, pa.bool_()), batch.column(5)], ["doc_id", "item_id", "score", "start_word", "end_word", "run", "place"])

    schema = f"doc_id {kinds['doc_id']}, item_id {kinds['item_id']}, score double, start_word long, end_word long, run boolean, place long"
    return common.in_batches(pairs, run, schema).where((F.col("score") >= threshold) | F.col("run"))

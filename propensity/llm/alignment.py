"""Alignment of the tokens of two tokenizers over the same bytes, and how often their tokens meet in the corpus.

Two tokens overlap if their byte ranges share a byte. Groups are the components of overlapping tokens; they end where tokens
of both sides end. They are found by pointer jumping: every token points to the overlapping token that reaches farthest to
the right (itself, if none reaches farther; of two that end together, the first side's), and doubling all pointers at once
until none moves leaves each at the last token of its component, which names the group.

All texts of a part are one line of bytes: a text's last tokens end together, so no pointer leaves its text. For the counts of the
whole corpus a block keeps its links as places in its own list of distinct pairs. The lists are summed by pair, the sums
return to the blocks that hold the pair, and a block meets its list as one group, bounded by the links of the block.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from propensity.llm import common
from propensity.session import materialize

#: Bytes of text that are tokenized and aligned at once (a longer text comes alone), and links after which a block is full.
TEXT_BYTES, BLOCK_LINKS = 1 << 20, 3 << 20
#: How byte-level vocabularies of this kind cut a text before they merge.
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_ARRAYS = ("a_ids", "b_ids", "a_ends", "b_ends", "a_group", "b_group")
_CARRIED = ["doc_id", "n_a", "n_b", "n_groups", "groups_sha256"]


def _byte_of() -> dict[str, int]:
    """The public byte-level alphabet: printable Latin-1 stands for itself, other bytes for the characters from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def byte_encoder(path: str) -> tuple[Callable[[str], np.ndarray], dict[int, bytes]]:
    """Ids of a text under the byte-level BPE at ``path``, special tokens' strings being plain text; and the bytes of each id.

    A vocabulary whose merges are numbered in their order is the same as ranks, and those are encoded some times faster by
    ``tiktoken``; any other goes through ``tokenizers``.
    """
    told = json.loads(Path(path).read_text())
    model, byte_of = told["model"], _byte_of()
    special = {t["content"] for t in told.get("added_tokens") or []}
    spelled = {i: bytes(byte_of[c] for c in name) for name, i in model["vocab"].items() if name not in special}
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    steps = told["pre_tokenizer"] or {}
    ranked = (
        told["normalizer"] is None and steps.get("type") == "ByteLevel" and not steps["add_prefix_space"] and steps["use_regex"]
        and not model.get("ignore_merges") and all(model["vocab"].get(a + b) == 256 + i for i, (a, b) in enumerate(merges))
        and len(spelled) == 256 + len(merges) and all(len(spelled[i]) == 1 for i in range(256))
    )
    library: list = []

    def whole(text: str) -> np.ndarray:
        if not library:
            import tokenizers

            library.append(tokenizers.Tokenizer.from_file(path))
            library[0].encode_special_tokens = True
        return np.array(library[0].encode(text, add_special_tokens=False).ids, np.int64)

    if not ranked:
        return whole, spelled
    import tiktoken

    encoding = tiktoken.Encoding("ranks", pat_str=_WORDS, mergeable_ranks={x: i for i, x in spelled.items()}, special_tokens={})

    def by_ranks(text: str) -> np.ndarray:
        try:
            return encoding.encode_to_numpy(text).astype(np.int64)
        except ValueError:  # its pattern runs out of stack in very long white space
            return whole(text)

    return by_ranks, spelled


class _Entries:
    """Byte strings by number, one after another."""

    def __init__(self, entries: list[bytes]):
        self.sizes = np.array([len(e) for e in entries], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.data = np.frombuffer(b"".join(entries), np.uint8)

    def joined(self, numbers: np.ndarray) -> np.ndarray:
        return common.gathered(self.data, self.starts, self.sizes, numbers)


class TokenizerPair:
    """A byte-level BPE over a space and the text, and a sentencepiece model that puts the space itself."""

    def __init__(self, byte_path: str, piece_path: str):
        import sentencepiece

        self.a, spelled = byte_encoder(byte_path)
        self.b = b = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        self.a_bytes = _Entries([spelled.get(i, b"") for i in range(max(spelled) + 1)])
        pieces = [bytes([int(b.id_to_piece(i)[3:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in range(len(b))]
        self.b_bytes = _Entries([b"" if b.is_control(i) or b.is_unknown(i) else p for i, p in enumerate(pieces)])
        #: The decimal of each id and what may follow it in the text of groups.
        self.a_names = _Entries([f"{i}{end}".encode() for end in ",|" for i in range(len(self.a_bytes.sizes))])
        self.b_names = _Entries([f"{i}{end}".encode() for end in ",;" for i in range(len(b))])

    def tokens(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of both sides of each text; none if the text is empty or a side does not spell its bytes."""
        none = np.empty(0, np.int64)
        found = []
        for text, b in zip(texts, self.b.encode(texts, num_threads=1)):
            a, b = self.a(" " + text), np.array(b, np.int64)
            raw = np.frombuffer((" " + text).encode(), np.uint8)
            kept = text and np.array_equal(self.a_bytes.joined(a), raw) and np.array_equal(self.b_bytes.joined(b), raw)
            found.append((a, b) if kept else (none, none))
        return found


_PAIRS: dict[tuple[str, str], TokenizerPair] = {}


def _pair(byte_path: str, piece_path: str) -> TokenizerPair:
    """The two tokenizers, once a worker process."""
    if (byte_path, piece_path) not in _PAIRS:
        _PAIRS[byte_path, piece_path] = TokenizerPair(byte_path, piece_path)
    return _PAIRS[byte_path, piece_path]


def _before(ends: np.ndarray, size: int) -> np.ndarray:
    """How many of the rising ``ends`` are less than each place from 0 to ``size``."""
    marks = np.zeros(size + 2, np.int64)
    marks[ends + 1] = 1
    return np.cumsum(marks)[:-1]


def components(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group of each token of both sides, from 0 in order, by pointer jumping over rising end places with the same last one."""
    if not len(a_ends):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    # the farthest overlapping token of the other side holds this token's last byte: the first that does not end before it
    size = int(a_ends[-1])
    over_a, over_b = _before(b_ends, size)[a_ends], _before(a_ends, size)[b_ends]
    own = np.arange(len(a_ends))
    points = np.concatenate([np.where(b_ends[over_a] > a_ends, over_a + len(own), own), over_b])
    while True:
        farther = points[points]
        if np.array_equal(farther, points):
            break
        points = farther
    last = np.zeros(len(own), bool)
    last[points] = True
    groups = (np.cumsum(last) - 1)[points]
    return groups[: len(own)], groups[len(own) :]


def links(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the two tokens of every overlapping pair, in order: one pair for each stretch between neighbouring ends."""
    if not len(a_ends):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    size = int(a_ends[-1])
    marks = np.zeros(size + 1, bool)
    marks[a_ends] = marks[b_ends] = True
    ends = np.flatnonzero(marks)
    return _before(a_ends, size)[ends], _before(b_ends, size)[ends]


class Part:
    """Aligned texts: keys, and the tokens of both sides of all texts on one line of bytes."""

    def __init__(self, pair: TokenizerPair, keys: pa.Array, texts: list[str]):
        found = pair.tokens(texts)
        self.pair, self.keys = pair, keys
        self.a, self.b = (np.concatenate([f[side] for f in found]) for side in (0, 1))
        #: Tokens of each side up to the end of each text, from 0.
        self.a_cuts, self.b_cuts = (np.concatenate([[0], np.cumsum([len(f[side]) for f in found])]) for side in (0, 1))
        self.a_ends, self.b_ends = np.cumsum(pair.a_bytes.sizes[self.a]), np.cumsum(pair.b_bytes.sizes[self.b])
        self.a_group, self.b_group = components(self.a_ends, self.b_ends)
        self.group_cuts = np.concatenate([[0], self.a_group + 1])[self.a_cuts]

    def arrays(self) -> list[pa.Array]:
        """The lists of each text in the order of _ARRAYS, bytes and groups counted from its start."""
        places, out = np.concatenate([[0], self.a_ends])[self.a_cuts], []
        zero = np.zeros(len(places), np.int64)
        for a, b, since in ((self.a, self.b, zero), (self.a_ends, self.b_ends, places), (self.a_group, self.b_group, self.group_cuts)):
            for values, cuts in ((a, self.a_cuts), (b, self.b_cuts)):
                own = values - np.repeat(since[:-1], np.diff(cuts))
                out.append(pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(own, pa.int32())))
        return out

    def group_texts(self) -> list[bytes]:
        """The groups of each text: ids of a, a bar, ids of b; a semicolon between groups."""
        numbers = np.zeros(len(self.a) + len(self.b), np.int64)
        ends_a, ends_b = np.ones(len(self.a), np.int64), np.ones(len(self.b), np.int64)
        ends_a[:-1], ends_b[:-1] = np.diff(self.a_group), np.diff(self.b_group)
        groups = int(self.group_cuts[-1])
        in_a, in_b = np.bincount(self.a_group, minlength=groups), np.bincount(self.b_group, minlength=groups)
        before_a, before_b = np.cumsum(in_a), np.cumsum(in_b) - in_b
        at_a, at_b = np.arange(len(self.a)) + before_b[self.a_group], np.arange(len(self.b)) + before_a[self.b_group]
        # both tables hold an id with its comma first, then with the other end
        size = len(self.pair.a_names.sizes)
        numbers[at_a] = self.a + ends_a * (size // 2)
        numbers[at_b] = size + self.b + ends_b * (len(self.pair.b_names.sizes) // 2)
        a_names, b_names = self.pair.a_names, self.pair.b_names
        data, starts = np.concatenate([a_names.data, b_names.data]), np.concatenate([a_names.starts, b_names.starts + len(a_names.data)])
        sizes = np.concatenate([a_names.sizes, b_names.sizes])
        flat = common.gathered(data, starts, sizes, numbers).tobytes()
        cuts = np.concatenate([[0], np.cumsum(sizes[numbers])])[self.a_cuts + self.b_cuts]
        return [flat[a : max(a, b - 1)] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]

    def carried(self) -> pa.StructArray:
        """What a row keeps of each text besides its links."""
        told = [hashlib.sha256(t).hexdigest() if t else "" for t in self.group_texts()]
        sizes = [pa.array(np.diff(cuts), pa.int64()) for cuts in (self.a_cuts, self.b_cuts, self.group_cuts)]
        return pa.StructArray.from_arrays([self.keys, *sizes, pa.array(told, pa.string())], _CARRIED)

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """The (a, b) of every link in order, as one number, and the links of each text."""
        at_a, at_b = links(self.a_ends, self.b_ends)
        until = np.concatenate([[0], np.flatnonzero(np.diff(at_a, append=-1)) + 1])[self.a_cuts]  # links up to the end of each text's tokens
        return self.a[at_a] << 32 | self.b[at_b], np.diff(until)


def _parts(batches: Iterator, byte_path: str, piece_path: str) -> Iterator[Part]:
    pair = _pair(byte_path, piece_path)
    for block in common.byte_blocks(batches, TEXT_BYTES, 1):
        yield Part(pair, block.column(0), [t or "" for t in block.column(1).to_pylist()])


def _texts(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, str]:
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows, rows.schema["doc_id"].dataType.simpleString()


def align(docs: DataFrame, byte_path: str, piece_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, a_ids, b_ids, a_ends, b_ends, a_group, b_group) of every row: tokens of both sides in order.

    Ends are bytes of a space and the text; a group's number counts from 0 in the text. Special tokens' strings are plain text. A null or
    empty text has no tokens, nor has one whose bytes a side does not give back (such as one that holds the space mark
    itself). Repeated rows repeat; a null key stays null. Other columns are ignored.
    """

    def run(batches: Iterator) -> Iterator:
        for part in _parts(batches, byte_path, piece_path):
            yield pa.RecordBatch.from_arrays([part.keys, *part.arrays()], ["doc_id", *_ARRAYS])

    rows, kind = _texts(docs, key, text)
    return common.in_batches(rows, run, f"doc_id {kind}, " + ", ".join(f"{name} array<int>" for name in _ARRAYS))


def _packed(codes: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(codes.astype("<u4").tobytes())


def _unpacked(raw: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(raw), "<u4")


def _blocks(rows: DataFrame, kind: str, byte_path: str, piece_path: str) -> DataFrame:
    """(block, rows, links, codes, pairs): texts with their links as places in the block's distinct (a, b, n)."""

    def block(number: int, rows: list, linked: list, sizes: list) -> pa.RecordBatch:
        pairs, codes, n = np.unique(np.concatenate(linked), return_inverse=True, return_counts=True)
        order = np.argsort(-n, kind="stable")  # frequent pairs get small numbers
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        columns = [pa.array((pairs >> 32)[order], pa.int32()), pa.array((pairs & 0xFFFFFFFF)[order], pa.int32()), pa.array(n[order], pa.int64())]
        table, texts = pa.StructArray.from_arrays(columns, ["a", "b", "n"]), pa.concat_arrays(rows)
        columns = [
            pa.array([number]),
            pa.ListArray.from_arrays(pa.array([0, len(texts)], pa.int32()), texts),
            pa.array([np.concatenate(sizes)], pa.list_(pa.int64())),
            pa.array([_packed(place[codes])], pa.binary()),
            pa.ListArray.from_arrays(pa.array([0, len(table)], pa.int32()), table),
        ]
        return pa.RecordBatch.from_arrays(columns, ["block", "rows", "links", "codes", "pairs"])

    def run(batches: Iterator) -> Iterator:
        number, held = TaskContext.get().partitionId() << 32, 0
        rows, linked, sizes = [], [], []
        for part in _parts(batches, byte_path, piece_path):
            rows.append(part.carried())
            for into, found in zip((linked, sizes), part.links()):
                into.append(found)
            held += len(linked[-1])
            if held >= BLOCK_LINKS:
                yield block(number, rows, linked, sizes)
                number, held = number + 1, 0
                rows, linked, sizes = [], [], []
        if rows:
            yield block(number, rows, linked, sizes)

    fields = f"doc_id: {kind}, n_a: long, n_b: long, n_groups: long, groups_sha256: string"
    schema = f"block long, rows array<struct<{fields}>>, links array<long>, codes binary, pairs array<struct<a: int, b: int, n: long>>"
    return common.in_batches(rows, run, schema)


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(a, b, count, best): links of each id pair in the corpus, and whether no other pair of b has more."""
    each = blocks.select(F.inline("pairs")).groupBy("a", "b").agg(F.sum("n").alias("count"))
    each = materialize(each, "pair-counts")
    most = each.groupBy("b").agg(F.max("count").alias("most"))  # a row for each id of the second vocabulary
    return each.join(most, "b").select("a", "b", "count", (F.col("count") == F.col("most")).alias("best"))


def link_scores(docs: DataFrame, byte_path: str, piece_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, groups_sha256, n_links, n_best, count_sum) of every row, aligned as by ``align``.

    A link is a pair of overlapping tokens; ``count_sum`` adds up how often the id pair of each is linked in the whole
    corpus, ``n_best`` counts the links with the highest such count of their b id, ties included. ``groups_sha256`` is of the ids
    by group (``group_texts``). Texts without tokens have zeros and an empty hash.
    """
    rows, kind = _texts(docs, key, text)
    blocks = materialize(_blocks(rows, kind, byte_path, piece_path), "links")
    uses = blocks.select(F.col("block").alias("home"), F.posexplode("pairs").alias("at", "pair")).select("home", "at", "pair.a", "pair.b")
    known = uses.join(pair_counts(blocks), ["a", "b"]).select("home", "at", "count", "best")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        at = right.column("at").to_numpy()
        count, best = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        count[at], best[at] = right.column("count").to_numpy(), right.column("best").to_numpy().astype(np.int64)
        codes, sizes = _unpacked(left.column("codes")[0].as_py()), left.column("links")[0].values.to_numpy()
        edges = np.concatenate([[0], np.cumsum(sizes)])
        sums = [np.diff(np.concatenate([[0], np.cumsum(x[codes])])[edges]) for x in (best, count)]
        rows = left.column("rows")[0].values
        return pa.Table.from_arrays([*rows.flatten(), *(pa.array(x, pa.int64()) for x in (sizes, *sums))], [*_CARRIED, "n_links", "n_best", "count_sum"])

    schema = f"doc_id {kind}, n_a long, n_b long, n_groups long, groups_sha256 string, n_links long, n_best long, count_sum long"
    both = blocks.select("block", "rows", "links", "codes").groupBy("block").cogroup(known.groupBy("home"))
    return both.applyInArrow(run, schema)

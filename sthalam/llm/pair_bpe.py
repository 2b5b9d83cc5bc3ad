"""Byte-level BPE of a whole corpus by a pair occurrence index.

All distinct pieces of a partition's block lie in one flat array of token ids with links to their neighbours. An index maps
the rank of each mergeable pair to all its positions; the active ranks are applied in ascending order, each to all its
positions at once, and the pairs that arise beside a merge are entered under their own, always later, ranks.
"""

from __future__ import annotations

import functools
import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKENIZERS = "/opt/tokenizers"
#: The split before the merges, as the public tokenizer's README gives it (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Characters of text that are encoded together.
BLOCK_CHARS = 16_000_000
#: Distinct pieces that a task keeps; beyond it the store is emptied and pieces are encoded again.
KEPT_PIECES = 2_000_000


def _byte_letters() -> dict[str, int]:
    """The printable stand-in of every byte in the vocabulary file: printable Latin-1 stays, the rest follows from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class PairIndexEncoder:
    """Encodes pieces of bytes; `merges` in order of rank."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]]):
        letters = _byte_letters()
        self.of_byte = np.zeros(256, np.int64)
        for letter, b in letters.items():
            self.of_byte[b] = vocab[letter]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in merges], np.int64)
        made = np.array([vocab[a + b] for a, b in merges], np.int64)
        order = np.argsort(keys, kind="stable")
        self.sorted_keys, self.rank_at = keys[order], order
        self.left, self.right, self.made = keys >> 32, keys & 0xFFFFFFFF, made
        self.store: dict[str, int] = {}
        self._reset()

    def _reset(self) -> None:
        self.store.clear()
        self.flat, self.starts, self.sizes = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of each pair, -1 where it has none."""
        key = a << 32 | b
        at = np.searchsorted(self.sorted_keys, key)
        at[at == len(self.sorted_keys)] = 0
        return np.where(self.sorted_keys[at] == key, self.rank_at[at], -1)

    def encode_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces, end to end, and each piece's number of ids."""
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        n = int(sizes.sum())
        if not n:
            return np.zeros(0, np.int32), sizes
        tok = self.of_byte[np.frombuffer(b"".join(pieces), np.uint8)]
        owner = np.repeat(np.arange(len(pieces)), sizes)
        nxt, prv = np.arange(1, n + 1), np.arange(-1, n - 1)
        ends = np.cumsum(sizes)[sizes > 0]
        nxt[ends - 1] = -1
        prv[np.concatenate([[0], ends[:-1]])] = -1
        alive = np.ones(n, bool)
        index: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def enter(left: np.ndarray) -> None:
            """Puts the pairs that begin at `left` under their ranks."""
            r = self._ranks(tok[left], tok[nxt[left]])
            left, r = left[r >= 0], r[r >= 0]
            if not len(left):
                return
            if len(left) == 1:
                groups = [(int(r[0]), left)]
            else:
                order = np.argsort(r, kind="stable")
                left, r = left[order], r[order]
                cuts = np.flatnonzero(np.diff(r)) + 1
                groups = zip(r[np.concatenate([[0], cuts])].tolist(), np.split(left, cuts), strict=True)
            for rank, at in groups:
                if rank in index:
                    index[rank].append(at)
                else:
                    index[rank] = [at]
                    heapq.heappush(active, rank)

        enter(np.flatnonzero(nxt >= 0))
        while active:
            rank = heapq.heappop(active)
            lists = index.pop(rank)
            p = lists[0] if len(lists) == 1 else np.unique(np.concatenate(lists))
            a, b = self.left[rank], self.right[rank]
            p = p[alive[p] & (tok[p] == a) & (nxt[p] >= 0)]
            p = p[tok[nxt[p]] == b]
            if a == b and len(p) > 1:  # in a run of one token every second pair is taken, from the left
                p = np.sort(p)
                keep, last = np.ones(len(p), bool), -1
                for i, at in enumerate(p.tolist()):
                    if at == last:
                        keep[i] = False
                        last = -1
                    else:
                        last = int(nxt[at])
                p = p[keep]
            if not len(p):
                continue
            q = nxt[p]
            after = nxt[q]
            tok[p] = self.made[rank]
            alive[q] = False
            nxt[p] = after
            prv[after[after >= 0]] = p[after >= 0]
            before = prv[p]
            enter(np.unique(np.concatenate([before[before >= 0], p[after >= 0]])))
        return tok[alive].astype(np.int32), np.bincount(owner[alive], minlength=len(pieces))

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, end to end, and each text's number of ids; none for an empty or null text."""
        if len(self.store) > KEPT_PIECES:
            self._reset()
        find, store, new, seq, counts = _splitter().findall, self.store, [], [], []
        for text in texts:
            pieces = find(text) if text else ()
            counts.append(len(pieces))
            for piece in pieces:
                k = store.get(piece)
                if k is None:
                    k = store[piece] = len(store)
                    new.append(piece.encode("utf-8", "surrogatepass"))
                seq.append(k)
        if new:
            flat, sizes = self.encode_pieces(new)
            self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(sizes) - sizes])
            self.sizes = np.concatenate([self.sizes, sizes])
            self.flat = np.concatenate([self.flat, flat])
        s = np.array(seq, np.int64)
        size = self.sizes[s]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.flat[np.repeat(self.starts[s] - (ends - size), size) + np.arange(total)]
        return ids, _sums(size, np.array(counts, np.int64))


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The sum of each run of `counts` values."""
    upto = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(counts)
    return upto[ends] - upto[ends - counts]


@functools.cache
def _splitter() -> regex.Pattern:
    return regex.compile(PATTERN)


@functools.cache
def encoder(path: str) -> PairIndexEncoder:
    """One encoder for each worker and vocabulary file."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    return PairIndexEncoder(model["vocab"], [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]])


def _blocks(batches: Iterator[pa.RecordBatch], chars: int) -> Iterator[pa.Table]:
    held, size = [], 0
    for b in batches:
        held.append(b)
        size += b.nbytes
        if size >= chars:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def encode_corpus(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), *, out: str = "ids", path: str = f"{TOKENIZERS}/byte_bpe_50k.json", lengths_only: bool = False) -> DataFrame:
    """The columns `keep` and the ids of `text` by the tokenizer in `path`, without special tokens, in `out`.

    A null and an empty text have an empty array; a blank text is encoded like any other. Repeated rows and rows with a null
    key come out as often as they go in; other columns of the input, whatever their names, aren't read. An empty table gives
    an empty table. With `lengths_only`, `out` has the number of ids (bigint) and no ids leave the worker. There is no
    shuffle: each block of a partition is encoded where it is read.
    """
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    schema = ", ".join([*(f"`{k}` {kinds[k]}" for k in keep), f"`{out}` {'bigint' if lengths_only else 'array<int>'}"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for t in _blocks(batches, BLOCK_CHARS):
            ids, n = bpe.encode(t.column("__text").to_pylist())
            if lengths_only:
                made = pa.array(n, pa.int64())
            else:
                made = pa.LargeListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int64()), pa.array(ids, pa.int32())).cast(pa.list_(pa.int32()))
            yield from pa.table([*(t.column(f"__k{i}") for i in range(len(keep))), made], [*keep, out]).to_batches(max_chunksize=10_000)

    return df.select(*(F.col(f"`{k}`").alias(f"__k{i}") for i, k in enumerate(keep)), F.col(f"`{text}`").alias("__text")).mapInArrow(run, schema)

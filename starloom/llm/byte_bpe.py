"""Byte-level BPE encoding and decoding with a rank queue on a hierarchical bitmap.

The new pre-tokens of some texts stand side by side in one buffer, each a linked list of
parts. Every adjacent pair that the vocabulary joins waits in the bucket of its rank; a
two-level bitmap marks the ranks whose buckets are not empty, so the next rank is found
by two find-first-set steps, and its bucket is worked off from left to right. Each
position knows the rank of its present pair, so an entry whose pair was changed by another merge
is stale, and skipped. Should a merge give a pair of a lower rank, the rest of the bucket
waits until that one is done. A pre-token of n bytes takes O(n log n) steps, so one of a
million letters is no problem. Workers remember the ids of short pre-tokens: the recent
ones in a dictionary of bounded size, and those before in another.

The vocabulary is a parameter: the driver reads the rank file and broadcasts it
(its size is that of the file, whatever the input).

Cases: a null or empty text has no tokens, and the digests of nothing; repeated
rows are encoded one by one; other columns pass through, columns named like ours are
replaced.
"""

from __future__ import annotations

import base64
import gc
import hashlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from heapq import heappop, heappush
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .stage import left, release, ship

_REMEMBER = 1 << 18  # pre-tokens of a generation; there are two
_KEPT = 1 << 18  # pre-tokens that a worker keeps between tasks
_SHORT = 64  # bytes of a pre-token worth remembering
_TEXT = 1 << 20  # bytes of text that are encoded and sent on together, or a longer one alone
_BUFFER = 1 << 18  # bytes of pre-tokens that are merged together, or a longer one alone
_BIT = [1 << i for i in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    """A file of lines ``base64 rank``."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


class RankQueue:
    """Positions in buckets by rank; ``pop`` takes the leftmost of the lowest rank.

    Two levels of words of 256 bits and more: a bit of ``low`` is a rank, a bit of ``top`` a word
    that is not zero. An emptied queue is as good as new. ``Codec.merge_all`` pushes in place, as
    calls would take most of its time.
    """

    __slots__ = ("buckets", "low", "top")

    def __init__(self, ranks: int):
        self.buckets: dict[int, list[int]] = {}
        self.low = [0] * ((ranks >> 8) + 1)
        self.top = 0

    def fill(self, rank: int, positions: list[int]) -> None:
        """Put several positions into a bucket."""
        if positions:
            word = rank >> 8
            self.buckets.setdefault(rank, []).extend(positions)
            self.low[word] |= _BIT[rank & 255]
            self.top |= 1 << word

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is None:
            self.buckets[rank] = [position]
            word = rank >> 8
            self.low[word] |= _BIT[rank & 255]
            self.top |= 1 << word
        elif position > bucket[-1]:
            bucket.append(position)  # the largest may stand last in a heap
        else:
            heappush(bucket, position)

    def first(self) -> int | None:
        """The lowest rank that has a bucket."""
        top = self.top
        if not top:
            return None
        word = (top & -top).bit_length() - 1
        bits = self.low[word]
        return word << 8 | (bits & -bits).bit_length() - 1

    def take(self) -> tuple[int, list[int]] | None:
        """The lowest rank and its whole bucket."""
        rank = self.first()
        if rank is None:
            return None
        word = rank >> 8
        self.low[word] ^= _BIT[rank & 255]
        if not self.low[word]:
            self.top ^= 1 << word
        return rank, self.buckets.pop(rank)

    def pop(self) -> tuple[int, int] | None:
        """The leftmost position of the lowest rank."""
        rank = self.first()
        if rank is None:
            return None
        if len(self.buckets[rank]) == 1:
            return rank, self.take()[1][0]
        return rank, heappop(self.buckets[rank])


@dataclass
class Codec:
    """Encodes and decodes texts by the ranks of a vocabulary."""

    ranks: dict[bytes, int]
    pattern: str
    _tokens: dict[int, bytes] = field(default_factory=dict, repr=False)
    _recent: dict[str, tuple[int, ...]] = field(default_factory=dict, repr=False)
    _before: dict[str, tuple[int, ...]] = field(default_factory=dict, repr=False)

    def __post_init__(self) -> None:
        self._split = regex.compile(self.pattern)
        self._whole = not self._split.groups  # findall gives groups where there are any
        self._tokens = {rank: token for token, rank in self.ranks.items()}
        self._queue = RankQueue(max(self._tokens, default=0))
        self.decimal = {rank: str(rank) for rank in self._tokens}.__getitem__
        # ranks of single bytes and of pairs of them
        self._byte = np.full(256, -1, np.int64)
        self._pair = np.full(1 << 16, -1, np.int64)
        for token, rank in self.ranks.items():
            if len(token) == 1:
                self._byte[token[0]] = rank
            elif len(token) == 2:
                self._pair[token[0] << 8 | token[1]] = rank

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one pre-token."""
        return self.merge_all([piece])[0] if piece else []

    def merge_all(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of each of some pre-tokens, which are not empty."""
        rank_of = self.ranks.get
        whole = [rank_of(p) for p in pieces]
        parts = iter(self._merged([p for p, w in zip(pieces, whole, strict=True) if w is None]))
        return [next(parts) if w is None else [w] for w in whole]

    def _merged(self, pieces: list[bytes]) -> list[list[int]]:
        if not pieces:
            return []
        data = b"".join(pieces)
        n = len(data)
        sizes = np.array([len(p) for p in pieces])
        starts = np.cumsum(sizes) - sizes
        raw = np.frombuffer(data, np.uint8)
        single = self._byte[raw]
        if single.min() < 0:
            raise ValueError("the vocabulary lacks a single byte")
        edges = np.zeros(n + 1, np.uint8)
        edges[starts] = edges[n] = 1
        pairs = np.full(n, -1, np.int64)
        pairs[:-1] = self._pair[raw[:-1].astype(np.int64) << 8 | raw[1:]]
        pairs[starts[1:] - 1] = -1  # no pair reaches over the end of a piece
        links = np.arange(-1, n - 1)
        links[starts] = -1

        ids = single.tolist()  # of the part that starts here; -1 once it is merged away
        now = pairs.tolist()  # rank of the pair that starts here
        end = list(range(1, n + 1))  # of the part that starts here
        before = links.tolist()
        edge = edges.tobytes()
        queue, rank_of, bit = self._queue, self.ranks.get, _BIT
        buckets, low = queue.buckets, queue.low
        bucket_of, take = buckets.get, queue.take
        at = np.flatnonzero(pairs >= 0)
        order = at[np.argsort(pairs[at], kind="stable")]
        found, first = np.unique(pairs[order], return_index=True)
        for rank, some in zip(found.tolist(), np.split(order, first[1:]), strict=bool(len(order))):
            queue.fill(rank, some.tolist())
        while (taken := take()) is not None:
            rank, bucket = taken
            bucket.sort()
            for place, left in enumerate(bucket):
                if now[left] != rank:
                    continue  # stale: the part is gone, or its pair is another one now
                right = end[left]
                after = end[right]
                end[left] = after
                ids[left], ids[right], now[right] = rank, -1, -1
                least = rank
                if edge[after]:
                    now[left] = -1
                else:
                    before[after] = left
                    wider = rank_of(data[left : end[after]])
                    if wider is None:
                        now[left] = -1
                    else:
                        now[left] = wider
                        least = wider if wider < least else least
                        some = bucket_of(wider)
                        if some is not None:
                            some.append(left)
                        else:
                            buckets[wider] = [left]
                            low[wider >> 8] |= bit[wider & 255]
                            queue.top |= 1 << (wider >> 8)
                previous = before[left]
                if previous >= 0:
                    wider = rank_of(data[previous:after])
                    if wider is None:
                        now[previous] = -1
                    else:
                        now[previous] = wider
                        least = wider if wider < least else least
                        some = bucket_of(wider)
                        if some is not None:
                            some.append(previous)
                        else:
                            buckets[wider] = [previous]
                            low[wider >> 8] |= bit[wider & 255]
                            queue.top |= 1 << (wider >> 8)
                if least < rank:
                    queue.fill(rank, bucket[place + 1 :])
                    break
        left = [i for i in ids if i >= 0]
        counts = np.add.reduceat(np.array(ids) >= 0, starts, dtype=np.int64)
        ends = np.cumsum(counts).tolist()
        return [left[e - c : e] for c, e in zip(counts.tolist(), ends, strict=True)]

    def encode_all(self, texts: Iterable[str | None]) -> list[list[int]]:
        """Ids of each text."""
        split = self._split
        if self._whole:
            tokens = [split.findall(t) if t else [] for t in texts]
        else:
            tokens = [[m[0] for m in split.finditer(t)] if t else [] for t in texts]
        known = self._recent
        new = set().union(*tokens).difference(known)
        long = []
        for token in [t for t in new if t in self._before]:
            known[token] = self._before[token]
            new.discard(token)
        new.discard("")
        some = list(new)
        pieces = [t.encode("utf-8", "replace") for t in some]
        at = 0
        while at < len(some):
            upto, size = at, 0
            while upto < len(some) and (upto == at or size + len(pieces[upto]) <= _BUFFER):
                size += len(pieces[upto])
                upto += 1
            for token, piece, ids in zip(
                some[at:upto], pieces[at:upto], self.merge_all(pieces[at:upto]), strict=True
            ):
                known[token] = tuple(ids)
                if len(piece) > _SHORT:
                    long.append(token)
            at = upto
        known[""] = ()
        of = known.__getitem__
        out = [list(chain.from_iterable(map(of, t))) for t in tokens]
        for token in long:
            del known[token]
        if len(known) >= _REMEMBER:
            self._before, self._recent = known, {}
        return out

    def forget(self) -> None:
        """Keep the pre-tokens of the last generation, those that came first, which are the frequent
        ones, and fill up with the one before: a worker that waits, or does other work, holds no
        more than these."""
        known = chain(self._recent.items(), self._before.items())
        self._recent, self._before = dict(islice(known, _KEPT)), {}

    def encode(self, text: str | None) -> list[int]:
        return self.encode_all([text])[0]

    def decode(self, ids) -> bytes:
        return b"".join(map(self._tokens.__getitem__, ids))


_NAME = "byte_bpe"


def _codec(ranks: dict[bytes, int], pattern: str) -> Codec:
    """This worker's codec; the tasks it runs share what it remembers, until another operator's
    task runs here."""
    return left(_NAME, lambda c: c.pattern == pattern and c.ranks == ranks, lambda: Codec(ranks, pattern))


def _slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Starts and sizes of runs of texts of about ``_TEXT`` bytes together."""
    lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    number = np.cumsum(lengths.astype(np.int64) + 1) // _TEXT
    if not len(number):
        return
    starts = np.flatnonzero(np.r_[True, number[1:] != number[:-1]])
    for start, end in zip(starts, [*starts[1:], len(number)], strict=True):
        yield int(start), int(end - start)


def _coded(docs: DataFrame, text: str, ranks: dict[bytes, int], pattern: str, kept: list[str],
           schema: T.StructType, rows: Callable[[Codec, list], list[pa.Array]]) -> DataFrame:
    """The columns ``kept`` and those that ``rows`` makes of some texts, a few megabytes at a time:
    batches come by the ten thousand, and the ids of so many long texts would fill a worker."""
    ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast((ranks, pattern))
    names = [f"c{i}" for i in range(len(kept))]
    fields = [T.StructField(n, docs.schema[c].dataType) for n, c in zip(names, kept, strict=True)]
    columns = [*names, *schema.names]

    def code(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(*sent.value)
        gc.disable()  # nothing here is in a cycle, and a million tuples take long to look through
        try:
            for batch in batches:
                for start, size in _slices(batch.column(len(names))):
                    *own, texts = batch.slice(start, size).columns
                    yield pa.RecordBatch.from_arrays([*own, *rows(codec, texts.to_pylist())], columns)
        finally:
            codec.forget()
            gc.enable()
            release(_NAME)

    chosen = [F.col(f"`{c}`").alias(n) for c, n in zip(kept, names, strict=True)]
    found = docs.select(*chosen, F.col(f"`{text}`").alias("t"))
    coded = found.mapInArrow(code, T.StructType([*fields, *schema.fields]))
    return coded.select(*[F.col(n).alias(c) for n, c in zip(names, kept, strict=True)], *schema.names)


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, *, text: str = "text") -> DataFrame:
    """The documents with ``ids`` (array of int) and ``decoded`` (bytes, from the ids)."""
    schema = T.StructType([
        T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.BinaryType())
    ])

    def rows(codec: Codec, texts: list) -> list[pa.Array]:
        ids = codec.encode_all(texts)
        return [pa.array(ids, pa.list_(pa.int32())), pa.array([codec.decode(i) for i in ids], pa.binary())]

    kept = [c for c in docs.columns if c.lower() not in ("ids", "decoded")]
    return _coded(docs, text, ranks, pattern, kept, schema, rows)


def digests(docs: DataFrame, ranks: dict[bytes, int], pattern: str, *, key: str = "doc_id",
            text: str = "text") -> DataFrame:
    """Per document ``key, n_tokens, ids_sha256, decoded_sha256``.

    The digests are made beside the ids, so that neither ids nor bytes leave the task.
    """
    schema = T.StructType([
        T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
    ])

    def rows(codec: Codec, texts: list) -> list[pa.Array]:
        found = []
        for ids in codec.encode_all(texts):
            joined = ",".join(map(codec.decimal, ids)).encode()
            decoded = hashlib.sha256(codec.decode(ids)).hexdigest()
            found.append((len(ids), hashlib.sha256(joined).hexdigest(), decoded))
        kinds = (pa.int64(), pa.string(), pa.string())
        return [pa.array(c, k) for c, k in zip(zip(*found, strict=True), kinds, strict=True)]

    return _coded(docs, text, ranks, pattern, [key], schema, rows)

"""Byte-level BPE by merge replay over a block of distinct words, and back to bytes.

A block's texts are split as the tokenizer's pattern does (see ``pieces``);
each distinct piece not met before becomes a chain of symbols.  An inverted index holds, for every
token that two neighbours can form, the positions of the left neighbours.
Tokens are taken in rank order; each merge touches its two neighbours only,
which enter the index again.  The ids of a text are the ids of its pieces in
order; decoding joins the bytes of the ids.

Pieces are independent, so a replay over many of them at once gives what the
piecewise encoder gives: the lowest rank first, leftmost first within a piece.
A piece that is itself a token is that token, as the library has it.

Memory: the pieces of one block, and a cache of encoded pieces of at most
``CACHE_PIECES`` entries, emptied when full (results don't depend on it).
Pieces are told apart by a 64-bit hash of their characters and length.

Defined cases: null and empty text give no ids and the hash of no bytes; text
that is one run without spaces is one piece; repeated rows give repeated rows;
an empty table gives no rows; extra input columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from dvspark.llm.blocks import row_blocks, text_buffers
from dvspark.llm.pieces import PieceBlock, PieceStore, explicit

CACHE_PIECES = 1_000_000
#: Bytes of text whose new pieces are replayed together.
REPLAY_BYTES = 4 << 20

def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(None, map(bytes.strip, lines)))}


class MergeReplay:
    """Applies a rank table to many byte strings at once."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.token = {rank: piece for piece, rank in ranks.items()}
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        self.pairs: dict[int, int] = {}

    def _formed(self, code: int) -> int:
        """Token that the pair a << 32 | b forms, or -1."""
        found = self.ranks.get(self.token[code >> 32] + self.token[code & 0xFFFFFFFF], -1)
        if len(self.pairs) > 2 * CACHE_PIECES:
            self.pairs.clear()
        self.pairs[code] = found
        return found

    def _enter(self, index: dict, waiting: list[int], at: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Adds the pairs (a, b) at their positions to the index; the token that each forms, or -1."""
        code, inverse = np.unique(a << 32 | b, return_inverse=True)
        known = self.pairs
        formed = np.array([known[c] if c in known else self._formed(c) for c in code.tolist()], dtype=np.int64)[inverse]
        order = np.argsort(formed, kind="stable")
        order = order[np.searchsorted(formed[order], 0) :]
        ranks = formed[order]
        cuts = [0, *(np.flatnonzero(np.diff(ranks)) + 1).tolist(), len(ranks)]
        for first, last in zip(cuts, cuts[1:], strict=False):
            if first == last:
                continue
            rank, part = int(ranks[first]), order[first:last]
            if rank not in index:
                index[rank] = []
                heapq.heappush(waiting, rank)
            index[rank].append((at[part], a[part], b[part]))
        return formed

    def encode(self, pieces: list[bytes]) -> list[np.ndarray]:
        """The ids of each piece."""
        sizes = np.array([len(p) for p in pieces], dtype=np.int64)
        ends = np.cumsum(sizes)
        n = int(ends[-1]) if len(ends) else 0
        symbol = self.byte[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        after[ends[sizes > 0] - 1] = -1
        before[(ends - sizes)[sizes > 0]] = -1
        index: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}
        waiting: list[int] = []
        at = np.flatnonzero(after >= 0)
        if len(at):
            self._enter(index, waiting, at, symbol[at], symbol[at + 1])
        again: list[np.ndarray] = []
        while waiting:
            rank = heapq.heappop(waiting)
            entries = index.pop(rank)
            i, a, b = (np.concatenate(x) for x in zip(*entries, strict=True)) if len(entries) > 1 else entries[0]
            j = after[i]
            i = np.unique(i[(symbol[i] == a) & (j >= 0) & (symbol[j] == b)])  # else a neighbour has merged meanwhile
            if not len(i):
                continue
            j = after[i]
            chained = np.zeros(len(i), dtype=bool)
            chained[1:] = j[:-1] == i[1:]
            if chained.any():
                # Pairs that share a symbol: leftmost first, so every second one of a chain.
                place = np.arange(len(i))
                i = i[(place - np.maximum.accumulate(np.where(chained, 0, place))) % 2 == 0]
                j = after[i]
            right = after[j]
            symbol[i], symbol[j] = rank, -1
            after[i] = right
            before[right[right >= 0]] = i[right >= 0]
            left = before[i]
            l, r = left >= 0, right >= 0
            touched = np.concatenate([left[l], i[r]])
            if len(touched):
                formed = self._enter(index, waiting, touched, symbol[touched], symbol[after[touched]])
                early = (formed >= 0) & (formed < rank)
                if early.any():
                    again.append(touched[early])
        keep = symbol >= 0
        ids = symbol[keep].astype("<u4")
        marks = np.concatenate([[0], np.cumsum(keep)])
        cuts = marks[np.concatenate([[0], ends])].tolist() if len(ends) else [0]
        out = [ids[x:y] for x, y in zip(cuts, cuts[1:], strict=False)]
        # A merge that made a token of lower rank possible comes before the rest of its own rank: one by one.
        for k in np.unique(np.searchsorted(ends, np.concatenate(again), side="right")).tolist() if again else []:
            out[k] = self._one_by_one(pieces[k])
        for k, piece in enumerate(pieces):
            whole = self.ranks.get(piece)
            if whole is not None:
                out[k] = np.array([whole], dtype="<u4")
        return out

    def _one_by_one(self, piece: bytes) -> np.ndarray:
        parts = [piece[i : i + 1] for i in range(len(piece))]
        never = 1 << 62
        while len(parts) > 1:
            rank, i = min((self.ranks.get(x + y, never), i) for i, (x, y) in enumerate(zip(parts, parts[1:], strict=False)))
            if rank == never:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return np.array([self.ranks[p] for p in parts], dtype="<u4")


class BlockEncoder:
    """Encodes blocks of texts, and decodes blocks of ids."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.replay = MergeReplay(ranks)
        self.exact = explicit(pattern)
        self.store = PieceStore(lambda new: self.replay.encode([p.encode() for p in new]), "<u4", CACHE_PIECES)
        tokens = [self.replay.token.get(i, b"") for i in range(max(self.replay.token) + 1)]
        self.flat = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        self.begin = np.concatenate([[0], np.cumsum([len(t) for t in tokens])])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in order, and where each text's begin."""
        block = PieceBlock(texts, attach=True, single=False, exact=self.exact)
        ids, out = self.store.values(block)
        return ids, out[block.first]

    def decode(self, ids: np.ndarray) -> bytes:
        begin, size = self.begin[ids], self.begin[ids + np.uint32(1)]
        size = size - begin
        out = np.cumsum(size)
        index = np.repeat(begin - (out - size), size) + np.arange(out[-1] if len(out) else 0)
        return self.flat[index].tobytes()


_encoders: dict[int, BlockEncoder] = {}


def _encoder(ranks: dict[bytes, int], pattern: str) -> BlockEncoder:
    """One per worker and table: tasks that follow find the pieces of those before."""
    key = hash((pattern, len(ranks), *sorted(ranks.items())[:: max(1, len(ranks) // 97)]))
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = BlockEncoder(ranks, pattern)
    return _encoders[key]


def bpe_round_trip(docs: DataFrame, ranks: dict[bytes, int], pattern: str, keep_ids: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids (binary, if kept), ids_sha256, decoded_sha256 of every row of ``docs``.

    ``ranks`` is the tokenizer's own table, of fixed size; it goes to the
    workers with the function.  No shuffle: each task encodes its rows.
    """
    fields = [("doc_id", pa.int64()), ("n_tokens", pa.int64()), *([("ids", pa.binary())] if keep_ids else []), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    table = docs.sparkSession.sparkContext.broadcast((ranks, pattern))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(*table.value)
        sha = lambda b: hashlib.sha256(b).hexdigest()
        for batch in batches:
            _, offsets = text_buffers(batch.column(1))
            for first, last in row_blocks(offsets, REPLAY_BYTES):
                part = batch.slice(first, last - first)
                flat, begin = encoder.encode([t or "" for t in part.column(1).to_pylist()])
                ids = [flat[a:b] for a, b in zip(begin, begin[1:], strict=False)]
                columns = {"doc_id": part.column(0).cast(pa.int64()), "n_tokens": pa.array(np.diff(begin), pa.int64()), "ids": pa.array([x.tobytes() for x in ids], pa.binary()) if keep_ids else None, "ids_sha256": pa.array([sha(x.tobytes()) for x in ids], pa.string()), "decoded_sha256": pa.array([sha(encoder.decode(x)) for x in ids], pa.string())}
                yield pa.RecordBatch.from_arrays([columns[n] for n, _ in fields], schema=pa.schema(fields))

    schema = "doc_id long, n_tokens long, " + "ids binary, " * keep_ids + "ids_sha256 string, decoded_sha256 string"
    return docs.select("doc_id", "text").mapInArrow(run, schema)

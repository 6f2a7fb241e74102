"""Exact token counts at every prefix of a text, by dynamic programming over prefixes.

For a word-end BPE tokenizer file (``tokenizers`` JSON: NFC, white space to
blanks, lower case, split by pattern, byte-level alphabet, ``</w>`` closing
each word).  Within a word, the last token of the encoding of a prefix is the
one token t such that t ends there, is its own encoding, and stands next to the
last token of the prefix before it as the encoder itself would leave the two:
count(prefix) = count(prefix without t) + 1.  A prefix that is cut off is
closed by a token with the word end, chosen the same way.  Words are
independent, so the count at any prefix of a text is the count of the whole
words before it plus that of the cut word.

Stored per text: one signed byte for each character of the normalised text,
the change of the count from the prefix before it.  Their running sum answers
"how many tokens has this prefix" and "where does the budget end" without
encoding again.  The strings of special tokens are one token each wherever
they stand, and are not cut: all their prefixes count the token.

Memory: a block of texts, and caches of at most ``CACHE_WORDS`` entries,
emptied when full (results don't depend on it).

Defined cases: null and empty text have no prefix and 0 tokens; white space
has none either; a text that is one long word takes time in proportion to its
length; repeated rows give repeated rows; an empty table gives no rows; extra
input columns are ignored.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from dvspark.llm.blocks import row_blocks, text_buffers
from dvspark.llm.pieces import PieceBlock, PieceStore, explicit

CACHE_WORDS = 1_000_000
_NEVER = 1 << 30
BLOCK = 6 << 20


def byte_alphabet() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordEndBpe:
    """Prefix counts of single words under a merge table with word ends."""

    def __init__(self, vocabulary: set[str], merges: list[tuple[str, str]], end: str):
        self.vocabulary, self.end = vocabulary, end
        self.rank = {pair: k for k, pair in enumerate(merges)}
        self.letters = byte_alphabet()
        self.longest = max(map(len, vocabulary))
        self.rows: dict[str, tuple[str, dict[str, bool], dict[str, bool]]] = {}
        self.made: dict[str, tuple[str, str]] = {}
        for pair in merges:
            self.made.setdefault(pair[0] + pair[1], pair)
        self.spines: tuple[dict, dict] = ({}, {})
        # Tokens that are their own encoding, by their text; those with the word end stand apart.
        self.inner = {t for t in vocabulary if not t.endswith(end) and self._merged([*t]) == [t]}
        self.closing = {t[: -len(end)] for t in vocabulary if t.endswith(end) and len(t) > len(end) and self._merged([*t[: -len(end)][:-1], t[-len(end) - 1] + end]) == [t]}

    def _merged(self, parts: list[str]) -> list[str]:
        rank = self.rank
        while len(parts) > 1:
            best, at = min((rank.get(pair, _NEVER), i) for i, pair in enumerate(zip(parts, parts[1:], strict=False)))
            if best == _NEVER:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _spine(self, token: str, side: int) -> list[tuple[str, int]]:
        """What stands at the token's left (0) or right (1) edge while it is made, each with the rank of the merge that takes it."""
        found = self.spines[side].get(token)
        if found is None:
            made = self.made.get(token)
            if made is None:
                found = [(token, _NEVER)]
            else:
                below = self._spine(made[side], side)
                found = [*below[:-1], (below[-1][0], self.rank[made]), (token, _NEVER)]
            self.spines[side][token] = found
        return found

    def _stands(self, a: str, b: str) -> bool:
        """Whether the encoder leaves a and b side by side.

        The merges of a's right edge and of b's left edge happen in rank order;
        the two stay apart if the pair at the border never comes first.  Of
        equal ranks the left one comes first.
        """
        rank, left, right, i, j = self.rank, self._spine(a, 1), self._spine(b, 0), 0, 0
        while True:
            (x, x_goes), (y, y_goes) = left[i], right[j]
            border = rank.get((x, y), _NEVER)
            if border < x_goes and border <= y_goes and border < _NEVER:
                return False
            if x_goes == y_goes == _NEVER:
                return True
            if x_goes <= y_goes:
                i += 1
            else:
                j += 1

    def _row(self, token: str) -> tuple[str, dict[str, bool], dict[str, bool]]:
        """A token, and which inner and closing tokens are known to stand behind it, or not."""
        found = self.rows.get(token)
        if found is None:
            found = self.rows[token] = (token, {}, {})
        return found

    def counts(self, words: list[str]) -> list[list[int]]:
        """For each word, the tokens of each of its non-empty prefixes, each closed by the word end.

        Words are taken in alphabetical order; what a word shares with the one
        before it is not counted again.
        """
        inner, closing, longest, end, letters, stands = self.inner, self.closing, self.longest, self.end, self.letters, self._stands
        if sum(len(row[1]) + len(row[2]) for row in self.rows.values()) > 4 * CACHE_WORDS:
            self.rows.clear()
        out: list[list[int]] = [[] for _ in words]
        # By position in the word: the last inner token up to it, how many there are, and the count if the word ended there.
        row, count, closed, text = [("", {}, {})], [0], {}, ""
        for k in sorted(range(len(words)), key=words.__getitem__):
            word, earlier = words[k], text
            text = "".join([letters[b] for b in word.encode("utf-8", "surrogatepass")])
            n, same = len(text), 0
            most = min(n, len(earlier))
            while same < most and text[same] == earlier[same]:
                same += 1
            del row[same + 1 :], count[same + 1 :]
            for i in range(len(row), n):
                for j in range(i - longest if i > longest else 0, i):
                    t = text[j:i]
                    if t in inner:
                        token, known, _ = row[j]
                        fits = j == 0 or known.get(t)
                        if fits is None:
                            fits = known[t] = stands(token, t)
                        if fits:
                            row.append(self._row(t))
                            count.append(count[j] + 1)
                            break
            cuts = range(1, n + 1) if n == len(word) else accumulate([len(c.encode("utf-8", "surrogatepass")) for c in word])
            mine = out[k]
            for i in cuts:
                if i <= same and i in closed:
                    mine.append(closed[i])
                    continue
                for j in range(i - longest if i > longest else 0, i):
                    t = text[j:i]
                    if t in closing:
                        token, _, known = row[j]
                        fits = j == 0 or known.get(t)
                        if fits is None:
                            fits = known[t] = stands(token, t + end)
                        if fits:
                            closed[i] = count[j] + 1
                            mine.append(closed[i])
                            break
        return out


class PrefixCounter:
    """Prefix counts of texts for one tokenizer file."""

    def __init__(self, spec: dict):
        model, split = spec["model"], next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.bpe = WordEndBpe(set(model["vocab"]), merges, model["end_of_word_suffix"])
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.exact = explicit(split["pattern"]["Regex"])
        self.store = PieceStore(self._changes, "i1", CACHE_WORDS)

    def _changes(self, words: list[str]) -> list[np.ndarray]:
        out = []
        for word, counts in zip(words, self.bpe.counts(words), strict=True):
            if len(word) == 3 and word in ("'re", "'ve", "'ll"):  # cut after the first letter it is two words
                counts[1] = counts[0] + self.bpe.counts([word[1]])[0][0]
            out.append(np.array([b - a for a, b in zip([0, *counts], counts, strict=False)], "i1"))
        return out

    @staticmethod
    def normalised(text: str) -> str:
        text = text if text.isascii() or unicodedata.is_normalized("NFC", text) else unicodedata.normalize("NFC", text)
        return text.replace("Σ", "σ").lower()

    def changes(self, texts: list[str]) -> list[np.ndarray]:
        """For each text, the change of the token count at each character of the normalised text."""
        parts, owner = [], []
        for k, text in enumerate(texts):
            found = self.special.split(text) if self.special and "<" in text else [text]
            parts += map(self.normalised, found)
            owner += [k] * len(found)
        block = PieceBlock(parts, attach=False, single=True, exact=self.exact)
        flat, _ = self.store.values(block)
        every = np.zeros(len(block.chars), "i1")
        size = block.ends - block.starts
        every[np.repeat(block.starts - np.cumsum(size) + size, size) + np.arange(len(flat))] = flat
        pieces: list[list[np.ndarray]] = [[] for _ in texts]
        for p, k in enumerate(owner):
            if pieces[k]:
                pieces[k].append(np.ones(1, "i1"))  # the special string between two parts
            pieces[k].append(every[block.bounds[p] : block.bounds[p + 1]])
        return [x[0] if len(x) == 1 else np.concatenate(x) for x in pieces]


def prefix_within(changes: np.ndarray, budget: int) -> int:
    """Characters of the longest prefix with at most ``budget`` tokens."""
    counts = np.cumsum(changes, dtype=np.int64)
    fits = np.flatnonzero(counts <= budget)
    return int(fits[-1]) + 1 if len(fits) else 0


_counters: dict[str, PrefixCounter] = {}


def prefix_counts(docs: DataFrame, tokenizer_json: str, budget: int, keep_changes: bool = True) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit, cut_chars and, if kept, ``changes`` (one signed byte a character).

    ``tokenizer_json`` is the file's content (of fixed size).  cut_chars: the
    normalised characters of the longest prefix within ``budget``.  No shuffle.
    """
    fields = [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_()), ("cut_chars", pa.int64()), *([("changes", pa.binary())] if keep_changes else [])]
    spec = docs.sparkSession.sparkContext.broadcast(tokenizer_json)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = str(hash(spec.value))
        if key not in _counters:
            _counters.clear()
            _counters[key] = PrefixCounter(json.loads(spec.value))
        counter = _counters[key]
        for batch in batches:
            _, offsets = text_buffers(batch.column(1))
            for first, last in row_blocks(offsets, BLOCK):
                part = batch.slice(first, last - first)
                changes = counter.changes([t or "" for t in part.column(1).to_pylist()])
                tokens = [int(c.sum(dtype=np.int64)) for c in changes]
                cut = [len(c) if n <= budget else prefix_within(c, budget) for c, n in zip(changes, tokens, strict=True)]
                columns = [part.column(0).cast(pa.int64()), pa.array(np.diff(offsets[first : last + 1]), pa.int64()), pa.array(tokens, pa.int64()), pa.array([n > budget for n in tokens], pa.bool_()), pa.array(cut, pa.int64())]
                columns += [pa.array([c.tobytes() for c in changes], pa.binary())] if keep_changes else []
                yield pa.RecordBatch.from_arrays(columns, schema=pa.schema(fields))

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean, cut_chars long" + ", changes binary" * keep_changes)

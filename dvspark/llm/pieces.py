"""Tokenizer pieces of a block of texts, found with array operations.

The usual byte-level BPE patterns split a text into runs of letters, digits,
other signs and white space, with a few contractions.  ``PieceBlock`` finds
those runs for a whole block at once; a text with characters whose class it
doesn't hold in its table is split by the pattern itself, piece by piece.
Equal pieces get equal 64-bit hashes, so only distinct ones become strings.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import regex

from dvspark.llm.blocks import _P, _P_INV, _power, mix

# \s of the libraries' pattern engines: the Unicode property White_Space.
WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_LETTER, _DIGIT, _OTHER, _SPACE = 0, 1, 2, 3
_KNOWN = 0x250


def _classes() -> np.ndarray:
    tests = [(_LETTER, regex.compile(r"\p{L}")), (_DIGIT, regex.compile(r"\p{N}")), (_SPACE, regex.compile(f"[{WHITE}]"))]
    return np.array([next((k for k, test in tests if test.match(chr(c))), _OTHER) for c in range(_KNOWN)], dtype=np.uint8)


_CLASS = _classes()


def explicit(pattern: str) -> Callable[[str], list[str]]:
    """findall() of a pattern with \\s spelled out."""
    return regex.compile(pattern.replace("[^\\s", f"[^{WHITE}").replace("\\S", f"[^{WHITE}]").replace("\\s", f"[{WHITE}]")).findall


class PieceBlock:
    """Pieces of some texts in order.

    attach: a space before a run belongs to it, and white space is pieces too
    (patterns that keep every character); else white space belongs to none.
    single: each digit is a piece of its own.
    exact: the pattern's findall, for texts with other characters; with
    ``attach`` its pieces tile the text, else they tile it but for white space.
    """

    def __init__(self, texts: list[str], attach: bool, single: bool, exact: Callable[[str], list[str]]):
        self.joined = "".join(texts)
        chars = np.frombuffer(self.joined.encode("utf-32-le", "surrogatepass"), dtype="<u4")
        n = len(chars)
        bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        self.bounds, self.chars = bounds, chars
        if n == 0:
            self.starts = self.ends = np.zeros(0, np.int64)
            self.first = np.zeros(len(bounds), np.int64)
            self.hash = np.zeros(0, np.uint64)
            return
        strange = chars >= _KNOWN
        kind = _CLASS[np.where(strange, 0, chars)]
        new_text = np.zeros(n + 1, dtype=bool)
        new_text[bounds] = True
        start = new_text[:n].copy()
        start[1:] |= kind[1:] != kind[:-1]
        run = np.flatnonzero(start)
        run_end = np.append(run[1:], n)
        if single:
            start |= kind == _DIGIT
        space = kind[run] == _SPACE
        inner = space & ~new_text[run_end]  # white space that something follows in its text
        tail = run_end[inner] - 1
        if attach:
            start[tail] = True
            blank = tail[chars[tail] == 0x20]
            start[blank + 1] = False
        # A quote alone between other runs, then letters: 's 't 'm 'd 're 've 'll.
        quote = run[(kind[run] == _OTHER) & (run_end - run == 1) & (chars[run] == 0x27)]
        quote = quote[start[quote] & ~new_text[quote + 1]] if len(quote) else quote
        if len(quote):
            a, b = chars[quote + 1], np.where(quote + 2 < n, chars[np.minimum(quote + 2, n - 1)], 0)
            b = np.where(new_text[np.minimum(quote + 2, n)], 0, b)
            one = np.isin(a, [ord(c) for c in "stmd"])
            two = ((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l")))
            for hit, length in ((one, 1), (two, 2)):
                at = quote[hit]
                start[at + 1] = False
                rest = at + 1 + length
                rest = rest[rest < n]
                start[rest[(kind[rest] == _LETTER) & ~new_text[rest]]] = True
        if strange.any():
            odd = np.unique(np.searchsorted(bounds, np.flatnonzero(strange), side="right") - 1)
            for k in odd.tolist():
                self._by_pattern(texts[k], int(bounds[k]), start, kind, exact)
        starts = np.flatnonzero(start)
        if attach:
            ends = np.append(starts[1:], n)
        else:
            ends = np.append(starts[1:], n)
            solid = kind[starts] != _SPACE
            starts, ends = starts[solid], ends[solid]
        self.starts, self.ends = starts, ends
        self.first = np.searchsorted(starts, bounds).astype(np.int64)
        values = chars.astype(np.uint64)
        values += np.uint64(1)
        values *= _power(_P, n)
        total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(values, out=total[1:])
        self.hash = mix((total[ends] - total[starts]) * _power(_P_INV, n)[starts] + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))

    @staticmethod
    def _by_pattern(text: str, base: int, start: np.ndarray, kind: np.ndarray, exact: Callable[[str], list[str]]) -> None:
        start[base : base + len(text)] = False
        kind[base : base + len(text)] = _OTHER
        at = 0
        for piece in exact(text):
            gap = text.find(piece, at) - at
            if gap:
                start[base + at] = True
                kind[base + at : base + at + gap] = _SPACE
                at += gap
            start[base + at] = True
            at += len(piece)
        if at < len(text):
            start[base + at] = True
            kind[base + at : base + len(text)] = _SPACE

    def text(self, k: int) -> str:
        return self.joined[self.starts[k] : self.ends[k]]


class PieceStore:
    """Numbers distinct pieces as they come, and keeps an array of values for each; emptied when full."""

    def __init__(self, make: Callable[[list[str]], list[np.ndarray]], dtype: str, limit: int):
        self.make, self.dtype, self.limit = make, dtype, limit
        self._clear()

    def _clear(self) -> None:
        self.number: dict[int, int] = {}
        self.flat = np.zeros(0, self.dtype)
        self.begin = np.zeros(1, np.int64)

    def values(self, block: PieceBlock) -> tuple[np.ndarray, np.ndarray]:
        """The pieces' values joined in order, and where each piece's begin."""
        if len(self.number) > self.limit:
            self._clear()
        hashes, where, inverse = np.unique(block.hash, return_index=True, return_inverse=True)
        number = self.number
        keys = hashes.tolist()
        found = [number.get(h, -1) for h in keys]
        numbers = np.array(found, dtype=np.int64)
        new = np.flatnonzero(numbers < 0)
        if len(new):
            made = self.make([block.text(k) for k in where[new].tolist()])
            have = len(self.begin) - 1
            numbers[new] = np.arange(have, have + len(new))
            number.update(zip((keys[k] for k in new.tolist()), range(have, have + len(new)), strict=True))
            self.flat = np.concatenate([self.flat, *made]) if made else self.flat
            self.begin = np.concatenate([self.begin, self.begin[-1] + np.cumsum([len(m) for m in made])])
        each = numbers[inverse]
        begin, size = self.begin[each], np.diff(self.begin)[each]
        out = np.concatenate([[0], np.cumsum(size)])
        index = np.repeat(begin - out[:-1], size) + np.arange(out[-1])
        return self.flat[index], out

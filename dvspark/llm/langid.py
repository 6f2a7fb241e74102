"""Language spans by Viterbi over per-word scores with a switching penalty.

Learning.  Character trigrams (with the word's ends) of lower-cased words are
counted by language in a table of ``BUCKETS`` hashed cells, summed up in Spark;
so is how often each language uses each script.  The driver gets at most
BUCKETS rows for each language, however large the corpus.

A word's score for a language is the sum of its trigrams' log-probabilities
(bounded by ``WORD_BOUND`` from the word's best language, so that one odd word
doesn't decide).  Its script, by Unicode range, narrows the candidates to the
languages that write in it; a script that no language uses leaves all open.

The labelling of a text's words with the largest sum of scores, less
``SWITCH`` for each change of language, is found exactly: where no
stretch of words gains half a switch in another language, one language holds
the whole text; else a Viterbi pass over the words decides.  The text's language is
the one whose spans have most letters (of equal ones, the smallest name), its
score the share of those letters times how clearly the first two languages
differ over them.

Defined cases: null text, and text without a letter, is ``und`` with score 0;
a language value that is null isn't learned from; a single learned language
answers everything; without any, all is ``und``; repeated rows count and are
answered alike; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dvspark.llm.blocks import row_blocks, text_buffers

BUCKETS = 1 << 16
SWITCH = 20.0
WORD_BOUND = 4.0
#: A language writes in a script that holds at least this share of its letters.
SCRIPT_SHARE = 0.01
UND = "und"
BLOCK = 2 << 20

#: First code points of the ranges whose letters are of one script; other ranges are "other".
_RANGES = [
    (0x0000, "latin"), (0x0250, "other"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"), (0x0600, "arabic"), (0x0700, "other"), (0x0750, "arabic"), (0x0780, "other"), (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "other"), (0x0B80, "tamil"), (0x0C00, "telugu"), (0x0C80, "other"), (0x0E00, "thai"), (0x0E80, "other"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"), (0x3040, "kana"), (0x3100, "other"), (0x3400, "han"), (0xA000, "other"), (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "other"),
]
_FIRST = np.array([f for f, _ in _RANGES], np.uint32)
SCRIPTS = sorted({s for _, s in _RANGES})
_SCRIPT = np.array([SCRIPTS.index(s) for _, s in _RANGES], np.int8)


def _fold_table() -> np.ndarray:
    """Lower-cased code point of each letter of the basic plane, 0 for what is no letter."""
    table = np.zeros(0x10000, np.uint32)
    for c in range(0x10000):
        ch = chr(c)
        if ch.isalpha():
            low = ch.lower()
            table[c] = ord(low) if len(low) == 1 else c
    return table


_fold: list[np.ndarray] = []


class Words:
    """Words (runs of letters) of some texts: letters, trigram cells, script; and where each text's words begin."""

    def __init__(self, texts: list[str]):
        if not _fold:
            _fold.append(_fold_table())
        joined = "\n".join(texts) + "\n"
        chars = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype="<u4")
        # Beyond the basic plane nearly all that is a letter is Han.
        letter = _fold[0][np.where(chars < 0x10000, chars, 0)]
        letter = np.where((chars >= 0x20000) & (chars < 0x32000), chars, letter)
        is_letter = letter > 0
        before = np.zeros(len(letter), bool)
        before[1:] = is_letter[:-1]
        starts = np.flatnonzero(is_letter & ~before)
        ends = np.flatnonzero(~is_letter & before)
        bounds = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
        self.first = np.searchsorted(starts, bounds)
        self.letters = ends - starts
        # One trigram ends at each letter and one behind the word; what lies outside the word reads as 0.
        low = letter.astype(np.uint64)
        one, two = np.zeros_like(low), np.zeros_like(low)
        one[1:] = low[:-1]
        two[2:] = low[:-2]
        two[one == 0] = 0
        cell = (two * np.uint64(0x9E3779B97F4A7C15) + one * np.uint64(0xC2B2AE3D27D4EB4F) + low * np.uint64(0x165667B19E3779F9)) * np.uint64(0xFF51AFD7ED558CCD)
        self.cell = (cell >> np.uint64(48)).astype(np.int64)
        self.starts, self.stops = starts, ends + 1
        self.script = _SCRIPT[np.searchsorted(_FIRST, np.minimum(letter[starts], 0xFFFF), side="right") - 1]
        self.script[letter[starts] > 0xFFFF] = SCRIPTS.index("han")

    def sums(self, table: np.ndarray) -> np.ndarray:
        """Sum of each word's trigrams in a table of cells by languages."""
        if not len(self.starts):
            return np.zeros((0, table.shape[1]))
        out = np.empty((len(self.starts), table.shape[1]))
        for k in range(table.shape[1]):
            values = np.concatenate([[0.0], np.cumsum(table[self.cell, k], dtype=np.float64)])
            out[:, k] = values[self.stops] - values[self.starts]
        return out


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        _, offsets = text_buffers(batch.column(0))
        for lo, hi in row_blocks(offsets, BLOCK):
            texts = [t or "" for t in batch.column(0).slice(lo, hi - lo).to_pylist()]
            langs = np.array(batch.column(1).slice(lo, hi - lo).to_pylist(), dtype=object)
            for lang in sorted(set(langs.tolist())):
                words = Words([t for t, own in zip(texts, langs, strict=True) if own == lang])
                cells, scripts = held.setdefault(lang, (np.zeros(BUCKETS, np.int64), np.zeros(len(SCRIPTS), np.int64)))
                size = words.stops - words.starts
                at = np.repeat(words.starts - np.cumsum(size) + size, size) + np.arange(size.sum())
                cells += np.bincount(words.cell[at], minlength=BUCKETS)
                scripts += np.bincount(words.script, weights=words.letters, minlength=len(SCRIPTS)).astype(np.int64)
    for lang, (cells, scripts) in held.items():
        for kind, counts in (("cell", cells), ("script", scripts)):
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array([kind] * len(at)), pa.array(at, pa.int32()), pa.array(counts[at], pa.int64())], names=["lang", "kind", "at", "n"])


class LanguageModel:
    def __init__(self, languages: list[str], cells: np.ndarray, scripts: np.ndarray):
        """cells, scripts: counts by [cell or script, language]."""
        self.languages = languages
        total = cells.sum(axis=0)
        self.table = np.log((cells + 0.5) / (total + 0.5 * BUCKETS)).astype(np.float32)
        share = scripts / np.maximum(scripts.sum(axis=0), 1)
        self.writes = share >= SCRIPT_SHARE
        self.writes[~self.writes.any(axis=1)] = True

    def word_scores(self, words: Words) -> np.ndarray:
        scores = words.sums(self.table)
        scores[~self.writes[words.script]] = -np.inf
        scores -= scores.max(axis=1, keepdims=True) if len(scores) else 0
        return np.maximum(scores, -WORD_BOUND)

    def label(self, scores: np.ndarray) -> np.ndarray:
        """The best labelling of one text's words."""
        n, k = scores.shape
        whole = int(np.argmax(scores.sum(axis=0)))
        # Largest gain of each language over any stretch, against the one that is best for all words.
        # A labelling of m stretches costs m - 1 switches at least, so half a switch each isn't enough.
        run = np.zeros((n + 1, k))
        np.cumsum(scores - scores[:, whole : whole + 1], axis=0, out=run[1:])
        if (run - np.minimum.accumulate(run, axis=0)).max() <= SWITCH / 2:
            return np.full(n, whole)
        best, back = scores[0].tolist(), np.zeros((n, k), np.int8)
        rows = scores.tolist()
        for t in range(1, n):
            top = max(range(k), key=best.__getitem__)
            jump = best[top] - SWITCH
            row, here = rows[t], back[t]
            for j in range(k):
                if best[j] >= jump:
                    here[j] = j
                    best[j] += row[j]
                else:
                    here[j] = top
                    best[j] = jump + row[j]
        out = np.empty(n, np.int64)
        state = max(range(k), key=best.__getitem__)
        for t in range(n - 1, -1, -1):
            out[t] = state
            state = back[t, state]
        return out

    def spans(self, text: str) -> list[tuple[str, str]]:
        """(language, words) of each span of a mixed text."""
        words = Words([text])
        found = self.label(self.word_scores(words)) if len(words.starts) else []
        out: list[tuple[str, str]] = []
        for k, s, e in zip(found, words.starts, words.stops - 1, strict=True):
            lang = self.languages[k]
            if out and out[-1][0] == lang:
                out[-1] = (lang, out[-1][1] + " " + text[s:e])
            else:
                out.append((lang, text[s:e]))
        return out

    def predict(self, texts: list[str]) -> tuple[list[str], list[float], list[int]]:
        """Language, score and number of spans of each text."""
        words = Words(texts)
        out: tuple[list[str], list[float], list[int]] = ([], [], [])
        scores = self.word_scores(words) if self.languages else None
        for a, b in zip(words.first, words.first[1:], strict=False):
            if a == b or scores is None:
                row = (UND, 0.0, 0)
            else:
                mine, letters = scores[a:b], words.letters[a:b]
                found = self.label(mine)
                held = np.bincount(found, weights=letters, minlength=len(self.languages))
                top = int(np.argmax(held))
                sums = mine[found == top].sum(axis=0)
                rest = np.delete(sums, top)
                clear = 1 / (1 + np.exp(-min(50.0, sums[top] - rest.max()))) if len(rest) else 1.0
                row = (self.languages[top], float(held[top] / held.sum() * clear), 1 + int((found[1:] != found[:-1]).sum()))
            for column, value in zip(out, row, strict=True):
                column.append(value)
        return out


def train(docs: DataFrame, usable: Column) -> LanguageModel:
    rows = docs.where(usable).where("lang IS NOT NULL AND text IS NOT NULL").select("text", "lang")
    counts = rows.mapInArrow(_counted, "lang string, kind string, at int, n long").groupBy("lang", "kind", "at").agg(F.sum("n").alias("n")).collect()
    languages = sorted({r.lang for r in counts})
    cells, scripts = np.zeros((BUCKETS, len(languages))), np.zeros((len(SCRIPTS), len(languages)))
    for r in counts:
        (cells if r.kind == "cell" else scripts)[r["at"], languages.index(r.lang)] = r.n
    return LanguageModel(languages, cells, scripts)


def predict(docs: DataFrame, model: LanguageModel, prefix: str = "lang_", keep_text: bool = False) -> DataFrame:
    """``prefix``pred, ``prefix``score, ``prefix``spans, then the columns of ``docs``; its ``text`` only if kept (then fourth)."""
    rest = [f for f in docs.schema.fields if f.name != "text"]
    found_fields = [T.StructField(prefix + "pred", T.StringType()), T.StructField(prefix + "score", T.DoubleType()), T.StructField(prefix + "spans", T.IntegerType())]
    schema = T.StructType([*found_fields, *([docs.schema["text"]] if keep_text else []), *rest])
    names, first_kept = schema.names, 0 if keep_text else 1
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, offsets = text_buffers(batch.column(0))
            for lo, hi in row_blocks(offsets, BLOCK):
                found = held.value.predict([t or "" for t in batch.column(0).slice(lo, hi - lo).to_pylist()])
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(found, (pa.string(), pa.float64(), pa.int32()), strict=True)] + [batch.column(k).slice(lo, hi - lo) for k in range(first_kept, batch.num_columns)], names=names)

    return docs.select("text", *(F.col(f"`{f.name}`") for f in rest)).mapInArrow(run, schema)

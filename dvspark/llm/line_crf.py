"""Quality by a linear-chain conditional random field over a text's lines.

Every line is good or bad.  A line's potential takes its own features and those
of the lines before and after it; a transition matrix ties neighbours.  The
score of a text is the length-weighted mean of the lines' forward-backward
marginals for good, stretched so that the best cut on the training texts lies
at ``CUT``.

Training, on the driver: at most ``TRAIN_TEXTS`` labelled texts (the smallest
by a hash of their id; those of over ``TRAIN_LINES`` lines are not taken), so
the sample is bounded whatever the corpus.  Labels are of whole texts: all
lines of a good text are good; those of a bad text start as bad, and after
each round are what the model says, at least one staying bad.

Features see the text alone, are counted with array operations over a block of
lines, and need no vocabulary.

Defined cases: null and empty text is one empty line; repeated rows are scored
alike; a label that is null counts as none, several labels of one doc_id as
the smallest; without labels of both kinds nothing is learned and every score
is CUT (nothing is rejected); an empty table gives no rows; extra columns are
ignored; a text that is one long line is one line.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dvspark.llm.blocks import WordBlock, mix, row_blocks, text_buffers

TRAIN_TEXTS = 4000
TRAIN_LINES = 1000
CUT = 0.7
ROUNDS, STEPS, RATE, RIDGE = 3, 120, 0.1, 1e-4

_LETTER, _UPPER, _DIGIT, _SPACE, _SIGN, _STOP = (np.zeros(256, bool) for _ in range(6))
_UPPER[ord("A") : ord("Z") + 1] = True
_LETTER[ord("a") : ord("z") + 1] = True
_LETTER |= _UPPER
_LETTER[0x80:] = True  # parts of letters outside ASCII, nearly always
_DIGIT[ord("0") : ord("9") + 1] = True
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_SIGN[:] = ~(_LETTER | _DIGIT | _SPACE)
_STOP[[ord(c) for c in ".!?:;"]] = True

FEATURES = ("words", "signs", "upper", "digits", "wordless", "doubled_sign", "same_as_before", "repeated", "word_length", "ends_in_stop", "line_again", "empty")


def line_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features and length of every line of some texts, and where each text's lines begin."""
    base = int(offsets[0])
    b = data[base : int(offsets[-1])]
    bounds = (offsets - base).astype(np.int64)
    breaks = np.flatnonzero(b == 0x0A) + 1
    # A text begins a line even where it is empty, so bounds are kept as often as they occur.
    text = np.searchsorted(bounds, breaks, side="right") - 1
    inside = breaks < bounds[text + 1] if len(breaks) else np.zeros(0, bool)
    closing = breaks == bounds[np.minimum(np.searchsorted(bounds, breaks), len(bounds) - 1)] if len(breaks) else inside
    lines = np.concatenate([bounds[:-1], breaks[inside & ~closing]])
    owner = np.concatenate([np.arange(len(bounds) - 1), text[inside & ~closing]])
    order = np.lexsort((lines, owner))
    lines, owner = lines[order], owner[order]
    first = np.searchsorted(owner, np.arange(len(bounds)))
    cuts = np.append(lines, len(b))
    n = len(lines)
    size = np.diff(cuts)
    block = WordBlock(b, cuts)
    per_line = block.counts()
    words = np.maximum(per_line, 1).astype(float)

    def bytes_of(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flags)])
        return (total[cuts[1:]] - total[cuts[:-1]]).astype(float)

    def words_of(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flags)])
        return (total[block.first[1:]] - total[block.first[:-1]]).astype(float)

    letters, signs, digits = bytes_of(_LETTER[b]), bytes_of(_SIGN[b]), bytes_of(_DIGIT[b])
    solid = np.maximum(size - bytes_of(_SPACE[b]), 1.0)
    s, e, h = block.starts, block.ends, block.hash
    known = np.concatenate([[0], np.cumsum(_LETTER[b] | _DIGIT[b])])
    wordless = known[e] == known[s] if len(s) else np.zeros(0, bool)
    last, before = (b[e - 1], b[np.maximum(e - 2, s)]) if len(s) else (b[:0], b[:0])
    doubled = _SIGN[last] & (last == before) & (e - s > 1)
    row = np.repeat(np.arange(n), per_line)
    same = np.zeros(len(h), bool)
    same[1:] = (h[1:] == h[:-1]) & (row[1:] == row[:-1])
    in_line = mix(h ^ mix(row.astype(np.uint64)))
    repeated = words_of(np.ones(len(h), np.int64)) if len(h) else np.zeros(n)
    distinct = np.bincount(row[np.unique(in_line, return_index=True)[1]], minlength=n) if len(h) else np.zeros(n)
    total = np.concatenate([[np.uint64(0)], np.cumsum(mix(h + (np.arange(len(h)) - block.first[row]).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), dtype=np.uint64)]) if len(h) else np.zeros(1, np.uint64)
    name = mix((total[block.first[1:]] - total[block.first[:-1]]) ^ mix(owner.astype(np.uint64) + np.uint64(1)))
    _, inverse, count = np.unique(name, return_inverse=True, return_counts=True)
    stop = np.zeros(n)
    ended = np.flatnonzero(per_line > 0)
    stop[ended] = _STOP[b[e[block.first[1:][ended] - 1] - 1]]
    x = np.stack([np.log1p(per_line), signs / solid, bytes_of(_UPPER[b]) / np.maximum(letters, 1.0), digits / solid, words_of(wordless) / words, words_of(doubled) / words, words_of(same) / words, (repeated - distinct) / words, np.minimum(solid / words, 30.0) / 10, stop, (count[inverse] > 1) & (per_line > 0), per_line == 0], axis=1)
    return x, size.astype(float) + 1, first


def with_neighbours(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Each line's features, those of the lines before and after it (0 beyond the text), and a constant."""
    n, k = x.shape
    out = np.zeros((n, 3 * k + 3))
    out[:, :k] = x
    out[1:, k : 2 * k] = x[:-1]
    out[:-1, 2 * k : 3 * k] = x[1:]
    starts, ends = first[:-1], first[1:] - 1
    out[starts, k : 2 * k] = 0
    out[ends, 2 * k : 3 * k] = 0
    out[starts, -3] = 1
    out[ends, -2] = 1
    out[:, -1] = 1
    return out


class Crf:
    """weights: potential of good against bad; ties: score of [label, next label]."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, weights: np.ndarray, ties: np.ndarray, cut: float):
        self.mean, self.scale, self.weights, self.ties, self.cut = mean, scale, weights, ties, cut

    def marginals(self, nodes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """P(good) of each line, and the expected number of each pair of neighbouring labels."""
        n = len(nodes)
        score = np.stack([np.zeros(n), nodes], axis=1)
        size = np.diff(first)
        order = np.argsort(-size, kind="stable")
        longest = size[order]
        # Chains side by side, the longest first: at step t those with more than t lines go on.
        alive = np.searchsorted(-longest, -np.arange(1, (longest[0] if len(longest) else 0) + 1), side="right")
        forward, backward = np.zeros((n, 2)), np.zeros((n, 2))
        forward[first[:-1]] = score[first[:-1]]
        for t in range(1, len(alive)):
            at = first[order[: alive[t]]] + t
            forward[at] = score[at] + np.logaddexp(forward[at - 1, :1] + self.ties[0], forward[at - 1, 1:] + self.ties[1])
        for t in range(len(alive) - 1, 0, -1):
            at = first[order[: alive[t]]] + t
            onward = score[at] + backward[at]
            backward[at - 1] = np.logaddexp(self.ties[:, 0] + onward[:, :1], self.ties[:, 1] + onward[:, 1:])
        both = forward + backward
        good = 1 / (1 + np.exp(np.clip(both[:, 0] - both[:, 1], -500, 500)))
        later = np.ones(n, bool)
        later[first[:-1]] = False
        at = np.flatnonzero(later)
        joint = forward[at - 1][:, :, None] + self.ties[None] + (score[at] + backward[at])[:, None, :]
        joint = np.exp(joint - np.logaddexp(both[at, 0], both[at, 1])[:, None, None])
        return good, joint.sum(axis=0)

    def lines(self, x: np.ndarray, first: np.ndarray) -> np.ndarray:
        return self.marginals(with_neighbours((x - self.mean) / self.scale, first) @ self.weights, first)[0]

    def texts(self, x: np.ndarray, size: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Length-weighted marginals of each text, with the training cut at CUT."""
        return self.stretched(weighted(self.lines(x, first), size, first))

    def stretched(self, raw: np.ndarray) -> np.ndarray:
        return np.where(raw < self.cut, raw * (CUT / self.cut), CUT + (raw - self.cut) * ((1 - CUT) / (1 - self.cut)))


def weighted(good: np.ndarray, size: np.ndarray, first: np.ndarray) -> np.ndarray:
    sums = [np.concatenate([[0.0], np.cumsum(v)]) for v in (good * size, size)]
    top, bottom = (s[first[1:]] - s[first[:-1]] for s in sums)
    return np.clip(top / bottom, 0.0, 1.0)


def fit(x: np.ndarray, size: np.ndarray, first: np.ndarray, label: np.ndarray) -> Crf | None:
    """A model of the labelled texts; None unless both labels occur."""
    if len(np.unique(label)) < 2:
        return None
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    full = with_neighbours((x - mean) / scale, first)
    model = Crf(mean, scale, np.zeros(full.shape[1]), np.zeros((2, 2)), 0.5)
    owner = np.repeat(np.arange(len(label)), np.diff(first))
    y = label[owner].astype(int)
    later = np.ones(len(y), bool)
    later[first[:-1]] = False
    at = np.flatnonzero(later)
    for _ in range(ROUNDS):
        seen = np.zeros((2, 2))
        np.add.at(seen, (y[at - 1], y[at]), 1)
        moments = [np.zeros(len(model.weights) + 4) for _ in range(2)]
        for step in range(1, STEPS + 1):
            good, expected = model.marginals(full @ model.weights, first)
            slope = np.concatenate([full.T @ (y - good), (seen - expected).ravel()]) / len(y) - RIDGE * np.concatenate([model.weights, model.ties.ravel()])
            moments[0] = 0.9 * moments[0] + 0.1 * slope
            moments[1] = 0.99 * moments[1] + 0.01 * slope**2
            move = RATE * moments[0] / (1 - 0.9**step) / (np.sqrt(moments[1] / (1 - 0.99**step)) + 1e-9)
            model.weights, model.ties = model.weights + move[:-4], model.ties + move[-4:].reshape(2, 2)
        good = model.marginals(full @ model.weights, first)[0]
        worst = np.full(len(label), np.inf)
        np.minimum.at(worst, owner, good)
        y = np.where(label[owner] == 1, 1, ((good > 0.5) & (good > worst[owner])).astype(int))
    raw = weighted(model.lines(x, first), size, first)
    # The cut with the best mean of the two labels' recalls, in the middle of its gap.
    values = np.unique(raw)
    cuts = (values[1:] + values[:-1]) / 2
    if len(cuts):
        ups, downs = np.sort(raw[label == 1]), np.sort(raw[label == 0])
        balance = (1 - np.searchsorted(ups, cuts) / len(ups)) + np.searchsorted(downs, cuts) / len(downs)
        best = np.flatnonzero(balance >= balance.max() - 1e-12)
        widest = best[np.argmax(np.diff(values)[best])]
        model.cut = float(np.clip(cuts[widest], 0.01, 0.99))
    return model


def _features_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = text_buffers(batch.column(0))
        for lo, hi in row_blocks(offsets):
            x, size, first = line_features(data, offsets[lo : hi + 1])
            rows = [(x[a:b].tobytes(), size[a:b].tobytes()) if b - a <= TRAIN_LINES else (None, None) for a, b in zip(first, first[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.binary()), batch.column(1).slice(lo, hi - lo)], names=["x", "size", "quality"])


def train(docs: DataFrame, labels: DataFrame, usable: Column) -> Crf | None:
    """Learns from the labelled texts of ``docs`` whose label row is ``usable``."""
    known = labels.where(usable).where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_TEXTS)
    # At most TRAIN_TEXTS short rows, one for a doc_id: the documents stay where they are.
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    rows = rows.groupBy("doc_id").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"), F.first("quality").alias("quality")).select("text", "quality")
    found = rows.mapInArrow(_features_of, "x binary, size binary, quality int").where("x IS NOT NULL").collect()
    if not found:
        return None
    size = [np.frombuffer(r.size, float) for r in found]
    x = np.concatenate([np.frombuffer(r.x, float).reshape(-1, len(FEATURES)) for r in found])
    first = np.concatenate([[0], np.cumsum([len(s) for s in size])])
    return fit(x, np.concatenate(size), first, np.array([1 if r.quality == 1 else 0 for r in found]))


def _scored(batches: Iterator[pa.RecordBatch], model: Crf | None, names: list[str], first_kept: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = text_buffers(batch.column(0))
        for lo, hi in row_blocks(offsets):
            x, size, first = line_features(data, offsets[lo : hi + 1])
            score = np.full(hi - lo, CUT) if model is None else model.texts(x, size, first)
            yield pa.RecordBatch.from_arrays([pa.array(score, pa.float64()), *(batch.column(k).slice(lo, hi - lo) for k in range(first_kept, batch.num_columns))], names=names)


def score(docs: DataFrame, model: Crf | None, name: str = "score", keep_text: bool = False) -> DataFrame:
    """``name`` (the score), then the columns of ``docs``; its ``text`` only if kept (then second)."""
    rest = [f for f in docs.schema.fields if f.name != "text"]
    kept = ["text"] * keep_text + [f.name for f in rest]
    schema = T.StructType([T.StructField(name, T.DoubleType()), *([docs.schema["text"]] if keep_text else []), *rest])
    return docs.select("text", *(F.col(f"`{f.name}`") for f in rest)).mapInArrow(lambda batches: _scored(batches, model, [name, *kept], 0 if keep_text else 1), schema)

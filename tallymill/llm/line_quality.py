"""Document quality from a linear-chain conditional random field over lines.

Every line of a text is good or bad. The field scores a line by features of the
line and of its two neighbours, and the step from one line to the next by a
transition weight. Forward and backward passes give each line's probability of
being good; their mean, weighted by the lengths of the lines, is the document's
evidence, which a logistic curve turns into a score.

Only the text is used. The field is trained on labelled documents of which each
line takes its document's label. Two of them in a row make one chain, so that labels
change inside of chains as they do in documents that hold both kinds; those are what
the transitions and the averaging are for.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tallymill.llm.rows import column, packed, text_or_empty, unpacked
from tallymill.session import written

#: Training bounds: labelled documents, bytes of one of them, and bytes of all of them.
TRAIN_DOCS = 3000
TRAIN_TEXT_BYTES = 1 << 18
TRAIN_BYTES = 1 << 23
#: Weight of the squares of all parameters in what training maximises.
PENALTY = 1.0
#: Labelled texts that are joined to one chain for training.
CHAIN_TEXTS = 2

#: Score from which a document counts as good.
THRESHOLD = 0.7

_BATCH_BYTES = 1 << 21

# Classes of bytes; everything else, such as ASCII control codes, is class 0.
_LOWER, _UPPER, _DIGIT, _SPACE, _STOP, _QUOTE, _SYMBOL, _WIDE, _TAIL = range(1, 10)


def _byte_classes() -> np.ndarray:
    table = np.zeros(256, np.int8)
    table[0x21:0x7F] = _SYMBOL
    table[[*b"abcdefghijklmnopqrstuvwxyz"]] = _LOWER
    table[[*b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"]] = _UPPER
    table[[*b"0123456789"]] = _DIGIT
    table[[*b" \t\n\r\x0b\x0c"]] = _SPACE
    table[[*b".,;:?"]] = _STOP
    table[[*b"'\"()-"]] = _QUOTE
    table[0xC0:0x100] = _WIDE
    table[0x80:0xC0] = _TAIL
    return table


_CLASS = _byte_classes()

# Edges of the bins into which the measures of a line are cut.
_EDGES = {
    "bytes": [1, 12, 40, 120, 400, 1500],
    "words": [1, 3, 8, 30, 120],
    "upper": [0.02, 0.08, 0.25, 0.5],
    "digit": [0.01, 0.05, 0.2],
    "symbol": [0.002, 0.01, 0.04, 0.1],
    "stop": [0.002, 0.01, 0.03, 0.08],
    "wide": [0.01, 0.05, 0.15],
    "word_length": [2.5, 4, 5.5, 7, 10],
    "marked_words": [0.02, 0.1, 0.3, 0.6],
    "bare_symbols": [0.02, 0.1, 0.3],
    "same_as_last": [0.02, 0.1, 0.4],
    "distinct": [0.2, 0.4, 0.6, 0.8, 0.95],
    "seen_before": [0.5],
}
_WIDTHS = [len(edges) + 1 for edges in _EDGES.values()]
_OWN = sum(_WIDTHS)
#: Features of a line: its own bins, those of the lines before and after, first line, last line, bias.
FEATURES = 3 * _OWN + 3


@dataclass(frozen=True)
class Model:
    """Weights of the field and of the curve from evidence to score."""

    weights: np.ndarray  # FEATURES, in favour of good
    steps: np.ndarray  # 2 x 2, from bad or good to bad or good
    slope: float
    offset: float

    def score(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * evidence + self.offset, -30, 30)))


def line_bins(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bins of all lines of some texts: (lines x measures), bytes per line, lines per text.

    A text without a line break, the empty one too, is one line. The work is done
    on one flat array; nothing is cut from the texts.
    """
    flat = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    text_ends = np.cumsum([len(t) + 1 for t in texts]) - 1
    ends = np.flatnonzero(flat == 10)
    starts = np.r_[0, ends[:-1] + 1]
    per_text = np.diff(np.r_[0, np.searchsorted(ends, text_ends, side="right")])
    kind = _CLASS[flat]

    def per_line(mask: np.ndarray) -> np.ndarray:
        before = np.r_[0, np.cumsum(mask, dtype=np.int64)]
        return (before[ends] - before[starts]).astype(np.float64)

    size = (ends - starts).astype(np.float64)
    chars = np.maximum(per_line(kind != _TAIL), 1)
    space = kind == _SPACE
    head = ~space & np.r_[True, space[:-1]]
    tail = ~space & np.r_[space[1:], True]
    symbol = kind == _SYMBOL
    words = per_line(head)
    each = np.maximum(words, 1)
    word_at = np.flatnonzero(head)
    word_to = np.flatnonzero(tail) + 1
    hashes = _word_hashes(flat, word_at, word_to)
    word_line = np.searchsorted(ends, word_at)
    lines = len(ends)
    again = np.r_[False, (hashes[1:] == hashes[:-1]) & (word_line[1:] == word_line[:-1])] if len(hashes) else np.zeros(0, bool)
    new = _first_seen(word_line, hashes)
    line_hash = np.zeros(lines, np.uint64)
    np.add.at(line_hash, word_line, hashes * np.uint64(0x9E3779B97F4A7C15))
    text_of_line = np.repeat(np.arange(len(texts)), per_text)
    seen = ~_first_seen(text_of_line, line_hash) & (words > 0)

    def per_line_words(mask: np.ndarray) -> np.ndarray:
        return np.bincount(word_line[mask], minlength=lines) / each

    measures = {
        "bytes": size,
        "words": words,
        "upper": per_line(kind == _UPPER) / chars,
        "digit": per_line(kind == _DIGIT) / chars,
        "symbol": per_line(symbol) / chars,
        "stop": per_line(kind == _STOP) / chars,
        "wide": per_line(kind == _WIDE) / chars,
        "word_length": per_line(~space & (kind != _TAIL)) / each,
        "marked_words": per_line(symbol & tail & ~head) / each,
        "bare_symbols": per_line(symbol & tail & head) / each,
        "same_as_last": per_line_words(again),
        "distinct": per_line_words(new),
        "seen_before": seen.astype(np.float64),
    }
    bins = np.stack([np.searchsorted(_EDGES[n], v, side="right") for n, v in measures.items()], axis=1)
    return bins, size, per_text


def _word_hashes(flat: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A number for each word, equal for equal words (all but certainly unequal for others)."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    inside = np.arange(len(flat)) - np.repeat(starts, np.diff(np.r_[starts, len(flat)])) if starts[0] == 0 else None
    if inside is None:
        inside = np.arange(len(flat)) - np.repeat(np.r_[0, starts], np.diff(np.r_[0, starts, len(flat)]))
    powers = np.cumprod(np.full(256, 0x100000001B3, np.uint64))
    value = (flat.astype(np.uint64) + np.uint64(1)) * powers[inside & 255]
    before = np.r_[np.uint64(0), np.cumsum(value, dtype=np.uint64)]
    return before[ends] - before[starts]


def _first_seen(group: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Whether an item is the first of its value in its group."""
    order = np.lexsort((np.arange(len(value)), value, group))
    g, v = group[order], value[order]
    first = np.r_[True, (g[1:] != g[:-1]) | (v[1:] != v[:-1])] if len(order) else np.zeros(0, bool)
    result = np.empty(len(order), bool)
    result[order] = first
    return result


def feature_places(bins: np.ndarray, per_text: np.ndarray) -> np.ndarray:
    """The places of a line's features in the weights; each row has the same number of them."""
    offsets = np.cumsum([0, *_WIDTHS[:-1]])
    own = bins + offsets
    last = np.cumsum(per_text) - 1
    first = np.r_[0, last[:-1] + 1] if len(last) else last
    is_first, is_last = np.zeros(len(own), bool), np.zeros(len(own), bool)
    is_first[first], is_last[last] = True, True
    nothing = np.full((1, own.shape[1]), -1)
    before = np.concatenate([nothing, own[:-1]]) + _OWN
    after = np.concatenate([own[1:], nothing]) + 2 * _OWN
    edge = FEATURES - 3
    before[is_first], after[is_last] = edge, edge + 1
    return np.concatenate([own, before, after, np.full((len(own), 1), edge + 2)], axis=1)


def marginals(
    good: np.ndarray, steps: np.ndarray, per_text: np.ndarray, weight: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward-backward over many texts at once, each step for all texts that have such a line.

    ``good`` has each line's score in favour of good. Returns the probability that each
    line is good, the expected number of steps of each kind over all texts, each text
    counted by its ``weight`` (1), and the logarithm of each text's partition sum.
    """
    order = np.argsort(-per_text, kind="stable")
    starts = (np.cumsum(per_text) - per_text)[order]
    lengths = per_text[order]
    counted = np.ones(len(order)) if weight is None else weight[order]
    rounds = int(lengths[0]) if len(lengths) else 0
    active = np.searchsorted(-lengths, -np.arange(rounds), side="left")
    emit = np.stack([np.zeros_like(good), good], axis=1)
    top = emit.max(axis=1)
    emit = np.exp(emit - top[:, None])
    move = np.exp(steps)
    forward, backward = np.empty_like(emit), np.ones_like(emit)
    scale = np.empty(len(good))
    for t in range(rounds):
        at = starts[: active[t]] + t
        value = emit[at] * (forward[at - 1] @ move) if t else emit[at]
        scale[at] = value.sum(axis=1)
        forward[at] = value / scale[at][:, None]
    pairs = np.zeros((2, 2))
    for t in range(rounds - 1, 0, -1):
        at = starts[: active[t]] + t
        onward = emit[at] * backward[at] / scale[at][:, None]
        pairs += move * ((forward[at - 1] * counted[: active[t], None]).T @ onward)
        backward[at - 1] = onward @ move.T
    both = forward * backward
    log_sum = np.zeros(len(per_text))
    if len(per_text):
        log_sum = np.add.reduceat(np.log(scale) + top, np.cumsum(per_text) - per_text)
    return both[:, 1] / both.sum(axis=1), pairs, log_sum


def likelihood(
    weights: np.ndarray, steps: np.ndarray, places: np.ndarray, per_chain: np.ndarray, labels: np.ndarray, weight: np.ndarray,
    penalty: float,
) -> tuple[float, np.ndarray, np.ndarray]:
    """What training maximises, and its gradient by the weights and by the steps.

    The sum over chains of ``weight`` times the log-likelihood of the labels of the
    chain's lines, less ``penalty`` / 2 times the squares of all parameters.
    """
    good = weights[places].sum(axis=1)
    p, expected, log_sum = marginals(good, steps, per_chain, weight)
    by_line = np.repeat(weight, per_chain)
    ends = np.zeros(len(labels), bool)
    ends[np.cumsum(per_chain) - 1] = True
    before = np.flatnonzero(~ends)
    observed = np.zeros((2, 2))
    np.add.at(observed, (labels[before].astype(int), labels[before + 1].astype(int)), by_line[before])
    value = (by_line * labels * good).sum() + (observed * steps).sum() - (weight * log_sum).sum()
    value -= penalty / 2 * ((weights**2).sum() + (steps**2).sum())
    gap = np.repeat((labels - p) * by_line, places.shape[1])
    return value, np.bincount(places.ravel(), gap, FEATURES) - penalty * weights, observed - expected - penalty * steps


def fit(texts: list[bytes], labels: list[int], rounds: int = 120, penalty: float = PENALTY, chain_texts: int = CHAIN_TEXTS) -> Model:
    """Train the field by gradient ascent on ``likelihood``, then the curve.

    The lines of every ``chain_texts`` texts in a row make one chain, in which labels
    change where texts of both kinds meet: that is what the steps are learnt from. The
    features of a line stay those of its own text. Both kinds count the same, and
    chains whatever their numbers of lines. Without both kinds of label every text gets
    the share of good labels (0.5 for none) as its score.
    """
    share = float(np.mean(labels)) if labels else 0.5
    share = min(max(share, 0.001), 0.999)
    if not 0 < sum(labels) < len(labels):
        return Model(np.zeros(FEATURES), np.zeros((2, 2)), 0.0, float(np.log(share / (1 - share))))
    bins, size, per_text = line_bins(texts)
    places = feature_places(bins, per_text)
    kind = np.array(labels, np.float64)
    chain = np.arange(len(texts)) // chain_texts
    per_chain = np.bincount(chain, per_text).astype(np.int64)
    weight = np.bincount(chain, np.where(kind == 1, 0.5 / share, 0.5 / (1 - share))) / per_chain
    by_line = np.repeat(kind, per_text)
    weights, steps = np.zeros(FEATURES), np.zeros((2, 2))
    squares, step_squares = np.full(FEATURES, 1e-8), np.full((2, 2), 1e-8)
    for _ in range(rounds):
        _, gradient, step_gradient = likelihood(weights, steps, places, per_chain, by_line, weight, penalty)
        squares += gradient**2
        step_squares += step_gradient**2
        weights += 0.3 * gradient / np.sqrt(squares)
        steps += 0.3 * step_gradient / np.sqrt(step_squares)
    return _with_curve(Model(weights, steps, 1.0, 0.0), bins, size, per_text, kind)


def _with_curve(model: Model, bins: np.ndarray, size: np.ndarray, per_text: np.ndarray, labels: np.ndarray) -> Model:
    x = evidence(model, bins, size, per_text)
    slope, offset = 1.0, 0.0
    for _ in range(200):  # Newton steps of a penalised logistic regression on one variable
        p = 1 / (1 + np.exp(-np.clip(slope * x + offset, -30, 30)))
        curve = p * (1 - p) + 1e-6
        g = np.array([((labels - p) * x).sum() - 0.01 * slope, (labels - p).sum() - 0.01 * offset])
        h = np.array([[(curve * x * x).sum() + 0.01, (curve * x).sum()], [(curve * x).sum(), curve.sum() + 0.01]])
        change = np.clip(np.linalg.solve(h, g), -2, 2)
        slope, offset = slope + change[0], offset + change[1]
        if np.abs(change).max() < 1e-9:
            break
    return Model(model.weights, model.steps, float(slope), float(offset))


def evidence(model: Model, bins: np.ndarray, size: np.ndarray, per_text: np.ndarray) -> np.ndarray:
    """The mean probability of good of each text's lines, weighted by their lengths."""
    if not len(per_text):
        return np.zeros(0)
    good = model.weights[feature_places(bins, per_text)].sum(axis=1)
    p, _, _ = marginals(good, model.steps, per_text)
    weight = np.maximum(size, 1.0)
    starts = np.cumsum(per_text) - per_text
    return np.add.reduceat(p * weight, starts) / np.add.reduceat(weight, starts)


def scores(model: Model, texts: list[bytes]) -> np.ndarray:
    """Scores of some texts, worked out in batches of bounded size."""
    found, part, held = [np.zeros(0)], [], 0
    for text in texts:
        if part and held + len(text) > _BATCH_BYTES:
            found.append(model.score(evidence(model, *line_bins(part))))
            part, held = [], 0
        part.append(text)
        held += len(text) + 1
    if part:
        found.append(model.score(evidence(model, *line_bins(part))))
    return np.concatenate(found)


def is_held_out(id_column: str = "doc_id") -> Column:
    """Rows never learnt from: the checksum of the id, as text, leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    label_column: str = "quality", max_docs: int = TRAIN_DOCS, max_bytes: int = TRAIN_BYTES, max_text_bytes: int = TRAIN_TEXT_BYTES,
) -> Model:
    """Fit on a bounded sample of the labelled documents that are not held out.

    Of the ``max_docs`` labelled ids with the smallest hashes, those whose text is at
    most ``max_text_bytes`` long, as many of them in the order of their hashes as make
    up ``max_bytes`` together. Longer texts take no part, and none that is left out
    keeps others out. Labels that are null, or of null ids, are left out; so are ids
    labelled both ways.
    """
    known = (
        labels.select(column(id_column).alias("id"), column(label_column).cast("int").alias("label"))
        .filter(F.col("id").isNotNull() & F.col("label").isin(0, 1))
        .filter(~is_held_out("id"))
        .groupBy("id")
        .agg(F.min("label").alias("label"), F.max("label").alias("other"))
        .filter("label = other")
        .orderBy(F.xxhash64("id"), "id")
        .limit(max_docs)
        .select("id", "label")
    )
    texts = docs.select(column(id_column).alias("id"), text_or_empty(text_column).alias("text"))
    # At most max_docs small rows are broadcast, and as many bounded texts are written. A repeated id counts once.
    found = (
        texts.filter(F.octet_length("text") <= max_text_bytes)
        .join(F.broadcast(known), "id")
        .groupBy("id")
        .agg(F.min("text").alias("text"), F.first("label").alias("label"))
    )
    found = written(found, "labelled")
    in_order = W.partitionBy(F.lit(0)).orderBy(F.xxhash64("id"), "id").rowsBetween(W.unboundedPreceding, 0)
    chosen = found.select("id", F.sum(F.octet_length("text")).over(in_order).alias("upto")).filter(F.col("upto") <= max_bytes)
    rows = found.join(F.broadcast(chosen.select("id")), "id").orderBy(F.xxhash64("id"), "id").toPandas()
    return fit([t.encode() for t in rows["text"]], [int(x) for x in rows["label"]])


def scored(texts: DataFrame, model: Model, text_column: str = "text", name: str = "score") -> DataFrame:
    """``texts`` with the score of each row's whole text in a new column. Null texts count as empty."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(scores(model, [t.encode() for t in batch]), index=batch.index, dtype=float)

    return texts.withColumn(name, score(F.coalesce(F.col(text_column), F.lit(""))))


def quality(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """(id, ``held_out``, ``score``, ``predicted``) of every row.

    Null and empty texts are scored as one empty line. Rows with a null id are
    scored but never learnt from; repeated rows each give their row, an empty
    table gives none, and without labels of both kinds every score is the share of
    good labels. Other columns are ignored whatever their names.
    """
    model = train(docs, labels, id_column, text_column)
    chosen = docs.select(column(id_column).alias("id"), column(text_column).alias("text"))
    return scored(chosen, model).select(
        F.col("id").alias(id_column),
        is_held_out("id").alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_good(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """The rows of ``docs`` whose score reaches the threshold, columns unchanged whatever their names."""
    model = train(docs, labels, id_column, text_column)
    rows = scored(packed(docs, text=column(text_column)), model)
    return unpacked(rows.filter(F.col("score") >= threshold), docs.columns)

"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

Labels come per document, so tokens are labelled at a distance: all features (words and their beginnings; a word
counts by its most telling one) are taken that toxic documents hold significantly more often than clean ones, where a
feature counts once for each pair of neighbours that it stands between and each text once, so that copies of a toxic
document neither make a feature nor hide one.  Those words in toxic documents are labelled 1, all else 0, and a two-state chain (word weights, one
weight for all other words, transitions, start) is trained on windows around them in both kinds of documents and on
windows elsewhere, by gradient steps on the conditional likelihood.

Scoring runs forward-backward over the whole token sequence of every text.  Words without a weight of their own
all act alike, so a stretch of g of them is one power of a 2x2 matrix and only weighted words are visited.  A
document's evidence is -log prod(1 - m) over its marginals m, its score the logistic curve fitted to the evidence of
the training rows; words with a marginal of ``at`` or more are its offending spans (byte ranges in the UTF-8 text).

Fitting takes at most about ``training_rows`` labelled rows and ``training_bytes`` of text, those with the smallest
digests of id; the features, whatever their number, come from that sample.  Scoring covers every row, each within one
task.  Only the weights are broadcast.

Edge cases: null, empty and wordless texts score as texts without evidence do; without toxic or clean training rows
every score is next to 0;
repeated rows get equal scores; null labels are left out; columns that clash with the result's names are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quirework.llm import _text as tx
from quirework.sources.scratch import Scratch

TRAINING_ROWS = 12000
TRAINING_BYTES = 64 << 20
AT, CUT = 0.5, 0.7
RADIUS = 3
#: How much more often a feature stands in toxic texts, and the log of the odds against chance that it takes.
LIFT, GAIN = 5.0, 12.0


#: Byte lengths of word beginnings that are features beside the whole word (0).
BEGINNINGS = (0, 3, 4, 5, 6, 7, 8)


def feature_hashes(w: tx.Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each kind of feature: (indices of the words that have it, its hash)."""
    run = tx.running(w)
    for k in BEGINNINGS:
        at = np.flatnonzero(w.stop - w.begin >= k)
        own = w._replace(begin=w.begin[at], stop=w.begin[at] + k if k else w.stop[at])
        yield at, tx.mixed(tx.word_hashes(own, run) ^ np.uint64(k * 0x9E3779B97F4A7C15 & (1 << 64) - 1))


def symbols(w: tx.Words, keys: np.ndarray, held: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """For each word the smallest rank (from 1) among its features that are in ``keys``; 0 without any."""
    out = np.full(len(w.begin), len(keys) + 1, np.int64)
    for at, h in feature_hashes(w) if len(keys) else ():
        some = np.flatnonzero(held[h >> np.uint64(48)])
        place = np.minimum(np.searchsorted(keys, h[some]), len(keys) - 1)
        same = keys[place] == h[some]
        words = at[some[same]]
        out[words] = np.minimum(out[words], rank[place[same]])
    return np.where(out > len(keys), 0, out)


@dataclass
class Field:
    """A trained chain.  Scores are logs; column 1 is toxic; symbol 0 stands for every word without features."""

    keys: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))  # feature hashes, sorted
    rank: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))  # the symbol of each
    scores: np.ndarray = field(default_factory=lambda: np.zeros((1, 2)))
    start: np.ndarray = field(default_factory=lambda: np.zeros(2))
    move: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    slope: float = 1.0  # of a document's log odds over its evidence
    level: float = -20.0

    def __post_init__(self) -> None:
        self.held = np.zeros(1 << 16, bool)
        self.held[self.keys >> np.uint64(48)] = True
        self.emit = np.exp(self.scores)
        self.plain, self.into, self.first = self.emit[0], np.exp(self.move), np.exp(self.start)
        self.values, self.left = np.linalg.eig(self.into * self.plain)  # into a word without features
        self.right = np.linalg.inv(self.left)

    def gap(self, n: int) -> np.ndarray:
        """The chain over n unweighted words, scaled to a largest eigenvalue of 1."""
        return ((self.left * (self.values / np.abs(self.values).max()) ** n) @ self.right).real

    def marginals(self, at: np.ndarray, which: np.ndarray, total: int) -> np.ndarray:
        """P(toxic) of the words with symbols ``which`` at these places of a sequence of ``total`` words."""
        k = len(at)
        forward, through = np.zeros((k, 2)), [None] * k
        for i in range(k):
            if i:
                through[i] = self.gap(int(at[i] - at[i - 1] - 1)) @ self.into
                v = forward[i - 1] @ through[i]
            elif at[0]:
                v = (self.first * self.plain) @ self.gap(int(at[0] - 1)) @ self.into
            else:
                v = self.first
            v = np.maximum(v, 0) * self.emit[which[i]]
            forward[i] = v / v.sum()
        out, back = np.zeros(k), self.gap(int(total - at[-1] - 1)) @ np.ones(2)
        for i in range(k - 1, -1, -1):
            p = forward[i] * np.maximum(back, 0)
            out[i] = p[1] / p.sum()
            if i:
                back = through[i] @ (self.emit[which[i]] * back)
                back = back / back.sum()
        return out

    def evidence(self, at: np.ndarray, which: np.ndarray, total: int) -> tuple[float, np.ndarray]:
        """-log prod(1 - m) and the marginals m."""
        if not len(at):
            return 0.0, np.zeros(0)
        m = self.marginals(at, which, total)
        return float(-np.log(np.maximum(1 - m, 1e-12)).sum()), m

    def score(self, evidence: float) -> float:
        return float(1 / (1 + np.exp(-(self.slope * evidence + self.level))))


def calibrated(x: np.ndarray, y: np.ndarray, steps: int = 60) -> tuple[float, float]:
    """Slope and level of a logistic curve by Newton's method, with a little shrinkage."""
    w, design = np.zeros(2), np.column_stack((x, np.ones(len(x))))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        h = design.T @ (design * (p * (1 - p))[:, None]) + np.eye(2) * 1e-2
        w += np.clip(np.linalg.solve(h, design.T @ (y - p) - 1e-2 * w), -2, 2)
    return float(w[0]), float(w[1])


def offending(docs: list[tuple[int, list[int], list[int]]]) -> list[int]:
    """Words that stand out in toxic documents by their surroundings.  docs: (label, words, hash of both neighbours).

    A word counts once for each document and once for each pair of neighbours, whichever is less, so words that only
    copies of some toxic document share, always between the same neighbours, hardly count.
    """
    n, held, around = [0, 0], [{}, {}], [{}, {}]
    for label, words, sides in docs:
        n[label] += 1
        for w in set(words):
            held[label][w] = held[label].get(w, 0) + 1
        for w, side in zip(words, sides):
            around[label].setdefault(w, set()).add(side)
    out = []
    for w, docs_ in held[1].items():
        k = min(docs_, len(around[1][w]))
        lift = (k / n[1]) / ((held[0].get(w, 0) + 0.5) / (n[0] + 1))
        if lift >= LIFT and k * np.log(lift) >= GAIN:  # k * log(lift) is about the log of the odds against chance
            out.append(w)
    return sorted(out)


def train(windows: np.ndarray, states: np.ndarray, n_words: int, steps: int = 120, rate: float = 0.5, decay: float = 1e-5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gradient ascent on the conditional log likelihood.  windows: word index (0: other, -1: none) of equal lengths."""
    b, length = windows.shape
    if b:  # equal windows with equal states count together
        both, times = np.unique(np.hstack((windows, states)), axis=0, return_counts=True)
        windows, states = both[:, :length], both[:, length:]
    else:
        times = np.zeros(0, np.int64)
    there, word = windows >= 0, np.maximum(windows, 0)
    emit, start, move = np.zeros((n_words + 1, 2)), np.zeros(2), np.zeros((2, 2))
    weight = times.astype(float)
    y = np.eye(2)[states] * there[..., None] * weight[:, None, None]
    pair = there[:, 1:] & there[:, :-1]
    seen_move = np.array([[((pair & (states[:, :-1] == i) & (states[:, 1:] == j)).sum(1) * weight).sum() for j in range(2)] for i in range(2)], float)
    seen_emit = np.zeros_like(emit)
    np.add.at(seen_emit, word[there], y[there])
    sums = [np.zeros_like(x) for x in (emit, start, move)]
    for _ in range(steps):
        e = np.where(there[..., None], emit[word], 0)
        a, z = np.zeros((len(windows), length, 2)), np.zeros((len(windows), length, 2))
        a[:, 0] = start + e[:, 0]
        for t in range(1, length):
            on = there[:, t, None]
            a[:, t] = np.where(on, np.logaddexp(a[:, t - 1, 0, None] + move[0], a[:, t - 1, 1, None] + move[1]) + e[:, t], a[:, t - 1])
        for t in range(length - 2, -1, -1):
            on = there[:, t + 1, None]
            n = z[:, t + 1] + e[:, t + 1]
            z[:, t] = np.where(on, np.logaddexp(move[:, 0] + n[:, 0, None], move[:, 1] + n[:, 1, None]), z[:, t + 1])
        total = np.logaddexp(a[:, -1, 0], a[:, -1, 1])
        p = np.exp(a + z - total[:, None, None]) * there[..., None] * weight[:, None, None]
        want_emit = np.zeros_like(emit)
        np.add.at(want_emit, word[there], p[there])
        two = np.exp(a[:, :-1, :, None] + move + (z[:, 1:] + e[:, 1:])[:, :, None, :] - total[:, None, None, None]) * (pair * weight[:, None])[..., None, None]
        grads = [(seen_emit - want_emit), (y[:, 0] - p[:, 0]).sum(0), seen_move - two.sum((0, 1))]
        for x, g, s in zip((emit, start, move), grads, sums):
            g = g / max(1, b) - decay * x
            s += g * g
            x += rate * g / np.sqrt(s + 1e-8)
    return emit, start, move


def _document_features(batches) -> Iterator:
    """(label, text) -> (label, feature, documents of this chunk that have it)."""
    import pyarrow as pa

    for batch in batches:
        labels = batch.column(0).to_numpy(zero_copy_only=False)
        data, offsets = tx.flat(batch.column(1))
        for first, last in tx.chunks(offsets, tx.CHUNK // 2):
            w = tx.words_of(data, offsets, first, last, tx.ALNUM)
            pairs = [(h, w.row[at]) for at, h in feature_hashes(w)]
            h, row = np.concatenate([x[0] for x in pairs]), np.concatenate([x[1] for x in pairs])
            order = np.argsort(row, kind="stable")
            h, row, _ = tx.distinct_in_rows(h[order], row[order], last - first)
            for label in (0, 1):
                keys, n = np.unique(h[labels[first + row] == label], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), label, np.int32)), pa.array(keys.view(np.int64)), pa.array(n.astype(np.int64))], ["label", "feature", "n"])


def _placing(keys: np.ndarray, rank: np.ndarray):
    """(label, text) -> its length, and places, symbols and neighbours of the words with features."""

    def place(batches) -> Iterator:
        import pyarrow as pa

        held = np.zeros(1 << 16, bool)
        held[keys >> np.uint64(48)] = True
        for batch in batches:
            data, offsets = tx.flat(batch.column(1))
            out = []
            for first, last in tx.chunks(offsets):
                w = tx.words_of(data, offsets, first, last, tx.ALNUM)
                symbol, h = symbols(w, keys, held, rank), tx.word_hashes(w)
                edged = np.concatenate(([0], h, [0])).astype(np.uint64)
                ends = np.cumsum(w.count)
                for r, (a, b) in enumerate(zip((ends - w.count).tolist(), ends.tolist())):
                    at = np.flatnonzero(symbol[a:b])
                    sides = tx.mixed(edged[a + at] * np.uint64(3) + edged[a + at + 2])
                    out.append((b - a, at.tolist(), symbol[a + at].tolist(), sides.view(np.int64).tolist()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x[0] for x in out], pa.int64()), *[pa.array([x[i] for x in out], pa.list_(pa.int64())) for i in (1, 2, 3)]], ["label", "n", "at", "symbol", "sides"])

    return place


def fit(labelled: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", training_rows: int = TRAINING_ROWS, training_bytes: int = TRAINING_BYTES) -> Field:
    """Train on rows (doc_id, text, label 0/1)."""
    rows = labelled.select(F.col(doc_id).alias("i"), F.col(text).alias("text"), F.col(label).cast("int").alias("label")).where("label in (0, 1) and text is not null")
    many = rows.agg(F.count("*")).first()[0]  # reads no texts
    share, s = min(1.0, training_rows / max(many, 1)), Scratch(rows.sparkSession, "toxic")
    place = F.conv(F.substring(F.md5(F.concat(F.lit("toxic:"), F.coalesce(F.col("i").cast("string"), F.lit(""))).cast("binary")), 1, 8), 16, 10).cast("double") / float(1 << 32)
    rows = s.cut(rows.withColumn("place", place).where(F.col("place") < share).select("label", "text", "place"), "drawn")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    rows = s.cut(rows.where(F.col("place") < share * min(1.0, training_bytes / max(size, 1))).select("label", "text").distinct(), "sample")
    held = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(held) < 2:
        return Field()
    sums = rows.mapInArrow(_document_features, "label int, feature long, n long").groupBy("feature").agg(F.sum(F.expr("if(label = 1, n, 0)")).alias("bad"), F.sum(F.expr("if(label = 0, n, 0)")).alias("good"))
    sums = sums.withColumn("lift", (F.col("bad") / held[1]) / ((F.col("good") + 0.5) / (held[0] + 1)))
    best = sums.where((F.col("lift") >= LIFT) & (F.col("bad") * F.log("lift") >= GAIN)).orderBy(F.desc(F.col("bad") * F.log("lift")), "feature")
    hashes = np.array([r["feature"] for r in best.select("feature").collect()], np.int64).view(np.uint64)  # of the sample
    order = np.argsort(hashes)
    keys, rank = hashes[order], order + 1
    found = _placed(rows, keys, rank)
    bad = np.array(offending([(f[0], f[3], f[4]) for f in found]), np.int64)
    if not len(bad):
        return Field()
    keep = np.isin(rank, bad)
    keys, rank = keys[keep], np.searchsorted(bad, rank[keep]) + 1
    found = _placed(rows, keys, rank)
    windows, states, rng, length = [], [], np.random.default_rng(11), 2 * RADIUS + 1
    for label_, total, where, which, _ in found:
        have = dict(zip(where, which))
        spots = [*where, int(rng.integers(total))] if total else []
        for spot in spots:
            span = range(max(0, spot - RADIUS), min(total, spot + RADIUS + 1))
            pad = [-1] * (length - len(span))
            windows.append([have.get(i, 0) for i in span] + pad)
            states.append([int(label_ and i in have) for i in span] + [0] * len(pad))
    windows, states = np.array(windows, np.int64).reshape(-1, length), np.array(states, np.int64).reshape(-1, length)
    model = Field(keys, rank, *train(windows, states, len(bad)))
    x = np.array([model.evidence(np.array(f[2]), np.array(f[3]), f[1])[0] for f in found])
    model.slope, model.level = calibrated(x, np.array([f[0] for f in found], float))
    return model


def _placed(rows: DataFrame, keys: np.ndarray, rank: np.ndarray) -> list[tuple]:
    """(label, length, places, symbols, neighbours) of every training row: about TRAINING_ROWS of them."""
    return sorted(tuple(r) for r in rows.mapInArrow(_placing(keys, rank), "label int, n long, at array<long>, symbol array<long>, sides array<long>").collect())


SPANS = T.ArrayType(T.StructType([T.StructField("begin", T.IntegerType()), T.StructField("stop", T.IntegerType()), T.StructField("p", T.DoubleType())]))


def score(docs: DataFrame, model: Field, *, text: str = "text", at: float = AT) -> DataFrame:
    """``docs`` and score (0 to 1), spans (offending words: byte range, marginal)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    fields = [f for f in docs.schema if f.name not in ("score", "spans")]
    schema = T.StructType([*fields, T.StructField("score", T.DoubleType()), T.StructField("spans", SPANS)])
    names = [f.name for f in fields]
    text_at = names.index(text)

    def judge(batches) -> Iterator:
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        target, m = to_arrow_schema(schema), shared.value
        for batch in batches:
            data, offsets = tx.flat(batch.column(text_at))
            scores, spans = np.full(batch.num_rows, m.score(0.0)), [[] for _ in range(batch.num_rows)]
            for first, last in tx.chunks(offsets) if len(m.keys) else ():
                w = tx.words_of(data, offsets, first, last, tx.ALNUM)
                symbol = symbols(w, m.keys, m.held, m.rank)
                place = np.flatnonzero(symbol)
                which = symbol[place]
                starts = np.cumsum(w.count) - w.count
                row = w.row[place]
                cuts = np.searchsorted(row, np.arange(last - first + 1))
                for r in np.unique(row).tolist():
                    own = slice(cuts[r], cuts[r + 1])
                    evidence, p = m.evidence(place[own] - starts[r], which[own], int(w.count[r]))
                    scores[first + r] = m.score(evidence)
                    base = int(offsets[first + r] - offsets[first])
                    spans[first + r] = [{"begin": int(w.begin[i]) - base, "stop": int(w.stop[i]) - base, "p": float(x)} for i, x in zip(place[own], p) if x >= at]
            yield pa.RecordBatch.from_arrays([*[batch.column(i).cast(target.field(i).type) for i in range(len(names))], pa.array(scores), pa.array(spans, target.field("spans").type)], schema=target)

    return docs.select(*names).mapInArrow(judge, schema)

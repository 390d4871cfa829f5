"""Quality classifier trained on weak labels.

1. *Labellers*: overlapping heuristics over a whole text vote bad (0), good
   (1) or abstain.  Votes are counted by pattern over all documents; there
   are at most 3 ** (number of labellers) patterns, whatever the input.
2. *Label model*: expectation-maximisation over the pattern counts estimates
   how often each labeller votes what on good and on bad documents, and the
   posterior of every pattern.
3. *Scorer*: a logistic regression on hashed word, word-shape and repetition
   features, trained on the posterior labels of a bounded sample
   (``SAMPLE_ROWS`` documents, those of the smallest hash, fewer if they
   have more than ``SAMPLE_FEATURES`` features together; every one with all
   its features, as it is scored), scores every document.

No gold label is read.

Defined results: texts of fewer than ``FEW_WORDS`` words (null and empty ones
too) get no votes and so the class prior as their label, and are scored by a
feature of their own; equal texts get equal scores; an empty table gives an empty
result (the scorer then has no weights); further columns of the input, of
any name, are passed on by ``keep_good`` and ignored by ``quality_scores``.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from operator import eq
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from occurrence_lake.llm.common import ship

#: Bounds of the fit: documents, features of all of them, hashed features.
SAMPLE_ROWS = 4000
SAMPLE_FEATURES = 4_000_000
BUCKETS = 1 << 18
FEW_WORDS = 3

_ABSTAIN = 2
_LETTERS = bytes(b for b in range(256) if chr(b).isalpha() and b < 128)
_UPPER = bytes(range(65, 91))
_CONTINUED, _BEYOND = bytes(range(0x80, 0xC0)), bytes(range(0xC0, 0x100))
_ENDS = frozenset(".!?\u2026\u3002")


def statistics(text: str, words: list[str] | None = None) -> dict[str, float]:
    """What the labellers look at, as shares of the whole text.  Characters
    beyond ASCII count as letters."""
    words = text.split() if words is None else words
    n = len(words)
    if n < FEW_WORDS:
        return {"words": n}
    raw = "".join(words).encode("utf-8", "replace")
    chars = raw.translate(None, _CONTINUED)
    plain = len(chars.translate(None, _LETTERS + _BEYOND))
    upper = len(raw) - len(raw.translate(None, _UPPER))
    ascii_letters = len(raw) - len(raw.translate(None, _LETTERS))
    noise = bare = ends = short = 0
    counts = Counter(words)
    for w, c in counts.items():
        if not w[-1].isalnum():
            if w[-1] in _ENDS:
                ends += c
            if not w[-2:-1].isalnum():
                if len(w) > 1:
                    noise += c
                if not any(map(str.isalnum, w)):
                    bare += c
                    continue
        if len(w) <= 3:
            short += c
    return {
        "words": n,
        "other": plain / len(chars),
        "upper": upper / max(1, ascii_letters),
        "noise": noise / n,
        "bare": bare / n,
        "again": sum(map(eq, words, words[1:])) / n,
        "distinct": len(counts) / n,
        "sentence": n / max(1, ends),
        "short": short / max(1, n - bare),
    }


def _from(name: str, bad: float):
    """Votes bad from ``bad`` on."""
    return lambda s: 0 if s[name] >= bad else _ABSTAIN


def _prose(s: dict[str, float]) -> int:
    calm = s["noise"] <= 0.03 and s["bare"] <= 0.03 and s["again"] <= 0.05 and s["upper"] <= 0.25 and s["other"] <= 0.1
    return 1 if calm else _ABSTAIN


#: Votes on texts of at least FEW_WORDS words; all abstain on shorter ones.
LABELLERS = {
    "other characters": _from("other", 0.15),
    "upper case": _from("upper", 0.35),
    "noisy word ends": _from("noise", 0.1),
    "bare symbols": _from("bare", 0.1),
    "repeated neighbours": _from("again", 0.15),
    "few distinct words": lambda s: 0 if s["words"] >= 20 and s["distinct"] < 0.25 else _ABSTAIN,
    "long sentences": lambda s: 0 if s["sentence"] > 80 else _ABSTAIN,
    "few short words": lambda s: 0 if s["words"] >= 20 and s["short"] < 0.1 else _ABSTAIN,
    "prose": _prose,
    "sentences": lambda s: 1 if 3 <= s["sentence"] <= 40 else _ABSTAIN,
    "short words": lambda s: 1 if 0.15 <= s["short"] <= 0.75 else _ABSTAIN,
}


def vote_pattern(text: str | None) -> int:
    """All votes as one number in base 3."""
    s = statistics(text or "")
    code = 0
    for vote in LABELLERS.values():
        code = 3 * code + (vote(s) if s["words"] >= FEW_WORDS else _ABSTAIN)
    return code


def votes_of(codes: np.ndarray) -> np.ndarray:
    k = len(LABELLERS)
    return np.stack([(codes // 3 ** (k - 1 - i)) % 3 for i in range(k)], axis=1)


def label_model(patterns: dict[int, int], rounds: int = 200) -> tuple[dict[int, float], np.ndarray, float]:
    """(pattern -> posterior that the text is good, labeller x class x vote
    probabilities, prior of good), by expectation-maximisation."""
    codes = np.array(sorted(patterns), np.int64)
    if not len(codes):
        return {}, np.zeros((0, 2, 3)), 0.5
    weight = np.array([patterns[c] for c in codes.tolist()], float)
    votes = votes_of(codes)
    cast = votes != _ABSTAIN
    share = ((votes == 1).sum(1) + 1.0) / (cast.sum(1) + 1.5)
    good = np.where(cast.any(1), share, 0.7)
    for _ in range(rounds):
        seen = weight * cast.any(1)
        prior = np.clip((seen @ good + 7) / (seen.sum() + 10), 0.01, 0.99)
        table = np.empty((votes.shape[1], 2, 3))
        for c, p in ((0, 1 - good), (1, good)):
            for v in range(3):
                # one pseudo-count, and the belief that labellers beat chance
                table[:, c, v] = (seen * p) @ (votes == v) + (3.0 if v == c else 1.0)
        table /= table.sum(2, keepdims=True)
        log = np.log(table)
        each = [sum(log[j, c, votes[:, j]] for j in range(votes.shape[1])) for c in (0, 1)]
        new = 1 / (1 + np.exp(np.clip(each[0] - each[1] + np.log((1 - prior) / prior), -50, 50)))
        done = np.abs(new - good).max() < 1e-9
        good = new
        if done:
            break
    good = np.where(cast.any(1), good, prior)  # nothing is known of a text without votes
    return dict(zip(codes.tolist(), good.tolist())), table, float(prior)


#: Characters of a shape: capital, small letter, digit; others stay.
_SHAPE = {**{c: "A" for c in range(0x250) if chr(c).isupper()}, **{c: "a" for c in range(0x250) if chr(c).islower()}, **{c: "0" for c in range(48, 58)}}


def word_features(word: str) -> tuple[int, int]:
    """Buckets of a word and of the shape of its ends."""
    shape = (word[:2] + word[-2:]).translate(_SHAPE)
    return crc32(b"w" + word.encode("utf-8", "replace")) % BUCKETS, crc32(b"s" + shape.encode("utf-8", "replace")) % BUCKETS


def text_features(text: str | None, words: list[str] | None = None) -> list[int]:
    """Buckets of a text's shares."""
    s = statistics(text or "", words)
    if s["words"] < FEW_WORDS:
        return [crc32(b"few") % BUCKETS]
    return [crc32(f"{name}{min(9, int(20 * s[name]))}".encode()) % BUCKETS for name in ("again", "distinct", "noise", "bare", "upper", "other")]


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, values): words and shapes by their share, repetition by 1."""
    words = (text or "").split()
    total: Counter[int] = Counter()
    for w, c in Counter(words).items():
        for f in word_features(w):
            total[f] += c
    values = {f: c / len(words) for f, c in total.items()}
    for f in text_features(text, words):
        values[f] = values.get(f, 0.0) + 1.0
    return np.fromiter(values, np.int64, len(values)), np.fromiter(values.values(), np.float64, len(values))


def train(rows: list[tuple[np.ndarray, np.ndarray, float]], rounds: int = 80, rate: float = 0.3, decay: float = 1e-4) -> np.ndarray:
    """Weights (the last is the bias) of a logistic regression on posterior
    labels; full-batch Adam from zero, so equal samples give equal weights."""
    if not rows:
        return np.zeros(BUCKETS + 1)
    at = np.concatenate([r[0] for r in rows])
    value = np.concatenate([r[1] for r in rows])
    row = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
    goal = np.array([r[2] for r in rows])
    used, at = np.unique(at, return_inverse=True)
    w = np.zeros(len(used) + 1)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, rounds + 1):
        z = np.bincount(row, value * w[at], len(rows)) + w[-1]
        off = (1 / (1 + np.exp(-np.clip(z, -50, 50))) - goal) / len(rows)
        g = np.append(np.bincount(at, value * off[row], len(used)) + decay * w[:-1], off.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    out = np.zeros(BUCKETS + 1)
    out[used], out[-1] = w[:-1], w[-1]
    return out


class WordWeights(dict):
    """Word -> its weight, filled as words come; forgets when it is full."""

    def __init__(self, weights: np.ndarray, most: int = 300_000):
        super().__init__()
        self.weights, self.most = weights, most

    def __missing__(self, word: str) -> float:
        if len(self) >= self.most:
            self.clear()
        a, b = word_features(word)
        self[word] = out = float(self.weights[a] + self.weights[b])
        return out


def score(text: str | None, by_word: WordWeights) -> float:
    words = (text or "").split()
    z = float(by_word.weights[-1])
    if words:
        z += sum(map(by_word.__getitem__, words)) / len(words)
    z += sum(float(by_word.weights[f]) for f in text_features(text, words))
    return float(1 / (1 + np.exp(-np.clip(z, -50, 50))))


def fit(df: DataFrame, text_col: str = "text", sample_rows: int = SAMPLE_ROWS, sample_features: int = SAMPLE_FEATURES, id_col: str = "doc_id") -> np.ndarray:
    """The scorer's weights: vote counts over all rows, then a sample of
    whole texts.  The sample goes by a hash of id and text, so the weights do
    not depend on how the rows are partitioned."""
    texts = df.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"))

    def patterns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([vote_pattern(t.as_py()) for t in batch.column(0)], pa.int32())], names=["pattern"])

    counted = {r["pattern"]: r["count"] for r in texts.select("text").mapInArrow(patterns, "pattern int").groupBy("pattern").count().collect()}
    posterior, _, _ = label_model(counted)
    total = sum(counted.values())
    if not total:
        return np.zeros(BUCKETS + 1)

    # Expected 1.2 x sample_rows rows pass the hash filter before the exact
    # bound; equal texts differ in their id, so copies are not all in or all
    # out, and rows of one hash are alike.
    spread = F.xxhash64("text", "id")
    chosen = (texts.withColumn("h", spread).where(F.abs(F.col("h") / 2.0**63) <= min(1.0, 1.2 * sample_rows / total))
              .orderBy("h").limit(sample_rows).select("h", "text").repartition(16, "h"))

    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                text = batch.column(1)[i].as_py()
                at, value = features(text)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, 1), pa.array([len(at)], pa.int64()), pa.array([vote_pattern(text)], pa.int32()),
                     pa.array([at.astype(np.int32).tobytes()], pa.binary()), pa.array([value.tobytes()], pa.binary())],
                    names=["h", "n", "pattern", "at", "value"])

    # Whole rows up to the bound (the first always): it holds before the driver sees them.
    so_far = F.sum("n").over(Window.orderBy("h").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = (chosen.mapInArrow(sampled, "h bigint, n bigint, pattern int, at binary, value binary").withColumn("so_far", so_far)
            .where((F.col("so_far") <= sample_features) | (F.col("so_far") == F.col("n"))).select("pattern", "at", "value").collect())
    return train([(np.frombuffer(r["at"], np.int32), np.frombuffer(r["value"]), posterior.get(r["pattern"], 0.5)) for r in rows])


def scorer(weights: np.ndarray):
    """A column function: text -> quality."""
    used = np.flatnonzero(weights)
    at, value = used.astype(np.int32), weights[used].astype(np.float32)

    @F.pandas_udf("double")
    def quality(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        dense = np.zeros(BUCKETS + 1, np.float32)
        dense[at] = value
        by_word = WordWeights(dense)
        for texts in parts:
            yield pd.Series([score(t, by_word) for t in texts], dtype="float64")

    return quality


def quality_scores(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5,
                   weights: np.ndarray | None = None) -> DataFrame:
    """One row per input row: id, ``quality`` (0 to 1), ``keep``."""
    quality = scorer(fit(df, text_col, id_col=id_col) if weights is None else weights)
    out = df.select(F.col(id_col).alias("id"), quality(F.col(text_col).cast("string")).alias("quality"))
    return out.select(F.col("id").alias(id_col), "quality", (F.col("quality") >= threshold).alias("keep"))


def keep_good(df: DataFrame, text_col: str = "text", threshold: float = 0.5, weights: np.ndarray | None = None, id_col: str = "doc_id") -> DataFrame:
    """The rows of ``df`` whose quality reaches the threshold."""
    quality = scorer(fit(df, text_col, id_col=id_col) if weights is None else weights)
    return df.where(quality(F.col(text_col).cast("string")) >= threshold)


ship(__name__)

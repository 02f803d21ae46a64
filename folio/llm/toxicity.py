"""Toxicity by compression distance to a toxic and an ordinary zstandard dictionary.

A window is a word (a run of letters, in lower case) between spaces. The dictionaries are learned from windows and
their beginnings: what stands in more training texts of a class than chance allows becomes that class's content, the
most telling last, where zstandard's offsets are shortest. They are raw-content dictionaries, as the library's trainer
keeps nothing of samples of a few bytes. Each window is compressed behind an anchor that both dictionaries hold, which
pays for the frame once, so that the difference of the two lengths is what the window itself saves. Windows that the
toxic dictionary shortens by a calibrated number of bytes or more are counted; a logistic model turns the count and
its share of all windows into the score.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bound of the training sample: so many labelled rows, by hash of doc_id, of texts up to so many characters.
TRAIN_ROWS = 4000
TRAIN_CHARS = 20_000
BEGINNINGS = (5, 6, 7)
#: Content must stand in so many training texts, so many standard deviations over its share in the other class, and
#: that many times the best content's deviations.
MIN_TEXTS = 3
MIN_DEVIATIONS = 5.0
SHARE_OF_BEST = 0.15
DICTIONARY_BYTES = 8192
_ANCHOR = b"\x01#anchor#\x02"
#: zstandard looks for no match in the last 8 bytes.
_TAIL = b"\x03\x04\x05\x06\x07\x08\x0e\x0f"
_LETTERS = bytes(b if chr(b).isalpha() or b >= 0x80 else 0x20 for b in range(256))
_MEMO = 300_000


def _words(text: str) -> list[bytes]:
    """Runs of letters, in lower case; characters beyond ASCII count as letters."""
    return text.lower().encode("utf-8", "replace").translate(_LETTERS).split()


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _units(text: str) -> set[bytes]:
    found = set()
    for w in set(_words(text)):
        w = b" %b " % w
        found.add(w)
        found.update(w[:k] for k in BEGINNINGS if len(w) > k + 1)
    return found


def _content(own: Counter, n_own: int, other: Counter, n_other: int) -> bytes:
    telling = {}
    for u, c in own.items():
        if c >= MIN_TEXTS:
            expected = (other[u] + 1) / (n_other + 1) * n_own
            if (z := (c - expected) / math.sqrt(expected + 1)) >= MIN_DEVIATIONS:
                telling[u] = z
    least = SHARE_OF_BEST * max(telling.values(), default=0)
    telling = {u: z for u, z in telling.items() if z >= least}
    # Of units that begin alike, the longest that stands in nearly as many texts.
    longer: set[bytes] = set()
    for u in sorted(telling, key=len):
        begun = [u[:k] for k in BEGINNINGS if k < len(u) and u[:k] in telling]
        if any(own[u] < 0.7 * own[b] for b in begun):
            longer.add(u)
        else:
            longer.update(begun)
    return b"".join(sorted(telling.keys() - longer, key=lambda u: (telling[u], u)))[-DICTIONARY_BYTES:]


class Distance:
    """Bytes that the toxic dictionary saves on a window over the ordinary one; picklable."""

    def __init__(self, ordinary: bytes, toxic: bytes) -> None:
        self.content = (ordinary, toxic)
        self._memo: dict[bytes, int] = {}
        self._pair = None

    def __reduce__(self) -> tuple:
        return Distance, self.content

    def __call__(self, word: bytes) -> int:
        d = self._memo.get(word)
        if d is None:
            if self._pair is None:
                params = zstandard.ZstdCompressionParameters(format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=0, write_checksum=0, write_dict_id=0, min_match=3, window_log=15, hash_log=13, chain_log=13, search_log=6, target_length=64, strategy=zstandard.STRATEGY_BTULTRA)
                self._pair = [zstandard.ZstdCompressor(compression_params=params, dict_data=zstandard.ZstdCompressionDict(c + _ANCHOR, dict_type=zstandard.DICT_TYPE_RAWCONTENT)) for c in self.content]
            window = b"%b %b %b" % (_ANCHOR, word, _TAIL)
            d = len(self._pair[0].compress(window)) - len(self._pair[1].compress(window))
            if len(self._memo) >= _MEMO:
                self._memo.clear()
            self._memo[word] = d
        return d


def _features(hits: np.ndarray, windows: np.ndarray) -> np.ndarray:
    return np.stack([np.ones(len(hits)), np.log1p(hits), 100 * hits / np.maximum(windows, 1)], axis=1)


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Newton's method with a small ridge."""
    beta, ridge = np.zeros(x.shape[1]), 1e-2 * np.eye(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ beta)
        beta += step
        if np.abs(step).max() < 1e-9:
            break
    return beta


class Model:
    """A fitted classifier: distance, threshold in bytes, weights."""

    def __init__(self, distance: Distance, threshold: int, beta: np.ndarray) -> None:
        self.distance, self.threshold, self.beta = distance, threshold, beta

    def count(self, text: str) -> tuple[int, int]:
        """Windows, and those that the toxic dictionary shortens by the threshold."""
        words, d, t = _words(text), self.distance, self.threshold
        memo = d._memo
        return len(words), sum((memo[w] if w in memo else d(w)) >= t for w in words)

    def scores(self, hits: np.ndarray, windows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(_features(hits, windows) @ self.beta, -30, 30)))


def fit(rows: list[tuple[str, int]]) -> Model:
    """From (text, label). Equal texts count once. Without rows of both classes every score is the share of toxic rows."""
    rows = sorted({t: y for t, y in sorted(rows)}.items())
    y = np.array([b for _, b in rows], float)
    if not len(y) or y.min() == y.max():
        rate = float(np.clip(y.mean() if len(y) else 0, 1e-6, 1 - 1e-6))
        return Model(Distance(b"", b""), 1, np.array([math.log(rate / (1 - rate)), 0, 0]))
    # One fold's dictionaries judge the other fold when the threshold and the weights are calibrated.
    units = [_units(t) for t, _ in rows]
    fold = np.arange(len(rows)) % 2

    def learn(part: np.ndarray) -> Distance:
        counts = (Counter(), Counter())
        for i in part:
            counts[int(y[i])].update(units[i])
        n = int(y[part].sum())
        return Distance(_content(counts[0], len(part) - n, counts[1], n), _content(counts[1], n, counts[0], len(part) - n))

    found = [None] * len(rows)
    for f in (0, 1):
        d = learn(np.flatnonzero(fold != f))
        for i in np.flatnonzero(fold == f):
            found[i] = np.bincount([min(max(d(w), 0), 7) for w in _words(rows[i][0])], minlength=8)
    saved = np.array(found)
    windows, best = saved.sum(axis=1), None
    for t in range(1, 7):
        x = _features(saved[:, t:].sum(axis=1), windows)
        beta = _logistic(x, y)
        p = np.clip(1 / (1 + np.exp(-np.clip(x @ beta, -30, 30))), 1e-9, 1 - 1e-9)
        loss = -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()
        if best is None or loss < best[0]:
            best = (loss, t, beta)
    return Model(learn(np.arange(len(rows))), best[1], best[2])


def train(documents: DataFrame, labels: DataFrame) -> Model:
    """Fits to labelled rows whose doc_id is not held out; TRAIN_ROWS and TRAIN_CHARS bound what reaches the driver."""
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("doc_id is not null and toxic in (0, 1)").where(~held_out(F.col("doc_id")))
    by_hash = [F.md5(F.col("doc_id").cast("string").cast("binary")), F.col("doc_id")]
    ids = {r.doc_id: r.toxic for r in rows.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(*by_hash).limit(TRAIN_ROWS).collect()}
    if not ids:
        return fit([])
    picked = documents.sparkSession.createDataFrame([(i,) for i in ids], "doc_id long")
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(picked), "doc_id").where(F.length("text") <= TRAIN_CHARS)
    return fit([(r.text, ids[r.doc_id]) for r in texts.groupBy("doc_id").agg(F.min("text").alias("text")).collect()])


def score(documents: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score, predicted, n_windows, n_toxic) of each row.

    Null and empty texts have no window and get the score of none. doc_id, lang and source are no input of the score;
    equal texts get equal scores; an empty table gives none; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = np.array([model.count(t.as_py() or "") for t in batch.column(1)], np.int64).reshape(-1, 2)
            s = model.scores(counts[:, 1], counts[:, 0])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s), pa.array((s >= 0.5).astype(np.int32)), pa.array(counts[:, 0]), pa.array(counts[:, 1])], ["doc_id", "score", "predicted", "n_windows", "n_toxic"])

    scored = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, score double, predicted int, n_windows long, n_toxic long")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", "n_windows", "n_toxic")

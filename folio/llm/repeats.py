"""Repeated passages across documents, by the common-prefix interval tree of a suffix array.

Every window of ``least`` bytes belongs to the run of neighbouring windows with the same minimizer, the least hash of
the byte k-mers in it. Equal windows have equal minimizers, so runs dealt out by minimizer bring all windows together
that can be equal, at about one row of 17 bytes for 16 bytes of text.

Runs that are equal as a whole are settled by their hashes. Where runs of one minimizer differ, their texts are
fetched and their suffixes are sorted by the first ``least`` bytes, by prefix doubling: the intervals of the common-prefix
tree at that depth. A byte goes if an interval's string covers it and a smaller document is in the interval; what lies deeper
in the tree (maximal_repeats) covers the same bytes with the same documents. Minimizers with more than HOT_RUNS different
runs (a passage that stands in a large share of all documents) are split into their windows, whose owners are found
in buckets by hash. Equality of runs is that of a 64-bit hash of all their bytes and of their minimizer, equality of
windows that of two 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm.scratch import Scratch
from folio.llm.textbytes import TABLE, U, eights, mix, slices, span_hash

KMER = 20
HOT_RUNS = 1000
#: Runs are dealt to one bucket for so many bytes of text, windows to one for so many windows.
BUCKET_BYTES = 8 << 20
BUCKET_WINDOWS = 500_000
MIN_BUCKETS = 1000
#: Runs that are compared by their bytes go to one task for so many of them: long work for few bytes.
COMPARED_BYTES = 4 << 20
_SLICE = 2 << 20


def _least_in_windows(h: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Minimum of each w consecutive values."""
    span, m = 1, h
    while span * 2 <= w:
        m = np.minimum(m[: len(m) - span], m[span:])
        span *= 2
    return np.minimum(m[: len(h) - w + 1], m[w - span :][: len(h) - w + 1])


def runs(buf: np.ndarray, offsets: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
    """(start, windows, minimizer, hash) of the runs of a slice of texts, in order."""
    n, none = len(buf), (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64))
    if n < least:
        return none
    view, m = eights(buf), n - KMER + 1
    h = mix(view[:m] * TABLE[2] + view[8 : m + 8] * TABLE[3] + view[KMER - 8 : m + KMER - 8] * TABLE[4])
    m = _least_in_windows(h, least - KMER + 1)
    # A window must end within its text: the last least-1 starts of a text have none.
    step = np.zeros(n + 1, np.int32)
    np.add.at(step, np.maximum(offsets[:-1], offsets[1:] - least + 1), 1)
    np.add.at(step, offsets[1:], -1)
    valid = np.cumsum(step[: len(m)]) == 0
    first = valid.copy()
    first[1:] &= (m[1:] != m[:-1]) | ~valid[:-1]
    start = np.flatnonzero(first)
    stop = valid.copy()
    stop[:-1] &= (m[1:] != m[:-1]) | ~valid[1:]
    size = np.flatnonzero(stop) + 1 - start
    return start, size, m[start], span_hash(buf, start, start + size + least - 1)


def _pack(docs: np.ndarray, *columns: np.ndarray) -> bytes:
    """Ascending docs and int columns, as differences."""
    parts = [np.int64(len(docs)).tobytes(), np.diff(docs, prepend=0).astype(np.int64).tobytes()]
    return zstandard.ZstdCompressor(level=1).compress(b"".join([*parts, *(np.ascontiguousarray(c).tobytes() for c in columns)]))


def _unpack(blob: bytes, *kinds: type) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    out, at = [np.cumsum(np.frombuffer(raw, np.int64, n, 8))], 8 + 8 * n
    for kind in kinds:
        out.append(np.frombuffer(raw, kind, n, at))
        at += n * np.dtype(kind).itemsize
    return out


_DEALT = "bucket int, doc_id long, blob binary"
_MARK = "kind int, grp long, doc_id long, start long, size long, blob binary"
#: blob of kind 0: starts and ends of removed bytes. kind 1: a run to compare, kind 2: a run to split, of a minimizer grp.


def _by_doc(docs: np.ndarray, start: np.ndarray, end: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """(doc_id, blob) of the bytes to remove, overlapping stretches joined."""
    if not len(docs):
        return
    order = np.lexsort((start, docs))
    docs, start, end = docs[order], start[order], end[order]
    new_doc = np.append(True, docs[1:] != docs[:-1])
    # One running maximum serves all documents, as those of each are moved beyond those before.
    moved = (np.cumsum(new_doc) - 1) * (int(end.max()) + 1)
    reach = np.maximum.accumulate(end + moved)
    new = new_doc.copy()
    new[1:] |= start[1:] + moved[1:] > reach[:-1]
    first = np.flatnonzero(new)
    stop = (reach - moved)[np.append(first[1:] - 1, len(start) - 1)]
    start, docs = start[first], docs[first]
    cut = np.flatnonzero(np.append(True, docs[1:] != docs[:-1]))
    starts, stops = start.astype(np.int64).tobytes(), stop.astype(np.int64).tobytes()
    for d, a, b in zip(docs[cut].tolist(), (8 * cut).tolist(), [*(8 * cut[1:]).tolist(), len(starts)], strict=True):
        yield d, starts[a:b] + stops[a:b]


def _joined(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of stretches with ascending starts."""
    reach = np.maximum.accumulate(end)
    new = np.ones(len(start), bool)
    new[1:] = start[1:] > reach[:-1]
    last = np.flatnonzero(new)
    return start[last], reach[np.append(last[1:] - 1, len(start) - 1)]


def _owners(key: np.ndarray, h: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """The least doc of those with the same key and h."""
    both = mix(key) ^ h
    order = np.argsort(both)
    same = np.append(both[order[1:]] == both[order[:-1]], False)
    same[1:] |= same[:-1].copy()
    several, owner = order[same], doc.copy()
    order = several[np.lexsort((doc[several], h[several], key[several]))]
    new = np.ones(len(order), bool)
    new[1:] = (key[order[1:]] != key[order[:-1]]) | (h[order[1:]] != h[order[:-1]])
    owner[order] = doc[order][np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
    return owner


def _deal(docs: DataFrame, least: int, buckets: int) -> DataFrame:
    bits = U(64 - buckets.bit_length() + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for a, b, buf, offsets in slices(batch.column(1), _SLICE):
                start, size, key, h = runs(buf, offsets, least)
                if not len(start):
                    continue
                row = np.searchsorted(offsets, start, "right") - 1
                doc, start = ids[a:b][row], start - offsets[row]
                # Of equal runs in the slice only those of the least document go on; the others' bytes are settled.
                owner = _owners(key, h, doc)
                gone = doc > owner
                out = [(int(d) % buckets, d, x) for d, x in _by_doc(doc[gone], start[gone], (start + size + least - 1)[gone])]
                stay = np.flatnonzero(~gone)
                where = (key[stay] >> bits).astype(np.int64) if buckets > 1 else np.zeros(len(stay), np.int64)
                # Runs of a document are in order already.
                by = np.argsort(doc[stay], kind="stable")
                by = by[np.argsort(where[by].astype(np.uint16) if buckets <= 1 << 16 else where[by], kind="stable")]
                stay, where = stay[by], where[by]
                cut = np.flatnonzero(np.diff(where, prepend=-1))
                low = key.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]
                for x, y in zip(cut, [*cut[1:], len(stay)], strict=True):
                    i = stay[x:y]
                    out.append((int(where[x]), None, _pack(doc[i], np.ascontiguousarray(low[i].T), h[i], start[i].astype(np.int64), size[i].astype(np.int64))))
                yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int32()), pa.array([o[1] for o in out], pa.int64()), pa.array([o[2] for o in out], pa.binary())], ["bucket", "doc_id", "blob"])

    return docs.select("doc_id", "text").mapInArrow(run, _DEALT)


def _settle(dealt: DataFrame, least: int, hot_runs: int) -> DataFrame:
    """Marks from buckets: bytes of runs that a smaller document has as a whole, and runs to look at more closely."""

    def bucket(number: int, blobs: list[bytes]) -> Iterator[pa.RecordBatch]:
        parts = []
        for blob in blobs:
            doc, *rest = _unpack(blob, np.dtype("V5"), np.uint64, np.int64, np.int64)
            low = np.zeros((8, len(doc)), np.uint8)
            low[:5] = np.frombuffer(rest[0].tobytes(), np.uint8).reshape(5, -1)
            parts.append((np.ascontiguousarray(low.T).view("<u8").ravel(), rest[1], doc, rest[2], rest[3]))
        key, h, doc, start, size = (np.concatenate(c) for c in zip(*parts, strict=True))
        order = np.lexsort((doc, h, key))
        key, h, doc, start, size = key[order], h[order], doc[order], start[order], size[order]
        n = np.arange(len(key))
        new_key = np.ones(len(key), bool)
        new_key[1:] = key[1:] != key[:-1]
        new_run = new_key.copy()
        new_run[1:] |= h[1:] != h[:-1]
        owner = doc[np.maximum.accumulate(np.where(new_run, n, 0))]
        gone = doc > owner
        yield from _rows([(0, None, d, None, None, x) for d, x in _by_doc(doc[gone], start[gone], (start + size + least - 1)[gone])])
        # Minimizers with different runs of different documents.
        at = np.flatnonzero(new_key)
        group = np.cumsum(new_key) - 1
        differ = np.add.reduceat(new_run.astype(np.int64), at)
        own = owner[new_run]
        first = np.cumsum(np.append(0, differ[:-1]))
        spread = np.minimum.reduceat(own, first) < np.maximum.reduceat(own, first)
        look = ((differ > 1) & spread)[group] & ~gone
        kind = np.where(differ > hot_runs, 2, 1)[group][look]
        named = mix(key[look] ^ (U(number) << U(44))).view(np.int64)
        if look.any():
            k = int(look.sum())
            yield pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array(named), pa.array(doc[look]), pa.array(start[look]), pa.array(size[look]), pa.nulls(k, pa.binary())], _MARK_NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, blobs = None, []
        for batch in batches:
            for number, doc, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if number != current:
                    if blobs:
                        yield from bucket(current, blobs)
                    current, blobs = number, []
                if doc is None:
                    blobs.append(blob)
                else:
                    yield from _rows([(0, None, doc, None, None, blob)])
        if blobs:
            yield from bucket(current, blobs)

    return dealt.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, _MARK)


_MARK_NAMES = ["kind", "grp", "doc_id", "start", "size", "blob"]


def _rows(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    if rows:
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], _MARK_NAMES)


#: Masks of the first so many bytes of a number of 8 bytes, the first byte highest.
_FIRST_BYTES = np.array([((1 << 64) - 1) ^ ((1 << (8 * (8 - n))) - 1) for n in range(9)], np.uint64)


def suffix_array(buf: np.ndarray, ends: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes that start at ``at`` and stop at ``ends``, sorted, and the common-prefix length of each with the one before it."""
    view = eights(buf)
    length = ends - at
    depth = -(-int(length.max(initial=1)) // 8)
    order, group = np.arange(len(at)), np.zeros(len(at), np.int64)
    common = np.zeros(len(at), np.int64)
    open_ = np.arange(len(at))
    for d in range(depth):
        # Only suffixes that still share their group with another are compared by the next 8 bytes.
        p = at[order[open_]] + 8 * d
        left = np.clip(ends[order[open_]] - p, 0, 8)
        word = view[np.minimum(p, len(buf))].byteswap() & _FIRST_BYTES[left]
        by = np.lexsort((left, word, group[open_]))
        moved = order[open_][by]
        word, left, g = word[by], left[by], group[open_][by]
        order[open_] = moved
        same = np.zeros(len(open_), bool)
        same[1:] = (g[1:] == g[:-1]) & (word[1:] == word[:-1]) & (left[1:] == left[:-1])
        inside = np.zeros(len(open_), bool)
        inside[1:] = g[1:] == g[:-1]
        # Where they part within these bytes, the common length is final.
        apart = np.flatnonzero(inside & ~same)
        if len(apart):
            x = word[apart] ^ word[apart - 1]
            equal = np.full(len(apart), 8, np.int64)
            for i in range(7, -1, -1):
                equal[(x >> U(8 * (7 - i))) & U(255) != 0] = i
            equal = np.minimum(equal, np.minimum(left[apart], left[apart - 1]))
            common[open_[apart]] = 8 * d + equal
        whole = np.flatnonzero(same)
        common[open_[whole]] = 8 * d + left[whole]
        group[open_] = open_[np.maximum.accumulate(np.where(same, 0, np.arange(len(open_))))]
        more = same & (left == 8)
        more[:-1] |= more[1:]
        open_ = open_[more]
        if not len(open_):
            break
    return order, common


def maximal_repeats(buf: np.ndarray, offsets: np.ndarray, least: int) -> Iterator[tuple[int, np.ndarray]]:
    """(length, starts) of each maximal repeat of at least ``least`` bytes of the texts, with all its occurrences.

    Repeats don't cross texts. An occurrence at the start of a text differs from all others on its left.
    """
    n = len(buf)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    at = np.flatnonzero(offsets[1:][row] - np.arange(n) >= least) if n else np.zeros(0, np.int64)
    if len(at) < 2:
        return
    order, common = suffix_array(buf, offsets[1:][row[at]], at)
    sa = at[order]
    before = np.where(sa > offsets[row[sa]], buf[np.maximum(sa - 1, 0)].astype(np.int64), -1 - np.arange(len(sa)))
    # Stretches of suffixes with a common prefix of that length; those with one character on the left are no maximal repeats.
    deep = common >= least
    deep[0] = False
    begin = np.flatnonzero(~deep & np.append(deep[1:], False))
    stop = np.flatnonzero(deep & ~np.append(deep[1:], False)) + 1
    if not len(begin):
        return
    low = np.minimum.reduceat(before, np.stack([begin, stop], 1).ravel()[: 2 * len(begin) - (stop[-1] == len(sa))])[::2]
    high = np.maximum.reduceat(before, np.stack([begin, stop], 1).ravel()[: 2 * len(begin) - (stop[-1] == len(sa))])[::2]
    for a, b in zip(begin[low < high].tolist(), stop[low < high].tolist(), strict=True):
        lcp, left = common[a:b].tolist(), before[a:b].tolist()
        # Scan with a stack of open intervals: (common length, first suffix, its one character on the left or None).
        stack: list[list] = []
        for i in range(1, b - a + 1):
            now = lcp[i] if i < b - a else 0
            first, mark = i - 1, left[i - 1]
            while stack and stack[-1][0] > now:
                size, first, own = stack.pop()
                mark = own if own == mark else None
                if mark is None:
                    yield size, sa[a + first : a + i]
            if stack and stack[-1][0] == now:
                stack[-1][2] = stack[-1][2] if stack[-1][2] == mark else None
            elif now:
                stack.append([now, first, mark])


def _ranks(keys: np.ndarray) -> np.ndarray:
    """Of each key the number of lesser different ones."""
    order = np.argsort(keys)
    ordered = keys[order]
    out = np.empty(len(keys), np.uint64)
    out[order] = np.cumsum(np.append(False, ordered[1:] != ordered[:-1])) if len(keys) else 0
    return out


def intervals(buf: np.ndarray, at: np.ndarray, least: int) -> np.ndarray:
    """For each suffix of ``at``, of ``least`` bytes or more, the number of its interval at depth ``least`` in the common-prefix tree."""
    # Suffixes of all places, sorted by their first 8, 16, 32... bytes; the last two stretches overlap.
    ranks, size = _ranks(eights(buf)[: len(buf)].byteswap()), 8
    while size * 2 < least:
        later = np.zeros(len(buf), np.uint64)
        later[: max(0, len(buf) - size)] = ranks[size:]
        ranks, size = _ranks(ranks << U(32) | later), size * 2
    return _ranks(ranks[at] << U(32) | ranks[at + least - size]).astype(np.int64)


def _compare(segments: DataFrame, least: int, tasks: int) -> DataFrame:
    """kind 0 marks from (grp, doc_id, start, bytes), partitioned and sorted by grp."""

    def settle(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        buf = np.frombuffer(b"".join(r[3] for r in rows), np.uint8)
        offsets = np.concatenate([[0], np.cumsum([len(r[3]) for r in rows])])
        doc, start = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
        row_of = np.repeat(np.arange(len(rows)), np.diff(offsets))
        at = np.flatnonzero(offsets[1:][row_of] - np.arange(len(buf)) >= least)
        interval, owner = intervals(buf, at, least), doc[row_of[at]]
        smallest = np.full(len(at), np.iinfo(np.int64).max)
        np.minimum.at(smallest, interval, owner)
        late = at[owner > smallest[interval]]
        # How many more removed stretches begin than end at each byte.
        change = np.zeros(len(buf) + 1, np.int32)
        change[late] += 1
        change[late + least] -= 1
        gone = np.cumsum(change[:-1]) > 0
        edge = np.zeros(len(buf), bool)
        edge[offsets[:-1]] = True
        first = np.flatnonzero(gone & (edge | ~np.concatenate([[False], gone[:-1]])))
        last = np.flatnonzero(gone & (np.append(edge[1:], True) | ~np.append(gone[1:], False)))
        r = row_of[first]
        yield from _rows([(0, None, d, None, None, x) for d, x in _by_doc(doc[r], start[r] + first - offsets[r], start[r] + last + 1 - offsets[r])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held, last = [], 0, None
        for batch in batches:
            for r in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held >= _SLICE // 4 and r[0] != last:
                    yield from settle(rows)
                    rows, held = [], 0
                rows.append(r)
                held += len(r[3])
                last = r[0]
        if rows:
            yield from settle(rows)

    return segments.repartition(tasks, "grp").sortWithinPartitions("grp").mapInArrow(run, _MARK)


def _window_hashes(buf: np.ndarray, at: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of the ``least`` bytes from each position on."""
    view = eights(buf)
    one, two = np.full(len(at), TABLE[5]), np.full(len(at), TABLE[6])
    for i in [*range(0, least - 8, 8), least - 8]:
        word = view[at + i]
        one, two = mix(one ^ word), mix(two + word)
    return one, two


def _cut(joined: DataFrame, least: int, buckets: int) -> DataFrame:
    """(kind, grp, doc_id, start, bytes) of the runs asked for: kind 1 whole; kind 2 as packed hashes of their windows, dealt
    to buckets grp by hash, the least document's of those equal within a batch."""

    def windows(parts: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]) -> Iterator[tuple]:
        doc = np.concatenate([np.full(len(p[3]), p[0], np.int64) for p in parts])
        one, two, start = (np.concatenate([p[i] for p in parts]) for i in (1, 2, 3))
        where = (one % U(buckets)).astype(np.int64)
        order = np.lexsort((start, doc, where))
        doc, one, two, start, where = doc[order], one[order], two[order], start[order], where[order]
        cut = np.flatnonzero(np.diff(where, prepend=-1))
        for a, b in zip(cut, [*cut[1:], len(where)], strict=True):
            yield 2, int(where[a]), None, None, _pack(doc[a:b], one[a:b], two[a:b], start[a:b])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, hot = [], []
            for doc, text, asked in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                raw = text.encode("utf-8", "surrogatepass")
                spans = []
                for a in asked:
                    s, n = a["start"], a["size"]
                    if a["kind"] == 1:
                        out.append((1, a["grp"], doc, s, raw[s : s + n + least - 1]))
                    else:
                        spans.append(np.arange(s, s + n))
                if spans:
                    at = np.concatenate(spans)
                    hot.append((doc, *_window_hashes(np.frombuffer(raw, np.uint8), at, least), at))
            if hot:
                out += windows(hot)
            if out:
                kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], ["kind", "grp", "doc_id", "start", "bytes"])

    return joined.mapInArrow(run, "kind int, grp long, doc_id long, start long, bytes binary")


def _settle_windows(dealt: DataFrame, least: int) -> DataFrame:
    """(doc_id, blob) of the windows in (grp, bytes) that a smaller document has as well."""

    def bucket(blobs: list[bytes]) -> Iterator[pa.RecordBatch]:
        doc, one, two, start = (np.concatenate(c) for c in zip(*(_unpack(b, np.uint64, np.uint64, np.int64) for b in blobs), strict=True))
        order = np.lexsort((doc, two, one))
        doc, one, two, start = doc[order], one[order], two[order], start[order]
        new = np.ones(len(doc), bool)
        new[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
        gone = doc > doc[np.maximum.accumulate(np.where(new, np.arange(len(doc)), 0))]
        found = list(_by_doc(doc[gone], start[gone], start[gone] + least))
        yield pa.RecordBatch.from_arrays([pa.array([d for d, _ in found], pa.int64()), pa.array([b for _, b in found], pa.binary())], ["doc_id", "blob"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, blobs = None, []
        for batch in batches:
            for number, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if number != current and blobs:
                    yield from bucket(blobs)
                    blobs = []
                current = number
                blobs.append(blob)
        if blobs:
            yield from bucket(blobs)

    return dealt.repartition("grp").sortWithinPartitions("grp").mapInArrow(run, "doc_id long, blob binary")


def _apply(joined: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_bytes, removed, spans, hashes, kept = [], [], [], [], []
            for text, blobs in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                raw = (text or "").encode("utf-8", "surrogatepass")
                s, e = np.zeros(0, np.int64), np.zeros(0, np.int64)
                if blobs:
                    both = np.concatenate([np.frombuffer(b, np.int64).reshape(2, -1) for b in blobs], axis=1)
                    order = np.argsort(both[0], kind="stable")
                    s, e = _joined(both[0][order], both[1][order])
                left = b"".join(raw[a:b] for a, b in zip([0, *e.tolist()], [*s.tolist(), len(raw)], strict=True))
                n_bytes.append(len(raw))
                removed.append(int((e - s).sum()))
                spans.append([{"start": a, "end": b} for a, b in zip(s.tolist(), e.tolist(), strict=True)])
                hashes.append(hashlib.sha256(left).hexdigest())
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(removed, pa.int64()), pa.array([len(x) for x in spans], pa.int64()), pa.array(hashes, pa.string()), pa.array(spans, kind)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])

    return joined.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:long,end:long>>")


def remove_repeats(docs: DataFrame, least: int = 50, hot_runs: int = HOT_RUNS) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans) of each row: bytes that ``least``-byte strings cover
    which also start in a document with a smaller doc_id, as judged on the input.

    Texts are UTF-8 bytes, null is empty. Rows of one doc_id don't remove each other's bytes. Rows without doc_id keep
    their text and remove nothing. An empty table gives none; other columns are not read.
    """
    scratch = Scratch(docs.sparkSession, "repeats")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    if least < KMER:
        raise ValueError(f"least is at least {KMER}")
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    buckets = 1 << max(MIN_BUCKETS, size // BUCKET_BYTES).bit_length()
    marks = scratch.save(_settle(_deal(docs.where("doc_id is not null"), least, buckets), least, hot_runs))
    whole, hot = (marks.where(f"kind = {k}").agg(F.coalesce(F.sum(F.col("size") + (least - 1) * (k == 1)), F.lit(0))).first()[0] for k in (1, 2))
    asked = marks.where("kind > 0").groupBy("doc_id").agg(F.collect_list(F.struct("kind", "grp", "start", "size")).alias("asked"))
    cut = scratch.save(_cut(docs.join(asked, "doc_id").select("doc_id", "text", "asked"), least, max(MIN_BUCKETS, hot // BUCKET_WINDOWS)))
    more = scratch.save(_compare(cut.where("kind = 1").select("grp", "doc_id", "start", "bytes"), least, 1 + whole // COMPARED_BYTES))
    split = scratch.save(_settle_windows(cut.where("kind = 2").select("grp", "bytes"), least))
    settled = marks.where("kind = 0").select("doc_id", "blob").unionByName(more.select("doc_id", "blob")).unionByName(split)
    by_doc = settled.groupBy("doc_id").agg(F.collect_list("blob").alias("blobs"))
    return _apply(docs.join(by_doc, "doc_id", "left").select("doc_id", "text", "blobs"))

"""Quality rules: counts within a text, and cross-document line frequency per host."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.llm.scratch import BROADCAST_IDS, Scratch
from folio.llm.tables import fresh
from folio.llm.textbytes import IS_WORD, LOWER, TABLE, mix, sequence_hash, slices, span_hash, word_bounds

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
#: Above both, a line is frequent: so many different documents of a host, and so many percent of its different documents.
LINE_DOCUMENTS = 10
LINE_PERCENT = 1
#: A document that keeps less than this percentage of its words without the frequent lines is depleted.
MIN_LEFT_PERCENT = 30
_SYMBOL = np.isin(np.arange(256), list(b"#*$%&|<>"))
_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def _seen_before(keys: np.ndarray) -> np.ndarray:
    """Whether an equal key stands earlier."""
    order = np.argsort(keys, kind="stable")
    again = np.zeros(len(keys), bool)
    again[order[1:]] = keys[order[1:]] == keys[order[:-1]]
    return again


def _repeated(keys: np.ndarray) -> np.ndarray:
    """Whether an equal key stands anywhere else."""
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    out = np.zeros(len(keys), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def _measure(buf: np.ndarray, offsets: np.ndarray) -> tuple[list[np.ndarray], tuple[np.ndarray, ...]]:
    """_COUNTS of each text of a slice; and of its lines with a word: text, number in the text, hash and length of the
    normal form, which is the line from its first word to its last, A-Z in lower case."""
    texts = len(offsets) - 1
    starts, ends, at = word_bounds(buf, offsets)
    chars = _per_text(IS_WORD[buf] & ((buf & 0xC0) != 0x80), offsets)
    symbols = _per_text(_SYMBOL[buf], offsets)
    words = np.diff(at)
    # Lines: cut at \n and at the ends of texts; a line counts if a word starts in it.
    breaks = np.flatnonzero(buf == 10)
    line_from = np.concatenate([offsets[:-1], breaks + 1])
    line_text = np.concatenate([np.arange(texts), np.searchsorted(offsets, breaks, "right") - 1])
    order = np.lexsort((line_text, line_from))
    line_text, line_from = line_text[order], line_from[order]
    line_to = np.concatenate([line_from[1:] - 1, offsets[-1:]])
    last = np.append(line_text[1:] != line_text[:-1], True)
    line_to[last] = offsets[1:]
    line_no = np.arange(len(line_from)) - np.searchsorted(line_text, line_text)
    first_word, past_word = np.searchsorted(starts, line_from), np.searchsorted(starts, line_to)
    has_word = past_word > first_word
    line_from, line_to, line_text, line_no = line_from[has_word], line_to[has_word], line_text[has_word], line_no[has_word]
    inner_from, inner_to = starts[first_word[has_word]], ends[past_word[has_word] - 1]
    points = np.zeros(len(buf) + 1, np.int64)
    np.cumsum((buf & 0xC0) != 0x80, out=points[1:])
    normal = span_hash(LOWER[buf], inner_from, inner_to)
    lines = mix(span_hash(buf, line_from, line_to) + line_text.astype(np.uint64) * TABLE[0])
    dup_lines = np.bincount(line_text[_seen_before(lines)], minlength=texts)
    # Windows of WINDOW words that stay within a text.
    repeat = np.zeros(texts, np.int64)
    if len(starts) >= WINDOW:
        word_text = np.repeat(np.arange(texts), words)
        whole = word_text[WINDOW - 1 :] == word_text[: len(word_text) - WINDOW + 1]
        keys = mix(sequence_hash(span_hash(buf, starts, ends), WINDOW) + word_text[: len(whole)].astype(np.uint64) * TABLE[1])
        found = np.zeros(len(whole), bool)
        inside = np.flatnonzero(whole)
        found[inside] = _repeated(keys[inside])
        cover = np.zeros(len(starts) + 1, np.int64)
        hits = np.flatnonzero(found)
        cover[hits] += 1
        cover[hits + WINDOW] -= 1
        repeat = np.bincount(word_text[np.cumsum(cover[:-1]) > 0], minlength=texts)
    return [words, chars, symbols, dup_lines, repeat], (line_text, line_no, normal, points[inner_to] - points[inner_from])


_MEASURED = ", ".join(["doc_id long", "text_hash long", "host string", *(f"{c} long" for c in _COUNTS), "positions array<int>", "hashes array<long>", "lengths array<int>"])


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, host, _COUNTS, and three arrays of a row's lines with a word: number, hash, length."""

    def lists(values: np.ndarray, at: np.ndarray, kind: type) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(values.astype(kind)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, buf, offsets in slices(batch.column(3)):
                counts, (text, number, h, n) = _measure(buf, offsets)
                at = np.searchsorted(text, np.arange(b - a + 1))
                yield pa.RecordBatch.from_arrays([*(c.slice(a, b - a) for c in batch.columns[:3]), *map(pa.array, counts), lists(number, at, np.int32), lists(h.view(np.int64), at, np.int64), lists(n, at, np.int32)], [c.rpartition(" ")[0] for c in _MEASURED.split(", ")])

    return docs.select("doc_id", "text_hash", "host", "text").mapInArrow(run, _MEASURED)


def _host(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), source), F.lit("null"))


def frequent_lines(rows: DataFrame) -> DataFrame:
    """(host, h, documents): lines of measured rows that stand in at least LINE_DOCUMENTS distinct documents of a host
    and in at least LINE_PERCENT of its distinct documents.

    Documents are distinct by text: equal texts of a host count once, so a copied page isn't taken for boilerplate.
    """
    distinct = rows.select("host", "text_hash", F.array_distinct("hashes").alias("hs")).dropDuplicates(["host", "text_hash"])
    hosts = rows.select("host", "text_hash").distinct().groupBy("host").agg(F.count("*").alias("all_documents"))
    counted = distinct.select("host", F.explode("hs").alias("h")).groupBy("host", "h").agg(F.count("*").alias("documents")).where(F.col("documents") >= LINE_DOCUMENTS)
    return counted.join(hosts, "host").where(F.col("documents") * 100 >= F.col("all_documents") * LINE_PERCENT).select("host", "h", "documents")


def _text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def quality(docs: DataFrame) -> DataFrame:
    """One row for each row of docs: doc_id, _COUNTS, base_failed, frequent_chars, line_chars, kept, text_hash,
    host, frequent_lines (numbers, from 0, of its frequent lines).

    base_failed: under MIN_WORDS words, or more than MAX_REPEAT_PERCENT of the words in repeated windows. kept: not
    base_failed, and at least MIN_LEFT_PERCENT of the characters of its normalised lines are in lines that are not
    frequent in its host. Null text is empty and fails; null source is a host of its own; rows that are equal get equal
    results; an empty table gives none; other columns are not read. Lines are told apart by 64-bit hashes in a host.
    """
    scratch = Scratch(docs.sparkSession, "quality")
    text = F.col("text").cast("string")
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _text_hash(text).alias("text_hash"), _host(F.col("source").cast("string")).alias("host"), text.alias("text"))
    rows = scratch.save(measured(keyed))
    frequent = scratch.save(frequent_lines(rows).select("host", "h"))
    each = rows.select("doc_id", "text_hash", "host", F.explode(F.arrays_zip("positions", "hashes", "lengths")).alias("line")).select("doc_id", "text_hash", "host", F.col("line.positions").alias("pos"), F.col("line.hashes").alias("h"), F.col("line.lengths").alias("n"))
    hit = each.join(F.broadcast(frequent) if frequent.count() <= BROADCAST_IDS else frequent, ["host", "h"], "left_semi")
    # Rows that are equal have the same lines: of each line number one is counted.
    summed = hit.groupBy("doc_id", "text_hash", "host").agg(F.collect_set(F.struct("pos", "n")).alias("ln"))
    summed = scratch.save(summed.select(F.col("doc_id").alias("id"), F.col("text_hash").alias("th"), F.col("host").alias("ho"), F.aggregate("ln", F.lit(0).cast("long"), lambda s, x: s + x["n"]).alias("frequent_chars"), F.sort_array("ln.pos").alias("frequent_lines")))
    small = F.broadcast(summed) if summed.agg(F.coalesce(F.sum(F.size("frequent_lines") + 8), F.lit(0))).first()[0] <= BROADCAST_IDS else summed
    out = rows.join(small, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_hash") == F.col("th")) & (F.col("host") == F.col("ho")), "left")
    out = out.withColumn("line_chars", F.aggregate("lengths", F.lit(0).cast("long"), lambda s, x: s + x)).withColumn("frequent_chars", F.coalesce("frequent_chars", F.lit(0).cast("long")))
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    enough = 100 * (F.col("line_chars") - F.col("frequent_chars")) >= MIN_LEFT_PERCENT * F.col("line_chars")
    return out.select("doc_id", *_COUNTS, base.alias("base_failed"), "frequent_chars", "line_chars", (~base & enough).alias("kept"), "text_hash", "host", F.coalesce("frequent_lines", F.array().cast("array<int>")).alias("frequent_lines"))


def without_lines(text: Column, numbers: Column) -> Column:
    """The text without its lines of those numbers (ascending, from 0)."""
    lines = F.split(text, "\n")
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), numbers)
    return F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n")


def kept_documents(docs: DataFrame) -> DataFrame:
    """The rows of docs, with all their columns, that quality() keeps, text without the lines that are frequent in its
    host. Columns may have any names; null texts and empty ones are not kept, rows that are equal are all kept or none."""
    i, t, h, lines = (fresh(docs, n) for n in ("id", "text", "host", "lines"))
    verdicts = quality(docs).where("kept").select(F.col("doc_id").alias(i), F.col("text_hash").alias(t), F.col("host").alias(h), F.col("frequent_lines").alias(lines)).distinct()
    text = docs["text"].cast("string")
    kept = docs.join(verdicts, docs["doc_id"].cast("long").eqNullSafe(F.col(i)) & (_text_hash(text) == F.col(t)) & (_host(docs["source"].cast("string")) == F.col(h)))
    left = F.when(F.size(F.col(lines)) == 0, text).otherwise(without_lines(text, F.col(lines)))
    return kept.select(*(left.alias(c) if c.lower() == "text" else docs[c] for c in docs.columns))

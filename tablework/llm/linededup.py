"""Line dedup: lines within one edit of an earlier line go, found by a join of deletion variants."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablework.llm.text import mix64, packed, powers, slices
from tablework.plans import join_by_count, join_lookup, stage

#: Shorter lines are not compared with one edit.
MIN_CHARS = 10
#: Characters of blank lines (the White_Space of Unicode).
BLANK = np.array([*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
#: Line numbers that may be broadcast (a few bytes each).
BROADCAST_LINES = 500_000

# Lines are cut into this many windows: first for all lines, then for those that are left.
_COARSE, _FINE = 2, 16
_SALTS = (np.uint64(0x2545F4914F6CDD1D), np.uint64(0x9FB21C651E98DF25))


class _Lines:
    """The lines of some texts as code points, and hashes of any spans of them."""

    def __init__(self, texts: pa.Array, split: bool = True):
        data, offsets = packed(texts)
        characters = (data & 0xC0) != 0x80
        before = np.concatenate([[0], np.cumsum(characters)])
        self.codes = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        at = before[offsets]
        if split:
            # a line ends at a newline or with its text
            newline = np.flatnonzero(self.codes == 10)
            self.ends = np.sort(np.concatenate([newline, at[1:]]), kind="stable")
            self.text = np.concatenate([np.searchsorted(at[1:], newline, side="right"), np.arange(len(at) - 1)])
            self.text = np.sort(self.text, kind="stable")
            self.starts = np.empty_like(self.ends)
            self.starts[1:] = self.ends[:-1] + 1
            first = np.searchsorted(self.text, np.arange(len(at) - 1))
            self.starts[first] = at[:-1]
            self.number = np.arange(len(self.ends)) - first[self.text]
        else:
            self.starts, self.ends = at[:-1], at[1:]
        self.lengths = self.ends - self.starts
        up, self.down = powers(len(self.codes) + 2)
        self.sums = []
        for salt in _SALTS:
            sums = np.zeros(len(self.codes) + 1, dtype=np.uint64)
            np.cumsum(mix64(self.codes.astype(np.uint64) + salt) * up[: len(self.codes)], out=sums[1:])
            self.sums.append(sums)

    def spans(self, starts, ends, which: int = 0) -> np.ndarray:
        sums = self.sums[which]
        return (sums[ends] - sums[starts]) * self.down[starts]

    def names(self, rows: np.ndarray) -> list[np.ndarray]:
        """Two 64-bit hashes of each line."""
        return [mix64(self.spans(self.starts[rows], self.ends[rows], k)).view(np.int64) for k in (0, 1)]

    def short(self, at_least: int, below: int) -> np.ndarray:
        """The lines of these lengths that are not blank."""
        rows = np.flatnonzero((self.lengths >= at_least) & (self.lengths < below))
        inked = np.zeros(len(rows), dtype=bool)
        for k in range(below - 1):
            there = self.lengths[rows] > k
            inked[there] |= ~np.isin(self.codes[self.starts[rows[there]] + k], BLANK)
        return rows[inked]

    def window_keys(self, rows: np.ndarray, windows: int) -> np.ndarray:
        """(rows, 2, windows) keys: hashes of a line without its q-th window.

        Of two lines with one edit between them let m be the length of the shorter: both
        agree before and after the window of m that holds the edit. So each line has keys
        for m = its length and m = its length - 1.
        """
        starts, ends = self.starts[rows], self.ends[rows]
        n = ends - starts
        keys = np.empty((len(rows), 2, windows), dtype=np.uint64)
        for less in (0, 1):
            m = n - less
            for q in range(windows):
                head = m * q // windows
                tail = m - m * (q + 1) // windows
                keys[:, less, q] = mix64(
                    mix64(self.spans(starts, starts + head) + np.uint64(1))
                    + mix64(self.spans(ends - tail, ends) + np.uint64(2)) * np.uint64(3)
                    + (m * windows + q).astype(np.uint64)
                )
        return keys

    def variants(self, row: int, places: np.ndarray) -> list[np.ndarray]:
        """Two 64-bit hashes of the line without the character at each place."""
        start, end = self.starts[row], self.ends[row]
        at = start + places
        out = []
        for sums in self.sums:
            rest = (sums[at] - sums[start]) + (sums[end] - sums[at + 1]) * self.down[1]
            out.append(mix64(rest * self.down[start]).view(np.int64))
        return out


def _lists(keys: np.ndarray, empty: int = 0) -> pa.Array:
    """A list for each row of keys, then ``empty`` lists without any."""
    width = keys.shape[1] * keys.shape[2]
    flat = keys.reshape(len(keys), width)
    offsets = np.minimum(np.arange(len(flat) + empty + 1) * width, len(flat) * width).astype(np.int32)
    return pa.ListArray.from_arrays(offsets, pa.array(flat.view(np.int64).ravel()))


def _occurrences(min_chars: int, exact_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                lines = _Lines(batch.column("text"))
                close, alone = np.flatnonzero(lines.lengths >= min_chars), lines.short(exact_chars, min_chars)
                rows = np.concatenate([close, alone])
                text = pa.array(lines.text[rows])
                a, b = lines.names(rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(a), pa.array(b), batch.column("doc_id").take(text), batch.column("text_hash").take(text),
                        pa.array(lines.number[rows].astype(np.int32)), _lists(lines.window_keys(close, _COARSE), len(alone)),
                    ],
                    names=["a", "b", "doc_id", "text_hash", "line", "keys"],
                )

    return run


def _fine_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "body"):
            lines = _Lines(batch.column("body"), split=False)
            keys = lines.window_keys(np.arange(batch.num_rows), _FINE)
            yield pa.RecordBatch.from_arrays([batch.column("sid"), _lists(keys)], names=["sid", "keys"])


def _variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each line its own hash (place -1) and those without a character of its open windows."""
    for whole in batches:
        for batch in slices(whole, "body", 1 << 18):
            lines = _Lines(batch.column("body"), split=False)
            parts: list[list[np.ndarray]] = []
            at = lines.names(np.arange(batch.num_rows))
            for row, open_windows in enumerate(batch.column("windows").to_pylist()):
                n, places = int(lines.lengths[row]), [np.zeros(0, dtype=np.int64)]
                for w in open_windows:
                    less, q = divmod(w, _FINE)
                    m = n - less
                    places.append(np.arange(m * q // _FINE, min(m * (q + 1) // _FINE + less, n)))
                places = np.unique(np.concatenate(places))
                a, b = lines.variants(row, places)
                parts.append([np.append(a, at[0][row]), np.append(b, at[1][row]), np.append(places, -1)])
            counts = [len(p[0]) for p in parts]
            text = pa.array(np.repeat(np.arange(len(parts)), counts))
            a, b, place = (np.concatenate([p[k] for p in parts]) for k in range(3))
            yield pa.RecordBatch.from_arrays(
                [pa.array(a), pa.array(b), pa.array(place.astype(np.int32)), batch.column("sid").take(text)],
                names=["va", "vb", "place", "sid"],
            )


def _shared(rows: DataFrame, key: str) -> DataFrame:
    """The rows whose key others have as well."""
    twice = stage(rows.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1").select(key), "shared")
    return join_lookup(rows, twice, key)


def _join_lines(docs: DataFrame, lines: DataFrame, how: str) -> DataFrame:
    """(row, gone): each row of ``docs`` as a struct, with the array ``lines`` of the row of
    ``lines`` (doc_id, text_hash, lines) of equal id and text. For an inner join ``lines`` is
    broadcast if it holds few line numbers; else both sides are shuffled."""
    side = lines.select("doc_id", "text_hash", F.col("lines").alias("gone"))
    few = how == "inner" and (side.agg(F.sum(F.size("gone") + 1).alias("n")).first()["n"] or 0) <= BROADCAST_LINES
    side = F.broadcast(side) if few else side.hint("merge")
    match = (F.xxhash64("row.text") == F.col("text_hash")) & F.col("row.doc_id").eqNullSafe(F.col("doc_id"))
    return docs.select(F.struct(*docs.columns).alias("row")).join(side, match, how).select("row", "gone")


def _first() -> Column:
    """The order of lines: by document (without an id last), then by place in it."""
    return F.struct(F.isnull("doc_id").alias("no_id"), "doc_id", "text_hash", "line")


def dropped_lines(docs: DataFrame, min_chars: int = MIN_CHARS, exact_chars: int = 1) -> DataFrame:
    """(doc_id, text_hash, lines): the numbers (from 0) of the lines that go, for documents
    that lose any.

    A line goes if an earlier line equals it or is one character inserted, deleted or
    replaced away. Lines are what newlines part; earlier means a smaller doc_id (null
    last; then the smaller xxhash64 of the text), then a smaller line number. Rows equal
    in id and text count as one. Lines of fewer than ``min_chars`` characters go only if an
    earlier line equals them, they have ``exact_chars`` characters or more, and are not blank: short lines of white space part paragraphs and stay.

    Equal lines are counted first, so a frequent line is one row from there on. Lines one
    edit apart agree outside a window that holds the edit; only lines that agree with
    another one outside a half, then outside a sixteenth, emit their deletion variants in
    the windows left. Both filters are exact. Lines that share a variant at one place
    differ there alone, and a line that equals another's variant is one deletion away; so
    the earliest partner comes from minima per variant, with no pairs listed. Partners are
    verified with the edit distance of their texts.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.filter(F.col("text").isNotNull())
    seen = stage(
        rows.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(
            _occurrences(min_chars, exact_chars), "a long, b long, doc_id long, text_hash long, line int, keys array<long>"
        ),
        "lines",
    )
    distinct = stage(
        seen.groupBy("a", "b").agg(
            F.min(_first()).alias("first"), F.count("*").alias("copies"), F.first("keys").alias("keys")
        ),
        "distinct",
    )
    close = _shared(distinct.select("first", F.explode("keys").alias("key")), "key")
    wanted = stage(
        close.groupBy("first.doc_id", "first.text_hash").agg(F.collect_set("first.line").alias("lines")), "close"
    )
    body = F.expr("explode(transform(gone, i -> struct(i as line, split(row.text, '\\n', -1)[i] as body)))")
    survivors = stage(
        _join_lines(rows, wanted, "inner")
        .select("row.doc_id", F.xxhash64("row.text").alias("text_hash"), body.alias("x"))
        .select("doc_id", "text_hash", "x.line", "x.body")
        .select(_first().alias("first"), "body")
        .groupBy("first")
        .agg(F.first("body").alias("body"))
        .select(F.monotonically_increasing_id().alias("sid"), "first", "body"),
        "survivors",
    )
    fine = survivors.select("sid", "body").mapInArrow(_fine_keys, "sid long, keys array<long>")
    fine = stage(fine.select("sid", F.posexplode("keys").alias("window", "key")), "windows")
    open_windows = _shared(fine, "key").groupBy("sid").agg(F.collect_set("window").alias("windows"))
    variants = (
        survivors.join(open_windows, "sid")
        .select("sid", "body", "windows")
        .mapInArrow(_variants, "va long, vb long, place int, sid long")
        .join(survivors.select("sid", "first"), "sid")
    )
    by_text = Window.partitionBy("va", "vb")
    line = F.struct("first", "sid")
    whole = F.col("place") == -1
    partner = F.when(whole, F.min(line).over(by_text)).otherwise(
        F.least(F.min(line).over(Window.partitionBy("va", "vb", "place")), F.min(F.when(whole, line)).over(by_text))
    )
    pairs = (
        variants.withColumn("partner", partner)
        .filter("partner.first < first")
        .groupBy("sid")
        .agg(F.min("partner").alias("partner"))
        .select("sid", F.col("partner.sid").alias("other"))
    )
    left = survivors.select("sid", "first", "body")
    right = survivors.select(F.col("sid").alias("other"), F.col("body").alias("earlier"))
    near = (
        pairs.join(left, "sid")
        .join(right, "other")
        .filter(F.levenshtein("body", "earlier", 1) >= 0)
        .select("first", F.lit(True).alias("near"))
    )
    marked = distinct.drop("keys").join(stage(near, "near"), "first", "left").filter("near or copies > 1")
    gone = join_by_count(seen.drop("keys"), marked, ["a", "b"], "copies").filter(
        F.coalesce("near", F.lit(False)) | ~_first().eqNullSafe(F.col("first"))
    )
    return stage(gone.groupBy("doc_id", "text_hash").agg(F.collect_set("line").alias("lines")), "gone")


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, exact_chars: int = 1) -> DataFrame:
    """``docs`` with ``text`` without the lines that ``dropped_lines`` names, and n_lines,
    n_dropped and dropped (their numbers, sorted). Null texts stay null, with no lines; an
    empty text is one empty line. Columns of these names are replaced; others stay, whatever
    their names. Each row is kept, also if it loses all of its lines.
    """
    docs = docs.drop("n_lines", "n_dropped", "dropped")
    own = docs.columns
    found = _join_lines(docs, dropped_lines(docs, min_chars, exact_chars), "left")
    lines, gone = F.split("row.text", "\n", -1), F.col("gone")
    rest = F.array_join(F.filter(lines, lambda x, i: ~F.array_contains(gone, i)), "\n")
    text = F.when(gone.isNull(), F.col("row.text")).otherwise(rest).alias("text")
    return found.select(
        *[text if c == "text" else F.col("row")[c].alias(c) for c in own],
        F.coalesce(F.when(F.col("row.text").isNotNull(), F.size(lines)), F.lit(0)).alias("n_lines"),
        F.coalesce(F.when(gone.isNotNull(), F.size(gone)), F.lit(0)).alias("n_dropped"),
        F.coalesce(F.sort_array(gone), F.array().cast("array<int>")).alias("dropped"),
    )

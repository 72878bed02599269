"""Removal of passages that repeat across documents: hashed lines and sentences, the earliest occurrence stays."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from tablelearn.plans.lineage import checkpointed

from .memory import tidy
from .shingles import mix, row_key

#: Repeated units go only where consecutive ones hold this many words together.
MIN_WORDS = 8
#: A sequence of this many words goes wherever it starts and ends.
PASSAGE_WORDS = 50
#: Words of the digests among which a window's anchor is the least.
ANCHOR_WORDS = 8
_U = np.uint64
_SPACE = np.array([9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000], np.uint32)
_STOP = np.array([ord(c) for c in ".!?…"], np.uint32)
# The stops of other scripts, and blocks of scripts that put no spaces between words.
_STOPS = np.concatenate((_STOP, np.array([ord(c) for c in "。！？｡؟۔।॥።၊။։"], np.uint32)))
_SINGLE = ((0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3001, 0x30FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0xFF01, 0xFF9F),
           (0x20000, 0x3FFFF))
_IS_STOP, _IS_SPACE = np.zeros(1 << 16, bool), np.zeros(1 << 16, bool)  # no mark has the last number
_IS_STOP[_STOPS], _IS_SPACE[_SPACE] = True, True
_SOLID = re.compile("[^" + "".join(map(chr, _SPACE)) + "]")
_EMPTY = np.zeros(0, np.int64)
# Kinds of rows: a digest's first place in a text, and one more for a further place (anchors: windows apart share it); a
# span that is known to go.
_CHAIN, _ANCHOR, _LONG, _SPAN = 0, 2, 4, 6
# What keeps the digests of anchors and of long chains apart from those of chains of units over the same words.
_APART = np.int64(0x2545F4914F6CDD1D), np.int64(0x5851F42D4C957F2D)


def _spaces(code: np.ndarray) -> np.ndarray:
    space = code <= 32
    space &= (code >= 9) & ((code <= 13) | (code == 32))
    if len(code) and code.max() >= 0x85:
        space |= _IS_SPACE[np.minimum(code, (1 << 16) - 1)]
    return space


def units(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, words, digest) of the units of a text, in order.

    A unit is a line, cut further where a word ends in . ! ? or an ellipsis and before a word with an upper-case first
    letter, so that a passage set into the middle of a line still starts a unit of its own. Digests are of the unit's
    words with A-Z and À-Þ lower-cased; white space does not matter.
    """
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    space = _spaces(code)
    solid = ~space
    begin = np.flatnonzero(solid & np.concatenate(([True], space[:-1]))) if len(code) else _EMPTY
    if not len(begin):
        return _EMPTY, _EMPTY, _EMPTY, _EMPTY
    end = np.flatnonzero(solid & np.concatenate((space[1:], [True]))) + 1
    upper = ((code >= 65) & (code <= 90)) | ((code >= 0xC0) & (code <= 0xDE) & (code != 0xD7))
    lines = np.cumsum(code == 10)
    first = upper[begin]
    first[0] = True
    first[1:] |= np.isin(code[end[:-1] - 1], _STOP) | (lines[begin[1:]] != lines[end[:-1] - 1])
    low = code.astype(_U) + (upper * _U(32)).astype(_U)
    length = end - begin
    inside = np.flatnonzero(solid)
    offset = inside - np.repeat(begin, length)
    word = np.add.reduceat(mix((low[inside] << _U(32)) + offset.astype(_U) + _U(1)), np.cumsum(length) - length)
    head = np.flatnonzero(first)
    words = np.diff(np.append(head, len(begin)))
    nth = np.arange(len(begin)) - np.repeat(head, words)
    digest = mix(np.add.reduceat(mix(word + nth.astype(_U) * _U(0x9E3779B97F4A7C15)), head))
    return begin[head], end[head + words - 1], words, digest.view(np.int64)


def repeated_spans(text: str, seen_before, min_words: int = MIN_WORDS) -> list[tuple[int, int]]:
    """Spans to remove: runs of consecutive repeated units with at least ``min_words`` words. A unit is repeated if an
    earlier document holds it (``seen_before``: its digests) or if it stands earlier in the text."""
    start, end, words, digest = units(text)
    if not len(start):
        return []
    again = np.ones(len(start), bool)
    again[np.unique(digest, return_index=True)[1]] = False
    if seen_before is not None and len(seen_before):
        again |= np.isin(digest, np.asarray(seen_before, np.int64))
    if not again.any():
        return []
    edge = np.flatnonzero(np.diff(np.concatenate(([0], again.view(np.int8), [0]))))
    spans = []
    for a, b in zip(edge[::2], edge[1::2], strict=True):
        if words[a:b].sum() >= min_words:
            spans.append((int(start[a]), int(end[b - 1])))
    return spans


def cut_out(text: str, spans) -> str:
    """The text without the spans; the white space around a removed span shrinks to what stood on its left."""
    kept, at = [], 0
    for start, end in spans:
        kept.append(text[at:start])
        at = end
        while at < len(text) and text[at].isspace():
            at += 1
    kept.append(text[at:])
    return "".join(kept)


def _marks(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(row_key, seen): the digests of the document's units that an earlier document holds."""
    table = docs.select(row_key(id_col, text_col).alias("row_key"), F.col(text_col).cast("string").alias("text"))

    def split(parts):
        for part in parts:
            for start in range(0, len(part), 512):
                some = part.iloc[start:start + 512]
                found = [np.unique(units(t or "")[3]) for t in some["text"]]
                if found:
                    yield pd.DataFrame({"row_key": np.repeat(some["row_key"].to_numpy(), [len(f) for f in found]), "digest": np.concatenate(found)})

    held = checkpointed(table.mapInPandas(split, "row_key long, digest long"))
    firsts = held.groupBy("digest").agg(F.min("row_key").alias("first"), F.max("row_key").alias("last"))
    firsts = firsts.where("`first` < `last`").select("digest", "first")
    later = held.join(firsts, "digest").where("row_key > `first`")
    return later.groupBy("row_key").agg(F.collect_set("digest").alias("seen"))


def _dedup(docs: DataFrame, id_col: str, text_col: str, min_words: int) -> DataFrame:
    """``docs`` with text replaced and ``_spans`` added."""
    marks = _marks(docs, id_col, text_col).withColumnsRenamed({"row_key": "_span_key", "seen": "_span_seen"})
    marked = docs.withColumn("_span_key", row_key(id_col, text_col)).join(marks, "_span_key", "left")

    @F.pandas_udf(T.ArrayType(T.ArrayType(T.IntegerType())))
    def find(texts: pd.Series, seen: pd.Series) -> pd.Series:
        return pd.Series([repeated_spans(t or "", s, min_words) for t, s in zip(texts, seen, strict=True)])

    @F.pandas_udf(T.StringType())
    def cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([t if t is None else cut_out(t, s) for t, s in zip(texts, spans, strict=True)])

    text = F.col(text_col).cast("string")
    found = marked.withColumn("_spans", find(text, F.col("_span_seen")))
    return found.withColumn(text_col, cut(text, F.col("_spans"))).drop("_span_key", "_span_seen")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, text (what stays), removed (spans of the original text as start and end, in code points), n_removed (code
    points) for every row.

    Documents rank by id, null ids last; a unit's first document in this order keeps it, all others lose it. Rows that
    share an id count as one document. Null texts stay null, empty texts empty; an empty table gives no rows; other
    columns are not read. Digests have 64 bits: among 10^12 units a given one is taken for another with a probability
    of 5 in 10^8, and a removal takes several words' units in a row.
    """
    table = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return _with_spans(_dedup(table, "doc_id", "text", min_words))


def _with_spans(done: DataFrame) -> DataFrame:
    spans = F.transform("_spans", lambda s: F.struct(s[0].alias("start"), s[1].alias("end")))
    size = F.aggregate("_spans", F.lit(0), lambda total, s: total + s[1] - s[0])
    return done.select("doc_id", "text", spans.alias("removed"), size.alias("n_removed"))


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with repeated passages cut from the text; all columns and rows stay."""
    return _dedup(docs, id_col, text_col, min_words).select(*[F.col(f"`{c}`") for c in docs.columns])


def tokens(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(begin, end, digest, first) of the words of a text: ``first`` marks the words that start a unit.

    As for ``units``, but a character of a script without spaces is a word of its own, and the stops of other scripts end
    a unit too, so that a line of Chinese is many words in several sentences.
    """
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    space = _spaces(code)
    solid = ~space
    if not solid.any():
        return _EMPTY, _EMPTY, _EMPTY.view(_U), np.zeros(0, bool)
    single = np.zeros(len(code), bool)
    if code.max() >= 0x0E00:
        for low, high in _SINGLE:
            single |= (code >= low) & (code <= high)
    edge = single[1:] | single[:-1] | space[1:] | space[:-1]
    begin = np.flatnonzero(solid & np.concatenate(([True], edge)))
    end = np.flatnonzero(solid & np.concatenate((edge, [True]))) + 1
    upper = ((code >= 65) & (code <= 90)) | ((code >= 0xC0) & (code <= 0xDE) & (code != 0xD7))
    lines = np.cumsum(code == 10)
    first = upper[begin]
    first[0] = True
    first[1:] |= _IS_STOP[np.minimum(code[end[:-1] - 1], (1 << 16) - 1)] | (lines[begin[1:]] != lines[end[:-1] - 1])
    low = code.astype(_U) + (upper * _U(32)).astype(_U)
    length = end - begin
    inside = np.flatnonzero(solid)
    offset = inside - np.repeat(begin, length)
    word = np.add.reduceat(mix((low[inside] << _U(32)) + offset.astype(_U) + _U(1)), np.cumsum(length) - length)
    return begin, end, mix(word), first


class Ranges:
    """Digests of ranges of words in order: sums of word times power, moved to the start of the range."""

    _BASE, _BACK = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)

    def __init__(self, word: np.ndarray):
        count = len(word)
        power, self._back = (np.concatenate((np.ones(1, _U), np.cumprod(np.full(count, base, _U), dtype=_U))) for base in (self._BASE, self._BACK))
        self._sums = np.concatenate((np.zeros(1, _U), np.cumsum(word * power[:count], dtype=_U)))

    def __call__(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mix((self._sums[stop] - self._sums[start]) * self._back[start] + mix((stop - start).astype(_U))).view(np.int64)


class Reading:
    """A text's ``begin`` and ``end`` of words; its chains of units as ``chain`` (digest), ``start`` and ``stop`` (words);
    for each window of ``passage`` words its ``anchor``, the least digest of ``ANCHOR_WORDS`` words in a row in it; and
    ``long`` chains, ``long_start`` and ``long_stop``, from anchor to anchor, of which one holds each window."""

    def __init__(self, text: str, min_words: int, passage: int):
        self.passage = passage
        self.begin, self.end, word, first = tokens(text)
        count = len(word)
        self.ranges = Ranges(word)
        head = np.flatnonzero(first)
        tail = np.append(head[1:], count) if len(head) else _EMPTY
        # from each unit on, and up to each unit, the least whole units with so many words together
        ahead = np.searchsorted(tail, head + min_words)
        back = np.searchsorted(head, tail - min_words, side="right") - 1
        on, up = ahead < len(tail), back >= 0
        pairs = np.unique(np.concatenate((head[on] * (count + 1) + tail[ahead[on]], head[back[up]] * (count + 1) + tail[up]))) if count else _EMPTY
        self.start, self.stop = np.divmod(pairs, count + 1)
        self.chain = self.ranges(self.start, self.stop)
        self.anchor = self.long = self.long_start = self.long_stop = _EMPTY
        if count >= passage:
            size = min(ANCHOR_WORDS, passage)
            at = np.arange(count - size + 1)
            grams, have, want = self.ranges(at, at + size), 1, passage - size + 1
            least = grams
            while have < want:
                step = min(have, want - have)
                least, have = np.minimum(least[:-step], least[step:]), have + step
            self.anchor = least ^ _APART[0]
            # a least digest holds for many windows in a row, so runs of them are few
            change = np.flatnonzero(least[1:] != least[:-1]) + 1
            self.run_start, self.run_stop = np.concatenate(([0], change)), np.concatenate((change, [len(least)]))
            names = np.unique(least[self.run_start])
            head = np.union1d(np.flatnonzero(names[np.minimum(np.searchsorted(names, grams), len(names) - 1)] == grams), [0])
            stops = np.union1d(head[1:] + size, [count])
            begin = head[head + passage + want <= count]
            begin, end = (begin, stops[np.searchsorted(stops, begin + passage + want)]) if len(begin) else (np.zeros(1, np.int64), np.array([count]))
            if end[-1] < count:  # the windows at the end of the text
                begin, end = np.append(begin, begin[-1]), np.append(end, count)
            self.long_start, self.long_stop, self.long = begin, end, self.ranges(begin, end) ^ _APART[1]

    def windows(self, at: np.ndarray) -> np.ndarray:
        return self.ranges(at, at + self.passage)

    def within(self, chosen: np.ndarray) -> np.ndarray:
        """The furthest word to which, for each window, one of the ``chosen`` long chains goes on that starts no later."""
        reach = np.zeros(len(self.anchor) + 1, np.int64)
        inside = chosen & (self.long_start < len(reach))
        np.maximum.at(reach, self.long_start[inside], self.long_stop[inside])
        return np.maximum.accumulate(reach)[:-1]

    def open(self, earlier, longs, long_docs, shared, shared_docs) -> np.ndarray:
        """Windows that must be compared one by one: their anchor stands elsewhere, and no long chain that holds them is
        one that an earlier document holds or that all rows with the anchor hold."""
        if shared is None or not len(shared) or not len(self.anchor):
            return _EMPTY
        stop = np.arange(len(self.anchor)) + self.passage
        rows = np.repeat(_looked_up(self.anchor[self.run_start], shared, shared_docs), self.run_stop - self.run_start)
        need = (rows > 1) & (self.within(_among(self.long, earlier)) < stop)
        held = _looked_up(self.long, longs, long_docs)
        for many in np.unique(rows[need]):
            need &= (rows != many) | (self.within(held == many) < stop)
        return np.flatnonzero(need)

    def places(self, digest: np.ndarray, start: np.ndarray, stop: np.ndarray, kind: int):
        """Rows of ranges of words: (digest, kind, begin, end) with begin and end in code points. A range that stands earlier
        in the text, and has ended before it starts again, goes whatever other texts hold: such ranges become spans."""
        if not len(digest):
            return _NO_ROWS
        _, place, own = np.unique(digest, return_index=True, return_inverse=True)
        again = stop[place][own] <= start
        if not again.any():
            return digest, kind + (place[own] != np.arange(len(digest))), self.begin[start], self.end[stop - 1]
        cover = np.zeros(len(self.begin) + 1, np.int64)
        np.add.at(cover, start[again], 1)
        np.add.at(cover, stop[again], -1)
        edge = np.flatnonzero(np.diff(np.concatenate(([0], np.cumsum(cover[:-1]) > 0, [0]))))
        first, last = edge[::2], edge[1::2]
        kinds = kind + (place[own] != np.arange(len(digest)))[~again]
        return (
            np.concatenate((digest[~again], np.zeros(len(first), np.int64))), np.concatenate((kinds, np.full(len(first), _SPAN))),
            np.concatenate((self.begin[start[~again]], self.begin[first])), np.concatenate((self.end[stop[~again] - 1], self.end[last - 1])),
        )

    def first_rows(self):
        """What a text tells before others are known: places of chains and long chains, and its anchors."""
        anchors, apart = self.anchors()
        none = np.zeros(len(anchors), np.int64)
        return _together(
            self.places(self.chain, self.start, self.stop, _CHAIN), self.places(self.long, self.long_start, self.long_stop, _LONG), (anchors, _ANCHOR + apart, none, none),
        )

    def window_rows(self, earlier, longs, long_docs, shared, shared_docs):
        """Places of the windows that must be compared (see ``open``), wherever their words stand in the text, and the spans of
        windows that repeat inside it. Equal windows have equal anchors, so only windows with shared anchors are read."""
        at = np.flatnonzero(np.repeat(_among(self.anchor[self.run_start], shared), self.run_stop - self.run_start)) if len(self.anchor) else _EMPTY
        digest = self.windows(at)
        wanted = _among(digest, self.windows(self.open(earlier, longs, long_docs, shared, shared_docs)))
        rows = self.places(digest, at, at + self.passage, 0)
        keep = (rows[1] == _SPAN) | _among(rows[0], digest[wanted])
        return tuple(r[keep] for r in rows)

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """The text's different anchors, and of each whether windows that do not overlap share it."""
        if not len(self.anchor):
            return _EMPTY, np.zeros(0, bool)
        names, own = np.unique(self.anchor[self.run_start], return_inverse=True)
        first, last = np.full(len(names), len(self.anchor)), np.zeros(len(names), np.int64)
        np.minimum.at(first, own, self.run_start)
        np.maximum.at(last, own, self.run_stop - 1)
        return names, last - first >= self.passage


def _among(digest: np.ndarray, some) -> np.ndarray:
    return np.isin(digest, np.asarray(some, np.int64)) if some is not None and len(some) else np.zeros(len(digest), bool)


def _looked_up(digest: np.ndarray, some, values) -> np.ndarray:
    """The value of each digest, 0 where it is not among ``some``."""
    if some is None or not len(some):
        return np.zeros(len(digest), np.int64)
    some, values = np.asarray(some, np.int64), np.asarray(values, np.int64)
    order = np.argsort(some)
    at = order[np.minimum(np.searchsorted(some, digest, sorter=order), len(some) - 1)]
    return np.where(some[at] == digest, values[at], 0)


_NO_ROWS = (_EMPTY, _EMPTY, _EMPTY, _EMPTY)
_PLACES = "row_key long, sig int, digest long, kind byte, begin int, end int"


def _together(*rows):
    return tuple(np.concatenate(column) for column in zip(*rows, strict=True))


def _batches(parts, columns: list[str], read):
    """What ``read`` gives for each row, as rows of _PLACES."""
    for part in parts:
        for start in range(0, len(part), 512):
            some = part.iloc[start:start + 512]
            found = [read(*row) for row in zip(*(some[c] for c in columns), strict=True)]
            sizes = [len(f[0]) for f in found]
            if sum(sizes):
                digest, kind, begin, end = _together(*found)
                yield pd.DataFrame({"row_key": np.repeat(some["row_key"].to_numpy(), sizes), "sig": np.repeat(some["sig"].to_numpy(), sizes), "digest": digest,
                                    "kind": kind.astype(np.int8), "begin": begin.astype(np.int32), "end": end.astype(np.int32)})


def _merged(text: str, spans) -> list[tuple[int, int]]:
    """The spans in order, joined where no word stands between them."""
    out = []
    for start, end in sorted(map(tuple, spans)):
        if out and (start <= out[-1][1] or not _SOLID.search(text, out[-1][1], start)):
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _earlier(held: DataFrame) -> DataFrame:
    """The rows of ``held`` whose digest an earlier document holds."""
    firsts = held.groupBy("digest").agg(F.min("row_key").alias("first"), F.max("row_key").alias("last")).where("`first` < `last`")
    return held.join(firsts.select("digest", "first"), "digest").where("row_key > `first`").drop("first")


def _passage_spans(docs: DataFrame, id_col: str, text_col: str, min_words: int, passage: int) -> DataFrame:
    """(row: a row of ``docs`` as it is, text: what stays, spans).

    Every text is read for its digests, once more if windows must be compared, and a last time to cut it, if anything
    goes. Digests carry their place, so spans come from joins alone. A row is named by its key and 32 bits of its text,
    as rows may share an id.
    """
    text = F.col(f"`{text_col}`").cast("string")
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), row_key(id_col, text_col).alias("row_key"), F.hash(text).alias("sig"), text.alias("text"))
    table = keyed.select("row_key", "sig", "text")

    def first(t):
        return Reading(t or "", min_words, passage).first_rows()

    held = checkpointed(table.mapInPandas(lambda parts: tidy(_batches(parts, ["text"], first)), _PLACES))
    digests = held.where(F.col("kind") < _SPAN)
    known = digests.groupBy("digest").agg(F.min("row_key").alias("first"), F.sum(F.when(F.col("kind").isin(_CHAIN, _ANCHOR, _ANCHOR + 1, _LONG), 1).otherwise(0)).alias("rows"), F.max("kind").alias("most"))
    known = known.where(f"rows > 1 OR most = {_ANCHOR + 1}").select("digest", "first", "rows")
    found = digests.join(known, "digest").withColumn("later", F.col("row_key") > F.col("first")).where(f"later OR kind > {_CHAIN + 1}").drop("first")
    found = found.unionByName(held.where(F.col("kind") == _SPAN).withColumns({"rows": F.lit(0).cast("long"), "later": F.lit(True)}))

    def some(value, when):
        return F.collect_list(F.when(when, value))

    kind, later, counted = F.col("kind"), F.col("later"), F.struct("digest", "rows")
    marks = checkpointed(found.groupBy("row_key", "sig").agg(
        some(F.struct("begin", "end"), later & ~kind.isin(_ANCHOR, _ANCHOR + 1)).alias("spans"), some(F.col("digest"), later & (kind == _LONG)).alias("earlier"),
        some(counted, kind.isin(_ANCHOR, _ANCHOR + 1)).alias("anchors"), some(counted, kind == _LONG).alias("longs")))

    def second(t, *marked):
        return Reading(t, min_words, passage).window_rows(*marked)

    open_rows = table.join(marks.where("size(anchors) > 0").select(
        "row_key", "sig", "earlier", F.col("longs.digest").alias("longs"), F.col("longs.rows").alias("long_rows"),
        F.col("anchors.digest").alias("shared"), F.col("anchors.rows").alias("shared_rows")), ["row_key", "sig"])
    windows = checkpointed(open_rows.mapInPandas(lambda parts: tidy(_batches(parts, ["text", "earlier", "longs", "long_rows", "shared", "shared_rows"], second)), _PLACES))
    gone = _earlier(windows.where(F.col("kind") < _SPAN)).unionByName(windows.where(F.col("kind") == _SPAN))
    gone = gone.select("row_key", "sig", F.struct("begin", "end").alias("s")).unionByName(marks.select("row_key", "sig", F.explode("spans").alias("s")))
    spans = gone.groupBy("row_key", "sig").agg(F.collect_set("s").alias("s")).select("row_key", "sig", F.col("s.begin").alias("begins"), F.col("s.end").alias("ends"))

    shape = T.StructType([T.StructField("text", T.StringType()), T.StructField("spans", T.ArrayType(T.ArrayType(T.IntegerType())))])

    def without(text, begins, ends):
        if begins is None:
            return None, []
        found = _merged(text, zip(begins.tolist(), ends.tolist(), strict=True))
        return cut_out(text, found), found

    @F.pandas_udf(shape)
    def cut(parts: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        yield from tidy(pd.DataFrame([without(*row) for row in zip(*part, strict=True)], columns=["text", "spans"]) for part in parts)

    marked = keyed.join(spans, ["row_key", "sig"], "left")
    hit = F.col("begins").isNotNull()
    out = marked.withColumn("cut", cut(F.when(hit, F.col("text")), "begins", "ends"))
    return out.select("row", F.when(hit, F.col("cut.text")).otherwise(F.col("text")).alias("text"), F.coalesce("cut.spans", F.array().cast("array<array<int>>")).alias("spans"))


def remove_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, passage: int = PASSAGE_WORDS) -> DataFrame:
    """As ``remove_repeats``, but what goes stood together, in this order, in one earlier document or earlier in the text:
    whole consecutive units with ``min_words`` words or more, and every sequence of ``passage`` words, wherever it starts
    and ends. A character of a script without spaces counts as a word.

    Each window of ``passage`` words has an anchor, the least digest of eight words in a row in it, so equal windows have
    equal anchors. Chains from anchor to anchor that an earlier document holds go whole. Windows are compared one by one
    only where their anchor stands elsewhere too and not all rows with the anchor hold the chain around: the rest have no
    border of a copy, so this leaves out none.
    """
    table = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    done = _passage_spans(table, "doc_id", "text", min_words, passage)
    return _with_spans(done.select("row.doc_id", "text", F.col("spans").alias("_spans")))


def drop_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, passage: int = PASSAGE_WORDS) -> DataFrame:
    """``docs`` with the passages of ``remove_passages`` cut from the text; all rows and columns stay, whatever their names."""
    done = _passage_spans(docs, id_col, text_col, min_words, passage)
    return done.select(*[F.col("text").alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in docs.columns])

"""Best-fit decreasing packing of tokenised documents into fixed windows."""

from __future__ import annotations

import os
import re
import zlib
from array import array
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

WINDOW = 2048
END_ID = 1
#: Documents per packing group. A group holds the pieces of about this many documents, whatever the table's size.
GROUP_DOCS = 4096
TOKENIZER = "byte_bpe_50k.json"

#: Characters on which white-space definitions differ between libraries, or that are white space but not ASCII.
_ODD = re.compile("[\\x1c-\\x1f\\x85\\xa0\\u1680\\u180e\\u2000-\\u200b\\u2028\\u2029\\u202f\\u205f\\u3000\\ufeff]")
#: White space and a word of Latin letters before ASCII punctuation; else white space and all up to the next.
_CHUNK = re.compile(r"\s*[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+(?=[!-/:-@\[-`{-~])|\s*\S+|\s+")
_PLAIN = re.compile(r" [A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")


class Encoder:
    """Token ids as little-endian 32-bit bytes.

    A byte-level pre-tokenizer never joins a non-space character with white space that follows it, nor a letter with
    punctuation that follows it, so a text may be cut there and the ids of the pieces remembered. Texts with unusual
    white space or with the text of a special token go to the tokenizer whole.
    """

    def __init__(self, path: str, memo: int = 500_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        special = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(special)) if special else None
        self.line_feed = self.tokenizer.token_to_id("\u010a")
        self.limit = memo
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}  # what the memo held when it was last full

    def _ids(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", f.ids).tobytes() for f in found]

    def _chunk_ids(self, chunks: list[str]) -> dict[str, bytes]:
        """Ids of chunks. Plain words go many to a text, with line feeds between them, which are tokens of their own."""
        plain = [c for c in chunks if _PLAIN.fullmatch(c)]
        other = [c for c in chunks if not _PLAIN.fullmatch(c)]
        out = dict(zip(other, self._ids(other), strict=True))
        groups = [plain[k:k + 64] for k in range(0, len(plain), 64)]
        for group, ids in zip(groups, self._ids(["\n".join(g) for g in groups]), strict=True):
            out.update(zip(group, _cut(ids, self.line_feed), strict=True))
        return out

    def __call__(self, texts: list[str]) -> list[bytes]:
        whole = [bool(_ODD.search(t) or (self.special and self.special.search(t))) for t in texts]
        chunks = [[] if w else _CHUNK.findall(t) for t, w in zip(texts, whole, strict=True)]
        if len(self.memo) > self.limit:
            self.memo, self.older = {}, self.memo
        memo, older = self.memo, self.older
        missing = []
        for chunk in set().union(*chunks):
            if chunk not in memo:
                if chunk in older:
                    memo[chunk] = older[chunk]
                else:
                    missing.append(chunk)
        memo.update(self._chunk_ids(missing))
        out = [self._ids([t])[0] if w else b"".join(map(memo.__getitem__, c)) for t, c, w in zip(texts, chunks, whole, strict=True)]
        for chunk in missing:
            if len(chunk) > 64:
                del memo[chunk]
        return out


def _cut(ids: bytes, at: int) -> list[bytes]:
    """The ids between the ids ``at``."""
    found = np.frombuffer(ids, "<u4")
    stops = np.flatnonzero(found == at).tolist()
    return [ids[4 * a:4 * b] for a, b in zip([0, *(s + 1 for s in stops)], [*stops, len(found)], strict=True)]


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """The worker's encoder; it stays for the worker's next task, with what it remembers."""
    return Encoder(path)


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def cut(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = TOKENIZER, window: int = WINDOW,
        end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Pieces of at most ``window`` ids: full windows first, then the rest of the document. A null or empty text is the
    end id alone."""
    id_type = docs.schema[id_col].dataType
    fields = [T.StructField("doc_id", id_type), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
              T.StructField("ids_crc32", T.LongType()), T.StructField("doc_tokens", T.LongType())]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))
    schema = T.StructType(fields)
    end = np.asarray([end_id], dtype="<u4").tobytes()

    def run(batches):
        import pyarrow as pa

        from pyspark.sql.pandas.types import to_arrow_schema

        encode, shape = encoder(tokenizer_path(tokenizer)), to_arrow_schema(schema)
        for batch in batches:
            columns = [[] for _ in fields]
            for begin in range(0, batch.num_rows, 128):
                some = batch.slice(begin, 128)
                texts = [t or "" for t in some.column(1).to_pylist()]
                for key, data in zip(some.column(0).to_pylist(), encode(texts), strict=True):
                    data += end
                    total = len(data) // 4
                    for start in range(0, total, window):
                        piece = data[4 * start:4 * (start + window)]
                        row = [key, start, len(piece) // 4, zlib.crc32(piece), total]
                        if with_ids:
                            row.append(np.frombuffer(piece, dtype="<i4"))
                        for column, value in zip(columns, row, strict=True):
                            column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, shape, strict=True)], schema=shape)
        encode.older.clear()  # what stays for the worker's next task is one generation at most

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)


class _Tightest:
    """Segment tree over remaining capacities: the least capacity of at least ``need`` that some open window has."""

    def __init__(self, window: int):
        self.size = 1 << window.bit_length()
        self.tree = [0] * (2 * self.size)
        self.stacks: list[list[int]] = [[] for _ in range(window + 1)]

    def add(self, capacity: int, name: int) -> None:
        self.stacks[capacity].append(name)
        node = capacity + self.size
        while node:
            self.tree[node] += 1
            node >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """(capacity, window) of the tightest open window, which is removed; None if nothing fits."""
        tree, node = self.tree, need + self.size
        if not tree[node]:
            while node > 1 and (node & 1 or not tree[node + 1]):  # climb until a right neighbour holds something
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.size:
                node *= 2
                node += not tree[node]
        capacity = node - self.size
        while node:
            tree[node] -= 1
            node >>= 1
        return capacity, self.stacks[capacity].pop()


def best_fit(lengths, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Window number and offset of each length; ``lengths`` must not increase."""
    tree, windows = _Tightest(window), 0
    where, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for k, need in enumerate(lengths):
        need = int(need)
        found = tree.take(need) if need < window else None
        if found is None:
            found, windows = (window, windows), windows + 1
        left, name = found
        where[k], offset[k] = name, window - left
        if left > need:
            tree.add(left - need, name)
    return where, offset


def group_of(groups: int, *keys: str) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(groups)).cast("int")


def pack(pieces: DataFrame, documents: int, window: int = WINDOW, group_docs: int = GROUP_DOCS) -> DataFrame:
    """Add ``sequence_id`` and ``offset``. Pieces are dealt by hash into groups of about ``group_docs`` documents' pieces
    (``documents``: their number), and each group is packed best-fit decreasing; so a group's size does not depend on
    the table's, and long documents spread over all groups."""
    groups = max(1, -(-documents // group_docs))
    schema = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def run(key, part: pd.DataFrame) -> pd.DataFrame:
        order = np.lexsort((part["ids_crc32"], part["start"], part["doc_id"].fillna(-1), -part["length"]))
        part = part.iloc[order].drop(columns="_group").reset_index(drop=True)
        where, offset = best_fit(part["length"].to_numpy(), window)
        return part.assign(sequence_id=where + (int(key[0]) << 32), offset=offset)

    return pieces.withColumn("_group", group_of(groups, "doc_id", "start", "ids_crc32")).groupBy("_group").applyInPandas(run, schema)


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = TOKENIZER, window: int = WINDOW,
                   end_id: int = END_ID, group_docs: int = GROUP_DOCS, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their place: doc_id, start, length, ids_crc32, doc_tokens (, ids), sequence_id, offset.

    Null and empty texts pack as the end id alone; null ids stay null; rows repeated whole are packed once each; an
    empty table gives no rows; other columns of ``docs`` are never read, so their names cannot clash.
    """
    return pack(cut(docs, id_col, text_col, tokenizer, window, end_id, with_ids), docs.count(), window, group_docs)


def sequences(packed: DataFrame, window: int = WINDOW, pad_id: int = 0) -> DataFrame:
    """One row per sequence from pieces with ``ids``: sequence_id, n_tokens, input_ids. A sequence is padded to the
    window, except that one whose length is a power of two stays as it is."""
    parts = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    ids = parts.select("sequence_id", F.flatten(F.col("parts.ids")).alias("ids")).withColumn("n_tokens", F.size("ids"))
    whole = F.col("n_tokens").bitwiseAND(F.col("n_tokens") - 1) == 0
    padding = F.when(whole, F.lit(0)).otherwise(F.lit(window) - F.col("n_tokens"))
    return ids.select("sequence_id", "n_tokens", F.concat("ids", F.array_repeat(F.lit(pad_id), padding)).alias("input_ids"))

"""Token ids of documents in shard files, each a wavelet matrix.

Documents are dealt out by ranges of ids and sorted in each range, so a shard holds consecutive
documents and shards are in order. A task encodes and writes its range; where a document's ids begin
follows from the counts in the manifest, a row per shard.

The tokenizer cuts a text before it merges, so a text can be cut at places where it always does: before a
space or a line end between two characters other than white space, and between a letter and a mark.
Pieces are hashed by array operations, and each distinct piece of a task is encoded once while the table
of pieces holds it. A long text is encoded in parts of bounded bytes, whose pieces always fit the table.

Null text: empty, which is the end id alone. Null ids come first, repeated ids in the order of their
texts. A text of any length is whole in one shard. An empty table gives no shard and no row. Other
columns are ignored.
"""

from __future__ import annotations

import functools
import os
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.files import read_part, size_of, write_whole
from tidemark.llm.wavelet import pack, unpack
from tidemark.llm.words import SPACED, Chunk, chunks
from tidemark.sources.lake import new_folder, staged

SHARD_IDS = 1 << 20
#: Slots of a task's table of pieces, a power of two. It is emptied when half of them are taken, and
#: before pieces that would take more than three quarters.
SLOTS = 1 << 21

_VISIBLE = np.zeros(256, bool)
_VISIBLE[0x21:0x7F] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_MARK = np.zeros(256, bool)
_MARK[list(b".,;:!?)\"")] = True
_AFTER_C3 = np.zeros(256, bool)
_AFTER_C3[[x for x in range(0x80, 0xC0) if x not in (0x97, 0xB7)]] = True


#: Bytes of words that are encoded together: visible ASCII, and C3 with the byte after it.
_TOGETHER = _VISIBLE.copy()
_TOGETHER[0xC3] = True


def _strange(data: np.ndarray) -> np.ndarray:
    """How many bytes before each place are in no word that is encoded together."""
    fine = _TOGETHER[data]
    fine[1:] |= (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] < 0xC0)
    return np.concatenate([[0], np.cumsum(~fine)])


def cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where pieces begin, each text's first one included; a text without bytes has none."""
    n = len(data)
    begins = np.zeros(n + 2, bool)
    if n > 2:
        left, mid, right = data[:-2], data[1:-1], data[2:]
        letter = _LETTER[left]
        far = np.zeros(n - 2, bool)
        far[1:] = (data[:-3] == 0xC3) & _AFTER_C3[left[1:]]
        letter |= far
        visible = (_VISIBLE[left] | far) & (_VISIBLE[right] | (right == 0xC3))
        line = (mid == 0x0A) & visible
        begins[1 : n - 1] = ((mid == 0x20) & visible) | line | (letter & _MARK[mid])
        begins[2:n] |= line
    begins[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    return np.flatnonzero(begins[:n])


class Encoder:
    """Ids of whole chunks of texts, by a hash table of encoded pieces. A piece's key has 64 bits."""

    def __init__(self, tokenizer_file: str, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.bits = max(size - 1, end_id).bit_length()
        self.kind = np.uint16 if self.bits <= 16 else np.uint32
        self.end_id = end_id
        line = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.line = line[0] if len(line) == 1 else -1
        self.spaced = np.array([(self.tokenizer.id_to_token(i) or "").startswith("\u0120") for i in range(size)])
        self.empty()

    def empty(self) -> None:
        self.keys = np.zeros(SLOTS, np.uint64)
        self.at, self.count = np.zeros(SLOTS + 1, np.int64), np.zeros(SLOTS + 1, np.int64)
        self.pool = np.full(1, self.end_id, self.kind)  # the last slot is the end of a text
        self.count[SLOTS] = 1
        self.used = 0

    def _look(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key, or of the free place where it belongs."""
        mask = np.uint64(SLOTS - 1)
        slots = (keys & mask).astype(np.int64)
        found = self.keys[slots]
        todo = np.flatnonzero((found != keys) & (found != 0))
        while len(todo):
            slots[todo] = (slots[todo] + 1) & (SLOTS - 1)
            found = self.keys[slots[todo]]
            todo = todo[(found != keys[todo]) & (found != 0)]
        return slots

    def _encoded(self, pieces: list[bytes], spaced: np.ndarray, bare: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(order, counts in that order, their ids) of distinct pieces. Words with a space before them are
        encoded in one text, and words without one in another, a line each: the tokenizer cuts those
        texts before every piece, where an id begins with a space, or at every line end."""
        order, counts, ids = [], [], []
        for own, before, begins in ((spaced, b"", lambda x: self.spaced[x]), (bare, b"\n", lambda x: x == self.line)):
            if not len(own):
                continue
            text = (before + before.join([pieces[i] for i in own])).decode()
            x = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids)
            at = np.flatnonzero(begins(x))
            if len(at) != len(own) or at[0]:
                continue  # left to be encoded one by one
            n = np.diff(np.append(at, len(x)))
            if before:
                x, n = np.delete(x, at), n - 1
            order += own.tolist()
            counts.append(n)
            ids.append(x.astype(self.kind))
        done = set(order)
        rest = [i for i in range(len(pieces)) if i not in done]
        each = [e.ids for e in self.tokenizer.encode_batch_fast([pieces[i].decode() for i in rest], add_special_tokens=False)]
        counts.append(np.array([len(x) for x in each], np.int64))
        ids += [np.array(x, self.kind) for x in each]
        return np.array(order + rest, np.int64), np.concatenate(counts), np.concatenate(ids)

    def _learn(self, keys: np.ndarray, pieces: list[bytes], spaced: np.ndarray, bare: np.ndarray) -> None:
        order, counts, ids = self._encoded(pieces, spaced, bare)
        keys = keys[order]
        at = len(self.pool) + np.cumsum(counts) - counts
        self.pool = np.concatenate([self.pool, ids])
        todo = np.arange(len(keys))
        while len(todo):  # of keys that want the same place the last one gets it
            slots = self._look(keys[todo])
            self.keys[slots] = keys[todo]
            mine = self.keys[slots] == keys[todo]
            self.at[slots[mine]], self.count[slots[mine]] = at[todo[mine]], counts[todo[mine]]
            todo = todo[~mine]
        self.used += len(keys)

    def encode(self, chunk) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts of the chunk, each closed by the end id; number of ids of each)."""
        starts = cuts(chunk.data, chunk.offsets)
        ends = np.append(starts[1:], len(chunk.data))
        bounds = np.searchsorted(starts, chunk.offsets[1:])  # pieces before the end of each text
        ids, counts, first = [], [], 0
        while first < len(starts) or not counts:
            # Pieces of at most SLOTS // 2 bytes, so no more than as many pieces, or one longer piece.
            last = first
            if len(starts):
                last = max(int(np.searchsorted(ends, starts[first] + SLOTS // 2, "right")), first + 1)
            closed = bounds[(bounds > first if first else bounds >= 0) & (bounds <= last)] - first
            x, n = self._part(chunk, starts[first:last], ends[first:last], closed)
            ids.append(x)
            counts.append(n)
            first = last
        total = np.concatenate([[0], np.cumsum(np.concatenate(counts))])
        return np.concatenate(ids), np.diff(total[bounds + np.arange(1, len(bounds) + 1)], prepend=0)

    def _part(self, chunk, starts: np.ndarray, ends: np.ndarray, closed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the pieces, with the end id where a text is closed; number of ids of each piece and end)."""
        if self.used > SLOTS // 2:
            self.empty()
        begin, end = (int(starts[0]), int(ends[-1])) if len(starts) else (0, 0)
        data = chunk.data[begin:end]
        s, e = starts - begin, ends - begin
        keys = Chunk(0, data, chunk.offsets, s, e, closed).span_hashes(s, e) | np.uint64(1)  # 0 is a free slot
        slots = self._look(keys)
        if (new := np.flatnonzero(self.keys[slots] == 0)).size:
            fresh, first = np.unique(keys[new], return_index=True)
            if self.used + len(fresh) > SLOTS * 3 // 4:
                self.empty()
                new = np.arange(len(keys))
                fresh, first = np.unique(keys, return_index=True)
            raw = data.tobytes()
            s, e = s[new[first]], e[new[first]]
            strange, space = _strange(data), data[s] == 0x20
            # A piece with one strange byte, the space before it, or with none at all.
            odd = strange[e] - strange[s]
            pieces = [raw[a:b] for a, b in zip(s.tolist(), e.tolist(), strict=True)]
            self._learn(fresh, pieces, np.flatnonzero(space & (odd == 1) & (e - s > 1)), np.flatnonzero(odd == 0))
            slots[new] = self._look(keys[new])
        slots = np.insert(slots, closed, SLOTS)
        counts = self.count[slots]
        total = np.concatenate([[0], np.cumsum(counts)])
        return self.pool[np.repeat(self.at[slots] - total[:-1], counts) + np.arange(total[-1])], counts


@functools.lru_cache(maxsize=1)
def _encoder(tokenizer_file: str, end_id: int) -> Encoder:
    """One for each Python worker: a worker runs many tasks, and the pieces it has met stay known."""
    return Encoder(tokenizer_file, end_id)


def _write(folder: str, tokenizer_file: str, end_id: int, shard_ids: int):
    def run(batches):
        encoder, part, seq = _encoder(tokenizer_file, end_id), TaskContext.get().partitionId(), 0
        ids, counts, documents, held = [], [], [], 0

        def close():
            nonlocal ids, counts, documents, held, seq
            path = f"{folder}/part-{part:07d}-{seq:05d}.wm"
            nulls = np.array([d is None for d in documents])
            own = np.concatenate(counts)
            write_whole(path, pack(np.concatenate(ids), encoder.bits, np.array([d or 0 for d in documents], np.int64), nulls, own))
            row = pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "seq": pa.array([seq], pa.int32()), "path": [path],
                                              "n_docs": pa.array([len(own)], pa.int64()), "n_ids": pa.array([held], pa.int64())})
            ids, counts, documents, held, seq = [], [], [], 0, seq + 1
            return row

        for batch in batches:
            names = batch.column("doc_id").to_pylist()
            for chunk in chunks(batch.column("text"), SPACED, lower=False):
                tokens, own = encoder.encode(chunk)
                ids.append(tokens)
                counts.append(own)
                documents += names[chunk.first_row : chunk.first_row + chunk.rows]
                held += len(tokens)
                if held >= shard_ids:
                    yield close()
        if counts:
            yield close()

    return run


def write_shards(docs: DataFrame, tokenizer_file: str, end_id: int, shard_ids: int = SHARD_IDS) -> DataFrame:
    """Write the shard files and return their manifest: (part, seq, path, n_docs, n_ids)."""
    spark = docs.sparkSession
    folder = new_folder(spark, "tokens")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    ranges = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    order = [F.asc_nulls_first("doc_id"), F.xxhash64("text")]
    rows = rows.repartitionByRange(ranges, *order).sortWithinPartitions(F.asc_nulls_first("doc_id"), "text")
    made = rows.mapInArrow(_write(folder, tokenizer_file, end_id, shard_ids), "part int, seq int, path string, n_docs long, n_ids long")
    return staged(made, "manifest")


def read_shard(path: str):
    return unpack(read_part(path, 0, size_of(path)))


def _read(batches):
    for batch in batches:
        for path, base in zip(batch.column("path").to_pylist(), batch.column("base").to_pylist(), strict=True):
            matrix, doc_ids, nulls, counts = read_shard(path)
            ids = matrix.decode()
            ends = np.cumsum(counts.astype(np.int64))
            starts = ends - counts.astype(np.int64)
            sums = [zlib.crc32(ids[s:e].astype("<u4")) for s, e in zip(starts, ends, strict=True)]
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array(doc_ids, pa.int64(), mask=nulls), "start": pa.array(base + starts, pa.int64()),
                "n_tokens": pa.array(counts.astype(np.int64)), "ids_crc32": pa.array(sums, pa.int64())})


def read_documents(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from the shard files."""
    # A row per shard: what the window sorts is smaller than the files by SHARD_IDS.
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    placed = staged(manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0))), "placed")
    return placed.repartition(max(placed.count(), 1)).select("path", "base").mapInArrow(_read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_shards(docs: DataFrame, tokenizer_file: str, end_id: int = 2, shard_ids: int = SHARD_IDS) -> DataFrame:
    return read_documents(write_shards(docs, tokenizer_file, end_id, shard_ids))

"""Token-id output: concatenated ids with Elias-Fano document boundaries, written and read by tasks.

Documents are sorted by id over range partitions; a task encodes its stretch and writes
files of at most 64 MB of ids or 262,144 documents each, so its memory is bounded
whatever it gets.  A file holds the ids (16 bits each where the vocabulary allows, else
32), the boundaries of the documents and the document ids as Elias-Fano sequences, and
a footer.  Where a document's ids lie is answered by ``select`` on the boundaries: no
table of 64-bit offsets is stored or built.  A file is written under a name of its own
and then renamed, and equal input gives equal files, so lost and repeated tasks do no
harm.  The manifest, one row a file, is a Parquet table beside the files; each file's
first id in the whole sequence comes from sums over blocks of files.

Encoding goes through the tokenizers library.  Pieces between which no merge reaches are
remembered, so a repeated piece is looked up; texts with characters whose class might
depend on a library's Unicode version, or with a special token's text, are encoded whole.

Defined cases: a null text is the empty text and holds the end id alone; null ids come
first; equal ids are ordered by a hash of their text; equal rows are documents of their
own, dealt to tasks in shares of ``COPIES`` that are encoded once each; an empty table gives no file and an empty result; further columns are left out.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
import zlib
from itertools import islice

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetlake.llm.common import id_and_text, record_batch, scanned_bytes, slices, stored
from fleetlake.llm.copies import in_parts, measured, reduced
from fleetlake.llm.elias_fano import EliasFano
from fleetlake.llm.ranges import range_count

FILE_IDS = 64 << 20    # bytes of ids in a file, unless one document has more
FILE_DOCS = 1 << 18    # documents in a file
READ_IDS = 1 << 20     # ids read at once, or one longer document
COPIES = 4             # equal rows encoded once and written together: no range gets more than so many times its share
PIECES = 400_000       # pieces a worker remembers
LONG_TEXT = 1 << 20    # characters from which pieces are taken in portions

_MAGIC = b"EFTOKENS"
_FOOTER = struct.Struct("<QQQqQQB7x8s")  # ids, documents, null ids, first id, places of both sequences, id bytes, magic

# Fixed value: how byte-level tokenizers split a text before merging, for the characters
# below, among which a letter is what ``re`` calls a word character.
_SPLIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
# anything but ASCII without odd controls, Latin without raised and broken digits, Greek,
# Cyrillic, Han and common punctuation
_UNSURE = re.compile("[^\t\n\r\x20-\x7e\xa0-\xb1\xb4-\xb8\xba\xbb\xbf-\u024f\u0391-\u03a1\u03a3-\u03c9"
                     "\u0410-\u044f\u2010-\u2027\u2030-\u205e\u4e00-\u9fa5]")
_WORD = re.compile(r" [^\W\d_]+")

_MANIFEST = "pid int, seq int, path string, n_docs long, n_ids long"
_ROWS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


class Encoder:
    """Texts → ids of a tokenizer file, as little-endian bytes."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark gives the cores
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        with open(path, encoding="utf-8") as f:
            made = json.load(f)
        split = made.get("pre_tokenizer") or {}
        self.by_pieces = (not made.get("normalizer") and split.get("type") == "ByteLevel" and split.get("use_regex", True)
                          and not split.get("add_prefix_space"))
        self.special = [t["content"] for t in made.get("added_tokens") or []]
        self.pieces: dict[str, bytes] = {}

    def _ids(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype=self.kind).tobytes() for e in found]

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of pieces of a space and letters, which stay apart in one text."""
        found = self.tokenizer.encode("".join(words), add_special_tokens=False)
        ends = np.flatnonzero(np.diff(np.array(found.word_ids, dtype=np.int64), append=-1)) + 1
        data, at = np.array(found.ids, dtype=self.kind).tobytes(), (ends * self.kind.itemsize).tolist()
        return [data[a:b] for a, b in zip([0, *at], at)]

    def _learn(self, new: list[str]) -> None:
        words = [p for p in new if _WORD.fullmatch(p)]
        for i in range(0, len(words), 10_000):
            part = words[i:i + 10_000]
            self.pieces.update(zip(part, self._words(part), strict=True))
        others = [p for p in new if p not in self.pieces]
        self.pieces.update(zip(others, self._ids(others)))

    def _joined(self, texts: list[list[str]]) -> list[bytes]:
        """Texts as pieces → ids.  When enough pieces are known, new ones are forgotten
        again: the frequent ones came early."""
        known = self.pieces
        new = list(set().union(*texts).difference(known))
        if new:
            self._learn(new)
        found = [b"".join(map(known.__getitem__, pieces)) for pieces in texts]
        if len(known) > PIECES:
            for piece in new:
                del known[piece]
        return found

    def encode(self, texts: list[str]) -> list[bytes]:
        found: list[bytes | None] = [None] * len(texts)
        short = []
        for i, text in enumerate(texts):
            if not self.by_pieces or _UNSURE.search(text) or any(s in text for s in self.special):
                found[i] = self._ids([text])[0]
            elif len(text) < LONG_TEXT:
                short.append(i)
            else:
                matches = (m.group() for m in _SPLIT.finditer(text))
                found[i] = b"".join(self._joined([part])[0] for part in iter(lambda: list(islice(matches, 100_000)), []))
        for i, ids in zip(short, self._joined([_SPLIT.findall(texts[i]) for i in short])):
            found[i] = ids
        return found


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _file_system(uri: str) -> tuple[fs.FileSystem, str]:
    """The store of a folder and its path there."""
    if uri.startswith("file:"):
        uri = "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri)


class TokenFile:
    """One file: ``ids(a, b)`` are those of documents a to b, ``bounds`` and ``doc_ids``
    the sequences."""

    def __init__(self, uri: str):
        store, path = _file_system(uri)
        self._file = store.open_input_file(path)
        size = self._file.size()
        (self.n_ids, self.n_docs, self.null_ids, self.first_id, bounds, doc_ids, width,
         magic) = _FOOTER.unpack(self._file.read_at(_FOOTER.size, size - _FOOTER.size))
        if magic != _MAGIC:
            raise ValueError(f"{uri} isn't a token file")
        self.kind = np.dtype(f"<u{width}")
        self._bounds = EliasFano(self._file.read_at(doc_ids - bounds, bounds))
        self._doc_ids = EliasFano(self._file.read_at(size - _FOOTER.size - doc_ids, doc_ids))

    def bounds(self, docs: np.ndarray) -> np.ndarray:
        """First id of each document; document ``n_docs`` begins at the end."""
        return self._bounds.get(docs).astype(np.int64)

    def doc_ids(self, docs: np.ndarray) -> list[int | None]:
        known = docs[docs >= self.null_ids]
        ids = (self._doc_ids.get(known - self.null_ids) + np.uint64(self.first_id % (1 << 64))).view(np.int64)
        return [None] * (len(docs) - len(known)) + ids.tolist()

    def ids(self, first: int, end: int) -> np.ndarray:
        """The ids from place ``first`` up to ``end``."""
        width = self.kind.itemsize
        return np.frombuffer(self._file.read_at((end - first) * width, first * width), self.kind)

    def close(self) -> None:
        self._file.close()


class _Writer:
    """One file being written: ids go out as they come, the sequences at the end."""

    def __init__(self, root: str, pid: int, seq: int, kind: np.dtype):
        self.store, self.folder = _file_system(root)
        self.store.create_dir(self.folder, recursive=True)
        self.name, self.kind = f"part-{pid:07d}-{seq:05d}.tokens", kind
        self.uri, self.key = f"{root.rstrip('/')}/{self.name}", (pid, seq)
        self.partial = f"{self.folder}/_{self.name}-{uuid.uuid4().hex}"
        self.out = self.store.open_output_stream(self.partial)
        self.lengths, self.doc_ids, self.n_bytes, self.nulls = [], [], 0, 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.out.write(ids)
        self.n_bytes += len(ids)
        self.lengths.append(len(ids) // self.kind.itemsize)
        if doc_id is None:
            self.nulls += 1
        else:
            self.doc_ids.append(doc_id)

    def full(self) -> bool:
        return self.n_bytes >= FILE_IDS or len(self.lengths) >= FILE_DOCS

    def close(self) -> tuple:
        bounds = np.concatenate([[0], np.cumsum(self.lengths, dtype=np.int64)])
        first = self.doc_ids[0] if self.doc_ids else 0
        apart = np.array(self.doc_ids, dtype=np.int64).view(np.uint64) - np.uint64(first % (1 << 64))
        of_bounds, of_ids = EliasFano.encode(bounds), EliasFano.encode(apart)
        pad = -self.n_bytes % 8
        at = self.n_bytes + pad
        self.out.write(b"\0" * pad + of_bounds + of_ids)
        n_ids = self.n_bytes // self.kind.itemsize
        self.out.write(_FOOTER.pack(n_ids, len(self.lengths), self.nulls, first, at, at + len(of_bounds),
                                    self.kind.itemsize, _MAGIC))
        self.out.close()
        self.store.move(self.partial, f"{self.folder}/{self.name}")
        return (*self.key, self.uri, len(self.lengths), n_ids)


def write_token_files(docs: DataFrame, root: str, tokenizer_path: str, end_id: int = 2, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """Write the ids of all documents, ascending by id, below ``root``; returns the manifest.

    Each document's ids are followed by ``end_id``.  ``root`` is a folder in any store
    that pyarrow opens at the workers and Spark at the driver."""
    rows = id_and_text(docs, id_col, text_col)
    _, repeated = measured(rows)
    if repeated:
        rows = in_parts(reduced(rows), COPIES)
    else:
        rows = rows.withColumns({"n": F.lit(1).cast("long"), "part": F.lit(0).cast("long")})
    rows = rows.withColumn("tie", F.xxhash64("text"))
    order = [F.col("doc_id").asc_nulls_first(), "tie", "part"]
    n = range_count(rows, 2 * scanned_bytes(docs.select(id_col, text_col)))
    rows = (rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
            .select(F.spark_partition_id().alias("pid"), "doc_id", "n", "text"))

    def write(batches):
        tool, out, done, files = encoder(tokenizer_path), None, [], 0
        end = np.array([end_id], dtype=tool.kind).tobytes()
        for pids, ids, copies, texts in slices(batches, ("pid", "doc_id", "n", "text")):
            for pid, doc_id, n_copies, tokens in zip(pids, ids, copies, tool.encode(texts)):
                for _ in range(n_copies):
                    if out is None:
                        out, files = _Writer(root, pid, files, tool.kind), files + 1
                    out.add(doc_id, tokens + end)
                    if out.full():
                        done.append(out.close())
                        out = None
        if out is not None:
            done.append(out.close())
        if done:
            yield record_batch(_manifest_schema(), *zip(*done))

    files = rows.mapInArrow(write, _MANIFEST)
    # a row a file; sums over blocks of 1,024 partitions, then inside each
    files = stored(files.repartition(1 + n // 4096), "token-files").withColumn("block", F.shiftright("pid", 10))
    all_before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("block").orderBy("pid", "seq").rowsBetween(Window.unboundedPreceding, -1)
    blocks = files.groupBy("block").agg(F.sum("n_ids").alias("n")).select(
        "block", F.coalesce(F.sum("n").over(all_before), F.lit(0)).alias("base"))
    manifest = files.join(blocks, "block").select(
        "pid", "seq", "path", "n_docs", "n_ids",
        (F.col("base") + F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).alias("start"))
    manifest.coalesce(1 + n // 4096).write.mode("overwrite").parquet(f"{root.rstrip('/')}/_manifest")
    return docs.sparkSession.read.parquet(f"{root.rstrip('/')}/_manifest")


def _manifest_schema() -> pa.Schema:
    return pa.schema([("pid", pa.int32()), ("seq", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()),
                      ("n_ids", pa.int64())])


def read_token_files(spark: SparkSession, root: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, read from the files:
    ``start`` counts the ids of all documents before it, the checksum is of the ids as
    unsigned 32-bit integers."""
    files = spark.read.parquet(f"{root.rstrip('/')}/_manifest")
    n = range_count(files, files.agg(F.sum("n_ids")).first()[0] or 0)
    files = files.select("start", "path").repartitionByRange(n, "start")

    def read(batches):
        for batch in batches:
            for start, path in zip(batch.column("start").to_pylist(), batch.column("path").to_pylist()):
                source = TokenFile(path)
                for first in range(0, source.n_docs, 4096):
                    docs = np.arange(first, min(first + 4096, source.n_docs))
                    bounds = source.bounds(np.append(docs, docs[-1] + 1))
                    sums, done = [], 0
                    while done < len(docs):
                        upto = max(done + 1, int(np.searchsorted(bounds, bounds[done] + READ_IDS, "right")) - 1)
                        ids = source.ids(int(bounds[done]), int(bounds[upto])).astype("<u4")
                        at = (bounds[done:upto + 1] - bounds[done]).tolist()
                        sums += [zlib.crc32(ids[a:b]) for a, b in zip(at, at[1:])]
                        done = upto
                    yield record_batch(_ROWS, source.doc_ids(docs), start + bounds[:-1], np.diff(bounds), sums)
                source.close()

    return files.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


__all__ = ["Encoder", "TokenFile", "encoder", "read_token_files", "write_token_files"]

"""Length-delimited binary records of token ids, with masked checksums and an offset index.

A record is: length of the body (8 bytes), masked CRC-32C of those 8 bytes (4), body,
masked CRC-32C of the body (4); all numbers little-endian. The body is: flags (1 byte:
width of an id, 2 or 4, plus 128 where the document id is NULL), document id (8 bytes),
ids. Beside each record file lies an index file with one entry of 24 bytes per record:
offset, length of the whole record, number of ids; a shuffled reader fetches any record
with one ranged read.
"""
from __future__ import annotations

import functools
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dieflow.llm.words import SPACE, Cache, is_plain, keys, pieces, unit
from dieflow.sources.frames import gather

# CRC-32C polynomial (reflected) and the mask of record files.
POLYNOMIAL = 0x82F63B78
MASK = 0xA282EAD8
LANE = 512
# Characters encoded together; records read together.
BLOCK = 1 << 23
# Units encoded as one text.
TOGETHER = 1 << 12
# Units whose ids a worker keeps.
CACHE = 1_000_000
READ = 1 << 23
# Schemes whose files pyarrow opens; extend for other stores.
SCHEMES = {"file": "file", "hdfs": "hdfs", "viewfs": "viewfs", "s3": "s3", "s3a": "s3", "s3n": "s3", "gs": "gs", "abfs": "abfs", "abfss": "abfss"}


def opened(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path for a URI; an unknown scheme raises."""
    scheme, found, rest = path.partition(":")
    if not found or "/" in scheme:
        return pafs.LocalFileSystem(), path
    if scheme not in SCHEMES:
        raise ValueError(f"no file system known for {scheme}: add it to SCHEMES")
    rest = rest if rest.startswith("//") else "//" + rest
    return pafs.FileSystem.from_uri(f"{SCHEMES[scheme]}:{rest}")


@functools.lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """CRC of every two bytes, and the effect of LANE zero bytes on a state."""
    word = np.arange(1 << 16, dtype=np.uint32)
    for _ in range(16):
        word = np.where(word & 1, (word >> 1) ^ np.uint32(POLYNOMIAL), word >> 1)
    basis = np.uint32(1) << np.arange(32, dtype=np.uint32)
    for _ in range(LANE // 2):
        basis = word[basis & 0xFFFF] ^ (basis >> 16)
    skip = np.zeros((4, 256), np.uint32)
    for part in range(4):
        for bit in range(8):
            skip[part] ^= np.where(np.arange(256) >> bit & 1, basis[8 * part + bit], 0).astype(np.uint32)
    return word, skip


def crc32c(data: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """CRC-32C of consecutive byte strings of at least 4 bytes each.

    Strings are cut into lanes of 512 bytes, aligned at their ends; all lanes advance two
    bytes at a time, then a string's lanes are chained.
    """
    word, skip = _tables()
    sizes = np.asarray(sizes, np.int64)
    if not len(sizes):
        return np.zeros(0, np.uint32)
    lanes = -(-sizes // LANE)
    first = np.cumsum(lanes) - lanes
    start = np.cumsum(sizes) - sizes
    # Zeros in front leave a zero state unchanged; the usual first state is put into the first four bytes.
    flat = np.zeros(int(lanes.sum()) * LANE, np.uint8)
    shift = (first + lanes) * LANE - (start + sizes)
    flat[np.arange(len(data)) + np.repeat(shift, sizes)] = data
    for k in range(4):
        flat[start + shift + k] ^= 0xFF
    steps = np.ascontiguousarray(flat.view("<u2").reshape(-1, LANE // 2).T).astype(np.uint32)
    state = np.zeros(len(flat) // LANE, np.uint32)
    for step in steps:
        state ^= step
        state = word[state & 0xFFFF] ^ (state >> 16)
    out = state[first]
    for k in range(1, int(lanes.max())):
        more = np.flatnonzero(lanes > k)
        x = out[more]
        out[more] = skip[0][x & 255] ^ skip[1][x >> 8 & 255] ^ skip[2][x >> 16 & 255] ^ skip[3][x >> 24] ^ state[first[more] + k]
    return out ^ np.uint32(0xFFFFFFFF)


def masked(crc: np.ndarray) -> np.ndarray:
    crc = crc.astype(np.uint64)
    return (((crc >> 15 | crc << 17) & 0xFFFFFFFF) + MASK & 0xFFFFFFFF).astype("<u4")


def framed(bodies: list[bytes]) -> list[bytes]:
    """Whole records."""
    if not bodies:
        return []
    sizes = np.array([len(b) for b in bodies], "<u8")
    heads = masked(crc32c(sizes.view(np.uint8), np.full(len(sizes), 8)))
    tails = masked(crc32c(np.frombuffer(b"".join(bodies), np.uint8), sizes.astype(np.int64)))
    return [b"".join((n.tobytes(), h.tobytes(), b, t.tobytes())) for n, h, b, t in zip(sizes, heads, bodies, tails)]


def unframed(data: bytes) -> tuple[list[bytes], int]:
    """Bodies of the whole records at the start of ``data``, checked, and the bytes they take."""
    at, bodies, heads, ends = 0, [], [], []
    while at + 16 <= len(data):
        size = int.from_bytes(data[at:at + 8], "little")
        if at + 16 + size > len(data):
            break
        heads.append(data[at:at + 12])
        bodies.append(data[at + 12:at + 12 + size])
        ends.append(data[at + 12 + size:at + 16 + size])
        at += 16 + size
    if bodies:
        head = np.frombuffer(b"".join(heads), np.dtype([("n", "u1", 8), ("crc", "<u4")]))
        sizes = np.array([len(b) for b in bodies])
        good = (masked(crc32c(head["n"].ravel(), np.full(len(head), 8))) == head["crc"]) & (
            masked(crc32c(np.frombuffer(b"".join(bodies), np.uint8), sizes)) == np.frombuffer(b"".join(ends), "<u4")
        )
        if not good.all():
            raise ValueError(f"record {int(np.flatnonzero(~good)[0])} of this block has a wrong checksum")
    return bodies, at


class Units(Cache):
    """A cache that, when full, keeps what the block at hand needs."""

    def learn(self, lists: list[list[str]]) -> None:
        wanted = set().union(*lists)
        new = wanted.difference(self.keys())
        if len(self) + len(new) > self.limit:
            kept = {k: self[k] for k in wanted.difference(new)}
            self.clear()
            self.update(kept)
        new = list(new)
        self.update(zip(new, self.compute([unit(k) for k in new])))


class Encoder:
    """Token ids of whole texts by the tokenizers library; each distinct unit is encoded once per worker."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.wide = 4 if self.library.get_vocab_size() > 1 << 16 else 2
        self.kind = "<u4" if self.wide == 4 else "<u2"
        self.special = [x.content for x in self.library.get_added_tokens_decoder().values()]
        # Bytes of each token: a letter stands for a byte.
        self.sizes = np.zeros(self.library.get_vocab_size(), np.int64)
        for token, i in self.library.get_vocab().items():
            self.sizes[i] = len(token)
        self.units = Units(self._units, CACHE)
        line = self.library.encode("\nx", add_special_tokens=False).ids
        self.cut = self.wide * (len(line) - 1)

    def _units(self, units: list[str]) -> list[bytes]:
        """Ids of each unit. No token crosses the start of white space behind something else, so such units are encoded many at a time."""
        out: list[bytes] = [b""] * len(units)
        safe = [u[0] in SPACE and u[-1] not in SPACE for u in units]
        alone = [i for i, ok in enumerate(safe) if not ok]
        whole = [i for i, ok in enumerate(safe) if ok]
        parts = [whole[at:at + TOGETHER] for at in range(0, len(whole), TOGETHER)]
        texts = [[units[i] for i in part] for part in parts]
        for part, text, found in zip(parts, texts, self.library.encode_batch_fast(list(map("".join, texts)), add_special_tokens=False)):
            ids = np.array(found.ids, self.kind)
            ends, upto = np.cumsum(self.sizes[ids]), np.cumsum([len(u.encode()) for u in text])
            stops = np.searchsorted(ends, upto) + 1
            if ends[-1] != upto[-1] or (ends[stops - 1] != upto).any():
                alone += part
                continue
            packed = ids.tobytes()
            for i, lo, hi in zip(part, [0, *(stops[:-1] * self.wide).tolist()], (stops * self.wide).tolist()):
                out[i] = packed[lo:hi]
        for i, found in zip(alone, self.library.encode_batch_fast([units[i] for i in alone], add_special_tokens=False)):
            out[i] = np.array(found.ids, self.kind).tobytes()
        return out

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text, as bytes. A text holding a special string goes to the library in one piece."""
        out: list[bytes] = []
        plain: list[int] = []
        other: list[tuple[int, list[str], bool]] = []
        size = rest = 0
        for i, text in enumerate(texts):
            out.append(b"")
            if text and any(x in text for x in self.special):
                out[i] = np.array(self.library.encode(text, add_special_tokens=False).ids, self.kind).tobytes()
            elif text and len(text) <= BLOCK and is_plain(text):
                plain.append(i)
                size += len(text)
                if size >= BLOCK:
                    self._add_plain(out, texts, plain)
                    plain, size = [], 0
            else:
                # Piece by piece, so that the units of a very long text are never all held.
                for piece in pieces(text or ""):
                    found, extra = keys(piece)
                    other.append((i, found, extra))
                    rest += len(piece)
                    if rest >= BLOCK:
                        self._add(out, other)
                        other, rest = [], 0
        self._add_plain(out, texts, plain)
        self._add(out, other)
        return out

    def _add(self, out: list[bytes], block: list[tuple[int, list[str], bool]]) -> None:
        self.units.learn([found for _, found, _ in block])
        get = self.units.__getitem__
        for i, found, extra in block:
            ids = b"".join(map(get, found))
            out[i] += ids[self.cut:] if extra else ids

    def _add_plain(self, out: list[bytes], texts: list[str], plain: list[int]) -> None:
        """Texts cut at every space and line break: each distinct unit of the block is looked up once, and its ids are copied to its places."""
        if not plain:
            return
        cut = pa.compute.split_pattern(pa.array(["\n" + texts[i].replace("\n", " \n") for i in plain]), " ")
        units = cut.flatten().dictionary_encode()
        known = units.dictionary.to_pylist()
        self.units.learn([known])
        ids = list(map(self.units.__getitem__, known))
        sizes = np.array([len(x) for x in ids], np.int64)
        at = units.indices.to_numpy()
        source = np.frombuffer(b"".join(ids), self.kind)
        sizes //= self.wide
        begin = np.cumsum(sizes) - sizes
        values, offsets = gather(source, begin[at], sizes[at])
        ends = offsets[np.asarray(cut.offsets)].tolist()
        lead = self.cut // self.wide
        for i, lo, hi in zip(plain, ends, ends[1:]):
            out[i] = values[lo + lead:hi].tobytes()


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Encoder(path)


WRITTEN = "shard int, path string, n_docs long, n_tokens long, n_bytes long"


def write_records(
    docs: DataFrame, folder: str, model_path: str, end_id: int | None = 2, id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """Encode whole texts and write them as record files in ascending id order; returns the manifest.

    One range partition is one shard: ``part-NNNNN.rec`` and its index ``part-NNNNN.idx``
    in ``folder``, written under a name of the attempt and renamed when whole, so a task
    that runs again replaces its own files only. The manifest (a row per shard: shard,
    path, n_docs, n_tokens, n_bytes) is stored in ``folder/manifest``.

    ``end_id`` is appended to every document unless None. NULL and empty texts give just the
    end id. Equal ids are ordered by a hash of the text, NULL ids come first, every row gives a record;
    an empty table gives an empty manifest. Other columns are not read.
    """
    spark = docs.sparkSession
    opened(folder)
    rows = docs.select(F.col(id_column).cast("bigint").alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    # The hash spreads repeated ids over shards.
    rows = rows.withColumn("tie", F.xxhash64("text")).repartitionByRange("id", "tie").sortWithinPartitions("id", "tie")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        fs, base = opened(folder)
        name, attempt = f"{base}/part-{shard:05d}", uuid.uuid4().hex
        ids = encoder(model_path)
        end = b"" if end_id is None else np.array([end_id], ids.kind).tobytes()
        out, index, at, tokens, count = None, [], 0, 0, 0
        for batch in batches:
            for lo, hi in _blocks(batch):
                part = batch.slice(lo, hi - lo)
                texts = ids.encode(part.column("text").to_pylist())
                bodies = [
                    struct.pack("<Bq", ids.wide | (128 if i is None else 0), i or 0) + t + end
                    for i, t in zip(part.column("id").to_pylist(), texts)
                ]
                if bodies and out is None:
                    fs.create_dir(base, recursive=True)
                    out = fs.open_output_stream(f"{base}/.{attempt}.rec")
                whole = framed(bodies)
                sizes = np.array([len(x) for x in whole], np.int64)
                n = (sizes - 25) // ids.wide
                index.append(np.stack([at + np.cumsum(sizes) - sizes, sizes, n], 1).astype("<i8").tobytes())
                out.write(b"".join(whole))
                at, tokens, count = at + int(sizes.sum()), tokens + int(n.sum()), count + len(whole)
        if out is not None:
            out.close()
            with fs.open_output_stream(f"{base}/.{attempt}.idx") as f:
                f.write(b"".join(index))
            for kind in ("rec", "idx"):
                fs.move(f"{base}/.{attempt}.{kind}", f"{name}.{kind}")
            yield pa.RecordBatch.from_pydict(
                {"shard": pa.array([shard], pa.int32()), "path": [f"part-{shard:05d}"], "n_docs": pa.array([count], pa.int64()),
                 "n_tokens": pa.array([tokens], pa.int64()), "n_bytes": pa.array([at], pa.int64())}
            )

    rows.select("id", "text").mapInArrow(write, WRITTEN).write.parquet(f"{folder}/manifest")
    return spark.read.schema(WRITTEN).parquet(f"{folder}/manifest")


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[int, int]]:
    """Row ranges of about BLOCK bytes of text."""
    sizes = np.cumsum(pa.compute.binary_length(batch.column("text")).to_numpy(zero_copy_only=False))
    lo = 0
    while lo < len(sizes):
        hi = max(lo + 1, int(np.searchsorted(sizes, (sizes[lo - 1] if lo else 0) + BLOCK, "right")))
        yield lo, hi
        lo = hi


READ_BACK = "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary"


def read_records(spark: SparkSession, folder: str, with_ids: bool = True) -> DataFrame:
    """Documents of a record folder: doc_id, start (ids of all documents before it), n_tokens, ids_crc32, ids.

    Every checksum is verified; a wrong one fails the job. ``ids`` are little-endian
    unsigned 32-bit integers, and ``ids_crc32`` is their CRC-32; ``with_ids=False`` leaves
    the ids out. One task reads one shard as a stream.
    """
    manifest = spark.read.schema(WRITTEN).parquet(f"{folder}/manifest")
    shards = max(1, manifest.count())
    # A row per shard, so the ordered sum in one task is bounded by the number of files.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.select("shard", "path", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("start"))

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, base = opened(folder)
        for frame in frames:
            for path, start in zip(frame["path"], frame["start"]):
                with fs.open_input_stream(f"{base}/{path}.rec") as f:
                    rest = b""
                    while data := f.read(READ):
                        bodies, used = unframed(rest + data)
                        rest = (rest + data)[used:]
                        if bodies:
                            out, start = _documents(bodies, start, with_ids)
                            yield out
                    if rest:
                        raise ValueError(f"{path}.rec ends inside a record")

    return placed.repartition(shards, "shard").mapInPandas(read, READ_BACK if with_ids else READ_BACK.removesuffix(", ids binary"))


def _documents(bodies: list[bytes], start: int, with_ids: bool) -> tuple[pd.DataFrame, int]:
    rows = []
    for body in bodies:
        flags, doc = struct.unpack_from("<Bq", body)
        ids = np.frombuffer(body, "<u4" if flags & 4 else "<u2", offset=9).astype("<u4").tobytes()
        row = (None if flags & 128 else doc, start, len(ids) // 4, zlib.crc32(ids))
        rows.append((*row, ids) if with_ids else row)
        start += len(ids) // 4
    columns = dict(zip(["doc_id", "start", "n_tokens", "ids_crc32", "ids"], zip(*rows)))
    return pd.DataFrame(columns | {"doc_id": pd.array(columns["doc_id"], "Int64")}), start


def fetch(folder: str, path: str, entries: np.ndarray) -> Iterator[bytes]:
    """Bodies of single records of one file, in the order of ``entries`` (record numbers), by way of its index."""
    fs, base = opened(folder)
    with fs.open_input_file(f"{base}/{path}.idx") as f:
        index = np.frombuffer(f.read(), "<i8").reshape(-1, 3)
    with fs.open_input_file(f"{base}/{path}.rec") as f:
        for offset, size, _ in index[entries]:
            f.seek(int(offset))
            yield unframed(f.read(int(size)))[0][0]

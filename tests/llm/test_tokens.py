"""Token counts and binary records against the tokenizers library."""
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from dieflow.llm import records, token_counts, words
from dieflow.llm.common import table
from dieflow.llm.queries import QUERIES
from dieflow.session import scratch_path

PATH = public_tokenizers.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.001"
ODD = [
    "", " ", "\n", "  ", "a", " a", "a ", "a\n", "\na", "a  b", "a \n b", "a\n\nb", "x\ty", "don't we'll I'M 's", "aaaaaaaaaaaaaaaa", "a" * 3001,
    "<|endoftext|>", "hi <|endoftext|> there<|endoftext|><|endoftext|>", "\x00nul \x00", "日本語 テキスト", "a b  c　", "é" * 50, "🙂🙂 x🙂",
    "12345 6,7.8", "***!!! ###", "a\x1cb \x1c c", "tail\n \n", "word " * 2000, None, "ß\r\nq\r\n", "\x85 x",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def odd_docs(spark):
    rows = [(i, t, "clash", 1) for i, t in enumerate(ODD)] + [(None, "null id", "c", 2), (3, "again", "c", 3), (3, "again", "c", 3)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, start int")


def test_counts_equal_the_library(spark, library):
    docs = odd_docs(spark).select("doc_id", "text", "n_tokens")
    got = sorted(map(str, token_counts.token_counts(docs, PATH).collect()))
    want = []
    for r in docs.collect():
        n = len(library.encode(r.text or "", add_special_tokens=False).ids)
        want.append(f"Row(doc_id={r.doc_id}, n_bytes={len((r.text or '').encode())}, n_tokens={n}, over_limit={n > 512})")
    assert got == sorted(want)
    assert token_counts.token_counts(docs.limit(0), PATH).count() == 0


def test_counts_of_the_given_table(spark, library):
    docs = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    rows = QUERIES["op7_token_counts"](spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert r.n_tokens == len(library.encode(docs[r.doc_id] or "", add_special_tokens=False).ids), r.doc_id


def test_pieces_and_small_caches_change_nothing(library, monkeypatch):
    merges = token_counts.Merges(PATH)
    merges.words.limit = 50
    monkeypatch.setattr(token_counts, "pieces", lambda text: words.pieces(text, 7))
    monkeypatch.setattr(token_counts, "BLOCK", 20)
    got = merges.count(ODD)
    assert got.tolist() == [len(library.encode(t or "", add_special_tokens=False).ids) for t in ODD]


def test_checksum():
    # Fixed value: the usual check value of CRC-32C.
    assert records.crc32c(np.frombuffer(b"123456789", np.uint8), np.array([9]))[0] == 0xE3069283

    def plain(data):
        crc = 0xFFFFFFFF
        for b in data:
            crc ^= b
            for _ in range(8):
                crc = crc >> 1 ^ (records.POLYNOMIAL if crc & 1 else 0)
        return crc ^ 0xFFFFFFFF

    data = [bytes((i * 7 + k) % 256 for k in range(n)) for i, n in enumerate([4, 5, 511, 512, 513, 1024, 2000])]
    got = records.crc32c(np.frombuffer(b"".join(data), np.uint8), np.array([len(d) for d in data]))
    assert got.tolist() == [plain(d) for d in data]


def expected(docs, library):
    start, out = 0, []
    rows = docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("tie")).collect()
    for doc_id, text, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[2])):
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_records_round_trip(spark, library):
    docs = odd_docs(spark)
    folder = scratch_path(spark, "records")
    manifest = records.write_records(docs, folder, PATH)
    got = records.read_records(spark, folder)
    rows = sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got.collect()), key=lambda r: r[1])
    assert rows == expected(docs, library)
    shard = manifest.orderBy("n_docs", ascending=False).first()
    bodies = list(records.fetch(folder, shard.path, np.arange(shard.n_docs)[::-1]))
    assert len(bodies) == shard.n_docs
    assert all(int.from_bytes(b[-2:], "little") == 2 for b in bodies)
    empty = scratch_path(spark, "records")
    assert records.write_records(docs.limit(0), empty, PATH).count() == 0 and records.read_records(spark, empty).count() == 0


def test_records_of_the_given_table(spark, library):
    docs = table(spark, SF, "documents")
    rows = QUERIES["op8_binary_records"](spark, SF).collect()
    assert sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in rows), key=lambda r: r[1]) == expected(docs, library)


def test_damage_is_found():
    whole = bytearray(b"".join(records.framed([b"x" * 20, b"y" * 600])))
    assert records.unframed(bytes(whole))[0] == [b"x" * 20, b"y" * 600]
    for at in (3, 15, 100, len(whole) - 1):
        broken = whole.copy()
        broken[at] ^= 4
        try:
            bodies, used = records.unframed(bytes(broken))
        except ValueError:
            continue
        assert used < len(whole)


def test_unknown_store_raises(spark):
    with pytest.raises(ValueError):
        records.write_records(odd_docs(spark), "nowhere://x/y", PATH)

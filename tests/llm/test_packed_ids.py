"""Packed token ids: exact round trips, and the query against the tokenizers library."""
import zlib

import numpy as np
import pytest
from pyarrow import fs
from tokenizers import Tokenizer

from tideline.llm import packed_ids
from tideline.llm.common import table
from tideline.llm.packing import tokenizer_file

SCHEMA = "doc_id long, text string"


@pytest.mark.parametrize("bits", [1, 3, 7, 8, 13, 16, 17, 24, 31, 32])
def test_round_trip_at_every_width(bits):
    rng = np.random.default_rng(bits)
    for count in (0, 1, 7, 8, 9, 1000):
        ids = rng.integers(0, 1 << bits, count, np.uint64).astype(np.uint32)
        data = packed_ids.packed(ids, bits)
        assert len(data) == -(-count * bits // 8)
        assert (packed_ids.unpacked(data, bits, count) == ids).all()
    with pytest.raises(ValueError):
        packed_ids.packed(np.array([1 << bits], np.uint64), bits)


def test_widths_of_vocabularies():
    assert [packed_ids.bits_for(n) for n in (1, 2, 3, 50257, 65536, 65537)] == [1, 1, 2, 16, 16, 17]


def test_file_with_random_access(tmp_path):
    rng, store = np.random.default_rng(3), fs.LocalFileSystem()
    docs = [rng.integers(0, 1 << 17, n).astype(np.uint32) for n in (0, 5, 40, 1, 300, 16, 0, 9)]
    out = packed_ids.Writer(store, str(tmp_path / "x"), 17, block=16)
    for i, ids in enumerate(docs):
        out.add(None if i < 2 else i, ids)
    size = out.close()
    assert [p.name for p in tmp_path.iterdir()] == ["x"] and (tmp_path / "x").stat().st_size == size
    reader, every = packed_ids.Reader(store, str(tmp_path / "x")), np.concatenate(docs)
    assert reader.doc_ids == [None, None, 2, 3, 4, 5, 6, 7]
    assert all((reader.document(i) == ids).all() for i, ids in enumerate(docs))
    for a in range(0, len(every), 7):
        for b in range(a, len(every), 31):
            assert (reader.ids(a, b) == every[a:b]).all()
    assert [c for *_, c in reader.checksums()] == [zlib.crc32(d.astype("<u4").tobytes()) for d in docs]


def plain(rows):
    """Rows of the query from the tokenizers library; ids of one doc_id in any order."""
    t = Tokenizer.from_file(tokenizer_file())
    out, start = [], 0
    for d, text in rows:
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        out.append((d, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_query(spark, small):
    import __spark_entry__
    rows = [tuple(r) for r in table(spark, small, "documents").select("doc_id", "text").orderBy("doc_id").collect()]
    got = [tuple(r) for r in __spark_entry__.queries()["op11_packed_ids"](spark, small)
           .select("doc_id", "start", "n_tokens", "ids_crc32").orderBy("start").collect()]
    assert got == plain(rows)


def test_odd_rows_and_small_files(spark, tmp_path):
    long = "word and <|endoftext|> " * 20000
    rows = [(None, "without id"), (-5, None), (1, ""), (2, "a b"), (2, "a b"), (7, long), (9, " \n\t éİ "), (11, "end")]
    docs = spark.createDataFrame([(*r, "x", 1) for r in reversed(rows)], SCHEMA + ", file string, part int")
    files = packed_ids.write_ids(docs, f"file://{tmp_path}/f", file_bytes=100, block=64)
    assert files.count() >= 2 and files.agg({"n_docs": "sum"}).first()[0] == len(rows)
    got = [tuple(r) for r in packed_ids.read_ids(files, f"file://{tmp_path}/f").orderBy("start").collect()]
    assert got == plain(rows)


def test_empty_table(spark, tmp_path):
    got = packed_ids.stored_ids(spark, spark.createDataFrame([], SCHEMA), str(tmp_path / "none"))
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and got.count() == 0

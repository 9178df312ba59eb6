"""Vector best-fit packing of tokenized documents.

Documents are tokenized once and become rows of piece lengths; only those rows
are packed. Pieces are dealt by hash to groups of about ``GROUP`` rows, each an
independent best-fit-decreasing packing, so work grows in proportion to the
data and a group loses at most a part of its last sequences.

A sequence has three residual capacities: tokens, documents and attention cost
(the sum of squared piece lengths). A piece goes to an open sequence that can
take it under all three, the one with the smallest weighted norm of what would
be left, or with the largest weighted dot product of piece and residual.

Defined cases: a null or empty text is one closing id; an empty table gives no
rows; a null doc_id is packed like any other; repeated rows are packed as often
as they come; further columns are ignored.
"""
from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tideline.llm.common import whole
from tideline.session import cut_lineage

CAPACITY = 2048
CLOSING_ID = 0
GROUP = 8192               # pieces packed together
DOCUMENTS = 64             # pieces of a sequence, for ``pack``
WEIGHTS = (1.0, 0.5, 0.5)  # of the tokens, documents and attention cost left, for ``pack``


def tokenizer_file() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


class Tokens:
    """Ids of whole texts under a byte-level BPE file.

    ``tokenizers`` reads the file; ``tiktoken`` merges with its vocabulary,
    where the id of a string is also its merge rank. Both give the same ids,
    and the latter returns them as an array without an object per id.
    """

    def __init__(self, path: str):
        import tiktoken
        from public_tokenizers import PATTERN
        from tokenizers import Tokenizer
        read = Tokenizer.from_file(path)
        special = {t.content: i for i, t in read.get_added_tokens_decoder().items()}
        own = [*range(33, 127), *range(161, 173), *range(174, 256)]     # bytes written as their own character
        byte = {chr(b): b for b in own}
        byte.update((chr(256 + i), b) for i, b in enumerate(sorted(set(range(256)) - set(own))))
        ranks = {bytes(map(byte.__getitem__, w)): i for w, i in read.get_vocab().items() if w not in special}
        self.coder = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def ids(self, text: str) -> np.ndarray:
        return self.coder.encode_to_numpy(text, allowed_special="all")


def pieces(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
           tokenizer: str | None = None, closing: int = CLOSING_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: long documents cut so that only the first piece is shorter."""
    path = tokenizer or tokenizer_file()

    def run(batches):
        tokens = Tokens(path)
        for batch in batches:
            rows = []
            for i, text in zip(*(c.to_pylist() for c in batch.columns)):
                ids = np.append(tokens.ids(text), closing).astype("<u4")
                more = (len(ids) - 1) // capacity
                size, start = len(ids) - more * capacity, 0
                for k in range(1 + more):
                    rows.append((i, k, start, size, zlib.crc32(ids[start:start + size])))
                    start, size = start + size, capacity
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                             names=["doc_id", "piece", "start", "length", "ids_crc32"])

    x = docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole(text).alias("text"))
    return x.mapInArrow(lambda batches: run(b for b in batches if b.num_rows),
                        "doc_id long, piece int, start long, length long, ids_crc32 long")


def best_fit(lengths: np.ndarray, capacity: int = CAPACITY, documents: int | None = None,
             attention: int | None = None, weights: tuple[float, float, float] = (1.0, 0.0, 0.0),
             rule: str = "norm") -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of each piece; ``documents`` and ``attention`` default to limits that never bind."""
    documents = capacity if documents is None else documents
    attention = capacity * capacity if attention is None else attention
    limit = np.array([capacity, documents, attention], float)
    w = np.array(weights, float) / limit ** 2
    if rule not in ("norm", "dot"):
        raise ValueError("rule is norm or dot")
    order = np.argsort(-lengths, kind="stable")
    seq, off = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    left = np.zeros((3, max(1, len(lengths))))
    name = np.zeros(max(1, len(lengths)), np.int64)
    opened = used = 0                                # open sequences are columns 0..used
    least = lengths.min() if len(lengths) else 0
    for i in order:
        n = float(lengths[i])
        need = np.array([n, 1.0, n * n])
        if (need > limit).any():
            raise ValueError("a piece exceeds the capacity of an empty sequence")
        room = left[:, :used]
        fits = np.flatnonzero((room[0] >= need[0]) & (room[1] >= need[1]) & (room[2] >= need[2]))
        if len(fits):
            r = room[:, fits]
            score = w @ (r - need[:, None]) ** 2 if rule == "norm" else -(w * need) @ r
            at = fits[np.argmin(score)]
        else:
            at, used = used, used + 1
            left[:, at], name[at] = limit, opened
            opened += 1
        seq[i], off[i] = name[at], capacity - left[0, at]
        left[:, at] -= need
        if left[0, at] < least or left[1, at] < 1 or left[2, at] < least * least:
            used -= 1                                # full: the last open one takes its column
            left[:, at], name[at] = left[:, used], name[used]
    return seq, off


def pack(cut: DataFrame, capacity: int = CAPACITY, group: int = GROUP, documents: int | None = DOCUMENTS,
         weights: tuple[float, float, float] = WEIGHTS, **limits) -> DataFrame:
    """Add sequence_id and offset to rows of ``pieces``.

    All three residuals weigh in the choice; a sequence takes ``documents``
    pieces at most. Attention cost is limited by what one full piece costs, so
    that limit is there for smaller ones that a caller states.
    """
    stored = cut_lineage(cut)
    groups = max(1, -(-stored.count() // group))

    def run(key: tuple, x: pd.DataFrame) -> pd.DataFrame:
        seq, off = best_fit(x["length"].to_numpy(), capacity, documents, weights=weights, **limits)
        return x.assign(sequence_id=(int(key[0]) << 32) + seq, offset=off).drop(columns="g")

    dealt = stored.withColumn("g", F.pmod(F.xxhash64("doc_id", "piece", "start", "length", "ids_crc32"),
                                          F.lit(groups)))
    return dealt.groupBy("g").applyInPandas(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def pack_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
                   tokenizer: str | None = None, closing: int = CLOSING_ID, **limits) -> DataFrame:
    return pack(pieces(docs, doc_id, text, capacity, tokenizer, closing), capacity, **limits)

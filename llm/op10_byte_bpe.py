"""Byte-level BPE: encoding with the tokenizers library over Arrow batches, and decoding.

A byte-level vocabulary writes every byte as one printable character. ``byte_characters`` is that
mapping; ids become bytes by its reverse, so a character split over several tokens comes back
whole once their bytes are put together. Offsets say which characters of the text a token covers;
a token that holds a part of a character covers that character.

Defined cases: a null text counts as empty and has no ids; special tokens' strings in a text are
ordinary text; ids that the vocabulary lacks decode to nothing; repeated rows are kept; other
columns are kept unless named like an output. Memory is bounded by the memo of vocab.py and by
the longest text.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm.tables import in_batches, others, table
from llm.vocab import encoder, public_path

OUTPUT_BYTES = 8 << 20


def byte_characters() -> dict[str, int]:
    """The character that stands for each byte: itself if printable in Latin-1, else the next from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


@lru_cache(maxsize=2)
def token_bytes(path: str) -> list[bytes]:
    """The bytes of each id."""
    of = byte_characters()
    with open(path, encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    out = [b""] * (max(vocab.values()) + 1)
    for token, i in vocab.items():
        out[i] = bytes(of[c] for c in token)
    return out


def decode_ids(packed: bytes, path: str) -> bytes:
    known = token_bytes(path)
    n = len(known)
    ids = memoryview(packed).cast("I").tolist() if packed else []
    try:
        return b"".join(map(known.__getitem__, ids))
    except IndexError:
        return b"".join(known[i] for i in ids if i < n)


def character_offsets(packed: bytes, path: str) -> tuple[list[int], list[int]]:
    """First character and one past the last of each token."""
    ids = np.frombuffer(packed, dtype="<u4")
    parts = [token_bytes(path)[i] for i in ids]
    ends = np.cumsum([len(p) for p in parts], dtype=np.int64)
    data = np.frombuffer(b"".join(parts), dtype=np.uint8)
    leads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    starts = ends - np.array([len(p) for p in parts], dtype=np.int64)
    inside = leads[starts] - np.array([(p[:1] or b"a")[0] & 0xC0 == 0x80 for p in parts], dtype=np.int64)
    return inside.tolist(), leads[ends].tolist()


def _mapped(df: DataFrame, column: str, made: list[T.StructField], work: Callable[[list], list[list]]) -> DataFrame:
    """``df`` with columns that ``work`` makes from the values of ``column``, in batches of bounded output."""
    names = [f.name for f in made]
    kept = others(df, names)
    schema = T.StructType([*[df.schema[c] for c in kept], *made])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = None
        for batch in batches:
            first, size = 0, 0
            values = batch.column(batch.schema.get_field_index(column))
            lengths = [len(v) if (v := x.as_py()) is not None else 0 for x in values]
            for i, n in enumerate([*lengths, 0]):
                size += n
                if i == len(lengths) or size > OUTPUT_BYTES:
                    stop = i if i == len(lengths) else i + 1
                    if stop > first:
                        part = batch.slice(first, stop - first)
                        out = work(part.column(part.schema.get_field_index(column)).to_pylist())
                        types = types or [pa.binary() if isinstance(f.dataType, T.BinaryType) else pa.list_(pa.int32()) for f in made]
                        yield pa.RecordBatch.from_arrays(
                            [*[part.column(part.schema.get_field_index(c)) for c in kept], *[pa.array(x, t) for x, t in zip(out, types, strict=True)]],
                            names=[*kept, *names],
                        )
                    first, size = stop, 0

    return in_batches(df, run, schema)


def encode(
    documents: DataFrame, path: str, *, text: str = "text", ids: str = "ids", decoded: str | None = None, offsets: bool = False
) -> DataFrame:
    """``documents`` with ``ids`` (binary: little-endian unsigned 32-bit), and on request the bytes
    they decode to and each token's character offsets (``starts``, ``stops``)."""
    made = [T.StructField(ids, T.BinaryType())]
    if decoded:
        made.append(T.StructField(decoded, T.BinaryType()))
    if offsets:
        made += [T.StructField(c, T.ArrayType(T.IntegerType())) for c in ("starts", "stops")]

    def work(texts: list) -> list[list]:
        packed = encoder(path, True).encode(pa.array(texts, pa.string()))
        out = [packed]
        if decoded:
            out.append([decode_ids(p, path) for p in packed])
        if offsets:
            both = [character_offsets(p, path) for p in packed]
            out += [[b[0] for b in both], [b[1] for b in both]]
        return out

    return _mapped(documents, text, made, work)


def decode(encoded: DataFrame, path: str, *, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``encoded`` with the bytes that its ids stand for; null ids decode to no bytes."""
    return _mapped(encoded, ids, [T.StructField(decoded, T.BinaryType())], lambda rows: [[decode_ids(p or b"", path) for p in rows]])


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    both = encode(documents, public_path("byte_bpe_50k.json"), decoded="decoded")
    return both.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )

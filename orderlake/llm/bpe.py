"""BPE encoding and decoding of whole texts over certain cuts."""

import hashlib
import struct

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .fragments import FragmentEncoder, put_together
from .shared import only, worker_store


def encode_texts(docs: DataFrame, tokenizer: str, id_column: str = "doc_id", text_column: str = "text", ids: bool = True) -> DataFrame:
    """Ids of every text and the text that they decode to.

    Columns: the id column, ``n_tokens``, ``ids`` (array of int, unless
    ``ids=False``), ``ids_text`` (decimal ids joined by commas), ``decoded``.
    A null text counts as empty, an empty one has no ids. Rows stay as they lie:
    no shuffle, repeated ids and texts give repeated rows. ``tokenizer`` is a
    path that exists on every executor.
    """
    schema = f"`{id_column}` {dict(docs.dtypes)[id_column]}, n_tokens long, " + "ids array<int>, " * ids + "ids_text string, decoded string"
    return only(docs, id_column, text_column).mapInArrow(_encoder(tokenizer, ids, False), schema)


def encode_digests(docs: DataFrame, tokenizer: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """As ``encode_texts``, with SHA-256 digests in place of ids and decoded text."""
    schema = f"`{id_column}` {dict(docs.dtypes)[id_column]}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return only(docs, id_column, text_column).mapInArrow(_encoder(tokenizer, False, True), schema)


def _encoder(tokenizer: str, with_ids: bool, digests: bool):
    def run(batches):
        import pyarrow as pa

        def make():
            # what is kept stays in the worker while other stages run: some 100 MB
            encoder = FragmentEncoder(tokenizer, lambda ids: struct.pack(f"<{len(ids)}i", *ids), keep=100_000, join=b"".join)
            ids = range(max(encoder.token_bytes) + 1)
            listed = pa.array([b"%d," % i for i in ids], pa.large_binary())
            return encoder, listed, pa.array([encoder.token_bytes.get(i, b"") for i in ids], pa.large_binary())

        sha = lambda data: hashlib.sha256(data).hexdigest()
        encoder, listed, tokens = worker_store(f"bpe:{tokenizer}", make)
        for batch in batches:
            rows = []
            for packed in encoder.encode_packed((text.as_py() or "" for text in batch.column(1)), group_chars=6_000_000):
                n = len(packed) // 4
                ids = pa.Array.from_buffers(pa.int32(), n, [None, pa.py_buffer(packed)])
                numbers = put_together(listed, ids)[0][:-1]
                decoded = put_together(tokens, ids)[0].decode("utf-8", "replace")
                if digests:
                    rows.append((n, sha(numbers), sha(decoded.encode("utf-8"))))
                else:
                    rows.append((n, numbers.decode(), decoded, ids.to_numpy() if with_ids else None))
            columns = [batch.column(0), pa.array([r[0] for r in rows], pa.int64())]
            names = [batch.schema.names[0], "n_tokens"]
            if with_ids:
                columns.append(pa.array([r[3] for r in rows], pa.list_(pa.int32())))
                names.append("ids")
            columns += [pa.array([r[i] for r in rows], pa.string()) for i in (1, 2)]
            names += ["ids_sha256", "decoded_sha256"] if digests else ["ids_text", "decoded"]
            yield pa.RecordBatch.from_arrays(columns, names)
        pa.default_memory_pool().release_unused()

    return run


def decode_ids(frame: DataFrame, tokenizer: str, ids_column: str = "ids") -> DataFrame:
    """``frame`` with ``decoded``: the text of each array of ids (null: empty)."""
    import pandas as pd

    @F.pandas_udf("string")
    def decoded(ids: pd.Series) -> pd.Series:
        of = worker_store(f"bytes:{tokenizer}", lambda: FragmentEncoder(tokenizer, len).token_bytes)
        return ids.map(lambda x: b"".join([of[int(i)] for i in x]).decode("utf-8", "replace") if x is not None else "")

    return frame.withColumn("decoded", decoded(frame[ids_column]))

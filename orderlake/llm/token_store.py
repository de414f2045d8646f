"""Token ids in binary shards with a minimal perfect hash index.

Layout under one shared folder:

- ``shards/*.ids``: 16 bytes of header (magic, bytes per id), the raw ids of the
  documents one after another (little endian, 2 bytes each if the vocabulary
  fits, else 4), the documents' keys and first ids, and their number;
- ``manifest``: a Parquet table, one row per shard in key order, with the number
  of ids before it. Only files that it names belong to the store: a repeated
  task writes under another name, so nothing is counted twice;
- ``index/*.mph``: for each bucket of key hashes a minimal perfect hash of its
  keys with stored fingerprints and, at each key's slot, the places of its
  documents. ``index_files`` lists those that count.

A keyed access costs one bucket lookup and one seek, whatever the store's size.
"""

from __future__ import annotations

import io
import struct
import uuid
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .files import open_file
from .fragments import FragmentEncoder
from .perfect_hash import PerfectHash, fingerprints
from .shared import worker_store, written

MAGIC = b"OLTOKENS"
#: A document without a key is stored under this one, before all others.
NO_KEY = -(2**63)




class TokenStore:
    """A store in ``folder``, a URI that all executors share."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.manifest = spark.read.parquet(f"{folder}/manifest")
        self.index_files = spark.read.parquet(f"{folder}/index_files")

    @classmethod
    def write(
        cls,
        docs: DataFrame,
        folder: str,
        tokenizer: str,
        end_id: int,
        id_column: str = "doc_id",
        text_column: str = "text",
        partitions: int | None = None,
        shard_ids: int = 16_000_000,
        shard_docs: int = 500_000,
        bucket_keys: int = 500_000,
    ) -> TokenStore:
        """Encode every whole text, append ``end_id``, and write shards in key order.

        Null texts count as empty: their documents hold ``end_id`` alone. Null
        keys come first and are found under ``NO_KEY``. Repeated keys are all
        kept, in the order of their texts' hashes. Shards end at ``shard_ids``
        ids or ``shard_docs`` documents. ``partitions``: tasks that encode,
        ``spark.sql.shuffle.partitions`` if not given.
        """
        spark = docs.sparkSession
        key = F.coalesce(docs[id_column].cast("long"), F.lit(NO_KEY)).alias("key")
        rows = docs.select(key, F.coalesce(docs[text_column], F.lit("")).alias("text")).withColumn("tie", F.xxhash64("text"))
        rows = rows.repartitionByRange(partitions or int(spark.conf.get("spark.sql.shuffle.partitions")), "key", "tie")
        rows = rows.sortWithinPartitions("key", "tie").select("key", "text")
        schema = "part int, seq int, path string, n_docs long, n_ids long, first_key long, last_key long"
        shards = rows.mapInArrow(_shard_writer(f"{folder}/shards", tokenizer, end_id, shard_ids, shard_docs), schema)
        shards = written(shards, f"{folder}/parts")
        # one row per shard: its number and the ids before it
        order = Window.orderBy("part", "seq")
        before = order.rowsBetween(Window.unboundedPreceding, -1)
        manifest = shards.select(
            (F.row_number().over(order) - 1).cast("long").alias("shard"), "path", "n_docs", "n_ids", "first_key", "last_key",
            F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base"),
        )
        manifest = written(manifest, f"{folder}/manifest")
        total = manifest.agg(F.sum("n_docs")).first()[0] or 0
        cls._write_index(manifest, folder, max(1, -(-total // bucket_keys)))
        return cls(spark, folder)

    @staticmethod
    def _write_index(manifest: DataFrame, folder: str, buckets: int) -> None:
        n = manifest.agg(F.count("*")).first()[0]
        paths = manifest.select("shard", "path").repartition(max(1, n), "shard")
        entries = paths.mapInArrow(_read_entries, "key long, shard long, row long, n long")
        bucket = F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("int")
        files = entries.withColumn("bucket", bucket).groupBy("bucket").applyInPandas(
            _index_writer(f"{folder}/index"), "bucket int, path string, n_keys long"
        )
        written(files.withColumn("buckets", F.lit(buckets)), f"{folder}/index_files")

    def locate(self, keys: DataFrame, key_column: str) -> DataFrame:
        """``key, shard, row, n``: where the rows of each key lie; unknown keys have none.

        ``key_column`` may hold a key many times: it is looked up once.
        """
        first = self.index_files.select("buckets").first()
        if first is None:
            return self.spark.createDataFrame([], "key long, shard long, row long, n long")
        wanted = keys.select(F.coalesce(keys[key_column].cast("long"), F.lit(NO_KEY)).alias("key")).distinct()
        wanted = wanted.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(first[0])).cast("int"))
        wanted = wanted.join(self.index_files.select("bucket", "path"), "bucket")
        return wanted.groupBy("bucket").applyInPandas(_locate, "key long, shard long, row long, n long")

    def fetch(self, keys: DataFrame, key_column: str, ids: bool = False) -> DataFrame:
        """The stored documents of ``keys``: ``key, start, n_tokens, ids_crc32`` and, if asked for, ``ids``.

        ``start``: ids of all documents before it. Read from the shards only,
        shard by shard in the order of their places, with seeks over what was
        not asked for.
        """
        places = self.locate(keys, key_column).join(self.manifest.select("shard", "path", "base"), "shard")
        places = places.repartition("shard").sortWithinPartitions("shard", "row")
        schema = "key long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * ids
        found = places.select("path", "key", "row", "n", "base").mapInArrow(_fetcher(ids), schema)
        return found.withColumn("key", F.when(F.col("key") != NO_KEY, F.col("key")))


def _shard_writer(folder: str, tokenizer: str, end_id: int, shard_ids: int, shard_docs: int):
    def run(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        def make():
            encoder = FragmentEncoder(tokenizer, lambda ids: None, keep=400_000, join=b"".join)
            code = "H" if max([end_id, *encoder.token_bytes]) < 65536 else "I"
            encoder._pack = lambda ids: struct.pack(f"<{len(ids)}{code}", *ids)
            return encoder, np.dtype(f"<{code}")

        encoder, dtype = worker_store(f"store:{tokenizer}:{end_id}", make)
        part, end = TaskContext.get().partitionId(), np.array([end_id], dtype).tobytes()
        out, seq = None, 0

        def finish():
            stream, path, keys, starts = out
            stream.write(np.array(keys, "<i8").tobytes() + np.array(starts, "<i8").tobytes() + np.array([len(keys)], "<i8").tobytes())
            stream.close()
            row = {"part": part, "seq": seq, "path": path, "n_docs": len(keys), "n_ids": starts[-1], "first_key": keys[0], "last_key": keys[-1]}
            return pa.RecordBatch.from_pylist([row], pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("path", pa.string()), *[(c, pa.int64()) for c in ("n_docs", "n_ids", "first_key", "last_key")]]))

        for batch in batches:
            encoded = encoder.encode_packed(text.as_py() for text in batch.column(1))
            for key, packed in zip(batch.column(0).to_pylist(), encoded):
                if out is not None and (out[3][-1] >= shard_ids or len(out[2]) >= shard_docs):
                    yield finish()
                    out, seq = None, seq + 1
                if out is None:
                    path = f"{folder}/{part:06d}-{seq:06d}-{uuid.uuid4().hex}.ids"
                    out = (open_file(path, write=True), path, [], [0])
                    out[0].write(MAGIC + np.array([dtype.itemsize], "<i8").tobytes())
                data = packed + end
                out[0].write(data)
                out[2].append(key)
                out[3].append(out[3][-1] + len(data) // dtype.itemsize)
        if out is not None:
            yield finish()

    return run


def _table(stream):
    """Bytes per id, keys and first ids of a shard's documents."""
    import numpy as np

    if stream.read_at(8, 0) != MAGIC:
        raise ValueError("not a token shard")
    width, size = int.from_bytes(stream.read_at(8, 8), "little"), stream.size()
    n = int.from_bytes(stream.read_at(8, size - 8), "little")
    both = np.frombuffer(stream.read_at(8 * (2 * n + 1), size - 8 - 8 * (2 * n + 1)), "<i8")
    return width, both[:n], both[n:]


def _read_entries(batches):
    """For each run of equal keys of a shard: key, shard, first row, rows."""
    import numpy as np
    import pyarrow as pa

    for batch in batches:
        for shard, path in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            with open_file(path) as stream:
                keys = _table(stream)[1]
            first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
            counts = np.diff(np.r_[first, len(keys)])
            columns = [keys[first], np.full(len(first), shard), first, counts]
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], ["key", "shard", "row", "n"])


def _index_writer(folder: str):
    def build(frame):
        import numpy as np
        import pandas as pd

        keys = np.unique(frame.key.to_numpy())
        hashed = PerfectHash.build(keys.view(np.uint64))
        slot = hashed.slots(frame.key.to_numpy().view(np.uint64))
        order = np.lexsort((frame.row.to_numpy(), frame.shard.to_numpy(), slot))
        prints = np.zeros(len(keys), np.uint32)
        prints[hashed.slots(keys.view(np.uint64))] = fingerprints(keys.view(np.uint64))
        arrays = hashed.to_arrays() | {"prints": prints, "first": np.searchsorted(slot[order], np.arange(len(keys) + 1))}
        arrays |= {c: frame[c].to_numpy()[order] for c in ("shard", "row", "n")}
        bucket = int(frame.bucket.iloc[0])
        path = f"{folder}/{bucket:06d}-{uuid.uuid4().hex}.mph"
        data = io.BytesIO()
        np.savez(data, **arrays)
        with open_file(path, write=True) as stream:
            stream.write(data.getvalue())
        return pd.DataFrame({"bucket": pd.Series([bucket], dtype="int32"), "path": [path], "n_keys": [len(keys)]})

    return build


def _locate(frame):
    import numpy as np
    import pandas as pd

    with open_file(frame.path.iloc[0]) as stream:
        arrays = np.load(io.BytesIO(stream.read()))
        arrays = {k: arrays[k] for k in arrays.files}
    keys = frame.key.to_numpy()
    slot = PerfectHash.from_arrays(arrays).slots(keys.view(np.uint64))
    known = slot >= 0
    known[known] = arrays["prints"][slot[known]] == fingerprints(keys[known].view(np.uint64))
    keys, slot = keys[known], slot[known]
    first, last = arrays["first"][slot], arrays["first"][slot + 1]
    times = last - first
    at = np.repeat(first, times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    return pd.DataFrame({"key": np.repeat(keys, times), **{c: arrays[c][at] for c in ("shard", "row", "n")}})


def _fetcher(with_ids: bool):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        path = stream = None
        for batch in batches:
            out = []
            for where, key, row, n, base in zip(*[c.to_pylist() for c in batch.columns]):
                if where != path:
                    if stream is not None:
                        stream.close()
                    path, stream = where, open_file(where)
                    width, keys, starts = _table(stream)
                if keys[row] != key:  # a fingerprint met by chance
                    continue
                for i in range(row, row + n):
                    count = int(starts[i + 1] - starts[i])
                    ids = np.frombuffer(stream.read_at(count * width, 16 + int(starts[i]) * width), f"<u{width}")
                    found = (key, base + int(starts[i]), count, zlib.crc32(ids.astype("<u4").tobytes()))
                    out.append((*found, ids.astype(np.int32)) if with_ids else found)
            names = ["key", "start", "n_tokens", "ids_crc32"]
            arrays = [pa.array([r[i] for r in out], pa.int64()) for i in range(4)]
            if with_ids:
                names, arrays = [*names, "ids"], [*arrays, pa.array([r[4] for r in out], pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(arrays, names)
        if stream is not None:
            stream.close()

    return run

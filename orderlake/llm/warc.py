"""WARC archives with a globally ordered index.

Writing: each task writes archives (one gzip member per record) and, for each
archive, a run: its captures sorted by URL key and time. Runs are merged with a
loser tree, ``fan_in`` at a time, until so few are left that the last merge can
take them all; that one is divided by key ranges, a task each. Merges stream:
a task holds one batch of each run. Files count only if the manifest names them,
so a repeated task does no harm.

A payload that another page holds too is written once, with the largest page id;
the others become revisit records that refer to it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .files import open_file
from .shared import only, shared_folder, written

#: Rows of a batch in a run.
BATCH = 2048
#: Fixed value: the profile of revisits with equal payload.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = "url_key string, time string, page_id long, archive string, offset long, length long"
ORDER = ["url_key", "time", "page_id", "archive", "offset"]


class LoserTree:
    """Merges sorted iterators: each node keeps the loser of its match, the top the winner."""

    def __init__(self, sources):
        self._sources = [iter(s) for s in sources]
        self._heads = [next(s, None) for s in self._sources]
        k = self._k = max(1, len(self._sources))
        self._heads += [None] * (k - len(self._heads))
        self._losers = [-1] * k
        for i in range(k):
            self._replay(i)

    def _beats(self, a: int, b: int) -> bool:
        """Whether source ``a`` comes before ``b``; an ended one comes last."""
        x, y = self._heads[a], self._heads[b]
        return y is None or (x is not None and (x, a) < (y, b))

    def _replay(self, winner: int) -> None:
        node = (winner + self._k) // 2
        while node:
            other = self._losers[node]
            if other < 0:  # while the tree fills: wait here for an opponent
                self._losers[node] = winner
                return
            if self._beats(other, winner):
                self._losers[node], winner = winner, other
            node //= 2
        self._losers[0] = winner

    def __iter__(self):
        while (head := self._heads[winner := self._losers[0]]) is not None:
            yield head
            self._heads[winner] = next(self._sources[winner], None)
            self._replay(winner)


class Archive:
    """Archives and index in a folder: ``index`` is the ordered capture history (INDEX columns, ``part``)."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.index = spark.read.parquet(f"{folder}/index")

    @classmethod
    def write(
        cls, pages: DataFrame, folder: str, min_bytes: int = 1000, archive_bytes: int = 128 << 20, archive_rows: int = 50_000, fan_in: int = 32, parts: int | None = None
    ) -> Archive:
        """A record for each row of ``pages`` (page_id, url, html).

        A null html is an empty payload, a null url has the empty key. Of equal
        payloads of at least ``min_bytes`` the rows with the largest page id are
        responses, the others revisits; rows without page id are responses.
        Captures are dated by their page id, as pages have no time.
        """
        spark = pages.sparkSession
        rows = only(pages, "page_id", "url", "html").select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
        rows = rows.withColumn("digest", F.sha1(F.encode("html", "UTF-8")))
        sized = rows.filter(F.col("page_id").isNotNull() & (F.octet_length("html") >= min_bytes)).select("page_id", "digest")
        first = sized.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.min("page_id").alias("least")).filter("least <> refers_to")
        revisits = sized.distinct().join(first.select("digest", "refers_to"), "digest").filter("page_id <> refers_to")
        rows = rows.join(revisits, ["page_id", "digest"], "left").select("page_id", "url", "html", "digest", "refers_to")
        runs = rows.mapInArrow(_writer(folder, archive_bytes, archive_rows), "run string, first string, rows long")
        runs = written(runs, f"{folder}/runs")
        cls._merge(spark, runs, folder, fan_in, parts or int(spark.conf.get("spark.sql.shuffle.partitions")))
        return cls(spark, folder)

    @staticmethod
    def _merge(spark: SparkSession, runs: DataFrame, folder: str, fan_in: int, parts: int) -> None:
        level, live = 0, runs.select("run").distinct()
        while (n := live.count()) > fan_in:
            level += 1
            numbered = live.select("run", (F.row_number().over(Window.orderBy("run")) - 1).alias("i"))  # paths of runs only
            groups = numbered.groupBy(F.floor(F.col("i") / fan_in).alias("g")).agg(F.collect_list("run").alias("paths"))
            groups = groups.repartition(max(1, -(-n // fan_in)), "g").select("paths")
            live = written(groups.mapInArrow(_merger(f"{folder}/merged-{level}"), "run string"), f"{folder}/level-{level}")
        paths = [r.run for r in live.orderBy("run").collect()]  # fan_in at most
        # the first key of each batch: ranges of about equal rows
        keys = runs.select("first", F.ntile(parts).over(Window.orderBy("first")).alias("t"))
        cuts = [r.cut for r in keys.groupBy("t").agg(F.min("first").alias("cut")).filter("t > 1").select("cut").distinct().orderBy("cut").collect()]
        ranges = list(zip([None, *cuts], [*cuts, None]))
        rows = spark.createDataFrame([(i, low, high) for i, (low, high) in enumerate(ranges)], "part int, low string, high string")
        rows = rows.repartition(len(ranges), "part")
        written(rows.mapInArrow(_range_merger(paths), f"part int, {INDEX}"), f"{folder}/index")

    def records(self) -> DataFrame:
        """Every capture of the index, read from its archive: ``page_id, url, record_type, payload, payload_bytes, payload_digest, refers_to``; revisits have no payload."""
        return self._read(True)

    def digests(self) -> DataFrame:
        """As ``records``, without url and payload."""
        return self._read(False)

    def _read(self, whole: bool) -> DataFrame:
        places = self.index.select("archive", "offset", "length").repartition("archive").sortWithinPartitions("archive", "offset")
        schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
        return places.mapInArrow(_reader(whole), schema + ", url string, payload binary" * whole)


def url_key(url: str | None) -> str:
    """Host turned round, path and query in lower case; scheme, user, ``www.``, port 80 or 443 and fragment left out."""
    text = (url or "").partition("#")[0]
    text = text.partition("://")[2] if "://" in text else text
    cut = min([i for i in (text.find("/"), text.find("?")) if i >= 0], default=len(text))
    host, rest = text[:cut].rpartition("@")[2].lower(), text[cut:].lower()
    name, _, port = host.partition(":")
    name = ",".join(reversed(name.removeprefix("www.").split("."))) if name else ""
    return name + (f":{port}" if port not in ("", "80", "443") else "") + ")" + (rest or "/")


def _date(page_id: int | None) -> str:
    from datetime import datetime, timedelta

    return (datetime(2000, 1, 1) + timedelta(seconds=(page_id or 0) % 2**31)).strftime("%Y-%m-%dT%H:%M:%SZ")


def _record(page_id, url, html: str, digest: str, refers_to) -> bytes:
    payload = html.encode("utf-8")
    name = lambda i: f"<urn:page:{i}>"
    safe = "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url or "")
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}"]
    lines += [f"WARC-Record-ID: {f'<urn:uuid:{uuid.uuid4()}>' if page_id is None else name(page_id)}", f"WARC-Date: {_date(page_id)}"]
    lines += [f"WARC-Target-URI: {safe}"] * (url is not None)
    lines += [f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {len(payload)}"]
    if refers_to is not None:
        lines += [f"WARC-Refers-To: {name(refers_to)}", f"WARC-Profile: {PROFILE}"]
    body = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body += payload if refers_to is None else b""
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}", "", ""]
    return "\r\n".join(lines).encode("utf-8") + body + b"\r\n\r\n"


def _parsed(data: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    return fields, rest[: int(fields["Content-Length"])].partition(b"\r\n\r\n")[2]


def _table(rows):
    import pyarrow as pa

    kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
    names = ["url_key", "time", "page_id", "archive", "offset", "length"]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names)


def _write_run(rows, path: str):
    """Write sorted captures; yields the first key and the number of rows of each batch."""
    import itertools

    import pyarrow as pa

    rows = iter(rows)
    with open_file(path, write=True) as stream, pa.ipc.new_file(stream, _table([]).schema) as out:
        while batch := list(itertools.islice(rows, BATCH)):
            out.write_batch(_table(batch))
            yield batch[0][0], len(batch)


def _sort_key(row):
    """Null page ids first."""
    return (row[0], row[1], row[2] is not None, row[2] or 0, row[3], row[4], row[5])


def _row(key):
    return (key[0], key[1], key[3] if key[2] else None, key[4], key[5], key[6])


def _run_rows(path: str, low: str | None = None, high: str | None = None):
    """Sort keys of a run's captures with ``low <= url key < high``, a batch at a time."""
    import pyarrow as pa

    with open_file(path) as stream:
        reader = pa.ipc.open_file(stream)
        first, last = 0, reader.num_record_batches
        while low is not None and last - first > 1:  # the last batch that begins below low
            middle = (first + last) // 2
            if reader.get_batch(middle).column(0)[0].as_py() < low:
                first = middle
            else:
                last = middle
        for i in range(first, reader.num_record_batches):
            for row in zip(*[c.to_pylist() for c in reader.get_batch(i).columns]):
                if high is not None and row[0] >= high:
                    return
                if low is None or row[0] >= low:
                    yield _sort_key(row)


def _writer(folder: str, archive_bytes: int, archive_rows: int):
    def run(batches):
        import zlib

        import pyarrow as pa
        from pyspark import TaskContext

        part, stream, rows = TaskContext.get().partitionId(), None, []

        def finish():
            stream.close()
            path = f"{folder}/first/{part:06d}-{uuid.uuid4().hex}.run"
            found = list(_write_run(map(_row, sorted(map(_sort_key, rows))), path))
            return pa.RecordBatch.from_pylist([{"run": path, "first": k, "rows": n} for k, n in found], pa.schema([("run", pa.string()), ("first", pa.string()), ("rows", pa.int64())]))

        for batch in batches:
            for page_id, url, html, digest, refers_to in zip(*[batch.column(i) for i in range(5)]):
                if stream is not None and (offset >= archive_bytes or len(rows) >= archive_rows):
                    yield finish()
                    stream, rows = None, []
                if stream is None:
                    archive, offset = f"{folder}/archives/{part:06d}-{uuid.uuid4().hex}.warc.gz", 0
                    stream = open_file(archive, write=True)
                page_id, url = page_id.as_py(), url.as_py()
                packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                data = packer.compress(_record(page_id, url, html.as_py(), digest.as_py(), refers_to.as_py())) + packer.flush()
                stream.write(data)
                time = "".join(c for c in _date(page_id) if c.isdigit())
                rows.append((url_key(url), time, page_id, archive, offset, len(data)))
                offset += len(data)
        if stream is not None:
            yield finish()

    return run


def _merger(folder: str):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for paths in batch.column(0).to_pylist():
                path = f"{folder}/{uuid.uuid4().hex}.run"
                for _ in _write_run(map(_row, LoserTree([_run_rows(p) for p in paths])), path):
                    pass
                yield pa.RecordBatch.from_arrays([pa.array([path])], ["run"])

    return run


def _range_merger(paths: list[str]):
    def run(batches):
        import itertools

        import pyarrow as pa

        for batch in batches:
            for part, low, high in zip(*[c.to_pylist() for c in batch.columns]):
                merged = map(_row, LoserTree([_run_rows(p, low, high) for p in paths]))
                while rows := list(itertools.islice(merged, BATCH)):
                    table = _table(rows)
                    yield pa.RecordBatch.from_arrays([pa.array([part] * len(rows), pa.int32()), *table.columns], ["part", *table.schema.names])

    return run


def _reader(whole: bool):
    def run(batches):
        import hashlib
        import zlib

        import pyarrow as pa

        path = stream = None
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "payload"][: 7 if whole else 5]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
        number = lambda s: int(s[len("<urn:page:") : -1]) if s and s.startswith("<urn:page:") else None
        for batch in batches:
            out = []
            for archive, offset, length in zip(*[c.to_pylist() for c in batch.columns]):
                if archive != path:
                    if stream is not None:
                        stream.close()
                    path, stream = archive, open_file(archive)
                fields, payload = _parsed(zlib.decompress(stream.read_at(length, offset), 31))
                kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
                size = int(fields["X-Payload-Length"])
                if kind == "response":
                    if (hashlib.sha1(payload).hexdigest(), len(payload)) != (digest, size):
                        raise ValueError(f"the payload of {fields['WARC-Record-ID']} in {archive} is damaged")
                else:
                    payload = None
                out.append((number(fields["WARC-Record-ID"]), size, digest, kind, number(fields.get("WARC-Refers-To")), fields.get("WARC-Target-URI"), payload))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], kinds[i]) for i in range(len(names))], names)
        if stream is not None:
            stream.close()

    return run

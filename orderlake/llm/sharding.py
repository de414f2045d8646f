"""Shards of near equal bytes by histogram sort, in DataFrame functions only.

Rows are ordered by a key of 48 hexadecimal digits: hash of the text, id, number
of the row. Equal texts lie side by side, and yet any group, however large, can
be cut. Each round counts the exact bytes and rows in the cells between probes
(two more digits within every cell that still holds a wanted boundary), until
each splitter is within tolerance of its share or no finer cut exists. Then the
rows are exchanged once.
"""

from __future__ import annotations

import json
import os.path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import shared_folder, written

#: Above every key of hexadecimal digits.
_END = "G"


def _digits(value: Column) -> Column:
    return F.lpad(F.hex(value), 16, "0")


def _after(prefix: str) -> str:
    """The least boundary above all keys that begin with ``prefix``."""
    up = f"{int(prefix, 16) + 1:0{len(prefix)}X}" if prefix else _END
    return up if len(up) == len(prefix) else _END


def find_splitters(rows: DataFrame, parts: int, tolerance: float, key: str = "key", size: str = "size") -> list[tuple[str, int, int]]:
    """``parts - 1`` boundaries (least key of the next part, bytes below, rows below).

    ``rows`` should be a written table: each round reads it once. The driver
    gets at most 256 counts per open boundary and round.
    """
    k = F.col(key)
    total = rows.agg(F.sum(size), F.count("*")).first()
    total_bytes, total_rows = total[0] or 0, total[1]
    within = tolerance * total_bytes / parts
    targets = [total_bytes * (i + 1) / parts for i in range(parts - 1)]
    found: dict[int, tuple[str, int, int]] = {}
    # cell -> (digits all its keys share, bytes below, rows below, boundaries wanted in it)
    open_: dict[str, tuple[str, int, int, list[int]]] = {"": ("", 0, 0, [*range(parts - 1)])}
    while open_:
        shapes: dict[tuple[int, int], list[str]] = {}
        for cell, (shared, *_) in open_.items():
            shapes.setdefault((len(cell), len(shared)), []).append(cell)
        child = F.coalesce(*[F.when(F.substring(k, 1, n).isin(cells), F.substring(k, 1, m + 2)) if n else F.substring(k, 1, m + 2) for (n, m), cells in shapes.items()])
        counted = rows.withColumn("cell", child).filter(F.col("cell").isNotNull()).groupBy("cell").agg(
            F.sum(size).alias("bytes"), F.count("*").alias("rows"), F.min(key).alias("least"), F.max(key).alias("most")
        )
        children = sorted(counted.collect(), key=lambda r: r.cell)
        deeper = {}
        for shared, bytes_below, rows_below, wanted in open_.values():
            inside = [r for r in children if r.cell.startswith(shared)]
            for r in inside:
                here = [i for i in wanted if bytes_below <= targets[i] < bytes_below + r.bytes]
                going = []
                for i in here:
                    low, high = targets[i] - bytes_below, bytes_below + r.bytes - targets[i]
                    if min(low, high) > within and r.rows > 1 and r.least != r.most:
                        going.append(i)
                    elif low <= high:
                        found[i] = (r.cell, bytes_below, rows_below)
                    else:
                        found[i] = (_after(r.cell), bytes_below + r.bytes, rows_below + r.rows)
                if going:
                    deeper[r.cell] = (os.path.commonprefix([r.least, r.most]), bytes_below, rows_below, going)
                bytes_below, rows_below = bytes_below + r.bytes, rows_below + r.rows
        open_ = deeper
    return [found.get(i, (_END, total_bytes, total_rows)) for i in range(parts - 1)]


def range_shards(
    df: DataFrame,
    shards: int = 40,
    tolerance: float = 0.001,
    part_bytes: int = 4 << 30,
    id_column: str = "doc_id",
    text_column: str = "text",
    carry: dict[str, Column] | None = None,
) -> DataFrame:
    """Every row with its shard and its slot there: ``size, shard, slot`` beside the id and ``carry``.

    Size: bytes of the text in UTF-8 (null: none) plus 16. Shards differ by at
    most the tolerance (a part of the mean) or one row. Slots run from 0 without
    gaps, in the order of the key. Large shards are sorted in parts of about
    ``part_bytes`` of text, so that no task gets a whole shard. Null ids and
    texts are ordinary values; repeated rows are told apart by their number; an
    empty table gives no rows.
    """
    text, folder = F.coalesce(df[text_column], F.lit("")), shared_folder(df.sparkSession, "shards")
    row_id = F.coalesce(df[id_column].cast("long"), F.lit(-(2**63)))
    key = F.concat(_digits(F.xxhash64(text)), _digits(row_id.bitwiseXOR(F.lit(-(2**63)))), _digits(F.monotonically_increasing_id()))
    size = (F.octet_length(text) + F.lit(16)).cast("long")
    carried = [value.alias(name) for name, value in (carry or {}).items()]
    # written once: the numbers of the rows must be the same in each round
    rows = written(df.select(key.alias("key"), size.alias("size"), F.struct(df[id_column], *carried).alias("kept")), f"{folder}/keys")
    total = rows.agg(F.sum("size")).first()[0] or 0
    each = max(1, -(-total // (shards * part_bytes)))
    splitters = find_splitters(rows, shards * each, tolerance)
    rows = rows.withColumn("part", _part_of(F.col("key"), [s[0] for s in splitters]))
    below = [0, *[s[2] for s in splitters]]
    offsets = F.from_json(F.lit(json.dumps([b - below[i - i % each] for i, b in enumerate(below)])), "array<bigint>")
    number = F.row_number().over(Window.partitionBy("part").orderBy("key"))
    slot = number - 1 + F.element_at(offsets, F.col("part") + 1)
    shard = F.floor(F.col("part") / each).cast("int")
    return rows.select("kept.*", "size", shard.alias("shard"), slot.cast("long").alias("slot"))


def _part_of(key: Column, boundaries: list[str]) -> Column:
    """How many of the sorted ``boundaries`` are at or below ``key``: those before its first two digits are counted beforehand."""
    heads, before = [f"{i:02X}" for i in range(256)], 0
    table = []
    for head in heads:
        inner = [b for b in boundaries if b[:2] == head]
        table.append({"before": before, "inner": inner})
        before += len(inner)
    table = F.from_json(F.lit(json.dumps(table)), "array<struct<before:int,inner:array<string>>>")
    row = F.element_at(table, F.conv(F.substring(key, 1, 2), 16, 10).cast("int") + 1)
    return row["before"] + F.size(F.filter(row["inner"], lambda b: b <= key))

"""Near copies by an inverted join over signature coordinates.

1. Each document's set of word shingles becomes a MinHash signature. Documents
   with the same set are one class; from here on a class has one row.
2. Classes are posted under each pair (coordinate, value). Two sets as similar
   as asked for agree on at least ``match`` coordinates (all but some in a
   million do), so they meet within the ``coordinates - match + 1`` rarest
   postings of each: only this prefix is kept, and a value that nobody else has
   is never posted. Documents of mostly own text drop out here.
   Of the rest only documents stay that agree with some member of their lists on
   ``match`` coordinates or more, counted on the low bytes of the signatures
   (which can only add to the count): in long lists with two members first, then
   in blocks for the documents that have met nobody so far.
3. Rounds: in each list every member meets the list's leader only (each round
   another one). Collisions are counted on the signatures, pairs at or above
   ``match`` are confirmed on the full sets, links give components. Lists whose
   members are all in one component are skipped from then on, as no pair in
   them can change the result. So a group of thousands of near copies costs a
   few rows per member and not all its pairs.
4. At last all pairs across components that still share a list are counted, in
   blocks of bounded size and each in the first list that the two share. Of each
   block only the documents with a pair at or above ``match`` get their full
   sets, where the pairs are confirmed. No pair is left out, and none becomes a
   row of a table unless it is a link.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .components import components
from .shared import only, shared_folder, written

CELL = ["token", "low", "high"]
#: Stands for a null id.
NO_ID = -(2**63)
ROW_KEY = ["_id", "_h1", "_h2"]


def near_copies(
    docs: DataFrame,
    words: int = 5,
    percent: int = 80,
    coordinates: int = 64,
    match: int = 36,
    rounds: int = 2,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``id, n_shingles, component_id, kept`` for every row.

    Words are runs of other than ASCII white space, A-Z in lower case; a text
    with fewer than ``words`` words has its whole sequence as one shingle, one
    without words (or null) has none and is linked with nothing. Two sets are
    linked if 100 * intersection >= ``percent`` * union. ``component_id`` is the
    smallest id reachable, ``kept`` whether it is the row's own. A null id is
    the least id of all and comes back as null. Repeated rows are copies of each
    other; rows with one id (or none) and different texts are linked by their
    texts only.
    """
    rows = near_rows(docs, words, percent, coordinates, match, rounds, id_column, text_column)
    component, null = F.coalesce("least.id", "id"), F.lit(NO_ID)
    return rows.select(
        F.when(F.col("id") != null, F.col("id")).alias(id_column),
        F.col("n").alias("n_shingles"),
        F.when(component != null, component).alias("component_id"),
        (F.col("id") == component).alias("kept"),
    )


def with_row_key(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` with the key of each row: ``_id`` (a null one as ``NO_ID``) and two hashes of the text, ``_h1, _h2``."""
    text = docs[text_column]
    key = [F.coalesce(docs[id_column].cast("long"), F.lit(NO_ID)), F.xxhash64(text), F.xxhash64(F.lit(7), text)]
    return docs.select("*", *[k.alias(name) for k, name in zip(key, ROW_KEY)])


def near_rows(
    docs: DataFrame,
    words: int = 5,
    percent: int = 80,
    coordinates: int = 64,
    match: int = 36,
    rounds: int = 2,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``id, h1, h2, n, least`` for every row: its key, the size of its set and the least key (id, h1, h2) reachable, null without words."""
    if not match <= coordinates <= 64:
        raise ValueError("match <= coordinates <= 64")
    spark, folder = docs.sparkSession, shared_folder(docs.sparkSession, "near")
    texts = with_row_key(only(docs, id_column, text_column).toDF("id", "text"), "id", "text").select(*[F.col(k).alias(k[1:]) for k in ROW_KEY], "text")
    signed = written(texts.mapInArrow(_sign(words, coordinates), "id long, h1 long, h2 long, n long, s1 long, s2 long, signature binary"), f"{folder}/signed")
    keys, row = ["n", "s1", "s2"], ["id", "h1", "h2"]
    # equal sets have equal signatures; the number of a class is nobody's id
    classes = signed.filter("n > 0").groupBy(*keys).agg(F.min(F.struct(*row)).alias("rep"), F.first("signature").alias("signature"))
    classes = written(classes.withColumn("node", F.monotonically_increasing_id()), f"{folder}/classes")
    reps = classes.select(F.col("node").alias("id"), "n", "signature")
    chosen = classes.select("node", "rep.*")

    links = _links(spark, texts, chosen, reps, folder, words, percent, coordinates, match, rounds)
    joined = components(links, f"{folder}/components")
    linked = classes.select("node", "rep").join(joined, "node")
    tops = written(linked.groupBy("component").agg(F.min("rep").alias("top")), f"{folder}/tops")
    linked = written(joined.join(tops, "component").select("node", "top"), f"{folder}/linked")
    named = classes.select("node", *keys, "rep").join(linked, "node", "left").select(*keys, F.coalesce("top", "rep").alias("least"))
    named = written(named, f"{folder}/named")
    return signed.select(*row, *keys).join(named, keys, "left").select(*row, "n", "least")


def _links(spark: SparkSession, texts: DataFrame, chosen: DataFrame, reps: DataFrame, folder: str, words: int, percent: int, coordinates: int, match: int, rounds: int) -> DataFrame:
    """Links ``a, b`` between classes that connect every pair of linked classes.

    ``id`` is the number of a class here; ``chosen`` (node, id, h1, h2) names one row of each.
    """
    tokens = reps.select("id", "n", "signature").mapInArrow(_tokens(coordinates), "id long, n long, token long")
    often = tokens.groupBy("token").agg(F.count("*").alias("times")).filter("times > 1")
    shared = tokens.join(often, "token").groupBy("id", "n").agg(F.sort_array(F.collect_list(F.struct("times", "token"))).alias("found"))
    prefix = coordinates - match + 1
    # own values are the rarest and come first in the prefix, though they are posted nowhere
    room = F.lit(prefix - coordinates) + F.size("found")
    posted = shared.filter(room > 0).select("id", "n", F.explode(F.slice("found", F.lit(1), room)).alias("f"))
    posted = posted.select("id", "n", F.col("f.token").alias("token"))
    lists = posted.groupBy("token").agg(F.count("*").alias("times")).filter("times > 1").select("token")
    posted = written(posted.join(lists, "token"), f"{folder}/posted")

    members = written(_plausible(posted, reps, folder, percent, match), f"{folder}/members")
    # members grow with the input: never broadcast
    posted = written(posted.join(members.hint("merge"), "id", "left_semi"), f"{folder}/plausible")
    chosen = chosen.join(members.hint("merge"), chosen.node == members.id, "left_semi")
    # rows with one key have one text
    sets = texts.join(chosen.hint("merge"), ["id", "h1", "h2"]).dropDuplicates(["id", "h1", "h2"]).select(F.col("node").alias("id"), "text")
    sets = written(sets.mapInArrow(_sets(words), "id long, shingles binary").join(reps, "id"), f"{folder}/confirm")

    links = None
    labels = posted.select(F.col("id").alias("node"), F.col("id").alias("component")).limit(0)
    for turn in range(rounds + 1):
        current = posted.join(labels, F.col("id") == F.col("node"), "left").select("token", "id", "n", F.coalesce("component", "id").alias("c"))
        # each round orders the members anew
        lead = F.min(F.struct(F.xxhash64(F.lit(turn), "id"), F.col("id"), F.col("n"), F.col("c")))
        spread = current.groupBy("token").agg(F.min("c").alias("c_min"), F.max("c").alias("c_max"), F.count("*").alias("members"), lead.alias("lead"))
        spread = spread.filter("c_min <> c_max")
        if turn == rounds:
            open_ = current.join(spread.select("token", "members"), "token")
            return links.unionByName(_open_links(spark, open_, posted, f"{folder}/confirm", sets.schema, folder, percent, match))
        led = spread.select("token", F.col("lead.id").alias("x"), F.col("lead.n").alias("xn"), F.col("lead.c").alias("xc"))
        pairs = current.join(led, "token").filter("c <> xc").filter(100 * F.least("n", "xn") >= percent * F.greatest("n", "xn"))
        pairs = pairs.select(F.least("id", "x").alias("a"), F.greatest("id", "x").alias("b")).distinct()
        confirmed = written(_confirmed(pairs, spark, f"{folder}/confirm", sets.schema, percent, match), f"{folder}/links-{turn}")
        links = confirmed if links is None else links.unionByName(confirmed)
        labels = components(links, f"{folder}/components-{turn}")


def _cells(rows: DataFrame, block: int = 512) -> DataFrame:
    """Rows (token, members, id, ...) with ``own, low, high``: each block of a list meets each block of it once."""
    blocks = F.ceil(F.col("members") / block).cast("int")
    rows = rows.withColumn("own", F.pmod(F.xxhash64(F.lit("block"), "id"), blocks).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    return rows.withColumn("low", F.least("own", "other")).withColumn("high", F.greatest("own", "other"))


def _plausible(posted: DataFrame, reps: DataFrame, folder: str, percent: int, match: int, block: int = 512) -> DataFrame:
    """``id`` of the posted documents with enough collisions with another member of a list.

    In a list longer than ``block`` all members first meet two of them. Those that
    have met nobody then are asked against all members, in blocks.
    """
    bytes_ = reps.select("id", "signature").mapInArrow(_low_bytes, "id long, low_bytes binary")
    lists = written(posted.groupBy("token").agg(F.count("*").alias("members")), f"{folder}/lists")
    long_ = posted.join(lists.filter(F.col("members") > block), "token")
    order = F.struct(F.xxhash64(F.lit("lead"), "id"), F.col("id"), F.col("n"))
    leads = long_.groupBy("token").agg(F.min(order).alias("x"), F.max(order).alias("y"))
    leads = leads.select("token", F.explode(F.array("x", "y")).alias("lead")).select("token", F.col("lead.id").alias("lead"), F.col("lead.n").alias("lead_n"))
    leads = written(leads.join(bytes_.toDF("lead", "lead_bytes"), "lead"), f"{folder}/leads")
    pairs = long_.join(leads, "token").filter("id <> lead").join(bytes_, "id").select("id", "n", "low_bytes", "lead", "lead_n", "lead_bytes")
    met = written(pairs.mapInArrow(_led(percent, match), "id long").distinct(), f"{folder}/led")

    marked = posted.join(met.withColumn("met", F.lit(True)).hint("merge"), "id", "left").withColumn("met", F.coalesce("met", F.lit(False)))
    unmet = marked.filter(~F.col("met")).groupBy("token").agg(F.count("*").alias("unmet"))
    open_ = written(lists.join(unmet, "token"), f"{folder}/unmet")
    rows = _asking(marked.join(open_, "token"), block).join(bytes_, "id").select(*CELL, "role", "id", "n", "met", "low_bytes")
    rows = rows.repartition(*CELL).sortWithinPartitions(*CELL)
    return met.unionByName(rows.mapInArrow(_by_cell(_crowded(percent, match)), "id long")).distinct()


def _asking(rows: DataFrame, block: int) -> DataFrame:
    """Rows (token, members, unmet, id, met, ...) with ``low, high, role``: each unmet member of a list meets each member of it.

    A short list is one cell. In a longer one each block of unmet members (role 1)
    has a cell with each block of all members (role 2).
    """
    at = lambda n: F.pmod(F.xxhash64(F.lit("block"), "id"), n).cast("int")
    own = lambda low, high, role: F.struct(low.alias("low"), high.alias("high"), F.lit(role).alias("role"))
    askers, all_ = (F.ceil(F.col(c) / block).cast("int") for c in ("unmet", "members"))
    answers = F.transform(F.sequence(F.lit(0), askers - 1), lambda i: own(i, at(all_), 2))
    asks = F.transform(F.sequence(F.lit(0), all_ - 1), lambda i: own(at(askers), i, 1))
    cells = F.when(F.col("members") <= block, F.array(own(F.lit(0), F.lit(0), 0))).otherwise(F.when(F.col("met"), answers).otherwise(F.concat(answers, asks)))
    return rows.select("*", F.explode(cells).alias("cell")).select("*", "cell.*").drop("cell")


def _open_links(spark: SparkSession, open_: DataFrame, posted: DataFrame, path: str, schema, folder: str, percent: int, match: int) -> DataFrame:
    """Links across components among the members (token, id, n, c, members) of open lists."""
    lists = F.expr("bit_or(shiftleft(1L, cast(shiftright(token, 32) as int)))")
    masks = posted.groupBy("id").agg(lists.alias("mask"))
    signatures = spark.read.schema(schema).parquet(path).select("id", "signature")
    rows = _cells(open_.join(masks, "id").join(signatures, "id"))
    rows = rows.select(*CELL, "own", "id", "n", "c", "mask", "signature")
    rows = rows.repartition(*CELL).sortWithinPartitions(*CELL)
    wanted = rows.mapInArrow(_by_cell(_meet(percent, match)), "token long, low int, high int, id long, c long, partners array<long>")
    wanted = written(wanted, f"{folder}/wanted")
    shingles = spark.read.schema(schema).parquet(path).select("id", "shingles")
    rows = wanted.join(shingles, "id").select(*CELL, "id", "c", "partners", "shingles").repartition(*CELL).sortWithinPartitions(*CELL)
    return written(rows.mapInArrow(_by_cell(_join(percent)), "a long, b long"), f"{folder}/links-open")


def _confirmed(pairs: DataFrame, spark: SparkSession, path: str, schema, percent: int, match: int) -> DataFrame:
    """Pairs that agree on ``match`` coordinates and are similar on their full sets."""

    def side(name: str, *columns: str) -> DataFrame:
        rows = spark.read.schema(schema).parquet(path)
        return rows.select(F.col("id").alias(name), *[F.col(c).alias(f"{name}_{c}") for c in columns])

    both = pairs.join(side("a", "signature"), "a").join(side("b", "signature"), "b")
    both = both.mapInArrow(_colliding(match), "a long, b long")
    both = both.join(side("a", "shingles"), "a").join(side("b", "shingles"), "b")
    return both.select("a", "b", "a_shingles", "b_shingles").mapInArrow(_similar(percent), "a long, b long")


def _by_cell(function):
    """Applies ``function`` to the rows of each cell (first three columns) of sorted batches."""

    def run(batches):
        import pyarrow as pa

        waiting = []
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = list(zip(*[batch.column(i).to_pylist() for i in range(3)]))
            starts = [0, *[i for i in range(1, len(keys)) if keys[i] != keys[i - 1]], len(keys)]
            for first, last in zip(starts, starts[1:]):
                if waiting and waiting[0][0] != keys[first]:
                    yield from function(pa.Table.from_batches([w[1] for w in waiting]))
                    waiting = []
                waiting.append((keys[first], batch.slice(first, last - first)))
        if waiting:
            yield from function(pa.Table.from_batches([w[1] for w in waiting]))

    return run


def _low_bytes(batches):
    """The lowest byte of each value of a signature."""
    import numpy as np
    import pyarrow as pa

    for batch in batches:
        low = [np.frombuffer(s.as_py(), "<u4").astype(np.uint8).tobytes() for s in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(low, pa.binary())], ["id", "low_bytes"])


def _led(percent: int, match: int):
    """The ids on both sides of the rows that agree on ``match`` bytes or more."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            if batch.num_rows:
                own, lead = [np.stack([np.frombuffer(x.as_py(), np.uint8) for x in batch.column(i)]) for i in (2, 5)]
                n, lead_n = (batch.column(i).to_numpy() for i in (1, 4))
                keep = ((own == lead).sum(1) >= match) & (100 * np.minimum(n, lead_n) >= percent * np.maximum(n, lead_n))
                ids = np.unique(np.concatenate([batch.column(i).to_numpy()[keep] for i in (0, 3)]))
                yield pa.RecordBatch.from_arrays([pa.array(ids)], ["id"])

    return run


def _crowded(percent: int, match: int):
    """The documents of a cell that agree with another one on ``match`` bytes or more and had met nobody."""

    def cell(table):
        import numpy as np
        import pyarrow as pa

        role, ids, n = (table.column(i).to_numpy() for i in (3, 4, 5))
        given = table.column(6).to_numpy()
        if role.any():
            given = given | (role == 2)  # these are asked about themselves elsewhere
        if given.all():
            return
        values = np.stack([np.frombuffer(s.as_py(), np.uint8) for s in table.column(7)])
        met = given.copy()
        for i in np.flatnonzero(role == 1) if role.any() else range(len(ids) - 1):
            rest = np.flatnonzero((role == 2) & (ids != ids[i])) if role[i] else np.arange(i + 1, len(ids))
            if met[i]:  # only those that have met nobody yet still have to be asked
                rest = rest[~met[rest]]
            rest = rest[100 * np.minimum(n[rest], n[i]) >= percent * np.maximum(n[rest], n[i])]
            found = rest[(values[rest] == values[i]).sum(1) >= match]
            if len(found):
                met[found] = met[i] = True
        if (met & ~given).any():
            yield pa.RecordBatch.from_arrays([pa.array(ids[met & ~given])], ["id"])

    return cell


def _meet(percent: int, match: int):
    """The documents of a cell with partners at or above ``match`` in other components."""

    def cell(table):
        import numpy as np
        import pyarrow as pa

        token, low, high = (table.column(i)[0].as_py() for i in range(3))
        own, ids, n, c = (table.column(i).to_numpy() for i in range(3, 7))
        masks = table.column(7).to_numpy().view(np.uint64)
        signatures = np.stack([np.frombuffer(s.as_py(), "<u4") for s in table.column(8)])
        here, partners, met = np.uint64(1) << np.uint64(token >> 32), {}, set()
        for i in range(len(ids) - 1):
            rest = slice(i + 1, None)
            able = (c[rest] != c[i]) & (100 * np.minimum(n[rest], n[i]) >= percent * np.maximum(n[rest], n[i]))
            if low != high:
                able &= own[rest] != own[i]
            at = np.flatnonzero(able) + i + 1
            if not len(at):
                continue
            equal = signatures[at] == signatures[i]
            enough = equal.sum(1) >= match
            at, equal = at[enough], equal[enough]
            if len(at):
                packed = np.zeros((len(at), 8), np.uint8)
                bits = np.packbits(equal, axis=1, bitorder="little")
                packed[:, : bits.shape[1]] = bits
                both = packed.view("<u8")[:, 0] & masks[at] & masks[i]
                at = at[(both & (~both + np.uint64(1))) == here]  # this is the first list that they share
            if len(at):
                partners[i] = ids[at].tolist()
                met |= {i, *at.tolist()}
        rows = sorted(met)
        if rows:
            columns = [pa.array([v] * len(rows), kind) for v, kind in ((token, pa.int64()), (low, pa.int32()), (high, pa.int32()))]
            columns += [pa.array(ids[rows]), pa.array(c[rows]), pa.array([partners.get(i, []) for i in rows], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["token", "low", "high", "id", "c", "partners"])

    return cell


def _join(percent: int):
    """Links of a cell; a pair whose components have been linked here already is skipped, as it changes nothing."""

    def cell(table):
        import numpy as np
        import pyarrow as pa

        ids, c = table.column(3).to_pylist(), table.column(4).to_pylist()
        sets = dict(zip(ids, [np.frombuffer(s.as_py(), "<u8") for s in table.column(6)]))
        of, top = dict(zip(ids, c)), {x: x for x in c}

        def root(x):
            while top[x] != x:
                top[x] = top[top[x]]
                x = top[x]
            return x

        links = []
        for a, partners in zip(ids, table.column(5).to_pylist()):
            for b in partners:
                x, y = root(of[a]), root(of[b])
                if x != y and _alike(sets[a], sets[b], percent):
                    top[x] = y
                    links.append((a, b))
        if links:
            yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in links], pa.int64()) for i in (0, 1)], ["a", "b"])

    return cell


def _alike(a, b, percent: int) -> bool:
    import numpy as np

    both = np.sort(np.concatenate([a, b]))
    met = int((both[1:] == both[:-1]).sum())
    return 100 * met >= percent * (len(both) - met)


def _shingles(text: str, words: int):
    """Distinct 64-bit hashes of the text's shingles, sorted."""
    import numpy as np
    from xxhash import xxh3_64_intdigest

    # bytes are split and lowered by ASCII's rules
    parts = text.encode("utf-8").lower().split()
    if not parts:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxh3_64_intdigest, parts), np.uint64, len(parts))
    width = min(words, len(parts))
    n = len(parts) - width + 1
    mixed = np.full(n, width, np.uint64)
    for i in range(width):
        mixed = (mixed ^ h[i : i + n]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def _sign(words: int, coordinates: int):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        draw = np.random.default_rng(20240)
        factors = draw.integers(0, 2**63, coordinates, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        adds = draw.integers(0, 2**63, coordinates, dtype=np.uint64)
        for batch in batches:
            rows = []
            for text in batch.column(3):
                found = _shingles(text.as_py() or "", words)
                least = np.full(coordinates, np.uint64(2**64 - 1))
                for i in range(0, len(found), 4096):  # very long texts in pieces
                    x = found[i : i + 4096, None] * factors + adds
                    x ^= x >> np.uint64(32)
                    least = np.minimum(least, (x * np.uint64(0xD6E8FEB86659FD93)).min(0))
                mixed = (found ^ (found >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
                sums = [int(s.sum(dtype=np.uint64).astype(np.int64)) if len(s) else 0 for s in (found, mixed ^ (mixed >> np.uint64(27)))]
                rows.append((len(found), *sums, (least >> np.uint64(32)).astype("<u4").tobytes()))
            columns = [pa.array([r[i] for r in rows], pa.int64() if i < 3 else pa.binary()) for i in range(4)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *columns], ["id", "h1", "h2", "n", "s1", "s2", "signature"])

    return run


def _sets(words: int):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            sets = [_shingles(text.as_py() or "", words).astype("<u8").tobytes() for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], ["id", "shingles"])

    return run


def _tokens(coordinates: int):
    """One row for each pair (coordinate, value) of a signature, as an integer."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        high = np.arange(coordinates, dtype=np.int64) << 32
        for batch in batches:
            if batch.num_rows:
                values = np.stack([np.frombuffer(s.as_py(), "<u4") for s in batch.column(2)]).astype(np.int64) | high
                ids, n = (np.repeat(batch.column(i).to_numpy(), coordinates) for i in (0, 1))
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(n), pa.array(values.ravel())], ["id", "n", "token"])

    return run


def _colliding(match: int):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            if batch.num_rows:
                a, b = [np.stack([np.frombuffer(x.as_py(), "<u4") for x in batch.column(i)]) for i in (2, 3)]
                keep = pa.array((a == b).sum(1) >= match)
                yield pa.RecordBatch.from_arrays([batch.column(i).filter(keep) for i in (0, 1)], ["a", "b"])

    return run


def _similar(percent: int):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            keep = []
            for a, b in zip(batch.column(2), batch.column(3)):
                keep.append(_alike(np.frombuffer(a.as_py(), "<u8"), np.frombuffer(b.as_py(), "<u8"), percent))
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(keep) for i in (0, 1)], ["a", "b"])

    return run

"""Sharding by fixed virtual slots and a versioned slot-to-shard map.

A record's slot is a hash of its id and text and never changes. Records that are equal in both and so
many that they would outweigh a slot are interchangeable: each draws a slot of its own. Equal texts
under different ids are placed each for itself. Bytes are summed per slot; the slots, of which there
are some thousands whatever the number of records, are given to shards so that their bytes come out
near equal. The map is a small table with a version. Rebalancing edits the map: slots move from
the fullest shards to the emptiest ones, all others stay where they are.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fichario.llm.common import saved, text_key
from fichario.session import new_folder

SLOTS = 4_096
HEAVY = 4  # a slot, or equal records, of more than so many mean slots
PIECE_ROWS = 100_000  # records that are numbered together
MAP = "version int, vslot int, shard int"


def _slot(key: Column, slots: int) -> Column:
    return F.pmod(key, F.lit(slots)).cast("int")


def records(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """doc_id, size, text_crc32, text_key, key, vslot of every row, by id and text alone."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        text_key().alias("text_key"))
    return rows.withColumn("key", F.xxhash64("doc_id", "text_key")).withColumn("vslot", _slot(F.col("key"), slots))


def repeats(rows: DataFrame, slots: int = SLOTS) -> DataFrame:
    """__id, __key: ids and text hashes of the equal records that weigh more than HEAVY mean slots, in
    bytes or number. There are fewer than the slots, so they make a list. Only slots that weigh so
    much can hold them: no other record is shuffled."""
    loads = weights(rows)
    size, n = (HEAVY * sum(x[k] for x in loads) / slots for k in (1, 2))
    heavy = [v for v, bytes_, count in loads if bytes_ > size or count > n]
    found = (
        rows.filter(F.col("vslot").isin(heavy)).groupBy("doc_id", "text_key")
        .agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
        .filter((F.col("n") > 1) & ((F.col("bytes") > size) | (F.col("n") > n)))
        .select("doc_id", "text_key").collect())
    return rows.sparkSession.createDataFrame([tuple(r) for r in found], "__id long, __key long")


def spread(rows: DataFrame, hot: DataFrame, slots: int = SLOTS) -> DataFrame:
    """rows, those of hot with a key and slot by their place in the input, which reading again keeps."""
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("text_key") == F.col("__key"))
    own = F.when(F.col("__key").isNotNull(), F.xxhash64("key", "__n")).otherwise(F.col("key"))
    return (
        rows.withColumn("__n", F.monotonically_increasing_id()).join(F.broadcast(hot), same, "left")
        .withColumn("key", own).withColumn("vslot", _slot(F.col("key"), slots)).drop("__n", "__id", "__key")
    )


def weights(rows: DataFrame) -> list[tuple[int, int, int]]:
    """(vslot, bytes, records) of the slots in use: at most as many as there are slots, so a list."""
    found = rows.groupBy("vslot").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    return sorted((r.vslot, r.bytes, r.n) for r in found.collect())


def first_map(loads: list[tuple[int, int, int]], shards: int, slots: int = SLOTS) -> dict[int, int]:
    """vslot -> shard for all slots: the heaviest slot first, always to the emptiest shard."""
    known = {v: b for v, b, _ in loads}
    heap, owner = [(0, s) for s in range(shards)], {}
    for vslot in sorted(range(slots), key=lambda v: (-known.get(v, 0), v)):
        load, shard = heapq.heappop(heap)
        owner[vslot] = shard
        # an empty slot counts a little, so that slots without records are dealt evenly too
        heapq.heappush(heap, (load + known.get(vslot, 0) + 1, shard))
    return owner


def rebalanced(
    owner: dict[int, int], loads: list[tuple[int, int, int]], shards: int, tolerance: float = 0.01
) -> dict[int, int]:
    """An edit of the map for new loads or a new number of shards: as few bytes move as bring every
    shard within the tolerance of the mean, if slots are small enough. Slots of shards that are no
    more all move."""
    known, out = {v: b for v, b, _ in loads}, dict(owner)
    held: dict[int, list[int]] = {s: [] for s in range(shards)}
    homeless = []
    for vslot, shard in sorted(out.items()):
        held[shard].append(vslot) if shard < shards else homeless.append(vslot)
    load = {s: sum(known.get(v, 0) for v in vs) for s, vs in held.items()}
    goal = sum(known.values()) / shards

    def give(vslot: int, shard: int) -> None:
        out[vslot] = shard
        held[shard].append(vslot)
        load[shard] += known.get(vslot, 0)

    for vslot in sorted(homeless, key=lambda v: (-known.get(v, 0), v)):
        give(vslot, min(load, key=lambda s: (load[s], s)))
    while True:
        full, empty = max(load, key=lambda s: (load[s], -s)), min(load, key=lambda s: (load[s], s))
        if load[full] <= goal * (1 + tolerance) and load[empty] >= goal * (1 - tolerance):
            return out
        room = min(max(load[full] - goal, 1), load[full] - load[empty] - 1)
        fits = [v for v in held[full] if 0 < known.get(v, 0) <= room]
        if not fits:
            return out
        vslot = max(fits, key=lambda v: (known[v], -v))
        held[full].remove(vslot)
        load[full] -= known[vslot]
        give(vslot, empty)


def store_map(spark: SparkSession, owner: dict[int, int], version: int) -> DataFrame:
    """The map as a saved table; every version is a table of its own."""
    rows = [(version, v, s) for v, s in sorted(owner.items())]
    return saved(spark.createDataFrame(rows, MAP).coalesce(1), f"slot-map-v{version}")


def load_map(table: DataFrame) -> dict[int, int]:
    """The latest version of a map table; it has one row per slot."""
    last = table.agg(F.max("version")).first()[0]
    return {r.vslot: r.shard for r in table.filter(F.col("version") == last).collect()}


def placed(rows: DataFrame, slot_map: DataFrame) -> DataFrame:
    """rows with shard and slot, the record's place in its shard, from 0 without gaps.

    Places are numbered within pieces of a virtual slot, pieces being cut by the key so that they hold
    about PIECE_ROWS records at any size, and moved by the records of the pieces and of the shard's slots
    before, so that neither a shard nor a slot is ever one task. The map has one row per slot: it is
    broadcast; the pieces' counts are joined as Spark sees fit.
    """
    spark = rows.sparkSession
    owner, before, starts = load_map(slot_map), {}, []
    loads = weights(rows)
    for vslot, _, n in loads:
        shard = owner[vslot]
        starts.append((vslot, shard, before.get(shard, 0)))
        before[shard] = before.get(shard, 0) + n
    table = spark.createDataFrame(starts, "vslot int, shard int, __base long")
    most = max((n for _, _, n in loads), default=0)
    pieces = F.pmod(F.xxhash64("key"), F.lit(most // PIECE_ROWS + 1))
    cut = rows.withColumn("__piece", pieces)
    earlier = Window.partitionBy("vslot").orderBy("__piece").rowsBetween(Window.unboundedPreceding, -1)
    counts = cut.groupBy("vslot", "__piece").agg(F.count("*").alias("__count")).select(
        "vslot", "__piece", F.coalesce(F.sum("__count").over(earlier), F.lit(0)).alias("__before"))
    order = Window.partitionBy("vslot", "__piece").orderBy("doc_id", "text_crc32", "size")
    return (
        cut.withColumn("__n", F.row_number().over(order)).join(counts, ["vslot", "__piece"])
        .join(F.broadcast(table), "vslot")
        .withColumn("slot", F.col("__base") + F.col("__before") + F.col("__n") - 1)
        .drop("__n", "__base", "__before", "__piece")
    )


def assign(docs: DataFrame, shards: int = 16, slots: int = SLOTS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, vslot, map_version of every row.

    The law is `bytes`: shards' sizes come out near equal, also where one id, one text or both repeat in
    a large part of the rows. Null texts have size 1; rows without id are placed by their text; repeated
    rows are placed each for itself. An empty table gives no rows.
    """
    spark = docs.sparkSession
    rows = saved(records(docs.select("doc_id", "text"), slots), "slot-records")
    hot = repeats(rows, slots)
    if not hot.isEmpty():
        rows = saved(spread(rows, hot, slots), "slot-records")
    slot_map = store_map(spark, first_map(weights(rows), shards, slots), 1)
    return placed(rows, slot_map).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "vslot", F.lit(1).alias("map_version"))


def write_shards(docs: DataFrame, slot_map: DataFrame, slots: int = SLOTS) -> str:
    """Writes the rows of docs to folders by shard under the shared folder; returns its path.

    A shard is written by many tasks: rows are dealt by shard and virtual slot. Which of many equal
    records lies in which shard may differ from `assign`; they are interchangeable.
    """
    hot = repeats(records(docs.select("doc_id", "text"), slots), slots)
    key = F.xxhash64("doc_id", text_key())
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (text_key() == F.col("__key"))
    own = F.when(F.col("__key").isNotNull(), F.xxhash64(key, F.col("__n"))).otherwise(key)
    last = slot_map.agg(F.max("version")).first()[0]
    owners = slot_map.filter(F.col("version") == last).select(F.col("vslot").alias("__vslot"), "shard")
    path = new_folder(docs.sparkSession, "shards")
    (
        docs.drop("shard").withColumn("__n", F.monotonically_increasing_id()).join(F.broadcast(hot), same, "left")
        .withColumn("__vslot", _slot(own, slots)).drop("__n", "__id", "__key")
        .join(F.broadcast(owners), "__vslot").repartition("shard", "__vslot").drop("__vslot")
        .write.partitionBy("shard").parquet(path)
    )
    return path

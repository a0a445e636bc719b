"""Shard assignment on a consistent-hash ring with bounded loads.

The ring is ``grid`` slots long and carries ``vnodes`` virtual nodes per shard.
A key's hash names its slot; its home is the shard of the first virtual node at
or after that slot. Every shard has a row capacity, and the capacities add up
to the number of rows (they differ by one at most). Rows keep their home while
it has room; the rest continue clockwise to the first shard that has room left,
so all shards end exactly full (law ``rows``) and only the excess of overfull
homes moves.

All of it is joins, aggregates and windows. What the overflow step sees is one
count per ring slot: ``grid`` rows, a parameter, whatever the number of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from medley.llm.common import text_of, written

GRID = 16_384
VNODES = 64


def ring(spark: SparkSession, n_shards: int, vnodes: int, grid: int) -> DataFrame:
    """(slot, home, prefs): for each ring slot its home shard and all shards in
    clockwise order. ``grid`` rows made from the parameters alone."""
    nodes = (spark.range(n_shards * vnodes)
             .select(F.floor(F.col("id") / vnodes).cast("int").alias("shard"),
                     F.pmod(F.xxhash64(F.lit("vnode"), F.floor(F.col("id") / vnodes),
                                       F.col("id") % vnodes), F.lit(grid)).alias("pos"),
                     F.col("id").alias("node")))
    order = nodes.agg(F.array_sort(F.collect_list(F.struct("pos", "node", "shard"))).alias("n"))
    order = order.select(F.transform("n", lambda x: x["shard"]).alias("order"))
    at = nodes.groupBy("pos").agg(F.count("*").alias("here"))
    before = (spark.range(grid).withColumnRenamed("id", "slot")
              .join(F.broadcast(at), F.col("slot") == F.col("pos"), "left")
              .select("slot", (F.sum(F.coalesce("here", F.lit(0))).over(
                  Window.orderBy("slot").rowsBetween(Window.unboundedPreceding, -1))).alias("b")))
    k = F.coalesce(F.col("b"), F.lit(0)).cast("int") % (n_shards * vnodes)
    arcs = (spark.range(n_shards * vnodes).withColumn("order", order.scalar())
            .select(F.col("id").cast("int").alias("first"),
                    F.array_distinct(F.concat(
                        F.slice("order", F.col("id").cast("int") + 1, n_shards * vnodes),
                        F.slice("order", F.lit(1), F.col("id").cast("int")))).alias("prefs")))
    return (before.select("slot", k.alias("first")).join(F.broadcast(arcs), "first")
            .select("slot", F.col("prefs")[0].alias("home"), "prefs"))


def plan_slots(counts: DataFrame, n_shards: int, vnodes: int, grid: int) -> DataFrame:
    """From (slot, n) to (slot, home, stay, before, pieces), ``grid`` rows.

    ``stay`` rows of the slot stay at home, numbered from ``before``; the rest
    go to ``pieces`` (from, upto, shard, base) in clockwise order."""
    spark = counts.sparkSession
    total = F.sum("n").over(Window.partitionBy())
    by_home = Window.partitionBy("home").orderBy("slot")
    cap = (F.floor(F.col("total") / n_shards)
           + F.when(F.col("home") < F.col("total") % n_shards, 1).otherwise(0))
    slots = (ring(spark, n_shards, vnodes, grid).join(counts, "slot", "left")
             .withColumn("n", F.coalesce("n", F.lit(0).cast("long")))
             .withColumn("total", total).withColumn("cap", cap.cast("long"))
             .withColumn("before", F.sum("n").over(by_home) - F.col("n"))
             .withColumn("stay", F.greatest(F.lit(0), F.least("n", F.col("cap") - F.col("before"))))
             .select("slot", "home", "prefs", "n", "total", "before", "stay"))
    slots = written(spark, slots, "ring-slots")          # grid rows, read three times below

    zero = F.lit(0).cast("long")
    shards = (spark.range(n_shards).select(F.col("id").cast("int").alias("home"))
              .join(slots.groupBy("home").agg(F.sum("stay").alias("kept")), "home", "left")
              .withColumn("total", slots.agg(F.max("total")).scalar())
              .select("home", F.coalesce("kept", zero).alias("kept"),
                      (F.floor(F.col("total") / n_shards)
                       + F.when(F.col("home") < F.col("total") % n_shards, 1).otherwise(0)
                       ).cast("long").alias("cap")))
    free = shards.agg(F.transform(F.array_sort(F.collect_list(
        F.struct("home", (F.col("cap") - F.col("kept")).alias("f")))), lambda x: x["f"]).alias("free"))
    over = (slots.filter("n > stay")
            .agg(F.array_sort(F.collect_list(F.struct(
                "slot", (F.col("n") - F.col("stay")).alias("n"), "prefs"))).alias("overs")))

    piece = "array<struct<slot:bigint,shard:int,at:bigint,n:bigint>>"

    def offer(state, overflow):
        """One slot's overflow walks clockwise, taking what room each shard has."""
        def visit(t, shard):
            take = F.least(t["left"], F.element_at(t["free"], shard + 1))
            out = F.when(take > 0, F.concat(t["out"], F.array(F.struct(
                overflow["slot"].alias("slot"), shard.alias("shard"),
                (overflow["n"] - t["left"]).alias("at"), take.alias("n"))))).otherwise(t["out"])
            room = F.transform(t["free"], lambda f, i: F.when(i == shard, f - take).otherwise(f))
            return F.struct(room.alias("free"), out.alias("out"), (t["left"] - take).alias("left"))
        return F.aggregate(overflow["prefs"],
                           F.struct(state["free"].alias("free"), state["out"].alias("out"),
                                    overflow["n"].alias("left")),
                           visit, lambda t: F.struct(t["free"].alias("free"), t["out"].alias("out")))

    moved = (over.withColumn("free", free.scalar())      # one row, grid entries at most
             .select(F.posexplode(F.aggregate(
                 "overs", F.struct(F.col("free").alias("free"),
                                   F.array().cast(piece).alias("out")),
                 offer, lambda s: s["out"])).alias("seq", "p"))
             .select("seq", "p.*"))
    by_shard = Window.partitionBy("shard").orderBy("seq")
    pieces = (moved.withColumn("prior", F.sum("n").over(by_shard) - F.col("n"))
              .join(F.broadcast(shards), F.col("shard") == F.col("home"))
              .groupBy("slot").agg(F.array_sort(F.collect_list(F.struct(
                  F.col("at").alias("from"), (F.col("at") + F.col("n")).alias("upto"), "shard",
                  (F.col("kept") + F.col("prior")).alias("base")))).alias("pieces")))
    return (slots.filter("n > 0").select("slot", "home", "stay", "before")
            .join(F.broadcast(pieces), "slot", "left"))


def assign(docs: DataFrame, n_shards: int = 16, id_col: str = "doc_id", text_col: str = "text",
           vnodes: int = VNODES, grid: int = GRID) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row.

    The key is the row's id and text checksum, so one id that many rows share
    still spreads. Rows alike in id, checksum and size are counted together
    before the shuffle and dealt out again at the end. NULL id: a key of its
    own; NULL text: size 1, checksum of the empty text. Empty table: no rows.
    Capacities differ by one at most, so law ``rows`` holds; ``slot`` counts up
    from 0 in each shard without gaps."""
    spark = docs.sparkSession
    text = text_of(docs, text_col)
    keyed = docs.select(
        docs[id_col].alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"))
    keyed = (keyed.withColumn("slot", F.pmod(F.xxhash64("doc_id", "text_crc32", "size"), F.lit(grid)))
             .groupBy("slot", "doc_id", "text_crc32", "size").agg(F.count("*").alias("copies")))
    keyed = written(spark, keyed, "ring-keys")
    counts = keyed.groupBy("slot").agg(F.sum("copies").alias("n"))
    slots = plan_slots(counts, n_shards, vnodes, grid)
    in_slot = Window.partitionBy("slot").orderBy("doc_id", "text_crc32", "size")
    rows = (keyed.withColumn("r0", F.sum("copies").over(in_slot) - F.col("copies"))
            .join(F.broadcast(slots), "slot")            # at most ``grid`` rows
            .withColumn("r", F.explode(F.expr("sequence(r0, r0 + copies - 1)"))))
    q = F.col("r") - F.col("stay")
    piece = F.element_at(F.filter("pieces", lambda p: (p["from"] <= q) & (q < p["upto"])), 1)
    rows = rows.withColumn("piece", F.when(q >= 0, piece))
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"),
        F.coalesce("piece.shard", "home").cast("int").alias("shard"),
        F.when(q < 0, F.col("before") + F.col("r"))
         .otherwise(F.col("piece.base") + q - F.col("piece.from")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), F.col("home").cast("int").alias("home_shard"))


def write_shards(docs: DataFrame, assigned: DataFrame, path: str, id_col: str = "doc_id") -> None:
    """Write the documents as one folder per shard (ids must be unique)."""
    keys = assigned.select(F.col("doc_id").alias("_k"), "shard", "slot")
    (docs.join(keys, docs[id_col].eqNullSafe(F.col("_k"))).drop("_k")
     .write.partitionBy("shard").parquet(path))


__all__ = ["assign", "write_shards", "ring"]

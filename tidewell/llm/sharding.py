"""Operator 6: shards of even size that keep linked documents together, by balanced label propagation.

Nodes carry a label (their shard). In each round, a Spark join brings the labels of a node's neighbours to it; half
of the nodes, chosen by a hash, may ask for the label that most of its links have. Requests are granted per pair of
labels up to the free capacity of the label asked for (and SLACK more, without which full labels could not swap), so
no label grows over its quota; what is granted is decided
on sums over at most labels**2 * BINS cells, whatever the size of the graph. Rounds end when two in a row move less
than the share LEAST of all weight.

Documents of equal text are linked through a node of their own for the text. Those of one text and one first shard
act as one node with their number as its weight, so a text of any number of copies is at most as many nodes as there
are shards; a text too large for a shard's quota spreads over several. Then documents are numbered within the shard
they were given, linked ones first, in one range-partitioned sort; those beyond the shard's exact size take the free
places of other shards. So counts differ by one at most, and a slot is the number of a document in its shard.

Defined results: a null text counts as an empty one (size 1); repeated rows are documents of their own; a null
doc_id is a value like others; fewer documents than shards leave shards empty; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm.common import Scratch, read, ship, sized_join

SHARDS, ROUNDS, BINS, SLACK, LEAST = 8, 12, 64, 0.03, 0.005


def propagate(nodes: DataFrame, links: DataFrame, labels: int, capacity: int, scratch: Scratch, rounds: int = ROUNDS) -> DataFrame:
    """(id, label) after balanced propagation over nodes(id, weight, label) and links(a, b, weight), taken both ways."""
    both = scratch.keep(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"), "weight")))
    quiet = 0
    for turn in range(rounds):
        near = both.join(nodes.select(F.col("id").alias("a"), "label"), "a").groupBy("b", "label").agg(F.sum("weight").alias("votes"))
        best = near.groupBy(F.col("b").alias("id")).agg(F.max(F.struct("votes", (-F.col("label")).alias("label"))).alias("best"), F.collect_list(F.struct("label", "votes")).alias("all"))
        here = F.coalesce(F.aggregate(F.filter("all", lambda x: x["label"] == F.col("label")), F.lit(0).cast("long"), lambda a, x: a + x["votes"]), F.lit(0))
        active = F.pmod(F.xxhash64("id", F.lit(turn)), F.lit(2)) == 0
        goal = F.when(active & (F.col("best.votes") > here), -F.col("best.label")).otherwise(F.col("label"))
        asked = scratch.keep(nodes.join(best, "id", "left").select("id", "weight", "label", F.coalesce(goal, "label").cast("int").alias("goal"), F.pmod(F.xxhash64("id", F.lit(-turn)), F.lit(BINS)).cast("int").alias("bin")))
        cells = asked.groupBy("label", "goal", "bin").agg(F.sum("weight").alias("w"), F.count("*").alias("n")).collect()  # at most labels**2 * BINS rows
        load = np.zeros(labels, np.int64)
        for c in cells:
            load[c.label] += c.w
        granted, moved, open_cells = [], 0, sorted((c for c in cells if c.label != c.goal), key=lambda c: (c.bin, c.label, c.goal))
        while True:  # what leaves a label makes room for others, so the refused are looked at again
            refused = []
            for c in open_cells:
                if load[c.goal] + c.w <= capacity * (1 + SLACK):
                    load[c.goal] += c.w
                    load[c.label] -= c.w
                    moved += c.w
                    granted.append((c.label, c.goal, c.bin))
                else:
                    refused.append(c)
            if len(refused) == len(open_cells):
                break
            open_cells = refused
        most, waiting = capacity * (1 + SLACK), {}
        for c in open_cells:  # two full labels may still swap
            back = waiting.get((c.goal, c.label))
            d = c.w - back[0].w if back else 0
            if back and load[c.goal] + d <= most and load[c.label] - d <= most:
                load[c.goal] += d
                load[c.label] -= d
                moved += c.w + back[0].w
                granted += [(x.label, x.goal, x.bin) for x in (c, back.pop(0))]
            else:
                waiting.setdefault((c.label, c.goal), []).append(c)
        quiet = quiet + 1 if moved <= LEAST * load.sum() else 0
        if granted:
            moves = scratch.spark.createDataFrame(granted, "label int, goal int, bin int").withColumn("moves", F.lit(True))
            nodes = scratch.keep(asked.join(F.broadcast(moves), ["label", "goal", "bin"], "left").select("id", "weight", F.when(F.col("moves"), F.col("goal")).otherwise(F.col("label")).alias("label")))
        if quiet == 2:
            break
    return nodes.select("id", "label")


def assign_shards(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) per row of docs(doc_id, text); counts differ by one at most."""
    spark = docs.sparkSession
    ship(spark)
    scratch = Scratch(spark)
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.xxhash64(text).alias("h"),
        F.pmod(F.xxhash64("doc_id", F.lit(29)), F.lit(shards)).cast("int").alias("origin"),
        F.pmod(F.monotonically_increasing_id(), F.lit(4096)).cast("int").alias("tie"),
    )
    rows = scratch.keep(rows.withColumn("same", F.concat_ws("-", "h", "text_crc32", "size")).drop("h"))
    units = rows.groupBy("same", "origin").agg(F.count("*").alias("weight"))
    total = units.groupBy("same").agg(F.sum("weight").alias("copies")).where("copies > 1").select("same")
    units = scratch.keep(units.join(total, "same").withColumn("id", F.concat_ws("/", "same", "origin")))
    hubs = units.groupBy("same").agg(F.min("origin").alias("label")).select(F.col("same").alias("id"), F.lit(0).cast("long").alias("weight"), "label")
    nodes = units.select("id", "weight", F.col("origin").alias("label")).unionByName(hubs)
    count = rows.count()
    placed = propagate(nodes, units.select(F.col("id").alias("a"), F.col("same").alias("b"), "weight"), shards, -(-count // shards), scratch)
    placed = scratch.keep(units.join(placed, "id").select("same", "origin", "label"))
    given = sized_join(rows, placed, ["same", "origin"], "left").select("doc_id", "size", "text_crc32", F.coalesce("label", "origin").alias("given"), F.col("label").isNull().alias("alone"), "same", "tie")
    order = ["given", "alone", "same", "doc_id", "tie"]

    def number(batches):
        seen, part = np.zeros(shards, np.int64), TaskContext.get().partitionId()
        for batch in batches:
            g = batch.column(3).to_numpy()
            local = np.empty(len(g), np.int64)
            for s in np.unique(g):
                at = np.flatnonzero(g == s)
                local[at] = seen[s] + np.arange(len(at))
                seen[s] += len(at)
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(4)] + [pa.array(np.full(len(g), part, np.int32)), pa.array(local)], names=["doc_id", "size", "text_crc32", "given", "part", "local"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    numbered = scratch.keep(given.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "size", "text_crc32", "given").mapInArrow(number, f"doc_id {kind}, size long, text_crc32 long, given int, part int, local long"))
    counts = numbered.groupBy("given", "part").count().orderBy("given", "part").collect()  # a row per shard and task
    have, starts = [0] * shards, []
    for c in counts:
        starts.append((c.given, c.part, have[c.given]))
        have[c.given] += c["count"]
    want = [count // shards + (s < count % shards) for s in range(shards)]
    over = np.concatenate([[0], np.cumsum([max(0, h - w) for h, w in zip(have, want, strict=True)])]).tolist()
    free = np.concatenate([[0], np.cumsum([max(0, w - h) for h, w in zip(have, want, strict=True)])]).tolist()

    def pick(values, by):
        return F.element_at(F.array(*(F.lit(int(v)).cast("long") for v in values)), by + 1)

    starts = spark.createDataFrame(starts, "given int, part int, start long")
    rank = F.col("start") + F.col("local")
    out = sized_join(numbered, scratch.keep(starts), ["given", "part"], "inner").withColumn("rank", rank).withColumn("extra", pick(over[:-1], F.col("given")) + F.col("rank") - pick(want, F.col("given")))
    other = F.coalesce(*(F.when(F.col("extra") < free[s + 1], s) for s in range(shards)))
    out = out.withColumn("shard", F.when(F.col("rank") < pick(want, F.col("given")), F.col("given")).otherwise(other))
    slot = F.when(F.col("rank") < pick(want, F.col("given")), F.col("rank")).otherwise(pick(have, F.col("shard")) + F.col("extra") - pick(free[:-1], F.col("shard")))
    return scratch.final(out.select("doc_id", "size", "text_crc32", F.col("shard").cast("int").alias("shard"), slot.alias("slot")))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = assign_shards(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))

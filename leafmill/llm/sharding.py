"""Even shards by balanced label propagation.

Nodes start in a shard by a hash of their row.  In each round every hub (what
links nodes: an equal text, say) counts its members by shard, each member adds
up the counts of its hubs and would move to the shard where the most of them
could be together, given the room there, and of equal ones where the most are;
only its own shard and those with room count.  Moves are granted under
quotas: the flows between shards are summed (SHARDS * SHARDS numbers), and a
shard takes in no more linked rows than its quota of rows has room for, plus
what swaps with it free; unlinked rows give way at the end.  All hubs go the
same way.  Which moves are granted is drawn for a hub, so that its members move
together; for the members of a hub with more than `LARGE` of a quota it is drawn
one by one, so that such a hub fills what room there is, and in the next round
the shard after that.  After the last round the counts are made even exactly:
each shard's rows beyond its quota, unlinked ones first, go to the shards below
theirs.  Rounds are joins and partial sums; the links are never expanded into
pairs, and a round's state is written to the shared folder.

The law is `rows`: row counts of any two shards differ by one at most.  Draws
depend on doc_id and text alone, not on files or partitions.

Edge cases.  Null and empty texts are rows like others; null texts link with
nothing.  Rows with equal or null doc_id are separate rows.  An empty table
gives an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

SHARDS = 8
ROUNDS = 4
#: The members of a hub with more of them than this share of a quota move one by one.
LARGE = 0.02


def _vector(shard: str, shards: int) -> Column:
    return F.array(*[F.count_if(F.col(shard) == s) for s in range(shards)])


def _grants(flow: dict[tuple[int, int], int], load: list[int], room: float) -> list[list[float]]:
    """Share of the wishes from one shard to another that the quotas allow."""
    k = len(load)
    share = [[0.0] * k for _ in range(k)]
    for to in range(k):
        wished = {f: n for (f, t), n in flow.items() if t == to and n}
        swaps = {f: min(n, flow.get((to, f), 0)) for f, n in wished.items()}
        free = max(0.0, room - load[to])
        rest = sum(wished.values()) - sum(swaps.values())
        for f, n in wished.items():
            share[f][to] = min(1.0, (swaps[f] + (n - swaps[f]) * min(1.0, free / rest if rest else 1.0)) / n)
    return share


def propagate(nodes: DataFrame, members: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """`nodes` (node long, seed long and others) with shard int and tied int (neighbours in that shard).

    members: node long, hub long; a node may have several hubs.  seed: what the draws of a node depend on.
    """
    quota = nodes.count() / shards
    members = common.beside(members.select("node", "hub"), "hub", "node", F.count(F.lit(1)), F.sum, "many").where("many > 1")
    share = F.when(F.col("many") > common.SHARES, F.pmod(F.xxhash64("node"), F.lit(common.SHARES)).cast("int")).otherwise(0)
    members = members.select("node", "hub", "many", share.alias("share"))
    members = common.materialize(members, "links")
    state = nodes.select("node", "seed", F.pmod(F.xxhash64("seed"), F.lit(shards)).cast("int").alias("shard"), F.lit(0).cast("long").alias("tied"))
    for turn in range(rounds):
        votes = members.join(state.select("node", "shard"), "node").groupBy("hub").agg(_vector("shard", shards).alias("v"), F.max("share").alias("last"))
        votes = votes.select("hub", "v", F.explode(F.sequence(F.lit(0), "last")).alias("share"))  # a large hub's votes, once for each share of its members
        # equal counts: every member of a hub prefers the same shard
        heard = members.join(votes, ["hub", "share"]).groupBy("node").agg(
            F.array(*[F.sum(F.get("v", F.lit(s))) for s in range(shards)]).alias("sum"), F.max(F.struct("many", "hub")).alias("main")
        )
        full = common.checkpointed(state.join(heard, "node", "left").select("node", "seed", "shard", "tied", "sum", "main"))
        linked = full.where("sum is not null")
        load = dict.fromkeys(range(shards), 0) | {r["shard"]: r["count"] for r in linked.groupBy("shard").count().collect()}  # shards numbers
        room = F.array(*[F.lit(max(0.0, quota - load[s])) for s in range(shards)])
        every = F.aggregate("sum", F.lit(0).cast("long"), lambda a, n: a + n)
        order = F.transform("sum", lambda n, s: F.struct(F.least(every, n + F.get(room, s)).alias("could"), n.alias("n"), F.pmod(F.xxhash64("main.hub", s), F.lit(1 << 20)).alias("r"), s.alias("s")))
        best = F.array_max(F.filter(order, lambda x: (x["s"] == F.col("shard")) | (F.get(room, x["s"]) >= 1)))["s"].cast("int")
        wish = F.coalesce(best, F.col("shard"))
        flow = {(r["shard"], r["to"]): r["n"] for r in linked.groupBy("shard", wish.alias("to")).agg(F.count(F.lit(1)).alias("n")).collect()}  # shards * shards numbers
        wishes = {ft: n for ft, n in flow.items() if ft[0] != ft[1]}
        share = F.array(*[F.array(*[F.lit(x) for x in row]) for row in _grants(wishes, [load[s] for s in range(shards)], quota)])
        die = F.when(F.col("main.many") > LARGE * quota, F.xxhash64("seed", F.lit(turn))).otherwise(F.xxhash64("main.hub", F.lit(turn)))
        moves = F.coalesce(F.pmod(die, F.lit(1 << 30)) < F.get(F.get(share, F.col("shard")), wish) * (1 << 30), F.lit(False)) & F.col("sum").isNotNull()
        now = F.when(moves, wish).otherwise(F.col("shard"))
        state = full.select("node", "seed", now.alias("shard"), F.coalesce(F.get("sum", now), F.col("tied")).alias("tied"))
        if not wishes:
            break
    return nodes.join(common.checkpointed(state.select("node", "shard", "tied")), "node")


def cut(placed: DataFrame, members: DataFrame) -> DataFrame:
    """links, cut_links: pairs of members of one hub, and those of them in different shards; counted by hub and shard, never listed.

    placed: node, shard.  members: node, hub.
    """
    n = members.join(placed.select("node", "shard"), "node").groupBy("hub", "shard").agg(F.count(F.lit(1)).cast("decimal(38,0)").alias("n"))
    by = n.groupBy("hub").agg(F.sum("n").alias("all"), F.sum(F.col("n") * F.col("n")).alias("same"))
    links, cut_links = F.sum(F.col("all") * (F.col("all") - 1)) / 2, F.sum(F.col("all") * F.col("all") - F.col("same")) / 2
    return by.agg(F.coalesce(links, F.lit(0)).cast("long").alias("links"), F.coalesce(cut_links, F.lit(0)).cast("long").alias("cut_links"))


def even(placed: DataFrame, shards: int = SHARDS) -> DataFrame:
    """`placed` (node, seed, shard, tied, keep_with) with final shard and slot; counts at most one apart."""
    load = dict.fromkeys(range(shards), 0) | {r["shard"]: r["count"] for r in placed.groupBy("shard").count().collect()}
    rows = sum(load.values())
    quota = [rows // shards + (s < rows % shards) for s in range(shards)]
    quotas = F.array(*[F.lit(q) for q in quota])
    loose = F.when(F.col("tied") > 1, F.lit(0)).otherwise(F.lit(1)).alias("loose")
    seated = common.ranked(placed.select("*", loose), ["shard"], ["loose"], ["seed", "node"], ["keep_with"], rows, "slot")
    seated = common.materialize(seated, "seated")
    stay = seated.where(F.col("slot") < F.get(quotas, F.col("shard")))
    over = seated.where(F.col("slot") >= F.get(quotas, F.col("shard"))).drop("slot", "shard")
    excess = sum(max(0, load[s] - quota[s]) for s in range(shards))
    moved = common.ranked(over, [], [], ["seed", "node"], ["seed", "node"], excess, "turn")
    shard, slot, start = F.lit(None).cast("int"), F.lit(None).cast("long"), 0
    for s in range(shards):
        short = max(0, quota[s] - load[s])
        if short:
            here = (F.col("turn") >= start) & (F.col("turn") < start + short)
            shard, slot = F.when(here, F.lit(s)).otherwise(shard), F.when(here, F.col("turn") - start + load[s]).otherwise(slot)
        start += short
    return stay.unionByName(moved.withColumns({"shard": shard, "slot": slot}).drop("turn")).drop("loose")


def shard_documents(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, cut-minimising for equal texts."""
    text = F.col("text")
    nodes = docs.select(
        F.monotonically_increasing_id().alias("node"), "doc_id", (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"), F.crc32(F.coalesce(text, F.lit(""))).alias("text_crc32"),
        F.when(text.isNotNull(), F.xxhash64(F.md5(text), F.xxhash64(text))).alias("hub"),
    ).withColumn("seed", F.xxhash64("doc_id", "hub", "size"))
    nodes = common.materialize(nodes, "nodes")  # node numbers join rows and decide nothing, once they are written
    placed = propagate(nodes, nodes.where("hub is not null").select("node", "hub"), shards, rounds)
    # rows of a hub are ranked side by side where a bucket holds them; else, and without one, the row's own number keeps repeated rows apart
    keep = F.when(F.col("tied").between(2, common.RANK_BUCKET_ROWS), F.xxhash64("hub")).otherwise(F.xxhash64("seed", "node"))
    out = even(placed.withColumn("keep_with", keep), shards)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))

"""Sharding by balanced label propagation.

Links come as memberships (row, group): rows of a group are linked with one another, so a group costs as many rows as it has
members, never pairs. Linked rows start in group order, one full shard after the other, so that a group larger than a
quota fills whole shards. In each round a row's neighbours vote with their shards (counts per group and shard, joined
back to the members), and rows that want to go elsewhere are let in, group after group, as far as the target's quota and
the rows that leave it at the same time allow. Shards that refused rows are left out of the next votes, so that those
rows take their next-best shard. Rounds go on until fewer links are cut no more. At the end rows without links fill what
is left, so that shard counts differ by one at most.

Null texts count as empty texts. Repeated rows are linked like other equal texts. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tallyhawk.functions.hashing import key_hash
from tallyhawk.llm.exact_dedup import digest
from tallyhawk.llm.heavy import attach_spread
from tallyhawk.operators.prefix import BUCKET, hash_prefix_bucket, rank_by_hash, running_totals
from tallyhawk.session import cut_lineage

ADMISSION_BITS = 16


def _votes(members: DataFrame, placed: DataFrame, shards: int, closed: set[int], total: int) -> DataFrame:
    """Per row the shard, its own or one not ``closed``, that most of its neighbours and itself are in.

    Ties fall the same way for a whole group.
    """
    at = members.join(placed, "row")
    counts = F.array(*[F.count_if(F.col("shard") == s) for s in range(shards)])
    tally = at.groupBy("group").agg(counts.alias("tally"), F.count("*").alias("_size"))
    heard = attach_spread(at, tally, ["group"], "_size", total, "row", "inner")
    sums = heard.groupBy("row", "shard").agg(
        F.array(*[F.sum(F.col("tally")[s]) for s in range(shards)]).alias("votes"), F.min("group").alias("_tie")
    )
    ranked = F.array(*[
        F.struct(F.col("votes")[s].alias("n"), F.xxhash64("_tie", F.lit(s)).alias("t"), F.lit(s).alias("s")) for s in range(shards)
    ])
    open_ = F.filter(ranked, lambda v: (v["s"] == F.col("shard")) | ~v["s"].isin(*closed))
    return sums.select("row", "shard", "_tie", F.array_max(open_)["s"].alias("wanted"))


def _quota(rows: int, shards: int) -> list[int]:
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def _at(values: list[int], place) -> F.Column:
    return F.get(F.array(*[F.lit(v).cast("long") for v in values]), place)


def _start(members: DataFrame, quotas: list[int]) -> DataFrame:
    """(row, shard): rows in order of their first group, cut at the quotas."""
    home = members.groupBy("row").agg(F.min("group").alias("group"))
    home = cut_lineage(home.withColumn("part", hash_prefix_bucket(key_hash("row", "shard start"), members.sparkSession)))
    # a large group spans many parts, so that neither windows nor joins have it in one task
    parts = home.groupBy("group", "part").agg(F.count("*").alias("n")).withColumn("_hash", key_hash("group", "shard order"))
    parts = parts.withColumn(BUCKET, hash_prefix_bucket(F.col("_hash"), members.sparkSession))
    parts = running_totals(parts, [], [F.asc("_hash"), F.asc("group"), F.asc("part")], ["n"])
    before = parts.select("group", "part", (F.col("run_n") - F.col("n")).alias("before"))
    inside = Window.partitionBy("group", "part").orderBy("row")
    ranked = home.withColumn("_rank", F.row_number().over(inside)).join(before, ["group", "part"])
    ends = [sum(quotas[: s + 1]) for s in range(len(quotas))]
    shard = sum(((F.col("before") + F.col("_rank") > F.lit(e)).cast("int") for e in ends[:-1]), F.lit(0))
    return cut_lineage(ranked.select("row", shard.alias("shard")))


def _uncut(members: DataFrame, placed: DataFrame) -> int:
    """Links within shards, each told from both ends, and every member with itself."""
    sizes = members.join(placed, "row").groupBy("group", "shard").agg(F.count("*").cast("decimal(18,0)").alias("n"))
    return int(sizes.agg(F.sum(F.col("n") * F.col("n")).alias("n")).first()["n"] or 0)


def _flows(wanted: dict[tuple[int, int], int], room: list[int]) -> dict[tuple[int, int], int]:
    """How many of the rows wanting to go from one shard to another may, so that none gets more than leave it plus its room."""
    flows, sweep, changed = dict(wanted), 0, True
    while changed:
        sweep, changed = sweep + 1, False
        for s, free in enumerate(room):
            into = sorted((k for k in flows if k[1] == s and flows[k]), key=lambda k: (-flows[k], k))
            total = sum(flows[k] for k in into)
            excess = total - free - sum(n for k, n in flows.items() if k[0] == s)
            if excess <= 0:
                continue
            changed = True
            if sweep > 100:  # excess going round in small steps
                excess = max(excess, total // 16)
            for k in into:
                less = min(flows[k], excess)
                flows[k], excess = flows[k] - less, excess - less
    return flows


def _admitted(votes: DataFrame, room: list[int]) -> tuple[DataFrame, int, set[int]]:
    """(row, to) of the rows let in, their number, and the shards that refused some."""
    # rows of a group come next to one another, and a large group spans many admission buckets
    half = ADMISSION_BITS // 2
    bucket = F.shiftleft(F.pmod(F.xxhash64("_tie"), F.lit(1 << half)), half) + F.pmod(F.xxhash64("row"), F.lit(1 << half))
    movers = votes.filter("wanted <> shard").withColumn("bucket", bucket)
    sums = cut_lineage(movers.groupBy("shard", "wanted", "bucket").agg(F.count("*").alias("n")))
    wanted = {(r["shard"], r["wanted"]): r["n"] for r in sums.groupBy("shard", "wanted").agg(F.sum("n").alias("n")).collect()}
    flows = _flows(wanted, room)
    places = _at([flows.get((s, t), 0) for s in range(len(room)) for t in range(len(room))], F.col("shard") * len(room) + F.col("wanted"))
    queue = Window.partitionBy("shard", "wanted").orderBy("bucket")  # at most 2^16 buckets a pair of shards
    before = sums.select("shard", "wanted", "bucket", (F.sum("n").over(queue) - F.col("n")).alias("before"))
    inside = Window.partitionBy("shard", "wanted", "bucket").orderBy("_tie", "row")
    ranked = movers.withColumn("_rank", F.row_number().over(inside)).join(before, ["shard", "wanted", "bucket"])
    moved = ranked.filter(F.col("before") + F.col("_rank") <= places).select("row", F.col("wanted").alias("to"))
    return moved, sum(flows.values()), {k[1] for k, n in wanted.items() if flows[k] < n}


def propagate(members: DataFrame, quotas: list[int], rounds: int | None = None) -> DataFrame:
    """(row, shard) of all rows in ``members`` (row, group), moved under the quotas until fewer links are cut no more.

    ``rounds`` bounds the rounds; without it every round cuts fewer links or closes another shard.
    """
    shards, total = len(quotas), members.count()
    placed = _start(members, quotas)
    uncut, closed, done = _uncut(members, placed), set(), 0
    while rounds is None or done < rounds:
        done += 1
        votes = cut_lineage(_votes(members, placed, shards, closed, total))
        load = {r["shard"]: r["n"] for r in votes.groupBy("shard").agg(F.count("*").alias("n")).collect()}
        moved, n_moved, refused = _admitted(votes, [q - load.get(s, 0) for s, q in enumerate(quotas)])
        if n_moved:
            after = cut_lineage(votes.join(moved, "row", "left").select("row", F.coalesce("to", "shard").alias("shard")))
            better = _uncut(members, after)
            if better > uncut:
                placed, uncut, closed = after, better, refused
                continue
        if refused <= closed:
            break
        closed = closed | refused
    return placed


def fill(rows: DataFrame, placed: DataFrame, quotas: list[int]) -> DataFrame:
    """``rows`` (row, ...) with ``shard`` and ``slot``: places of ``placed`` as far as quotas go, then the rest."""
    ranked = rank_by_hash(placed, ["shard"], key_hash("row", "slot"), "row")
    held = cut_lineage(ranked.filter(F.col("rank") <= _at(quotas, F.col("shard"))).select("row", "shard", (F.col("rank") - 1).alias("slot")))
    used = {r["shard"]: r["n"] for r in held.groupBy("shard").agg(F.count("*").alias("n")).collect()}
    rest = rows.select("row").join(held, "row", "left_anti")
    queued = rank_by_hash(rest, [], key_hash("row", "fill"), "row").select("row", (F.col("rank") - 1).alias("queue"))
    shard, before, left = F.lit(0), F.lit(0).cast("long"), 0
    for s, quota in enumerate(quotas):
        free = quota - used.get(s, 0)
        inside = F.col("queue") >= left
        shard, before = F.when(inside, s).otherwise(shard), F.when(inside, F.lit(left - used.get(s, 0)).cast("long")).otherwise(before)
        left += free
    filled = queued.select("row", shard.cast("int").alias("shard"), (F.col("queue") - before).alias("slot"))
    return rows.join(held.unionByName(filled), "row")


def balanced_shards(docs: DataFrame, shards: int = 16, rounds: int | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the id, ``size`` in bytes plus one, ``text_crc32``, ``shard`` and ``slot``; equal texts are linked."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(doc_id).alias(doc_id),
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        digest(text).alias("group"),
    )
    rows = cut_lineage(rows)
    total = rows.count()
    quotas = _quota(total, shards)
    linked = rows.groupBy("group").agg(F.count("*").alias("n")).filter("n > 1")
    members = cut_lineage(attach_spread(rows.select("row", "group"), linked, ["group"], "n", total, "row", "inner").drop("n"))
    return fill(rows.drop("group"), propagate(members, quotas, rounds), quotas).drop("row")

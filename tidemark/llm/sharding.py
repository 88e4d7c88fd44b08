"""Sharding by balanced label propagation. DataFrame functions only.

Documents that share a group are linked; a group stands for all links between its members, so links
take one row per member. Every linked document starts in a hashed shard, members of a group that is large
beside a shard in as many shards as the group fills. In each round a join
tells it how many members of its groups every shard has, itself included; it moves towards the shard
that has most, ties going by a hash of the group, so that members agree. Moves are held under
capacity quotas: what may flow between two shards is solved from the 16 x 16 demands, and groups (members
of a large group) are drawn by hash up to the share that may move. Every other round only shards with room are
in the choice, so that what a full one can't take goes elsewhere. Documents without links take what room is left,
and a last pass evens the counts exactly, moving the smallest groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import left_join_hot, store, text_or_empty

#: Production parameters: shards, rounds at the most.
SHARDS = 16
ROUNDS = 12

_BUCKET_ROWS = 4096
_UNIT = 1 << 30


def _draw(*columns: Column | str) -> Column:
    """A number below _UNIT from a hash of the columns."""
    return F.pmod(F.xxhash64(*columns), F.lit(_UNIT))


def _per_shard(shards: int, value) -> Column:
    return F.array(*[value(s) for s in range(shards)])


def admitted(demand: dict[tuple[int, int], int], load: list[int], capacity: int) -> dict[tuple[int, int], float]:
    """The share of each demanded flow {(from, to): rows} that may move so that no load passes ``capacity``; one
    that is above it already takes nothing in until enough has left it.

    All flows start whole; those into a shard that would overflow shrink in proportion, which shrinks what leaves
    others, until none overflows. Flows only shrink, so this ends.
    """
    share = dict.fromkeys(demand, 1.0)
    for _ in range(1000):
        steady = True
        for shard in range(len(load)):
            into = sum(n * share[f] for f, n in demand.items() if f[1] == shard)
            out = sum(n * share[f] for f, n in demand.items() if f[0] == shard)
            room = max(capacity - load[shard] + out, 0.0)
            if into > room + 1e-6:
                steady = False
                for f in demand:
                    if f[1] == shard:
                        share[f] *= room / into
        if steady:
            break
    return share


def _is_large(n: Column, capacity: int) -> Column:
    return n * 4 >= F.lit(capacity)


def _start(shards: int, *columns: Column | str) -> Column:
    return F.pmod(F.xxhash64(*columns, F.lit(7)), F.lit(shards)).cast("int")


def _round(labels: DataFrame, links: DataFrame, shards: int, capacity: int, turn: int) -> tuple[DataFrame, int]:
    """``labels`` (node, shard) after one round, and how many nodes moved.

    ``links`` is (node, hub), with ``n``, the members of the hub.
    """
    placed = store(links.join(labels, "node"), "op13_placed")
    total = placed.count()
    pulls = store(placed.groupBy("hub", "n").agg(_per_shard(shards, lambda s: F.count_if(F.col("shard") == s)).alias("pull")),
                  "op13_pulls")
    seen = left_join_hot(placed.drop("n"), pulls, ["hub"], "n", total)
    # All hubs of a node add up; its own label counts once for each of them.
    score = [F.sum(F.get("pull", F.lit(s))) for s in range(shards)]
    nodes = seen.groupBy("node", "shard").agg(F.array(*score).alias("score"), F.min("hub").alias("hub"), F.max("n").alias("n"))
    loads = {r["shard"]: r["n"] for r in labels.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most ``shards``
    load = [loads.get(s, 0) for s in range(shards)]
    # In even rounds full shards may swap members; in odd ones they draw only those they have.
    is_open = F.array(*[F.lit(turn % 2 == 0 or n < capacity) for n in load])
    ranked = F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: F.struct(
        F.when(F.get(is_open, s) | (s == F.col("shard")), F.get(F.col("score"), s)).otherwise(F.lit(-1)).alias("score"),
        _draw("hub", s).alias("tie"), s.alias("shard")))
    wanted = nodes.withColumn("target", F.array_max(ranked)["shard"]).drop("score")
    # A group that is large beside a shard parts; a smaller one moves as one.
    drawn = F.when(_is_large(F.col("n"), capacity), _draw("node", F.lit(turn))).otherwise(_draw("hub", F.lit(turn)))
    wanted = store(wanted.select("node", "shard", "target", drawn.alias("drawn")), "op13_wanted")
    flows = wanted.filter("shard <> target").groupBy("shard", "target").agg(F.count(F.lit(1)).alias("n")).collect()
    share = admitted({(r["shard"], r["target"]): r["n"] for r in flows}, load, capacity)
    limits = F.array(*[F.lit(int(share.get((a, b), 1.0) * _UNIT)) for a in range(shards) for b in range(shards)])
    goes = F.col("drawn") < F.get(limits, F.col("shard") * shards + F.col("target"))
    moved = wanted.withColumn("next", F.when(goes, F.col("target")).otherwise(F.col("shard")))
    after = store(moved.select("node", F.col("next").alias("shard"), (F.col("next") != F.col("shard")).alias("moved")), "op13_labels")
    return after.select("node", "shard"), after.filter("moved").count()


def propagate(links: DataFrame, shards: int = SHARDS, capacity: int = 1, rounds: int = ROUNDS) -> DataFrame:
    """(node, shard) of every node of ``links`` (node long, hub long): linked nodes together, about ``capacity`` nodes
    a shard at the most.

    A node may be in several hubs. Rounds end when two in a row move nothing.
    """
    links = store(links.select("node", "hub").distinct(), "op13_links")
    sizes = store(links.groupBy("hub").agg(F.count(F.lit(1)).alias("n")), "op13_hubs")
    links = store(left_join_hot(links, sizes, ["hub"], "n", links.count()), "op13_sized_links")
    part = F.floor(_draw("node") * F.ceil(F.col("n") / capacity) / _UNIT)
    start = F.when(_is_large(F.col("n"), capacity), F.pmod(_start(shards, "hub") + part, F.lit(shards)).cast("int"))
    labels = links.groupBy("node").agg(F.max_by(F.coalesce(start, _start(shards, "node")), F.struct("n", "hub")).alias("shard"))
    still = 0
    for turn in range(rounds):
        labels, moved = _round(labels, links, shards, capacity, turn)
        still = 0 if moved else still + 1
        if still == 2:
            break
    return labels


def _ranked(rows: DataFrame, group: list[str], total: int, name: str) -> DataFrame:
    """``rows`` with ``name``, their place in their group from 0: unlinked rows last, larger hubs first, hubs whole.

    Places come from sorted buckets of about _BUCKET_ROWS rows and the sums of the buckets before. A hub's rows are in
    one bucket, or, where it has more than a bucket should, in buckets by ``drawn``.
    """
    bits = max(0, min(24, (total // _BUCKET_ROWS).bit_length()))
    by_hub = F.shiftright(F.pmod("hub", F.lit(_UNIT)), 30 - bits)  # the leading digits of the order's hub part
    parts = F.greatest(F.lit(1), F.floor(F.col("n") / _BUCKET_ROWS)).cast("long")
    part = F.floor(F.col("drawn") * parts / _UNIT).cast("long")
    hot = F.when(parts > 1, F.col("hub"))  # a hot hub has buckets of its own, after the others of its digits
    size = -F.floor(F.log2("n"))
    cut = rows.withColumn("_bucket", F.struct("late", size.alias("size"), by_hub.alias("digits"), hot.alias("hot"),
                                              part.alias("part")))
    sizes = cut.groupBy(*group, "_bucket").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*group, "_bucket", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    local = Window.partitionBy(*group, "_bucket").orderBy("hub", "drawn", "node")
    numbered = cut.withColumn("_local", F.row_number().over(local) - 1)
    same = F.col("a._bucket").eqNullSafe(F.col("b._bucket"))
    for g in group:
        same = same & (F.col(f"a.{g}") == F.col(f"b.{g}"))
    return numbered.alias("a").join(starts.alias("b"), same).select(
        *[f"a.{c}" for c in rows.columns], (F.col("b._start") + F.col("a._local")).cast("long").alias(name))


def even_out(rows: DataFrame, shards: int, total: int) -> DataFrame:
    """``rows`` (node, hub, n, drawn, late, shard) with their final ``shard`` and ``slot``: counts at most one apart.

    Each shard keeps its first rows up to its quota, large groups first and unlinked rows last; the rest fill the holes
    of the others in order, so that a group that has to leave goes to one shard, or to a few.
    """
    quota = [total // shards + (s < total % shards) for s in range(shards)]
    placed = store(_ranked(rows, ["shard"], total, "place"), "op13_placed_rows")
    counts = {r["shard"]: r["n"] for r in placed.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}
    quota_of = _per_shard(shards, lambda s: F.lit(quota[s]).cast("long"))
    stays = F.col("place") < F.get(quota_of, F.col("shard"))
    kept = placed.filter(stays).select("node", "shard", F.col("place").alias("slot"))
    spilled = placed.filter(~stays).drop("place", "shard")
    ranked = _ranked(spilled.withColumn("all", F.lit(0)), ["all"], total, "place")
    target, slot, begin = F.lit(None).cast("int"), F.lit(None).cast("long"), 0
    for s in range(shards):
        held = min(counts.get(s, 0), quota[s])
        end = begin + quota[s] - held
        here = (F.col("place") >= begin) & (F.col("place") < end)
        target = F.when(here, F.lit(s)).otherwise(target)
        slot = F.when(here, F.col("place") - F.lit(begin - held)).otherwise(slot)
        begin = end
    return kept.unionByName(ranked.select("node", target.alias("shard"), slot.cast("long").alias("slot")))


def shard(docs: DataFrame, group: Column | None = None, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, size, text_crc32, shard and slot.

    Counts of shards are at most one apart; slots run from 0 in each. ``group`` (default: the text) links
    the rows with the same value; null groups link nothing. Groups stay in one shard unless they are
    larger than its room. size is the UTF-8 bytes of the text plus one; a null text has none, and is grouped with
    empty ones by default. Rows that share a doc_id, or repeat, are rows of their own. Fewer rows than shards leave
    shards empty; an empty table gives no rows. Other columns are read only by ``group``.
    """
    text = text_or_empty()
    key = text if group is None else group
    hub = F.when(key.isNotNull(), F.xxhash64(key, F.lit(1)))
    nodes = store(docs.select(F.col("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
                              F.crc32(text.cast("binary")).alias("text_crc32"), hub.alias("hub"),
                              F.monotonically_increasing_id().alias("node")), "op13_nodes")
    total = nodes.count()
    hubs = store(nodes.filter("hub IS NOT NULL").groupBy("hub").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "op13_shared")
    linked = store(left_join_hot(nodes.select("node", "hub"), hubs, ["hub"], "n", max(total, 1)), "op13_linked")
    labels = propagate(linked.filter("n IS NOT NULL").select("node", "hub"), shards, max(total // shards, 1), rounds)
    both = linked.join(labels.withColumnRenamed("shard", "found"), "node", "left")
    rows = both.select("node", F.coalesce("hub", F.xxhash64("node")).alias("hub"), F.coalesce("n", F.lit(1)).alias("n"),
                       _draw("node").alias("drawn"), F.col("n").isNull().alias("late"),
                       F.coalesce("found", _start(shards, "node")).alias("shard"))
    placed = even_out(store(rows, "op13_rows"), shards, total)
    return nodes.join(placed, "node").select("doc_id", "size", "text_crc32", "shard", "slot")

"""Networks: edge tables ``(a, b, score)`` and what is read from them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise


#: Nodes of one list of a group, and pairs that one task adds up.
LONGEST, TASK_PAIRS = 4096, 2_000_000


def shared_edges(members: DataFrame, node: str, group: str, sizes: DataFrame | None = None) -> DataFrame:
    """``(a, b, score)`` with ``a < b``: the number of groups two nodes have in common. ``sizes`` ``(via, n)`` of the groups may be given.

    A group's nodes become one sorted list, and each node is sent what follows it there, once for all; where a node is, its pairs are counted, so that no row is
    shuffled for a pair and a group. Tasks are as many as the pairs need. Groups of very many nodes are cut into lists that meet each other.
    """
    rows = members.select(F.col(node).alias("node"), F.col(group).alias("via")).where("node is not null and via is not null")
    if sizes is None:
        sizes = rows.groupBy("via").agg(F.count("*").alias("n"))
    most, pairs = sizes.agg(F.max("n"), F.sum(F.col("n") * (F.col("n") - 1) / 2)).first()
    tasks = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), int((pairs or 0) // TASK_PAIRS) + 1)
    if (most or 0) <= LONGEST:
        lists = rows.repartition(max(tasks // 8, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "via").distinct().groupBy("via").agg(F.sort_array(F.collect_list("node")).alias("x"))
        ends = lists.select("x", F.posexplode("x").alias("i", "a")).select("a", F.slice("x", F.col("i") + 2, F.size("x")).alias("bs"))
    else:
        cut = rows.distinct().join(sizes, "via").withColumn("k", F.pmod(F.xxhash64("node"), F.ceil(F.col("n") / LONGEST)))
        lists = materialise(cut.groupBy("via", "k").agg(F.sort_array(F.collect_list("node")).alias("x")), "lists")
        ends = lists.select("via", "x").join(lists.select("via", F.col("x").alias("y")), "via")
        ends = ends.select(F.explode("x").alias("a"), "y").select("a", F.filter("y", lambda b: b > F.col("a")).alias("bs"))
    return ends.where("size(bs) > 0").repartition(tasks, "a").select("a", F.explode("bs").alias("b")).groupBy("a", "b").agg(F.count("*").alias("score"))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


#: A node is a hub with more rows than this and than this share of all rows; so there are at most ``1 / HUB_SHARE`` of them.
HUB_ROWS, HUB_SHARE = 100_000, 0.001


def _with_least(rows: DataFrame, least: DataFrame, total: int) -> DataFrame:
    """``rows`` ``(a, b)`` with the ``m`` of their ``a`` in ``least`` ``(a, m, n)``, ``n`` being the number of rows of ``a``, of ``total`` at most.

    Hubs, a thousand at most, are broadcast, so that their rows stay where they are; only the rows of other nodes are shuffled to join.
    """
    if total <= HUB_ROWS:
        return rows.join(least.select("a", "m"), "a")
    limit = max(HUB_ROWS, total * HUB_SHARE)
    hubs = least.where(F.col("n") > limit).select("a", F.col("m").alias("hub"))
    marked = rows.join(F.broadcast(hubs), "a", "left")
    rest = marked.where("hub is null").select("a", "b").join(least.where(F.col("n") <= limit).select("a", "m"), "a")
    return marked.where("hub is not null").select("a", "b", F.col("hub").alias("m")).unionByName(rest.select("a", "b", "m"))


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """Connected components: ``(node, component)``, the component named by its smallest node.

    Alternating star contraction: each round hangs the larger neighbours of a node on
    the smallest node in reach, so that the rounds grow with the logarithm of the
    longest path. Every round is written to the shared folder. Self loops give a node of
    its own, edges with a null end are ignored, repeated edges count once. The rows of a hub are neither grouped nor joined in one task
    (:func:`_with_least`); least neighbours are combined before their shuffle.
    """
    ends = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a is not null and b is not null")
    nodes = ends.where("a = b").select(F.col("a").alias("node"))
    e = materialise(ends.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = _state(e)
    for _ in range(max_rounds):
        if not state[0]:
            break
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), "a").alias("m"), F.count("*").alias("n"))
        large = _with_least(both.where("b > a"), low, 2 * state[0]).select(F.col("b").alias("a"), F.col("m").alias("b"))
        if state[0] > HUB_ROWS:  # read twice below
            large = materialise(large, "large")
        low = large.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))
        small = _with_least(large, low, state[0]).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        e = materialise(small.unionByName(low.select("a", F.col("m").alias("b"))).where("a <> b").distinct(), "edges")
        before, state = state, _state(e)
        if state == before:
            break
    else:
        raise RuntimeError(f"components did not settle within {max_rounds} rounds")
    found = e.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = e.select(F.col("b").alias("node")).unionByName(nodes).distinct().join(found, "node", "left_anti")
    return found.unionByName(roots.select("node", F.col("node").alias("component")))


def induced_edges(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges with both ends among ``nodes`` (column ``node``)."""
    names = nodes.select("node").distinct()
    return edges.join(names.withColumnRenamed("node", "a"), "a", "left_semi").join(names.withColumnRenamed("node", "b"), "b", "left_semi").select(edges.columns)


def relabel_edges(edges: DataFrame, id_map: DataFrame, directed_count: bool = False) -> DataFrame:
    """Edges ``(a, b, score)`` under the names of ``id_map`` ``(id, name)``; unmapped ones and self loops go.

    Links are undirected: both directions are one edge with the larger score, unless ``directed_count`` keeps them apart.
    """
    named = edges.join(id_map.select(F.col("id").alias("a"), F.col("name").alias("na")), "a").join(id_map.select(F.col("id").alias("b"), F.col("name").alias("nb")), "b").where("na <> nb")
    if directed_count:
        return named.select(F.col("na").alias("a"), F.col("nb").alias("b"), "score").distinct()
    return named.groupBy(F.least("na", "nb").alias("a"), F.greatest("na", "nb").alias("b")).agg(F.max("score").alias("score"))


def degree(edges: DataFrame) -> DataFrame:
    """``(node, degree)``."""
    return edges.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("degree"))


def hubs(edges: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` nodes of the largest degree, equal ones by name."""
    return degree(edges).orderBy(F.col("degree").desc(), "node").limit(k)


def coexpression_edges(measurements: DataFrame, features: DataFrame, r: float = 0.9, most: int = 200) -> DataFrame:
    """Edges between the first ``most`` features whose Spearman correlation is at least ``r`` in size: ``a, b, score, signed_r``."""
    from .qc import pair_correlation

    chosen = features.select("feature").distinct().orderBy("feature").limit(most)
    pairs = pair_correlation(measurements.join(chosen, "feature", "left_semi"), "feature", "spearman")
    return pairs.where(F.abs("r") >= r).select("a", "b", F.round(F.abs("r") * 1000).cast("long").alias("score"), F.col("r").alias("signed_r"))


def network_route(edges: DataFrame, measurements: DataFrame, selected: DataFrame, r: float = 0.9, min_edges: int = 1) -> DataFrame:
    """Edges among the selected features with ``method``: from the edge table where it has any, else by co-expression, else none."""
    names = selected.select(F.col("feature").alias("node"))
    known = induced_edges(edges, names).select("a", "b", F.col("score").cast("double").alias("score"))
    if known.limit(min_edges).count() >= min_edges:
        return known.withColumn("method", F.lit("edge_table"))
    found = coexpression_edges(measurements, selected, r).select("a", "b", F.col("score").cast("double").alias("score"))
    return found.withColumn("method", F.lit("coexpression"))


def network_status(routed: DataFrame, r: float = 0.9) -> DataFrame:
    """One row ``(status, method, n_edges, n_nodes, caveat, reason)`` of what :func:`network_route` found: ``ok``, ``fallback`` with a caveat, or ``skipped`` with a reason."""
    nodes = routed.select(F.explode(F.array("a", "b")).alias("node")).agg(F.count_distinct("node").alias("n_nodes"))
    one = routed.agg(F.max("method").alias("method"), F.count("*").alias("n_edges")).join(nodes, F.lit(True))
    status = F.when(F.col("n_edges") == 0, "skipped").when(F.col("method") == "edge_table", "ok").otherwise("fallback")
    caveat = F.when(F.col("method") == "coexpression", F.lit(f"not a network of known links: features whose rank correlation is at least {r} in size"))
    reason = F.when(F.col("n_edges") == 0, F.lit(f"no known edge between the selected features, and no rank correlation of at least {r} in size"))
    return one.select(status.alias("status"), "method", "n_edges", "n_nodes", caveat.alias("caveat"), reason.alias("reason"))


def largest_component(edges: DataFrame) -> DataFrame:
    """Edges of the component with most nodes, of equals the one with the smallest name."""
    edges = materialise(edges, "edges")
    named = materialise(components(edges), "components")
    top = named.groupBy("component").agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "component").limit(1)
    return induced_edges(edges, named.join(top, "component", "left_semi").select("node"))


def thin(edges: DataFrame, max_nodes: int = 200, max_edges: int = 450) -> DataFrame:
    """Edges among the ``max_nodes`` nodes of largest degree, of these the ``max_edges`` strongest."""
    edges = materialise(edges, "edges")
    kept = induced_edges(edges, hubs(edges, max_nodes).select("node"))
    return kept.orderBy(F.col("score").desc(), "a", "b").limit(max_edges)


#: Nodes of a graph up to which the label of each is sent to every task, links of a node up to which they are one list, and cells of a table of weights.
MOST_NODES, MOST_LINKS, CELLS = 1 << 20, 1 << 22, 1 << 22

#: Columns of a block of nodes with all their links: their numbers as bytes, which no reader or writer takes one by one.
_BLOCK = {"node": np.int32, "n": np.int32, "other": np.int32, "score": np.float64}


def _blocks(lists: DataFrame) -> DataFrame:
    """Blocks of ``(node, other, score)``, a node and the lists of its links. A link of its own largest score is added to each node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, n = (x.to_numpy(zero_copy_only=False) for x in (batch.column("node"), pc.list_value_length(batch.column("other"))))
            if not len(node):
                continue
            other, score = (batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("other", "score"))
            ends = np.cumsum(n)
            loops = np.maximum.reduceat(score, ends - n)
            columns = node, n + 1, np.insert(other, ends, node), np.insert(score, ends, loops)
            yield pa.RecordBatch.from_arrays([pa.array([x.astype(kind).tobytes()]) for x, kind in zip(columns, _BLOCK.values())], list(_BLOCK))

    return materialise(lists.mapInArrow(run, ", ".join(f"{c} binary" for c in _BLOCK)), "blocks")


def _best(size: np.ndarray, label: np.ndarray, score: np.ndarray, n: int) -> np.ndarray:
    """Of each node with ``size`` links of ``score`` to others of ``label`` (less than ``n``), the label of most weight, of equals the least."""
    at = np.concatenate([[0], np.cumsum(size)])
    if len(size) * n > 16 * len(label) or score.min() <= 0:
        key = np.repeat(np.arange(len(size)) * n, size) + label
        order = np.argsort(key, kind="stable")
        first = np.flatnonzero(np.diff(key[order], prepend=-1))
        owner, name, weight = key[order][first] // n, key[order][first] % n, np.add.reduceat(score[order], first)
        most = np.flatnonzero(weight == np.maximum.reduceat(weight, np.flatnonzero(np.diff(owner, prepend=-1)))[owner])
        return name[most[np.unique(owner[most], return_index=True)[1]]]
    best, step = np.zeros(len(size), np.int64), max(1, CELLS // n)
    for i in range(0, len(size), step):
        k = size[i : i + step]
        own = slice(at[i], at[i + len(k)])
        best[i : i + step] = np.bincount(np.repeat(np.arange(len(k)) * n, k) + label[own], score[own], len(k) * n).reshape(len(k), n).argmax(1)
    return best


def _labels_by_blocks(edges: DataFrame, numbers: DataFrame, n: int, rounds: int) -> DataFrame:
    """``(node, label)`` of :func:`communities`: links stay in their blocks, and every task has the labels of all nodes."""
    spark = edges.sparkSession
    end = lambda c: F.broadcast(numbers.select(F.col("node").alias(c), F.col("i").alias(f"i{c}")))
    both = edges.join(end("a"), "a").join(end("b"), "b").select("ia", "ib", F.col("score").cast("double").alias("score"))
    both = both.select(F.inline(F.array(F.struct(F.col("ia").alias("a"), F.col("ib").alias("b")), F.struct(F.col("ib").alias("a"), F.col("ia").alias("b")))), "score")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * edges.count() // TASK_PAIRS + 1)
    blocks = _blocks(both.repartition(parts, "a").groupBy(F.col("a").alias("node")).agg(F.collect_list("b").alias("other"), F.collect_list("score").alias("score")))

    def run(labels: np.ndarray) -> np.ndarray:
        names, own = np.unique(labels, return_inverse=True)
        sent = spark.sparkContext.broadcast((names.astype(np.int32), own.astype(np.int32)))

        def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            names, own = sent.value
            for batch in batches:
                for r in range(batch.num_rows):
                    node, size, other, score = (np.frombuffer(batch.column(c)[r].as_buffer(), kind) for c, kind in _BLOCK.items())
                    yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(names[_best(size, own[other], score, len(names))])], ["i", "label"])

        found = blocks.mapInArrow(choose, "i int, label int").toArrow()
        sent.destroy()
        new = np.empty_like(labels)
        new[found.column("i").to_numpy()] = found.column("label").to_numpy()
        return new

    labels = np.arange(n, dtype=np.int32)
    for _ in range(rounds):
        before, labels = labels, run(labels)
        if (before == labels).all():
            break
    chosen = spark.createDataFrame(pa.table({"i": np.arange(n, dtype=np.int32), "l": labels}))
    return numbers.join(chosen, "i").join(numbers.select(F.col("i").alias("l"), F.col("node").alias("label")), "l").select("node", "label")


def _labels_by_joins(edges: DataFrame, rounds: int) -> DataFrame:
    """``(node, label)`` of :func:`communities`, for any number of nodes."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"), "score"))
    loops = both.groupBy("a").agg(F.max("score").alias("score")).select("a", F.col("a").alias("b"), "score")
    # Links of a node lie together, so that each round adds most of them up before its shuffle.
    both = materialise(both.unionByName(loops).repartitionByRange("a", "b").sortWithinPartitions("a", "b"), "links")
    labels = materialise(both.select(F.col("a").alias("node"), F.col("a").alias("label")).distinct(), "labels")
    for _ in range(rounds):
        weight = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy("a", "label").agg(F.sum("score").alias("w"))
        best = weight.groupBy(F.col("a").alias("node")).agg(F.min_by("label", F.struct(-F.col("w"), F.col("label"))).alias("label"))
        new = materialise(best, "labels")
        moved = new.join(labels.withColumnRenamed("label", "old"), "node").where("label <> old").limit(1).count()
        labels = new
        if not moved:
            break
    return labels


def communities(edges: DataFrame, top: int = 4, rounds: int = 10) -> DataFrame:
    """``(node, community, size)`` by weighted label propagation: each node takes the label of most weight around it, of equals the smallest.

    The ``top`` largest communities are numbered, the others are ``other``. ``edges`` is a table that may be read several times. Up to ``MOST_NODES`` nodes, of up
    to ``MOST_LINKS`` links each, links are shuffled once for all rounds; else labels are joined to the links in each.
    """
    from ..functions.stats import global_row_number

    edges = edges.select("a", "b", "score").where("a is not null and b is not null and score is not null")
    nodes = materialise(degree(edges), "nodes")
    n, most = nodes.agg(F.count("*"), F.max("degree")).first()
    if n <= MOST_NODES and (most or 0) <= MOST_LINKS:
        numbers = materialise(global_row_number(nodes, [F.col("node")], "nth").select("node", (F.col("nth") - 1).cast("int").alias("i")), "numbers")
        labels = _labels_by_blocks(edges, numbers, n, rounds)
    else:
        labels = _labels_by_joins(edges, rounds)
    labels = materialise(labels, "labels")
    sizes = labels.groupBy("label").agg(F.count("*").alias("size"))
    ranked = sizes.orderBy(F.col("size").desc(), "label").limit(top).withColumn("community", F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(F.col("size").desc(), "label")).cast("string"))
    return labels.join(sizes, "label").join(ranked.select("label", "community"), "label", "left").select("node", F.coalesce("community", F.lit("other")).alias("community"), "size")


def modularity(edges: DataFrame, named: DataFrame) -> DataFrame:
    """One row with the modularity of a division ``(node, community)``. ``edges`` is a table that may be read several times."""
    label = lambda c: named.select(F.col("node").alias(c), F.col("community").alias(f"c{c}"))
    named = materialise(named, "named")
    edges = edges.select("a", "b", "score")
    # Edges are added up by the communities of their ends; the rest is read from these sums. A node without a community counts in the whole sum only.
    pairs = materialise(edges.join(label("a"), "a", "left").join(label("b"), "b", "left").groupBy("ca", "cb").agg(F.sum("score").alias("s")), "sums")
    one = pairs.agg(F.sum("s").alias("m"), F.coalesce(F.sum(F.when(F.col("ca") == F.col("cb"), F.col("s"))), F.lit(0)).alias("inside"))
    ends = pairs.select(F.explode(F.array("ca", "cb")).alias("community"), "s").where("community is not null")
    kk = ends.groupBy("community").agg(F.sum("s").alias("k")).agg(F.sum(F.pow("k", F.lit(2))).alias("kk"))
    return one.join(kk, F.lit(True)).select((F.col("inside") / F.col("m") - F.col("kk") / F.pow(2 * F.col("m"), F.lit(2))).alias("modularity"))


def ring_layout(nodes: DataFrame, rings: int = 3, gap: float = 0.72) -> DataFrame:
    """``(node, ring, place, angle, x, y)`` of ``(node, degree, community)``.

    Rings hold numbers of nodes in proportion to their radius, high degrees inside, at most one ring for
    each twelve nodes; within a ring communities lie together, from the top on.
    """
    from ..functions.stats import global_row_number

    nodes = materialise(nodes, "nodes")
    n = nodes.count()
    radii = [1 + gap * i for i in range(min(rings, max(1, n // 12)))]
    sizes = [max(1, round(n * r / sum(radii))) for r in radii[:-1]]
    cuts = [sum(sizes[: i + 1]) for i in range(len(sizes))]
    ranked = global_row_number(nodes, [F.col("degree").desc(), F.col("node")])
    out = ranked.withColumn("ring", sum(((F.col("rank") > c).cast("int") for c in cuts), F.lit(1)))
    by = Window.partitionBy("ring")
    out = out.withColumn("place", F.row_number().over(by.orderBy("community", F.col("degree").desc(), "node"))).withColumn("angle", 2 * F.pi() * (F.col("place") - 1) / F.count("*").over(by) + F.pi() / 2)
    radius = 1 + (F.col("ring") - 1) * gap
    return out.select("node", "ring", "place", "angle", (radius * F.cos("angle")).alias("x"), (radius * F.sin("angle")).alias("y"))


def compare_signed_sets(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row comparing two tables ``(source, target, sign)``: shared and own pairs, Jaccard, shared sources, agreement of signs."""
    x = a.groupBy("source", "target").agg(F.min("sign").alias("sa"), F.lit(1).alias("ia"))
    y = b.groupBy("source", "target").agg(F.min("sign").alias("sb"), F.lit(1).alias("ib"))
    j = x.join(y, ["source", "target"], "full_outer")
    both = F.col("ia").isNotNull() & F.col("ib").isNotNull()
    one = j.agg(
        F.count_if(both).alias("shared"), F.count_if(F.col("ib").isNull()).alias("only_a"), F.count_if(F.col("ia").isNull()).alias("only_b"), F.count_if(both & (F.col("sa") == F.col("sb"))).alias("sign_agree"), F.count_if(both & (F.col("sa") != F.col("sb"))).alias("sign_conflict")
    )
    sources = a.select("source").distinct().join(b.select("source").distinct(), "source", "left_semi").agg(F.count("*").alias("shared_sources"))
    return one.join(sources, F.lit(True)).withColumn("jaccard", F.col("shared") / (F.col("shared") + F.col("only_a") + F.col("only_b")))


def sign_conflicts(a: DataFrame, b: DataFrame, most: int = 20) -> DataFrame:
    """The first ``most`` pairs of which the two tables give opposite signs."""
    both = a.select("source", "target", F.col("sign").alias("sign_a")).join(b.select("source", "target", F.col("sign").alias("sign_b")), ["source", "target"])
    return both.where("sign_a <> sign_b").distinct().orderBy("source", "target").limit(most)

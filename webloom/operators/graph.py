"""Graph operators and PageRank.

Graphs are two tables: ``nodes(id long)`` and ``edges(src long, dst long)``.
Duplicate edges keep their weight (they count in the out-degree), as in the
reference.

PageRank plan:
  * links are counted to distinct weighted ones, then dealt to (src, salt)
    keys: a node with over ``salt_chunk`` distinct links gets several salts by
    a hash of dst, and its rank share is replicated once per salt, so a node
    holding a third of all links is split evenly over tasks;
  * the links are a table bucketed by (src, salt), which stays where it is: per
    iteration the small share table (a row per node and salt) moves to the links and is
    looked up in a hash table, without a sort; contributions are summed per dst with a
    map-side partial sum, so only shares and sums are shuffled;
  * the mass of nodes without links is one number, added as mass / N to every
    node (no scatter of N rows per such node);
  * links, degrees and each state are tables in the shared folder, so lineage
    stays short, a lost executor replays one iteration, and adaptive
    execution can split what is hot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from webloom.session import Scratch, shuffle_partitions

# Damping factor of the reference's rank update (fixed value).
DAMPING = 0.85
# Distinct links of one source that go by one key.
SALT_CHUNK = 1_000_000
# Buckets of the links at most (Spark's own limit).
MAX_BUCKETS = 100_000


# ---------------------------------------------------------------- structure
def edges_from_adjacency(lines: DataFrame, col: str = "value", sep: str = r"\s+") -> tuple[DataFrame, DataFrame]:
    """Parse adjacency lines ``src t1 t2 ...`` into (nodes, edges).

    The first token is the source; the rest are targets (none = dangling).
    Several lines for one source are unioned.  ``sep`` is a regex; the
    single-space variant of the reference is ``sep=' '``.
    """
    toks = lines.select(F.split(F.trim(F.col(col)), sep).alias("t")).filter(F.size("t") > 0) \
        .filter(F.col("t")[0] != "")
    parsed = toks.select(F.col("t")[0].cast("long").alias("src"),
                         F.slice("t", 2, F.greatest(F.size("t") - 1, F.lit(0))).alias("targets"))
    edges = parsed.select("src", F.explode("targets").alias("dst")) \
        .select("src", F.col("dst").cast("long").alias("dst"))
    nodes = parsed.select(F.col("src").alias("id")).union(edges.select(F.col("dst").alias("id"))).distinct()
    return nodes, edges


def weighted(edges: DataFrame) -> DataFrame:
    """(src, dst, w): each distinct link with the number of times it occurs.
    Counted map-side first, so repeats of one hot link are a row per task."""
    return edges.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("w"))


def adjacency_lines(edges: DataFrame, nodes: DataFrame | None = None,
                    max_targets: int = 100_000) -> DataFrame:
    """(src, chunk, targets, line) -- the adjacency text form, targets sorted.

    A source with more than ``max_targets`` links, repeats counted, is written as
    several lines (picked by a hash), which the reader unions back; a link that
    repeats more often than that is dealt to several of them.
    Degrees and links meet as plain tables, so a hot source can be split
    there; a repeated link is one weighted row until its line is written.
    Sources in ``nodes`` without links get a line holding only their id.
    """
    scratch = Scratch(edges.sparkSession, "adjacency")
    links = scratch.save(weighted(edges))
    deg = scratch.save(links.groupBy("src").agg(F.ceil(F.sum("w") / F.lit(max_targets)).cast("long").alias("_n")))
    most = F.lit(max_targets).cast("long")
    parts = links.withColumn("_i", F.explode(F.expr(f"sequence(0L, (w - 1) DIV {int(max_targets)})"))) \
        .withColumn("w", F.least(most, F.col("w") - F.col("_i") * most))
    keyed = parts.join(deg, "src").withColumn("chunk", F.pmod(F.xxhash64("dst", "_i"), F.col("_n")))
    each = F.array_repeat("dst", F.col("w").cast("int"))
    lists = keyed.groupBy("src", "chunk").agg(F.sort_array(F.flatten(F.collect_list(each))).alias("targets"))
    if nodes is not None:
        lonely = nodes.select(F.col("id").alias("src")).join(deg, "src", "left_anti") \
            .select("src", F.lit(0).cast("long").alias("chunk"),
                    F.array().cast("array<bigint>").alias("targets"))
        lists = lists.unionByName(lonely)
    words = F.concat(F.array(F.col("src").cast("string")),
                     F.transform("targets", lambda x: x.cast("string")))
    return lists.withColumn("line", F.array_join(words, " "))


def out_degree(edges: DataFrame) -> DataFrame:
    """(src, out_degree): number of links, duplicates counted."""
    return edges.groupBy("src").agg(F.count(F.lit(1)).alias("out_degree"))


def dangling_nodes(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Nodes with no outgoing link (anti join; no per-node scatter).  Sources
    are de-duplicated first (map-side), so a hot source is one row by the time
    it reaches the join."""
    return nodes.join(edges.select(F.col("src").alias("id")).distinct(), "id", "left_anti")


def all_nodes(nodes: DataFrame | None, edges: DataFrame) -> DataFrame:
    """Every id seen as a node, a source or a target (each starts with rank mass)."""
    ids = edges.select(F.col("src").alias("id")).union(edges.select(F.col("dst").alias("id")))
    if nodes is not None:
        ids = nodes.select("id").union(ids)
    return ids.distinct()


# ---------------------------------------------------------------- PageRank
def pagerank_init(nodes: DataFrame, num_nodes: int | None = None) -> DataFrame:
    """(id, rank) with the uniform start 1/N."""
    n = num_nodes if num_nodes is not None else nodes.count()
    return nodes.select("id", (F.lit(1.0) / F.lit(float(n))).alias("rank"))


def pagerank_contrib(ranks: DataFrame, edges: DataFrame, salt_chunk: int = SALT_CHUNK) -> DataFrame:
    """(dst, contrib): every distinct link carries w * rank(src) / out_degree(src)."""
    salted, deg = _salted_edges(edges, salt_chunk, Scratch(edges.sparkSession, "contrib"))
    state = _state(ranks, deg)
    return salted.join(_shares(state), ["src", "salt"]).select("dst", (F.col("share") * F.col("w")).alias("contrib"))


def pagerank_step(ranks: DataFrame, edges: DataFrame, num_nodes: int,
                  damping: float = DAMPING, salt_chunk: int = SALT_CHUNK) -> DataFrame:
    """One synchronous update: (1-d)/N + d * (sum of contributions + dangling mass / N)."""
    salted, deg = _salted_edges(edges, salt_chunk, Scratch(edges.sparkSession, "step"))
    return _step(_state(ranks, deg), salted, num_nodes, damping).select("id", "rank")


def _salted_edges(edges: DataFrame, salt_chunk: int, scratch: Scratch, buckets: int = 0) -> tuple[DataFrame, DataFrame]:
    """(src, salt, dst, w) and (src, out_degree, nsalt); the links in ``buckets``, if given.

    Links are counted to distinct weighted ones before anything is keyed by
    src; degrees are a plain table before links meet them, so adaptive
    execution splits a hot src there; then its links are dealt to ``nsalt``
    keys of about ``salt_chunk`` distinct links."""
    links = scratch.save(weighted(edges))
    deg = scratch.save(links.groupBy("src").agg(
        F.sum("w").alias("out_degree"), F.ceil(F.count(F.lit(1)) / F.lit(salt_chunk)).cast("int").alias("nsalt")))
    salted = links.join(deg.select("src", "nsalt"), "src").select(
        "src", F.pmod(F.xxhash64("dst"), F.col("nsalt")).cast("int").alias("salt"), "dst", "w")
    salted = scratch.save_bucketed(salted, buckets, "src", "salt") if buckets else scratch.save(salted)
    scratch.drop(links)
    return salted, deg


def _state(ranks: DataFrame, deg: DataFrame) -> DataFrame:
    return ranks.join(deg, ranks.id == deg.src, "left").select(
        "id", "rank", F.coalesce("out_degree", F.lit(0)).alias("out_degree"), F.coalesce("nsalt", F.lit(1)).alias("nsalt"))


def _dangling_mass():
    return F.coalesce(F.sum(F.when(F.col("out_degree") == 0, F.col("rank"))), F.lit(0.0))


def _shares(state: DataFrame) -> DataFrame:
    return state.filter(F.col("out_degree") > 0).select(
        F.col("id").alias("src"), (F.col("rank") / F.col("out_degree")).alias("share"),
        F.explode(F.sequence(F.lit(0), F.col("nsalt") - 1)).alias("salt"))


def _carried(salted: DataFrame, state: DataFrame) -> DataFrame:
    """Links with their source's share; a task holds the shares of its bucket."""
    return salted.join(_shares(state).hint("shuffle_hash"), ["src", "salt"])


def _step(state: DataFrame, salted: DataFrame, n: int, damping: float,
          dangling: float | None = None) -> DataFrame:
    """One update.  ``dangling`` (the rank mass of nodes without links) is a
    number the caller already has; otherwise a scalar subquery computes it."""
    sums = _carried(salted, state).groupBy("dst").agg(F.sum(F.col("share") * F.col("w")).alias("_in"))
    mass = state.agg(_dangling_mass()).scalar() if dangling is None else F.lit(float(dangling))
    nn = F.lit(float(n))
    new_rank = (F.lit(round(1.0 - damping, 12)) / nn
                + F.lit(damping) * (F.coalesce(F.col("_in"), F.lit(0.0)) + mass / nn))
    return state.join(sums, state.id == sums.dst, "left").select(
        "id", new_rank.alias("rank"), "out_degree", "nsalt")


def pagerank(edges: DataFrame, nodes: DataFrame | None = None, iterations: int = 5,
             damping: float = DAMPING, num_nodes: int | None = None,
             salt_chunk: int = SALT_CHUNK) -> DataFrame:
    """Ranks (id, rank) after a fixed number of iterations (no convergence test).

    Every node of ``nodes`` and every id seen in ``edges`` starts at 1/N and is
    always present; mass is conserved (ranks sum to 1).  ``num_nodes``
    overrides N.

    Links, degrees and each iteration's state (id, rank, degree; N rows, small
    next to the links) are tables in the shared folder; the state before the
    previous one is deleted, so at most two are left.  One job per iteration:
    the mass of nodes without links is observed while the state is written.
    """
    scratch = Scratch(edges.sparkSession, "pagerank")
    salted, deg = _salted_edges(edges, salt_chunk, scratch, min(MAX_BUCKETS, shuffle_partitions(edges.sparkSession)))
    ids = scratch.save(all_nodes(nodes, salted.select("src", "dst")))
    n = num_nodes if num_nodes is not None else ids.count()

    def written(state):
        seen = Observation()
        out = scratch.save(state.observe(seen, _dangling_mass().alias("mass")))
        return out, seen.get["mass"] or 0.0

    state, mass = written(_state(ids.select("id", (F.lit(1.0) / F.lit(float(n))).alias("rank")), deg))
    scratch.drop(ids, deg)
    for _ in range(iterations):
        old = state
        state, mass = written(_step(old, salted, n, damping, mass))
        scratch.drop(old)
    scratch.drop(salted)
    return state.select("id", "rank")


def ranked(ranks: DataFrame) -> DataFrame:
    """Total order by rank descending, ties by id (range-partitioned sort)."""
    return ranks.orderBy(F.desc("rank"), F.asc("id"))


def top_ranked(ranks: DataFrame, k: int = 10) -> DataFrame:
    """Top-k by rank (one bounded heap per task, then a k-row merge)."""
    return ranks.orderBy(F.desc("rank"), F.asc("id")).limit(k)

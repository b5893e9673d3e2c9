"""Mixing sources to target weights as a min-cost flow over membership patterns.

Documents are aggregated by the set of sources they belong to (their pattern). From each pattern flow its words, up to
``copies`` times: the first copy is free, each further one costs more, so that repetition is spread before it is
deepened. The flow goes to the sources of the pattern and ends in their quotas. It decides how many words each pattern
gives; the documents for them are chosen in a seeded order.
"""

from __future__ import annotations

from collections import deque

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kerbside.llm.store import materialize
from kerbside.llm.text import WORD

COPIES = 3
MOST_PATTERNS = 5_000  # rows of the driver's flow problem; more are refused
LEVEL = 12  # bits of the seeded order that one histogram resolves


def targets(sizes: dict[str | None, int], weights: dict[str | None, float], share: float = 1.0, copies: int = COPIES) -> dict[str | None, float]:
    """Words wanted of each source: ``share`` of all by weight, none above ``copies`` times its size; what is cut off is
    shared among the others by weight until none is above."""
    wanted = dict.fromkeys(sizes, 0.0)
    total, free = share * sum(sizes.values()), sum(weights[s] for s in sizes)
    if free:
        wanted = {s: total * weights[s] / free for s in sizes}
    capped: set = set()
    while above := [s for s in sizes if s not in capped and wanted[s] > copies * sizes[s]]:
        excess = sum(wanted[s] - copies * sizes[s] for s in above)
        capped.update(above)
        wanted |= {s: float(copies * sizes[s]) for s in above}
        rest = sum(weights[s] for s in sizes if s not in capped)
        for s in sizes:
            if s not in capped:
                wanted[s] += excess * weights[s] / rest
    return wanted


def rotating_weights(sources) -> dict[str | None, float]:
    """1, 2, 3, 1, ... for the sources in order of code points, null last."""
    ordered = sorted(sources, key=lambda s: (s is None, s or ""))
    return {s: float(i % 3 + 1) for i, s in enumerate(ordered)}


def min_cost_flow(capacity: dict[tuple, int], quota: dict, copies: int = COPIES) -> dict[tuple, int]:
    """Words that each pattern (a tuple of sources) gives in all, filling the quotas at the least cost of repetition.

    Successive shortest paths: every augmentation fills an arc, and the network has copies + sources arcs a pattern.
    """
    arcs: list[list] = []  # to, capacity left, cost; an arc and its reverse are neighbours
    out: dict = {}

    def arc(a, b, most, cost):
        for x, y, c, w in ((a, b, most, cost), (b, a, 0, -cost)):
            out.setdefault(x, []).append(len(arcs))
            arcs.append([y, c, w])

    begin = {}
    for pattern, words in capacity.items():
        begin[pattern] = len(arcs)
        for copy in range(copies):
            arc("from", ("pattern", pattern), words, copy * (copy + 1) // 2)
        for s in pattern:
            arc(("pattern", pattern), ("source", s), copies * words, 0)
    for s, most in quota.items():
        arc(("source", s), "to", most, 0)
    while True:
        cost, via, queue = {"from": 0}, {}, deque(["from"])
        while queue:
            x = queue.popleft()
            for i in out.get(x, ()):
                y, left, w = arcs[i]
                if left and cost[x] + w < cost.get(y, 1 << 60):
                    cost[y], via[y] = cost[x] + w, i
                    queue.append(y)
        if "to" not in cost:
            break
        path, x = [], "to"
        while x != "from":
            path.append(via[x])
            x = arcs[via[x] ^ 1][0]
        pushed = min(arcs[i][1] for i in path)
        for i in path:
            arcs[i][1] -= pushed
            arcs[i ^ 1][1] += pushed
    return {p: sum(arcs[i + 1][1] for i in range(at, at + 2 * copies, 2)) for p, at in begin.items()}


def plan(sized: DataFrame, weights=None, share: float = 1.0, copies: int = COPIES) -> tuple[dict, dict, dict]:
    """Sizes and targets of the sources, and words to take of each pattern, for ``sized(size, pattern)``.

    A source's size counts all documents that belong to it; the share is of the words of all documents.
    """
    rows = sized.groupBy("pattern").agg(F.sum("size").alias("size")).limit(MOST_PATTERNS + 1).collect()
    if len(rows) > MOST_PATTERNS:
        raise ValueError(f"more than {MOST_PATTERNS} membership patterns")
    capacity = {tuple(r.pattern): r["size"] or 0 for r in sorted(rows, key=lambda r: str(r.pattern))}
    sizes: dict = {}
    for pattern, words in capacity.items():
        for s in pattern:
            sizes[s] = sizes.get(s, 0) + words
    sizes = {s: sizes[s] for s in sorted(sizes, key=lambda s: (s is None, s or ""))}
    wanted = targets(sizes, weights or rotating_weights(sizes), share * sum(capacity.values()) / max(1, sum(sizes.values())), copies)
    return sizes, wanted, min_cost_flow(capacity, {s: round(w) for s, w in wanted.items()}, copies)


def cut_points(sized: DataFrame, flow: dict, capacity: dict) -> DataFrame:
    """What ``with_copies`` needs of each pattern to take whole copies of documents whose words sum up to nearly the flow.

    One row for each pattern of ``sized(pattern_key, size, h)``. All documents of a pattern are taken as often as the flow
    holds the pattern's words; those first in the seeded order ``h`` once more, until the rest is filled. The end of these is found by histograms of ``h``, each of which resolves
    12 bits, and by the order of the few rows that are left in one cell, so that no pattern is ever ordered in one task.
    One further document, that whose size is nearest to the words still missing, closes the gap.
    """
    spark = sized.sparkSession
    rows = []
    for key, words in flow.items():
        whole, rest = divmod(words, capacity[key]) if capacity[key] else (0, 0)
        rows.append((key, whole, rest))
    decided = F.broadcast(spark.createDataFrame(rows, "pattern_key string, whole long, rest long"))  # at most MOST_PATTERNS rows
    part = sized.join(decided, "pattern_key")
    cut = spark.createDataFrame([(k, 0, 0) for k, _, _ in rows], "pattern_key string, base long, before long")
    for level in (1, 2):
        slot = F.shiftrightunsigned("h", 64 - level * LEVEL)
        cells = part.groupBy("pattern_key", slot.alias("slot")).agg(F.sum("size").alias("words"), F.first("rest").alias("rest"))
        cells = cells.join(F.broadcast(cut), "pattern_key")
        upto = Window.partitionBy("pattern_key").orderBy("slot")  # at most 4096 cells each
        cells = cells.withColumn("upto", F.col("before") + F.sum("words").over(upto))
        cut = cells.where("upto > rest").groupBy("pattern_key").agg(F.min_by(F.struct("slot", (F.col("upto") - F.col("words")).alias("before")), "slot").alias("c"))
        cut = materialize(cut.select("pattern_key", F.col("c.slot").alias("base"), F.col("c.before").alias("before")), "cut")
        at = cut.select(F.col("pattern_key"), F.col("base").alias("slot"))
        part = part.withColumn("slot", slot).join(F.broadcast(at), ["pattern_key", "slot"]).drop("slot")
    units = part.groupBy("pattern_key", "h").agg(F.sum("size").alias("words"), F.first("rest").alias("rest")).join(F.broadcast(cut), "pattern_key")
    low = F.col("h").bitwiseAND((1 << (64 - 2 * LEVEL)) - 1)
    units = units.withColumn("upto", F.col("before") + F.sum("words").over(Window.partitionBy("pattern_key").orderBy(low)))
    ends = units.groupBy("pattern_key").agg(
        F.max("base").alias("cell"), F.max(F.when(F.col("upto") <= F.col("rest"), low)).alias("last"),
        F.max(F.when(F.col("upto") <= F.col("rest"), F.col("upto"))).alias("filled"), F.max("before").alias("before"),
    )
    ends = materialize(ends.select("pattern_key", "cell", F.coalesce("last", F.lit(-1)).alias("last"), F.coalesce("filled", "before").alias("filled")), "ends")
    points = decided.join(ends, "pattern_key", "left")
    marked = sized.join(F.broadcast(points), "pattern_key")
    left = marked.where(~_chosen() & (F.col("rest") > 0)).groupBy("pattern_key", "h").agg(F.sum("size").alias("words"), F.first(F.col("rest") - F.col("filled")).alias("gap"))
    left = left.where("words < 2 * gap").groupBy("pattern_key").agg(F.min_by("h", F.struct(F.abs(F.col("words") - F.col("gap")), "h")).alias("closing"))
    return materialize(points.join(left, "pattern_key", "left"), "points")


def _chosen():
    """Whether a row is taken once more, in the seeded order; a pattern without an end is taken whole."""
    cell = F.shiftrightunsigned("h", 64 - 2 * LEVEL)
    low = F.col("h").bitwiseAND((1 << (64 - 2 * LEVEL)) - 1)
    return F.coalesce((cell < F.col("cell")) | ((cell == F.col("cell")) & (low <= F.col("last"))), F.lit(True)) & (F.col("rest") > 0)


def with_copies(rows: DataFrame, points: DataFrame) -> DataFrame:
    """``rows(pattern_key, h)`` with ``copies``, decided where the rows are: at most MOST_PATTERNS cut points are broadcast."""
    more = _chosen() | F.coalesce(F.col("h") == F.col("closing"), F.lit(False))
    marked = rows.join(F.broadcast(points), "pattern_key")
    return marked.withColumn("copies", F.col("whole") + more.cast("long")).drop(*(c for c in points.columns if c != "pattern_key"))


def sized_rows(docs: DataFrame, membership, seed: int, *carried: str) -> DataFrame:
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    rows = docs.select("doc_id", membership.alias("pattern"), size.alias("size"), *carried)
    return rows.select("*", F.to_json(F.struct("pattern"), {"ignoreNullFields": "false"}).alias("pattern_key"), F.xxhash64(F.lit(seed), "doc_id", "size", "pattern").alias("h"))


def _mixed(docs: DataFrame, membership, weights, share, copies, seed):
    sized = materialize(sized_rows(docs, membership, seed), "sized")
    sizes, wanted, flow = plan(sized, weights, share, copies)
    rows = sized.groupBy("pattern_key", "pattern").agg(F.sum("size").alias("size")).collect()  # at most MOST_PATTERNS
    keys = {r.pattern_key: tuple(r.pattern) for r in rows}
    points = cut_points(sized, {k: flow[p] for k, p in keys.items()}, {r.pattern_key: r["size"] for r in rows})
    return sized, points, sizes, wanted


def mix(docs: DataFrame, weights: dict | None = None, share: float = 1.0, copies: int = COPIES, seed: int = 17) -> DataFrame:
    """``doc_id``, ``size``, ``source_size``, ``target``, ``taken`` and ``copies`` of every row of ``docs(doc_id, text, source)``.

    ``size`` is the number of words; ``taken`` = copies * size. A null source is a source of its own and the last in
    order; a null text has no words. Rows that agree in doc_id, size and source are taken alike, so the seeded order has
    no ties that matter, and reruns agree. Other columns are not looked at; an empty table gives no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("source").cast("string").alias("source"))
    sized, points, sizes, wanted = _mixed(docs, F.array("source"), weights, share, copies, seed)
    told = docs.sparkSession.createDataFrame([(s, sizes[s], wanted[s]) for s in sizes], "source string, source_size long, target double")
    rows = with_copies(sized, points).withColumn("of", F.col("pattern")[0]).join(F.broadcast(told), F.col("of").eqNullSafe(F.col("source")))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


def mixed_documents(docs: DataFrame, weights: dict | None = None, share: float = 1.0, copies: int = COPIES, seed: int = 17) -> DataFrame:
    """The rows of ``docs``, each as many times as the mix takes it; columns are those of ``docs``."""
    rows = docs.select(F.struct("*").alias("row"))
    plain = rows.select(*(F.col(f"row.{c}").cast(kind).alias(c) for c, kind in (("doc_id", "long"), ("text", "string"), ("source", "string"))), "row")
    _, points, _, _ = _mixed(plain.drop("row"), F.array("source"), weights, share, copies, seed)
    taken = with_copies(sized_rows(plain, F.array("source"), seed, "row"), points).where("copies > 0")
    each = taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return each.select(*(F.col("row")[c].alias(c) for c in docs.columns))

"""Mixing overlapping sources to target weights by min-cost flow.

Documents are aggregated by membership pattern (the set of sources they belong to). Each pattern offers
its words once at a low cost and once more at a higher one (convex repetition costs); each source asks
for its target. The flow of least cost routes pattern words to source quotas, and each pattern's flow
selects documents in a seeded order, whole documents only. Documents above the pattern's mean size come first,
the smaller ones fill what is missing, so that the words taken miss the flow by half a mean document at
most (unless the smaller ones are too few to make up for it).

The driver holds one row a pattern, at most ``max_patterns`` (a checked bound, more is an error), never
documents. A pattern with a third of all rows is spread over many tasks by the seeded order.

Defined results: a null or empty text has 0 words; a null source is a source of its own, last in order;
an empty table gives an empty result; equal rows are separate documents with neighbouring places; a
source without words has target 0; other columns are ignored.
"""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dwspark.llm.ranks import running_total
from dwspark.llm.tables import SPACES, save

WEIGHTS = (3, 1, 2)
SHARE_PERCENT = 150
MAX_USES = 2
SEED = 20240229
MAX_PATTERNS = 100_000


def targets(sizes: Sequence[int], weights: Sequence[float], total: float, most: float = MAX_USES) -> list[float]:
    """Shares of ``total`` by weight; a share stops at ``most`` times its size and the excess is shared
    again by weight among the others until none is above."""
    out, open_, left = [0.0] * len(sizes), set(range(len(sizes))), float(total)
    while open_:
        weight = sum(weights[i] for i in sorted(open_))
        over = [i for i in sorted(open_) if left * weights[i] / weight > most * sizes[i]]
        if not over:
            for i in open_:
                out[i] = left * weights[i] / weight
            break
        for i in over:
            out[i] = float(most * sizes[i])
            left -= out[i]
            open_.discard(i)
    return out


def route(supply: Sequence[int], members: Sequence[Sequence[int]], quota: Sequence[int], costs: Sequence[int]) -> list[dict[int, int]]:
    """Flow of each pattern to each of its sources: the greatest total, at the least cost, when use
    number ``k`` of a pattern's words costs ``costs[k]`` a word (rising). Successive cheapest paths."""
    p, s = len(supply), len(quota)
    start, end = p + s, p + s + 1
    arcs: list[list[int]] = []  # [to, free, cost]; arc i ^ 1 is the reverse
    out: list[list[int]] = [[] for _ in range(p + s + 2)]

    def arc(a: int, b: int, free: int, cost: int) -> None:
        out[a].append(len(arcs))
        arcs.append([b, free, cost])
        out[b].append(len(arcs))
        arcs.append([a, 0, -cost])

    for i, words in enumerate(supply):
        for cost in costs:
            arc(start, i, words, cost)
    first = len(arcs)
    pairs = [(i, j) for i in range(p) for j in members[i]]
    for i, j in pairs:
        arc(i, p + j, supply[i] * len(costs), 0)
    for j, words in enumerate(quota):
        arc(p + j, end, words, 0)
    while True:
        far, via, waiting = {start: 0}, {}, deque([start])
        while waiting:
            a = waiting.popleft()
            for k in out[a]:
                b, free, cost = arcs[k]
                if free and far[a] + cost < far.get(b, 1 << 60):
                    far[b], via[b] = far[a] + cost, k
                    waiting.append(b)
        if end not in far:
            break
        path, at = [], end
        while at != start:
            path.append(via[at])
            at = arcs[via[at] ^ 1][0]
        step = min(arcs[k][1] for k in path)
        for k in path:
            arcs[k][1] -= step
            arcs[k ^ 1][1] += step
    flow: list[dict[int, int]] = [{} for _ in range(p)]
    for n, (i, j) in enumerate(pairs):
        if used := arcs[first + 2 * n + 1][1]:
            flow[i][j] = used
    return flow


def mix(
    docs: DataFrame, members: Column, size: Column, weights: Sequence[float] = WEIGHTS, share_percent: int = SHARE_PERCENT,
    max_uses: int = MAX_USES, seed: int = SEED, max_patterns: int = MAX_PATTERNS,
) -> DataFrame:
    """doc_id, ``members`` (array of source names), ``size``, ``uses`` (array of the sources that take
    the document, one entry a use), ``taken`` words, and ``source_size`` and ``target`` of the first
    member. Weights repeat over the sources in code point order, null last."""
    spark = docs.sparkSession
    rows = save(docs.select("doc_id", F.sort_array(F.array_distinct(members)).alias("members"), size.cast("long").alias("size")), "sizes")
    rows = rows.withColumn("pattern", F.to_json("members"))
    found = rows.groupBy("pattern").agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("n")).limit(max_patterns + 1).collect()
    if len(found) > max_patterns:
        raise ValueError(f"more than {max_patterns} membership patterns")
    found = sorted((r["pattern"], r["words"], r["words"] // r["n"]) for r in found)
    sets = [json.loads(pattern) for pattern, _, _ in found]
    names = sorted({x for m in sets for x in m}, key=lambda x: (x is None, x or ""))
    place = {x: i for i, x in enumerate(names)}
    member_of = [sorted(place[x] for x in m) for m in sets]
    supply = [words for _, words, _ in found]
    sizes = [0] * len(names)
    for words, m in zip(supply, member_of):
        for j in m:
            sizes[j] += words
    want = targets(sizes, [weights[i % len(weights)] for i in range(len(names))], sum(supply) * share_percent / 100, max_uses)
    flow = route(supply, member_of, [round(t) for t in want], [2 * k + 1 for k in range(max_uses)])

    # Documents above their pattern's mean size are selected first, for their share of the flow; the
    # smaller ones then make up for the words by which whole documents missed it.
    about = spark.createDataFrame(
        [(pattern, mean, sizes[m[0]] if m else 0, want[m[0]] if m else 0.0) for (pattern, _, mean), m in zip(found, member_of)],
        "pattern string, _mean long, source_size long, target double")
    # At most max_patterns rows are broadcast, here and below.
    rows = rows.join(F.broadcast(about), "pattern").withColumn("_large", F.col("size") > F.col("_mean"))
    rows = rows.withColumn("_stratum", F.concat(F.when(F.col("_large"), "L").otherwise("S"), "pattern")).withColumn("_seeded", F.xxhash64(F.lit(seed), "doc_id"))
    ordered = running_total(rows, "_stratum", ["_seeded", "doc_id", "size"], "size", "_before")
    large_words = {r["pattern"]: r["words"] for r in rows.where("_large").groupBy("pattern").agg(F.sum("size").alias("words")).collect()}

    def used(part: DataFrame, plan: list[tuple[str, int, dict[int, int]]]) -> DataFrame:
        """Use k of a document lies at k * words + before; the source whose range holds its middle takes
        it. plan: pattern, its words, the words that each source takes, one range after the other."""
        table = []
        for pattern, words, taken in plan:
            at, ranges = 0, []
            for j in sorted(taken):
                ranges.append((names[j], at, at + max(0, taken[j])))
                at += max(0, taken[j])
            table.append((pattern, words, ranges))
        plan_df = spark.createDataFrame(table, "pattern string, _words long, _ranges array<struct<source:string,lo:long,hi:long>>")
        joined = part.join(F.broadcast(plan_df), "pattern")
        middle = lambda k: (k * F.col("_words") + F.col("_before")) * 2 + F.col("size")
        uses = F.transform(F.sequence(F.lit(0), F.lit(max_uses - 1)), lambda k: F.filter(
            "_ranges", lambda x: (middle(k) >= x["lo"] * 2) & (middle(k) < x["hi"] * 2) & (F.col("size") > 0)))
        return joined.withColumn("uses", F.transform(F.flatten(uses), lambda x: x["source"])).drop("_words", "_ranges")

    share = [(pattern, large_words.get(pattern, 0), {j: v * large_words.get(pattern, 0) // max(words, 1) for j, v in f.items()})
             for (pattern, words, _), f in zip(found, flow)]
    large = used(ordered.where("_large"), share)
    got = {(r["pattern"], r["source"]): r["words"] for r in large.select("pattern", "size", F.explode("uses").alias("source"))
           .groupBy("pattern", "source").agg(F.sum("size").alias("words")).collect()}
    rest = [(pattern, words - large_words.get(pattern, 0), {j: v - got.get((pattern, names[j]), 0) for j, v in f.items()})
            for (pattern, words, _), f in zip(found, flow)]
    out = large.unionByName(used(ordered.where(~F.col("_large")), rest))
    return out.select("doc_id", "members", "size", "uses", (F.size("uses") * F.col("size")).alias("taken"), "source_size", "target")


def word_count(text: Column) -> Column:
    """Number of words. Runs of spaces are replaced by one mark, which is cheaper than keeping words."""
    t = F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")
    spaces = F.length(t) - F.length(F.replace(t, F.lit(" "), F.lit("")))
    return F.when(F.trim(t) == "", 0).otherwise(spaces + 1 - F.startswith(t, F.lit(" ")).cast("int") - F.endswith(t, F.lit(" ")).cast("int"))


def mix_documents(docs: DataFrame) -> DataFrame:
    return mix(docs, F.array("source"), word_count(F.col("text")))


def query(docs: DataFrame) -> DataFrame:
    return mix_documents(docs).select("doc_id", "size", "source_size", "target", "taken", F.col("members")[0].alias("source"), F.size("uses").alias("n_uses"))


def keep_mixed(docs: DataFrame) -> DataFrame:
    """The documents of the mix with the input's columns, each as often as the mix uses it."""
    # Rows get a number of their own, as ids may repeat; writing it down makes it last.
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    rows = save(docs.select(F.monotonically_increasing_id().alias("doc_id"), "source", word_count(F.col("text")).alias("size"), row), "numbered")
    uses = mix(rows, F.array("source"), F.col("size")).where(F.size("uses") > 0).select("doc_id", "uses")
    return rows.select("doc_id", "_row").join(uses, "doc_id").select("_row", F.explode("uses")).select("_row.*")

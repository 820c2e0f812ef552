"""Merkle dataset manifest with lag and lead windows.

Every row is a leaf. Per group (source) the leaves are ordered and, level by level, every ``FANOUT`` consecutive nodes
become one; the groups' roots, in group order, are the leaves of one more such tree. At each level the
siblings of a node are the lag and lead columns at the fixed offsets 1 to ``FANOUT - 1``, masked by the node's slot
in its run and by the run's length; the first child of each run hashes the parent.

The window's partition is one run (``FANOUT`` rows), so a group with a third of all rows is as many tasks as any
other. Positions come from a range sort (:func:`running_total`), level ``k`` has 1/16 of the rows of level
``k - 1``, and proofs go down the same levels by one equi-join each, on the key that the window has already
shuffled by. The driver holds only the number of levels.

Encoding: a leaf is the lowercase hex SHA-256 of its fields one after the other, ``-`` for a null, otherwise the UTF-8
byte count, ``:`` and the value; a parent is that of its children's hex texts.

Defined results: a null group is a group of its own and comes first; a null key sorts first and is never
tampered with; repeated rows are separate leaves, equal keys are ordered by their leaves; a tree of one leaf is
its own root and has an empty proof (the hash of the empty string); a text without capital letters verifies
after tampering, since nothing changes; an empty table gives an empty manifest; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dwspark.llm.ranks import running_total
from dwspark.llm.tables import save

FANOUT = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
STEP = "struct<left:string,right:string>"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def positions(rows: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``pos`` (from 0 in the group, by ``order``) and the group's size ``n``."""
    rows = save(running_total(rows.withColumn("_one", F.lit(1).cast("long")), group, list(order), "_one", "pos").drop("_one"), "positions")
    return rows.join(rows.groupBy(group).agg(F.count(F.lit(1)).alias("n")), group)


def with_siblings(nodes: DataFrame, group: str) -> DataFrame:
    """``nodes`` (group, pos, n, digest) with the digests ``left`` and ``right`` of them in their run, joined."""
    slot = F.col("pos") % FANOUT
    length = F.least(F.lit(FANOUT), F.col("n") - F.col("pos") + slot)
    run = Window.partitionBy(group, "run").orderBy("pos")
    before = [F.when(slot >= k, F.lag("digest", k).over(run)) for k in range(FANOUT - 1, 0, -1)]
    after = [F.when(slot + k < length, F.lead("digest", k).over(run)) for k in range(1, FANOUT)]
    nodes = nodes.withColumn("run", F.floor(F.col("pos") / FANOUT))
    return nodes.withColumns({"left": F.concat_ws("", *before), "right": F.concat_ws("", *after)})


def levels(leaves: DataFrame, group: str) -> list[DataFrame]:
    """The nodes (group, pos, n, digest) of each level; a group's last node is its root and goes no higher. The
    first level is ``leaves`` with all its columns."""
    found = [leaves]
    while not found[-1].where("n > 1").isEmpty():
        children = with_siblings(found[-1].where("n > 1").select(group, "pos", "n", "digest"), group)
        parents = children.where(F.col("pos") % FANOUT == 0).select(
            group, F.col("run").alias("pos"), F.ceil(F.col("n") / FANOUT).alias("n"), digest("digest", "right").alias("digest"))
        found.append(save(parents, "level"))
    return found


def roots(found: Sequence[DataFrame], group: str) -> DataFrame:
    """group, root."""
    tops = [x.where("n = 1").select(group, F.col("digest").alias("root")) for x in found]
    out = tops[0]
    for top in tops[1:]:
        out = out.unionByName(top)
    return out


def with_paths(found: Sequence[DataFrame], group: str, above: DataFrame) -> DataFrame:
    """The leaves with ``path``, their siblings (left, right) of every level from the leaf up, and the columns of
    ``above`` (group, path and others): what goes on from each group's root. Paths go down level by level; each
    level's nodes meet their parents' paths on the partitioning that their windows need, so that whole paths
    are never shuffled but for the sixteenth part that the level above holds."""
    carried = [c for c in above.columns if c != group]
    down: DataFrame | None = None
    for number in range(len(found) - 1, -1, -1):
        nodes = found[number]
        here = nodes.where("n = 1").join(above, group).select(*nodes.columns, *carried)
        if down is not None:
            parents = down.select(group, F.col("pos").alias("run"), *carried)
            inner = with_siblings(nodes.where("n > 1"), group).join(parents, [group, "run"])
            longer = F.concat(F.array(F.struct("left", "right")), "path").alias("path")
            here = here.unionByName(inner.select(*nodes.columns, *[longer if c == "path" else c for c in carried]))
        down = save(here, "paths") if number else here
    return down


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path give."""
    return F.aggregate(path, leaf, lambda node, step: digest(step["left"], node, step["right"]))


def proof(path: Column) -> Column:
    return F.sha2(F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), ""), 256)


def manifest(rows: DataFrame, fields: Sequence[str] = FIELDS, group: str = "source", key: str = "doc_id", changed: dict[str, Column] | None = None) -> DataFrame:
    """One row per input row: ``key``, ``leaf``, its group's ``subroot``, the dataset's ``root``, its ``path`` and
    ``changed_leaf``, the leaf when the columns ``changed`` take the place of their fields."""
    changed = changed or {}
    fields_now = [field(F.col(f)) for f in fields]
    fields_then = [field(changed.get(f, F.col(f))) for f in fields]
    leaves = save(rows.select(
        F.col(key).alias("_key"), F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")).alias("_group"),
        digest(*fields_now).alias("digest"), (digest(*fields_then) if changed else F.lit(None).cast("string")).alias("changed_leaf")), "digests")
    leaves = save(positions(leaves, "_group", ["_key", "digest"]), "leaves")
    within = levels(leaves, "_group")
    tops = save(roots(within, "_group").select("_group", F.col("root").alias("digest"), F.lit("").alias("_all")), "subroots")
    groups = save(positions(tops, "_all", ["_group"]), "groups")
    across = levels(groups, "_all")
    whole = roots(across, "_all").select("_all", "root", F.array().cast(f"array<{STEP}>").alias("path"))  # one row
    above = save(with_paths(across, "_all", whole).select("_group", "path", F.col("digest").alias("subroot"), "root"), "group-paths")
    out = with_paths(within, "_group", above)
    return out.select(F.col("_key").alias(key), F.col("digest").alias("leaf"), "changed_leaf", "subroot", "root", "path")


def query(docs: DataFrame) -> DataFrame:
    tampered = F.coalesce(F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 5 == 0, F.lit(False))
    out = manifest(docs, changed={"text": F.when(tampered, F.translate("text", UPPER, LOWER)).otherwise(F.col("text"))})
    folded = fold(F.col("changed_leaf"), F.col("path"))
    return out.select("doc_id", "leaf", "subroot", "root", proof(F.col("path")).alias("proof_sha256"), folded.alias("folded_root")).withColumn(
        "verified", F.col("folded_root") == F.col("root"))


def sql() -> str:
    encoded = lambda f: f"coalesce(strlen({f}::VARCHAR)::VARCHAR || ':' || {f}::VARCHAR, '-')"
    plain = " || ".join(encoded(f) for f in FIELDS)
    lowered = f"translate(text, '{UPPER}', '{LOWER}')"
    other = " || ".join(encoded(lowered if f == "text" else f) for f in FIELDS)
    crc = """list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(range(1, length(doc_id::VARCHAR) + 1),
        lambda i: [ascii(substr(doc_id::VARCHAR, i, 1))::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
        lambda c, x: xor(xor(c, x) >> 1, CASE WHEN xor(c, x) & 1 = 1 THEN 3988292384 ELSE 0 END))"""
    return f"""
WITH RECURSIVE leaves AS (
    SELECT doc_id, coalesce('=' || source, '') AS g, sha256({plain}) AS leaf,
        CASE WHEN doc_id IS NOT NULL AND xor({crc}, 4294967295) % 5 = 0 THEN sha256({other}) ELSE sha256({plain}) END AS changed
    FROM documents),
placed AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY g) AS n FROM leaves),
inner_nodes AS (
    SELECT 0 AS lev, g, pos, n, leaf AS digest FROM placed
    UNION ALL
    SELECT lev + 1, g, pos // {FANOUT}, any_value((n + {FANOUT - 1}) // {FANOUT}), sha256(string_agg(digest, '' ORDER BY pos))
    FROM inner_nodes WHERE n > 1 GROUP BY lev, g, pos // {FANOUT}),
tops AS (SELECT g, digest AS subroot, row_number() OVER (ORDER BY g) - 1 AS pos, count(*) OVER () AS n FROM inner_nodes WHERE n = 1),
outer_nodes AS (
    SELECT 0 AS lev, pos, n, subroot AS digest FROM tops
    UNION ALL
    SELECT lev + 1, pos // {FANOUT}, any_value((n + {FANOUT - 1}) // {FANOUT}), sha256(string_agg(digest, '' ORDER BY pos))
    FROM outer_nodes WHERE n > 1 GROUP BY lev, pos // {FANOUT}),
every AS (SELECT 0 AS part, lev, g, pos, n, digest FROM inner_nodes UNION ALL SELECT 1, lev, '', pos, n, digest FROM outer_nodes),
sides AS (
    SELECT part, lev, g, pos,
        string_agg(digest, '') OVER (PARTITION BY part, lev, g, pos // {FANOUT} ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before,
        string_agg(digest, '') OVER (PARTITION BY part, lev, g, pos // {FANOUT} ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS after
    FROM every),
climb AS (
    SELECT row_number() OVER () AS id, doc_id, leaf, g, 0 AS part, 0 AS lev, pos, n, changed AS node, '' AS proof FROM placed
    UNION ALL
    SELECT c.id, c.doc_id, c.leaf, c.g,
        CASE WHEN c.n = 1 THEN 1 ELSE c.part END, CASE WHEN c.n = 1 THEN 0 ELSE c.lev + 1 END,
        CASE WHEN c.n = 1 THEN t.pos ELSE c.pos // {FANOUT} END, CASE WHEN c.n = 1 THEN t.n ELSE (c.n + {FANOUT - 1}) // {FANOUT} END,
        CASE WHEN c.n = 1 THEN c.node ELSE sha256(coalesce(s.before, '') || c.node || coalesce(s.after, '')) END,
        CASE WHEN c.n = 1 THEN c.proof ELSE c.proof || coalesce(s.before, '') || coalesce(s.after, '') END
    FROM climb c JOIN tops t ON t.g = c.g
    LEFT JOIN sides s ON s.part = c.part AND s.lev = c.lev AND s.pos = c.pos AND (c.part = 1 OR s.g = c.g)
    WHERE c.part = 0 OR c.n > 1)
SELECT c.doc_id, c.leaf, t.subroot, r.digest AS root, sha256(c.proof) AS proof_sha256, c.node AS folded_root, c.node = r.digest AS verified
FROM climb c JOIN tops t ON t.g = c.g CROSS JOIN (SELECT digest FROM outer_nodes WHERE n = 1) r
WHERE c.part = 1 AND c.n = 1"""

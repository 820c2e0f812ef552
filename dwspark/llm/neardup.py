"""MinHash near-duplicates by a multi-index Hamming join.

Every text's set of five-word shingles is summarised by 40 MinHash symbols of 16 bits, packed four to a
chunk into ten numbers. Two signatures at a symbol distance of at most 19 have, by the pigeonhole
principle, a chunk with at most one wrong symbol, so each chunk is indexed four times, with one symbol
masked each time: equal masked chunks meet in a bucket, and all pairs under that distance share one.
A pair of Jaccard similarity 0.75 misses all buckets with a probability below 2e-6. Pairs are confirmed
on the full sets.

Equal sets are collapsed first. Buckets of up to ``small`` sets compare all their pairs (a pair goes on
when its distance is at most ``reach``). In larger buckets each set is first confirmed against one
central member; if a bucket then still holds several components, its sets go through an exact prefix
join on rarest shingles with length and position bounds, so no link is lost and no bucket emits all its
pairs. Candidates inside one component are not confirmed again, as they cannot change it.

Defined results: null and empty texts and texts without words have no shingles and are linked with
nothing; fewer than five words make one shingle of the whole sequence; equal rows, and repeated ids,
are copies of each other; an empty table gives an empty result; other columns are ignored by
:func:`link` and kept by :func:`keep_first`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwspark.llm.components import components
from dwspark.llm.tables import save
from dwspark.llm.textbytes import chunks, column, mix, shingle_sets

WIDTH = 5
PERCENT = 75
CHUNKS, PER_CHUNK = 10, 4
REACH = 24  # symbols of 40 that may differ; a pair at 0.75 exceeds it with a probability near 1e-6
SMALL = 32
_seeds = np.random.default_rng(11).integers(0, 1 << 64, (2, CHUNKS * PER_CHUNK), dtype=np.uint64)
SIGNATURE = [f"s{i}" for i in range(CHUNKS)]


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = column(batch.column("text"))
        for i, j in chunks(offsets):
            part = offsets[i:j + 1]
            grams, at = shingle_sets(data[part[0]:part[-1]], part, WIDTH)
            size = np.diff(at)
            full = np.flatnonzero(size)
            signature = np.zeros((CHUNKS, j - i), np.uint64)
            sums = np.zeros((2, j - i), np.uint64)
            if len(full):
                starts = at[full]
                for k in range(CHUNKS * PER_CHUNK):
                    low = np.minimum.reduceat(mix_one(grams, k), starts)
                    signature[k // PER_CHUNK, full] |= (mix(low) & np.uint64(0xFFFF)) << np.uint64(16 * (k % PER_CHUNK))
                sums[0, full] = np.add.reduceat(mix(grams ^ _seeds[0, 0]), starts)
                sums[1, full] = np.add.reduceat(mix(grams ^ _seeds[0, 1]), starts)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(i, j - i), pa.array(size.astype(np.int64)),
                 *[pa.array(x.view(np.int64)) for x in (*sums, *signature)]],
                ["doc_id", "n", "c1", "c2", *SIGNATURE])


def mix_one(h: np.ndarray, k: int) -> np.ndarray:
    """The k-th of the hash functions whose minima make the signature."""
    h = (h ^ _seeds[0, k]) * (_seeds[1, k] | np.uint64(1))
    return h ^ (h >> np.uint64(29))


def _equal_symbols(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Equal 16-bit symbols of two arrays of signatures (rows x chunks)."""
    return (x.view(np.uint16).reshape(len(x), -1) == y.view(np.uint16).reshape(len(y), -1)).sum(axis=1)


def _near_in_bucket(small: int, reach: int):
    symbols = CHUNKS * PER_CHUNK

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tail = None
        for pdf in batches:
            held = 0 if tail is None else len(tail)
            pdf = pdf if tail is None else pd.concat([tail, pdf], ignore_index=True)
            key, rep = pdf["key"].to_numpy(), pdf["rep"].to_numpy()
            signature = np.ascontiguousarray(pdf[SIGNATURE].to_numpy(np.int64))
            found = []
            for lag in range(1, small):
                at = np.flatnonzero(key[lag:] == key[:-lag])
                at = at[at + lag >= held]  # pairs inside the tail were seen before
                if not len(at):
                    if lag > len(key) or not held:
                        break
                    continue
                same = _equal_symbols(signature[at], signature[at + lag])
                ok = same >= symbols - reach
                found.append(pd.DataFrame({"a": np.minimum(rep[at], rep[at + lag])[ok], "b": np.maximum(rep[at], rep[at + lag])[ok], "same": same[ok]}))
            if found:
                yield pd.concat(found).drop_duplicates(["a", "b"])
            tail = pdf.iloc[-(small - 1):]

    return run


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=3).compress
    for batch in batches:
        texts = batch.column("text").cast(pa.large_binary())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([pack(x.as_py() or b"") for x in texts], pa.binary())], ["rep", "packed"])


def _unpacked(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    unpack = zstandard.ZstdDecompressor().decompress
    texts = [unpack(x.as_py()) for x in array]
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(x) for x in texts], out=offsets[1:])
    return np.frombuffer(b"".join(texts), np.uint8), offsets


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                x, xo = shingle_sets(*_unpacked(part.column("pa")), WIDTH)
                y, yo = shingle_sets(*_unpacked(part.column("pb")), WIDTH)
                linked = []
                for i in range(part.num_rows):
                    one, two = x[xo[i]:xo[i + 1]], y[yo[i]:yo[i + 1]]
                    common = len(one) + len(two) - len(np.union1d(one, two))
                    linked.append(100 * common >= percent * (len(one) + len(two) - common))
                yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b")], ["a", "b"]).filter(pa.array(linked))

    return run


def _confirmed(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    both = pairs.select("a", "b").join(texts.select(F.col("rep").alias("a"), F.col("packed").alias("pa")), "a").join(
        texts.select(F.col("rep").alias("b"), F.col("packed").alias("pb")), "b")
    return save(both.mapInArrow(_confirm(percent), "a long, b long"), "links")


def _shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            part = batch.slice(at, 64)
            grams, offsets = shingle_sets(*_unpacked(part.column("packed")), WIDTH)
            size = np.diff(offsets)
            rep = np.repeat(part.column("rep").to_numpy(), size)
            for i in range(0, len(grams), 100_000):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rep[i:i + 100_000]), pa.array(grams[i:i + 100_000].view(np.int64)), pa.array(np.repeat(size, size)[i:i + 100_000])],
                    ["rep", "gram", "n"])


def _prefix_pairs(texts: DataFrame, labelled: DataFrame, percent: int) -> DataFrame:
    """Pairs with different labels that can reach the similarity, exactly: of two such sets, ordered by
    (frequency, shingle), the first ``n - ceil(percent * n) + 1`` shingles have one in common, and
    what follows it must be long enough for the overlap that the similarity needs."""
    grams = save(texts.join(labelled.select("rep"), "rep", "left_semi").mapInArrow(_shingles, "rep long, gram long, n long"), "grams")
    often = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("often")).where("often > 1")
    ranked = grams.join(often, "gram", "left").groupBy("rep").agg(
        F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct(F.coalesce("often", F.lit(1)).alias("often"), F.col("gram").alias("gram")))).alias("all"))
    length = F.expr(f"cast(n - ((n * {percent} + 99) div 100) + 1 as int)")
    prefix = ranked.select("rep", "n", F.posexplode(F.slice("all", F.lit(1), length)).alias("pos", "x")).where("x.often > 1")
    prefix = save(prefix.join(labelled, "rep").select("rep", "label", "n", "pos", F.col("x.gram").alias("gram")), "prefix")
    # Pairs inside a shingle's most frequent label are never needed: one side is always outside it.
    main = prefix.groupBy("gram", "label").agg(F.count(F.lit(1)).alias("rows")).groupBy("gram").agg(
        F.max(F.struct("rows", "label"))["label"].alias("main"), F.count(F.lit(1)).alias("labels")).where("labels > 1").select("gram", "main")
    one = prefix.join(main, "gram").where("label <> main").select("gram", *[F.col(c).alias(f"{c}1") for c in ("rep", "label", "n", "pos")])
    need = F.expr(f"({percent} * (n + n1) + {99 + percent}) div {100 + percent}")
    pairs = prefix.join(one, "gram").where(
        (F.col("label") != F.col("label1")) & (F.col("n") * 100 >= F.col("n1") * percent) & (F.col("n1") * 100 >= F.col("n") * percent)
        & (F.least(F.col("n") - F.col("pos"), F.col("n1") - F.col("pos1")) >= need))
    return pairs.select(F.least("rep", "rep1").alias("a"), F.greatest("rep", "rep1").alias("b")).distinct()


def _across(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs whose ends have different labels so far (a node without a label is its own)."""
    one = labels.select(F.col("node").alias("a"), F.col("label").alias("la"))
    two = labels.select(F.col("node").alias("b"), F.col("label").alias("lb"))
    return pairs.join(one, "a", "left").join(two, "b", "left").where(
        F.coalesce("la", "a") != F.coalesce("lb", "b")).drop("la", "lb")


def link(docs: DataFrame, percent: int = PERCENT, small: int = SMALL, reach: int = REACH) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = ", ".join(f"{s} long" for s in SIGNATURE)
    sketch = save(rows.mapInArrow(_sketch, f"doc_id long, n long, c1 long, c2 long, {signed}"), "sketch")
    filled = sketch.where("n > 0")
    classes = save(filled.groupBy("n", "c1", "c2").agg(F.min("doc_id").alias("rep"), *[F.first(s).alias(s) for s in SIGNATURE]), "classes")

    # Four masked keys a chunk.
    masks = [F.lit(~(0xFFFF << (16 * i)) & 0x7FFFFFFFFFFFFFFF if i == 3 else ~(0xFFFF << (16 * i))) for i in range(PER_CHUNK)]
    keys = F.array(*[F.xxhash64(F.lit(4 * i + k), F.col(s).bitwiseAND(m)) for i, s in enumerate(SIGNATURE) for k, m in enumerate(masks)])
    keyed = classes.select("rep", F.explode(keys).alias("key"))
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    buckets = save(keyed.join(shared, "key"), "buckets")

    texts = save(
        rows.mapInArrow(_pack, "rep long, packed binary").join(buckets.select("rep").distinct(), "rep", "left_semi").dropDuplicates(["rep"]), "texts")

    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    little = buckets.where(F.col("rows") <= small).join(classes.select("rep", *SIGNATURE), "rep")
    near = save(little.repartition(n, "key").sortWithinPartitions("key", "rep").select("key", "rep", *SIGNATURE)
                .mapInPandas(_near_in_bucket(small, reach), "a long, b long, same int").groupBy("a", "b").agg(F.max("same").alias("same")), "near")
    # First each set's smallest and most similar partner, and in large buckets one central member: the
    # set that shares most large buckets.
    lowest = near.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
    closest = near.groupBy("b").agg(F.max(F.struct(F.col("same"), (-F.col("a")).alias("a")))["a"].alias("a")).select((-F.col("a")).alias("a"), "b")
    large = buckets.where(F.col("rows") > small).select("key", "rep")
    standing = large.groupBy("rep").agg(F.count(F.lit(1)).alias("standing"))
    centre = large.join(standing, "rep").groupBy("key").agg(F.max(F.struct("standing", "rep")).alias("centre"))
    central = large.join(centre, "key").groupBy("rep").agg(F.max("centre")["rep"].alias("centre")).where("rep <> centre")
    central = central.select(F.least("rep", "centre").alias("a"), F.greatest("rep", "centre").alias("b"))
    first = _confirmed(lowest.unionByName(closest).unionByName(central).distinct(), texts, percent)
    labels = components(first)

    # Then what can still join two components.
    second = _confirmed(_across(near, labels), texts, percent)
    labelled = large.join(labels.withColumnRenamed("node", "rep"), "rep", "left").select("key", "rep", F.coalesce("label", "rep").alias("label"))
    open_ = labelled.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("key")
    labelled = save(labelled.join(open_, "key", "left_semi").select("rep", "label").distinct(), "open")
    links = first.unionByName(second)
    if not labelled.isEmpty():
        links = links.unionByName(_confirmed(_prefix_pairs(texts, labelled, percent), texts, percent))
    labels = components(links)

    members = classes.join(labels.withColumnRenamed("node", "rep"), "rep", "left").select("n", "c1", "c2", F.coalesce("label", "rep").alias("component_id"))
    out = sketch.select("doc_id", "n", "c1", "c2").join(members, ["n", "c1", "c2"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
    return out.withColumn("kept", F.col("doc_id") == F.col("component_id"))


def keep_first(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One document of each component, with the input's columns: that of the smallest id."""
    gone = link(docs, percent).where(~F.col("kept")).select(F.col("doc_id").alias("_gone"))
    kept = docs.join(gone, F.col("doc_id").cast("long") == F.col("_gone"), "left_anti")
    # Rows that repeat an id are copies as well; where there are any, one of them stays.
    ids = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1 AND doc_id IS NOT NULL").select(F.col("doc_id").alias("_id"))
    ids = save(ids, "repeated-ids")
    if ids.isEmpty():
        return kept
    same = F.col("doc_id") == F.col("_id")
    return kept.join(ids, same, "left_anti").unionByName(kept.join(ids, same, "left_semi").dropDuplicates(["doc_id"]))

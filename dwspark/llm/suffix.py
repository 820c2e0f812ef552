"""Removal of long repeated byte strings by threshold-bounded interval expansion on a Burrows-Wheeler
transform.

Every string of ``length`` bytes is filed under its minimiser, the k-gram of least hash in it (leftmost
of equals), which depends on the string alone: equal strings share it and stand at the same offset from
it. Neighbouring strings with one minimiser form a run, so a text yields about one run in 150 bytes, and
only runs whose minimiser occurs again can hold a repeat.

* Runs with the same bytes settle each other; equal runs are counted, never gathered.
* A minimiser with several different runs gets their bytes together: a task concatenates such groups
  up to a bounded size, builds the Burrows-Wheeler transform and extends intervals backwards, breadth
  first (Beller, Gog, Ohlebusch, Schnattinger 2013). Level l marks the neighbours in suffix order whose
  common prefix is l; it stops at ``length``, and what is not separated by then is repeated.
* A minimiser with more than ``group_limit`` different runs would not fit one task for sure. Its runs
  are cut at fixed offsets from the minimiser into blocks of 32 strings, filed under the bytes that
  all strings of a block share. Equal blocks settle each other; different ones with the same shared
  bytes are compared string by string, by hash, each counted with a partial aggregate. That is exact
  as well.

Defined results: a null or empty text has 0 bytes and nothing removed; a text shorter than ``length``
keeps everything; all copies of a string are removed, the first included; equal rows are copies of each
other, but ``doc_id`` must be unique, as results are joined by it; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwspark.llm.tables import save
from dwspark.llm.textbytes import CHUNK, column, hash_slices, mix, prefix_hash

LENGTH = 400
GRAM = 100
GROUP_LIMIT = 256
BLOCK = 32
BATCH = 1 << 20  # bytes of one Burrows-Wheeler transform; below 2**21, as three ranks share 63 bits


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours."""
    have, out = 1, x
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    return np.minimum(out[: len(x) - width + 1], out[width - have:]) if have < width else out


def _segments(offsets: np.ndarray, length: int) -> list[tuple[int, int, int]]:
    """(row, start, end) of texts of ``length`` bytes or more; very long ones in overlapping parts."""
    out = []
    for row in np.flatnonzero(np.diff(offsets) >= length):
        start, end = int(offsets[row]), int(offsets[row + 1])
        for at in range(start, end - length + 1, 4 * CHUNK):
            out.append((int(row), at, min(end, at + 4 * CHUNK + length - 1)))
    return out


def _runs_of(data: np.ndarray, segments: list[tuple[int, int, int]], offsets: np.ndarray, length: int, gram: int):
    """Runs of some segments: row, start in the text, count of strings, offset of the minimiser from the
    start, its hash, the hash of the run's bytes."""
    part = np.concatenate([data[s:e] for _, s, e in segments])
    sizes = np.array([e - s for _, s, e in segments])
    ends = np.cumsum(sizes)
    total = prefix_hash(part)
    n = len(part) - gram + 1
    at = np.arange(n)
    grams = hash_slices(total, at, at + gram)
    ordered = (grams & ~np.uint64(0xFFFFFF)) | at.astype(np.uint64)
    low = sliding_min(ordered, length - gram + 1)
    inside = np.ones(len(low), bool)
    for end in ends[:-1]:
        inside[max(0, end - length + 1):end] = False
    start = np.flatnonzero(inside)
    best = (low[start] & np.uint64(0xFFFFFF)).astype(np.int64)
    new = np.ones(len(start), bool)
    new[1:] = (best[1:] != best[:-1]) | (start[1:] != start[:-1] + 1)
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(start)))
    p, q = start[first], best[first]
    owner = np.searchsorted(ends, p, side="right")
    rows = np.array([r for r, _, _ in segments])[owner]
    shift = np.array([s - offsets[r] for r, s, _ in segments])[owner] - (ends - sizes)[owner]
    return rows, p + shift, count, q - p, mix(grams[q]), hash_slices(total, p, p + count + length - 1)


def _runs(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = column(batch.column("text"))
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            waiting, held = [], 0
            for segment in [*_segments(offsets, length), None]:
                if waiting and (segment is None or held + segment[2] - segment[1] > CHUNK):
                    yield from _settled_here(ids, *_runs_of(data, waiting, offsets, length, gram))
                    waiting, held = [], 0
                if segment:
                    waiting.append(segment)
                    held += segment[2] - segment[1]

    return run


def _settled_here(ids, rows, p, count, x, h, f) -> Iterator[pa.RecordBatch]:
    """Runs that are equal within the batch need no more proof: their places are given at once (n = 0),
    joined to ranges, and one of them stands for all (n: how many)."""
    order = np.lexsort((h, f))
    new = np.ones(len(order), bool)
    new[1:] = (h[order][1:] != h[order][:-1]) | (f[order][1:] != f[order][:-1])
    times = np.diff(np.append(np.flatnonzero(new), len(order)))
    one = order[new]
    yield _run_batch(ids[rows[one]], p[one], count[one], x[one], h[one], f[one], times)
    many = np.zeros(len(order), bool)
    many[order] = np.repeat(times > 1, times)
    at = np.flatnonzero(many)
    if len(at):
        joined = (rows[at][1:] == rows[at][:-1]) & (p[at][1:] == p[at][:-1] + count[at][:-1])
        first = np.flatnonzero(np.append(True, ~joined))
        zero = np.zeros(len(first), np.int64)
        yield _run_batch(ids[rows[at[first]]], p[at[first]], np.add.reduceat(count[at], first), zero, zero.view(np.uint64), zero.view(np.uint64), zero)


RUN = "doc_id long, p long, c int, x int, h long, f long, n long"


def _run_batch(doc, p, c, x, h, f, n) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(doc.astype(np.int64)), pa.array(p.astype(np.int64)), pa.array(c.astype(np.int32)), pa.array(x.astype(np.int32)),
         pa.array(h.view(np.int64)), pa.array(f.view(np.int64)), pa.array(n.astype(np.int64))],
        ["doc_id", "p", "c", "x", "h", "f", "n"])


def suffix_order(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Starts of the suffixes in the order of their first ``depth`` symbols (below 512), by tripling."""
    n = len(symbols)
    padded = np.concatenate([symbols.astype(np.int64), np.zeros(7, np.int64)])
    key = np.zeros(n, np.int64)
    for k in range(7):
        key = (key << 9) | padded[k:k + n]
    have = 7
    while True:
        order = np.argsort(key, kind="stable")
        ranked = key[order]
        step = np.append(True, ranked[1:] != ranked[:-1])
        if have >= depth or step.all():
            return order
        rank = np.zeros(n + 2 * have, np.int64)
        rank[order] = np.cumsum(step)
        key = (rank[:n] << 42) | (rank[have:have + n] << 21) | rank[2 * have:]
        have *= 3


def repeated_starts(symbols: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffix order and, for each place in it, whether the suffix differs from the one before within
    ``depth`` symbols. Symbol 0 separates texts; suffixes with one in reach are not told apart after it.

    Breadth-first backward extension: the intervals of all strings of l symbols give those of l + 1, and
    an interval whose right end was not yet marked marks it: there the common prefix is l. An interval
    with a marked end is not extended, so at most one interval a place is ever kept.
    """
    n = len(symbols)
    order = suffix_order(symbols, depth)
    before = symbols[order - 1]
    back = np.empty(n, np.int64)
    back[np.argsort(before, kind="stable")] = np.arange(n)
    first = symbols[order]
    zeros = int(np.searchsorted(first, 1))
    differs = np.zeros(n + 1, bool)
    differs[[0, n]] = True
    owner = np.zeros(n, np.int64)
    # Level 0: the interval of the empty string gives one interval for each symbol.
    ends = np.append(np.flatnonzero(first[1:] != first[:-1]), n - 1)
    starts = np.append(0, ends[:-1] + 1)
    new = ~differs[ends + 1]
    differs[ends + 1] = True
    starts, ends = starts[new], ends[new]
    for _ in range(1, depth):
        if not len(starts):
            break
        size = ends - starts + 1
        shift = np.cumsum(size) - size
        at = np.repeat(starts - shift, size) + np.arange(int(size.sum()))
        to = back[at]
        owner[to] = np.repeat(np.arange(len(size)), size)
        to = np.sort(to[to >= zeros])
        if not len(to):
            break
        own, symbol = owner[to], first[to]
        change = (own[1:] != own[:-1]) | (symbol[1:] != symbol[:-1])
        starts, ends = to[np.append(True, change)], to[np.append(change, True)]
        new = ~differs[ends + 1]
        differs[ends + 1] = True
        starts, ends = starts[new], ends[new]
    return order, differs[:n]


def _expanded(length: int):
    def solve(rows: list[tuple]) -> pa.RecordBatch | None:
        doc, p, c, n = (np.array([r[k] for r in rows]) for k in range(4))
        pieces = [np.frombuffer(r[4], np.uint8) for r in rows]
        sizes = np.array([len(x) for x in pieces])
        begin = np.cumsum(sizes + 1) - sizes - 1
        symbols = np.zeros(int(sizes.sum()) + len(rows), np.uint16)
        for b, x in zip(begin, pieces):
            symbols[b:b + len(x)] = x.astype(np.uint16) + 1
        order, differs = repeated_starts(symbols, length)
        group = np.empty(len(order), np.int64)
        group[order] = np.cumsum(differs)
        strings = np.repeat(begin - (np.cumsum(c) - c), c) + np.arange(int(c.sum()))
        owner = np.repeat(np.arange(len(rows)), c)
        times = np.bincount(group[strings], weights=n[owner])
        hit = times[group[strings]] > 1
        at, who = strings[hit], owner[hit]
        if not len(at):
            return None
        first = np.flatnonzero(np.append(True, (at[1:] != at[:-1] + 1) | (who[1:] != who[:-1])))
        count = np.diff(np.append(first, len(at)))
        who = who[first]
        return pa.RecordBatch.from_arrays(
            [pa.array(doc[who].astype(np.int64)), pa.array((p[who] + at[first] - begin[who]).astype(np.int64)), pa.array(count.astype(np.int32))],
            ["doc_id", "p", "c"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple] = []
        held, last = 0, None
        for batch in batches:
            columns = [batch.column(name).to_pylist() for name in ("h", "doc_id", "p", "c", "n", "piece")]
            for h, *row in zip(*columns):
                if h != last and held > BATCH // 2:  # a group stays whole; its size is bounded
                    if (out := solve(waiting)) is not None:
                        yield out
                    waiting, held = [], 0
                waiting.append(tuple(row))
                held += len(row[4])
                last = h
        if waiting and (out := solve(waiting)) is not None:
            yield out

    return run


def _blocks(length: int, block: int):
    """Cut a run's strings at fixed offsets from the minimiser; a block's key is what they all share."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for h, doc, p, c, x, n, piece in zip(*(batch.column(k).to_pylist() for k in ("h", "doc_id", "p", "c", "x", "n", "piece"))):
                data = np.frombuffer(piece, np.uint8)
                total = prefix_hash(data)
                start = np.arange(c)
                strings = hash_slices(total, start, start + length).view(np.int64)
                number = (x - start) // block
                for b in range(int(number.min()), int(number.max()) + 1):
                    own = np.flatnonzero(number == b)
                    core = x - b * block
                    key = hash_slices(total, np.array([core]), np.array([core + length - block + 1]))
                    key = mix(key ^ np.uint64(h & 0xFFFFFFFFFFFFFFFF) ^ np.uint64(b))
                    out.append((int(key.view(np.int64)[0]), doc, p + int(own[0]), n, strings[own].tolist()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.int64()), pa.array([r[2] for r in out], pa.int64()),
                 pa.array([r[3] for r in out], pa.int64()), pa.array([r[4] for r in out], pa.list_(pa.int64()))],
                ["core", "doc_id", "p", "n", "strings"])

    return run


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=3).compress
    for batch in batches:
        texts = batch.column("text").cast(pa.large_binary())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([pack(x.as_py() or b"") for x in texts], pa.binary())], ["doc_id", "packed"])


def _pieces(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                out: list[tuple] = []
                for doc, packed, wanted in zip(*(part.column(k).to_pylist() for k in ("doc_id", "packed", "wanted"))):
                    text = unpack(packed)
                    out += [(w["h"], doc, w["p"], w["c"], w["x"], w["n"], w["m"], text[w["p"]:w["p"] + w["c"] + length - 1]) for w in wanted]
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)], ["h", "doc_id", "p", "c", "x", "n", "m", "piece"])

    return run


def _cut(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            out: list[tuple] = []
            for doc, packed, found in zip(*(batch.column(k).to_pylist() for k in ("doc_id", "packed", "found"))):
                text, spans, kept, at = unpack(packed), [], hashlib.sha256(), 0
                for p, c in sorted((x["p"], x["c"]) for x in found or ()):
                    if spans and p <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], p + c + length - 1)
                    else:
                        spans.append([p, p + c + length - 1])
                for start, end in spans:
                    kept.update(text[at:start])
                    at = end
                kept.update(text[at:])
                out.append((doc, len(text), sum(e - s for s, e in spans), len(spans), kept.hexdigest(), [{"start": s, "end": e} for s, e in spans]))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])

    return run


def repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, group_limit: int = GROUP_LIMIT, block: int = BLOCK) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the removed ``spans`` (byte ranges) of
    every row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.encode(F.coalesce(F.col("text"), F.lit("")), "UTF-8").alias("text"))
    packed = rows.mapInArrow(_pack, "doc_id long, packed binary")
    runs = save(rows.mapInArrow(_runs(length, gram), RUN), "runs")
    at_once = runs.where("n = 0").select("doc_id", "p", "c")
    again = runs.where("n > 0").groupBy("h").agg(F.sum("n").alias("all")).where("all > 1").select("h")
    shared = save(runs.where("n > 0").join(again, "h", "left_semi"), "shared")

    different = save(shared.groupBy("h", "f").agg(F.sum("n").alias("n"), F.min(F.struct("doc_id", "p", "c", "x")).alias("one")), "different")
    equal = shared.join(different.where("n > 1").select("h", "f"), ["h", "f"], "left_semi").select("doc_id", "p", "c")
    groups = different.groupBy("h").agg(F.count(F.lit(1)).alias("m"), F.sum((F.col("n") == 1).cast("long")).alias("open")).where("m > 1 AND open > 0")
    wanted = different.join(groups.select("h", "m"), "h").groupBy("one.doc_id").agg(
        F.collect_list(F.struct("h", "one.p", "one.c", "one.x", "n", "m")).alias("wanted"))  # bounded by the text's length
    pieces = save(packed.join(wanted, "doc_id").mapInArrow(
        _pieces(length), "h long, doc_id long, p long, c int, x int, n long, m long, piece binary"), "pieces")

    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    expanded = pieces.where(F.col("m") <= group_limit).select("h", "doc_id", "p", "c", "n", "piece")
    expanded = expanded.repartition(n, "h").sortWithinPartitions("h").mapInArrow(_expanded(length), "doc_id long, p long, c int")

    blocks = save(pieces.where(F.col("m") > group_limit).mapInArrow(
        _blocks(length, block), "core long, doc_id long, p long, n long, strings array<long>"), "blocks")
    # Equal blocks settle each other whole; only one of each is compared, string by string, with the
    # others that share its core.
    same = ["core", "whole"]
    blocks = blocks.withColumn("whole", F.xxhash64("strings"))
    kinds = save(blocks.groupBy(*same).agg(F.sum("n").alias("n"), F.min(F.struct("doc_id", "p")).alias("one"), F.first("strings").alias("strings")), "kinds")
    whole = blocks.join(kinds.where("n > 1").select(*same), same, "left_semi").select("doc_id", "p", F.size("strings").alias("c"))
    cores = kinds.groupBy("core").agg(F.count(F.lit(1)).alias("m"), F.min("n").alias("least")).where("m > 1 AND least = 1").select("core")
    strings = save(kinds.join(cores, "core", "left_semi").select("one.doc_id", "one.p", "n", F.posexplode("strings").alias("i", "string")), "strings")
    twice = strings.groupBy("string").agg(F.sum("n").alias("all")).where("all > 1").select("string")
    split = strings.where("n = 1").join(twice, "string", "left_semi").select("doc_id", (F.col("p") + F.col("i")).alias("p"), F.lit(1).alias("c"))
    split = split.unionByName(whole)

    found = at_once.unionByName(equal).unionByName(expanded).unionByName(split).groupBy("doc_id").agg(
        F.collect_list(F.struct("p", "c")).alias("found"))  # bounded by the text's length
    return packed.join(found, "doc_id", "left").mapInArrow(
        _cut(length),
        "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:long,end:long>>")


def query(docs: DataFrame) -> DataFrame:
    return repeats(docs).drop("spans")

"""Benchmark decontamination by template canonicalisation.

Texts become tokens (runs of letters and digits, parted by any other sign, curly quotes, long dashes and no-break blanks
included; a point or comma between digits stays inside a number).
Numbers, units right after a number, and names (capitalised words that do not begin a sentence; several
in a row are one) become typed placeholders, all other tokens their lower-case form. Windows of 13 such
tokens of every document are matched by hash with the windows of every benchmark item, so a question
whose numbers and names were exchanged still meets its original. A match counts when the slots are
consistent: over all windows of a document and an item at one alignment, equal benchmark values stand
for equal document values, and different benchmark names for different ones. As a capitalised word is a
literal where it opens a text, an item's first window is also indexed as it reads after other words.

Beside the template, every window of 13 plain tokens is matched word for word, whatever stands before it
and in upper or lower case (a word all in capitals is another word), unless its alignment is inconsistent;
windows of less than ``literals`` percent literal tokens count in any alignment, as all their values agree.

Only hits leave the scan: the benchmark's window hashes travel to the tasks in blocks of at most
``block_hashes`` (8 bytes each); a larger benchmark takes several passes over the documents.

Defined results: null and empty texts have no windows; an item of fewer than 13 tokens is one window of
its own length, whose template is indexed if it has as many literal tokens as a full window needs (8);
with fewer than 8 words besides numbers and units it is only matched word for word, by a whole line or
sentence (or several) of a document; a template window with less than ``literals`` percent literal tokens is not indexed, as
placeholders alone prove nothing, but its plain windows are; equal items are reported each; repeated documents are reported each;
an empty table gives an empty result; other columns are ignored by :func:`matches` and kept by
:func:`keep_clean`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwspark.llm.tables import save
from dwspark.llm.textbytes import LOWER, chunks, column, hash_slices, mix, prefix_hash, window_sums, word_spans

WINDOW = 13
LITERALS = 60
BLOCK_HASHES = 4_000_000
# Common units of measure and currency, lower case.
UNITS = ("mm cm m km in ft yd mi mg g kg t lb oz ml cl l s ms min h hr day days week weeks month months year years hour hours minute "
         "minutes second seconds meter meters metre metres kilometer kilometers mile miles foot feet inch inches gram grams kilogram "
         "kilograms pound pounds ounce ounces liter liters litre litres degree degrees percent pct usd eur gbp dollar dollars euro euros "
         "cent cents k kb mb gb tb hz khz mhz ghz w kw mw v kv a ma j kj n kn pa kpa bar mph kmh").split()
NUMBER, UNIT, NAME = 1, 2, 3
PLAIN = np.uint64(0x506C61696E)  # sets the hashes of plain windows apart
_KINDS = np.array([0, 0x6E756D626572, 0x756E6974, 0x6E616D65], np.uint64) * np.uint64(0x9E3779B97F4A7C15)

IS_GAP = np.ones(256, bool)
IS_GAP[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
IS_DIGIT = np.zeros(256, bool)
IS_DIGIT[48:58] = True
ENDS_SENTENCE = np.zeros(256, bool)
ENDS_SENTENCE[[ord(c) for c in ".!?:;\n\""]] = True

# Second bytes of the signs (no letters or digits) among U+00A0 to U+00BF that part words.
SIGNS_C2 = np.zeros(256, bool)
SIGNS_C2[[0xA0, 0xA1, 0xA7, 0xAB, 0xAD, 0xB6, 0xB7, 0xBB, 0xBF]] = True


def _gaps(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes that part words, and bytes that end a sentence: ASCII other than letters and digits, the signs above, general
    punctuation (U+2000 to U+206F: dashes, curly quotes, dots, blanks) and the wide blank, comma and stop of U+3000 to U+3002."""
    gap, ends = IS_GAP[data], ENDS_SENTENCE[data]
    two = np.flatnonzero((data[:-1] == 0xC2) & SIGNS_C2[data[1:]])
    gap[two] = gap[two + 1] = True
    if len(data) > 2:
        general = (data[:-2] == 0xE2) & ((data[1:-1] == 0x80) | (data[1:-1] == 0x81))
        wide = (data[:-2] == 0xE3) & (data[1:-1] == 0x80) & (data[2:] <= 0x82)
        three = np.flatnonzero(general | wide)
        for k in range(3):
            gap[three + k] = True
        last = data[three + 2]
        quote = (data[three] == 0xE2) & (data[three + 1] == 0x80) & ((last == 0x9C) | (last == 0x9D) | (last == 0xA6))
        ends[three[quote | ((data[three] == 0xE3) & (last == 0x82))] + 2] = True
    return gap, ends & gap


def _unit_hashes() -> np.ndarray:
    data = np.frombuffer("".join(UNITS).encode(), np.uint8)
    ends = np.cumsum([len(u) for u in UNITS])
    return np.sort(hash_slices(prefix_hash(data), np.append(0, ends[:-1]), ends))


def canonical(data: np.ndarray, offsets: np.ndarray, opening: bool = True):
    """Template tokens of texts that lie side by side: their hashes, kinds (0: literal), starts, ends,
    and each text's first token; then the plain tokens' hashes, each text's first plain token, the plain
    place of each template token, and which plain tokens open a text or sentence. Without ``opening`` a text's first word opens no sentence."""
    digit = IS_DIGIT[data]
    gap, ends = _gaps(data)
    inner = np.flatnonzero((data == 46) | (data == 44))
    inner = inner[(inner > 0) & (inner < len(data) - 1)]
    inner = inner[digit[inner - 1] & digit[inner + 1] & ~np.isin(inner, offsets)]
    marked = data.copy()
    marked[gap] = 32
    marked[inner] = 48
    start, end, first = word_spans(marked, offsets)
    # Lower case of A-Z and of the two-byte letters from U+00C0 to U+00DE.
    second_byte = np.append(False, data[:-1] == 0xC3)
    low = LOWER[data]
    low[second_byte & (data >= 0x80) & (data <= 0x9E) & (data != 0x97)] += 32
    hashes = hash_slices(prefix_hash(low), start, end)
    n = len(start)
    if not n:
        return hashes, np.zeros(0, np.int8), start, end, first, hashes, first, np.zeros(0, np.int64), np.zeros(0, bool)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    opens = np.zeros(n, bool)  # begins a text or a sentence
    opens[first[:-1][np.diff(first) > 0]] = opening
    sentence = np.append(0, np.cumsum(ends))
    opens[1:] |= sentence[start[1:]] > sentence[end[:-1]]
    kind = np.zeros(n, np.int8)
    kind[digit[start]] = NUMBER
    head, second = data[start], data[np.minimum(start + 1, len(data) - 1)]
    upper = ((head >= 65) & (head <= 90)) | ((head == 0xC3) & (second >= 0x80) & (second <= 0x9E))
    small = np.append(0, np.cumsum(((data >= 97) & (data <= 122)) | (second_byte & (data >= 0xA0))))
    kind[upper & (small[end] > small[start]) & ~opens & (kind == 0)] = NAME  # a word all in capitals is a literal
    capitals = upper & (small[end] == small[start]) & (end - start > 1 + (head == 0xC3))
    plain = np.where(capitals, mix(hashes + _KINDS[NAME]), hashes)
    after = np.append(False, (kind[:-1] == NUMBER) & (text[1:] == text[:-1]))
    unit = _unit_hashes()
    at = np.flatnonzero(after & (kind == 0))
    kind[at[unit[np.minimum(np.searchsorted(unit, hashes[at]), len(unit) - 1)] == hashes[at]]] = UNIT
    # Names in a row are one slot.
    inside = np.append(False, (kind[1:] == NAME) & (kind[:-1] == NAME) & ~opens[1:] & (text[1:] == text[:-1]))
    keep = ~inside
    last = np.append(np.flatnonzero(keep)[1:] - 1, n - 1)
    kept_before = np.append(0, np.cumsum(keep))
    hashes, kind = hashes[keep], kind[keep]
    hashes = np.where(kind > 0, _KINDS[kind], hashes)
    return hashes, kind, start[keep], end[last], kept_before[first], plain, first, np.flatnonzero(keep), opens


def _windows(hashes: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Window hashes and the text of each window, -1 where it crosses texts."""
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    grams = window_sums(hashes, width)
    owner = text[: len(grams)].copy()
    owner[owner != text[width - 1: width - 1 + len(grams)]] = -1
    return grams ^ np.uint64(width), owner


def _slots(data: bytes, kind, start, end, a: int, b: int) -> list[str]:
    """The values of the slots among tokens a to b - 1, each as place:kind:value."""
    return [f"{k}:{kind[k + a]}:" + data[start[k + a]:end[k + a]].decode("utf-8", "replace").lower() for k in range(b - a) if kind[k + a]]


# ``at`` is the plain place of the window, ``plain`` tells windows of plain tokens from those of template
# tokens, ``word`` is the word that the first slot must hold, ``few`` marks plain windows with few literal
# tokens, and ``alone`` those that must be whole lines or sentences (items) or are (documents).
WINDOWS = "id long, place long, width int, hash long, slots array<string>, at long, plain boolean, word string, few boolean, alone boolean"


def _batch(out: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.string()), pa.int64(), pa.bool_(), pa.string(), pa.bool_(), pa.bool_())
    return pa.RecordBatch.from_arrays(
        [pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)], ["id", "place", "width", "hash", "slots", "at", "plain", "word", "few", "alone"])


def _item_windows(window: int, literals: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = column(batch.column("text"))
            ids = batch.column("id").to_pylist()
            for i, j in chunks(offsets):
                part, at = data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
                hashes, kind, start, end, first, plain, first_plain, origin, _ = canonical(part, at)
                literal = np.zeros(len(plain) + 1, np.int64)  # literal tokens before each plain token
                literal[origin + 1] = kind == 0
                literal = np.cumsum(literal)
                later = canonical(part, at, opening=False)
                raw, out = part.tobytes(), []
                for row in range(j - i):
                    a, b = int(first_plain[row]), int(first_plain[row + 1])
                    width = min(window, b - a)
                    if width:
                        grams = window_sums(plain[a:b], width) ^ np.uint64(width) ^ PLAIN
                        few = 100 * (literal[a + width:b + 1] - literal[a:b + 1 - width]) < literals * width
                        words = width - int(np.isin(kind[first[row]:first[row + 1]], (NUMBER, UNIT)).sum())
                        alone = width < window and 100 * words < literals * window
                        out += [(ids[i + row], k, width, h, [], k, True, None, bool(few[k]), alone) for k, h in enumerate(grams.view(np.int64).tolist())]
                    a, b = int(later[4][row]), int(later[4][row + 1])
                    width = min(window, b - a)
                    if width and later[1][a] == NAME and 100 * (1 + int((later[1][a:a + width] == 0).sum())) >= literals * window:
                        h = window_sums(later[0][a:a + width], width) ^ np.uint64(width)
                        word = raw[start[first[row]]:end[first[row]]].decode("utf-8", "replace").lower()
                        out.append((ids[i + row], 0, width, int(h.view(np.int64)[0]), _slots(raw, *later[1:4], a, a + width), 0, False, word, False, False))
                    a, b = int(first[row]), int(first[row + 1])
                    width = min(window, b - a)
                    if not width:
                        continue
                    grams = window_sums(hashes[a:b], width) ^ np.uint64(width)
                    for k, h in enumerate(grams.view(np.int64).tolist()):
                        if 100 * int((kind[a + k:a + k + width] == 0).sum()) >= literals * window:
                            out.append((ids[i + row], k, width, h, _slots(raw, kind, start, end, a + k, a + k + width),
                                        int(origin[a + k] - origin[a]), False, None, False, False))
                yield _batch(out)

    return run


def _hits(wanted: np.ndarray, widths: list[tuple[bool, int]]):
    """Windows of the documents whose hash is among ``wanted`` (sorted)."""
    bits = np.zeros(1 << 20, bool)
    bits[(wanted >> np.uint64(44)).astype(np.int64)] = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = column(batch.column("text"))
            ids = batch.column("id").to_pylist()
            for i, j in chunks(offsets):
                part, at = data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
                hashes, kind, start, end, first, plain, first_plain, origin, opens = canonical(part, at)
                border = np.append(opens, True)  # a line or sentence ends before the token
                border[first_plain] = True
                raw, out = None, []
                for is_plain, width in widths:
                    grams, owner = _windows(plain, first_plain, width) if is_plain else _windows(hashes, first, width)
                    grams = grams ^ PLAIN if is_plain else grams
                    hit = np.flatnonzero(bits[(grams >> np.uint64(44)).astype(np.int64)] & (owner >= 0))
                    place = np.minimum(np.searchsorted(wanted, grams[hit]), len(wanted) - 1)
                    for k in hit[wanted[place] == grams[hit]].tolist():
                        raw = raw or part.tobytes()
                        row, h = int(owner[k]), int(grams[k:k + 1].view(np.int64)[0])
                        if is_plain:
                            place = k - int(first_plain[row])
                            out.append((ids[i + row], place, width, h, [], place, True, None, False, bool(border[k] and border[k + width])))
                        else:
                            out.append((ids[i + row], k - int(first[row]), width, h, _slots(raw, kind, start, end, k, k + width),
                                        int(origin[k] - first_plain[row]), False, None, False, False))
                if out:
                    yield _batch(out)

    return run


def matches(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, literals: int = LITERALS, block_hashes: int = BLOCK_HASHES,
) -> DataFrame:
    """doc_id, item_id, ``n_windows`` (of the document, that match the item consistently or word for word,
    whichever are more), ``item_windows`` (indexed ones, likewise) and ``exact`` (all slot values agree at
    some alignment, or there are only word-for-word matches)."""
    items = save(benchmark.select(F.col("item_id").cast("long").alias("id"), "text").mapInArrow(_item_windows(window, literals), WINDOWS), "items")
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), "text")
    total = items.select("hash").distinct().count()
    widths = sorted((r["plain"], r["width"]) for r in items.select("plain", "width").distinct().collect())  # at most ``2 * window`` values
    blocks = max(1, -(-total // block_hashes))
    found = None
    for b in range(blocks):
        own = items.select("hash").distinct().where(F.pmod("hash", F.lit(blocks)) == b).toPandas()["hash"]
        wanted = np.sort(own.to_numpy(np.int64).view(np.uint64))
        part = rows.mapInArrow(_hits(wanted, widths), WINDOWS) if len(wanted) else rows.limit(0).select(
            "id", *[F.lit(None).cast(t).alias(c) for c, t in (
                ("place", "long"), ("width", "int"), ("hash", "long"), ("slots", "array<string>"), ("at", "long"), ("plain", "boolean"), ("word", "string"), ("few", "boolean"), ("alone", "boolean"))])
        found = part if found is None else found.unionByName(part)
    hits = save(found, "hits")

    both = hits.drop("word", "few").join(items.select(
        "hash", "word", "few", F.col("alone").alias("item_alone"), F.col("id").alias("item_id"), F.col("place").alias("item_place"), F.col("at").alias("item_at"), F.col("slots").alias("item_slots")), "hash")
    both = both.withColumn("shift", F.col("place") - F.col("item_place")).withColumn("at_shift", F.col("at") - F.col("item_at")).withColumnRenamed("id", "doc_id")
    first = F.split(F.element_at("slots", 1), ":", 3)[2]
    both = both.where(F.col("word").isNull() | F.array_contains(F.split(first, r"[^\p{L}\p{Nd}]+"), F.col("word"))).where("alone OR NOT item_alone")
    plain, both = both.where("plain"), both.where("NOT plain")
    # One slot of an alignment is seen by several windows; its place in the item names it.
    slots = both.select("doc_id", "item_id", "shift", "item_place", F.explode(F.arrays_zip("slots", "item_slots")).alias("s"))
    slots = slots.select(
        "doc_id", "item_id", "shift", F.split("s.slots", ":", 3)[1].alias("kind"), F.split("s.slots", ":", 3)[2].alias("value"),
        F.split("s.item_slots", ":", 3)[2].alias("item_value")).distinct()
    forth = slots.groupBy("doc_id", "item_id", "shift", "kind", "item_value").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    back = slots.where(F.col("kind") == str(NAME)).groupBy("doc_id", "item_id", "shift", "kind", "value").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    broken = forth.select("doc_id", "item_id", "shift").unionByName(back.select("doc_id", "item_id", "shift")).distinct()
    good = both.join(broken, ["doc_id", "item_id", "shift"], "left_anti")
    aligned = good.groupBy("doc_id", "item_id", "shift").agg(
        F.count(F.lit(1)).alias("n"), F.min((F.col("slots") == F.col("item_slots")).cast("int")).alias("same"))
    vetoed = both.join(broken, ["doc_id", "item_id", "shift"], "left_semi").select("doc_id", "item_id", "at_shift").distinct()
    words = plain.where("NOT few").join(vetoed, ["doc_id", "item_id", "at_shift"], "left_anti").unionByName(
        plain.where("few")).groupBy("doc_id", "item_id").agg(F.count(F.lit(1)).alias("n_plain"))
    sizes = items.where("word IS NULL").groupBy("id").agg(
        F.greatest(F.sum(F.col("plain").cast("long")), F.sum((~F.col("plain")).cast("long"))).alias("item_windows")).withColumnRenamed("id", "item_id")
    out = aligned.groupBy("doc_id", "item_id").agg(F.sum("n").alias("n"), (F.max("same") == 1).alias("same")).join(words, ["doc_id", "item_id"], "full")
    out = out.select("doc_id", "item_id", F.greatest("n", "n_plain").alias("n_windows"), F.coalesce("same", F.lit(True)).alias("exact"))
    return out.join(sizes, "item_id").select("doc_id", "item_id", "n_windows", "item_windows", "exact")


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without a benchmark passage, with the input's columns."""
    hit = matches(docs, benchmark).select(F.col("doc_id").alias("_hit")).distinct()
    return docs.join(hit, docs["doc_id"].cast("long") == F.col("_hit"), "left_anti")

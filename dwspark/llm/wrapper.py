"""Main text of web pages by wrapper induction.

Pages of one host share a template. Each page's tree of block elements is aligned with a reference tree
by simple tree matching: equal labels match, children match in order, and the alignment with the most
matched nodes wins. The reference is the largest page of the host's most frequent shape (the set of label
paths; pages without text only if there are no others). Over the host's pages, those of equal text counted once,
a node whose own text is the same in at least half of them, and in two at least, is template; nodes with varying text are content slots. The
content slot of the host is the deepest container that holds all varying, unlinked text outside boilerplate
regions, but none below an article or main element (where these hold half of that text or more, what varies
outside of them does not count); its blocks, in page order and without boilerplate regions, are the page's main text; template nodes inside the
slot whose text stands in three different pages at least are left out, unless nothing else is there. A page whose alignment
lacks that slot uses its own article or main element, or the deepest container of all its own text.

Only the reference trees and one slot number a host are joined to the pages, read from written tables,
so that Spark broadcasts them while their files are small and otherwise joins by host. Counts by host are
pre-aggregated, and no task holds a host's pages, so a hot host is no special case.

Regions that are never main text are known by element, role, ``hidden`` and class or identifier: a name counts as a
whole, only if all its words speak of such regions (see ``_condemned``). Markup is read in one pass in linear time.

Defined results: null and empty markup gives an empty text; a null or broken address belongs to the host
''; repeated pages are extracted each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dwspark.llm.tables import save

# HTML's element classes.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript xmp iframe noembed noframes".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup "
             "time tt u var wbr br img".split())
TEXT_BLOCKS = set("p h1 h2 h3 h4 h5 h6 pre li dt dd blockquote figcaption caption summary address td th hr".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
CLOSE_LIMITS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}, "option": {"select"}}
# Elements, roles and class words of regions that are not main text.
BOILERPLATE = set("head nav footer aside form script style noscript template svg iframe button select option textarea menu dialog title "
                  "input object canvas audio video".split())
ROLES = set("navigation banner contentinfo complementary search form menu menubar dialog alert".split())
WORDS = set("nav navbar navigation menu header footer sidebar aside ad ads advert adverts advertisement advertising banner promo promotion "
            "sponsor sponsored cookie cookies consent gdpr notice notices comment comments disqus reply replies respond share sharing social "
            "related recommended breadcrumb breadcrumbs pagination pager subscribe newsletter signup popup modal toolbar widget skip".split())

# Words that stand beside those in a class or identifier without changing what the region is.
BESIDE = set("site page global main top bottom left right primary secondary sub inner outer mobile desktop list box bar slot item items wrap wrapper "
             "container block section area region posts links link buttons button panel icons inline fixed sticky toggle content body form meta "
             "count group holder placeholder unit zone module component js the".split())

DEEPEST = 512  # blocks inside each other; further ones are not told apart, as in browsers

# One pass: a quoted value begins after "=" and ends at its quote; a tag that never ends swallows the rest, as in browsers.
MARKUP = re.compile(r"<!--.*?(?:--!?>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|=)*+)(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s=\"'/]++)\s*+(?:=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++)))?")
INVISIBLE = re.compile(r"display\s*:\s*none", re.I)


def _condemned(token: str) -> bool:
    """Whether a class or identifier names a boilerplate region: it holds one of ``WORDS`` and no word that says something
    else (``site-footer``, but not ``with-sidebar``, ``entry-header`` or ``share-price-table``)."""
    words = [w for w in re.split(r"[_-]+|\d+", token) if w]
    return any(w in WORDS for w in words) and all(w in WORDS or w in BESIDE for w in words)


def _described(tag: str, attributes: str) -> tuple[str, bool]:
    """An element's label for the alignment, and whether it opens a boilerplate region."""
    if not attributes.strip():
        return tag, tag in BOILERPLATE
    found: dict[str, str] = {}
    for m in ATTRIBUTE.finditer(attributes):
        found.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
    tokens = [x for k in ("class", "id") for x in found.get(k, "").lower().split()]
    unseen = "hidden" in found or found.get("aria-hidden", "").strip().lower() == "true" or INVISIBLE.search(found.get("style", ""))
    bad = tag in BOILERPLATE or any(map(_condemned, tokens)) or found.get("role", "").strip().lower() in ROLES or bool(unseen)
    names = re.sub(r"\d+", "", found.get("class", "").strip().lower())
    return (f"{tag}.{names}" if names else tag), bad and tag not in ("html", "body", "article", "main")


class Stack:
    """The open elements and their block nodes, with how many of each name are open (in all, and in the run of inline
    elements at the top), so that no tag has to look through elements that it does not close."""

    def __init__(self):
        self.open: list[tuple[str, int]] = [("#", 0)]
        self.count: dict[str, int] = {}
        self.runs: list[dict[str, int]] = [{}]

    @property
    def node(self) -> int:
        return self.open[-1][1]

    def has(self, *tags: str) -> bool:
        return any(self.count.get(t) for t in tags)

    def push(self, tag: str, node: int) -> None:
        self.open.append((tag, node))
        self.count[tag] = self.count.get(tag, 0) + 1
        if tag in INLINE:
            self.runs[-1][tag] = self.runs[-1].get(tag, 0) + 1
        else:
            self.runs.append({})

    def cut(self, depth: int) -> None:
        """Close the elements from ``depth`` on."""
        while len(self.open) > depth:
            tag, _ = self.open.pop()
            self.count[tag] -= 1
            if tag in INLINE:
                self.runs[-1][tag] -= 1
            else:
                self.runs.pop()

    def end(self, tag: str) -> None:
        """An end tag: an inline one ends nothing beyond the block it stands in, and one without a start ends nothing."""
        if (self.runs[-1] if tag in INLINE else self.count).get(tag):
            depth = len(self.open) - 1
            while self.open[depth][0] != tag:
                depth -= 1
            self.cut(depth)

    def make_room(self, tag: str) -> None:
        """Elements that a start tag ends: an open paragraph with what is open in it, or an item of the same list or
        row."""
        targets, limits = CLOSES.get(tag, ()), CLOSE_LIMITS.get(tag, ())
        if not self.has("p", *targets):
            return
        for d in range(len(self.open) - 1, 0, -1):
            name = self.open[d][0]
            if name == "p" or name in targets:
                self.cut(d)
                if self.open[d - 1][0] not in targets:
                    return
            elif name in limits or (name not in INLINE and name not in TEXT_BLOCKS and not targets):
                return


class Page:
    """Block elements of a page in page order, as parallel lists, and its blocks of text.

    ``label``, ``parent`` and ``bad`` describe node i; ``blocks`` are (node, text, linked characters)."""

    def __init__(self, markup: str):
        self.label, self.parent, self.bad, self.tag = ["#"], [-1], [False], ["#"]
        self.blocks: list[tuple[int, str, int]] = []
        self._parse(markup)

    def _parse(self, markup: str) -> None:
        stack = Stack()
        text: list[str] = []
        linked, at, size = 0, 0, len(markup)
        too_deep: dict[str, int] = {}

        def flush() -> None:
            nonlocal linked
            if text:
                joined = " ".join(entities.unescape("".join(text)).split())
                if joined:
                    self.blocks.append((stack.node, joined, linked))
                text.clear()
            linked = 0

        while at < size:
            m = MARKUP.search(markup, at)
            piece = markup[at:m.start()] if m else markup[at:]
            if piece:
                text.append(piece)
                linked += len(piece) if stack.has("a") else 0
            if not m:
                break
            at = m.end()
            if not m[2]:
                continue
            tag = m[2].lower()
            if m[1]:  # end tag
                if tag not in INLINE:
                    flush()
                if too_deep.get(tag):
                    too_deep[tag] -= 1
                else:
                    stack.end(tag)
                continue
            if tag == "br":
                text.append(" ")
                continue
            if tag in INLINE:
                if tag not in VOID and not m[3].endswith("/"):
                    stack.push(tag, stack.node)
                continue
            flush()
            if tag not in RAW and tag not in VOID and len(stack.runs) > DEEPEST:
                too_deep[tag] = too_deep.get(tag, 0) + 1
                continue
            if tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(markup, at)
                at = end.end() if end else size
                continue
            if tag in VOID:
                continue
            stack.make_room(tag)
            label, bad = _described(tag, m[3])
            up = stack.node
            inside = stack.has("article", "main")
            self.label.append(label)
            self.tag.append(tag)
            self.parent.append(up)
            self.bad.append(self.bad[up] or bad or (tag == "header" and not inside))
            stack.push(tag, len(self.label) - 1)
        flush()

    def children(self) -> list[list[int]]:
        out: list[list[int]] = [[] for _ in self.label]
        for i, p in enumerate(self.parent):
            if p >= 0:
                out[p].append(i)
        return out

    def own_slot(self) -> int:
        """The page's own article or main element, or where its text leads."""
        for wanted in ("article", "main"):
            for i, tag in enumerate(self.tag):
                if tag == wanted and not self.bad[i]:
                    return i
        return lead(self.parent, self.tag, self.mass(lambda node, text: True))

    def mass(self, counts) -> list[int]:
        """Unlinked characters below each node, outside boilerplate, of the blocks that count."""
        out = [0] * len(self.label)
        for node, text, linked in self.blocks:
            if not self.bad[node] and counts(node, text):
                out[node] += max(0, len(text) - linked)
        for i in range(len(out) - 1, 0, -1):
            out[self.parent[i]] += out[i]
        return out


def lead(parent: list[int], tag: list[str], mass: list[int]) -> int:
    """From the root down to the deepest container that holds all of the text, at most to an article or
    main element: a step is taken while one child container leaves none behind."""
    below: dict[int, list[int]] = {}
    for i, p in enumerate(parent):
        below.setdefault(p, []).append(i)
    at = 0
    while tag[at] not in ("article", "main"):
        steps = [i for i in below.get(at, []) if tag[i] not in TEXT_BLOCKS and mass[i] == mass[at] > 0]
        if not steps:
            return at
        at = steps[0]
    return at


def align(page: Page, labels: list[str], parents: list[int]) -> list[int]:
    """For each node of the page its node in the reference tree, or -1, by simple tree matching."""
    left = page.children()
    right: list[list[int]] = [[] for _ in labels]
    for i, p in enumerate(parents):
        if p >= 0:
            right[p].append(i)
    # Equal subtrees share their matching, so each pair of shapes is computed once.
    shapes: dict[tuple, int] = {}
    sizes: list[int] = []

    def shaped(label: list[str], below: list[list[int]]) -> list[int]:
        out = [0] * len(label)
        for i in range(len(label) - 1, -1, -1):
            key = (label[i], *(out[c] for c in below[i]))
            out[i] = shapes.setdefault(key, len(shapes))
            if len(sizes) < len(shapes):
                sizes.append(1 + sum(sizes[c] for c in key[1:]))
        return out

    a_shape, b_shape = shaped(page.label, left), shaped(labels, right)
    memo: dict[tuple[int, int], int] = {}

    def unlike(a: int, b: int) -> tuple[int, int]:
        """How many children are left before the last ones of equal shape, which match in the best alignment."""
        i, k = len(left[a]), len(right[b])
        while i and k and a_shape[left[a][i - 1]] == b_shape[right[b][k - 1]]:
            i, k = i - 1, k - 1
        return i, k

    def table(a: int, b: int, n: int, m: int) -> list[list[int]]:
        rows = [[0] * (m + 1)]
        for x in left[a][:n]:
            last, row = rows[-1], [0]
            for k, y in enumerate(right[b][:m]):
                best = last[k + 1] if last[k + 1] > row[k] else row[k]
                if page.label[x] == labels[y]:
                    taken = last[k] + score(x, y)
                    best = taken if taken > best else best
                row.append(best)
            rows.append(row)
        return rows

    def score(a: int, b: int) -> int:
        key = (a_shape[a], b_shape[b])
        if key not in memo:
            n, m = unlike(a, b)
            memo[key] = 1 + sum(sizes[a_shape[x]] for x in left[a][n:]) + (table(a, b, n, m)[-1][-1] if n and m else 0)
        return memo[key]

    out = [-1] * len(page.label)
    waiting = [(0, 0)]
    while waiting:
        a, b = waiting.pop()
        out[a] = b
        if not (left[a] and right[b]):
            continue
        i, k = unlike(a, b)
        waiting.extend(zip(left[a][i:], right[b][k:]))
        rows = table(a, b, i, k) if i and k else []
        while i and k:
            x, y = left[a][i - 1], right[b][k - 1]
            if page.label[x] == labels[y] and rows[i][k] == rows[i - 1][k - 1] + score(x, y):
                waiting.append((x, y))
                i, k = i - 1, k - 1
            elif rows[i][k] == rows[i - 1][k]:
                i -= 1
            else:
                k -= 1
    return out


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def _safe(markup: str | None) -> Page:
    try:
        return Page(markup or "")
    except RecursionError:  # trees of thousands of levels: text only
        page = Page("")
        page.blocks = [(0, " ".join(entities.unescape(MARKUP.sub(" ", markup or "")).split()), 0)]
        return page


def _trees(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        pages = [_safe(x) for x in pdf["html"]]
        yield pd.DataFrame({"host": pdf["host"], "labels": [p.label for p in pages], "parents": [p.parent for p in pages],
                            "tags": [p.tag for p in pages]})


def _shapes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """What the choice of a host's reference page needs of each page."""
    for pdf in batches:
        out = []
        for name, page_id, markup in pdf[["host", "page_id", "html"]].itertuples(index=False):
            page = _safe(markup)
            paths, path = set(), []
            for i, p in enumerate(page.parent):
                path.append(zlib.crc32(page.label[i].encode("utf-8", "replace"), path[p] if p >= 0 else 0))
                paths.add(path[i])
            words = [t for node, t, _ in page.blocks if not page.bad[node]]
            out.append((name, None if pd.isna(page_id) else int(page_id), bool(words), zlib.crc32(repr(sorted(paths)).encode()),
                        zlib.crc32("\n".join(words).encode("utf-8", "replace")), len(page.label)))
        frame = pd.DataFrame(out, columns=["host", "page_id", "filled", "shape", "content", "size"])
        yield frame.astype({"page_id": "Int64"})


PARSED = ("page_id long, url string, host string, own int, nodes array<struct<ref:int,sum:long,mass:long>>, "
          "blocks array<struct<good:boolean,own:boolean,refs:array<int>,sum:long,text:string>>")


def _parsed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        out = []
        for page_id, url, name, markup, labels, parents in pdf[["page_id", "url", "host", "html", "labels", "parents"]].itertuples(index=False):
            page = _safe(markup)
            try:
                to = align(page, list(labels), list(parents)) if labels is not None else [-1] * len(page.label)
            except RecursionError:
                to = [-1] * len(page.label)
            slot = page.own_slot()
            inside: list[bool] = []
            refs: list[list[int]] = []
            for i, p in enumerate(page.parent):
                inside.append(i == slot or (p >= 0 and inside[p]))
                refs.append((refs[p] if p >= 0 else []) + ([to[i]] if to[i] >= 0 else []))
            own_text: dict[int, list] = {}
            for node, text, linked in page.blocks:
                if not page.bad[node] and to[node] >= 0:
                    seen = own_text.setdefault(to[node], [0, 0])
                    seen[0] = zlib.crc32(text.encode("utf-8", "replace"), seen[0])
                    seen[1] += max(0, len(text) - linked)
            out.append((page_id, url, name, to[slot], [(ref, total, mass) for ref, (total, mass) in own_text.items()],
                        [(not page.bad[node], inside[node], refs[node], own_text[to[node]][0] if not page.bad[node] and to[node] >= 0 else None, text)
                         for node, text, _ in page.blocks]))
        yield pd.DataFrame(out, columns=["page_id", "url", "host", "own", "nodes", "blocks"])


def _slots(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row a host: its reference tree and, by node, the characters of varying text."""
    for pdf in batches:
        out = []
        for name, parents, tags, found in pdf[["host", "parents", "tags", "found"]].itertuples(index=False):
            mass, landmark = [0] * len(parents), []
            for tag, p in zip(tags, parents):
                landmark.append(tag in ("article", "main") or (p >= 0 and landmark[p]))
            for x in found if found is not None else ():
                mass[x["ref"]] += x["mass"]
            if 2 * sum(m for m, inside in zip(mass, landmark) if inside) >= sum(mass):  # what varies beside them is no article
                mass = [m if inside else 0 for m, inside in zip(mass, landmark)]
            for i in range(len(parents) - 1, 0, -1):
                mass[parents[i]] += mass[i]
            slot = lead(list(parents), list(tags), mass)
            out.append((name, slot if slot else -1))
        yield pd.DataFrame(out, columns=["host", "slot"])


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars, host and ``aligned`` (the host's slot was found in the page)."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", host(F.col("url")).alias("host"), "html")
    shapes = rows.select("host", "page_id", "html").mapInPandas(_shapes, "host string, page_id long, filled boolean, shape long, content long, size int")
    shapes = shapes.groupBy("host", "filled", "shape", "content").agg(F.max(F.struct("size", (-F.col("page_id")).alias("first"))).alias("page"))
    shapes = shapes.groupBy("host", "filled", "shape").agg(F.count(F.lit(1)).alias("n"), F.max("page").alias("page"))
    first = shapes.groupBy("host").agg(F.max(F.struct("filled", "n", "page", "shape")).alias("best"))
    first = save(first.select("host", (-F.col("best.page.first")).alias("page_id")), "first")
    trees = save(rows.select("host", "page_id", "html").join(first, ["host", "page_id"], "left_semi").dropDuplicates(["host"]).select("host", "html")
                 .mapInPandas(_trees, "host string, labels array<string>, parents array<int>, tags array<string>"), "trees")
    parsed = save(rows.join(trees.drop("tags"), "host", "left").mapInPandas(_parsed, PARSED), "parsed")

    # A node is template where one text makes up half or more of its host's pages that have it, copies counted once.
    distinct = parsed.select("host", "nodes", F.xxhash64("nodes").alias("content")).dropDuplicates(["host", "content"])
    seen = distinct.select("host", F.explode("nodes").alias("x")).groupBy("host", "x.ref", "x.sum").agg(
        F.count(F.lit(1)).alias("n"), F.sum("x.mass").alias("mass"))
    nodes = seen.groupBy("host", "ref").agg(
        F.max("n").alias("most"), F.sum("n").alias("n"), F.sum("mass").alias("mass"), F.max(F.struct("n", "sum"))["sum"].alias("sum"))
    nodes = save(nodes, "nodes")
    constant = nodes.where("most > 2 AND 2 * most >= n").groupBy("host").agg(F.collect_list(F.struct("ref", "sum")).alias("constant"))  # by node of one tree
    varying = nodes.where("most = 1 OR 2 * most < n").groupBy("host").agg(F.collect_list(F.struct("ref", "mass")).alias("found"))  # by node of one tree
    slots = save(trees.join(varying, "host", "left").mapInPandas(_slots, "host string, slot int").join(constant, "host", "left"), "slots")

    both = parsed.join(slots, "host", "left")
    aligned = F.exists("blocks", lambda b: F.array_contains(b["refs"], F.col("slot")) & b["good"])
    both = both.withColumn("aligned", F.coalesce(aligned, F.lit(False)))
    chosen = F.filter("blocks", lambda b: b["good"] & F.when(F.col("aligned"), F.array_contains(b["refs"], F.col("slot"))).otherwise(b["own"]))
    same = lambda b: F.array_contains("constant", F.struct(F.get(b["refs"], F.size(b["refs"]) - 1).alias("ref"), b["sum"].alias("sum")))
    both = both.withColumn("chosen", chosen)
    kept = F.filter("chosen", lambda b: ~F.coalesce(F.col("aligned") & b["sum"].isNotNull() & same(b), F.lit(False)))
    chosen = F.when(F.size(kept) > 0, kept).otherwise(F.col("chosen"))
    text = F.coalesce(F.array_join(F.transform(chosen, lambda b: b["text"]), " "), F.lit(""))
    return both.select("page_id", "url", text.alias("text"), "host", "aligned").select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "host", "aligned")

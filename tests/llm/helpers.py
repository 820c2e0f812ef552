"""Brute-force versions and the edge-case table that the operators' tests share."""

import hashlib
import re
from collections import Counter

import duckdb

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = {c: c + 32 for c in range(65, 91)}
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def table(name):
    return duckdb.sql(f"SELECT * FROM '{SF}/{name}.parquet'").fetchall()


def documents():
    return [(r[0], r[1]) for r in duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()]


def prose(seed, n):
    """n words, different for each seed, that pass the quality rules."""
    import random

    r = random.Random(seed)
    common = ["the", "of", "and", "to", "in"]
    return " ".join(r.choice(common) if r.random() < 0.2 else "".join(r.choice("abcdefghiklmnoprstu") for _ in range(r.randint(3, 8))) for _ in range(n))


def edge_rows():
    """Nulls in every column, empty and very long texts, ties, repeated rows."""
    long = prose(1, 60_000)
    return [
        (1, None, None, None, None), (2, "", "", "", 0), (3, " \t\n\x0b\x0c\r ", "en", "a", 6), (4, long, "en", "a", len(long)),
        (5, long, "en", "b", len(long)), (6, prose(2, 100), "fr", None, 1), (7, prose(2, 100), "fr", None, 1), (8, "one two", "en", "a", 7),
        (9, "one two", None, "b", 7), (10, prose(2, 100) + " more", "de", "ü", 1), (11, "\x00 nul " + prose(3, 80), "es", "b", 1),
        (12, "word " * 300, "en", "a", 1), (12, "word " * 300, "en", "a", 1),
    ]


def components(rows, percent=75, width=5):
    sets = {}
    for d, t in rows:
        w = WORD.findall((t or "").translate(LOW))
        sets[d] = {tuple(w[i:i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())
    where, label = {}, {d: d for d in sets}
    for d, s in sets.items():
        for x in s:
            where.setdefault(x, []).append(d)

    def root(d):
        while label[d] != d:
            d = label[d]
        return d

    for d, s in sets.items():
        common = Counter(e for x in s for e in where[x] if e < d)
        for e, n in common.items():
            if 100 * n >= percent * (len(s) + len(sets[e]) - n):
                a, b = root(d), root(e)
                label[max(a, b)] = min(a, b)
    return {d: (len(sets[d]), root(d)) for d in sets}


def repeats(rows, length=400):
    rows = [(d, (t or "").encode()) for d, t in rows]
    seen = Counter(t[i:i + length] for _, t in rows for i in range(len(t) - length + 1))
    out = {}
    for d, t in rows:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out[d] = (len(t), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(t, gone) if not g)).hexdigest())
    return out


def quality(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    w = WORD.findall(text)
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    times = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if times[g] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)

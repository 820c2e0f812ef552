"""Token counts of whole texts by a public tokenizer, encoded in batches inside Arrow functions.

Only lengths leave the Arrow function. Texts are cut into pieces and the pieces gathered into batches of about
``batch_bytes`` UTF-8 bytes whatever the number of texts, so a task's memory follows one batch (and one Arrow
batch), neither the number of rows nor the longest text. No shuffle: each row is counted where it is read.

Where texts may be split, a batch's pieces are cut at every safe place and each distinct word is encoded once; the counts of
``MEMO_CHARS`` characters of words are kept from batch to batch (then forgotten all at once), so common words cost a
look-up.

A text above ``piece_bytes`` is split where no token can reach across. This is known for byte-level BPE with the
usual split pattern, no normaliser and no prefix blank: a run of blanks always begins a new pre-token after a
visible character, and nothing before the cut looks further than the blank itself. So a cut stands between a
word character or ASCII sign and an ASCII blank. A special token's text holds no blank before which a cut could
fall, which is checked. Where no such place comes, or for any other kind of tokenizer, the piece grows up to
the whole text: the count is exact in any case, only the memory follows the text.

The vocabulary file is read once on the driver (a few megabytes) and sent to the tasks, so that executors need
no copy. ``.json`` files are read by ``tokenizers``, ``.model`` files by ``sentencepiece``, each with its default
treatment of special strings inside texts, without added begin or end tokens, truncation or padding.

Defined results: a null text counts as empty (0 bytes, 0 tokens); repeated rows give repeated rows; an empty
table gives an empty result; columns other than the keys are left out, whatever their names.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwspark.llm.textbytes import column

VOCABULARY = "byte_bpe_50k.json"
LIMIT = 512
PIECE_BYTES = 1 << 16
BATCH_BYTES = 1 << 20
MEMO_CHARS = 1 << 21
CUT = re.compile(r"(?<=[\w!-~])(?=[ \t\n\r])")


def can_split(vocabulary: bytes) -> bool:
    """Whether :data:`CUT` is safe for the tokenizer of a ``.json`` file."""
    spec = json.loads(vocabulary)
    pre = spec.get("pre_tokenizer") or {}
    plain = not spec.get("normalizer") and not spec.get("post_processor") and spec["model"]["type"] == "BPE"
    byte_level = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space", True)
    added = spec.get("added_tokens", ())
    return bool(plain and byte_level and not any(
        CUT.search(t["content"]) or t["content"][:1].isspace() or t["lstrip"] or t["rstrip"] or t["single_word"] for t in added))


def by_word(lengths: Callable[[list[str]], list[int]], memo_chars: int = MEMO_CHARS) -> Callable[[list[str]], list[int]]:
    """The same numbers as ``lengths``, from the words of a batch, each encoded once."""
    known: dict[str, int] = {}
    held = 0

    def count(texts: list[str]) -> list[int]:
        nonlocal held
        words = [CUT.split(t) for t in texts]
        new = list(set(chain.from_iterable(words)) - known.keys())
        known.update(zip(new, lengths(new)))
        held += sum(map(len, new))
        found = [sum(map(known.__getitem__, w)) for w in words]
        if held > memo_chars:
            known.clear()
            held = 0
        return found

    return count


def encoder(path: str, vocabulary: bytes) -> tuple[Callable[[list[str]], list[int]], bool]:
    """A function from texts to their numbers of tokens, and whether texts may be split for it."""
    if path.endswith(".json"):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(vocabulary.decode())
        tokenizer.no_truncation()
        tokenizer.no_padding()
        lengths = lambda texts: [len(e) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        split = can_split(vocabulary)
        return (by_word(lengths) if split else lengths), split
    if path.endswith(".model"):
        import sentencepiece

        pieces = sentencepiece.SentencePieceProcessor(model_proto=vocabulary)
        return lambda texts: [len(e) for e in pieces.encode(texts, num_threads=1)], False
    raise ValueError(f"{path}: neither a .json nor a .model file")


def pieces(text: str, size: int) -> Iterator[str]:
    """``text`` in pieces of ``size`` characters or, up to the next safe place, a few more."""
    start = 0
    while len(text) - start > size:
        cut = CUT.search(text, start + size)
        if not cut:
            break
        yield text[start:cut.start()]
        start = cut.start()
    yield text[start:]


def batches(texts: Sequence[str], sizes: Sequence[int], piece_bytes: int, batch_bytes: int, split: bool) -> Iterator[tuple[list[int], list[str]]]:
    """Rows and pieces of all texts, in batches of about ``batch_bytes`` bytes."""
    rows: list[int] = []
    parts: list[str] = []
    held = 0
    for row, (text, n) in enumerate(zip(texts, sizes)):
        for part in (pieces(text, piece_bytes // 4) if split and n > piece_bytes else (text,)):
            if not part:
                continue
            size = n if len(part) == len(text) else len(part.encode())
            if parts and held + size > batch_bytes:
                yield rows, parts
                rows, parts, held = [], [], 0
            rows.append(row)
            parts.append(part)
            held += size
    if parts:
        yield rows, parts


def token_counts(docs: DataFrame, keys: Sequence[str] = ("doc_id",), text: str = "text", path: str | None = None,
                 piece_bytes: int = PIECE_BYTES, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """The ``keys`` of each row with ``n_bytes`` and ``n_tokens`` of its text."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(VOCABULARY)
    with open(path, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())
    rows = docs.select(*[F.col(k) for k in keys], F.col(text).cast("string").alias("_text"))
    out = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes[:-1]) + ", n_bytes long, n_tokens long"

    def count(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, split = encoder(path, shared.value)
        for batch in arrow:
            texts = batch.column(batch.num_columns - 1)
            _, offsets = column(texts)
            sizes = np.diff(offsets)
            tokens = np.zeros(len(sizes), np.int64)
            each = (value.as_py() or "" for value in texts)
            for owner, parts in batches(each, sizes.tolist(), piece_bytes, batch_bytes, split):
                np.add.at(tokens, owner, lengths(parts))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(sizes, pa.int64()), pa.array(tokens)], names=[*batch.schema.names[:-1], "n_bytes", "n_tokens"])

    return rows.mapInArrow(count, out)


def query(docs: DataFrame) -> DataFrame:
    return token_counts(docs).withColumn("over_limit", F.col("n_tokens") > LIMIT)

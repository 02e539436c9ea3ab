"""Token counts by the whole-token shortcut.

Offline, every vocabulary string is encoded on its own; those that are a single pre-token and
come back as exactly one id are *whole tokens*. A task splits texts into pre-tokens with the
public pattern, counts the whole ones by set membership and runs the byte-pair merges only
on the other distinct pre-tokens, remembering their counts.

Defined results: null text counts as empty (0 bytes, 0 tokens); strings of special tokens inside
a text are one token each, as the library does by default; texts of any length are counted
whole; repeated rows and null ids give one output row each; an empty table gives no rows.
Only the id and the text column are read, so other columns may have any name.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from slotcast.session import ship_package

# Fixed value: the public pattern that byte-level BPE splits text with before merging.
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+"
           r"|\s+(?!\S)|\s+")
MAX_TOKENIZER_BYTES = 64 << 20      # the broadcast file and set are bounded by this
CACHE_SIZE = 200_000                # remembered merge counts per Python worker
CHUNK_CHARS = 2_000_000             # texts are handled in runs of about this many characters


def _unmap_bytes() -> dict[str, int]:
    """Byte-level BPE writes byte b as a printable character: itself where printable, else
    the next free code point from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {chr(b): b for b in printable}
    for b in range(256):
        if b not in printable:
            table[chr(256 + len(table) - len(printable))] = b
    return table


def whole_tokens(tokenizer) -> frozenset[str]:
    """The vocabulary strings proved to encode alone as one token."""
    unmap, strings = _unmap_bytes(), []
    for piece in tokenizer.get_vocab(with_added_tokens=False):
        try:
            strings.append(bytes(unmap[c] for c in piece).decode())
        except (KeyError, UnicodeDecodeError):
            continue                        # part of a character: never a pre-token
    pre = tokenizer.pre_tokenizer.pre_tokenize_str
    encoded = tokenizer.encode_batch(strings, add_special_tokens=False)
    return frozenset(s for s, e in zip(strings, encoded) if len(e.ids) == 1 and len(pre(s)) == 1)


class _Counter:
    """Per-worker state: tokenizer, whole tokens, remembered merges and proved characters."""

    def __init__(self, blob: str, whole: frozenset[str]):
        import regex
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_str(blob)
        self.pre = self.tok.pre_tokenizer.pre_tokenize_str
        self.special = [a["content"] for a in json.loads(blob).get("added_tokens", [])]
        self.find = regex.compile(PATTERN).findall
        self.split = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))).split \
            if self.special else (lambda t: [t])
        self.whole, self.merged = whole, {}
        self.good: set[str] = set()
        self.bad: set[str] = set()

    def agrees(self, text: str) -> bool:
        """Whether the pattern engine and the library class every character alike (they can
        follow different Unicode versions); each character is probed once."""
        chars = set(text)
        for c in chars - self.good - self.bad:
            probe = f"a{c}a1{c}1 {c}{c} ,{c},"
            same = self.find(probe) == [probe[a:b] for _, (a, b) in self.pre(probe)]
            (self.good if same else self.bad).add(c)
        return self.bad.isdisjoint(chars)

    def counts(self, texts: list[str]) -> list[int]:
        totals, found = [], []
        for text in texts:
            parts = self.split(text)
            n, pieces = len(parts) - 1, Counter()
            for part in parts:
                if self.agrees(part):
                    pieces.update(self.find(part))
                else:
                    n += len(self.tok.encode(part, add_special_tokens=False).ids)
            rest = []
            for piece, k in pieces.items():
                if piece in self.whole:
                    n += k
                else:
                    rest.append((piece, k))
            totals.append(n)
            found.append(rest)
        new = list({p for rest in found for p, _ in rest if p not in self.merged})
        if len(self.merged) + len(new) > CACHE_SIZE:
            self.merged.clear()
            new = list({p for rest in found for p, _ in rest})
        for start in range(0, len(new), 20_000):
            some = new[start:start + 20_000]
            self.merged.update(zip(some, map(len, self.tok.encode_batch(some, add_special_tokens=False))))
        return [n + sum(k * self.merged[p] for p, k in rest) for n, rest in zip(totals, found)]


_STATE: dict[int, _Counter] = {}


def count_tokens(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 512) -> DataFrame:
    """One row per input row: id, n_bytes, n_tokens, over_limit. ``tokenizer_path`` is a
    byte-level BPE file of the ``tokenizers`` library, read on the driver."""
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    ship_package(spark)
    with open(tokenizer_path, encoding="utf-8") as f:
        blob = f.read()
    if len(blob) > MAX_TOKENIZER_BYTES:
        raise ValueError("tokenizer file is larger than the broadcast bound")
    shared = spark.sparkContext.broadcast((blob, whole_tokens(Tokenizer.from_str(blob))))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        key = hash(shared.value[0])
        if key not in _STATE:
            _STATE[key] = _Counter(*shared.value)
        state = _STATE[key]
        for frame in frames:
            texts = [t if isinstance(t, str) else "" for t in frame["__text"]]
            counts, start, size = [], 0, 0
            for i, t in enumerate(texts):
                size += len(t)
                if size >= CHUNK_CHARS or i == len(texts) - 1:
                    counts += state.counts(texts[start:i + 1])
                    start, size = i + 1, 0
            yield pd.DataFrame({"__id": frame["__id"], "n_bytes": frame["__bytes"],
                                "n_tokens": pd.Series(counts, dtype="int64")})

    schema = T.StructType([T.StructField("__id", docs.schema[id_col].dataType),
                           T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])
    text = docs[text_col].cast("string")
    rows = docs.select(docs[id_col].alias("__id"), text.alias("__text"),
                       F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("__bytes"))
    return rows.mapInPandas(run, schema).select(
        F.col("__id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))

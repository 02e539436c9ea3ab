"""Language identification by compression.

Per language, a raw-content zstandard dictionary is made of text snippets of labelled rows. A
text is cut into chunks, every chunk is compressed with each language's dictionary, and the
language with the smallest total wins. Narrow margins are reported as rejected.

Training sample (documented bound): per language ``buckets`` snippets of ``snippet_chars``
characters. Training texts are dealt into buckets by hash and each bucket keeps the text with
the smallest second hash, so one partial aggregation gathers them without a per-language
group; a snippet is a window drawn from the whole text that holds a letter; and the driver holds at most languages x buckets x snippet_chars characters.

Defined results: null texts and texts without any letter give ``und`` with score 0; without
training rows every text does; rows with null text, null or empty lang or letterless text teach nothing;
equal sizes go to the alphabetically first language; repeated rows give equal rows; whole texts
are encoded; only the id, text and lang columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from slotcast.session import ship_package

UNDETERMINED = "und"
LETTER = "\\p{L}"
LEVEL = 3
CHUNK_BYTES = 2048
SHARPNESS = 40.0        # score = 1 / sum over languages of 2^(-SHARPNESS * relative excess size)


def snippet(text: Column, draw: Column, chars: int) -> Column:
    """A window of ``chars`` characters of the text, at a place drawn from all; without a letter there, the window
    from the text's first letter on."""
    places = F.greatest(F.length(text) - chars + 1, F.lit(1))
    window = F.substring(text, (F.pmod(draw, places) + 1).cast("int"), F.lit(chars))
    return F.when(window.rlike(LETTER), window).otherwise(F.substring(text, F.regexp_instr(text, F.lit(LETTER)), F.lit(chars)))


def train_dictionaries(docs: DataFrame, where: Column, text_col: str = "text", lang_col: str = "lang",
                       buckets: int = 32, snippet_chars: int = 4096) -> dict[str, bytes]:
    """Raw dictionary content of each language among the rows that satisfy ``where``."""
    text = F.col("__text")
    rows = (docs.where(where)
            .select(docs[text_col].cast("string").alias("__text"), docs[lang_col].cast("string").alias("__lang"))
            .where(F.col("__lang").isNotNull() & (F.col("__lang") != "") & text.rlike(LETTER))
            .withColumn("__bucket", F.pmod(F.xxhash64(text, F.lit(1)), F.lit(buckets)))
            .withColumn("__key", F.xxhash64(text, F.lit(2)))
            .withColumn("__text", snippet(text, F.xxhash64(text, F.lit(3)), snippet_chars)))
    picked = rows.groupBy("__lang", "__bucket").agg(F.min(F.struct("__key", "__text")).alias("p")).collect()
    found: dict[str, list] = {}
    for r in sorted(picked, key=lambda r: (r["__lang"], r["__bucket"])):
        found.setdefault(r["__lang"], []).append(r["p"]["__text"])
    return {lang: "\n".join(texts).encode("utf-8", "replace") for lang, texts in found.items()}


class Coder:
    """One compressor per language."""

    def __init__(self, dictionaries: dict[str, bytes]):
        import zstandard as z

        self.langs = sorted(dictionaries)
        self.coders = []
        for lang in self.langs:
            d = z.ZstdCompressionDict(dictionaries[lang], dict_type=z.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=LEVEL)
            self.coders.append(z.ZstdCompressor(level=LEVEL, dict_data=d, write_checksum=False,
                                                write_content_size=False, write_dict_id=False).compress)

    def sizes(self, text: str) -> list[int]:
        raw = text.encode("utf-8", "replace")
        chunks = [raw[i:i + CHUNK_BYTES] for i in range(0, len(raw), CHUNK_BYTES)]
        return [sum(len(code(c)) for c in chunks) for code in self.coders]

    def classify(self, text: str | None) -> tuple[str, float, float]:
        """(language, score, relative margin to the second-best)."""
        if not text or not self.langs or not any(map(str.isalpha, text)):
            return UNDETERMINED, 0.0, 0.0
        sizes = self.sizes(text)
        best = min(sizes)
        excess = [(s - best) / best for s in sizes]
        others = sorted(excess)[1:]
        score = 1.0 / sum(2.0 ** (-SHARPNESS * e) for e in excess)
        return self.langs[sizes.index(best)], score, others[0] if others else 1.0


def identify(docs: DataFrame, dictionaries: dict[str, bytes], id_col: str = "doc_id", text_col: str = "text",
             min_margin: float = 0.01) -> DataFrame:
    """One row per input row: id, lang_pred, score, margin, accepted (false where the second-best
    language is within ``min_margin``, and for ``und``)."""
    ship_package(docs.sparkSession)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = Coder(dictionaries)
        for frame in frames:
            out = [coder.classify(t if isinstance(t, str) else None) for t in frame["__text"]]
            yield pd.DataFrame({"__id": frame["__id"], "lang_pred": [o[0] for o in out],
                                "score": [o[1] for o in out], "margin": [o[2] for o in out]})

    schema = T.StructType([T.StructField("__id", docs.schema[id_col].dataType),
                           T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
                           T.StructField("margin", T.DoubleType())])
    rows = docs.select(docs[id_col].alias("__id"), docs[text_col].cast("string").alias("__text"))
    return rows.mapInPandas(run, schema).select(
        F.col("__id").alias(id_col), "lang_pred", "score", "margin",
        ((F.col("margin") >= min_margin) & (F.col("lang_pred") != UNDETERMINED)).alias("accepted"))

"""Vector code compression: integer product codes, the nearest entry found by Orchard's search.

Components become the integers floor(scale * x). A vector is cut into ``parts`` consecutive parts; each
part position has a codebook of up to ``entries`` entries, started from the vectors of the smallest ids
and improved by ``rounds`` rounds of assignment and componentwise floor(sum / count). The code of a
vector is the index of the nearest entry of every part.

Nearest entries come from Orchard's search: every entry holds the list of all entries sorted by their
distance from it. A query walks the list of its best entry so far, marks what it has seen, jumps to the
list of any entry that is nearer, and stops where the list passes twice the best distance: by the
triangle inequality no entry further on can be as near. The walk starts at the nearest of a few entries.
Distances are whole numbers below 2^53, so double arithmetic is exact and ties go to the lower index.

Scale: a round is one scan of the kept vectors; each task sends at most parts * entries partial sums,
which Spark adds up; the driver holds only codebooks (parts * entries entries), never vectors. Equal labels
are summed by an aggregation and joined back; labels that hold more than a thousandth of the rows (a
thousand at most) are joined by broadcast, so no label is gathered in one task.

Defined results: vectors null or with null or non-finite components, and vectors of another length than
the most frequent (ties: the longer), are left out. A length that ``parts`` does not divide gives the first
parts one component more. Null ids are coded but start no codebook; of rows that share an id the least
vector starts it; repeated rows give equal rows. Fewer kept ids than ``entries`` give fewer entries. Empty
tables give no rows. A component of which the square sums could pass 2^53 is refused with an error.
Only the id, vector and label columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from slotcast.session import cut_lineage, ship_package

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
STARTS = 16         # entries compared before the walk begins
STEP = 8            # list places looked at per turn of the walk
BLOCK = 8192        # vectors searched together
HOT_SHARE = 1000    # labels with more than 1 / HOT_SHARE of the rows are joined by broadcast


def part_slices(width: int, parts: int) -> list[slice]:
    edges = np.cumsum([0] + [width // parts + (i < width % parts) for i in range(parts)])
    return [slice(int(a), int(b)) for a, b in zip(edges, edges[1:])]


class Orchard:
    """One part's codebook with the distance-sorted list of every entry."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries.astype(np.float64)
        self.norms = (self.entries ** 2).sum(axis=1)
        gaps = self.norms[:, None] + self.norms[None, :] - 2.0 * (self.entries @ self.entries.T)
        self.lists = np.argsort(gaps, axis=1, kind="stable")
        self.gaps = np.take_along_axis(gaps, self.lists, axis=1)
        self.starts = np.unique(np.linspace(0, len(entries) - 1, min(STARTS, len(entries))).astype(int))

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, squared distance) of the nearest entry of every row of ``x``."""
        n, size = len(x), len(self.entries)
        index, distance = np.zeros(n, dtype=np.int64), np.zeros(n)
        for at in range(0, n, BLOCK):
            index[at:at + BLOCK], distance[at:at + BLOCK] = self._walk(x[at:at + BLOCK].astype(np.float64), size)
        return index, distance.astype(np.int64)

    def _walk(self, x: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        norm = (x ** 2).sum(axis=1)
        first = norm[:, None] + self.norms[self.starts][None, :] - 2.0 * (x @ self.entries[self.starts].T)
        lead = first.argmin(axis=1)
        best, dist = self.starts[lead], first[np.arange(len(x)), lead]
        marked = np.zeros((len(x), size), dtype=bool)
        marked[:, self.starts] = True
        place = np.zeros(len(x), dtype=np.int64)
        live = np.arange(len(x))
        while len(live):
            spots = place[live][:, None] + np.arange(STEP)[None, :]
            inside = spots < size
            spots = np.minimum(spots, size - 1)
            row = best[live][:, None]
            seen = self.lists[row, spots]
            near = inside & (self.gaps[row, spots] <= 4.0 * dist[live][:, None])
            fresh = near & ~marked[live[:, None], seen]
            q, s = np.nonzero(fresh)
            found = np.full(seen.shape, np.inf)
            who = seen[q, s]
            found[q, s] = norm[live[q]] + self.norms[who] - 2.0 * np.einsum("ij,ij->i", x[live[q]], self.entries[who])
            marked[live[q], who] = True
            least = found.min(axis=1)
            entry = np.where(found == least[:, None], seen, size).min(axis=1)
            better = (least < dist[live]) | ((least == dist[live]) & (entry < best[live]))
            moved = live[better]
            best[moved], dist[moved], place[moved] = entry[better], least[better], 0
            place[live[~better]] += STEP
            live = live[better | near[:, -1]]
        return best, dist


@dataclass
class Codebooks:
    """Final integer entries by part."""

    entries: list[np.ndarray]
    width: int

    def digest(self) -> str:
        """sha256 over the entries' decimal components by part, entry and position, joined by commas."""
        return hashlib.sha256(",".join(str(int(v)) for part in self.entries for v in part.ravel()).encode()).hexdigest()


def kept_vectors(vectors: DataFrame, id_col: str, vec_col: str, label_col: str | None, scale: int) -> DataFrame:
    """(vec_id, label, v) of the rows that take part, v as integers; written once."""
    label = vectors[label_col] if label_col else F.lit(None).cast("int")
    rows = vectors.select(vectors[id_col].cast("long").alias("vec_id"), label.alias("label"),
                          vectors[vec_col].cast("array<double>").alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    limit = float(1 << 22)      # (2 * 2^22)^2 * 128 components = 2^53
    whole = F.transform("v", lambda x: F.when(F.abs(x * scale) < limit, F.floor(x * scale)).otherwise(
        F.raise_error(F.lit(f"component beyond {limit} after scaling")).cast("long")).cast("int"))
    kept = cut_lineage(rows.where(F.col("v").isNotNull() & ~bad).withColumn("v", whole))
    width = kept.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("c")).orderBy(F.desc("c"), F.desc("d")).first()
    return kept.where(F.size("v") == width["d"]) if width else kept


def train(kept: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks:
    """Codebooks from (vec_id, v) rows of equal length."""
    ship_package(kept.sparkSession)
    first = (kept.where("vec_id is not null").select("vec_id", "v").groupBy("vec_id").agg(F.min("v").alias("v"))
             .orderBy("vec_id").limit(entries).collect())
    width = len(first[0]["v"]) if first else 0
    if width > 128 * parts:
        raise ValueError("vectors of more than 128 components a part are not summed exactly")
    start = np.array([r["v"] for r in first], dtype=np.int64).reshape(len(first), width)
    cuts = part_slices(width, parts)
    books = [start[:, c] for c in cuts]
    if not first:
        return Codebooks(books, width)
    deep = max(c.stop - c.start for c in cuts)
    schema = "part int, entry int, n long, " + ", ".join(f"s{i} long" for i in range(deep))

    for _ in range(rounds):
        def sums(frames: Iterator[pd.DataFrame], books=books) -> Iterator[pd.DataFrame]:
            search = [Orchard(b) for b in books]
            count = np.zeros((parts, len(start)), dtype=np.int64)
            total = np.zeros((parts, len(start), deep), dtype=np.int64)
            for f in frames:
                if not len(f):
                    continue
                x = np.vstack(f["v"])
                for p, c in enumerate(cuts):
                    near, _ = search[p].nearest(x[:, c])
                    count[p] += np.bincount(near, minlength=len(start))
                    np.add.at(total[p][:, :c.stop - c.start], near, x[:, c])
            p, e = np.nonzero(count)
            out = pd.DataFrame({"part": p, "entry": e, "n": count[p, e]})
            for i in range(deep):
                out[f"s{i}"] = total[p, e, i]
            yield out

        partial = kept.select("v").mapInPandas(sums, schema)
        added = partial.groupBy("part", "entry").agg(
            F.sum("n").alias("n"), *[F.sum(f"s{i}").alias(f"s{i}") for i in range(deep)]).collect()   # parts * entries
        books = [b.copy() for b in books]
        for r in added:
            c = cuts[r["part"]]
            books[r["part"]][r["entry"]] = [r[f"s{i}"] // r["n"] for i in range(c.stop - c.start)]
    return Codebooks(books, width)


def encode(kept: DataFrame, books: Codebooks) -> DataFrame:
    """(vec_id, label, code, error): the entry index of every part, two hex digits or more each."""
    ship_package(kept.sparkSession)
    parts = len(books.entries)
    cuts = part_slices(books.width, parts)
    digits = max(2, len(f"{max(1, len(books.entries[0])) - 1:x}"))

    def code(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        search = [Orchard(b) for b in books.entries]
        for f in frames:
            if not len(f):
                continue
            x = np.vstack(f["v"])
            found = [search[p].nearest(x[:, c]) for p, c in enumerate(cuts)]
            text = ["".join(f"{i:0{digits}x}" for i in row) for row in zip(*(i.tolist() for i, _ in found))]
            yield pd.DataFrame({"vec_id": f["vec_id"], "label": f["label"], "code": text,
                                "error": sum(d for _, d in found)})

    schema = T.StructType([kept.schema["vec_id"], kept.schema["label"], T.StructField("code", T.StringType()),
                           T.StructField("error", T.LongType())])
    return kept.select("vec_id", "label", "v").mapInPandas(code, schema)


def add_label_error(coded: DataFrame) -> DataFrame:
    """``coded`` with label_error, the error summed over the rows of an equal label (nulls together)."""
    by_label = cut_lineage(coded.groupBy("label").agg(F.sum("error").alias("label_error"), F.count("*").alias("__n")))
    rows = by_label.agg(F.coalesce(F.sum("__n"), F.lit(0))).first()[0]
    by_label = by_label.withColumnRenamed("label", "__label")
    hot = by_label.where(F.col("__n") * HOT_SHARE > rows).withColumnRenamed("label_error", "__hot")
    out = coded.join(F.broadcast(hot.drop("__n")), coded["label"].eqNullSafe(F.col("__label")), "left").drop("__label")
    rest = by_label.where(F.col("__n") * HOT_SHARE <= rows).withColumnRenamed("label_error", "__rest").drop("__n")
    if rest.isEmpty():
        return out.withColumnRenamed("__hot", "label_error")
    served = out.where("__hot is not null").withColumnRenamed("__hot", "label_error")
    others = out.where("__hot is null").drop("__hot")
    others = others.join(rest, others["label"].eqNullSafe(F.col("__label"))).drop("__label")
    return served.unionByName(others.withColumnRenamed("__rest", "label_error"))


def compress(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str | None = "label",
             parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """One row per kept row: vec_id, code, error, label_error, codebooks_sha256."""
    kept = kept_vectors(vectors, id_col, vec_col, label_col, scale)
    books = train(kept, parts, entries, rounds)
    if not len(books.entries[0]):
        return kept.limit(0).select("vec_id", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"),
                                    F.lit(0).cast("long").alias("label_error"), F.lit("").alias("codebooks_sha256"))
    coded = add_label_error(cut_lineage(encode(kept, books)))
    return coded.select("vec_id", "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))


def oracle(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> str:
    """DuckDB SQL of ``op11``: every part against every entry, round by round."""
    steps = [f"""
WITH k AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, label, [CAST(floor(CAST(x AS DOUBLE) * {scale}) AS BIGINT) for x in embedding] AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
x AS MATERIALIZED (
  SELECT rid, p, list_slice(v, p * len(v) // {parts} + 1, (p + 1) * len(v) // {parts}) AS y
  FROM k, (SELECT CAST(range AS INTEGER) AS p FROM range({parts}))),
b0 AS MATERIALIZED (
  SELECT x.p, o.e, x.y FROM x JOIN (
    SELECT rid, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM k ORDER BY vec_id LIMIT {entries}) o USING (rid))"""]
    for i in range(rounds + 1):
        steps.append(f"""
a{i} AS MATERIALIZED (
  SELECT rid, p, min((d, e)) AS best FROM (
    SELECT x.rid, x.p, b.e, CAST(list_sum([(z[1] - z[2]) * (z[1] - z[2]) for z in list_zip(x.y, b.y)]) AS BIGINT) AS d
    FROM x JOIN b{i} b USING (p)) GROUP BY 1, 2)""")
        if i < rounds:
            steps.append(f"""
m{i} AS MATERIALIZED (
  SELECT p, e, list(s ORDER BY j) AS y FROM (
    SELECT x.p, a.best[2] AS e, j, CAST(floor(sum(x.y[j])::DOUBLE / count(*)) AS BIGINT) AS s
    FROM x JOIN a{i} a USING (rid, p), (SELECT unnest(range(1, 65)) AS j) WHERE j <= len(x.y) GROUP BY 1, 2, 3) GROUP BY 1, 2),
b{i + 1} AS MATERIALIZED (SELECT b.p, b.e, coalesce(m.y, b.y) AS y FROM b{i} b LEFT JOIN m{i} m USING (p, e))""")
    return ",".join(steps) + f""",
c AS (
  SELECT rid, string_agg(lpad(to_hex(best[2]), 2, '0'), '' ORDER BY p) AS code, CAST(sum(best[1]) AS BIGINT) AS error
  FROM a{rounds} GROUP BY 1),
h AS (SELECT lower(sha256(string_agg(array_to_string(y, ','), ',' ORDER BY p, e))) AS codebooks_sha256 FROM b{rounds})
SELECT vec_id, lower(code) AS code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM k JOIN c USING (rid), h"""

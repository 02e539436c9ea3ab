"""Mixing sources to target weights by hierarchical budgeting.

Leaves of a domain - language - source tree are aggregated from the rows. A token budget flows
down the tree by weight, level by level. A node takes at most its capacity (tokens x ``max_epochs``);
what it cannot use goes to its siblings by their weights (water filling in closed form, by sorting
on capacity / weight), and only what a whole family cannot use reaches the families above.
Budgets are rounded down to whole tokens at every node.

Each leaf then takes whole epochs of its rows plus a prefix of one more epoch: rows are ordered
by a seeded hash of the epoch number and the row's key, and the prefix is the longest that fits the
rest of the budget. The cut is found on token sums of hash buckets and exactly within one bucket,
so no leaf is ever sorted in one task; selecting is a comparison with one cut per leaf.

Defined results: null domain, language or source are leaves of their own; null text has 0
tokens; rows equal in id and text share a hash and stand or fall together; an empty table or a
zero budget selects nothing; equal ratios need no tie rule (any order gives the same shares).
Extra columns pass untouched.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

from slotcast.llm.common import WORD_PATTERN
from slotcast.llm.sharding import BITS, MARK, hash60, key_text
from slotcast.session import cut_lineage

LEVELS = ["domain", "lang", "source"]
BUCKET_BITS = 12
MAX_BROADCAST_LEAVES = 100_000
NULL = "\u0001null"


def word_tokens(text: Column) -> Column:
    """Words of a text as its token count."""
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def source_family(source: Column, families: int = 4) -> Column:
    """Domain of a source: the trailing number of its name modulo ``families``."""
    number = F.regexp_extract(source, "([0-9]+)$", 1)
    return F.when(number != "", F.concat(F.lit("family"), (number.cast("long") % families).cast("string")))


def _weight(name: Column, weights: Mapping[str, int]) -> Column:
    w = F.lit(1)
    for k, v in weights.items():
        w = F.when(name == k, F.lit(v)).otherwise(w)
    return F.coalesce(w, F.lit(1)).cast("double")


def share_out(nodes: DataFrame, parents: list[str], name: str) -> DataFrame:
    """Split ``budget`` (equal within a family) over the rows of each family: adds ``got``.
    ``nodes`` has the columns ``parents``, ``name``, cap, w and budget."""
    family = Window.partitionBy(*parents) if parents else Window.partitionBy(F.lit(0))
    by_need = family.orderBy(F.col("cap") / F.col("w"), name)
    before = by_need.rowsBetween(Window.unboundedPreceding, -1)
    out = (nodes.withColumn("w_all", F.sum("w").over(family))
           .withColumn("cap_before", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
           .withColumn("w_left", F.col("w_all") - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
           .withColumn("fair", (F.col("budget") - F.col("cap_before")) / F.col("w_left"))
           .withColumn("full", F.col("cap") <= F.col("fair") * F.col("w")))
    # the level of the first node that its share does not fill holds for all after it
    level = F.first(F.when(~F.col("full"), F.col("fair")), ignorenulls=True).over(
        by_need.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return (out.withColumn("level", level)
            .withColumn("got", F.when(F.col("full"), F.col("cap"))
                        .otherwise(F.floor(F.col("level") * F.col("w")).cast("double")))
            .drop("w_all", "cap_before", "w_left", "fair", "full", "level", "budget"))


def allocate(leaves: DataFrame, budget: Column, weights: Mapping[str, Mapping[str, int]],
             max_epochs: int) -> DataFrame:
    """Leaf budgets. ``leaves`` has LEVELS and ``tokens``; ``budget`` is a column over one row."""
    caps = leaves.withColumn("cap", F.col("tokens").cast("double") * max_epochs)
    got = None
    for i, level in enumerate(LEVELS):
        parents = LEVELS[:i]
        nodes = caps.groupBy(*parents, level).agg(F.sum("cap").alias("cap")).withColumn(
            "w", _weight(F.col(level), weights.get(level, {})))
        if got is None:
            total = leaves.agg(F.sum("tokens").alias("tokens")).select(budget.cast("double").alias("budget"))
            nodes = nodes.withColumn("k", F.lit(1)).join(total.withColumn("k", F.lit(1)), "k").drop("k")
        else:
            nodes = nodes.join(got, parents)
        got = share_out(nodes, parents, level).select(*parents, level, F.col("got").alias("budget"))
    return got


def prepare(docs: DataFrame, domain: Column, lang: Column, source: Column, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """Leaf, key and tokens of every row."""
    name = lambda c: F.coalesce(c.cast("string"), F.lit(NULL))
    return docs.select(name(domain).alias("domain"), name(lang).alias("lang"), name(source).alias("source"),
                       key_text(docs[id_col], docs[text_col]).alias("__key"),
                       word_tokens(docs[text_col]).alias("tokens"), docs[id_col].alias("__id"))


def epoch_hash(key: Column, epoch: Column, seed: int) -> Column:
    return hash60(F.concat(F.lit(f"{seed}:"), epoch.cast("long").cast("string"), F.lit(":"), key))


def plan(rows: DataFrame, weights: Mapping[str, Mapping[str, int]], budget: Column, max_epochs: int,
         seed: int) -> DataFrame:
    """One row per leaf: LEVELS, epochs (whole), cut (largest hash of the prefix, -1: none)."""
    leaves = cut_lineage(rows.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens")))
    shares = cut_lineage(
        allocate(leaves, budget, weights, max_epochs).join(leaves, LEVELS)
        .withColumn("epochs", F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens"))).otherwise(0)
                    .cast("long"))
        .withColumn("rest", F.col("budget").cast("long") - F.col("epochs") * F.col("tokens"))
        .select(*LEVELS, "epochs", "rest"))
    hashed = (_with_leaf(rows, shares).where("rest > 0")
              .withColumn("__h", epoch_hash(F.col("__key"), F.col("epochs"), seed))
              .withColumn("__b", F.shiftright("__h", BITS - BUCKET_BITS)))
    run = Window.partitionBy(*LEVELS).orderBy("__b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    buckets = (hashed.groupBy(*LEVELS, "__b").agg(F.sum("tokens").alias("t"), F.first("rest").alias("rest"))
               .withColumn("upto", F.sum("t").over(run)).where("upto > rest")
               .groupBy(*LEVELS).agg(F.min(F.struct("__b", (F.col("rest") - F.col("upto") + F.col("t")).alias("left")))
                                     .alias("m"))
               .select(*LEVELS, F.col("m.__b").alias("__edge"), F.col("m.left").alias("left")))
    edge = cut_lineage(buckets)
    within = Window.partitionBy(*LEVELS).orderBy("__h").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = (_with_leaf(hashed, edge).where("__b = __edge").groupBy(*LEVELS, "__h")
              .agg(F.sum("tokens").alias("t"), F.first("left").alias("left"))
              .withColumn("upto", F.sum("t").over(within)).where("upto <= left")
              .groupBy(*LEVELS).agg(F.max("__h").alias("last")))
    cut = F.coalesce(F.col("last"), (F.col("__edge") * F.lit(1 << (BITS - BUCKET_BITS))) - 1, F.lit(-1))
    return cut_lineage(shares.join(edge, LEVELS, "left").join(inside, LEVELS, "left")
                       .select(*LEVELS, "epochs", cut.alias("cut")))


def _with_leaf(rows: DataFrame, leaves: DataFrame) -> DataFrame:
    """Attach leaf columns: broadcast when the counted leaves are few, else a plain join."""
    if leaves.count() <= MAX_BROADCAST_LEAVES:
        leaves = F.broadcast(leaves)
    return rows.join(leaves, LEVELS)


def copies(epochs: Column, key: Column, cut: Column, seed: int) -> Column:
    """How often a row is taken."""
    return epochs + F.when(epoch_hash(key, epochs, seed) <= cut, 1).otherwise(0)


def mix(docs: DataFrame, domain: Column, lang: Column, source: Column, weights: Mapping[str, Mapping[str, int]],
        budget: Column, max_epochs: int = 2, seed: int = 7, id_col: str = "doc_id",
        text_col: str = "text") -> DataFrame:
    """One row per selected row: id, LEVELS, n_tokens, copies. ``budget`` is a column over the
    corpus's ``tokens``."""
    rows = cut_lineage(prepare(docs, domain, lang, source, id_col, text_col))
    leaf_plan = plan(rows, weights, budget, max_epochs, seed)
    out = _with_leaf(rows, leaf_plan).withColumn("copies", copies(F.col("epochs"), F.col("__key"), F.col("cut"), seed))
    label = [F.when(F.col(c) != NULL, F.col(c)).alias(c) for c in LEVELS]
    return out.where("copies > 0").select(F.col("__id").alias(id_col), *label, F.col("tokens").alias("n_tokens"), "copies")


def select_rows(docs: DataFrame, domain: Column, lang: Column, source: Column,
                weights: Mapping[str, Mapping[str, int]], budget: Column, max_epochs: int = 1, seed: int = 7,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The selected rows of ``docs`` with all their columns, a row taken n times n times over."""
    rows = cut_lineage(prepare(docs, domain, lang, source, id_col, text_col))
    leaf_plan = plan(rows, weights, budget, max_epochs, seed)
    names = [f"__{c}" for c in LEVELS]
    p = leaf_plan.select(*[F.col(c).alias(n) for c, n in zip(LEVELS, names)], F.col("epochs").alias("__epochs"),
                         F.col("cut").alias("__cut"))
    if leaf_plan.count() <= MAX_BROADCAST_LEAVES:
        p = F.broadcast(p)
    wide = docs
    for n, c in zip(names, (domain, lang, source)):
        wide = wide.withColumn(n, F.coalesce(c.cast("string"), F.lit(NULL)))
    taken = copies(F.col("__epochs"), key_text(docs[id_col], docs[text_col]), F.col("__cut"), seed)
    out = wide.join(p, names).withColumn("__copies", taken.cast("int")).where("__copies > 0")
    if max_epochs > 1:
        out = out.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies"))))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def oracle(weights: Mapping[str, Mapping[str, int]], num: int, den: int, max_epochs: int, seed: int,
           families: int = 4) -> str:
    """DuckDB SQL of ``op8`` with plain windows over whole leaves."""
    def w(level):
        cases = "".join(f" WHEN {level} = '{k}' THEN {v}" for k, v in weights.get(level, {}).items())
        return f"CAST(CASE{cases} ELSE 1 END AS DOUBLE)" if cases else "CAST(1 AS DOUBLE)"

    ctes, got = [], f"(SELECT CAST(floor(sum(tokens) * {num} / {den}) AS DOUBLE) AS budget FROM leaf)"
    for i, level in enumerate(LEVELS):
        up = LEVELS[:i]
        part = f"PARTITION BY {', '.join(up)}" if up else ""
        keys = ", ".join([*up, level])
        join = f"JOIN s{i - 1} USING ({', '.join(up)})" if up else f"CROSS JOIN {got}"
        ctes.append(f"""n{i} AS (SELECT {keys}, cap, {w(level)} AS w, budget FROM
  (SELECT {keys}, sum(CAST(tokens AS DOUBLE) * {max_epochs}) AS cap FROM leaf GROUP BY ALL) {join}),
a{i} AS (SELECT *, (budget - coalesce(sum(cap) OVER b, 0)) / (sum(w) OVER ({part}) - coalesce(sum(w) OVER b, 0)) AS fair
  FROM n{i} WINDOW b AS ({part} ORDER BY cap / w, {level} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l{i} AS (SELECT *, first(CASE WHEN NOT cap <= fair * w THEN fair END IGNORE NULLS) OVER ({part} ORDER BY cap / w, {level}
  ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS lev FROM a{i}),
s{i} AS (SELECT {keys}, CASE WHEN cap <= fair * w THEN cap ELSE floor(lev * w) END AS budget FROM l{i})""")
    return f"""
WITH r AS (
  SELECT doc_id, coalesce(CASE WHEN regexp_extract(source, '([0-9]+)$', 1) <> ''
      THEN 'family' || (CAST(regexp_extract(source, '([0-9]+)$', 1) AS BIGINT) % {families}) END, chr(1) || 'null') AS domain,
    coalesce(lang, chr(1) || 'null') AS lang, coalesce(source, chr(1) || 'null') AS source,
    md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || md5(coalesce(text, chr(0)))) AS k,
    CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS tokens
  FROM documents),
leaf AS (SELECT domain, lang, source, sum(tokens) AS tokens FROM r GROUP BY ALL),
{', '.join(ctes)},
p AS (SELECT domain, lang, source, CAST(CASE WHEN tokens > 0 THEN floor(budget / tokens) ELSE 0 END AS BIGINT) AS e,
  CAST(budget AS BIGINT) AS budget, tokens AS lt FROM s2 JOIN leaf USING (domain, lang, source)),
h AS (SELECT r.*, e, budget - e * lt AS rest,
  CAST('0x' || substr(md5('{seed}:' || e || ':' || k), 1, 15) AS BIGINT) AS h FROM r JOIN p USING (domain, lang, source)),
c AS (SELECT *, sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY h
  RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto,
  sum(tokens) OVER (PARTITION BY domain, lang, source) AS lt FROM h),
x AS (SELECT *, e + CASE WHEN rest > 0 AND upto <= rest THEN 1 ELSE 0 END AS copies FROM c)
SELECT doc_id, nullif(domain, chr(1) || 'null') AS domain, nullif(lang, chr(1) || 'null') AS lang,
  nullif(source, chr(1) || 'null') AS source, tokens AS n_tokens, copies FROM x WHERE copies > 0"""

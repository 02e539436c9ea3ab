"""Chat formatting in budgeted, turn-aligned windows, with DataFrame functions only.

A conversation becomes one or more windows of text. Prefix sums of its turns' tokens lay the turns on a
line, cut into cells of the room that the budget leaves beside the system turn and the history. The turns
that lie within one cell are the own turns of a window; a turn that crosses into another cell is a window
by itself. Every window starts with the conversation's system turn (if its first turn is one), repeats the
last whole turns of at most ``history`` tokens before its own, and then has its own turns. So a window is
within ``budget`` tokens unless one new turn is too long for the room or the system turn leaves less room
than ``history`` (``over_budget``); turns are never cut.

Template: ``<s>``, then per turn an opening mark, the text and a closing mark: ``[SYS]`` ``[/SYS]`` for system,
``[INST]`` ``[/INST]`` for user, ``[ANS]`` ``</s>`` for assistant, ``[ROLE hex]`` ``[/ROLE]`` for any other role (its
UTF-8 in hex; a null role has no hex). A mark that occurs in a text gets a tilde after its first character,
one more where it has tildes already, so texts hold no mark and ``unescape`` gives them back exactly.
``loss_spans`` are the code-point ranges (start, end) of the assistant texts among a window's own turns:
repeated turns, marks and other roles are masked.

Scale: prefix sums are taken over rows without their texts, range-partitioned by (conversation, turn), in
each partition and carried over between partitions; windows meet their history by (conversation, cell) and
their system turn by (conversation, block of cells). A conversation that holds a third of all rows is thus
spread over tasks, and no more than a window is gathered in one row. Texts are shuffled twice: to their
places and to their windows.

Defined results: rows are ordered by turn (null first), then role, then md5 of the text; null text is empty;
repeated rows are repeated turns; null conversation ids are one conversation; a turn counts one token at
least; an empty table gives no rows. Only the four columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from slotcast.llm.common import written

BUDGET = 2048
HISTORY = 512
TURN_TOKENS = 4         # marks of a turn
BYTES_PER_TOKEN = 4
CELL_BLOCK = 1024

# A mark is an opening character and a rest without one, so that marks in a text never overlap.
MARKS = "([<\\[])(~*)(/?s>|/?SYS\\]|/?INST\\]|ANS\\]|/?ROLE\\]|ROLE [0-9A-F]*\\])"
ESCAPED = MARKS.replace("(~*)", "~(~*)")
ROLES = {"system": ("[SYS]", "[/SYS]"), "user": ("[INST]", "[/INST]"), "assistant": ("[ANS]", "</s>")}
START = "<s>"
TURN_END = "(?<=[>\\]])(?<=</s>|\\[/INST\\]|\\[/SYS\\]|\\[/ROLE\\])"
TURN = "(?s)^\\[([^\\]]*)\\](.*)(?:</s>|\\[/[A-Z]+\\])\\z"


def _where_marked(text: Column, changed: Column) -> Column:
    """``changed`` only for texts that hold an opening character: the others need no pattern search."""
    return F.when((F.instr(text, "<") > 0) | (F.instr(text, "[") > 0), changed).otherwise(text)


def escape(text: Column) -> Column:
    return _where_marked(text, F.regexp_replace(text, MARKS, "$1~$2$3"))


def unescape(text: Column) -> Column:
    return _where_marked(text, F.regexp_replace(text, ESCAPED, "$1$2$3"))


def estimated_tokens(text: Column) -> Column:
    """A turn's tokens from its bytes; pass exact counts to ``format_windows`` where they are at hand."""
    return F.ceil(F.octet_length(text) / BYTES_PER_TOKEN) + TURN_TOKENS


def _mark(role: Column, side: int) -> Column:
    named = F.concat(F.lit("[ROLE"), F.coalesce(F.concat(F.lit(" "), F.hex(F.encode(role, "UTF-8"))), F.lit("")), F.lit("]"))
    out = F.when(role.isNull(), named if side == 0 else F.lit("[/ROLE]"))
    for name, marks in ROLES.items():
        out = out.when(role == name, F.lit(marks[side]))
    return out.otherwise(named if side == 0 else F.lit("[/ROLE]"))


def _meet(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on ``keys``, nulls equal; the keys once."""
    other = right.select(*[F.col(c).alias(f"__{c}" if c in keys else c) for c in right.columns])
    on = None
    for k in keys:
        same = F.col(k).eqNullSafe(F.col(f"__{k}"))
        on = same if on is None else on & same
    return left.join(other, on).drop(*[f"__{k}" for k in keys])


def place_turns(turns: DataFrame, budget: int, history: int) -> DataFrame:
    """Rows (conv_id, turn, role, key, tok) with pos (0, 1, ...) in the conversation, the conversation's
    number of turns, sys (tokens of its system turn), is_sys, room (tokens of a cell), and a0 and a1, the tokens
    before and up to the turn, the system turn not counted."""
    # the row number only parts equal rows, which may then lie in several partitions
    rows = turns.withColumn("row", F.monotonically_increasing_id())
    order = ["turn", "role", "key", "row"]
    rows = written(rows.repartitionByRange("conv_id", *order).withColumn("part", F.spark_partition_id()))
    parts = rows.groupBy("conv_id", "part").agg(F.sum("tok").alias("t"), F.count("*").alias("n"),
                                                F.min(F.struct(*order, "tok")).alias("lead"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("conv_id")
    first = F.min(F.struct("part", "lead")).over(whole)["lead"]
    parts = parts.select("conv_id", "part", F.coalesce(F.sum("t").over(before), F.lit(0)).alias("t0"),
                         F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n0"), F.sum("n").over(whole).alias("turns"),
                         F.when(first["role"] == "system", first["tok"]).otherwise(F.lit(0)).alias("sys"))
    run = Window.partitionBy("conv_id", "part").orderBy(*order)
    rows = (rows.withColumn("pos", F.row_number().over(run) - 1)
            .withColumn("a1", F.sum("tok").over(run.rowsBetween(Window.unboundedPreceding, Window.currentRow))))
    rows = _meet(rows, parts, ["conv_id", "part"])
    pos, a1 = F.col("n0") + F.col("pos"), F.col("t0") + F.col("a1") - F.col("sys")
    return rows.select("conv_id", "turn", "role", "key", "tok", pos.alias("pos"), "turns", "sys",
                       ((F.col("sys") > 0) & (pos == 0)).alias("is_sys"),
                       F.greatest(F.lit(budget - history) - F.col("sys"), F.lit(history), F.lit(1)).alias("room"),
                       (a1 - F.col("tok")).alias("a0"), a1.alias("a1"))


def window_members(placed: DataFrame, history: int) -> DataFrame:
    """One row per turn and window that shows it: conv_id, cell, cross, pos, turn, role, key, tok, own (the system
    turn is the first window's own)."""
    cell = lambda x: F.floor(x / F.col("room"))
    spoken = placed.where(~F.col("is_sys"))
    own = spoken.withColumn("cell", cell(F.col("a0"))).withColumn("cross", cell(F.col("a1") - 1) > F.col("cell"))
    alone = placed.where(F.col("is_sys") & (F.col("turns") == 1)).select(
        "*", F.lit(0).cast("long").alias("cell"), F.lit(False).alias("cross"))
    show = ["conv_id", "cell", "cross", "pos", "turn", "role", "key", "tok"]
    windows = own.groupBy("conv_id", "cell", "cross").agg(F.min("a0").alias("w0"))
    kept = spoken.where(F.col("tok") <= history).withColumn(
        "cell", F.explode(F.sequence(cell(F.col("a1")), cell(F.col("a0") + history))))
    repeated = _meet(kept, windows, ["conv_id", "cell"]).where(F.col("w0").between(F.col("a1"), F.col("a0") + history))
    last = F.floor(windows["cell"] / CELL_BLOCK)
    blocks = windows.select("conv_id", "cell", "cross", last.alias("block"), (F.col("w0") == 0).alias("own"))
    reach = blocks.select("conv_id", "block").distinct()
    system = _meet(placed.where(F.col("is_sys") & (F.col("turns") > 1)), reach, ["conv_id"])
    system = _meet(system, blocks, ["conv_id", "block"])
    return (own.unionByName(alone).select(*show, F.lit(True).alias("own"))
            .unionByName(repeated.select(*show, F.lit(False).alias("own")))
            .unionByName(system.select(*show, "own")))


def format_windows(convs: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                   text_col: str = "text", tokens: Column | None = None, budget: int = BUDGET,
                   history: int = HISTORY) -> DataFrame:
    """One row per window: conv_id, first (position of its first own turn), text, loss_spans, n_tokens, n_own,
    n_repeated (turns at its start that other windows hold as their own), over_budget. ``tokens`` is a
    column over ``convs``."""
    text = F.coalesce(convs[text_col].cast("string"), F.lit(""))
    rows = convs.select(convs[conv_col].alias("conv_id"), convs[turn_col].alias("turn"), convs[role_col].cast("string").alias("role"),
                        F.md5(text).alias("key"), text.alias("text"),
                        F.greatest((estimated_tokens(text) if tokens is None else tokens).cast("long"), F.lit(1)).alias("tok"))
    placed = written(place_turns(rows.drop("text"), budget, history))
    members = window_members(placed, history)
    place = ["conv_id", "turn", "role", "key"]
    texts = rows.groupBy(*place).agg(F.first("text").alias("text"))
    shown = _meet(members, texts, place).withColumns({
        "open": F.length(_mark(F.col("role"), 0)), "body": escape(F.col("text"))}).withColumn(
        "piece", F.concat(_mark(F.col("role"), 0), F.col("body"), _mark(F.col("role"), 1)))
    by = ["conv_id", "cell", "cross"]
    so_far = F.sum(F.length("piece")).over(Window.partitionBy(*by).orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    start = (F.lit(len(START)) + F.col("upto") - F.length("piece") + F.col("open")).cast("int")
    span = F.when(F.col("own") & (F.col("role") == "assistant"),
                  F.struct(start.alias("start"), (start + F.length("body")).alias("end")))
    shown = shown.withColumn("upto", so_far).select(*by, "pos", "piece", "tok", "own", span.alias("span"))
    pieces = F.transform(F.array_sort(F.collect_list(F.struct("pos", "piece"))), lambda x: x["piece"])
    return shown.groupBy(*by).agg(
        F.min(F.when(F.col("own"), F.col("pos"))).alias("first"), F.concat(F.lit(START), F.array_join(pieces, "")).alias("text"),
        F.array_sort(F.collect_list("span")).alias("loss_spans"), F.sum("tok").alias("n_tokens"),
        F.count_if("own").alias("n_own"), F.count_if(~F.col("own")).cast("int").alias("n_repeated"),
        (F.sum("tok") > budget).alias("over_budget")).drop("cell", "cross")


def read_back(windows: DataFrame) -> DataFrame:
    """``windows`` with own_turns, the (role, text) of their own turns parsed from the text, and loss_texts, the
    unescaped text of every span under the loss mask."""
    pieces = F.filter(F.split(F.expr(f"substring(text, {len(START) + 1})"), TURN_END, -1), lambda x: x != "")
    own = F.slice(pieces, F.col("n_repeated") + 1, F.greatest(F.size(pieces) - F.col("n_repeated"), F.lit(0)))

    def parse(piece: Column) -> Column:
        mark = F.regexp_extract(piece, TURN, 1)
        role = F.when(mark == "ROLE", F.lit(None).cast("string"))
        for name, marks in ROLES.items():
            role = role.when(mark == marks[0][1:-1], F.lit(name))
        role = role.otherwise(F.decode(F.unhex(F.substring(mark, 6, 1 << 30)), "UTF-8"))
        return F.struct(role.alias("role"), unescape(F.regexp_extract(piece, TURN, 2)).alias("text"))

    spans = F.transform("loss_spans", lambda s: unescape(F.substring(F.col("text"), s["start"] + 1, s["end"] - s["start"])))
    return windows.withColumns({"own_turns": F.transform(own, parse), "loss_texts": spans})


def digest(windows: DataFrame) -> DataFrame:
    """Per conversation, read back from the windows: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256,
    formatted_chars, n_windows. A digest needs the whole conversation as one string."""
    line = lambda t: F.concat(F.coalesce(t["role"], F.lit("")), F.lit("\n"), t["text"], F.lit("\n"))
    read = read_back(windows).select(
        "conv_id", "first", F.size("own_turns").alias("n"), F.array_join(F.transform("own_turns", line), "").alias("turns"),
        F.array_join("loss_texts", "").alias("loss"), F.length("text").cast("long").alias("chars"))
    joined = lambda c: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("first", c))), lambda x: x[c]), "")
    out = read.groupBy("conv_id").agg(
        F.sum("n").cast("long").alias("n_turns"), joined("turns").alias("turns"), joined("loss").alias("loss"),
        F.sum("chars").alias("formatted_chars"), F.count("*").alias("n_windows"))
    return out.select("conv_id", "n_turns", F.sha2("turns", 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"),
                      F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars", "n_windows")


def oracle(extra: list[tuple], budget: int = BUDGET, history: int = HISTORY) -> str:
    """DuckDB SQL of ``op12``: ``extra`` rows (conv_id, turn, role, text) are formatted too."""
    q = lambda s: "'" + s.replace("'", "''") + "'"
    more = "".join(f" UNION ALL SELECT {c}, {t}, {q(r)}, {q(x)}" for c, t, r, x in extra)
    marks = MARKS.replace("([<\\[])(~*)", "[<\\[]~*")
    return f"""
WITH c AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations{more}),
p AS (
  SELECT *, row_number() OVER o - 1 AS pos, count(*) OVER (PARTITION BY conv_id) AS turns,
         (strlen(text) + {BYTES_PER_TOKEN - 1}) // {BYTES_PER_TOKEN} + {TURN_TOKENS} AS tok,
         length(text) + len(regexp_extract_all(text, '{marks}')) + CASE role WHEN 'system' THEN 11 WHEN 'user' THEN 13
           WHEN 'assistant' THEN 9 ELSE 13 + coalesce(2 * strlen(role) + 1, 0) END AS chars,
         coalesce(first_value(role) OVER o = 'system', false) AS has_sys
  FROM c WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, md5(text))),
s AS (
  SELECT *, CASE WHEN has_sys THEN first_value(tok) OVER o ELSE 0 END AS sys, has_sys AND pos = 0 AS is_sys, sum(tok) OVER o AS upto
  FROM p WINDOW o AS (PARTITION BY conv_id ORDER BY pos)),
r AS (SELECT *, greatest({budget - history} - sys, {history}, 1) AS room, upto - sys AS a1, upto - sys - tok AS a0 FROM s),
w AS (
  SELECT conv_id, CAST(a0 // room AS BIGINT) AS cell, (a1 - 1) // room > a0 // room AS crosses, min(a0) AS w0
  FROM r WHERE NOT is_sys GROUP BY ALL),
m AS (
  SELECT conv_id, 0 AS w0, chars FROM r WHERE is_sys AND turns = 1
  UNION ALL SELECT w.conv_id, w0, chars FROM r JOIN w ON w.conv_id IS NOT DISTINCT FROM r.conv_id AND (
    is_sys OR (w.cell = a0 // room AND crosses = ((a1 - 1) // room > a0 // room))
    OR (tok <= {history} AND w0 BETWEEN a1 AND a0 + {history}))),
f AS (SELECT conv_id, CAST(sum(chars) + 3 * count(DISTINCT w0) AS BIGINT) AS formatted_chars, count(DISTINCT w0) AS n_windows FROM m GROUP BY 1),
t AS (
  SELECT conv_id, count(*) AS n_turns, sha256(string_agg(coalesce(role, '') || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
         coalesce(string_agg(text, '' ORDER BY pos) FILTER (role = 'assistant'), '') AS loss FROM r GROUP BY 1)
SELECT t.conv_id, n_turns, lower(turns_sha256) AS turns_sha256, length(loss) AS loss_chars, lower(sha256(loss)) AS loss_sha256,
       formatted_chars, n_windows
FROM t JOIN f ON f.conv_id IS NOT DISTINCT FROM t.conv_id"""

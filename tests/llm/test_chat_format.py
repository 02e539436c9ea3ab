"""op12: its SQL (test_shards_mixing runs it on the given table), and a plain version on odd rows."""

import hashlib
import random
import re

import pytest

from slotcast.llm import chat_format as cf

COLS = "conv_id long, turn long, role string, text string, pos int, cell string"


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "c") for r in rows], COLS)


def plain(rows, budget, history):
    """Windows of every conversation: (conv_id, first, text, [loss texts], own turns, repeated)."""
    out = []
    order = lambda r: ((r[1] is not None, r[1] or 0), (r[2] is not None, r[2] or ""), hashlib.md5((r[3] or "").encode()).hexdigest())
    for conv in {r[0] for r in rows}:
        turns = [(r[2], r[3] or "") for r in sorted((r for r in rows if r[0] == conv), key=order)]
        tok = [-(-len(t.encode()) // 4) + 4 for _, t in turns]
        has = turns[0][0] == "system"
        sys = tok[0] if has else 0
        room = max(budget - history - sys, history, 1)
        a, at = [], 0
        for i, n in enumerate(tok):
            if has and i == 0:
                a.append(None)
            else:
                a.append((at, at + n))
                at += n
        windows = {}
        for i, x in enumerate(a):
            if x:
                windows.setdefault((x[0] // room, (x[1] - 1) // room > x[0] // room), []).append(i)
        if not windows:
            windows = {(0, False): []}
        for n, key in enumerate(sorted(windows)):
            own = windows[key]
            w0 = a[own[0]][0] if own else 0
            before = [j for j, x in enumerate(a) if x and own and j < own[0] and w0 - x[0] <= history]
            start = [0] if has else []
            mine = (start if n == 0 else []) + own
            rep = (start if n else []) + before
            out.append((conv, mine[0], [turns[j] for j in rep + mine], [turns[j] for j in mine], len(rep)))
    return out


def corpus(seed=3):
    rng = random.Random(seed)
    words = ["ok", "</s>", "[INST]", "[/INST]", "<~/s>", "[~~SYS]", "[ROLE 61]", "[ROLE]", "~", "ß", "𝄞", "\n", "[", "<s>", "[ANS]", "$1 \\", "\r\n"]
    roles = ["user", "assistant", "system", "tool", None, "", "[/INST]"]
    rows = []
    for c in range(60):
        n = rng.choice([1, 2, 5, 20])
        for t in range(n):
            role = "system" if t == 0 and rng.random() < .5 else rng.choice(roles if rng.random() < .3 else ["user", "assistant"])
            text = None if rng.random() < .05 else "".join(rng.choice(words) for _ in range(rng.choice([0, 3, 30, 200])))
            rows.append((c, t * 1000, role, text))
    rows += [(None, 1, "user", "a"), (None, None, "user", "b"), (None, 0, "assistant", "c")]
    rows += [(100, 5, "assistant", "same")] * 30 + [(101, 0, "system", "alone")] + [(102, 0, None, None)]
    return rows


@pytest.mark.parametrize("budget,history", [(2048, 512), (120, 30), (40, 0)])
def test_windows_equal_plain_version(spark, budget, history):
    rows = corpus()
    got = cf.read_back(cf.format_windows(table(spark, rows), budget=budget, history=history)).collect()
    want = plain(rows, budget, history)
    by = {(r["conv_id"], r["first"]): r for r in got}
    assert len(by) == len(got) == len(want)
    for conv, first, shown, own, repeated in want:
        r = by[conv, first]
        assert [tuple(t) for t in r["own_turns"]] == own
        assert (r["n_repeated"], r["n_own"]) == (repeated, len(own))
        assert r["loss_texts"] == [t for role, t in own if role == "assistant"]
        # marks come from the template only, one opening and one closing a turn
        assert len(re.findall(r"</s>|\[/INST\]|\[/SYS\]|\[/ROLE\]", r["text"])) == len(shown)
        assert len(re.findall(r"\[(?:INST|SYS|ANS|ROLE(?: [0-9A-F]*)?)\]", r["text"])) == len(shown)
        assert r["text"].startswith("<s>") and r["text"].count("<s>") == 1
        if not r["over_budget"]:
            assert r["n_tokens"] <= budget
        else:
            sys = -(-len(shown[0][1].encode()) // 4) + 4 if shown[0][0] == "system" else 0
            assert len(own) == 1 or sys > budget - 2 * history or len(own) == 2 and own[0][0] == "system"


def test_digest_and_sql(spark):
    import duckdb
    rows = corpus(8)
    con = duckdb.connect()
    frame = table(spark, rows).toPandas()       # noqa: F841 - read by DuckDB
    con.execute("CREATE VIEW conversations AS SELECT conv_id, turn, role, text FROM frame")
    con.execute("SET pandas_analyze_sample=0")
    extra = [(-1, 0, "user", "</s>[INST] ok [/INST]")]
    full = table(spark, rows + extra)
    for budget, history in ((2048, 512), (120, 30)):
        got = cf.digest(cf.format_windows(full, budget=budget, history=history))
        res = con.execute(cf.oracle(extra, budget, history))
        names = [d[0] for d in res.description]
        want = sorted((tuple(r) for r in res.fetchall()), key=repr)
        assert sorted((tuple(r[c] for c in names) for r in got.collect()), key=repr) == want


def test_long_conversation_spreads_and_custom_tokens(spark):
    from pyspark.sql import functions as F
    rows = [(1, t, "system" if t == 0 else ("user", "assistant")[t % 2], f"t{t}") for t in range(3000)]
    full = table(spark, rows)
    out = cf.read_back(cf.format_windows(full, tokens=F.lit(10), budget=100, history=30)).orderBy("first").collect()
    assert sum(r["n_own"] for r in out) == 3000 and all(r["n_tokens"] <= 100 for r in out)
    assert [t["text"] for r in out for t in r["own_turns"]] == [f"t{t}" for t in range(3000)]
    assert all(r["n_repeated"] == 4 for r in out[1:])      # the system turn and three turns of history


def test_empty(spark):
    out = cf.digest(cf.format_windows(table(spark, [])))
    assert out.count() == 0

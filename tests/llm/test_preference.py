from __future__ import annotations

import duckdb

from strata.llm import preference, queries

SCHEMA = "pair_id long, turn long, role string, text string, status string"
SF = "/root/testdata/sf0.001"


def clean(text):
    return (text or "").replace("<|", "< |")


def plain(chosen, rejected):
    sides = []
    for rows in (chosen, rejected):
        pairs = {}
        for pair, turn, role, text in rows:
            if pair is not None:
                pairs.setdefault(pair, []).append((turn is None, turn or 0, clean(role), clean(text)))
        sides.append({p: [t[2:] for t in sorted(v)] for p, v in pairs.items()})
    out = {}
    for pair in set(sides[0]) | set(sides[1]):
        c, r = (s.get(pair, []) for s in sides)
        n = 0
        while n < min(len(c), len(r)) and c[n] == r[n]:
            n += 1

        def show(turns):
            text, spans = "", []
            for role, body in turns:
                text += f"<|{role}|>\n"
                if role == "assistant":
                    spans.append(f"{len(text)}:{len(text) + len(body) + len('<|end|>')}")
                text += body + "<|end|>\n"
            return text, ",".join(spans)

        (a, a_mask), (b, b_mask) = show(c[n:]), show(r[n:])
        status = {(0, 0): "pair", (1, 1): "equal", (1, 0): "chosen_empty", (0, 1): "rejected_empty"}[(len(c) == n, len(r) == n)]
        out[pair] = (status, n, show(c[:n])[0], a, b, a_mask, b_mask)
    return out


def run(spark, chosen, rejected):
    frames = [spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA) for rows in (chosen, rejected)]
    return {r[0]: tuple(r)[1:] for r in preference.format_preferences(*frames).collect()}


def test_edges_match_plain_version(spark):
    long = "word " * 50_000
    chosen = [
        (1, 0, "user", "hi"), (1, 1, "assistant", "good"),
        (2, 0, "user", "same"), (2, 1, "assistant", "same"),
        (3, 0, "user", "a"), (3, 1, "assistant", "b"), (3, 2, "user", "c"),
        (4, 0, None, None), (4, 1, "assistant", ""),
        (5, 0, "user", long), (5, 1, "assistant", long),
        (6, 0, "user", "tie"), (6, 0, "user", "tie"), (6, None, "assistant", "last"), (6, 0, "assistant", "first"),
        (7, 0, "user", "only chosen"), (None, 0, "user", "no pair"),
        (9, 0, "user", "<|end|> <|assistant|>"), (9, 1, "assistant", "日本 \U0001f600"), (9, 2, "assistant", "x"),
    ]
    rejected = [
        (1, 0, "user", "hi"), (1, 1, "assistant", "bad"),
        (2, 0, "user", "same"), (2, 1, "assistant", "same"),
        (3, 0, "user", "a"), (3, 1, "assistant", "b"),
        (4, 0, None, ""), (4, 1, "assistant", None), (4, 2, "user", "more"),
        (5, 0, "user", long), (5, 1, "assistant", long + "!"),
        (6, 0, "user", "tie"), (6, 0, "assistant", "first"),
        (8, 0, "user", "only rejected"),
        (9, 0, "user", "<|end|> <|assistant|>"), (9, 1, "user", "y"),
    ]
    got = run(spark, chosen, rejected)
    assert got == plain(chosen, rejected)
    assert [got[k][0] for k in (1, 2, 3, 4, 7, 8)] == ["pair", "equal", "rejected_empty", "chosen_empty", "rejected_empty", "chosen_empty"]


def test_empty(spark):
    assert run(spark, [], []) == {}


def test_query_matches_statement(spark):
    got = queries.op8_preference_format(spark, SF).toPandas().sort_values("pair_id").reset_index(drop=True)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    want = con.sql(queries.ORACLE["op8_preference_format"]).df().sort_values("pair_id").reset_index(drop=True)
    assert len(got) and got.equals(want[got.columns].astype(got.dtypes.to_dict()))


def test_no_python_in_plan(spark):
    plan = queries.op8_preference_format(spark, SF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan

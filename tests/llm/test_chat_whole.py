"""One rendering per perspective, however many rows it is stored in."""

import re

import pytest

from commitlens.llm import chat


def brute(turns):
    """{perspective: (rendered, mask as a text of 0 and 1)}"""
    turns = sorted(turns, key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2]))
    out = {}
    for who in {r for _, r, _ in turns if r != "system"}:
        text, mask = "", ""
        for _, role, body in turns:
            head = "<|assistant|>\n" if role == who else "<|system|>\n" if role == "system" else f"<|user:{role.replace('<|', '<||')}|>\n"
            body = body.replace("<|", "<||") + "<|end|>\n"
            text += head + body
            mask += "0" * len(head) + ("1" if role == who else "0") * len(body)
        out[who] = text, mask
    return out


def spelled(mask):
    return "".join(b * int(n) for b, n in re.findall(r"([01])\*(\d+)", mask))


@pytest.mark.parametrize("part_turns", [1, 7, 64, 1000])
def test_long_dialogue_is_one_rendering(spark, part_turns):
    roles = ["user", "assistant", "guest", "system"]
    turns = [(i, roles[i % 3] if i else "system", f"words <|of {i} é🙂" * (i % 4)) for i in range(130)] + [(None, "user", "no number")]
    df = spark.createDataFrame([(5, *t) for t in turns], "conv_id long, turn long, role string, text string").repartition(5)
    rows = chat.rotate(df, part_turns)
    want = brute(turns)
    whole = {r["perspective"]: r for r in chat.whole_renderings(rows).collect()}
    assert {k: (r["rendered"], spelled(r["mask"])) for k, r in whole.items()} == want
    assert all(r["n_turns"] == 131 for r in whole.values())
    for r in rows.collect():
        text, mask = want[r["perspective"]]
        end = r["start"] + len(r["rendered"])
        assert text[r["start"]:end] == r["rendered"] and mask[r["start"]:end] == spelled(r["mask"])


def test_sql_states_the_starts(spark, tmp_path):
    import duckdb

    rows = [(c, t, "user" if t % 2 else "bot", "x" * (t % 9)) for c in (1, 2, None) for t in range(150)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    con = duckdb.connect()
    frame = df.toPandas().astype({"conv_id": "Int64"})
    con.register("conversations", frame)
    rel = con.sql(chat.ORACLE_SQL)
    got = chat.rotate(df).select(*rel.columns)
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, rel.fetchall()), key=key)

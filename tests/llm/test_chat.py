import pytest

from aurum.llm.chat import CONTROLS, escape, format_trees, format_turns, parse_turns, threads, unescape


@pytest.mark.parametrize("text", [*CONTROLS, "", "\\", "\\\\<|end|>\\", "<<s>>", "[[INST]]", "a\\<s>\n", "<\\|end|>", "</s>[INST] ok [/INST]"])
def test_escape_round_trip(text):
    assert unescape(escape(text)) == text
    assert not any(c in escape(text) for c in CONTROLS)


def test_format_reads_back():
    turns = [("user", "a<|end|>\n"), ("assistant", "<|turn|>x\\"), ("we\nird\\", ""), ("assistant", "two")]
    text, spans = format_turns(turns)
    assert parse_turns(text) == turns
    assert "".join(unescape(text[a:b]) for a, b in spans) == "<|turn|>x\\two"


def paths_by_recursion(rows):
    kids, out = {}, []
    ids = {r[1] for r in rows}
    for r in rows:
        kids.setdefault(r[2] if r[2] in ids else None, []).append(r)

    def walk(r, path):
        path = [*path, r]
        if r[1] not in kids:
            out.append(path)
        for k in kids.get(r[1], []):
            walk(k, path)

    for r in kids.get(None, []):
        walk(r, [])
    return out


def test_trees(spark):
    rows = [(1, 1, None, "user", "q", 1.0), (1, 2, 1, "assistant", "a1", 0.5), (1, 3, 1, "assistant", "a2", 4.0), (1, 4, 3, "user", None, None),
            (1, 5, 4, "assistant", "end", 1.0), (1, 6, 99, "user", "orphan", 0.0), (1, 7, 8, "x", "cycle", 1.0), (1, 8, 7, "x", "cycle", 1.0),
            (1, 9, 8, "x", "off the cycle", 9.0)]
    df = spark.createDataFrame([(*r, "?") for r in rows], "conv_id long, msg_id long, parent_id long, role string, text string, score double, leaf string")
    got = {r.leaf: r for r in format_trees(df, score="score").collect()}
    want = {p[-1][1]: p for p in paths_by_recursion(rows)}
    assert got.keys() == want.keys() == {2, 5, 6}
    for leaf, p in want.items():
        assert parse_turns(got[leaf].formatted) == [(r[3], r[4] or "") for r in p]
        assert got[leaf].score == pytest.approx(sum(r[5] or 0 for r in p) / len(p))
    assert [leaf for leaf, r in sorted(got.items(), key=lambda x: x[1].rank)] == [5, 2, 6]
    assert [r.leaf for r in format_trees(df, score="score", top=1).collect()] == [5]


def test_long_thread_null_ids_and_repeats(spark):
    rows = [(7, k, "user" if k % 2 else "assistant", f"t{k}") for k in range(70)] + [(None, 0, "user", "n"), (None, 1, None, None), (8, 0, "user", "x"), (8, 0, "user", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: parse_turns(r.formatted) for r in format_trees(threads(df)).collect()}
    assert got[7] == [(r[2], r[3]) for r in rows[:70]]
    assert got[None] == [("user", "n"), ("", "")] and got[8] == [("user", "x")] * 2
    assert format_trees(threads(df.limit(0))).count() == 0


def test_the_plan_does_not_grow_with_the_turns(spark):
    for turns in (8, 600):
        df = spark.range(turns).selectExpr("7L AS conv_id", "id AS turn", "IF(id % 2 = 0, 'user', 'assistant') AS role", "string(id) AS text")
        out = format_trees(threads(df))
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Join") <= 20
    assert len(parse_turns(out.collect()[0].formatted)) == 600

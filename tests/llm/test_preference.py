from clientcurve.llm.preference import END, HEADER, assemble, one_row_a_turn, preference_segments, swapped_endings

SCHEMA = "conv_id long, turn long, role string, text string, pair int, part string, said string, split int"


def conversations(spark, rows):
    return spark.createDataFrame([(*r, 1, "p", "s", 0) for r in rows], SCHEMA)


def shown(role, text):
    return f"{HEADER}{role or ''}\n{text or ''}{END}"


CHOSEN = [(1, 0, "user", "hi"), (1, 1, "assistant", "hello"), (1, 2, "user", "more"), (1, 3, "assistant", "good")]
REJECTED = [*CHOSEN[:3], (1, 3, "assistant", "bad"), (1, 4, "user", "?")]


def test_prefix_once_then_two_completions(spark):
    a, b = (one_row_a_turn(conversations(spark, r), "conv_id") for r in (CHOSEN, REJECTED))
    out = preference_segments(a, b).collect()
    got = sorted((r["part"], r["turn"], r["rendered"]) for r in out)
    assert got == sorted(
        [("prompt", t, shown(r, x)) for _, t, r, x in CHOSEN[:3]] + [("chosen", 3, shown("assistant", "good")), ("rejected", 3, shown("assistant", "bad")), ("rejected", 4, shown("user", "?"))]
    )
    masked = {(r["part"], r["turn"]): r["rendered"][r["mask_from"] : r["mask_to"]] for r in out}
    assert masked[("chosen", 3)] == "good" + END and masked[("rejected", 4)] == "" and masked[("prompt", 1)] == ""
    row = assemble(preference_segments(a, b)).collect()[0]
    assert row["prompt"] == "".join(shown(r, x) for _, _, r, x in CHOSEN[:3])
    assert [row["rejected"][m["from"] : m["to"]] for m in row["rejected_masks"]] == ["bad" + END]


def test_odd_conversations(spark):
    rows = [
        (1, 0, None, "a"), (1, 1, "assistant", None),  # null role and text, the same on both sides
        (2, 0, "user", "same"), (2, 0, "user", "same"), (2, 1, "assistant", "x"),  # a repeated turn
        (3, 5, "user", "only chosen"),
        (None, 0, "user", "no pair"), (4, None, "user", "no turn"),
    ]
    a = one_row_a_turn(conversations(spark, rows), "conv_id")
    b = one_row_a_turn(conversations(spark, [r for r in rows if r[0] in (1, 2)]), "conv_id")
    got = sorted((r["pair"], r["part"], r["turn"], r["rendered"]) for r in preference_segments(a, b).collect())
    assert got == [
        (1, "prompt", 0, shown(None, "a")), (1, "prompt", 1, shown("assistant", None)),
        (2, "prompt", 0, shown("user", "same")), (2, "prompt", 1, shown("assistant", "x")),
        (3, "chosen", 5, shown("user", "only chosen")),
    ]
    empty = a.limit(0)
    assert preference_segments(empty, empty).collect() == []


def test_swapped_endings(spark):
    rows = [(4, 0, "user", "a"), (4, 1, "assistant", "b"), (5, 0, "user", "c"), (8, 0, "user", "lone"), (8, 1, "assistant", "end")]
    out = swapped_endings(one_row_a_turn(conversations(spark, rows), "conv_id")).collect()
    assert sorted((r["pair"], r["turn"], r["said"]["text"]) for r in out) == [(4, 0, "a"), (4, 1, "c"), (5, 0, "b"), (8, 0, "lone")]


def test_no_python_in_the_plan(spark):
    a = one_row_a_turn(conversations(spark, CHOSEN), "conv_id")
    plan = preference_segments(a, swapped_endings(a))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan

from caseloom.llm import perspectives as P


def brute(rows, per=256, context=("system",)):
    esc = lambda s: s.replace("<|", "<||")
    convs = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            who = esc("unknown" if role is None else role)
            convs.setdefault(conv, []).append((turn is not None, turn or 0, who, esc(text or "")))
    out = []
    for conv, turns in convs.items():
        for speaker in sorted({w for _, _, w, _ in turns} - set(context)):
            parts = {}
            for i, t in enumerate(sorted(turns)):
                parts.setdefault(i // per, []).append(t)
            opening = sorted(turns)[0]
            for part in parts:
                if part and opening[2] in context:
                    parts[part].insert(0, opening)
            for part, own in parts.items():
                text, spans = "", []
                for _, _, who, said in own:
                    text += "<|" + ("assistant" if who == speaker else who if who in context else "user " + who) + "|>\n"
                    at = len(text)
                    text += said + "<|end|>"
                    if who == speaker:
                        spans.append(f"{at}:{len(text)}")
                    text += "\n"
                out.append((conv, speaker, part, len(own), text, ",".join(spans)))
    return sorted(out)


ROWS = [
    (1, 0, "system", "rules"), (1, 1, "user", "hi 😀"), (1, 2, "assistant", "é<|end|>é"), (1, 3, "ann", None), (1, 3, "bob", "same turn"),
    (2, 0, "user", "alone"), (3, 0, "system", "context only"), (4, None, None, "no turn"), (4, 300, "user", ""), (4, 5, None, "x"),
    (None, 1, "user", "no conversation"), (5, 1, "user", "twice"), (5, 1, "user", "twice"), (6, 700, "<|system|>", "far"), (7, 1, "user", "long " * 20_000),
]


def test_against_definition(spark):
    df = spark.createDataFrame(ROWS, "conv_id long, turn long, role string, text string")
    clash = df.selectExpr("*", "1 AS speaker", "2 AS part", "3 AS who", "'x' AS said", "0 AS pieces")
    assert sorted(map(tuple, P.rotate(clash).collect())) == brute(ROWS)
    assert sorted(map(tuple, P.rotate(df, turns_per_part=2).collect())) == brute(ROWS, 2)
    assert sorted(map(tuple, P.rotate(df, context=()).collect())) == brute(ROWS, context=())
    assert P.rotate(df.limit(0)).count() == 0


def test_masks_hold_what_the_speaker_says(spark):
    df = spark.createDataFrame(ROWS, "conv_id long, turn long, role string, text string")
    for r in P.rotate(df).where("conv_id = 1 AND speaker = 'assistant'").collect():
        spans = [tuple(map(int, s.split(":"))) for s in r["mask"].split(",")]
        assert [r.text[a:b] for a, b in spans] == ["é<||end|>é<|end|>"]


def test_parts_follow_ranks_not_turn_numbers(spark):
    """Sparse, equal and missing turn numbers; the opening turn of the system heads every part."""
    rows = [(8, None, "system", "be kind")] + [(8, i * 1000, "ann" if i % 2 else "bob", f"t{i}") for i in range(9)]
    rows += [(9, 1, "ann", "same")] * 7 + [(9, None, "bob", "none")] * 4 + [(10, 5, "ann", "first"), (10, 9, "system", "late")] * 3
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    got = sorted(map(tuple, P.rotate(df, turns_per_part=4).collect()))
    assert got == brute(rows, 4)
    assert {(r[0], r[2], r[3]) for r in got if r[0] == 8} == {(8, 0, 4), (8, 1, 5), (8, 2, 3)}
    assert all(r[4].startswith("<|system|>\nbe kind<|end|>") for r in got if r[0] == 8)


def test_long_dialogue(spark):
    df = spark.range(3000).selectExpr("1L AS conv_id", "id * 70000 AS turn", "if(id % 2 = 0, 'user', 'assistant') AS role", "concat('t', id) AS text")
    got = P.rotate(df).collect()
    assert len(got) == 2 * 12 and sum(r.n_turns for r in got) == 6000
    assert "Python" not in P.rotate(df)._jdf.queryExecution().toString()

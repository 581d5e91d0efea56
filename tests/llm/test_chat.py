from llm_fixtures import rng, table  # noqa: F401

from dimflow.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"


def by_hand(rows):
    """(conv, perspective) -> the whole rendering, its trained spans."""
    safe = lambda s: s.replace("<|", "< |")
    out = {}
    for conv in {r[0] for r in rows}:
        turns = [r for r in rows if r[0] == conv]
        turns.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2] is not None, r[2] or ""))
        for speaker in {r[2] for r in turns} - {None}:
            text, spans = "", []
            for _, _, role, said in turns:
                own = role == speaker
                text += "<|assistant|>\n" if own else f"<|user name={safe('unknown' if role is None else role)}|>\n"
                start = len(text)
                text += safe(said or "") + "<|end|>\n"
                spans += [(start, len(text) - 1)] if own else []
            out[conv, speaker] = text, spans
    return out


def check(rows, found):
    expected, segments = by_hand(rows), {}
    for r in found.collect():
        segments.setdefault((r.conv_id, r.perspective), []).append(r)
    assert set(segments) == set(expected)
    for key, own in segments.items():
        own.sort(key=lambda r: r.position)
        assert [r.position for r in own] == list(range(len(own)))
        text, spans = expected[key]
        assert "".join(r.segment for r in own) == text
        assert all(text[r.start : r.stop] == r.segment for r in own)
        assert [(r.mask_start, r.mask_stop) for r in own if r.train] == spans
        assert all(r.mask_start is None and r.role != key[1] for r in own if not r.train)


def test_equals_brute_force(spark, table, rng):
    rows = []
    for conv in range(30):
        people = rng.sample(["user", "assistant", "system", "Ann", "Bo <|x|>", "é😀"], rng.randrange(1, 6))
        rows += [(conv, t, rng.choice(people), f"said {t} <|end|> é😀" * rng.randrange(3)) for t in range(rng.randrange(1, 12))]
    rng.shuffle(rows)
    check(rows, chat.rotate(table(rows, SCHEMA)))


def test_one_conversation_with_most_rows(spark, table):
    rows = [(1, t, ["a", "b", "c"][t % 3], f"t{t}") for t in range(2000)]
    rows += [(c, t, "a", "x") for c in range(2, 200) for t in range(3)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        check(rows, chat.rotate(table(rows, SCHEMA)))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_nulls_empty_ties_and_repeated(spark, table):
    rows = [(1, 0, "a", None), (1, 1, None, "who"), (1, None, "b", ""), (2, 0, None, "nobody"), (None, 0, "a", "x"),
            (None, 1, "b", "y"), (3, 5, "a", "same"), (3, 5, "a", "same"), (3, 5, "b", "tie"), (4, 0, "", "z" * 200_000)]
    check(rows, chat.rotate(table(rows, SCHEMA)))
    assert chat.rotate(table([], SCHEMA)).count() == 0


def test_equal_turns_are_ordered_by_text(spark, table):  # noqa: F811
    rows = [(1, 0, "user", text) for text in ("b", "a", "c", "a")]
    found = chat.rotate(table(rows, "conv_id long, turn long, role string, text string"))
    assert [r.segment for r in found.orderBy("position").collect()] == [f"<|assistant|>\n{t}<|end|>\n" for t in "aabc"]

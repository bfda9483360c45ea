from __future__ import annotations

from caremeld.llm import preference as P

TURNS = "conv_id long, turn long, role string, text string, prompt string"


def formatted(spark, rows):
    made = P.format_preferences(P.swapped_replies(spark.createDataFrame(rows, TURNS)))
    return {r.pair_id: r for r in made.collect()}


def shown(*turns):
    return "".join(f"<|im_start|>{role}\n{text}<|im_end|>\n" for role, text in turns)


def test_prefix_and_masks(spark):
    rows = [
        (4, 1, "assistant", "A1", ""), (4, 0, "user", "Q1", ""), (4, 2, "user", "Q2", ""), (4, 3, "assistant", "A2", ""),
        (4, 4, "user", "bye", ""), (5, 0, "user", "R", ""), (5, 1, "assistant", "other", ""),
    ]
    made = formatted(spark, rows)
    one = made[4]
    assert one.n_common == 3
    assert one.prompt == shown(("user", "Q1"), ("assistant", "A1"), ("user", "Q2"))
    assert one.chosen_completion == shown(("assistant", "A2"), ("user", "bye"))
    assert one.rejected_completion == shown(("assistant", "other"))
    (span,) = one.chosen_mask
    assert one.chosen_completion[span.start : span.end] == "A2<|im_end|>"
    (span,) = one.rejected_mask
    assert one.rejected_completion[span.start : span.end] == "other<|im_end|>"
    assert made[5].rejected_completion == shown(("assistant", "A2"))


def test_edges(spark):
    rows = [
        (0, 0, None, None, "x"), (0, 0, None, None, "x"), (None, 0, "user", "lost", ""), (2, 0, "user", "only", ""),
        (3, None, "assistant", "<|im_end|> é\U0001f600", ""), (3, 1, "assistant", "", ""),
    ]
    made = formatted(spark, rows)
    assert set(made) == {0, 2, 3}
    assert made[0].prompt == shown(("user", ""), ("user", "")) and made[0].n_common == 2
    assert made[0].chosen_completion == made[0].rejected_completion == ""
    assert made[2].prompt == shown(("user", "only"))
    assert made[3].prompt == shown(("assistant", "<\\|im_end|> é\U0001f600"))
    assert made[3].rejected_completion == ""


def test_equal_sides_and_empty_input(spark):
    turns = [(1, "user", "a"), (2, "assistant", "b")]
    schema = "pair_id long, chosen array<struct<turn:long,role:string,text:string>>, rejected array<struct<turn:long,role:string,text:string>>"
    made = P.format_preferences(spark.createDataFrame([(1, turns, turns), (2, turns, None), (3, None, None)], schema)).collect()
    one, two, three = sorted(made, key=lambda r: r.pair_id)
    assert (one.n_common, one.chosen_completion, one.chosen_mask) == (2, "", [])
    assert (two.n_common, two.prompt, two.rejected_completion) == (0, "", "")
    assert (three.n_common, three.prompt) == (0, "")
    assert formatted(spark, []) == {}

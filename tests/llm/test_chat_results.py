"""Results that are repeated or have no id, and conversations without an id."""
from collections import Counter

import pytest

from riskspark.llm import chat

CALLS = '{"tool_calls":[{"id":"a","name":"x"},{"id":"b","name":"x","after":["a"]},{"id":"c","name":"x","after":["b"]}]}'


def result(call, content):
    return f'{{"tool_call_id":"{call}","content":"{content}"}}'


@pytest.fixture(scope="module")
def linked(spark):
    rows = []
    for conv in (1, None):
        rows += [(conv, 0, "assistant", CALLS), (conv, 1, "tool", result("a", "one")), (conv, 1, "tool", result("a", "one")),
                 (conv, 2, "tool", result("a", "two")), (conv, 3, "tool", result("b", "x")),
                 (conv, 4, "tool", result("q", "y")), (conv, 5, "tool", result("q", "z")),
                 (conv, 6, "tool", "nonsense"), (conv, 7, "tool", None), (conv, 7, "tool", None)]
    m = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return chat.link_calls(m).collect()


@pytest.mark.parametrize("conv", [1, None])
def test_every_result_has_a_row(linked, conv):
    got = Counter((r.call_id, r.status, r.result_turn, '"result":"one"' in r.canonical)
                  for r in linked if r.conv_id == conv)
    assert got == Counter({
        ("a", "answered", 1, True): 1, ("a", "duplicate result", 1, True): 1, ("a", "duplicate result", 2, False): 1,
        ("b", "answered", 3, False): 1, ("c", "unanswered", None, False): 1, ("q", "orphan", 4, False): 1,
        ("q", "orphan", 5, False): 1, (None, "orphan", 6, False): 1, (None, "orphan", 7, False): 2})
    assert all(r.level is None and r.problems is None and r.turn == r.result_turn
               for r in linked if r.status in ("orphan", "duplicate result"))


@pytest.mark.parametrize("conv", [1, None])
def test_levels_without_a_conversation_id(linked, conv):
    assert {r.call_id: r.level for r in linked if r.conv_id == conv and r.call_index is not None} == {"a": 0, "b": 1, "c": 2}

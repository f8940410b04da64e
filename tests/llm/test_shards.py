"""Shards that turn out to hold no passage."""

from __future__ import annotations

from gridloom.llm import phrase_automata as P


def test_a_shard_without_a_recurring_window_has_no_passages():
    """Segments meet by one gram; that none of their windows starts twice was an error when it held for the whole shard."""
    texts = [tuple(range(40)), tuple(range(100, 140)), (1, 2, 3)]
    assert P.passages(texts, [1, 1, 1], 35) == []
    assert P.matches(texts, [1, 1, 1], 35) == [[], [], []]
    assert P.passages([], [], 35) == []

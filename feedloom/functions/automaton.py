"""Keyword balance of texts by one automaton over both lexicons."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def keyword_balance(text: Column, positive: Sequence[str], negative: Sequence[str]) -> Column:
    """Different positive keywords in a text less different negative ones, in one pass over it.

    A keyword counts once however often it occurs, also inside words and other keywords; one
    that both lists name counts on both sides. The empty keyword is in every text; null has none.
    """
    sides: dict[str, int] = {}
    for weight, words in ((1, positive), (-1, negative)):
        for word in dict.fromkeys(words):
            sides[word] = sides.get(word, 0) + weight
    everywhere = sides.pop("", 0)
    held: list = []  # the automaton, built once in each worker

    def balance(texts: pa.Array) -> pa.Array:
        if not held:
            import ahocorasick

            automaton = ahocorasick.Automaton()
            for place, word in enumerate(sides):
                automaton.add_word(word, place)
            automaton.make_automaton()
            held.append(automaton)
        weights = list(sides.values())
        out = []
        for value in texts.to_pylist():
            if value is None:
                out.append(0)
            elif not weights:
                out.append(everywhere)
            else:
                found = {place for _, place in held[0].iter(value)}
                out.append(everywhere + sum(weights[place] for place in found))
        return pa.array(out, pa.int32())

    balance.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(balance, "int")(text)

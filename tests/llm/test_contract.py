"""The driver's contract lists every operator of this package and the pipeline."""

from __future__ import annotations

import re

import __spark_entry__ as contract
import corpus_pipeline
from feedloom.llm.queries import ORACLES, QUERIES


def test_every_operator_is_registered_once():
    listed = [int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES]
    assert sorted(listed) == list(list(range(1, 14)))
    assert ORACLES.keys() <= QUERIES.keys()
    assert QUERIES.items() <= contract.queries().items()
    assert contract.queries()["pipeline"] is corpus_pipeline.run
    assert len(corpus_pipeline.STAGES) == 5

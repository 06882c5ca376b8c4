"""The driver contract: every query has an oracle unless SQL cannot state it."""

import re

from tessera.plans import registry as E

# Wall-clock columns and file metadata have oracles of what can be stated of them.
ROWS_ONLY = set()


def test_every_query_has_an_oracle_or_a_reason():
    qs, oracles = E.queries(), E.oracles()
    assert set(oracles) <= set(qs)
    assert set(qs) - set(oracles) == ROWS_ONLY


def test_query_names_are_plain():
    for name in E.queries():
        assert name.isidentifier() and not re.match(r"op\d+_", name) and "pipeline" not in name

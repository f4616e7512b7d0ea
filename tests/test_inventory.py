"""
the few with no query form, by a named test)."""

from tidepool.plans import REGISTRY


def _ids(prefix: str, n: int) -> set[str]:
    return {f"{prefix}{i}" for i in range(1, n + 1)}


SURVEY_IDS = (
    _ids("SRC", 8) | _ids("SNK", 10) | _ids("PRJ", 5) | _ids("FLT", 3) | {"DDP1"} | _ids("AGG", 10)
    | _ids("BIN", 3) | _ids("SRT", 4) | _ids("FN", 13) | _ids("ENC", 2) | _ids("SPL", 2) | _ids("SMP", 2)
    | _ids("TRN", 3) | _ids("EVL", 6) | _ids("REG", 2) | _ids("PRD", 4) | _ids("STR", 3) | _ids("DCL", 4)
)

# Covered by tests only: the landing-zone existence check (test_sinks.py).
TEST_ONLY = {"SRC8"}


def test_every_inventory_id_is_covered():
    covered = {i for q in REGISTRY.values() for i in q.ids}
    assert SURVEY_IDS - covered - TEST_ONLY == set()


def test_every_query_names_its_ids():
    assert all(q.ids for q in REGISTRY.values())

"""Registered corpus queries against their SQL on the small tables."""

import pytest

from oracle import compare, connect
from tripspot.llm.registry import ORACLES, QUERIES

CONTRACT = {
    "op1": ["doc_id", "n_shingles", "component_id", "kept"],
    "op2": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    "op3": ["doc_id", "held_out", "score", "predicted"],
    "op4": ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
    "op5": ["doc_id", "item_id"],
    "op6": ["doc_id", "held_out", "lang_pred", "score"],
    "op7": ["query_id", "rank", "vec_id", "score"],
    "op8": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
    "op9": ["doc_id", "n_tokens", "n_tokens_edited"],
    "op10": ["doc_id", "size", "source_size", "target", "taken"],
    "op11": ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"],
    "op12": ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
    "op13": ["lang", "rank", "phrase", "a", "l", "r", "n", "score"],
}


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, sf, con, name):
    result = QUERIES[name](spark, sf)
    columns = CONTRACT[name.split("_")[0]]
    assert result.columns[: len(columns)] == columns  # others may follow
    if name in ORACLES:
        assert compare(result, con, ORACLES[name]) == ""
    else:
        assert result.count() > 0


def test_every_operator_has_one_query():
    assert [name.split("_")[0] for name in QUERIES] == list(CONTRACT)

"""Every registered operator query: against its SQL where there is some, else its shape."""

import pytest

from checks.compare import duck, rows_of
from spelltide.llm.queries import QUERIES, SQL

# The columns each query must return at least.
COLUMNS = {
    "op1": "page_id payload_bytes payload_digest record_type refers_to",
    "op2": "doc_id n_shingles component_id",
    "op3": "doc_id n_assign n_access n_hex base_sha256 spans",
    "op4": "vec_id n_links component_id kept",
    "op5": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op6": "doc_id held_out score predicted",
    "op7": "doc_id sample n_pieces log_prob perturbed log_inclusion round_trip",
    "op8": "doc_id item_id score question_overlap answer_overlap",
    "op9": "doc_id size text_crc32 law shard slot grown_shard",
    "op10": "page_id host path rule verdict",
    "op11": "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256",
    "op12": "anchor_id positive_id rank negative_id positive_score negative_score",
    "op13": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
}


def test_one_query_per_operator():
    assert sorted(n.split("_")[0] for n in QUERIES) == sorted(COLUMNS)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, name):
    df = QUERIES[name](spark, sf)
    assert set(COLUMNS[name.split("_")[0]].split()) <= set(df.columns)
    have = rows_of(df.columns, [tuple(r) for r in df.collect()])
    assert have
    if name in SQL:
        result = duck(sf).execute(SQL[name])
        columns = [d[0] for d in result.description]
        assert sorted(columns) == sorted(df.columns)
        assert have == rows_of(columns, result.fetchall())


def test_native_query_has_no_python(spark, sf, capsys):
    QUERIES["op9_stratified_shards"](spark, sf).explain("formatted")
    assert not any(word in capsys.readouterr().out for word in ("Python", "Pandas", "Arrow"))

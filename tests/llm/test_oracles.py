"""Every text query: against its SQL twin where there is one, else that it returns a row for each input row."""

import pytest
from compare import differences, duck

from trueledger.llm import queries

INPUT = {"op3_byte_bpe": "documents", "op5_licence_scan": "documents", "op7_kneser_ney_toxicity": "documents", "op8_threshold_sketch": "documents", "op9_template_extraction": "pages"}


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_matches_sql(spark, sf_dir, name):
    _, problems = differences(queries.QUERIES[name](spark, sf_dir), duck(sf_dir), queries.ORACLES[name])
    assert not problems


@pytest.mark.parametrize("name", sorted(INPUT))
def test_one_row_for_each(spark, sf_dir, name):
    assert queries.QUERIES[name](spark, sf_dir).count() == spark.read.parquet(f"{sf_dir}/{INPUT[name]}.parquet").count()

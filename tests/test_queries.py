"""A selection of the registered queries next to their SQL on the smallest tables; tools/verify.py runs all."""

import duckdb
import pytest

import __spark_entry__ as entry
from tools.verify import TABLES, check

FOLDER = "/root/testdata/sf0.001"
NAMES = (
    "kyc_features customer_profile country_counters counterparty_lists transaction_network all_names two_hop_flow label_propagation "
    "community_risk fuzzy_occupation_match five_number_summary auc_roc_ties undersample oversample stratified_kfold standardize label_encode "
    "html_paragraphs offender_table find_duplicates csv_scan"
).split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES.split():
        c.sql(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, con, name):
    _, _, state = check(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], FOLDER)
    assert state == "ok"


def test_entry(spark):
    assert entry.entry(spark).count() > 0

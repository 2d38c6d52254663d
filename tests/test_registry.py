"""The registered queries against their SQL on the smallest tables."""

import datetime as dt

import duckdb
import pytest

import __spark_entry__ as entry
from sourcetrail.plans.oracles import ORACLES
from sourcetrail.plans.registry import REGISTRY

FOLDER = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()
# those that run the whole review are covered by its last step
PART_OF_OTHERS = {"serve_case_list", "serve_queue", "serve_payload", "serve_metrics", "review_status",
                  "attestation_payload", "outcome_histogram", "due_for_classification"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def plain(value):
    return repr(value.replace(tzinfo=None)) if isinstance(value, dt.datetime) else repr(value)


def test_every_query_has_sql():
    assert set(REGISTRY) == set(ORACLES)
    assert set(REGISTRY) <= set(entry.queries())


@pytest.mark.parametrize("name", [n for n in REGISTRY if n not in PART_OF_OTHERS])
def test_query_equals_sql(spark, duck, name):
    df = entry.queries()[name](spark, FOLDER)
    cursor = duck.execute(entry.oracle_sql()[name])
    columns = sorted(c[0] for c in cursor.description)
    assert sorted(df.columns) == columns
    order = {c[0]: i for i, c in enumerate(cursor.description)}
    want = sorted([plain(r[order[c]]) for c in columns] for r in cursor.fetchall())
    got = sorted([plain(r[c]) for c in columns] for r in df.collect())
    assert got == want

"""The driver contract of __spark_entry__.py."""

import re

import __spark_entry__ as entry


def test_oracle_keys_are_registered_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_query_names():
    for name in entry.queries():
        assert re.fullmatch(r"[a-z][a-z0-9_]*", name), name


def test_oracle_sql_is_text():
    for name, sql in entry.oracle_sql().items():
        assert isinstance(sql, str) and "SELECT" in sql.upper(), name

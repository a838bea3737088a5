import __spark_entry__ as entry


def test_names_match():
    known = entry.queries()
    assert set(entry.oracle_sql()) <= set(known) and len(known) > 50

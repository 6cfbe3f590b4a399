import __spark_entry__ as entry_points


def test_entry_runs_with_rows(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["anio_mes", "nombre_canal", "ventas_netas"] and df.count() > 0


def test_sql_keys_are_queries():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
    assert len(entry_points.queries()) > 150

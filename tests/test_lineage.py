from batchlens.operators.lineage import REF_COLUMNS, extract_references, keyed_replace

SQL = ("SELECT t.C1 AS A1, Edw.Dbo.C2, C3,C4, COUNT(x) AS n, last\n"
       "FROM [Edw].[Dbo].[T9] t JOIN Edw.U5 u JOIN Other.Sch.t")


def _refs(spark, text, bid=1):
    df = spark.createDataFrame([(bid, text)], "DestinationBindingID bigint, AttributeValueLongTXT string")
    return [tuple(r) for r in extract_references(df).collect()]


def test_reference_rules(spark):
    rows = _refs(spark, SQL)
    # t.C1: qualifier 't' names table 't' -> the LAST 't' (Other.Sch.t) wins
    assert (1, "Other", "Sch", "t", "C1", "A1") in rows
    # Edw.Dbo.C2: 'edw' is no table -> schema.table from the two qualifiers
    assert (1, None, "Edw", "Dbo", "C2", None) in rows
    assert (1, None, None, None, "C3", None) in rows
    # ',C4' (no whitespace after the comma) is missed
    assert all(r[4] != "C4" for r in rows)
    # function names become columns; a keyword can be taken as alias
    assert (1, None, None, None, "COUNT", None) in rows
    assert (1, None, None, None, "last", "FROM") in rows
    assert len(rows) == 5


def test_two_part_table_fills_database(spark):
    rows = _refs(spark, "SELECT U5.x FROM Edw.U5")
    # 'x FROM' also shows the keyword-as-alias quirk
    assert rows == [(1, "Edw", None, "U5", "x", "FROM")]


def test_empty_and_null_texts(spark):
    df = spark.createDataFrame([(1, None), (2, "")], "DestinationBindingID bigint, AttributeValueLongTXT string")
    assert extract_references(df).count() == 0


def test_keyed_replace_is_idempotent(spark):
    old = spark.createDataFrame([(1, None, None, None, "a", None), (2, None, None, None, "b", None)],
                                ", ".join(f"{c} {'bigint' if i == 0 else 'string'}" for i, c in enumerate(REF_COLUMNS)))
    new = old.filter("DestinationBindingID = 2").withColumn("ParsedColumnNM", old.ParsedColumnNM.substr(1, 0))
    once = keyed_replace(old, new)
    twice = keyed_replace(once, new)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    assert once.count() == 2


def test_verify_sample_orders_and_limits(spark):
    from batchlens.operators.lineage import verify_sample
    schema = ", ".join(f"{c} {'bigint' if i == 0 else 'string'}" for i, c in enumerate(REF_COLUMNS))
    refs = spark.createDataFrame([(i % 7, None, None, None, f"c{i}", None) for i in range(30)], schema)
    got = [(r.DestinationBindingID, r.ParsedColumnNM) for r in verify_sample(refs).collect()]
    assert len(got) == 10 and got == sorted(got)

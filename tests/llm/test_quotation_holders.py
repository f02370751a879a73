"""A quoted line is found in every other conversation that holds it."""

from loanlake.llm import queries


def test_own_later_line_does_not_hide_other_conversations(spark, tmp_path):
    rows = [
        (1, 1, "user", "hello"), (1, 3, "user", "> the line"), (1, 5, "user", "the line"), (7, 1, "user", "the line"), (9, 2, "user", "the line"),
        (2, 1, "user", "> only here"), (2, 2, "user", "only here"), (8, 1, "user", "> the line"),
    ]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    table.write.parquet(f"{tmp_path}/conversations.parquet")
    got = {(r["conv_id"], r["turn"]): (r["n_linked"], r["quoted_conv"]) for r in queries.op4_quotation_links(spark, str(tmp_path)).collect()}
    assert got[1, 3] == (1, 7) and got[8, 1] == (1, 1) and got[2, 1] == (0, None)


def test_query_and_sql_agree_on_quotations(spark, tmp_path):
    """Nested, common and own later quotations: the registered query, its SQL, and loops over all messages."""
    import random

    import duckdb

    from test_native import brute_force_replies

    rng = random.Random(5)
    rows = []
    for c in range(30):
        for t in range(rng.randint(1, 8)):
            lines = [rng.choice(["Yes.", f"line {rng.randrange(25)}", f"own {c} {t}"]) for _ in range(rng.randint(0, 3))]
            lines += [rng.choice(["> ", ">> ", "> > > "]) + rng.choice(["yes.", f"Line  {rng.randrange(25)}", "nobody said"]) for _ in range(rng.randint(0, 3))]
            rng.shuffle(lines)
            rows.append((c, t, "user", "\n".join(lines)))
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").coalesce(1).write.parquet(f"{tmp_path}/conversations.parquet")
    got = queries.op4_quotation_links(spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    cursor = con.execute(queries.SQL["op4_quotation_links"])
    names = sorted(c[0] for c in cursor.description)
    order = [[c[0] for c in cursor.description].index(n) for n in names]
    sql = sorted(tuple(str(row[k]) for k in order) for row in cursor.fetchall())
    found = got.collect()
    assert sorted(tuple(str(r[n]) for n in names) for r in found) == sql
    expected = brute_force_replies(rows)
    linked = 0
    for r in found:
        _, _, quoted, _, n, parent, conv, depth, position = expected[r["conv_id"], r["turn"]]
        linked += n
        assert (r["n_quoted"], r["n_linked"], r["parent_turn"], r["quoted_conv"], r["depth"], r["position"]) == (quoted, n, parent, conv, depth, position)
    assert linked > 50

from parcelflow import state_queries

D = "/root/testdata/sf0.001"


def test_loads_do_not_join_the_tables_again(spark, monkeypatch):
    read_by = []

    class Store:
        def __init__(self, *_):
            pass

        def run(self, part, read, merge, now, first, lookback, checks):
            read_by.append(read(first, now))

    monkeypatch.setattr(state_queries, "Increments", Store)
    state_queries._three_runs(spark, D)
    assert len(read_by) == 15
    assert not any("Join" in rows._jdf.queryExecution().optimizedPlan().toString() for rows in read_by)
    every = state_queries._arriving(spark, D)
    want = every.where(f"region <> '' and lastTransition >= timestamp_ntz '{state_queries.FIRST}' and lastTransition < timestamp_ntz '2001-06-01' and arrived < timestamp_ntz '2001-06-01'")
    assert sum(rows.count() for rows in read_by[10:]) == want.count() > 0

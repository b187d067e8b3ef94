from test_splits import groups


def test_all_nodes_of_copies_that_differ_relate(spark):
    tasks = ("fold a towel", "pour water", "stack cups")
    rows = [(1, "Gamma", None, t) for t in tasks] + [(2 + i, "Gamma", None, t) for i, t in enumerate(tasks)]
    assert groups(spark, rows) == {(1, 1), (2, 1), (3, 1), (4, 1)}

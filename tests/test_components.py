from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from millrace.operators.components import connected_components
from millrace.operators.ordering import running_total


def plain(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in list(parent)}


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(edges=st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), min_size=0, max_size=40))
def test_against_union_find(spark, edges):
    df = spark.createDataFrame(edges, "u bigint, v bigint")
    assert {r.node: r.component for r in connected_components(df).collect()} == plain(edges)


def test_long_chain_and_star(spark):
    chain = [(i, i + 1) for i in range(300)]
    star = [(1000, 1000 + i) for i in range(1, 300)]
    df = spark.createDataFrame(chain + star + star, "u bigint, v bigint")
    assert {r.node: r.component for r in connected_components(df).collect()} == plain(chain + star)


def test_strings_nulls_and_nothing(spark):
    df = spark.createDataFrame([("b", "a"), ("c", None), (None, None), ("d", "d")], "u string, v string")
    assert {tuple(r) for r in connected_components(df).collect()} == {("a", "a"), ("b", "a"), ("d", "d")}
    assert connected_components(df.limit(0)).count() == 0


def test_running_total(spark):
    df = spark.createDataFrame([(i % 7, i, 1 + i % 3) for i in range(500)], "t int, k bigint, n bigint")
    want, total = {}, 0
    for t, k, n in sorted((i % 7, i, 1 + i % 3) for i in range(500)):
        want[k] = total
        total += n
    assert {r.k: r.before for r in running_total(df, ["t", "k"], "n").collect()} == want
    assert running_total(df.limit(0), ["t", "k"], "n").count() == 0

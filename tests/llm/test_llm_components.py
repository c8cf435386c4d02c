import random

from lectern.llm import components as C
from lectern.llm.common import shared_table


def _plain(links):
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x
    for a, b in links:
        ra, rb = root(a), root(b)
        up[max(ra, rb)] = min(ra, rb)
    return {x: root(x) for x in up}


def test_components_equal_plain_ones_with_two_joins_a_round(spark, monkeypatch):
    """Chains, stars, loops and repeated links; no table of a round joins more than
    once, since every broadcast costs the driver threads and heap."""
    joins = {}

    def spied(df, name, paths=None):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        joins[name] = max(joins.get(name, 0), sum("Join " in line for line in plan.splitlines()))
        return shared_table(df, name, paths)
    monkeypatch.setattr(C, "shared_table", spied)
    draw = random.Random(7)
    names = [draw.randrange(-1 << 62, 1 << 62) for _ in range(120)]
    links = [(names[i], names[i + 1]) for i in range(30)]
    links += [(names[40], names[i]) for i in range(41, 70)]
    links += [(draw.choice(names[70:]), draw.choice(names[70:])) for _ in range(30)]
    links += [(names[3], names[3]), (names[1], names[0]), (names[1], names[0])]
    got = C.components(spark.createDataFrame(links, "a long, b long")).collect()
    assert sorted(map(tuple, got)) == sorted(_plain(links).items())
    assert joins["hooked"] == 1 and joins["jumped"] == 1

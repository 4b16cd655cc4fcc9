"""Ids and merges across runs against plain sequential versions."""

import random
import uuid

import pandas as pd
import pytest

from tessera.operators import identity, matching


class Register:
    """The same rules one component after the other."""

    def __init__(self, previous, anchors, aliases):
        self.previous, self.anchors, self.stands = previous, dict(anchors), dict(aliases)
        self.known, self.new_aliases, self.new_anchors = set(aliases), set(), set()

    def end(self, x):
        path = []
        while x in self.stands and x not in path:
            path.append(x)
            x = self.stands[x]
        return x

    def run(self, parts):
        out, given = {}, set()
        for keys in sorted(map(sorted, parts)):
            had = {self.end(self.previous[k]) for k in keys if k in self.previous}
            free = sorted(had - given)
            own = [x for x in free if self.anchors.get(x) in keys]
            made = str(uuid.uuid5(uuid.NAMESPACE_URL, f"facility:{keys[0]}"))
            kept = (own or free or [made])[0]
            if not free and made in given:
                kept = str(uuid.uuid5(uuid.NAMESPACE_URL, "facility-split:" + "|".join(keys)))
            given.add(kept)
            out[keys[0]] = kept
            if kept not in self.anchors:
                self.anchors[kept] = keys[0]
                self.new_anchors.add((kept, keys[0]))
            for loser in sorted(had - {kept}):
                if loser not in self.known:
                    self.new_aliases.add((loser, kept))
                    self.known.add(loser)
                self.stands[loser] = kept
        return out


def compare(spark, parts, previous, anchors, aliases):
    facility = spark.createDataFrame([(k, min(p)) for p in parts for k in p], "key string, facility string")
    frame = lambda rows, a, b: spark.createDataFrame(list(rows.items()), f"{a} string, {b} string")
    ids, new_aliases, new_anchors = identity.surviving_ids(facility, frame(previous, "key", "canonical_id"), frame(anchors, "canonical_id", "key"), frame(aliases, "alias", "canonical_id"))
    plain = Register(previous, anchors, aliases)
    want = plain.run(parts)
    assert {r.facility: r.canonical_id for r in ids.collect()} == want
    assert sorted(map(tuple, new_anchors.select("canonical_id", "key").collect())) == sorted(plain.new_anchors)
    assert sorted(map(tuple, new_aliases.select("alias", "canonical_id").collect())) == sorted(plain.new_aliases)
    return want, plain


def test_named_cases(spark):
    made = lambda k: str(uuid.uuid5(uuid.NAMESPACE_URL, f"facility:{k}"))
    parts = [{"a", "b"}, {"c"}, {"d"}, {"e", "f"}, {"g"}, {"h"}, {"i"}, {"k"}, {"l"}, {"m"}]
    previous = {"a": "X", "b": "Y", "c": "Y", "d": "alias2", "e": "loop1", "f": "tail", "g": made("h"), "h": "Y", "i": made("i"), "k": made("i"), "l": "Z", "m": "Z"}
    anchors = {"Y": "b", "loop1": "zz", made("i"): "k"}
    aliases = {"alias2": "alias1", "alias1": "W", "loop1": "loop2", "loop2": "loop1", "tail": "loop2"}
    want, plain = compare(spark, parts, previous, anchors, aliases)
    assert want["a"] == "Y" and want["d"] == "W" and ("X", "Y") in plain.new_aliases
    compare(spark, [], {}, {}, {})


@pytest.mark.parametrize("seed", [2])
def test_random_runs_one_after_the_other(spark, seed):
    r = random.Random(seed)
    keys = [f"k{i:02}" for i in range(40)]
    previous, anchors, aliases = {}, {}, {}
    for _ in range(2):
        r.shuffle(keys)
        cuts = sorted(r.sample(range(1, len(keys)), 14))
        parts = [set(keys[a:b]) for a, b in zip([0, *cuts], [*cuts, len(keys)])]
        want, plain = compare(spark, parts, previous, anchors, aliases)
        anchors, aliases = plain.anchors, aliases | dict(plain.new_aliases)
        previous = {k: want[min(p)] for p in parts for k in sorted(p) if r.random() < 0.9}


@pytest.mark.parametrize("seed", [1])
def test_rounds_equal_the_order(spark, seed):
    r = random.Random(seed)
    names = [f"n{i:03}" for i in range(14)]
    rows = {}
    for _ in range(18):
        a, b = sorted(r.sample(names, 2))
        rows[a, b] = ("auto_merge" if r.random() < 0.8 else r.choice(["review", "separate"]), r.random() < 0.06)
    decided = spark.createDataFrame([(a, b, d, c) for (a, b), (d, c) in rows.items()], "left_key string, right_key string, decision string, phones_conflict boolean")
    records = spark.createDataFrame([(n,) for n in names], "key string")
    results = []
    for bound in (10_000, 0):
        facility, blocked = matching.merged(records, decided, bound)
        results.append(({tuple(x) for x in facility.collect()}, {tuple(x) for x in blocked.select("left_key", "right_key").collect()}))
    assert results[0] == results[1] and results[0][1]
    plain = matching.merge_in_order(pd.DataFrame([(a, b, d, c) for (a, b), (d, c) in rows.items()], columns=["left_key", "right_key", "decision", "phones_conflict"]))
    assert {(x.key, x.other) for x in plain.itertuples() if x.kind == "member"} <= results[1][0]
    assert {(x.key, x.other) for x in plain.itertuples() if x.kind == "blocked"} == results[1][1]


def test_a_long_component_with_few_conflicts_takes_few_rounds(spark):
    n = 120
    ids = spark.range(n)
    name = lambda c: f"format_string('n%06d', {c})"
    chain = ids.filter(f"id < {n - 1}").selectExpr(f"{name('id')} AS left_key", f"{name('id + 1')} AS right_key", "'auto_merge' AS decision", "false AS phones_conflict")
    apart = spark.createDataFrame([("n000001", "n000118", "separate", False), ("n000030", "n000090", "review", False)], chain.schema)
    facility, blocked = matching.merged(ids.selectExpr(f"{name('id')} AS key"), chain.unionByName(apart), 0)
    assert [tuple(x) for x in blocked.collect()] == [("n000089", "n000090")]
    assert {tuple(x) for x in facility.groupBy("facility").count().collect()} == {("n000000", 90), ("n000090", 30)}

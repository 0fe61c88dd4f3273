"""Association rules against a brute-force Apriori in Python."""

import itertools
import random
from collections import Counter

from civiclens.operators import rules


def _long_table(seed=3, n_uid=400):
    rnd = random.Random(seed)
    rows = []
    for uid in range(n_uid):
        for attr, card in (("age", 3), ("race", 2), ("sex", 2), ("vdecile", 4), ("zone", 3)):
            if attr == "zone" and uid % 7 == 0:
                continue  # some uids lack an attribute
            rows.append((uid, attr, rnd.randrange(card) + 1))
    return rows


def _brute(rows, supp, conf, prot, cons="vdecile", protected="race"):
    by_uid = {}
    for uid, a, v in rows:
        by_uid.setdefault(uid, []).append((a, v))
    f1 = {k: c for k, c in Counter((a, v) for _, a, v in rows).items() if c >= supp}
    c2 = Counter()
    for items in by_uid.values():
        for x, y in itertools.permutations(items, 2):
            if x[0] < y[0] and x in f1 and y in f1:
                c2[(x, y)] += 1
    f2 = {k: c for k, c in c2.items() if c >= supp}
    c3 = Counter()
    for items in by_uid.values():
        for x, y, z in itertools.permutations(items, 3):
            if ((x, y) in f2 and (x, z) in f2 and z[0] == cons and y[0] != cons):
                c3[(x, y, z)] += 1
    f3 = {k: c for k, c in c3.items() if c >= supp}
    r2 = {(x, y): (s, s / f1[x]) for (x, y), s in f2.items() if y[0] == cons and s / f1[x] >= conf}
    r3 = {(x, y, z): (s, s / f2[(x, y)]) for (x, y, z), s in f3.items() if s / f2[(x, y)] >= conf}
    pd = {k: v[1] / r2[(k[0], k[2])][1] for k, v in r3.items()
          if k[1][0] == protected and (k[0], k[2]) in r2 and v[1] / r2[(k[0], k[2])][1] >= prot}
    return f1, f2, f3, r2, r3, pd


def test_all_levels_match_brute_force(spark):
    rows = _long_table()
    items = spark.createDataFrame(rows, "uid int, attr string, val int").repartition(5)
    got = rules.mine_rules(items, supp=20, conf=0.2, prot=1.0, protected="race")
    f1, f2, f3, r2, r3, pd = _brute(rows, 20, 0.2, 1.0)
    assert {(r.attr, r.val): r.supp for r in got.f1.collect()} == f1
    assert {((r.attr1, r.val1), (r.attr2, r.val2)): r.supp for r in got.f2.collect()} == f2
    assert {((r.attr1, r.val1), (r.attr2, r.val2), (r.attr3, r.val3)): r.supp
            for r in got.f3.collect()} == f3
    got_r2 = {((r.attr1, r.val1), (r.attr2, r.val2)): (r.supp, r.conf) for r in got.r2.collect()}
    assert got_r2.keys() == r2.keys()
    assert all(abs(got_r2[k][1] - r2[k][1]) < 1e-12 for k in r2)
    assert {((r.attr1, r.val1), (r.attr2, r.val2), (r.attr3, r.val3)) for r in got.r3.collect()} == set(r3)
    pruned = rules.frequent_triples(items, got.f1, got.f2, 20, "vdecile")
    assert {((r.attr1, r.val1), (r.attr2, r.val2), (r.attr3, r.val3)): r.supp
            for r in pruned.collect()} == f3
    got_pd = {((r.attr1, r.val1), (r.attr2, r.val2), (r.attr3, r.val3)): r.prot for r in got.pd_r3.collect()}
    assert got_pd.keys() == pd.keys() and all(abs(got_pd[k] - pd[k]) < 1e-12 for k in pd)


def test_properties_and_partition_invariance(spark):
    rows = _long_table(seed=11)
    one = spark.createDataFrame(rows, "uid int, attr string, val int").coalesce(1)
    many = one.repartition(8)
    f1_a = sorted(tuple(r) for r in rules.frequent_items(one, 15).collect())
    f1_b = sorted(tuple(r) for r in rules.frequent_items(many, 15).collect())
    assert f1_a == f1_b
    f1 = rules.frequent_items(many, 15)
    item_supp = {(r.attr, r.val): r.supp for r in f1.collect()}
    for r in rules.frequent_pairs(many, f1, 15).collect():
        assert r.supp <= min(item_supp[(r.attr1, r.val1)], item_supp[(r.attr2, r.val2)])
        assert r.attr1 < r.attr2


def test_any_position_has_rules_on_both_sides_of_the_consequent(spark):
    """Consequent and protected attribute in the middle of the name order."""
    rows = _long_table(seed=5)
    items = spark.createDataFrame(rows, "uid int, attr string, val int").repartition(3)
    got = rules.mine_rules(items, supp=10, conf=0.1, prot=0.9, consequent="sex", protected="vdecile",
                           any_position=True)
    by_uid = {}
    for uid, a, v in rows:
        by_uid.setdefault(uid, set()).add((a, v))
    n = Counter()
    for held in by_uid.values():
        for size in (1, 2, 3):
            n.update(frozenset(c) for c in itertools.combinations(held, size))

    def rule(left, right):
        both = n[frozenset(left | {right})]
        return (both, both / n[frozenset(left)]) if both >= 10 else (0, 0.0)

    every = {x for x in n if len(x) == 1 and n[x] >= 10}
    left = sorted(i for x in every for i in x if i[0] != "sex")
    right = [i for x in every for i in x if i[0] == "sex"]
    r2 = {(x, z): rule({x}, z)[1] for x in left for z in right if rule({x}, z)[1] >= 0.1}
    r3 = {(x, y, z): rule({x, y}, z)[1] for x in left for y in left for z in right
          if x[0] < y[0] and rule({x, y}, z)[1] >= 0.1}
    pd = {}
    for (x, y, z), conf in r3.items():
        for protected, other in ((x, y), (y, x)):
            if protected[0] == "vdecile" and (other, z) in r2 and conf / r2[other, z] >= 0.9:
                pd[x, y, z] = conf / r2[other, z]
    assert any(x[0] > "sex" for x, _ in r2) and any(x[0] == "vdecile" for x, _, _ in pd)
    assert {((r.attr1, r.val1), (r.attr2, r.val2)): round(r.conf, 9) for r in got.r2.collect()} == {
        k: round(v, 9) for k, v in r2.items()}
    triple = lambda r: ((r.attr1, r.val1), (r.attr2, r.val2), (r.attr3, r.val3))
    assert {triple(r): round(r.conf, 9) for r in got.r3.collect()} == {k: round(v, 9) for k, v in r3.items()}
    assert {triple(r): round(r.prot, 9) for r in got.pd_r3.collect()} == {k: round(v, 9) for k, v in pd.items()}


def test_uids_with_many_items(spark):
    """Baskets that are cut, repeated items, several consequent items a uid."""
    rnd = random.Random(9)
    rows = [(u, f"a{rnd.randrange(12):02}", rnd.randrange(2)) for u in range(40) for _ in range(rnd.choice([3, 30]))]
    rows += [(u, "vdecile", rnd.randrange(3)) for u in range(40) for _ in range(2)] + [(None, "a01", 1)] * 50
    items = spark.createDataFrame(rows, "uid int, attr string, val int")
    f1 = rules.frequent_items(items, 5)
    grouped = rules.baskets(items, f1, "vdecile", size=4)
    assert grouped.selectExpr("max(size(items))").first()[0] == 4
    by_uid = {}
    for uid, a, v in rows:
        if uid is not None:
            by_uid.setdefault(uid, []).append((a, v))
    c2, c3, both = Counter(), Counter(), Counter()
    ok = {(r.attr, r.val) for r in f1.collect()}
    for its in by_uid.values():
        its = [i for i in its if i in ok]
        for x, y in itertools.permutations(its, 2):
            if x[0] < y[0]:
                c2[x + y] += 1
            elif y[0] == "a05" and x[0] != "a05":
                both[x + y] += 1
        for x, y in itertools.permutations(its, 2):
            for z in its:
                if x[0] < y[0] and z[0] == "vdecile" and y[0] != "vdecile":
                    c3[x + y + z] += 1
    least = 6
    keep = lambda c: {k: n for k, n in c.items() if n >= least}
    assert {tuple(r)[:4]: r.supp for r in rules.frequent_pairs(items, f1, least, grouped=grouped).collect()} == keep(c2)
    assert {tuple(r)[:4]: r.supp for r in rules.frequent_pairs(items, f1, least, "a05", grouped).collect()} == keep(c2 + both)
    assert {tuple(r)[:6]: r.supp for r in rules.frequent_triples(
        items, f1, None, least, "vdecile", grouped=grouped).collect()} == keep(c3)
    assert {tuple(r)[:4]: r.supp for r in rules.frequent_pairs(items, f1, least).collect()} == keep(c2)


def test_one_shuffle_by_uid(spark):
    items = spark.createDataFrame(_long_table(), "uid int, attr string, val int")
    grouped = rules.baskets(items, rules.frequent_items(items, 20), "vdecile")
    plan = grouped._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(uid") == 1
    f3 = rules.frequent_triples(items, rules.frequent_items(items, 20), None, 20)
    assert "hashpartitioning(uid" not in f3._jdf.queryExecution().executedPlan().toString()


def test_equal_baskets_are_counted_together(spark):
    """300 uids with one of 2 item sets, a uid whose items fill three baskets and
    rows without a uid: as many rows to enumerate as there are different baskets."""
    rows = [(u, a, u % 2) for u in range(300) for a in ("a", "b", "vdecile")]
    rows += [(900, a, v) for a in ("a", "b") for v in (0, 1, 1)] + [(None, "a", 1)] * 9
    items = spark.createDataFrame(rows, "uid int, attr string, val int").repartition(4)
    f1 = rules.frequent_items(items, 2)
    grouped = rules.baskets(items, f1, "vdecile", size=2).cache()
    counted = rules.counted_baskets(grouped).cache()
    assert grouped.count() == 603 and counted.count() == 603
    whole = rules.counted_baskets(rules.baskets(items, f1, "vdecile"))
    got = sorted((len(r["items"]), r.uid, r.chunk, r.n) for r in whole.collect())
    assert got == [(3, None, 0, 150), (3, None, 0, 150), (6, None, 0, 1)]
    for g in (grouped, counted, rules.counted_baskets(rules.baskets(items, f1, "vdecile"))):
        two = {tuple(r)[:4]: r.supp for r in rules.frequent_pairs(items, f1, 1, "a", grouped=g).collect()}
        assert two["a", 0, "b", 0] == 151 and two["a", 1, "b", 1] == 154 and two["vdecile", 1, "a", 1] == 150
        assert two["a", 0, "b", 1] == 2 and len(two) == 14
        three = {tuple(r)[:6]: r.supp for r in rules.frequent_triples(
            items, f1, None, 1, "vdecile", grouped=g).collect()}
        assert three == {("a", v, "b", v, "vdecile", v): 150 for v in (0, 1)}


def test_mined_levels_read_counted_baskets(spark, monkeypatch):
    seen = []
    pairs = rules.frequent_pairs
    monkeypatch.setattr(rules, "frequent_pairs", lambda *a: seen.append(a[-1]) or pairs(*a))
    items = spark.createDataFrame(_long_table(), "uid int, attr string, val int")
    rules.mine_rules(items, 20, 0.2, 1.0)
    n = seen[0].agg({"n": "sum"}).first()[0]
    assert n == 400 and seen[0].count() <= 192


def _as_rows(grouped):
    return sorted((tuple((i.attr, i.val) for i in r["items"]), tuple((i.attr, i.val) for i in r["cons"]),
                   -1 if r.uid is None else r.uid, r.chunk, r.n) for r in grouped.collect())


def test_grouped_baskets_are_the_counted_ones(spark, monkeypatch):
    """Uids with one value of an attribute, with several (repeated or not), with
    rare items beside frequent ones, without the consequent; NULL uids and values."""
    rnd = random.Random(4)
    rows = [(u, a, rnd.randrange(3)) for u in range(120) for a in ("b", "a", "vdecile", "z") if rnd.random() < 0.8]
    rows += [(u, a, rnd.randrange(3)) for u in range(110, 150) for a in ("a", "vdecile") for _ in range(rnd.randrange(4))]
    rows += [(u, "a", 100 + u) for u in range(40)] + [(u, "vdecile", 1) for u in range(30, 36)] * 2
    rows += [(None, "a", 1)] * 9 + [(u, "b", None) for u in range(20)] + [(u, None, 1) for u in range(20)]
    rows += [(200, "a", rnd.randrange(3)) for _ in range(200)] + [(200, "vdecile", 2)]
    items = spark.createDataFrame(rows, "uid int, attr string, val int").repartition(3)
    f1 = rules.frequent_items(items, 8)
    want = _as_rows(rules.counted_baskets(rules.baskets(items, f1, "vdecile")))
    assert any(len(w[0]) > 40 for w in want) and any(not w[1] for w in want)
    assert _as_rows(rules.grouped_baskets(items, f1, "vdecile")) == want
    one = items.filter("uid < 110 AND NOT uid BETWEEN 30 AND 35")
    lists = rules.baskets
    monkeypatch.setattr(rules, "baskets", None)  # no lists where a uid has one value of an attribute
    got = _as_rows(rules.grouped_baskets(one, f1, "vdecile", None))
    got_none = _as_rows(rules.grouped_baskets(one, f1, "none", None))
    monkeypatch.setattr(rules, "baskets", lists)
    assert got == _as_rows(rules.counted_baskets(rules.baskets(one, f1, "vdecile"))) != []
    assert got_none == _as_rows(rules.counted_baskets(rules.baskets(one, f1, "none")))
    monkeypatch.setattr(rules, "WIDE", 2)
    assert _as_rows(rules.grouped_baskets(items, f1, "vdecile")) == want
    assert rules.grouped_baskets(items, rules.frequent_items(items, 10 ** 6), "vdecile").count() == 0


def test_partly_gathered_rows_are_shuffled(spark, monkeypatch):
    """Rows of a uid are combined before their shuffle, and the long table is not
    written down where it is melted from a computed one."""
    seen = []
    kept = rules.materialize
    monkeypatch.setattr(rules, "materialize", lambda d, *a: seen.append(d) or kept(d, *a))
    wide = spark.range(1000).selectExpr("id AS u", "id % 3 AS age", "id % 2 AS race", "id % 4 AS vdecile").cache()
    got = rules.mine_rules(rules.long_items(wide, "u", ["age", "race", "vdecile"]), 10, 0.2, 0.5, keep_items=False)
    assert not any(d.columns == ["uid", "attr", "val"] for d in seen)
    plan = seen[1]._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "Window" not in plan and "collect_list" not in plan
    same = rules.mine_rules(rules.long_items(wide, "u", ["age", "race", "vdecile"]), 10, 0.2, 0.5)
    for level in ("f1", "f2", "f3", "r2", "r3", "pd_r3"):
        a, b = (sorted(map(tuple, getattr(x, level).collect())) for x in (got, same))
        assert a == b != []
